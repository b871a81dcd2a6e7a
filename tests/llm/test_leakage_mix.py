import random

from cadence.llm import leakage
from test_leakage import DOCS, ITEMS, corpus, sentence


def leaks(spark, docs, items):
    out = leakage.find_leaks(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)).collect()
    return sorted((r.doc_id, r.item_id, round(r.score, 9), r.question_overlap, r.answer_overlap, r.first_word) for r in out)


def test_a_long_item_does_not_widen_the_passages_of_short_ones(spark):
    rng = random.Random(4)
    vocab = [f"{a}{b}{c}" for a in "bcdfg" for b in "aeiou" for c in "klmnp"]
    short = (1, "Zorbal quindle frax mantel gruve tolin? Ostrap.")
    scattered = " ".join(w for x in "zorbal quindle frax mantel gruve tolin ostrap".split() for w in [x, *(rng.choice(vocab) for _ in range(150))])
    docs = [(1, scattered), (2, f"{scattered} {short[1]}")]
    long = (2, sentence(rng, vocab, 900) + " " + sentence(rng, vocab, 100))
    assert {r[:2] for r in leaks(spark, docs, [short, long])} == {(2, 1)}


def test_shards_change_nothing(spark, monkeypatch):
    docs, items = corpus(9)
    want = leaks(spark, docs, items)
    whole = leakage.indexes
    shards = []
    monkeypatch.setattr(leakage, "indexes", lambda b: (shards.append(s) or s for s in whole(b, 1500)))
    assert leaks(spark, docs, items) == want and len(want) >= 30 and len(shards) > 3
