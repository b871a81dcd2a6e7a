import random

import numpy as np

from cadence.llm import toxicity
from cadence.llm.toxicity import INSULT, NEGATION, PATTERNS, PLAIN, QUOTE, REPORT, TARGET, THREAT


def names(symbols):
    return [PATTERNS[p] for p in toxicity.match(symbols)]


def test_grammar():
    assert names([PLAIN, INSULT]) == [(INSULT, "bare", "said")]
    assert names([TARGET, PLAIN, INSULT]) == [(INSULT, "aimed", "said")]
    assert names([INSULT, PLAIN, TARGET]) == [(INSULT, "aimed", "said")]
    assert names([TARGET, PLAIN, PLAIN, PLAIN, PLAIN, PLAIN, INSULT]) == [(INSULT, "bare", "said")]
    assert names([TARGET, NEGATION, INSULT]) == [(INSULT, "aimed", "negated")]
    assert names([REPORT, PLAIN, PLAIN, PLAIN, PLAIN, PLAIN, PLAIN, INSULT]) == [(INSULT, "bare", "reported")]
    assert names([QUOTE, INSULT, QUOTE, THREAT, TARGET]) == [(INSULT, "bare", "reported"), (THREAT, "aimed", "said")]
    assert names([PLAIN, TARGET]) == [] == names([])


def test_composition_equals_its_parts():
    rng = random.Random(2)
    parts = [toxicity._hostile(), toxicity._countdown(TARGET, 4), toxicity._countdown(NEGATION, 4), toxicity._reported()]
    whole = toxicity.compose(*parts)
    for _ in range(200):
        state, states = whole.start, [p.start for p in parts]
        for _ in range(12):
            symbol = rng.randrange(7)
            state, out = whole(state, symbol)
            for i, p in enumerate(parts):
                states[i], o = p(states[i], symbol)
                assert o == out[i]


def test_clauses_and_words_in_texts():
    lexicon = {k: np.zeros(0, np.uint64) for k in (0, *toxicity.PREFIXES)}
    lexicon[0] = toxicity._hash_words("zork")
    lexicon[4] = np.sort(toxicity.tk.hash_spans(np.frombuffer(b"blag", np.uint8), np.array([0]), np.array([4])))
    texts = ["You are a ZORK!", "He said: you zork", "Not a blagger. You", "zorks blag", "", "x"]
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    got = toxicity.Reader(raw, offsets).counts(lexicon, len(texts))
    want = {0: (INSULT, "aimed", "said"), 1: (INSULT, "aimed", "reported"), 2: (INSULT, "bare", "negated")}
    for i in range(len(texts)):
        assert [PATTERNS[j] for j in np.flatnonzero(got[i])] == ([want[i]] if i in want else [])


def planted(spark, n=900):
    rng = random.Random(8)
    vocab = [f"{a}{b}" for a in "ba ne ri to lu ka so mi".split() for b in "ran tel dos fim gup".split()]
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice(vocab) for _ in range(rng.randrange(20, 120))]
        toxic = i % 6 == 0
        for _ in range(rng.randrange(2, 5) if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(["grumble", "snark" + rng.choice(vocab), "Fzzt"]))
        docs.append((i, " ".join(words), "x"))
        labels.append((i, int(toxic)))
    return spark.createDataFrame(docs, "doc_id long, text string, score string"), spark.createDataFrame(labels, "doc_id long, toxic int"), labels


def test_learned_from_labels_and_held_out_accuracy(spark):
    docs, labels, truth = planted(spark)
    got = {r.doc_id: r for r in toxicity.predictions(docs, labels).collect()}
    held = [i for i in got if got[i].held_out]
    assert len(got) == 900 and 120 < len(held) < 240
    right = sum(got[i].predicted == t for i, t in truth if got[i].held_out)
    assert right >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())


def test_held_out_accuracy_on_the_table(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.predictions(docs, labels).where("held_out").join(labels, "doc_id").groupBy("toxic", "predicted").count().collect()
    n = {(r.toxic, r.predicted): r["count"] for r in rows}
    assert n.get((0, 1), 0) <= 0.01 * (n[0, 0] + n.get((0, 1), 0))  # a part of this table's toxic labels has no mark in the text
    assert n[1, 1] >= 0.8 * (n[1, 1] + n.get((1, 0), 0))


def test_edges(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "zork"), (3, "a " * 100_000), (3, "a " * 100_000)], "doc_id long, text string")
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int")
    rows = toxicity.predictions(docs, none).collect()
    assert len(rows) == 5 and all(r.predicted == 0 for r in rows)
    model = toxicity.train(docs, none)
    assert toxicity.reject_toxic(docs, model).count() == 5
    assert toxicity.predictions(docs.limit(0), none).collect() == []


def test_short_texts_do_not_depend_on_batches(spark):
    """Texts under five words are copies of equal texts only, however the rows are cut."""
    rows = [(i, f"word{i}", 0.0) for i in range(40)] + [(100 + i, "Same Text", 1.0) for i in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, label double")
    kept = [sorted(r.doc_id for r in toxicity.independent(df.repartition(n)).collect()) for n in (1, 4, 8)]
    assert kept[0] == kept[1] == kept[2] == [*range(40), 100]
