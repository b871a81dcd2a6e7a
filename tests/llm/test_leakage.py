import math
import random
from collections import Counter

import numpy as np

from cadence.llm import leakage

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def sentence(rng, vocab, n):
    return " ".join(rng.choice(vocab) for _ in range(n)).capitalize() + "."


def corpus(seed=3):
    rng = random.Random(seed)
    common = [f"c{chr(97 + i)}" for i in range(20)]
    rare = [f"{a}{b}{c}" for a in "ba ne ri to".split() for b in "ran tel dos".split() for c in "a e i o u".split()]
    vocab = common * 12 + rare
    items = [(i, sentence(rng, vocab, rng.randrange(10, 30)) + " " + sentence(rng, vocab, rng.randrange(3, 12))) for i in range(60)]
    docs = []
    for d in range(150):
        parts = [sentence(rng, vocab, rng.randrange(5, 40)) for _ in range(rng.randrange(1, 12))]
        if d % 5 == 0:
            parts.insert(rng.randrange(len(parts) + 1), rng.choice(items)[1].upper() if d % 2 else rng.choice(items)[1])
        docs.append((d, "\n".join(parts)))
    return docs, items


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b):
            before, row[j + 1] = row[j + 1], before + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def test_in_order_is_the_longest_common_subsequence():
    rng = random.Random(1)
    for _ in range(300):
        a, b = ([rng.randrange(6) for _ in range(rng.randrange(1, 90))] for _ in range(2))
        assert leakage.in_order(a, b) == lcs(a, b) / len(a)


def scores(index, words):
    """Every item's score for a set of words, by adding up impacts."""
    out = {}
    for w in words:
        if w in index.postings:
            for j, s in zip(*index.postings[w][:2]):
                out[j] = out.get(j, 0.0) + s
    return out


def test_search_and_candidates_lose_no_item_above_the_threshold():
    docs, items = corpus()
    for threshold in (0.2, 0.35, 0.5):
        index = leakage.Index(items, threshold)
        for _, text in docs[:80]:
            words = leakage._words(text)
            want = {j: round(s, 9) for j, s in scores(index, set(words)).items() if s >= threshold}
            assert {j: round(s, 9) for j, s in index.search(set(words))} == want
            half = np.zeros(len(words), dtype=np.int64)
            found = index.candidates(np.array(words, dtype=np.uint64), half, half, half)
            if want:
                assert found.tolist() == [0]


def brute(docs, items):
    """Every passage of every document against every item: passages are twice the item's own words long and start at
    multiples of its length; BM25 shares are worked out here, over all items."""
    parts = {i: leakage._words(t) for i, t in items}
    parts = {i: w for i, w in parts.items() if w}
    mean = sum(map(len, parts.values())) / len(parts)
    held = Counter(w for words in parts.values() for w in set(words))
    share = {}
    for i, words in parts.items():
        tf = Counter(words)
        norm = leakage.K1 * (1 - leakage.B + leakage.B * len(words) / mean)
        one = {w: math.log(1 + (len(parts) - held[w] + 0.5) / (held[w] + 0.5)) * f * (leakage.K1 + 1) / (f + norm) for w, f in tf.items()}
        share[i] = {w: x / sum(one.values()) for w, x in one.items()}
    texts = dict(items)
    out = set()
    for d, text in docs:
        words = leakage._words(text or "")
        for i, own in parts.items():
            for lo in range(0, len(words), len(own)):
                passage = words[lo : lo + 2 * len(own)]
                seen = set(passage)
                if sum(x for w, x in share[i].items() if w in seen) >= 0.5 - 1e-9:
                    if all(lcs(p, passage) / len(p) >= 0.8 for p in leakage.question_and_answer(texts[i])):
                        out.add((d, i))
    return out


def test_matches_brute_force(spark):
    docs, items = corpus(9)
    got = leakage.find_leaks(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)).collect()
    assert {(r.doc_id, r.item_id) for r in got} == brute(docs, items) and len(got) >= 30


def test_a_question_and_its_answer_are_found_near_each_other_only(spark):
    """The two may be parted by some words, as long as both stand in one passage of twice the item's words."""
    question, answer = "Which of the lorin vexes the tamble quod in dref?", "It is the parlim sotte."
    item = f"{question} {answer}"
    fill = " ".join(f"filler{i}" for i in range(40))
    docs = [(1, f"{question} well now {answer}"), (2, f"{question} {fill} {answer}"), (3, f"{fill} {question} {answer}")]
    got = leakage.find_leaks(spark.createDataFrame(docs, DOCS), spark.createDataFrame([(1, item)], ITEMS)).collect()
    assert sorted(r.doc_id for r in got) == [1, 3]
    assert {(r.doc_id, r.item_id) for r in got} == brute(docs, [(1, item)])


def test_shards_give_the_same_leaks_and_table_agrees(spark, monkeypatch):
    docs, items = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "benchmark"))
    texts = {r.item_id: r.text for r in items.collect()}
    want = {(r.doc_id, i) for r in docs.collect() for i, t in texts.items() if t and r.text and t in r.text}
    assert {(r.doc_id, r.item_id) for r in leakage.find_leaks(docs, items).collect()} == want and want
    monkeypatch.setattr(leakage, "indexes", lambda b: __import__("itertools").chain(leakage_indexes(b, 2000)))
    assert {(r.doc_id, r.item_id) for r in leakage.find_leaks(docs, items).collect()} >= want
    assert leakage.drop_leaks(docs, items).count() <= docs.count() - len({d for d, _ in want})


leakage_indexes = leakage.indexes


def test_edges(spark):
    item = "What is the zorbal of quindle frax? It is the mantel gruve."
    items = [(1, item), (2, None), (3, ""), (4, "..."), (None, item), (5, "single")]
    docs = [(1, None), (2, ""), (3, f"before {item.lower()} after"), (3, f"before {item.lower()} after"), (None, item), (4, "What is the zorbal of quindle frax?"), (5, "x " * 50_000 + item)]
    d, b = spark.createDataFrame([(*r, 1) for r in docs], DOCS + ", item_id int"), spark.createDataFrame(items, ITEMS)
    got = sorted(((r.doc_id, r.item_id) for r in leakage.find_leaks(d, b).collect()), key=str)
    assert got == sorted([(i, j) for i in (3, 3, None, 5) for j in (1, None)], key=str)
    assert sorted((r.doc_id for r in leakage.drop_leaks(d, b).collect()), key=str) == [1, 2, 4]
    assert leakage.find_leaks(d, b.limit(0)).collect() == [] == leakage.find_leaks(d.limit(0), b).collect()
