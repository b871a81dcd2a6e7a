import itertools
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from cadence.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def fewest(lengths, capacity):
    """Fewest bins by trying all assignments (bins in order of first use)."""
    best = len(lengths)

    def place(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(lengths):
            best = len(bins)
            return
        for r in sorted({b for b in bins if b >= lengths[i]}):
            bins.remove(r)
            place(i + 1, [*bins, r - lengths[i]])
            bins.append(r)
        place(i + 1, [*bins, capacity - lengths[i]])

    lengths = sorted(lengths, reverse=True)
    place(0, [])
    return best


def test_bin_completion_is_optimal_on_small_cases():
    rng = random.Random(4)
    for _ in range(60):
        lengths = [rng.randrange(10, 60) for _ in range(rng.randrange(1, 10))]
        bins = packing.bin_completion(lengths, 100, width=50)
        assert sorted(itertools.chain(*bins)) == sorted(lengths) and max(map(sum, bins)) <= 100
        assert len(bins) == fewest(lengths, 100)


def test_never_worse_than_best_fit_and_loses_nothing():
    rng = random.Random(5)
    for n, nodes in itertools.product((1, 30, 200), (1, 7, 500)):
        lengths = [rng.randrange(20, 70) for _ in range(n)]
        bins = packing.bin_completion(lengths, 100, nodes=nodes)
        assert sorted(itertools.chain(*bins)) == sorted(lengths) and max(map(sum, bins)) <= 100
        assert len(bins) <= len(packing.best_fit(lengths, 100))


def test_beats_best_fit():
    # 44 + 30 + 26, 42 + 30 + 28 and 40 + 30 + 30 fill three bins; best fit opens a fourth.
    assert len(packing.best_fit([44, 42, 40, 30, 28, 26, 30, 30, 30], 100)) == 4
    lengths = [44, 42, 40, 30, 28, 26, 30, 30, 30]
    assert len(packing.bin_completion(lengths, 100)) == 3


def test_fillings_are_maximal_and_undominated():
    lengths, room = [50, 40, 30, 30, 20, 7], 60
    count = [0] * 101
    for x in lengths:
        count[x] += 1
    found = packing.fillings(count, sum(1 << x for x in set(lengths)), room, 50)
    assert found[0] in ((40, 20), (30, 30))
    assert found == [(40, 20), (30, 30), (50, 7)] or found == [(30, 30), (40, 20), (50, 7)]  # 30 + 20 + 7 goes into 40 + 20


def check(rows, docs):
    library = Tokenizer.from_file(PATH)
    want = []
    for i, t in docs:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 1]
        for n, at in enumerate(range(0, len(ids), 4096)):
            part = ids[at : at + 4096]
            want.append((i, n, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=str) == sorted(want, key=str)
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 4096
    return len(by)


def test_query_on_the_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = packing.pack(docs, PATH).collect()
    n = check(rows, [(r.doc_id, r.text) for r in docs.collect()])
    assert n <= -(-sum(r.length for r in rows) // 4096) + 1


def test_edges(spark):
    texts = [(1, None), (2, ""), (3, " \n"), (None, "Don't <|endoftext|> STOP"), (4, "déjà vu, Σ ΟΔΟΣ × 12"), (5, "x " * 20_000), (5, "x " * 20_000), (6, "a " * 4095)]
    df = spark.createDataFrame([(*t, 9) for t in texts], "doc_id long, text string, sequence_id int")
    check(packing.pack(df, PATH).collect(), texts)
    assert packing.pack(df.limit(0), PATH).collect() == []


def test_batches_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(packing, "PIECES_PER_BATCH", 50)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    check(packing.pack(docs, PATH).collect(), [(r.doc_id, r.text) for r in docs.collect()])


def test_short_lengths_fill_their_bins():
    rng = np.random.default_rng(5)
    rng.integers(20, 400, 3000)
    lengths = rng.integers(100, 800, 3000).tolist()
    bound = -(-sum(lengths) // 4096)
    assert len(packing.best_fit(lengths, 4096)) == bound + 1
    bins = packing.bin_completion(lengths, 4096)
    assert sorted(itertools.chain(*bins)) == sorted(lengths) and max(map(sum, bins)) <= 4096
    assert len(bins) == bound


def test_lengths_of_a_mask():
    rng = random.Random(6)
    for most in (0, 1, 7, 8, 63, 400):
        have = sorted(rng.sample(range(1, 500), 60))
        assert packing.lengths_of(sum(1 << x for x in have), most) == [x for x in have if x <= most]


def test_pieces_do_not_depend_on_what_is_remembered(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    check(packing.pack(docs, PATH, remembered=100).collect(), [(r.doc_id, r.text) for r in docs.collect()])
