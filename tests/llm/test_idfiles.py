import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cadence.llm import encoders, idfiles
from cadence.session import scratch_path

PATH = public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.001"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1), st.sampled_from([255, 256, 65535, 65536, 2**24 - 1, 2**24]))))
def test_values_round_trip(values):
    control, data = idfiles.pack_values(np.array(values, dtype=np.uint32))
    assert len(control) == -(-len(values) // 4)
    assert len(data) == sum(max(1, -(-v.bit_length() // 8)) for v in values)
    assert idfiles.unpack_values(control, data, len(values)).tolist() == values


def expected(rows):
    """(doc_id, start, n, crc) in the documented order, straight from the library."""
    lib = Tokenizer.from_file(PATH)
    out, start = [], 0
    for i, t in rows:
        ids = np.array([*lib.encode(t or "", add_special_tokens=False).ids, 2], dtype="<u4")
        out.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_table_against_the_library(spark, monkeypatch):
    monkeypatch.setattr(idfiles, "BLOCK_IDS", 500)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = sorted(tuple(r) for r in idfiles.round_trip(docs, PATH).collect())
    assert got == expected(sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()))


def test_edges(spark):
    long = "word " * 90_000
    rows = [(3, "b", 1), (None, "a", 2), (1, None, 3), (2, "", 4), (7, "<|endoftext|> x 日本", 5), (9, long, 6), (9, long, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start long").repartition(4)
    got = idfiles.round_trip(docs, PATH)
    want = expected([(None, "a"), (1, None), (2, ""), (3, "b"), (7, "<|endoftext|> x 日本"), (9, long), (9, long)])
    assert sorted(map(tuple, got.collect()), key=lambda r: r[1]) == want
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    none = idfiles.round_trip(docs.where("false"), PATH)
    assert none.count() == 0


def test_several_texts_of_one_id_and_ids(spark):
    docs = spark.createDataFrame([(5, "one two"), (5, "three"), (4, "x")], "doc_id long, text string")
    path = scratch_path(spark, "test-token-files")
    idfiles.write_tokens(docs, PATH, path)
    got = idfiles.read_tokens(spark, path, with_ids=True).orderBy("start").collect()
    lib = Tokenizer.from_file(PATH)
    assert [r.doc_id for r in got] == [4, 5, 5]
    assert sorted(lib.decode(r.ids[:-1]) for r in got) == ["one two", "three", "x"]
    assert [r.start for r in got] == [0, got[0].n_tokens, got[0].n_tokens + got[1].n_tokens]
    ranks = spark.read.parquet(f"{path}/ranks").orderBy("rank").collect()
    assert ranks[0].id == 2 and [r["rank"] for r in ranks] == list(range(len(ranks)))


def test_frequent_ids_take_one_byte(spark):
    docs = spark.createDataFrame([(i, "the cat sat on the mat " * 50) for i in range(20)], "doc_id long, text string")
    path = scratch_path(spark, "test-token-files")
    idfiles.write_tokens(docs, PATH, path)
    for r in spark.read.parquet(f"{path}/blocks").collect():
        assert len(r.data) == r.n and set(r.control) <= {0}


@pytest.mark.parametrize("n", [1, 8])
def test_order_does_not_depend_on_partitions(spark, n):
    docs = spark.read.parquet(f"{SF}/documents.parquet").repartition(n)
    got = {r.doc_id: r.start for r in idfiles.round_trip(docs, PATH).collect()}
    assert got == {r[0]: r[1] for r in expected(sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()))}


def test_pieces_merge_as_in_the_library(spark):
    """Both kinds of merging agree on the distinct words of a table."""
    words = {" " + w for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect() for w in (r.text or "").split() if w.isalpha()}
    merge, lib = encoders.merger(PATH), Tokenizer.from_file(PATH)
    assert merge is not None and encoders.merger(public_tokenizers.path("word_bpe_49k.json")) is None
    for w in words:
        assert merge(w) == lib.encode(w, add_special_tokens=False).ids
