import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cadence.llm import tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")
BITS = ["a", "b", "re", "ing", "the", " ", "  ", "\n", "\t", " \n", "'", "'s", "'re", "'ll", "'v", "é", "É", "ß", "×", "1", "23", "!", "##", "<|endoftext|>", "<|", "日本", " ", "Σ", "ve", "I", "don't", "\x00"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def count(library, text):
    return len(library.encode(text, add_special_tokens=False).ids)


def test_every_prefix_of_random_texts(library):
    c, rng = tokens.PrefixCounter(PATH), random.Random(1)
    for _ in range(400):
        text = "".join(rng.choice(BITS) for _ in range(rng.randrange(14)))
        raw = np.frombuffer(text.encode(), np.uint8)
        row = c.rows(raw, np.array([0, len(raw)]))[0]
        assert c.totals(raw, np.array([0, len(raw)])).tolist() == [count(library, text)]
        for k in range(len(text) + 1):
            assert row[len(text[:k].encode())] == count(library, text[:k]), (text, k)


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=30))
def test_total_of_any_text(library, text):
    text = text.encode("utf-8", "ignore").decode()
    assert int(tokens.counter(PATH).prefixes(text)[-1]) == count(library, text)


def test_pairs_stay_apart_as_merging_says():
    c, rng = tokens.counter(PATH), random.Random(2)
    vocab = sorted(c.vocab)
    for _ in range(3000):
        a, b = rng.choice(vocab), rng.choice(vocab)
        if c.merge(a) == [a] and c.merge(b) == [b]:
            assert c.stay_apart(a, b) == (c.merge(a + b) == [a, b])


def test_query_on_the_table(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in tokens.over_limit(tokens.token_counts(docs, PATH), 512).collect()}
    for r in docs.select("doc_id", "text").collect():
        n = count(library, r.text or "")
        assert got[r.doc_id] == (len((r.text or "").encode()), n, n > 512)


def test_edges_and_budget_questions(spark, library):
    long = "word " * 60_000
    df = spark.createDataFrame([(1, None, 0), (2, "", 0), (3, "We've  seen\n\nthis <|endoftext|> é", 0), (None, "x", 0), (4, long, 0), (4, long, 0)], "doc_id long, text string, n_tokens int")
    got = sorted(tokens.token_counts(df, PATH).collect(), key=str)
    assert [(r.doc_id, r.n_bytes, r.n_tokens) for r in got][:2] == [(1, 0, 0), (2, 0, 0)]
    assert sum(r.doc_id == 4 and r.n_tokens == count(library, long) for r in got) == 2 and len(got) == 6
    row = next(r for r in tokens.prefix_counts(df, PATH).collect() if r.doc_id == 3)
    text = "We've  seen\n\nthis <|endoftext|> é"
    for k in range(len(text) + 1):
        assert tokens.count_at(row.steps, len(text[:k].encode())) == count(library, text[:k])
    for budget in range(row.n_tokens + 1):
        fits = [len(text[:k].encode()) for k in range(len(text) + 1) if count(library, text[:k]) <= budget]
        assert tokens.longest_within(row.steps, budget) >= max(fits)
    assert tokens.token_counts(df.limit(0), PATH).collect() == []


def test_piece_table_forgets_and_works_out_again():
    """Beyond its bounds the table forgets its older half; what it returns never changes, also for very long pieces."""
    import numpy as np

    from cadence.llm.pretokens import PieceTable

    table = PieceTable(lambda pieces: [[len(p), *p[:2]] for p in pieces], limit=50, limit_values=400)
    rng = np.random.default_rng(3)
    for _ in range(60):
        words = [bytes([97 + int(x)]) * int(n) for x, n in zip(rng.integers(0, 26, 30), rng.integers(1, 40, 30), strict=True)]
        raw = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum([len(w) for w in words])
        flat, at, length = table.look_up(raw, ends - np.diff(ends, prepend=0), ends)
        assert [flat[a : a + n].tolist() for a, n in zip(at, length, strict=True)] == [[len(w), *w[:2]] for w in words]
        assert len(table.keys) <= 50 + 30
    big = PieceTable(lambda pieces: [np.arange(len(p), dtype=np.uint32) for p in pieces])
    raw = np.full(16_777_221, 97, dtype=np.uint8)
    flat, at, length = big.look_up(raw, np.array([0]), np.array([len(raw)]))
    assert length[0] == len(raw) and flat[at[0] + length[0] - 1] == len(raw) - 1
