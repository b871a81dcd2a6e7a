import random

import duckdb
import re

from cadence.llm import lines

SCHEMA = "doc_id long, text string"


def brute(rows):
    """doc_id -> (text, n_lines, n_removed); rows with distinct ids."""
    seen, out = set(), {}
    for i, text in sorted(rows):
        if text is None:
            out[i] = (None, 0, 0)
            continue
        parts = text.split("\n")
        used = [n for n, p in enumerate(parts) if re.search(r"[^\x20\x09-\x0D]", p)]
        gone = set()
        for j in range(len(used) - 2):
            key = tuple(parts[used[j + d]] for d in range(3))
            if key in seen:
                gone.update(used[j : j + 3])
            seen.add(key)
        out[i] = ("\n".join(p for n, p in enumerate(parts) if n not in gone), len(used), len(gone))
    return out


def result(spark, rows):
    return {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in lines.deduplicate_lines(spark.createDataFrame(rows, SCHEMA)).collect()}


def test_random_corpora_match_brute_force(spark):
    rng = random.Random(3)
    rows = [(i, "\n".join(rng.choice(["a", "b", "c", "", " ", "d d", "e\r"]) for _ in range(rng.randrange(12)))) for i in range(150)] + [(999, None)]
    assert result(spark, rows) == brute(rows)


def test_table_matches_brute_force_and_oracle(spark):
    path = "/root/testdata/sf0.01/documents.parquet"
    docs = spark.read.parquet(path).select("doc_id", "text")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in lines.deduplicate_lines(docs).collect()}
    assert got == brute(rows) and sum(v[2] for v in got.values()) > 100
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{path}'")
    assert {r[0]: r[1:] for r in con.execute(lines.ORACLE_SQL).fetchall()} == got


def test_edges(spark):
    t = "x\ny\nz"
    rows = [(1, t), (2, t), (2, t), (None, t), (3, "x\ny"), (4, ""), (5, "q\n\nx\ny\n\nz\nend"), (6, "r\nr\nr\nr\nr")]
    df = spark.createDataFrame([(*r, "keep", 5) for r in rows], "doc_id long, text string, `row` string, n_lines int")
    got = sorted(((r.doc_id, r.text, r.row, r.n_lines, r.n_removed) for r in lines.deduplicate_lines(df).collect()), key=str)
    want = [(1, t, 3, 0), (2, "", 3, 3), (2, "", 3, 3), (None, t, 3, 0), (3, "x\ny", 2, 0), (4, "", 0, 0), (5, "q\n\n\nend", 5, 3), (6, "r", 5, 4)]
    assert got == sorted(((i, x, "keep", n, g) for i, x, n, g in want), key=str)
    assert lines.deduplicate_lines(df.limit(0)).collect() == []


def test_long_text(spark):
    text = "\n".join(f"line {i % 5000}" for i in range(30_000))
    assert result(spark, [(1, text)]) == brute([(1, text)])
