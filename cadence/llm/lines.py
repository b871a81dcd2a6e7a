"""Line deduplication by overlapping windows of three lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.llm.tables import drop, stored

_WORD = "[^\\\\x20\\\\x09-\\\\x0D]"

# Positions (from 0) of a text's lines that hold a word, and the hashes of those lines.
_LINES = "split(text, '\\n', -1)"
_USED = f"filter(sequence(0, size(lines) - 1), i -> lines[i] rlike '{_WORD}')"


def _prepared(docs: DataFrame) -> DataFrame:
    """row (all columns), doc_id, text hash, lines and the positions of lines with a word; null texts have none."""
    return (
        docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
        .select("row", F.expr("row.doc_id").cast("long").alias("id"), F.expr("row.text").alias("text"))
        .select("row", "id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("version"), F.expr(f"coalesce({_LINES}, array())").alias("lines"))
        .withColumn("used", F.expr(f"if(size(lines) = 0, array(), {_USED})"))
    )


def deduplicate_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated lines taken out of ``text``, and n_lines and n_removed (lines with a word).

    Lines are what \\n separates; a window is three lines in a row that hold a word (blank lines between them are
    passed over). A window's first occurrence in the corpus, by doc_id and position, stays; every later one covers
    its three lines, and the lines of a document that any such window covers are removed, blank lines never. Windows
    are compared by two 64-bit hashes over line hashes. The count of a window's occurrences and its first place are
    combined before the shuffle; the lookup of all occurrences is a join that adaptive execution can split.

    Edges: a null text stays null and an empty one empty; texts of fewer than three such lines stay; a text that
    loses all lines becomes empty; rows with a null id stay as they are and take no part; repeated rows of one id
    and text are one document, and all of them get its result; an id with several texts is several documents, in
    the order of a hash; columns of other names, also n_lines and n_removed, are passed on or replaced by the new ones."""
    ready = _prepared(docs)
    one = "xxhash64(a[used[j]], a[used[j + 1]], a[used[j + 2]])"
    two = "xxhash64(7, b[used[j]], b[used[j + 1]], b[used[j + 2]])"
    windows = (
        ready.where("id is not null and size(used) > 2")
        .select("id", "version", "used", F.expr("transform(lines, l -> xxhash64(l))").alias("a"), F.expr("transform(lines, l -> xxhash64(3, l))").alias("b"))
        .select("id", "version", F.expr(f"explode(transform(sequence(0, size(used) - 3), j -> struct(j as at, {one} as k1, {two} as k2)))").alias("w"))
        .select("id", "version", "w.*")
    )
    windows = stored(windows, "windows")
    firsts = windows.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "version", "at")).alias("first")).where("n > 1")
    later = windows.join(firsts, ["k1", "k2"]).where("struct(id, version, at) > first")
    covered = later.groupBy("id", "version").agg(F.collect_set("at").alias("starts"))
    covered = covered.select("id", "version", F.expr("array_distinct(flatten(transform(starts, s -> array(s, s + 1, s + 2))))").alias("gone"))
    joined = ready.join(covered, ["id", "version"], "left").select(
        "row", "lines", "used", F.expr("if(gone is null, array(), transform(gone, g -> used[g]))").alias("gone")
    )
    kept = F.expr("array_join(transform(array_except(sequence(0, size(lines) - 1), gone), i -> lines[i]), '\\n')")
    text = F.when(F.expr("size(gone) = 0"), F.col("row.text")).otherwise(kept)
    names = [c for c in docs.columns if c not in ("text", "n_lines", "n_removed")]
    out = joined.select(
        *[F.col("row").getField(c).alias(c) for c in names], text.alias("text"), F.expr("size(used)").cast("long").alias("n_lines"), F.expr("size(gone)").cast("long").alias("n_removed")
    )
    return out.select(*docs.columns, *[c for c in ("n_lines", "n_removed") if c not in docs.columns])


ORACLE_SQL = """
WITH l AS (
  SELECT doc_id, text, generate_subscripts(string_split(text, chr(10)), 1) AS raw, unnest(string_split(text, chr(10))) AS line
  FROM documents
), n AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY raw) AS r
  FROM l WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')
), w AS (
  SELECT doc_id, r, line, lead(line, 1) OVER p AS line2, lead(line, 2) OVER p AS line3
  FROM n WINDOW p AS (PARTITION BY doc_id ORDER BY r)
), f AS (
  SELECT doc_id, r, row_number() OVER (PARTITION BY line, line2, line3 ORDER BY doc_id, r) AS k
  FROM w WHERE line3 IS NOT NULL
), c AS (
  SELECT DISTINCT doc_id, r + o AS r FROM f, (VALUES (0), (1), (2)) t(o) WHERE k > 1
), g AS (
  SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.raw) FILTER (WHERE c.r IS NULL) AS kept,
         count(n.r) AS n_lines, count(c.r) AS n_removed
  FROM l LEFT JOIN n USING (doc_id, raw) LEFT JOIN c ON c.doc_id = n.doc_id AND c.r = n.r
  GROUP BY l.doc_id
)
SELECT d.doc_id,
       CASE WHEN d.text IS NULL THEN NULL WHEN g.n_removed = 0 THEN d.text ELSE coalesce(g.kept, '') END AS text,
       coalesce(g.n_lines, 0) AS n_lines, coalesce(g.n_removed, 0) AS n_removed
FROM documents d LEFT JOIN g USING (doc_id)
"""
