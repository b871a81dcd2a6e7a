"""Divergence of the sources of each language, priced on hash-consed segment trees over term ids.

The kept terms of a language get ids: blocks of about ``BLOCK`` terms by hash, and inside a block places by falling
document frequency, so that terms with similar counts stand side by side. A source's counts in a block are the leaves
of a segment tree. Trees of a block are hash-consed together: a node is its pair of child nodes, so equal count
subtrees, of any source and at any place, are one node. Two trees are compared by walking both at once from their
roots; a pair of nodes met again is not walked again, and each distinct pair of leaf counts is priced once. Spark deals
out blocks and tiles of sources, and adds up the blocks' prices."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadence.llm.tables import begin, drop, small, stored

# Bytes of a UTF-8 text: A-Z become a-z, bytes of no term become spaces.
_TERMS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
MIN_DOCS = 30
TOP = 50
BLOCK = 1024  # terms of a block, on average
TILE = 32  # sources whose trees are built together
HELD = 500_000  # terms that a counting task holds before it passes them on
CHUNK = 1 << 20  # bytes of a text read at once
SCALE = 1_000_000_000
SMOOTH = 5


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a UTF-8 text in chunks that end between terms."""
    lo = 0
    while lo < len(text):
        part = text[lo : lo + CHUNK].translate(_TERMS)
        lo += len(part)
        while lo < len(text) and not part.endswith(b" "):
            more = text[lo : lo + CHUNK].translate(_TERMS)
            cut = more.find(b" ") + 1 or len(more)
            part += more[:cut]
            lo += cut
        yield part.split()


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences), docs (documents that have it); a null text, lang or source is ''."""
    begin(docs)
    text = lambda c: (F.coalesce(docs[c].cast("string"), F.lit("")) if c in docs.columns else F.lit("")).alias(c)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, d) in held.items():
                k = len(n)
                terms = pa.array(list(n), pa.binary()).cast(pa.string())
                columns = [pa.array([lang] * k, pa.string()), pa.array([source] * k, pa.string()), terms, pa.array(list(n.values()), pa.int64()), pa.array([d[t] for t in n], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "n", "docs"])
            held.clear()

        size = 0
        for batch in batches:
            for lang, source, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary()), strict=True):
                n, d = held.setdefault((lang, source), (Counter(), Counter()))
                size -= len(n)
                seen: set[bytes] = set()
                for terms in terms_of(body.as_py()):
                    n.update(terms)
                    seen.update(terms)
                d.update(seen)
                size += len(n)
                if size > HELD:
                    yield from flush()
                    size = 0
        yield from flush()

    rows = docs.select(text("lang"), text("source"), text("text")).mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return rows.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def shares(counts: np.ndarray, total: int) -> np.ndarray:
    """1 + floor(SCALE * counts / total) exactly, for 0 <= counts <= total < 9.2e15: long division by thousands."""
    q, r = np.zeros(len(counts), np.int64), counts.astype(np.int64)
    scale = SCALE
    while scale > 1:
        r = r * 1000
        q = q * 1000 + r // total
        r %= total
        scale //= 1000
    return 1 + q


def share(count: Column, total: Column) -> Column:
    """``shares`` as a Spark column, on decimals."""
    wide = (count + F.lit(SMOOTH)).cast("decimal(28,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return (F.lit(1) + F.floor(_div(wide, total))).cast("long")


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b.cast("decimal(20,0)"))


class Trees:
    """Segment trees over the columns of ``counts`` (one row a source), sharing equal subtrees.

    ``levels[0]`` holds each leaf's node (its distinct count), ``levels[h]`` each node over 2**h leaves; ``children[h]``
    holds the two child nodes of each distinct node. Leaves that only fill up a block are node 0, which costs nothing."""

    def __init__(self, counts: np.ndarray):
        n = counts.shape[1]
        width = 1 << max(0, n - 1).bit_length() if n else 1
        values, leaf = np.unique(counts, return_inverse=True)
        self.values = np.concatenate([[-1], values])
        level = np.zeros((len(counts), width), dtype=np.int64)
        level[:, :n] = leaf.reshape(counts.shape) + 1
        self.children: list[np.ndarray] = []
        while level.shape[1] > 1:
            pairs = level[:, 0::2] << 32 | level[:, 1::2]
            nodes, level_ids = np.unique(pairs, return_inverse=True)
            self.children.append(np.stack([nodes >> 32, nodes & 0xFFFFFFFF], axis=1))
            level = level_ids.reshape(pairs.shape)
        self.roots = level[:, 0]

    def price(self, a: int, b: int, p: np.ndarray, q: np.ndarray) -> int:
        """Sum of |p - q| over all leaves of the trees of rows a and b; p and q are the shares of each distinct count
        in the two sources (by leaf node)."""
        pairs = np.array([self.roots[a] << 32 | self.roots[b]], dtype=np.int64)
        back: list[tuple[np.ndarray, np.ndarray]] = []
        for children in reversed(self.children):
            left, right = children[pairs >> 32], children[pairs & 0xFFFFFFFF]
            both = np.concatenate([left[:, 0] << 32 | right[:, 0], left[:, 1] << 32 | right[:, 1]])
            distinct, place = np.unique(both, return_inverse=True)
            back.append((place[: len(pairs)], place[len(pairs) :]))
            pairs = distinct
        value = np.abs(p[pairs >> 32] - q[pairs & 0xFFFFFFFF])
        for first, second in reversed(back):
            value = value[first] + value[second]
        return int(value[0])


def _price_tiles(rows: list[tuple], ta: int, tb: int) -> list[tuple[str, str, int]]:
    """(source a, source b, price) of one block and one pair of tiles, each unordered pair of sources once.

    ``rows``: (tile, source, group total, terms kept, terms of the block, places, counts)."""
    n = max(r[4] for r in rows)
    counts = np.zeros((len(rows), n), dtype=np.int64)
    for k, r in enumerate(rows):
        counts[k, r[5]] = r[6]
    trees = Trees(counts)
    p = []
    for r in rows:
        x = shares(trees.values + SMOOTH, r[2] + SMOOTH * r[3]) if r[3] else np.zeros(len(trees.values), np.int64)
        x[0] = 0  # filling leaves
        p.append(x)
    out = []
    for i, a in enumerate(rows):
        for j, b in enumerate(rows):
            if a[0] == ta and b[0] == tb and (ta != tb or a[1] < b[1]):
                out.append((a[1], b[1], trees.price(i, j, p[i], p[j])))
    return out


def block_prices(leaves: DataFrame) -> DataFrame:
    """lang, a, b, price: the sum of each block's price for each unordered pair of sources."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        lang, _, ta, tb = (k.as_py() for k in key)
        rows = [
            (*r[:5], np.array(r[5], dtype=np.int64), np.array(r[6], dtype=np.int64))
            for r in zip(*[table.column(c).to_pylist() for c in ("tile", "source", "total", "kept", "size", "places", "counts")], strict=True)
        ]
        found = _price_tiles(sorted(rows, key=lambda r: r[:2]), ta, tb)
        a, b, price = zip(*found, strict=True) if found else ((), (), ())
        return pa.table({"lang": pa.array([lang] * len(a), pa.string()), "a": pa.array(a, pa.string()), "b": pa.array(b, pa.string()), "price": pa.array(price, pa.int64())})

    # A tile meets itself and every other tile of its language once, under the smaller number first.
    meets = F.expr("transform(sequence(0, tiles - 1), o -> struct(least(tile, o) as ta, greatest(tile, o) as tb))")
    dealt = leaves.select("*", F.explode(meets).alias("m")).select("*", "m.ta", "m.tb").drop("m", "tiles")
    priced = dealt.groupBy("lang", "block", "ta", "tb").applyInArrow(run, "lang string, a string, b string, price long")
    return priced.groupBy("lang", "a", "b").agg(F.sum("price").alias("price"))


def source_divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value, rank: how the sources of a language differ in their use of terms.

    Terms are runs of letters and characters beyond ASCII, A-Z lower-cased. A language keeps the V terms that at least
    ``min_docs`` of its documents have. In a group with N kept occurrences a term counted c times has the share
    p = 1 + floor(10**9 * (c + 5) / (N + 5 * V)). Part ``pair``: item is each other source of the language, value the
    sum of |p - q| over all kept terms. Part ``term``: item is each kept term that occurs in the source and has a
    larger share there than in the whole language, value the difference, the ``top`` largest. Ranks go by value, then
    by the item's UTF-8 bytes.

    Hot terms and sources are added up in the counting tasks and again before each shuffle; a task that prices trees
    holds one block of two tiles of sources.

    Edges: null text, lang and source are '' (a group of their own); doc_id is not used, so null ids and repeated rows
    count like others; a group without terms takes part with N = 0; a language without kept terms has pairs of value
    0; a language with one source has no pairs; no rows give no rows; other columns are ignored; text of any length."""
    begin(docs)
    groups = docs.select(*[(F.coalesce(docs[c].cast("string"), F.lit("")) if c in docs.columns else F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    groups = stored(groups, "groups")
    every = stored(term_counts(docs), "terms")
    kept = every.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n")).where(F.col("docs") >= min_docs)
    kept = stored(kept, "kept-terms")
    counts = stored(every.select("lang", "source", "term", "n").join(kept.select("lang", "term", "lang_n"), ["lang", "term"]), "kept-counts")
    drop(every)

    langs = small(stored(kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("lang_n").alias("lang_total")), "langs"))
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    members = (
        groups.withColumn("tile", F.floor(number / TILE).cast("int"))
        .withColumn("tiles", (F.floor((F.count(F.lit(1)).over(Window.partitionBy("lang")) - 1) / TILE) + 1).cast("int"))
        .join(langs, "lang", "left")
        .join(totals, ["lang", "source"], "left")
        .na.fill(0, ["kept", "lang_total", "total"])
    )
    members = stored(members, "members")
    named = small(members)

    # Places of the kept terms: block by hash, place by falling document frequency.
    n_blocks = F.greatest(F.lit(1), F.floor(F.col("kept") / BLOCK)).cast("int")
    by_block = Window.partitionBy("lang", "block")
    ids = (
        kept.join(langs.select("lang", "kept"), "lang")
        .select("lang", "term", "docs", F.pmod(F.xxhash64("term"), n_blocks).cast("int").alias("block"))
        .select("lang", "term", "block", (F.row_number().over(by_block.orderBy(F.desc("docs"), "term")) - 1).alias("place"), F.count(F.lit(1)).over(by_block).cast("int").alias("size"))
    )
    filled = counts.join(ids, ["lang", "term"]).groupBy("lang", "source", "block", "size").agg(F.collect_list("place").alias("places"), F.collect_list("n").alias("counts"))
    # Every source has a tree in every block, all zeros where it lacks the block's terms.
    sizes = ids.groupBy("lang", "block").agg(F.max("size").alias("size"))
    none = F.array().cast("array<int>")
    leaves = (
        members.where("kept > 0")
        .select("*", F.explode(F.sequence(F.lit(0), n_blocks - 1)).alias("block"))
        .join(filled.drop("size"), ["lang", "source", "block"], "left")
        .join(sizes, ["lang", "block"])
        .select("lang", "block", "tile", "tiles", "source", "total", "kept", "size", F.coalesce("places", none).alias("places"), F.coalesce("counts", none.cast("array<bigint>")).alias("counts"))
    )
    prices = stored(block_prices(leaves), "prices")
    both = prices.select("lang", F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("s"), "price")
    both = both.select("lang", "s.source", "s.item", F.col("price").alias("value"))
    # Languages without kept terms have no blocks; their pairs are worth 0.
    empty = members.where("kept = 0")
    zero = empty.select("lang", "source").join(empty.select("lang", F.col("source").alias("item")), "lang").where("source <> item").select("lang", "source", "item", F.lit(0).cast("long").alias("value"))
    pairs = both.unionAll(zero).select("lang", "source", F.lit("pair").alias("part"), "item", "value")

    own = F.col("total") + SMOOTH * F.col("kept")
    whole = F.col("lang_total") + SMOOTH * F.col("kept")
    terms = counts.join(named.select("lang", "source", "total", "kept", "lang_total"), ["lang", "source"]).select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (share(F.col("n"), own) - share(F.col("lang_n"), whole)).alias("value")
    )
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    ranked = pairs.withColumn("rank", F.row_number().over(order))
    best = terms.where("value > 0").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.unionAll(best)


ORACLE_SQL = """
WITH d AS (
  SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms
  FROM documents
), w AS (
  SELECT k, lang, source, unnest(terms) AS term FROM d
), kept AS (
  SELECT lang, term, count(*) AS lang_n FROM w GROUP BY lang, term HAVING count(DISTINCT k) >= 30
), lv AS (
  SELECT lang, count(*) AS v, sum(lang_n)::HUGEINT AS total FROM kept GROUP BY lang
), c AS (
  SELECT w.lang, w.source, w.term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY ALL
), g AS (
  SELECT s.lang, s.source, coalesce(v, 0) AS v, coalesce(sum(n), 0)::HUGEINT AS total
  FROM (SELECT DISTINCT lang, source FROM d) s LEFT JOIN lv USING (lang) LEFT JOIN c USING (lang, source)
  GROUP BY s.lang, s.source, v
), p AS (
  SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (g.total + 5 * g.v) AS share
  FROM g JOIN kept USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(max(x.value), 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (
    SELECT x.lang, x.source, y.source AS item, sum(abs(x.share - y.share)) AS value
    FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL
  ) x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  GROUP BY a.lang, a.source, b.source
), terms AS (
  SELECT p.lang, p.source, 'term' AS part, p.term AS item,
         p.share - (1 + (1000000000::HUGEINT * (kept.lang_n + 5)) // (lv.total + 5 * lv.v)) AS value
  FROM p JOIN kept USING (lang, term) JOIN lv USING (lang) WHERE p.n > 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms WHERE value > 0)
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""
