"""Prefix trie of conversations as a burst trie: shards hold suffix containers under trie heads.

Every rebuilt conversation is a sequence of turn ids; all of them start in one container under the root. A container
that holds several conversations and more than ``BURST`` turns bursts: its conversations go on to the containers of
their next turn id, and the prefix becomes a head, a node that Spark counts by aggregation. Bursting goes on with
twice as many levels each round, and only for conversations that are still in too large a container. The remaining
containers are bounded, so each is sorted and swept into nodes inside one task; a container of one conversation, of
any length, needs no sweep. What a subtree adds up is carried by the conversation that first reaches a node, and
flows up that conversation's own path.

Everything is one narrow row a turn (ids of 16 bytes and the text's length), so neither a long conversation nor a
group of copies is ever one row or one task's memory."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.llm.tables import begin, drop, stored
from cadence.operators.bucketing import BUCKET, range_buckets
from cadence.operators.cumulative import cumulative

BURST = 4096  # turns that a container of several conversations holds at most
RANGE_ROWS = 2_000_000  # turns numbered by one task
SPAN = 1 << 16  # positions of a conversation that one window holds
CHUNK_IDS = 4096  # ids joined before their digest is taken
NO_ENDS = hashlib.sha256(b"").hexdigest()
KEY = ["pos", "k1", "k2"]
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def _mark(lane: int) -> Column:
    """One turn's share of a prefix key; a prefix's key is the xor of its turns' shares."""
    return F.xxhash64(F.lit(lane), "pos", "token")


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), token (16 bytes of the SHA-256 of role and text), size (code points of the text).

    Equal rows are counted first, so that a conversation of many equal turns is split like any other; places are
    running sums over ranges of (conv_id, turn, token)."""
    have = conversations.columns
    text = lambda c: F.coalesce(conversations[c].cast("string"), F.lit("")) if c in have else F.lit("")
    turn = conversations["turn"].cast("long") if "turn" in have else F.lit(None).cast("long")
    digest = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    rows = (
        conversations.select(conversations["conv_id"].cast("long").alias("conv_id"), turn.alias("turn"), text("role").alias("role"), text("text").alias("text"))
        .where("conv_id is not null")
        .select("conv_id", "turn", F.unhex(F.substring(digest, 1, 32)).alias("token"), F.length("text").cast("long").alias("size"))
    )
    rows = stored(rows.groupBy("conv_id", "turn", "token", "size").agg(F.count(F.lit(1)).alias("n")), "turns")
    ranged = range_buckets(rows, ["conv_id", "turn", "token"], rows.count(), RANGE_ROWS)
    placed = cumulative(ranged, ["conv_id"], ["turn", "token"], BUCKET, {"upto": ("sum", F.col("n"))})
    return placed.select("conv_id", F.explode(F.expr("sequence(upto - n + 1, upto)")).alias("pos"), "token", "size")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, length) of every conversation, and the rebuilt turns: conv_id, pos, token, size, length.

    Conversation c starts with the first h = crc32(c) % 6 turns of conversation c - c % 100 (all if it has fewer, none
    if it is absent), then come its own turns after its first h. At most 199 conversations share one such start."""
    sizes = turns.groupBy("conv_id").agg(F.max("pos").alias("n_own"))
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6
    named = sizes.select("conv_id", "n_own", h.alias("h"), F.expr("conv_id - conv_id % 100").alias("base"))
    taken = F.least(F.col("h"), F.coalesce("n_base", F.lit(0)))
    plan = (
        named.join(sizes.select(F.col("conv_id").alias("base"), F.col("n_own").alias("n_base")), "base", "left")
        .withColumn("taken", taken)
        .withColumn("length", F.col("taken") + F.greatest(F.col("n_own") - F.col("h"), F.lit(0)))
        .select("conv_id", "base", "h", "taken", "length")
    )
    plan = stored(plan, "plan")
    starts = turns.where("conv_id % 100 = 0 and pos <= 5").select(F.col("conv_id").alias("base"), "pos", "token", "size")
    first = plan.where("taken > 0").join(starts, "base").where("pos <= taken").select("conv_id", "pos", "token", "size", "length")
    rest = turns.join(plan, "conv_id").where("pos > h").select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "token", "size", "length")
    return plan.select("conv_id", "length"), first.unionAll(rest)


def paths(turns: DataFrame) -> DataFrame:
    """``turns`` with the key of the prefix that ends in each turn (k1, k2) and of the one before it (p1, p2)."""
    spans = turns.withColumn(BUCKET, F.floor(F.col("pos") / SPAN))
    keyed = cumulative(spans, ["conv_id"], ["pos"], BUCKET, {"k1": ("xor", _mark(1)), "k2": ("xor", _mark(2))}).drop(BUCKET)
    return keyed.withColumn("p1", F.col("k1").bitwiseXOR(_mark(1))).withColumn("p2", F.col("k2").bitwiseXOR(_mark(2)))


def burst(rows: DataFrame, limit: int) -> tuple[list[DataFrame], list[DataFrame], DataFrame]:
    """Burst containers from the root down until none is too large.

    Returns per round the prefixes counted and the turns at those levels (with their prefix's n and ``big``), and the
    container of each conversation that is in one: conv_id, top (depth of the container's first node), n (its
    conversations), c1 and c2 (its first node's key)."""
    counted, levels, tops = [], [], []
    active, lo, hi = rows, 0, 1
    while True:
        at = active.where((F.col("pos") > lo) & (F.col("pos") <= hi))
        prefixes = at.groupBy(*KEY).agg(
            F.count(F.lit(1)).alias("n"),
            F.min("conv_id").alias("conv_id"),
            F.sum(F.col("length") - F.col("pos") + 1).alias("turns"),
            F.max("size").alias("size"),
            F.max("p1").alias("p1"),
            F.max("p2").alias("p2"),
        )
        prefixes = stored(prefixes.withColumn("big", (F.col("n") > 1) & (F.col("turns") > limit)), "prefixes")
        level = stored(at.join(prefixes.select(*KEY, "n", "big"), KEY), "levels")
        counted.append(prefixes)
        levels.append(level)
        least = level.where("not big").groupBy("conv_id").agg(F.min(F.struct("pos", "n", "k1", "k2")).alias("t"))
        tops.append(least.select("conv_id", F.col("t.pos").alias("top"), "t.n", F.col("t.k1").alias("c1"), F.col("t.k2").alias("c2")))
        deeper = level.where(F.col("big") & (F.col("pos") == hi) & (F.col("length") > hi)).select("conv_id")
        if not deeper.take(1):
            break
        active = rows.where(F.col("pos") > hi).join(deeper, "conv_id", "left_semi")
        lo, hi = hi, 2 * hi + 1
    top = tops[0]
    for t in tops[1:]:
        top = top.unionAll(t)
    return counted, levels, top


def _spans(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The numbers of all ranges [start, end) one after another."""
    size = ends - starts
    return np.arange(int(size.sum())) + np.repeat(starts - (np.cumsum(size) - size), size)


def sweep(container: np.ndarray, conv: np.ndarray, last: np.ndarray, token: np.ndarray, size: np.ndarray) -> dict[str, np.ndarray]:
    """The nodes of whole containers. Rows are turns in the order of (container, conversation, position); ``last``
    marks a conversation's last turn, ``token`` has 16 bytes a row.

    Suffixes are sorted; a turn opens a new node where its suffix leaves the one before it. In the order of (container,
    level, suffix) each node's turns stand together, so all of a node's figures are sums over a stretch."""
    n = len(conv)
    change = np.ones(n, dtype=bool)
    change[1:] = (conv[1:] != conv[:-1]) | (container[1:] != container[:-1])
    starts = np.flatnonzero(change)
    ends = np.append(starts[1:], n)
    raw = token.tobytes()
    keys = [(c, raw[16 * s : 16 * e]) for c, s, e in zip(container[starts].tolist(), starts.tolist(), ends.tolist(), strict=True)]
    by_suffix = np.array(sorted(range(len(keys)), key=keys.__getitem__))
    row = _spans(starts[by_suffix], ends[by_suffix])
    length = (ends - starts)[by_suffix]
    begin_at = np.cumsum(length) - length
    suffix = np.repeat(np.arange(len(length)), length)
    level = np.arange(n) - begin_at[suffix]
    container, conv, last, size, token = container[row], conv[row], last[row], size[row], token[row]
    # How many turns each suffix shares with the one before it.
    above = np.where(suffix > 0, begin_at[suffix - 1] + level, 0)
    same = (suffix > 0) & (level < np.where(suffix > 0, length[suffix - 1], 0))
    same &= container[above] == container
    same[same] = (token[above[same]] == token[same]).all(axis=1)
    shared = np.minimum.reduceat(np.where(same, n, level), begin_at)
    new = level >= shared[suffix]

    order = np.lexsort((suffix, level, container))
    opens = np.flatnonzero(new[order])
    node = np.empty(n, dtype=np.int64)
    node[order] = np.cumsum(new[order]) - 1
    first = order[opens]
    n_convs = np.diff(np.append(opens, n))
    name = np.minimum.reduceat(conv[order], opens)
    is_top = level[first] == 0
    parent = np.where(is_top, -1, node[np.maximum(first - 1, 0)])
    n_children = np.bincount(parent[~is_top], minlength=len(first))

    def over_subtree(value: np.ndarray) -> np.ndarray:
        own = np.zeros(n, dtype=np.int64)
        own[first] = value
        total = np.cumsum(own)
        below = total[(begin_at + length - 1)[suffix]] - total + own
        return np.add.reduceat(below[order], opens)

    ends_at = np.flatnonzero(last)
    ends_at = ends_at[np.lexsort((conv[ends_at], node[ends_at]))]
    digests = np.full(len(first), NO_ENDS, dtype=object)
    ended, at = np.unique(node[ends_at], return_index=True)
    for e, a, b in zip(ended.tolist(), at.tolist(), [*at[1:].tolist(), len(ends_at)], strict=True):
        digests[e] = hashlib.sha256(",".join(map(str, conv[ends_at[a:b]].tolist())).encode()).hexdigest()
    return {
        "first": row[first],
        "conv_id": name,
        "parent": np.where(is_top, -1, name[np.maximum(parent, 0)]),
        "is_top": is_top,
        "n_convs": n_convs,
        "n_children": n_children,
        "n_leaves": over_subtree((n_children == 0).astype(np.int64)),
        "saved": over_subtree((n_convs - 1) * size[first]),
        "ends": digests,
    }


def _sweep_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sweep whole containers as they come; rows of the last one wait for the next batch."""

    def nodes(t: pa.Table) -> pa.RecordBatch:
        t = t.combine_chunks()
        number = lambda c: t.column(c).to_numpy()
        c1, c2, top = number("c1"), number("c2"), number("top")
        change = np.ones(t.num_rows, dtype=bool)
        change[1:] = (c1[1:] != c1[:-1]) | (c2[1:] != c2[:-1]) | (top[1:] != top[:-1])
        token = np.frombuffer(b"".join(t.column("token").to_pylist()), np.uint8).reshape(-1, 16)
        got = sweep(np.cumsum(change), number("conv_id"), number("pos") == number("length"), token, number("size"))
        first = got["first"]
        columns = [
            pa.array(got["conv_id"]), pa.array(number("pos")[first]), pa.array(got["parent"], mask=got["is_top"]), pa.array(got["n_convs"]), pa.array(got["n_children"]),
            pa.array(got["n_leaves"]), pa.array(got["saved"]), pa.array(got["ends"], pa.string()), pa.array(number("p1")[first]), pa.array(number("p2")[first]),
        ]
        return pa.RecordBatch.from_arrays(columns, names=[*COLUMNS, "p1", "p2"])

    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        t = pa.Table.from_batches(held)
        key = [t.column(c).to_numpy() for c in ("c1", "c2", "top")]
        differs = np.flatnonzero((key[0] != key[0][-1]) | (key[1] != key[1][-1]) | (key[2] != key[2][-1]))
        if len(differs):
            cut = int(differs[-1]) + 1
            yield nodes(t.slice(0, cut))
            held = t.slice(cut).to_batches()
    if held:
        yield nodes(pa.Table.from_batches(held))


def _join_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of at most CHUNK_IDS ids of one prefix as one text each."""
    for batch in batches:
        pos, k1, k2, conv = (batch.column(i).to_numpy() for i in range(4))
        n = len(pos)
        if not n:
            continue
        change = np.ones(n, dtype=bool)
        change[1:] = (pos[1:] != pos[:-1]) | (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])
        cuts = sorted({*np.flatnonzero(change).tolist(), *range(0, n, CHUNK_IDS)})
        rows = [(int(pos[a]), int(k1[a]), int(k2[a]), int(conv[a]), ",".join(map(str, conv[a:b].tolist()))) for a, b in zip(cuts, [*cuts[1:], n], strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=[*KEY, "first", "ids"])


def _digest_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest a prefix over its texts in order, joined by commas; only the running digest is held."""
    key, digest = None, None
    for batch in batches:
        out = []
        for *at, ids in zip(*[batch.column(i).to_pylist() for i in (0, 1, 2, 4)], strict=True):
            if at != key:
                if key is not None:
                    out.append((*key, digest.hexdigest()))
                key, digest = at, hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names=[*KEY, "ends_sha256"])
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (*key, digest.hexdigest())], names=[*KEY, "ends_sha256"])


def end_digests(ended: DataFrame) -> DataFrame:
    """pos, k1, k2, ends_sha256 of the conversations (conv_id) that end at each prefix, however many there are: sorted
    ranges are joined into texts first, and a digest is taken over texts."""
    order = [*KEY, "conv_id"]
    key = "pos long, k1 long, k2 long"
    texts = ended.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_join_ids, f"{key}, first long, ids string")
    return texts.repartition(*KEY).sortWithinPartitions(*KEY, "first").mapInArrow(_digest_ids, f"{key}, ends_sha256 string")


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionAll(f)
    return out


def prefix_trie(conversations: DataFrame, limit: int = BURST) -> DataFrame:
    """One row for each node of the trie of rebuilt conversations; see ``rebuilt`` for what a conversation is.

    conv_id (smallest member), depth, parent_conv_id, n_convs (members), n_children, n_leaves, saved_tokens (summed over
    the subtree: each node's members less one times its last text's length), ends_sha256 (of the ids of members that
    end here).

    Edges: a null role or text is empty; a null turn comes first; turns of equal number stand in the order of the
    digest of role and text, repeated rows stay as repeated turns; rows with a null conv_id belong to no conversation and
    are left out; a conversation may be rebuilt without turns and is then a member of the root alone; no rows give no
    nodes; other columns are ignored, also those named like a result's."""
    begin(conversations)
    turns = stored(numbered_turns(conversations), "numbered")
    everyone, sequences = rebuilt(turns)
    rows = stored(paths(sequences), "paths")
    drop(turns)
    all_of = everyone.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n")).first()
    counted, levels, top = burst(rows, limit)
    prefixes, level = _union(counted), _union(levels)
    heads = prefixes.where("big")

    members = rows.join(top, "conv_id").where("pos >= top")
    lone = members.where("n = 1")
    first_key = F.col("top") == F.col("pos")
    several = members.where("n > 1").select("c1", "c2", "top", "conv_id", "pos", "length", "token", "size", "p1", "p2").repartition("c1", "c2").sortWithinPartitions("c1", "c2", "top", "conv_id", "pos")
    keyed = SCHEMA + ", p1 long, p2 long"
    swept = several.mapInArrow(_sweep_batches, keyed)
    one = lambda x: F.lit(x).cast("long")
    digest = F.when(F.col("pos") == F.col("length"), F.sha2(F.col("conv_id").cast("string").cast("binary"), 256)).otherwise(F.lit(NO_ENDS))
    chain = lone.select(
        "conv_id", F.col("pos").alias("depth"), F.when(~first_key, F.col("conv_id")).alias("parent_conv_id"), one(1).alias("n_convs"), (F.col("pos") < F.col("length")).cast("long").alias("n_children"),
        one(1).alias("n_leaves"), one(0).alias("saved_tokens"), digest.alias("ends_sha256"), "p1", "p2",
    )
    below = stored(swept.unionAll(chain), "nodes")

    # Sums of the heads' subtrees: each container's and head's own figures, carried by its smallest member.
    n_kids = prefixes.groupBy((F.col("pos") - 1).alias("pos"), F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.count(F.lit(1)).alias("n_children"))
    heads = stored(heads.join(n_kids, KEY, "left").na.fill(0, ["n_children"]), "heads")
    own = heads.select("conv_id", "pos", (F.col("n_children") == 0).cast("long").alias("leaves"), ((F.col("n") - 1) * F.col("size")).alias("saved"))
    own = own.unionAll(below.where("parent_conv_id is null").select("conv_id", "depth", "n_leaves", "saved_tokens"))
    total = own.agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")).first()
    turnless = everyone.where("length = 0").select(one(0).alias("pos"), one(0).alias("k1"), one(0).alias("k2"), "conv_id")
    ended = level.where("big and pos = length").select(*KEY, "conv_id").unionAll(turnless)
    ends = stored(end_digests(ended), "ends")
    on_path = level.where("big").select("conv_id", "pos", "k1", "k2", one(0).alias("leaves"), one(0).alias("saved"), F.lit(1).alias("head")).join(own.select("conv_id").distinct(), "conv_id", "left_semi")
    carried = on_path.unionAll(own.select("conv_id", "pos", one(None).alias("k1"), one(None).alias("k2"), "leaves", "saved", F.lit(0).alias("head")))
    carried = carried.withColumn("up", -F.col("pos")).withColumn(BUCKET, F.floor(F.col("up") / SPAN))
    sums = cumulative(carried, ["conv_id"], ["up", "head"], BUCKET, {"n_leaves": ("sum", F.col("leaves")), "saved_tokens": ("sum", F.col("saved"))})
    sums = sums.where("head = 1").groupBy(*KEY).agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))

    # A head's or container's parent is a head; the root is not among them.
    parents = heads.select((F.col("pos") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("above"))
    upper = (
        heads.join(sums, KEY).join(ends, KEY, "left")
        .select("conv_id", F.col("pos").alias("depth"), one(None).alias("parent_conv_id"), F.col("n").alias("n_convs"), "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"), "p1", "p2")
    )
    root_of = F.when(F.col("depth") == 1, one(all_of["conv_id"]))
    resolved = (
        upper.unionAll(below.where("parent_conv_id is null"))
        .join(parents, ["depth", "p1", "p2"], "left")
        .withColumn("parent_conv_id", F.coalesce(root_of, F.col("above")))
        .select(*COLUMNS)
    )
    n_first = prefixes.where("pos = 1").count()
    spark = conversations.sparkSession
    root_ends = ends.where("pos = 0").select("ends_sha256").first()
    root_rows = [] if not all_of["n"] else [(all_of["conv_id"], 0, None, all_of["n"], n_first, total["leaves"] or 1, total["saved"] or 0, root_ends["ends_sha256"] if root_ends else NO_ENDS)]
    root = spark.createDataFrame(root_rows, SCHEMA)
    return root.unionAll(resolved).unionAll(below.where("parent_conv_id is not null").select(*COLUMNS))


# crc32 in SQL: one step a bit over the bytes of the decimal number (the byte comes in with its first bit).
ORACLE_SQL = """
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT conv_id, role, text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(role)::VARCHAR || ':' || role || text)) AS pos
  FROM t
), c AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base,
         xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(conv_id::VARCHAR, ''),
             lambda x: [ascii(x)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
             lambda s, e: xor(xor(s, e) >> 1, 3988292384 * (xor(s, e) & 1))), 4294967295) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM t)
), r AS (
  SELECT c.conv_id, 0 AS own, o.pos, o.role, o.text FROM c JOIN own o ON o.conv_id = c.base AND o.pos <= c.h
  UNION ALL
  SELECT c.conv_id, 1, o.pos, o.role, o.text FROM c JOIN own o ON o.conv_id = c.conv_id AND o.pos > c.h
), q AS (
  SELECT conv_id, row_number() OVER w AS depth, list(struct_pack(r := role, t := text)) OVER w AS path, length(text) AS size,
         count(*) OVER (PARTITION BY conv_id) AS total
  FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY own, pos)
), m AS (
  SELECT conv_id, depth, path, size, total FROM q
  UNION ALL
  SELECT c.conv_id, 0, [], 0, coalesce(max(q.total), 0) FROM c LEFT JOIN q USING (conv_id) GROUP BY c.conv_id
), k AS (
  SELECT *, min(conv_id) OVER (PARTITION BY depth, path) AS node FROM m
), n AS (
  SELECT node, depth, max(size) AS size, count(*) AS n_convs, bool_and(total = depth) AS leaf,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE total = depth), '')) AS ends_sha256
  FROM k GROUP BY node, depth
), e AS (
  SELECT DISTINCT b.node, b.depth, a.node AS parent FROM k b JOIN k a ON a.conv_id = b.conv_id AND a.depth = b.depth - 1
), s AS (
  SELECT u.node, u.depth, sum((n.n_convs - 1) * n.size) AS saved, count(*) FILTER (WHERE n.leaf) AS n_leaves
  FROM n JOIN k u ON u.conv_id = n.node AND u.depth <= n.depth GROUP BY u.node, u.depth
)
SELECT n.node AS conv_id, n.depth, e.parent AS parent_conv_id, n.n_convs,
       (SELECT count(*) FROM e x WHERE x.parent = n.node AND x.depth = n.depth + 1) AS n_children,
       s.n_leaves, s.saved::BIGINT AS saved_tokens, n.ends_sha256
FROM n JOIN s USING (node, depth) LEFT JOIN e USING (node, depth)
"""
