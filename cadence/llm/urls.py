"""URL filters by a temporal list join: every capture meets the list entries that were active when it was fetched."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Kinds of list entries, and what an entry may do, the later in the list winning a tie on one date.
KINDS = ["domain", "host", "prefix"]  # by rising precedence
ACTIONS = ["remove", "allow", "block"]
PERIOD_DAYS = 64  # intervals and captures meet on (kind, key, period), so one key's many intervals are not all tried

_HOST = "^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"
_PATH = "^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)"


def host_of(url: Column) -> Column:
    """Lower-case host of an absolute URL, without user and port; empty if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), _HOST, 1))


def list_keys(url: Column) -> Column:
    """All (kind, key) a list could name a URL by: the host and its parent domains, the host itself, and the host
    with each leading part of the path."""
    host = host_of(url)
    path = F.regexp_extract(F.coalesce(url, F.lit("")), _PATH, 1)
    labels = F.split(host, "\\.")
    segments = F.filter(F.split(path, "/"), lambda s: s != "")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.struct(F.lit("domain").alias("kind"), F.array_join(F.slice(labels, i, F.size(labels)), ".").alias("key")))
    hosts = F.array(F.struct(F.lit("host").alias("kind"), host.alias("key")))
    prefixes = F.when(
        F.size(segments) > 0,
        F.transform(F.sequence(F.lit(1), F.size(segments)), lambda i: F.struct(F.lit("prefix").alias("kind"), F.concat(host, F.lit("/"), F.array_join(F.slice(segments, F.lit(1), i), "/")).alias("key"))),
    ).otherwise(F.array())
    return F.when(host == "", F.array()).otherwise(F.concat(domains, hosts, prefixes))


def validity_intervals(entries: DataFrame) -> DataFrame:
    """(kind, key, action, valid_from, valid_to) from dated entries (kind, key, action, effective_from date): an entry
    holds until its key's next one; valid_to is null for the last. Removals only end what came before. Entries with a
    null in any of these columns, or of an unknown kind or action, are not used."""
    rank = F.array_position(F.array(*map(F.lit, ACTIONS)), F.col("action"))
    dated = (
        entries.select("kind", "key", "action", F.col("effective_from").cast("date").alias("valid_from"))
        .where(F.col("kind").isin(KINDS) & F.col("action").isin(ACTIONS) & F.col("key").isNotNull() & F.col("valid_from").isNotNull())
        .groupBy("kind", "key", "valid_from")
        .agg(F.max_by("action", rank).alias("action"))
    )
    w = Window.partitionBy("kind", "key").orderBy("valid_from")
    return dated.withColumn("valid_to", F.lead("valid_from").over(w)).where("action <> 'remove'")


def filter_urls(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """page_id, url, fetched, host, verdict, entry_kind, entry_key, valid_from for every row of ``captures``
    (page_id, url, fetched date).

    Of the entries active on the day of the fetch the most specific decides: a path prefix before a host, a host
    before a domain, the longer key first. The verdict is ``block``, ``allow``, or ``unlisted`` if none was active.
    Decisions are made once for each distinct (url, fetched); both joins have equality keys that adaptive execution
    can split where a host is hot, and intervals are cut into periods so that a key with a long history is not
    searched whole.

    Edges: a null or host-less URL, or a null date, is unlisted; repeated rows and null ids stay as they are; ties
    between dates are settled by ``ACTIONS``; other columns are ignored; empty tables give no rows or only unlisted
    ones."""
    rows = captures.select("page_id", F.col("url").cast("string").alias("url"), F.col("fetched").cast("date").alias("fetched"))
    asked = rows.where("url is not null and fetched is not null").select("url", "fetched").distinct()
    keyed = asked.select("url", "fetched", F.floor(F.unix_date("fetched") / PERIOD_DAYS).alias("period"), F.explode(list_keys(F.col("url"))).alias("k")).select("url", "fetched", "period", "k.kind", "k.key")
    last = rows.agg(F.max("fetched").alias("day"))  # one row: open intervals end after the last fetch
    spans = (
        validity_intervals(entries)
        .join(F.broadcast(last), F.col("valid_from") <= F.col("day"))
        .withColumn("end", F.least(F.coalesce(F.date_sub("valid_to", 1), F.col("day")), F.col("day")))
        .where("end >= valid_from")
        .select("kind", "key", "action", "valid_from", "end", F.explode(F.sequence(F.floor(F.unix_date("valid_from") / PERIOD_DAYS), F.floor(F.unix_date("end") / PERIOD_DAYS))).alias("period"))
    )
    active = keyed.join(spans, ["kind", "key", "period"]).where("fetched >= valid_from and fetched <= end")
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    chosen = active.groupBy("url", "fetched").agg(F.max(F.struct(rank.alias("rank"), F.length("key").alias("n"), "key", "kind", "action", "valid_from")).alias("e"))
    out = rows.join(chosen, ["url", "fetched"], "left")
    return out.select(
        "page_id", "url", "fetched", host_of(F.col("url")).alias("host"), F.coalesce("e.action", F.lit("unlisted")).alias("verdict"),
        F.col("e.kind").alias("entry_kind"), F.col("e.key").alias("entry_key"), F.col("e.valid_from").alias("valid_from"),
    )


def captures_of(pages: DataFrame) -> DataFrame:
    """Captures for the registered query: the pages table has no fetch dates, so they are spread over 360 days by
    page_id."""
    return pages.select("page_id", "url", F.expr("date_add(date'2024-01-01', cast(page_id * 37 % 360 as int))").alias("fetched"))


def list_from(pages: DataFrame) -> DataFrame:
    """Dated list entries for the registered query, derived from the pages' own hosts (the tables hold no list): one
    or two spells for a host by how often and how early it was captured, its domain or one of its sections."""
    hosts = pages.where("url is not null").groupBy(host_of(F.col("url")).alias("host")).agg(F.count(F.lit(1)).alias("n"), F.min("page_id").alias("lo"), F.max("page_id").alias("hi")).where("host <> '' and lo is not null")
    return hosts.select(
        F.expr("""explode(array(
            named_struct('kind', 'host', 'key', host, 'action', if(n % 2 = 0, 'block', 'allow'), 'd', lo % 200),
            named_struct('kind', 'host', 'key', host, 'action', 'remove', 'd', lo % 200 + 30 + n % 60),
            named_struct('kind', 'host', 'key', host, 'action', 'block', 'd', 250 + hi % 80),
            named_struct('kind', 'domain', 'key', substring_index(host, '.', -2), 'action', if(lo % 2 = 0, 'block', 'remove'), 'd', lo % 360),
            named_struct('kind', 'prefix', 'key', concat(host, '/en'), 'action', if(hi % 3 = 0, 'block', 'allow'), 'd', hi % 300)
        ))""").alias("e")
    ).select("e.kind", "e.key", "e.action", F.expr("date_add(date'2024-01-01', cast(e.d as int))").alias("effective_from"))


ORACLE_SQL = r"""
WITH p AS (
  SELECT page_id, url, DATE '2024-01-01' + CAST(page_id * 37 % 360 AS INTEGER) AS fetched,
         lower(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)) AS host,
         list_filter(string_split(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)', 1), '/'), lambda s: s <> '') AS segs
  FROM pages
), h AS (
  SELECT host, count(*) AS n, min(page_id) AS lo, max(page_id) AS hi FROM p WHERE url IS NOT NULL AND host <> '' GROUP BY host
), e AS (
  SELECT 'host' AS kind, host AS key, CASE WHEN n % 2 = 0 THEN 'block' ELSE 'allow' END AS action, lo % 200 AS d FROM h
  UNION ALL SELECT 'host', host, 'remove', lo % 200 + 30 + n % 60 FROM h
  UNION ALL SELECT 'host', host, 'block', 250 + hi % 80 FROM h
  UNION ALL SELECT 'domain', array_to_string(string_split(host, '.')[-2:], '.'), CASE WHEN lo % 2 = 0 THEN 'block' ELSE 'remove' END, lo % 360 FROM h
  UNION ALL SELECT 'prefix', host || '/en', CASE WHEN hi % 3 = 0 THEN 'block' ELSE 'allow' END, hi % 300 FROM h
), u AS (
  SELECT kind, key, d, arg_max(action, CASE action WHEN 'remove' THEN 1 WHEN 'allow' THEN 2 ELSE 3 END) AS action FROM e GROUP BY kind, key, d
), v AS (
  SELECT kind, key, action, DATE '2024-01-01' + CAST(d AS INTEGER) AS valid_from,
         DATE '2024-01-01' + CAST(lead(d) OVER (PARTITION BY kind, key ORDER BY d) AS INTEGER) AS valid_to
  FROM u
), k AS (
  SELECT DISTINCT url, fetched, 'host' AS kind, host AS key FROM p WHERE host <> ''
  UNION ALL SELECT DISTINCT url, fetched, 'domain', unnest(list_transform(range(1, len(string_split(host, '.')) + 1), lambda i: array_to_string(string_split(host, '.')[i:], '.'))) FROM p WHERE host <> ''
  UNION ALL SELECT DISTINCT url, fetched, 'prefix', unnest(list_transform(range(1, len(segs) + 1), lambda i: host || '/' || array_to_string(segs[:i], '/'))) FROM p WHERE host <> ''
), a AS (
  SELECT k.url, k.fetched, v.*, row_number() OVER (PARTITION BY k.url, k.fetched
         ORDER BY CASE v.kind WHEN 'prefix' THEN 3 WHEN 'host' THEN 2 ELSE 1 END DESC, length(v.key) DESC) AS r
  FROM k JOIN v ON k.kind = v.kind AND k.key = v.key AND v.action <> 'remove'
    AND k.fetched >= v.valid_from AND (v.valid_to IS NULL OR k.fetched < v.valid_to)
)
SELECT p.page_id, p.url, p.fetched, p.host, coalesce(a.action, 'unlisted') AS verdict, a.kind AS entry_kind, a.key AS entry_key, a.valid_from
FROM p LEFT JOIN a ON a.url = p.url AND a.fetched = p.fetched AND a.r = 1
"""
