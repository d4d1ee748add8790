"""URL filters as a temporal list join, with DataFrame functions only.

A list is a table of dated entries: list_id, effect ('block' or 'allow'), kind, value,
action ('add' or 'remove'), listed_on (date). Kinds, from the least to the most specific:

=========  ==================================================================
domain     the value's host (without a leading ``www.``) and every host below it
host       the value's host alone
prefix     the value's host and path, and every path below it
url        the value's host, path and query
=========  ==================================================================

Values may be typed as URLs or as bare hosts. Entries of one list about the same thing make
a history: on a day with both actions the addition counts, repeats change nothing, and what
is left are disjoint validity intervals [valid_from, valid_to). The as-of join meets every
capture, by the keys its URL has, with the intervals of the year of its fetch and keeps those
that hold on the day. The most specific of them decides; of equals the longer value, then a
block before an allow, then the later list and value.

What is large is cut down before it moves: equal (url, day) captures are judged once; a
history holds at most one interval for two days of its year; path prefixes are made only at
the depths that occur in the lists. A host with a third of all captures is one skewed side of
an ordinary equi-join, which adaptive execution splits.

Defined cases: a null or empty URL, one without a host, or a null fetch day matches nothing
and passes; entries with a null field, or of an unknown kind or action, are ignored; repeated captures
each get their verdict; empty tables give empty results or pass everything; extra columns
of the captures are kept (they must not be named like the verdict's).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cadenza.llm.common import staged, table

KINDS = ["domain", "host", "prefix", "url"]
SCHEME = r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*://|//)?"
FOREVER = "9999-12-31"
VERDICT = ["blocked", "effect", "list_id", "kind", "value", "valid_from", "valid_to", "n_active"]


def parsed(df: DataFrame, url: str) -> DataFrame:
    """``df`` with _host (lower case, without user, port and trailing dot), _rest (path and
    query) and _segments (of the path)."""
    host = F.regexp_extract(url, SCHEME + r"(?:[^/?#@]*@)?([^/?#:]*)", 1)
    rest = F.regexp_extract(url, SCHEME + r"[^/?#]*([^#]*)", 1)
    df = df.withColumn("_host", F.regexp_replace(F.lower(host), r"\.$", "")).withColumn("_rest", rest)
    return df.withColumn("_segments", F.filter(F.split(F.regexp_extract("_rest", r"^([^?]*)", 1), "/"), lambda s: s != ""))


def path_key(depth) -> F.Column:
    return F.concat_ws("/", F.col("_host"), F.slice("_segments", F.lit(1), depth))


def url_key() -> F.Column:
    """Host, path and query; a bare slash counts as no path."""
    return F.concat("_host", F.regexp_replace("_rest", r"^/(\?|$)", "$1"))


def validity_intervals(entries: DataFrame) -> DataFrame:
    """``list_id, effect, kind, key, depth, valid_from, valid_to`` of the dated entries."""
    known = entries.where(F.col("kind").isin(KINDS) & F.col("action").isin("add", "remove")
                          & F.col("effect").isin("block", "allow"))
    known = parsed(known.where("list_id is not null and value is not null and listed_on is not null"), "value")
    key = (F.when(F.col("kind") == "domain", F.regexp_replace("_host", r"^www\.", ""))
           .when(F.col("kind") == "host", F.col("_host"))
           .when(F.col("kind") == "prefix", path_key(F.size("_segments")))
           .otherwise(url_key()))
    days = (known.where("_host <> ''")
            .select("list_id", "effect", "kind", key.alias("key"), F.col("listed_on").cast("date").alias("day"),
                    F.when(F.col("kind") == "prefix", F.size("_segments")).alias("depth"),
                    (F.col("action") == "add").alias("on"))
            .groupBy("list_id", "effect", "kind", "key", "depth", "day").agg(F.max("on").alias("on")))
    history = Window.partitionBy("list_id", "effect", "kind", "key", "depth").orderBy("day")
    changes = days.withColumn("was", F.coalesce(F.lag("on").over(history), F.lit(False))).where("on <> was")
    spans = changes.withColumn("valid_to", F.coalesce(F.lead("day").over(history), F.lit(FOREVER).cast("date")))
    return spans.where("on").select("list_id", "effect", "kind", "key", "depth", F.col("day").alias("valid_from"), "valid_to")


def url_filter(captures: DataFrame, entries: DataFrame, url: str = "url", fetched_on: str = "fetched_on") -> DataFrame:
    """``captures`` with VERDICT columns: whether the entries active on the day of the fetch
    block it, the deciding entry (null if none) and how many were active. Captures that have a
    column of such a name already are refused."""
    clash = {c.lower() for c in captures.columns} & set(VERDICT)
    if clash:
        raise ValueError(f"captures already have columns {sorted(clash)}")
    spans = validity_intervals(entries)
    depths = sorted(r.depth for r in spans.where("kind = 'prefix'").select("depth").distinct().collect())
    span = captures.agg(F.min(F.year(fetched_on)), F.max(F.year(fetched_on))).first()
    years = F.sequence(F.greatest(F.year("valid_from"), F.lit(span[0])), F.least(F.year("valid_to"), F.lit(span[1])))
    seen = (F.year("valid_from") <= F.lit(span[1])) & (F.year("valid_to") >= F.lit(span[0]))
    # written, so that both sides of the join below are plain shuffles, which AQE splits where a host is hot
    histories = staged(spans.where(seen).withColumn("year", F.explode(years)).groupBy("kind", "key", "year")
                       .agg(F.collect_list(F.struct("list_id", "effect", "valid_from", "valid_to")).alias("history")), "histories")

    once = parsed(captures.select(F.col(url).alias("_url"), F.col(fetched_on).cast("date").alias("_day"))
                  .where("_url is not null and _day is not null").distinct(), "_url").where("_host <> ''")
    labels = F.split("_host", r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.struct(
        F.lit("domain").alias("kind"), F.array_join(F.slice(labels, i, F.size(labels)), ".").alias("key")))
    reached = F.filter(F.array(*map(F.lit, depths)).cast("array<int>"), lambda d: d <= F.size("_segments"))
    prefixes = F.transform(reached, lambda d: F.struct(F.lit("prefix").alias("kind"), path_key(d).alias("key")))
    others = F.array(F.struct(F.lit("host").alias("kind"), F.col("_host").alias("key")),
                     F.struct(F.lit("url").alias("kind"), url_key().alias("key")))
    keys = F.explode(F.concat(domains, others, prefixes))
    asked = once.select("_url", "_day", F.year("_day").alias("year"), keys.alias("k")).select("_url", "_day", "year", "k.*")
    met = asked.join(histories, ["kind", "key", "year"]).select(
        "_url", "_day", "kind", "key", F.explode(F.filter("history", lambda h: (h["valid_from"] <= F.col("_day"))
                                                          & (F.col("_day") < h["valid_to"]))).alias("h"))
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    best = F.struct(rank, F.length("key"), F.col("h.effect") == "block", F.col("h.list_id"), F.col("key"))
    verdicts = met.groupBy("_url", "_day").agg(
        F.max_by(F.struct("kind", "key", "h.*"), best).alias("e"), F.count("*").alias("_n"))
    day = F.col(fetched_on).cast("date")
    joined = captures.join(verdicts, (captures[url] == verdicts["_url"]) & (day == verdicts["_day"]), "left")
    return joined.select(*[captures[c] for c in captures.columns],
                         F.coalesce(F.col("e.effect") == "block", F.lit(False)).alias("blocked"),
                         F.col("e.effect").alias("effect"), F.col("e.list_id").alias("list_id"),
                         F.col("e.kind").alias("kind"), F.col("e.key").alias("value"),
                         F.col("e.valid_from").alias("valid_from"), F.col("e.valid_to").alias("valid_to"),
                         F.coalesce("_n", F.lit(0)).alias("n_active"))


def stand_in(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Captures and list entries in the operator's schemas: ``pages`` has neither fetch days nor
    lists, so days, kinds and actions are dealt out by page_id and values are the pages' URLs."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    day = lambda n: F.expr(f"date_add(date'2023-01-01', cast(page_id * {n} % 1000 as int))")
    captures = pages.select("page_id", "url", day(37).alias("fetched_on"))
    kind = F.expr("case when page_id % 8 < 1 then 'domain' when page_id % 8 < 3 then 'host' "
                  "when page_id % 8 < 5 then 'prefix' else 'url' end")
    value = F.when(kind == "prefix", F.regexp_replace("url", "[^/]*$", "")).otherwise(F.col("url"))
    entries = pages.select(
        F.concat(F.lit("list"), (F.col("page_id") % 5).cast("string")).alias("list_id"),
        F.when(F.col("page_id") % 5 == 4, "allow").otherwise("block").alias("effect"), kind.alias("kind"),
        value.alias("value"), F.when(F.col("page_id") % 3 == 2, "remove").otherwise("add").alias("action"),
        day(53).alias("listed_on"))
    return captures, entries


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page, with what the lists say about it on the day of its fetch (days as text)."""
    found = url_filter(*stand_in(spark, sf_dir))
    return found.withColumns({c: F.col(c).cast("string") for c in ("fetched_on", "valid_from", "valid_to")})


#: The same rows, said event by event: for a capture's key and list the last day with an event decides.
OP1_SQL = r"""
WITH p AS (SELECT page_id, url FROM pages),
cap AS (SELECT page_id, url, DATE '2023-01-01' + CAST(page_id * 37 % 1000 AS INT) AS fetched_on FROM p),
ent AS (
  SELECT 'list' || CAST(page_id % 5 AS VARCHAR) AS list_id, CASE WHEN page_id % 5 = 4 THEN 'allow' ELSE 'block' END AS effect,
         kind, CASE WHEN kind = 'prefix' THEN regexp_replace(url, '[^/]*$', '') ELSE url END AS value,
         page_id % 3 <> 2 AS is_on, DATE '2023-01-01' + CAST(page_id * 53 % 1000 AS INT) AS listed_on
  FROM (SELECT *, CASE WHEN page_id % 8 < 1 THEN 'domain' WHEN page_id % 8 < 3 THEN 'host'
                       WHEN page_id % 8 < 5 THEN 'prefix' ELSE 'url' END AS kind FROM p)),
parts AS (
  SELECT DISTINCT u, rtrim_host AS host, rest,
         list_filter(string_split(regexp_extract(rest, '^([^?]*)', 1), '/'), lambda s: s <> '') AS seg
  FROM (SELECT u, regexp_replace(lower(regexp_extract(u, '^(?:[a-zA-Z][a-zA-Z0-9+.-]*://|//)?(?:[^/?#@]*@)?([^/?#:]*)', 1)), '\.$', '') AS rtrim_host,
               regexp_extract(u, '^(?:[a-zA-Z][a-zA-Z0-9+.-]*://|//)?[^/?#]*([^#]*)', 1) AS rest
        FROM (SELECT url AS u FROM cap UNION SELECT value FROM ent))
  WHERE u IS NOT NULL AND rtrim_host <> ''),
ev AS (
  SELECT list_id, effect, kind, listed_on AS day, bool_or(is_on) AS is_on,
         CASE kind WHEN 'domain' THEN regexp_replace(host, '^www\.', '') WHEN 'host' THEN host
                   WHEN 'prefix' THEN array_to_string(list_concat([host], seg), '/')
                   ELSE host || regexp_replace(rest, '^/(\?|$)', '\1') END AS key
  FROM ent JOIN parts ON value = u GROUP BY ALL),
want AS (
  SELECT u, 'domain' AS kind, array_to_string(list_slice(string_split(host, '.'), i, len(string_split(host, '.'))), '.') AS key
  FROM (SELECT u, host, unnest(range(1, len(string_split(host, '.')) + 1)) AS i FROM parts)
  UNION ALL SELECT u, 'host', host FROM parts
  UNION ALL SELECT u, 'prefix', array_to_string(list_concat([host], list_slice(seg, 1, i)), '/')
  FROM (SELECT u, host, seg, unnest(range(0, len(seg) + 1)) AS i FROM parts)
  UNION ALL SELECT u, 'url', host || regexp_replace(rest, '^/(\?|$)', '\1') FROM parts),
asked AS (SELECT DISTINCT url, fetched_on, kind, key FROM cap JOIN want ON url = u),
hist AS (
  SELECT url, fetched_on, kind, key, list_id, effect,
         max(day) FILTER (WHERE is_on AND day <= fetched_on) AS last_on,
         max(day) FILTER (WHERE NOT is_on AND day <= fetched_on) AS last_off,
         list(day) FILTER (WHERE is_on AND day <= fetched_on) AS ons,
         min(day) FILTER (WHERE NOT is_on AND day > fetched_on) AS next_off
  FROM asked JOIN ev USING (kind, key) GROUP BY ALL),
active AS (
  SELECT *, list_min(list_filter(ons, lambda d: last_off IS NULL OR d > last_off)) AS valid_from
  FROM hist WHERE last_on IS NOT NULL AND (last_off IS NULL OR last_on > last_off)),
ranked AS (
  SELECT *, count(*) OVER (PARTITION BY url, fetched_on) AS n,
         row_number() OVER (PARTITION BY url, fetched_on ORDER BY
           CASE kind WHEN 'url' THEN 4 WHEN 'prefix' THEN 3 WHEN 'host' THEN 2 ELSE 1 END DESC,
           length(key) DESC, effect = 'block' DESC, list_id DESC, key DESC) AS nth
  FROM active)
SELECT c.page_id, c.url, CAST(c.fetched_on AS VARCHAR) AS fetched_on, coalesce(r.effect = 'block', false) AS blocked, r.effect, r.list_id, r.kind,
       r.key AS value, CAST(r.valid_from AS VARCHAR) AS valid_from,
       CASE WHEN r.key IS NULL THEN NULL ELSE coalesce(CAST(r.next_off AS VARCHAR), '9999-12-31') END AS valid_to,
       coalesce(r.n, 0) AS n_active
FROM cap c LEFT JOIN ranked r ON c.url = r.url AND c.fetched_on = r.fetched_on AND r.nth = 1
"""
