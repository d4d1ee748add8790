"""How far the sources of each language diverge in their words, from count-level bitmaps.

Occurrences are counted per (language, source, term) and summed; a language keeps the terms
that enough of its documents hold. Kept terms get bit positions: sorted by frequency they are
dealt into runs of 64, a term's bit being its place in the run. For every run, group and
count there is one 64-bit set of the terms that occur that often in that group.

A smoothed share depends on the count alone, ``p = 1 + floor(SCALE * (count + 2) / (N + 2 V))``,
and so does the divergence of a term between two groups, ``f = floor((p - q)**2 / (p + q))``.
Two groups' sets are joined by AND, the bits that are left are counted, and each such cell
(count, count) adds its number of terms times f. Terms that one or both groups lack need no
set: with n(a, b) the joint cells of counts above 0, m(a) the terms of count a in one group
and V all kept terms, complement gives

    sum of f = sum over a, b of n(a, b) * (f(a, b) - f(a, 0) - f(0, b) + f(0, 0))
             + sum over a of m(a) * (f(a, 0) - f(0, 0)) + sum over b of m(b) * (f(0, b) - f(0, 0))
             + V * f(0, 0)

How it runs: texts are counted where they lie, a task sends one row per distinct (group,
term) of a run of texts, and Spark adds these up before and after its shuffle, so a source
with a third of all rows is spread like any other. Runs of 64 terms are numbered inside the
partitions of a range sort. The comparison gathers one run of terms: at most 64 rows per
group, in tiles of ``TILE`` x ``TILE`` sets; its output, like the result, has a row per pair of sources.

Arithmetic is exact: products that may pass 64 bits are decimals of up to 38 digits, and a
square of shares stays below 2**63 since they do not pass SCALE + 1. A sum of f may reach
``V * SCALE`` and is taken in 64 bits, enough for 9 * 10**9 kept terms a language.

Defined cases: a null text, language or source counts as ''; a text without a term makes its
group occur; repeated rows count once each; texts are counted whole, whatever their length;
equal values rank by the item's UTF-8 bytes; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cadenza.llm.common import on_workers, slices, staged, table, task

SCALE = 1_000_000_000
MIN_DOCS, TOP_TERMS = 10, 10
WORD = 64    # terms in a set
TILE = 2048  # sets that are joined with as many others at once
SLICE = 8 << 20
#: ASCII letters in lower case, the rest of ASCII as blanks; other bytes belong to terms.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def _terms(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """``(distinct terms, codes, bounds)``: the terms of all texts as codes, and each text's end."""
    texts = texts.fill_null("").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    if data is not None:
        changed = pa.py_buffer(data.to_pybytes().translate(TERM_BYTES))
        texts = pa.LargeStringArray.from_buffers(len(texts), offsets, changed, offset=texts.offset)
    lists = pc.ascii_split_whitespace(texts)
    flat = lists.flatten().dictionary_encode()
    bounds = lists.offsets.to_numpy().astype(np.int64) - lists.offsets[0].as_py()
    codes = flat.indices.to_numpy().astype(np.int64)
    blank = pc.index(flat.dictionary, pa.scalar("", flat.dictionary.type)).as_py()
    if blank >= 0:  # what a blank at an end leaves
        real = np.flatnonzero(codes != blank)
        bounds, codes = np.searchsorted(real, bounds), codes[real]
    return flat.dictionary, codes, bounds


def term_counts(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """``lang, source, term, count, docs``: occurrences, and documents that hold the term; one row
    with a null term for every group."""
    on_workers(docs.sparkSession)

    def run(batches):
        for batch in task(batches):
            for part in slices(batch, "text", SLICE):
                terms, codes, bounds = _terms(part.column("text"))
                groups = pa.StructArray.from_arrays([part.column("lang"), part.column("source")], ["lang", "source"])
                keys: dict = {}
                group = np.fromiter((keys.setdefault((g["lang"], g["source"]), len(keys)) for g in groups.to_pylist()),
                                    np.int64, part.num_rows)
                size = max(1, len(terms))
                per_doc, occurs = np.unique(np.repeat(np.arange(part.num_rows), np.diff(bounds)) * size + codes, return_counts=True)
                cell, at = np.unique(group[per_doc // size] * size + per_doc % size, return_inverse=True)
                names = list(keys)
                owner, term = cell // size, cell % size
                add = lambda weights: np.bincount(at, weights, len(cell)).astype(np.int64) if len(cell) else cell
                for i, (owners, terms_, count, held) in enumerate((
                        (owner, terms.take(pa.array(term)).cast(pa.string()), add(occurs), add(None)),
                        (np.arange(len(names)), pa.nulls(len(names), pa.string()), np.zeros(len(names), np.int64), np.zeros(len(names), np.int64)))):
                    lookup = [pa.array([n[j] for n in names], pa.string()).take(pa.array(owners)) for j in (0, 1)]
                    yield pa.RecordBatch.from_pydict({"lang": lookup[0], "source": lookup[1], "term": terms_,
                                                      "count": pa.array(count), "docs": pa.array(held)})

    rows = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n)
                         for c, n in ((lang, "lang"), (source, "source"))), F.col(text).alias("text"))
    return (rows.mapInArrow(run, "lang string, source string, term string, count long, docs long")
            .groupBy("lang", "source", "term").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs")))


def share(count, total, kept):
    """The smoothed share of a count, as a 64-bit column, exact for any counts."""
    whole = lambda c, digits: F.col(c).cast(f"decimal({digits},0)") if isinstance(c, str) else c
    top = F.lit(SCALE).cast("decimal(10,0)") * (whole(count, 20) + 2)
    return F.lit(1) + F.call_function("div", top, whole(total, 20) + whole(kept, 15) * 2)


def _divergence(p: str, q: str) -> str:
    return f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})"


def _f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def joint_cells(rows: pd.DataFrame) -> pd.DataFrame:
    """All pairs of sets of one run: per pair of groups, the sum over joint cells of their number
    of terms times the corrected f. ``rows``: grp, p (share of the count), p0 (of count 0), bits."""
    rows = rows.sort_values("grp")
    names, grp = np.unique(rows["grp"].to_numpy(), return_inverse=True)
    p, p0 = rows["p"].to_numpy(), rows["p0"].to_numpy()
    bits = rows["bits"].to_numpy(np.int64).view(np.uint64)
    out = []
    for at in range(0, len(rows), TILE):
        for to in range(at, len(rows), TILE):  # sorted by group: earlier tiles hold no later group
            both = np.bitwise_count(bits[at:at + TILE, None] & bits[None, to:to + TILE])
            a, b = np.nonzero(both)
            n, a, b = both[a, b].astype(np.int64), a + at, b + to
            later = grp[b] > grp[a]
            n, a, b = n[later], a[later], b[later]
            value = n * (_f(p[a], p[b]) - _f(p[a], p0[b]) - _f(p0[a], p[b]) + _f(p0[a], p0[b]))
            out.append(pd.DataFrame({"a": grp[a], "b": grp[b], "value": value}).groupby(["a", "b"], as_index=False).sum())
    cells = pd.concat(out, ignore_index=True)
    return cells.assign(a=names[cells["a"]], b=names[cells["b"]])


def divergences(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS, lang: str = "lang",
                source: str = "source", text: str = "text") -> DataFrame:
    """``lang, source, part, item, value, rank``.

    Part ``pair``: every other source of the language with the summed divergence over all kept
    terms, all ranks. Part ``term``: the kept terms that the group holds more of than its
    language, with their divergence from it, the ``top`` best. Ranks fall with the value.
    """
    counts = staged(term_counts(docs, lang, source, text), "terms")
    kept = staged(counts.where(F.col("term").isNotNull()).groupBy("lang", "term")
                  .agg(F.sum("count").alias("lang_count"), F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs)
                  .select("lang", "term", "lang_count")
                  .repartitionByRange("lang", F.desc("lang_count"), "term").sortWithinPartitions("lang", F.desc("lang_count"), "term")
                  .withColumn("at", F.monotonically_increasing_id()), "kept")
    of_lang = kept.groupBy("lang").agg(F.sum("lang_count").alias("lang_total"), F.count(F.lit(1)).alias("kept"))
    used = staged(counts.where(F.col("count") > 0).join(kept, ["lang", "term"]), "used")
    total = used.groupBy("lang", "source").agg(F.sum("count").alias("total"))
    groups = (counts.where(F.col("term").isNull()).select("lang", "source").join(of_lang, "lang", "left")
              .join(total, ["lang", "source"], "left").fillna(0, ["lang_total", "kept", "total"])
              .withColumn("p0", F.when(F.col("kept") > 0, share(F.lit(0), "total", "kept"))))
    groups = staged(groups, "groups")

    pairs = _pairs(used, groups)
    held = used.join(groups, ["lang", "source"]).select(
        "lang", "source", F.col("term").alias("item"), share("count", "total", "kept").alias("p"),
        share("lang_count", "lang_total", "kept").alias("q"))
    terms = held.where(F.col("p") > F.col("q")).select("lang", "source", "item", F.expr(_divergence("p", "q")).alias("value"))
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    ranked = terms.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return (pairs.withColumn("rank", F.row_number().over(best)).withColumn("part", F.lit("pair"))
            .unionByName(ranked.withColumn("part", F.lit("term")))
            .select("lang", "source", "part", "item", "value", "rank"))


def _pairs(used: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, source, item, value``: every two sources of a language, both ways round."""
    run = (F.shiftright("at", 33).alias("part"), F.shiftright(F.col("at").bitwiseAND((1 << 33) - 1), 6).alias("run"))
    sets = (used.select("lang", "source", "count", *run, F.expr(f"shiftleft(1L, cast(at % {WORD} as int))").alias("bit"))
            .groupBy("lang", "part", "run", "source", "count").agg(F.bit_or("bit").alias("bits"))
            .join(groups, ["lang", "source"])
            .select("lang", "part", "run", F.col("source").alias("grp"), share("count", "total", "kept").alias("p"), "p0", "bits"))

    def compare(key, rows):
        return joint_cells(rows).assign(lang=key[0])

    cells = (sets.groupBy("lang", "part", "run").applyInPandas(compare, "lang string, a string, b string, value long")
             .groupBy("lang", "a", "b").agg(F.sum("value").alias("joint")))
    # terms that one group holds, by count, against the other's share of count 0
    level = used.groupBy("lang", "source", "count").agg(F.count(F.lit(1)).alias("n")).join(groups, ["lang", "source"]).select(
        "lang", "source", "n", share("count", "total", "kept").alias("p"), "p0")
    others = groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"))
    single = (level.join(others, "lang").where(F.col("item") != F.col("source"))
              .groupBy("lang", "source", "item")
              .agg(F.sum(F.expr(f"n * ({_divergence('p', 'q0')} - {_divergence('p0', 'q0')})")).alias("single")))
    both = (groups.select("lang", "source", "p0", "kept").join(others, "lang").where(F.col("item") != F.col("source"))
            .withColumn("a", F.least("source", "item")).withColumn("b", F.greatest("source", "item")))
    other_way = single.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), F.col("single").alias("single_back"))
    none = F.coalesce(F.expr(f"kept * ({_divergence('p0', 'q0')})"), F.lit(0))
    value = none + sum(F.coalesce(c, F.lit(0)) for c in ("joint", "single", "single_back"))
    return (both.join(cells, ["lang", "a", "b"], "left").join(single, ["lang", "source", "item"], "left")
            .join(other_way, ["lang", "source", "item"], "left").select("lang", "source", "item", value.alias("value")))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' sources against each other and against their language."""
    return divergences(table(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row_no, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents),
words AS (
  SELECT row_no, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
counts AS (SELECT lang, source, term, count(*) AS n FROM words GROUP BY ALL),
kept AS (SELECT lang, term FROM words GROUP BY ALL HAVING count(DISTINCT row_no) >= 10),
grp AS (SELECT DISTINCT lang, source FROM docs),
cells AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n
  FROM grp g JOIN kept k USING (lang) LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
shares AS (
  SELECT lang, source, term, n, 1 + (1000000000::HUGEINT * (n + 2)) // (sum(n) OVER w + 2 * count(*) OVER w) AS p
  FROM cells WINDOW w AS (PARTITION BY lang, source)),
lang_cells AS (SELECT lang, term, sum(n) AS n FROM cells GROUP BY ALL),
lang_shares AS (
  SELECT lang, term, 1 + (1000000000::HUGEINT * (n + 2)) // (sum(n) OVER w + 2 * count(*) OVER w) AS q
  FROM lang_cells WINDOW w AS (PARTITION BY lang)),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
terms AS (
  SELECT s.lang, s.source, s.term AS item, ((p - q) * (p - q)) // (p + q) AS value
  FROM shares s JOIN lang_shares l ON l.lang = s.lang AND l.term = s.term WHERE n > 0 AND p > q),
results AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL SELECT lang, source, 'term', item, value FROM terms)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM results)
WHERE part = 'pair' OR rank <= 10
"""
