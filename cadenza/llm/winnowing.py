"""Document fingerprints by winnowing, with DataFrame functions only.

Every run of ``gram`` code points of a text is hashed; of each ``window`` consecutive hashes
the smallest is selected, the rightmost one of equals, with its position. Any two texts that
share ``gram + window - 1`` consecutive code points then select a common hash there, and its
positions tell where. A text shorter than ``gram`` is one gram; with fewer than ``window``
grams there is one window; an empty text has an empty fingerprint.

In the expressions a gram is one long: 33 bits of its XXH64 above 30 bits that hold its
position counted down, so that the smallest long of a window is the rightmost smallest hash.
Window minima are taken by doubling: minima over 1, 2, 4, ... neighbours, log2(window) passes.

Defined cases: a null text counts as empty; repeated rows each get their row; texts above
2^30 code points would need a wider position; extra columns are kept by ``winnow``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cadenza.llm.common import table

GRAM, WINDOW = 12, 16
POSITION_BITS = 30
LAST = (1 << POSITION_BITS) - 1


def winnow(df: DataFrame, text: str, out: str, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """``df`` with ``out``: array<long> of the selected grams of ``text`` in text order, each
    the gram's hash above the reversed position (:func:`hashes`, :func:`positions`)."""
    if window & (window - 1):
        raise ValueError("window must be a power of two")
    # one match per code point: the gram is looked ahead at, one code point is consumed
    grams = F.expr(f"regexp_extract_all(`{text}`, '(?s)(?=(.{{{gram}}})).', 1)")
    short = F.when(F.coalesce(F.char_length(text), F.lit(0)) == 0, F.array().cast("array<string>")).otherwise(F.array(text))
    df = df.withColumn(out, F.when(F.char_length(text) >= gram, grams).otherwise(short))
    df = df.withColumn(out, F.expr(
        f"transform(`{out}`, (g, i) -> shiftleft(xxhash64(g) & {(1 << 33) - 1}L, {POSITION_BITS}) | ({LAST}L - i))"))
    step = 1
    while step < window:
        df = df.withColumn(out, F.expr(
            f"zip_with(`{out}`, slice(`{out}`, {1 + step}, greatest(size(`{out}`) - {step}, 0)), (a, b) -> least(a, b))"))
        step *= 2
    # the last window - 1 entries are minima of windows that would reach past the end
    return df.withColumn(out, F.expr(f"array_distinct(slice(`{out}`, 1, greatest(size(`{out}`) - {window - 1}, 1)))"))


def winnow_edit(df: DataFrame, text: str, edited: str, kept: Column, out: tuple[str, str],
                gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """``df`` with the selections of ``text`` and of ``edited``, two texts alike in their first
    ``kept`` code points. Windows wholly among these are gone through once for both; what is behind
    them is a text of its own only where there are no such windows, so a tail too short for a
    window then selects nothing, as in a text that is gone through at once."""
    span = gram + window - 1
    same, head, tail = (f"_{out[0]}_{x}" for x in ("cut", "head", "tail"))
    df = df.withColumn(same, F.greatest(kept - (span - 1), F.lit(0)))  # the first window that an edit can change
    df = df.withColumn(head, F.when(F.col(same) > 0, F.substring(text, F.lit(1), kept)).otherwise(""))
    df = winnow(df, head, head + "_s", gram, window)
    for column, name in ((text, out[0]), (edited, out[1])):
        df = df.withColumn(tail, F.substring(column, F.col(same) + 1, F.char_length(column)))
        df = winnow(df, tail, name, gram, window)
        df = df.withColumn(name, F.expr(
            f"if(`{same}` > 0 and char_length(`{tail}`) < {span}, `{head}_s`, "
            f"array_union(`{head}_s`, transform(`{name}`, v -> v - `{same}`)))"))
    return df.drop(same, head, head + "_s", tail)


def hashes(selected: Column | str) -> Column:
    """The distinct selected hashes, without positions."""
    return F.array_distinct(F.transform(selected, lambda v: F.shiftright(v, POSITION_BITS)))


def positions(selected: Column | str) -> Column:
    """``array<struct<hash, pos>>``: the selected hashes with their 0-based code point positions."""
    return F.transform(selected, lambda v: F.struct(
        F.shiftright(v, POSITION_BITS).alias("hash"), (F.lit(LAST) - v.bitwiseAND(F.lit(LAST))).alias("pos")))


def likeness(a: str, b: str) -> Column:
    """Share of common hashes among all of two ``hashes`` columns (Jaccard); two empty ones are alike."""
    common = F.size(F.array_intersect(a, b))
    every = F.size(a) + F.size(b) - common
    return F.when(every == 0, 1.0).otherwise(common / every)


def digest(selected: str) -> Column:
    """A fingerprint as one short text: equal for equal selections."""
    return F.lower(F.lpad(F.hex(F.xxhash64(selected)), 16, "0"))


def next_rows(df: DataFrame, key: str, text: str) -> tuple[DataFrame, Window]:
    """Deal ``df`` out so that every row meets its successor by (``key``, ``text``) in one bucket.

    Buckets are ranges of the key, cut at the smallest key of each of a range partitioning's
    tasks. The rows of a bucket's smallest key are also copied to the end of the bucket
    before it (of the first bucket: to the last), marked ``_copy``. Texts move once. Returns
    the rows with ``_bucket`` and ``_copy`` and the window over which ``lead`` is the next row;
    drop the copies after it. Null keys come first.
    """
    spark = df.sparkSession
    df = df.withColumn("_key", F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63))))
    tasks = max(64, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    first = (df.select("_key").repartitionByRange(tasks, "_key").groupBy(F.spark_partition_id())
             .agg(F.min("_key").alias("first")).collect())
    bounds = sorted({r.first for r in first}) or [0]
    steps = [1 << i for i in range(len(bounds).bit_length() - 1, -1, -1)]
    # binary search for the last bound at or below the key
    array = "array(" + ", ".join(f"bigint('{b}')" for b in bounds) + ")"
    df = df.withColumn("_bounds", F.expr(array)).withColumn("_bucket", F.expr(
        f"aggregate(array({', '.join(map(str, steps))}), 0, (at, step) -> "
        f"if(at + step < {len(bounds)} and get(_bounds, at + step) <= _key, at + step, at))"))
    before = F.pmod(F.col("_bucket") - 1, F.lit(len(bounds)))
    here = F.struct(F.col("_bucket").alias("b"), F.lit(False).alias("c"))
    there = F.struct(before.alias("b"), F.lit(True).alias("c"))
    to = F.when(F.expr("get(_bounds, _bucket) = _key"), F.array(here, there)).otherwise(F.array(here))
    df = df.withColumn("_to", F.explode(to)).withColumns({"_bucket": F.col("_to.b"), "_copy": F.col("_to.c")})
    df = df.drop("_to", "_bounds").repartition("_bucket")
    return df, Window.partitionBy("_bucket").orderBy("_copy", "_key", text)


def op7_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, whose second half is the
    beginning of the next document, with the likeness to the edited text and to that document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows, order = next_rows(docs, "doc_id", "text")
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    # within the bucket: the next text first, then both selections, then the next row's
    rows = rows.withColumn("next_text", F.lead("text").over(order))
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half))
    rows = rows.withColumn("edited", F.coalesce(edited, F.lit(""))).withColumn("n_chars", n.cast("long"))
    rows = winnow_edit(rows, "text", "edited", n - half, ("own", "new"))
    rows = rows.withColumn("own_hashes", hashes("own")).withColumn("new_hashes", hashes("new"))
    rows = rows.withColumn("next_hashes", F.lead("own_hashes").over(order)).where(~F.col("_copy"))
    return rows.select("doc_id", "n_chars", F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
                       digest("own").alias("fingerprint"), digest("new").alias("edited_fingerprint"),
                       likeness("own_hashes", "new_hashes").alias("near_edited"),
                       likeness("own_hashes", "next_hashes").alias("near_next"))
