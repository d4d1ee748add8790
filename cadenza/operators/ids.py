"""Dense integer codes for ids of any type, and back.

Models want ids as INT from 0. :func:`dense_index` numbers the distinct ids of a column in their
sort order, as a label encoder does, but by ranges and prefix sums: no task and not the
driver sees all ids. The index is a table ``id, code`` that is written, joined to encode, joined
to decode, and reused for the next batch of rows. Order is kept, so equal orders of ids get
equal codes, whatever their type.

Null ids get no code. More than 2**31 ids fail the job (codes are INT, as models ask for).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.functions.joins import growing
from cadenza.operators.numbering import numbered


def dense_index(ids: DataFrame, col: str) -> DataFrame:
    """``id, code``: the distinct non-null values of ``col``, numbered 0, 1, 2, ... in their order."""
    distinct = ids.select(F.col(col).alias("id")).where(F.col("id").isNotNull()).distinct()
    code = F.when(F.col("place") < 1 << 31, F.col("place")).otherwise(F.raise_error(F.lit("more ids than INT codes")))
    return numbered(distinct, "id").select("id", code.cast("int").alias("code"))


def encode(df: DataFrame, index: DataFrame, col: str, out: str | None = None, unknown: str = "drop") -> DataFrame:
    """``df`` with the codes of ``col`` in ``out`` (default: in its place). Rows whose id the index lacks
    go with ``unknown="drop"``, have a null code with ``"keep"``, fail the job with ``"fail"``."""
    if unknown not in ("drop", "keep", "fail"):
        raise ValueError("unknown is drop, keep or fail")
    side = index.select(F.col("id").alias("_id"), F.col("code").alias("_code"))
    joined = df.join(growing(side), F.col(col) == F.col("_id"), "inner" if unknown == "drop" else "left")
    code = F.col("_code") if unknown != "fail" else F.when(F.col("_code").isNotNull(), F.col("_code")).otherwise(
        F.raise_error(F.concat(F.lit(f"{col} without a code: "), F.coalesce(F.col(col).cast("string"), F.lit("null")))))
    return joined.withColumn(out or col, code).drop("_id", "_code")


def decode(df: DataFrame, index: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """``df`` with the ids behind the codes of ``col`` in ``out`` (default: in its place); codes the index lacks become null."""
    side = index.select(F.col("id").alias("_id"), F.col("code").alias("_code"))
    joined = df.join(growing(side), F.col(col) == F.col("_code"), "left")
    return joined.withColumn(out or col, F.col("_id")).drop("_id", "_code")


def encoded_pairs(pairs: DataFrame, user: str = "user_id", item: str = "item_id") -> tuple[DataFrame, DataFrame, DataFrame]:
    """``pairs`` with INT codes for both ids, and the two indexes (users, items) they came from."""
    from cadenza.operators.numbering import stored
    users, items = (stored(dense_index(pairs, c), f"index-{c}") for c in (user, item))
    return encode(encode(pairs, users, user), items, item), users, items
