import datetime as dt

from pyspark.sql import DataFrame


def lists(df: DataFrame, key: str = "user_id") -> dict:
    """``(key, pos, item_id)`` rows as {key: [item, ...]} in pos order."""
    out: dict = {}
    for r in df.orderBy(key, "pos").collect():
        out.setdefault(r[key], []).append(r["item_id"])
    return out


def ts(day: int, sec: int = 0) -> dt.datetime:
    return dt.datetime(2000, 1, day, 0, 0, sec)


def reqs(spark, pairs):
    """Requests from (user, k) pairs, numbered from 0."""
    return spark.createDataFrame([(i, u, k) for i, (u, k) in enumerate(pairs)], "request_id bigint, user_id int, k int")
