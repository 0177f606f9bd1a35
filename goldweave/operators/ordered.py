"""Look-back, look-ahead and look-up by a key that may hold, or lack, any share of the rows.

A plain window would bring a whole key to one task. Here a key is cut into
chunks of the order value: the window runs inside a chunk, and one row per
chunk carries the value across chunk borders.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNK = 100_000


def left_join_spread(rows: DataFrame, found: DataFrame, key: str, spread: str) -> DataFrame:
    """``rows`` left-joined with ``found`` on ``key``; rows without a key, which a join brings to one task, are dealt out by ``spread``."""
    # Zero, but not a literal: the planner takes an equality with a constant out of the join's keys.
    zero = F.pmod(F.xxhash64(key), F.lit(1).cast("bigint"))
    dealt = rows.withColumn("_dealt", F.when(F.col(key).isNull(), F.xxhash64(spread)).otherwise(zero))
    return dealt.join(found.withColumn("_dealt", zero), [key, "_dealt"], "left").drop("_dealt")


def _chunked(rows: DataFrame, order: str, chunk: int) -> DataFrame:
    return rows.withColumn("_chunk", F.floor(F.col(order) / chunk))


def previous_value(rows: DataFrame, key: str, order: str, value: str, output: str, chunk: int = CHUNK) -> DataFrame:
    """Adds the key's ``value`` at the nearest smaller ``order``, NULL when there is none.

    ``order`` is a whole number, unique within the key; ``value`` is not NULL.
    """
    cut = _chunked(rows, order, chunk)
    near = cut.withColumn("_near", F.lag(value).over(Window.partitionBy(key, "_chunk").orderBy(order)))
    last = cut.groupBy(key, "_chunk").agg(F.max_by(value, order).alias("_last"))
    carried = last.select(
        key, "_chunk", F.lag("_last").over(Window.partitionBy(key).orderBy("_chunk")).alias("_far")
    )
    return (
        near.join(carried, [key, "_chunk"])
        .withColumn(output, F.coalesce("_near", "_far"))
        .drop("_chunk", "_near", "_far")
    )


def next_order(rows: DataFrame, key: str, order: str, flag: Column, output: str, chunk: int = CHUNK) -> DataFrame:
    """Adds the smallest larger ``order`` of the key among rows where ``flag`` holds."""
    cut = _chunked(rows, order, chunk).withColumn("_mark", F.when(flag, F.col(order)))
    after = lambda keys, by: Window.partitionBy(*keys).orderBy(by).rowsBetween(1, Window.unboundedFollowing)
    near = cut.withColumn("_near", F.min("_mark").over(after([key, "_chunk"], order)))
    first = cut.groupBy(key, "_chunk").agg(F.min("_mark").alias("_first"))
    carried = first.select(key, "_chunk", F.min("_first").over(after([key], "_chunk")).alias("_far"))
    return (
        near.join(carried, [key, "_chunk"])
        .withColumn(output, F.coalesce("_near", "_far"))
        .drop("_chunk", "_mark", "_near", "_far")
    )
