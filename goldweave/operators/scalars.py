"""One-row reports put together from aggregates of several tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def one_row(*parts: DataFrame) -> DataFrame:
    """Merges one-row frames with distinct columns into one row, without a join."""
    kinds = {f.name: f.dataType for part in parts for f in part.schema}
    stacked = reduce(DataFrame.unionByName, [
        part.select(*[
            (F.col(c) if c in part.columns else F.lit(None)).cast(kind).alias(c) for c, kind in kinds.items()
        ])
        for part in parts
    ])
    return stacked.agg(*[F.max(c).alias(c) for c in kinds])


def table_count(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def links_per_golden(links: DataFrame) -> DataFrame:
    """Links and survivors of each golden record; one shuffle serves every link statistic."""
    return links.groupBy("golden_id").agg(
        F.count(F.lit(1)).alias("links"), F.count_if("is_survivor").alias("survivors")
    )
