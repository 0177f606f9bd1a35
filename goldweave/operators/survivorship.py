"""Best value per field of a cluster, in two map-side combinable aggregations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldweave.config import MasteringConfig
from goldweave.functions.text import usable


def survivor_fields(cfg: MasteringConfig) -> list[str]:
    return [*cfg.field_sources, *cfg.priority_fields]


def usable_rows(parties: DataFrame, cfg: MasteringConfig) -> DataFrame:
    """Record keys with every survivor field reduced to its usable value."""
    return parties.select(
        "id", "source_system", "source_party_id", *[usable(f).alias(f) for f in survivor_fields(cfg)]
    )


def by_source(rows: DataFrame, cfg: MasteringConfig, key: str = "cluster_id") -> DataFrame:
    """One row per cluster and source, from :func:`usable_rows` with a cluster key.

    ``first`` holds the values of the source's first record, ``any`` the
    first usable value of each field over all its records. Rows of a source
    are ordered by ``id``.
    """
    first = F.min_by(F.struct(*cfg.field_sources), "id").alias("first")
    picks = [F.min_by(f, F.when(F.col(f).isNotNull(), F.col("id"))).alias(f) for f in survivor_fields(cfg)]
    return (
        rows.groupBy(key, "source_system")
        .agg(
            F.count(F.lit(1)).alias("records"),
            F.max("id").alias("last_id"),
            F.min("source_party_id").alias("first_party"),
            first,
            *picks,
        )
        .select(
            key, "source_system", "records", "last_id", "first_party", "first",
            F.struct(*survivor_fields(cfg)).alias("any"),
        )
    )


def priority_of(cfg: MasteringConfig, source: str | Column = "source_system") -> Column:
    """Trust of a source; 0 when it is not ranked."""
    column = F.col(source) if isinstance(source, str) else source
    pairs = [F.lit(x) for item in cfg.source_priority.items() for x in item]
    return F.coalesce(F.create_map(*pairs)[column], F.lit(0))


def survivors(sources: DataFrame, cfg: MasteringConfig, key: str = "cluster_id") -> DataFrame:
    """Golden field values and cluster facts from the per-source rows.

    A listed field asks its sources in order for their first record, then falls
    back to the first usable value in (source, id) order. Other fields take the
    first usable value by source priority, then the same order.
    """
    picks = []
    for name, order in cfg.field_sources.items():
        asked = [F.max(F.when(F.col("source_system") == s, F.col(f"first.{name}"))) for s in order]
        value = F.col(f"any.{name}")
        rest = F.min_by(value, F.when(value.isNotNull(), F.col("source_system")))
        picks.append(F.coalesce(*asked, rest).alias(name))
    for name in cfg.priority_fields:
        value = F.col(f"any.{name}")
        rank = F.struct((-priority_of(cfg)).alias("rank"), F.col("source_system"))
        picks.append(F.min_by(value, F.when(value.isNotNull(), rank)).alias(name))
    return sources.groupBy(key).agg(
        F.sum("records").alias("records"),
        F.max(priority_of(cfg)).alias("top_priority"),
        F.min(F.concat("source_system", F.lit("|"), "first_party")).alias("natural_key"),
        F.max(F.struct("source_system", "last_id")).alias("last_member"),
        F.array_sort(F.collect_list(F.struct("source_system", "records"))).alias("source_counts"),
        *picks,
    )


def lone_survivors(rows: DataFrame, cfg: MasteringConfig) -> DataFrame:
    """The same columns for records that match nothing: a projection, no shuffle."""
    return rows.select(
        F.col("id").alias("cluster_id"),
        F.lit(1).cast("bigint").alias("records"),
        priority_of(cfg).alias("top_priority"),
        F.concat("source_system", F.lit("|"), "source_party_id").alias("natural_key"),
        F.array(F.struct("source_system", F.lit(1).cast("bigint").alias("records"))).alias("source_counts"),
        *survivor_fields(cfg),
    )
