"""Upserts as new snapshots, and dense ids for new rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from goldweave.session import Scratch

# Columns an upsert refreshes on an existing key.
SOURCE_REFRESHED = ("full_name", "tax_id", "entity_status", "raw_payload")
GOLDEN_REFRESHED = ("full_name", "tax_id", "entity_status")


def collapse_batch(batch: DataFrame, keys: list[str], refreshed: list[str], order: str) -> DataFrame:
    """One row per key as if the batch were applied row by row.

    The last row of a key gives the refreshed columns, its first row the rest;
    ``order`` becomes the first row's.
    """
    kept = [c for c in batch.columns if c not in (*keys, *refreshed, order)]
    both = batch.groupBy(*keys).agg(
        F.min_by(F.struct(F.lit(1).alias("present"), *kept), order).alias("first"),
        F.max_by(F.struct(*refreshed), order).alias("last"),
        F.min(order).alias(order),
    )
    return both.select(*keys, *[F.col(f"first.{c}").alias(c) for c in kept], *[F.col(f"last.{c}").alias(c) for c in refreshed], order)


def upsert(existing: DataFrame, batch: DataFrame, keys: list[str], refreshed: list[str], as_of: Column,
           created: str | None = None, updated: str = "updated_at") -> DataFrame:
    """Snapshot after inserting new keys and refreshing some columns of known ones.

    ``batch`` holds one row per key. ``created`` and ``updated`` are stamped
    with ``as_of`` on insert, ``updated`` also on refresh.
    """
    old, new = existing.withColumn("_old", F.lit(True)).alias("o"), batch.withColumn("_new", F.lit(True)).alias("n")
    joined = old.join(new, [F.col(f"o.{k}") == F.col(f"n.{k}") for k in keys], "full_outer")
    known, given = F.col("_old").isNotNull(), F.col("_new").isNotNull()

    def value(name: str, kind) -> Column:
        before = F.col(f"o.{name}")
        after = F.col(f"n.{name}") if name in batch.columns else F.lit(None)
        if name in keys:
            return F.coalesce(before, after)
        if name == updated:
            return F.when(given, as_of).otherwise(before)
        if name == created:
            return F.when(known, before).otherwise(as_of)
        if name in refreshed:
            return F.when(given, after).otherwise(before)
        return F.when(known, before).otherwise(after)

    return joined.select(*[value(f.name, f.dataType).cast(f.dataType).alias(f.name) for f in existing.schema])


def dense_ids(rows: DataFrame, order: list[str], start: DataFrame, scratch: Scratch, name: str, column: str = "id") -> DataFrame:
    """Numbers rows from the value in the one-row frame ``start`` plus one, in ``order``.

    Rows are range-sorted, numbered inside their partition, and shifted by the
    rows before it. The partition sizes are the only thing summed in one place.
    """
    placed = scratch.save(
        rows.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), name
    )
    inside = placed.withColumn("_n", F.row_number().over(Window.partitionBy("_part").orderBy(*order)))
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("n"))
    running = F.coalesce(
        F.sum("n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    base = start.agg(F.coalesce(F.max(start.columns[0]), F.lit(0)).alias("base")).withColumn("one", F.lit(1))
    shifts = sizes.select("_part", running.alias("shift"), F.lit(1).alias("one")).join(base, "one").select(
        "_part", (F.col("shift") + F.col("base")).alias("shift")
    )
    return (
        inside.join(shifts, "_part")
        .withColumn(column, (F.col("_n") + F.col("shift")).cast("bigint"))
        .drop("_part", "_n", "shift")
    )


def upsert_sources(existing: DataFrame, batch: DataFrame, order: str, as_of: Column, scratch: Scratch | None = None,
                   refreshed: tuple[str, ...] = SOURCE_REFRESHED) -> DataFrame:
    """New snapshot of the source table; unseen keys get the next ids in batch order."""
    keys = ["source_system", "source_party_id"]
    columns = [c for c in batch.columns if c not in ("id", "ingested_at", "updated_at")]
    single = collapse_batch(batch.select(*columns), keys, [c for c in refreshed if c in columns], order)
    if "id" in batch.columns:
        ids = batch.groupBy(*keys).agg(F.min_by("id", order).alias("id"))
        single = single.join(ids, keys)
    else:
        scratch = scratch or Scratch(existing.sparkSession, "upsert")
        single = scratch.save(single, "batch")
        fresh = single.join(existing.select(*keys), keys, "left_anti").select(*keys, order)
        numbered = dense_ids(fresh, [order, *keys], existing.select("id"), scratch, "numbered").drop(order)
        single = single.join(numbered, keys, "left")
    return upsert(existing, single, keys, list(refreshed), as_of, created="ingested_at")


def upsert_golden(existing: DataFrame, batch: DataFrame, as_of: Column) -> DataFrame:
    """New snapshot of the golden table; a known id refreshes name, tax id and status only."""
    return upsert(existing, batch, ["golden_id"], list(GOLDEN_REFRESHED), as_of, created="created_at")


def append_links(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Links with the new ones added; a record that already has a link keeps it."""
    return existing.unionByName(new.join(existing.select("source_party_id"), "source_party_id", "left_anti").select(*existing.columns))
