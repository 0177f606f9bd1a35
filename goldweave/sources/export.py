"""Golden export: full set, by party type, and records with several sources."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldweave.schemas import GOLDEN_PARTIES
from goldweave.sources.files import exchange

EXPORT_VERSION = "1.0"


def golden_export(golden: DataFrame, links: DataFrame, parties: DataFrame, exported_at: str) -> DataFrame:
    """Golden records with link count, contributing sources and export metadata.

    Links are reduced to one row per golden record before they meet the golden table.
    """
    sources = parties.select(F.col("id").alias("source_party_id"), "source_system")
    stats = (
        links.select("golden_id", "source_party_id")
        .join(sources, "source_party_id", "left")
        .groupBy("golden_id")
        .agg(
            F.count("source_party_id").alias("n"),
            F.array_sort(F.collect_set("source_system")).alias("systems"),
        )
    )
    return golden.join(stats, "golden_id", "left").select(
        *GOLDEN_PARTIES.names,
        F.coalesce("n", F.lit(0)).alias("source_record_count"),
        F.when(F.size("systems") > 0, F.array_join("systems", ",")).alias("contributing_sources"),
        F.lit(exported_at).alias("exported_at"),
        F.lit(EXPORT_VERSION).alias("export_version"),
    )


def several_sources(export: DataFrame) -> DataFrame:
    return export.filter(F.col("source_record_count") > 1)


def write_export(export: DataFrame, zone: str) -> None:
    """Writes the three export sets below ``<zone>/golden_records``.

    The full set is written once; the other two read it back. Files are
    ordered by type and name inside. All is written next to the export in
    place, which is then exchanged as a whole and kept until the next time, so
    readers meet the old files or the new ones.
    """
    spark, new = export.sparkSession, f"{zone}/.golden_records-{uuid.uuid4().hex}"
    ordered = export.sortWithinPartitions("party_type", "full_name")
    ordered.write.mode("overwrite").option("compression", "snappy").parquet(f"{new}/full")
    full = spark.read.schema(export.schema).parquet(f"{new}/full")
    typed = full.filter("party_type IS NOT NULL")
    typed.write.mode("overwrite").option("compression", "snappy").partitionBy("party_type").parquet(f"{new}/by_type")
    several_sources(full).write.mode("overwrite").option("compression", "snappy").parquet(f"{new}/multi_source")
    exchange(spark, new, f"{zone}/golden_records", f"{zone}/.golden_records-before")


def export_summary(export: DataFrame) -> DataFrame:
    """Exported records, those with several sources, distinct party types."""
    by_type = export.groupBy("party_type").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("source_record_count") > 1).alias("multi")
    )
    return by_type.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
        F.coalesce(F.sum("multi"), F.lit(0)).alias("multi_source"),
        F.count("party_type").alias("party_types"),
    )


def iso_text(value: Column) -> Column:
    """ISO text of a date or timestamp column."""
    return F.regexp_replace(value.cast("string"), " ", "T")


def serialize(df: DataFrame) -> DataFrame:
    """Dates and timestamps as ISO text, other columns unchanged."""
    kinds = dict(df.dtypes)
    return df.select(*[
        (iso_text(F.col(c)) if kinds[c] in ("date", "timestamp", "timestamp_ntz") else F.col(c)).alias(c) for c in df.columns
    ])
