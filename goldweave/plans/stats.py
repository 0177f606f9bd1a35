"""Counts, breakdowns, chart series and freshness of the mastered tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldweave.functions.text import age_hours, confidence_band
from goldweave.operators.mastering import moment
from goldweave.operators.scalars import links_per_golden, one_row, table_count

STALE_AFTER_HOURS = 24


def _count(name: str = "count") -> Column:
    return F.count(F.lit(1)).alias(name)


def _mean(column: str, places: int) -> Column:
    """Mean rounded half up, computed in decimals when the column is one."""
    return F.round(F.avg(column), places).cast("double")


# Ingest and mastering reports


def ingest_counts(parties: DataFrame) -> DataFrame:
    """Records per source and party type, and a TOTAL row."""
    counted = parties.groupBy("source_system", "party_type").agg(_count())
    total = counted.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("count")).select(
        F.lit("TOTAL").alias("source_system"), F.lit("").alias("party_type"), "count"
    )
    return counted.unionByName(total)


def golden_by_type(golden: DataFrame) -> DataFrame:
    return golden.groupBy("party_type").agg(_count(), _mean("confidence_score", 3).alias("avg_confidence"))


def link_stats(links: DataFrame) -> DataFrame:
    """Distinct golden records linked, links, survivors, and links beyond one per golden record."""
    return links_per_golden(links).agg(
        F.count("golden_id").alias("total_golden"),
        F.coalesce(F.sum("links"), F.lit(0)).alias("total_links"),
        F.coalesce(F.sum("survivors"), F.lit(0)).alias("survivors"),
    ).withColumn("duplicates_resolved", F.col("total_links") - F.col("total_golden"))


def lineage_count(lineage: DataFrame) -> DataFrame:
    return table_count(lineage, "lineage_events")


# Headline statistics


def headline(golden: DataFrame, parties: DataFrame, links: DataFrame, lineage: DataFrame) -> DataFrame:
    """Totals, links of golden records that have several, mean confidence, last lineage event."""
    return one_row(
        golden.agg(_count("total_golden"), F.coalesce(_mean("confidence_score", 4), F.lit(0.0)).alias("avg_confidence")),
        table_count(parties, "total_source"),
        links_per_golden(links).agg(
            F.coalesce(F.sum(F.when(F.col("links") > 1, F.col("links"))), F.lit(0)).alias("duplicates_resolved")
        ),
        lineage.agg(F.max("event_at").alias("last_run")),
    )


def stats_by_type(golden: DataFrame) -> DataFrame:
    return golden.groupBy("party_type").agg(
        _count(), F.coalesce(_mean("confidence_score", 3), F.lit(0.0)).alias("avg_confidence")
    )


# Table breakdowns


def source_breakdown(parties: DataFrame) -> DataFrame:
    return (
        parties.groupBy("source_system", "party_type", "entity_status")
        .agg(_count(), F.max("ingested_at").alias("last_ingested"))
        .orderBy("source_system", F.col("count").desc(), "party_type", "entity_status")
    )


def source_rollup(breakdown: DataFrame) -> DataFrame:
    """Records per source, summed from the breakdown."""
    return breakdown.groupBy("source_system").agg(F.sum("count").alias("count"))


def golden_breakdown(golden: DataFrame) -> DataFrame:
    return (
        golden.groupBy("party_type", "entity_status")
        .agg(
            _count(), _mean("confidence_score", 3).alias("avg_confidence"),
            F.round(F.min("confidence_score"), 3).cast("double").alias("min_confidence"),
        )
        .orderBy("party_type", "entity_status")
    )


def lineage_by_type(lineage: DataFrame) -> DataFrame:
    return (
        lineage.groupBy("event_type").agg(_count(), F.max("event_at").alias("last_event"))
        .orderBy(F.col("count").desc(), "event_type")
    )


def dq_history(results: DataFrame, limit: int = 20) -> DataFrame:
    """Newest quality results."""
    return (
        results.select("run_id", "source_system", "expectation_suite", "total_records", "passed_records", "pass_rate", "run_at")
        .orderBy(F.col("run_at").desc_nulls_first(), "expectation_suite", "run_id").limit(limit)
    )


def dq_runs(results: DataFrame) -> DataFrame:
    return results.agg(F.count_distinct("run_id").alias("total_runs"))


def recent_stream_events(lineage: DataFrame, trigger: str, limit: int = 10) -> DataFrame:
    """Newest lineage rows written by the event stream."""
    return (
        lineage.filter(F.col("triggered_by") == trigger)
        .select("golden_id", "event_type", "triggered_by", "event_at", "changed_fields", "event_id")
        .orderBy(F.col("event_at").desc_nulls_first(), "event_id").limit(limit)
    )


# Chart series


def chart_series(df: DataFrame, column: str) -> DataFrame:
    """(name, value) counts of a column, largest first."""
    return (
        df.groupBy(F.col(column).alias("name")).agg(_count("value")).orderBy(F.col("value").desc(), "name")
    )


def chart_confidence(golden: DataFrame) -> DataFrame:
    return golden.groupBy(confidence_band("confidence_score").alias("range")).agg(_count()).orderBy(F.col("range").desc())


def chart_quality(results: DataFrame) -> DataFrame:
    return results.groupBy(F.col("expectation_suite").alias("suite")).agg(
        F.round(F.avg("pass_rate") * 100, 1).cast("double").alias("pass_rate")
    )


def chart_summary(parties: DataFrame, golden: DataFrame) -> DataFrame:
    totals = one_row(
        table_count(parties, "total_source"),
        golden.agg(_count("total_golden"), F.round(F.avg("confidence_score") * 100, 1).cast("double").alias("avg_confidence_pct")),
    )
    return totals.withColumn("duplicates_resolved", F.col("total_source") - F.col("total_golden"))


# Freshness


def freshness(as_of: str, parties: DataFrame, golden: DataFrame, dq: DataFrame, raw_files: DataFrame | None = None,
              exported: DataFrame | None = None) -> DataFrame:
    """One row per pipeline step: status, last run, age, staleness, detail.

    ``raw_files`` and ``exported`` are zone listings (``zone``, ``key``,
    ``last_modified``, ``size_bytes``), which may be the same: of the first
    the CSV feeds in the raw zone count, a landed feed's folder once; of the
    second the Parquet files of the full export. Their steps are left out when
    not given.
    """
    def step(name: str, df: DataFrame, last: str, detail: Column, empty: str, extra: list[Column] = ()) -> DataFrame:
        facts = df.agg(_count("n"), F.max(last).alias("last"), *extra)
        ran = F.col("n") > 0
        age = age_hours(F.col("last"), moment(as_of))
        return facts.select(
            F.lit(name).alias("step"),
            F.when(ran, "success").otherwise("not_run").alias("status"),
            F.when(ran, F.col("last")).alias("last_run"),
            F.when(ran, F.round(age, 1)).alias("age_hours"),
            F.when(ran, age > STALE_AFTER_HOURS).otherwise(True).alias("is_stale"),
            F.when(ran, detail).otherwise(empty).alias("details"),
        )

    count_text = lambda text: F.concat(F.col("n").cast("string"), F.lit(text))
    steps = [
        step("ingest", parties, "ingested_at", count_text(" source records loaded"), "No source records found"),
        step("master", golden, "created_at", count_text(" golden records created"), "No golden records found"),
        step("quality", dq, "run_at",
             F.concat(F.lit("Pass rate: "), F.round(F.coalesce("rate", F.lit(0.0)) * 100, 1).cast("string"), F.lit("%")),
             "No quality runs found", [F.avg("pass_rate").alias("rate")]),
    ]
    if raw_files is not None:
        feed = F.regexp_extract("key", r"^(.*\.csv)(/|$)", 1)
        feeds = raw_files.filter((F.col("zone") == "raw") & (feed != "")).groupBy(feed.alias("feed")).agg(F.max("last_modified").alias("last_modified"))
        steps.insert(0, step("generate_data", feeds, "last_modified", count_text(" CSV files generated"), "No raw data files found"))
    if exported is not None:
        size = F.concat(F.lit("Size: "), F.round(F.col("bytes") / 1024, 1).cast("string"), F.lit(" KB"))
        full = exported.filter("zone = 'golden' AND key LIKE 'golden_records/full/%' AND key LIKE '%.parquet'")
        steps.append(step("export_s3", full, "last_modified", size, "No Parquet files found", [F.sum("size_bytes").alias("bytes")]))
    return reduce(DataFrame.unionByName, steps)
