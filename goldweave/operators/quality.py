"""Data-quality suites: declared expectations, measured in one aggregation per suite."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldweave.config import ENTITY_STATUSES, PARTY_TYPES, SOURCE_SYSTEMS
from goldweave.functions.text import natural_key
from goldweave.operators.mastering import moment
from goldweave.operators.scalars import links_per_golden, one_row, table_count
from goldweave.session import Scratch

RESULT = T.StructType([
    T.StructField("suite", T.StringType()),
    T.StructField("position", T.IntegerType()),
    T.StructField("expectation", T.StringType()),
    T.StructField("column", T.StringType()),
    T.StructField("filter", T.StringType()),
    T.StructField("table_rows", T.LongType()),
    T.StructField("total", T.LongType()),
    T.StructField("passed", T.LongType()),
    T.StructField("failed", T.LongType()),
    T.StructField("unique", T.LongType()),
    T.StructField("duplicates", T.LongType()),
    T.StructField("pass_rate", T.DoubleType()),
    T.StructField("mostly", T.DoubleType()),
    T.StructField("success", T.BooleanType()),
    # What was asked for: the allowed values, or the bounds of a length or number.
    T.StructField("value_set", T.ArrayType(T.StringType())),
    T.StructField("min_value", T.DoubleType()),
    T.StructField("max_value", T.DoubleType()),
])


@dataclass(frozen=True)
class _Check:
    expectation: str
    column: str
    kind: str  # rate | unique | missing
    total: Column | None = None
    passed: Column | None = None
    mostly: float | None = None
    filter: str | None = None
    value_set: tuple[str, ...] | None = None
    bounds: tuple[float, float] | None = None

    @property
    def arguments(self) -> list[Column]:
        allowed = F.array(*map(F.lit, self.value_set)) if self.value_set is not None else F.lit(None)
        low, high = self.bounds or (None, None)
        return [
            allowed.cast("array<string>").alias("value_set"), F.lit(low).cast("double").alias("min_value"), F.lit(high).cast("double").alias("max_value"),
        ]


@dataclass
class ExpectationSuite:
    """Named list of column expectations over one table.

    An expectation on an absent column is reported as failed. With
    ``strict=False`` a not-null check on it passes and the others leave no row.
    """

    name: str
    df: DataFrame
    strict: bool = True
    checks: list[_Check] = field(default_factory=list)

    def _add(self, check: _Check, absent_passes: bool = False) -> ExpectationSuite:
        if check.column in self.df.columns:
            self.checks.append(check)
        elif self.strict:
            self.checks.append(_Check(f"column_missing_{check.column}", check.column, "missing", mostly=check.mostly))
        elif absent_passes:
            self.checks.append(_Check(check.expectation, check.column, "rate", check.total, check.total, check.mostly, check.filter))
        return self

    def expect_column_values_to_not_be_null(self, column: str, filter_expr: str | None = None, mostly: float = 1.0) -> ExpectationSuite:
        """Rows (of those passing ``filter_expr``) that hold a value; '' counts as one."""
        chosen = F.coalesce(F.expr(filter_expr), F.lit(False)) if filter_expr else F.lit(True)
        present = F.col(column).isNotNull()
        return self._add(
            _Check(f"expect_{column}_not_null", column, "rate", F.count_if(chosen), F.count_if(chosen & present), mostly, filter_expr),
            absent_passes=True,
        )

    def expect_column_values_to_be_in_set(self, column: str, value_set: list | tuple, mostly: float = 1.0) -> ExpectationSuite:
        """Non-null values out of ``value_set``."""
        return self._add(
            _Check(f"expect_{column}_in_set", column, "rate", F.count(F.col(column)), F.count_if(F.col(column).isin(*value_set)), mostly,
                   value_set=tuple(map(str, value_set)))
        )

    def expect_column_value_lengths_to_be_between(self, column: str, min_len: int, max_len: int, mostly: float = 1.0) -> ExpectationSuite:
        """Text length of non-null values within bounds."""
        fits = F.length(F.col(column).cast("string")).between(min_len, max_len)
        return self._add(
            _Check(f"expect_{column}_length_{min_len}_to_{max_len}", column, "rate", F.count(F.col(column)), F.count_if(fits), mostly,
                   bounds=(min_len, max_len))
        )

    def expect_column_values_to_be_between(self, column: str, min_val: float, max_val: float, mostly: float = 1.0) -> ExpectationSuite:
        """Values within bounds, among those that read as numbers."""
        number = F.col(column).try_cast("double")
        number = F.when(~F.isnan(number), number)
        return self._add(
            _Check(f"expect_{column}_between_{min_val}_{max_val}", column, "rate", F.count(number),
                   F.count_if(number.between(min_val, max_val)), mostly, bounds=(min_val, max_val))
        )

    def expect_column_values_to_be_unique(self, column: str) -> ExpectationSuite:
        """No non-null value occurs twice."""
        return self._add(_Check(f"expect_{column}_unique", column, "unique"))

    def _measures(self) -> list[Column]:
        """Counts behind the rate checks, all from a single pass over the table."""
        return [F.count(F.lit(1)).alias("table_rows"), *[
            m.alias(f"{k}_{i}") for i, c in enumerate(self.checks) if c.kind == "rate" for k, m in (("total", c.total), ("passed", c.passed))]]

    def _rates(self, measured: DataFrame) -> DataFrame:
        """The rate checks from a row of their counts."""
        rated = [(i, c) for i, c in enumerate(self.checks) if c.kind != "unique"]
        null = lambda kind: F.lit(None).cast(kind)
        rows = []
        for i, c in rated:
            missing = c.kind == "missing"
            total = F.lit(0).cast("bigint") if missing else F.col(f"total_{i}")
            passed = F.lit(0).cast("bigint") if missing else F.col(f"passed_{i}")
            rate = F.lit(0.0) if missing else F.when(total > 0, F.round(passed / total, 4)).otherwise(1.0)
            rows.append(F.struct(
                F.lit(self.name).alias("suite"), F.lit(i).alias("position"), F.lit(c.expectation).alias("expectation"),
                F.lit(c.column).alias("column"), F.lit(c.filter).cast("string").alias("filter"), F.col("table_rows"),
                total.alias("total"), passed.alias("passed"), (total - passed).alias("failed"),
                null("bigint").alias("unique"), null("bigint").alias("duplicates"), rate.alias("pass_rate"),
                F.lit(c.mostly).cast("double").alias("mostly"),
                (F.lit(False) if missing else rate >= c.mostly).alias("success"), *c.arguments,
            ))
        return measured.select(F.explode(F.array(*rows)).alias("r")).select("r.*")

    def _unique(self, position: int, check: _Check, df: DataFrame) -> DataFrame:
        null = lambda kind: F.lit(None).cast(kind)
        counts = df.groupBy(F.col(check.column).alias("key")).agg(F.count(F.lit(1)).alias("n"))
        held = F.col("key").isNotNull()
        totals = counts.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("table_rows"),
            F.coalesce(F.sum(F.when(held, F.col("n"))), F.lit(0)).alias("total"),
            F.count_if(held).alias("unique"),
        )
        return totals.select(
            F.lit(self.name).alias("suite"), F.lit(position).alias("position"), F.lit(check.expectation).alias("expectation"),
            F.lit(check.column).alias("column"), null("string").alias("filter"), "table_rows", "total",
            null("bigint").alias("passed"), null("bigint").alias("failed"), "unique",
            (F.col("total") - F.col("unique")).alias("duplicates"), null("double").alias("pass_rate"),
            null("double").alias("mostly"), (F.col("total") == F.col("unique")).alias("success"), *check.arguments,
        )

    def _results(self, measured: DataFrame, df: DataFrame) -> DataFrame:
        parts = [self._unique(i, c, df) for i, c in enumerate(self.checks) if c.kind == "unique"]
        if any(c.kind != "unique" for c in self.checks):
            parts.insert(0, self._rates(measured))
        return reduce(DataFrame.unionByName, parts)

    def results(self) -> DataFrame:
        """One row per expectation, in the order they were declared (``position``)."""
        return self._results(self.df.agg(*self._measures()), self.df)

    def while_writing(self, write: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
        """(table, results): the table that ``write`` stores and reads back, and the results, counted by the write itself.

        Only a uniqueness check reads the stored table, and of it its column.
        """
        seen = Observation()
        stored = write(self.df.observe(seen, *self._measures()))
        counts = seen.get
        names = [f"{k}_{i}" for i, c in enumerate(self.checks) if c.kind == "rate" for k in ("total", "passed")]
        row = tuple(int(counts[name]) for name in ("table_rows", *names))
        measured = self.df.sparkSession.createDataFrame([row], T.StructType([T.StructField(name, T.LongType()) for name in ("table_rows", *names)]))
        return stored, self._results(measured, stored)

    def summary(self) -> DataFrame:
        return suite_summary(self.results())


def suite_summary(results: DataFrame) -> DataFrame:
    """Totals per suite; passed and failed records are sums over its checks."""
    return results.groupBy("suite").agg(
        F.max("table_rows").alias("total_records"),
        F.coalesce(F.sum("passed"), F.lit(0)).alias("passed_records"),
        F.coalesce(F.sum("failed"), F.lit(0)).alias("failed_records"),
        F.count(F.lit(1)).alias("total_checks"),
        F.count_if("success").alias("passed_checks"),
        F.count_if(~F.col("success")).alias("failed_checks"),
        F.bool_and("success").alias("overall_success"),
    )


# The members, columns and thresholds of the two suites below.
def source_suite(parties: DataFrame, strict: bool = True) -> ExpectationSuite:
    """Checks on incoming records, run before mastering."""
    keyed = parties.withColumn("source_key", natural_key())
    suite = ExpectationSuite("source_parties_suite", keyed, strict)
    suite.expect_column_values_to_be_in_set("party_type", PARTY_TYPES)
    suite.expect_column_values_to_not_be_null("full_name", mostly=0.99)
    suite.expect_column_values_to_not_be_null("tax_id", mostly=0.90)
    suite.expect_column_value_lengths_to_be_between("tax_id", 9, 12, mostly=0.95)
    suite.expect_column_values_to_be_in_set("source_system", SOURCE_SYSTEMS)
    suite.expect_column_values_to_be_in_set("entity_status", ENTITY_STATUSES, mostly=0.99)
    suite.expect_column_values_to_not_be_null("address_line1", mostly=0.95)
    suite.expect_column_values_to_not_be_null("city", mostly=0.95)
    suite.expect_column_value_lengths_to_be_between("state", 2, 2, mostly=0.95)
    suite.expect_column_values_to_be_unique("source_key")
    return suite


def golden_suite(golden: DataFrame, strict: bool = True) -> ExpectationSuite:
    """Checks on golden records, run after mastering."""
    suite = ExpectationSuite("golden_parties_suite", golden, strict)
    suite.expect_column_values_to_be_unique("golden_id")
    suite.expect_column_values_to_not_be_null("full_name", mostly=0.99)
    suite.expect_column_values_to_be_in_set("party_type", PARTY_TYPES)
    suite.expect_column_values_to_not_be_null("tax_id", mostly=0.90)
    suite.expect_column_values_to_be_between("confidence_score", 0.0, 1.0)
    suite.expect_column_values_to_be_between("confidence_score", 0.80, 1.0, mostly=0.95)
    suite.expect_column_values_to_be_in_set("entity_status", ENTITY_STATUSES, mostly=0.99)
    suite.expect_column_values_to_not_be_null("address_line1", mostly=0.90)
    suite.expect_column_values_to_not_be_null("city", mostly=0.90)
    return suite


def cluster_totals(parties: DataFrame, golden: DataFrame, links: DataFrame) -> DataFrame:
    """Row counts behind the integrity checks, one row."""
    return one_row(
        table_count(parties, "total_source"),
        table_count(golden, "total_golden"),
        table_count(links.filter("source_party_id IS NOT NULL").groupBy("source_party_id").count(), "linked_source"),
        links_per_golden(links).filter("golden_id IS NOT NULL").agg(
            F.count(F.lit(1)).alias("linked_golden"), F.coalesce(F.sum("survivors"), F.lit(0)).alias("survivors")
        ),
    )


CLUSTER_SUITE = "cluster_integrity_suite"


def cluster_suite(totals: DataFrame) -> DataFrame:
    """Integrity checks: every record linked, every golden record linked, one survivor each."""
    nothing = F.lit(None).cast("bigint")
    check = lambda position, name, total, linked, missing, good, **counts: F.struct(
        F.lit(CLUSTER_SUITE).alias("suite"), F.lit(position).alias("position"), F.lit(name).alias("expectation"),
        total.alias("total"), linked.alias("linked"), missing.alias("missing"), good.alias("success"),
        *[counts.get(k, nothing).cast("bigint").alias(k) for k in ("unlinked", "orphans", "survivors", "golden")],
    )
    c = F.col
    unlinked, orphans = c("total_source") - c("linked_source"), c("total_golden") - c("linked_golden")
    rows = F.array(
        check(0, "all_source_records_linked", c("total_source"), c("linked_source"), unlinked, unlinked == 0, unlinked=unlinked),
        check(1, "all_golden_records_have_clusters", c("total_golden"), c("linked_golden"), orphans, orphans == 0, orphans=orphans),
        check(2, "each_cluster_has_one_survivor", c("total_golden"), c("survivors"), c("total_golden") - c("survivors"),
              c("survivors") == c("total_golden"), survivors=c("survivors"), golden=c("total_golden")),
    )
    return totals.select(F.explode(rows).alias("r")).select("r.*")


def cluster_summary(checks: DataFrame) -> DataFrame:
    """Suite totals of the integrity checks; records are source records linked or not."""
    first = lambda name: F.max(F.when(F.col("position") == 0, F.col(name)))
    return checks.groupBy("suite").agg(
        first("total").alias("total_records"), first("linked").alias("passed_records"), first("missing").alias("failed_records"),
        F.count(F.lit(1)).alias("total_checks"), F.count_if("success").alias("passed_checks"),
        F.count_if(~F.col("success")).alias("failed_checks"), F.bool_and("success").alias("overall_success"),
    )


def _details(checks: DataFrame) -> DataFrame:
    fields = [c for c in checks.columns if c not in ("suite", "position", "table_rows")]
    ordered = F.array_sort(F.collect_list(F.struct("position", F.struct(*fields).alias("check"))))
    return checks.groupBy("suite").agg(F.to_json(F.transform(ordered, lambda x: x["check"])).alias("details"))


def dq_results(runs: list[tuple[str, DataFrame, DataFrame]], run_id: str, as_of: str | None = None) -> DataFrame:
    """Result rows to append, from (table name, summary, checks) of each suite.

    ``pass_rate`` divides the passed records of all checks by the table's rows,
    so it exceeds 1 when several checks count; ``record_check_rate`` is the
    share of passed record checks.
    """
    rows = []
    for table, summary, checks in runs:
        passed, failed, total = F.col("passed_records"), F.col("failed_records"), F.col("total_records")
        rows.append(
            summary.join(_details(checks), "suite").select(
                F.lit(run_id).alias("run_id"), F.lit(table).alias("source_system"), F.col("suite").alias("expectation_suite"),
                "total_records", "passed_records", "failed_records",
                F.when(total > 0, F.round(passed / total, 4)).otherwise(0.0).alias("pass_rate"),
                F.when(passed + failed > 0, F.round(passed / (passed + failed), 4)).otherwise(0.0).alias("record_check_rate"),
                "details", moment(as_of).alias("run_at"),
            )
        )
    return reduce(DataFrame.unionByName, rows)


def quality_report(summaries: list[DataFrame], checks: list[DataFrame]) -> DataFrame:
    """Per suite: status, check counts, names of failed checks; last row is the overall verdict."""
    totals = reduce(DataFrame.unionByName, summaries)
    named = reduce(DataFrame.unionByName, [c.select("suite", "position", "expectation", "success") for c in checks])
    failed = named.filter(~F.col("success")).groupBy("suite").agg(
        F.array_sort(F.collect_list(F.struct("position", "expectation"))).alias("f")
    )
    status = lambda good: F.when(good, "PASSED").otherwise("FAILED").alias("status")
    suites = totals.join(failed, "suite", "left").select(
        "suite", status(F.col("overall_success")), "total_records", "passed_checks", "total_checks",
        F.coalesce(F.array_join(F.transform("f", lambda x: x["expectation"]), ","), F.lit("")).alias("failed_checks"),
    )
    overall = totals.agg(
        F.bool_and("overall_success").alias("good"), F.sum("total_records").alias("total_records"),
        F.sum("passed_checks").alias("passed_checks"), F.sum("total_checks").alias("total_checks"),
    ).select(F.lit("OVERALL").alias("suite"), status(F.col("good")), "total_records", "passed_checks", "total_checks", F.lit("").alias("failed_checks"))
    return suites.unionByName(overall)


@dataclass(frozen=True)
class QualityRun:
    results: DataFrame
    report: DataFrame


def run_quality(parties: DataFrame, golden: DataFrame, links: DataFrame, run_id: str, as_of: str | None = None,
                scratch: Scratch | None = None) -> QualityRun:
    """All three suites: rows for the results table and the report.

    The few check rows are written once, so the tables are scanned once for both outputs.
    """
    scratch = scratch or Scratch(parties.sparkSession, "quality")
    source = scratch.save(source_suite(parties).results(), "source_checks")
    master = scratch.save(golden_suite(golden).results(), "golden_checks")
    integrity = scratch.save(cluster_suite(cluster_totals(parties, golden, links)), "cluster_checks")
    summaries = [suite_summary(source), suite_summary(master), cluster_summary(integrity)]
    checks = [source, master, integrity]
    names = ["source_parties", "golden_parties", "party_clusters"]
    return QualityRun(
        dq_results(list(zip(names, summaries, checks)), run_id, as_of), quality_report(summaries, checks)
    )
