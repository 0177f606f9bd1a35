"""Frames the registered queries share, all derived from the given tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldweave import fixtures
from goldweave.config import MasteringConfig
from goldweave.operators.mastering import Mastered, master_parties
from goldweave.operators.matching import Matches, find_matches
from goldweave.operators.ordered import left_join_spread
from goldweave.operators.quality import QualityRun, run_quality
from goldweave.schemas import DQ_RESULTS, SOURCE_PARTIES
from goldweave.session import Scratch, tune
from goldweave.sources.tables import AppendTable
from goldweave.plans.search_index import NameIndex
from goldweave.streaming.events import Applied, State, apply_events, decode
from goldweave.streaming.stream import PartyStore

AS_OF = "2025-01-01 00:00:00"
EVENTS_AS_OF = "2025-02-01 00:00:00"

_kept: dict[tuple, object] = {}


def once(spark: SparkSession, sf_dir: str, name: str, build):
    """Builds a shared stage the first time a session asks for it; its tables are written to the shared folder."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _kept:
        _kept[key] = build()
    return _kept[key]


def scratch(spark: SparkSession, label: str, codec: str = "snappy") -> Scratch:
    tune(spark)
    return Scratch(spark, label, codec)


def parties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source records with load times, in the source table's schema."""
    tune(spark)
    loaded = F.timestamp_seconds(F.unix_timestamp(F.lit("2024-12-30 00:00:00").cast("timestamp")) + F.col("id") % 100_000)
    rows = fixtures.source_parties(spark, sf_dir).withColumns({
        "raw_payload": F.lit(None).cast("string"), "ingested_at": loaded, "updated_at": loaded,
    })
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in SOURCE_PARTIES])


def source_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source records as the stored table mastering reads."""
    return once(spark, sf_dir, "sources", lambda: scratch(spark, "sources").save(parties(spark, sf_dir), "source_parties"))


@dataclass(frozen=True)
class Tables:
    parties: DataFrame
    mastered: Mastered

    @property
    def golden(self) -> DataFrame:
        return self.mastered.golden

    @property
    def links(self) -> DataFrame:
        return self.mastered.links

    @property
    def lineage(self) -> DataFrame:
        return self.mastered.lineage


def fresh_mastering(spark: SparkSession, sf_dir: str, cfg: MasteringConfig | None = None) -> Tables:
    """Runs mastering from the source table."""
    rows = source_table(spark, sf_dir)
    return Tables(rows, master_parties(rows, cfg, scratch(spark, "mastering"), AS_OF))


def tables(spark: SparkSession, sf_dir: str) -> Tables:
    """Mastered tables, written once per session as the pipeline would."""
    def build() -> Tables:
        fresh = fresh_mastering(spark, sf_dir)
        out = scratch(spark, "tables")
        m = fresh.mastered
        stored = Mastered(
            m.matches, m.clusters, m.entities, out.save(m.golden, "golden"), out.save(m.links, "links"), out.save(m.lineage, "lineage")
        )
        return Tables(fresh.parties, stored)

    return once(spark, sf_dir, "tables", build)


def matches(spark: SparkSession, sf_dir: str, cfg: MasteringConfig | None = None) -> Matches:
    """Runs the matching stage from the source table."""
    return find_matches(source_table(spark, sf_dir), cfg or MasteringConfig(), scratch(spark, "matching").save)


def quality(spark: SparkSession, sf_dir: str) -> QualityRun:
    t = tables(spark, sf_dir)
    return once(spark, sf_dir, "quality", lambda: run_quality(
        t.parties, t.golden, t.links, "run-1", AS_OF, scratch(spark, "quality")))


RUNS = 8


def dq_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results table after eight runs three hours apart, the second of them repeated."""
    def build() -> DataFrame:
        table = AppendTable(spark, scratch(spark, "dq").path("dq_results"), DQ_RESULTS)
        first = quality(spark, sf_dir).results
        for run in [*range(1, RUNS + 1), 2]:
            later = F.col("run_at") + F.expr(f"INTERVAL {3 * (run - 1)} HOURS")
            table.append(first.withColumns({"run_id": F.lit(f"run-{run}"), "run_at": later}), f"run-{run}")
        return table.read()

    return once(spark, sf_dir, "dq_log", build)


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(seq, value): party events as JSON, references resolved to golden ids.

    An unknown party reference becomes an unknown golden id.
    """
    t = tables(spark, sf_dir)
    refs = t.parties.filter("source_system = 'internal_crm'").select("id", "source_party_id").join(
        t.links.select(F.col("source_party_id").alias("id"), "golden_id"), "id"
    ).drop("id")

    def resolve(df: DataFrame, ref: str, name: str) -> DataFrame:
        found = refs.select(F.col("source_party_id").alias(ref), F.col("golden_id").alias("_g"))
        return left_join_spread(df, found, ref, "seq").withColumn(
            name, F.when(F.col(ref).isNotNull(), F.coalesce("_g", F.concat(F.lit("unknown-"), ref)))
        ).drop("_g")

    events = fixtures.party_events(spark, sf_dir)
    for ref, name in (("party_ref", "golden_id"), ("primary_ref", "primary_golden_id"), ("secondary_ref", "secondary_golden_id")):
        events = resolve(events, ref, name)
    kind = F.col("event_type")
    place = ["address_line1", "address_line2", "city", "state", "postal_code", "country"]
    payload = F.struct(
        F.when(kind == "NEW_PARTY", F.concat(F.lit("Party "), F.col("seq").cast("string"))).alias("full_name"),
        *place,
        F.when(kind == "KYC_STATUS_UPDATE", "VERIFIED").alias("kyc_status"),
        F.when(kind == "KYC_STATUS_UPDATE", F.col("risk_score")).alias("risk_score"),
        F.when(kind == "KYC_STATUS_UPDATE", F.col("raw_props")).alias("notes"),
        F.col("new_status").alias("entity_status"),
        F.when(kind == "ENTITY_MERGE", F.col("primary_golden_id")).alias("primary_golden_id"),
        F.when(kind == "ENTITY_MERGE", F.col("secondary_golden_id")).alias("secondary_golden_id"),
    )
    sent = F.date_format("event_ts", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp")
    message = F.struct("seq", "event_id", "event_type", "golden_id", F.lit("internal_crm").alias("source_system"), sent, payload.alias("payload"))
    return events.select("seq", F.to_json(message).alias("value"))


def state(spark: SparkSession, sf_dir: str) -> State:
    t = tables(spark, sf_dir)
    return State(t.golden, t.links, t.parties, t.lineage)


def applied(spark: SparkSession, sf_dir: str) -> Applied:
    """All events applied as one batch."""
    return once(spark, sf_dir, "applied", lambda: apply_events(
        state(spark, sf_dir), decode(messages(spark, sf_dir)), None, scratch(spark, "events"), EVENTS_AS_OF))


def store(spark: SparkSession, sf_dir: str) -> PartyStore:
    """The stored tables, with all events recorded as batch 0."""
    def build() -> PartyStore:
        t, done = tables(spark, sf_dir), applied(spark, sf_dir)
        out = PartyStore(spark, scratch(spark, "store").path("tables"), buckets=8)
        out.start(t.golden, t.links, t.parties, t.lineage)
        out.record(done, 0, t.parties.agg(F.max("id").alias("id")))
        return out

    return once(spark, sf_dir, "store", build)


def name_index(spark: SparkSession, sf_dir: str) -> NameIndex:
    return once(spark, sf_dir, "names", lambda: NameIndex(spark, scratch(spark, "names").path("trigrams")).build(tables(spark, sf_dir).golden))
