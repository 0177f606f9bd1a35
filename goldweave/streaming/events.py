"""Party events applied to the mastered tables, a whole batch at a time.

A batch gives the same tables as its events taken one by one in ``seq``
order. ``seq`` is a whole number, unique within the batch.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldweave.config import MasteringConfig
from goldweave.functions.text import filled, natural_key, uuid_of
from goldweave.operators.mastering import moment
from goldweave.operators.ordered import left_join_spread, next_order, previous_value
from goldweave.operators.upsert import dense_ids
from goldweave.schemas import ADDRESS_COLUMNS, EVENT, GOLDEN_PARTIES, PARTY_CLUSTERS, PARTY_LINEAGE, SOURCE_PARTIES
from goldweave.session import Scratch

ADDRESS_CHANGE, KYC_STATUS_UPDATE, NEW_PARTY, STATUS_CHANGE, ENTITY_MERGE = (
    "ADDRESS_CHANGE", "KYC_STATUS_UPDATE", "NEW_PARTY", "STATUS_CHANGE", "ENTITY_MERGE",
)
HANDLED = (ADDRESS_CHANGE, KYC_STATUS_UPDATE, NEW_PARTY, STATUS_CHANGE, ENTITY_MERGE)
STREAM_PREFIX = "STREAM-"
_OLD_ADDRESS = ("address_line1", "city", "state", "postal_code")
_NEW_PARTY_TEXT = ("full_name", "first_name", "last_name", "tax_id", "address_line1", "address_line2", "city", "state",
                   "postal_code", "email", "phone")


@dataclass(frozen=True)
class State:
    """Tables a batch reads.

    ``lineage`` only serves to recognise events already logged, ``sources``
    records already made by events. ``source_ids`` may give the ids in use, or
    the highest one, more cheaply than ``sources`` does.
    """

    golden: DataFrame
    links: DataFrame
    sources: DataFrame
    lineage: DataFrame
    source_ids: DataFrame | None = None


@dataclass(frozen=True)
class Applied:
    """What a batch changes: new versions of touched rows, and rows to append.

    ``left_links`` names the links (golden_id, source_party_id) that moved away.
    """

    golden: DataFrame
    links: DataFrame
    left_links: DataFrame
    sources: DataFrame
    lineage: DataFrame
    confirmations: DataFrame
    errors: DataFrame


# Fields of a payload that any event reads.
_PAYLOAD = T.StructType([T.StructField(name, T.StringType()) for name in dict.fromkeys((
    *_NEW_PARTY_TEXT, *ADDRESS_COLUMNS, "entity_status", "kyc_status", "kyc_provider", "risk_score", "verification_date", "notes",
    "primary_golden_id", "secondary_golden_id", "reason", "merged_by"))])


# Decoding and routing


def decode(raw: DataFrame) -> DataFrame:
    """JSON text in ``value`` as event columns; ``problem`` says why a message cannot be read.

    ``payload`` stays JSON text, for the log; ``p`` holds its fields, read once,
    and ``payload_keys`` tells missing ones from nulls.
    """
    keys = F.json_object_keys("value")
    has = lambda name: F.coalesce(F.array_contains("_keys", name), F.lit(False))
    absent = lambda name, default: F.when(has(name), F.col(f"e.{name}")).otherwise(F.lit(default))
    parsed = raw.select("seq", "value", keys.alias("_keys"), F.from_json("value", EVENT).alias("e"))
    payload = F.when(has("payload"), F.col("e.payload")).otherwise("{}")
    return parsed.select(
        "seq", "value",
        F.col("e.event_id").alias("event_id"),
        absent("event_type", "UNKNOWN").alias("event_type"),
        F.col("e.timestamp").alias("sent_at"),
        filled("e.golden_id").alias("golden_id"),
        absent("party_type", "INDIVIDUAL").alias("party_type"),
        absent("source_system", "internal_crm").alias("source_system"),
        payload.alias("payload"),
        F.from_json(payload, _PAYLOAD).alias("p"),
        F.json_object_keys(payload).alias("payload_keys"),
        F.when(F.col("_keys").isNull(), "message is not a JSON object").alias("problem"),
    )


def message_key(golden_id: str = "golden_id", event_id: str = "event_id") -> Column:
    """Key an event is partitioned by: its golden id, or else its own id."""
    return F.coalesce(filled(golden_id), F.col(event_id))


def event_mix(events: DataFrame) -> DataFrame:
    return events.groupBy("event_type").agg(F.count(F.lit(1)).alias("count"))


def _field(name: str) -> Column:
    return F.col(f"p.{name}")


def _field_or(name: str, default: str) -> Column:
    """Payload value; the default only when the key is absent."""
    return F.when(F.array_contains("payload_keys", name), _field(name)).otherwise(F.lit(default))


def _readable() -> Column:
    return F.col("payload_keys").isNotNull()


def referred_ids(events: DataFrame) -> DataFrame:
    """(golden_id, merged): the golden records that events name, and which of them a merge may take away."""
    named = lambda value, merged: F.struct(value.alias("golden_id"), F.lit(merged).alias("merged"))
    every = F.array(named(F.col("golden_id"), False), named(filled(_field("primary_golden_id")), False), named(filled(_field("secondary_golden_id")), True))
    return events.select(F.explode(every).alias("r")).select("r.*").filter("golden_id IS NOT NULL").groupBy("golden_id").agg(F.max("merged").alias("merged"))


def event_name() -> Column:
    """Id of an event; one made of its place in the order where it has none."""
    return F.coalesce("event_id", uuid_of(F.col("seq").cast("string"))).alias("event_id")


# New parties


def _new_parties(events: DataFrame, sources: DataFrame) -> DataFrame:
    """NEW_PARTY events with ``accepted``: first of their key in the batch and not stored yet."""
    keys = ["source_system", "source_party_id"]
    asked = events.filter((F.col("event_type") == NEW_PARTY) & _readable() & F.col("source_system").isNotNull()).withColumn(
        "source_party_id", F.concat(F.lit(STREAM_PREFIX), event_name())
    )
    first = asked.groupBy(*keys).agg(F.min("seq").alias("first_seq"))
    stored = sources.select(*keys).join(first.select(*keys), keys, "left_semi").distinct().withColumn("stored", F.lit(True))
    verdict = first.join(stored, keys, "left")
    return asked.join(verdict, keys).withColumn(
        "accepted", (F.col("seq") == F.col("first_seq")) & F.col("stored").isNull()
    ).drop("first_seq", "stored")


def _party_row(accepted: DataFrame) -> DataFrame:
    """Accepted NEW_PARTY events in party columns, keyed by the golden id they create."""
    null = F.lit(None).cast("string")
    return accepted.select(
        "seq", "event_id", uuid_of(natural_key()).alias("golden_id"), "source_system", "source_party_id", "party_type",
        *[_field(n).alias(n) for n in _NEW_PARTY_TEXT],
        _field_or("country", "USA").alias("country"), _field_or("entity_status", "ACTIVE").alias("entity_status"),
        null.cast("date").alias("date_of_birth"), null.alias("lei"), F.col("payload").alias("raw_payload"),
    )


# Verdicts


def _verdicts(events: DataFrame, known: DataFrame, created: DataFrame) -> DataFrame:
    """Every readable event with its ``status`` and ``reason``, and the state its ids had before the batch."""
    reference = F.when(F.col("event_type") == ENTITY_MERGE, F.col("primary_id")).otherwise(F.col("golden_id"))
    asked = events.withColumns({
        "primary_id": F.when(F.col("event_type") == ENTITY_MERGE, filled(_field("primary_golden_id"))),
        "secondary_id": F.when(F.col("event_type") == ENTITY_MERGE, filled(_field("secondary_golden_id"))),
        "new_status": F.when(F.col("event_type") == STATUS_CHANGE, filled(_field("entity_status"))),
    }).withColumn("ref", reference)
    looked_up = left_join_spread(asked, known.withColumnRenamed("known_id", "ref"), "ref", "seq").join(
        created.select("seq", "accepted", "created_id"), "seq", "left"
    )
    exists = F.coalesce(F.col("created_seq") < F.col("seq"), F.lit(False))
    kind = F.col("event_type")
    unreadable = F.lit("error: payload is not an object")
    no_id, not_found = F.lit("skipped: no golden_id"), F.lit("skipped: golden_id not found")
    change = F.when(F.col("golden_id").isNull(), no_id).when(~exists, not_found).when(~_readable(), unreadable)
    status = (
        F.when(F.col("golden_id").isNull(), no_id).when(~_readable(), unreadable)
        .when(F.col("new_status").isNull(), "skipped: no entity_status in payload").when(~exists, not_found)
    )
    merge = (
        F.when(~_readable(), unreadable)
        .when(F.col("primary_id").isNull() | F.col("secondary_id").isNull(), "skipped: missing golden IDs for merge")
        .when(F.col("primary_id") == F.col("secondary_id"), "skipped: merge of a record with itself")
        .when(~exists, "error: primary not found")
    )
    new = (
        F.when(~_readable(), unreadable).when(F.col("source_system").isNull(), "error: source_system is null")
        .when(~F.coalesce("accepted", F.lit(False)), "skipped: duplicate source record")
    )
    outcome = (
        F.when(kind.isin(ADDRESS_CHANGE, KYC_STATUS_UPDATE), change)
        .when(kind == STATUS_CHANGE, status).when(kind == ENTITY_MERGE, merge).when(kind == NEW_PARTY, new)
        .otherwise(F.concat(F.lit("skipped: unknown event type: "), F.coalesce(kind, F.lit("None"))))
    )
    return looked_up.withColumn("_o", F.coalesce(outcome, F.lit("success"))).withColumns({
        "status": F.substring_index("_o", ": ", 1),
        "reason": F.when(F.col("_o") != "success", F.expr("substring(_o, instr(_o, ': ') + 2)")),
    }).drop("_o")


def _known(golden: DataFrame, events: DataFrame, parties: DataFrame) -> DataFrame:
    """Golden records the batch refers to, with when they came to exist and their address and status then."""
    before = golden.join(referred_ids(events).select("golden_id"), "golden_id", "left_semi").withColumn("created_seq", F.lit(None).cast("bigint"))
    both = before.select("golden_id", "created_seq", "entity_status", *ADDRESS_COLUMNS).unionByName(
        parties.select("golden_id", F.col("seq").alias("created_seq"), "entity_status", *ADDRESS_COLUMNS)
    )
    return both.select(
        F.col("golden_id").alias("known_id"),
        F.coalesce("created_seq", F.lit(-(2**62))).alias("created_seq"),
        F.col("entity_status").alias("status_before"),
        F.struct(*ADDRESS_COLUMNS).alias("address_before"),
    )


# State changes


def _address_changes(done: DataFrame) -> DataFrame:
    """Address events with the address each one replaces."""
    fields = [(_field_or("country", "USA") if c == "country" else _field(c)).alias(c) for c in ADDRESS_COLUMNS]
    rows = done.filter(F.col("event_type") == ADDRESS_CHANGE).withColumn("address", F.struct(*fields))
    return previous_value(rows, "golden_id", "seq", "address", "replaced").withColumn(
        "replaced", F.coalesce("replaced", "address_before")
    )


def _status_changes(done: DataFrame, known: DataFrame) -> DataFrame:
    """Status writes per golden record: status events and the secondaries of merges, with the status before."""
    direct = done.filter(F.col("event_type") == STATUS_CHANGE).select(
        "golden_id", "seq", "event_type", F.struct(F.col("new_status").alias("s")).alias("written"), "status_before"
    )
    merged = (
        done.filter(F.col("event_type") == ENTITY_MERGE)
        .select(F.col("secondary_id").alias("known_id"), "seq", "event_type")
        .join(known.select("known_id", F.col("created_seq").alias("born"), "status_before"), "known_id")
        .filter("born < seq")
        .select(F.col("known_id").alias("golden_id"), "seq", "event_type", F.struct(F.lit("MERGED").alias("s")).alias("written"), "status_before")
    )
    return previous_value(direct.unionByName(merged), "golden_id", "seq", "written", "p").select(
        "golden_id", "seq", "event_type", F.col("written.s").alias("new_status"),
        F.when(F.col("p").isNotNull(), F.col("p.s")).otherwise(F.col("status_before")).alias("old_status"),
    )


def link_destinations(merges: DataFrame, scratch: Scratch, name: str = "merge_chain") -> DataFrame:
    """(seq, secondary_id, destination): where the links moved by each merge end up.

    ``merges`` has seq, primary_id, secondary_id. A merge hands its links on to
    the next later merge that has its primary as secondary; chains are
    shortened by doubling, so the rounds grow with the logarithm of their length.
    """
    stops = merges.select(F.col("primary_id").alias("node"), "seq", F.lit(False).alias("leaves")).unionByName(
        merges.select(F.col("secondary_id").alias("node"), "seq", F.lit(True).alias("leaves"))
    )
    onward = next_order(stops, "node", "seq", F.col("leaves"), "next_seq").filter("NOT leaves").select("seq", "next_seq")
    def written(df: DataFrame, table: str) -> tuple[DataFrame, int]:
        """The written hops, and how many of them go on, counted by the write."""
        seen = Observation()
        kept = scratch.save(df.observe(seen, F.count("next_seq").alias("going")), table)
        return kept, seen.get["going"]

    first = merges.join(onward, "seq").select("seq", "secondary_id", F.col("primary_id").alias("destination"), "next_seq")
    rounds = 0
    hops, going = written(first, f"{name}-0")
    while going:
        rounds += 1
        later = hops.select(F.col("seq").alias("next_seq"), F.col("destination").alias("to"), F.col("next_seq").alias("then"))
        step = hops.join(later, "next_seq", "left").select(
            "seq", "secondary_id", F.coalesce("to", "destination").alias("destination"), F.col("then").alias("next_seq")
        )
        hops, going = written(step, f"{name}-{rounds}")
        scratch.drop(f"{name}-{rounds - 1}")
    return hops.select("seq", "secondary_id", "destination")


def _moved_links(done: DataFrame, known: DataFrame, links: DataFrame, scratch: Scratch) -> DataFrame:
    """Links whose golden record ``left_id`` was merged away, at their final place and no longer survivors."""
    merges = scratch.save(
        done.filter(F.col("event_type") == ENTITY_MERGE).select("seq", "primary_id", "secondary_id"), "merges"
    )
    ends = link_destinations(merges, scratch)
    first = (
        ends.join(known.select(F.col("known_id").alias("secondary_id"), "created_seq"), "secondary_id")
        .filter("created_seq < seq")
        .groupBy(F.col("secondary_id").alias("golden_id"))
        .agg(F.min_by("destination", "seq").alias("destination"))
    )
    return links.join(first, "golden_id").select(
        F.col("destination").alias("golden_id"), "source_party_id", F.lit(False).alias("is_survivor"), "match_score", "linked_at",
        F.col("golden_id").alias("left_id"),
    )


# Lineage


def _json(name: str) -> Column:
    return F.try_parse_json(F.col(name))


def _lineage_rows(events: DataFrame, golden_id: Column, kind: str, detail: Column, cfg: MasteringConfig, as_of: str | None) -> DataFrame:
    return events.select(
        "seq", golden_id.alias("golden_id"), F.lit(kind).alias("event_type"),
        F.to_json(detail, {"ignoreNullFields": "false"}).alias("changed_fields"),
        F.lit(cfg.stream_trigger).alias("triggered_by"), "event_id", moment(as_of).alias("event_at"),
    )


def _lineage(done: DataFrame, addresses: DataFrame, statuses: DataFrame, cfg: MasteringConfig, as_of: str | None) -> DataFrame:
    of = lambda kind: done.filter(F.col("event_type") == kind)
    me, event_id = F.col("golden_id"), F.col("event_id")
    field = lambda name: _field(name).alias(name)
    status_events = of(STATUS_CHANGE).join(
        statuses.filter(F.col("event_type") == STATUS_CHANGE).select("seq", "old_status"), "seq"
    )
    return reduce(DataFrame.unionByName, [
        _lineage_rows(addresses, me, "ADDRESS_UPDATED", F.struct(
            F.struct(*[F.col(f"replaced.{c}").alias(c) for c in _OLD_ADDRESS]).alias("old_address"),
            _json("payload").alias("new_address"), F.col("source_system").alias("source"), event_id), cfg, as_of),
        _lineage_rows(of(KYC_STATUS_UPDATE), me, "KYC_STATUS_UPDATED", F.struct(
            field("kyc_status"), field("kyc_provider"), _field("risk_score").try_cast("double").alias("risk_score"),
            field("verification_date"), field("notes"), event_id), cfg, as_of),
        _lineage_rows(of(NEW_PARTY), F.col("created_id"), "CREATED", F.struct(
            F.col("source_system").alias("source"), event_id, "party_type", field("full_name"),
            F.lit("kafka_stream").alias("via")), cfg, as_of),
        _lineage_rows(status_events, me, "STATUS_CHANGED", F.struct(
            "old_status", "new_status", field("reason"), event_id), cfg, as_of),
        _lineage_rows(of(ENTITY_MERGE), F.col("primary_id"), "MERGED", F.struct(
            "primary_id", "secondary_id", field("reason"), field("merged_by"), event_id), cfg, as_of),
    ])


def _fresh_lineage(rows: DataFrame, lineage: DataFrame, events: DataFrame) -> DataFrame:
    """Rows whose event an earlier batch has not logged yet; the log is first cut to the batch's events."""
    logged = lineage.select("event_id", "event_type").join(events.select("event_id").distinct(), "event_id", "left_semi")
    return rows.join(logged, ["event_id", "event_type"], "left_anti").select(*PARTY_LINEAGE.names)


# Whole batch


def _confirmations(verdicts: DataFrame, statuses: DataFrame, as_of: str | None) -> DataFrame:
    """One row per handled or skipped event, with the action taken or the reason."""
    old = statuses.filter(F.col("event_type") == STATUS_CHANGE).select("seq", "old_status")
    kind = F.col("event_type")
    shown = lambda c: F.coalesce(c, F.lit("None"))
    action = (
        F.when(kind == ADDRESS_CHANGE, "address_updated").when(kind == KYC_STATUS_UPDATE, "kyc_logged")
        .when(kind == NEW_PARTY, "new_party_created")
        .when(kind == STATUS_CHANGE, F.concat(F.lit("status_changed_"), shown(F.col("old_status")), F.lit("_to_"), F.col("new_status")))
        .when(kind == ENTITY_MERGE, F.concat(F.lit("merged_"), F.col("secondary_id"), F.lit("_into_"), F.col("primary_id")))
    )
    good = F.col("status") == "success"
    target = F.when(kind == NEW_PARTY, F.col("created_id")).when(kind == ENTITY_MERGE, F.col("primary_id")).otherwise(F.col("golden_id"))
    return verdicts.filter("status <> 'error'").join(old, "seq", "left").select(
        "seq", F.coalesce("event_id", F.lit("N/A")).alias("event_id"), "event_type", "status",
        "reason", F.when(good, target).alias("golden_id"), F.when(good, action).alias("action"),
        moment(as_of).alias("processed_at"),
    )


def confirmation_messages(confirmations: DataFrame) -> DataFrame:
    """Confirmations as keyed JSON messages for a sink topic."""
    result = F.struct("status", "reason", "golden_id", "action").alias("result")
    body = F.struct("event_id", "event_type", result, F.date_format("processed_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("processed_at"))
    return confirmations.select(F.col("event_id").alias("key"), F.to_json(body).alias("value"))


def run_stats(confirmations: DataFrame, errors: DataFrame) -> DataFrame:
    """Processed, skipped and failed counts, then processed per event type."""
    counted = confirmations.groupBy("status", "event_type").agg(F.count(F.lit(1)).alias("n"))
    totals = counted.groupBy(F.when(F.col("status") == "success", "processed").otherwise("skipped").alias("measure")).agg(F.sum("n").alias("count"))
    failed = errors.agg(F.count(F.lit(1)).alias("count")).select(F.lit("errors").alias("measure"), "count")
    by_type = counted.filter("status = 'success'").select(F.col("event_type").alias("measure"), F.col("n").alias("count"))
    return totals.unionByName(failed).unionByName(by_type)


def apply_events(state: State, events: DataFrame, cfg: MasteringConfig | None = None, scratch: Scratch | None = None,
                 as_of: str | None = None, stored: bool = False) -> Applied:
    """Applies decoded events (:func:`decode`) to the tables.

    New parties come first; an id counts as existing only for events after the
    one that created it. ``stored`` says that the events are a written table,
    which need not be written once more.
    """
    cfg = cfg or MasteringConfig()
    scratch = scratch or Scratch(events.sparkSession, "events")
    events = events if stored else scratch.save(events, "events")  # read many times from here on, parsed once
    readable = events.filter("problem IS NULL")
    asked = scratch.save(_new_parties(readable, state.sources), "new_party_events")
    ids = state.sources.select("id") if state.source_ids is None else state.source_ids
    parties = scratch.save(dense_ids(_party_row(asked.filter("accepted")), ["seq"], ids, scratch, "numbered"), "new_parties")
    known = scratch.save(_known(state.golden, readable, parties), "known")
    created = asked.select("seq", "accepted", uuid_of(natural_key()).alias("created_id"))
    verdicts = scratch.save(_verdicts(readable, known, created), "verdicts")
    done = verdicts.filter("status = 'success'")
    addresses = scratch.save(_address_changes(done), "addresses")
    statuses = scratch.save(_status_changes(done, known), "statuses")

    stamp = moment(as_of)
    new_golden = parties.withColumns({"confidence_score": F.lit(1.0), "created_at": stamp, "updated_at": stamp}).select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in GOLDEN_PARTIES]
    )
    final = addresses.groupBy("golden_id").agg(F.max_by("address", "seq").alias("final_address")).join(
        statuses.groupBy("golden_id").agg(F.max_by("new_status", "seq").alias("final_status")), "golden_id", "full_outer"
    )
    touched = state.golden.select(*GOLDEN_PARTIES.names).join(final.select("golden_id"), "golden_id", "left_semi").unionByName(new_golden)
    changed = touched.join(final, "golden_id", "left")
    moved = F.col("final_address").isNotNull()
    golden = changed.select(*[
        (
            F.when(moved, F.col(f"final_address.{c}")).otherwise(F.col(c)) if c in ADDRESS_COLUMNS
            else F.coalesce("final_status", c) if c == "entity_status"
            else F.when(moved | F.col("final_status").isNotNull(), stamp).otherwise(F.col(c)) if c == "updated_at"
            else F.col(c)
        ).alias(c)
        for c in GOLDEN_PARTIES.names
    ])
    new_links = parties.select(
        "golden_id", F.col("id").alias("source_party_id"), F.lit(True).alias("is_survivor"),
        F.lit(1).cast("decimal(5,4)").alias("match_score"), stamp.alias("linked_at"),
    )
    current = state.links.select(*PARTY_CLUSTERS.names).unionByName(new_links)
    shifted = scratch.save(_moved_links(done, known, current, scratch), "moved_links")
    placed = shifted.drop("left_id")
    links = placed.unionByName(new_links.join(shifted.select("source_party_id"), "source_party_id", "left_anti").select(*placed.columns))
    sources = parties.withColumns({"ingested_at": stamp, "updated_at": stamp}).select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in SOURCE_PARTIES]
    )
    errors = events.filter("problem IS NOT NULL").select("seq", "event_id", "event_type", F.col("problem").alias("reason"), "value").unionByName(
        verdicts.filter("status = 'error'").select("seq", "event_id", "event_type", "reason", "value")
    )
    return Applied(
        golden=golden,
        links=links,
        left_links=shifted.select(F.col("left_id").alias("golden_id"), "source_party_id"),
        sources=sources,
        lineage=_fresh_lineage(_lineage(done, addresses, statuses, cfg, as_of), state.lineage, done),
        confirmations=_confirmations(verdicts, statuses, as_of),
        errors=errors,
    )


def merge_changes(base: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Table after a batch: changed rows replace theirs, new rows join."""
    return base.join(changes.select(key), key, "left_anti").select(*base.columns).unionByName(changes.select(*base.columns))
