import json
import random

from pyspark.sql import functions as F

from goldweave.config import MasteringConfig
from goldweave.operators.mastering import master_parties
from goldweave.operators.ordered import next_order, previous_value
from goldweave.session import Scratch
from goldweave.streaming import events, stream
from tests.build import CRM, DNB, frame, party

AS_OF = "2025-02-01 00:00:00"


def test_look_back_and_ahead_across_chunks(spark):
    rng = random.Random(4)
    rows = [(rng.choice("aaab"), i, f"v{i}", rng.random() < 0.2) for i in range(200) if rng.random() < 0.6]
    df = spark.createDataFrame(rows, "k string, n bigint, v string, f boolean")
    both = next_order(previous_value(df, "k", "n", "v", "before", chunk=7), "k", "n", F.col("f"), "after", chunk=7)
    for r in both.collect():
        mine = [x for x in rows if x[0] == r["k"]]
        assert r["before"] == max([(x[1], x[2]) for x in mine if x[1] < r["n"]], default=(0, None))[1]
        assert r["after"] == min([x[1] for x in mine if x[1] > r["n"] and x[3]], default=None)


def _one_by_one(golden, links, messages):
    """The events applied in order to plain dicts; results per message."""
    results, sources = [], set()
    for seq, text in messages:
        try:
            e = json.loads(text)
            assert isinstance(e, dict)
        except (ValueError, AssertionError):
            results.append((seq, "error"))
            continue
        kind, gid, p = e.get("event_type", "UNKNOWN"), e.get("golden_id"), e.get("payload", {})
        if kind in ("ADDRESS_CHANGE", "KYC_STATUS_UPDATE"):
            ok = bool(gid) and gid in golden
            if ok and kind == "ADDRESS_CHANGE":
                golden[gid].update({c: p.get(c) for c in ("address_line1", "address_line2", "city", "state", "postal_code")}, country=p.get("country", "USA"))
            results.append((seq, "success" if ok else "skipped"))
        elif kind == "STATUS_CHANGE":
            ok = bool(gid) and bool(p.get("entity_status")) and gid in golden
            results.append((seq, f"status_changed_{golden[gid]['entity_status']}_to_{p['entity_status']}" if ok else "skipped"))
            if ok:
                golden[gid]["entity_status"] = p["entity_status"]
        elif kind == "ENTITY_MERGE":
            a, b = p.get("primary_golden_id"), p.get("secondary_golden_id")
            if not a or not b or a == b:
                results.append((seq, "skipped"))
            elif a not in golden:
                results.append((seq, "error"))
            else:
                if b in golden:
                    golden[b]["entity_status"] = "MERGED"
                for link in links.values():
                    if link[0] == b:
                        link[:] = [a, False]
                results.append((seq, "success"))
        elif kind == "NEW_PARTY":
            key = e["event_id"]
            if key in sources:
                results.append((seq, "skipped"))
            else:
                sources.add(key)
                new = e["_id"]
                golden[new] = {c: p.get(c) for c in ("address_line1", "address_line2", "city", "state", "postal_code")}
                golden[new].update(country=p.get("country", "USA"), entity_status=p.get("entity_status", "ACTIVE"))
                links[f"STREAM-{key}"] = [new, True]
                results.append((seq, "success"))
        else:
            results.append((seq, "skipped"))
    return results


def _mastered(spark):
    rows = [party(i, [CRM, DNB][i % 2], tax_id=f"T{i // 2}") for i in range(2, 14)]
    parties = frame(spark, rows)
    return parties, master_parties(parties, as_of="2025-01-01", scratch=Scratch(spark, "t"))


def _random_messages(spark, ids, seed, n=120):
    rng = random.Random(seed)
    new = {f"N{i}": spark.range(1).select(events.uuid_of(F.lit(f"{CRM}|STREAM-N{i}"))).first()[0] for i in range(4)}
    pool = ids + list(new.values()) + ["nobody", "", None]
    weighted = lambda: ids[0] if rng.random() < 0.35 else rng.choice(pool)
    out = []
    for seq in range(1, n + 1):
        kind = rng.choice(["ADDRESS_CHANGE", "STATUS_CHANGE", "ENTITY_MERGE", "ENTITY_MERGE", "NEW_PARTY", "KYC_STATUS_UPDATE", "ODD"])
        e = {"seq": seq, "event_id": f"E{seq}", "event_type": kind, "golden_id": weighted(), "source_system": CRM}
        if kind == "ADDRESS_CHANGE":
            e["payload"] = {"city": f"c{seq}", **({"country": rng.choice([None, "CAN"])} if rng.random() < 0.5 else {})}
        elif kind == "STATUS_CHANGE":
            e["payload"] = {"entity_status": rng.choice(["ACTIVE", "INACTIVE", "", None])}
        elif kind == "ENTITY_MERGE":
            e["payload"] = {"primary_golden_id": weighted(), "secondary_golden_id": weighted()}
        elif kind == "NEW_PARTY":
            key = rng.choice(list(new))
            e.update(event_id=key, _id=new[key], payload={"full_name": f"n{seq}", "city": "born"})
        out.append((seq, json.dumps(e)))
    return out + [(n + 1, "{broken"), (n + 2, "[1]"), (n + 3, "{}")]


def _check(parties, mastered, golden_df, links_df, sources_df, confirmations, errors, messages):
    golden = {r["golden_id"]: r.asDict() for r in mastered.golden.collect()}
    by_id = {r["id"]: r["source_party_id"] for r in parties.collect()}
    links = {by_id[r["source_party_id"]]: [r["golden_id"], r["is_survivor"]] for r in mastered.links.collect()}
    results = _one_by_one(golden, links, messages)
    got = {r["golden_id"]: r for r in golden_df.collect()}
    assert set(got) == set(golden)
    for gid, row in golden.items():
        for c in ("address_line1", "address_line2", "city", "state", "postal_code", "country", "entity_status"):
            assert got[gid][c] == row[c], (gid, c)
    names = {r["id"]: r["source_party_id"] for r in sources_df.collect()}
    assert {names[r["source_party_id"]]: [r["golden_id"], r["is_survivor"]] for r in links_df.collect()} == links
    said = {r["seq"]: r for r in confirmations.collect()}
    failed = {r["seq"] for r in errors.collect()}
    for seq, result in results:
        if result == "error":
            assert seq not in said
        elif result.startswith("status_changed"):
            assert said[seq]["action"] == result
        else:
            assert said[seq]["status"] == result, said[seq]
    return results, failed


def test_batch_equals_one_by_one_and_stream_equals_batch(spark):
    parties, mastered = _mastered(spark)
    ids = sorted(r["golden_id"] for r in mastered.golden.collect())
    messages = _random_messages(spark, ids, 11)
    raw = spark.createDataFrame(messages, "seq bigint, value string")
    state = events.State(mastered.golden, mastered.links, parties, mastered.lineage)
    done = events.apply_events(state, events.decode(raw), as_of=AS_OF)
    results, failed = _check(
        parties, mastered, events.merge_changes(mastered.golden, done.golden, "golden_id"),
        events.merge_changes(mastered.links, done.links, "source_party_id"), parties.unionByName(done.sources), done.confirmations, done.errors, messages)
    assert failed == {s for s, r in results if r == "error"}

    out = Scratch(spark, "streamtest")
    store = stream.PartyStore(spark, out.path("store"), buckets=2)
    store.start(mastered.golden, mastered.links, parties, mastered.lineage)
    confirmed = []
    write = stream.batch_writer(store, stream.field_order(), MasteringConfig(), AS_OF, lambda df, n: confirmed.append(df.count()))
    for part in (messages[:60], messages[60:]):
        spark.createDataFrame(part, "seq bigint, value string").select("value").coalesce(1).write.mode("append").text(out.path("inbox"))
        with stream.progress_log(spark, out.path("progress")):
            stream.start_stream(stream.read_messages(spark, "text", out.path("inbox")), write, out.path("checkpoint")).awaitTermination()
    # The line without an order is an error here, and '{}' has none either.
    _check(parties, mastered, store.golden.read(), store.links.read(), store.sources.read(), store.confirmations.read(), store.errors.read(),
           [m for m in messages if m[1] != "{}"])
    assert sum(confirmed) == store.confirmations.read().count()
    assert {r["status"] for r in stream.stream_progress(spark, out.path("progress")).collect()} == {"up_to_date"}

    assert stream.refresh_export(store, out.path("zone"), AS_OF) and not stream.refresh_export(store, out.path("zone"), AS_OF, since=99)
    assert spark.read.parquet(f"{out.path('zone')}/golden_records/full").count() == store.golden.read().count()

    before = {n: t.read().count() for n, t in (("lineage", store.lineage), ("golden", store.golden), ("confirmations", store.confirmations))}
    again = spark.createDataFrame(messages[60:], "seq bigint, value string").select("value")
    write(again, 1)
    assert before == {n: t.read().count() for n, t in (("lineage", store.lineage), ("golden", store.golden), ("confirmations", store.confirmations))}
    logged = store.lineage.read().count()
    write(again.filter("value LIKE '%KYC_STATUS_UPDATE%'"), 2)
    assert store.lineage.read().count() == logged
    rows = sorted(map(str, store.golden.read().collect()))
    store.compact(3)
    assert rows == sorted(map(str, store.golden.read().collect()))


def test_chained_merges_follow_event_order(spark):
    rows = [(1, "b", "a"), (2, "c", "b"), (3, "e", "f"), (4, "d", "e"), (5, "f", "d"), (6, "a", "x")]
    merges = spark.createDataFrame(rows, "seq bigint, primary_id string, secondary_id string")
    ends = {r["seq"]: r["destination"] for r in events.link_destinations(merges, Scratch(spark, "m")).collect()}
    assert ends == {1: "c", 2: "c", 3: "f", 4: "f", 5: "f", 6: "a"}


def test_confirmation_message(spark):
    parties, mastered = _mastered(spark)
    raw = spark.createDataFrame([(1, json.dumps({"event_id": "E", "event_type": "ODD"}))], "seq bigint, value string")
    done = events.apply_events(events.State(mastered.golden, mastered.links, parties, mastered.lineage), events.decode(raw), as_of=AS_OF)
    row = events.confirmation_messages(done.confirmations).first()
    body = json.loads(row["value"])
    assert row["key"] == "E" and body["result"] == {"status": "skipped", "reason": "unknown event type: ODD"} and body["processed_at"].startswith("2025-02-01T")


def test_a_bounded_run_stops_between_batches_and_the_next_goes_on(spark):
    parties, mastered = _mastered(spark)
    out = Scratch(spark, "bounded")
    store = stream.PartyStore(spark, out.path("store"), buckets=2)
    store.start(mastered.golden, mastered.links, parties, mastered.lineage)
    gid = mastered.golden.first()["golden_id"]
    for part in range(3):
        lines = [(json.dumps({"seq": 10 * part + i, "event_id": f"E{part}{i}", "event_type": "KYC_STATUS_UPDATE", "golden_id": gid if i else None, "payload": {}}),) for i in range(3)]
        spark.createDataFrame(lines, "value string").coalesce(1).write.mode("append").text(out.path("inbox"))
    write = stream.batch_writer(store, stream.field_order(), MasteringConfig(), AS_OF)
    rows = lambda: stream.read_messages(spark, "text", out.path("inbox"), maxFilesPerTrigger="1")
    assert stream.run_bounded(store, rows(), write, out.path("checkpoint"), successes=3, idle=2, poll_seconds=0.5) == 4
    assert store.complete() == 2
    assert stream.run_bounded(store, rows(), write, out.path("checkpoint"), successes=50, idle=2, poll_seconds=0.5) == 2
    assert store.complete() == 3 and store.lineage.read().filter("event_id IS NOT NULL").count() == 6


def test_progress_of_topic_partitions(spark, tmp_path):
    report = {"batchId": 4, "sources": [{"description": "Kafka", "endOffset": {"t": {"0": 5, "1": 7}}, "latestOffset": {"t": {"0": 5, "1": 9}}, "numInputRows": 3}]}
    (tmp_path / "a.json").write_text(json.dumps(report) + "\n")
    rows = {r["part"]: (r["end_offset"], r["latest_offset"], r["lag"], r["status"]) for r in stream.stream_progress(spark, str(tmp_path)).collect()}
    assert rows == {"t-0": (5, 5, 0, "up_to_date"), "t-1": (7, 9, 2, "lagging")}


def test_rows_without_a_key_are_looked_up_in_many_tasks(spark):
    from goldweave.operators.ordered import left_join_spread

    rows = spark.range(4000).select(F.col("id").alias("seq"), F.when(F.col("id") % 10 == 0, F.col("id") % 30).alias("ref"))
    found = spark.createDataFrame([(0, "a"), (20, "b"), (20, "c"), (None, "none")], "ref long, g string")
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        joined = left_join_spread(rows, found, "ref", "seq")
        expected = rows.join(found, "ref", "left")
        assert sorted(map(repr, joined.select("seq", "ref", "g").collect())) == sorted(map(repr, expected.select("seq", "ref", "g").collect()))
        per_task = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert len(per_task) == 4 and max(per_task) < 2000
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_a_batch_is_decoded_and_written_once(spark, tmp_path, monkeypatch):
    rows = frame(spark, [party(1, full_name="A One"), party(2, full_name="B Two")])
    known = master_parties(rows, MasteringConfig(), Scratch(spark, "once"), AS_OF)
    store = stream.PartyStore(spark, str(tmp_path / "store"), buckets=2)
    store.start(known.golden, known.links, rows, known.lineage)
    written, save = [], Scratch.save
    monkeypatch.setattr(Scratch, "save", lambda self, df, name: written.append((name, self.codec)) or save(self, df, name))
    message = json.dumps({"seq": 1, "event_id": "E1", "event_type": "NEW_PARTY", "payload": {"full_name": "C Three"}})
    stream.batch_writer(store, stream.field_order(), MasteringConfig(), AS_OF)(spark.createDataFrame([(message,)], "value string"), 0)
    assert [n for n, _ in written].count("decoded") == 1 and "events" not in [n for n, _ in written]
    assert {codec for _, codec in written} == {"zstd"}
    assert [(r.event_id, r.status) for r in store.confirmations.read().collect()] == [("E1", "success")] and store.state().sources.count() == 3


def test_source_records_are_made_in_many_tasks(spark, tmp_path):
    from goldweave import fixtures

    for name, key in {**fixtures.KEYS, "events": "event_id"}.items():
        spark.range(1000).withColumnRenamed("id", key).coalesce(1).write.parquet(str(tmp_path / f"{name}.parquet"))
    made = fixtures.source_parties(spark, str(tmp_path))
    sizes = made.groupBy(F.spark_partition_id().alias("part")).count().collect()
    assert sum(r["count"] for r in sizes) == 3000 and len(sizes) >= 3 * spark.sparkContext.defaultParallelism


def test_parts_of_the_messages_are_written_at_once_and_dated_in_order(spark, tmp_path):
    from checks.queries import _parts

    messages = spark.range(5, 305, 1, 8).select(((F.col("id") * 7) % 300 + 5).alias("seq")).withColumn("value", F.col("seq").cast("string"))
    spark.sparkContext.setJobGroup("parts", "parts")
    _parts(messages, 30, str(tmp_path / "inbox"))
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("parts"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    files = sorted((tmp_path / "inbox").glob("part-*"), key=lambda f: f.stat().st_mtime_ns)
    assert [sorted(map(int, f.read_text().split())) for f in files] == [list(range(5 + 10 * k, 15 + 10 * k)) for k in range(30)]
    assert jobs < 10
