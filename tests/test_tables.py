import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldweave.functions.text import strip, usable
from goldweave.operators.mastering import master_parties, moment
from goldweave.operators.quality import ExpectationSuite, run_quality, suite_summary
from goldweave.operators.upsert import upsert_sources
from goldweave.plans import serving, stats
from goldweave.plans.search_index import NameIndex, search_indexed
from goldweave.schemas import GOLDEN_PARTIES, PARTY_CLUSTERS, PARTY_LINEAGE, SOURCE_PARTIES
from goldweave.session import Scratch
from goldweave.sources import export, feeds, files
from goldweave.sources.tables import SPAN, KeyedTable
from goldweave.streaming.stream import PartyStore
from tests.build import CRM, DNB, MKT, frame, party


def test_strip_and_usable(spark):
    df = spark.createDataFrame([("\t a\n ",), ("nan",), ("　",), (None,)], "x string")
    assert [tuple(r) for r in df.select(strip("x"), usable("x")).collect()] == [("a", "a"), ("nan", None), ("", None), (None, None)]


@pytest.fixture()
def feed_file(spark, tmp_path):
    path = tmp_path / "individuals.csv"
    path.write_text(
        "source_party_id,party_type,full_name,first_name,last_name,date_of_birth,tax_id,address_line1,address_line2,city,state,postal_code,email,phone,kyc_status\n"
        'C1,INDIVIDUAL," Ann ""A"" Lee\t",Ann,Lee,1980-02-30,1-2,"1 Oak, St",,Rye,NY,10001,, 5 ,OK\n'
        "C2,INDIVIDUAL,Bob,Bob,B,1981-03-04,,2 Elm,Apt 1,Troy,NY,10002,b@x,,\n"
        "C1,INDIVIDUAL,Ann L,Ann,L,1980-02-03,9-9,new,,Moved,NJ,1,,,\n"
    )
    return str(path)


def test_feed_scan_normalize_and_rejects(spark, feed_file, tmp_path):
    assert feeds.read_feed(spark, str(tmp_path / "none.csv")) is None
    rows = feeds.read_feed(spark, feed_file)
    out = {r["tax_id"]: r for r in feeds.normalize_crm(rows).collect()}
    ann = out["1-2"]
    assert ann["full_name"] == 'Ann "A" Lee' and ann["address_line2"] is None and ann["email"] is None and ann["phone"] == "5"
    assert ann["country"] == "USA" and ann["entity_status"] == "ACTIVE" and ann["date_of_birth"] is None and ann["address_line1"] == "1 Oak, St"
    assert json.loads(ann["raw_payload"])["kyc_status"] == "OK"
    assert out[""]["full_name"] == "Bob"
    assert {r["reason"]: r["rows"] for r in feeds.feed_rejects(rows, feeds.normalize_crm(rows)).collect()} == {"date_of_birth_unreadable": 1}
    landed = feeds.land_raw(spark, feed_file, str(tmp_path / "raw"), CRM)
    assert spark.read.text(landed).count() == 4


def test_upsert_applies_batch_in_order(spark, feed_file):
    empty = spark.createDataFrame([], SOURCE_PARTIES)
    batch = feeds.normalize_crm(feeds.read_feed(spark, feed_file))
    first = Scratch(spark, "u").save(upsert_sources(empty, batch, feeds.LINE_ORDER, moment("2025-01-01")), "v1")
    rows = {r["source_party_id"]: r for r in first.collect()}
    assert {k: r["id"] for k, r in rows.items()} == {"C1": 1, "C2": 2}
    assert rows["C1"]["full_name"] == "Ann L" and rows["C1"]["city"] == "Rye" and rows["C1"]["tax_id"] == "9-9"
    more = batch.withColumn("source_party_id", F.when(F.col("full_name") == "Bob", "C9").otherwise(F.col("source_party_id")))
    second = {r["source_party_id"]: r for r in upsert_sources(first, more, feeds.LINE_ORDER, moment("2025-01-05")).collect()}
    assert second["C9"]["id"] == 3 and str(second["C1"]["ingested_at"])[:10] == "2025-01-01" and str(second["C1"]["updated_at"])[:10] == "2025-01-05"


def test_expectations(spark):
    df = spark.createDataFrame([("a", "1"), ("", "x"), (None, "3"), ("a", None)], "c string, n string")
    suite = ExpectationSuite("s", df)
    suite.expect_column_values_to_not_be_null("c", mostly=0.75).expect_column_values_to_be_between("n", 0, 2)
    suite.expect_column_values_to_be_unique("c").expect_column_values_to_be_in_set("gone", ["x"]).expect_column_values_to_not_be_null("gone")
    rows = {r["expectation"]: r for r in suite.results().collect()}
    assert (rows["expect_c_not_null"]["passed"], rows["expect_c_not_null"]["success"]) == (3, True)
    assert (rows["expect_n_between_0_2"]["total"], rows["expect_n_between_0_2"]["pass_rate"]) == (2, 0.5)
    assert (rows["expect_c_unique"]["unique"], rows["expect_c_unique"]["duplicates"]) == (2, 1)
    assert not rows["column_missing_gone"]["success"]
    assert suite_summary(suite.results()).first()["failed_checks"] == 4
    loose = ExpectationSuite("s", df, strict=False)
    loose.expect_column_values_to_be_in_set("gone", ["x"]).expect_column_values_to_not_be_null("gone").expect_column_values_to_not_be_null("c")
    assert {r["expectation"]: r["success"] for r in loose.results().collect()} == {"expect_gone_not_null": True, "expect_c_not_null": False}
    none = ExpectationSuite("s", df.limit(0))
    none.expect_column_values_to_not_be_null("c").expect_column_values_to_be_unique("c")
    assert all(r["success"] for r in none.results().collect())


@pytest.fixture(scope="module")
def mastered(spark):
    rows = [party(1, CRM, tax_id="A", full_name="Ann"), party(2, DNB, tax_id="A", full_name="ANN LLC"), party(3, MKT, tax_id="B", lei="L"),
            party(4, CRM, full_name=None), party(5, MKT, tax_id="C"), party(6, MKT, tax_id="C", party_type=None)]
    parties = frame(spark, rows)
    return parties, master_parties(parties, as_of="2025-01-01")


def test_quality_run(spark, mastered):
    parties, m = mastered
    run = run_quality(parties, m.golden, m.links, "r1", "2025-01-02")
    rows = {r["expectation_suite"]: r for r in run.results.collect()}
    assert rows["source_parties_suite"]["pass_rate"] > 1 >= rows["source_parties_suite"]["record_check_rate"]
    details = json.loads(rows["source_parties_suite"]["details"])
    assert len(details) == 10 and details[0]["expectation"] == "expect_party_type_in_set"
    report = {r["suite"]: r for r in run.report.collect()}
    assert report["cluster_integrity_suite"]["failed_checks"] == "each_cluster_has_one_survivor" and report["OVERALL"]["status"] == "FAILED"


def test_export_files_and_preview(spark, mastered, tmp_path):
    parties, m = mastered
    rows = export.golden_export(m.golden, m.links, parties, "2025-01-02T00:00:00")
    export.write_export(rows, str(tmp_path / "golden"))
    root = f"{tmp_path}/golden/golden_records"
    assert spark.read.parquet(f"{root}/multi_source").select("contributing_sources", "source_record_count").orderBy("contributing_sources").collect() == [
        ("dnb_feed,internal_crm", 2), ("markit_feed", 2)]
    assert spark.read.parquet(f"{root}/by_type").count() == m.golden.filter("party_type IS NOT NULL").count()
    assert export.export_summary(rows).first()["total"] == 4
    listing = files.zone_files(spark, str(tmp_path))
    totals = {r["zone"]: r["file_count"] for r in files.zone_totals(listing).collect()}
    assert totals["golden"] == totals["TOTAL"] == listing.count() > 2
    (tmp_path / "x.csv").write_text("a,b\n1,\n2,z")
    seen = files.preview(spark, str(tmp_path / "x.csv"))
    assert seen.format == "csv" and seen.total_rows.first()[0] == 2 and seen.rows.first()["b"] == ""
    assert files.preview(spark, str(tmp_path / "x.txt")).format == "unsupported"
    fresh = stats.freshness("2025-01-03 00:00:00", parties, m.golden, run_quality(parties, m.golden, m.links, "r", "2025-01-02 12:00:00").results, listing, listing)
    steps = {r["step"]: r for r in fresh.collect()}
    assert steps["master"]["age_hours"] == 48.0 and steps["master"]["is_stale"] and not steps["quality"]["is_stale"] and steps["export_s3"]["status"] == "success"
    assert steps["generate_data"]["status"] == "not_run"


def test_search_and_lookup(spark, mastered):
    parties, m = mastered
    found = serving.search_parties(m.golden, name="an_", limit=1)
    assert found.total.first()["total"] == 1 and found.page.count() == 1
    assert serving.search_parties(m.golden, name="a%l").total.first()["total"] == 1
    names = [r["full_name"] for r in serving.search_parties(m.golden).page.collect()]
    assert names[-1] is None and names[:-1] == sorted(names[:-1])
    with pytest.raises(ValueError):
        serving.search_parties(m.golden, limit=101)
    gid = serving.search_parties(m.golden, tax_id="A").page.first()["golden_id"]
    assert [r["id"] for r in serving.party_sources(m.links, parties, gid).collect()] == [2, 1]
    assert serving.party(m.golden, gid).first()["created_at"].startswith("2025-01-01T")
    assert serving.party(m.golden, "none").count() == serving.party_lineage(m.golden, m.lineage, "none").count() == 0


def _keyed(spark, root, buckets=8):
    return KeyedTable(spark, str(root), T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.LongType())]), ("k",), buckets=buckets)


def _state(df):
    return {r["k"]: r["v"] for r in df.collect()}


def test_keyed_table_is_the_last_word_on_each_key(spark, tmp_path):
    table, rng, expected, past = _keyed(spark, tmp_path), random.Random(3), {f"k{i}": -1 for i in range(30)}, []
    frame = lambda rows: spark.createDataFrame(list(rows.items()), table.schema)
    table.write(frame(expected), 0, 0)
    for batch in range(10):
        past.append(dict(expected))
        changed = {f"k{rng.randint(0, 40)}": batch for _ in range(4)}
        gone = {f"k{rng.randint(0, 40)}" for _ in range(2)} - set(changed)
        table.change(frame(changed), batch, spark.createDataFrame([(k,) for k in gone], "k string"))
        table.settle(batch)
        expected = {k: v for k, v in (expected | changed).items() if k not in gone}
        if batch == 5:
            table.write(table.read(), 1, 6)
    assert _state(table.read()) == expected
    assert table.spans() == [(0, 7), (8, 8), (9, 9)] and table.spans(6) == [(6, 6), (7, 7), (8, 8), (9, 9)]
    for before in range(10):
        assert _state(table.read(before)) == past[before]
    wanted = spark.createDataFrame([("k1",), ("k7",), ("nobody",), ("k1",)], "x string")
    assert _state(table.read(keys=wanted)) == {k: v for k, v in expected.items() if k in ("k1", "k7")}
    other = _keyed(spark, tmp_path, buckets=3)  # opened with another number: that of the first write holds
    assert _state(other.read(keys=wanted)) == _state(table.read(keys=wanted)) and other.buckets == 8
    table.write(table.read(), 2, 10)
    table.retire(1)
    assert _state(table.read()) == expected and table.spans() == []
    assert _state(_keyed(spark, tmp_path / "none").read()) == {} and _keyed(spark, tmp_path / "none").read(keys=wanted).count() == 0


def test_files_read_for_one_key_do_not_grow_with_buckets_or_batches(spark, tmp_path):
    one, opened = spark.createDataFrame([("k3",)], "k string"), {}
    for buckets in (4, 32):
        table = _keyed(spark, tmp_path / str(buckets), buckets)
        table.write(spark.range(2000).selectExpr("concat('k', id) AS k", "id AS v"), 0, 0)
        for batch in range(SPAN * 2):
            table.change(spark.createDataFrame([(f"k{batch}", batch), ("k3", batch)], table.schema), batch)
            table.settle(batch)
            if batch in (SPAN - 1, 2 * SPAN - 1):
                df = table.read(keys=one)
                opened[buckets, batch] = _scanned(df)
        assert _state(table.read(keys=one)) == {"k3": 2 * SPAN - 1}
    assert opened[4, SPAN - 1] == opened[32, SPAN - 1] and opened[32, 2 * SPAN - 1] <= opened[32, SPAN - 1] + 1


def _scanned(df, metric="numFiles"):
    """Files that the scans of a frame open, or another metric of theirs."""
    spark, key = df.sparkSession, "spark.sql.adaptive.enabled"
    spark.conf.set(key, "false")
    try:
        execution = df._jdf.queryExecution()
        execution.toRdd().count()
        leaves = execution.executedPlan().collectLeaves()
        scans = [leaf for leaf in (leaves.apply(i) for i in range(leaves.size())) if leaf.nodeName().startswith("Scan parquet")]
        return sum(scan.metrics().apply(metric).value() for scan in scans)
    finally:
        spark.conf.set(key, "true")


def test_a_lookup_reads_a_small_share_of_the_rows(spark, tmp_path):
    n = 20_000
    rows = spark.range(n)
    golden = rows.select(*[(F.sha2(F.col("id").cast("string"), 256) if c.name == "golden_id" else F.concat(F.lit("T"), "id") if c.name == "tax_id" else F.lit(None)).cast(c.dataType).alias(c.name) for c in GOLDEN_PARTIES])
    sources = rows.select(*[(F.col("id") if c.name == "id" else F.lit("s")).cast(c.dataType).alias(c.name) if c.name in ("id", "source_system", "source_party_id") else F.lit(None).cast(c.dataType).alias(c.name) for c in SOURCE_PARTIES])
    gid = F.sha2((F.col("id") % 5000).cast("string"), 256)
    links = rows.select(*[{"golden_id": gid, "source_party_id": F.col("id"), "is_survivor": F.lit(True)}.get(c.name, F.lit(None)).cast(c.dataType).alias(c.name) for c in PARTY_CLUSTERS])
    lineage = rows.select(*[{"golden_id": gid, "event_type": F.lit("CREATED")}.get(c.name, F.lit(None)).cast(c.dataType).alias(c.name) for c in PARTY_LINEAGE])
    store = PartyStore(spark, str(tmp_path), buckets=16)
    store.start(golden, links, sources, lineage)
    wanted = golden.filter("tax_id = 'T77'").first()["golden_id"]
    now = store.state_of(wanted)
    for df, rows_found, most in ((now.golden, 1, n / 8), (now.links, 4, n / 8), (now.sources, 4, n * 5 / 16), (now.lineage, 4, n)):
        assert df.count() == rows_found
        assert _scanned(df, "numOutputRows") <= most
    by_tax = store.golden.read().filter("tax_id = 'T77'")
    assert by_tax.count() == 1 and _scanned(by_tax, "numOutputRows") <= n / 8
    assert _scanned(store.golden.read(), "numOutputRows") == n


def test_search_by_trigrams_equals_a_scan(spark, tmp_path):
    rng = random.Random(8)
    names = ["".join(rng.choice("abÄ _") for _ in range(rng.randint(0, 9))) for _ in range(300)] + [None, "", "AB", "abab abab"]
    golden = spark.createDataFrame([(f"g{i}", n, None, None, None, None, None) for i, n in enumerate(names)],
                                   "golden_id string, full_name string, tax_id string, lei string, state string, party_type string, entity_status string")
    index = NameIndex(spark, str(tmp_path / "grams")).build(golden)
    for name in ("aba", "ABÄ", "ab", "a%bab", "ba_ab", "abä b", "_", "zzz", "bab%aba"):
        found, scanned = search_indexed(golden, index, 100, 0, name=name), serving.search_parties(golden, 100, 0, name=name)
        assert found.page.collect() == scanned.page.collect() and found.total.first() == scanned.total.first(), name
    assert index.candidates("ab") is None and index.candidates("aba").count() < 100


def test_checks_while_writing_equal_those_of_a_scan(spark, tmp_path):
    df = spark.createDataFrame([("a", "1"), ("", "x"), (None, "3"), ("a", None)], "c string, n string")

    def suite(rows):
        out = ExpectationSuite("s", rows)
        out.expect_column_values_to_not_be_null("c", mostly=0.75).expect_column_values_to_be_between("n", 0, 2)
        return out.expect_column_values_to_be_unique("c").expect_column_values_to_not_be_null("gone")

    for rows in (df, df.limit(0)):
        stored, results = suite(rows).while_writing(lambda r: _kept(spark, r, tmp_path))
        assert sorted(map(str, results.collect())) == sorted(map(str, suite(rows).results().collect())) and stored.count() == rows.count()
    rates = ExpectationSuite("s", df).expect_column_values_to_not_be_null("c")
    _, results = rates.while_writing(lambda r: _kept(spark, r, tmp_path))
    assert "parquet" not in results._jdf.queryExecution().optimizedPlan().toString()  # nothing is read again


def _kept(spark, rows, tmp_path):
    path = str(tmp_path / f"kept{random.random()}")
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)
