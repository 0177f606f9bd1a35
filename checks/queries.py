"""Registered queries: one per operator, each from the given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import data
from goldweave.config import LEI_EXACT, TAX_ID_EXACT, MasteringConfig
from goldweave.operators import incremental, mastering, matching, quality
from goldweave.operators.mastering import master_parties
from goldweave.operators.upsert import append_links, upsert_golden, upsert_sources
from goldweave.plans import search_index, serving, stats
from goldweave.plans.pipeline import Warehouse, fold_events, master, upsert_stored
from goldweave.schemas import ADDRESS_COLUMNS, PARTY_COLUMNS
from goldweave.session import Scratch
from goldweave.sources import export, feeds, files
from goldweave.streaming import events, stream

CFG = MasteringConfig()
BINARIZED = MasteringConfig(binarize_threshold=0.0)
ONE_SURVIVOR = MasteringConfig(single_survivor=True)


def plain(df: DataFrame) -> DataFrame:
    """Portable types: whole numbers as bigint, decimals as double, dates and times as text."""
    columns = []
    for name, kind in df.dtypes:
        column = F.col(f"`{name}`")
        if kind in ("date", "timestamp", "timestamp_ntz"):
            column = column.cast("string")
        elif kind in ("int", "smallint", "tinyint") or kind.endswith(",0)"):
            column = column.cast("bigint")
        elif kind.startswith("decimal") or kind == "float":
            column = column.cast("double")
        columns.append(column.alias(name))
    return df.select(*columns)


Query = Callable[[SparkSession, str], DataFrame]


def _feed(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    """Feed rows as text: padded names, blanks for missing values."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    own = {
        "internal_crm": ["first_name", "last_name", "date_of_birth", "email", "phone"],
        "dnb_feed": ["phone"], "markit_feed": ["lei"],
    }[source]
    padded = F.concat(F.lit(" \t"), F.coalesce("full_name", F.lit("")), F.lit("  \t")).alias("full_name")
    shared = ["source_party_id", "party_type", "tax_id", "address_line1", "address_line2", "city", "state", "postal_code", "country", "entity_status"]
    return data.parties(spark, sf_dir).filter(F.col("source_system") == source).select(
        padded, *[blank(c) for c in [*shared, *own]]
    )


def _normalized(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    return plain(feeds.NORMALIZERS[source](_feed(spark, sf_dir, source)).drop("raw_payload"))


def _feed_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes each feed as CSV, reads it back, normalizes it, and reads the kept raw payload."""
    out = data.scratch(spark, "feed")

    def back(source: str) -> DataFrame:
        rows = _feed(spark, sf_dir, source)
        path = out.path(feeds.FEEDS[source][1])
        feeds.write_csv(rows, path, rows.columns)
        return feeds.NORMALIZERS[source](feeds.read_feed(spark, path))

    raw = [F.get_json_object("raw_payload", f"$.{c}").alias(f"raw_{c}") for c in ("full_name", "tax_id", "city")]
    return plain(reduce(DataFrame.unionByName, [
        back(source).select("source_system", "source_party_id", *_PLAIN_FIELDS, *raw) for source in feeds.FEEDS
    ]))


_PLAIN_FIELDS = ["party_type", "full_name", "date_of_birth", "tax_id", "lei", "address_line1", "city", "state", "postal_code", "country", "email", "phone", "entity_status"]
_LANDED = ["source_party_id", "party_type", "tax_id", "address_line1", "address_line2", "city", "state", "postal_code", "country", "entity_status"]


def _landed(spark: SparkSession, sf_dir: str, zone: str) -> list[str]:
    """Lands the three feeds in a zone; the paths of the landed files."""
    out, paths = data.scratch(spark, "landing"), []
    for source, (_, file) in feeds.FEEDS.items():
        rows = _feed(spark, sf_dir, source).select(*_LANDED)
        feeds.write_csv(rows, out.path(file), rows.columns)
        paths.append(feeds.land_raw(spark, out.path(file), zone, source))
    return paths


def _raw_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every landed line, the three headers included."""
    paths = _landed(spark, sf_dir, data.scratch(spark, "zone").path("raw"))
    lines = reduce(DataFrame.unionByName, [spark.read.text(p).select(F.lit(source).alias("source"), F.col("value").alias("line")) for source, p in zip(feeds.FEEDS, paths)])
    header = F.col("line") == ",".join(_LANDED)
    # A CSV written by several tasks has a header in each part.
    return lines.filter(~header).unionByName(lines.filter(header).distinct())


def _feed_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed with some unreadable dates and over-long postal codes."""
    number = F.substring_index("source_party_id", "-", -1).cast("bigint")
    rows = _feed(spark, sf_dir, "internal_crm").withColumns({
        "date_of_birth": F.when(number % 7 == 0, "1950-13-45").otherwise(F.col("date_of_birth")),
        "postal_code": F.when(number % 5 == 0, F.repeat(F.col("postal_code"), 5)).otherwise(F.col("postal_code")),
    })
    return feeds.feed_rejects(rows, feeds.normalize_crm(rows))


def _upsert_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loads a third of the records, then a batch that repeats and revises every second one."""
    rows = data.parties(spark, sf_dir)
    existing = rows.filter("id % 3 = 0")
    first = rows.withColumn("at", F.col("id") * 2).withColumn("full_name", F.concat(F.lit("A "), "full_name"))
    again = rows.filter("id % 2 = 0").withColumn("at", F.col("id") * 2 + 1).withColumns({
        "full_name": F.concat(F.lit("B "), "full_name"), "city": F.lit("Elsewhere"), "entity_status": F.lit("PENDING"),
    })
    batch = first.unionByName(again)
    after = upsert_sources(existing, batch, "at", mastering.moment(data.EVENTS_AS_OF))
    return plain(after.select("id", "source_system", "source_party_id", "full_name", "city", "tax_id", "entity_status", "ingested_at", "updated_at"))


def _upsert_new_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loads records without ids into a table that ends at id 500: new ids follow in batch order."""
    rows = data.parties(spark, sf_dir)
    existing = rows.filter("id <= 500 AND source_system = 'internal_crm'")
    batch = rows.withColumn("at", F.col("id")).drop("id")
    after = upsert_sources(existing, batch, "at", mastering.moment(data.EVENTS_AS_OF), data.scratch(spark, "ids"))
    return plain(after.select("id", "source_system", "source_party_id"))


def _upsert_golden(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = data.tables(spark, sf_dir)
    old = t.golden.filter("party_type <> 'LEGAL_ENTITY'")
    new = t.golden.withColumns({"full_name": F.upper("full_name"), "city": F.lit("Moved"), "entity_status": F.lit("PENDING")})
    after = upsert_golden(old, new.select(*old.columns), mastering.moment(data.EVENTS_AS_OF))
    return plain(after.select("golden_id", "full_name", "city", "entity_status", "created_at", "updated_at"))


def _append_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = data.tables(spark, sf_dir).links
    old = links.filter("source_party_id % 2 = 0")
    new = links.withColumn("golden_id", F.concat(F.lit("new-"), "golden_id"))
    return plain(append_links(old, new).select("golden_id", "source_party_id"))


def _exact(kind: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(matching.exact_links(data.source_table(spark, sf_dir)).filter(F.col("match_type") == kind))


def _fuzzy(cfg: MasteringConfig, spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(matching.fuzzy_matches(data.matches(spark, sf_dir, cfg), cfg))


def _clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = data.matches(spark, sf_dir)
    return mastering.components(data.source_table(spark, sf_dir), mastering.build_clusters(found, data.scratch(spark, "components")))


def _golden_binarized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(data.fresh_mastering(spark, sf_dir, BINARIZED).golden.select("golden_id", "full_name", "city", "confidence_score"))


def _lineage_created(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = data.fresh_mastering(spark, sf_dir).lineage
    part = lambda name: F.get_json_object("changed_fields", f"$.{name}")
    return plain(rows.select(
        "golden_id", "event_type", "triggered_by", "event_at", part("source_count").cast("bigint").alias("source_count"),
        part("sources").alias("sources"), part("source_counts").alias("source_counts"), part("confidence").cast("double").alias("confidence"), part("match_type").alias("match_type"),
    ))


def _stable_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Masters half the records, then all of them with the first run's links: old ids stay."""
    rows = data.source_table(spark, sf_dir)
    half = mastering.master_parties(rows.filter("id % 2 = 1"), CFG, data.scratch(spark, "half"), data.AS_OF)
    held = data.scratch(spark, "held").save(half.links, "links")
    full = mastering.master_parties(rows, CFG, data.scratch(spark, "full"), data.AS_OF, held)
    return full.links.select("source_party_id", "golden_id")


def _master_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Masters half the records, then the others as changes to the tables of the first run."""
    rows = data.source_table(spark, sf_dir)
    half = mastering.master_parties(rows.filter("id % 2 = 1"), CFG, data.scratch(spark, "half"), data.AS_OF)
    out = data.scratch(spark, "changes")
    golden, links = out.save(half.golden, "golden"), out.save(half.links, "links")
    done = incremental.master_changes(rows, golden, links, rows.filter("id % 2 = 0").select("id"), CFG, out, data.AS_OF)
    golden, links = incremental.after_changes(golden, links, rows, done)
    return plain(links.join(golden.select("golden_id", "full_name", "confidence_score"), "golden_id").select(
        "source_party_id", "golden_id", "is_survivor", "match_score", "full_name", "confidence_score"))


# What a check was asked for and its counts; dq_results reads them back from the stored details.
_ARGUMENTS = ["value_set", "min_value", "max_value", "unlinked", "orphans", "survivors", "golden"]


def _dq_while_writing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results of the golden suite, counted by the write that stores the golden records."""
    out = data.scratch(spark, "written")
    suite = quality.golden_suite(data.tables(spark, sf_dir).golden)
    return plain(suite.while_writing(lambda df: out.save(df, "golden"))[1].drop(*_ARGUMENTS))


def _dq(suite: Callable, table: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(suite(getattr(data.tables(spark, sf_dir), table)).results().drop(*_ARGUMENTS))


def _dq_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    suite = quality.ExpectationSuite("filtered", data.parties(spark, sf_dir))
    suite.expect_column_values_to_not_be_null("tax_id", "entity_status = 'ACTIVE'", 0.9)
    suite.expect_column_values_to_not_be_null("lei", "source_system = 'markit_feed'")
    suite.expect_column_values_to_be_between("postal_code", 20000, 90000, 0.5)
    suite.expect_column_values_to_be_unique("postal_code")
    suite.expect_column_values_to_be_in_set("no_such_column", ["x"])
    return plain(suite.results().drop(*_ARGUMENTS))


def _dq_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = data.tables(spark, sf_dir)
    return plain(quality.cluster_suite(quality.cluster_totals(t.parties, t.golden, t.links)).drop(*_ARGUMENTS))


def _search(spark: SparkSession, sf_dir: str, limit: int, offset: int, **conditions: str) -> DataFrame:
    page = serving.search_parties(data.tables(spark, sf_dir).golden, limit, offset, **conditions).page
    return plain(page.select("golden_id", "full_name", "tax_id", "state", "party_type", "entity_status", "confidence_score"))


def _search_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.search_parties(data.tables(spark, sf_dir).golden, name="A", state="s3", status="active").total


def _one_golden_id(spark: SparkSession, sf_dir: str) -> str:
    """Id of the first golden record with most links."""
    counted = data.tables(spark, sf_dir).links.groupBy("golden_id").count()
    return counted.orderBy(F.col("count").desc(), "golden_id").first()["golden_id"]


def _party_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = _one_golden_id(spark, sf_dir)
    found = serving.party(data.store(spark, sf_dir).state_of(wanted, before=0).golden, wanted)
    return plain(found.select("golden_id", *PARTY_COLUMNS, "confidence_score", "created_at"))


def _party_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trail of the first golden record with most events."""
    store = data.store(spark, sf_dir)
    counted = store.lineage.read().groupBy("golden_id").count()
    wanted = counted.orderBy(F.col("count").desc(), "golden_id").first()["golden_id"]
    now = store.state_of(wanted)
    rows = serving.party_lineage(now.golden, now.lineage, wanted)
    return plain(rows.select("golden_id", "event_type", "event_id", "triggered_by", "event_at"))


def _party_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = _one_golden_id(spark, sf_dir)
    then = data.store(spark, sf_dir).state_of(wanted, before=0)
    return plain(serving.party_sources(then.links, then.sources, wanted))


def _search_indexed(spark: SparkSession, sf_dir: str) -> search_index.SearchResult:
    return search_index.search_indexed(data.tables(spark, sf_dir).golden, data.name_index(spark, sf_dir), 20, 0, name="aB1")


def _search_indexed_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(_search_indexed(spark, sf_dir).page.select("golden_id", "full_name", "tax_id", "state", "party_type", "entity_status", "confidence_score"))


def _export(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = data.tables(spark, sf_dir)
    return export.golden_export(t.golden, t.links, t.parties, "2025-01-02T00:00:00")


def _exported(part: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the export and reads one of its sets back."""
    out = data.scratch(spark, "export")
    export.write_export(_export(spark, sf_dir), out.path("golden"))
    back = spark.read.parquet(f"{out.path('golden')}/golden_records/{part}")
    if part == "by_type":
        return back.groupBy("party_type").agg(F.count(F.lit(1)).alias("count"))
    return plain(back.drop("updated_at"))


def _zone_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folders of the listed files of two zones, and whether the totals are the sums of the listing."""
    out = data.scratch(spark, "zones")
    export.write_export(_export(spark, sf_dir), out.path("golden"))
    _landed(spark, sf_dir, out.path("raw"))
    listed = files.zone_files(spark, out.root)
    sums = listed.groupBy("zone").agg(F.count(F.lit(1)).alias("n"), F.sum("size_bytes").alias("bytes"))
    every = sums.unionByName(sums.agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes")).withColumn("zone", F.lit("TOTAL")))
    agrees = files.zone_totals(listed).join(every, "zone").select(
        "zone", F.lit("").alias("folder"), ((F.col("file_count") == F.col("n")) & (F.abs(F.col("total_size_kb") - F.col("bytes") / 1024) < 0.01)).alias("sums_agree"))
    folders = listed.filter("key NOT LIKE '%\\_SUCCESS'").select("zone", F.regexp_extract("key", "^(.*)/[^/]*$", 1).alias("folder")).distinct()
    return folders.withColumn("sums_agree", F.lit(True)).unionByName(agrees)


def _file_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Preview of the first of the files that hold the golden records in order, next to the row count of all of them."""
    out = data.scratch(spark, "preview")
    rows = data.tables(spark, sf_dir).golden.select("golden_id", "full_name", "lei", "date_of_birth")
    rows.orderBy("golden_id").write.parquet(out.path("curated/sample.parquet"))
    listed = files.zone_files(spark, out.root).filter("key LIKE '%part-%.parquet'").orderBy("key").first()
    seen = files.preview(spark, f"{out.root}/{listed['zone']}/{listed['key']}")
    total = files.preview(spark, out.path("curated/sample.parquet")).total_rows.first()[0]
    return seen.rows.withColumn("total_rows", F.lit(total).cast("bigint"))


def _freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All five steps; file times and sizes are set, as those of a run differ."""
    out, t = data.scratch(spark, "fresh"), data.tables(spark, sf_dir)
    _landed(spark, sf_dir, out.path("raw"))
    export.write_export(_export(spark, sf_dir), out.path("golden"))
    files_there = files.zone_files(spark, out.root)
    first = files_there.filter("key LIKE 'golden_records/full/%.parquet'").agg(F.min("key")).first()[0]
    listed = files_there.withColumns({
        "last_modified": F.lit("2025-01-01 12:00:00").cast("timestamp"), "size_bytes": F.when(F.col("key") == first, 2048).otherwise(0).cast("bigint")})
    return plain(stats.freshness("2025-01-02 06:30:00", t.parties, t.golden, data.dq_log(spark, sf_dir), listed, listed))


def _dq_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result rows with the arguments and counts that their details keep for each check."""
    check = "struct<expectation:string,column:string,value_set:array<string>,min_value:double,max_value:double,mostly:double,unlinked:bigint,orphans:bigint,survivors:bigint,golden:bigint>"
    rows = data.quality(spark, sf_dir).results
    return plain(rows.select("*", F.explode(F.from_json("details", f"array<{check}>")).alias("c")).select(
        *[c for c in rows.columns if c != "details"], "c.expectation", "c.column", F.array_join("c.value_set", ",").alias("value_set"),
        "c.min_value", "c.max_value", "c.mostly", "c.unlinked", "c.orphans", "c.survivors", "c.golden"))


def _stream_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The export written once after the run."""
    out = _streamed(spark, sf_dir)[2]
    back = spark.read.parquet(f"{out.path('golden')}/golden_records/full")
    return plain(back.select("golden_id", "address_line1", "city", "state", "entity_status", "source_record_count"))


def _confirmation_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages as the sink wrote them: keys and parts of their JSON."""
    out = _streamed(spark, sf_dir)[2]
    rows = spark.read.option("recursiveFileLookup", True).text(out.path("confirmed")).select(
        F.substring_index("value", "\t", 1).alias("key"), F.expr("substring(value, instr(value, '\t') + 1)").alias("value"))
    part = lambda path: F.get_json_object("value", f"$.{path}")
    return rows.select("key", part("event_id").alias("event_id"), part("event_type").alias("event_type"), part("result.status").alias("status"),
                       part("result.reason").alias("reason"), part("result.golden_id").alias("golden_id"), part("result.action").alias("action"))


def _charts(column: str, table: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.chart_series(getattr(data.tables(spark, sf_dir), table), column)


def _events(kind: str, fields: dict[str, str], spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineage rows of one kind with parts of their detail."""
    rows = data.applied(spark, sf_dir).lineage.filter(F.col("event_type") == kind)
    parts = [F.get_json_object("changed_fields", f"$.{path}").alias(name) for name, path in fields.items()]
    return plain(rows.select("golden_id", "event_id", "triggered_by", *parts))


def _event_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = events.decode(data.messages(spark, sf_dir))
    known = F.col("event_type").isin(*events.HANDLED)
    return decoded.groupBy(
        "event_type", F.when(known, "handled").otherwise("skipped").alias("route")
    ).agg(F.count(F.lit(1)).alias("count"))


def _event_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = events.decode(data.messages(spark, sf_dir))
    return decoded.select("seq", events.message_key().alias("key"))


def _golden_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    changed = events.merge_changes(data.tables(spark, sf_dir).golden, data.applied(spark, sf_dir).golden, "golden_id")
    return plain(changed.select("golden_id", *ADDRESS_COLUMNS, "entity_status", "updated_at"))


def _links_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = events.merge_changes(data.tables(spark, sf_dir).links, data.applied(spark, sf_dir).links, "source_party_id")
    return plain(links.select("golden_id", "source_party_id", "is_survivor", "match_score"))


def _streamed(spark: SparkSession, sf_dir: str) -> tuple[stream.PartyStore, DataFrame, Scratch]:
    """Store and progress report after streaming all events; run once per session."""
    return data.once(spark, sf_dir, "streamed", lambda: _stream(spark, sf_dir))


def _store(spark: SparkSession, sf_dir: str, out: Scratch) -> stream.PartyStore:
    t = data.tables(spark, sf_dir)
    store = stream.PartyStore(spark, out.path("store"), buckets=8)
    store.start(t.golden, t.links, t.parties, t.lineage)
    return store


def _stream(spark: SparkSession, sf_dir: str) -> tuple[stream.PartyStore, DataFrame, Scratch]:
    """Writes the events as JSON lines in two goes and streams each into the stored tables."""
    out = data.scratch(spark, "stream", "zstd")
    store = _store(spark, sf_dir, out)
    messages = out.save(data.messages(spark, sf_dir), "messages")
    broken = messages.filter("seq % 500 = 3").select("seq", F.expr("substring(value, 1, length(value) - 5)").alias("value"))
    lines = messages.unionByName(broken)
    middle = messages.agg(F.expr("(min(seq) + max(seq)) div 2").alias("m")).first()["m"]
    write = stream.batch_writer(store, stream.field_order(), CFG, data.EVENTS_AS_OF, stream.confirmation_sink("text", out.path("confirmed")))
    for go, part in enumerate((F.col("seq") <= middle, F.col("seq") > middle)):
        lines.filter(part).select("value").write.mode("append").text(out.path("inbox"))
        with stream.progress_log(spark, out.path(f"progress-{go}")):
            stream.start_stream(stream.read_messages(spark, "text", out.path("inbox")), write, out.path("checkpoint")).awaitTermination()
    stream.refresh_export(store, out.path("golden"), data.EVENTS_AS_OF)
    return store, stream.stream_progress(spark, out.path("progress-1")), out


def _parts(messages: DataFrame, parts: int, folder: str) -> None:
    """Messages as one file for each of ``parts`` stretches of their order; the files come into the folder in that order.

    All files are written at once. A stream takes them by age, so each is
    dated behind the one before, or where a store dates files itself, moved
    behind it.
    """
    spark = messages.sparkSession
    low, high = messages.agg(F.min("seq"), F.max("seq")).first()
    cut = F.floor((F.col("seq") - low) * parts / (high - low + 1)).cast("int")
    messages.filter("seq IS NOT NULL").repartitionById(parts, cut).select("value").write.text(f"{folder}.written")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(path(folder))
    files = sorted((s.getPath() for s in fs.globStatus(path(f"{folder}.written/part-*"))), key=lambda p: p.getName())
    newest = max(fs.getFileStatus(p).getModificationTime() for p in files)
    for place, file in enumerate(files):
        fs.setTimes(file, newest - 1000 * (len(files) - place), -1)
        fs.rename(file, path(f"{folder}/{file.getName()}"))


def _stream_progress_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches, rows and last status of a run of 120 batches, more than a query remembers by itself."""
    out = data.scratch(spark, "progress")
    _parts(out.save(data.messages(spark, sf_dir), "messages"), 120, out.path("inbox"))
    messages = stream.read_messages(spark, "text", out.path("inbox"), maxFilesPerTrigger="1")
    with stream.progress_log(spark, out.path("progress")):
        stream.start_stream(messages, lambda batch, number: batch.write.format("noop").mode("overwrite").save(), out.path("checkpoint")).awaitTermination()
    seen = stream.stream_progress(spark, out.path("progress")).filter("input_rows > 0")
    return seen.agg(F.count_distinct("batch_id").alias("batches"), F.sum("input_rows").alias("input_rows"), F.max_by("status", "batch_id").alias("status"))


def _stream_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over four files of events: the first stops at a fifth of the events in successes, the second takes the rest."""
    out = data.scratch(spark, "bounded")
    store = _store(spark, sf_dir, out)
    messages = out.save(data.messages(spark, sf_dir), "messages")
    _parts(messages, 4, out.path("inbox"))
    write = stream.batch_writer(store, stream.field_order(), CFG, data.EVENTS_AS_OF)
    rows = lambda: stream.read_messages(spark, "text", out.path("inbox"), maxFilesPerTrigger="1")
    stream.run_bounded(store, rows(), write, out.path("checkpoint"), successes=messages.count() // 5, idle=2, poll_seconds=1)
    after = store.complete()
    stream.run_bounded(store, rows(), write, out.path("checkpoint"), successes=None, idle=2, poll_seconds=1)
    done = [store.confirmations.batch(n).select("status", F.lit(n).alias("batch")).unionByName(store.errors.batch(n).select(F.lit("error").alias("status"), F.lit(n).alias("batch")))
            for n in range(store.complete())]
    return reduce(DataFrame.unionByName, done).groupBy(F.when(F.col("batch") < after, 1).otherwise(2).alias("run")).agg(
        F.count_distinct("batch").alias("batches"), F.count(F.lit(1)).alias("events"), F.count_if(F.col("status") == "success").alias("successes"))


def _stream_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source records, and whether they are linked, after events, an ingest, events, a mastering, events and a fold."""
    out = data.scratch(spark, "fold", "zstd")
    store = Warehouse(spark, out.path("warehouse"), buckets=8)
    rows = data.source_table(spark, sf_dir)
    first = rows.filter("id % 3 <> 0")
    known = master_parties(first, CFG, out, data.AS_OF)
    store.tables.start(known.golden, known.links, first, known.lineage)
    messages = out.save(data.messages(spark, sf_dir), "messages")
    write = stream.batch_writer(store.tables, stream.field_order(), CFG, data.EVENTS_AS_OF)
    part = lambda k: messages.filter(F.pmod(F.col("seq"), F.lit(3)) == k).select("value")
    write(part(0), 0)
    batch = rows.withColumns({"at": F.col("id"), "full_name": F.concat(F.when(F.col("id") % 2 == 0, "B ").otherwise("A "), "full_name")})
    upsert_stored(store, batch.drop("id"), "at", data.EVENTS_AS_OF)
    write(part(1), 1)
    master(store, CFG, data.EVENTS_AS_OF)
    write(part(2), 2)
    fold_events(store)
    linked = store.links.join(store.golden, "golden_id", "left_semi").select(F.col("source_party_id").alias("id"), F.lit(True).alias("linked")).distinct()
    return plain(store.sources.join(linked, "id", "left").select(
        "source_system", "source_party_id", "full_name", "city", F.coalesce("linked", F.lit(False)).alias("linked")))


def _stream_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    store, _, _ = _streamed(spark, sf_dir)
    return plain(store.state().golden.select("golden_id", *ADDRESS_COLUMNS, "entity_status", "updated_at"))


def _stream_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    store, _, _ = _streamed(spark, sf_dir)
    return events.run_stats(store.confirmations.read(), store.errors.read())


def _stream_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows read and final status over the last run's batches."""
    _, progress, _ = _streamed(spark, sf_dir)
    return progress.agg(F.sum("input_rows").alias("input_rows"), F.max("lag").alias("lag"), F.max_by("status", "batch_id").alias("status"))


def _of(function: Callable, *names: str) -> Query:
    """Query that passes stored tables to a plan function."""
    return lambda spark, sf_dir: plain(function(*[getattr(data.tables(spark, sf_dir), n) for n in names]))


def registry() -> dict[str, Query]:
    return {
        # sources, normalizers, upserts
        "source_parties": lambda s, d: plain(data.parties(s, d).drop("raw_payload")),
        "normalize_crm": partial(_normalized, source="internal_crm"),
        "normalize_dnb": partial(_normalized, source="dnb_feed"),
        "normalize_markit": partial(_normalized, source="markit_feed"),
        "feed_csv_roundtrip": _feed_round_trip,
        "raw_landing": _raw_landing,
        "feed_rejects": _feed_rejects,
        "upsert_sources": _upsert_sources,
        "upsert_new_ids": _upsert_new_ids,
        "upsert_golden": _upsert_golden,
        "append_links": _append_links,
        # matching and mastering
        "exact_tax_links": partial(_exact, TAX_ID_EXACT),
        "exact_lei_links": partial(_exact, LEI_EXACT),
        "fuzzy_pairs": partial(_fuzzy, CFG),
        "fuzzy_pairs_binarized": partial(_fuzzy, BINARIZED),
        "match_edges": lambda s, d: plain(matching.match_edges(data.matches(s, d), CFG)),
        "match_counts": lambda s, d: plain(matching.match_counts(data.matches(s, d), CFG)),
        "pair_types": lambda s, d: plain(matching.final_pair_types(data.matches(s, d))),
        "components": _clusters,
        "cluster_sizes": lambda s, d: plain(mastering.cluster_sizes(_clusters(s, d))),
        "golden_records": lambda s, d: plain(data.fresh_mastering(s, d).golden),
        "golden_records_binarized": _golden_binarized,
        "party_links": lambda s, d: plain(data.fresh_mastering(s, d).links),
        "party_links_single_survivor": lambda s, d: plain(
            data.fresh_mastering(s, d, ONE_SURVIVOR).links.select("golden_id", "source_party_id", "is_survivor")),
        "lineage_created": _lineage_created,
        "stable_golden_ids": _stable_ids,
        "master_incremental": _master_incremental,
        # reports and statistics
        "ingest_counts": _of(stats.ingest_counts, "parties"),
        "golden_by_type": _of(stats.golden_by_type, "golden"),
        "link_stats": _of(lambda links: stats.link_stats(links).drop("duplicates_resolved"), "links"),
        "lineage_count": _of(stats.lineage_count, "lineage"),
        "stats_overview": _of(stats.headline, "golden", "parties", "links", "lineage"),
        "stats_by_type": _of(stats.stats_by_type, "golden"),
        "source_breakdown": _of(stats.source_breakdown, "parties"),
        "source_rollup": _of(lambda p: stats.source_rollup(stats.source_breakdown(p)), "parties"),
        "golden_breakdown": _of(stats.golden_breakdown, "golden"),
        "dup_resolution": _of(stats.link_stats, "links"),
        "lineage_by_type": lambda s, d: plain(stats.lineage_by_type(
            data.tables(s, d).lineage.unionByName(data.applied(s, d).lineage))),
        "chart_golden_by_type": partial(_charts, "party_type", "golden"),
        "chart_source_by_system": partial(_charts, "source_system", "parties"),
        "chart_confidence": _of(stats.chart_confidence, "golden"),
        "chart_quality": lambda s, d: plain(stats.chart_quality(data.dq_log(s, d))),
        "chart_lineage_events": lambda s, d: stats.chart_series(
            data.tables(s, d).lineage.unionByName(data.applied(s, d).lineage), "event_type"),
        "chart_entity_status": partial(_charts, "entity_status", "golden"),
        "chart_summary": _of(stats.chart_summary, "parties", "golden"),
        "freshness": _freshness,
        "dq_source": partial(_dq, quality.source_suite, "parties"),
        "dq_while_writing": _dq_while_writing,
        "dq_golden": partial(_dq, quality.golden_suite, "golden"),
        "dq_clusters": _dq_clusters,
        "dq_filtered": _dq_filtered,
        "dq_results": _dq_results,
        "dq_append": lambda s, d: plain(data.dq_log(s, d).drop("details")),
        "dq_report": lambda s, d: plain(data.quality(s, d).report),
        "dq_history": lambda s, d: plain(stats.dq_history(data.dq_log(s, d))),
        "dq_runs": lambda s, d: plain(stats.dq_runs(data.dq_log(s, d))),
        # serving
        "search_name": lambda s, d: _search(s, d, 20, 0, name="AB"),
        "search_filters": lambda s, d: _search(s, d, 100, 5, state="s3", party_type="individual", status="active"),
        "search_indexed": _search_indexed_page,
        "search_indexed_total": lambda s, d: _search_indexed(s, d).total,
        "search_page_2": lambda s, d: _search(s, d, 20, 20),
        "search_total": _search_total,
        "party_lookup": _party_lookup,
        "party_lineage": _party_lineage,
        "party_sources": _party_sources,
        "active_parties": lambda s, d: serving.active_parties(data.tables(s, d).golden),
        # export and files
        "export_golden": lambda s, d: plain(_export(s, d).drop("updated_at")),
        "export_full": partial(_exported, "full"),
        "export_multi_source": partial(_exported, "multi_source"),
        "export_by_type_counts": partial(_exported, "by_type"),
        "export_summary": lambda s, d: plain(export.export_summary(_export(s, d))),
        "zone_listing": _zone_listing,
        "file_preview": _file_preview,
        # events
        "event_mix": lambda s, d: events.event_mix(events.decode(data.messages(s, d))),
        "event_routing": _event_routing,
        "event_keys": _event_keys,
        "event_times": lambda s, d: events.decode(data.messages(s, d)).select("seq", "sent_at"),
        "events_address": partial(_events, "ADDRESS_UPDATED", {
            "old_line1": "old_address.address_line1", "old_city": "old_address.city", "old_state": "old_address.state",
            "old_postal": "old_address.postal_code", "new_line1": "new_address.address_line1", "new_line2": "new_address.address_line2", "new_city": "new_address.city",
            "new_state": "new_address.state", "new_postal": "new_address.postal_code", "new_country": "new_address.country"}),
        "events_kyc": lambda s, d: _events("KYC_STATUS_UPDATED", {"kyc_status": "kyc_status", "risk_score": "risk_score", "notes": "notes"}, s, d).withColumn(
            "risk_score", F.col("risk_score").cast("double")),
        "events_new_party": partial(_events, "CREATED", {"source": "source", "full_name": "full_name", "via": "via"}),
        "events_status": partial(_events, "STATUS_CHANGED", {"old_status": "old_status", "new_status": "new_status"}),
        "events_merge": partial(_events, "MERGED", {"primary_id": "primary_id", "secondary_id": "secondary_id"}),
        "golden_after_events": _golden_after,
        "links_after_events": _links_after,
        "confirmations": lambda s, d: plain(data.applied(s, d).confirmations.drop("processed_at")),
        "event_errors": lambda s, d: plain(data.applied(s, d).errors.select("seq", "event_id", "event_type", "reason")),
        "stream_run_stats": lambda s, d: plain(events.run_stats(data.applied(s, d).confirmations, data.applied(s, d).errors)),
        "recent_stream_events": lambda s, d: plain(stats.recent_stream_events(
            data.tables(s, d).lineage.unionByName(data.applied(s, d).lineage), CFG.stream_trigger).select("golden_id", "event_type", "event_id")),
        "stream_apply_available_now": _stream_apply,
        "stream_stats_available_now": lambda s, d: plain(_stream_stats(s, d)),
        "stream_progress": _stream_progress,
        "stream_progress_all": _stream_progress_all,
        "stream_bounded": _stream_bounded,
        "stream_fold": _stream_fold,
        "stream_export": _stream_export,
        "confirmation_messages": _confirmation_messages,
    }
