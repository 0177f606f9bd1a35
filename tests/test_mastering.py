import json
import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from goldweave.config import MasteringConfig
from goldweave.operators.components import connected_components, extended_components
from goldweave.operators.incremental import after_changes, master_changes
from goldweave.operators.mastering import build_clusters, build_entities, components, master_parties
from goldweave.operators.matching import final_pair_types, find_matches, fuzzy_facts, fuzzy_matches, match_counts
from goldweave.session import Scratch, tune
from tests.build import (
    CRM, DNB, MKT, brute_clusters, brute_confidence, brute_link_score, brute_pairs, brute_survivors, frame, party,
)


def _random_rows(seed, n=90):
    """Rows with shared keys, look-alikes, exact copies, blanks and padding."""
    rng = random.Random(seed)
    rows = []
    for i in range(1, n + 1):
        source = rng.choice([CRM, CRM, DNB, MKT, "other_feed"])
        rows.append(party(
            i, source, full_name=rng.choice(["Ann Lee", "ann lee ", "Anne Lee", "Bob Stone", "Bob  Stone", "", None, "nan", "Zed"]),
            address_line1=rng.choice(["1 Oak St", "1 Oak Street", "9 Elm Rd", None]), city=rng.choice(["Rye", " rye", "Troy", "", None]),
            state=rng.choice(["NY", "NJ", None]), postal_code=rng.choice(["10001", "10002", "", None]),
            tax_id=rng.choice([None, "", f"T{i}", f"T{i}", f"T{i}", "T-A", "T-B"]),
            lei=rng.choice([None, None, "", f"L{i}", "L-A"]) if source == MKT else None,
            email=rng.choice([None, " ", f"{i}@x"]), phone=rng.choice([None, f"\t{i}\n"]),
        ))
    return rows


@pytest.mark.parametrize("seed,binarize", [(1, False), (2, False), (3, True)])
def test_equals_literal_rules(spark, seed, binarize):
    rows = _random_rows(seed, 60 if binarize else 90)
    cfg = MasteringConfig(binarize_threshold=0.0 if binarize else None, block_cell_rows=3)
    done = master_parties(frame(spark, rows), cfg, as_of="2025-01-01")
    pairs = brute_pairs(rows, binarize)
    clusters = brute_clusters(rows, pairs)

    got = {r["id"]: r["cluster_id"] for r in components(frame(spark, rows), done.clusters).collect()}
    assert got == {r["id"]: root for root, members in clusters.items() for r in members}
    types = {r["match_type"]: int(r["pairs"]) for r in final_pair_types(done.matches).collect()}
    kinds = [k for _, k in pairs.values()]
    assert types == {k: kinds.count(k) for k in set(kinds)}

    golden = {r["cluster_id"]: r for r in done.entities.collect()}
    links = {r["source_party_id"]: r for r in done.links.collect()}
    assert len(links) == len(rows) and len(golden) == len(clusters)
    for root, members in clusters.items():
        record = golden[root]
        for field, value in brute_survivors(members).items():
            assert record[field] == value, (field, [m["id"] for m in members])
        assert record["confidence"] == pytest.approx(brute_confidence(members, pairs), abs=1.01e-4)
        for m in members:
            assert float(links[m["id"]]["match_score"]) == pytest.approx(brute_link_score(members, pairs), abs=1e-4)
            assert links[m["id"]]["golden_id"] == record["golden_id"]


def test_copies_stay_one_profile_and_hot_key_one_group(spark):
    copies = [party(i, [CRM, DNB, MKT][i % 3], full_name="Same", address_line1="1 Way", city="Here", postal_code="1") for i in range(1, 301)]
    shared = [party(i, CRM, tax_id="HOT") for i in range(1001, 1201)]
    done = master_parties(frame(spark, copies + shared), MasteringConfig(block_cell_rows=2), as_of="2025-01-01")
    assert done.matches.fuzzy.count() == 3
    assert {r["source_pair"]: int(r["pairs"]) for r in match_counts(done.matches, MasteringConfig()).collect()} == {
        "all": 200 * 199 // 2, "CRM vs DNB": 10000, "CRM vs Markit": 10000, "DNB vs Markit": 10000}
    found = {r["records"]: r["confidence"] for r in done.entities.collect()}
    expected = (30000 * 1.0 + (300 * 299 / 2 - 30000) * 0.85) / (300 * 299 / 2)
    assert found == {300: pytest.approx(expected, abs=1e-4), 200: 0.99}


@pytest.mark.parametrize("threshold", [0.7, 0.8, 0.88, 0.95])
def test_blocks_without_texts_stand_for_their_pairs(spark, threshold):
    rows = _random_rows(7, 80)
    cfg = MasteringConfig(binarize_threshold=0.0, block_cell_rows=4, fuzzy_threshold=threshold)
    parties, scratch = frame(spark, rows), Scratch(spark, "blocks")
    found = find_matches(parties, cfg, scratch.save)
    listed = replace(found, blocks=None, facts=None)

    def entities(matches, name):
        work = Scratch(spark, name)
        clusters = work.save(build_clusters(matches, work), "clusters")
        return sorted(map(repr, build_entities(parties, matches, clusters, cfg, work).collect()))

    assert entities(found, "by-blocks") == entities(listed, "by-pairs")
    total = lambda facts: facts.agg(F.sum("pairs"), F.round(F.sum("score"), 6)).first()
    assert total(fuzzy_facts(found)) == total(fuzzy_facts(listed)) and found.fuzzy.count() > 5


def _rows_without_texts():
    """300 records of three sources in one city, of which fourteen pairs share a tax id."""
    return [party(i, [CRM, DNB, MKT][i % 3], city="Here", tax_id=f"T{i // 2}" if i % 20 < 2 else None) for i in range(1, 301)]


def _largest_table(spark, work):
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(work.root)
    listed = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(root)
    return max(spark.read.parquet(work.path(s.getPath().getName())).count() for s in listed)


def test_pairs_of_blocks_without_texts_are_written_nowhere(spark):
    rows, cfg, work = _rows_without_texts(), MasteringConfig(binarize_threshold=0.0), Scratch(spark, "no-pairs")
    listed = fuzzy_matches(find_matches(frame(spark, rows), cfg, work.save), cfg)
    assert listed.count() == 3 * 100 * 100 - 14 and _largest_table(spark, work) <= 2 * len(rows)
    assert listed._jdf.queryExecution().executedPlan().toString().count("SortMergeJoin") == 1


def test_mastering_without_texts_lists_no_pairs(spark):
    rows, cfg, work = _rows_without_texts(), MasteringConfig(binarize_threshold=0.0), Scratch(spark, "no-pairs")
    assert master_parties(frame(spark, rows), cfg, work, "2025-01-01").golden.count() == 1
    assert _largest_table(spark, work) <= 2 * len(rows)


def test_lineage_has_one_shape_at_every_size(spark):
    rows = [party(i, [CRM, DNB][i % 2], tax_id="T") for i in range(1, 4002)] + [party(i, [CRM, MKT][i % 2], tax_id="U") for i in (5001, 5002)]
    done = master_parties(frame(spark, rows), as_of="2025-01-01")
    large, small = sorted((json.loads(r["changed_fields"]) for r in done.lineage.collect()), key=lambda d: -d["source_count"])
    assert list(large) == list(small)
    assert large["sources"] == [DNB, CRM] and large["source_counts"] == [2001, 2000] and large["source_count"] == 4001
    assert small["sources"] == [CRM, MKT] and small["source_counts"] == [1, 1]


def test_exact_pair_is_not_fuzzy_and_lei_overrides_tax(spark):
    rows = [
        party(1, MKT, tax_id="A", lei="L", full_name="x", city="c", address_line1="a"),
        party(2, MKT, tax_id="A", lei="L", full_name="x", city="c", address_line1="a"),
        party(3, CRM, tax_id="B", full_name="y", city="d", address_line1="b"),
        party(4, DNB, tax_id="B", full_name="y", city="d", address_line1="b"),
    ]
    done = master_parties(frame(spark, rows), as_of="2025-01-01")
    assert fuzzy_matches(done.matches, MasteringConfig()).count() == 0
    assert sorted(float(r["confidence_score"]) for r in done.golden.collect()) == [0.99, 1.0]


def test_survivor_flags(spark):
    rows = [party(1, MKT, tax_id="A"), party(2, MKT, tax_id="A"), party(3, CRM, tax_id="A")]
    for single, expected in ((False, {1, 2}), (True, {1})):
        done = master_parties(frame(spark, rows), MasteringConfig(single_survivor=single), as_of="2025-01-01")
        assert {r["source_party_id"] for r in done.links.collect() if r["is_survivor"]} == expected


def test_rerun_is_idempotent_and_keeps_ids(spark):
    rows = [party(5, CRM, tax_id="A"), party(6, DNB, tax_id="A"), party(7, CRM)]
    first = master_parties(frame(spark, rows), as_of="2025-01-01")
    again = master_parties(frame(spark, rows), as_of="2025-01-01")
    pick = lambda m: {r["source_party_id"]: r["golden_id"] for r in m.links.collect()}
    assert pick(first) == pick(again)
    grown = rows + [party(1, CRM, tax_id="A", source_party_id="A-0")]
    kept = master_parties(frame(spark, grown), as_of="2025-01-01", previous_links=first.links)
    assert pick(kept)[1] == pick(first)[5] == pick(kept)[5]
    split = [party(5, CRM, tax_id="A"), party(6, DNB, tax_id="B"), party(7, CRM)]
    apart = pick(master_parties(frame(spark, split), as_of="2025-01-01", previous_links=first.links))
    assert apart[6] == pick(first)[5] and len(set(apart.values())) == 3


def test_documented_totals(spark):
    """200 + 170 + 115 records, 35 of them sharing a tax id with the first source."""
    rows = [party(i, CRM, tax_id=f"T{i}", state=f"S{i}") for i in range(1, 201)]
    rows += [party(1000 + i, DNB, tax_id=f"D{i}", state=f"D{i}") for i in range(150)]
    rows += [party(1200 + i, DNB, tax_id=f"T{i + 1}", state="X") for i in range(20)]
    rows += [party(2000 + i, MKT, tax_id=f"M{i}", lei=f"L{i}", state=f"M{i}") for i in range(100)]
    rows += [party(2200 + i, MKT, tax_id=f"T{i + 21}", lei=f"K{i}", state="X") for i in range(15)]
    done = master_parties(frame(spark, rows), as_of="2025-01-01")
    assert (len(rows), done.golden.count(), len(rows) - done.golden.count()) == (485, 450, 35)


def test_no_match_at_all(spark):
    done = master_parties(frame(spark, [party(1), party(2, DNB, state=None)]), as_of="2025-01-01")
    assert done.golden.count() == 2 and {float(r["match_score"]) for r in done.links.collect()} == {1.0}


@pytest.mark.parametrize("edges", [
    [(i, i + 1) for i in range(60)],
    [(0, i) for i in range(1, 60)],
    [(random.Random(3).randint(0, 80), random.Random(i).randint(0, 80)) for i in range(70)],
    [],
])
def test_components_equal_union_find(spark, edges):
    ids = sorted({n for e in edges for n in e})
    expected = {m["id"]: root for root, ms in brute_clusters([{"id": i, "source_system": ""} for i in ids], edges).items() for m in ms}
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    got = {r["node"]: r["component"] for r in connected_components(df, Scratch(spark, "cc")).collect()}
    looped = {n for a, b in edges if a != b for n in (a, b)}
    assert got == {n: c for n, c in expected.items() if n in looped}


def test_a_pair_is_scored_by_one_call(spark):
    from goldweave.operators.matching import blocked_profiles, profiles, scored_profile_pairs

    rows = [party(i, [CRM, DNB][i % 2], full_name=f"Name {i // 2}", city="c", postal_code="1", address_line1="1 Way") for i in range(1, 9)]
    cfg = MasteringConfig()
    blocked = Scratch(spark, "plan").save(blocked_profiles(profiles(frame(spark, rows), cfg), cfg), "blocked")
    plan = scored_profile_pairs(blocked, cfg)._jdf.queryExecution().executedPlan().toString()
    nodes = [line for line in plan.split("\n") if "EvalPython" in line]
    assert len(nodes) == 1 and nodes[0].count("score(") == 1


@pytest.mark.parametrize("binarize", [None, 0.8])
def test_dense_blocks_give_the_pairs_of_a_join(spark, monkeypatch, binarize):
    from goldweave.operators import matching

    rng = random.Random(11)
    word = lambda n: "".join(rng.choice("abcdé😀") for _ in range(n))
    names = [word(rng.randint(0, 14)) for _ in range(25)] + ["x" * 64, "x" * 63 + "y", "x" * 70, "", None]
    rows = [party(i, rng.choice([CRM, DNB, MKT]), full_name=rng.choice(names), address_line1=rng.choice(["1 Oak St", "1 Oak Street", "", None]),
                  city=rng.choice(["Rye", "Troy", None]), state="NY", postal_code=rng.choice(["1", "2", None])) for i in range(1, 301)]
    cfg = MasteringConfig(block_cell_rows=40, binarize_threshold=binarize)

    def pairs(dense):
        monkeypatch.setattr(matching, "_DENSE_PAIRS", dense)
        blocked = Scratch(spark, "dense").save(matching.blocked_profiles(matching.profiles(frame(spark, rows), cfg), cfg), "blocked")
        assert (blocked.filter("dense").count() > 0) == (dense == 1)
        every = matching.scored_profile_pairs(blocked, cfg)
        some = matching.scored_profile_pairs(blocked, cfg, "(l.profile_id % 7 = 0 OR r.profile_id % 7 = 0)")
        return sorted(map(repr, every.collect())), sorted(map(repr, some.collect()))

    joined, arrays = pairs(1 << 60), pairs(1)
    assert joined == arrays and len(joined[0]) > len(joined[1]) > 10


def test_joins_broadcast_by_measured_size(spark, tmp_path):
    """A side of few bytes on disk and many in memory must not pass through the driver."""
    spark.range(3_000_000).selectExpr("id div 1000000 AS k", "7L AS a", "8L AS b").write.parquet(str(tmp_path / "small"))
    files = spark.read.parquet(str(tmp_path / "small"))
    tune(spark)
    joined = spark.range(0, 1_000_000, 1, 4).withColumnRenamed("id", "k").join(files, "k")
    assert joined.count() == 3_000_000 and "BroadcastHashJoin" not in joined._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("seed", [1, 2])
def test_new_edges_extend_known_components(spark, seed):
    rng = random.Random(seed)
    old, new = ([(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(n)] for n in (30, 8))
    frame_of = lambda edges: spark.createDataFrame(edges, "a bigint, b bigint")
    work = Scratch(spark, "grown")
    known = work.save(connected_components(frame_of(old), work, "old"), "known")
    moved = {r["node"]: r["component"] for r in extended_components(known, frame_of(new), work).collect()}
    before = {r["node"]: r["component"] for r in known.collect()}
    full = {r["node"]: r["component"] for r in connected_components(frame_of(old + new), work, "all").collect()}
    loops = {a for a, b in new if a == b}
    assert {n: c for n, c in (before | moved).items() if n not in loops or n in full} == full
    assert all(before.get(n) != c for n, c in moved.items())
    assert extended_components(known, frame_of([]), work, "none").count() == 0


def _tables_of(golden, links):
    drop = ("created_at", "updated_at", "linked_at")
    key = lambda r: str(sorted((k, str(v)) for k, v in r.asDict().items() if k not in drop))
    return sorted(key(r) for r in golden.collect()), sorted(key(r) for r in links.collect())


@pytest.mark.parametrize("seed", [3, 4, 5])
def test_changed_records_equal_a_mastering_of_all(spark, seed):
    rng = random.Random(seed)

    def record(i):
        return party(i, rng.choice([CRM, DNB, MKT]), tax_id=rng.choice([None, f"T{rng.randint(0, 25)}"]), lei=rng.choice([None, None, f"L{rng.randint(0, 9)}"]),
                     full_name=f"Name {rng.randint(0, 12)}", city=rng.choice("ab"), postal_code=rng.choice(["1", "2"]), address_line1=f"{rng.randint(0, 3)} Way")

    rows = {i: record(i) for i in range(1, 60)}
    first = master_parties(frame(spark, list(rows.values())), as_of="2025-01-01")
    work = Scratch(spark, "before")
    golden, links = work.save(first.golden, "golden"), work.save(first.links, "links")
    ids = rng.sample(range(1, 60), 5) + [100, 101]
    for i in ids[:4] + [100, 101]:
        rows[i] = record(i)
    del rows[ids[4]]
    now = frame(spark, list(rows.values()))
    done = master_changes(now, golden, links, spark.createDataFrame([(i,) for i in ids], "id bigint"), as_of="2025-01-02")
    full = master_parties(now, as_of="2025-01-02", previous_links=links)
    assert _tables_of(*after_changes(golden, links, now, done)) == _tables_of(full.golden, full.links)


def test_rows_rewritten_follow_the_change(spark):
    rows = [party(i, [CRM, DNB][i % 2], tax_id=f"T{i // 2}", city=f"c{i // 8}", full_name=f"Name {i}") for i in range(2, 202)]
    first = master_parties(frame(spark, rows), as_of="2025-01-01")
    work = Scratch(spark, "before")
    golden, links = work.save(first.golden, "golden"), work.save(first.links, "links")
    now = frame(spark, [*rows, party(900, MKT, tax_id="T7"), party(901, MKT, tax_id="new", city="far")])
    done = master_changes(now, golden, links, spark.createDataFrame([(900,), (901,)], "id bigint"), as_of="2025-01-02")
    assert (done.golden.count(), done.gone.count(), done.lineage.count()) == (2, 0, 1) and done.links.count() <= 12


def _block(seed, customers, parts):
    rng = random.Random(seed)
    word = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    return [party(i, CRM if i <= customers else MKT, full_name=f"{word(7)} {word(8)}", address_line1=f"{rng.randint(1, 999)} {word(6)} Street",
                  city="Rye", state="NY", postal_code=str(10000 + i)) for i in range(1, customers + parts + 1)]


def test_a_dense_block_compares_few_texts_and_in_few_calls(spark, monkeypatch):
    """The counts of shared characters settle nearly all pairs of different names, and texts are compared in large batches."""
    import numpy as np

    from goldweave.functions import similarity
    from goldweave.operators import matching

    cfg = MasteringConfig()
    rows = _block(3, 600, 600)
    blocked = matching.blocked_profiles(matching.profiles(frame(spark, rows), cfg), cfg)
    assert blocked.filter("dense").count() == 1200
    table = blocked.filter("dense").toArrow()
    rank = table["source_rank"].to_numpy()
    calls = []
    compare = similarity._common_in_words
    monkeypatch.setattr(similarity, "_common_in_words", lambda a, *rest: calls.append(len(a)) or compare(a, *rest))
    match = similarity.matched_in_cell(
        blocked.columns, cfg.name_weight, cfg.address_weight, cfg.city_weight, cfg.postal_weight, cfg.fuzzy_threshold, cfg.binarize_threshold)
    found = match(table.filter(rank < 2), table.filter(rank > 0))
    left, right = (found[c].combine_chunks().field("profile_id").to_numpy() for c in "lr")
    assert (left <= 600).all() and (right > 600).all()
    assert len(calls) <= 4 and sum(calls) < 600 * 600 / 300 and np.isfinite(found["raw"].to_numpy()).all()


def test_rows_of_a_dense_block_are_copied_to_few_cells(spark):
    """Cells compared as arrays hold more rows, so that what is shuffled does not grow with the square of a block."""
    from goldweave.operators import matching

    cfg = MasteringConfig(block_cell_rows=100)
    rows = _block(4, 800, 800)
    blocked = Scratch(spark, "cells").save(matching.blocked_profiles(matching.profiles(frame(spark, rows), cfg), cfg), "blocked")
    left, right = matching._cell_sides(blocked.filter("dense"), cfg)
    assert left.count() + right.count() <= 2 * 1600


def test_small_sides_stay_out_of_the_driver(spark):
    """Even one of a few rows: a broadcast of it takes a page of the driver's memory, and a run has very many."""
    tune(spark)
    small = spark.range(20).select(F.col("id").cast("string").alias("k"), F.lit("x").alias("v")).distinct()
    joined = spark.range(1000).select(F.col("id").cast("string").alias("k")).distinct().join(small, "k")
    assert joined.count() == 20
    joined.collect()
    assert "BroadcastExchange" not in joined._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("weights", [(0.0, 0.6, 0.3, 0.1), (0.3, 0.3, 0.3, 0.1), (0.7, 0.3, 0.0, 0.0)])
def test_dense_blocks_follow_other_weights(spark, monkeypatch, weights):
    """Blocks of a city, a postal code or a whole state, where names decide, help or do not count."""
    from goldweave.operators import matching

    cfg = MasteringConfig(**dict(zip(("name_weight", "address_weight", "city_weight", "postal_weight"), weights)), fuzzy_threshold=0.75, block_cell_rows=30)
    rng = random.Random(5)
    rows = [r | {"city": rng.choice(["Rye", "Troy"]), "postal_code": rng.choice(["1", "2", None])} for r in _block(6, 50, 50)]

    def pairs(dense):
        monkeypatch.setattr(matching, "_DENSE_PAIRS", dense)
        blocked = Scratch(spark, "weights").save(matching.blocked_profiles(matching.profiles(frame(spark, rows), cfg), cfg), "blocked")
        return sorted(map(repr, matching.scored_profile_pairs(blocked, cfg).collect()))

    joined = pairs(1 << 60)
    assert joined and joined == pairs(1)
