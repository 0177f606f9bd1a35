"""Clusters, golden records, links, confidence and creation lineage."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldweave.config import LEI_EXACT, TAX_ID_EXACT, MasteringConfig
from goldweave.functions.text import uuid_of
from goldweave.operators.components import connected_components
from goldweave.operators.matching import TAX_AND_LEI, Matches, alike_edges, find_matches, first_partners, fuzzy_facts
from goldweave.operators.survivorship import by_source, lone_survivors, priority_of, survivors, usable_rows
from goldweave.schemas import GOLDEN_PARTIES
from goldweave.session import Scratch, tune


@dataclass(frozen=True)
class Mastered:
    """Result of one mastering run."""

    matches: Matches
    clusters: DataFrame  # id -> cluster_id of every record in a cluster of two or more
    entities: DataFrame  # golden values with cluster facts, one row per entity
    golden: DataFrame
    links: DataFrame
    lineage: DataFrame


def moment(as_of: str | None) -> Column:
    """Fixed UTC timestamp, or the current one."""
    return F.lit(as_of).cast("timestamp") if as_of else F.current_timestamp()


def _anchors(matches: Matches) -> DataFrame:
    """Anchor of each group a record belongs to: tax, LEI and look-alike profile."""
    exact = matches.members.filter(F.col("match_type") != TAX_AND_LEI)
    all_rows = exact.select("id", "match_type", F.col("anchor_id").alias("anchor")).unionByName(
        matches.member_of.select("id", F.lit("PROFILE").alias("match_type"), F.col("profile_id").alias("anchor"))
    )
    of_kind = lambda kind: F.max(F.when(F.col("match_type") == kind, F.col("anchor")))
    return all_rows.groupBy("id").agg(
        of_kind(TAX_ID_EXACT).alias("tax_anchor"), of_kind(LEI_EXACT).alias("lei_anchor"), of_kind("PROFILE").alias("profile_anchor")
    )


def build_clusters(matches: Matches, scratch: Scratch) -> DataFrame:
    """(id, cluster_id, anchors) of every matched record; ``cluster_id`` is the cluster's smallest id.

    Components run over group anchors only. A record adds an edge just when it
    ties two groups together, and equal edges collapse before the loop, so a
    key held by very many records costs a single node.
    """
    anchors = scratch.save(_anchors(matches), "anchors")
    slots = F.array_distinct(F.array_compact(F.array("tax_anchor", "lei_anchor", "profile_anchor")))
    ties = (
        anchors.select(F.array_sort(slots).alias("a"))
        .filter(F.size("a") > 1)
        .select(F.col("a")[0].alias("x"), F.explode(F.slice("a", 2, 2)).alias("y"))
    )
    labels = connected_components(ties.unionByName(alike_edges(matches)), scratch)
    own = F.coalesce("tax_anchor", "lei_anchor", "profile_anchor")
    return (
        anchors.withColumn("anchor", own)
        .join(labels.withColumnsRenamed({"node": "anchor"}), "anchor", "left")
        .select(
            "id", F.coalesce("component", "anchor").alias("cluster_id"), "anchor", "tax_anchor", "lei_anchor", "profile_anchor"
        )
    )


def components(parties: DataFrame, clusters: DataFrame) -> DataFrame:
    """(id, cluster_id) of every record; a record without a match is its own cluster."""
    return (
        parties.select("id")
        .join(clusters.select("id", "cluster_id"), "id", "left")
        .select("id", F.coalesce("cluster_id", "id").alias("cluster_id"))
    )


def cluster_sizes(membership: DataFrame) -> DataFrame:
    """Clusters with several records, with one, and in all."""
    sizes = membership.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(
        F.count_if(F.col("n") > 1).alias("multi_record"),
        F.count_if(F.col("n") == 1).alias("single_record"),
        F.count(F.lit(1)).alias("total"),
    )


_PAIR_FACTS = ("tax_pairs", "lei_pairs", "both_pairs", "fuzzy_pairs", "fuzzy_score")


def _pair_facts(matches: Matches, clusters: DataFrame) -> DataFrame:
    """Per cluster: exact pairs of each kind, fuzzy pairs and the sum of their scores."""
    zero = F.lit(0).cast("decimal(38,0)")
    of_kind = lambda kind: F.when(F.col("match_type") == kind, F.col("pairs")).otherwise(zero)
    exact = matches.groups.select(
        F.col("anchor_id").alias("id"), of_kind(TAX_ID_EXACT).alias("tax_pairs"), of_kind(LEI_EXACT).alias("lei_pairs"),
        of_kind(TAX_AND_LEI).alias("both_pairs"), zero.alias("fuzzy_pairs"), F.lit(0.0).alias("fuzzy_score"),
    )
    fuzzy = fuzzy_facts(matches).select(
        "id", zero.alias("tax_pairs"), zero.alias("lei_pairs"), zero.alias("both_pairs"), F.col("pairs").alias("fuzzy_pairs"), F.col("score").alias("fuzzy_score"),
    )
    per_anchor = exact.unionByName(fuzzy).groupBy("id").agg(*[F.sum(c).alias(c) for c in _PAIR_FACTS])
    return (
        per_anchor.join(clusters.select("id", "cluster_id"), "id")
        .groupBy("cluster_id")
        .agg(*[F.sum(c).alias(c) for c in _PAIR_FACTS])
    )


def _confidence(cfg: MasteringConfig) -> Column:
    """Fixed score when a tax pair survives, else the mean over all member pairs."""
    n = F.col("records").cast("double")
    every = n * (n - 1) / 2
    exact = (F.col("tax_pairs") + F.col("lei_pairs") - F.col("both_pairs")).cast("double")
    matched = exact + F.col("fuzzy_pairs").cast("double")
    mean = (exact + F.col("fuzzy_score") + (every - matched) * cfg.unmatched_pair_score) / every
    return F.when(F.col("tax_pairs") > F.col("both_pairs"), F.lit(cfg.tax_confidence)).otherwise(F.round(mean, 4))


def _link_scores(matches: Matches, clusters: DataFrame, entities: DataFrame, cfg: MasteringConfig) -> DataFrame:
    """Score shared by a cluster's links: its last member with that member's first partner.

    Both in (source, id) order. The first partner is the earliest of the first
    members of the groups the last member belongs to; an exact key wins a tie.
    """
    exact_first = (
        matches.members.filter(F.col("match_type") != TAX_AND_LEI)
        .groupBy("match_type", F.col("anchor_id").alias("anchor"))
        .agg(F.min(F.struct("source_system", "id")).alias("p"))
        .select(
            F.col("match_type").alias("kind"), "anchor",
            F.struct("p.source_system", "p.id", F.lit(0).alias("fuzzy"), F.lit(1.0).alias("score")).alias("partner"),
        )
    )
    fuzzy_first = first_partners(matches, cfg).select(F.lit("PROFILE").alias("kind"), "anchor", "partner")
    slot = lambda kind, column: F.struct(F.lit(kind).alias("kind"), F.col(column).alias("anchor"))
    last = (
        entities.select("cluster_id", F.col("last_member.last_id").alias("id"))
        .join(clusters.drop("cluster_id"), "id")
        .select(
            "cluster_id",
            F.explode(F.array(slot(TAX_ID_EXACT, "tax_anchor"), slot(LEI_EXACT, "lei_anchor"), slot("PROFILE", "profile_anchor"))).alias("k"),
        )
        .select("cluster_id", "k.*")
        .filter("anchor IS NOT NULL")
    )
    return (
        last.join(exact_first.unionByName(fuzzy_first), ["kind", "anchor"])
        .groupBy("cluster_id")
        .agg(F.min("partner").alias("partner"))
        .select("cluster_id", F.col("partner.score").alias("match_score"))
    )


def assign_golden_ids(entities: DataFrame, membership: DataFrame | None = None, links: DataFrame | None = None) -> DataFrame:
    """Adds ``golden_id``, derived from the smallest natural key of the entity.

    With the links of an earlier run, an entity keeps the lowest id its records
    had; an id claimed by several entities stays with the smallest natural key.
    """
    fresh = uuid_of(F.col("natural_key"))
    if links is None:
        return entities.withColumn("golden_id", fresh)
    claims = (
        membership.join(links.select(F.col("source_party_id").alias("id"), F.col("golden_id").alias("held")), "id")
        .groupBy("cluster_id").agg(F.min("held").alias("held"))
        .join(entities.select("cluster_id", "natural_key"), "cluster_id")
    )
    winners = claims.groupBy("held").agg(F.min("natural_key").alias("winner"))
    settled = claims.join(winners, "held").select("cluster_id", "held", (F.col("natural_key") == F.col("winner")).alias("keeps"))
    return (
        entities.join(settled, "cluster_id", "left")
        .withColumn(
            "golden_id",
            F.when(F.col("held").isNull(), fresh)
            .when(F.col("keeps"), F.col("held"))
            .otherwise(uuid_of(F.concat("natural_key", F.lit("|split|"), "held"))),
        )
        .drop("held", "keeps")
    )


def _lineage_detail(cfg: MasteringConfig) -> Column:
    """Creation detail as JSON, in one shape at every size.

    ``sources`` names each source once, in cluster order; as clusters are
    ordered by source, ``source_counts`` next to it gives the records in a row.
    """
    counts = F.col("source_counts")
    return F.to_json(
        F.struct(
            F.col("records").alias("source_count"),
            F.transform(counts, lambda c: c["source_system"]).alias("sources"),
            F.transform(counts, lambda c: c["records"]).alias("source_counts"),
            F.col("confidence").alias("confidence"),
            F.when(F.col("confidence") >= cfg.tax_confidence, "EXACT").otherwise("FUZZY").alias("match_type"),
        )
    )


def golden_records(entities: DataFrame, as_of: str | None = None) -> DataFrame:
    """Entities in the golden table's schema."""
    stamped = entities.withColumn("confidence_score", F.col("confidence")).withColumns(
        {"created_at": moment(as_of), "updated_at": moment(as_of)}
    )
    return stamped.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in GOLDEN_PARTIES])


def creation_lineage(entities: DataFrame, cfg: MasteringConfig, as_of: str | None = None) -> DataFrame:
    """One CREATED row per entity."""
    return entities.select(
        "golden_id", F.lit("CREATED").alias("event_type"), _lineage_detail(cfg).alias("changed_fields"),
        F.lit(cfg.batch_trigger).alias("triggered_by"), F.lit(None).cast("string").alias("event_id"),
        moment(as_of).alias("event_at"),
    )


def party_links(parties: DataFrame, clusters: DataFrame, entities: DataFrame, cfg: MasteringConfig, as_of: str | None = None) -> DataFrame:
    """Record-to-golden links; a survivor comes from the cluster's most trusted source.

    ``single_survivor`` keeps the flag on the first such record only.
    """
    narrow = parties.select("id", "source_system").join(clusters.select("id", "cluster_id"), "id", "left")
    keyed = narrow.select("id", F.coalesce("cluster_id", "id").alias("cluster_id"), "source_system")
    facts = entities.select("cluster_id", "golden_id", "top_priority", "match_score")
    linked = keyed.join(facts, "cluster_id")
    survivor = priority_of(cfg) == F.col("top_priority")
    if cfg.single_survivor:
        first = (
            linked.filter(survivor).groupBy("cluster_id")
            .agg(F.min(F.struct("source_system", "id"))["id"].alias("first_id"))
        )
        linked = linked.join(first, "cluster_id", "left")
        survivor = F.col("id") == F.col("first_id")
    return linked.select(
        "golden_id", F.col("id").alias("source_party_id"), survivor.alias("is_survivor"),
        F.col("match_score").cast("decimal(5,4)").alias("match_score"), moment(as_of).alias("linked_at"),
    )


def build_entities(parties: DataFrame, matches: Matches, clusters: DataFrame, cfg: MasteringConfig, scratch: Scratch,
                   previous_links: DataFrame | None = None) -> DataFrame:
    """Golden values, confidence, link score and id of every entity."""
    tagged = usable_rows(parties, cfg).join(clusters.select("id", "cluster_id"), "id", "left")
    alone = lone_survivors(tagged.filter("cluster_id IS NULL"), cfg).withColumns(
        {"confidence": F.lit(1.0), "match_score": F.lit(1.0)}
    )
    together = scratch.save(survivors(by_source(tagged.filter("cluster_id IS NOT NULL"), cfg), cfg), "together")
    scored = (
        together.join(_pair_facts(matches, clusters), "cluster_id")
        .join(_link_scores(matches, clusters, together, cfg), "cluster_id")
        .withColumn("confidence", _confidence(cfg))
        .select(*alone.columns)
    )
    entities = alone.unionByName(scored)
    membership = components(parties, clusters) if previous_links is not None else None
    return assign_golden_ids(entities, membership, previous_links)


def master_parties(parties: DataFrame, cfg: MasteringConfig | None = None, scratch: Scratch | None = None,
                   as_of: str | None = None, previous_links: DataFrame | None = None) -> Mastered:
    """Match, cluster and merge source records into golden records.

    Pass the links of an earlier run as ``previous_links`` to keep its golden ids.
    """
    cfg = cfg or MasteringConfig()
    tune(parties.sparkSession)
    scratch = scratch or Scratch(parties.sparkSession, "mastering")
    matches = find_matches(parties, cfg, scratch.save)
    clusters = scratch.save(build_clusters(matches, scratch), "clusters")
    entities = scratch.save(build_entities(parties, matches, clusters, cfg, scratch, previous_links), "entities")
    return Mastered(
        matches=matches,
        clusters=clusters,
        entities=entities,
        golden=golden_records(entities, as_of),
        links=party_links(parties, clusters, entities, cfg, as_of),
        lineage=creation_lineage(entities, cfg, as_of),
    )
