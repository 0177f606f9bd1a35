"""Mastering of changed records only.

A change can alter the entities that its records were in and those that its
records now match; all other entities stay as they are. So the changed records
are matched against the stored ones, and mastering runs over the records of
the touched entities.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldweave.config import MasteringConfig
from goldweave.operators.mastering import master_parties
from goldweave.operators.matching import blocked_profiles, match_keys, profile_members, profiles, scored_profile_pairs
from goldweave.session import Scratch, tune


@dataclass(frozen=True)
class Remastered:
    """What changed records change in the mastered tables."""

    golden: DataFrame  # new and altered golden records
    gone: DataFrame  # golden_id of those that are no more
    links: DataFrame  # new and altered links
    lineage: DataFrame  # of golden records that are new


def _partners(parties: DataFrame, changed: DataFrame, cfg: MasteringConfig, scratch: Scratch) -> DataFrame:
    """Ids of the records that match a changed one. Only pairs with a changed record are compared."""
    asked = scratch.save(match_keys(parties.join(changed, "id", "left_semi"), cfg).select("exact", "key").distinct(), "changed_keys")
    shared = scratch.save(match_keys(parties, cfg).join(asked, ["exact", "key"], "left_semi").select("id", "exact").distinct(), "sharing")
    pool = scratch.save(parties.join(shared.filter("NOT exact").select("id").distinct(), "id", "left_semi"), "blockmates")
    profile = profiles(pool, cfg)
    blocked = scratch.save(blocked_profiles(profile, cfg), "blocked")
    fresh = profile_members(pool.join(changed, "id", "left_semi"), _as_pairs(blocked), cfg).select("profile_id").distinct().withColumn("fresh", F.lit(True))
    marked = scratch.save(blocked.join(fresh, "profile_id", "left").withColumn("fresh", F.coalesce("fresh", F.lit(False))), "marked")
    pairs = scratch.save(scored_profile_pairs(marked, cfg, "(l.fresh OR r.fresh)"), "changed_pairs")
    return shared.filter("exact").select("id").unionByName(profile_members(pool, pairs, cfg).select("id")).distinct()


def _as_pairs(blocked: DataFrame) -> DataFrame:
    """Every profile as both sides of a pair, so that the records of all profiles can be looked up."""
    side = ["profile_id", "members", "source_system", "state", "city_key", "postal_code", "name_key", "address_key"]
    return blocked.select(*side).distinct().withColumn("members", F.greatest("members", F.lit(2))).select(
        *[F.col(c).alias(f"{c}_{s}") for s in "ab" for c in side])


def master_changes(
    parties: DataFrame, golden: DataFrame, links: DataFrame, changed: DataFrame, cfg: MasteringConfig | None = None,
    scratch: Scratch | None = None, as_of: str | None = None,
) -> Remastered:
    """Masters the source records ``changed`` (one column ``id``) into tables mastered without them.

    ``parties`` are all source records as they are now, ``golden`` and
    ``links`` the mastered tables before the change; a changed record may be
    new, altered or gone. The tables after it equal a mastering of all records
    with ``links`` as its previous links. Rows that stay as they are, times
    aside, are not in the result.
    """
    cfg = cfg or MasteringConfig()
    tune(parties.sparkSession)
    scratch = scratch or Scratch(parties.sparkSession, "changes")
    changed = scratch.save(changed.select("id").distinct(), "changed")
    near = scratch.save(changed.unionByName(_partners(parties, changed, cfg, scratch)).distinct(), "near")
    entities = links.join(near.select(F.col("id").alias("source_party_id")), "source_party_id", "left_semi").select("golden_id").distinct()
    old_links = scratch.save(links.join(entities, "golden_id", "left_semi"), "old_links")
    old_golden = scratch.save(golden.join(old_links.select("golden_id").distinct(), "golden_id", "left_semi"), "old_golden")
    ids = old_links.select(F.col("source_party_id").alias("id")).unionByName(near).distinct()
    rows = scratch.save(parties.join(ids, "id", "left_semi"), "rows")
    done = master_parties(rows, cfg, scratch, as_of, old_links)

    new_golden, new_links = scratch.save(done.golden, "new_golden"), scratch.save(done.links, "new_links")
    facts = lambda df: [c for c in df.columns if c not in ("created_at", "updated_at", "linked_at")]
    same = lambda new, old: new.select(*facts(new)).intersect(old.select(*facts(new)))
    born = old_golden.select("golden_id", F.col("created_at").alias("first_created"))
    altered = new_golden.join(same(new_golden, old_golden).select("golden_id"), "golden_id", "left_anti").join(born, "golden_id", "left").withColumn(
        "created_at", F.coalesce("first_created", "created_at")).select(*golden.columns)
    return Remastered(
        golden=altered,
        gone=old_golden.join(new_golden, "golden_id", "left_anti").select("golden_id"),
        links=new_links.join(same(new_links, old_links).select("source_party_id"), "source_party_id", "left_anti").select(*links.columns),
        lineage=done.lineage.join(old_golden, "golden_id", "left_anti"),
    )


def after_changes(golden: DataFrame, links: DataFrame, parties: DataFrame, done: Remastered) -> tuple[DataFrame, DataFrame]:
    """The golden and link tables after a change; links of records that are gone leave with them."""
    altered = done.golden.select("golden_id").unionByName(done.gone)
    kept = golden.join(altered, "golden_id", "left_anti").unionByName(done.golden)
    stay = links.join(done.links.select("source_party_id"), "source_party_id", "left_anti").join(
        parties.select(F.col("id").alias("source_party_id")), "source_party_id", "left_semi")
    return kept, stay.select(*links.columns).unionByName(done.links)
