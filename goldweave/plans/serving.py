"""Lookup queries over the mastered tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldweave.functions.text import ignore_case_contains
from goldweave.sources.export import serialize

MAX_PAGE = 100


@dataclass(frozen=True)
class SearchResult:
    total: DataFrame  # one row: total
    page: DataFrame


def search_filter(golden: DataFrame, name: str | None = None, tax_id: str | None = None, lei: str | None = None,
                  state: str | None = None, party_type: str | None = None, status: str | None = None) -> DataFrame:
    """Golden records meeting every given condition; empty arguments are ignored."""
    found = golden
    if name:
        found = found.filter(ignore_case_contains("full_name", name))
    exact = {
        "tax_id": tax_id, "lei": lei, "state": state and state.upper(),
        "party_type": party_type and party_type.upper(), "entity_status": status and status.upper(),
    }
    for column, wanted in exact.items():
        if wanted:
            found = found.filter(F.col(column) == wanted)
    return found


def search_parties(golden: DataFrame, limit: int = 20, offset: int = 0, **conditions: str | None) -> SearchResult:
    """One page of matches by name, and the count of all of them."""
    if not 1 <= limit <= MAX_PAGE or offset < 0:
        raise ValueError(f"limit must be 1..{MAX_PAGE} and offset at least 0")
    found = search_filter(golden, **conditions)
    page = found.orderBy(F.col("full_name").asc_nulls_last(), F.col("golden_id")).offset(offset).limit(limit)
    return SearchResult(found.agg(F.count(F.lit(1)).alias("total")), page)


def party(golden: DataFrame, golden_id: str) -> DataFrame:
    """A single golden record; no row when it is unknown."""
    return serialize(golden.filter(F.col("golden_id") == golden_id))


def party_lineage(golden: DataFrame, lineage: DataFrame, golden_id: str) -> DataFrame:
    """Audit trail of a known golden record, newest first."""
    known = golden.filter(F.col("golden_id") == golden_id).select("golden_id")
    return (
        lineage.filter(F.col("golden_id") == golden_id)
        .join(known, "golden_id", "left_semi")
        .orderBy(F.col("event_at").desc_nulls_first(), "event_type", "event_id")
    )


def party_sources(links: DataFrame, parties: DataFrame, golden_id: str) -> DataFrame:
    """Source records behind a golden record, survivors first."""
    mine = links.filter(F.col("golden_id") == golden_id).select(
        F.col("source_party_id").alias("id"), "is_survivor", "match_score"
    )
    wanted = ["id", "source_system", "source_party_id", "party_type", "full_name", "tax_id", "entity_status"]
    extra = [c for c in ("ingested_at",) if c in parties.columns]
    return (
        mine.join(parties.select(*wanted, *extra), "id")
        .select(*wanted, "is_survivor", "match_score", *extra)
        .orderBy(F.col("is_survivor").desc_nulls_first(), F.col("source_system").asc_nulls_last(), "id")
    )


def active_parties(golden: DataFrame, limit: int = 100) -> DataFrame:
    """References to the first active golden records by id."""
    return (
        golden.filter("entity_status = 'ACTIVE'").select("golden_id", "party_type", "full_name", "tax_id")
        .orderBy("golden_id").limit(limit)
    )
