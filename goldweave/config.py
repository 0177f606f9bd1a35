"""User-tunable settings of the mastering pipeline."""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import combinations

# Source systems, their short labels and their trust ranking.
SOURCE_PRIORITY = {"markit_feed": 3, "dnb_feed": 2, "internal_crm": 1}
SOURCE_LABELS = {"internal_crm": "CRM", "dnb_feed": "DNB", "markit_feed": "Markit"}

# Which sources are asked for a field, best first.
FIELD_SOURCES = {
    "full_name": ("markit_feed", "dnb_feed", "internal_crm"),
    "lei": ("markit_feed",),
    "tax_id": ("internal_crm", "dnb_feed", "markit_feed"),
    "address_line1": ("dnb_feed", "markit_feed", "internal_crm"),
    "city": ("dnb_feed", "markit_feed", "internal_crm"),
    "state": ("dnb_feed", "markit_feed", "internal_crm"),
    "postal_code": ("dnb_feed", "markit_feed", "internal_crm"),
    "email": ("internal_crm",),
    "phone": ("internal_crm", "dnb_feed"),
    "entity_status": ("markit_feed", "dnb_feed", "internal_crm"),
}

# Fields picked by source priority alone.
PRIORITY_FIELDS = ("first_name", "last_name", "date_of_birth", "address_line2", "country", "party_type")

# Allowed codes.
PARTY_TYPES = ("INDIVIDUAL", "ORGANIZATION", "LEGAL_ENTITY")
ENTITY_STATUSES = ("ACTIVE", "INACTIVE", "MERGED", "PENDING")
SOURCE_SYSTEMS = ("internal_crm", "dnb_feed", "markit_feed")

# Match types and lineage event types.
TAX_ID_EXACT = "TAX_ID_EXACT"
LEI_EXACT = "LEI_EXACT"
FUZZY_NAME_ADDRESS = "FUZZY_NAME_ADDRESS"


@dataclass(frozen=True)
class MasteringConfig:
    """Thresholds, weights, priorities and scale limits of one mastering run.

    ``binarize_threshold`` turns each similarity into 0 or 1 at that cut before
    weighting; ``None`` keeps graded similarities.
    """

    source_priority: dict[str, int] = field(default_factory=lambda: dict(SOURCE_PRIORITY))
    field_sources: dict[str, tuple[str, ...]] = field(default_factory=lambda: dict(FIELD_SOURCES))
    priority_fields: tuple[str, ...] = PRIORITY_FIELDS
    compared_sources: tuple[str, ...] = SOURCE_SYSTEMS
    source_labels: dict[str, str] = field(default_factory=lambda: dict(SOURCE_LABELS))

    name_weight: float = 0.50
    address_weight: float = 0.25
    city_weight: float = 0.15
    postal_weight: float = 0.10
    fuzzy_threshold: float = 0.80
    binarize_threshold: float | None = None

    unmatched_pair_score: float = 0.85
    tax_confidence: float = 0.99
    single_survivor: bool = False

    batch_trigger: str = "batch_mastering"
    stream_trigger: str = "event_stream"

    # Rows of one side of a block that meet in one join cell; larger blocks are split into a grid of cells.
    block_cell_rows: int = 1024

    @property
    def priority_rank(self) -> list[str]:
        """Source systems from most to least trusted."""
        return sorted(self.source_priority, key=lambda s: -self.source_priority[s])

    @property
    def source_pairs(self) -> list[tuple[str, str, str]]:
        """(left source, right source, label) of every compared pair."""
        label = lambda s: self.source_labels.get(s, s)
        return [(a, b, f"{label(a)} vs {label(b)}") for a, b in combinations(self.compared_sources, 2)]

    @property
    def needs_place_agreement(self) -> bool:
        """True when name and address alone cannot reach the threshold."""
        return self.name_weight + self.address_weight < self.fuzzy_threshold
