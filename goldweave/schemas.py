"""Schemas of record."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, B = T.StringType(), T.LongType(), T.BooleanType()
D, TS, SCORE = T.DateType(), T.TimestampType(), T.DecimalType(5, 4)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# Business columns shared by source and golden records, in table order.
PARTY_COLUMNS = [
    "party_type", "full_name", "first_name", "last_name", "date_of_birth", "tax_id", "lei",
    "address_line1", "address_line2", "city", "state", "postal_code", "country", "email", "phone", "entity_status",
]
ADDRESS_COLUMNS = ["address_line1", "address_line2", "city", "state", "postal_code", "country"]

_party = {name: (D if name == "date_of_birth" else S) for name in PARTY_COLUMNS}

SOURCE_PARTIES = _struct(
    id=L, source_system=S, source_party_id=S, **_party, raw_payload=S, ingested_at=TS, updated_at=TS
)
GOLDEN_PARTIES = _struct(golden_id=S, **_party, confidence_score=SCORE, created_at=TS, updated_at=TS)
PARTY_CLUSTERS = _struct(golden_id=S, source_party_id=L, is_survivor=B, match_score=SCORE, linked_at=TS)
PARTY_LINEAGE = _struct(golden_id=S, event_type=S, changed_fields=S, triggered_by=S, event_id=S, event_at=TS)
DQ_RESULTS = _struct(
    run_id=S, source_system=S, expectation_suite=S, total_records=L, passed_records=L, failed_records=L,
    pass_rate=T.DoubleType(), record_check_rate=T.DoubleType(), details=S, run_at=TS,
)
# Longest text each column may hold.
LENGTH_LIMITS = {
    "source_system": 50, "source_party_id": 100, "party_type": 30, "full_name": 255, "first_name": 100,
    "last_name": 100, "tax_id": 20, "lei": 20, "address_line1": 255, "address_line2": 100, "city": 100,
    "state": 50, "postal_code": 20, "country": 3, "email": 150, "phone": 30, "entity_status": 20,
}
EVENT = _struct(
    event_id=S, event_type=S, golden_id=S, party_type=S, source_system=S, timestamp=S, payload=S
)
