"""Small column helpers shared by every stage."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters a text strip removes (Unicode white space).
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(value: Column | str) -> Column:
    """Text without leading and trailing white space of any kind."""
    return F.btrim(F.col(value) if isinstance(value, str) else value, F.lit(WHITE_SPACE))


def clean_key(value: Column | str) -> Column:
    """Comparison form of a text: missing becomes '', lower case, stripped."""
    column = F.col(value) if isinstance(value, str) else value
    return strip(F.lower(F.coalesce(column, F.lit(""))))


def usable(value: Column | str) -> Column:
    """Stripped text, or NULL when it is missing, blank or the literal ``nan``."""
    text = (F.col(value) if isinstance(value, str) else value).cast("string")
    return F.when((strip(text) != "") & (text != "nan"), strip(text))


def filled(value: Column | str) -> Column:
    """Text key, or NULL when it is missing or empty."""
    return F.nullif(F.col(value) if isinstance(value, str) else value, F.lit(""))


def natural_key(system: Column | str = "source_system", party: Column | str = "source_party_id") -> Column:
    """``system|party``; NULL when either part is."""
    return F.concat(system, F.lit("|"), party)


def uuid_of(key: Column) -> Column:
    """UUID-shaped identifier derived from a key."""
    return F.regexp_replace(
        F.substring(F.sha2(key, 256), 1, 32), r"^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"
    )


def confidence_band(score: Column | str) -> Column:
    """Label of the confidence histogram bucket."""
    value = F.col(score) if isinstance(score, str) else score
    return (
        F.when(value >= 0.99, "0.99-1.00 (Exact)")
        .when(value >= 0.90, "0.90-0.99 (High)")
        .when(value >= 0.80, "0.80-0.90 (Good)")
        .otherwise("Below 0.80 (Low)")
    )


def age_hours(moment: Column, as_of: Column) -> Column:
    """Hours from ``moment`` to ``as_of``."""
    return (F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(moment.cast("timestamp"))) / F.lit(3_600_000_000.0)


def ignore_case_contains(value: Column | str, part: str) -> Column:
    """Case-insensitive partial match; ``%`` and ``_`` in ``part`` stay wildcards."""
    return (F.col(value) if isinstance(value, str) else value).ilike(f"%{part}%")
