"""Substring search through stored trigrams."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from goldweave.plans.serving import SearchResult, search_filter, search_parties


def _grams(text: Column) -> Column:
    """Distinct runs of three characters, case-folded."""
    folded = F.lower(text)
    starts = F.sequence(F.lit(1), F.char_length(folded) - 2)
    return F.when(F.char_length(folded) > 2, F.array_distinct(F.transform(starts, lambda i: F.substring(folded, i, F.lit(3))))).otherwise(
        F.array().cast("array<string>"))


class NameIndex:
    """Trigrams of golden names below a folder: for each, the golden records whose name holds it, in ranges of the trigram."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def build(self, golden: DataFrame) -> NameIndex:
        postings = golden.select(F.explode(_grams(F.col("full_name"))).alias("gram"), "golden_id")
        postings.repartitionByRange("gram", "golden_id").sortWithinPartitions("gram", "golden_id").write.mode("overwrite").parquet(self.root)
        return self

    def candidates(self, name: str) -> DataFrame | None:
        """golden_id of the records that hold every trigram of a search text; None when it has none, so that all must be read.

        ``%`` and ``_`` are wildcards; the trigrams are those of the text between them.
        """
        parts = [p for p in re.split("[%_]", name) if len(p) > 2]
        if not parts:
            return None
        grams = [r[0] for r in self.spark.createDataFrame([(p,) for p in parts], "p string").select(F.explode(_grams(F.col("p")))).distinct().collect()]
        if not grams:
            return None
        held = self.spark.read.schema("gram string, golden_id string").parquet(self.root).filter(F.col("gram").isin(grams))
        return held.groupBy("golden_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") == len(grams)).select("golden_id")


def search_indexed(golden: DataFrame, index: NameIndex, limit: int = 20, offset: int = 0, name: str | None = None, **conditions: str | None) -> SearchResult:
    """As ``search_parties``: names are found by their trigrams first and then compared; shorter texts read all records."""
    found = index.candidates(name) if name else None
    rows = golden if found is None else golden.join(found, "golden_id", "left_semi")
    return search_parties(search_filter(rows, name=name, **conditions), limit, offset)
