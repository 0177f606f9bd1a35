"""Zone listings and file previews."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldweave.sources.feeds import path_exists

# Storage zones.
ZONES = ("raw", "curated", "golden")


def zone_files(spark: SparkSession, root: str, zones: tuple[str, ...] = ZONES) -> DataFrame:
    """Key, size and time of every file below ``<root>/<zone>``; contents are never read."""
    parts = []
    for zone in zones:
        if not path_exists(spark, f"{root}/{zone}"):
            continue
        listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{root}/{zone}")
        parts.append(listed.select(
            F.lit(zone).alias("zone"),
            F.regexp_extract("path", f"/{zone}/(.*)$", 1).alias("key"),
            F.col("length").alias("size_bytes"),
            F.round(F.col("length") / 1024, 2).alias("size_kb"),
            F.col("modificationTime").alias("last_modified"),
        ))
    if not parts:
        return spark.createDataFrame([], "zone string, key string, size_bytes bigint, size_kb double, last_modified timestamp")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.filter("NOT endswith(key, '/')")


def exchange(spark: SparkSession, new: str, place: str, before: str) -> None:
    """Puts the folder ``new`` in ``place`` and what was there ``before``; of what was before that, nothing stays."""
    jvm = spark.sparkContext._jvm
    new_path, path, old = (jvm.org.apache.hadoop.fs.Path(p) for p in (new, place, before))
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.delete(old, True)
    if fs.exists(path):
        fs.rename(path, old)
    if not fs.rename(new_path, path):
        raise OSError(f"could not rename {new} to {place}")


def zone_totals(files: DataFrame) -> DataFrame:
    """File count and size per zone, then for all zones together (``zone`` = TOTAL)."""
    return files.rollup("zone").agg(F.count(F.lit(1)).alias("file_count"), F.sum("size_bytes").alias("b")).select(
        F.coalesce("zone", F.lit("TOTAL")).alias("zone"), "file_count", F.round(F.coalesce("b", F.lit(0)) / 1024, 2).alias("total_size_kb")
    )


@dataclass(frozen=True)
class Preview:
    format: str  # csv | parquet | unsupported
    columns: list[str]
    rows: DataFrame | None
    total_rows: DataFrame | None


def preview(spark: SparkSession, path: str, rows: int = 10) -> Preview:
    """First rows, columns and row count of a CSV or Parquet file; other types are ``unsupported``."""
    kind = path.lower().rsplit(".", 1)[-1]
    if kind == "csv":
        df = spark.read.option("header", True).option("escape", '"').csv(path)
    elif kind == "parquet":
        df = spark.read.parquet(path)
    else:
        return Preview("unsupported", [], None, None)
    total = df.agg(F.count(F.lit(1)).alias("total_rows"))
    return Preview(kind, df.columns, as_text(df.limit(rows)), total)


def as_text(df: DataFrame) -> DataFrame:
    """Every column as text, missing values as ''."""
    return df.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in df.columns])
