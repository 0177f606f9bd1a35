"""Feed files: scan, raw landing and mapping to the common party columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldweave.functions.text import strip
from goldweave.schemas import LENGTH_LIMITS

# Source system, default party type and file of each feed.
FEEDS = {
    "internal_crm": ("INDIVIDUAL", "internal_crm/individuals.csv"),
    "dnb_feed": ("ORGANIZATION", "dnb_feed/organizations.csv"),
    "markit_feed": ("LEGAL_ENTITY", "markit_feed/legal_entities.csv"),
}
# Columns a feed carries beyond the shared ones.
FEED_ONLY = {
    "internal_crm": ("first_name", "last_name", "date_of_birth", "email", "phone"),
    "dnb_feed": ("phone",),
    "markit_feed": ("lei",),
}

LINE_ORDER = "line_order"
_OPTIONAL = ("first_name", "last_name", "date_of_birth", "lei", "email", "phone")


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(target)
    return found is not None and len(found) > 0


def read_feed(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame | None:
    """CSV with a header as text columns, missing values as ''; None when there is no file.

    ``line_order`` orders the rows as they stand in the files. ``multiline``
    allows line breaks inside quotes, at the price of one task per file.
    """
    if not path_exists(spark, path):
        return None
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multiline).option("encoding", "UTF-8")
    # The first file's header, read once, as an all-text schema: a file whose header differs fails instead of shifting its columns.
    columns = reader.csv(path).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    rows = reader.option("enforceSchema", False).schema(schema).csv(path)
    order = F.struct(
        F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id().alias("n")
    )
    return rows.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in rows.columns], order.alias(LINE_ORDER))


def land_raw(spark: SparkSession, path: str, zone: str, source: str) -> str | None:
    """Copies a feed's lines unchanged to ``<zone>/<source>/<file name>``; None when there is no file."""
    if not path_exists(spark, path):
        return None
    target = f"{zone}/{source}/{path.rstrip('/').rsplit('/', 1)[-1]}"
    spark.read.option("lineSep", "\n").text(path).write.mode("overwrite").option("lineSep", "\n").text(target)
    return target


def normalize(rows: DataFrame, source: str) -> DataFrame:
    """Feed rows in the common party columns, with the whole row as JSON.

    Blank optional values become NULL; other texts are stripped and may stay
    ''. Country, status and type defaults apply only when the column is absent.
    """
    party_type, _ = FEEDS[source]
    own = FEED_ONLY[source]
    columns = [c for c in rows.columns if c != LINE_ORDER]

    def text(name: str, default: str = "") -> Column:
        return strip(name) if name in columns else F.lit(default)

    def raw(name: str, default: str) -> Column:
        return F.col(name) if name in columns else F.lit(default)

    optional = {c: (F.nullif(text(c), F.lit("")) if c in own else F.lit(None).cast("string")) for c in _OPTIONAL}
    for name in ("first_name", "last_name"):
        if name in own:
            optional[name] = text(name)
    born = F.nullif(raw("date_of_birth", ""), F.lit("")) if "date_of_birth" in own else F.lit(None).cast("string")
    order = [F.col(LINE_ORDER)] if LINE_ORDER in rows.columns else []
    return rows.select(
        F.lit(source).alias("source_system"),
        raw("source_party_id", "").alias("source_party_id"),
        raw("party_type", party_type).alias("party_type"),
        text("full_name").alias("full_name"),
        optional["first_name"].alias("first_name"),
        optional["last_name"].alias("last_name"),
        F.try_to_date(born, "yyyy-MM-dd").alias("date_of_birth") if "date_of_birth" in own else F.lit(None).cast("date").alias("date_of_birth"),
        text("tax_id").alias("tax_id"),
        optional["lei"].alias("lei"),
        text("address_line1").alias("address_line1"),
        F.nullif(text("address_line2"), F.lit("")).alias("address_line2"),
        text("city").alias("city"),
        text("state").alias("state"),
        text("postal_code").alias("postal_code"),
        text("country", "USA").alias("country"),
        optional["email"].alias("email"),
        optional["phone"].alias("phone"),
        text("entity_status", "ACTIVE").alias("entity_status"),
        F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("raw_payload"),
        *order,
    )


def normalize_crm(rows: DataFrame) -> DataFrame:
    return normalize(rows, "internal_crm")


def normalize_dnb(rows: DataFrame) -> DataFrame:
    return normalize(rows, "dnb_feed")


def normalize_markit(rows: DataFrame) -> DataFrame:
    return normalize(rows, "markit_feed")


NORMALIZERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "internal_crm": normalize_crm, "dnb_feed": normalize_dnb, "markit_feed": normalize_markit,
}


def feed_rejects(rows: DataFrame, normalized: DataFrame) -> DataFrame:
    """Rows the table of record would refuse, counted per reason: bad dates and texts over their limit."""
    too_long = [
        F.count_if(F.length(c) > limit).alias(f"{c}_too_long") for c, limit in LENGTH_LIMITS.items() if c in normalized.columns
    ]
    lengths = normalized.agg(*too_long)
    names = lengths.columns
    found = lengths.select(
        F.explode(F.array(*[F.struct(F.lit(n).alias("reason"), F.col(n).alias("rows")) for n in names])).alias("r")
    ).select("r.*")
    if "date_of_birth" in rows.columns:
        bad = (F.col("date_of_birth") != "") & F.try_to_date("date_of_birth", "yyyy-MM-dd").isNull()
        found = found.unionByName(rows.agg(F.count_if(bad).alias("rows")).select(F.lit("date_of_birth_unreadable").alias("reason"), "rows"))
    return found.filter("rows > 0")


def write_csv(rows: DataFrame, path: str, columns: list[str]) -> None:
    """CSV with a header and a fixed column list; other columns are dropped, absent ones left empty."""
    wanted = [(F.col(c) if c in rows.columns else F.lit(None).cast("string")).alias(c) for c in columns]
    plain = {"header": True, "escape": '"', "emptyValue": "", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    rows.select(*wanted).write.mode("overwrite").options(**plain).csv(path)
