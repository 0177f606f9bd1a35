"""Text columns and settings the operators of this package share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from goldweave.session import Scratch, tune

# The ASCII letters that case folding maps.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

# Fixed value: ASCII characters that are in no word.
NO_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

# Rows of an Arrow batch. A row may hold a whole long document, so batches are far below Spark's default of 10,000 rows.
BATCH_ROWS = 512


def settle(spark: SparkSession) -> SparkSession:
    """Session settings the operators rely on. They stay set in the caller's session, the rows of an Arrow batch among them."""
    tune(spark, measured_broadcasts=False)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def scratch(spark: SparkSession, label: str) -> Scratch:
    """Written intermediate tables in the shared folder."""
    return Scratch(settle(spark), label)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return settle(spark).read.parquet(f"{sf_dir}/{table}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def fold_word(word: Column) -> Column:
    """A-Z in lower case, other letters as they are; words in plain ASCII take the fast path."""
    return F.when(F.octet_length(word) == F.char_length(word), F.lower(word)).otherwise(F.translate(word, UPPER, LOWER))


def pieces(text: Column, separators: str) -> Column:
    """Non-empty parts of a text between separators; none for a null text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), separators), "")


def alnum_words(text: Column) -> Column:
    """Runs of letters and digits, every non-ASCII character counting as a letter, A-Z lower-cased."""
    return F.transform(pieces(text, NO_WORD), fold_word)


def spaced_words(text: Column) -> Column:
    """Runs of anything but ASCII white space, A-Z lower-cased."""
    return F.transform(pieces(text, r"[\x20\x09-\x0D]+"), fold_word)


def word_hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def fold_of(doc_id: Column, folds: int) -> Column:
    """Remainder of the CRC-32 of an id written as text; null ids count as the text ''."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % F.lit(folds)


# Bits of a sieve, and how many of them a row of it holds: 4,096 rows of 1 kB, whatever is put into it.
SIEVE_BITS, SIEVE_ROW = 1 << 25, 1 << 13


def sieve(rows: DataFrame, key: Column, wanted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows`` in two parts: those whose key may be among the values of the one column ``wanted``, and those whose key is not.

    The hashes of the wanted values are a bit set of fixed size, which is
    broadcast, so neither part is shuffled. The more values, the more rows are
    in the first part without need; it is for the caller to join it exactly.
    Nulls are values like others.
    """
    place = lambda value: F.pmod(F.xxhash64(value), F.lit(SIEVE_BITS))
    at = place(F.col(wanted.columns[0]))
    bit = lambda at: (at % 64).cast("int")
    word = lambda at: F.floor(at % SIEVE_ROW / 64).cast("int")
    words = wanted.select(F.floor(at / SIEVE_ROW).alias("__sieve_row"), word(at).alias("__sieve_word"), bit(at).alias("__sieve_bit")).groupBy("__sieve_row", "__sieve_word").agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("__sieve_bit"))).alias("__sieve_bits"))
    every = F.transform(F.sequence(F.lit(0), F.lit(SIEVE_ROW // 64 - 1)), lambda w: F.coalesce(F.element_at("__sieve_map", w), F.lit(0).cast("long")))
    bits = words.groupBy("__sieve_row").agg(F.map_from_entries(F.collect_list(F.struct("__sieve_word", "__sieve_bits"))).alias("__sieve_map")).select("__sieve_row", every.alias("__sieve_words"))
    marked = rows.withColumn("__sieve_at", place(key)).withColumn("__sieve_row", F.floor(F.col("__sieve_at") / SIEVE_ROW)).join(F.broadcast(bits), "__sieve_row", "left")
    shifted = F.call_function("shiftright", F.get("__sieve_words", word(F.col("__sieve_at"))), bit(F.col("__sieve_at")))
    held = F.coalesce(shifted.bitwiseAND(F.lit(1)) == 1, F.lit(False))
    part = lambda condition: marked.filter(condition).select(*rows.columns)
    return part(held), part(~held)
