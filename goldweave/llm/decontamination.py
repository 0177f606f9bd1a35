"""Benchmark decontamination by winnowed fingerprints.

Of every window of ``window`` words the smallest hash of its k-grams is kept,
with k about half a window. Two texts that share a window of words share the
k-grams in it and so its smallest hash: joining kept hashes finds every shared
window. The join's hits are then extended to the windows around them, which
are compared word for word.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldweave.llm.common import NO_WORD, alnum_words, let, pieces, sieve, word_hashes
from goldweave.session import Scratch


def _grams(hashes: Column, k: int) -> Column:
    """Hash of each run of k words; the length is part of the hash."""
    return let(hashes, lambda h: F.when(
        F.size(h) >= k, F.transform(F.sequence(F.lit(0), F.size(h) - F.lit(k)), lambda i: F.xxhash64(F.lit(k), *[F.get(h, i + j) for j in range(k)]))
    ).otherwise(F.array().cast("array<bigint>")))


def _winnowed(hashes: Column, window: int) -> Column:
    """For each window of words, the smallest hash of its k-grams."""
    k = max(1, window // 2)
    width = window - k + 1
    smallest = lambda g, i: F.least(*[F.get(g, i + j) for j in range(width)]) if width > 1 else F.get(g, i)
    return let(_grams(hashes, k), lambda g: F.when(
        F.size(g) >= width, F.transform(F.sequence(F.lit(0), F.size(g) - width), lambda i: smallest(g, i))
    ).otherwise(F.array().cast("array<bigint>")))


def _prints(hashes: Column, length: int, window: int) -> Column:
    """One fingerprint for each run of ``length`` words: winnowed for whole windows, the run's own hash for the windows of short items."""
    return _winnowed(hashes, window) if length == window else _grams(hashes, length)


def benchmark_windows(items: DataFrame, *, window: int = 10, id_column: str = "item_id", text_column: str = "text") -> DataFrame:
    """(length, words, print, items): each distinct window of the items, its fingerprint and the sorted ids of the items that hold it.

    An item of fewer words than a window is one window; an item without words has none.
    """
    worded = items.select(F.col(id_column).alias("item"), alnum_words(F.col(text_column)).alias("w")).filter(F.size("w") > 0)
    sized = worded.withColumn("length", F.least(F.size("w"), F.lit(window)))
    lengths = range(1, window + 1)
    hashes = word_hashes(F.col("w"))
    prints = reduce(lambda other, n: F.when(F.col("length") == n, _prints(hashes, n, window)).otherwise(other), lengths, F.array().cast("array<bigint>"))
    texts = F.transform(F.sequence(F.lit(1), F.size("w") - F.col("length") + 1), lambda i: F.array_join(F.slice("w", i, F.col("length")), " "))
    return sized.select("item", "length", F.explode(F.arrays_zip(texts.alias("words"), prints.alias("print"))).alias("x")).groupBy(
        "length", F.col("x.words").alias("words"), F.col("x.print").alias("print")
    ).agg(F.sort_array(F.collect_set("item")).alias("items"))


def contamination(
    docs: DataFrame, items: DataFrame, scratch: Scratch, *, window: int = 10,
    id_column: str = "doc_id", text_column: str = "text", item_id_column: str = "item_id", item_text_column: str = "text",
) -> DataFrame:
    """One row per document: doc_id, text_key, n_words, n_hit, spans, items.

    ``spans`` are the (start, length) of the windows found, in words from 0;
    ``n_hit`` counts the words inside them; ``items`` are the sorted ids of the
    benchmark items that hold one. A null or empty text has no words and no
    hit. Documents with equal id and text give equal rows, as often as they
    occur. Items with a null id mark words but are not listed. Without
    documents the result is empty, without items nothing is hit. Extra columns
    of either table are left out. ``text_key`` tells texts of one id apart.
    """
    base = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"), F.xxhash64(F.col(text_column)).alias("text_key"))
    windows = scratch.save(benchmark_windows(items, window=window, id_column=item_id_column, text_column=item_text_column), "windows")
    # At most `window` values: which lengths of window there are.
    lengths = sorted(r["length"] for r in windows.select("length").distinct().collect()) or [window]
    prints = scratch.save(windows.select("print").distinct(), "prints")

    hashes = word_hashes(alnum_words(F.col("text")))
    every = let(hashes, lambda h: F.array_distinct(F.concat(*[_prints(h, n, window) for n in lengths])))
    touched = base.select("doc_id", "text_key", F.explode(every).alias("print")).join(prints, "print", "left_semi")
    hits = scratch.save(touched.groupBy("doc_id", "text_key").agg(F.collect_set("print").alias("hits")), "hits")

    # Extension: of the documents with a hit, the windows that hold one, compared as words.
    key = ["doc_id", "text_key"]
    near = base.alias("b").join(hits.alias("h"), F.col("b.doc_id").eqNullSafe(F.col("h.doc_id")) & (F.col("b.text_key") == F.col("h.text_key")))
    words = near.select("b.doc_id", "b.text_key", "hits", alnum_words(F.col("b.text")).alias("w")).withColumn("wh", word_hashes(F.col("w")))

    def around(n: int) -> Column:
        starts = let(_prints(F.col("wh"), n, window), lambda p: F.filter(
            F.sequence(F.lit(0), F.size(p) - 1, F.lit(1)), lambda i: F.array_contains(F.col("hits"), F.get(p, i))))
        listed = F.transform(starts, lambda i: F.struct(
            i.alias("start"), F.lit(n).alias("length"), F.array_join(F.slice("w", i + 1, n), " ").alias("words")))
        return F.when(F.size("w") >= n, listed).otherwise(F.array().cast("array<struct<start:int,length:int,words:string>>"))

    candidates = words.select(*key, F.explode(F.array_distinct(F.concat(*[around(n) for n in lengths]))).alias("x")).select(*key, "x.start", "x.length", "x.words")
    found = candidates.join(windows.select("length", "words", "items"), ["length", "words"]).groupBy(*key).agg(
        F.array_sort(F.collect_set(F.struct("start", "length"))).alias("spans"), F.collect_set("items").alias("items"),
    )
    covered = F.size(F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(s["start"], s["start"] + s["length"] - 1)))))
    found = scratch.save(found.select(
        *key, "spans", covered.cast("long").alias("n_hit"), F.array_sort(F.array_distinct(F.array_compact(F.flatten("items")))).alias("items")
    ), "found")
    counted = base.select(*key, F.size(pieces(F.col("text"), NO_WORD)).cast("long").alias("n_words"))
    joined = counted.alias("c").join(
        found.alias("f"), F.col("c.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("c.text_key") == F.col("f.text_key")), "left")
    none = lambda name: F.array().cast(found.schema[name].dataType)
    return joined.select(
        "c.doc_id", "c.text_key", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("spans", none("spans")).alias("spans"), F.coalesce("items", none("items")).alias("items"),
    )


def drop_contaminated(docs: DataFrame, found: DataFrame, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents without a hit. Those with one go as a whole, as their remainder still tells the answers' context."""
    bad = found.filter("n_hit > 0").select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key")).distinct()
    suspects, clear = sieve(docs, F.col(id_column), bad.select("__id"))
    kept = suspects.join(bad, F.col(id_column).eqNullSafe(F.col("__id")) & (F.xxhash64(F.col(text_column)) == F.col("__key")), "left_anti")
    return kept.unionByName(clear)
