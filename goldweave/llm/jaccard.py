"""N-gram Jaccard self-join by MinHash banding.

Texts of equal words form a class. Each class gets a MinHash signature cut
into bands; classes that share a band's hash are candidates, and candidates
are verified on their full n-gram sets. Pairs are never listed: a task
verifies a block of a bucket with matrix products and gives each class its
number of links and one tie to its group.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldweave.llm.common import alnum_words, let, sieve, word_hashes
from goldweave.operators.components import connected_components
from goldweave.session import Scratch


@dataclass(frozen=True)
class Settings:
    """Two texts are linked when the Jaccard similarity of their word n-gram sets is ``similarity`` or more.

    A pair just that similar becomes a candidate with probability ``recall``.
    Large buckets are verified in parts of ``block`` texts and ``grams``
    n-grams on average; one text is never cut.
    """

    words: int = 5
    similarity: float = 0.8
    recall: float = 0.999
    hashes: int = 64
    block: int = 1024
    grams: int = 1 << 21

    @property
    def banding(self) -> tuple[int, int]:
        """(bands, rows): the most rows for which the bands that the recall takes fit into the hashes."""
        fitting = [(1, 1)]
        for rows in range(1, self.hashes + 1):
            bands = max(1, math.ceil(math.log(1 - self.recall) / math.log1p(-self.similarity**rows))) if self.similarity < 1 else 1
            if bands * rows <= self.hashes:
                fitting.append((bands, rows))
        return fitting[-1]


def _mixed(x):
    import numpy as np

    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(29))


def shingles(hashes, words: int):
    """(n-gram hashes, first n-gram of each text, n-grams of each text) of a list column of word hashes.

    A text of fewer words, but not none, is one n-gram.
    """
    import numpy as np

    offsets = np.asarray(hashes.offsets).astype(np.int64)
    flat = np.asarray(hashes.flatten()).view(np.uint64)
    begin, size = offsets[:-1] - offsets[0], np.diff(offsets)
    count = np.where(size > 0, np.maximum(size - words + 1, 1), 0)
    first = np.cumsum(count) - count
    rows = np.repeat(np.arange(len(size)), count)
    at = np.repeat(begin - first, count) + np.arange(count.sum())
    left = np.minimum(size, words)[rows]
    padded = np.concatenate([flat, np.zeros(words, np.uint64)])
    grams = left.astype(np.uint64)
    for k in range(words):
        grams = np.where(k < left, grams * np.uint64(0x9E3779B97F4A7C15) + padded[at + k], grams)
    return _mixed(grams), first, count


def _signer(cfg: Settings):
    bands, rows = cfg.banding

    @F.arrow_udf("array<bigint>")
    def sign(hashes):
        import numpy as np
        import pyarrow as pa

        grams, first, count = shingles(hashes, cfg.words)
        some = np.flatnonzero(count)
        rng = np.random.default_rng(11)
        odd = rng.integers(0, 1 << 63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        shift = rng.integers(0, 1 << 63, bands * rows, dtype=np.uint64)
        signature = np.zeros((len(some), bands), np.uint64)
        if len(some):
            for j in range(bands * rows):
                low = np.minimum.reduceat(grams * odd[j] + shift[j], first[some])
                signature[:, j // rows] = _mixed(signature[:, j // rows] * np.uint64(0x100000001B3) + low)
        offsets = np.concatenate([[0], np.cumsum(np.where(count > 0, bands, 0))])
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(signature.ravel().view(np.int64)))

    return sign


def _key(hashes):
    """128 bits that name a sequence of words."""
    return F.concat_ws("-", F.hex(F.xxhash64(hashes)), F.hex(F.xxhash64(F.reverse(hashes))))


def _verifier(cfg: Settings):
    """Verifies the pairs of one block and gives the linked classes their links and the root of their group in the block."""

    def verify(unit, table):
        import numpy as np
        import pyarrow as pa

        band, low, high = unit[0].as_py(), unit[2].as_py(), unit[3].as_py()
        keys, side = table["key"].to_pylist(), table["chunk"].to_numpy()
        weight = table["n"].to_numpy()
        signature = np.stack([np.asarray(b) for b in table["bands"].to_pylist()])
        sets = [np.frombuffer(s, "<u8") for s in table["grams"].to_pylist()]
        n, sizes = len(keys), np.array([len(s) for s in sets])
        pairs = ~np.eye(n, dtype=bool) if low == high else side[:, None] != side[None, :]
        for b in range(band):  # a pair is verified in its first common band only
            pairs &= signature[:, b][:, None] != signature[:, b][None, :]
        common = np.zeros((n, n), np.float32)
        _, gram, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        owner, shared = np.repeat(np.arange(n), sizes), seen[gram] > 1
        column = (np.cumsum(seen > 1) - 1)[gram[shared]]
        order = np.argsort(column, kind="stable")
        column, owner = column[order], owner[shared][order]
        width = 4096
        for at in range(0, int(column[-1]) + 1 if len(column) else 0, width):
            part = slice(*np.searchsorted(column, [at, at + width]))
            some, row = np.unique(owner[part], return_inverse=True)
            dense = np.zeros((len(some), width), np.float32)
            dense[row, column[part] - at] = 1
            common[np.ix_(some, some)] += dense @ dense.T
        union = sizes[:, None] + sizes[None, :] - common.astype(np.int64)
        linked = pairs & (common >= cfg.similarity * union - 1e-6)
        links = linked @ weight
        root = np.arange(n)
        while True:
            lower = np.minimum(root, np.where(linked, root[None, :], n).min(1))
            if (lower == root).all():
                break
            root = lower
        out = np.flatnonzero(linked.any(1))
        return pa.table({
            "key": pa.array([keys[i] for i in out], pa.string()), "links": pa.array(links[out].astype(np.int64)),
            "root": pa.array([keys[root[i]] for i in out], pa.string()),
        })

    return verify


def jaccard_join(
    docs: DataFrame, scratch: Scratch, cfg: Settings = Settings(), *, id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """One row per document: doc_id, words_key, class_id, copy_id, n_links, kept.

    ``class_id`` is the smallest id among the documents that links join,
    directly or through others; ``copy_id`` the smallest among those of the
    same words; ``n_links`` the number of other documents that the document
    is linked with, copies included; ``kept`` is true for the rows of one
    document of each class. Words are runs of letters and digits in lower
    case; fewer than ``words`` of them are one n-gram. A text without words,
    null or not, has no n-grams and no links: it is a class by itself, and
    kept. Rows with equal ids are documents of their own for the links, and
    null ids name a class only if it has no others. A text of any length is
    read whole. Empty input gives an empty result; extra columns are left out.
    """
    bands, _ = cfg.banding
    work = Scratch(scratch.spark, "jaccard")
    texts = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    base = texts.select("doc_id", word_hashes(alnum_words(F.col("text"))).alias("w"))
    signed = scratch.save(base.select(
        "doc_id", F.when(F.size("w") > 0, _key(F.col("w"))).alias("key"), F.size("w").alias("words"), _signer(cfg)(F.col("w")).alias("bands")), "signed")
    classes = work.save(signed.filter("key IS NOT NULL").groupBy("key").agg(
        F.min("doc_id").alias("copy_id"), F.count(F.lit(1)).alias("n"), F.first("words").alias("words"), F.first("bands").alias("bands")), "classes")

    spread = classes.select("key", F.col("words").cast("long").alias("grams"), F.posexplode("bands").alias("band", "hash"))
    several = spread.groupBy("band", "hash").agg(F.count(F.lit(1)).alias("members"), F.sum("grams").alias("grams")).filter("members > 1")
    buckets = work.save(spread.drop("grams").join(several, ["band", "hash"]), "buckets")
    # A bucket whose classes all agree on an earlier band holds no new pair.
    ends = [f(F.get("bands", F.lit(b))).alias(f"{name}{b}") for b in range(bands) for name, f in (("low", F.min), ("high", F.max))]
    spans = buckets.join(classes.select("key", "bands"), "key").groupBy("band", "hash").agg(*ends)
    agreed = reduce(lambda a, b: a | b, [(F.col("band") > b) & (F.col(f"low{b}") == F.col(f"high{b}")) for b in range(bands)])
    fresh = work.save(buckets.join(spans.filter(~agreed).select("band", "hash"), ["band", "hash"], "left_semi"), "fresh")

    # Full n-gram sets of one document of each candidate class; only the texts that may be wanted are shuffled.
    wanted = work.save(fresh.select("key").distinct().join(classes, "key").select("key", "n", F.col("bands").alias("b"), "copy_id"), "wanted")
    near, _ = sieve(texts, F.col("doc_id"), wanted.select("copy_id"))
    worded = near.join(wanted, near["doc_id"].eqNullSafe(wanted["copy_id"])).select("key", "n", "b", word_hashes(alnum_words(F.col("text"))).alias("w"))

    @F.arrow_udf("binary")
    def gram_set(hashes):
        import numpy as np
        import pyarrow as pa

        grams, first, count = shingles(hashes, cfg.words)
        return pa.array([np.unique(grams[a:a + k]).tobytes() for a, k in zip(first, count)], pa.binary())

    single = worded.filter(_key(F.col("w")) == F.col("key")).groupBy("key").agg(F.first("n").alias("n"), F.first("b").alias("bands"), F.first("w").alias("w"))
    sets = work.save(single.select("key", "n", "bands", gram_set(F.col("w")).alias("grams")), "sets")

    parts = F.ceil(F.greatest(F.col("members") / F.lit(cfg.block), F.least(F.col("members"), F.col("grams") / F.lit(cfg.grams)))).cast("int")
    placed = fresh.withColumn("parts", parts).withColumn("chunk", F.pmod(F.xxhash64("key", "band"), F.col("parts")).cast("int"))
    units = placed.select("band", "hash", "key", "chunk", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")).select(
        "band", "hash", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"), "chunk", "key")
    verified = work.save(units.join(sets, "key").groupBy("band", "hash", "low", "high").applyInArrow(
        _verifier(cfg), T.StructType().add("key", "string").add("links", "long").add("root", "string")), "verified")

    ties = verified.filter("key <> root").select(F.col("key").alias("u"), F.col("root").alias("v")).distinct()
    groups = connected_components(ties, work, "groups")
    links = verified.groupBy("key").agg(F.sum("links").alias("links"))
    known = classes.select("key", "n", "copy_id").join(groups.select(F.col("node").alias("key"), "component"), "key", "left").join(
        links, "key", "left").withColumn("component", F.coalesce("component", "key"))
    named = known.groupBy("component").agg(F.min(F.struct(F.col("copy_id").isNull(), "copy_id", "key")).alias("m")).select(
        "component", F.col("m.copy_id").alias("class_id"), F.col("m.key").alias("kept_key"))
    info = scratch.save(known.join(named, "component").select(
        "key", "copy_id", "class_id", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), (F.col("key") == F.col("kept_key")).alias("named")
    ), "info")
    work.close()
    return signed.select("doc_id", F.col("key").alias("words_key")).join(info, F.col("words_key") == F.col("key"), "left").select(
        "doc_id", "words_key", F.when(F.col("words_key").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(F.col("words_key").isNull(), F.col("doc_id")).otherwise(F.col("copy_id")).alias("copy_id"),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.when(F.col("words_key").isNull(), True).otherwise(F.col("named") & F.col("doc_id").eqNullSafe(F.col("copy_id"))).alias("kept"),
    )


def drop_linked(docs: DataFrame, joined: DataFrame, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents that ``joined`` keeps: one of each class, and every text without words. Of repeated rows one stays.

    Ids that occur once, in a document that is kept, decide nothing: only the others' documents are looked at and shuffled.
    """
    asked = joined.filter("words_key IS NOT NULL").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("kept")).alias("gone"))
    suspects, clear = sieve(docs, F.col(id_column), asked.filter("gone > 0 OR n > 1").select("doc_id"))
    hashes = word_hashes(alnum_words(F.col(text_column)))
    keyed = suspects.withColumn("__key", let(hashes, lambda h: F.when(F.size(h) > 0, _key(h))))
    kept = joined.filter("kept AND words_key IS NOT NULL").groupBy(F.col("doc_id").alias("__id"), F.col("words_key").alias("__kept")).agg(
        F.count(F.lit(1)).alias("__rows"))
    matched = keyed.filter("__key IS NOT NULL").join(kept, F.col(id_column).eqNullSafe(F.col("__id")) & (F.col("__key") == F.col("__kept")))
    if kept.filter("__rows > 1").isEmpty():
        once = matched
    else:
        once = matched.filter("__rows = 1").unionByName(matched.filter("__rows > 1").dropDuplicates(["__id", "__kept"]))
    return once.drop("__id", "__kept", "__rows").unionByName(keyed.filter("__key IS NULL")).drop("__key").unionByName(clear)
