"""Turns of conversations in order, and digests of ordered rows, also where one conversation holds most rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from goldweave.session import Scratch


def _numbered(batches):
    """Rows with their part and their place among the part's rows of the same conversation; rows come sorted by conversation."""
    import numpy as np
    import pyarrow as pa
    from pyspark import TaskContext

    part, last, count = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        ids = batch["conv_id"]
        values, missing = ids.fill_null(0).to_numpy(zero_copy_only=False), ids.is_null().to_numpy(zero_copy_only=False)
        new = np.ones(n, bool)
        new[1:] = (values[1:] != values[:-1]) | (missing[1:] != missing[:-1])
        new[0] = last != (missing[0], values[0])
        at = np.arange(n)
        start = np.maximum.accumulate(np.where(new, at, 0 if new[0] else -count))
        place = at - start
        last, count = (missing[-1], values[-1]), int(place[-1]) + 1
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(np.full(n, part, np.int32)), pa.array(place, pa.int64())], names=[*batch.schema.names, "part", "place"])


def placed(rows: DataFrame, scratch: Scratch, *keep: Column | str) -> DataFrame:
    """``keep`` of ``rows`` (conv_id, turn, role, text) with conv_id and the row's ``position`` in its conversation.

    The order is turn, nulls first, then role and text. Rows are dealt out by
    ranges of it, so a long conversation lies in several parts; each part
    numbers its rows, and what lies in further parts is moved behind the parts
    before. Null ids are one conversation.
    """
    ranges = rows.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, 64)).sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", *keep)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranges.schema)
    # Written once, so that every later read sees the same parts.
    ordered = scratch.save(ranges.mapInArrow(_numbered, f"{fields}, part int, place long"), "ranges")
    runs = ordered.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # Only the last conversation of a part goes on in the next: no more rows than parts.
    moved = scratch.save(runs.select(F.col("conv_id").alias("c"), F.col("part").alias("p"), F.sum("n").over(before).alias("shift")).filter("shift > 0"), "moved")
    joined = ordered.join(moved, ordered["conv_id"].eqNullSafe(moved["c"]) & (ordered["part"] == moved["p"]), "left")
    return joined.withColumn("position", F.col("place") + F.coalesce("shift", F.lit(0))).drop("place", "part", "c", "p", "shift")


def turn_name(role: str = "role", text: str = "text") -> Column:
    """128 bits that name a role and a text."""
    return F.unhex(F.md5(F.concat(*[F.encode(part, "UTF-8") for part in (F.char_length(role).cast("string"), F.lit(":"), F.col(role), F.col(text))])))


def _digester(separator: str):
    def digest(batches):
        import hashlib

        import pyarrow as pa

        glue = separator.encode()
        key, running = None, None
        for batch in batches:
            kind, keys, digests = batch.schema.field("key").type, [], []
            for k, piece in zip(batch["key"].to_pylist(), batch["piece"].to_pylist()):
                if running is None or k != key:
                    if running is not None:
                        keys.append(key)
                        digests.append(running.hexdigest())
                    key, running = k, hashlib.sha256(piece.encode())
                else:
                    running.update(glue)
                    running.update(piece.encode())
            yield pa.RecordBatch.from_pydict({"key": pa.array(keys, kind), "sha": pa.array(digests, pa.string())})
        if running is not None:
            yield pa.RecordBatch.from_pydict({"key": pa.array([key], kind), "sha": pa.array([running.hexdigest()], pa.string())})

    return digest


def joined_digests(rows: DataFrame, key: Column, piece: Column, separator: str, *order: str) -> DataFrame:
    """(key, sha): SHA-256 of each key's pieces in order, joined by a separator.

    A digest is made in one go, so a key's pieces pass through one task, in
    sorted order and a batch at a time; they are never held together.
    """
    named = rows.select(key.alias("key"), piece.alias("piece"), *[F.col(c).alias(f"by_{c}") for c in order])
    ordered = named.repartition("key").sortWithinPartitions("key", *[f"by_{c}" for c in order]).select("key", "piece")
    return ordered.mapInArrow(_digester(separator), f"key {named.schema['key'].dataType.simpleString()}, sha string")
