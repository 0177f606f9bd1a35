"""Exact top-k search by integer inner product.

Queries are packed into blocks and all rows into shards, each one binary
value. Every block meets every shard in one task, which multiplies them tile
by tile and keeps each query's best; the lists of the shards are merged in a
tree.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldweave.session import Scratch


@dataclass(frozen=True)
class Settings:
    """``k`` rows for each query; components become floor(``scale`` * x).

    ``values`` bounds the components of a shard and of a block, ``tile`` the
    queries and rows of one matrix product, ``fan`` the lists that one merge
    step joins. None of the three changes the result.
    """

    k: int = 20
    scale: int = 64
    values: int = 1 << 20
    tile: int = 2048
    fan: int = 16


# Fixed value: a score below all others, for places that no row takes.
_NONE = -(1 << 63)


def _sound(vector: Column) -> Column:
    """Neither null nor holding a null or non-finite component."""
    return vector.isNotNull() & F.coalesce(F.forall(vector, lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False))), F.lit(False))


def _packer(batches):
    """All rows of a partition as one row: ids, row numbers and lengths, then the components, ordered by length and id."""
    import numpy as np
    import pyarrow as pa
    from pyspark import TaskContext

    held = [b for b in batches if b.num_rows]
    if not held:
        return
    table = pa.Table.from_batches(held).combine_chunks()
    ids, rows, vectors = table["id"].chunk(0), table["row"].to_numpy(), table["v"].chunk(0)
    missing = ids.is_null().to_numpy(zero_copy_only=False)
    number = ids.fill_null(0).to_numpy()
    offsets = np.asarray(vectors.offsets).astype(np.int64)
    offsets, lengths, flat = offsets[:-1] - offsets[0], np.diff(offsets), np.asarray(vectors.flatten())
    order = np.lexsort((rows, number, missing, lengths))
    values = np.concatenate([flat[offsets[i]:offsets[i] + lengths[i]] for i in order])
    blob = lambda x: pa.array([np.ascontiguousarray(x).tobytes()], pa.binary())
    yield pa.RecordBatch.from_pydict({
        "part": pa.array([TaskContext.get().partitionId()], pa.int32()), "ids": blob(number[order].astype("<i8")), "missing": blob(missing[order]),
        "rows": blob(rows[order].astype("<i8")), "lengths": blob(lengths[order].astype("<i8")), "values": blob(values.astype(f"<f{flat.dtype.itemsize}")),
        "width": pa.array([flat.dtype.itemsize], pa.int32()),
    })


_PACKED = "part int, ids binary, missing binary, rows binary, lengths binary, values binary, width int"


def _unpacked(table):
    """Rows of a packed value by their length: (length, ids, missing, row numbers, matrix)."""
    import numpy as np

    row = {name: table[name][0].as_py() for name in table.column_names}
    ids, rows, lengths = (np.frombuffer(row[n], "<i8") for n in ("ids", "rows", "lengths"))
    missing, values = np.frombuffer(row["missing"], bool), np.frombuffer(row["values"], f"<f{row['width']}")
    ends = np.concatenate([[0], np.cumsum(lengths)])
    for length in np.unique(lengths):
        a, b = np.searchsorted(lengths, [length, length + 1])
        yield int(length), ids[a:b], missing[a:b], rows[a:b], values[ends[a]:ends[b]].reshape(b - a, length)


def _whole(matrix, scale: int):
    """floor(scale * x), and the vectors' lengths in space."""
    import numpy as np

    with np.errstate(over="ignore"):
        whole = np.floor(matrix.astype(np.float64) * scale)
        return whole, np.sqrt(np.einsum("ij,ij->i", whole, whole))


def _exact(left, right, scale: int):
    """Inner products of components too large for floating point, in whole numbers; beyond a long, the nearest one."""
    import math

    import numpy as np

    as_int = np.frompyfunc(lambda x: int(x) * scale if abs(x) >= 1 << 53 else math.floor(x * scale), 1, 1)
    a, b = (as_int(m.astype(np.float64)).astype(object) for m in (left, right))
    products = a @ b.T if a.shape[1] else np.zeros((len(a), len(b)), object)
    return np.clip(products, _NONE + 1, (1 << 63) - 1).astype(np.int64)


def _scores(left, right, scale: int):
    """Exact scores of all pairs, as floats where every partial sum is a float without rounding."""
    import numpy as np

    (a, na), (b, nb) = _whole(left, scale), _whole(right, scale)
    bound = (na.max() if len(na) else 0) * (nb.max() if len(nb) else 0)
    if bound < 1 << 23:
        return a.astype(np.float32) @ b.astype(np.float32).T
    if bound < 1 << 52:
        return a @ b.T
    # Only rows that take it leave floating point.
    big_a, big_b = ~(na * (nb.min() if len(nb) else 0) < 1 << 52), ~(nb * (na.min() if len(na) else 0) < 1 << 52)
    fits = lambda x, y: (x.max() if len(x) else 0) * (y.max() if len(y) else 0) < 1 << 52
    scores = np.zeros((len(a), len(b)), np.int64)
    if fits(na[~big_a], nb[~big_b]):
        scores[np.ix_(~big_a, ~big_b)] = a[~big_a] @ b[~big_b].T
    else:
        scores[np.ix_(~big_a, ~big_b)] = _exact(left[~big_a], right[~big_b], scale)
    scores[big_a] = _exact(left[big_a], right, scale)
    scores[np.ix_(~big_a, big_b)] = _exact(left[~big_a], right[big_b], scale)
    return scores


def _lowest(scores):
    import numpy as np

    return -np.inf if scores.dtype.kind == "f" else _NONE


def _best_of(scores, k: int):
    """Positions and scores of each query's k best in a tile, equal scores by position."""
    import numpy as np

    low = _lowest(scores)
    n, m = scores.shape
    if m <= k:
        place = np.broadcast_to(np.arange(m), (n, m))
        found = scores
    else:
        limit = np.partition(scores, m - k, axis=1)[:, m - k, None]
        above, level = scores > limit, scores == limit
        open_places = k - above.sum(1, keepdims=True)
        taken = above | (level & (np.cumsum(level, axis=1, dtype=np.int32) <= open_places))
        place = np.nonzero(taken)[1].reshape(n, k)
        found = np.take_along_axis(scores, place, axis=1)
    none = found == low
    return place, np.where(none, _NONE, np.where(none, 0, found).astype(np.int64))


def _searcher(cfg: Settings):
    def search(key, queries, shard):
        import numpy as np
        import pyarrow as pa

        out = {"row": [], "id": [], "missing": [], "near": []}
        shards = list(_unpacked(shard)) if shard.num_rows else []
        for q_length, q_ids, q_missing, q_rows, q_matrix in _unpacked(queries) if queries.num_rows else []:
            for q in range(0, len(q_ids), cfg.tile):
                part = slice(q, q + cfg.tile)
                asked, n = q_rows[part], len(q_rows[part])
                score = np.full((n, cfg.k), _NONE, np.int64)
                name, nameless = np.zeros((n, cfg.k), np.int64), np.zeros((n, cfg.k), bool)
                for length, ids, missing, rows, matrix in shards:
                    common = min(length, q_length)  # a shorter vector goes on with zeros
                    for s in range(0, len(ids), cfg.tile):
                        cut = slice(s, s + cfg.tile)
                        scores = _scores(q_matrix[part, :common], matrix[cut, :common], cfg.scale)
                        by_row = np.argsort(rows[cut])
                        at = np.minimum(np.searchsorted(rows[cut], asked, sorter=by_row), len(by_row) - 1)
                        own = np.flatnonzero(rows[cut][by_row[at]] == asked)
                        scores[own, by_row[at[own]]] = _lowest(scores)
                        rising = np.flatnonzero(scores.max(1) >= score[:, -1])
                        if not len(rising):
                            continue
                        place, found = _best_of(scores[rising], cfg.k)
                        both = np.concatenate([score[rising], found], 1)
                        names = np.concatenate([name[rising], ids[cut][place]], 1)
                        gone = np.concatenate([nameless[rising], missing[cut][place]], 1)
                        order = np.lexsort((names, gone, ~both), axis=-1)[:, :cfg.k]  # ~x falls as x rises and cannot overflow
                        take = lambda x: np.take_along_axis(x, order, axis=1)
                        score[rising], name[rising], nameless[rising] = take(both), take(names), take(gone)
                some = score != _NONE
                down = pa.StructArray.from_arrays([
                    pa.array(~score[some], pa.int64()), pa.array(nameless[some], pa.bool_()), pa.array(name[some], pa.int64(), mask=nameless[some]),
                ], ["down", "nameless", "id"])
                ends = np.concatenate([[0], np.cumsum(some.sum(1))]).astype(np.int32)
                out["near"].append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), down))
                out["row"].append(asked)
                out["id"].append(q_ids[part])
                out["missing"].append(q_missing[part])
        if not out["row"]:
            return pa.table({"row": pa.array([], pa.int64()), "query_id": pa.array([], pa.int64()), "node": pa.array([], pa.int32()), "near": pa.array([], _near())})
        rows = np.concatenate(out["row"])
        return pa.table({
            "row": pa.array(rows, pa.int64()), "query_id": pa.array(np.concatenate(out["id"]), pa.int64(), mask=np.concatenate(out["missing"])),
            "node": pa.array(np.full(len(rows), key[1].as_py()), pa.int32()), "near": pa.concat_arrays(out["near"]),
        })

    return search


def _near():
    import pyarrow as pa

    return pa.list_(pa.struct([("down", pa.int64()), ("nameless", pa.bool_()), ("id", pa.int64())]))


def _packed(rows: DataFrame, scratch: Scratch, name: str, cfg: Settings) -> tuple[DataFrame, int]:
    """Rows dealt in turn to as many parts as their components take, each part one row; and the number of parts."""
    values = rows.agg(F.sum(F.size("v") + F.lit(1)).alias("n")).first()["n"] or 0
    parts = max(1, -(-values // cfg.values))
    return scratch.save(rows.select("id", "row", "v").repartition(parts).mapInArrow(_packer, _PACKED), name), parts


def exact_top_k(
    vectors: DataFrame, queries: Column, scratch: Scratch, cfg: Settings = Settings(), *, id_column: str = "vec_id", vector_column: str = "embedding",
) -> DataFrame:
    """(query_id, rank, neighbour_id, score): for each row that ``queries`` selects, the ``k`` rows of highest score among all others.

    The score is the inner product of the vectors floor(scale * x), exact in
    whole numbers; one that no long can hold counts as the nearest long. Ties
    go to the smaller id, null ids last. Vectors that are null or hold a null
    or non-finite component take no part; an empty vector scores 0, and of two
    lengths the shorter vector goes on with zeros, however long the other is.
    Rows are told apart by themselves, not by id: repeated rows and rows of
    equal ids are queries and candidates of their own. A null in ``queries``
    selects nothing. Empty input gives an empty result; extra columns are left
    out.

    Work is queries times rows, as the task demands. A task holds a block and
    a shard of ``values`` components each and the products of one tile; rows
    are dealt out in turn, so neither equal ids nor equal vectors make a part
    larger.
    """
    sound = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).alias("v"), F.coalesce(queries, F.lit(False)).alias("asks")).filter(_sound(F.col("v")))
    # Written once, so that every later read sees the same row numbers.
    rows = scratch.save(sound.withColumn("row", F.monotonically_increasing_id()), "rows")
    shards, n_shards = _packed(rows, scratch, "shards", cfg)
    blocks, n_blocks = _packed(rows.filter("asks"), scratch, "blocks", cfg)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    asking = blocks.withColumnRenamed("part", "block").withColumn("shard", every(n_shards)).groupBy("block", "shard")
    held = shards.withColumnRenamed("part", "shard").withColumn("block", every(n_blocks)).groupBy("block", "shard")
    near = "array<struct<down: bigint, nameless: boolean, id: bigint>>"
    lists = scratch.save(asking.cogroup(held).applyInArrow(_searcher(cfg), f"row long, query_id long, node int, near {near}"), "lists")
    while n_shards > 1:
        node = F.floor(F.col("node") / cfg.fan).cast("int").alias("node")
        best = F.slice(F.array_sort(F.flatten(F.collect_list("near"))), 1, cfg.k).alias("near")
        lists, n_shards = lists.groupBy("row", "query_id", node).agg(best), -(-n_shards // cfg.fan)
    return lists.select("query_id", F.posexplode("near").alias("place", "c")).select(
        "query_id", (F.col("place") + 1).cast("int").alias("rank"), F.col("c.id").alias("neighbour_id"), F.bitwise_not("c.down").alias("score"))
