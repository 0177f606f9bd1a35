"""Nearest neighbours by inner product with multiprobe p-stable hashing.

Vectors get one more component that makes them equally long, so the largest
inner product is the smallest distance. Each table hashes a vector by random
projections cut into cells of equal width. A query visits its own cell and
perturbed ones in the order of their estimated success: the smaller the
squared distance from the query's projections to the boundaries crossed, the
sooner. Candidates of all tables are merged and ranked by their exact product.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from goldweave.session import Scratch


@dataclass(frozen=True)
class Settings:
    """``width`` is in units of the longest vector; a query visits ``probes`` cells of each table.

    ``block`` is the size of the parts that index and queries meet in: 16 MB for
    64 components in double precision. The larger it is, the fewer parts give
    a list of their best to each query; choose it smaller for longer vectors.
    """

    k: int = 20
    tables: int = 4
    hashes: int = 4
    width: float = 1.5
    probes: int = 30
    block: int = 32_768
    seed: int = 3


def usable(vector: Column) -> Column:
    """True for vectors that are not zero and hold finite components only."""
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & sound & F.exists(vector, lambda x: x != 0), F.lit(False))


def product(a: Column, b: Column) -> Column:
    """Inner product in double precision."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def _projector(cfg: Settings, longest: float, query: bool):
    def project(column):
        import numpy as np

        n = len(column)
        x = np.asarray(column.flatten(), float).reshape(n, -1)
        lengths = np.linalg.norm(x, axis=1, keepdims=True)
        if query:
            x, last = x / lengths, np.zeros((n, 1))
        else:
            x = x / longest
            last = np.sqrt(np.maximum(0, 1 - (lengths / longest) ** 2))
        rng = np.random.default_rng(cfg.seed)
        directions = rng.normal(size=(cfg.tables * cfg.hashes, x.shape[1] + 1))
        offsets = rng.uniform(0, cfg.width, cfg.tables * cfg.hashes)
        return ((np.concatenate([x, last], 1) @ directions.T + offsets) / cfg.width).reshape(n, cfg.tables, cfg.hashes)

    return project


def _cells(np, whole):
    """One number for each table (the second axis) and cell; tables share no number."""
    table = np.arange(1, whole.shape[1] + 1, dtype=np.uint64).reshape(1, -1, *[1] * (whole.ndim - 3))
    code = np.broadcast_to(table * np.uint64(0xD6E8FEB86659FD93), whole.shape[:-1])
    for j in range(whole.shape[-1]):
        code = (code ^ whole[..., j].astype(np.int64).view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        code ^= code >> np.uint64(29)
    return code.view(np.int64)


def _hasher(cfg: Settings, longest: float):
    project = _projector(cfg, longest, False)

    @F.arrow_udf("array<bigint>")
    def cells(column):
        import numpy as np
        import pyarrow as pa

        if not len(column):
            return pa.array([], pa.list_(pa.int64()))
        code = _cells(np, np.floor(project(column)))
        return pa.ListArray.from_arrays(pa.array(np.arange(len(column) + 1) * cfg.tables, pa.int32()), pa.array(code.ravel()))

    return cells


def _prober(cfg: Settings):
    project = _projector(cfg, 1.0, True)

    @F.arrow_udf("array<bigint>")
    def cells(column):
        """Cells of each table in the order of estimated success, table by table."""
        import numpy as np
        import pyarrow as pa

        if not len(column):
            return pa.array([], pa.list_(pa.int64()))
        x = project(column)
        whole = np.floor(x)
        part = x - whole
        moves = np.array(list(itertools.product((-1, 0, 1), repeat=cfg.hashes)))
        cost = np.stack([part**2, np.zeros_like(part), (1 - part) ** 2], -1)
        total = sum(cost[:, :, j, :][:, :, moves[:, j] + 1] for j in range(cfg.hashes))
        visited = np.argsort(total, axis=2, kind="stable")[:, :, :cfg.probes]
        code = _cells(np, whole[:, :, None, :] + moves[visited])
        each = code.shape[1] * code.shape[2]
        return pa.ListArray.from_arrays(pa.array(np.arange(len(column) + 1) * each, pa.int32()), pa.array(code.ravel()))

    return cells


def _best(cfg: Settings):
    """Ranks the index rows of one unit for each query among those in a cell it visits."""
    # More than are asked for, as a product of matrices may differ in the last digits from the one that ranks in the end.
    spare = cfg.k + 8

    def rank(key, queries, rows):
        import numpy as np
        import pyarrow as pa

        schema = pa.schema([("q", pa.int64()), ("x", pa.int64()), ("s", pa.float64())])
        if not queries.num_rows or not rows.num_rows:
            return schema.empty_table()
        matrix = lambda t: np.asarray(t["v"].combine_chunks().flatten(), float).reshape(t.num_rows, -1)
        q, x = matrix(queries), matrix(rows)
        name, number = queries["q"].to_numpy(), rows["x"].to_numpy()
        visits = queries["cells"].combine_chunks()
        cell = np.asarray(visits.flatten())
        visitor = np.repeat(np.arange(len(q)), np.diff(np.asarray(visits.offsets)))
        order, by_cell = np.argsort(cell, kind="stable"), np.argsort(rows["cell"].to_numpy(), kind="stable")
        cell, visitor, at = cell[order], visitor[order], rows["cell"].to_numpy()[by_cell]
        held = [[] for _ in q]
        for c in np.unique(at):
            who = visitor[slice(*np.searchsorted(cell, [c, c + 1]))]
            what = by_cell[slice(*np.searchsorted(at, [c, c + 1]))]
            for a in range(0, len(who), 1024):
                score = q[who[a:a + 1024]] @ x[what].T
                for i, row in zip(who[a:a + 1024], score):
                    top = np.argpartition(-row, spare)[:spare] if len(row) > spare else np.arange(len(row))
                    held[i].append((row[top], number[what[top]]))
        out = []
        for i, lists in enumerate(held):
            if lists:
                score, found = np.concatenate([s for s, _ in lists]), np.concatenate([f for _, f in lists])
                # A row met in several tables counts once, or its repeats would take the places of others.
                order = np.argsort(-score, kind="stable")
                once = order[np.unique(found[order], return_index=True)[1]]
                score, found = score[once], found[once]
                top = np.argpartition(-score, spare)[:spare] if len(score) > spare else np.arange(len(score))
                out.append((np.full(len(top), name[i]), found[top], score[top]))
        if not out:
            return schema.empty_table()
        return pa.table([np.concatenate(c) for c in zip(*out)], schema=schema)

    return rank


def _meet(index: DataFrame, probes: DataFrame, cfg: Settings, scratch: Scratch, name: str) -> DataFrame:
    """(q, x, s): the best of the cells that each query visits.

    ``index`` has (x, v, cell), ``probes`` (q, v, cells). Small cells are
    gathered into units of about ``block`` rows; larger ones, and units that
    more queries visit, are cut into parts.
    """
    cells = index.groupBy("cell").agg(F.count(F.lit(1)).alias("rows"))
    total = index.count()
    units = max(1, -(-total // cfg.block))
    placed = scratch.save(cells.select(
        "cell", F.ceil(F.col("rows") / F.lit(cfg.block)).cast("int").alias("parts"), F.pmod(F.xxhash64("cell"), F.lit(units)).alias("unit"),
    ), f"{name}-cells")
    visits = probes.select("q", F.explode("cells").alias("cell")).join(placed, "cell").select(
        "q", "cell", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.when(F.col("parts") > 1, F.col("cell")).otherwise(-1).alias("alone"), "unit")
    key = ["unit", "alone", "part"]
    by_unit = scratch.save(visits.groupBy("q", *key).agg(F.collect_list("cell").alias("cells")), f"{name}-visits")
    crowds = by_unit.groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / F.lit(cfg.block)).cast("int").alias("crowds"))
    asking = by_unit.join(crowds, key).select(
        *key, "q", "cells", F.pmod(F.xxhash64("q"), F.col("crowds")).cast("int").alias("crowd")).join(probes.select("q", "v"), "q")
    rows = index.join(placed, "cell").select(
        "x", "v", "cell", "unit", F.when(F.col("parts") > 1, F.col("cell")).otherwise(-1).alias("alone"), F.pmod(F.xxhash64("x"), F.col("parts")).cast("int").alias("part"))
    held = rows.join(crowds, key).select(
        *key, "x", "v", "cell", F.explode(F.sequence(F.lit(0), F.col("crowds") - 1)).alias("crowd"))
    return asking.groupBy(*key, "crowd").cogroup(held.groupBy(*key, "crowd")).applyInArrow(_best(cfg), "q long, x long, s double")


def nearest(
    vectors: DataFrame, queries: Column, scratch: Scratch, cfg: Settings = Settings(), *, id_column: str = "vec_id", vector_column: str = "embedding",
) -> DataFrame:
    """(query_id, rank, neighbour_id, score): for each row that ``queries`` selects, the ``k`` nearest found among all other rows.

    ``score`` is the inner product of the original vectors in double
    precision; ties go to the smaller id. Vectors that are null, zero, or hold
    a null or non-finite component take no part, nor do vectors of another
    length than most have (of equally frequent lengths the smallest counts),
    nor null ids. Equal vectors are hashed and ranked once: no more than k + 1
    of their ids can be among the nearest. Rows equal in id and vector count
    once. A query that meets too few candidates in the cells it visits is
    compared with every row. Empty input gives an empty result; extra columns
    are left out.
    """
    k = cfg.k
    rows = vectors.select(F.col(id_column).alias("id"), F.col(vector_column).alias("v"), queries.alias("asks")).filter(usable(F.col("v")) & F.col("id").isNotNull())
    size = rows.groupBy(F.size("v").alias("n")).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), "n").first()
    dimension = size["n"] if size else 0
    rows = scratch.save(rows.filter(F.size("v") == dimension).groupBy("id", "v").agg(F.max("asks").alias("asks")), "rows")
    ranked = rows.withColumn("n", F.row_number().over(Window.partitionBy("v").orderBy("id"))).filter(F.col("n") <= k + 1)
    distinct = ranked.groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    index = scratch.save(distinct.select(F.monotonically_increasing_id().alias("x"), "v", "ids"), "index")
    asked = scratch.save(rows.filter("asks").select("id", "v").join(index.select("v", "x"), "v").select("id", F.col("x").alias("q")), "asked")
    asking = scratch.save(index.join(asked.select(F.col("q").alias("x")).distinct(), "x", "left_semi").select(F.col("x").alias("q"), "v"), "asking")
    longest = index.agg(F.max(product(F.col("v"), F.col("v")))).first()[0]
    longest = float(longest) ** 0.5 if longest else 1.0

    hashed = scratch.save(index.select("x", "v", F.explode(_hasher(cfg, longest)(F.col("v"))).alias("cell")), "hashed")
    probes = scratch.save(asking.select("q", "v", _prober(cfg)(F.col("v")).alias("cells")), "probes")
    # Only the best of each query go on: more than k + 1 distinct vectors are never needed.
    best = Window.partitionBy("q").orderBy(F.desc("s"), "x")
    shortlist = lambda met: met.groupBy("q", "x").agg(F.max("s").alias("s")).withColumn("n", F.row_number().over(best)).filter(
        F.col("n") <= 2 * k + 8).drop("n")
    kept = scratch.save(shortlist(_meet(hashed, probes, cfg, scratch, "near")), "near")

    # Whoever met fewer candidates than the answer takes is compared with every row.
    total = rows.count()
    enough = kept.select("q", "x").join(index.select("x", F.size("ids").alias("n")), "x").groupBy("q").agg(F.sum("n").alias("n")).filter(
        F.col("n") >= min(k + 1, total))
    lacking = scratch.save(asking.join(enough, "q", "left_anti"), "lacking")
    if not lacking.isEmpty():
        everywhere = index.select("x", "v", F.lit(0).cast("long").alias("cell"))
        rest = _meet(everywhere, lacking.withColumn("cells", F.array(F.lit(0).cast("long"))), cfg, scratch, "rest")
        kept = scratch.save(shortlist(kept.unionByName(rest)), "all")

    exact = kept.select("q", "x").join(index, "x").join(asking.select("q", F.col("v").alias("w")), "q").select(
        "q", product(F.col("w"), F.col("v")).alias("score"), F.explode("ids").alias("id"))
    listed = exact.withColumn("n", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "id"))).filter(F.col("n") <= k + 1).groupBy("q").agg(
        F.array_sort(F.collect_list(F.struct("n", "id", "score"))).alias("near"))
    own = asked.join(listed, "q").select(F.col("id").alias("query_id"), "near")
    others = own.select("query_id", F.slice(F.filter("near", lambda c: c["id"] != F.col("query_id")), 1, k).alias("near"))
    return others.select("query_id", F.posexplode("near").alias("place", "c")).select(
        "query_id", (F.col("place") + 1).cast("int").alias("rank"), F.col("c.id").alias("neighbour_id"), F.col("c.score").alias("score"))
