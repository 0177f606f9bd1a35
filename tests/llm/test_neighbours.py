import numpy as np
from pyspark.sql import functions as F

from goldweave.llm import queries
from goldweave.llm.common import scratch
from goldweave.llm.neighbours import Settings, nearest


def plain(rows, asks, k):
    sound = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(v).all() and np.any(v)]
    sizes = [len(v) for _, v in sound]
    usual = min(set(sizes), key=lambda n: (-sizes.count(n), n)) if sizes else 0
    unique = {(i, v.tobytes()): (i, v) for i, v in sound if len(v) == usual}
    out = {}
    for i, v in unique.values():
        if asks(i):
            near = sorted(((-sum(a * b for a, b in zip(v, w)), j) for j, w in unique.values() if j != i))[:k]
            out[i] = [(j, -s) for s, j in near]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        assert r["rank"] == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((r.neighbour_id, r.score))
    return out


def test_few_vectors_give_all_candidates_in_order(spark):
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(size=4).astype("f4").tolist()) for i in range(12)]
    rows += [(100 + i, rows[3][1]) for i in range(40)]  # ties beyond k
    rows += [(60, None), (61, [0.0] * 4), (62, [1.0, None, 0.0, 2.0]), (63, [1.0, float("nan"), 0.0, 2.0]), (64, [float("inf")] * 4), (65, [1.0, 2.0]), (None, [1.0] * 4), (3, rows[3][1]), (20, [9.0, 9.0, 1.0, 0.0])]
    df = spark.createDataFrame([(i, v, "c", 1) for i, v in rows], "vec_id long, embedding array<float>, q string, score int")
    for cfg in (Settings(k=5), Settings(k=5, block=3, probes=2)):
        got = found(nearest(df, F.col("vec_id") % 20 == 0, scratch(spark, "test"), cfg))
        expected = plain(rows, lambda i: i % 20 == 0, 5)
        assert got.keys() == expected.keys()
        if cfg.probes > 2:
            for q, near in expected.items():
                assert [j for j, _ in got[q]] == [j for j, _ in near]
                assert np.allclose([s for _, s in got[q]], [s for _, s in near])
        assert all(len(near) == 5 for near in got.values())


def test_fewer_candidates_than_asked_for(spark):
    rows = [(0, [1.0, 0.0]), (1, [-1.0, 0.1]), (2, [0.0, -5.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert [j for j, _ in found(nearest(df, F.col("vec_id") == 0, scratch(spark, "test")))[0]] == [2, 1]
    assert nearest(df.limit(0), F.col("vec_id") == 0, scratch(spark, "test")).count() == 0
    assert nearest(df.limit(1), F.col("vec_id") == 0, scratch(spark, "test")).count() == 0


def test_recall_against_every_row(spark):
    sf = "/root/testdata/sf0.1"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows], float)
    got = {q: {j for j, _ in near} for q, near in found(queries.op6_multiprobe_neighbours(spark, sf).withColumnRenamed("vec_id", "neighbour_id")).items()}
    hits = total = 0
    for q in np.flatnonzero(ids % 20 == 0):
        score = x @ x[q]
        score[q] = -np.inf
        best = set(ids[np.argsort(-score)[:20]].tolist())
        hits, total = hits + len(best & got[int(ids[q])]), total + 20
    assert len(got) == (ids % 20 == 0).sum() and hits >= 0.9 * total


def recall(spark, x, cfg):
    """Share of the true nearest found, and of the queries that were compared with every row."""
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(4)
    work = scratch(spark, "test")
    got = found(nearest(df, F.col("vec_id") % 20 == 0, work, cfg))
    hits = 0
    for q in range(0, len(x), 20):
        score = x @ x[q]
        score[q] = -np.inf
        hits += len(set(np.argsort(-score)[:cfg.k].tolist()) & {j for j, _ in got[q]})
    asked = len(range(0, len(x), 20))
    assert len(got) == asked
    return hits / (asked * cfg.k), work.read("lacking").count() / asked


def test_recall_of_the_hashing_alone(spark):
    """One unit and many, and hardly a query answered by comparing it with every row."""
    given = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").orderBy("vec_id").collect()
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(60, 64))
    clustered = np.repeat(centres, 50, 0) + 0.3 * rng.normal(size=(3000, 64))
    clustered /= np.linalg.norm(clustered, axis=1, keepdims=True)
    x = np.array([r.embedding for r in given], float)
    for x, cfg in ((x, Settings()), (x, Settings(block=500)), (clustered, Settings(block=500))):
        share, fallback = recall(spark, x, cfg)
        assert share >= 0.9 and fallback <= 0.02
