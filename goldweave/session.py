"""Session settings and written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(app_name: str = "goldweave", master: str | None = None, **conf: str) -> SparkSession:
    """Session with adaptive execution on and the time zone fixed to UTC."""
    builder = SparkSession.builder.appName(app_name)
    # Recording the Python call site of every column expression slows plan building.
    builder = builder.config("spark.python.sql.dataFrameDebugging.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return tune(builder.getOrCreate())


def tune(spark: SparkSession, measured_broadcasts: bool = True) -> SparkSession:
    """Runtime settings the plans rely on; cluster sizing stays with the caller.

    Skewed joins may be split even when that costs one more shuffle, because
    the joins here are many-to-one lookups whose hot key can hold a third of
    the rows.

    With ``measured_broadcasts`` joins by key are not broadcast. Planned sizes
    are those of the compressed files of intermediate tables, which can hold a
    hundred times as much; and both sides are shuffled by the time their sizes
    are measured, while each of the many small sides would still cost the
    driver a whole page of memory.
    """
    if measured_broadcasts:
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", "true")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables.

    Taken from ``spark.checkpoint.dir``. Only a local master without that
    setting gets a folder of its own, since executors elsewhere could not read it.
    """
    context = spark.sparkContext
    configured = spark.conf.get(_CHECKPOINT_KEY, None) or context.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {_CHECKPOINT_KEY} to a folder every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="goldweave-"))
    return context.getCheckpointDir()


class Scratch:
    """One run's folder of written intermediate tables under the shared checkpoint folder.

    Each table is written once and read back, which cuts the lineage and
    survives the loss of executors. ``codec`` is Parquet's: zstd writes about
    half of the bytes of JSON texts that snappy does.
    """

    def __init__(self, spark: SparkSession, label: str = "run", codec: str = "snappy"):
        self.spark, self.codec = spark, codec
        self.root = f"{scratch_root(spark)}/goldweave/{label}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").option("compression", self.codec).parquet(self.path(name))
        return self.read(name, df)

    def read(self, name: str, like: DataFrame | None = None) -> DataFrame:
        reader = self.spark.read
        if like is not None:
            reader = reader.schema(like.schema)
        return reader.parquet(self.path(name))

    def drop(self, name: str) -> None:
        """Delete one of this run's own tables once nothing reads it any more."""
        self._delete(self.path(name))

    def close(self) -> None:
        self._delete(self.root)

    def _delete(self, path: str) -> None:
        jvm = self.spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        target.getFileSystem(conf).delete(target, True)
