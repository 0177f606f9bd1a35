"""Stored Parquet tables: batches that are appended, and rows by key that are written over."""

from __future__ import annotations

from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldweave.sources.feeds import path_exists


class AppendTable:
    """Append-only table kept as ``<root>/batch=N`` folders; writing a batch again replaces it.

    Batches are numbers, or texts such as run ids; only numbered ones can be cut off by ``before``.
    ``order`` is a column whose ranges the files of a batch hold in order.
    """

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, order: str | None = None):
        self.spark, self.root, self.schema, self.order = spark, root.rstrip("/"), schema, order

    def append(self, df: DataFrame, batch: int | str) -> None:
        cast = df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in self.schema])
        if self.order:
            cast = cast.repartitionByRange(self.order).sortWithinPartitions(self.order)
        cast.write.mode("overwrite").option("compression", "snappy").parquet(f"{self.root}/batch={quote(str(batch), safe='')}")

    def published(self) -> list[int]:
        """Numbers of the committed batches that have one, ascending."""
        jvm = self.spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(self.root)
        done = target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).globStatus(jvm.org.apache.hadoop.fs.Path(f"{self.root}/batch=*/_SUCCESS")) or []
        names = [s.getPath().getParent().getName().split("=", 1)[1] for s in done]
        return sorted(int(n) for n in names if n.lstrip("-").isdigit())

    def batch(self, number: int | str) -> DataFrame:
        """One batch; only its folder is read."""
        return self.spark.read.schema(self.schema).parquet(f"{self.root}/batch={quote(str(number), safe='')}")

    def read(self, before: int | None = None) -> DataFrame:
        """All batches, or those numbered below ``before``."""
        if not path_exists(self.spark, f"{self.root}/batch=*"):
            return self.spark.createDataFrame([], self.schema)
        with_batch = T.StructType([*self.schema.fields, T.StructField("batch", T.StringType() if before is None else T.LongType())])
        rows = self.spark.read.schema(with_batch).parquet(self.root)
        return (rows if before is None else rows.filter(rows["batch"] < before)).drop("batch")

    def read_from(self, first: int) -> DataFrame:
        """Batches numbered ``first`` and higher; only their folders are read."""
        if not path_exists(self.spark, f"{self.root}/batch=*"):
            return self.spark.createDataFrame([], self.schema)
        with_batch = T.StructType([*self.schema.fields, T.StructField("batch", T.LongType())])
        rows = self.spark.read.schema(with_batch).parquet(self.root)
        return rows.filter(rows["batch"] >= first).drop("batch")


# Batches that one merged change set of the first level spans; each further level spans as many of the level below.
SPAN = 8


class KeyedTable:
    """Table of one row a key: published bases, and on top of them the change sets of batches, all in the same key buckets.

    A base lies in ``base/version=N.upto=M``: version N, which holds every
    batch below M. The rows that batch K wrote lie in ``changes/span=K-K``,
    those of several batches, the newest of each key, in ``span=K-L``. Readers
    take the row of the newest batch that the base does not hold, else the
    base's, so a batch, an upsert and a mastering run in any order lose
    nothing. Writing a version or a batch again replaces it.

    Folders have one subfolder for each bucket of ``by``, a key column. A read
    by keys lists the buckets first and opens only those. How many there are is
    settled by the first write; ``buckets`` says it for a new table. ``found_by`` names
    columns for which bases have Bloom filters, so that an equality on one of
    them passes over the row groups without the value.
    """

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, key: tuple[str, ...], by: str | None = None, buckets: int = 32,
                 found_by: tuple[str, ...] = ()):
        self.spark, self.root, self.schema, self.key, self.by, self._new_buckets = spark, root.rstrip("/"), schema, key, by or key[0], buckets
        self.found_by = found_by
        added = [T.StructField("changed_in", T.LongType()), T.StructField("gone", T.BooleanType())]
        self._bucket = T.StructField("bucket", T.IntegerType())
        self._log_schema = T.StructType([*schema.fields, *added, self._bucket])

    def _place(self, path: str):
        """A path and its file system."""
        target = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return target, target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    @property
    def buckets(self) -> int:
        pattern, fs = self._place(f"{self.root}/buckets=*")
        there = fs.globStatus(pattern) or []
        return int(there[0].getPath().getName().split("=")[1]) if len(there) else self._new_buckets

    def _settle_buckets(self) -> None:
        path, fs = self._place(f"{self.root}/buckets={self.buckets}")
        fs.mkdirs(path)

    def bucket(self, value: str) -> Column:
        return F.pmod(F.xxhash64(F.col(value).cast("string")), F.lit(self.buckets)).cast("int")

    def _published(self, folder: str) -> list[str]:
        """Names of the committed folders below one of the table's."""
        pattern, fs = self._place(f"{self.root}/{folder}/*/_SUCCESS")
        done = fs.globStatus(pattern) or []
        return [s.getPath().getParent().getName() for s in done]

    def versions(self) -> list[tuple[int, int]]:
        """(version, batches below it that it holds) of every published base, ascending."""
        return sorted(tuple(int(part.split("=")[1]) for part in name.split(".")) for name in self._published("base"))

    def latest(self, before: int | None = None) -> tuple[int, int] | None:
        """Newest base, or the newest that holds only batches below ``before``."""
        found = [v for v in self.versions() if before is None or v[1] <= before]
        return found[-1] if found else None

    def base_path(self, version: tuple[int, int]) -> str:
        return f"{self.root}/base/version={version[0]}.upto={version[1]}"

    def write(self, df: DataFrame, version: int, upto: int) -> DataFrame:
        """Publishes a base; files hold ranges of the key in order, so a lookup reads few row groups of one bucket."""
        self._settle_buckets()
        cast = df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in self.schema]).withColumn("bucket", self.bucket(self.by))
        ordered = cast.repartitionByRange("bucket", *self.key).sortWithinPartitions("bucket", *self.key)
        filters = {f"parquet.bloom.filter.enabled#{c}": "true" for c in self.found_by}
        if filters:
            filters["parquet.bloom.filter.adaptive.enabled"] = "true"
        ordered.write.mode("overwrite").options(**filters).partitionBy("bucket").parquet(self.base_path((version, upto)))
        return self.read(version=(version, upto))

    def change(self, df: DataFrame, batch: int, gone: DataFrame | None = None) -> None:
        """Records what a batch writes, and the keys of the rows that it takes away."""
        rows = df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in self.schema]).withColumns({"changed_in": F.lit(batch).cast("long"), "gone": F.lit(False)})
        if gone is not None:
            empty = [F.col(f.name) if f.name in self.key else F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema]
            left = gone.select(*self.key).distinct().select(*empty, F.lit(batch).cast("long").alias("changed_in"), F.lit(True).alias("gone"))
            rows = rows.unionByName(left.join(rows.select(*self.key), list(self.key), "left_anti").select(*rows.columns))
        self._write_span(rows, batch, batch)

    def _write_span(self, rows: DataFrame, first: int, last: int) -> None:
        self._settle_buckets()
        placed = rows.withColumn("bucket", self.bucket(self.by)).repartition("bucket")
        placed.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.root}/changes/span={first}-{last}")

    def spans(self, first: int = 0, before: int | None = None) -> list[tuple[int, int]]:
        """The fewest published change sets that hold the batches from ``first`` on, or those of them below ``before``."""
        listed = [tuple(map(int, name.split("=")[1].split("-"))) for name in self._published("changes")]
        taken: list[tuple[int, int]] = []
        for a, b in sorted((s for s in listed if s[0] >= first and (before is None or s[1] < before)), key=lambda s: (s[0], -s[1])):
            if not taken or a > taken[-1][1]:
                taken.append((a, b))
        return taken

    def _log(self, spans: list[tuple[int, int]]) -> DataFrame:
        if not spans:
            return self.spark.createDataFrame([], self._log_schema)
        paths = [f"{self.root}/changes/span={a}-{b}" for a, b in spans]
        return self.spark.read.schema(self._log_schema).option("basePath", f"{self.root}/changes").parquet(*paths).select(*self._log_schema.names)

    def _newest(self, log: DataFrame) -> DataFrame:
        row = F.max_by(F.struct(*[c for c in log.columns if c != "bucket"]), "changed_in").alias("row")
        return log.groupBy(*[F.col(k).alias(f"_{k}") for k in self.key]).agg(row).select("row.*")

    def read(self, before: int | None = None, keys: DataFrame | None = None, version: tuple[int, int] | None = None, values: list | None = None) -> DataFrame:
        """State after all batches, or after those below ``before``, on the newest base that allows it or on the one given.

        ``keys``, one column with values of ``by``, keeps the rows of those
        values; only their buckets are read, before any version is resolved.
        A few ``values`` given as such are also pushed down to the row groups.
        """
        chosen = version or self.latest(before)
        log = self._log(self.spans(chosen[1] if chosen else 0, before))
        with_bucket = T.StructType([*self.schema.fields, self._bucket])
        base = self.spark.createDataFrame([], with_bucket) if chosen is None else self.spark.read.schema(with_bucket).parquet(self.base_path(chosen))
        if values is not None:
            keys = self.spark.createDataFrame([(v,) for v in values], T.StructType([self.schema[self.by]]))
            base, log = (rows.filter(F.col(self.by).isin(values)) for rows in (base, log))
        if keys is not None:
            wanted = keys.select(F.col(keys.columns[0]).alias(self.by)).distinct()
            # At most as many values as the table has buckets.
            numbers = sorted(r[0] for r in wanted.select(self.bucket(self.by)).distinct().collect())
            base, log = (rows.filter(F.col("bucket").isin(numbers)).join(wanted, self.by, "left_semi") for rows in (base, log))
        newest = self._newest(log)
        kept = base.join(newest.select(*self.key), list(self.key), "left_anti").select(*self.schema.names)
        return kept.unionByName(newest.filter("NOT gone").select(*self.schema.names))

    def merge(self, first: int, last: int) -> None:
        """One change set for the batches from ``first`` to ``last``: only rows that they changed are read and written."""
        parts = [s for s in self.spans(first, last + 1) if s != (first, last)]
        if len(parts) > 1:
            self._write_span(self._newest(self._log(parts)), first, last)

    def settle(self, batch: int) -> None:
        """Merges change sets after a batch, so that a reader opens a number of them that grows with the logarithm of the batches."""
        width = SPAN
        while (batch + 1) % width == 0:
            self.merge(batch + 1 - width, batch)
            width *= SPAN

    def retire(self, keep: int = 2) -> None:
        """Deletes all but the newest bases, and the change sets that the oldest one left holds."""
        versions = self.versions()
        oldest = versions[-keep:][0][1] if versions else 0
        old = [self.base_path(v) for v in versions[:-keep]]
        for name in self._published("changes"):
            if int(name.split("-")[-1]) < oldest:
                old.append(f"{self.root}/changes/{name}")
        for name in old:
            path, fs = self._place(name)
            fs.delete(path, True)
