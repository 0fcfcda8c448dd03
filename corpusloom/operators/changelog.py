"""A keyed table as a base and a log of changes, both bucketed by the key.

A batch appends the rows that it changes, whole, under its number; on reading,
the latest row of a key wins. Base and log lie in the same buckets, so reading,
and looking up some keys, joins without shuffling either: only the keys asked
for are dealt out. Compaction writes the latest rows as the next base and begins
a new log. A batch that is run again overwrites its own part of the log.

Folders under ``path``: ``base/v`` and ``log/v`` of each version v. A base
counts once Spark has marked it complete, so a compaction that was cut off is
simply run again.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class ChangeLog:
    """Rows of ``schema`` by ``key``, a column of it; further columns of the log are __batch."""

    def __init__(self, spark: SparkSession, path: str, key: str, schema: str | StructType, buckets: int = 64):
        self.spark, self.path, self.key, self.buckets = spark, path.rstrip("/"), key, buckets
        self.schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
        self.name = f"changes_{hashlib.sha256(self.path.encode()).hexdigest()[:16]}"
        self.version = max(self._complete(), default=-1)
        if self.version < 0:
            self.version = 0
            self._write(spark.createDataFrame([], self.schema), 0)
        self._open()

    def _files(self):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _complete(self) -> list[int]:
        at, system = self._files()
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        base = path(at, "base")
        if not system.exists(base):
            return []
        names = [f.getPath().getName() for f in system.listStatus(base)]
        return [int(n) for n in names if n.isdigit() and system.exists(path(base, f"{n}/_SUCCESS"))]

    def _table(self, kind: str, version: int | None = None) -> str:
        return f"{self.name}_{kind}_{self.version if version is None else version}"

    def _columns(self) -> str:
        return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields)

    def _write(self, rows: DataFrame, version: int) -> None:
        """A file a bucket, sorted; the catalog's entry is made anew by :meth:`_open`."""
        table = self._table("base", version)
        self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        dealt = rows.select(*self.schema.names).repartition(self.buckets, self.key)
        dealt.write.mode("overwrite").bucketBy(self.buckets, self.key).sortBy(self.key).option("path", f"{self.path}/base/{version}").saveAsTable(table)

    def _open(self) -> None:
        """The catalog of a session knows nothing of another's tables, the folders do."""
        by = f"CLUSTERED BY (`{self.key}`) SORTED BY (`{self.key}`) INTO {self.buckets} BUCKETS"
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self._table('base')} ({self._columns()}) USING parquet {by} LOCATION '{self.path}/base/{self.version}'")
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self._table('log')} ({self._columns()}, `__batch` bigint) USING parquet PARTITIONED BY (`__batch`) {by} LOCATION '{self.path}/log/{self.version}'")

    def _parts(self, keys: DataFrame | None, before: int | None) -> tuple[DataFrame, DataFrame]:
        """The base, and the latest of the log, of ``keys`` or of all; every batch lies in the same buckets, so neither is shuffled."""
        base, log = self.spark.table(self._table("base")), self.spark.table(self._table("log"))
        if before is not None:
            log = log.where(F.col("__batch") < before)
        if keys is not None:
            base, log = (x.join(keys, self.key, "left_semi") for x in (base, log))
        last = F.max_by(F.struct(*self.schema.names), "__batch").alias("__new")
        return base, log.groupBy(self.key).agg(last).select(F.col(self.key).alias("__key"), "__new")

    def rows(self, keys: DataFrame | None = None, before: int | None = None) -> DataFrame:
        """The latest rows, all or those of ``keys`` (the key column; any number of rows each). Keys that are not there give none.

        ``before``: only changes of batches before that one count, so a batch
        that is run again doesn't see what it wrote.
        """
        base, new = self._parts(None if keys is None else keys.select(self.key), before)
        both = base.join(new, base[self.key] == new["__key"], "full")
        changed = F.col("__new").isNotNull()
        return both.select(*[F.when(changed, F.col("__new")[n]).otherwise(F.col(n)).alias(n) for n in self.schema.names])

    def append(self, rows: DataFrame, batch: int) -> None:
        """Logs whole ``rows``, one a key, as changes of a batch; later batches have larger numbers."""
        out = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields], F.lit(batch).cast("long").alias("__batch"))
        mode = "spark.sql.sources.partitionOverwriteMode"
        before = self.spark.conf.get(mode)
        self.spark.conf.set(mode, "dynamic")
        try:
            out.repartition(self.buckets, self.key).write.insertInto(self._table("log"), overwrite=True)
        finally:
            self.spark.conf.set(mode, before)
        self.spark.catalog.refreshTable(self._table("log"))

    def batches(self) -> int:
        """Batches in the log, a sign of when to compact."""
        return self.spark.table(self._table("log")).select("__batch").distinct().count()

    def compact(self, before: int | None = None) -> None:
        """Makes the latest rows the next base, of batches ``before`` one that begins. Older versions stay for those who still read them, until :meth:`vacuum`."""
        self._write(self.rows(before=before), self.version + 1)
        self.version += 1
        self._open()

    def vacuum(self) -> list[int]:
        """Removes versions before the present one; says which."""
        at, system = self._files()
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        gone = sorted(v for v in self._complete() if v < self.version)
        for v in gone:
            for kind in ("base", "log"):
                self.spark.sql(f"DROP TABLE IF EXISTS {self._table(kind, v)}")
                system.delete(path(at, f"{kind}/{v}"), True)
        return gone
