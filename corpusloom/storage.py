"""Reliable cuts of lineage in the folder that driver and executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``.

    Where it is unset (tests, a notebook) a temporary folder is set, but only
    for a local master: on a cluster such a folder would not be shared.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not named and sc.getCheckpointDir() is None:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="corpusloom-"))
    elif named and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(named)
    return named or sc.getCheckpointDir()


#: Bytes of an input, by its files, that :func:`spread` may deal out.
SMALL = 256 << 20
#: What the library's queries leave in the shared folder.
LEFT = ("archive-", "media-", "pipeline-", "stream-")


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores, if its files give fewer partitions than there are and hold ``SMALL`` bytes at most.

    A table of one row group can't be split by its reader. Larger inputs are
    never shuffled for this, however many cores there are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return df.repartition(cores) if int(size) <= SMALL else df


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back from there."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def clear(spark: SparkSession, checkpoints: bool = False) -> list[str]:
    """Removes the folders that queries left in the shared one, and this session's checkpoints if asked; says which.

    To be called when no DataFrame that reads them is needed any more.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path
    base = path(shared_dir(spark))
    system = base.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [f.getPath() for f in (system.listStatus(base) or []) if f.isDirectory() and f.getPath().getName().startswith(LEFT)]
    own = spark.sparkContext.getCheckpointDir()
    if checkpoints and own:
        found += [f.getPath() for f in system.listStatus(path(own)) if f.getPath().getName().startswith("rdd-")]
    for f in found:
        system.delete(f, True)
    return sorted(f.getName() for f in found)
