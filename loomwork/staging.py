"""Tables written between the steps of a job.

A step whose result is read several times, or by every round of a loop, is written as Parquet into the shared folder
the cluster names in ``spark.checkpoint.dir``. That cuts the lineage (a lost executor costs a re-read, not a re-run of
the joins above), gives later steps column pruning, and tells the planner the true size of what it joins.

Where Spark runs on one machine and names no folder, the step is persisted in Spark's own storage instead.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def staging_folder(spark: SparkSession) -> str | None:
    """The shared folder of the session; none on a single machine that names none."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    local = spark.sparkContext.master.split("[")[0] == "local"
    if not folder and not local:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return folder


_made: list[str] | None = None  # paths of the running job


@contextmanager
def job_staging(spark: SparkSession) -> Iterator[None]:
    """Delete what was staged inside when the job ends."""
    global _made
    outer, _made = _made, []
    try:
        yield
    finally:
        for path in _made:
            delete(spark, path)
        _made = outer


def staging_path(spark: SparkSession) -> str:
    """A new path in the shared folder, for steps that write files; on one machine that names none, in the warehouse."""
    folder = staging_folder(spark) or spark.conf.get("spark.sql.warehouse.dir")
    path = f"{folder.rstrip('/')}/loomwork-{uuid.uuid4().hex}"
    if _made is not None:
        _made.append(path)
    return path


def spread(table: DataFrame) -> DataFrame:
    """A staged table over at least as many partitions as there are cores.

    Only small tables and single unsplittable files come in fewer; steps that compute long on each row spread them.
    """
    cores = table.sparkSession.sparkContext.defaultParallelism
    return table.repartition(cores) if table.rdd.getNumPartitions() < cores else table


_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """What is written inside deletes its shuffle files when it ends: nothing reads them again, and otherwise they lie on the
    disks until the driver collects its garbage."""
    before = spark.conf.get(_FREED, None)
    spark.conf.set(_FREED, "true")
    try:
        yield
    finally:
        spark.conf.set(_FREED, before) if before is not None else spark.conf.unset(_FREED)


def staged(df: DataFrame, in_loop: bool = False) -> DataFrame:
    """Write ``df`` once and return a scan of what was written.

    Where no folder is named, only steps ``in_loop`` are written (to the warehouse): the plan of a persisted table still
    holds all its steps, which would multiply from round to round.
    """
    spark = df.sparkSession
    if not staging_folder(spark) and not in_loop:
        kept = df.persist(StorageLevel.DISK_ONLY)
        kept.write.format("noop").mode("overwrite").save()
        return kept
    path = staging_path(spark)
    with shuffles_freed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Delete what ``staged`` wrote. Only for tables that nothing reads any more."""
    spark = table.sparkSession
    persisted = table.storageLevel.useDisk
    table.unpersist()
    for name in () if persisted else {file.rpartition("/")[0] for file in table.inputFiles()}:
        if "/loomwork-" in name:
            delete(spark, name)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a path of the shared folder."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
