"""Intermediate tables in the shared folder: they cut lineage and survive lost executors."""

from __future__ import annotations

import tempfile
import uuid
import weakref

from pyspark.sql import DataFrame, SparkSession

_local_dirs: dict[str, str] = {}
_paths: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def shared_dir(spark: SparkSession) -> str:
    """A new path below spark.checkpoint.dir.

    Where that setting is absent, a local master (as in tests) gets a temporary folder; any other master raises, since
    executors would write to disks of their own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    app = spark.sparkContext.applicationId
    if not base:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = _local_dirs.setdefault(app, "file://" + tempfile.mkdtemp(prefix="leafmill-"))
    return f"{base.rstrip('/')}/leafmill-{app}/{uuid.uuid4().hex}"


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back; what was shuffled to write it is removed at once."""
    spark, path = df.sparkSession, shared_dir(df.sparkSession)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    _paths[out] = path
    return out


def discard(*tables: DataFrame) -> None:
    """Remove tables that `materialize` wrote and that nothing reads any more; others are left alone."""
    for df in tables:
        path = _paths.pop(df, None)
        if path is not None:
            jvm, sc = df.sparkSession._jvm, df.sparkSession.sparkContext
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(sc._jsc.hadoopConfiguration()).delete(at, True)


def replace(df: DataFrame, path: str, form: str = "json") -> None:
    """Write df beside path and move it there when it is whole, so that a failed write leaves the old table; that one goes just before the move."""
    spark, beside = df.sparkSession, f"{path.rstrip('/')}.{uuid.uuid4().hex}"
    df.write.format(form).save(beside)
    made, at = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (beside, path))
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.delete(at, True)
    if not fs.rename(made, at):
        raise OSError(f"cannot move {beside} to {path}")
