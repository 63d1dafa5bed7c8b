"""How rows are dealt to tasks; the shared folder of a session, and the few file operations that tables in it need."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt by keys to a number of tasks that Spark does not lower, as a few small shuffled bytes may be many groups to keep."""
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism), *keys)


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see: spark.checkpoint.dir.

    Where that is unset, local mode takes a temporary folder; elsewhere other machines would not
    see its files, so the job fails at once.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    own = getattr(spark.sparkContext, "_padron_scratch", None)
    if own is None:
        own = spark.sparkContext._padron_scratch = "file://" + tempfile.mkdtemp(prefix="spark-padron-")
    return own


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared one."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _files(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def listed(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none if there is no such folder."""
    where, fs = _files(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(where)) if fs.exists(where) else []


def delete(spark: SparkSession, path: str) -> None:
    where, fs = _files(spark, path)
    fs.delete(where, True)
