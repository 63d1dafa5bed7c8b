"""F: one row or the first few of each key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from padron.operators.joins import count_children


def latest(df: DataFrame, keys: list[str], order: str, tiebreak: str) -> DataFrame:
    """The newest row of each key. A grouped maximum, so that only one row of a key leaves each task."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(order, tiebreak)).alias("r"))
    return best.select(*keys, "r.*").select(*df.columns)


def keep_first(df: DataFrame, keys: list[str], id: str) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), id).alias("r")).select(*keys, "r.*").select(*df.columns)


def current_run(df: DataFrame, column: str = "last_seen") -> DataFrame:
    """Rows seen in the latest run."""
    newest = df.agg(F.max(column).alias(column))
    return df.join(F.broadcast(newest), column, "left_semi")  # one row


def topk_sectors(sectores, ec, k=10):
    return count_children(sectores, ec, "sector_id", "n").orderBy(F.desc("n"), "sector_id").limit(k)


def sample_children(df: DataFrame, parent: str, key: str, k: int = 10) -> DataFrame:
    """The first k children of each parent by key."""
    n = F.row_number().over(W.partitionBy(parent).orderBy(key))
    return df.withColumn("n", n).filter(F.col("n") <= k).drop("n")  # Spark keeps k rows a parent before the shuffle


def capped(df: DataFrame, entity: str, key: str, k: int = 20) -> DataFrame:
    """The first k rows with the number of all."""
    total = df.agg(F.count("*").alias("total"))
    return df.select(F.lit(entity).alias("entity"), F.col(key).alias("id")).orderBy("id").limit(k).crossJoin(F.broadcast(total))  # one row


def error_examples(errors: DataFrame, k: int = 3) -> DataFrame:
    """Number and first k examples of each (field, message). errors: field, message, key."""
    n = F.row_number().over(W.partitionBy("field", "message").orderBy("key"))
    few = errors.withColumn("n", n).filter(F.col("n") <= k).groupBy("field", "message").agg(F.array_join(F.sort_array(F.collect_list("key")), ",").alias("examples"))
    counts = errors.groupBy("field", "message").agg(F.count("*").alias("count"))
    return counts.join(few, ["field", "message"])


def top_errors(errors: DataFrame, k: int = 10) -> DataFrame:
    return errors.groupBy("message").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "message").limit(k)


def last_run(runs: DataFrame) -> DataFrame:
    """The newest completed run."""
    done = runs.filter(F.col("status") == "completed")
    return done.agg(F.max_by(F.struct("harvest_id", "start_time", "items"), F.struct("start_time", "harvest_id")).alias("r")).select("r.*")


def ordered(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.orderBy(*keys)


def payload_dedup(df: DataFrame) -> DataFrame:
    """One stored body of each url and content, the earliest."""
    return df.groupBy("url", "hash").agg(F.min_by(F.struct("page_id", "fetch", "size"), F.struct("fetch", "page_id")).alias("r")).select("url", "hash", "r.*")
