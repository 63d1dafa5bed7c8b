"""A: scans of tables, files, pages, captures and run logs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from padron.schemas import SCHEMAS, V1_COLUMNS


def scan_entity(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(path)


def scan_projected(spark: SparkSession, path: str, cols: list[str]) -> DataFrame:
    return spark.read.parquet(path).select(*cols)


def scan_v1(spark: SparkSession, directory: str) -> dict[str, DataFrame]:
    """The four tables of the older shape below directory, each with its fixed columns only."""
    return {name: scan_projected(spark, f"{directory}/{name}", cols) for name, cols in V1_COLUMNS.items()}


def scan_json_items(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Items, or objects of lists of items, as one item set. One JSON value a line, so that files can be split;
    multi_line reads files that hold one value over many lines."""
    df = spark.read.option("multiLine", multi_line).json(path)
    lists = [f.name for f in df.schema.fields if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StructType)]
    if len(lists) < len(df.columns) or not lists:
        return df
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [df.select(F.explode(c).alias("r")).select("r.*") for c in lists])


def scan_csv_items(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """multi_line is for values with line ends; files can be split only without it."""
    return spark.read.csv(path, header=True, inferSchema=False, multiLine=multi_line, escape='"')


def scan_baseline(spark: SparkSession, path: str, entity: str) -> DataFrame:
    return spark.read.json(f"{path}/{entity}")


def scan_crawl_map(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMAS["crawl_map"]).json(path)


def scan_captures(spark: SparkSession, path: str, session: str | None = None) -> DataFrame:
    """Captures of a session, or of the session that was written last, with all its files."""
    df = spark.read.schema(SCHEMAS["captures"]).json(path)
    if session is not None:
        return df.filter(F.col("session") == session)
    newest = df.agg(F.max_by("session", F.struct("_metadata.file_modification_time", "_metadata.file_path")).alias("session"))
    return df.join(F.broadcast(newest), "session", "left_semi").select(*df.columns)  # one row


#: What the addresses of each component's pages hold.
COMPONENT_URLS = {"ec": ("/ec/", "estandar"), "cert": ("/cert", "ece", "oc="), "centro": ("/centro",), "sector": ("/sector", "/comite")}


def scan_pages(spark: SparkSession, path: str, parts: tuple[str, ...] | None = None) -> DataFrame:
    """Stored pages, those whose address holds one of parts."""
    df = spark.read.parquet(path)
    return df.filter(reduce(lambda a, b: a | b, [F.col("url").contains(p) for p in parts])) if parts else df


def scan_runs(runs: DataFrame, mode: str | None = None, k: int = 10) -> DataFrame:
    df = runs.filter(F.col("mode") == mode) if mode else runs
    return df.orderBy(F.desc("start_time"), "harvest_id").limit(k)


def list_crawl_maps(spark: SparkSession, path: str) -> DataFrame:
    """One row of each saved crawl map: session from the folder name, number of addresses, size, newest first."""
    df = spark.read.schema(SCHEMAS["crawl_map"]).json(path).select("url", "_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time")
    files = df.groupBy("file_path").agg(F.count("url").alias("urls"), F.max("file_size").alias("bytes"), F.max("file_modification_time").alias("saved"))
    session = F.regexp_extract("file_path", r"session=([^/]+)/", 1)
    return files.groupBy(session.alias("session")).agg(F.sum("urls").alias("urls"), F.sum("bytes").alias("bytes"), F.max("saved").alias("saved")).orderBy(F.desc("saved"), "session")
