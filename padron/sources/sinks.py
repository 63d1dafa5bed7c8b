"""B: exports and table writers. No writer collects rows in the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from padron.functions.clean import iso_dates
from padron.operators.listing import apply_filters
from padron.schemas import BASELINE_COLUMNS, CSV_COLUMNS
from padron.sources.merge_table import MergeTable
from padron.sources.storage import scratch

WRITERS = {}


def register_writer(fmt: str, write) -> None:
    """Add or replace a format: write(df, path, entity)."""
    WRITERS[fmt] = write


def write_json_records(df: DataFrame, path: str, compression: str = "none") -> None:
    dates = [c for c, t in df.dtypes if t in ("date", "timestamp", "timestamp_ntz")]
    iso_dates(df, dates).write.mode("overwrite").json(path, compression=compression)


def write_json_envelope(frames: dict[str, DataFrame], path: str, filters: dict | None = None) -> None:
    """data/<entity> for each table and metadata with the counts, written once the data are there."""
    spark = next(iter(frames.values())).sparkSession
    for name, df in frames.items():
        write_json_records(apply_filters(df, name, filters or {}), f"{path}/data/{name}")
    counts = None
    for name in frames:
        one = spark.read.text(f"{path}/data/{name}").agg(F.lit(name).alias("entity"), F.count("*").alias("rows"))
        counts = one if counts is None else counts.unionByName(one)
    counts.withColumn("filters", F.lit(str(filters or {}))).write.mode("overwrite").json(f"{path}/metadata")


def write_csv(df: DataFrame, path: str, columns: list[str] | None = None) -> bool:
    """One folder of CSV in fixed column order; nothing is written for an empty table."""
    if df.isEmpty():
        return False
    df.select(*(columns or df.columns)).write.mode("overwrite").csv(path, header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return True


def write_csv_v1(df: DataFrame, directory: str, entity: str, session: str) -> bool:
    return write_csv(df, f"{directory}/{entity}_{session}")


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


register_writer("json", lambda df, path, entity: write_json_records(df, path))
register_writer("csv", lambda df, path, entity: write_csv(df, path, [c for c in CSV_COLUMNS.get(entity, df.columns) if c in df.columns]))
register_writer("parquet", lambda df, path, entity: write_parquet(df, path))


def write_bundle(frames: dict[str, DataFrame], directory: str, formats=("json", "csv", "parquet"), shapes: dict[str, DataFrame] | None = None) -> None:
    """All tables in all formats, each table computed once: Parquet is written first, into the bundle or the shared
    folder, and the other formats read it. shapes (graph, nested documents) go as JSON under their names,
    compressed, as they repeat the names of each edge."""
    for name, df in (shapes or {}).items():
        write_json_records(df, f"{directory}/{name}", "gzip")
    for name, df in frames.items():
        spark = df.sparkSession
        once = f"{directory}/parquet/{name}" if "parquet" in formats else scratch(spark, "bundle")
        WRITERS["parquet"](df, once, name)
        stored = spark.read.schema(df.schema).parquet(once)
        for fmt in formats:
            if fmt != "parquet":
                WRITERS[fmt](stored, f"{directory}/{fmt}/{name}", name)


def write_baseline(frames: dict[str, DataFrame], path: str) -> None:
    for name, df in frames.items():
        df.select(*[c for c in BASELINE_COLUMNS[name] if c in df.columns]).write.mode("overwrite").json(f"{path}/{name}")


def write_quality_report(report: DataFrame, path: str) -> None:
    report.coalesce(1).write.mode("overwrite").json(path)  # a row a type


def write_diff(diffs: dict[str, DataFrame], path: str, keys: dict[str, str]) -> None:
    out = None
    for entity, d in diffs.items():
        one = d.select(F.lit(entity).alias("entity"), "op", F.col(keys[entity]).alias("key"), "changes")
        out = one if out is None else out.unionByName(one)
    out.filter("op <> 'unchanged'").write.mode("overwrite").partitionBy("entity", "op").json(path)


def merge_sink(target: MergeTable, batch: DataFrame, now) -> DataFrame:
    """Merge batch into a table, of which only the buckets of its keys are rewritten; the table as it then is."""
    target.merge(batch, now)
    return target.rows()


def write_capture_analysis(df: DataFrame, path: str) -> None:
    """API captures, and their totals."""
    api = df.filter(F.col("path").contains("/api/"))
    api.write.mode("overwrite").json(f"{path}/captures")
    api.groupBy("method").agg(F.count("*").alias("n")).write.mode("overwrite").json(f"{path}/totals")


def append_entities(df: DataFrame, path: str, now=None) -> None:
    """Append with defaults: vigente true, and the times of creation and change."""
    now = F.current_timestamp() if now is None else now
    if "vigente" in df.columns:
        df = df.withColumn("vigente", F.coalesce("vigente", F.lit(True)))
    df.withColumns({"created_at": now, "updated_at": now}).write.mode("append").parquet(path)


def write_paged(df: DataFrame, path: str, rows: int) -> None:
    df.write.mode("overwrite").option("maxRecordsPerFile", rows).json(path)
