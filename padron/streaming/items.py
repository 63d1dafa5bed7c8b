"""M1 to M4: the item flow as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from padron.functions.clean import normalize_items
from padron.functions.rules import error, raw_errors
from padron.operators.joins import fk_resolve
from padron.schemas import V1_COLUMNS
from padron.sources.merge_table import MergeTable
from padron.sources.storage import delete


def read_stream(spark: SparkSession, path: str, schema, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def dedup_ttl(df: DataFrame, ttl: str = "24 hours", time: str = "extracted_at", keys=("type", "content_hash")) -> DataFrame:
    """Drops repeats of keys within ttl of event time; of a static table, all repeats but the earliest."""
    if df.isStreaming:
        return df.withWatermark(time, ttl).dropDuplicatesWithinWatermark(list(keys))
    rest = [c for c in df.columns if c not in keys]
    first = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(time, *[c for c in rest if c != time])).alias("r"))
    return first.select(*keys, "r.*").select(*df.columns)


#: Kinds of items that are merged by key, and the columns that a merge brings in where an item has them.
UPSERTED = {t: ("code", [c for c in V1_COLUMNS[name] if c not in ("code", "status", "first_seen", "last_seen")] + ["content_hash"]) for t, name in (("ec_standard", "ec_standards"), ("certificador", "certificadores"), ("center", "evaluation_centers"))}


def routed(src: DataFrame) -> DataFrame:
    """Raw items cleaned and hashed, with their errors (judged before cleaning) and the way each goes: upsert for a
    valid item of a kind with keys, append for a valid course, reject for all others, untyped ones included."""
    df = normalize_items(raw_errors(src))
    valid, keyed = F.size("errors") == 0, F.col("type").isin(*UPSERTED)
    lacks = valid & keyed & F.col("code").isNull()
    df = df.withColumn("errors", F.when(lacks, F.array(error("code", "required", F.lit(True)))).otherwise(F.col("errors")))
    return df.withColumn("way", F.when(F.size("errors") > 0, "reject").when(keyed, "upsert").otherwise("append"))


def item_stream(src: DataFrame, path: str, checkpoint: str, ttl: str = "24 hours", time: str = "extracted_at", buckets: int = 16) -> StreamingQuery:
    """The whole flow: rules, cleaning, repeats dropped within ttl, then every item to its sink below path.

    Valid items of a kind with keys are merged into path/<type>; courses are always appended, with the
    standard that their code names, to path/courses; rejects go with their errors to path/rejects. A batch is
    computed once, into path/staged, from where the sinks read; each sink is written under the batch's number, so
    a batch that runs again replaces what it wrote. path/outcomes has the number of rows of each way and type.
    Repeats are of valid items only: a reject is nobody's repeat and enters no one's memory.
    What the query drops before the sinks stands in its progress: flow_report() adds it up.
    """
    df = routed(src).observe("items", F.count("*").alias("rows"), F.count_if(F.col("way") == "reject").alias("rejects"))
    memory = F.when(F.col("way") == "reject", F.uuid()).otherwise(F.concat_ws(":", "type", "content_hash"))
    kept = df.withColumn("memory", memory).withWatermark(time, ttl).dropDuplicatesWithinWatermark(["memory"]).drop("memory")

    def fan_out(batch: DataFrame, n: int) -> None:
        spark, staged = batch.sparkSession, f"{path}/staged/batch={n}"
        batch.write.mode("overwrite").partitionBy("way").parquet(staged)
        rows = spark.read.schema(batch.schema).parquet(staged)
        rows.groupBy("way", "type").agg(F.count("*").alias("n")).write.mode("overwrite").parquet(f"{path}/outcomes/batch={n}")
        for kind, (key, fields) in UPSERTED.items():
            own = rows.filter((F.col("way") == "upsert") & (F.col("type") == kind))
            fields = [c for c in fields if c in rows.columns]
            # of several rows of a key in one batch, the newest counts
            newest = own.groupBy(key).agg(F.max_by(F.struct(*fields), F.struct(F.col(time), *fields)).alias("r")).select(key, "r.*")
            now = own.agg(F.max(time)).first()[0]
            if now is not None:
                MergeTable(spark, f"{path}/{kind}", key, fields, buckets).merge(newest, F.lit(now), n)
        standards = MergeTable(spark, f"{path}/ec_standard", "code", [], buckets).rows()
        courses = rows.filter("way = 'append'").drop("way", "errors")
        parents = standards.select("code") if standards is not None else courses.select("code").limit(0)
        fk_resolve(courses.drop("code"), parents, "ec_code", "code", "code", "ec_ref").write.mode("overwrite").parquet(f"{path}/courses/batch={n}")
        rows.filter("way = 'reject'").drop("way").write.mode("overwrite").parquet(f"{path}/rejects/batch={n}")
        delete(spark, staged)

    return kept.writeStream.foreachBatch(fan_out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def flow_report(query: StreamingQuery) -> dict[str, int]:
    """Rows that came in, rejects among them, repeats and late rows that never reached a sink, from the query's progress."""
    out = dict.fromkeys(("rows", "rejects", "repeated", "late"), 0)
    for p in query.recentProgress:
        seen = (p.get("observedMetrics") or {}).get("items")
        if seen is not None:
            out["rows"] += seen["rows"]
            out["rejects"] += seen["rejects"]
        for s in p.get("stateOperators") or ():
            out["repeated"] += (s.get("customMetrics") or {}).get("numDroppedDuplicateRows", 0)
            out["late"] += s.get("numRowsDroppedByWatermark", 0)
    return out


def stream_upsert(df: DataFrame, path: str, key: str, fields: list[str], checkpoint: str, time: str = "extracted_at", buckets: int = 64) -> StreamingQuery:
    """Merge each micro-batch into the MergeTable at path, of which only the buckets of the batch's keys are rewritten.

    Batch n writes version n, so a batch that runs again after a failure writes the same version again.
    """

    def merge(batch: DataFrame, n: int) -> None:
        # of several rows of a key in one batch, the newest counts
        newest = batch.groupBy(key).agg(F.max_by(F.struct(*fields), F.struct(F.col(time), *fields)).alias("r"), F.max(time).alias("now")).select(key, "r.*", "now")
        staged = f"{path}/staged/batch={n}"
        newest.write.mode("overwrite").parquet(staged)
        rows = batch.sparkSession.read.schema(newest.schema).parquet(staged)
        now = rows.agg(F.max("now")).first()[0]
        MergeTable(batch.sparkSession, path, key, fields, buckets).merge(rows.drop("now"), F.lit(now), n)
        delete(batch.sparkSession, staged)

    return df.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def split_late(df: DataFrame, newest, delay: str = "24 hours", time: str = "extracted_at") -> tuple[DataFrame, DataFrame]:
    """Rows in time, and rows more than delay before `newest`; rows without a hash are never late."""
    late = F.col("content_hash").isNotNull() & (F.col(time) < F.lit(newest).cast("timestamp") - F.expr(f"interval {delay}"))
    return df.filter(~F.coalesce(late, F.lit(False))), df.filter(late)


def in_time_stream(df: DataFrame, key: str, delay: str = "24 hours", time: str = "extracted_at") -> DataFrame:
    """Rows that come no later than the watermark, `delay` behind the newest time of the batches before; rows of a key that
    was seen within the delay, and late ones, are dropped, and counted in the progress: see dropped_late(). Rows
    without a hash pass by."""
    hashed = df.filter("content_hash is not null").withWatermark(time, delay).dropDuplicatesWithinWatermark([key])
    return hashed.unionByName(df.filter("content_hash is null"))


def late_rows(source: DataFrame, in_time: DataFrame, key: str) -> DataFrame:
    """The side table: rows of the source that the stream has not let through."""
    return source.join(in_time.select(key), key, "left_anti")


def dropped_late(query: StreamingQuery) -> int:
    """Rows that the query's operators have dropped as late, as Spark has counted them."""
    return sum(s.get("numRowsDroppedByWatermark", 0) for p in query.recentProgress for s in p.get("stateOperators") or ())


def write_all(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Run a stream over all that is there into Parquet files, and wait; the ended query, for its progress."""
    if mode == "append":
        q = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    else:
        q = df.writeStream.foreachBatch(lambda b, n: b.write.mode("overwrite").parquet(path)).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()
    return q
