"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MASK64 = (1 << 64) - 1

#: Bytes of a word as the contracts define it: 0-9, a-z and all bytes from 0x80;
#: A-Z become lower case and everything else a space.
WORD_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256)
)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir. Without it, a temporary one in local mode only."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    own = getattr(spark.sparkContext, "_padron_shared", None)
    if own is None:
        own = "file://" + tempfile.mkdtemp(prefix="spark-padron-")
        spark.sparkContext._padron_shared = own
    return own


def materialize(df: DataFrame) -> DataFrame:
    """Write df to the shared folder and read it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/padron/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._padron_path = path
    return out


def discard(*frames: DataFrame | None) -> None:
    """Delete what materialize() has written, once nothing reads it any more; other frames are left alone."""
    for df in frames:
        path = getattr(df, "_padron_path", None)
        if path:
            spark = df.sparkSession
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(where, True)
            df._padron_path = None


def small_batches(spark: SparkSession, rows: int = 2000) -> None:
    """Whole texts go to Python in Arrow batches of at most so many rows, unless the session has a smaller number.

    The number is a setting of the session, read when a plan runs, so it stays.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, str(rows))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def id_text(docs: DataFrame) -> DataFrame:
    """doc_id and the whole text as UTF-8 bytes (null stays null); other columns are left out."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))


#: Stands for a null id in joins.
NO_ID = -(1 << 63)


def keyed(docs: DataFrame) -> DataFrame:
    """id and th, which together tell rows apart (the id, NO_ID if null, and a hash of the text), and the bytes of
    the text, empty if null. Rows that are equal in both are the same row to the operators."""
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"),
        F.xxhash64("text").alias("th"),
        F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"),
    )


def own_id(column: str = "id"):
    """The id that keyed() has written, null again where it was null."""
    return F.when(F.col(column) != NO_ID, F.col(column))


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (three xor-shift-multiply rounds), on uint64 in place of a slower hash."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def rows_of(batch, *names):
    return [batch.column(batch.schema.get_field_index(n)) for n in names]


def connected_components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """Smallest reachable id of every id in edges(a, b); ids that only a chain joins included.

    Alternates two star steps: every neighbourhood hooks its larger members, then
    its smaller ones, to its smallest id, until nothing changes. Edges never
    outnumber the input's and each step is one grouped minimum plus one join. The
    minima are written before the join, so that a join of two plain exchanges can
    split the root of a large component; a round's folder goes once the next one
    is written. Returns (id, component), one row per id that is not itself the
    smallest of its component; an empty edge table gives no rows.
    """
    current = materialize(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    while True:
        # ids that are no larger than all their neighbours keep them, so only the others' minima are needed
        low = materialize(current.groupBy("u").agg(F.min("v").alias("m")))
        upward = current.select(F.col("v").alias("u"), F.col("u").alias("v"))
        if current.count() == low.count() and upward.join(low, "u", "left_semi").isEmpty():
            discard(low)  # every id has one smaller neighbour, which has none itself
            break
        large = upward.join(low, "u", "left").select(F.col("v").alias("u"), F.coalesce("m", "u").alias("v")).distinct()
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low2, "u")
            .select(F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
                                      F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v").where("u <> v").distinct()
        )
        after = materialize(small)
        discard(current, low)
        current = after
    out = current.select(F.col("u").alias("id"), F.col("v").alias("component"))
    out._padron_path = current._padron_path
    return out
