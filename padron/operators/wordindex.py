"""C15 on a stored index: words to keys, for searches that read the asked words alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from padron.operators.listing import folded_words, token_search
from padron.sources.storage import listed


class WordIndex:
    """Postings (word, entity, key) in hash buckets of the word, a folder for each bucket and version.

    A batch of new or changed rows is added under its number; adding it again replaces it. Postings of texts that have
    changed since stay, so matches() holds what the index finds against the rows as they are. The number of
    buckets is fixed once the first version stands.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets

    def _bucket(self, word: Column) -> Column:
        return F.pmod(F.xxhash64(word), F.lit(self.buckets)).cast("int")

    def add(self, df: DataFrame, entity: str, key: str, fields: list[str], version: int) -> None:
        """Index the rows of one entity; null keys are left out."""
        words = F.explode(F.array_distinct(folded_words(F.concat_ws(" ", *fields))))
        rows = df.filter(F.col(key).isNotNull()).select(F.lit(entity).alias("entity"), F.col(key).cast("string").alias("key"), words.alias("word")).distinct()
        out = rows.withColumns({"bucket": self._bucket(F.col("word")), "part": F.lit(f"{entity}-{version}")})
        # a word of very many keys is split; sorted files let the scan skip to the asked words
        out.hint("rebalance", "bucket").sortWithinPartitions("bucket", "word").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "part").parquet(f"{self.path}/words")

    def postings(self, q: str) -> DataFrame:
        """(word, entity, key) of the words of q; only their buckets are read."""
        shape = "word string, entity string, key string"
        asked = self.spark.range(1).select(F.explode(F.array_distinct(folded_words(F.lit(q)))).alias("word")).withColumn("bucket", self._bucket(F.col("word"))).collect()  # the words of one search
        there = {int(n.split("=")[1]) for n in listed(self.spark, f"{self.path}/words") if n.startswith("bucket=")}
        paths = [f"{self.path}/words/bucket={b}" for b in sorted({r["bucket"] for r in asked} & there)]
        if not paths:
            return self.spark.createDataFrame([], shape)
        rows = self.spark.read.schema(shape).option("basePath", f"{self.path}/words").parquet(*paths)
        return rows.filter(F.col("word").isin([r["word"] for r in asked])).select("word", "entity", "key").distinct()

    def search(self, q: str, limit: int | None = None) -> DataFrame:
        """(entity, key, words, score): keys with at least one word of q; a word weighs one over the number of its keys, so rare
        words count for most. Best first where a limit is given."""
        found = self.postings(q)
        weight = found.groupBy("word").agg((1.0 / F.count("*")).alias("w"))
        out = found.join(weight, "word").groupBy("entity", "key").agg(F.sort_array(F.collect_list("word")).alias("words"), F.round(F.sum("w"), 9).alias("score"))
        return out if limit is None else out.orderBy(F.desc("score"), "entity", "key").limit(limit)

    def matches(self, df: DataFrame, entity: str, key: str, fields: list[str], q: str) -> DataFrame:
        """The rows of df that token_search() finds, by way of the index."""
        keys = self.postings(q).filter(F.col("entity") == entity).select(F.col("key").alias("_key")).distinct()
        near = df.join(keys, F.col(key).cast("string") == F.col("_key"), "left_semi")
        return token_search(near, q, fields)
