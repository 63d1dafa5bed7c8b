"""A Parquet table that is merged into by key and rewrites only what a batch touches.

Rows lie in hash buckets of the key, each bucket in a folder of its newest version. A merge
reads and rewrites the buckets that its batch has keys of, then commits a small table that
names the version of every bucket. Readers go by the newest commit, so a merge that fails midway
changes nothing, and a version that is merged again replaces itself. Versions that neither of
the last two commits names are deleted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from padron.operators.joins import upsert
from padron.sources.storage import delete, listed


class MergeTable:
    """key: the column that tells rows apart; fields: the columns that a merge brings in. The number of buckets is
    fixed once the first version stands."""

    def __init__(self, spark: SparkSession, path: str, key: str, fields: list[str], buckets: int = 64):
        self.spark, self.path, self.key, self.fields, self.buckets = spark, path.rstrip("/"), key, list(fields), buckets

    def versions(self) -> list[int]:
        """Committed versions, oldest first."""
        names = listed(self.spark, f"{self.path}/commits")
        return sorted(int(n.split("=")[1]) for n in names if n.startswith("version="))

    def _held(self, version: int) -> dict[int, int]:
        """Version of each bucket as of a commit; a row a bucket."""
        return {r["bucket"]: r["version"] for r in self.spark.read.parquet(f"{self.path}/commits/version={version}").collect()}

    def _read(self, held: dict[int, int]) -> DataFrame | None:
        if not held:
            return None
        paths = [f"{self.path}/data/bucket={b}/version={v}" for b, v in sorted(held.items())]
        return self.spark.read.option("basePath", f"{self.path}/data").parquet(*paths).drop("bucket", "version")

    def rows(self, keys: list | None = None) -> DataFrame | None:
        """The table as of the newest commit, None before the first; with keys, only their buckets are read."""
        versions = self.versions()
        held = self._held(versions[-1]) if versions else {}
        if keys is None:
            return self._read(held)
        asked = self.spark.createDataFrame([(k,) for k in keys], [self.key]).select(self._bucket().alias("b")).distinct()
        out = self._read({r["b"]: held[r["b"]] for r in asked.collect() if r["b"] in held})
        return out if out is None else out.filter(F.col(self.key).isin(list(keys)))

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(F.col(self.key).cast("string")), F.lit(self.buckets)).cast("int")

    def merge(self, batch: DataFrame, now: Column, version: int | None = None) -> int:
        """Merge batch as upsert() does, into the newest version before `version`, by default the one after the
        newest; returns the version. A batch without rows commits nothing. batch is read twice."""
        earlier = [v for v in self.versions() if version is None or v < version]
        version = version if version is not None else (earlier[-1] + 1 if earlier else 0)
        held = self._held(earlier[-1]) if earlier else {}
        # at most one row a bucket
        touched = [r["b"] for r in batch.select(self._bucket().alias("b")).distinct().collect()]
        if not touched:
            return version
        old = self._read({b: held[b] for b in touched if b in held})
        if old is None:
            kinds = dict(batch.dtypes)
            old = batch.limit(0).select(self.key, *[F.lit(None).cast(kinds[f]).alias(f) for f in self.fields], now.alias("first_seen"), now.alias("last_seen"))
        out = upsert(old, batch, self.key, self.fields, now).withColumns({"bucket": self._bucket(), "version": F.lit(version)})
        # large buckets are split into several files
        out.hint("rebalance", "bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "version").parquet(f"{self.path}/data")
        held = held | {b: version for b in touched}
        self.spark.createDataFrame(sorted(held.items()), "bucket int, version int").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/commits/version={version}")
        self._clean(earlier, touched, held)
        return version

    def _clean(self, earlier: list[int], touched: list[int], held: dict[int, int]) -> None:
        """Drop the touched buckets' versions that neither this commit nor the one before names, and older commits."""
        before = self._held(earlier[-1]) if earlier else {}
        for b in touched:
            for name in listed(self.spark, f"{self.path}/data/bucket={b}"):
                if name.startswith("version=") and int(name[8:]) not in (held[b], before.get(b)):
                    delete(self.spark, f"{self.path}/data/bucket={b}/{name}")
        for v in earlier[:-1]:
            delete(self.spark, f"{self.path}/commits/version={v}")
