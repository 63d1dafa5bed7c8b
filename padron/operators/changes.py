"""J: differences between snapshots, harvests, edges and fetched pages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from padron.functions.clean import row_hash_canonical
from padron.operators.choose import latest
from padron.operators.joins import snapshot_at
from padron.operators.sets import list_diff


def field_changes(fields: list[str], before: str = "b", after: str = "a", hash: str | None = None) -> Column:
    """Array of struct(field, before, after) of the fields that differ, nulls compared as values.

    With a hash column, equal hashes stand for equal rows, but only where both are there.
    """
    def one(f):
        old, new = F.col(f"{before}.{f}"), F.col(f"{after}.{f}")
        return F.when(~old.eqNullSafe(new), F.struct(F.lit(f).alias("field"), old.cast("string").alias("before"), new.cast("string").alias("after")))
    found = F.array_compact(F.array(*[one(f) for f in fields]))
    if not hash:
        return found
    same = F.col(f"{before}.{hash}").isNotNull() & (F.col(f"{before}.{hash}") == F.col(f"{after}.{hash}"))
    return F.when(same, F.filter(found, lambda x: F.lit(False))).otherwise(found)


def compare(old: DataFrame, new: DataFrame, key: str, fields: list[str], hash: str | None = None, lists: str | None = None) -> DataFrame:
    """(key, op, changes) of every key of either side: added, removed, modified or unchanged.

    lists names a column of codes whose members are compared as well. Rows without the key are left out.
    """
    old, new = old.filter(F.col(key).isNotNull()), new.filter(F.col(key).isNotNull())
    a, b = old.withColumn("_in", F.lit(True)).alias("b"), new.withColumn("_in", F.lit(True)).alias("a")
    both = a.join(b, F.col(f"b.{key}") == F.col(f"a.{key}"), "full")
    changes = field_changes(fields, "b", "a", hash)
    out = both.select(F.coalesce(F.col(f"a.{key}"), F.col(f"b.{key}")).alias(key), F.col("b._in").alias("was"), F.col("a._in").alias("is"), changes.alias("changes"), *([list_diff(F.col(f"b.{lists}"), F.col(f"a.{lists}")).alias("list")] if lists else []))
    differs = F.size("changes") > 0
    if lists:
        differs = differs | (F.size("list.added") > 0) | (F.size("list.removed") > 0)
    op = F.when(F.col("was").isNull(), "added").when(F.col("is").isNull(), "removed").when(differs, "modified").otherwise("unchanged")
    none = F.filter("changes", lambda x: F.lit(False))
    return out.withColumn("op", op).withColumn("changes", F.when(F.col("op") == "modified", F.col("changes")).otherwise(none)).drop("was", "is")


def diff(df: DataFrame, t1, t2, key: str, fields: list[str], tiebreak: str, hash: str | None = None, lists: str | None = None) -> DataFrame:
    """Differences between the states at two times; of several rows valid at a time the newest counts."""
    old, new = (latest(snapshot_at(df, t), [key], "last_seen", tiebreak) for t in (t1, t2))
    return compare(old, new, key, fields, hash, lists)


def diff_stats(d: DataFrame) -> DataFrame:
    """Counts by operation, and by changed field as field_<name>."""
    ops = d.groupBy(F.col("op").alias("stat")).agg(F.count("*").alias("n"))
    fields = d.select(F.explode("changes").alias("c")).groupBy(F.concat(F.lit("field_"), F.col("c.field")).alias("stat")).agg(F.count("*").alias("n"))
    return ops.unionByName(fields)


def diff_stats_cert(d: DataFrame, later: DataFrame) -> DataFrame:
    """diff_stats with status and accreditation changes and the later snapshot's types."""
    def has(f):
        return F.exists("changes", lambda c: c["field"] == f)
    more = d.agg(F.count_if(has("estatus")).alias("status_changes"), (F.count_if((F.size("list.added") > 0) | (F.size("list.removed") > 0)) if "list" in d.columns else F.lit(0).cast("long")).alias("accreditation_changes"))
    long = more.select(F.explode(F.array(*[F.struct(F.lit(c).alias("stat"), F.col(c).alias("n")) for c in more.columns])).alias("r")).select("r.*")
    tipos = later.groupBy(F.concat(F.lit("tipo_"), F.col("tipo")).alias("stat")).agg(F.count("*").alias("n"))
    return diff_stats(d).unionByName(long).unionByName(tipos)


def diff_summary(diffs: dict[str, DataFrame]) -> DataFrame:
    """Counts by entity and operation with all totals."""
    all_ = reduce(DataFrame.unionByName, [d.select(F.lit(e).alias("entity"), "op") for e, d in diffs.items()])
    cubed = all_.cube("entity", "op").agg(F.count("*").alias("n"))
    return cubed.select(F.coalesce("entity", F.lit("(all)")).alias("entity"), F.coalesce("op", F.lit("(all)")).alias("op"), "n")


def diff_baseline(current: DataFrame, baseline: DataFrame, key: str) -> DataFrame:
    """(key, op): any two tables by key; a row is modified if its canonical hash differs."""
    a, b = (df.filter(F.col(key).isNotNull()).select(key, row_hash_canonical(df).alias(n)) for df, n in ((baseline, "old"), (current, "new")))
    op = F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed").when(F.col("old") != F.col("new"), "modified").otherwise("unchanged")
    return a.join(b, key, "full").select(key, op.alias("op"))


def edge_diff(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    gone, new = a.select(*keys).join(b.select(*keys), keys, "left_anti"), b.select(*keys).join(a.select(*keys), keys, "left_anti")
    return gone.withColumn("op", F.lit("removed")).unionByName(new.withColumn("op", F.lit("added")))


def drift(counts: DataFrame, drop: float = 0.5) -> DataFrame:
    """counts(name, run, n): each run against the one before; severe if it lost more than `drop` of the rows."""
    before = F.lag("n").over(W.partitionBy("name").orderBy("run"))
    return counts.withColumn("before", before).filter("before is not null").withColumn("severe", F.col("n") < (1 - drop) * F.col("before"))


def changed_pages(fetch_log: DataFrame) -> DataFrame:
    """Fetches whose content differs from the page's fetch before."""
    before = F.lag("hash").over(W.partitionBy("page_id").orderBy("fetch"))
    return fetch_log.withColumn("before", before).filter("before is not null and before <> hash").select("page_id", "url", "fetch")


def diff_report_rows(d: DataFrame, key: str, k: int = 5) -> DataFrame:
    """The first k keys of each operation as one line, with how many more there are; unchanged rows are not listed."""
    shown = d.filter("op <> 'unchanged'")
    n = F.row_number().over(W.partitionBy("op").orderBy(key))
    first = shown.withColumn("i", n).filter(F.col("i") <= k).groupBy("op").agg(F.array_join(F.sort_array(F.collect_list(key)), ", ").alias("keys"))
    total = shown.groupBy("op").agg(F.count("*").alias("n"))
    more = F.when(F.col("n") > k, F.format_string(" ... %d more", F.col("n") - k)).otherwise(F.lit(""))
    return total.join(first, "op").select("op", "n", F.concat("keys", more).alias("line"))
