"""G: set operations on tables, keys and lists, and the searches built from them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from padron.operators.choose import capped
from padron.operators.listing import equal_to, multi_field_search


def union_items(frames: dict[str, DataFrame]) -> DataFrame:
    """One table of mixed items, each tagged with its type; missing columns are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [df.withColumn("type", F.lit(t)) for t, df in frames.items()])


def added(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    return new.join(old.select(key), key, "left_anti")


def removed(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    return added(new, old, key)


def common(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    return a.select(key).distinct().join(b.select(key).distinct(), key)


def list_diff(before: Column, after: Column) -> Column:
    """Members added and removed, sorted, and the sizes of both lists; a null list is empty."""
    empty = F.array().cast("array<string>")
    a, b = F.array_distinct(F.coalesce(before, empty)), F.array_distinct(F.coalesce(after, empty))
    return F.struct(F.array_sort(F.array_except(b, a)).alias("added"), F.array_sort(F.array_except(a, b)).alias("removed"), F.size(a).alias("n_before"), F.size(b).alias("n_after"))


def search_all(q: str, tables: dict[str, tuple[DataFrame, str, list[str]]], limit: int = 10) -> DataFrame:
    """The first `limit` hits of each entity with the number of all. tables: name -> (rows, key, fields)."""
    return reduce(DataFrame.unionByName, [capped(multi_field_search(df.withColumn(key, F.col(key).cast("string")), q, fields), name, key, limit) for name, (df, key, fields) in tables.items()])


def search_location(code: str, municipio: str | None, cert: DataFrame, centros: DataFrame, k: int = 20) -> DataFrame:
    """Certifiers and centres of a state, the first k of each with the number of all and the state's name."""
    out = []
    for name, df, key in (("certificador", cert, "cert_id"), ("centro", centros, "centro_id")):
        own = multi_field_search(equal_to(df, estado_inegi=code), municipio, ["municipio"])
        state = own.agg(F.min("estado").alias("estado"))
        out.append(capped(own, name, key, k).crossJoin(F.broadcast(state)))  # one row
    return reduce(DataFrame.unionByName, out)
