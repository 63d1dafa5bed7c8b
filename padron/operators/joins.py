"""D: joins, lookups, upserts, snapshots and places."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from padron.schemas import STATE_ALIASES, STATE_CODES
from padron.sources.storage import dealt


def ec_certificadores(ec: DataFrame, ece_ec: DataFrame, cert: DataFrame) -> DataFrame:
    """Each standard's certifiers with the date of accreditation and their number."""
    rows = ec.select("ec_clave").join(ece_ec, "ec_clave").join(cert.select("cert_id", "tipo", "nombre_legal", "estado"), "cert_id")
    totals = rows.groupBy("ec_clave").agg(F.count("*").alias("total"))
    return rows.join(totals, "ec_clave").select("ec_clave", "cert_id", "tipo", "nombre_legal", "estado", "acreditado_desde", "total")


def ec_centros(ec, centro_ec, centros, estado=None):
    if estado:
        centros = centros.filter(F.col("estado_inegi") == estado)
    return ec.select("ec_clave").join(centro_ec, "ec_clave").join(centros.select("centro_id", "nombre", "municipio", "estado_inegi"), "centro_id").select("ec_clave", "centro_id", "nombre", "municipio", "estado_inegi")


def cert_standards(cert, ece_ec, ec, vigente=None):
    """Standards of certifiers; only those of type ECE have any."""
    if vigente is not None:
        ec = ec.filter(F.col("vigente") == vigente)
    return cert.filter(F.col("tipo") == "ECE").select("cert_id").join(ece_ec, "cert_id").join(ec.select("ec_clave", "titulo", "vigente"), "ec_clave").select("cert_id", "ec_clave", "titulo", "vigente", "acreditado_desde")


def centro_standards(centros, centro_ec, ec, vigente=None):
    if vigente is not None:
        ec = ec.filter(F.col("vigente") == vigente)
    return centros.select("centro_id").join(centro_ec, "centro_id").join(ec.select("ec_clave", "titulo", "nivel"), "ec_clave").select("centro_id", "ec_clave", "titulo", "nivel")


def count_children(parent: DataFrame, child: DataFrame, key: str, name: str = "n") -> DataFrame:
    """parent with the number of child rows of its key; 0 without any. The children are counted before the join."""
    counts = child.groupBy(key).agg(F.count("*").alias(name))
    return parent.join(counts, key, "left").withColumn(name, F.coalesce(name, F.lit(0)))


def lookup_name(df, dim, key, column, name, default="Unknown"):
    return df.join(dim.select(key, F.col(column).alias(name)), key, "left").withColumn(name, F.coalesce(name, F.lit(default)))


def upsert(target: DataFrame, batch: DataFrame, key: str, fields: list[str], now: Column) -> DataFrame:
    """target after merging batch: new keys are inserted with first_seen = last_seen = now; known
    ones get last_seen = now and those fields whose incoming value is not null. Batch rows with
    validation errors are left out, and of several rows of a key the last in order of its fields counts.
    """
    if "validation_errors" in batch.columns:
        batch = batch.filter(F.coalesce(F.size("validation_errors"), F.lit(0)) <= 0)
    batch = batch.groupBy(key).agg(F.max(F.struct(*fields)).alias("new"))
    both = target.alias("t").join(batch.alias("s"), key, "full")
    hit, known = F.col("new").isNotNull(), F.col("t.last_seen").isNotNull()
    return both.select(
        key,
        *[F.coalesce(F.col(f"new.{f}"), F.col(f"t.{f}")).alias(f) for f in fields],
        F.when(known, F.col("t.first_seen")).otherwise(now).alias("first_seen"),
        F.when(hit, now).otherwise(F.col("t.last_seen")).alias("last_seen"),
    )


def fk_resolve(child, parent, code, parent_code, parent_id, name):
    """child with the parent's id found by code; null where there is none."""
    return child.join(parent.select(F.col(parent_code).alias(code), F.col(parent_id).alias(name)), code, "left")


def append_courses(target: DataFrame, batch: DataFrame, ec: DataFrame) -> DataFrame:
    """Courses are always added, with the standard that their code names."""
    return target.unionByName(fk_resolve(batch, ec, "ec_code", "ec_clave", "ec_clave", "ec_ref"), allowMissingColumns=True)


def related(df: DataFrame, edge: DataFrame, key: str) -> DataFrame:
    return df.join(edge.select(key), key, "left_semi")


def orphans(child: DataFrame, parent: DataFrame, fk: str, key: str) -> DataFrame:
    """Rows with a code that no parent has."""
    return child.filter(F.col(fk).isNotNull()).join(parent.select(F.col(key).alias(fk)), fk, "left_anti")


def nearby(centros: DataFrame, estado: str, municipio: str, limit: int = 10) -> DataFrame:
    """Centres of a state whose municipality is the given one or, if there is none, contains it."""
    rank = F.when(F.lower("municipio") == municipio.lower(), 0).when(F.col("municipio").ilike(f"%{municipio}%"), 1)
    ranked = centros.filter(F.col("estado_inegi") == estado).withColumn("rank", rank).filter("rank is not null")
    best = ranked.agg(F.min("rank").alias("rank"))
    return ranked.join(F.broadcast(best), "rank", "left_semi").select("centro_id", "nombre", "municipio").orderBy("centro_id").limit(limit)


def distance_km(lat1: Column, lon1: Column, lat2: float, lon2: float) -> Column:
    """Great-circle distance by the haversine formula."""
    a = F.pow(F.sin(F.radians(lat1 - lat2) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(F.lit(lat2))) * F.pow(F.sin(F.radians(lon1 - lon2) / 2), 2)
    return F.lit(2 * 6371.0) * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def within_radius(df: DataFrame, lat: float, lon: float, km: float) -> DataFrame:
    """Rows within km of a point, nearest first; a box that the scan can filter by goes first."""
    import math

    dlat = km / 111.0
    dlon = km / (111.0 * max(0.01, math.cos(math.radians(lat))))
    box = df.filter(F.col("latitud").between(lat - dlat, lat + dlat) & F.col("longitud").between(lon - dlon, lon + dlon))
    return box.withColumn("distance_km", F.round(distance_km(F.col("latitud"), F.col("longitud"), lat, lon), 3)).filter(F.col("distance_km") <= km).orderBy("distance_km", "centro_id")


def state_code(df: DataFrame, column: str, codes=STATE_CODES) -> DataFrame:
    """df with estado_inegi: the code of the state named in column.

    Short forms count first; then the exact name, the name without "ESTADO DE " or
    "EDO. ", then either name within the other, in the official order. The states are a
    fixed list, so the code is an expression on each row and df is computed once.
    """
    states = F.array(*[F.struct(F.lit(i).alias("ordinal"), F.lit(n.upper()).alias("state"), F.lit(c).alias("code")) for i, (n, c) in enumerate(codes)])
    alias = F.create_map(*[F.lit(x) for k, v in STATE_ALIASES.items() for x in (k, v)])
    clean = F.upper(F.coalesce(F.element_at(alias, F.lower(F.trim(column))), F.trim(column)))
    bare = F.regexp_replace(clean, r"^(ESTADO DE |EDO\. )", "")
    named = df.withColumn("_clean", clean).withColumn("_bare", bare)
    clean, bare = F.col("_clean"), F.col("_bare")
    met = F.filter(states, lambda s: (bare != "") & (s["state"].contains(bare) | clean.contains(s["state"]) | bare.contains(s["state"])))
    ranked = F.transform(met, lambda s: F.struct(F.when(clean == s["state"], 0).when(bare == s["state"], 1).when(s["state"].contains(bare) | bare.contains(s["state"]), 2).alias("rank"), s["ordinal"], s["code"].alias("code")))
    return named.select(column, *[c for c in df.columns if c != column], F.array_min(ranked)["code"].alias("estado_inegi"))


def related_entities(clave: str, ec, ece_ec, cert, centro_ec, centros, sectores, comites) -> DataFrame:
    """The neighbourhood of one standard as (kind, id, name)."""
    one = ec.filter(F.col("ec_clave") == clave)
    parts = [
        related(cert, one.join(ece_ec, "ec_clave"), "cert_id").select(F.lit("certificador").alias("kind"), F.col("cert_id").alias("id"), F.col("nombre_legal").alias("name")),
        related(centros, one.join(centro_ec, "ec_clave"), "centro_id").select(F.lit("centro").alias("kind"), F.col("centro_id").alias("id"), F.col("nombre").alias("name")),
        related(sectores, one, "sector_id").select(F.lit("sector").alias("kind"), F.col("sector_id").cast("string").alias("id"), F.col("nombre").alias("name")),
        related(comites, one, "comite_id").select(F.lit("comite").alias("kind"), F.col("comite_id").cast("string").alias("id"), F.col("nombre").alias("name")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def snapshot_at(df: DataFrame, t) -> DataFrame:
    """Rows valid at t."""
    return df.filter((F.col("first_seen") <= F.lit(t)) & (F.col("last_seen") >= F.lit(t)))


#: An interval is cut into so many bins at most; longer ones go to the next level, whose bins are so many times as wide.
BINS, LEVELS = 16, 6


def snapshots_at(df: DataFrame, moments: DataFrame, days: int = 30) -> DataFrame:
    """Rows valid at each of moments(t), of any number: an equi-join on bins of time, then the exact bounds.

    An interval lies in the bins of the lowest level at which it covers no more than BINS of them, so long
    ones make few rows as well; a moment lies in one bin of every level. Rows without both bounds are valid at no
    moment; repeated moments and rows count each.
    """
    step = days * 86_400_000_000.0

    def micros(c):
        return F.unix_micros(F.col(c).cast("timestamp"))

    def bin_of(at, level):
        return F.floor(at / (F.lit(step) * F.pow(F.lit(float(BINS)), level))).cast("long")

    span = (micros("last_seen") - micros("first_seen")) / step
    level = F.lit(LEVELS - 1)
    for k in reversed(range(LEVELS - 1)):
        level = F.when(span <= float(BINS) ** (k + 1), k).otherwise(level)
    held = df.filter("first_seen <= last_seen").withColumn("_level", level.cast("int"))
    held = held.withColumn("_bin", F.explode(F.sequence(bin_of(micros("first_seen"), F.col("_level")), bin_of(micros("last_seen"), F.col("_level")))))
    asked = moments.filter("t is not null").withColumn("_level", F.explode(F.array(*[F.lit(k) for k in range(LEVELS)]))).withColumn("_bin", bin_of(micros("t"), F.col("_level")))
    met = held.join(asked, ["_level", "_bin"]).filter((F.col("first_seen") <= F.col("t")) & (F.col("last_seen") >= F.col("t")))
    return met.drop("_level", "_bin")


def cert_state_standards(cert, ece_ec):
    """Certifiers in force by state and kind: a row for each accreditation, or for a certifier without any, and different standards."""
    rows = cert.filter(F.col("estatus") == "Vigente").join(dealt(ece_ec.select("cert_id", "ec_clave"), "cert_id"), "cert_id", "left")
    each = dealt(rows.select("estado", "tipo", "ec_clave"), "estado", "tipo", "ec_clave").groupBy("estado", "tipo", "ec_clave").agg(F.count("*").alias("n"))
    return each.groupBy("estado", "tipo").agg(F.sum("n").alias("count"), F.count("ec_clave").alias("standards")).orderBy(F.desc("count"), "estado", "tipo")


def centros_of_cert(centros, cert_id):
    own = centros.filter(F.col("certificador_id") == cert_id)
    return own.groupBy("estado_inegi", "estado").agg(F.count("*").alias("centros")).withColumn("total", F.sum("centros").over(W.partitionBy(F.lit(1))))
