"""E: statistics of the registry, its runs and its request log."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from padron.operators.joins import count_children, orphans
from padron.sources.storage import dealt


def _union(frames):
    return reduce(DataFrame.unionByName, frames)


def centros_stats(df):
    n, m = F.count("*"), F.countDistinct("municipio")
    return df.groupBy("estado_inegi", "estado").agg(n.alias("centros"), m.alias("municipios"), F.when(m > 0, F.round(n / m, 2)).otherwise(F.lit(0.0)).alias("por_municipio")).orderBy(F.desc("centros"), "estado_inegi", "estado")


def centros_national(df):
    """National totals; municipalities are summed over states, not counted again."""
    s = centros_stats(df)
    return s.agg(F.sum("centros").alias("centros"), F.sum("municipios").alias("municipios"), F.count("*").alias("estados"), F.round(F.sum("centros") / F.count("*"), 2).alias("por_estado"))


def cert_stats(df):
    p = df.groupBy("estado_inegi").pivot("tipo", ["ECE", "OC"]).agg(F.count(F.lit(1)))
    names = df.groupBy("estado_inegi").agg(F.min("estado").alias("estado"))
    filled = p.select("estado_inegi", F.coalesce("ECE", F.lit(0)).alias("ece"), F.coalesce("OC", F.lit(0)).alias("oc"))
    return filled.join(names, "estado_inegi").withColumn("total", F.col("ece") + F.col("oc")).orderBy(F.desc("total"), "estado_inegi")


def cert_national(df):
    return df.agg(F.count_if(F.col("tipo") == "ECE").alias("ece"), F.count_if(F.col("tipo") == "OC").alias("oc"), F.count("*").alias("total"))


def cert_in_state(df, code, tipo=None):
    own = df.filter(F.col("estado_inegi") == code)
    if tipo:
        own = own.filter(F.col("tipo") == tipo)
    totals = own.agg(F.count("*").alias("total"), F.count_if(F.col("tipo") == "ECE").alias("ece"), F.count_if(F.col("tipo") == "OC").alias("oc"))
    return own.select("cert_id", "tipo", "nombre_legal").crossJoin(F.broadcast(totals))  # totals is one row


def centros_in_state(df, code):
    own = df.filter(F.col("estado_inegi") == code)
    groups = own.groupBy("municipio").agg(F.count("*").alias("n"), F.array_join(F.sort_array(F.collect_list("centro_id")), ",").alias("centros"))
    n = own.agg(F.countDistinct("municipio").alias("municipios"))
    return groups.crossJoin(F.broadcast(n))  # n is one row


def sector_stats(sectores, ec, comites):
    """Standards and committees of each sector; each side is counted before it is joined."""
    s = count_children(sectores, ec.select("sector_id", "ec_clave").distinct(), "sector_id", "estandares")
    return count_children(s, comites.select("sector_id", "comite_id").distinct(), "sector_id", "comites").orderBy(F.desc("estandares"), "sector_id")


def registry_totals(sectores, comites, ec):
    counts = [sectores.agg(F.count("*").alias("sectores")), comites.agg(F.count("*").alias("comites")),
              ec.agg(F.countDistinct("ec_clave").alias("estandares"), F.count_if("vigente").alias("activos"))]
    one = reduce(lambda a, b: a.crossJoin(F.broadcast(b)), counts)  # one row each
    return one.withColumn("inactivos", F.col("estandares") - F.col("activos"))


def sectors_without(sectores, ec):
    return sectores.join(ec.select("sector_id"), "sector_id", "left_anti")


def item_summary(df, dims=("type", "status", "sector")):
    """Totals by each of dims in one pass, in long form (dimension, value, n)."""
    sets = df.groupingSets([[F.col(d)] for d in dims], *[F.col(d) for d in dims]).agg(F.count("*").alias("n"), F.grouping_id().alias("g"))
    which = reduce(lambda c, i: c.when(F.col("g") == ((1 << len(dims)) - 1) ^ (1 << (len(dims) - 1 - i)), dims[i]), range(len(dims)), F.when(F.lit(False), ""))
    value = reduce(lambda c, i: c.when(which == dims[i], F.col(dims[i]).cast("string")), range(len(dims)), F.when(F.lit(False), ""))
    return sets.select(which.alias("dimension"), value.alias("value"), "n")


def coverage(df, cols, entity):
    """Share of filled fields as a percentage with one decimal; 0% without rows."""
    total = F.count("*")
    aggs = [F.when(total == 0, F.lit("0%")).otherwise(F.format_string("%.1f%%", F.round(F.lit(100.0) * F.count(c) / total, 1))).alias(c) for c in cols]
    one = df.agg(*aggs)
    return one.select(F.explode(F.array(*[F.struct(F.lit(entity).alias("entity"), F.lit(c).alias("field"), F.col(c).alias("filled")) for c in cols])).alias("r")).select("r.*")


def duplicate_keys(df, *keys):
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def relationship_issues(centros, cert, courses, ec):
    parts = [
        orphans(centros, cert, "certificador_id", "cert_id").agg(F.lit("orphan_centros").alias("issue"), F.count("*").alias("n")),
        orphans(courses, ec, "ec_code", "ec_clave").agg(F.lit("orphan_courses").alias("issue"), F.count("*").alias("n")),
        duplicate_keys(ec, "ec_clave").agg(F.lit("duplicate_codes").alias("issue"), F.count("*").alias("n")),
    ]
    return _union(parts).filter("n > 0")


def freshness(frames: dict, now, days: int = 7, runs=None):
    """Rows and stale rows of each entity at `now`; the alert is raised by any stale row. With runs, also the last
    one that was completed and its end."""
    parts = [df.agg(F.lit(name).alias("entity"), F.count("*").alias("total"), F.count_if(F.col("last_seen") < F.lit(now).cast("timestamp") - F.expr(f"interval {days} days")).alias("stale")) for name, df in frames.items()]
    out = _union(parts).withColumn("alert", F.col("stale") > 0)
    if runs is None:
        return out
    done = F.when(F.col("status") == "completed", F.struct("start_time", "harvest_id"))
    last = runs.agg(F.max(F.struct(done.alias("k"), F.col("end_time"))).alias("r")).select(F.col("r.k.harvest_id").alias("last_run"), F.when(F.col("r.k").isNotNull(), F.col("r.end_time")).alias("last_end"))
    return out.crossJoin(F.broadcast(last))  # one row


def split_archive(runs, now, days: int = 90):
    """Runs that ended more than `days` before now, with the month they are archived under."""
    return runs.filter(F.col("end_time") < F.lit(now).cast("timestamp") - F.expr(f"interval {days} days")).withColumn("month", F.date_format("end_time", "yyyy-MM"))


def archive_runs(runs, now, path: str, days: int = 90):
    """Write old runs below path, a folder a month; months that are archived again are replaced. The runs that stay,
    those without an end among them."""
    split_archive(runs, now, days).repartition("month").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(path)
    return runs.filter(F.col("end_time").isNull() | (F.col("end_time") >= F.lit(now).cast("timestamp") - F.expr(f"interval {days} days")))


def url_type_counts(df, column="type"):
    return df.groupBy(F.coalesce(F.col(column), F.lit("unknown")).alias("type")).agg(F.count("*").alias("n")).orderBy("type")


def endpoint_counts(log):
    api = log.filter(F.col("path").contains("/api/"))
    return api.groupBy("method", F.col("path").alias("url")).agg(F.count("*").alias("n")).orderBy("method", "url")


def component_progress(log):
    """Of each component successes, total, their share, mean response and last request; and the share of all components."""
    ok = F.count_if(F.col("status") == 200)
    rows = log.groupBy("component").agg(ok.alias("scraped"), F.count("*").alias("total"), F.round(F.lit(100.0) * ok / F.count("*"), 1).alias("success_pct"), F.round(F.avg("duration"), 4).alias("avg_response"), F.max("ts").alias("last_updated"))
    overall = rows.agg(F.round(F.lit(100.0) * F.sum("scraped") / F.sum("total"), 1).alias("overall_pct"))
    return rows.crossJoin(F.broadcast(overall))  # one row


def error_summary(log, limit=50):
    bad = log.filter("status >= 400")
    total = log.agg(F.count("*").alias("requests"))
    rows = bad.groupBy("component", "status", "path").agg(F.count("*").alias("n"), F.max("ts").alias("latest")).orderBy(F.desc("n"), "component", "path").limit(limit)
    return rows.crossJoin(F.broadcast(total)).withColumn("rate", F.round(F.col("n") / F.col("requests"), 6)).drop("requests")  # one row


def topk(df, keys, k=10):
    return df.groupBy(*keys).agg(F.count("*").alias("n")).orderBy(F.desc("n"), *keys).limit(k)


def sum_by(df, keys, column):
    return df.groupBy(*keys).agg(F.sum(column).alias("total"))


def hit_ratio(df, keys, hit):
    return df.groupBy(*keys).agg(F.round(F.try_divide(F.lit(100.0) * F.count_if(hit), F.count("*")), 4).alias("hit_pct"))


def run_stats(runs):
    seconds = F.unix_timestamp("end_time") - F.unix_timestamp("start_time")
    return runs.select("harvest_id", "items", "pages", "errors", seconds.alias("seconds"), F.when(seconds > 0, F.round(F.col("items") / seconds, 6)).otherwise(F.lit(0.0)).alias("items_per_second"))


def table_counts(frames: dict):
    return _union([df.agg(F.lit(name).alias("name"), F.count("*").alias("n")) for name, df in frames.items()])


def state_density(cert, states):
    """Certifiers of every state, 0 included. states(estado_inegi)."""
    return count_children(states, cert, "estado_inegi", "certificadores")


def timeline(df, key, unit="month"):
    event = F.explode(F.array(F.struct(F.lit("new").alias("event"), F.col("first_seen").alias("at")), F.struct(F.lit("retired").alias("event"), F.col("last_seen").alias("at"))))
    span = df.groupBy(key).agg(F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"))
    return span.select(event.alias("e")).groupBy(F.date_format(F.date_trunc(unit, "e.at"), "yyyy-MM-dd").alias("period"), F.col("e.event").alias("event")).agg(F.count("*").alias("n"))


def sector_flow(ec, ece_ec):
    """The flow from sectors through standards to certifiers: (level, source, target, weight). A sector's flow to a standard
    is the standard's number of certifiers; a standard without any has none. Edges are dealt by standard once, for the join and both counts."""
    edges = ec.select("ec_clave", F.col("sector_id").cast("string").alias("sector")).join(dealt(ece_ec.select("ec_clave", "cert_id"), "ec_clave"), "ec_clave")
    upper = edges.groupBy(F.lit("sector-standard").alias("level"), F.col("sector").alias("source"), F.col("ec_clave").alias("target")).agg(F.count("*").alias("weight"))
    return upper.unionByName(edges.groupBy(F.lit("standard-cert").alias("level"), F.col("ec_clave").alias("source"), F.col("cert_id").alias("target")).agg(F.count("*").alias("weight")))


def cert_overview(cert, k=5):
    totals = cert.agg(F.count("*").alias("total"), F.count_if(F.col("tipo") == "ECE").alias("ece"), F.count_if(F.col("tipo") == "OC").alias("oc"), F.count_if(F.col("estatus") == "Vigente").alias("activos"), F.min("fecha_acreditacion").alias("desde"), F.max("fecha_acreditacion").alias("hasta"))
    top = topk(cert, ["estado"], k).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("o"), "estado"))), lambda x: x["estado"]), ",").alias("top_estados"))
    return totals.crossJoin(F.broadcast(top))  # one row each


def centros_overview(centros, edge, k=5):
    per = edge.groupBy("centro_id").agg(F.count("*").alias("n"))
    joined = centros.join(per, "centro_id", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    totals = joined.agg(F.count("*").alias("total"), F.round(F.avg("n"), 6).alias("standards_per_centro"))
    for name, col in (("top_estados", "estado"), ("top_certificadores", "certificador_id")):
        top = topk(centros, [col], k).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("o"), F.col(col).alias("c")))), lambda x: x["c"]), ",").alias(name))
        totals = totals.crossJoin(F.broadcast(top))  # one row each
    return totals


def sector_overview(sectores, comites, ec, k=3):
    ranked = count_children(sectores, ec, "sector_id", "n").orderBy(F.desc("n"), "sector_id").limit(k)
    top = ranked.agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("o"), F.col("sector_id").alias("i"), "nombre"))), lambda x: x["nombre"]), ",").alias("top_sectores"))
    return sectores.agg(F.count("*").alias("sectores")).crossJoin(F.broadcast(comites.agg(F.count("*").alias("comites")))).crossJoin(F.broadcast(top))  # one row each


def last_update(frames: dict):
    """Newest row of each table: (name, key, last_seen)."""
    return _union([df.agg(F.lit(name).alias("name"), F.max_by(key, F.struct("last_seen", key)).alias("key"), F.max("last_seen").alias("last_seen")) for name, (df, key) in frames.items()])


def reachability(fetch_log, topic: str = "topic"):
    kind = F.when(F.col("status") != 200, F.concat(F.lit("failed_"), F.col("status").cast("string"))).when(F.col(topic), "with_topic").otherwise("reachable")
    return fetch_log.groupBy(kind.alias("outcome")).agg(F.count("*").alias("n"))


def run_summary(log, reported=None):
    """Of each day and component requests, failures, elapsed seconds and bytes; the coverage is the share of successes
    of the totals that reported(component, reported) tells, or of the requests without it."""
    bad = F.count_if(F.col("status") >= 400)
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    rows = log.groupBy(F.to_date("ts").alias("run"), "component").agg(F.count("*").alias("requests"), bad.alias("failures"), F.round((F.max(at) - F.min(at)) / 1e6, 3).alias("elapsed"), F.sum(F.length("props")).alias("bytes"))
    rows = rows.withColumn("reported", F.col("requests")) if reported is None else rows.join(reported, "component", "left")
    return rows.withColumn("coverage_pct", F.round(F.lit(100.0) * F.try_divide(F.col("requests") - F.col("failures"), "reported"), 4)).drop("reported")
