"""Queries of A, B, J and of the export shapes, with their SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from padron.operators import changes, exports
from padron.plans.catalog import query
from padron.schemas import DIFF_FIELDS_CERT, DIFF_FIELDS_EC, V1_COLUMNS
from padron.sources import scans, sinks
from padron.sources.merge_table import MergeTable

C = F.col

# ---- A: files are first derived from the tables, then scanned ----


@query("A1_scan_entity", "select ec_clave, titulo, vigente, nivel from ec")
def a1(r):
    path = sinks.scratch(r.spark, "ec")
    sinks.write_parquet(r.ec.withColumn("sector_id", C("sector_id").cast("int")).select("ec_clave", "titulo", "vigente", "sector_id", "nivel"), path)
    return scans.scan_entity(r.spark, path, "ec").select("ec_clave", "titulo", "vigente", "nivel")


@query("A2_scan_projected", "select p_partkey, p_name from part")
def a2(r):
    return scans.scan_projected(r.spark, f"{r.dir}/part.parquet", ["p_partkey", "p_name"])


_V1_TYPES = {"ec_standards": "ec_standard", "certificadores": "certificador", "evaluation_centers": "center", "courses": "course"}


@query("A2_scan_v1", " union all ".join(f"select '{t}' as entity, {len(V1_COLUMNS[t])} as columns, url, {'name' if t == 'courses' else 'code'} as label, {V1_COLUMNS[t][1 if t != 'courses' else 3]} as field from items where type = '{k}'" for t, k in _V1_TYPES.items()))
def a2b(r):
    path = sinks.scratch(r.spark, "v1")
    for t, kind in _V1_TYPES.items():
        # tables with more columns than are read
        df = r.items.filter(C("type") == kind)
        df.withColumns({c: F.lit(None).cast("string") for c in V1_COLUMNS[t] if c not in df.columns}).write.parquet(f"{path}/{t}")
    tables = scans.scan_v1(r.spark, path)
    return reduce(DataFrame.unionByName, [df.select(F.lit(t).alias("entity"), F.lit(len(df.columns)).alias("columns"), "url", C("name" if t == "courses" else "code").alias("label"), C(df.columns[1 if t != "courses" else 3]).alias("field")) for t, df in tables.items()])


@query("A3_scan_json_items", "select ec_clave, cast(null as string) as cert_id, titulo as title from ec union all select null, cert_id, nombre_legal from cert")
def a3(r):
    path = sinks.scratch(r.spark, "items")
    # objects with lists of at most a hundred items each, in as many files as there are tasks
    for name, df, key, title in (("ec", r.ec, "ec_clave", "titulo"), ("cert", r.cert, "cert_id", "nombre_legal")):
        part = F.expr(f"substr({key}, 1, length({key}) - 2)")
        df.groupBy(part.alias("part")).agg(F.collect_list(F.struct(key, C(title).alias("title"))).alias(name)).select(name).write.mode("append").json(path)
    return scans.scan_json_items(r.spark, path).select("ec_clave", "cert_id", "title")


@query("A4_scan_csv_items", "select cast(item_id as string) as item_id, coalesce(type, '(none)') as type, title from items where title <> ''")
def a4(r):
    path = sinks.scratch(r.spark, "csv")
    sinks.write_csv(r.items.filter("title <> ''").select("item_id", F.coalesce("type", F.lit("(none)")).alias("type"), C("title").alias("title")), path)
    return scans.scan_csv_items(r.spark, path, multi_line=True)


@query("A5_scan_baseline", "select ec_clave, titulo, vigente, sector_id, nivel from ec")
def a5(r):
    path = sinks.scratch(r.spark, "baseline")
    sinks.write_baseline({"ec": r.ec, "cert": r.cert}, path)
    return scans.scan_baseline(r.spark, path, "ec").select("ec_clave", "titulo", "vigente", "sector_id", "nivel")


def _maps(r):
    path = sinks.scratch(r.spark, "maps")
    r.pages.select("url", F.md5("url").alias("url_hash"), F.concat(F.lit("S"), (C("page_id") % 3).cast("string")).alias("session")).write.partitionBy("session").json(path)
    return path


@query("A6_scan_crawl_map", "select url, md5(url) as url_hash from pages")
def a6(r):
    return scans.scan_crawl_map(r.spark, _maps(r)).select("url", "url_hash")


def _captures(r):
    path = sinks.scratch(r.spark, "captures")
    log = r.request_log.select((C("event_id") % 2).cast("string").alias("session"), C("path").alias("request_url"), "method", C("duration").alias("duration_ms"))
    for s in ("1", "0"):
        log.filter(C("session") == s).repartition(3).write.mode("append").json(path)
    return path


@query("A7_scan_latest_capture", "select path as request_url, method, duration as duration_ms from request_log where event_id % 2 = 0")
def a7(r):
    return scans.scan_captures(r.spark, _captures(r)).select("request_url", "method", "duration_ms")


@query("A8_scan_pages", "select page_id, url from pages where url like '%/en/%' or url like '%/de/%'")
def a8(r):
    return scans.scan_pages(r.spark, f"{r.dir}/pages.parquet", ("/en/", "/de/")).select("page_id", "url")


@query("A9_scan_runs", "select harvest_id, status, start_time from runs where mode = 'harvest' order by start_time desc, harvest_id limit 10")
def a9(r):
    return scans.scan_runs(r.runs, "harvest").select("harvest_id", "status", "start_time")


@query("A10_list_crawl_maps", "select concat('S', cast(page_id % 3 as string)) as session, count(*) as urls from pages group by 1")
def a10(r):
    return scans.list_crawl_maps(r.spark, _maps(r)).select("session", "urls")


# ---- B: written, read again, compared with the source ----


@query("B1_write_json_envelope", "select 'cert' as entity, count(*) filter (tipo = 'ECE') as rows from cert union all select 'ec', count(*) from ec")
def b1(r):
    path = sinks.scratch(r.spark, "envelope")
    sinks.write_json_envelope({"ec": r.ec, "cert": r.cert}, path, {"tipo": "ECE"})
    return r.spark.read.json(f"{path}/metadata").select("entity", "rows")


@query("B2_write_csv", "select cert_id, tipo, nombre_legal, siglas, estado, estado_inegi, estatus from cert")
def b2(r):
    path = sinks.scratch(r.spark, "csv")
    sinks.write_csv(r.cert, path, ["cert_id", "tipo", "nombre_legal", "siglas", "estado", "estado_inegi", "estatus"])
    return scans.scan_csv_items(r.spark, path, multi_line=True)


@query("B3_write_parquet", "select cert_id, ec_clave, acreditado_desde from ece_ec")
def b3(r):
    path = sinks.scratch(r.spark, "parquet")
    sinks.write_parquet(r.ece_ec, path)
    return r.spark.read.parquet(path)


@query("B4_write_json_records", "select cert_id, strftime(fecha_acreditacion, '%Y-%m-%d') as fecha_acreditacion from cert")
def b4(r):
    path = sinks.scratch(r.spark, "records")
    sinks.write_json_records(r.cert.select("cert_id", "fecha_acreditacion"), path)
    return r.spark.read.schema("cert_id string, fecha_acreditacion string").json(path)


@query("B5_write_csv_v1", "select centro_id, nombre from centros")
def b5(r):
    path = sinks.scratch(r.spark, "v1")
    sinks.write_csv_v1(r.centros.select("centro_id", "nombre"), path, "centros", "20240101_000000")
    return scans.scan_csv_items(r.spark, f"{path}/centros_20240101_000000", multi_line=True)


_KNOWN = "from ece_ec where ec_clave in (select ec_clave from ec) and cert_id in (select cert_id from cert)"
_SHAPES = f"select 'graph' as format, 'nodes' as entity, (select count(*) from ec) + (select count(*) from cert) as n union all select 'graph', 'edges', count(*) {_KNOWN} union all select 'denormalized', 'ec', count(*) from ec union all select 'denormalized', 'cert', count(*) from cert union all select 'nested', 'ec', count(*) {_KNOWN} union all select 'nested', 'cert', count(*) {_KNOWN}"


@query("B6_write_bundle", " union all ".join(f"select '{f}' as format, '{t}' as entity, count(*) as n from {t}" for f in ("json", "csv", "parquet") for t in ("sectores", "comites", "cert")))
def b6(r):
    path = sinks.scratch(r.spark, "bundle")
    sinks.write_bundle({t: getattr(r, t) for t in ("sectores", "comites", "cert")}, path)
    read = {"json": r.spark.read.json, "csv": lambda p: r.spark.read.csv(p, header=True), "parquet": r.spark.read.parquet}
    return reduce(DataFrame.unionByName, [f(f"{path}/{k}/{t}").agg(F.lit(k).alias("format"), F.lit(t).alias("entity"), F.count("*").alias("n")) for k, f in read.items() for t in ("sectores", "comites", "cert")])


@query("B6_bundle_shapes", _SHAPES)
def b6b(r):
    path = sinks.scratch(r.spark, "bundle")
    sinks.write_bundle({"sectores": r.sectores}, path, ("json",), exports.bundle_shapes(r.ec, r.cert, r.ece_ec, r.centros, r.centro_ec))

    def total(folder, fmt, entity, n):
        return r.spark.read.json(f"{path}/{folder}").agg(F.lit(fmt).alias("format"), F.lit(entity).alias("entity"), n.alias("n"))

    sizes = {"ec": "certificadores", "cert": "estandares"}
    rows = [total(f"{f}/{e}", f, e, F.count("*")) for f, e in (("graph", "nodes"), ("graph", "edges"), ("denormalized", "ec"), ("denormalized", "cert"))]
    return reduce(DataFrame.unionByName, rows + [total(f"denormalized/{e}", "nested", e, F.sum(F.size(F.coalesce(c, F.array()))).cast("long")) for e, c in sizes.items()])


@query("B7_write_baseline", "select cert_id, tipo, nombre_legal, estado_inegi, estatus from cert")
def b7(r):
    path = sinks.scratch(r.spark, "baseline")
    sinks.write_baseline({"cert": r.cert}, path)
    return scans.scan_baseline(r.spark, path, "cert").select("cert_id", "tipo", "nombre_legal", "estado_inegi", "estatus")


@query("B8_write_quality_report", "select coalesce(type, '(all)') as type, count(*) as total from (select coalesce(type, '(none)') as type from items) group by rollup(type)")
def b8(r):
    from padron.functions import rules

    path = sinks.scratch(r.spark, "report")
    sinks.write_quality_report(rules.quality_report(rules.raw_errors(r.items)), path)
    return r.spark.read.json(path).select("type", "total")


_B11 = """select ec_clave, case when comite_id < 8 then titulo when comite_id in (10, 11) then 'new' else concat(titulo, ' v2') end as titulo,
    case when comite_id in (10, 11) then '2021' else '2020' end as first_year, case when comite_id < 8 then '2020' else '2021' end as last_year from ec where comite_id < 12"""


@query("B11_merge_sink", _B11)
def b11(r):
    table = MergeTable(r.spark, sinks.scratch(r.spark, "target"), "ec_clave", ["titulo"], buckets=16)
    table.merge(r.ec.filter("comite_id < 10").select("ec_clave", "titulo"), F.lit("2020-01-01").cast("timestamp"))
    old, new = r.ec.filter("comite_id in (8, 9)").select("ec_clave", F.concat("titulo", F.lit(" v2")).alias("titulo")), r.ec.filter("comite_id in (10, 11)").select("ec_clave", F.lit("new").alias("titulo"))
    out = sinks.merge_sink(table, old.unionByName(new), F.lit("2021-01-01").cast("timestamp"))
    return out.select("ec_clave", "titulo", F.date_format("first_seen", "yyyy").alias("first_year"), F.date_format("last_seen", "yyyy").alias("last_year"))


@query("B12_write_capture_analysis", "select method, count(*) as n, count(distinct path) as paths from request_log where path like '%/api/%' group by method")
def b12(r):
    path = sinks.scratch(r.spark, "analysis")
    sinks.write_capture_analysis(r.request_log, path)
    captures = r.spark.read.json(f"{path}/captures").groupBy("method").agg(F.count_distinct("path").alias("paths"))
    return r.spark.read.json(f"{path}/totals").join(captures, "method").select("method", "n", "paths")


@query("B13_append_entities", "select ec_clave, coalesce(case when comite_id = 1 then null else vigente end, true) as vigente from ec")
def b13(r):
    path = sinks.scratch(r.spark, "append")
    df = r.ec.select("ec_clave", F.when(C("comite_id") != 1, C("vigente")).alias("vigente"), "comite_id")
    for half in ("comite_id < 12", "comite_id >= 12"):
        sinks.append_entities(df.filter(half).drop("comite_id"), path)
    return r.spark.read.parquet(path).select("ec_clave", "vigente")


@query("B14_write_paged_bundle", "select count(*) as n, true as bounded from ec")
def b14(r):
    path = sinks.scratch(r.spark, "paged")
    sinks.write_paged(r.ec, path, 100)
    files = r.spark.read.json(path).select("ec_clave", "_metadata.file_path").groupBy("file_path").agg(F.count("*").alias("n"))
    return files.agg(F.sum("n").alias("n"), (F.max("n") <= 100).alias("bounded"))


# ---- J ----

_T1, _T2 = "1997-01-01 00:00:00", "2001-06-01 00:00:00"
_FIELDS = ["titulo", "vigente", "sector_id", "nivel"]


def _snap(t, table="ec_history", key="ec_clave"):
    return f"(select * from (select *, row_number() over (partition by {key} order by last_seen desc, version desc) as rn from {table} where first_seen <= timestamp '{t}' and last_seen >= timestamp '{t}') where rn = 1)"


def _ops(t1=_T1, t2=_T2):
    changed = " or ".join(f"b.{f} is distinct from a.{f}" for f in _FIELDS)
    return f"select coalesce(a.ec_clave, b.ec_clave) as ec_clave, case when b.ec_clave is null then 'added' when a.ec_clave is null then 'removed' when {changed} then 'modified' else 'unchanged' end as op, b.titulo as old_titulo, a.titulo as new_titulo, b.vigente as old_vigente, a.vigente as new_vigente from {_snap(t1)} b full join {_snap(t2)} a on a.ec_clave = b.ec_clave"


def _diff(r, t1=_T1, t2=_T2):
    return changes.diff(r.ec_history, t1, t2, "ec_clave", _FIELDS, "version")


@query("J1_diff_snapshots", f"select ec_clave, op from ({_ops()})")
def j1(r):
    return _diff(r).select("ec_clave", "op")


# the fields that the history lacks, as functions of those it has; equal content hashes stand for equal rows
_EC_MORE = {
    "comite_id": "sector_id * 5 + case when version = 'R' then 1 else 0 end", "descripcion": "case when sector_id = 1 then concat('D', version) else 'D' end",
    "duracion_horas": "case when nivel = '2' and version = 'N' then 20 else 10 end", "tipo_norma": "case when sector_id = 2 then version end",
    "fecha_publicacion": "case when sector_id = 3 then cast(first_seen as date) end", "fecha_vigencia": "case when nivel = '5' then cast(last_seen as date) end",
    "perfil_evaluador": "case when nivel = '1' then concat('P', version) end", "content_hash": "case when sector_id = 0 then md5(ec_clave) when nivel = '3' then md5(version) end",
}
_CERT_MORE = {
    "siglas": "concat('S', version)", "domicilio_texto": "case when estatus = 'Vigente' then concat('Calle ', cert_id) end", "municipio": "case when tipo = 'OC' then version end",
    "telefono": "case when version = 'A' then '55' else '56' end", "correo": "concat(lower(cert_id), '@cert.mx')", "sitio_web": "case when version <> 'N' then cert_id end",
    "representante_legal": "case when cert_id like '%1' then version end", "content_hash": "case when cert_id like '%7' then md5(cert_id) end",
}


def _full(table, more):
    return f"(select *, {', '.join(f'{e} as {f}' for f, e in more.items())} from {table})"


def _changes_sql(table, key, fields, more):
    one = "select {k}, '{f}' as field, cast(old_{f} as string) as before, cast(new_{f} as string) as after from m where old_{f} is distinct from new_{f}"
    sides = ", ".join(f"b.{f} as old_{f}, a.{f} as new_{f}" for f in fields)
    t1, t2 = (_snap(t, _full(table, more), key) for t in (_T1, _T2))
    return f"with m as (select a.{key}, {sides} from {t1} b join {t2} a on a.{key} = b.{key} where not coalesce(a.content_hash = b.content_hash, false)) " + " union all ".join(one.format(k=key, f=f) for f in fields)


def _changes(df, key, fields, more):
    full = df.withColumns({f: F.expr(e) for f, e in more.items()})
    return changes.diff(full, _T1, _T2, key, fields, "version", hash="content_hash").select(key, F.explode("changes").alias("c")).select(key, "c.*")


@query("J2_field_changes_ec", _changes_sql("ec_history", "ec_clave", DIFF_FIELDS_EC, _EC_MORE))
def j2(r):
    return _changes(r.ec_history, "ec_clave", DIFF_FIELDS_EC, _EC_MORE)


@query("J3_field_changes_cert_fields", _changes_sql("cert_history", "cert_id", DIFF_FIELDS_CERT, _CERT_MORE))
def j3a(r):
    return _changes(r.cert_history, "cert_id", DIFF_FIELDS_CERT, _CERT_MORE)


_CERT = "select cert_id, tipo, nombre_legal, estatus, estado, version, first_seen, last_seen from cert_history"
_CODES = "(select cert_id, list_sort(list(ec_clave)) as codes from ece_ec where acreditado_desde < date '{d}' group by cert_id)"


@query("J3_field_changes_cert", f"select c.cert_id, len(list_filter(coalesce(b.codes, []), lambda x: not list_contains(coalesce(a.codes, []), x))) as added, len(list_filter(coalesce(a.codes, []), lambda x: not list_contains(coalesce(b.codes, []), x))) as removed, len(coalesce(a.codes, [])) as n_before, len(coalesce(b.codes, [])) as n_after from cert c left join {_CODES.format(d='1995-02-01')} a on c.cert_id = a.cert_id left join {_CODES.format(d='1995-06-01')} b on c.cert_id = b.cert_id")
def j3(r):
    def state(d):
        codes = r.ece_ec.filter(C("acreditado_desde") < d).groupBy("cert_id").agg(F.collect_list("ec_clave").alias("codes"))
        return r.cert.join(codes, "cert_id", "left")
    out = changes.compare(state("1995-02-01"), state("1995-06-01"), "cert_id", ["tipo", "nombre_legal", "estatus"], lists="codes")
    return out.select("cert_id", *[F.size(f"list.{f}").cast("long").alias(f) for f in ("added", "removed")], *[C(f"list.{f}").cast("long").alias(f) for f in ("n_before", "n_after")])


@query("J4_diff_stats", f"select op as stat, count(*) as n from ({_ops()}) group by op union all select 'field_titulo', count(*) from ({_ops()}) where op = 'modified' and old_titulo is distinct from new_titulo union all select 'field_vigente', count(*) from ({_ops()}) where op = 'modified' and old_vigente is distinct from new_vigente")
def j4(r):
    return changes.diff_stats(_diff(r))


_CT = ("1997-01-01 00:00:00", "2001-01-01 00:00:00")


def _cert_diff(r):
    return changes.diff(r.cert_history, *_CT, "cert_id", ["tipo", "nombre_legal", "estatus", "estado"], "version")


def _cert_ops():
    return f"select coalesce(a.cert_id, b.cert_id) as cert_id, case when b.cert_id is null then 'added' when a.cert_id is null then 'removed' when b.estatus is distinct from a.estatus then 'modified' else 'unchanged' end as op from {_snap(_CT[0], 'cert_history', 'cert_id')} b full join {_snap(_CT[1], 'cert_history', 'cert_id')} a on a.cert_id = b.cert_id"


@query("J4_diff_stats_cert", f"select op as stat, count(*) as n from ({_cert_ops()}) group by op union all select s, count(*) from ({_cert_ops()}) cross join (select 'field_estatus' as s) where op = 'modified' group by s union all select 'status_changes', count(*) from ({_cert_ops()}) where op = 'modified' union all select 'accreditation_changes', 0 union all select concat('tipo_', tipo), count(*) from {_snap(_CT[1], 'cert_history', 'cert_id')} group by tipo")
def j4b(r):
    from padron.operators.choose import latest
    from padron.operators.joins import snapshot_at

    later = latest(snapshot_at(r.cert_history, _CT[1]), ["cert_id"], "last_seen", "version")
    return changes.diff_stats_cert(_cert_diff(r), later)


@query("J5_diff_summary", f"select case when grouping(entity) = 1 then '(all)' else entity end as entity, case when grouping(op) = 1 then '(all)' else op end as op, count(*) as n from (select 'ec' as entity, op from ({_ops()}) union all select 'cert', op from ({_cert_ops()})) group by cube(entity, op)")
def j5(r):
    return changes.diff_summary({"ec": _diff(r), "cert": _cert_diff(r)})


_B1 = "select ec_clave, titulo, nivel from ec where comite_id < 20"
_B2 = "select ec_clave, case when comite_id = 7 then concat(titulo, '!') else titulo end as titulo, nivel from ec where comite_id > 2"


@query("J6_diff_baseline", f"select coalesce(a.ec_clave, b.ec_clave) as ec_clave, case when b.ec_clave is null then 'added' when a.ec_clave is null then 'removed' when a.titulo <> b.titulo then 'modified' else 'unchanged' end as op from ({_B2}) a full join ({_B1}) b on a.ec_clave = b.ec_clave")
def j6(r):
    return changes.diff_baseline(r.sql(_B2), r.sql(_B1), "ec_clave")


@query("J7_edge_diff", "select cert_id, ec_clave, 'removed' as op from ece_ec where ec_clave like '%1' and acreditado_desde < date '1999-01-01' and ec_clave not like '%01' union all select cert_id, ec_clave, 'added' from ece_ec where ec_clave like '%01' and acreditado_desde >= date '1999-01-01'")
def j7(r):
    a = r.ece_ec.filter("ec_clave like '%1' and acreditado_desde < date '1999-01-01'")
    b = r.ece_ec.filter("ec_clave like '%01'")
    return changes.edge_diff(a, b, ["cert_id", "ec_clave"])


@query("J8_drift_check", "select * from (select component as name, cast(ts as date) as run, count(*) as n, lag(count(*)) over (partition by component order by cast(ts as date)) as before, count(*) < 0.9 * lag(count(*)) over (partition by component order by cast(ts as date)) as severe from request_log group by 1, 2) where before is not null")
def j8(r):
    counts = r.request_log.groupBy(C("component").alias("name"), F.to_date("ts").alias("run")).agg(F.count("*").alias("n"))
    return changes.drift(counts, 0.1)


@query("J9_changed_pages", "select page_id, url, 1 as fetch from pages where page_id % 5 = 0")
def j9(r):
    return changes.changed_pages(r.fetch_log)


@query("B9_write_diff_json", f"select 'ec' as entity, op, count(*) as n from ({_ops()}) where op <> 'unchanged' group by op union all select 'cert', op, count(*) from ({_cert_ops()}) where op <> 'unchanged' group by op")
def b9(r):
    path = sinks.scratch(r.spark, "diff")
    sinks.write_diff({"ec": _diff(r), "cert": _cert_diff(r)}, path, {"ec": "ec_clave", "cert": "cert_id"})
    return r.spark.read.json(path).groupBy("entity", "op").agg(F.count("*").alias("n"))


@query("B10_diff_report_rows", f"select op, max(n) as n, concat(string_agg(ec_clave, ', ' order by ec_clave) filter (i <= 5), case when max(n) > 5 then concat(' ... ', cast(max(n) - 5 as string), ' more') else '' end) as line from (select op, ec_clave, row_number() over (partition by op order by ec_clave) as i, count(*) over (partition by op) as n from ({_ops()}) where op <> 'unchanged') group by op")
def b10(r):
    return changes.diff_report_rows(_diff(r), "ec_clave")


# ---- export shapes ----


@query("K10_graph_nodes_edges", "select 'node' as what, concat('ec_', ec_clave) as a, 'ec' as b from ec union all select 'node', concat('cert_', cert_id), 'cert' from cert union all select 'edge', concat('cert_', cert_id), concat('ec_', ec_clave) from ece_ec")
def k10(r):
    nodes, edges = exports.graph_nodes_edges(r.ec, r.cert, r.ece_ec)
    return nodes.select(F.lit("node").alias("what"), C("id").alias("a"), C("kind").alias("b")).unionByName(edges.select(F.lit("edge").alias("what"), C("source").alias("a"), C("target").alias("b")))


@query("K11_denormalize", "select e.ec_clave, x.certificadores, y.centros from ec e left join (select ec_clave, string_agg(c.cert_id, ',' order by c.cert_id) as certificadores from ece_ec join cert c on ece_ec.cert_id = c.cert_id group by ec_clave) x on e.ec_clave = x.ec_clave left join (select ec_clave, string_agg(c.centro_id, ',' order by c.centro_id) as centros from centro_ec join centros c on centro_ec.centro_id = c.centro_id group by ec_clave) y on e.ec_clave = y.ec_clave")
def k11(r):
    out = exports.denormalize_ec(r.ec, r.cert, r.ece_ec, r.centros, r.centro_ec)
    return out.select("ec_clave", *[F.array_join(C(f"{c}.{i}"), ",").alias(c) for c, i in (("certificadores", "cert_id"), ("centros", "centro_id"))])


@query("K11_denormalize_cert", "select c.cert_id, x.estandares from cert c left join (select cert_id, string_agg(ec_clave, ',' order by ec_clave) as estandares from ece_ec where ec_clave in (select ec_clave from ec) group by cert_id) x on c.cert_id = x.cert_id")
def k11b(r):
    lists = r.ece_ec.groupBy("cert_id").agg(F.concat(F.collect_list("ec_clave"), F.array(F.lit("EC9999X"))).alias("codes"))
    return exports.denormalize_cert(r.cert, r.ec, lists).select("cert_id", F.array_join(F.transform("estandares", lambda x: x["ec_clave"]), ",").alias("estandares"))


@query("K12_location_dim", "select estado, estado_inegi, municipio, cp, sha256(concat_ws('|', estado, estado_inegi, municipio, cp)) as location_id from (select estado, estado_inegi, municipio, cp from cert union select estado, estado_inegi, municipio, cp from centros)")
def k12(r):
    return exports.location_dim(r.cert, r.centros)
