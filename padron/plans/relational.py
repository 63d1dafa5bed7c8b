"""Queries of C, D, E, F and G over the registry views, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from padron.operators import aggregates as agg
from padron.operators import choose, joins, listing, sets
from padron.operators.wordindex import WordIndex
from padron.plans.catalog import query
from padron.sources.storage import scratch
from padron.streaming import metrics

# ---- C ----


@query("C1_list_ec", """select e.ec_clave, e.titulo, h.version, e.vigente, s.nombre as sector, e.sector_id, e.nivel, e.duracion_horas, h.last_seen
    from ec e left join sectores s on s.sector_id = e.sector_id
    left join (select ec_clave, version, last_seen, row_number() over (partition by ec_clave order by last_seen desc, version desc) as rn from ec_history) h on h.ec_clave = e.ec_clave and rn = 1
    where e.vigente = true and e.sector_id = 1 and (e.ec_clave ilike '%a%' or e.titulo ilike '%a%') order by e.ec_clave limit 100 offset 20""")
def c1(r):
    newest = choose.latest(r.ec_history, ["ec_clave"], "last_seen", "version").select("ec_clave", "version", "last_seen")
    ec = r.ec.join(r.sectores.withColumnRenamed("nombre", "sector"), "sector_id", "left").join(newest, "ec_clave", "left")
    return listing.list_ec(ec, vigente=True, sector_id=1, search="a", skip=20)


@query("C2_list_cert", "select cert_id, tipo, nombre_legal, siglas, estatus, estado, estado_inegi from cert where tipo = 'ECE' and estatus = 'Vigente' and (cert_id ilike '%1%' or nombre_legal ilike '%1%' or siglas ilike '%1%') order by cert_id limit 100")
def c2(r):
    return listing.list_cert(r.cert, tipo="ece", estatus="Vigente", search="1")


@query("C3_list_centros", "select centro_id, nombre, municipio, estado, estado_inegi, certificador_id from centros where estado_inegi = '03' and municipio ilike '%build%' and (centro_id ilike '%0%' or nombre ilike '%0%') order by centro_id limit 100")
def c3(r):
    return listing.list_centros(r.centros, estado_inegi="03", municipio="build", search="0")


@query("C4_list_sectores", "select s.sector_id, nombre, coalesce(n, 0) as num_estandares from sectores s left join (select sector_id, count(*) as n from ec group by sector_id) c on s.sector_id = c.sector_id where nombre ilike '%a%' order by s.sector_id limit 100")
def c4(r):
    return listing.list_sectores(r.sectores, r.ec, search="a")


@query("C5_list_comites", "select c.comite_id, c.nombre, c.sector_id, coalesce(s.nombre, 'Unknown') as sector_nombre, coalesce(n, 0) as num_estandares from comites c left join sectores s on c.sector_id = s.sector_id left join (select comite_id, count(*) as n from ec group by comite_id) e on c.comite_id = e.comite_id where c.nombre ilike '%1%' order by c.comite_id limit 100")
def c5(r):
    return listing.list_comites(r.comites, r.sectores, r.ec, search="1")


@query("C6_multi_field_search", "select ec_clave, titulo from ec where lower(ec_clave) like '%ring%' or lower(titulo) like '%ring%'")
def c6(r):
    return listing.multi_field_search(r.ec.select("ec_clave", "titulo"), "RING", ["ec_clave", "titulo"])


@query("C7_prefix_search", "select cert_id as value, concat(cert_id, ' - ', case when length(nombre_legal) > 12 then concat(substr(nombre_legal, 1, 12), '...') else nombre_legal end, concat(' (', siglas, ')')) as label from cert where cert_id ilike 'EC%' or nombre_legal ilike '%EC%' order by cert_id limit 5")
def c7(r):
    return listing.suggest(r.cert, "ec", "cert_id", "nombre_legal", limit=5, cut=12, siglas="siglas")


@query("C8_paginate", "select ec_clave, titulo, t.total, cast(ceil(t.total / 25.0) as bigint) as pages from (select ec_clave, titulo from ec order by ec_clave limit 25 offset 50) cross join (select count(*) as total from ec) t")
def c8(r):
    return listing.paginate(r.ec.select("ec_clave", "titulo"), ["ec_clave"], 3, 25)


@query("C9_date_range_filter", "select cert_id, ec_clave, acreditado_desde from ece_ec where acreditado_desde >= date '1996-01-01' and acreditado_desde <= date '1996-03-31'")
def c9(r):
    return listing.date_range_filter(r.ece_ec, "acreditado_desde", "1996-01-01", "1996-03-31")


@query("C10_export_filters", "select cert_id, tipo, estado_inegi from cert where tipo = 'OC' and estado_inegi in ('01', '02', '03', '04')")
def c10(r):
    return listing.apply_filters(r.cert, "cert", {"tipo": "OC", "estado_inegi": ["01", "02", "03", "04"], "other": 1}).select("cert_id", "tipo", "estado_inegi")


@query("C11_incremental_since", "select ec_clave, version, last_seen from ec_history where last_seen >= timestamp '2001-06-01 00:00:00'")
def c11(r):
    return listing.since(r.ec_history, "2001-06-01").select("ec_clave", "version", "last_seen")


_STATUS = "case when item_id % 3 = 0 then 'invalid' else 'valid' end"


@query("C12_item_explorer", f"select type, code, title, {_STATUS} as status from items where type = 'ec_standard' and {_STATUS} = 'valid' and (title ilike '%the%' or code ilike '%the%') order by type, code, item_id limit 20 offset 20")
def c12(r):
    return listing.item_explorer(r.items.withColumn("status", F.expr(_STATUS)), type="ec_standard", status="valid", q="the", number=2, per_page=20)


@query("C13_point_lookup", "select ec_clave, titulo, sector_id from ec where ec_clave = 'EC0017'")
def c13(r):
    return listing.by_key(r.ec, "ec_clave", "EC0017", r"^EC\d{4}$").select("ec_clave", "titulo", "sector_id")


@query("C14_cache_warm_projection", "select ec_clave as id, titulo as name from ec where vigente union all select cert_id, nombre_legal from cert where estatus = 'Vigente'")
def c14(r):
    e = listing.hot_subset_ec(r.ec).select(F.col("ec_clave").alias("id"), F.col("titulo").alias("name"))
    return e.unionByName(listing.hot_subset_cert(r.cert).select(F.col("cert_id").alias("id"), F.col("nombre_legal").alias("name")))


@query("C15_token_search", "select ec_clave, titulo from ec where list_has_any(string_split_regex(lower(titulo), '[^a-z0-9]+'), ['ring', 'small'])")
def c15(r):
    return listing.token_search(r.ec, "Ríng SMALL", ["titulo"]).select("ec_clave", "titulo")


_NOW = "(select ec_clave, case when comite_id < 5 then 'SMALL thing' else titulo end as titulo, descripcion from ec)"
_FOUND = "list_filter(['ring', 'small', 's2'], lambda w: list_contains(string_split_regex(lower({0}), '[^a-z0-9]+'), w))"


@query("C15_index_matches", f"select ec_clave, titulo from {_NOW} where len({_FOUND.format('titulo')}) > 0")
def c15b(r):
    index = WordIndex(r.spark, scratch(r.spark, "words"), 32)
    index.add(r.ec, "ec", "ec_clave", ["titulo"], 0)
    # the titles of some committees change; what the index knew of them is no match any more
    now = r.ec.withColumn("titulo", F.when(F.col("comite_id") < 5, "SMALL thing").otherwise(F.col("titulo")))
    index.add(now.filter("comite_id < 5"), "ec", "ec_clave", ["titulo"], 1)
    return index.matches(now, "ec", "ec_clave", ["titulo"], "Ríng small S2").select("ec_clave", "titulo")


_TEXTS = "(select 'ec' as entity, ec_clave as key, concat_ws(' ', titulo, descripcion) as t from ec union all select 'cert', cert_id, concat_ws(' ', nombre_legal, siglas) from cert)"
_HITS = f"(select entity, key, unnest({_FOUND.format('t')}) as word from {_TEXTS})"


@query("C15_index_search", f"select entity, key, string_agg(word, ',' order by word) as words, round(sum(w), 9) as score from {_HITS} join (select word, 1.0::double / count(*) as w from {_HITS} group by word) using (word) group by entity, key")
def c15c(r):
    # one index over two entities
    index = WordIndex(r.spark, scratch(r.spark, "words"), 32)
    index.add(r.ec, "ec", "ec_clave", ["titulo", "descripcion"], 0)
    index.add(r.cert, "cert", "cert_id", ["nombre_legal", "siglas"], 0)
    return index.search("small Ring s2 none").select("entity", "key", F.array_join("words", ",").alias("words"), "score")


@query("C8_page_after", "select ec_clave, titulo from (select *, row_number() over (order by ec_clave) as n from ec) where n > 60 and n <= 120")
def c8b(r):
    # the second page, by the last key of the first
    rows = r.ec.select("ec_clave", "titulo")
    first = listing.page_after(rows, ["ec_clave"], None, 60)
    return listing.page_after(rows, ["ec_clave"], (first.agg(F.max("ec_clave")).first()[0],), 60)


# ---- D ----


@query("D1_ec_with_certificadores", "select e.ec_clave, c.cert_id, tipo, nombre_legal, estado, acreditado_desde, count(*) over (partition by e.ec_clave) as total from ec e join ece_ec x on e.ec_clave = x.ec_clave join cert c on c.cert_id = x.cert_id")
def d1(r):
    return joins.ec_certificadores(r.ec, r.ece_ec, r.cert)


@query("D2_ec_with_centros", "select e.ec_clave, c.centro_id, nombre, municipio, estado_inegi from ec e join centro_ec x on e.ec_clave = x.ec_clave join centros c on c.centro_id = x.centro_id where estado_inegi = '05'")
def d2(r):
    return joins.ec_centros(r.ec, r.centro_ec, r.centros, "05")


@query("D3_cert_standards", "select c.cert_id, e.ec_clave, titulo, vigente, acreditado_desde from cert c join ece_ec x on c.cert_id = x.cert_id join ec e on e.ec_clave = x.ec_clave where tipo = 'ECE' and vigente")
def d3(r):
    return joins.cert_standards(r.cert, r.ece_ec, r.ec, vigente=True)


@query("D4_centro_standards", "select c.centro_id, e.ec_clave, titulo, nivel from centros c join centro_ec x on c.centro_id = x.centro_id join ec e on e.ec_clave = x.ec_clave where not vigente")
def d4(r):
    return joins.centro_standards(r.centros, r.centro_ec, r.ec, vigente=False)


@query("D5_count_children", "select c.comite_id, nombre, c.sector_id, coalesce(n, 0) as n from comites c left join (select comite_id, count(*) as n from ec where vigente group by comite_id) e on c.comite_id = e.comite_id")
def d5(r):
    return joins.count_children(r.comites, r.ec.filter("vigente"), "comite_id", "n")


@query("D6_lookup_name", "select centro_id, certificador_id as cert_id, coalesce(nombre_legal, 'Unknown') as certificador from centros left join cert on certificador_id = cert_id")
def d6(r):
    return joins.lookup_name(r.centros.select("centro_id", F.col("certificador_id").alias("cert_id")), r.cert, "cert_id", "nombre_legal", "certificador")


_OLD = "select ec_clave, titulo, nivel, timestamp '2020-01-01 00:00:00' as first_seen, timestamp '2020-06-01 00:00:00' as last_seen from ec where duracion_horas <= 35"
_NEW = "select ec_clave, case when duracion_horas % 4 = 0 then null else concat(titulo, ' v2') end as titulo, case when duracion_horas % 3 = 0 then null else '9' end as nivel from ec where duracion_horas > 20"


@query("D7_upsert_merge", f"select coalesce(o.ec_clave, n.ec_clave) as ec_clave, coalesce(n.titulo, o.titulo) as titulo, coalesce(n.nivel, o.nivel) as nivel, coalesce(o.first_seen, timestamp '2021-01-01 00:00:00') as first_seen, case when n.ec_clave is not null then timestamp '2021-01-01 00:00:00' else o.last_seen end as last_seen from ({_OLD}) o full join ({_NEW}) n on o.ec_clave = n.ec_clave")
def d7(r):
    return joins.upsert(r.sql(_OLD), r.sql(_NEW), "ec_clave", ["titulo", "nivel"], F.lit("2021-01-01").cast("timestamp"))


@query("D8_append_courses", "select i.item_id, i.ec_code, e.ec_clave as ec_ref from items i left join ec e on i.ec_code = e.ec_clave where type = 'course' and item_id % 2 = 1 union all select item_id, ec_code, cast(null as string) from items where type = 'course' and item_id % 2 = 0")
def d8(r):
    courses = r.items.filter("type = 'course'").select("item_id", "ec_code")
    stored = courses.filter("item_id % 2 = 0").withColumn("ec_ref", F.lit(None).cast("string"))
    return joins.append_courses(stored, courses.filter("item_id % 2 = 1"), r.ec)


@query("D9_fk_resolve", "select centro_id, certificador_id, cert_id as cert_ref from centros left join cert on certificador_id = cert_id")
def d9(r):
    return joins.fk_resolve(r.centros.select("centro_id", "certificador_id"), r.cert, "certificador_id", "cert_id", "cert_id", "cert_ref")


@query("D10_semi_edge", "select cert_id, nombre_legal from cert where cert_id in (select cert_id from ece_ec where ec_clave = 'EC0042')")
def d10(r):
    return joins.related(r.cert, r.ece_ec.filter("ec_clave = 'EC0042'"), "cert_id").select("cert_id", "nombre_legal")


@query("D11_orphans", "select certificador_id, centro_id from centros where certificador_id not in (select cert_id from cert)")
def d11(r):
    return joins.orphans(r.centros.select("centro_id", "certificador_id"), r.cert, "certificador_id", "cert_id")


@query("D12_nearby_exact_then_partial", "select centro_id, nombre, municipio from centros where estado_inegi = '07' and municipio ilike '%hold%' order by centro_id limit 10")
def d12(r):
    return joins.nearby(r.centros, "07", "hold")


_KM = "12742.0 * asin(sqrt(least(pow(sin(radians(latitud - 19.4) / 2), 2) + cos(radians(latitud)) * cos(radians(19.4)) * pow(sin(radians(longitud + 99.1) / 2), 2), 1.0)))"


@query("D13_radius_search", f"select centro_id, cast(round({_KM}, 3) as double) as distance_km from centros where {_KM} <= 250 order by 2, 1")
def d13(r):
    return joins.within_radius(r.centros, 19.4, -99.1, 250).select("centro_id", "distance_km")


_NAMES = "select i.item_id, case item_id % 7 when 0 then 'cdmx' when 1 then 'JALISCO' when 2 then 'EDO. Jalisco' when 3 then 'Estado de Puebla' when 4 then 'nuevo león' when 5 then 'Atlantis' when 6 then 'Baja California Sur' end as estado from items i"


@query("D14_state_code_theta", f"select item_id, estado, case item_id % 7 when 0 then '09' when 1 then '14' when 2 then '14' when 3 then '21' when 4 then '19' when 6 then '03' end as estado_inegi from ({_NAMES})")
def d14(r):
    return joins.state_code(r.sql(_NAMES), "estado")


@query("D15_related_entities", """select 'certificador' as kind, cert_id as id, nombre_legal as name from cert where cert_id in (select cert_id from ece_ec where ec_clave = 'EC0042')
    union all select 'centro', centro_id, nombre from centros where centro_id in (select centro_id from centro_ec where ec_clave = 'EC0042')
    union all select 'sector', cast(s.sector_id as string), s.nombre from sectores s join ec on s.sector_id = ec.sector_id where ec_clave = 'EC0042'
    union all select 'comite', cast(c.comite_id as string), c.nombre from comites c join ec on c.comite_id = ec.comite_id where ec_clave = 'EC0042'""")
def d15(r):
    return joins.related_entities("EC0042", r.ec, r.ece_ec, r.cert, r.centro_ec, r.centros, r.sectores, r.comites)


@query("D16_asof_snapshot", "select ec_clave, version, titulo from ec_history where first_seen <= timestamp '1996-01-01 00:00:00' and last_seen >= timestamp '1996-01-01 00:00:00'")
def d16(r):
    return joins.snapshot_at(r.ec_history, "1996-01-01").select("ec_clave", "version", "titulo")


@query("D16_snapshots_at", "select t, count(*) as n from ec_history join (select distinct cast(o_orderdate as timestamp) + interval 12 hours as t from orders) m on first_seen <= t and last_seen >= t group by t")
def d16b(r):
    # every day on which there was an order
    moments = r.orders.select((F.col("o_orderdate").cast("timestamp") + F.expr("interval 12 hours")).alias("t")).distinct()
    # versions that are valid over the same time meet the moments once, with their number
    spans = r.ec_history.groupBy("first_seen", "last_seen").agg(F.count("*").alias("n"))
    return joins.snapshots_at(spans, moments).groupBy("t").agg(F.sum("n").alias("n"))


@query("D17_cert_by_state_docs", "select estado, tipo, count(*) as count, count(distinct ec_clave) as standards from cert c left join ece_ec x on c.cert_id = x.cert_id where estatus = 'Vigente' group by estado, tipo")
def d17(r):
    return joins.cert_state_standards(r.cert, r.ece_ec)


@query("D18_centros_of_cert", "select estado_inegi, estado, count(*) as centros, cast(sum(count(*)) over () as bigint) as total from centros where certificador_id = 'ECE005' group by estado_inegi, estado")
def d18(r):
    return joins.centros_of_cert(r.centros, "ECE005")


# ---- E ----

_E1 = "select estado_inegi, estado, count(*) as centros, count(distinct municipio) as municipios, round(count(*) / cast(count(distinct municipio) as double), 2) as por_municipio from centros group by estado_inegi, estado"


@query("E1_centros_by_state", _E1)
def e1(r):
    return agg.centros_stats(r.centros)


@query("E2_centros_national", f"select cast(sum(centros) as bigint) as centros, cast(sum(municipios) as bigint) as municipios, count(*) as estados, round(cast(sum(centros) as double) / count(*), 2) as por_estado from ({_E1})")
def e2(r):
    return agg.centros_national(r.centros)


@query("E3_cert_by_state", "select estado_inegi, min(estado) as estado, count(*) filter (tipo = 'ECE') as ece, count(*) filter (tipo = 'OC') as oc, count(*) as total from cert group by estado_inegi")
def e3(r):
    return agg.cert_stats(r.cert)


@query("E4_cert_national", "select count(*) filter (tipo = 'ECE') as ece, count(*) filter (tipo = 'OC') as oc, count(*) as total from cert")
def e4(r):
    return agg.cert_national(r.cert)


@query("E5_cert_in_state", "select cert_id, tipo, nombre_legal, count(*) over () as total, count(*) filter (tipo = 'ECE') over () as ece, count(*) filter (tipo = 'OC') over () as oc from cert where estado_inegi = '05'")
def e5(r):
    return agg.cert_in_state(r.cert, "05")


@query("E6_centros_by_municipio", "select municipio, count(*) as n, string_agg(centro_id, ',' order by centro_id) as centros, (select count(distinct municipio) from centros where estado_inegi = '02') as municipios from centros where estado_inegi = '02' group by municipio")
def e6(r):
    return agg.centros_in_state(r.centros, "02")


@query("E7_sector_summary", "select s.sector_id, nombre, coalesce(e.n, 0) as estandares, coalesce(c.n, 0) as comites from sectores s left join (select sector_id, count(distinct ec_clave) as n from ec group by sector_id) e on s.sector_id = e.sector_id left join (select sector_id, count(distinct comite_id) as n from comites group by sector_id) c on s.sector_id = c.sector_id")
def e7(r):
    return agg.sector_stats(r.sectores, r.ec, r.comites)


@query("E8_registry_totals", "select (select count(*) from sectores) as sectores, (select count(*) from comites) as comites, count(distinct ec_clave) as estandares, count(*) filter (vigente) as activos, count(distinct ec_clave) - count(*) filter (vigente) as inactivos from ec")
def e8(r):
    return agg.registry_totals(r.sectores, r.comites, r.ec)


@query("E9_sectors_without", "select sector_id, nombre from sectores where sector_id not in (select sector_id from ec)")
def e9(r):
    return agg.sectors_without(r.sectores, r.ec)


@query("E10_group_summary", f"select 'type' as dimension, type as value, count(*) as n from items group by type union all select 'status', {_STATUS}, count(*) from items group by {_STATUS} union all select 'sector', source, count(*) from items group by source")
def e10(r):
    return agg.item_summary(r.items.select("type", F.expr(_STATUS).alias("status"), F.col("source").alias("sector")))


@query("E11_coverage", "select 'cert' as entity, 'correo' as field, printf('%.1f%%', round(100.0 * count(correo) / count(*), 1)) as filled from cert union all select 'cert', 'telefono', printf('%.1f%%', round(100.0 * count(telefono) / count(*), 1)) from cert")
def e11(r):
    return agg.coverage(r.cert, ["correo", "telefono"], "cert")


@query("E12_duplicate_keys", "select ec_clave, count(*) as n from ec_history group by ec_clave having count(*) > 1")
def e12(r):
    return agg.duplicate_keys(r.ec_history, "ec_clave")


@query("E13_relationship_issues", """select * from (select 'orphan_centros' as issue, count(*) as n from centros where certificador_id not in (select cert_id from cert)
    union all select 'orphan_courses', count(*) from items where type = 'course' and ec_code not in (select ec_clave from ec)
    union all select 'duplicate_codes', count(*) from (select ec_clave from ec_history group by ec_clave having count(*) > 1)) where n > 0""")
def e13(r):
    return agg.relationship_issues(r.centros.select("certificador_id"), r.cert, r.items.filter("type = 'course'").select("ec_code"), r.ec_history.select("ec_clave"))


_LAST = "(select harvest_id as last_run, end_time as last_end from runs where status = 'completed' order by start_time desc, harvest_id desc limit 1)"


@query("E14_freshness", f"select * from (select 'ec' as entity, count(*) as total, count(*) filter (last_seen < timestamp '2001-10-25 00:00:00') as stale, count(*) filter (last_seen < timestamp '2001-10-25 00:00:00') > 0 as alert from ec_history union all select 'cert', count(*), count(*) filter (last_seen < timestamp '2001-10-25 00:00:00'), count(*) filter (last_seen < timestamp '2001-10-25 00:00:00') > 0 from cert_history) cross join {_LAST}")
def e14(r):
    return agg.freshness({"ec": r.ec_history, "cert": r.cert_history}, "2001-11-01", runs=r.runs)


@query("E15_stale_runs", "select harvest_id, strftime(end_time, '%Y-%m') as month, true as archived from runs where end_time < timestamp '2024-01-16 00:00:00' union all select harvest_id, null, false from runs where end_time >= timestamp '2024-01-16 00:00:00'")
def e15(r):
    # the archive as it was written, twice, and what stays
    path = scratch(r.spark, "archive")
    for _ in range(2):
        stays = agg.archive_runs(r.runs, "2024-01-26", path, 10)
    archive = r.spark.read.schema("harvest_id string, month string").parquet(path)
    return archive.withColumn("archived", F.lit(True)).unionByName(stays.select("harvest_id", F.lit(None).cast("string").alias("month"), F.lit(False).alias("archived")))


@query("E16_url_type_counts", "select coalesce(type, 'unknown') as type, count(*) as n from items group by 1")
def e16(r):
    return agg.url_type_counts(r.items)


@query("E17_endpoint_counts", "select method, path as url, count(*) as n from request_log where path like '%/api/%' group by method, path")
def e17(r):
    return agg.endpoint_counts(r.request_log)


@query("E18_component_progress", "select component, count(*) filter (status = 200) as scraped, count(*) as total, round(100.0 * count(*) filter (status = 200) / count(*), 1) as success_pct, round(avg(duration), 4) as avg_response, max(ts) as last_updated, (select round(100.0 * count(*) filter (status = 200) / count(*), 1) from request_log) as overall_pct from request_log group by component")
def e18(r):
    return agg.component_progress(r.request_log)


@query("E19_error_summary", "select component, status, path, count(*) as n, max(ts) as latest, round(count(*) / cast((select count(*) from request_log) as double), 6) as rate from request_log where status >= 400 group by component, status, path order by n desc, component, path limit 50")
def e19(r):
    return agg.error_summary(r.request_log)


@query("E20_topk_errors", "select host, component, count(*) as n from request_log where status >= 400 group by host, component order by n desc, host, component limit 10")
def e20(r):
    return agg.topk(r.request_log.filter("status >= 400"), ["host", "component"], 10)


@query("E21_sum_by", "select component, cast(sum(length(props)) as bigint) as total from request_log group by component")
def e21(r):
    return agg.sum_by(r.request_log.withColumn("bytes", F.length("props")), ["component"], "bytes")


_EDGES = (0.5, 1.0, 5.0, 10.0, 50.0, 100.0, 500.0)


@query("E22_latency_quantile", """select component, cast(round(case when le0 >= r then case when le0 = 0 then 0 else 0.5 * r / le0 end when le1 >= r then 0.5 + 0.5 * (r - le0) / (le1 - le0)
    when le2 >= r then 1 + 4 * (r - le1) / (le2 - le1) when le3 >= r then 5 + 5 * (r - le2) / (le3 - le2) when le4 >= r then 10 + 40 * (r - le3) / (le4 - le3)
    when le5 >= r then 50 + 50 * (r - le4) / (le5 - le4) when le6 >= r then 100 + 400 * (r - le5) / (le6 - le5) else 500 end, 6) as double) as bucketed, round(exact, 6) as exact
    from (select component, cast(count(*) as double) * 0.95 as r, count(*) filter (duration <= 0.5) as le0, count(*) filter (duration <= 1) as le1, count(*) filter (duration <= 5) as le2, count(*) filter (duration <= 10) as le3,
    count(*) filter (duration <= 50) as le4, count(*) filter (duration <= 100) as le5, count(*) filter (duration <= 500) as le6, quantile_cont(duration, 0.95) as exact from request_log group by component)""")
def e22(r):
    by_host = metrics.latency_summaries(r.request_log.withColumn("ts", F.col("ts").cast("timestamp")), ("component", "host"), bounds=_EDGES)
    merged = metrics.merge_summaries(by_host, ["component"], bounds=_EDGES).select("component", F.round(metrics.bucket_quantile(0.95, _EDGES), 6).alias("bucketed"))
    exact = metrics.exact_quantile(r.request_log, 0.95, "component").withColumnRenamed("component", "c")
    return merged.join(exact, F.col("component").eqNullSafe(F.col("c")), "left").select("component", "bucketed", F.round("exact", 6).alias("exact"))


@query("E22_latency_sketch", "select component, q, count(*) as n, true as within from request_log cross join (select unnest([50, 95]) as q) group by component, q")
def e22b(r):
    # the sketch's own answer is not SQL's: that its rank lies within two percent of the one asked for is
    log = r.request_log.withColumn("ts", F.col("ts").cast("timestamp"))
    merged = metrics.merge_summaries(metrics.latency_summaries(log, ("component", "host")), ["component"])
    asked = F.explode(F.array(*[F.struct(F.lit(q).alias("q"), metrics.sketch_quantile(q / 100).alias("v")) for q in (50, 95)]))
    found = merged.select("component", asked.alias("a")).select("component", "a.*")
    ranks = log.join(found, "component").groupBy("component", "q").agg(F.count("*").alias("n"), (F.count_if(F.col("duration") < F.col("v")) / F.count("*")).alias("lo"), (F.count_if(F.col("duration") <= F.col("v")) / F.count("*")).alias("hi"))
    return ranks.select("component", "q", "n", ((100 * F.col("lo") - 2 <= F.col("q")) & (100 * F.col("hi") + 2 >= F.col("q"))).alias("within"))


@query("E23_hit_ratio", "select host, round(100.0 * count(*) filter (component = 'view') / count(*), 4) as hit_pct from request_log group by host")
def e23(r):
    return agg.hit_ratio(r.request_log, ["host"], F.col("component") == "view")


_SECONDS = "cast(floor(epoch(end_time)) as bigint) - cast(floor(epoch(start_time)) as bigint)"


@query("E24_run_stats", f"select harvest_id, cast(items as bigint) as items, cast(pages as bigint) as pages, cast(errors as bigint) as errors, {_SECONDS} as seconds, case when {_SECONDS} > 0 then round(items / cast({_SECONDS} as double), 6) else 0.0 end as items_per_second from runs")
def e24(r):
    return agg.run_stats(r.runs)


@query("E25_table_counts", " union all ".join(f"select '{t}' as name, count(*) as n from {t}" for t in ("sectores", "comites", "ec", "cert", "centros", "ece_ec", "centro_ec")))
def e25(r):
    return agg.table_counts({t: getattr(r, t) for t in ("sectores", "comites", "ec", "cert", "centros", "ece_ec", "centro_ec")})


@query("E26_state_density", "select s.estado_inegi, coalesce(n, 0) as certificadores from (select lpad(cast(i as string), 2, '0') as estado_inegi from (select unnest(range(1, 33)) as i)) s left join (select estado_inegi, count(*) as n from cert group by estado_inegi) c on s.estado_inegi = c.estado_inegi")
def e26(r):
    states = r.spark.range(1, 33).select(F.lpad(F.col("id").cast("string"), 2, "0").alias("estado_inegi"))
    return agg.state_density(r.cert, states)


@query("E27_new_retired_timeline", "select strftime(date_trunc('month', t), '%Y-%m-%d') as period, event, count(*) as n from (select ec_clave, 'new' as event, min(first_seen) as t from ec_history group by ec_clave union all select ec_clave, 'retired', max(last_seen) from ec_history group by ec_clave) group by 1, 2")
def e27(r):
    return agg.timeline(r.ec_history, "ec_clave")


@query("E28_sector_flow", "select 'sector-standard' as level, cast(sector_id as string) as source, ec.ec_clave as target, count(*) as weight from ec join ece_ec on ec.ec_clave = ece_ec.ec_clave group by 2, 3 union all select 'standard-cert', ec.ec_clave, cert_id, count(*) from ec join ece_ec on ec.ec_clave = ece_ec.ec_clave group by 2, 3")
def e28(r):
    return agg.sector_flow(r.ec, r.ece_ec)


@query("E29_cert_overview", "select count(*) as total, count(*) filter (tipo = 'ECE') as ece, count(*) filter (tipo = 'OC') as oc, count(*) filter (estatus = 'Vigente') as activos, min(fecha_acreditacion) as desde, max(fecha_acreditacion) as hasta, (select string_agg(estado, ',' order by n desc, estado) from (select estado, count(*) as n from cert group by estado order by n desc, estado limit 5)) as top_estados from cert")
def e29(r):
    return agg.cert_overview(r.cert)


@query("E30_centros_overview", "select (select count(*) from centros) as total, round((select count(*) from centro_ec x where x.centro_id in (select centro_id from centros)) / cast((select count(*) from centros) as double), 6) as standards_per_centro, (select string_agg(estado, ',' order by n desc, estado) from (select estado, count(*) as n from centros group by estado order by n desc, estado limit 5)) as top_estados, (select string_agg(c, ',' order by n desc, c) from (select certificador_id as c, count(*) as n from centros group by certificador_id order by n desc, c limit 5)) as top_certificadores")
def e30(r):
    return agg.centros_overview(r.centros, r.centro_ec)


@query("E31_sector_overview", "select (select count(*) from sectores) as sectores, (select count(*) from comites) as comites, (select string_agg(nombre, ',' order by n desc, sector_id) from (select s.sector_id, nombre, count(ec_clave) as n from sectores s left join ec on s.sector_id = ec.sector_id group by s.sector_id, nombre order by n desc, s.sector_id limit 3)) as top_sectores")
def e31(r):
    return agg.sector_overview(r.sectores, r.comites, r.ec)


@query("E32_last_update", "select 'ec' as name, (select ec_clave from ec_history order by last_seen desc, ec_clave desc limit 1) as key, (select max(last_seen) from ec_history) as last_seen union all select 'cert', (select cert_id from cert_history order by last_seen desc, cert_id desc limit 1), (select max(last_seen) from cert_history)")
def e32(r):
    return agg.last_update({"ec": (r.ec_history, "ec_clave"), "cert": (r.cert_history, "cert_id")})


@query("E33_reachability", "select case when status <> 200 then concat('failed_', cast(status as string)) when url like '%/en/%' then 'with_topic' else 'reachable' end as outcome, count(*) as n from fetch_log group by 1")
def e33(r):
    return agg.reachability(r.fetch_log.withColumn("topic", F.col("url").contains("/en/")))


@query("E34_run_summary", "select cast(ts as date) as run, l.component, count(*) as requests, count(*) filter (status >= 400) as failures, round((epoch_us(max(ts)) - epoch_us(min(ts))) / cast(1e6 as double), 3) as elapsed, cast(sum(length(props)) as bigint) as bytes, round(100.0 * (count(*) - count(*) filter (status >= 400)) / any_value(reported), 4) as coverage_pct from request_log l join (select component, max(n) as reported from (select component, cast(ts as date) as d, count(*) as n from request_log group by 1, 2) group by component) p on p.component = l.component group by 1, 2")
def e34(r):
    # as much is reported as the fullest day had
    per_day = r.request_log.groupBy("component", F.to_date("ts").alias("d")).agg(F.count("*").alias("n"))
    return agg.run_summary(r.request_log, per_day.groupBy("component").agg(F.max("n").alias("reported")))


# ---- F ----


@query("F1_latest_per_key", "select ec_clave, version, last_seen from (select *, row_number() over (partition by ec_clave order by last_seen desc, version desc) as n from ec_history) where n = 1")
def f1(r):
    return choose.latest(r.ec_history, ["ec_clave"], "last_seen", "version").select("ec_clave", "version", "last_seen")


@query("F2_keep_min_id", "select source, min(item_id) as item_id from items group by source")
def f2(r):
    return choose.keep_first(r.items.select("source", "item_id"), ["source"], "item_id")


@query("F3_current_run_view", "select ec_clave, version from ec_history where last_seen = (select max(last_seen) from ec_history)")
def f3(r):
    return choose.current_run(r.ec_history).select("ec_clave", "version")


@query("F4_topk_sectors", "select s.sector_id, nombre, count(ec_clave) as n from sectores s left join ec on s.sector_id = ec.sector_id group by s.sector_id, nombre order by n desc, s.sector_id limit 10")
def f4(r):
    return choose.topk_sectors(r.sectores, r.ec)


@query("F5_sample_per_parent", "select comite_id, ec_clave from (select comite_id, ec_clave, row_number() over (partition by comite_id order by ec_clave) as n from ec) where n <= 10")
def f5(r):
    return choose.sample_children(r.ec.select("comite_id", "ec_clave"), "comite_id", "ec_clave")


@query("F6_capped_items", "select 'centro' as entity, centro_id as id, (select count(*) from centros where estado_inegi = '04') as total from centros where estado_inegi = '04' order by id limit 20")
def f6(r):
    return choose.capped(r.centros.filter("estado_inegi = '04'"), "centro", "centro_id", 20)


_ERR = "select 'code' as field, concat('bad code of ', coalesce(type, 'nothing')) as message, lpad(cast(item_id as string), 8, '0') as key from items where item_id % 3 = 0"


@query("F7_first_k_examples", f"select field, message, count(*) as count, string_agg(key, ',' order by key) filter (n <= 3) as examples from (select *, row_number() over (partition by field, message order by key) as n from ({_ERR})) group by field, message")
def f7(r):
    return choose.error_examples(r.sql(_ERR))


@query("F8_top_errors", f"select message, count(*) as n from ({_ERR}) group by message order by n desc, message limit 10")
def f8(r):
    return choose.top_errors(r.sql(_ERR))


@query("F9_last_completed_run", "select harvest_id, start_time, cast(items as bigint) as items from runs where status = 'completed' order by start_time desc, harvest_id desc limit 1")
def f9(r):
    return choose.last_run(r.runs)


@query("F10_ordered_list", "select nivel, ec_clave, titulo from ec where vigente order by nivel, ec_clave")
def f10(r):
    return choose.ordered(r.ec.filter("vigente").select("nivel", "ec_clave", "titulo"), ["nivel", "ec_clave"])


@query("F11_payload_dedup", "select url, hash, page_id, \"fetch\", cast(size as int) as size from (select *, row_number() over (partition by url, hash order by \"fetch\", page_id) as n from fetch_log) where n = 1")
def f11(r):
    return choose.payload_dedup(r.fetch_log)


# ---- G ----


@query("G1_union_items", "select 'ec_standard' as type, ec_clave as code, titulo as title, cast(null as string) as siglas from ec union all select 'certificador', cert_id, nombre_legal, siglas from cert")
def g1(r):
    return sets.union_items({"ec_standard": r.ec.select(F.col("ec_clave").alias("code"), F.col("titulo").alias("title")), "certificador": r.cert.select(F.col("cert_id").alias("code"), F.col("nombre_legal").alias("title"), "siglas")})


_T1 = "select distinct ec_clave from ec_history where first_seen <= timestamp '1995-04-01 00:00:00' and last_seen >= timestamp '1995-04-01 00:00:00'"
_T2 = "select distinct ec_clave from ec_history where first_seen <= timestamp '2001-08-01 00:00:00' and last_seen >= timestamp '2001-08-01 00:00:00'"


@query("G2_key_except", f"select 'added' as op, ec_clave from (({_T2}) except ({_T1})) union all select 'removed', ec_clave from (({_T1}) except ({_T2}))")
def g2(r):
    a, b = r.sql(_T1), r.sql(_T2)
    return sets.added(a, b, "ec_clave").select(F.lit("added").alias("op"), "ec_clave").unionByName(sets.removed(a, b, "ec_clave").select(F.lit("removed").alias("op"), "ec_clave"))


@query("G3_key_intersect", f"({_T1}) intersect ({_T2})")
def g3(r):
    return sets.common(r.sql(_T1), r.sql(_T2), "ec_clave")


_LISTS = "select cert_id, {f}(ec_clave) as codes from ece_ec where acreditado_desde < date '{d}' group by cert_id"


@query("G4_array_set_diff", f"""select a.cert_id, cast(len(a.codes) as int) as n_before, cast(len(b.codes) as int) as n_after, array_to_string(list_sort(list_filter(b.codes, lambda x: not list_contains(a.codes, x))), ',') as added,
    array_to_string(list_sort(list_filter(a.codes, lambda x: not list_contains(b.codes, x))), ',') as removed from ({_LISTS.format(f='list', d='1995-06-01')}) a join ({_LISTS.format(f='list', d='1996-01-01')}) b on a.cert_id = b.cert_id""")
def g4(r):
    a, b = (r.ece_ec.filter(F.col("acreditado_desde") < d).groupBy("cert_id").agg(F.collect_list("ec_clave").alias(n)) for d, n in (("1995-06-01", "a"), ("1996-01-01", "b")))
    return a.join(b, "cert_id").withColumn("d", sets.list_diff(F.col("a"), F.col("b"))).select("cert_id", "d.n_before", "d.n_after", F.array_join("d.added", ",").alias("added"), F.array_join("d.removed", ",").alias("removed"))


def _hits(name, key, table, where):
    return f"(select '{name}' as entity, cast({key} as string) as id, (select count(*) from {table} where {where}) as total from {table} where {where} order by id limit 10)"


@query("G5_global_search", "select * from " + " union all select * from ".join([_hits("ec", "ec_clave", "ec", "(ec_clave ilike '%1%' or titulo ilike '%1%')"), _hits("cert", "cert_id", "cert", "(cert_id ilike '%1%' or nombre_legal ilike '%1%')"), _hits("centro", "centro_id", "centros", "(centro_id ilike '%1%' or nombre ilike '%1%')"), _hits("sector", "sector_id", "sectores", "nombre ilike '%1%'"), _hits("comite", "comite_id", "comites", "nombre ilike '%1%'")]))
def g5(r):
    return sets.search_all("1", {"ec": (r.ec, "ec_clave", ["ec_clave", "titulo"]), "cert": (r.cert, "cert_id", ["cert_id", "nombre_legal"]), "centro": (r.centros, "centro_id", ["centro_id", "nombre"]), "sector": (r.sectores, "sector_id", ["nombre"]), "comite": (r.comites, "comite_id", ["nombre"])})


@query("G6_search_by_location", "select * from (select 'certificador' as entity, cert_id as id, count(*) over () as total, min(estado) over () as estado from cert where estado_inegi = '06' order by id limit 20) union all select * from (select 'centro', centro_id as id, count(*) over (), min(estado) over () from centros where estado_inegi = '06' order by id limit 20)")
def g6(r):
    return sets.search_location("06", None, r.cert, r.centros)
