"""Queries of H and I over the raw items and the registry views, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from padron.functions import clean, rules
from padron.operators.choose import error_examples, top_errors
from padron.plans.catalog import query
from padron.sources.sinks import write_parquet
from padron.sources.storage import scratch

C = F.col
_COLLAPSED = "trim(regexp_replace({c}, '\\s+', ' ', 'g'))"
_DIG = "regexp_replace({c}, '[^0-9]', '', 'g')"


def _phone(c):
    d = _DIG.format(c=c)
    return f"case when length({d}) = 10 then concat('+52', {d}) when length({d}) = 12 and {d} like '52%' then concat('+', {d}) else {c} end"


@query("H1_clean_text", f"select item_id, {_COLLAPSED.format(c='text')} as v from items")
def h1(r):
    return r.items.select("item_id", clean.clean_text(C("text")).alias("v"))


@query("H2_normalize_phone_raw", f"select item_id, {_phone('contact_phone')} as v from items")
def h2(r):
    return r.items.select("item_id", clean.normalize_phone_raw(C("contact_phone")).alias("v"))


_D = _DIG.format(c="p")


@query("H3_normalize_phone_v2", f"select item_id, case when length({_D}) = 10 then concat('+52', {_D}) when length({_D}) = 12 and {_D} like '52%' then concat('+', {_D}) when length({_D}) = 13 and {_D} like '052%' then concat('+', substr({_D}, 2, 12)) else {_D} end as v from (select item_id, case when item_id % 5 = 0 then '052 5512345678' else contact_phone end as p from items)")
def h3(r):
    p = F.when(C("item_id") % 5 == 0, "052 5512345678").otherwise(C("contact_phone"))
    return r.items.select("item_id", clean.normalize_phone_v2(p).alias("v"))


@query("H4_normalize_state_name", "select item_id, case item_id % 6 when 0 then 'Ciudad de México' when 1 then 'Estado de México' when 2 then 'Nuevo León' when 3 then 'Jalisco' when 4 then 'D.F.' end as v from items")
def h4(r):
    return r.items.select("item_id", clean.normalize_state_name(C("state")).alias("v"))


@query("H5_title_case", "select cert_id, case when cert_id like 'OC%' then 'Oc' else 'Ece' end as v from cert")
def h5(r):
    return r.cert.select("cert_id", F.regexp_replace(clean.title_case(C("cert_id")), r"\d", "").alias("v"))


@query("H6_postal_code", "select item_id, case when item_id % 2 = 0 then concat('0', cast(1000 + item_id % 9000 as string)) end as v from items")
def h6(r):
    return r.items.select("item_id", clean.postal_code(F.lit(None).cast("string"), C("address")).alias("v"))


@query("H7_email_norm", "select item_id, lower(trim(contact_email)) as v from items")
def h7(r):
    return r.items.select("item_id", clean.email_norm(C("contact_email")).alias("v"))


@query("H8_url_norm", "select item_id, rtrim(url, '/') as v from items")
def h8(r):
    return r.items.select("item_id", clean.url_norm(C("url")).alias("v"))


@query("H9_website_scheme", "select item_id, case when item_id % 3 = 0 then url else concat('http://', replace(url, 'https://', '')) end as v from items")
def h9(r):
    site = F.when(C("item_id") % 3 == 0, C("url")).otherwise(F.replace(C("url"), F.lit("https://"), F.lit("")))
    return r.items.select("item_id", clean.website_scheme(site).alias("v"))


@query("H10_code_norm", "select item_id, upper(trim(code)) as v from items")
def h10(r):
    return r.items.select("item_id", clean.code_norm(C("code")).alias("v"))


@query("H11_modality_norm", "select item_id, case item_id % 3 when 0 then 'en_linea' when 1 then 'presencial' else 'mixto' end as v from items")
def h11(r):
    return r.items.select("item_id", clean.modality_norm(C("modality")).alias("v"))


_DAY = "date '2020-01-01' + cast(item_id % 300 as int)"


@query("H12_parse_date_raw", f"select item_id, case when item_id % 5 < 4 then {_DAY} end as v from items")
def h12(r):
    day = F.date_add(F.lit("2020-01-01").cast("date"), (C("item_id") % 300).cast("int"))
    text = F.when(C("item_id") % 5 == 0, F.date_format(day, "yyyy-MM-dd")).when(C("item_id") % 5 == 1, F.date_format(day, "dd/MM/yyyy")).when(C("item_id") % 5 == 2, F.date_format(day, "dd-MM-yyyy")).when(C("item_id") % 5 == 3, F.date_format(day, "yyyy/MM/dd")).otherwise("invalid date")
    return r.items.select("item_id", clean.parse_date_raw(text).alias("v"))


@query("H13_parse_date_iso", f"select item_id, case when item_id % 5 in (0, 1, 2) then {_DAY} when item_id % 5 = 3 then date '2013-01-01' end as v from items")
def h13(r):
    day = F.date_add(F.lit("2020-01-01").cast("date"), (C("item_id") % 300).cast("int"))
    names = F.element_at(F.array(*[F.lit(m) for m in clean.MONTHS]), F.month(day))
    text = (
        F.when(C("item_id") % 5 == 0, F.concat(F.lit("Publicado el "), F.date_format(day, "d/M/yyyy"), F.lit(".")))
        .when(C("item_id") % 5 == 1, F.concat(F.lit("fecha: "), F.date_format(day, "yyyy-MM-dd")))
        .when(C("item_id") % 5 == 2, F.concat(F.dayofmonth(day).cast("string"), F.lit(" de "), F.initcap(names), F.lit(" de "), F.year(day).cast("string")))
        .when(C("item_id") % 5 == 3, F.lit("desde 2013")).otherwise(F.lit("nunca"))
    )
    return r.items.select("item_id", clean.parse_date_iso(text, year_only=True).alias("v"))


@query("H14_first_number", "select item_id, try_cast(nullif(regexp_extract(duration, '(\\d+)', 1), '') as int) as hours, coalesce(try_cast(nullif(regexp_extract(title, '(\\d+)', 1), '') as int), -1) as n from items")
def h14(r):
    return r.items.select("item_id", clean.first_number(C("duration")).alias("hours"), clean.first_number(C("title"), -1).alias("n"))


@query("H15_ec_codes_in_text", "select substr(ec_clave, 1, length(ec_clave) - 2) as part, array_to_string(list_sort(list(distinct substr(ec_clave, 1, 6))), ',') as codes from ec group by 1")
def h15(r):
    # texts of at most a hundred codes each
    text = r.ec.groupBy(F.expr("substr(ec_clave, 1, length(ec_clave) - 2)").alias("part")).agg(F.concat_ws(" y ", F.collect_list("ec_clave"), F.collect_list("ec_clave")).alias("t"))
    return text.select("part", F.array_join(clean.ec_codes_in_text(C("t")), ",").alias("codes"))


@query("H16_id_from_url", "select page_id, nullif(regexp_extract(url, 'page=(\\d+)', 1), '') as page, nullif(regexp_extract(url, '[?&]ref=([^&#]+)', 1), '') as ref from pages")
def h16(r):
    return r.pages.select("page_id", clean.id_from_url(C("url"), r"page=(\d+)").alias("page"), clean.id_from_url(C("url"), r"[?&]ref=([^&#]+)").alias("ref"))


@query("H17_content_hash_item", "select item_id, sha256(concat_ws('|', type, code, name, title)) as v from items")
def h17(r):
    return r.items.select("item_id", clean.content_hash_item(*[C(c) for c in ("type", "code", "name", "title")]).alias("v"))


@query("H18_row_hash_canonical", """select ec_clave, version, sha256(concat('{"ec_clave":"', ec_clave, '","nivel":', case when nivel = '1' then 'null' else concat('"', nivel, '"') end, ',"version":"', version, '"}')) as v from ec_history""")
def h18(r):
    df = r.ec_history.select("ec_clave", "version", F.nullif(C("nivel"), F.lit("1")).alias("nivel"), "last_seen")
    return df.select("ec_clave", "version", clean.row_hash_canonical(df).alias("v"))


@query("H19_url_hash", "select page_id, md5(url) as u, md5(html) as p, substr(md5(html), 1, 16) as s from pages")
def h19(r):
    return r.pages.select("page_id", clean.url_hash(C("url")).alias("u"), clean.page_hash(C("html")).alias("p"), clean.page_hash(C("html"), short=True).alias("s"))


@query("H20_json_fields", "select cert_id, case when n > 0 then concat('[\"', array_to_string(codes, '\",\"'), '\"]') end as codes from (select c.cert_id, count(ec_clave) as n, list(ec_clave order by ec_clave) filter (ec_clave is not null) as codes from cert c left join ece_ec x on c.cert_id = x.cert_id group by c.cert_id)")
def h20(r):
    few = r.ece_ec.groupBy("cert_id").agg(F.sort_array(F.collect_list("ec_clave")).alias("codes"))
    return clean.json_fields(r.cert.select("cert_id").join(few, "cert_id", "left"), ["codes"])


@query("H21_iso_dates", "select ec_clave, version, strftime(last_seen, '%Y-%m-%dT%H:%M:%S') as last_seen, strftime(first_seen, '%Y-%m-%dT%H:%M:%S') as first_seen from ec_history")
def h21(r):
    return clean.iso_dates(r.ec_history.select("ec_clave", "version", "last_seen", "first_seen"), ["last_seen", "first_seen"])


_SEC = "cast(floor(epoch(end_time)) as bigint) - cast(floor(epoch(start_time)) as bigint)"


@query("H22_ratio_fmt", f"select harvest_id, case when items + errors = 0 then '0%' else printf('%.1f%%', round(100.0 * items / (items + errors), 1)) end as ok, concat(cast(({_SEC}) // 3600 as string), 'h ', cast((({_SEC}) % 3600) // 60 as string), 'm') as took from runs")
def h22(r):
    seconds = F.unix_timestamp("end_time") - F.unix_timestamp("start_time")
    return r.runs.select("harvest_id", clean.pct(C("items"), C("items") + C("errors")).alias("ok"), clean.dur(seconds).alias("took"))


@query("H23_split_modalities", "select item_id, case item_id % 3 when 0 then 'presencial|mixto' when 1 then 'a|b' else '' end as v from items")
def h23(r):
    text = F.when(C("item_id") % 3 == 0, " presencial , mixto,,presencial").when(C("item_id") % 3 == 1, "a,b").otherwise(" , ")
    return r.items.select("item_id", F.array_join(clean.split_modalities(text), "|").alias("v"))


@query("H24_latlong_parse", "select centro_id, case when centro_id like '%7' then null else latitud end as lat, case when centro_id like '%7' then null else longitud end as lon from centros")
def h24(r):
    text = F.when(C("centro_id").endswith("7"), "invalid").otherwise(F.concat(C("latitud").cast("string"), F.lit(", "), C("longitud").cast("string")))
    return r.centros.select("centro_id", clean.latlong_parse(text).alias("p")).select("centro_id", "p.lat", "p.lon")


@query("H25_contact_struct", "select cert_id, correo as email, telefono as phone, correo is null and telefono is null as none from cert")
def h25(r):
    return r.cert.select("cert_id", clean.contact_struct(C("correo"), C("telefono")).alias("c")).select("cert_id", "c.email", "c.phone", C("c").isNull().alias("none"))


@query("H26_page_count_expr", "select estado_inegi, cast(ceil(count(*) / 20.0) as bigint) as pages from centros group by estado_inegi")
def h26(r):
    return r.centros.groupBy("estado_inegi").agg(clean.page_count(F.count("*"), 20).alias("pages"))


@query("H27_stable_id", "select item_id, coalesce(code, sha256(concat_ws('|', type, url))) as v from items")
def h27(r):
    return r.items.select("item_id", clean.stable_id(C("code"), C("type"), C("url")).alias("v"))


@query("H28_unicode_nfc", "select item_id, nfc_normalize(title) as v from items")
def h28(r):
    return r.items.select("item_id", clean.unicode_nfc(C("title")).alias("v"))


@query("H29_body_preview", "select page_id, substr(html, 1, 1000) as preview, cast(octet_length(encode(html)) as int) as size, sha256(html) as hash from pages")
def h29(r):
    return r.pages.select("page_id", clean.body_preview(C("html")).alias("b")).select("page_id", "b.*")


# ---- I ----


def _flags(df, made, key):
    """Errors as sorted text: one row for each row of df."""
    text = F.array_join(F.array_sort(F.transform("errors", lambda e: F.concat_ws(":", e["field"], e["message"]))), ",")
    return rules.with_errors(df, made).select(key, text.alias("errors"))


def _sql(key, table, checks):
    """The SQL of _flags: checks are (field:message, condition)."""
    parts = ", ".join(f"case when {cond} then '{name}' end" for name, cond in checks)
    return f"select {key}, array_to_string(list_sort(list_filter([{parts}], lambda x: x is not null)), ',') as errors from {table}"


_BLANK = "({c} is null or trim({c}) = '')"


def _form(c, p):
    return f"({c} is not null and trim({c}) <> '' and not regexp_matches({c}, '{p}'))"


RAW = {
    "ec_standard": [("code:required", _BLANK.format(c="code")), ("code:format", _form("code", r"^EC\d{4}(\.\d{2})?$")), ("title:required", _BLANK.format(c="title")), ("level:number", "level is not null and try_cast(level as int) is null")],
    "certificador": [("code:format", _form("code", r"^OC\d{3,4}$")), ("name:required", _BLANK.format(c="name")), ("contact_email:format", _form("contact_email", rules.EMAIL)), ("rfc:format", _form("rfc", rules.RFC))],
    "center": [("code:format", _form("code", r"^CE\d{4,5}$")), ("name:required", _BLANK.format(c="name")), ("certificador_code:required", _BLANK.format(c="certificador_code"))],
    "course": [("name:required", _BLANK.format(c="name")), ("ec_code:format", _form("ec_code", r"^EC\d{4}(\.\d{2})?$")), ("duration:number", "not regexp_matches(duration, '[0-9]')")],
}


def _raw(i, name, kind, make):
    @query(f"{i}_{name}", _sql("item_id", f"items where type = '{kind}'", RAW[kind]))
    def run(r):
        df = r.items.filter(C("type") == kind)
        return _flags(df, make(df), "item_id")


for _i, (_n, _k) in enumerate((("rules_raw_ec", "ec_standard"), ("rules_raw_cert", "certificador"), ("rules_raw_center", "center"), ("rules_raw_course", "course")), 1):
    _raw(f"I{_i}", _n, _k, rules.RAW_RULES[_k])


@query("I5_drop_untyped", "select item_id, type is not null as kept from items")
def i5(r):
    ok, rejects = rules.split_untyped(r.items)
    return ok.select("item_id", F.lit(True).alias("kept")).unionByName(rejects.select("item_id", F.lit(False).alias("kept")))


_MIXED = "select ec_clave, cast(null as string) as cert_id, cast(null as string) as centro_id, cast(null as string) as type from ec union all select null, cert_id, null, case when estatus = 'Cancelado' then 'certificador' end from cert union all select null, null, centro_id, null from centros union all select ec_clave, cert_id, null, null from ece_ec"


@query("I6_infer_entity_type", f"select entity_type, count(*) as n from (select coalesce(type, case when cert_id is not null and ec_clave is not null then 'ece_ec' when ec_clave is not null then 'ec_standard' when cert_id is not null then 'certificador' when centro_id is not null then 'centro' end) as entity_type from ({_MIXED})) group by entity_type")
def i6(r):
    return rules.infer_entity_type(r.sql(_MIXED)).groupBy("entity_type").agg(F.count("*").alias("n"))


_HOLES = "select cert_id, case when siglas = 'S1' then ' ' else tipo end as tipo, case when siglas = 'S2' then null else nombre_legal end as nombre_legal from cert"


@query("I7_required_fields", _sql("cert_id", f"({_HOLES})", [(f"{f}:required", _BLANK.format(c=f)) for f in ("cert_id", "tipo", "nombre_legal")]))
def i7(r):
    df = r.sql(_HOLES)
    return _flags(df, rules.required_fields(df, "certificador"), "cert_id")


@query("I8_rules_ec", _sql("ec_clave", "ec", [("ec_clave:required", _BLANK.format(c="ec_clave")), ("ec_clave:format", _form("ec_clave", r"^EC\d{4}$")), ("titulo:length", "length(titulo) not between 10 and 500")]))
def i8(r):
    df = r.ec
    return _flags(df, rules.rules_ec(df), "ec_clave")


_BENT = "select cert_id, case when siglas = 'S0' then 'XX' else tipo end as tipo, estatus, case when siglas = 'S3' then '33' else estado_inegi end as estado_inegi, case when siglas = 'S4' then '1234' else cp end as cp, case when siglas = 'S5' then '123' else telefono end as telefono, case when siglas = 'S6' then 'x@y' else correo end as correo from cert"


@query("I9_rules_cert", _sql("cert_id", f"({_BENT})", [("tipo:value", "tipo not in ('ECE', 'OC')"), ("estado_inegi:format", _form("estado_inegi", r"^(0[1-9]|[12]\d|3[0-2])$")), ("cp:format", _form("cp", r"^\d{5}$")), ("telefono:phone", f"telefono is not null and length({_DIG.format(c='telefono')}) not in (10, 12, 13)"), ("correo:format", _form("correo", rules.EMAIL))]))
def i9(r):
    df = r.sql(_BENT)
    return _flags(df, rules.rules_cert(df), "cert_id")


_SC = "select concat('s', cast(sector_id as string)) as k, case when sector_id = 1 then 'x' else cast(sector_id as string) end as id, case when sector_id = 2 then '  ' else nombre end as nombre from sectores"


@query("I10_rules_sector", _sql("k", f"({_SC})", [("sector_id:number", "try_cast(id as int) is null"), ("nombre:required", _BLANK.format(c="nombre"))]))
def i10(r):
    df = r.sql(_SC).withColumnRenamed("id", "sector_id")
    return _flags(df, rules.rules_sector(df), "k")


@query("I10_rules_comite", _sql("k", "(select cast(comite_id as string) as k, case when comite_id % 7 = 0 then null else nombre end as nombre from comites)", [("nombre:required", _BLANK.format(c="nombre"))]))
def i10b(r):
    df = r.comites.select(C("comite_id").cast("string").alias("k"), "comite_id", "sector_id", F.when(C("comite_id") % 7 == 0, None).otherwise(C("nombre")).alias("nombre"))
    return _flags(df, rules.rules_comite(df), "k")


@query("I11_rules_centro", _sql("centro_id", "(select centro_id, nombre, case when estado_inegi = '04' then null else certificador_id end as certificador_id, case when municipio = 'BUILDING' then '00' else estado_inegi end as estado_inegi, cp from centros)", [("certificador_id:required", "certificador_id is null"), ("estado_inegi:format", _form("estado_inegi", r"^(0[1-9]|[12]\d|3[0-2])$"))]))
def i11(r):
    df = r.sql("select centro_id, nombre, case when estado_inegi = '04' then null else certificador_id end as certificador_id, case when municipio = 'BUILDING' then '00' else estado_inegi end as estado_inegi, cp from centros")
    return _flags(df, rules.rules_centro(df), "centro_id")


@query("I12_rules_relation", "select cert_id, ec_clave, acreditado_desde < date '2000-01-01' as early, not regexp_matches(ec_clave, '^EC\\d{4}$') as bent from ece_ec where acreditado_desde < date '2000-01-01' or not regexp_matches(ec_clave, '^EC\\d{4}$')")
def i12(r):
    bad = rules.with_errors(r.ece_ec, rules.rules_relation(r.ece_ec)).filter(F.size("errors") > 0)
    return bad.select("cert_id", "ec_clave", F.exists("errors", lambda e: e["message"] == "date").alias("early"), F.exists("errors", lambda e: e["message"] == "format").alias("bent"))


# every limited field is filled with so much of a text that about half of the rows break the limit
_LONG = {f: f"substr(text, 1, cast(item_id % {2 * n} as int))" for f, n in rules.MAX_LENGTHS.items()}


@query("I13_max_length", "select item_id, " + " + ".join(f"cast(length({e}) > {rules.MAX_LENGTHS[f]} as int)" for f, e in _LONG.items()) + " as broken from items where text is not null")
def i13(r):
    df = r.items.filter("text is not null").select("item_id", *[F.expr(e).alias(f) for f, e in _LONG.items()])
    return rules.with_errors(df, rules.max_length(df, rules.MAX_LENGTHS)).select("item_id", F.size("errors").alias("broken"))


@query("I14_date_range_rule", "select count(*) as n from ece_ec where acreditado_desde not between date '1996-01-01' and date '1999-12-31'")
def i14(r):
    return rules.with_errors(r.ece_ec, [rules.date_range_rule("acreditado_desde", "1996-01-01", "1999-12-31")]).filter(F.size("errors") > 0).agg(F.count("*").alias("n"))


@query("I15_rules_component", _sql("item_id", "items", [("title:short", "length(trim(title)) < 10"), ("level:range", "try_cast(level as int) is null or try_cast(level as int) not between 1 and 5"), ("contact_phone:format", _form("contact_phone", r"^\+?[\d\s()-]{10,}$")), ("duration:range", "not coalesce(try_cast(regexp_extract(duration, '(\\d+)', 1) as int) between 0 and 1000, false)")]))
def i15(r):
    return _flags(r.items, rules.rules_component(r.items), "item_id")


_BAD = " or ".join(f"(type = '{k}' and ({' or '.join(c for _, c in v)}))" for k, v in RAW.items())
_CHECKED = f"(select item_id, coalesce(type, '(none)') as type, not coalesce(({_BAD}), false) and type is not null as ok from items)"


@query("I16_quality_report", f"select case when grouping(type) = 1 then '(all)' else type end as type, count(*) as total, count(*) filter (ok) as valid, count(*) filter (not ok) as invalid, round(count(*) filter (ok) / cast(count(*) as double), 6) as rate from {_CHECKED} group by rollup(type)")
def i16(r):
    return rules.quality_report(rules.raw_errors(r.items))


@query("I17_coverage_expectations", "select name, n, minimum, n >= minimum as ok from (select 'ec' as name, count(*) as n, 1000 as minimum from ec union all select 'cert', count(*), 100 from cert union all select 'centros', count(*), 500 from centros union all select 'sectores', count(*), 10 from sectores union all select 'comites', count(*), 50 from comites)")
def i17(r):
    from padron.operators.aggregates import table_counts

    return rules.coverage_expectations(table_counts({t: getattr(r, t) for t in rules.MINIMUMS}))


_ERRS = " union all ".join(f"select lpad(cast(item_id as string), 8, '0') as key, '{n.split(':')[0]}' as field, '{n.split(':')[1]}' as message from items where type = '{k}' and ({c})" for k, v in RAW.items() for n, c in v) + " union all select lpad(cast(item_id as string), 8, '0'), 'type', 'unknown type' from items where type is null"


def _errors(r):
    return rules.exploded(rules.raw_errors(r.items.withColumn("key8", F.lpad(C("item_id").cast("string"), 8, "0"))), "key8")


@query("I18_error_breakdown", f"select field, message, count(*) as count, string_agg(key, ',' order by key) filter (n <= 3) as examples from (select *, row_number() over (partition by field, message order by key) as n from ({_ERRS})) group by field, message")
def i18(r):
    return error_examples(_errors(r))


@query("I19_sample_errors", f"select item_id from {_CHECKED} where not ok order by item_id limit 10")
def i19(r):
    return rules.sample_errors(rules.raw_errors(r.items), "item_id").select("item_id")


@query("I20_quality_gate", f"select round(count(*) filter (ok) / cast(count(*) as double), 6) as rate, round(count(*) filter (ok) / cast(count(*) as double), 6) >= 0.95 as passed from {_CHECKED}")
def i20(r):
    return rules.quality_gate(rules.quality_report(rules.raw_errors(r.items)))


@query("I20_gate_in_flight", f"select type, count(*) as total, count(*) filter (ok) as valid, count(*) filter (not ok) as invalid, round(count(*) filter (ok) / cast(count(*) as double), 6) as rate, (select count(*) from items) as written from (select * from {_CHECKED} union all select item_id, '(all)', ok from {_CHECKED}) group by type")
def i20b(r):
    # the report of what is written, without a second pass over it
    path = scratch(r.spark, "gated")
    report = rules.written_with_report(rules.raw_errors(r.items), lambda df: write_parquet(df, path))
    written = r.spark.read.parquet(path).agg(F.count("*").alias("written"))
    return report.crossJoin(F.broadcast(written))  # one row


@query("I21_driver_item_gate", "select ec_clave, regexp_matches(ec_clave, '^EC\\d{4}$') and length(titulo) between 10 and 500 as kept from ec")
def i21(r):
    ok, rejects = rules.item_gate(r.ec, "ec_standard")
    return ok.select("ec_clave", F.lit(True).alias("kept")).unionByName(rejects.select("ec_clave", F.lit(False).alias("kept")))


@query("I22_orm_code_prefix", "select item_id from items where not coalesce(upper(trim(code)) like 'EC%', false)")
def i22(r):
    return rules.with_errors(r.items, [rules.code_prefix("code", "EC")]).filter(F.size("errors") > 0).select("item_id")


@query("I23_unique_constraint", "select titulo, count(*) as n from ec group by titulo having count(*) > 1")
def i23(r):
    return rules.unique_violations(r.ec, "titulo")


@query("I24_ref_integrity", "select certificador_id as cert_id, count(*) as n from centros where certificador_id not in (select cert_id from cert) group by certificador_id")
def i24(r):
    return rules.ref_violations(r.centros.select(C("certificador_id").alias("cert_id")), r.cert, "cert_id").groupBy("cert_id").agg(F.count("*").alias("n"))


@query("I25_export_parity", "select (select count(*) from cert where estatus = 'Vigente') as written, count(*) as source, (select count(*) from cert where estatus = 'Vigente') = count(*) as ok, case when (select count(*) from cert where estatus = 'Vigente') <> count(*) then 'count differs' end as issue from cert")
def i25(r):
    return rules.export_parity(r.cert.filter("estatus = 'Vigente'"), r.cert)


@query("I26_coverage_parity", "select cast(s.sector_id as string) as name, n, n + s.sector_id * 5 as reported, round(n / cast(n + s.sector_id * 5 as double), 6) as share, n / cast(n + s.sector_id * 5 as double) >= 0.99 as ok from sectores s join (select sector_id, count(*) as n from ec group by sector_id) e on s.sector_id = e.sector_id")
def i26(r):
    counts = r.ec.groupBy(C("sector_id").cast("string").alias("name")).agg(F.count("*").alias("n"))
    reported = r.sectores.join(r.ec.groupBy("sector_id").agg(F.count("*").alias("n")), "sector_id").select(C("sector_id").cast("string").alias("name"), (C("n") + C("sector_id") * 5).alias("reported"))
    return rules.coverage_parity(counts, reported)


@query("I_top_error_messages", f"select message, count(*) as n from ({_ERRS}) group by message order by n desc, message limit 10")
def i_top(r):
    return top_errors(_errors(r))
