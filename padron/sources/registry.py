"""The registry's tables as views over the relational test tables.

One SQL text a view; it runs in Spark and, unchanged, in the engine that checks results.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from padron.sources.storage import dealt

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages")


def _padded(prefix: str, key: str, width: int) -> str:
    """prefix + key padded to at least width digits, never cut."""
    return f"concat('{prefix}', case when {key} < {10**width} then lpad(cast({key} as string), {width}, '0') else cast({key} as string) end)"


def _ec(key: str) -> str:
    return _padded("EC", key, 4)


def _cert(key: str) -> str:
    return f"concat(case when {key} % 3 = 0 then 'OC' else 'ECE' end, case when {key} < 1000 then lpad(cast({key} as string), 3, '0') else cast({key} as string) end)"


def _centro(key: str) -> str:
    return _padded("CE", key, 5)


VIEWS = {
    "sectores": "select cast(r_regionkey as bigint) as sector_id, r_name as nombre from region",
    "comites": "select cast(n_nationkey as bigint) as comite_id, n_name as nombre, cast(n_regionkey as bigint) as sector_id from nation",
    "ec": f"""select {_ec('p_partkey')} as ec_clave, p_name as titulo, p_type as descripcion, p_partkey % 4 as sector_id,
        p_partkey % 25 as comite_id, cast(p_size % 5 + 1 as string) as nivel, cast(p_size as bigint) as duracion_horas, p_size > 10 as vigente from part""",
    "cert": f"""select {_cert('s_suppkey')} as cert_id, case when s_suppkey % 3 = 0 then 'OC' else 'ECE' end as tipo, s_name as nombre_legal,
        concat('S', cast(s_suppkey % 7 as string)) as siglas, n_name as estado, lpad(cast(n_nationkey + 1 as string), 2, '0') as estado_inegi,
        concat('M', cast(s_suppkey % 9 as string)) as municipio, lpad(cast(s_suppkey % 90 + 1000 as string), 5, '0') as cp,
        case when s_acctbal >= 0 then 'Vigente' else 'Cancelado' end as estatus,
        case when s_suppkey % 4 = 0 then null else concat('s', cast(s_suppkey as string), '@cert.mx') end as correo,
        case when s_suppkey % 5 = 0 then null else concat('+5255', lpad(cast(s_suppkey as string), 8, '0')) end as telefono,
        cast(concat(cast(2010 + s_suppkey % 12 as string), '-', lpad(cast(s_suppkey % 12 + 1 as string), 2, '0'), '-15') as date) as fecha_acreditacion
        from supplier join nation on s_nationkey = n_nationkey""",
    "centros": f"""select {_centro('c_custkey')} as centro_id, c_name as nombre, c_mktsegment as municipio, n_name as estado,
        lpad(cast(n_nationkey + 1 as string), 2, '0') as estado_inegi, lpad(cast(c_custkey % 90 + 2000 as string), 5, '0') as cp,
        case when c_custkey % 11 = 0 then 'ECE99999' else {_cert('(c_custkey % 100)')} end as certificador_id,
        cast(14 as double) + cast(c_custkey % 180 as double) / 10 as latitud, cast(-117 as double) + cast(c_custkey % 300 as double) / 10 as longitud
        from customer join nation on c_nationkey = n_nationkey""",
    "ece_ec": f"select {_cert('l_suppkey')} as cert_id, {_ec('l_partkey')} as ec_clave, min(cast(l_shipdate as date)) as acreditado_desde from lineitem group by l_suppkey, l_partkey",
    "centro_ec": f"select distinct {_centro('o_custkey')} as centro_id, {_ec('l_partkey')} as ec_clave from orders join lineitem on o_orderkey = l_orderkey",
    "ec_sector": f"select {_ec('p_partkey')} as ec_clave, p_partkey % 4 as sector_id, p_partkey % 25 as comite_id from part",
    "ec_history": f"""select {_ec('p_partkey')} as ec_clave, l_returnflag as version, concat(p_name, case when p_partkey % 3 = 0 then concat(' ', l_returnflag) else '' end) as titulo,
        case when p_partkey % 5 = 0 then l_returnflag = 'A' else true end as vigente, p_partkey % 4 as sector_id, cast(p_size % 5 + 1 as string) as nivel,
        min(l_shipdate) as first_seen, max(l_shipdate) as last_seen from lineitem join part on l_partkey = p_partkey
        group by p_partkey, p_name, p_size, l_returnflag""",
    "cert_history": f"""select {_cert('s_suppkey')} as cert_id, l_returnflag as version, case when s_suppkey % 3 = 0 then 'OC' else 'ECE' end as tipo, s_name as nombre_legal,
        case when s_suppkey % 2 = 0 and l_returnflag = 'R' then 'Cancelado' else 'Vigente' end as estatus, n_name as estado,
        min(l_shipdate) as first_seen, max(l_shipdate) as last_seen from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey
        where l_partkey % 50 = l_suppkey % 50 group by s_suppkey, s_name, n_name, l_returnflag""",
    "items": """select doc_id as item_id, case doc_id % 5 when 0 then 'ec_standard' when 1 then 'certificador' when 2 then 'center' when 3 then 'course' end as type,
        case when doc_id % 5 = 0 then concat(case when doc_id % 7 = 0 then 'ec' else 'EC' end, case when doc_id % 11 = 0 then 'X' else '' end, lpad(cast(doc_id % 10000 as string), 4, '0'))
             when doc_id % 5 = 1 then concat('OC', lpad(cast(doc_id % 1000 as string), 3, '0')) when doc_id % 5 = 2 then concat('CE', lpad(cast(doc_id % 100000 as string), 5, '0')) end as code,
        case when doc_id % 13 = 0 then '' else substr(text, 1, 40) end as title, case when doc_id % 17 = 0 then null else concat('  ', substr(text, 3, 30), ' ') end as name,
        case when doc_id % 19 = 0 then 'not-an-email' when doc_id % 3 = 0 then null else concat('Contacto', cast(doc_id as string), '@CERT.MX') end as contact_email,
        case doc_id % 4 when 0 then '5555555555' when 1 then '52 555 555 5555' when 2 then '+525555555555' else '123' end as contact_phone,
        case doc_id % 6 when 0 then 'cdmx' when 1 then 'mexico' when 2 then 'NL' when 3 then 'jalisco' when 4 then ' D.F. ' end as state,
        case when doc_id % 5 in (2) then concat('OC', lpad(cast(doc_id % 1000 as string), 3, '0')) end as certificador_code,
        case when doc_id % 5 = 3 then case when doc_id % 7 = 3 then 'BAD' else concat('EC', lpad(cast(doc_id % 10000 as string), 4, '0')) end end as ec_code,
        case when doc_id % 23 = 0 then 'invalid' else cast(doc_id % 6 as string) end as level, concat(cast(doc_id % 200 as string), ' horas') as duration,
        case doc_id % 3 when 0 then 'En línea' when 1 then 'PRESENCIAL' else 'Híbrido' end as modality,
        case when doc_id % 29 = 0 then 'BAD' else concat('CCT', lpad(cast(doc_id % 1000000 as string), 6, '0'), 'ABC') end as rfc,
        concat('https://example.org/', source, '/', cast(doc_id as string), case when doc_id % 2 = 0 then '/' else '' end) as url,
        concat('Calle ', cast(doc_id as string), case when doc_id % 2 = 0 then ', C.P. 0' else ' ' end, cast(1000 + doc_id % 9000 as string)) as address,
        text, lang, source from documents""",
    "request_log": """select event_id, ts, user_id, concat('host', cast(user_id % 10 as string), '.example.org') as host,
        concat(case when user_id % 4 = 0 then '/static/' else '/api/' end, event_type, '/', cast(user_id % 3 as string), '/x') as path, case when event_type in ('view', 'click') then 'GET' else 'POST' end as method,
        event_type as component, case when event_type = 'error' then 500 else 200 end as status, value as duration, props from events""",
    "runs": """select concat('H', cast(user_id as string), '_', cast(cast(ts as date) as string)) as harvest_id, case when user_id % 2 = 0 then 'harvest' else 'probe' end as mode,
        min(ts) as start_time, max(ts) as end_time, sum(case when event_type = 'error' then 1 else 0 end) as errors,
        sum(case when event_type <> 'error' then 1 else 0 end) as items, sum(case when event_type = 'view' then 1 else 0 end) as pages,
        case when sum(case when event_type = 'error' then 1 else 0 end) > 1 then 'failed' else 'completed' end as status
        from events group by user_id, cast(ts as date)""",
    "links": """select p.page_id as src, case e.k when 0 then (3 * p.page_id + 1) % s.n else (7 * p.page_id + 2) % s.n end as dst
        from pages p cross join (select count(*) as n from pages) s cross join (select 0 as k union all select 1 as k) e""",
    "fetch_log": """select page_id, url, 0 as fetch, md5(html) as hash, length(html) as size, case when page_id % 17 = 0 then 404 else 200 end as status from pages
        union all select page_id, url, 1 as fetch, case when page_id % 5 = 0 then md5(concat(html, 'x')) else md5(html) end as hash, length(html) as size,
        case when page_id % 19 = 0 then 500 else 200 end as status from pages""",
}


def _needs(sql: str) -> set[str]:
    return {w for w in re.findall(r"\b(?:from|join)\s+(\w+)", sql, re.I) if w in VIEWS}


def with_views(sql: str) -> str:
    """sql with the views that it uses put before it as common table expressions."""
    order: list[str] = []

    def visit(text: str):
        for v in sorted(_needs(text)):
            if v not in order:
                visit(VIEWS[v])
                order.append(v)

    visit(sql)
    if not order:
        return sql
    head = ", ".join(f"{v} as ({VIEWS[v]})" for v in order)
    body = sql.strip()
    if body.lower().startswith("with recursive "):
        return f"with recursive {head}, {body[15:]}"
    if body.lower().startswith("with "):
        return f"with {head}, {body[5:]}"
    return f"with {head} {body}"


#: Views that group a large table into hardly fewer rows: the table's rows are dealt by these columns first, so that no task groups a whole split.
DEALT = {"ece_ec": {"lineitem": ("l_suppkey", "l_partkey")}}


class Registry:
    """The registry's tables of one data folder, each read when it is first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def base(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def sql(self, text: str, by: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
        """A query over the views; the session's own temporary views are left alone. by names columns by which tables are dealt to tasks."""
        frames: dict[str, DataFrame] = {}

        def named(m):
            frames[m[2]] = dealt(self.base(m[2]), *by[m[2]]) if by and m[2] in by else self.base(m[2])
            return f"{m[1]} {{{m[2]}}}"

        body = with_views(text).replace("{", "{{").replace("}", "}}")
        body = re.sub(rf"\b(from|join)\s+({'|'.join(BASE_TABLES)})\b", named, body, flags=re.I)
        return self.spark.sql(body, **frames)

    def __getattr__(self, name: str) -> DataFrame:
        if name in VIEWS:
            return self.sql(f"select * from {name}", DEALT.get(name))
        if name in BASE_TABLES:
            return self.base(name)
        raise AttributeError(name)
