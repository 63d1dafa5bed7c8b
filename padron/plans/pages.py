"""Queries of K and L over pages: stored ones, and ones that Spark writes from the registry views."""

from __future__ import annotations

from pyspark.sql import functions as F

from padron.functions import rules
from padron.operators import extract, linkgraph
from padron.plans.catalog import query
from padron.schemas import STATES

C = F.col


def _html(*parts):
    return F.concat(*[F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("")) for p in parts])


def _row(label, value):
    return F.concat(F.lit(f"<tr><th>{label}:</th><td>"), F.coalesce(value.cast("string"), F.lit("")), F.lit("</td></tr>"))


def _page(df, url, *parts):
    return df.select(F.xxhash64(url).alias("page_id"), url.alias("url"), F.concat(F.lit("<html><head><title>T</title></head><body>"), *parts, F.lit("</body></html>")).alias("html"))


def _hundred(key):
    """The code without its last two digits."""
    return F.expr(f"substr({key}, 1, length({key}) - 2)").alias("part")


def _ec_pages(r):
    detail = _page(r.ec, F.concat(F.lit("https://example.org/ec/"), C("ec_clave")), F.lit("<table>"), _row("Código", C("ec_clave")), _row("Nivel", C("nivel")), _row("Duración", F.concat(C("duracion_horas").cast("string"), F.lit(" horas"))), _row("Vigente", F.when(C("vigente"), "Sí").otherwise("No")), _row("Versión", F.lit("v 2.00")), F.lit("</table>"))
    line = F.concat(F.lit("<tr><td>"), C("ec_clave"), F.lit('</td><td><a href="/ec/'), C("ec_clave"), F.lit('">'), C("titulo"), F.lit("</a></td></tr>"))
    # pages of at most a hundred rows
    groups = r.ec.groupBy("comite_id", _hundred("ec_clave")).agg(F.array_join(F.sort_array(F.collect_list(line)), "").alias("rows"))
    listing = _page(groups, F.concat(F.lit("https://example.org/list/"), C("comite_id").cast("string"), F.lit("/"), C("part")), F.lit("<table><tr><th>Código</th><th>Título</th></tr>"), C("rows"), F.lit('</table><a href="?p=2">Siguiente</a>'))
    return detail.unionByName(listing)


def _pair(label, value):
    """A row of two plain cells, between cells and rows that say nothing."""
    return _html("<tr><td>&nbsp;</td><td>", label, "</td><td></td><td>", value, "</td><td>otro</td></tr><tr><td>", value, "</td></tr>")


def _cert_pages(r):
    codes = r.ece_ec.groupBy("cert_id").agg(F.sort_array(F.collect_list("ec_clave")).alias("codes"))
    df = r.cert.join(codes, "cert_id", "left").withColumn("codes", F.coalesce("codes", F.array().cast("array<string>")))
    # codes of another form are left out
    standards = F.concat(F.transform("codes", lambda c: F.struct(c.alias("code"), F.lit("x").alias("name"))), F.array(F.struct(F.lit("EC1").alias("code"), F.lit("y").alias("name"))))
    contact = F.array(F.create_map(F.lit("nombre"), C("siglas"), F.lit("correo"), C("correo")))
    modal = F.concat(F.lit("<script>var x = 1; var modalData = "), F.to_json(F.struct(standards.alias("standards"), contact.alias("contacts"))), F.lit("; f(modalData);</script>"))
    return _page(df, F.concat(F.lit("https://example.org/cert/"), C("cert_id")), F.lit("<table>"), _row("Cédula", C("cert_id")), _row("Nombre", C("nombre_legal")), _row("Estatus", C("estatus")), _row("Estado", C("estado")), _row("Teléfono", C("telefono")), _row("Correo", F.upper("correo")), _row("Domicilio", F.concat(F.lit("Calle 1, C.P. "), C("cp"))), F.lit("</table>"), modal)


@query("K1_html_cells", "select page_id, len(regexp_extract_all(html, '<a href=\"')) as links, len(regexp_extract_all(html, '<h[123][ >]')) as headings from pages")
def k1(r):
    cells = extract.html_cells(r.pages)
    return cells.groupBy("page_id").agg(F.count_if(C("kind") == "link").alias("links"), F.count_if(C("kind") == "heading").alias("headings"))


@query("K2_extract_ec", "select ec_clave, titulo, nivel, cast(duracion_horas as int) as duracion_horas, vigente, '2.00' as version from ec")
def k2(r):
    return extract.extract_ec(extract.html_cells(_ec_pages(r))).select("ec_clave", "titulo", "nivel", "duracion_horas", "vigente", "version")


@query("K3_extract_cert", "select c.cert_id, tipo, nombre_legal, estatus, correo, telefono, cp, upper(estado) as estado, siglas as contacto, coalesce(x.codes, '') as codes from cert c left join (select cert_id, string_agg(ec_clave, ',' order by ec_clave) as codes from ece_ec group by cert_id) x on c.cert_id = x.cert_id")
def k3(r):
    out = extract.extract_cert(extract.html_cells(_cert_pages(r)))
    return out.select("cert_id", "tipo", "nombre_legal", "estatus", "correo", "telefono", "cp", "estado", C("contactos")[0]["nombre"].alias("contacto"), F.array_join("codes", ",").alias("codes"))


@query("K4_extract_centro", "select centro_id, nombre, municipio, certificador_id as cert_id, concat(estado, '|', lower(estado)) as modalidades, case when ec < other then concat(ec, ',', other) else concat(other, ',', ec) end as codes from (select *, concat('EC', right(centro_id, 4)) as ec, concat('EC', right(centro_id, 2), right(centro_id, 1), '9') as other from centros)".replace("case when ec < other", "case when ec = other then ec when ec < other"))
def k4(r):
    code, other = F.expr("concat('EC', right(centro_id, 4))"), F.expr("concat('EC', right(centro_id, 2), right(centro_id, 1), '9')")
    fields = (("Clave", C("centro_id")), ("Nombre", C("nombre")), ("Municipio", C("municipio")), ("Certificador", C("certificador_id")), ("Modalidades", F.concat("estado", F.lit(" , "), F.lower("estado"))), ("Estándares", F.concat(code, F.lit(" y "), other, F.lit(", "), code)))
    pages = _page(r.centros, F.concat(F.lit("https://example.org/centro/"), C("centro_id")), F.lit("<dl>"), *[F.concat(F.lit(f"<dt>{l}</dt><dd>"), v, F.lit("</dd>")) for l, v in fields], F.lit("</dl>"))
    out = extract.extract_centro(extract.html_cells(pages))
    return out.select("centro_id", "nombre", "municipio", "cert_id", F.array_join("modalidades", "|").alias("modalidades"), F.array_join("codes", ",").alias("codes"))


@query("K5_extract_sector_comite", "select cast(comite_id as int) as comite_id, nombre, cast(length(nombre) as int) as num_estandares, concat(lower(nombre), '@b.mx') as email from comites")
def k5(r):
    pages = _page(r.comites, F.concat(F.lit("https://example.org/comite/"), C("comite_id").cast("string")), F.lit("<table>"), _row("Comité", C("nombre")), _row("Número de estándares", F.concat(F.length("nombre").cast("string"), F.lit(" estándares"))), _row("Correo", F.concat("nombre", F.lit("@b.mx"))), F.lit("</table>"))
    return extract.extract_sector_comite(extract.html_cells(pages)).select("comite_id", "nombre", "num_estandares", "contacto.email")


# ---- details in the forms that pages have: a cell after a cell, classes, ids ----


_STATE = "[" + ", ".join(f"'{n}'" for n in STATES) + "][cast(estado_inegi as int)]"


def _state():
    """The name of a state that has a code, by the row's code."""
    return F.element_at(F.array(*map(F.lit, STATES)), C("estado_inegi").cast("int"))


def _form_of(key):
    """0, 1 or 2 by the last digit of a code."""
    return F.expr(f"cast(right({key}, 1) as int) % 3")


def _by_form(form, *forms):
    out = F.when(form == 0, forms[0])
    for i, f in enumerate(forms[1:], 1):
        out = out.when(form == i, f)
    return out


def _list(values, tag="li"):
    return F.array_join(F.transform(values, lambda v: F.concat(F.lit(f"<{tag}> "), v, F.lit(f" </{tag}>"))), "")


_EC_DETAIL = """select ec_clave, titulo, concat(cast(sector_id as string), '.5') as version, concat('Sector ', cast(sector_id as string)) as sector, cast(sector_id as int) as sector_id, concat('C', cast(comite_id as string)) as comite, cast(comite_id as int) as comite_id,
    descripcion, concat(nivel, 'a|', titulo) as competencias, nivel, cast(duracion_horas as int) as duracion_horas, case when vigente then 'NTCL' else 'NIE' end as tipo_norma,
    cast(date '2010-01-01' + cast(duracion_horas as int) as date) as fecha_publicacion, cast(date '2015-01-01' + cast(duracion_horas as int) as date) as fecha_vigencia, concat('perfil ', nivel) as perfil_evaluador, concat(descripcion, '|', nivel) as criterios from ec"""


@query("K2_detail_forms", _EC_DETAIL)
def k2c(r):
    form = _form_of("ec_clave")
    day = lambda start: F.date_format(F.date_add(F.lit(start).cast("date"), C("duracion_horas").cast("int")), "dd/MM/yyyy")
    skills, version = F.array(F.concat("nivel", F.lit("a")), C("titulo")), F.concat(F.lit("versión "), C("sector_id").cast("string"), F.lit(".5"))
    titulo = _by_form(form, _pair("Título del estándar:", C("titulo")), _html('<h2 class="ec-title">no</h2><h1 class="ec-title">', C("titulo"), "</h1>"), _html('<span id="titulo">', C("titulo"), "</span>"))
    texto = _by_form(form, _html('<tr><td>Descripción</td><td></td><td>', C("descripcion"), "</td></tr>"), _html('<div class="descripcion"><p>', C("descripcion"), "</p></div>"), _html('<div id="descripcion">', C("descripcion"), "</div>"))
    pares = _by_form(form, _html("<tr><td>Elementos</td><td><ul>", _list(skills), "</ul></td></tr>"), _html('<ul class="competencias">', _list(skills), "</ul><ul><li>otro</li></ul>"), F.array_join(F.transform(skills, lambda v: F.concat(F.lit('<div class="competencia-item">'), v, F.lit("</div>"))), ""))
    tabla = _html("<table>", titulo, F.when(form == 0, _pair("Versión", version)), _pair("Sector productivo", _html("Sector ", C("sector_id"))), _pair("Comité", _html("C", C("comite_id"))), texto, pares, _pair("Nivel:", C("nivel")), _pair("Duración", _html(C("duracion_horas"), " horas")), _pair("Tipo", F.when(C("vigente"), "NTCL").otherwise("NIE")), _pair("Fecha de Publicación", day("2010-01-01")), _pair("Fecha de Vigencia", day("2015-01-01")), "</table>")
    rest = _html('<a href="/x?sector=', C("sector_id"), '&y=1">s</a><a href="/x?comite=', C("comite_id"), '">c</a>', F.when(form != 0, _html('<span class="version">', version, "</span>")), '<div class="caja perfil-evaluador">perfil ', C("nivel"), '</div><div class="criterios"><ol>', _list(F.array("descripcion", "nivel")), "</ol></div>")
    # the code stands in the address alone
    pages = _page(r.ec, _html("https://example.org/detalle?clave=", C("ec_clave")), tabla, rest)
    out = extract.extract_ec(extract.html_cells(pages))
    return out.select("ec_clave", "titulo", "version", "sector", "sector_id", "comite", "comite_id", "descripcion", F.array_join("competencias", "|").alias("competencias"), "nivel", "duracion_horas", "tipo_norma", "fecha_publicacion", "fecha_vigencia", "perfil_evaluador", F.array_join("criterios_evaluacion", "|").alias("criterios"))


@query("K2_span_listing", "select ec_clave, titulo, case when vigente then 'active' else 'historical' end as listing_type from ec")
def k2d(r):
    box = _html('<div class="fila"><span class="ec-code"> ', C("ec_clave"), ' </span><p><span class="ec-title">', C("titulo"), "</span></p></div>")
    now, old = _hundreds("?list=ESLACT", "ec_clave"), _hundreds("?list=ESLHIST", "ec_clave")
    pages = _entries(r.ec.filter("vigente"), now, box).unionByName(_entries(r.ec.filter("not vigente"), old, box))
    return extract.extract_ec(extract.html_cells(pages)).select("ec_clave", "titulo", "listing_type")


@query("K3_detail_forms", f"select cert_id, nombre_legal, siglas, coalesce(nullif(estatus, 'Vigente'), 'ACTIVO') as estatus, upper({_STATE}) as estado, estado_inegi, municipio, cp, telefono, correo, concat('http://', lower(siglas), '.mx') as sitio_web, concat('Rep ', nombre_legal) as representante_legal, fecha_acreditacion from cert")
def k3d(r):
    form = _form_of("cert_id")
    nombre = _by_form(form, _pair("Nombre legal", C("nombre_legal")), _html('<h1 class="cert-title">', C("nombre_legal"), "</h1>"), _html('<div class="nombre-legal"> ', C("nombre_legal"), "</div>"))
    estatus = F.when(C("estatus") != "Vigente", _by_form(form, _pair("Estatus", C("estatus")), _html('<span class="status">', C("estatus"), "</span>"), _pair("Estatus:", C("estatus"))))
    cp = _by_form(form, _pair("C.P.", C("cp")), _html("<tr><td>Domicilio</td><td>Calle 1</td><td>C.P. ", C("cp"), "</td></tr>"), _html('<div class="domicilio">Calle 1, CP ', C("cp"), "</div>"))
    correo = F.when(C("correo").isNotNull(), F.when(form == 1, _html('<a href="mailto:x">', F.upper("correo"), "</a>")).otherwise(_pair("Correo electrónico", C("correo"))))
    sitio = F.concat(F.lower("siglas"), F.lit(".mx"))
    web = F.when(form == 2, _pair("Sitio web", sitio)).otherwise(_html('<tr><td>Sitio</td><td><a href="', F.when(form == 1, F.concat(F.lit("http://"), sitio)).otherwise(sitio), '">ver</a></td></tr>'))
    day = F.date_format("fecha_acreditacion", "yyyy-MM-dd")
    tabla = _html("<table>", nombre, _pair("Siglas", C("siglas")), estatus, cp, _pair("Estado", _state()), _pair("Municipio", C("municipio")), F.when(C("telefono").isNotNull(), _pair("Teléfono", C("telefono"))), correo, web, _pair("Representante legal", F.concat(F.lit("Rep "), C("nombre_legal"))), _pair("Fecha de Acreditación", day), "</table>")
    out = extract.extract_cert(extract.html_cells(_page(r.cert, _html("https://example.org/ver/", C("cert_id"), "/x"), tabla)))
    return out.select("cert_id", "nombre_legal", "siglas", "estatus", "estado", "estado_inegi", "municipio", "cp", "telefono", "correo", "sitio_web", "representante_legal", "fecha_acreditacion")


@query("K4_detail_forms", f"""select centro_id, nombre, certificador_id as cert_id, upper({_STATE}) as estado, estado_inegi, municipio, cp, concat(lower(centro_id), '@c.mx') as correo, concat('R ', nombre) as responsable, concat(municipio, '|', estado) as modalidades,
    case when ec = 'EC0007' then ec when ec < 'EC0007' then concat(ec, ',EC0007') else concat('EC0007,', ec) end as codes, cast(date '2012-01-01' + cast(cp as int) % 900 as date) as fecha_acreditacion from (select *, concat('EC', right(centro_id, 4)) as ec from centros)""")
def k4c(r):
    form, ec = _form_of("centro_id"), F.expr("concat('EC', right(centro_id, 4))")
    nombre = _by_form(form, _html('<h1 class="centro-title">', C("nombre"), "</h1>"), _pair("Nombre", C("nombre")), _html('<div class="nombre-centro">', C("nombre"), "</div>"))
    owner = F.when(form == 0, _html('<a href="?list=CERT_VER&id=', C("certificador_id"), '&z=1">c</a>')).otherwise(_pair("Certificador", _html("el ", C("certificador_id"), " de aquí")))
    cp = _by_form(form, _pair("Código postal C.P.", _html("C.P. ", C("cp"))), _html('<div class="domicilio">Calle 1 C.P. ', C("cp"), "</div>"), _html("<address>Calle 1 <b>C.P. ", C("cp"), "</b></address>"))
    modes = F.when(form == 1, _pair("Modalidad", _html(C("municipio"), " , ", C("estado")))).otherwise(_html("<tr><td>Modalidad</td><td><ul>", _list(F.array("municipio", "estado")), "</ul></td></tr>"))
    both = F.array(F.concat(ec, F.lit(" uno")), F.lit("dos EC0007"), ec)
    codes = _by_form(form, _html('<div class="estandares"><p><span class="ec-code">', ec, '</span><span class="ec-code">EC0007</span></p></div><span class="ec-code">EC9999</span>'), _html("<tr><td>Estándares</td><td><ul>", _list(both), "</ul></td></tr>"), _html('<ul class="ec-list">', _list(both), "</ul>"))
    day = F.date_format(F.date_add(F.lit("2012-01-01").cast("date"), (C("cp").cast("int") % 900).cast("int")), "dd/MM/yyyy")
    tabla = _html("<table>", nombre, owner, cp, _pair("Estado", _state()), _pair("Municipio", C("municipio")), _pair("Correo", F.concat("centro_id", F.lit("@C.MX"))), _pair("Responsable", F.concat(F.lit("R "), C("nombre"))), _pair("Acreditación", day), modes, F.when(form == 1, codes), "</table>", F.when(form != 1, codes))
    out = extract.extract_centro(extract.html_cells(_page(r.centros, _html("https://example.org/?controller=CENTRO&id=", C("centro_id")), tabla)))
    return out.select("centro_id", "nombre", "cert_id", "estado", "estado_inegi", "municipio", "cp", "correo", "responsable", F.array_join("modalidades", "|").alias("modalidades"), F.array_join("codes", ",").alias("codes"), "fecha_acreditacion")


@query("K5_detail_forms", f"""select cast(c.comite_id as int) as comite_id, cast(c.sector_id as int) as sector_id, c.nombre, concat('d ', c.nombre) as descripcion, concat('o ', c.nombre) as objetivo, -1 as num_comites, cast(c.comite_id as int) as num_estandares, cast(date '2001-01-01' + cast(c.comite_id as int) as date) as creado, cast(date '2011-01-01' + cast(c.comite_id as int) as date) as cambiado,
    lower(c.nombre) as email, concat('55 ', cast(c.comite_id as string)) as phone, coalesce(string_agg(e.ec_clave, ',' order by e.ec_clave), '') as codes from comites c left join ec_sector e on e.comite_id = c.comite_id group by all
    union all select -1, cast(s.sector_id as int), s.nombre, concat('d ', s.nombre), null, cast(n as int), cast(s.sector_id as int) + 7, cast(date '2001-01-01' + cast(s.sector_id as int) as date), null, null, null, '' from sectores s join (select sector_id, count(*) as n from comites group by sector_id) x on x.sector_id = s.sector_id""")
def k5c(r):
    def common(key, nombre):
        form = C(key) % 3
        day = lambda start: F.date_format(F.date_add(F.lit(start).cast("date"), C(key).cast("int")), "yyyy-MM-dd")
        name = _by_form(form, _html("<h1><b>", C("nombre"), "</b></h1>"), _pair(nombre, C("nombre")), _html('<div class="entity-name">', C("nombre"), "</div>"))
        about = _by_form(form, _html('<div class="descripcion">d ', C("nombre"), "</div>"), _html("<tr><td>Descripción</td><td></td><td>d ", C("nombre"), "</td></tr>"), _html('<p class="description">d ', C("nombre"), "</p>"))
        return form, name, about, day

    codes = r.ec_sector.groupBy("comite_id").agg(F.collect_list("ec_clave").alias("codes"))
    df = r.comites.join(codes, "comite_id", "left").withColumn("codes", F.coalesce("codes", F.array().cast("array<string>")))
    form, name, about, day = common("comite_id", "Nombre del comité")
    links = F.array_join(F.transform("codes", lambda c: F.concat(F.lit('<a href="/ec?EC='), c, F.lit('">'), c, F.lit("</a> "))), "")
    lists = _by_form(form, _html('<div class="estandares">', links, "</div>"), _html('<ul class="ec-list">', _list(C("codes")), "</ul>"), _html("<tr><td>Estándares</td><td></td><td>", links, "</td></tr>"))
    owner = F.when(form == 0, _html('<a href="?list=SECTOR_VER&id=', C("sector_id"), '">s</a>')).otherwise(_pair("Sector", _html("el ", C("sector_id"), " - x")))
    tabla = _html("<table>", _pair("Estándares:", _html(C("comite_id"), " en total")), name, about, owner, _pair("Objetivo", _html("o ", C("nombre"))), _pair("Fecha de Creación", day("2001-01-01")), _pair("Última Actualización", day("2011-01-01")), _pair("Correo", F.upper("nombre")), _pair("Teléfono", _html("55 ", C("comite_id"))), lists, "</table>")
    pages = _page(df, _html("https://example.org/comite/", C("comite_id")), tabla)
    sectors = r.sectores.join(r.comites.groupBy("sector_id").agg(F.count("*").alias("n")), "sector_id")
    _, name, about, day = common("sector_id", "Nombre")
    tabla = _html("<table>", name, about, _pair("Comités", C("n")), _pair("Estándares", C("sector_id") + 7), _pair("Creación", day("2001-01-01")), "</table>")
    pages = pages.unionByName(_page(sectors, _html("https://example.org/sector/", C("sector_id")), tabla))
    out = extract.extract_sector_comite(extract.html_cells(pages))
    return out.select(F.coalesce("comite_id", F.lit(-1)).alias("comite_id"), "sector_id", "nombre", "descripcion", "objetivo", F.coalesce("num_comites", F.lit(-1)).alias("num_comites"), "num_estandares", C("fecha_creacion").alias("creado"), C("fecha_actualizacion").alias("cambiado"), "contacto.email", "contacto.phone", F.array_join("estandares", ",").alias("codes"))


def _entries(df, url, entry, before="", after=""):
    """Listing pages with the entries of each address, between look-alikes that are no entries."""
    decoys = F.lit('<table class="menu"><tr><td>Menú</td></tr><tr><td><a href="?id=M1">uno</a></td><td>x</td></tr></table><div class="panel" data-id="P1"><h3>Panel</h3><span class="estado">x</span></div>')
    pages = df.groupBy(url.alias("address")).agg(F.array_join(F.collect_list(entry), "").alias("entries"))
    return _page(pages, C("address"), decoys, F.lit(before), C("entries"), F.lit(after), F.lit('<a href="/pie?x=9">pie</a>'))


def _hundreds(address, key):
    return F.concat(F.lit(f"https://example.org/{address}&part="), F.expr(f"substr({key}, 1, length({key}) - 2)"))


_TABLE = ('<table class="table"><tr><th>A</th><th>B</th><th>C</th><th>D</th></tr>', "</table>")


@query("K2_listing_type", "select ec_clave, case when vigente then 'active' else 'historical' end as listing_type, vigente from ec")
def k2b(r):
    # what is in force stands in two listings, of which the first counts
    row = _html("<tr><td>", C("ec_clave"), "</td><td>", C("titulo"), "</td></tr>")
    now, old = _hundreds("?list=ESLACT", "ec_clave"), _hundreds("?list=ESLHIST", "ec_clave")
    pages = _entries(r.ec.filter("vigente"), now, row, *_TABLE).unionByName(_entries(r.ec, old, row, *_TABLE))
    return extract.extract_ec(extract.html_cells(pages)).select("ec_clave", "listing_type", "vigente")


@query("K3_list_cert", "select cert_id, tipo, nombre_legal, siglas, estado, estatus, case when tipo = 'OC' then 'card' else 'table' end as form from cert")
def k3b(r):
    row = _html("<tr><td>", C("nombre_legal"), "</td><td>", C("siglas"), "</td><td>", C("estado"), "</td><td>", C("estatus"), '</td><td><a href="/ver?x=1&id=', C("cert_id"), '&z=2">ver</a></td></tr>')
    card = _html('<div class="certificador-card" data-cert-id="', C("cert_id"), '"><h3 class="cert-name">', C("nombre_legal"), '</h3><div class="datos"><span class="cert-siglas">', C("siglas"), '</span><span class="cert-estado">', C("estado"), '</span></div><span class="cert-status">', C("estatus"), "</span></div>")
    tables = _entries(r.cert.filter("tipo = 'ECE'"), _hundreds("?comp=ECE", "cert_id"), row, *_TABLE)
    cards = _entries(r.cert.filter("tipo = 'OC'"), _hundreds("?comp=OC", "cert_id"), card)
    return extract.list_cert(extract.html_cells(tables.unionByName(cards))).select("cert_id", "tipo", "nombre_legal", "siglas", "estado", "estatus", "form")


@query("K3_modal_html", "select cert_id, string_agg(ec_clave, ',' order by ec_clave) as codes from ece_ec group by cert_id")
def k3c(r):
    codes = r.ece_ec.groupBy("cert_id").agg(F.array_join(F.transform(F.collect_list("ec_clave"), lambda c: F.concat(F.lit('<p><span class="ec-code"> '), c, F.lit(" </span></p>"))), "").alias("spans"))
    pages = _page(codes, F.concat(F.lit("https://example.org/cert/"), C("cert_id")), F.lit("<table>"), _row("Cédula", C("cert_id")), F.lit('</table><span class="ec-code">EC9998</span><div class="modal-estandares"><div class="lista">'), C("spans"), F.lit('<span class="ec-code">EC12</span></div></div><div class="otro"><span class="ec-code">EC9999</span></div>'))
    return extract.extract_cert(extract.html_cells(pages)).select("cert_id", F.array_join("codes", ",").alias("codes"))


@query("K4_list_centro", "select centro_id, nombre, case when right(centro_id, 1) in ('0', '1', '2') then null else estado end as estado, case when right(centro_id, 1) in ('0', '1', '2') then null else municipio end as municipio, case when right(centro_id, 1) in ('0', '1', '2') then 'link' when right(centro_id, 1) in ('3', '4', '5') then 'card' else 'table' end as form, case when right(centro_id, 1) in ('6', '7', '8', '9') then certificador_id end as cert_id from centros")
def k4b(r):
    df = r.centros.withColumn("k", F.expr("right(centro_id, 1)").cast("int"))
    link = _html('<p><a href="?controller=CENTRO&id=', C("centro_id"), '">', C("nombre"), "</a></p>")
    card = _html('<div class="centro-card"><h3 class="centro-name">', C("nombre"), '</h3><span class="estado">', C("estado"), '</span><div class="mas"><span class="municipio">', C("municipio"), '</span><a href="?id=', C("centro_id"), '">ver</a></div></div>')
    row = _html('<tr data-centro-id="', C("centro_id"), '"><td>', C("nombre"), "</td><td>", C("certificador_id"), "</td><td>", C("estado"), "</td><td>", C("municipio"), "</td></tr>")
    owner = F.concat(F.lit("https://example.org/?list=CERT_CENTROS&id="), C("certificador_id"), F.lit("&part="), F.expr("substr(centro_id, 1, length(centro_id) - 2)"))
    pages = [_entries(df.filter("k < 3"), _hundreds("?list=L", "centro_id"), link), _entries(df.filter("k between 3 and 5"), _hundreds("?list=C", "centro_id"), card), _entries(df.filter("k > 5"), owner, row, *_TABLE)]
    out = extract.list_centro(extract.html_cells(pages[0].unionByName(pages[1]).unionByName(pages[2])))
    return out.select("centro_id", "nombre", "estado", "municipio", "form", "cert_id")


@query("K5_list_sector_comite", "select cast(comite_id as int) as id, nombre, cast(sector_id as int) as sector_id, -1 as num_comites, cast(length(nombre) as int) as num_estandares, 'table' as form from comites union all select cast(sector_id as int), nombre, -1, -1, -1, 'card' from sectores union all select cast(s.sector_id as int), nombre, -1, cast(n as int), 7, 'table' from sectores s join (select sector_id, count(*) as n from comites group by sector_id) c on s.sector_id = c.sector_id")
def k5b(r):
    row = _html("<tr><td>", C("nombre"), "</td><td>s</td><td>", F.length("nombre"), ' estándares</td><td><a href="?id=', C("comite_id"), '">ver</a></td></tr>')
    card = _html('<div class="panel sector-card" data-sector-id="', C("sector_id"), '"><h3>', C("nombre"), "</h3></div>")
    counts = r.sectores.join(r.comites.groupBy("sector_id").agg(F.count("*").alias("n")), "sector_id")
    counted = _html('<tr data-id="', C("sector_id"), '"><td>', C("nombre"), "</td><td>", C("n"), " comités</td><td>7</td></tr>")
    owner = F.concat(F.lit("https://example.org/?list=SECTOR_COMITES&id="), C("sector_id").cast("string"))
    cells = extract.html_cells(_entries(r.comites, owner, row, *_TABLE))
    sectors = extract.html_cells(_entries(r.sectores, F.lit("https://example.org/?list=SECTORES&p=1"), card).unionByName(_entries(counts, F.lit("https://example.org/?list=SECTORES&p=2"), counted, *_TABLE)))
    none = F.lit(-1)
    out = extract.list_comite(cells).select(C("comite_id").alias("id"), "nombre", "sector_id", none.alias("num_comites"), "num_estandares", "form")
    return out.unionByName(extract.list_sector(sectors).select(C("sector_id").alias("id"), "nombre", none.alias("sector_id"), *[F.coalesce(c, none).alias(c) for c in ("num_comites", "num_estandares")], "form"))


@query("K6_merge_listing_detail", "select cert_id, case when siglas = 'S1' then upper(nombre_legal) else nombre_legal end as nombre_legal, estatus from cert")
def k6(r):
    listing = r.cert.filter("siglas = 'S1'").select("cert_id", F.upper("nombre_legal").alias("nombre_legal"))
    return extract.merge_listing_detail(listing, r.cert.select("cert_id", "nombre_legal", "estatus"), "cert_id")


@query("K7_fallback_selectors", "select item_id, coalesce(nullif(trim(title), ''), nullif(trim(name), ''), trim(code)) as v from items where coalesce(code, 'x') <> ''")
def k7(r):
    return r.items.select("item_id", extract.first_non_empty(C("title"), C("name"), C("code")).alias("v"))


def _outline(rows):
    """One row of a page: its links, and its first heading."""
    heads = [x["text"] for x in rows if x["kind"] == "heading"]
    yield rows[0]["page_id"], sum(x["kind"] == "link" for x in rows), heads[0] if heads else None


@query("K_registered_extractor", "select page_id, cast(len(regexp_extract_all(html, '<a href=\"')) as int) as links, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_extract(html, '<h1>([^<]*)</h1>', 1), '&quot;?', '\"', 'g'), '&#0*39;|&#[xX]0*27;', '''', 'g'), '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&amp;?', '&', 'g'), '\\s+', ' ', 'g')) as heading, case when len(regexp_extract_all(html, '<a href=\"')) > 5 then 'links:many' else '' end as errors from pages")
def k_registered(r):
    # an extractor and rules of a user's own, run by their names
    extract.register_extractor("outline", extract.page_extractor("page_id long, links int, heading string", _outline))
    rules.register_rules("outline", lambda df: [rules.error("links", "many", C("links") > 5), rules.required("page_id")])
    found = rules.checked(extract.run_extractor("outline", extract.html_cells(r.pages)), "outline")
    return found.select("page_id", "links", "heading", F.array_join(F.transform("errors", lambda e: F.concat_ws(":", e["field"], e["message"])), ",").alias("errors"))


@query("K8_edges_from_lists", "select distinct e.cert_id, ec_clave, fecha_acreditacion as acreditado_desde, 'R1' as run_id from ece_ec e join cert c on c.cert_id = e.cert_id")
def k8(r):
    lists = r.ece_ec.groupBy("cert_id").agg(F.concat(F.collect_list("ec_clave"), F.collect_list("ec_clave")).alias("codes")).join(r.cert.select("cert_id", "fecha_acreditacion"), "cert_id")
    return extract.edges_from_lists(lists, "cert_id", "codes", "R1", "fecha_acreditacion")


@query("K8_sector_edges", "select ec_clave, cast(c.sector_id as int) as sector_id, cast(c.comite_id as int) as comite_id from ec_sector e join comites c on c.comite_id = e.comite_id where c.comite_id % 2 = 0")
def k8b(r):
    # committees with an odd id name no sector
    # pages of at most a hundred standards, each named twice
    lists = r.ec_sector.groupBy("comite_id", _hundred("ec_clave")).agg(F.concat(F.collect_list("ec_clave"), F.collect_list("ec_clave")).alias("codes"))
    owner = F.when(C("comite_id") % 2 == 0, _pair("Sector", _html("núm. ", C("sector_id"))))
    pages = _page(r.comites.join(lists, "comite_id"), _html("https://example.org/comite/", C("comite_id"), "?part=", C("part")), F.lit("<table>"), F.coalesce(owner, F.lit("")), _html("</table><ul class=\"ec-list\">", _list(C("codes")), "</ul>"))
    return extract.sector_edges(extract.extract_sector_comite(extract.html_cells(pages)))


def _listed(df, key, *parts):
    """Listing pages of at most a hundred cards, each in a container, with look-alikes outside of any."""
    card = F.concat(*[F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    decoy = F.lit('<div class="menu"><span class="ec-code">EC9999</span><span class="oec-code">OC999</span><h3 class="nombre">Menú</h3><a href="mailto:menu@x.mx">m</a></div>')
    return _page(df.groupBy(_hundred(key)).agg(F.array_join(F.collect_list(card), "").alias("cards")), C("part"), decoy, C("cards"), F.lit('<div class="pie"><span class="telefono">000</span></div>'))


@query("K9_extract_v1_items", "select 'ec_standard' as type, ec_clave as code, titulo as title, nivel as level from ec")
def k9(r):
    pages = _listed(r.ec, "ec_clave", '<div class="lista estandar-item"><span class="ec-code">', C("ec_clave"), '</span><h3 class="ec-title">', C("titulo"), '</h3><span class="nivel">', C("nivel"), "</span></div>")
    return extract.extract_v1_items(extract.html_cells(pages), "ec_standard").select("type", "code", "title", "level")


@query("K9_v1_certificador", "select 'certificador' as type, cert_id as code, nombre_legal as name, coalesce(correo, '') as email, coalesce(telefono, '') as phone, concat('Calle 1, C.P. ', cp) as address from cert where tipo = 'OC'")
def k9b(r):
    # the code has no class of its own, it is told by its text
    mail = F.when(C("correo").isNotNull(), F.concat(F.lit('<a href="mailto:'), C("correo"), F.lit('">Correo</a>')))
    pages = _listed(r.cert.filter("tipo = 'OC'"), "cert_id", '<div class="oec-item"><h3 class="oec-name">', C("nombre_legal"), '</h3><span class="x">', C("cert_id"), "</span>", mail, '<span class="telefono">', C("telefono"), '</span><div class="direccion">Calle 1, C.P. ', C("cp"), "</div></div>")
    return extract.extract_v1_items(extract.html_cells(pages), "certificador").select("type", "code", "name", *[F.coalesce(c, F.lit("")).alias(c) for c in ("email", "phone", "address")])


@query("K9_v1_center", "select 'center' as type, centro_id as code, nombre as name, certificador_id as certificador, concat(centro_id, '@c.mx') as email from centros")
def k9c(r):
    pages = _listed(r.centros, "centro_id", '<div class="centro-evaluacion-mx"><h3 class="nombre">', C("nombre"), '</h3><span class="ce-code">', C("centro_id"), '</span><span class="oec-parent">', C("certificador_id"), '</span><a href="mailto:', C("centro_id"), '@c.mx">c</a></div>')
    return extract.extract_v1_items(extract.html_cells(pages), "center").select("type", "code", "name", "certificador", "email")


@query("K9_v1_course", "select 'course' as type, concat('Curso de ', titulo) as name, ec_clave as ec_code, concat(cast(duracion_horas as string), ' horas') as duration, case when vigente then 'Presencial' else 'En Línea' end as modality from ec")
def k9d(r):
    pages = _listed(r.ec, "ec_clave", '<div class="curso-item"><h3 class="curso-name">Curso de ', C("titulo"), '</h3><span class="c1">', C("ec_clave"), '</span><span class="c2">', C("duracion_horas"), ' horas</span><span class="c3">', F.when(C("vigente"), "Presencial").otherwise("En Línea"), "</span></div>")
    return extract.extract_v1_items(extract.html_cells(pages), "course").select("type", "name", "ec_code", "duration", "modality")


# ---- L ----

_HOST = "regexp_extract(url, '^(https?://[^/?#]+)', 1)"
_LINKS = f"(select page_id, concat({_HOST}, href) as target from (select page_id, url, unnest(regexp_extract_all(html, 'href=[\"''](.*?)[\"'']', 1)) as href from pages) where href like '/%')"


@query("L1_extract_links", f"select page_id, target from {_LINKS}")
def l1(r):
    return linkgraph.extract_links(r.pages).select("page_id", "target")


@query("L2_should_follow", f"select distinct target from {_LINKS} where regexp_extract(target, '^https?://([^/?#]+)', 1) in (select regexp_extract(url, '^https?://([^/?#]+)', 1) from pages where url like '%/en/%') and target not like '%the%'")
def l2(r):
    hosts = r.pages.filter("url like '%/en/%'").select(F.regexp_extract("url", r"^https?://([^/?#]+)", 1).alias("host")).distinct()
    links = linkgraph.extract_links(r.pages).select("target").distinct()
    return linkgraph.in_scope(links, hosts, links.filter("target like '%the%'"))


@query("L3_page_title", "select page_id, trim(regexp_extract(html, '<title>(.*?)</title>', 1)) as title from pages")
def l3(r):
    return r.pages.select("page_id", linkgraph.page_title(C("html")).alias("title"))


_RULES = {"urls": (("english", ("/en/",)), ("german", ("/de/",))), "texts": (("licence", "licen"),)}
_CLASS = "case when url like '%/en/%' then 'english' when url like '%/de/%' then 'german' when contains(lower(html), 'licen') then 'licence' else 'general' end"


@query("L4_classify_page", f"select page_id, {_CLASS} as type from (select page_id, lower(url) as url, html from pages)")
def l4(r):
    return r.pages.select("page_id", linkgraph.classify(C("url"), C("html"), **_RULES).alias("type"))


@query("L5_classify_simple", "select page_id, case when contains(lower(html), 'estándar') or contains(lower(html), 'estandar') then 'ec_standard' when contains(lower(html), 'certificador') then 'certificador' when contains(lower(html), 'centro') then 'center' when contains(lower(html), 'curso') then 'course' else 'unknown' end as type from pages")
def l5(r):
    return r.pages.select("page_id", linkgraph.classify_simple(C("html")).alias("type"))


_BFS = "with recursive b(node, depth) as (select cast(0 as bigint), 0 union select l.dst, b.depth + 1 from b join links l on l.src = b.node where b.depth < 6), d as (select node, min(depth) as depth from b group by node) select d.node, d.depth, coalesce(min(p.node), -1) as parent from d left join links l on l.dst = d.node and d.depth > 0 left join d p on p.node = l.src and p.depth = d.depth - 1 group by d.node, d.depth"


@query("L6_bfs_depth", _BFS)
def l6(r):
    return linkgraph.bfs_depth(r.links, 0, 6).withColumn("parent", F.coalesce("parent", F.lit(-1)))


_MAP = f"""{_BFS.replace("b.depth < 6", "b.depth < 3").replace(" select d.node, d.depth, coalesce", ", t as (select d.node, d.depth, coalesce", 1)})
    select u.url, md5(u.url) as url_hash, md5(html) as content_hash, trim(regexp_extract(html, '<title>(.*?)</title>', 1)) as title, {_CLASS.replace("url like", "lower(u.url) like")} as type, length(html) as content_length, coalesce(t.depth, -1) as depth, coalesce(t.parent, -1) as parent, f.status
    from (select url, min(page_id) as page_id, min_by(html, page_id) as html from pages group by url) u left join t on t.node = u.page_id left join fetch_log f on f.page_id = u.page_id and f.fetch = 0"""


@query("L7_crawl_map", _MAP)
def l7(r):
    depths = linkgraph.bfs_depth(r.links, 0, 3).withColumn("parent", F.coalesce("parent", F.lit(-1)))
    status = r.fetch_log.filter("fetch = 0").select("page_id", "status")
    return linkgraph.crawl_map(r.pages, depths, status, **_RULES).select("url", "url_hash", "content_hash", "title", "type", "content_length", *[F.coalesce(c, F.lit(-1)).alias(c) for c in ("depth", "parent")], "status")


@query("L8_in_out_links", "select node, coalesce(o.n, 0) as n_out, coalesce(i.n, 0) as n_in from (select src as node, count(*) as n from links group by src) o full join (select dst as node, count(*) as n from links group by dst) i using (node)")
def l8(r):
    return linkgraph.degrees(r.links)


_TERMS = ("licen", "the ", "und ")


@query("L9_page_signals", "select page_id, contains(lower(html), '<form') as has_form, contains(lower(html), '<script') as has_script, regexp_matches(lower(html), 'ajax|xmlhttprequest|fetch\\(') as has_ajax, concat_ws(',', " + ", ".join(f"case when contains(lower(html), '{t}') then '{t}' end" for t in _TERMS) + ") as topics from pages")
def l9(r):
    return linkgraph.page_signals(r.pages, _TERMS)


@query("L10_next_page_edges", "select distinct concat('https://example.org/list/', '?p=2') as target, comite_id from ec")
def l10(r):
    found = linkgraph.next_page(extract.html_cells(_ec_pages(r)))
    return found.select(F.concat(F.lit("https://example.org/list/"), F.regexp_extract("target", r"(\?p=2)$", 1)).alias("target"), F.regexp_extract("url", r"/list/(\d+)", 1).cast("bigint").alias("comite_id")).distinct()


@query("L11_endpoint_registry", "select distinct method, path as url from request_log where path like '%/api/%'")
def l11(r):
    return linkgraph.endpoint_registry(r.request_log)
