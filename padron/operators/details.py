"""Fields of detail pages: for each field, the places where its value may stand, in order of preference.

A place says which cells hold a value. Each cell gives an entry for every place that it is at, all other cells are
dropped before the shuffle, and a page's entries are one small array. A field takes the first value that is not
empty, a list field all values of the first place that has any.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ENTRY = "array<struct<field:int,rank:int,x:int,seq:int,value:string>>"
#: Texts of label cells that places name; html_cells() notes them on the cells after a label.
MARKS = (
    "Acreditación", "Actualización", "C.P.", "Certificador", "Clave", "Comité", "Comités", "Coordinador", "Correo", "Creación", "Cédula", "Código", "Descripción", "Domicilio", "Duración", "Elementos",
    "Estado", "Estatus", "Estándares", "Modalidad", "Municipio", "Nivel", "Nombre", "Objetivo", "Publicación", "Representante", "Responsable", "Sector", "Siglas", "Sitio", "Teléfono", "Tipo", "Título", "Versión", "Vigencia", "Vigente",
)


class Place(NamedTuple):
    """Cells that pass a test, or those of a kind that follow a label in their row."""

    value: str | Column = "text"
    test: Column | None = None
    mark: str | None = None
    kind: str = "cell"
    nearest: bool = False
    joined: bool = False
    label: str | None = None


def after(mark: str) -> Place:
    """The first text that is not empty in the cells after one that holds the mark."""
    return Place(mark=mark, nearest=True)


def all_after(mark: str) -> Place:
    """The texts of all cells after one that holds the mark, joined."""
    return Place(mark=mark, joined=True)


def parts_after(mark: str, kind: str, field: str = "text") -> Place:
    """Links or list items in the cells after one that holds the mark."""
    return Place(field, mark=mark, kind=kind)


def labelled(label: str) -> Place:
    """Values whose header or term is the label, whole and in any case."""
    return Place(test=F.col("kind").isin("cell", "value") & (F.col("label") == label), label=label)


def _element(kind: str, tag: str) -> Column:
    return (F.col("kind") == kind) & (F.col("tag") == tag)


def of_class(tag: str, name: str) -> Place:
    return Place(test=_element("class", tag) & (F.col("css_class") == name))


def of_class_like(tag: str, part: str) -> Place:
    return Place(test=_element("class", tag) & F.col("css_class").contains(part))


def of_id(tag: str, name: str) -> Place:
    return Place(test=_element("id", tag) & (F.col("css_class") == name))


def of_tag(tag: str) -> Place:
    return Place(test=F.col("kind").isin("heading", "element") & (F.col("tag") == tag))


def items_in(owner: str) -> Place:
    """List items below an element, written tag.class."""
    return Place(test=(F.col("kind") == "item") & F.array_contains("under", owner))


def classed_in(owner: str, tag: str, name: str) -> Place:
    return Place(test=_element("class", tag) & (F.col("css_class") == name) & F.array_contains("under", owner))


def links_in(owner: str, part: str) -> Place:
    return Place(test=(F.col("kind") == "link") & F.col("href").contains(part) & F.array_contains("under", owner))


def link_texts(part: str) -> Place:
    return Place(test=(F.col("kind") == "link") & F.col("href").contains(part))


def from_links(pattern: str, *parts: str) -> Place:
    """What the pattern finds in the addresses of links that hold all parts."""
    test = F.col("kind") == "link"
    for p in parts:
        test = test & F.col("href").contains(p)
    return Place(F.regexp_extract("href", pattern, 1), test)


def let(value: Column, body) -> Column:
    """body(value) with the value computed once, also where body uses it within a function of array elements."""
    return F.transform(F.array(value), body)[0]


class Fields:
    """The places of a kind of page, numbered; first() and many() are columns over a page's entries."""

    def __init__(self):
        self.fields: list[tuple[Place, ...]] = []

    def _own(self, places) -> Column:
        for p in places:
            if p.mark and p.mark not in MARKS:
                raise ValueError(f"{p.mark} is none of the marks that cells note")
        self.fields.append(places)
        i = len(self.fields) - 1
        return F.filter("c", lambda e: e["field"] == i)

    def first(self, *places: Place) -> Column:
        """The first value that is not empty, place by place."""
        own = self._own(places)
        best = F.array_min(own)
        joined = [r for r, p in enumerate(places) if p.joined]
        if not joined:
            return best["value"]

        def whole(b):
            parts = F.filter(own, lambda e: (e["rank"] == b["rank"]) & (e["x"] == b["x"]))
            return F.when(b["rank"].isin(joined), F.array_join(F.transform(F.array_sort(parts), lambda e: e["value"]), " ")).otherwise(b["value"])

        return let(best, whole)

    def many(self, *places: Place) -> Column:
        """All values of the first place that has one."""
        own = self._own(places)
        kept = let(F.array_min(own)["rank"], lambda r: F.filter(own, lambda e: e["rank"] == r))
        return F.transform(F.array_sort(kept), lambda e: F.trim(e["value"]))

    def _plain(self):
        return [(i, rank, p, F.col(p.value) if isinstance(p.value, str) else p.value) for i, places in enumerate(self.fields) for rank, p in enumerate(places) if not p.mark]

    def wanted(self) -> Column:
        """Whether a cell gives entries: a test of its own columns that needs no arrays. A page's first cell
        always gives one, so that no page is lost. Labels are one test, as the JVM compiles no method of over 8000 bytes."""
        test = (F.col("seq") == 0) | (F.size("labels") > 0)
        labels = sorted({p.label for _, _, p, _ in self._plain() if p.label})
        if labels:
            test = test | F.coalesce(F.col("kind").isin("cell", "value") & F.col("label").isin(*labels), F.lit(False))
        for _, _, p, _ in self._plain():
            if not p.label:
                test = test | F.coalesce(p.test, F.lit(False))
        return test

    def entries(self) -> Column:
        """The entries of one cell, one by one concatenated, as functions of array elements are slow."""
        none = F.array().cast(ENTRY)
        parts = [F.when(F.col("seq") == 0, F.array(_entry(-1, 0, F.lit(None).cast("string")))).otherwise(none)]
        parts += [F.when(p.test & (F.trim(value) != ""), F.array(_entry(i, rank, value))).otherwise(none) for i, rank, p, value in self._plain()]
        marked: dict[str, list] = {}
        for i, places in enumerate(self.fields):
            for rank, p in enumerate(places):
                if p.mark:
                    marked.setdefault(f"{p.kind} {p.mark}", []).append(F.struct(F.lit(i).alias("field"), F.lit(rank).alias("rank"), F.lit(p.nearest).alias("nearest"), F.lit(p.value == "href").alias("href")))
        where = F.create_map(*[x for key, uses in marked.items() for x in (F.lit(key), F.array(*uses))])

        def of_label(n):
            uses = F.filter(F.element_at(where, F.concat_ws(" ", "kind", n["mark"])), lambda u: ~u["nearest"] | n["nearest"])
            return F.coalesce(F.transform(uses, lambda u: _entry(u["field"], u["rank"], F.when(u["href"], F.col("href")).otherwise(F.col("text")), n["seq"])), none)

        after_labels = F.filter(F.flatten(F.transform("labels", of_label)), lambda e: F.trim(e["value"]) != "")
        return F.concat(*parts, F.when(F.size("labels") > 0, after_labels).otherwise(none))


def _entry(field, rank, value: Column, x=0) -> Column:
    parts = [v if isinstance(v, Column) else F.lit(v) for v in (field, rank, x)]
    return F.struct(parts[0].cast("int").alias("field"), parts[1].cast("int").alias("rank"), parts[2].cast("int").alias("x"), F.col("seq").alias("seq"), value.alias("value"))


def page_fields(cells: DataFrame, places, keep: Column | None = None, *gathered: Column) -> DataFrame:
    """(page_id, url, fields of places, gathered): one row a page, in one pass over its cells. keep names
    further cells that the aggregates `gathered` want."""
    f = Fields()
    columns = places(f)
    wanted = f.wanted()
    rows = cells.filter(wanted if keep is None else wanted | keep).withColumn("e", F.when(wanted, f.entries()))
    pages = rows.groupBy("page_id", "url").agg(F.flatten(F.collect_list("e")).alias("c"), *gathered)
    return pages.select("page_id", "url", *[v.alias(k) for k, v in columns.items()], *[c for c in pages.columns if c not in ("page_id", "url", "c")])


def codes_in(values: Column) -> Column:
    """Distinct codes of standards in a list of texts, sorted."""
    found = F.flatten(F.transform(values, lambda v: F.regexp_extract_all(v, F.lit(r"(EC\d{4,})"), 1)))
    return F.array_sort(F.array_distinct(found))


# The places of each field, with the labels, classes and ids that pages use.


def ec_places(f: Fields) -> dict[str, Column]:
    return {
        "clave": f.first(labelled("código"), after("Código"), after("Clave"), of_class("span", "ec-clave")),
        "titulo": f.first(of_class("h1", "ec-title"), of_class("div", "titulo-estandar"), after("Título"), of_id("span", "titulo"), labelled("título")),
        "version": f.first(after("Versión"), of_class("span", "version"), labelled("versión")),
        "sector": f.first(after("Sector"), labelled("sector")),
        "sector_id": f.first(from_links(r"sector=(\d+)", "sector=")),
        "comite": f.first(after("Comité"), labelled("comité")),
        "comite_id": f.first(from_links(r"comite=(\d+)", "comite=")),
        "descripcion": f.first(of_class("div", "descripcion"), all_after("Descripción"), of_id("div", "descripcion"), labelled("descripción")),
        "competencias": f.many(items_in("ul.competencias"), of_class("div", "competencia-item"), parts_after("Elementos", "item")),
        "nivel": f.first(after("Nivel"), labelled("nivel")),
        "duracion": f.first(after("Duración"), labelled("duración")),
        "tipo_norma": f.first(after("Tipo"), labelled("tipo de norma")),
        "fecha_publicacion": f.first(after("Publicación"), labelled("fecha de publicación")),
        "fecha_vigencia": f.first(after("Vigencia"), labelled("fecha de vigencia")),
        "perfil_evaluador": f.first(of_class_like("div", "perfil-evaluador")),
        "criterios_evaluacion": f.many(items_in("div.criterios")),
        "vigente": f.first(labelled("vigente"), after("Vigente")),
    }


def _contact(f: Fields) -> dict[str, Column]:
    return {
        "estado": F.upper(f.first(after("Estado"), labelled("estado"))),
        "municipio": f.first(after("Municipio"), labelled("municipio")),
        "cp": f.first(after("C.P.")),
        "telefono": f.first(after("Teléfono"), labelled("teléfono")),
        "correo": f.first(after("Correo"), link_texts("mailto:"), labelled("correo")),
        "fecha_acreditacion": f.first(after("Acreditación"), labelled("fecha de acreditación")),
    }


def cert_places(f: Fields) -> dict[str, Column]:
    return _contact(f) | {
        "cedula": f.first(labelled("cédula"), after("Cédula")),
        "nombre_legal": f.first(after("Nombre"), of_class("h1", "cert-title"), of_class("div", "nombre-legal"), labelled("nombre")),
        "siglas": f.first(after("Siglas"), labelled("siglas")),
        "estatus": F.coalesce(f.first(after("Estatus"), of_class("span", "status"), labelled("estatus")), F.lit("ACTIVO")),
        "domicilio_texto": f.first(all_after("Domicilio"), of_class("div", "domicilio"), labelled("domicilio")),
        "sitio_web": f.first(parts_after("Sitio", "link", "href"), after("Sitio"), labelled("sitio web")),
        "representante_legal": f.first(after("Representante"), labelled("representante legal")),
        "listed_codes": codes_in(f.many(after("Estándares"), labelled("estándares"))),
    }


def centro_places(f: Fields) -> dict[str, Column]:
    return _contact(f) | {
        "clave": f.first(labelled("clave"), after("Clave")),
        "nombre": f.first(of_class("h1", "centro-title"), after("Nombre"), of_class("div", "nombre-centro"), labelled("nombre")),
        "cert_id": F.coalesce(f.first(from_links("id=([^&]+)", "CERT", "id=")), F.nullif(F.regexp_extract(f.first(after("Certificador"), labelled("certificador")), r"\b((?:ECE|OC)\d+)\b", 1), F.lit(""))),
        "domicilio_texto": f.first(all_after("Domicilio"), of_class("div", "domicilio"), of_tag("address"), labelled("domicilio")),
        "responsable": f.first(after("Responsable"), labelled("responsable")),
        "coordinador": f.first(after("Coordinador"), labelled("coordinador")),
        "listed_modes": f.many(parts_after("Modalidad", "item")),
        "modes_text": f.first(after("Modalidad"), labelled("modalidades")),
        "codes": codes_in(f.many(classed_in("div.estandares", "span", "ec-code"), parts_after("Estándares", "item"), items_in("ul.ec-list"), labelled("estándares"), after("Estándares"))),
    }


def sector_places(f: Fields) -> dict[str, Column]:
    """Of sectors and committees alike."""
    return {
        "nombre": f.first(of_tag("h1"), after("Nombre"), of_class("div", "entity-name"), labelled("comité"), labelled("sector")),
        "descripcion": f.first(of_class("div", "descripcion"), all_after("Descripción"), of_class("p", "description"), labelled("descripción")),
        "objetivo": f.first(after("Objetivo"), labelled("objetivo")),
        "num_comites": f.first(after("Comités"), labelled("número de comités")),
        "num_estandares": f.first(after("Estándares"), labelled("número de estándares")),
        "sector_of": F.coalesce(f.first(from_links(r"id=([^&]+)", "SECTOR", "id=")).try_cast("int"), F.regexp_extract(f.first(after("Sector")), r"\b(\d+)\b", 1).try_cast("int")),
        "fecha_creacion": f.first(after("Creación")),
        "fecha_actualizacion": f.first(after("Actualización")),
        "email": F.lower(f.first(after("Correo"), labelled("correo"))),
        "phone": f.first(after("Teléfono"), labelled("teléfono")),
        "estandares": codes_in(f.many(links_in("div.estandares", "EC"), items_in("ul.ec-list"), parts_after("Estándares", "link"))),
    }
