"""K1 to K9: entities and edges out of stored HTML pages.

One mapInArrow turns a page into a flat table of cells; everything after it is
column expressions on that table.
"""

from __future__ import annotations

import html as entities
import re
from html.parser import HTMLParser

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from padron.functions import clean
from padron.operators import details

CELLS = "page_id long, url string, kind string, block int, row int, col int, label string, text string, href string, css_class string, inside array<int>, seq int, tr int, tag string, under array<string>, lead string, labels array<struct<mark: string, seq: int, nearest: boolean>>"
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_SPACE = re.compile(r"\s+")
_NO_ATTRS: dict = {}
_MARK = re.compile("|".join(map(re.escape, details.MARKS)))
# Plain markup, which needs no parser: text, tags in lower case whose attributes are quoted and hold no references.
_TAG = re.compile(r"""([^<]*)(?:<(?:/([a-z][a-z0-9]*)|([a-z][a-z0-9]*)((?:\ [a-z][a-z-]*="[^"<>]*")*))>|\Z)""")
_ATTR = re.compile(r"""([a-z][a-z-]*)="([^"]*)\"""")
#: Elements whose content is not markup.
_RAW = {"script", "style", "title", "textarea", "xmp", "iframe", "noembed", "noframes", "noscript", "plaintext"}
#: A batch of cells ends at so many cells or characters.
_CELLS_A_BATCH, _TEXT_A_BATCH = 20_000, 8_000_000


class _Cells(HTMLParser):
    """Collects the fields of CELLS after the page's.

    inside holds the blocks of the open tables and divs with a class, under the open elements with a class as
    tag.class; labels the cells before in the same row of a table that hold a mark of details.MARKS, with their seq and whether
    no text stands between. seq counts the records in order of their beginning, tr the rows of tables; lead is a cell's own
    text, without that of elements that are recorded themselves.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out: list[list] = []
        self.open: list[tuple[str, list, int]] = []  # records whose text is wanted, with the number of their element
        self.elements = 0
        self.scopes: list[tuple[str, int | None]] = []  # open tables and divs with the blocks that they begin
        self.owners: list[tuple[str, str]] = []  # open elements with a class
        self.rows: list[tuple[int, int]] = []  # row and column of the tables around
        self.block = self.row = self.col = self.tr = self.last_tr = self.seq = -1
        self.label = None

    def _record(self, kind, label=None, text="", href=None, css=None, tag=None):
        self.seq += 1
        return [kind, self.block, self.row, self.col, label, text, href, css, [b for _, b in self.scopes if b is not None], self.seq, self.tr, tag, [o for _, o in self.owners], ""]

    def _begin(self, tag, kind, href=None, css=None):
        self.open.append((tag, self._record(kind, self.label, "", href, css, tag), self.elements))

    def handle_starttag(self, tag, attrs):
        a = dict(attrs) if attrs else _NO_ATTRS
        name = a.get("class")
        self.elements += 1
        if tag == "table":
            self.block, self.row = self.block + 1, -1
            self.scopes.append((tag, self.block))
            self.rows.append((self.tr, self.col))
            self.out.append(self._record("table", css=name, tag=tag))
        elif tag == "tr":
            self.row, self.col, self.label = self.row + 1, -1, None
            self.last_tr += 1
            self.tr = self.last_tr
        elif tag in ("td", "th"):
            self.col += 1
            self._begin(tag, "header" if tag == "th" else "cell", css=name)
        elif tag in ("dt", "dd"):
            self._begin(tag, "term" if tag == "dt" else "value", css=name)
        elif tag == "a" and "href" in a:
            self._begin(tag, "link", a["href"], name)
        elif tag in ("h1", "h2", "h3", "title"):
            self._begin(tag, "title" if tag == "title" else "heading", css=tag)
        elif tag == "script":
            self._begin(tag, "script")
        elif tag == "li":
            self._begin(tag, "item", css=name)
        elif tag == "address":
            self._begin(tag, "element", css=name)
        if name and tag in ("div", "span", "p", "li", "h1", "h2", "h3"):
            if tag == "div":
                self.block += 1
                self.scopes.append((tag, self.block))
            self._begin(tag, "class", css=name)
        elif tag == "div":
            self.scopes.append((tag, None))
        if a and a.get("id") and tag in ("div", "span", "p"):
            self._begin(tag, "id", css=a["id"])
        if name and tag not in _VOID:
            self.owners.append((tag, f"{tag}.{name}"))
        elif self.owners and tag not in _VOID and any(t == tag for t, _ in self.owners):
            self.owners.append((tag, ""))  # so that its end does not close the one around
        for attr, value in attrs or ():
            if attr.startswith("data-") and attr.endswith("id") and value:
                self.out.append(self._record("data", attr, value))

    def handle_data(self, data):
        script = self.open and self.open[-1][0] == "script"
        for _, rec, _ in self.open[-1:] if script else self.open:
            rec[5] += data
        # of an element's records the first is the cell
        for _, rec, number in self.open[-3:]:
            if number == self.open[-1][2]:
                rec[13] += data

    def _close(self, rec):
        own, rec[13] = rec[13], ""
        if rec[0] != "script":
            text = rec[5]
            rec[5] = _SPACE.sub(" ", text).strip()
            if rec[0] == "cell" or rec[0] == "header":
                rec[13] = rec[5] if own == text else _SPACE.sub(" ", own).strip()
        self.out.append(rec)

    def handle_endtag(self, tag):
        if tag in _VOID:
            return
        if self.owners and any(t == tag for t, _ in self.owners):
            while self.owners.pop()[0] != tag:
                pass
        if tag in ("div", "table") and any(t == tag for t, _ in self.scopes):
            while self.scopes.pop()[0] != tag:
                pass
        if tag == "tr":
            self.tr = self.rows[-1][0] if self.rows else -1
        elif tag == "table":
            self.row = self.col = -1
            self.tr, col = self.rows.pop() if self.rows else (-1, -1)
            if self.tr >= 0:
                self.col = col
        if not self.open or self.open[-1][0] != tag and not any(t == tag for t, _, _ in self.open):
            return
        closed = None
        # an element may be recorded several times: as what it is, by its class and by its id
        while self.open and (closed is None or self.open[-1][2] == closed):
            t, rec, number = self.open.pop()
            self._close(rec)
            if rec[0] in ("header", "term"):
                self.label = rec[5].rstrip(":").lower()
            if t == tag:
                closed = number


def _plain(html: str) -> list[tuple] | None:
    """The tokens (text, end tag, start tag, attributes) of plain markup; None where it takes a parser."""
    tokens, at, raw = [], 0, None
    for m in _TAG.finditer(html):
        if m.start() != at:
            return None
        at = m.end()
        text, end, start, attrs = m.groups()
        if raw and end != raw or start == "plaintext":
            return None
        if text and "&" in text and raw not in ("script", "style"):
            if raw and raw != "title":
                return None
            text = entities.unescape(text)
        if attrs and "&" in attrs and entities.unescape(attrs) != attrs:
            return None
        tokens.append((text, end, start, attrs))
        raw = start if start and start in _RAW else None
        if at == len(html) and not end and not start:
            break
    return tokens if at == len(html) and raw is None else None


def _feed(p: _Cells, html: str) -> None:
    tokens = _plain(html)
    if tokens is None:
        p.feed(html)
        p.close()
        return
    for text, end, start, attrs in tokens:
        if text:
            p.handle_data(text)
        if start:
            p.handle_starttag(start, _ATTR.findall(attrs) if attrs else [])
        elif end:
            p.handle_endtag(end)


def _labels(out: list[list]) -> None:
    """Adds to each record the labels before it in its row."""
    marked: dict[int, list] = {}
    for r in out:
        if r[0] in ("cell", "header") and r[10] >= 0 and r[13] and _MARK.search(r[13]):
            marked.setdefault(r[10], []).append((r[9], r[3], [m for m in details.MARKS if m in r[13]]))
    if not marked:
        for r in out:
            r.append([])
        return
    first: dict[tuple[int, int], int] = {}
    for r in out:
        if r[0] == "cell" and r[5] and r[10] in marked:
            for seq, col, _ in marked[r[10]]:
                if col < r[3]:
                    first[r[10], seq] = min(first.get((r[10], seq), r[9]), r[9])
    for r in out:
        near = marked.get(r[10], ()) if r[0] in ("cell", "link", "item") else ()
        r.append([{"mark": m, "seq": seq, "nearest": first.get((r[10], seq)) == r[9]} for seq, col, marks in near if col < r[3] for m in marks])


def cells_of(html: str | None) -> list[tuple]:
    p = _Cells()
    _feed(p, html or "")
    for _, rec, _ in reversed(p.open):
        p._close(rec)
    _labels(p.out)
    return [tuple(r) for r in p.out]


def html_cells(pages: DataFrame) -> DataFrame:
    """The cells of pages(page_id, url, html): table cells with the header or term before them as
    label, links, headings, titles, scripts, tables, ids in data attributes and elements with a class.

    Pages are dealt to all tasks before they are parsed, as a small file may hold many; a worker holds a batch of cells."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    spark = pages.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    shape = StructType.fromDDL(CELLS)

    def run(batches):
        schema = to_arrow_schema(shape)

        def table(rows):
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows) if rows else [[]] * len(schema), schema.types)], schema=schema)

        rows, held = [], 0
        for batch in batches:
            for i, u, h in zip(*batch.columns):
                i, u = i.as_py(), u.as_py()
                for c in cells_of(h.as_py()):
                    rows.append((i, u, *c))
                    held += len(c[5])
                    if len(rows) >= _CELLS_A_BATCH or held >= _TEXT_A_BATCH:
                        yield table(rows)
                        rows, held = [], 0
        yield table(rows)

    dealt = pages.select(F.col("page_id").cast("long"), "url", "html").repartition(tasks, "page_id", "url")
    return dealt.mapInArrow(run, CELLS)


# Per component the columns of its listing table, the class of its card and the class (or tag) of each part of a card.
LISTINGS = {
    "cert": (("nombre_legal", "siglas", "estado", "estatus"), "certificador-card", {"nombre_legal": "cert-name", "siglas": "cert-siglas", "estado": "cert-estado", "estatus": "cert-status"}),
    "centro": (("nombre", "cert_nombre", "estado", "municipio"), "centro-card", {"nombre": "centro-name", "cert_nombre": "cert-name", "estado": "estado", "municipio": "municipio"}),
    "sector": (("nombre", "num_comites", "num_estandares"), "sector-card", {"nombre": "h3"}),
    "comite": (("nombre", "sector_nombre", "num_estandares"), "comite-item", {"nombre": "comite-item"}),
}
# Parts of the address that tell what a listing holds.
EC_LISTINGS = (("ESLACT", "active"), ("ESLINACT", "inactive"), ("ESLHIST", "historical"), ("ECNew", "new"))
CERT_LISTINGS = (("comp=ECE", "ECE"), ("comp=OC", "OC"))


def told_by_url(url: Column, marks, default: str) -> Column:
    """The name of the first mark that the address holds."""
    return F.coalesce(*[F.when(url.contains(mark), name) for mark, name in marks], F.lit(default))


def listed(cells: DataFrame, component: str) -> DataFrame:
    """Entries of listing pages: (page_id, url, form, id, fields of LISTINGS).

    Of each page the first form that has entries counts: rows of tables of class `table`
    but their first, cards, and (centres) links to a centre. The id is the id=... of a link
    in the entry, else (cards: before it) a data attribute of the entry. Entries without an
    id stay for certifiers and centres and go for sectors and committees.
    """
    columns, card, parts = LISTINGS[component]
    css = F.coalesce("css_class", F.lit(""))
    classes = F.split(css, " ")
    cell, link, data = F.col("kind") == "cell", F.col("kind") == "link", F.col("kind") == "data"
    linked = F.nullif(F.regexp_extract(F.coalesce("href", F.lit("")), "id=([^&]+)", 1), F.lit(""))

    def part(c):
        return F.array_contains(classes, c) if c != "h3" else (F.col("kind") == "heading") & (css == c)

    def unit(rank, a, b):
        return F.struct(F.lit(rank).alias("rank"), a.alias("a"), b.alias("b"))

    # one pass: units of rank 0 are rows of a block, and at -1 its table, of rank 1 blocks around a cell, of rank 2 links to a centre
    none = F.array().cast("array<struct<rank:int,a:int,b:int>>")
    titled = (F.col("kind") == "table") & F.array_contains(classes, "table")
    units = [
        F.when(F.col("row") > 0, F.array(unit(0, F.col("block"), F.col("row")))).when(titled, F.array(unit(0, F.col("block"), F.lit(-1)))).otherwise(none),
        F.when(F.col("kind").isin("class", "heading", "link", "data"), F.transform("inside", lambda o: unit(1, o, F.lit(0)))).otherwise(none),
    ]
    if component == "centro":
        units.append(F.when(link & F.col("href").like("%CENTRO%") & linked.isNotNull(), F.array(unit(2, F.col("seq"), F.lit(0)))).otherwise(none))
    rank, text = F.col("rank"), F.col("text")

    def value(i, c):
        of_card = F.when(part(parts[c]), text) if c in parts else F.lit(None).cast("string")
        of_link = text if c == "nombre" else F.lit(None).cast("string")
        return F.max(F.when(rank == 0, F.when(cell & (F.col("col") == i), text)).when(rank == 1, of_card).otherwise(of_link)).alias(c)

    met = cells.repartition("page_id").withColumn("unit", F.explode(F.concat(*units))).select("*", "unit.*")
    met = met.groupBy("page_id", "url", "rank", "a", "b").agg(
        F.count_if(cell).alias("cells"), F.min(F.when(link, linked)).alias("link"), F.min(F.when(data, text)).alias("data"),
        F.max((F.col("kind") == "class") & (F.col("block") == F.col("a")) & F.array_contains(classes, card)).alias("card"),
        *[value(i, c) for i, c in enumerate(columns)])
    of_table = F.max(F.col("b") == -1).over(W.partitionBy("page_id", "rank", "a"))
    forms = met.withColumn("table", of_table).filter(F.when(rank == 0, F.col("table") & (F.col("b") > 0) & (F.col("cells") > 0)).when(rank == 1, F.col("card")).otherwise(True))
    forms = forms.withColumn("id", F.when(rank == 1, F.coalesce("data", "link")).otherwise(F.coalesce("link", "data")))
    best = forms.withColumn("best", F.min("rank").over(W.partitionBy("page_id"))).filter("rank = best")
    form = F.element_at(F.array(*[F.lit(f) for f in ("table", "card", "link")]), F.col("rank") + 1)
    texts = [(clean.first_number(F.col(c)) if c.startswith("num_") else F.nullif(F.trim(c), F.lit(""))).alias(c) for c in columns]
    out = best.select("page_id", "url", form.alias("form"), "id", *texts)
    if component in ("sector", "comite"):
        out = out.withColumn("id", F.col("id").try_cast("int")).filter("id is not null")
    return out


def list_cert(cells: DataFrame) -> DataFrame:
    """Listed certifiers, with their kind from the address."""
    return listed(cells, "cert").withColumnRenamed("id", "cert_id").withColumn("tipo", told_by_url(F.col("url"), CERT_LISTINGS, "UNKNOWN"))


def list_centro(cells: DataFrame) -> DataFrame:
    """Listed centres; those of one certifier's list carry its id, from the address."""
    owner = F.when(F.col("url").contains("CERT_CENTROS"), F.nullif(F.regexp_extract("url", "id=([^&]+)", 1), F.lit("")))
    return listed(cells, "centro").withColumnRenamed("id", "centro_id").withColumn("cert_id", owner)


def list_sector(cells: DataFrame) -> DataFrame:
    return listed(cells, "sector").withColumnRenamed("id", "sector_id")


def list_comite(cells: DataFrame) -> DataFrame:
    """Listed committees; those of one sector's list carry its id, from the address."""
    owner = F.when(F.col("url").contains("SECTOR_COMITES"), F.regexp_extract("url", "id=([0-9]+)", 1).try_cast("int"))
    return listed(cells, "comite").withColumnRenamed("id", "comite_id").withColumn("sector_id", owner)


def first_non_empty(*cols: Column) -> Column:
    return F.coalesce(*[F.nullif(F.trim(c), F.lit("")) for c in cols])


def listing_rows(cells: DataFrame, columns: list[str]) -> DataFrame:
    """One row of each table row without a label: the texts of its cells under the given names, and its first link."""
    data = cells.filter("kind = 'cell' and label is null")
    rows = data.groupBy("page_id", "url", "block", "row").agg(*[F.max(F.when(F.col("col") == i, F.col("text"))).alias(c) for i, c in enumerate(columns)])
    links = cells.filter("kind = 'link' and row >= 0").groupBy("page_id", "block", "row").agg(F.min("href").alias("href"))
    return rows.join(links, ["page_id", "block", "row"], "left").drop("block", "row")


def merge_listing_detail(listing: DataFrame, detail: DataFrame, key: str) -> DataFrame:
    """Listing values before detail values, by key."""
    a, b = listing.alias("l"), detail.alias("d")
    cols = [c for c in dict.fromkeys([*listing.columns, *detail.columns]) if c != key]
    pick = [F.coalesce(*[F.col(f"{n}.{c}") for n, df in (("l", listing), ("d", detail)) if c in df.columns]).alias(c) for c in cols]
    return a.join(b, key, "full").select(key, *pick)


def extract_ec(cells: DataFrame) -> DataFrame:
    """Standards from listings (code, title, kind of listing) and detail pages.

    A listing has rows of a table, or spans of classes `ec-code` and `ec-title` in one element. Listings whose address
    tells their kind decide whether a standard is in force; a standard of several listings takes the first of
    EC_LISTINGS. A detail page names its standard, or its address does and it has a title.
    """
    kind = told_by_url(F.col("url"), EC_LISTINGS, "unknown")
    order = F.array_position(F.array(*[F.lit(name) for _, name in EC_LISTINGS], F.lit("unknown")), kind)
    f = details.Fields()
    places = details.ec_places(f)
    # one pass: a page's fields are unit 0, a row of a listing's table is unit 1, the spans of one element unit 2
    owner = F.get("inside", F.size("inside") - 1)
    in_row = (F.col("kind") == "cell") & F.col("label").isNull() & F.col("col").isin(0, 1)
    in_box = (F.col("kind") == "class") & F.col("css_class").isin("ec-code", "ec-title") & (F.col("tag") == "span") & owner.isNotNull()
    code = F.col("css_class") == "ec-code"
    none, detailed = F.array().cast(details.ENTRY), f.wanted()
    units = F.array(
        F.struct(F.lit(0).alias("unit"), F.lit(0).alias("a"), F.lit(0).alias("b"), F.when(detailed, f.entries()).otherwise(none).alias("c")),
        F.struct(F.lit(1).alias("unit"), F.col("block").alias("a"), F.col("row").alias("b"), F.when(in_row, F.array(details._entry(F.col("col"), 0, F.col("text")))).otherwise(none).alias("c")),
        F.struct(F.lit(2).alias("unit"), F.coalesce(owner, F.lit(-1)).alias("a"), F.lit(0).alias("b"), F.when(in_box, F.array(details._entry(F.when(code, 0).otherwise(1), 0, F.when(code, F.trim("text")).otherwise(F.col("text"))))).otherwise(none).alias("c")),
    )
    # the units are a column of their own first, as Spark compiles a projection and interprets a generator's argument
    met = cells.filter(detailed | in_row | in_box).select("page_id", "url", units.alias("units")).select("page_id", "url", F.inline("units")).filter(F.size("c") > 0)
    met = met.groupBy("page_id", "url", "unit", "a", "b").agg(F.flatten(F.collect_list("c")).alias("c"))

    def of_field(i):
        return F.transform(F.filter("c", lambda e: e["field"] == i), lambda e: e["value"])

    part = [of_field(0), of_field(1)]
    fields = ["url", *[k for k in places if k != "clave"]]
    listed_row = F.struct(order.alias("o"), F.array_max(part[1]).alias("titulo"), kind.alias("listing_type"))
    detail_row = F.struct(*[(F.col("url") if k == "url" else places[k]).alias(k) for k in fields])
    of_row = F.when((F.col("unit") == 1) | ((F.size(part[0]) == 1) & (F.size(part[1]) > 0)), F.array_max(part[0]))
    own = F.coalesce(places["clave"], F.when(places["titulo"].isNotNull(), F.nullif(F.regexp_extract("url", r"(EC\d{4,})", 1), F.lit(""))))
    facts = met.select(
        F.when(F.col("unit") == 0, own).otherwise(F.when(of_row.rlike(r"^EC\d{4,}$"), of_row)).alias("ec_clave"),
        F.when(F.col("unit") > 0, listed_row).alias("l"), F.when(F.col("unit") == 0, detail_row).alias("d"), F.when(F.col("unit") == 0, F.col("url")).alias("at"),
    ).filter("ec_clave is not null")
    # of several pages of a standard the first by address; what a listing says comes before
    one = facts.groupBy("ec_clave").agg(F.min("l").alias("l"), F.min_by("d", "at").alias("d"))
    out = one.select("ec_clave", F.coalesce("l.titulo", "d.titulo").alias("titulo"), "l.listing_type", *[f"d.{c}" for c in fields if c != "titulo"])
    told = F.coalesce("listing_type", F.lit("unknown"))
    return out.withColumns({
        "duracion_horas": clean.first_number(F.col("duracion")), "fecha_publicacion": clean.parse_date_iso(F.col("fecha_publicacion")), "fecha_vigencia": clean.parse_date_iso(F.col("fecha_vigencia")),
        "vigente": F.when(told == "unknown", F.lower("vigente").isin("sí", "si", "true")).otherwise(told == "active"), "version": clean.version_number(F.col("version")),
        "sector_id": F.col("sector_id").try_cast("int"), "comite_id": F.col("comite_id").try_cast("int"),
    }).drop("duracion")


def modal_json() -> list[Column]:
    """Aggregates over a page's cells: codes and contacts out of `modalData = {...};` scripts, those of `standards` that have the
    form of one, and `contacts`. Of several scripts the last one that has them counts."""
    text = F.when(F.col("kind") == "script", F.regexp_extract("text", r"(?s)modalData\s*=\s*(\{.*?\});", 1))
    m = F.from_json(text, "standards array<struct<code:string>>, contacts array<map<string,string>>")
    codes = F.filter(F.transform(m["standards"], lambda s: s["code"]), lambda c: c.rlike(r"^EC\d{4,}$"))
    return [F.max_by(v, F.when(v.isNotNull(), F.col("seq"))).alias(n) for n, v in (("modal_codes", codes), ("contactos", m["contacts"]))]


def _in_modal() -> Column:
    return (F.col("kind") == "class") & F.col("css_class").isin("ec-code", "modal-estandares")


def modal_html() -> Column:
    """Aggregate over a page's cells: what html_codes() reads."""
    code = F.when((F.col("css_class") == "ec-code") & F.trim("text").rlike(r"^EC\d{4,}$"), F.trim("text"))
    box = F.when((F.col("css_class") == "modal-estandares") & F.array_contains("inside", F.col("block")), F.col("block"))
    return F.collect_list(F.when(_in_modal(), F.struct(code.alias("code"), box.alias("box"), "inside"))).alias("modal")


def html_codes() -> Column:
    """Codes in spans of class `ec-code` inside a `modal-estandares`."""
    boxes = F.array_compact(F.transform("modal", lambda m: m["box"]))
    inside = details.let(boxes, lambda b: F.filter("modal", lambda m: m["code"].isNotNull() & F.arrays_overlap(m["inside"], b)))
    return F.array_distinct(F.transform(inside, lambda m: m["code"]))


def _dates(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: clean.parse_date_iso(F.col(n)) for n in names})


def extract_cert(cells: DataFrame) -> DataFrame:
    """Certifiers from detail pages, with the codes and contacts of the modal script, or the codes of the modal's
    HTML where the script has none; the state's code is computed last. A page names its certifier, or its address
    does and it has a name."""
    from padron.operators.joins import state_code

    detail = details.page_fields(cells, details.cert_places, (F.col("kind") == "script") | _in_modal(), *modal_json(), modal_html())
    by_url = F.when(F.col("nombre_legal").isNotNull(), F.nullif(F.regexp_extract("url", r"\b((?:ECE|OC)\d+)\b", 1), F.lit("")))
    detail = detail.withColumn("cert_id", F.coalesce("cedula", by_url)).filter("cert_id is not null").drop("cedula")
    none = F.array().cast("array<string>")
    in_modal = F.when(F.size(F.coalesce("modal_codes", none)) > 0, F.col("modal_codes")).otherwise(html_codes())
    out = detail.withColumns({
        "codes": F.array_sort(F.array_distinct(F.concat("listed_codes", in_modal))),
        "tipo": F.regexp_extract("cert_id", r"^(ECE|OC)", 1), "telefono": clean.normalize_phone_v2(F.col("telefono")), "correo": clean.email_norm(F.col("correo")),
        "sitio_web": clean.website_scheme(F.col("sitio_web")), "cp": clean.postal_code(F.col("cp"), F.col("domicilio_texto")),
    })
    return state_code(_dates(out, "fecha_acreditacion").drop("listed_codes", "modal_codes", "modal", "page_id"), "estado")


def extract_centro(cells: DataFrame) -> DataFrame:
    """Centres from detail pages; those of listings come from list_centro. A page names its centre, or its address does
    (id=...) and it has a name."""
    from padron.operators.joins import state_code

    detail = details.page_fields(cells, details.centro_places).drop("page_id")
    by_url = F.when(F.col("nombre").isNotNull(), clean.id_from_url(F.col("url")))
    detail = detail.withColumn("centro_id", F.coalesce("clave", by_url)).filter("centro_id is not null").drop("clave")
    modes = F.when(F.size("listed_modes") > 0, F.col("listed_modes")).otherwise(clean.split_modalities(F.col("modes_text")))
    out = detail.withColumns({"modalidades": modes, "telefono": clean.normalize_phone_v2(F.col("telefono")), "correo": clean.email_norm(F.col("correo")), "cp": clean.postal_code(F.col("cp"), F.col("domicilio_texto"))})
    return state_code(_dates(out, "fecha_acreditacion").drop("listed_modes", "modes_text"), "estado")


def extract_sector_comite(cells: DataFrame) -> DataFrame:
    """Sectors and committees: own ids from the address, all else from the detail page. A committee's sector is that of
    its address, or of a link, or the number in its sector's cell."""
    d = details.page_fields(cells, details.sector_places).drop("page_id")
    in_url = {k: clean.id_from_url(F.col("url"), k).try_cast("int") for k in ("sector", "comite")}
    out = d.select(
        F.coalesce(in_url["sector"], F.when(in_url["comite"].isNotNull(), F.col("sector_of"))).alias("sector_id"), in_url["comite"].alias("comite_id"), "nombre", "descripcion", "objetivo",
        clean.first_number(F.col("num_comites")).alias("num_comites"), clean.first_number(F.col("num_estandares")).alias("num_estandares"),
        "fecha_creacion", "fecha_actualizacion", clean.contact_struct(F.col("email"), F.col("phone")).alias("contacto"), "estandares", F.col("url").alias("src_url"),
    )
    return _dates(out, "fecha_creacion", "fecha_actualizacion").filter("sector_id is not null or comite_id is not null")


def edges_from_lists(df: DataFrame, id: str, codes: str, run_id: str, since: str | None = None) -> DataFrame:
    """One edge for each distinct code of a list: (id, ec_clave, acreditado_desde where since names its column, run_id).

    Lists of an id are put together before they are unfolded, so no task keeps a table of all its edges to tell repeats."""
    dated = [F.col(since).alias("acreditado_desde")] if since else []
    lists = df.select(id, *dated, F.col(codes).alias("_codes")).groupBy(id, *["acreditado_desde"] * bool(since)).agg(F.flatten(F.collect_list("_codes")).alias("_codes"))
    return lists.select(id, *["acreditado_desde"] * bool(since), F.explode(F.array_distinct("_codes")).alias("ec_clave"), F.lit(run_id).alias("run_id"))


def sector_edges(comites: DataFrame) -> DataFrame:
    """(ec_clave, sector_id, comite_id) of the standards of committees whose sector is known."""
    known = comites.filter("comite_id is not null and sector_id is not null")
    return known.select(F.explode("estandares").alias("ec_clave"), "sector_id", "comite_id").distinct()


# Classes of the element that holds a listed item, by component (whole, or part of a class).
V1_CONTAINERS = {
    "ec_standard": ("estandar-item", "ec-item"),
    "certificador": ("oec-item", "certificador"),
    "center": ("ce-item", "centro-evaluacion"),
    "course": ("curso-item", "course"),
}
# Field, its classes, and the texts that tell it where no class does.
V1_PARTS = {
    "ec_standard": {"code": (("ec-code",), ("EC",)), "title": (("ec-title", "titulo-estandar"), ()), "sector": (("sector", "sector-productivo"), ()), "level": (("nivel",), ("Nivel",)), "publication_date": (("fecha", "fecha-publicacion"), ("Publicación",))},
    "certificador": {"name": (("oec-name", "nombre"), ()), "code": (("oec-code",), ("OC",)), "phone": (("telefono",), ("Tel",)), "address": (("direccion", "address"), ())},
    "center": {"name": (("ce-name", "nombre"), ()), "code": (("ce-code",), ("CE",)), "certificador": (("oec-parent",), ("OC",)), "phone": (("telefono",), ("Tel",)), "address": (("direccion", "address"), ())},
    "course": {"name": (("curso-name", "titulo"), ()), "ec_code": ((), ("EC",)), "duration": (("duracion",), ("horas",)), "modality": (("modalidad",), ("Presencial", "Línea"))},
}
#: Fields of which one must be filled.
V1_KEYS = ("code", "name", "ec_code")


def extract_v1_items(cells: DataFrame, component: str) -> DataFrame:
    """Items of the older shape: the parts inside each container, by class, else by a text that they hold, and mail links.

    What stands outside of any container of the component is left out. Parts without
    a class of this component are looked at in spans with a class only.
    """
    css = F.col("css_class")
    holds = F.lit(False)
    for c in V1_CONTAINERS[component]:
        holds = holds | css.contains(c)
    box = (F.col("kind") == "class") & holds
    # one pass: each block's parts are aggregates, which the blocks of a container then put together
    kind = (F.col("kind") == "class") & ~box
    plain = kind
    for classes, _ in V1_PARTS[component].values():
        for c in classes:
            plain = plain & ~F.array_contains(F.split(css, " "), c)
    found = {}
    for f, (classes, marks) in V1_PARTS[component].items():
        marked = F.lit(False)
        for m in marks:
            marked = marked | F.col("text").contains(m)
        by_class = F.when(kind & F.arrays_overlap(F.split(css, " "), F.array(*[F.lit(c) for c in classes])), F.col("text")) if classes else F.lit(None).cast("string")
        found |= {f"{f} by class": by_class, f"{f} by text": F.when(plain & marked, F.col("text"))}
    found["email"] = F.when((F.col("kind") == "link") & F.col("href").startswith("mailto:"), F.regexp_extract("href", "^mailto:([^?]*)", 1))
    # a div with a class starts a block: the blocks of a page are known by whether they begin a container
    blocks = cells.filter("block >= 0").groupBy("page_id", "block").agg(F.max(box).alias("begins"), F.min(F.when(F.col("kind") == "class", css)).alias("classes"), *[F.max(v).alias(n) for n, v in found.items()])
    inner = F.lit(False)
    for classes, _ in V1_PARTS[component].values():
        for c in classes:
            inner = inner | F.array_contains(F.split("classes", " "), c)
    order = W.partitionBy("page_id").orderBy("block")
    # a block that is neither a container nor a part ends the one before
    state = F.when(F.col("begins"), F.col("block")).when(inner, F.lit(None)).otherwise(F.lit(-1))
    own = blocks.withColumn("item", F.last(state, ignorenulls=True).over(order)).filter("item >= 0")
    fields = [F.coalesce(F.max(f"{f} by class"), F.max(f"{f} by text")).alias(f) for f in V1_PARTS[component]]
    out = own.groupBy("page_id", "item").agg(*fields, F.max("email").alias("email"))
    key = [k for k in V1_KEYS if k in out.columns]
    return out.filter(F.coalesce(*[F.nullif(F.trim(k), F.lit("")) for k in key]).isNotNull()).withColumn("type", F.lit(component)).drop("item")


EXTRACTORS = {
    "ec": extract_ec, "cert": extract_cert, "centro": extract_centro, "sector": extract_sector_comite,
    "cert_list": list_cert, "centro_list": list_centro, "sector_list": list_sector, "comite_list": list_comite,
}


def register_extractor(kind: str, extract) -> None:
    """Add or replace an extractor: extract(cells) gives a table. See page_extractor() for one in Python."""
    EXTRACTORS[kind] = extract


def run_extractor(kind: str, cells: DataFrame) -> DataFrame:
    """The table of the extractor that is registered under a kind."""
    if kind not in EXTRACTORS:
        raise ValueError(f"no extractor is registered for {kind}; there are {', '.join(sorted(EXTRACTORS))}")
    return EXTRACTORS[kind](cells)


def page_extractor(schema: str, of_page):
    """An extractor out of of_page(rows), which gets the cells of one page in order and yields tuples of schema.

    It runs as a table function over the cells, partitioned by page, so pages are dealt to all tasks.
    """
    from pyspark.sql.functions import udtf
    from pyspark.sql.types import StructType

    shape = StructType.fromDDL(schema)

    class Pages:
        def __init__(self):
            self.rows = []

        @staticmethod
        def analyze(cells):
            from pyspark.sql.udtf import AnalyzeResult, OrderingColumn, PartitioningColumn

            return AnalyzeResult(shape, partitionBy=[PartitioningColumn("page_id")], orderBy=[OrderingColumn("seq")])

        def eval(self, cells):
            self.rows.append(cells)

        def terminate(self):
            if self.rows:
                yield from of_page(self.rows)

    function = udtf(Pages)
    return lambda cells: function(cells.asTable())
