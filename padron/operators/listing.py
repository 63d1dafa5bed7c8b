"""C: filters, searches, projections and paging."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_ACCENTS = ("áéíóúüñÁÉÍÓÚÜÑ", "aeiouunAEIOUUN")


def fold_accents(c: Column) -> Column:
    return F.translate(c, *_ACCENTS)


def literal_pattern(term: str) -> str:
    """term as a LIKE pattern that matches only itself."""
    for ch in ("\\", "%", "_"):
        term = term.replace(ch, "\\" + ch)
    return term


def multi_field_search(df: DataFrame, term: str | None, fields: list[str], literal: bool = True) -> DataFrame:
    """Rows in which any field contains term, whatever its case; no term, no filter."""
    if not term:
        return df
    pattern = f"%{literal_pattern(term) if literal else term}%"
    return df.filter(reduce(or_, [F.col(f).ilike(pattern) for f in fields]))


def equal_to(df: DataFrame, **wanted) -> DataFrame:
    """Equality filters; None is no filter and a list means any of its values."""
    for name, value in wanted.items():
        if isinstance(value, (list, tuple, set)):
            df = df.filter(F.col(name).isin(list(value)))
        elif value is not None:
            df = df.filter(F.col(name) == value)
    return df


def page(df: DataFrame, keys: list[str], skip: int, limit: int) -> DataFrame:
    return df.orderBy(*keys).offset(skip).limit(limit)


EC_LIST = ["ec_clave", "titulo", "version", "vigente", "sector", "sector_id", "nivel", "duracion_horas", "last_seen"]


def list_ec(df, vigente=None, sector_id=None, search=None, skip=0, limit=100):
    df = multi_field_search(equal_to(df, vigente=vigente, sector_id=sector_id), search, ["ec_clave", "titulo"])
    return page(df.select(*[c for c in EC_LIST if c in df.columns]), ["ec_clave"], skip, limit)


def list_cert(df, tipo=None, estado_inegi=None, estatus=None, search=None, skip=0, limit=100):
    df = equal_to(df, tipo=tipo.upper() if tipo else None, estado_inegi=estado_inegi, estatus=estatus)
    df = multi_field_search(df, search, ["cert_id", "nombre_legal", "siglas"])
    return page(df.select("cert_id", "tipo", "nombre_legal", "siglas", "estatus", "estado", "estado_inegi"), ["cert_id"], skip, limit)


def list_centros(df, estado_inegi=None, municipio=None, search=None, skip=0, limit=100):
    df = multi_field_search(multi_field_search(equal_to(df, estado_inegi=estado_inegi), municipio, ["municipio"]), search, ["centro_id", "nombre"])
    return page(df.select("centro_id", "nombre", "municipio", "estado", "estado_inegi", "certificador_id"), ["centro_id"], skip, limit)


def list_sectores(sectores, ec, search=None, skip=0, limit=100):
    from padron.operators.joins import count_children

    return page(count_children(multi_field_search(sectores, search, ["nombre"]), ec, "sector_id", "num_estandares"), ["sector_id"], skip, limit)


def list_comites(comites, sectores, ec, sector_id=None, search=None, skip=0, limit=100):
    from padron.operators.joins import count_children, lookup_name

    df = multi_field_search(equal_to(comites, sector_id=sector_id), search, ["nombre"])
    df = lookup_name(df, sectores, "sector_id", "nombre", "sector_nombre")
    return page(count_children(df, ec, "comite_id", "num_estandares"), ["comite_id"], skip, limit)


def suggest(df, q: str, key: str, name: str, limit: int = 5, cut: int = 50, siglas: str | None = None):
    """Autocomplete rows (value, label): key starts with q or name contains it."""
    text = F.when(F.length(name) > cut, F.concat(F.substring(name, 1, cut), F.lit("..."))).otherwise(F.col(name))
    label = F.concat(F.col(key), F.lit(" - "), text)
    if siglas:
        label = F.concat(label, F.when(F.col(siglas).isNotNull() & (F.col(siglas) != ""), F.concat(F.lit(" ("), F.col(siglas), F.lit(")"))).otherwise(F.lit("")))
    p = literal_pattern(q)
    found = df.filter(F.col(key).ilike(f"{p}%") | F.col(name).ilike(f"%{p}%"))
    return found.select(F.col(key).alias("value"), label.alias("label")).orderBy("value").limit(limit)


def paginate(df: DataFrame, keys: list[str], number: int, per_page: int) -> DataFrame:
    """One page, each row with the total of rows and of pages."""
    totals = df.agg(F.count("*").alias("total")).withColumn("pages", F.ceil(F.col("total") / per_page).cast("long"))
    rows = page(df, keys, (number - 1) * per_page, per_page)
    return rows.crossJoin(F.broadcast(totals))  # totals is one row


def date_range_filter(df: DataFrame, column: str, start=None, end=None) -> DataFrame:
    """Rows within start..end, both included; an end before the start is an error."""
    if start is not None and end is not None and str(end) < str(start):
        raise ValueError("the end lies before the start")
    if start is not None:
        df = df.filter(F.col(column) >= F.lit(start))
    return df if end is None else df.filter(F.col(column) <= F.lit(end))


#: Filters that an export may set for each entity.
EXPORT_FILTERS = {"ec": ("vigente", "sector_id"), "cert": ("tipo", "estado_inegi", "estatus")}


def apply_filters(df: DataFrame, entity: str, filters: dict) -> DataFrame:
    return equal_to(df, **{k: v for k, v in filters.items() if k in EXPORT_FILTERS.get(entity, ())})


def since(df: DataFrame, moment, column: str = "last_seen") -> DataFrame:
    return df.filter(F.col(column) >= F.lit(moment))


def item_explorer(items: DataFrame, type=None, status=None, q=None, number=1, per_page=20):
    df = multi_field_search(equal_to(items, type=type, status=status), q, ["title", "code"])
    # a code may repeat: of equal ones the smaller id comes first
    return page(df.select("type", "code", "title", "status", "item_id"), ["type", "code", "item_id"], (number - 1) * per_page, per_page).drop("item_id")


def by_key(df: DataFrame, key: str, value, pattern: str | None = None) -> DataFrame:
    """The row of one key; with a pattern, a value of another form finds nothing."""
    found = df.filter(F.col(key) == value)
    return found.filter(F.lit(value).rlike(pattern)) if pattern else found


def hot_subset_ec(ec: DataFrame) -> DataFrame:
    return ec.filter("vigente").select("ec_clave", "titulo", "sector_id", "nivel")


def hot_subset_cert(cert: DataFrame) -> DataFrame:
    return cert.filter(F.col("estatus") == "Vigente").select("cert_id", "tipo", "nombre_legal", "estado", "estado_inegi")


def folded_words(text: Column) -> Column:
    """Words of a text in lower case and without accents; none of a null one."""
    words = F.filter(F.split(F.lower(fold_accents(text)), r"[^a-z0-9]+"), lambda w: w != "")
    return F.coalesce(words, F.array().cast("array<string>"))


def token_search(df: DataFrame, q: str, fields: list[str]) -> DataFrame:
    """Rows with at least one word of q among the words of the fields; case and accents do not matter."""
    return df.filter(F.arrays_overlap(folded_words(F.concat_ws(" ", *fields)), folded_words(F.lit(q))))


def page_after(df: DataFrame, keys: list[str], last: tuple | None, limit: int) -> DataFrame:
    """The next page after the last row's keys, in order of the keys, which must not be null: the scan skips what lies before,
    at any depth, where an offset reads and sorts it."""
    if last is not None:
        tests = [reduce(lambda a, b: a & b, [*[F.col(k) == F.lit(v) for k, v in zip(keys[:i], last)], F.col(keys[i]) > F.lit(last[i])]) for i in range(len(keys))]
        df = df.filter(reduce(or_, tests))
    return df.orderBy(*keys).limit(limit)
