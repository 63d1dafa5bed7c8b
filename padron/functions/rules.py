"""I: data-quality rules. A rule is a column giving struct(field, message) or null; a set of rules
gives each row an array of errors."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

# The forms of codes and contact fields.
EC_RAW, EC = r"^EC\d{4}(\.\d{2})?$", r"^EC\d{4}$"
OC, CE, RFC = r"^OC\d{3,4}$", r"^CE\d{4,5}$", r"^[A-ZÑ&]{3,4}\d{6}[A-Z0-9]{3}$"
EMAIL, URL, VERSION, POSTAL = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$", r"^https?://\S+$", r"^\d+(\.\d+)?$", r"^\d{5}$"
TIPOS, ESTATUS = ("ECE", "OC"), ("ACTIVO", "INACTIVO", "SUSPENDIDO", "Vigente", "Cancelado", "Suspendido")

# Required fields of each entity, in v2 names.
REQUIRED = {
    "ec_standard": ("ec_clave", "titulo"), "certificador": ("cert_id", "tipo", "nombre_legal"), "centro": ("centro_id", "nombre"),
    "sector": ("sector_id", "nombre"), "comite": ("comite_id", "nombre"), "ece_ec": ("cert_id", "ec_clave"), "centro_ec": ("centro_id", "ec_clave"), "ec_sector": ("ec_clave", "sector_id"),
}
# Longest texts.
MAX_LENGTHS = {
    "ec_clave": 10, "titulo": 500, "version": 10, "sector": 200, "comite": 200, "tipo_norma": 50, "nivel": 50, "url": 500, "cert_id": 50, "nombre_legal": 500,
    "siglas": 50, "estatus": 50, "estado": 50, "municipio": 100, "cp": 5, "telefono": 20, "correo": 100, "sitio_web": 200, "centro_id": 50,
}
MINIMUMS = {"ec": 1000, "cert": 100, "centros": 500, "sectores": 10, "comites": 50}


def filled(c: Column) -> Column:
    return c.isNotNull() & (F.trim(c.cast("string")) != "")


def error(field: str, message: str, broken: Column) -> Column:
    return F.when(broken, F.struct(F.lit(field).alias("field"), F.lit(message).alias("message")))


def required(field: str) -> Column:
    return error(field, "required", ~filled(F.col(field)))


def shaped(field: str, pattern: str) -> Column:
    """The field, where filled, has the form."""
    return error(field, "format", filled(F.col(field)) & ~F.col(field).cast("string").rlike(pattern))


def one_of(field: str, values) -> Column:
    return error(field, "value", filled(F.col(field)) & ~F.col(field).isin(*values))


def numeric(field: str) -> Column:
    return error(field, "number", F.col(field).isNotNull() & F.col(field).cast("string").try_cast("int").isNull())


def phone(field: str) -> Column:
    n = F.length(F.regexp_replace(F.col(field), "[^0-9]", ""))
    return error(field, "phone", filled(F.col(field)) & ~n.isin(10, 12, 13))


def date_range_rule(field: str, lo: str = "2000-01-01", hi: str = "2050-12-31") -> Column:
    d = F.try_to_date(F.col(field).cast("string"), "yyyy-MM-dd")
    return error(field, "date", filled(F.col(field)) & ~F.coalesce(d.between(F.lit(lo).cast("date"), F.lit(hi).cast("date")), F.lit(False)))


def max_length(df: DataFrame, limits: dict = MAX_LENGTHS) -> list[Column]:
    return [error(c, "too long", F.length(F.col(c).cast("string")) > n) for c, n in limits.items() if c in df.columns]


def with_errors(df: DataFrame, rules: list[Column], name: str = "errors") -> DataFrame:
    return df.withColumn(name, F.array_compact(F.array(*rules)))


def _has(df, *fields):
    return [f for f in fields if f in df.columns]


def rules_raw_ec(df):
    return [required("code"), shaped("code", EC_RAW), required("title"), numeric("level")]


def rules_raw_cert(df):
    return [shaped("code", OC), required("name"), shaped("contact_email", EMAIL), shaped("rfc", RFC)]


def rules_raw_center(df):
    return [shaped("code", CE), required("name"), required("certificador_code")]


def rules_raw_course(df):
    return [required("name"), shaped("ec_code", EC_RAW), error("duration", "number", filled(F.col("duration")) & (F.regexp_extract("duration", r"(\d+)", 1) == ""))]


RAW_RULES = {"ec_standard": rules_raw_ec, "certificador": rules_raw_cert, "center": rules_raw_center, "course": rules_raw_course}


def raw_errors(df: DataFrame, rules=RAW_RULES) -> DataFrame:
    """Mixed raw items with their errors, each by the rules of its type; other types are an error."""
    known = F.when(F.lit(False), F.array(error("type", "", F.lit(True))))
    for t, make in rules.items():
        known = known.when(F.col("type") == t, F.array_compact(F.array(*make(df))))
    return df.withColumn("errors", known.otherwise(F.array(error("type", "unknown type", F.lit(True)))))


def split_untyped(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return df.filter(filled(F.col("type"))), df.filter(~filled(F.col("type")))


def infer_entity_type(df: DataFrame) -> DataFrame:
    """The explicit type, else what the filled keys tell, in a fixed order."""
    order = (("ece_ec", ("cert_id", "ec_clave")), ("centro_ec", ("centro_id", "ec_clave")), ("ec_standard", ("ec_clave",)), ("certificador", ("cert_id",)), ("centro", ("centro_id",)), ("sector", ("sector_id",)), ("comite", ("comite_id",)))
    found = F.when(F.lit(False), "")
    for name, keys in order:
        if all(k in df.columns for k in keys):
            found = found.when(reduce(lambda a, b: a & b, [filled(F.col(k)) for k in keys]), name)
    explicit = F.nullif(F.trim("type"), F.lit("")) if "type" in df.columns else F.lit(None)
    return df.withColumn("entity_type", F.coalesce(explicit, found))


def required_fields(df: DataFrame, entity: str) -> list[Column]:
    return [required(f) if f in df.columns else error(f, "required", F.lit(True)) for f in REQUIRED[entity]]


def rules_ec(df):
    n = F.length("titulo")
    return [required("ec_clave"), shaped("ec_clave", EC), error("titulo", "length", ~F.coalesce(n.between(10, 500), F.lit(False)))] + [shaped(f, p) for f, p in (("version", VERSION), ("url", URL)) if f in df.columns] + [date_range_rule(f) for f in _has(df, "fecha_publicacion", "fecha_vigencia")] + [numeric(f) for f in _has(df, "sector_id", "comite_id")]


def rules_cert(df):
    rules = [one_of("tipo", TIPOS), one_of("estatus", ESTATUS), shaped("estado_inegi", r"^(0[1-9]|[12]\d|3[0-2])$"), shaped("cp", POSTAL), phone("telefono"), shaped("correo", EMAIL)]
    rules += [shaped(f, URL) for f in _has(df, "sitio_web")] + [date_range_rule(f) for f in _has(df, "fecha_acreditacion")]
    if "estandares_acreditados" in df.columns:
        rules.append(error("estandares_acreditados", "format", F.exists("estandares_acreditados", lambda c: ~c.rlike(EC))))
    return rules


def rules_sector(df):
    return [numeric("sector_id"), required("sector_id"), required("nombre")] + [shaped(f, URL) for f in _has(df, "src_url")]


def rules_comite(df):
    return [numeric("comite_id"), required("comite_id"), required("nombre")] + [numeric(f) for f in _has(df, "sector_id")] + [shaped(f, URL) for f in _has(df, "src_url")]


def rules_centro(df):
    out = [required("centro_id"), required("nombre")] + [required(f) for f in _has(df, "certificador_id")]
    out += [shaped(f, p) for f, p in (("estado_inegi", r"^(0[1-9]|[12]\d|3[0-2])$"), ("cp", POSTAL), ("correo", EMAIL), ("sitio_web", URL)) if f in df.columns]
    return out + [phone(f) for f in _has(df, "telefono")]


def rules_relation(df):
    return [shaped("ec_clave", EC)] + [required(f) for f in _has(df, "ec_clave", "cert_id", "centro_id", "sector_id")] + [date_range_rule(f) for f in _has(df, "acreditado_desde")]


def rules_component(df):
    """The older check of mixed components: title, level, phone, duration."""
    level, hours = F.col("level").cast("string").try_cast("int"), F.regexp_extract("duration", r"(\d+)", 1).try_cast("int")
    return [
        error("title", "short", F.length(F.trim("title")) < 10), error("level", "range", level.isNull() | ~level.between(1, 5)),
        shaped("contact_phone", r"^\+?[\d\s()-]{10,}$"), error("duration", "range", filled(F.col("duration")) & ~F.coalesce(hours.between(0, 1000), F.lit(False))),
    ]


RULES = {"ec": rules_ec, "cert": rules_cert, "centros": rules_centro, "sectores": rules_sector, "comites": rules_comite, "ece_ec": rules_relation, "centro_ec": rules_relation, "ec_sector": rules_relation}


def register_rules(entity: str, make) -> None:
    """Add or replace the rule set of an entity: make(df) gives a list of rule columns."""
    RULES[entity] = make


def checked(df: DataFrame, entity: str) -> DataFrame:
    """df with the errors that the rules registered for an entity find."""
    if entity not in RULES:
        raise ValueError(f"no rules are registered for {entity}; there are {', '.join(sorted(RULES))}")
    return with_errors(df, RULES[entity](df))


def quality_report(df: DataFrame, by: str = "type") -> DataFrame:
    """Totals, valid and invalid rows and the rate, by type and (type null, level total) in all. df has errors."""
    ok = F.count_if(F.size("errors") == 0)
    n = F.count("*")
    out = df.rollup(by).agg(n.alias("total"), ok.alias("valid"), F.grouping(by).alias("g"))
    return out.select(F.when(F.col("g") == 1, "(all)").otherwise(F.coalesce(by, F.lit("(none)"))).alias("type"), "total", "valid", (F.col("total") - F.col("valid")).alias("invalid"), F.round(F.col("valid") / F.col("total"), 6).alias("rate"))


def coverage_expectations(counts: DataFrame, minimums: dict = MINIMUMS) -> DataFrame:
    """counts(name, n) against the least number of rows of each entity."""
    least = F.element_at(F.create_map(*[F.lit(x) for k, v in minimums.items() for x in (k, v)]), F.col("name"))
    return counts.withColumn("minimum", least).filter("minimum is not null").withColumn("ok", F.col("n") >= F.col("minimum"))


def exploded(df: DataFrame, key: str) -> DataFrame:
    return df.select(F.col(key).cast("string").alias("key"), F.explode("errors").alias("e")).select("key", "e.field", "e.message")


def sample_errors(df: DataFrame, key: str, k: int = 10) -> DataFrame:
    return df.filter(F.size("errors") > 0).orderBy(key).limit(k)


def quality_gate(report: DataFrame, min_rate: float = 0.95) -> DataFrame:
    return report.filter("type = '(all)'").select("rate", (F.col("rate") >= min_rate).alias("passed"))


def written_with_report(df: DataFrame, write, types=tuple(RAW_RULES), by: str = "type") -> DataFrame:
    """quality_report() of what write(df) writes, counted while it is written: the gate costs no pass of its own.

    df has errors. A type that is none of `types` counts as (other), a null one as (none); types without rows are left out.
    """
    seen = Observation("quality")
    ok = F.size("errors") == 0
    kinds = {**{t: F.col(by) == t for t in types}, "(none)": F.col(by).isNull(), "(other)": F.col(by).isNotNull() & ~F.col(by).isin(*types), "(all)": F.lit(True)}
    counts = [F.count_if(c).alias(f"total {t}") for t, c in kinds.items()] + [F.count_if(c & ok).alias(f"valid {t}") for t, c in kinds.items()]
    write(df.observe(seen, *counts))
    got = seen.get
    rows = [(t, got[f"total {t}"], got[f"valid {t}"]) for t in kinds if got[f"total {t}"]]
    out = df.sparkSession.createDataFrame(rows, "type string, total long, valid long")
    return out.withColumn("invalid", F.col("total") - F.col("valid")).withColumn("rate", F.round(F.col("valid") / F.col("total"), 6))


def item_gate(df: DataFrame, entity: str) -> tuple[DataFrame, DataFrame]:
    """Rows that may leave extraction, and the others with their errors."""
    checked = with_errors(df, required_fields(df, entity) + {"ec_standard": rules_ec, "certificador": lambda d: [one_of("tipo", TIPOS)], "centro": lambda d: [], "sector": rules_sector, "comite": rules_comite}[entity](df))
    return checked.filter(F.size("errors") == 0).drop("errors"), checked.filter(F.size("errors") > 0)


def code_prefix(field: str, prefix: str) -> Column:
    return error(field, f"must start with {prefix}", ~F.coalesce(F.upper(F.trim(field)).startswith(prefix), F.lit(False)))


def unique_violations(df: DataFrame, *keys) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def ref_violations(edge: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    return edge.join(dim.select(key), key, "left_anti")


def export_parity(written: DataFrame, source: DataFrame) -> DataFrame:
    """Whether an export is whole: same number of rows and not empty."""
    one = written.agg(F.count("*").alias("written")).crossJoin(F.broadcast(source.agg(F.count("*").alias("source"))))  # one row
    issue = F.when(F.col("written") == 0, "empty").when(F.col("written") != F.col("source"), "count differs")
    return one.withColumn("ok", issue.isNull()).withColumn("issue", issue)


def coverage_parity(counts: DataFrame, reported: DataFrame, least: float = 0.99) -> DataFrame:
    """counts(name, n) against the totals that the source pages report (name, reported)."""
    share = F.try_divide("n", "reported")
    return counts.join(reported, "name").withColumn("share", F.round(share, 6)).withColumn("ok", F.coalesce(share >= least, F.lit(False)))
