"""H: scalar cleaning functions, all column expressions but the Unicode normal form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from padron.schemas import STATE_ALIASES

_ZERO_WIDTH = "​‌‍﻿"
# Month names.
MONTHS = ("enero", "febrero", "marzo", "abril", "mayo", "junio", "julio", "agosto", "septiembre", "octubre", "noviembre", "diciembre")
MONTHS_EN = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")


def _map(pairs) -> Column:
    return F.create_map(*[F.lit(x) for k, v in pairs for x in (k, v)])


_MONTH_NUMBER = [(m, f"{i:02d}") for names in (MONTHS, MONTHS_EN) for i, m in enumerate(names, 1)]


def clean_text(c: Column) -> Column:
    """White space of any kind, no-break spaces included, to single spaces; zero-width characters go."""
    return F.trim(F.regexp_replace(F.translate(c, _ZERO_WIDTH, ""), r"(?U)\s+", " "))


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def normalize_phone_raw(c: Column) -> Column:
    """10 digits, or 12 with 52 before, in international form; anything else as it is."""
    d = _digits(c)
    return F.when(F.length(d) == 10, F.concat(F.lit("+52"), d)).when((F.length(d) == 12) & d.startswith("52"), F.concat(F.lit("+"), d)).otherwise(c)


def normalize_phone_v2(c: Column) -> Column:
    """As normalize_phone_raw, and 13 digits with 052 before; anything else as its digits."""
    d = _digits(c)
    return (
        F.when(F.length(d) == 10, F.concat(F.lit("+52"), d)).when((F.length(d) == 12) & d.startswith("52"), F.concat(F.lit("+"), d))
        .when((F.length(d) == 13) & d.startswith("052"), F.concat(F.lit("+"), F.substring(d, 2, 12))).otherwise(d)
    )


def title_case(c: Column) -> Column:
    """The first letter of every run of letters in upper case, the others in lower case."""
    # cut where a letter follows something else, then treat each part
    parts = F.split(c, r"(?<=[^\p{L}])(?=\p{L})")
    return F.array_join(F.transform(parts, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.lower(F.substring(p, 2, 1_000_000)))), "")


def normalize_state_name(c: Column) -> Column:
    known = F.element_at(_map(STATE_ALIASES.items()), F.lower(F.trim(c)))
    return F.coalesce(known, title_case(F.trim(c)))


def postal_code(c: Column, address: Column) -> Column:
    """The first five digits of the code, else those after C.P. in the address, else null."""
    own = F.substring(_digits(c), 1, 5)
    found = F.regexp_extract(address, r"C\.?P\.?\s*(\d{5})", 1)
    return F.coalesce(F.nullif(own, F.lit("")), F.nullif(found, F.lit("")))


def email_norm(c: Column) -> Column:
    return F.lower(F.trim(c))


def url_norm(c: Column) -> Column:
    return F.regexp_replace(F.trim(c), "/+$", "")


def website_scheme(c: Column) -> Column:
    return F.when(c.startswith("http"), c).otherwise(F.concat(F.lit("http://"), c))


def code_norm(c: Column) -> Column:
    return F.upper(F.trim(c))


def modality_norm(c: Column) -> Column:
    low = F.lower(c)
    return F.when(low.contains("línea") | low.contains("linea") | low.contains("online"), "en_linea").when(low.contains("presencial"), "presencial").when(c.isNotNull(), "mixto")


def _spelled(c: Column) -> Column:
    """'d de month de yyyy' or 'd month yyyy' as yyyy-mm-dd."""
    def at(g):
        return F.regexp_extract(F.lower(c), r"(\d{1,2})\s+(?:de\s+)?(\p{L}+)\s+(?:de\s+)?(\d{4})", g)
    month = F.element_at(_map(_MONTH_NUMBER), at(2))
    return F.when(at(1) != "", F.try_to_date(F.concat_ws("-", at(3), month, F.lpad(at(1), 2, "0")), "yyyy-MM-dd"))


def _date(c: Column, form: str) -> Column:
    return F.try_to_timestamp(c, F.lit(form)).cast("date")


def parse_date_raw(c: Column) -> Column:
    """A whole value as a date: ISO, dd/mm/yyyy, dd-mm-yyyy, yyyy/mm/dd or spelled out, in this order; else null."""
    t = F.trim(c)
    whole = F.when(t.rlike(r"^\d{1,2} (de )?\p{L}+ (de )?\d{4}$"), _spelled(t))
    return F.coalesce(_date(t, "yyyy-MM-dd"), _date(t, "dd/MM/yyyy"), _date(t, "dd-MM-yyyy"), _date(t, "yyyy/MM/dd"), whole)


def parse_date_iso(c: Column, year_only: bool = False) -> Column:
    """The first date found inside a text: dd/mm/yyyy, else ISO, else spelled out, else (if asked) a bare year's first day."""
    slash, iso = F.regexp_extract(c, r"(\d{1,2}/\d{1,2}/\d{4})", 1), F.regexp_extract(c, r"(\d{4}-\d{2}-\d{2})", 1)
    found = [F.when(slash != "", _date(slash, "d/M/yyyy")), F.when(iso != "", _date(iso, "yyyy-MM-dd")), _spelled(c)]
    if year_only:
        year = F.regexp_extract(c, r"\b(\d{4})\b", 1)
        found.append(F.when(year != "", F.try_to_date(F.concat(year, F.lit("-01-01")), "yyyy-MM-dd")))
    return F.coalesce(*found)


def first_number(c: Column, default=None) -> Column:
    n = F.regexp_extract(c, r"(\d+)", 1).try_cast("int")
    return n if default is None else F.coalesce(n, F.lit(default))


def version_number(c: Column) -> Column:
    return F.coalesce(F.nullif(F.regexp_extract(c, r"(\d+(?:\.\d+)?)", 1), F.lit("")), F.lit("1.0"))


def ec_codes_in_text(c: Column) -> Column:
    return F.array_sort(F.array_distinct(F.regexp_extract_all(c, F.lit(r"(EC\d{4})"), 1)))


ID_PATTERNS = {"id": r"[?&]id=([^&#]+)", "sector": r"(?:sector=|/sector/)(\d+)", "comite": r"(?:comite=|/comite/)(\d+)", "number": r"[?&/](?:id=)?(\d+)(?:$|[?&#/])", "cert": r"\b((?:ECE|OC)\d+)\b"}


def id_from_url(c: Column, pattern: str = "id") -> Column:
    return F.nullif(F.regexp_extract(c, ID_PATTERNS.get(pattern, pattern), 1), F.lit(""))


def content_hash_item(*cols: Column) -> Column:
    """SHA-256 of the fields that are there, joined by |."""
    return F.sha2(F.concat_ws("|", *cols), 256)


#: Columns that say when a row was seen, not what it says.
VOLATILE = ("extracted_at", "first_seen", "last_seen", "created_at", "updated_at", "row_hash", "content_hash")


def row_hash_canonical(df: DataFrame, exclude=VOLATILE) -> Column:
    """SHA-256 of the row as JSON with sorted keys, nulls included; only business columns."""
    return F.sha2(F.to_json(F.struct(*sorted(c for c in df.columns if c not in exclude)), {"ignoreNullFields": "false"}), 256)


def url_hash(c: Column) -> Column:
    return F.md5(c)


def page_hash(c: Column, short: bool = False) -> Column:
    return F.left(F.md5(c), F.lit(16)) if short else F.md5(c)


def json_fields(df: DataFrame, cols: list[str]) -> DataFrame:
    """List columns as JSON text; null and empty lists as null."""
    return df.withColumns({c: F.when(F.size(c) > 0, F.to_json(c)) for c in cols})


def iso_dates(df: DataFrame, cols: list[str]) -> DataFrame:
    kinds = dict(df.dtypes)
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd" if kinds[c] == "date" else "yyyy-MM-dd'T'HH:mm:ss") for c in cols})


def pct(n: Column, d: Column) -> Column:
    return F.when(d == 0, "0%").otherwise(F.format_string("%.1f%%", F.round(F.lit(100.0) * n / d, 1)))


def dur(seconds: Column) -> Column:
    s = seconds.cast("long")
    return F.format_string("%dh %dm", (s / 3600).cast("long"), ((s % 3600) / 60).cast("long"))


def split_modalities(c: Column) -> Column:
    return F.array_distinct(F.filter(F.transform(F.split(c, ","), lambda x: F.trim(x)), lambda x: x != ""))


def latlong_parse(c: Column) -> Column:
    """'lat,lon' as a struct of doubles; null if it is not two numbers."""
    p = F.split(c, ",")
    lat, lon = F.trim(F.get(p, F.lit(0))).try_cast("double"), F.trim(F.get(p, F.lit(1))).try_cast("double")
    return F.when((F.size(p) == 2) & lat.isNotNull() & lon.isNotNull(), F.struct(lat.alias("lat"), lon.alias("lon")))


def contact_struct(email: Column, phone: Column) -> Column:
    return F.when(F.coalesce(email, phone).isNotNull(), F.struct(email.alias("email"), phone.alias("phone")))


def page_count(total: Column, per_page: int) -> Column:
    return F.ceil(total / per_page).cast("long")


def stable_id(id: Column, *cols: Column) -> Column:
    return F.coalesce(id, F.sha2(F.concat_ws("|", *cols), 256))


def unicode_nfc(c: Column) -> Column:
    """Composed form, straight quotes, no zero-width characters; Arrow batches, as Spark has no built-in form."""
    nfc = F.pandas_udf(lambda s: s.str.normalize("NFC"), "string", F.PandasUDFType.SCALAR)
    return F.translate(nfc(c), "‘’“”" + _ZERO_WIDTH, "''\"\"")


def body_preview(c: Column, n: int = 1000) -> Column:
    """The first n characters with the size in bytes and the hash of the whole body."""
    return F.struct(F.left(c, F.lit(n)).alias("preview"), F.octet_length(c).alias("size"), F.sha2(c, 256).alias("hash"))


def normalize_items(df: DataFrame) -> DataFrame:
    """All cleaning of raw items, columns that are there only."""
    rules = {
        "title": clean_text, "name": clean_text, "address": clean_text, "contact_email": email_norm, "contact_phone": normalize_phone_raw, "url": url_norm,
        "code": code_norm, "ec_code": code_norm, "certificador_code": code_norm, "rfc": code_norm, "state": normalize_state_name, "modality": modality_norm, "sector": title_case,
    }
    df = df.withColumns({c: f(F.col(c)) for c, f in rules.items() if c in df.columns})
    present = [F.col(c) for c in ("type", "code", "name", "title", "rfc", "ec_code") if c in df.columns]
    return df.withColumn("content_hash", content_hash_item(*present))
