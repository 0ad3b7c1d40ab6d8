"""Scalar cleaning and normalisation as native Column expressions (SC1-SC40).

Everything here is ``Column -> Column`` built from ``pyspark.sql.functions``,
so it stays inside whole-stage codegen; no Python UDF is involved.  ANSI mode
is assumed on: every parse uses ``try_*`` so bad input gives null, never an
exception.
"""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

NOT_SPECIFIED = "No especificado"
MALE = "Masculino"
FEMALE = "Femenino"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _norm_upper(c) -> Column:
    return F.upper(F.trim(_c(c)))


def _try_lookup(key: Column, mapping: dict) -> Column:
    # element_at on a map with a missing key is null (not an error) for maps.
    return F.try_element_at(F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))]), key)


# --------------------------------------------------------------- gender

# Shared gender vocabulary.
GENDER_MALE_WORDS = ["M", "MASCULINO", "MALE", "H", "HOMBRE"]
GENDER_FEMALE_WORDS = ["F", "FEMENINO", "FEMALE", "MUJER"]


def gender_shared(c) -> Column:
    """SC1: trim+upper; male / female word lists; anything else not specified."""
    g = _norm_upper(c)
    return (F.when(g.isin(GENDER_MALE_WORDS), F.lit(MALE))
            .when(g.isin(GENDER_FEMALE_WORDS), F.lit(FEMALE))
            .otherwise(F.lit(NOT_SPECIFIED)))


def gender_mysql(c) -> Column:
    """SC2: case-insensitive M / F only."""
    g = _norm_upper(c)
    return (F.when(g == "M", F.lit(MALE)).when(g == "F", F.lit(FEMALE))
            .otherwise(F.lit(NOT_SPECIFIED)))


def gender_exact(c) -> Column:
    """SC3 / SC4 (SQL Server, Mongo): exact full words."""
    g = _c(c)
    return (F.when(g == MALE, F.lit(MALE)).when(g == FEMALE, F.lit(FEMALE))
            .otherwise(F.lit(NOT_SPECIFIED)))


def gender_letters_or_words(c) -> Column:
    """SC4 (Supabase, Neo4j): exact 'M'/'F' or the full words."""
    g = _c(c)
    return (F.when(g.isin("M", MALE), F.lit(MALE)).when(g.isin("F", FEMALE), F.lit(FEMALE))
            .otherwise(F.lit(NOT_SPECIFIED)))


GENDER_RULES = {
    "mssql": gender_exact,
    "mysql": gender_mysql,
    "supabase": gender_letters_or_words,
    "mongo": gender_exact,
    "neo4j": gender_letters_or_words,
    "shared": gender_shared,
}


def gender_for(source: str, c) -> Column:
    return GENDER_RULES[source](c)


# -------------------------------------------------------------- channel

# Shared channel synonyms -> standard channel.
CHANNEL_MAP_SHARED = {
    "WEB": "WEB", "ONLINE": "WEB", "ECOMMERCE": "WEB",
    "TIENDA": "TIENDA", "STORE": "TIENDA", "RETAIL": "TIENDA", "FISICA": "TIENDA",
    "APP": "APP", "MOBILE": "APP", "MOVIL": "APP",
    "PARTNER": "PARTNER", "SOCIO": "PARTNER", "ASOCIADO": "PARTNER",
}

# MySQL channel map.
CHANNEL_MAP_MYSQL = {
    "WEB": "WEB", "TIENDA": "TIENDA", "APP": "APP", "PARTNER": "PARTNER",
    "ONLINE": "WEB", "STORE": "TIENDA", "MOVIL": "APP", "MOBILE": "APP",
}


def channel_shared(c) -> Column:
    """SC5: map synonyms; unknown kept upper-cased; null or empty -> WEB."""
    raw = _c(c)
    u = _norm_upper(raw)
    mapped = F.coalesce(_try_lookup(u, CHANNEL_MAP_SHARED), u)
    return F.when(raw.isNull() | (raw == ""), F.lit("WEB")).otherwise(mapped)


def channel_mysql(c) -> Column:
    """SC6: smaller map; null -> WEB; empty string stays empty."""
    raw = _c(c)
    u = _norm_upper(raw)
    return F.when(raw.isNull(), F.lit("WEB")).otherwise(F.coalesce(_try_lookup(u, CHANNEL_MAP_MYSQL), u))


def channel_upper_default(c) -> Column:
    """SC7 (SQL Server): upper, falsy -> WEB."""
    raw = _c(c)
    return F.when(raw.isNull() | (raw == ""), F.lit("WEB")).otherwise(F.upper(raw))


def channel_for(source: str, c) -> Column:
    if source == "mssql":
        return channel_upper_default(c)
    if source == "mysql":
        return channel_mysql(c)
    return _c(c)   # Mongo / Supabase / Neo4j keep the value


# --------------------------------------------------------------- amounts

def parse_amount(c) -> Column:
    """SC8: money text -> double.

    Both ',' and '.' -> commas are thousands separators.  Only ',' and one
    comma followed by at most two characters -> decimal comma; otherwise
    thousands.  Unparseable -> retry with digits and dots only -> else 0.0.
    """
    s = F.trim(_c(c).cast("string"))
    has_comma = s.contains(",")
    has_dot = s.contains(".")
    one_comma_decimal = s.rlike(r"^[^,]*,[^,]{0,2}$")
    normalised = (F.when(has_comma & has_dot, F.regexp_replace(s, ",", ""))
                  .when(has_comma & one_comma_decimal, F.regexp_replace(s, ",", "."))
                  .when(has_comma, F.regexp_replace(s, ",", ""))
                  .otherwise(s))
    digits = F.regexp_replace(normalised, r"[^\d.]", "")
    second = digits.try_cast("double")
    return F.coalesce(normalised.try_cast("double"), second, F.lit(0.0))


def safe_decimal(c, precision: int = 18, scale: int = 2, default=None) -> Column:
    """SC9: commas removed, try-cast, default when it fails."""
    v = F.regexp_replace(_c(c).cast("string"), ",", "").try_cast(f"decimal({precision},{scale})")
    return F.coalesce(v, F.lit(default).cast(f"decimal({precision},{scale})")) if default is not None else v


def safe_int(c, default=None) -> Column:
    v = F.trim(_c(c).cast("string")).try_cast("int")
    return F.coalesce(v, F.lit(default).cast("int")) if default is not None else v


def safe_float(c, default=None) -> Column:
    v = F.regexp_replace(_c(c).cast("string"), ",", "").try_cast("double")
    return F.coalesce(v, F.lit(default).cast("double")) if default is not None else v


# ----------------------------------------------------------------- dates

# Accepted date formats, in the order they are tried.
DATE_FORMATS_MYSQL = ["yyyy-M-d H:m:s", "yyyy-M-d", "d/M/yyyy", "d-M-yyyy"]
DATE_FORMATS_SHARED = ["yyyy-M-d", "yyyy-M-d H:m:s", "yyyy/M/d", "d/M/yyyy", "d-M-yyyy"]


def parse_date_formats(c, formats: Iterable[str]) -> Column:
    s = F.trim(_c(c).cast("string"))
    return F.coalesce(*[F.try_to_timestamp(s, F.lit(f)) for f in formats]).cast("date")


def parse_date_mysql(c) -> Column:
    """SC10."""
    return parse_date_formats(c, DATE_FORMATS_MYSQL)


def safe_date(c) -> Column:
    """SC11 (returns a timestamp like the shared helper)."""
    s = F.trim(_c(c).cast("string"))
    return F.coalesce(*[F.try_to_timestamp(s, F.lit(f)) for f in DATE_FORMATS_SHARED])


def iso_local_date(c) -> Column:
    """SC12 / D10: date of an ISO-8601 text as written (offset not applied).

    The first 10 characters are the local calendar date; the full text must
    still be a valid ISO timestamp or date, else null.
    """
    s = F.trim(_c(c).cast("string"))
    valid = F.coalesce(
        F.try_to_timestamp(s, F.lit("yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]XXX")),
        F.try_to_timestamp(s, F.lit("yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]")),
        F.try_to_timestamp(s, F.lit("yyyy-MM-dd HH:mm:ss[.SSSSSS][XXX]")),
        F.try_to_timestamp(s, F.lit("yyyy-MM-dd")))
    return F.when(valid.isNotNull(), F.substring(s, 1, 10).try_cast("date"))


def to_date_native(c) -> Column:
    """SC13."""
    return F.to_date(_c(c))


def date_or_run_date(parsed: Column, run_date) -> Column:
    """SC14: unparseable order date -> the run date (a parameter)."""
    return F.coalesce(parsed, F.lit(run_date).cast("date"))


# ------------------------------------------------------------------ SKUs

def normalize_sku(c) -> Column:
    """SC17: trim; 'SKU1234' without '-' -> 'SKU-1234'; others unchanged."""
    s = F.trim(_c(c))
    return (F.when(F.upper(s).startswith("SKU") & ~s.contains("-") & (F.length(s) > 3),
                   F.concat(F.lit("SKU-"), F.substr(s, F.lit(4))))
            .otherwise(s))


def sku_number(c) -> Column:
    """SC18: numeric suffix of 'SKU-0012' / 'SKU0012' -> 12, else null."""
    return F.regexp_extract(_c(c), r"^SKU-?(\d+)$", 1).try_cast("long")


def sku_text(n) -> Column:
    """Canonical SKU text for a number: SKU-%04d."""
    return F.format_string("SKU-%04d", _c(n))


def valid_sku(c) -> Column:
    """SC19: at least 3 characters after trim."""
    return F.coalesce(F.length(F.trim(_c(c))) >= 3, F.lit(False))


def match_key(c) -> Column:
    """SC20: lower(trim(x)), null -> ''."""
    return F.lower(F.trim(F.coalesce(_c(c), F.lit(""))))


# --------------------------------------------------------------- amounts

def line_total_discount(qty, price, pct) -> Column:
    """SC21: qty * price * (1 - pct/100), null pct = 0 (double arithmetic)."""
    p = F.coalesce(_c(pct).cast("double"), F.lit(0.0))
    return _c(qty).cast("double") * _c(price).cast("double") * (F.lit(1.0) - p / 100.0)


def line_total(qty, price) -> Column:
    """SC22 / SC39."""
    return _c(qty).cast("double") * _c(price).cast("double")


def code_or(c, fallback) -> Column:
    """SC24: nullif(c, '') else fallback."""
    v = _c(c)
    return F.coalesce(F.when(v != "", v), fallback if isinstance(fallback, Column) else F.lit(fallback))


def business_key(*cols) -> Column:
    """SC26: 'order-item'; null propagates (T-SQL '+' semantics)."""
    out = None
    for c in cols:
        out = _c(c) if out is None else F.concat(out, F.lit("-"), _c(c))
    return out


def date_key(c) -> Column:
    """SC27: yyyyMMdd as int."""
    return F.date_format(_c(c), "yyyyMMdd").cast("int")


def to_usd(amount, currency, crc_per_usd) -> Column:
    """SC28: USD as is; CRC / rate (null when no rate); other currencies unchanged."""
    a = _c(amount)
    cur = _c(currency)
    return (F.when(cur == "USD", a)
            .when(cur == "CRC", F.try_divide(a, _c(crc_per_usd)))
            .otherwise(a))


def transaction_id(source, source_key) -> Column:
    """SC29: order part of the fact's composite SourceKey, per source."""
    s = _c(source)
    k = _c(source_key)
    return (F.when(s == "neo4j", F.substring_index(k, "-SKU-", 1))
            .when(s == "mongo", F.substring(k, 1, 24))
            .when(s == "supabase", F.substring(k, 1, 36))
            .otherwise(F.regexp_extract(k, r"^(.*)-[^-]*$", 1)))


def date_text(c, include_time: bool = False) -> Column:
    """SC31."""
    return F.date_format(_c(c), "yyyy-MM-dd HH:mm:ss" if include_time else "yyyy-MM-dd")


def split_list(c, sep: str = ",") -> Column:
    """SC32: delimited list -> trimmed, non-empty, distinct values."""
    parts = F.transform(F.split(_c(c), sep), lambda x: F.trim(x))
    return F.array_distinct(F.filter(parts, lambda x: x != ""))


def order_number(c) -> Column:
    """SC37: numeric part of 'ORD-000123' / 'O123'."""
    return F.regexp_extract(_c(c), r"^(?:ORD-|O)(\d+)$", 1).try_cast("long")


def clean_object_id(c) -> Column:
    """SC38: trim, strip wrapping quotes; valid 24-hex or null."""
    s = F.regexp_replace(F.trim(_c(c)), r"""^["']+|["']+$""", "")
    return F.when(s.rlike(r"^[0-9a-fA-F]{24}$"), s)


def items_from_json(c, item_schema: str) -> Column:
    """SC35: JSON array text of order items -> array of typed structs
    (explode / inline it for one row per item); bad JSON -> null."""
    return F.from_json(_c(c), f"array<struct<{item_schema}>>", {"mode": "PERMISSIVE"})


def attainment_band(pct) -> Column:
    """SC40: >100 green, 80-100 amber, <80 red."""
    p = _c(pct)
    return (F.when(p.isNull(), F.lit(None)).when(p > 100, F.lit("green"))
            .when(p >= 80, F.lit("amber")).otherwise(F.lit("red")))


def fx_status(last_load_date, rates_today: Column, today) -> Column:
    """SC36: both rates today -> OK; last load >= yesterday -> WARNING; else ERROR."""
    t = F.lit(today).cast("date")
    return (F.when(rates_today >= 2, F.lit("OK"))
            .when(_c(last_load_date) >= F.date_sub(t, 1), F.lit("WARNING"))
            .otherwise(F.lit("ERROR")))
