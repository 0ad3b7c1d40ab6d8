"""SC30 + JN10: country name -> ISO alpha-2 code (contains theta join).

Lookup order follows the ISO 3166-1 list (sorted by alpha-3): exact name
(case-insensitive) first, else the first country whose name contains the
text, else no code (the caller keeps the original text; empty -> 'CR').

The table is complete wherever it runs: codes, their order and most names come
from the JDK's ISO 3166-1 data, and the formal names in which the ISO list
differs from the JDK's short ones are fixed values below.  A caller may pass
its own table instead.  The table is a broadcast side of at most ~250 rows, and
only the distinct raw values of the input are matched against it (a broadcast
nested-loop join), then joined back.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values: (alpha_2, ISO 3166-1 English short name) of frequent countries and of formal names, in alpha-3 order.
ISO_NAMES = [
    ("AR", "Argentina"),
    ("BO", "Bolivia, Plurinational State of"),
    ("BR", "Brazil"),
    ("CA", "Canada"),
    ("CL", "Chile"),
    ("CN", "China"),
    ("CD", "Congo, The Democratic Republic of the"),
    ("CO", "Colombia"),
    ("CR", "Costa Rica"),
    ("CU", "Cuba"),
    ("DE", "Germany"),
    ("DO", "Dominican Republic"),
    ("EC", "Ecuador"),
    ("ES", "Spain"),
    ("FR", "France"),
    ("GB", "United Kingdom"),
    ("GT", "Guatemala"),
    ("HN", "Honduras"),
    ("IT", "Italy"),
    ("JP", "Japan"),
    ("KR", "Korea, Republic of"),
    ("MX", "Mexico"),
    ("NI", "Nicaragua"),
    ("PA", "Panama"),
    ("PE", "Peru"),
    ("PR", "Puerto Rico"),
    ("PT", "Portugal"),
    ("KP", "Korea, Democratic People's Republic of"),
    ("PY", "Paraguay"),
    ("SV", "El Salvador"),
    ("UM", "United States Minor Outlying Islands"),
    ("UY", "Uruguay"),
    ("US", "United States"),
    ("VE", "Venezuela, Bolivarian Republic of"),
]


@lru_cache(maxsize=1)
def _jdk_countries(jvm) -> list[tuple[str, str, str]]:
    """(alpha-3, alpha-2, English name) of every ISO 3166-1 country the JDK knows."""
    locale = jvm.java.util.Locale
    out = []
    for code in locale.getISOCountries():
        c = locale("", code)
        out.append((c.getISO3Country(), code, c.getDisplayCountry(locale.ENGLISH)))
    return out


def country_table(spark: SparkSession, table: DataFrame | None = None) -> DataFrame:
    """ord, alpha_2, name of every country, in alpha-3 order; ``table`` (same columns) replaces it."""
    if table is not None:
        return table.select("ord", "alpha_2", "name")
    formal = dict(ISO_NAMES)
    rows = sorted((a3, a2, formal.get(a2, name)) for a3, a2, name in _jdk_countries(spark._jvm))
    return spark.createDataFrame([(i, a2, n) for i, (_, a2, n) in enumerate(rows)], "ord int, alpha_2 string, name string")


def country_codes(df: DataFrame, col: str, out: str, countries: DataFrame) -> DataFrame:
    """Add ``out`` = ISO code of ``df[col]`` ('' when not found, as the reference)."""
    vals = df.select(F.col(col).alias("_v")).where(F.col("_v").isNotNull() & (F.col("_v") != "")).distinct()
    c = F.broadcast(countries.select("ord", "alpha_2", F.lower("name").alias("_n")))
    lv = F.lower(F.col("_v"))
    cand = vals.join(c, (lv == F.col("_n")) | F.col("_n").contains(lv), "inner")
    # exact match wins, then the first country in list order
    prio = F.struct(F.when(lv == F.col("_n"), 0).otherwise(1), F.col("ord"))
    best = cand.groupBy("_v").agg(F.min_by("alpha_2", prio).alias("_code"))
    j = df.join(best, df[col].eqNullSafe(best["_v"]), "left").drop("_v")
    return j.withColumn(out, F.coalesce(F.col("_code"), F.lit(""))).drop("_code")


def country_or_default(code: Column, raw: Column, default: str = "CR") -> Column:
    """Caller rule: code if found, else the raw text; empty/null -> default."""
    v = F.when(code != "", code).otherwise(raw)
    return F.when(v.isNull() | (v == ""), F.lit(default)).otherwise(v)
