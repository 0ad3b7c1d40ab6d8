"""UD1-UD4 for SQL users: the main cleaning rules as session SQL functions.

``CREATE TEMPORARY FUNCTION ... RETURN <expr>`` bodies are inlined by the
analyzer, so they run as native expressions (no Python).  The word lists are
the same fixed values as ``clean``; tests check both forms agree.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from .clean import CHANNEL_MAP_SHARED, GENDER_FEMALE_WORDS, GENDER_MALE_WORDS


def _in_list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def _map_literal(m: dict) -> str:
    return "map(" + ", ".join(f"'{k}', '{v}'" for k, v in m.items()) + ")"


def register_sql_functions(spark: SparkSession) -> list[str]:
    bodies = {
        "sm_normalize_sku": ("s STRING", "STRING",
                             "CASE WHEN upper(trim(s)) LIKE 'SKU%' AND NOT contains(trim(s), '-') AND length(trim(s)) > 3 "
                             "THEN concat('SKU-', substr(trim(s), 4)) ELSE trim(s) END"),
        "sm_sku_number": ("s STRING", "BIGINT", "try_cast(regexp_extract(s, '^SKU-?(\\\\d+)$', 1) AS BIGINT)"),
        "sm_match_key": ("s STRING", "STRING", "lower(trim(coalesce(s, '')))"),
        "sm_gender": ("g STRING", "STRING",
                      f"CASE WHEN upper(trim(g)) IN ({_in_list(GENDER_MALE_WORDS)}) THEN 'Masculino' "
                      f"WHEN upper(trim(g)) IN ({_in_list(GENDER_FEMALE_WORDS)}) THEN 'Femenino' "
                      "ELSE 'No especificado' END"),
        "sm_channel": ("c STRING", "STRING",
                       "CASE WHEN c IS NULL OR c = '' THEN 'WEB' ELSE coalesce(try_element_at("
                       f"{_map_literal(CHANNEL_MAP_SHARED)}, upper(trim(c))), upper(trim(c))) END"),
        "sm_to_usd": ("amount DOUBLE, currency STRING, rate DOUBLE", "DOUBLE",
                      "CASE WHEN currency = 'USD' THEN amount WHEN currency = 'CRC' THEN try_divide(amount, rate) "
                      "ELSE amount END"),
    }
    for name, (args, ret, body) in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({args}) RETURNS {ret} RETURN {body}")
    return list(bodies)


def register_rule_functions(spark: SparkSession, rules, bridge, dim_p, k: int = 5) -> list[str]:
    """UD2: the four look-ups as SQL table functions over comma-separated lists.

    ``sm_skus_por_codigos_mongo`` and ``sm_skus_por_codigo_supabase`` give the
    SKU of each code of the list (JN12); ``sm_consecuentes_por_skus`` (Mongo
    codes) and ``sm_consecuentes`` (Supabase codes) the ``k`` best rules whose
    antecedent is exactly the list and whose consequent shares nothing with it
    (AR8), with the products of both sides as JSON.  Blank entries of a list
    are ignored, repeated ones count once.  The rules are ranked and their sides
    written out before a call: a call is an equi-join on the list's canonical text.
    """
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from ..operators.rules import side_products_json
    order = Window.partitionBy("Antecedent").orderBy(F.desc("confidence"), F.desc("lift"), F.asc("Consequent"))
    best = rules.withColumn("rango", F.row_number().over(order)).where(F.col("rango") <= k)
    names = []
    for source, code, skus, rules_fn in (("mongo", "CodigoMongo", "sm_skus_por_codigos_mongo", "sm_consecuentes_por_skus"),
                                         ("supabase", "CodigoSupabase", "sm_skus_por_codigo_supabase", "sm_consecuentes")):
        own = bridge.where(F.col("source_system") == source).select(F.col("source_code").alias("codigo"), F.col("sku_oficial").alias("s"), F.lit(0).alias("p"))
        also = dim_p.where(F.col("SourceSystem") == source).select(F.col("SourceKey").alias("codigo"), F.col("SKU").alias("s"), F.lit(1).alias("p"))
        (own.unionByName(also).where(F.col("s").isNotNull()).groupBy("codigo").agg(F.min_by("s", "p").alias("SKU"))
         .createOrReplaceTempView(f"sm_codigos_{source}"))
        full = best
        for side, name in (("antecedents", "ProductosAntecedente"), ("consequents", "ProductosConsecuente")):
            full = full.join(side_products_json(best, side, dim_p, bridge, source, "CodigoSupa" if source == "supabase" else code, name),
                             ["Antecedent", "Consequent"], "left")
        full.createOrReplaceTempView(f"sm_reglas_{source}")
        spark.sql(f"""
            CREATE OR REPLACE TEMPORARY FUNCTION {skus}(lista STRING) RETURNS TABLE ({code} STRING, SKU STRING) RETURN
            SELECT c.codigo, c.SKU
            FROM (SELECT explode(array_distinct(filter(transform(split(lista, ','), x -> trim(x)), x -> x <> ''))) AS parte) e
            JOIN sm_codigos_{source} c ON c.codigo = e.parte""")
        spark.sql(f"""
            CREATE OR REPLACE TEMPORARY FUNCTION {rules_fn}(lista STRING)
            RETURNS TABLE (Antecedent STRING, Consequent STRING, Support DOUBLE, Confidence DOUBLE, Lift DOUBLE, Rango INT,
                           ProductosAntecedente STRING, ProductosConsecuente STRING) RETURN
            SELECT r.Antecedent, r.Consequent, r.support, r.confidence, r.lift, r.rango, r.ProductosAntecedente, r.ProductosConsecuente
            FROM sm_reglas_{source} r
            WHERE r.Antecedent = array_join(array_sort(array_distinct(filter(transform(split(lista, ','), x -> trim(x)), x -> x <> ''))), ', ')""")
        names += [skus, rules_fn]
    return names


def register_config_function(spark: SparkSession, settings, name: str = "sm_config") -> str:
    """UD1: the value of a setting by name, from a settings table (nombre, valor); null if there is none.  A name given twice has its greatest value."""
    settings.createOrReplaceTempView(f"{name}_tabla")
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(clave STRING) RETURNS STRING "
              f"RETURN (SELECT max(t.valor) FROM {name}_tabla t WHERE t.nombre = clave)")
    return name
