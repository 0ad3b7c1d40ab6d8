"""Queries for SKU rules, recommendations from source codes and the SQL functions over them, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.sql_functions import register_config_function, register_rule_functions
from ..operators import rules as R
from .etl import published_rules, warehouse_tables

#: Thresholds low enough for single products to give rules: two baskets at least.
SUPPORT, CONFIDENCE, LIFT = 0.00002, 0.05, 1.5
#: (source, field of its code in the products of a rule).
SOURCES = (("mongo", "CodigoMongo"), ("supabase", "CodigoSupa"))


def _rules(spark, sf_dir):
    return published_rules(spark, sf_dir, "SKU", SUPPORT, CONFIDENCE, LIFT, min_baskets=2)


def _code_lines(spark, sf_dir):
    """{source: (basket, code)} of every order line of the two sources that ask with their own product codes."""
    from .etl import source_tables
    s = source_tables(spark, sf_dir)
    mongo = s["mongo"]["ordenes"].select(F.col("_id").alias("basket"), F.explode("items").alias("i")).select("basket", F.col("i.producto_id").alias("_p"))
    mongo = mongo.join(s["mongo"]["productos"].select(F.col("_id").alias("_p"), F.col("codigo_mongo").alias("code")), "_p").select("basket", "code")
    sup = s["supabase"]
    code = F.when(F.col("sku") == "", F.col("producto_id")).otherwise(F.col("sku"))        # a product without a SKU goes by its uuid
    supabase = sup["orden_detalle"].select(F.col("orden_id").alias("basket"), "producto_id").join(
        sup["producto"].select("producto_id", code.alias("code")), "producto_id").select("basket", "code")
    return {"mongo": mongo, "supabase": supabase}


def association_rules_sku_pairs(spark, sf_dir):
    """AR2-AR7, SC33, SNK5: rules between single products (support of two baskets, confidence 0.05, lift 1.5)."""
    r = _rules(spark, sf_dir)
    return r.select("Antecedent", "Consequent", F.round("support", 9).alias("support"), F.round("confidence", 9).alias("confidence"),
                    F.round("lift", 9).alias("lift"))


def recommend_from_codes(spark, sf_dir):
    """AR9, AR8, AR10, SC34, JN12: every Mongo and Supabase order in its own product codes, the five best rules and both sides' products."""
    w = warehouse_tables(spark, sf_dir)
    rules, lines, out = _rules(spark, sf_dir), _code_lines(spark, sf_dir), None
    for source, code_name in SOURCES:
        part = R.recommend_from_codes(lines[source], rules, w["map_producto"], w["dim_producto"], source, code_name).select(
            F.lit(source).alias("fuente"), "basket", "Antecedent", "Consequent", "rank", "productos_antecedente", "productos_consecuente")
        out = part if out is None else out.unionByName(part)
    return out


def _lists(spark, sf_dir):
    """Temporary views of every order's codes and SKUs as comma-separated lists, and the functions over them."""
    w = warehouse_tables(spark, sf_dir)
    register_rule_functions(spark, _rules(spark, sf_dir), w["map_producto"], w["dim_producto"])
    for source, lines in _code_lines(spark, sf_dir).items():
        (lines.groupBy("basket").agg(F.array_join(F.array_sort(F.collect_list("code")), " , ").alias("lista"))
         .createOrReplaceTempView(f"sm_pedidos_{source}"))


def sql_skus_por_codigos(spark, sf_dir):
    """UD2: the two code look-ups called from SQL for every order's list of codes."""
    _lists(spark, sf_dir)
    return spark.sql("""
        SELECT 'mongo' AS fuente, b.basket, f.CodigoMongo AS codigo, f.SKU FROM sm_pedidos_mongo b, LATERAL sm_skus_por_codigos_mongo(b.lista) f
        UNION ALL
        SELECT 'supabase', b.basket, f.CodigoSupabase, f.SKU FROM sm_pedidos_supabase b, LATERAL sm_skus_por_codigo_supabase(b.lista) f""")


def sql_consecuentes(spark, sf_dir):
    """UD2: the two rule look-ups called from SQL for the SKUs of every order."""
    _lists(spark, sf_dir)
    return spark.sql("""
        WITH m AS (SELECT b.basket, concat_ws(',', collect_list(f.SKU)) AS skus
                   FROM sm_pedidos_mongo b, LATERAL sm_skus_por_codigos_mongo(b.lista) f GROUP BY b.basket),
        s AS (SELECT b.basket, concat_ws(',', collect_list(f.SKU)) AS skus
              FROM sm_pedidos_supabase b, LATERAL sm_skus_por_codigo_supabase(b.lista) f GROUP BY b.basket)
        SELECT 'mongo' AS fuente, m.basket, r.Antecedent, r.Consequent, r.Rango AS rank, r.ProductosAntecedente AS productos_antecedente,
               r.ProductosConsecuente AS productos_consecuente FROM m, LATERAL sm_consecuentes_por_skus(m.skus) r
        UNION ALL
        SELECT 'supabase', s.basket, r.Antecedent, r.Consequent, r.Rango, r.ProductosAntecedente, r.ProductosConsecuente
        FROM s, LATERAL sm_consecuentes(s.skus) r""")


def config_sales(spark, sf_dir):
    """UD1: sales of the last year, in the currency, that a settings table names, read by the SQL function ``sm_config``."""
    w = warehouse_tables(spark, sf_dir)
    last = w["fact_ventas"].agg((F.max("TiempoID") - 10000).cast("string").alias("d"))         # the same day a year earlier
    settings = (last.select(F.lit("desde").alias("nombre"), F.col("d").alias("valor"))
                .unionByName(w["fact_ventas"].agg(F.min("MonedaOriginal").alias("valor")).select(F.lit("moneda").alias("nombre"), "valor")))
    register_config_function(spark, settings)
    w["fact_ventas"].createOrReplaceTempView("sm_fact_ventas")
    return spark.sql("""
        SELECT sm_config('desde') AS desde, sm_config('moneda') AS moneda, sm_config('nada') AS nada, count(*) AS lineas,
               CAST(round(sum(TotalUSD), 2) AS DOUBLE) AS ventas_usd
        FROM sm_fact_ventas WHERE TiempoID >= CAST(sm_config('desde') AS INT) AND MonedaOriginal = sm_config('moneda')""")


QUERIES = {f.__name__: f for f in (association_rules_sku_pairs, recommend_from_codes, sql_skus_por_codigos, sql_consecuentes, config_sales)}


def oracle() -> dict[str, str]:
    from .oracle import DIMP_CTE, FACTK_CTE, PRESENT_CTE, RULE_CTES, _mining_ctes, with_all
    mining = [c.replace(">= ceil(7e-77 * (SELECT n FROM nb))", f">= greatest(2, ceil({SUPPORT:.5f} * (SELECT n FROM nb)))") for c in _mining_ctes("sku", 7e-77)]
    kept = f"kept AS MATERIALIZED (SELECT * FROM rules WHERE conf >= {CONFIDENCE} AND lift >= {LIFT})"
    field = "CASE WHEN fuente = 'mongo' THEN 'CodigoMongo' ELSE 'CodigoSupa' END"
    asked = f"""
code AS (SELECT s AS fuente, sku, source_code FROM pres),
ordered AS (
  SELECT lx.fuente, CASE WHEN lx.src = 3 THEN printf('%024d', lx.ok) ELSE '00000000-0000-0000-0000-' || printf('%012d', lx.ok) END AS basket, lx.p
  FROM lx WHERE lx.src IN (2, 3)),
lines AS (SELECT DISTINCT o.fuente, o.basket, pres.source_code AS codigo, pres.sku FROM ordered o JOIN pres ON pres.p = o.p AND pres.s = o.fuente),
baskets AS (SELECT fuente, basket, array_to_string(list_sort(list(DISTINCT sku)), ', ') AS t FROM lines GROUP BY 1, 2),
side AS (SELECT DISTINCT t, unnest(string_split(t, ', ')) AS sku FROM (SELECT a AS t FROM kept UNION SELECT c FROM kept)),
named AS (
  SELECT f.fuente, side.t, '[' || string_agg('{{"SKU":"' || side.sku || '","Nombre":"' || d.nombre_norm || '"'
      || coalesce(',"' || {field.replace('fuente', 'f.fuente')} || '":"' || code.source_code || '"', '') || '}}', ',' ORDER BY side.sku) || ']' AS j
  FROM side CROSS JOIN (VALUES ('mongo'), ('supabase')) f(fuente) JOIN dimp d ON d.sku = side.sku
  LEFT JOIN code ON code.fuente = f.fuente AND code.sku = side.sku GROUP BY 1, 2)"""
    ctes = [*mining, RULE_CTES, kept, PRESENT_CTE, DIMP_CTE, asked]
    recommended = with_all("""
SELECT fuente, basket, Antecedent, Consequent, CAST(rank AS INTEGER) AS rank, productos_antecedente, productos_consecuente FROM (
  SELECT b.fuente, b.basket, k.a AS Antecedent, k.c AS Consequent, na.j AS productos_antecedente, nc.j AS productos_consecuente,
         row_number() OVER (PARTITION BY b.fuente, b.basket ORDER BY conf DESC, lift DESC, k.c) AS rank
  FROM baskets b JOIN kept k ON k.a = b.t LEFT JOIN named na ON na.fuente = b.fuente AND na.t = k.a
  LEFT JOIN named nc ON nc.fuente = b.fuente AND nc.t = k.c) WHERE rank <= 5
""", *ctes)
    return {
        "association_rules_sku_pairs": with_all("""
SELECT a AS Antecedent, c AS Consequent, round(sup, 9) AS support, round(conf, 9) AS confidence, round(lift, 9) AS lift FROM kept
""", *mining, RULE_CTES, kept),
        "recommend_from_codes": recommended,
        "sql_skus_por_codigos": with_all("SELECT fuente, basket, codigo, sku AS SKU FROM lines", *ctes),
        "sql_consecuentes": recommended,
        "config_sales": with_all("""
, conf AS (SELECT CAST(max(tiempo_id) - 10000 AS VARCHAR) AS desde FROM factk),
mon AS (SELECT min(cur) AS moneda FROM factk)
SELECT desde, moneda, CAST(NULL AS VARCHAR) AS nada, count(*) AS lineas, CAST(round(sum(total_usd), 2) AS DOUBLE) AS ventas_usd
FROM factk, conf, mon WHERE tiempo_id >= CAST(desde AS INTEGER) AND cur = moneda GROUP BY 1, 2
""", FACTK_CTE),
    }
