"""Queries for order pages, include shapes and options that no other query sets, with their SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..functions import clean
from ..operators import kpi, orders, staging, warehouse
from ..operators import equivalence as eqv
from ..sources.readers import relationship_triplets
from .etl import source_tables, warehouse_tables


def _page(spark, sf_dir, **how):
    g = source_tables(spark, sf_dir)["neo4j"]
    x = orders.graph_orders_page(g["Orden"], g["REALIZO"], g["CONTIENE"], g["Producto"], g["PERTENECE_A"], g["Categoria"], **how)
    return x.select(F.col("id").alias("orden_id"), F.to_date("fecha").alias("fecha"), "cliente_id", "seq", "producto_id", "producto_nombre", "categoria",
                    "cantidad", F.round("subtotal", 2).alias("subtotal"))


def graph_orders_third_page(spark, sf_dir):
    """JN13, SO2: third page of 40 orders, oldest first, expanded to lines after the cut."""
    return _page(spark, sf_dir, page=3, limit=40)


def graph_orders_newest_page(spark, sf_dir):
    """JN13, SO2: the 40 newest orders, expanded to lines after the cut."""
    return _page(spark, sf_dir, page=1, limit=40, newest=True)


def graph_triplets_all(spark, sf_dir):
    """SRC5: every relationship of the graph with both end nodes, whichever its type."""
    t = relationship_triplets(source_tables(spark, sf_dir)["neo4j"])

    def named(end):
        return F.coalesce(F.col(f"{end}_props")["nombre"], F.col(f"{end}_props")["canal"])
    return t.select(F.col("type").alias("tipo"), F.col("from_label").alias("de_etiqueta"), F.col("from_id").alias("de_id"), named("from").alias("de_nombre"),
                    F.col("to_label").alias("a_etiqueta"), F.col("to_id").alias("a_id"), named("to").alias("a_nombre"),
                    F.col("props")["seq"].cast("int").alias("seq"), F.col("props")["cantidad"].cast("int").alias("cantidad"))


def include_client_orders(spark, sf_dir):
    """JN20: clients with their orders, each with its lines (two levels of nesting)."""
    s = source_tables(spark, sf_dir)["mssql"]
    lines = s["OrdenDetalle"].join(s["Producto"].select("ProductoId", "SKU"), "ProductoId", "left")
    with_lines = orders.include_related(s["Orden"], lines, "OrdenId", ["OrdenDetalleId", "SKU", "Cantidad"], "OrdenDetalleId", "lineas")
    c = orders.include_related(s["Cliente"], with_lines, "ClienteId", ["OrdenId", "Canal", "lineas"], "OrdenId", "ordenes")
    units = F.aggregate("ordenes", F.lit(0).cast("long"), lambda a, o: a + F.aggregate(o["lineas"], F.lit(0).cast("long"), lambda b, x: b + x["Cantidad"]))
    return c.select("ClienteId", F.size("ordenes").alias("n_ordenes"), units.alias("unidades"),
                    F.array_join(F.transform("ordenes", lambda o: F.concat(o["OrdenId"].cast("string"), F.lit(":"), F.size(o["lineas"]).cast("string"))),
                                 ",").alias("ordenes"))


def include_product_lines(spark, sf_dir):
    """JN20: products with the order lines that name them."""
    s = source_tables(spark, sf_dir)["mssql"]
    p = orders.include_related(s["Producto"], s["OrdenDetalle"], "ProductoId", ["OrdenDetalleId", "OrdenId", "Cantidad"], "OrdenDetalleId", "lineas")
    return p.select("ProductoId", "SKU", F.size("lineas").alias("n_lineas"),
                    F.aggregate("lineas", F.lit(0).cast("long"), lambda a, x: a + x["Cantidad"]).alias("unidades"),
                    F.try_element_at("lineas", F.lit(1))["OrdenDetalleId"].alias("primera"), F.try_element_at("lineas", F.lit(-1))["OrdenDetalleId"].alias("ultima"))


def include_line_parents(spark, sf_dir):
    """JN20: order lines with their order, its client, and their product as nested records."""
    s = source_tables(spark, sf_dir)["mssql"]
    o = s["Orden"].join(s["Cliente"].select("ClienteId", "Nombre"), "ClienteId", "left").select(
        "OrdenId", F.struct("Canal", F.struct("ClienteId", F.col("Nombre").alias("nombre")).alias("cliente")).alias("orden"))
    p = s["Producto"].select("ProductoId", F.struct("SKU", "Categoria").alias("producto"))
    d = s["OrdenDetalle"].join(o, "OrdenId", "left").join(p, "ProductoId", "left")
    return d.select("OrdenDetalleId", F.col("orden.Canal").alias("canal"), F.col("orden.cliente.ClienteId").alias("cliente_id"),
                    F.col("orden.cliente.nombre").alias("cliente"), F.col("producto.SKU").alias("sku"))


def fact_source_totals(spark, sf_dir):
    """SC23: the fact with each order's own total on every line, for the sources whose orders carry one."""
    w = warehouse_tables(spark, sf_dir)
    f = warehouse.fact_ventas(w["stg_orden_items"], w["dim_tiempo"], w["dim_cliente"], w["map_producto"], w["dim_producto"], total_basis="source")
    return (f.where(F.col("Fuente").isin("supabase", "mongo", "neo4j")).groupBy("Fuente", "MonedaOriginal")
            .agg(F.count(F.lit(1)).alias("filas"), F.round(F.sum("TotalOriginal"), 2).cast("double").alias("total_original")))


def kpi_total_filters(spark, sf_dir):
    """KP1: total sales of one client, one product, one category, and of product and dates together."""
    w = warehouse_tables(spark, sf_dir)
    sales = w["fact_ventas"].join(w["dim_producto"].select("ProductoID", "SKU", "Categoria"), "ProductoID")
    first = sales.agg(F.min("ClienteID").alias("c"), F.min("SKU").alias("p"), F.min("Categoria").alias("k")).first()       # three scalars
    cases = {"cliente": {"cliente": first["c"]}, "producto": {"producto": first["p"]}, "categoria": {"categoria": first["k"]},
             "producto y fechas": {"producto": first["p"], "date_from": "1996-01-01", "date_to": "1998-12-31"}}
    parts = [kpi.total_sales(kpi.apply_filters(sales, **how)).select(F.lit(name).alias("filtro"), "ventas_usd", "lineas") for name, how in cases.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def equivalence_without_source(spark, sf_dir):
    """SRC9: product equivalences while one source (SQL Server) is absent, by origin of the SKU."""
    src = {k: v for k, v in source_tables(spark, sf_dir).items() if k != "mssql"}
    groups = eqv.resolve_skus(eqv.group_products(eqv.standardize_products(staging.product_frames(src))), 0)
    return groups.groupBy("sku_origin").agg(F.count(F.lit(1)).alias("grupos"))


_GENDERS = ["M", " masculino ", "male", "H", "Hombre", "f", "FEMENINO", "mujer", "x", None]
_CHANNELS = ["web", " Online ", "ecommerce", "tienda", "STORE", "app", "Partner", "fax", "", None]


def shared_cleaners(spark, sf_dir):
    """SC1 + SC5: the shared gender and channel rules on a messy word for every order."""
    from ..sources import fixtures
    o = fixtures.read_table(spark, sf_dir, "orders")
    i = (F.col("o_orderkey") % 10).cast("int")
    o = o.select(fixtures.pick(i, _GENDERS).alias("g"), fixtures.pick(i, _CHANNELS).alias("c"))
    return (o.select("g", "c", clean.gender_shared(F.col("g")).alias("genero"), clean.channel_shared(F.col("c")).alias("canal"))
            .groupBy("g", "c", "genero", "canal").agg(F.count(F.lit(1)).alias("filas")))


QUERIES = {f.__name__: f for f in (graph_orders_third_page, graph_orders_newest_page, graph_triplets_all, include_client_orders, include_product_lines, include_line_parents,
                                   fact_source_totals, kpi_total_filters, equivalence_without_source, shared_cleaners)}


def oracle() -> dict[str, str]:
    from .oracle import FACTK_CTE, PRESENT_CTE, with_all, with_lines

    def graph_page(way: str, offset: int) -> str:
        return with_lines(f"""
, page AS (SELECT o_orderkey AS ok, o_custkey AS ck, CAST(o_orderdate AS DATE) AS d FROM orders WHERE o_custkey % 5 = 4
           ORDER BY o_orderdate {way}, printf('ORD-%06d', o_orderkey) {way} LIMIT 40 OFFSET {offset})
SELECT printf('ORD-%06d', page.ok) AS orden_id, page.d AS fecha, printf('C%05d', page.ck) AS cliente_id, CAST(l.line_id AS INTEGER) AS seq,
       'SKU' || CAST(1000 + l.p AS VARCHAR) AS producto_id, pa.nm AS producto_nombre, pa.cat AS categoria, CAST(l.qty AS INTEGER) AS cantidad,
       round(l.qty * l.price, 2) AS subtotal
FROM page LEFT JOIN (SELECT * FROM lp WHERE present) l ON l.ok = page.ok LEFT JOIN parts pa ON pa.p = l.p
""")
    own = "SELECT ok, line_id, ok * 10 + line_id AS lid, p, qty, present FROM lx WHERE src = 0"
    genders = ["Masculino"] * 5 + ["Femenino"] * 3 + ["No especificado"] * 2
    channels = ["WEB", "WEB", "WEB", "TIENDA", "TIENDA", "APP", "PARTNER", "FAX", "WEB", "WEB"]

    def listed(xs):
        return "[" + ", ".join("NULL" if x is None else "'" + x + "'" for x in xs) + "]"
    return {
        "graph_orders_third_page": graph_page("ASC", 80),
        "graph_orders_newest_page": graph_page("DESC", 0),
        "graph_triplets_all": with_all("""
, o AS (SELECT o_orderkey AS ok, o_custkey AS ck, printf('ORD-%06d', o_orderkey) AS id,
          ['WEB','TIENDA','APP','PARTNER','WEB'][CAST(substr(o_orderpriority, 1, 1) AS INTEGER)] AS canal FROM orders WHERE o_custkey % 5 = 4)
SELECT 'REALIZO' AS tipo, 'Cliente' AS de_etiqueta, printf('C%05d', o.ck) AS de_id, c_name AS de_nombre, 'Orden' AS a_etiqueta, o.id AS a_id,
       o.canal AS a_nombre, CAST(NULL AS INTEGER) AS seq, CAST(NULL AS INTEGER) AS cantidad
FROM o LEFT JOIN customer ON c_custkey = o.ck
UNION ALL
SELECT 'CONTIENE', 'Orden', o.id, o.canal, 'Producto', 'SKU' || CAST(1000 + l.p AS VARCHAR), CASE WHEN l.present THEN pa.nm END,
       CAST(l.line_id AS INTEGER), CAST(l.qty AS INTEGER)
FROM lx l JOIN o ON o.ok = l.ok JOIN parts pa ON pa.p = l.p WHERE l.src = 4
UNION ALL
SELECT 'PERTENECE_A', 'Producto', 'SKU' || CAST(1000 + p AS VARCHAR), nm, 'Categoria', 'CAT-' || cat, cat, NULL, NULL FROM pres WHERE k = 4
""", PRESENT_CTE),
        "include_client_orders": with_lines(f"""
, l AS ({own}),
o AS (SELECT o_orderkey AS ok, o_custkey AS ck, count(l.ok) AS n, coalesce(sum(l.qty), 0) AS u FROM orders LEFT JOIN l ON l.ok = o_orderkey
      WHERE o_custkey % 5 = 0 GROUP BY 1, 2)
SELECT CAST(c_custkey AS INTEGER) AS ClienteId, CAST(count(o.ok) AS INTEGER) AS n_ordenes, CAST(coalesce(sum(o.u), 0) AS BIGINT) AS unidades,
       coalesce(string_agg(CAST(o.ok AS VARCHAR) || ':' || CAST(o.n AS VARCHAR), ',' ORDER BY o.ok), '') AS ordenes
FROM customer LEFT JOIN o ON o.ck = c_custkey WHERE c_custkey % 5 = 0 GROUP BY c_custkey
"""),
        "include_product_lines": with_lines(f"""
, l AS ({own})
SELECT CAST(p_partkey AS INTEGER) AS ProductoId, 'SKU-' || CAST(1000 + p_partkey AS VARCHAR) AS SKU, CAST(count(l.lid) AS INTEGER) AS n_lineas,
       CAST(coalesce(sum(l.qty), 0) AS BIGINT) AS unidades, CAST(min(l.lid) AS INTEGER) AS primera, CAST(max(l.lid) AS INTEGER) AS ultima
FROM part LEFT JOIN l ON l.p = p_partkey WHERE p_partkey % 97 NOT IN (0, 1) AND p_partkey % 10 <> 0 GROUP BY p_partkey
"""),
        "include_line_parents": with_lines(f"""
, l AS ({own})
SELECT CAST(l.lid AS INTEGER) AS OrdenDetalleId, ['WEB','TIENDA','APP','PARTNER','WEB'][CAST(substr(o_orderpriority, 1, 1) AS INTEGER)] AS canal,
       CAST(o_custkey AS INTEGER) AS cliente_id, c_name AS cliente, CASE WHEN l.present THEN 'SKU-' || CAST(1000 + l.p AS VARCHAR) END AS sku
FROM l JOIN orders ON o_orderkey = l.ok JOIN customer ON c_custkey = o_custkey
"""),
        "fact_source_totals": with_lines("""
, tot AS (SELECT ok, sum(CAST(qty * price AS DECIMAL(18,2))) AS t FROM lp GROUP BY ok)
SELECT f.fuente AS Fuente, f.cur AS MonedaOriginal, count(*) AS filas, CAST(round(sum(tot.t), 2) AS DOUBLE) AS total_original
FROM fact f JOIN tot ON tot.ok = f.ok WHERE f.src IN (2, 3, 4) GROUP BY 1, 2
"""),
        "kpi_total_filters": with_all("""
, c AS (SELECT fuente, client_key FROM factk ORDER BY 1, 2 LIMIT 1), m AS (SELECT min(sku) AS p, min(cat) AS k FROM factk),
cases AS (
  SELECT 'cliente' AS filtro, total_usd FROM factk JOIN c USING (fuente, client_key)
  UNION ALL SELECT 'producto', total_usd FROM factk, m WHERE sku = m.p
  UNION ALL SELECT 'categoria', total_usd FROM factk, m WHERE cat = m.k
  UNION ALL SELECT 'producto y fechas', total_usd FROM factk, m WHERE sku = m.p AND tiempo_id BETWEEN 19960101 AND 19981231)
SELECT f.filtro, CAST(round(sum(total_usd), 2) AS DOUBLE) AS ventas_usd, count(total_usd) AS lineas
FROM (VALUES ('cliente'), ('producto'), ('categoria'), ('producto y fechas')) f(filtro) LEFT JOIN cases USING (filtro) GROUP BY 1
""", FACTK_CTE),
        "equivalence_without_source": """
SELECT CASE WHEN p_partkey % 97 IN (0, 1) THEN 'generated' WHEN p_partkey % 10 IN (2, 5) THEN 'mongo' ELSE 'supabase' END AS sku_origin, count(*) AS grupos
FROM part GROUP BY 1
""",
        "shared_cleaners": f"""
SELECT {listed(_GENDERS)}[i + 1] AS g, {listed(_CHANNELS)}[i + 1] AS c, {listed(genders)}[i + 1] AS genero, {listed(channels)}[i + 1] AS canal, count(*) AS filas
FROM (SELECT CAST(o_orderkey % 10 AS INTEGER) AS i FROM orders) GROUP BY i
""",
    }
