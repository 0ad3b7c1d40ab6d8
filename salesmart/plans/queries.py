"""Query registry: one callable per implemented operator group.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
given tables (through the warehouse built from them).  Column names match
``oracle.ORACLE``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .etl import warehouse_tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def _w(spark: SparkSession, sf_dir: str) -> dict:
    return warehouse_tables(spark, sf_dir)


def money(c) -> F.Column:
    """Report rounding: exact decimal sum, 2 places, as double."""
    return F.round(c, 2).cast("double")


# ------------------------------------------------------------------ M0

@register("vw_ventas_mensuales")
def vw_ventas_mensuales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG12: monthly quantity and USD by product (fact carries Anio/Mes, so
    the date dimension join of the view is not needed)."""
    w = _w(spark, sf_dir)
    f = w["fact_ventas"]
    p = w["dim_producto"].select("ProductoID", "SKU", F.col("Nombre").alias("Producto"), "Categoria")
    per = f.groupBy("Anio", "Mes", "ProductoID").agg(F.sum("Cantidad").alias("_q"), F.sum("TotalUSD").alias("_v"))
    return per.join(p, "ProductoID").select(       # a SKU is one row of the dimension: names join after the aggregate
        "Anio", "Mes", "SKU", "Producto", "Categoria", F.col("_q").cast("double").alias("Qty"), money(F.col("_v")).alias("VentasUSD"))


# ------------------------------------------------------------------ M2

@register("equivalence_map")
def equivalence_map(spark, sf_dir):
    """ER1-ER4, ER10 (SC17-SC20): one row per product group with its official SKU and origin."""
    e = _w(spark, sf_dir)["eq_map"]
    return e.select("key_nombre", "key_categoria", "sku_oficial", "sku_origin")


@register("equivalence_stats")
def equivalence_stats_q(spark, sf_dir):
    """ER7: group and SKU-origin statistics."""
    from ..operators.equivalence import equivalence_stats
    return equivalence_stats(_w(spark, sf_dir)["eq_map"])


@register("map_producto")
def map_producto(spark, sf_dir):
    """ER8, ER9, SNK1: the bridge table."""
    b = _w(spark, sf_dir)["map_producto"]
    return b.select("source_system", "source_code", "sku_oficial", "nombre_norm", "categoria_norm", "es_servicio")


@register("stg_clientes")
def stg_clientes(spark, sf_dir):
    """ST1-ST5 clients (SC2-SC4, SC10, SC12, SC15-SC16, SC30, JN10, SNK2)."""
    c = _w(spark, sf_dir)["stg_clientes"]
    return c.select("source_system", "source_code", "cliente_email", "cliente_nombre", "genero_norm",
                    "pais_raw", "fecha_creado_dt")


@register("rejects_by_reason")
def rejects_by_reason(spark, sf_dir):
    """FL1-FL5: staged vs rejected order lines per source and reason."""
    from ..operators.quality import rejects_by_reason as rr
    return rr(_w(spark, sf_dir)["items_all"])


@register("staging_stats_items")
def staging_stats_items(spark, sf_dir):
    """AG3 over staged lines (after SNK3 first-wins; SC21-SC22 line totals)."""
    s = _w(spark, sf_dir)["stg_orden_items"]
    return s.groupBy("source_system", "moneda").agg(
        F.count(F.lit(1)).alias("lineas"), F.countDistinct("source_key_orden").alias("ordenes"),
        money(F.sum(F.col("line_total_num").cast("decimal(18,6)"))).alias("monto"))


@register("staging_stats_bridge")
def staging_stats_bridge(spark, sf_dir):
    """AG1: bridge rows, distinct SKUs and services per source."""
    from ..operators.quality import bridge_stats
    return bridge_stats(_w(spark, sf_dir)["map_producto"])


@register("staging_stats_clients")
def staging_stats_clients(spark, sf_dir):
    """AG2: clients, distinct emails and countries per source."""
    from ..operators.quality import client_stats
    return client_stats(_w(spark, sf_dir)["stg_clientes"])


# ------------------------------------------------------------------ M3

@register("tipo_cambio")
def tipo_cambio(spark, sf_dir):
    """SNK4: directed daily rates (feed unpivoted, upserted on (fecha, de, a))."""
    t = _w(spark, sf_dir)["tipo_cambio"]
    return t.select("fecha", "de", "a", F.col("tasa").cast("double").alias("tasa"))


@register("dim_tiempo")
def dim_tiempo(spark, sf_dir):
    """DW1 + DW2 (JN7, JN8, SE5, SC27)."""
    t = _w(spark, sf_dir)["dim_tiempo"]
    return t.select("TiempoID", "Fecha", "Anio", "Mes", "Dia", F.col("TC_CRC_USD").cast("double").alias("TC_CRC_USD"),
                    F.col("TC_USD_CRC").cast("double").alias("TC_USD_CRC"))


@register("dim_cliente")
def dim_cliente(spark, sf_dir):
    """DW3 + DW6 (distributed surrogate keys)."""
    return _w(spark, sf_dir)["dim_cliente"].select("ClienteID", "SourceSystem", "SourceKey", "Genero", "Pais",
                                                    "FechaCreacionID")


@register("dim_producto")
def dim_producto(spark, sf_dir):
    """DW4/DW5 + DW6: one row per SKU by source priority."""
    return _w(spark, sf_dir)["dim_producto"].select("ProductoID", "SKU", "Nombre", "Categoria", "EsServicio",
                                                     "SourceSystem", "SourceKey")


@register("fact_ventas")
def fact_ventas(spark, sf_dir):
    """DW7/DW9 over the whole run: sources (SE2 union) -> staging (JN1-JN3, FL1-FL4,
    SC2, SC6-SC8, SC10, SC12-SC14, SC17, SC21-SC22, SC24-SC25) -> dims (DW1-DW6) -> fact (JN4, SC26-SC28, FL6, JN5)."""
    w = _w(spark, sf_dir)
    p = w["dim_producto"].select("ProductoID", "SKU")
    return w["fact_ventas"].join(p, "ProductoID").select(
        "Fuente", "SourceKey", "TiempoID", "SKU", "Canal", F.col("Cantidad").cast("double").alias("Cantidad"),
        F.col("PrecioUnitUSD").cast("double").alias("PrecioUnitUSD"),
        F.col("TotalUSD").cast("double").alias("TotalUSD"), "MonedaOriginal")


def _batches(spark, sf_dir):
    from .etl import incremental_batches
    return incremental_batches(spark, sf_dir)


@register("incremental_load")
def incremental_load(spark, sf_dir):
    """IN1/JN5/JN6: load orders before 2001-01-01, then the rest, then re-run
    everything; the re-run must add nothing."""
    batches = _batches(spark, sf_dir)
    parts = [b.agg(F.count(F.lit(1)).alias("filas")).select(F.lit(i).alias("lote"), "filas")
             for i, b in enumerate(batches, start=1)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# ------------------------------------------------------------------ M4

@register("dw_stats")
def dw_stats(spark, sf_dir):
    """AG5: fact rows, sales and date range per source plus a total row."""
    from ..operators.quality import fact_stats
    return fact_stats(_w(spark, sf_dir)["fact_ventas"])


@register("load_diagnostics")
def load_diagnostics(spark, sf_dir):
    """AG6 + SE1: one-pass load diagnostics by reason."""
    from ..operators.quality import load_diagnostics as ld
    w = _w(spark, sf_dir)
    return ld(w["stg_orden_items"], w["dim_tiempo"], w["dim_cliente"], w["map_producto"], w["dim_producto"],
              w["fact_ventas"])


@register("fx_coverage")
def fx_coverage(spark, sf_dir):
    """AG7: CRC sales days and rows without a rate."""
    from ..operators.quality import fx_coverage as fc
    w = _w(spark, sf_dir)
    return fc(w["stg_orden_items"], w["dim_tiempo"])


# ------------------------------------------------------------------ M6

def _sales(spark, sf_dir, clients: bool = False, products: bool = False):
    """The fact, joined only with the dimensions that the filter or grouping names."""
    from ..operators.kpi import sales_base
    w = _w(spark, sf_dir)
    return sales_base(w["fact_ventas"], w["dim_cliente"] if clients else None, w["dim_producto"] if products else None)


@register("kpi_total")
def kpi_total(spark, sf_dir):
    """KP1: sales for a date range and channel (shared filter builder)."""
    from ..operators import kpi
    return kpi.total_sales(kpi.apply_filters(_sales(spark, sf_dir), date_from="1997-01-01", date_to="1999-12-31",
                                             canal="WEB"))


@register("kpi_growth_yoy")
def kpi_growth_yoy(spark, sf_dir):
    """KP2 + KP11: each month against the same month of the previous year."""
    from ..operators import kpi
    return kpi.growth_vs_last_year(_sales(spark, sf_dir))


@register("kpi_top_clients")
def kpi_top_clients(spark, sf_dir):
    """KP3: top 10 clients by sales (WN1-style top-k with key tie-break)."""
    from ..operators import kpi
    return kpi.top_clients(_sales(spark, sf_dir, clients=True), 10)


@register("kpi_top_products")
def kpi_top_products(spark, sf_dir):
    """KP4: top 10 products by sales."""
    from ..operators import kpi
    return kpi.top_products(_sales(spark, sf_dir, products=True), 10)


@register("kpi_category_share")
def kpi_category_share(spark, sf_dir):
    """KP5: sales and share per category."""
    from ..operators import kpi
    return kpi.sales_by_category(_sales(spark, sf_dir, products=True))


@register("kpi_avg_ticket")
def kpi_avg_ticket(spark, sf_dir):
    """KP7 (SC29): average ticket per order."""
    from ..operators import kpi
    return kpi.average_ticket(_sales(spark, sf_dir))


@register("kpi_active_clients")
def kpi_active_clients(spark, sf_dir):
    """KP8: active clients per year and overall."""
    from ..operators import kpi
    return kpi.active_clients(_sales(spark, sf_dir))


@register("kpi_channel_month")
def kpi_channel_month(spark, sf_dir):
    """KP9: sales by channel and month."""
    from ..operators import kpi
    return kpi.sales_by_channel_month(_sales(spark, sf_dir))


@register("kpi_mom_accum")
def kpi_mom_accum(spark, sf_dir):
    """KP10: month-over-month percent, accumulated within the year."""
    from ..operators import kpi
    return kpi.mom_accumulated(_sales(spark, sf_dir))


@register("ventas_vs_metas")
def ventas_vs_metas(spark, sf_dir):
    """KP6/KP12 + DW10 + SC40: targets = 1.10 x the same month of the previous year."""
    from ..operators import kpi
    w = _w(spark, sf_dir)
    r = kpi.sales_vs_prior_year_targets(w["fact_ventas"])
    c = w["dim_cliente"].select("ClienteID", "SourceSystem", "SourceKey")
    p = w["dim_producto"].select("ProductoID", "SKU")
    return r.join(c, "ClienteID").join(p, "ProductoID").drop("ClienteID", "ProductoID")


# ------------------------------------------------------------------ M5

def _lines(spark, sf_dir, item_col="SKU", merge_sources=False):
    from ..operators.rules import basket_lines
    w = _w(spark, sf_dir)
    return basket_lines(w["fact_ventas"], w["dim_producto"], item_col, merge_sources)


@register("baskets")
def baskets_q(spark, sf_dir):
    """AR1 + AR2 (SC29, AR6): one basket per (source, order) with its sorted SKU text."""
    from ..operators.rules import baskets
    w = _w(spark, sf_dir)
    return baskets(w["fact_ventas"], w["dim_producto"]).drop("items")


@register("baskets_merged_sources")
def baskets_merged(spark, sf_dir):
    """AR1 as the reference groups it: transaction id only (D2, SC29)."""
    from ..operators.rules import baskets
    w = _w(spark, sf_dir)
    return baskets(w["fact_ventas"], w["dim_producto"], merge_sources=True).drop("items", "Fuente")


def _itemsets_out(fi):
    from ..operators.rules import canon
    return fi.select(canon("items").alias("itemset"), F.size("items").alias("n_items"), "count",
                     F.round("support", 9).alias("support"))


@register("frequent_itemsets_sku")
def frequent_itemsets_sku(spark, sf_dir):
    """AR3 + AR4 on SKUs with the reference thresholds (FP-Growth)."""
    from ..operators.rules import frequent_itemsets, mining_baskets
    return _itemsets_out(frequent_itemsets(mining_baskets(_lines(spark, sf_dir)), 0.002, cut_lineage=False))


@register("frequent_itemsets_category")
def frequent_itemsets_category(spark, sf_dir):
    """AR3 + AR4 with the product category as the item."""
    from ..operators.rules import frequent_itemsets, mining_baskets
    return _itemsets_out(frequent_itemsets(mining_baskets(_lines(spark, sf_dir, "Categoria")), 0.002, cut_lineage=False))


def _rules_out(r):
    return r.select("Antecedent", "Consequent", F.round("support", 9).alias("support"),
                    F.round("confidence", 9).alias("confidence"), F.round("lift", 9).alias("lift"))


@register("association_rules_sku")
def association_rules_sku(spark, sf_dir):
    """AR2-AR7 (SC33, AR6) with every reference threshold (support 0.002, confidence 0.10,
    lift 1.5, item count 5); the rules table is published once (AR7, SNK5)."""
    from .etl import published_rules
    from ..operators.rules import MIN_CONFIDENCE, MIN_LIFT, MIN_SUPPORT
    return _rules_out(published_rules(spark, sf_dir, "SKU", MIN_SUPPORT, MIN_CONFIDENCE, MIN_LIFT))


def _category_rules(spark, sf_dir):
    from .etl import published_rules
    return published_rules(spark, sf_dir, "Categoria", 0.002, 0.10, 0.0)


@register("association_rules_category")
def association_rules_category(spark, sf_dir):
    """AR3-AR7 on categories: all splits incl. multi-item consequents (lift filter off)."""
    return _rules_out(_category_rules(spark, sf_dir))


@register("recommend_top5")
def recommend_top5(spark, sf_dir):
    """AR8/JN11/WN1 for every basket at once: rules whose antecedent equals the
    basket's category set, top 5 by confidence, lift, consequent text."""
    from ..operators.rules import recommend
    lines = _lines(spark, sf_dir, "Categoria")
    b = lines.groupBy("Fuente", "transaction_id").agg(F.collect_set("item").alias("items"))
    r = recommend(b, _category_rules(spark, sf_dir), 5, "items", ("Fuente", "transaction_id"))
    return r.select("Fuente", "transaction_id", "Consequent", "rank")


@register("codes_to_skus")
def codes_to_skus_q(spark, sf_dir):
    """JN12: Mongo product codes of every Mongo order line -> official SKU."""
    from ..operators.rules import codes_to_skus
    from ..sources import fixtures
    w = _w(spark, sf_dir)
    t = fixtures.load_tables(spark, sf_dir, ["lineitem", "orders"])
    li = t["lineitem"].join(t["orders"], F.col("l_orderkey") == F.col("o_orderkey"))
    codes = (li.where(fixtures.src_index(F.col("o_custkey")) == 3)
             .select(F.concat(F.lit("MN-"), (F.col("l_partkey") + 4000).cast("string")).alias("code")).distinct())
    return codes_to_skus(codes, w["map_producto"], w["dim_producto"], "mongo").select("code", "SKU")


# ------------------------------------------------------------------ M7

def _src(spark, sf_dir):
    from .etl import source_tables
    return source_tables(spark, sf_dir)


@register("list_ordenes")
def list_ordenes(spark, sf_dir):
    """FL12 + FL14 + SO1: filtered SQL Server orders, sorted by total desc, page 2 of 20."""
    from ..operators.listing import PageSpec, apply_filter_spec, page
    o = _src(spark, sf_dir)["mssql"]["Orden"]
    f = apply_filter_spec(o, {"Canal": ("eq", "WEB"), "Total": ("gte", 1000),
                              "Fecha": ("between", ("1996-01-01", "1998-12-31 23:59:59"))})
    out = page(f, "OrdenId", PageSpec(page=2, limit=20, sort_by="Total", sort_order="desc"),
               ("Total", "Fecha", "ClienteId"))
    return out.select("OrdenId", "ClienteId", "Fecha", "Canal", F.col("Total").cast("double").alias("Total"))


@register("list_ordenes_count")
def list_ordenes_count(spark, sf_dir):
    """SO1/AG17: total rows and pages of the same filter."""
    from ..operators.listing import apply_filter_spec, page_count
    o = _src(spark, sf_dir)["mssql"]["Orden"]
    f = apply_filter_spec(o, {"Canal": ("eq", "WEB"), "Total": ("gte", 1000),
                              "Fecha": ("between", ("1996-01-01", "1998-12-31 23:59:59"))})
    return page_count(f, 20)


@register("list_clientes")
def list_clientes(spark, sf_dir):
    """FL10 + SO3: clients by country and gender, name contains, sorted by name."""
    from ..operators.listing import PageSpec, apply_filter_spec, page
    c = _src(spark, sf_dir)["mssql"]["Cliente"]
    f = apply_filter_spec(c, {"Pais": ("eq", "spain"), "Genero": ("eq", "Femenino"),
                              "Nombre": ("contains", "customer#0000")}, case_insensitive=True)
    return page(f, "ClienteId", PageSpec(page=1, limit=20, sort_by="Nombre"), ("Nombre",)).select(
        "ClienteId", "Nombre", "Pais")


@register("orden_completa")
def orden_completa_q(spark, sf_dir):
    """JN16 (SC39): the Supabase complete-order view over all orders."""
    from ..operators.orders import orden_completa
    s = _src(spark, sf_dir)["supabase"]
    v = orden_completa(s["orden"], s["orden_detalle"], s["producto"], s["cliente"])
    return v.select("orden_id", "orden_detalle_id", "producto_nombre", "cliente_nombre", "cantidad",
                    F.col("precio_unit").cast("double").alias("precio_unit"),
                    F.col("subtotal").cast("double").alias("subtotal"))


@register("orders_nested")
def orders_nested(spark, sf_dir):
    """JN13 + AG16 + AG13 (SC39): graph orders rebuilt with client and item array."""
    from ..operators.orders import graph_order_lines, nested_orders
    g = _src(spark, sf_dir)["neo4j"]
    lines = graph_order_lines(g["Orden"], g["REALIZO"], g["CONTIENE"], g["Producto"], g["PERTENECE_A"],
                              g["Categoria"])
    n = nested_orders(lines, ["id", "cliente_id"], ["producto_id", "cantidad", "precio_unit", "categoria"], "seq")
    return n.select(F.col("id").alias("orden_id"), "cliente_id", "n_items",
                    F.col("items_total").cast("double").alias("items_total"),
                    F.try_element_at("items", F.lit(1))["producto_id"].alias("primer_producto"))


@register("merge_repeated_products")
def merge_repeated_products_q(spark, sf_dir):
    """AG15: repeated product lines of one graph order merged."""
    from ..operators.orders import merge_repeated_products
    e = _src(spark, sf_dir)["neo4j"]["CONTIENE"]
    return merge_repeated_products(e, "from_id", "to_id", "seq").select(
        F.col("from_id").alias("orden_id"), F.col("to_id").alias("producto_id"), "cantidad", "precio_unit")


@register("order_total_check")
def order_total_check(spark, sf_dir):
    """AG14: MySQL text totals vs the sum of their parsed lines."""
    from ..functions.clean import parse_amount
    from ..operators.orders import total_mismatches
    s = _src(spark, sf_dir)["mysql"]
    o = s["Orden"].select(F.col("id").alias("orden_id"), parse_amount(F.col("total")).alias("total"))
    d = s["OrdenDetalle"]
    lt = (F.col("cantidad") * parse_amount(F.col("precio_unit"))).cast("decimal(18,2)")
    j = total_mismatches(o, d, "orden_id", "total", lt, keep_all=True).where(~F.col("sin_lineas"))
    return j.agg(F.count(F.lit(1)).alias("ordenes_revisadas"),
                  F.count(F.when(F.col("descuadre"), 1)).alias("descuadres"))


def _supabase_change_events(s):
    o = s["orden"].withColumn("_ok", F.regexp_extract("orden_id", r"(\d{12})$", 1).cast("long"))
    d = s["orden_detalle"]
    items = (d.groupBy("orden_id").agg(F.collect_list(F.struct(
        "producto_id", (F.col("cantidad") + 1).alias("cantidad"), "precio_unit")).alias("items")))
    deletes = o.where(F.col("_ok") % 11 == 0).select("orden_id", F.lit("delete").alias("op"))
    updates = (o.where((F.col("_ok") % 13 == 0) & (F.col("_ok") % 11 != 0)).join(items, "orden_id")
               .select("orden_id", F.lit("update").alias("op"), "cliente_id", "fecha", "canal", "moneda",
                       "total", "items"))
    unknown = o.where(F.col("_ok") % 101 == 0).select(
        F.concat(F.lit("99999999-"), F.col("orden_id")).alias("orden_id"), F.lit("delete").alias("op"))
    # new orders copy an existing one's lines; every 17th is tried under the id it already has
    creates = (o.where((F.col("_ok") % 19 == 0) & (F.col("_ok") % 11 != 0)).join(items, "orden_id")
               .select(F.concat(F.lit("77777777-"), F.col("orden_id")).alias("orden_id"), F.lit("create").alias("op"), "cliente_id",
                       "fecha", "canal", "moneda", "total", "items"))
    again = (o.where((F.col("_ok") % 17 == 0) & (F.col("_ok") % 11 != 0) & (F.col("_ok") % 13 != 0))
             .select("orden_id", F.lit("create").alias("op")))
    bad_op = o.where(F.col("_ok") % 103 == 0).select(F.concat(F.lit("88888888-"), F.col("orden_id")).alias("orden_id"), F.lit("merge").alias("op"))
    ev = deletes
    for part in (updates, unknown, creates, again, bad_op):
        ev = ev.unionByName(part, allowMissingColumns=True)
    return ev.withColumn("seq", F.lit(1))


@register("orders_after_changes")
def orders_after_changes(spark, sf_dir):
    """CH1-CH3: a batch of create / update (replace lines) / delete events applied; line ids and totals of what it wrote."""
    from ..operators.orders import apply_order_changes
    s = _src(spark, sf_dir)["supabase"]
    orders, lines, _ = apply_order_changes(s["orden"], s["orden_detalle"], _supabase_change_events(s))
    per = lines.groupBy("orden_id").agg(F.count(F.lit(1)).alias("n_lineas"), F.sum("cantidad").cast("long").alias("unidades"),
                                        F.sum((F.col("cantidad") * F.col("precio_unit")).cast("decimal(28,6)")).alias("_t"),
                                        F.countDistinct("orden_detalle_id").alias("ids_linea"))
    # an order that the batch wrote carries the total of its lines
    return orders.join(per, "orden_id").select(
        "orden_id", "n_lineas", "unidades", "ids_linea",
        F.when(F.abs(F.col("total").cast("double") - F.col("_t").cast("double")) <= 0.01, True).otherwise(False).alias("cuadra"))


@register("order_change_rejects")
def order_change_rejects(spark, sf_dir):
    """CH1-CH3: events that cannot be applied (unknown order, existing order, unknown op) by reason."""
    from ..operators.orders import apply_order_changes
    s = _src(spark, sf_dir)["supabase"]
    _, _, rej = apply_order_changes(s["orden"], s["orden_detalle"], _supabase_change_events(s))
    return rej.groupBy("op", "motivo").agg(F.count(F.lit(1)).alias("filas"))


@register("new_order_ids")
def new_order_ids(spark, sf_dir):
    """CH4/WN4 (SC37): one new graph order per client, ids after the current maximum."""
    from ..operators.orders import next_order_ids
    g = _src(spark, sf_dir)["neo4j"]
    new = g["Cliente"].select(F.col("id").alias("cliente_id"))     # one new order per graph client
    return next_order_ids(g["Orden"], new, ["cliente_id"]).select("cliente_id", "nuevo_id")


@register("include_order_lines")
def include_order_lines(spark, sf_dir):
    """JN20: orders with their lines and products nested (?include=)."""
    s = _src(spark, sf_dir)["mssql"]
    d = s["OrdenDetalle"].join(s["Producto"].select("ProductoId", "SKU"), "ProductoId", "left")
    n = (s["Orden"].join(d, "OrdenId", "left").groupBy("OrdenId")
         .agg(F.collect_list(F.when(F.col("OrdenDetalleId").isNotNull(),
                                    F.struct("OrdenDetalleId", "SKU", "Cantidad"))).alias("lineas")))
    return n.select("OrdenId", F.size("lineas").alias("n_lineas"),
                    F.array_join(F.array_sort(F.filter(F.transform("lineas", lambda x: x["SKU"]),
                                                       lambda v: v.isNotNull())), ", ").alias("skus"))


@register("bulk_violations")
def bulk_violations(spark, sf_dir):
    """FL15/FL16 + JN19: rule violations of bulk sheets built from the sources."""
    from ..operators import bulk
    s = _src(spark, sf_dir)
    my = s["mysql"]
    cl = my["Cliente"].withColumn("_row", F.col("id").cast("long"))
    orden = (my["Orden"].join(my["Cliente"].select(F.col("id").alias("cliente_id"), "correo"), "cliente_id", "left")
             .withColumn("_row", F.col("id").cast("long")))
    from ..operators.keys import global_row_number
    # JN19: a line names its order by the 1-based row position of the order sheet
    idx = global_row_number(s["mssql"]["Orden"].select("OrdenId"), ["OrdenId"], "OrdenIndex")
    lines = (s["mssql"]["OrdenDetalle"].withColumn("_row", F.col("OrdenDetalleId").cast("long"))
             .join(idx, "OrdenId", "left")
             .join(s["mssql"]["Producto"].select("ProductoId", "SKU"), "ProductoId", "left"))
    parts = [(n, bulk.sheet_violations(df, rules)) for n, df, rules in [
        ("Cliente", cl, bulk.client_rules_mysql()), ("Orden", orden, bulk.order_rules_mysql()),
        ("OrdenDetalle", lines, bulk.line_rules_mssql())]]
    u = None
    for n, v in parts:
        x = v.select(F.lit(n).alias("hoja"), F.explode("violaciones").alias("regla"))
        u = x if u is None else u.unionByName(x)
    return u.groupBy("hoja", "regla").agg(F.count(F.lit(1)).alias("filas"))


@register("bulk_violations_all")
def bulk_violations_all(spark, sf_dir):
    """FL15/FL16 + JN19: rule violations of all eight bulk sheets (four a relational source) built from the sources."""
    from ..operators import bulk
    from ..operators.keys import global_row_number
    s = _src(spark, sf_dir)
    ms, my = s["mssql"], s["mysql"]
    ms_orden = ms["Orden"].join(ms["Cliente"].select("ClienteId", "Email"), "ClienteId", "left")
    my_orden = my["Orden"].join(my["Cliente"].select(F.col("id").alias("cliente_id"), "correo"), "cliente_id", "left")
    # JN19: a line names its order by the 1-based row position of the order sheet
    ms_idx = global_row_number(ms["Orden"].select("OrdenId"), ["OrdenId"], "OrdenIndex")
    my_idx = global_row_number(my["Orden"].select(F.col("id").alias("orden_id")), ["orden_id"], "OrdenIndex")
    ms_lines = (ms["OrdenDetalle"].join(ms_idx, "OrdenId", "left")
                .join(ms["Producto"].select("ProductoId", "SKU"), "ProductoId", "left"))
    my_lines = (my["OrdenDetalle"].join(my_idx, "orden_id", "left")
                .join(my["Producto"].select(F.col("id").alias("producto_id"), "codigo_alt"), "producto_id", "left"))
    u = None
    for fuente, hoja, df, row, rules in [
            ("mssql", "Cliente", ms["Cliente"], "ClienteId", bulk.client_rules_mssql()),
            ("mssql", "Producto", ms["Producto"], "ProductoId", bulk.product_rules_mssql()),
            ("mssql", "Orden", ms_orden, "OrdenId", bulk.order_rules_mssql()),
            ("mssql", "OrdenDetalle", ms_lines, "OrdenDetalleId", bulk.line_rules_mssql()),
            ("mysql", "Cliente", my["Cliente"], "id", bulk.client_rules_mysql()),
            ("mysql", "Producto", my["Producto"], "id", bulk.product_rules_mysql()),
            ("mysql", "Orden", my_orden, "id", bulk.order_rules_mysql()),
            ("mysql", "OrdenDetalle", my_lines, "id", bulk.line_rules_mysql())]:
        x = bulk.sheet_violations(df, rules, row).select(
            F.lit(fuente).alias("fuente"), F.lit(hoja).alias("hoja"), F.explode("violaciones").alias("regla"))
        u = x if u is None else u.unionByName(x)
    return u.groupBy("fuente", "hoja", "regla").agg(F.count(F.lit(1)).alias("filas"))


@register("bulk_upsert")
def bulk_upsert(spark, sf_dir):
    """BL1 + AG19: upload of clients upserted by email into the SQL Server clients."""
    from ..operators import bulk
    from ..sources import fixtures
    s = _src(spark, sf_dir)
    stored = s["mssql"]["Cliente"]
    c = fixtures.read_table(spark, sf_dir, "customer")
    ck = F.col("c_custkey")
    email = F.when((ck % 5 == 1) & (ck % 7 == 0), F.lit(None)).otherwise(fixtures.email_of(ck))
    # every SQL Server client re-uploaded with a new name (updates by email) plus
    # every MySQL client (new emails or none: inserts)
    up = (c.where((ck % 5 == 0) | (ck % 5 == 1))
          .select(ck.alias("_row"), F.upper("c_name").alias("Nombre"), email.alias("Email"),
                  F.lit("Femenino").alias("Genero"), F.lit("CR").alias("Pais"),
                  F.lit("2001-01-01").cast("date").alias("FechaRegistro")))
    table, actions = bulk.upsert_clients_by_email(stored, up)
    a = actions.groupBy("accion").agg(F.count(F.lit(1)).alias("filas"))
    return a.unionByName(table.agg(F.count(F.lit(1)).alias("filas")).select(F.lit("total_tabla").alias("accion"), "filas"))


# ------------------------------------------------------------------ M8

def _stream_dir(spark, name):
    import uuid
    from ..session import work_path
    return work_path(spark, f"stream/{name}-{uuid.uuid4().hex[:8]}")


@register("stream_fact_load")
def stream_fact_load_q(spark, sf_dir):
    """SM1: staged lines streamed year by year into the fact (availableNow)."""
    from ..streaming.ingest import stream_fact_load, write_lines_by_year
    w = _w(spark, sf_dir)
    base = _stream_dir(spark, "fact")
    write_lines_by_year(w["stg_orden_items"], f"{base}/in")
    stream_fact_load(spark, f"{base}/in", w, f"{base}/fact", f"{base}/ckpt")
    f = spark.read.parquet(f"{base}/fact")
    return f.groupBy("Fuente").agg(F.count(F.lit(1)).alias("filas"), money(F.sum("TotalUSD")).alias("ventas_usd"))


@register("stream_dedup")
def stream_dedup_q(spark, sf_dir):
    """SM2: every line sent twice; each micro-batch keeps what was not written before."""
    from ..streaming.ingest import dedup_stream, write_lines_by_year
    w = _w(spark, sf_dir)
    base = _stream_dir(spark, "dedup")
    items = w["stg_orden_items"]
    write_lines_by_year(items.unionByName(items), f"{base}/in")
    dedup_stream(spark, f"{base}/in", f"{base}/out", f"{base}/ckpt")
    return spark.read.parquet(f"{base}/out").groupBy("source_system").agg(F.count(F.lit(1)).alias("filas"))


@register("stream_daily_sales")
def stream_daily_sales_q(spark, sf_dir):
    """SM3: purchase events per 1-day tumbling window with a watermark."""
    from ..streaming.ingest import daily_sales_stream, read_latest_by_key
    base = _stream_dir(spark, "daily")
    daily_sales_stream(spark, f"{sf_dir.rstrip('/')}/events.parquet", f"{base}/out", f"{base}/ckpt")
    r = read_latest_by_key(spark, f"{base}/out", "dia")
    return r.select("dia", "compras", F.round("valor", 4).alias("valor"))


# ----------------------------------------------------- sources and cleaning

@register("extraction_counts")
def extraction_counts(spark, sf_dir):
    """SRC10: rows per (source, entity) over every landed source table."""
    from ..sources.readers import extraction_counts as ec
    return ec(_src(spark, sf_dir))


@register("mongo_item_count")
def mongo_item_count(spark, sf_dir):
    """SRC4: nested items of the document source (null array counts 0)."""
    from ..sources.readers import item_count
    return item_count(_src(spark, sf_dir)["mongo"]["ordenes"])


@register("graph_triplets")
def graph_triplets_q(spark, sf_dir):
    """SRC5: CONTIENE edges with both end nodes' properties."""
    from ..sources.readers import graph_triplets
    g = _src(spark, sf_dir)["neo4j"]
    t = graph_triplets(g["CONTIENE"], g["Orden"], g["Producto"])
    return t.select(F.col("from_id").alias("orden_id"), F.col("to_id").alias("producto_id"), "seq",
                    F.to_date("from_fecha").alias("fecha"), F.col("to_nombre").alias("producto_nombre"))


@register("fx_feed_parse")
def fx_feed_parse(spark, sf_dir):
    """SRC6 + JN9 + SNK4: monthly XML documents of buy and sell series parsed
    with regexp_extract_all / arrays_zip / try_cast, paired by date, unpivoted."""
    from ..operators.merge import fx_rows
    from ..sources import fixtures
    from ..sources.readers import fx_feed_pair, parse_fx_feed
    feed = fixtures.fixture_rates(spark, sf_dir)

    def docs(col):
        rec = F.concat(F.lit("<INGC011_CAT_INDICADORECONOMIC><DES_FECHA>"),
                       F.date_format("fecha", "yyyy-MM-dd'T'00:00:00-06:00"), F.lit("</DES_FECHA><NUM_VALOR>"),
                       F.col(col).cast("string"), F.lit("</NUM_VALOR></INGC011_CAT_INDICADORECONOMIC>"))
        return (feed.groupBy(F.date_format("fecha", "yyyy-MM").alias("mes"))
                .agg(F.concat_ws("", F.collect_list(rec)).alias("xml")))
    pair = fx_feed_pair(parse_fx_feed(docs("compra")), parse_fx_feed(docs("venta")))
    return fx_rows(pair).select("fecha", "de", "a", F.col("tasa").cast("double").alias("tasa"))


@register("clean_amounts")
def clean_amounts(spark, sf_dir):
    """SC8 on every MySQL line price text (three formats)."""
    from ..functions.clean import parse_amount
    d = _src(spark, sf_dir)["mysql"]["OrdenDetalle"]
    return d.select("id", parse_amount(F.col("precio_unit")).alias("precio_unit_num"))


@register("clean_dates")
def clean_dates(spark, sf_dir):
    """SC10 on every MySQL client creation text (two formats)."""
    from ..functions.clean import parse_date_mysql
    c = _src(spark, sf_dir)["mysql"]["Cliente"]
    return c.select("id", parse_date_mysql(F.col("created_at")).alias("fecha"))


@register("country_iso")
def country_iso(spark, sf_dir):
    """SC30: distinct client country texts -> ISO code (broadcast contains-join)."""
    from ..functions.country import country_codes, country_table
    s = _src(spark, sf_dir)
    u = s["supabase"]["cliente"].select("pais").unionByName(s["neo4j"]["Cliente"].select("pais")).distinct()
    return country_codes(u, "pais", "codigo", country_table(spark))


@register("lookup_by_name")
def lookup_by_name(spark, sf_dir):
    """ER6: official SKU of each MySQL product by (name, category)."""
    from ..operators.equivalence import lookup_by_name as lk
    p = _src(spark, sf_dir)["mysql"]["Producto"]
    return lk(p, _w(spark, sf_dir)["eq_map"], "nombre", "categoria").select("codigo_alt", "sku_oficial")


@register("collapsed_items")
def collapsed_items_q(spark, sf_dir):
    """D12: clean lines dropped because the item key is the product id."""
    from ..operators.staging import collapsed_items
    return collapsed_items(_w(spark, sf_dir)["items_all"])


@register("missing_product_refs")
def missing_product_refs(spark, sf_dir):
    """JN17/SE3/SE4: distinct products named by graph order edges that have no node."""
    from ..operators.orders import missing_references
    g = _src(spark, sf_dir)["neo4j"]
    return missing_references(g["CONTIENE"].select(F.col("to_id").alias("producto_id")),
                              g["Producto"], "producto_id", "id")


@register("duplicate_products_in_orders")
def duplicate_products_in_orders(spark, sf_dir):
    """FL18: document orders that list a product twice."""
    from ..operators.orders import duplicate_products
    o = _src(spark, sf_dir)["mongo"]["ordenes"]
    return duplicate_products(o.where(F.col("items").isNotNull())).select(F.col("_id").alias("orden_id"))


@register("rate_availability")
def rate_availability_q(spark, sf_dir):
    """AG9: rates loaded for 1998."""
    from ..operators.quality import rate_availability
    return rate_availability(_w(spark, sf_dir)["tipo_cambio"], "1998-01-01", "1998-12-31")


@register("fx_status")
def fx_status_q(spark, sf_dir):
    """AG11 + SC36 + AG10: status as of the last order date of the data."""
    from ..operators.quality import rate_status
    w = _w(spark, sf_dir)
    today = w["stg_orden_items"].agg(F.max("fecha_dt")).first()[0]
    return rate_status(w["tipo_cambio"], today)


# ----------------------------------------------------- more reports and lists

@register("dw_counts")
def dw_counts_q(spark, sf_dir):
    """AG4 + AG10: rows per warehouse table (the rate row count included)."""
    from ..operators.quality import dw_counts
    w = _w(spark, sf_dir)
    return dw_counts({k: w[k] for k in ["dim_tiempo", "dim_cliente", "dim_producto", "fact_ventas", "map_producto",
                                         "stg_clientes", "stg_orden_items", "tipo_cambio"]})


@register("loaded_by_source")
def loaded_by_source_q(spark, sf_dir):
    """AG8: rows appended per source by the second incremental batch."""
    from ..operators.quality import loaded_by_source
    return loaded_by_source(_batches(spark, sf_dir)[1])


@register("orders_newest_page")
def orders_newest_page(spark, sf_dir):
    """SO2: Supabase orders newest first (id as tie-break), first page of 20."""
    from ..operators.listing import PageSpec, page
    o = _src(spark, sf_dir)["supabase"]["orden"]
    return page(o, "orden_id", PageSpec(page=1, limit=20, sort_by="fecha", sort_order="desc"), ("fecha",)).select(
        "orden_id", "fecha", F.col("total").cast("double").alias("total"))


@register("list_orden_detalles")
def list_orden_detalles(spark, sf_dir):
    """FL13: order lines by quantity and discount ranges, priciest first, page 1."""
    from ..operators.listing import PageSpec, apply_filter_spec, page
    d = _src(spark, sf_dir)["mssql"]["OrdenDetalle"]
    f = apply_filter_spec(d, {"Cantidad": ("between", (10, 20)), "DescuentoPct": ("gte", 5)})
    return page(f, "OrdenDetalleId", PageSpec(page=1, limit=20, sort_by="PrecioUnit", sort_order="desc"),
                ("PrecioUnit", "Cantidad")).select("OrdenDetalleId", "Cantidad",
                                                   F.col("PrecioUnit").cast("double").alias("PrecioUnit"),
                                                   F.col("DescuentoPct").cast("double").alias("DescuentoPct"))


@register("list_productos")
def list_productos(spark, sf_dir):
    """FL11: products whose name contains a word, exact category, by name."""
    from ..operators.listing import PageSpec, apply_filter_spec, page
    p = _src(spark, sf_dir)["mssql"]["Producto"]
    f = apply_filter_spec(p, {"Nombre": ("contains", "widget"), "Categoria": ("eq", "LARGE")})
    return page(f, "ProductoId", PageSpec(page=1, limit=20, sort_by="Nombre"), ("Nombre", "SKU")).select(
        "ProductoId", "SKU", "Nombre")


@register("order_payload_violations")
def order_payload_violations(spark, sf_dir):
    """FL17: document orders checked against the order payload rules."""
    from ..functions.validate import violations
    from ..operators.orders import payload_rules
    o = _src(spark, sf_dir)["mongo"]["ordenes"]
    v = o.select(F.explode(violations(payload_rules("mongo"))).alias("regla"))
    return v.groupBy("regla").agg(F.count(F.lit(1)).alias("filas"))


@register("product_categories")
def product_categories(spark, sf_dir):
    """JN15: graph path Producto -> Categoria."""
    g = _src(spark, sf_dir)["neo4j"]
    c = g["Categoria"].select(F.col("id").alias("to_id"), F.col("nombre").alias("_cat"))
    e = g["PERTENECE_A"].join(c, "to_id")
    p = g["Producto"].select("id", "nombre")
    return p.join(e, p.id == e.from_id).select(F.col("id").alias("producto_id"), "nombre",
                                                F.col("_cat").alias("categoria"))


@register("sku_by_name_fallback")
def sku_by_name_fallback(spark, sf_dir):
    """WN2/JN21: each document-source product resolved through the bridge by
    (name, category) with source priority and newest row first."""
    from ..operators.equivalence import best_bridge_by_name
    p = _src(spark, sf_dir)["mongo"]["productos"]
    return best_bridge_by_name(p, _w(spark, sf_dir)["map_producto"], "nombre", "categoria").select(
        "codigo_mongo", "sku_por_nombre")


@register("bulk_sheets_roundtrip")
def bulk_sheets_roundtrip(spark, sf_dir):
    """SRC7: MySQL-shaped bulk sheets written as one CSV per sheet, read back
    with per-sheet typed coercion (bad cells -> null, raw text kept)."""
    from ..sources.readers import read_bulk
    s = _src(spark, sf_dir)["mysql"]
    base = _stream_dir(spark, "bulk")
    orden = s["Orden"].join(s["Cliente"].select(F.col("id").alias("cliente_id"), "correo"), "cliente_id", "left")
    sheets = {"Cliente": s["Cliente"].select("nombre", "correo", "genero", "pais", "created_at"),
              "Producto": s["Producto"].select("codigo_alt", "nombre", "categoria"),
              "Orden": orden.select("correo", "fecha", "canal", "moneda", "total")}
    for name, df in sheets.items():      # the OrdenDetalle sheet is absent on purpose
        df.write.option("header", True).csv(f"{base}/{name}.csv")
    got = read_bulk(spark, base, "mysql", "csv")
    parts = []
    for name, df in got.items():
        if df is None:
            parts.append(spark.createDataFrame([(name, 0, 0)], "hoja string, filas long, correo_nulo long"))
            continue
        nul = F.count(F.when(F.col("correo").isNull(), 1)) if "correo" in df.columns else F.lit(0).cast("long")
        parts.append(df.agg(F.count(F.lit(1)).alias("filas"), nul.alias("correo_nulo"))
                     .select(F.lit(name).alias("hoja"), "filas", "correo_nulo"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("fx_new_days")
def fx_new_days(spark, sf_dir):
    """IN2: with rates loaded up to 1997, the feed days still to load."""
    from ..operators.merge import upsert_rates
    from ..operators.warehouse import new_rate_days
    from ..sources import fixtures
    feed = fixtures.fixture_rates(spark, sf_dir)
    loaded = upsert_rates(None, feed.where(F.col("fecha") < F.lit("1998-01-01").cast("date")))
    n = new_rate_days(feed, loaded)
    return n.agg(F.count(F.lit(1)).alias("dias"), F.min("fecha").alias("desde"), F.max("fecha").alias("hasta"))


@register("bridge_validation")
def bridge_validation(spark, sf_dir):
    """JN22: document products' (SKU, name, category) checked against the bridge."""
    from ..functions.clean import normalize_sku
    from ..operators.orders import validate_against_bridge
    p = _src(spark, sf_dir)["mongo"]["productos"].withColumn("_sku", normalize_sku(F.col("equivalencias.sku")))
    v = validate_against_bridge(p, _w(spark, sf_dir)["map_producto"], "_sku", "nombre", "categoria")
    return v.groupBy("valido").agg(F.count(F.lit(1)).alias("filas"))


@register("order_items_json")
def order_items_json(spark, sf_dir):
    """SC35: order items carried as JSON text, parsed back and exploded."""
    from ..functions.clean import items_from_json
    o = _src(spark, sf_dir)["mongo"]["ordenes"].select("_id", F.to_json("items").alias("items_json"))
    it = o.select("_id", F.explode(items_from_json(F.col("items_json"),
                                                   "producto_id string, cantidad int, precio_unit long")).alias("it"))
    return it.agg(F.count(F.lit(1)).alias("items"), F.sum("it.cantidad").alias("unidades"),
                  F.countDistinct("_id").alias("ordenes"))


@register("run_gate")
def run_gate(spark, sf_dir):
    """DW8 + AG18: should the load run?  Last loads = the fact after the first
    incremental batch and the full client dimension; staging maxima from the
    staged tables; 'now' = the newest staged order date."""
    from ..operators.warehouse import should_run
    w = _w(spark, sf_dir)
    items = w["stg_orden_items"]
    b1 = _batches(spark, sf_dir)[0]
    as_ts = lambda c: F.to_timestamp(F.col(c).cast("string"), "yyyyMMdd")
    last = (b1.agg(F.max(as_ts("TiempoID")).alias("last_ts")).select(F.lit("fact_ventas").alias("table"), "last_ts")
            .unionByName(w["dim_cliente"].agg(F.max(as_ts("FechaCreacionID")).alias("last_ts"))
                         .select(F.lit("dim_cliente").alias("table"), "last_ts")))
    stg = (items.agg(F.max(F.col("fecha_dt").cast("timestamp")).alias("max_ts"))
           .select(F.lit("fact_ventas").alias("table"), "max_ts")
           .unionByName(w["stg_clientes"].agg(F.max(F.col("fecha_creado_dt").cast("timestamp")).alias("max_ts"))
                        .select(F.lit("dim_cliente").alias("table"), "max_ts")))
    now = items.agg(F.max("fecha_dt")).first()[0]
    return should_run(last, stg, now)


@register("max_existing_sku")
def max_existing_sku_q(spark, sf_dir):
    """ER5 + FL8 + SC18: highest SKU number in the built bridge (the start
    point of the next run's generated SKUs)."""
    from ..operators.equivalence import max_existing_sku
    return max_existing_sku(_w(spark, sf_dir)["map_producto"])


@register("bulk_orders_fk")
def bulk_orders_fk(spark, sf_dir):
    """JN18 + WN3: the MySQL order sheet's emails resolved to
    client ids (latest id per email, duplicates allowed); any unresolved
    order rejects the whole upload."""
    from ..operators.bulk import resolve_emails
    s = _src(spark, sf_dir)["mysql"]
    sheet = s["Orden"].join(s["Cliente"].select(F.col("id").alias("cliente_id"), "correo"), "cliente_id", "left") \
        .select("correo", "fecha", "total")
    stored = s["Cliente"].select("id", "correo")
    r = resolve_emails(sheet, None, stored, "correo", "id", latest=True)
    c = r.agg(F.count(F.col("cliente_id")).alias("resueltas"),
              F.count(F.when(F.col("cliente_id").isNull(), 1)).alias("sin_resolver"))
    return c.withColumn("carga_aceptada", F.col("sin_resolver") == 0)


@register("sql_clean_functions")
def sql_clean_functions(spark, sf_dir):
    """UD4: the cleaning rules called from SQL over the landed MySQL clients
    and order lines (session SQL functions, inlined as native expressions)."""
    from ..functions.sql_functions import register_sql_functions
    register_sql_functions(spark)
    s = _src(spark, sf_dir)["mysql"]
    s["Cliente"].createOrReplaceTempView("sm_mysql_cliente")
    s["Orden"].createOrReplaceTempView("sm_mysql_orden")
    return spark.sql("""
        SELECT 'genero' AS campo, sm_gender(genero) AS valor, count(*) AS filas FROM sm_mysql_cliente GROUP BY 2
        UNION ALL
        SELECT 'canal' AS campo, sm_channel(canal) AS valor, count(*) AS filas FROM sm_mysql_orden GROUP BY 2
    """)


# ------------------------------------------------- cleaning helpers on messy text made from the orders

def _orders_text(spark, sf_dir):
    from ..sources import fixtures
    return fixtures.read_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("long").alias("id"), F.col("o_orderdate").cast("date").alias("d"))


@register("safe_casts")
def safe_casts(spark, sf_dir):
    """SC9: decimal, int and float casts of order numbers written with commas, blanks, letters or nothing."""
    from ..functions import clean
    o = _orders_text(spark, sf_dir)
    k, kind = F.col("id"), F.col("id") % 4
    text = (F.when(kind == 0, F.concat((k / 1000).cast("long").cast("string"), F.lit(","), F.lpad((k % 1000).cast("string"), 3, "0"), F.lit(".25")))
            .when(kind == 1, F.concat(F.lit("x"), k.cast("string"))).when(kind == 2, F.concat(F.lit(" "), k.cast("string"), F.lit(" "))).otherwise(F.lit("")))
    o = o.withColumn("t", text)
    return o.select("id", clean.safe_decimal("t", default=0).cast("double").alias("decimal_0"), clean.safe_int("t", default=-1).alias("entero"),
                    clean.safe_float("t").alias("flotante"))


@register("safe_dates")
def safe_dates(spark, sf_dir):
    """SC11 + SC31: order dates written in the five accepted formats or not as a date, back to one text form."""
    from ..functions import clean
    o = _orders_text(spark, sf_dir)
    formats = ["yyyy-MM-dd", "yyyy-MM-dd 00:00:00", "yyyy/MM/dd", "dd/MM/yyyy", "dd-MM-yyyy"]
    text = F.lit("n/a")
    for i, f in enumerate(formats):
        text = F.when(F.col("id") % 6 == i, F.date_format("d", f)).otherwise(text)
    return o.select("id", clean.date_text(clean.safe_date(text)).alias("fecha"))


@register("split_lists")
def split_lists(spark, sf_dir):
    """SC32: delimited lists with blanks, gaps and repeats -> trimmed distinct values."""
    from ..functions import clean
    a, b = F.concat(F.lit("a"), (F.col("id") % 3).cast("string")), F.concat(F.lit("b"), (F.col("id") % 5).cast("string"))
    v = clean.split_list(F.concat(F.lit(" "), a, F.lit(", ,"), b, F.lit(" ,,"), a))
    return _orders_text(spark, sf_dir).select("id", F.array_join(v, "|").alias("valores"), F.size(v).alias("n"))


@register("object_ids")
def object_ids(spark, sf_dir):
    """SC38: quoted, padded and malformed object ids -> 24 hex digits or null."""
    from ..functions import clean
    h = F.lpad(F.hex(F.col("id")), 24, "0")
    text = (F.when(F.col("id") % 3 == 0, F.concat(F.lit('"'), h, F.lit('"'))).when(F.col("id") % 3 == 1, F.concat(F.lit("  "), h))
            .otherwise(F.concat(F.lit("zz"), h)))
    return _orders_text(spark, sf_dir).select("id", clean.clean_object_id(text).alias("objeto"))


@register("valid_order_ids")
def valid_order_ids(spark, sf_dir):
    """FL9: ids of the shape ORD-<digits> or O<digits>, whole string only."""
    from ..operators.orders import valid_order_ids as keep_valid
    k = F.col("id").cast("string")
    text = (F.when(F.col("id") % 4 == 0, F.concat(F.lit("ORD-"), k)).when(F.col("id") % 4 == 1, F.concat(F.lit("O"), k))
            .when(F.col("id") % 4 == 2, F.concat(F.lit("xORD-"), k)).otherwise(F.concat(F.lit("ORD-"), k, F.lit("b"))))
    return keep_valid(_orders_text(spark, sf_dir).withColumn("orden", text), "orden").select("id", "orden")


@register("rate_backfill")
def rate_backfill(spark, sf_dir):
    """IN3: three years of history are loaded only when under 100 rates exist; asked for the rates
    of the first month and for all of them."""
    from ..operators.warehouse import backfill_range
    t = _w(spark, sf_dir)["tipo_cambio"]
    some = t.where(F.col("fecha") < F.add_months(F.lit("1992-01-01").cast("date"), 1))
    return backfill_range(some, "1998-08-02").withColumn("caso", F.lit("enero")).unionByName(
        backfill_range(t, "1998-08-02").withColumn("caso", F.lit("todas")))


# ------------------------------------------------------------------ features over all the sources they cover

def _union(parts):
    out = None
    for x in parts:
        out = x if out is None else out.unionByName(x)
    return out


def _product_names(s):
    """(fuente, codigo, nombre, categoria) of every source's products, by the code the bridge knows them by."""
    code = {"mssql": F.col("ProductoId").cast("string"), "mysql": F.col("codigo_alt"),
            "supabase": F.coalesce(F.when(F.trim("sku") != "", F.col("sku")), F.col("producto_id")),
            "mongo": F.col("codigo_mongo"), "neo4j": F.col("id")}
    table = {"mssql": "Producto", "mysql": "Producto", "supabase": "producto", "mongo": "productos", "neo4j": "Producto"}
    return {k: s[k][table[k]].select(F.lit(k).alias("fuente"), code[k].alias("codigo"), "nombre", "categoria") for k in code}


def _nested_items(orders, lines, key, line_key, product):
    """``orders`` with their lines as an array; null without lines."""
    items = lines.groupBy(F.col(line_key).alias(key)).agg(
        F.collect_list(F.struct(F.col(product).alias("producto_id"), "cantidad", "precio_unit")).alias("items"))
    return orders.join(items, key, "left")


@register("order_payload_violations_all")
def order_payload_violations_all(spark, sf_dir):
    """FL17: Mongo, Supabase and Neo4j orders checked against their source's order payload rules."""
    from ..functions.validate import violations
    from ..operators.orders import payload_rules
    s = _src(spark, sf_dir)
    orders = {"mongo": s["mongo"]["ordenes"],
              "supabase": _nested_items(s["supabase"]["orden"], s["supabase"]["orden_detalle"], "orden_id", "orden_id", "producto_id"),
              "neo4j": _nested_items(s["neo4j"]["Orden"], s["neo4j"]["CONTIENE"], "id", "from_id", "to_id")}
    v = _union(o.select(F.lit(k).alias("fuente"), F.explode(violations(payload_rules(k))).alias("regla")) for k, o in orders.items())
    return v.groupBy("fuente", "regla").agg(F.count(F.lit(1)).alias("filas"))


@register("bridge_validation_all")
def bridge_validation_all(spark, sf_dir):
    """JN22: Supabase, Neo4j and document products' (SKU, name, category) checked against the bridge."""
    from ..functions.clean import normalize_sku
    from ..operators.orders import validate_against_bridge
    s = _src(spark, sf_dir)
    sku = {"supabase": (s["supabase"]["producto"], "sku"), "neo4j": (s["neo4j"]["Producto"], "sku"),
           "mongo": (s["mongo"]["productos"], "equivalencias.sku")}
    p = _union(df.select(F.lit(k).alias("fuente"), normalize_sku(F.col(c)).alias("_sku"), "nombre", "categoria")
               for k, (df, c) in sku.items())
    v = validate_against_bridge(p, _w(spark, sf_dir)["map_producto"], "_sku", "nombre", "categoria")
    return v.groupBy("fuente", "valido").agg(F.count(F.lit(1)).alias("filas"))


@register("lookup_by_name_all")
def lookup_by_name_all(spark, sf_dir):
    """ER6: official SKU of each product of the five sources by (name, category)."""
    from ..operators.equivalence import lookup_by_name as lk
    p = _union(_product_names(_src(spark, sf_dir)).values())
    return lk(p, _w(spark, sf_dir)["eq_map"], "nombre", "categoria").select("fuente", "codigo", "sku_oficial")


@register("sku_by_name_fallback_all")
def sku_by_name_fallback_all(spark, sf_dir):
    """WN2/JN21: each MySQL, Supabase, Mongo and Neo4j product resolved through the bridge by
    (name, category) with source priority and newest row first."""
    from ..operators.equivalence import best_bridge_by_name
    p = _union(df for k, df in _product_names(_src(spark, sf_dir)).items() if k != "mssql")
    return best_bridge_by_name(p, _w(spark, sf_dir)["map_producto"], "nombre", "categoria").select(
        "fuente", "codigo", "sku_por_nombre")


@register("order_total_check_all")
def order_total_check_all(spark, sf_dir):
    """AG14: stored totals of the five sources vs the sum of their lines (net of the line discount where there is one);
    orders without lines count too."""
    from ..functions.clean import parse_amount
    from ..operators.orders import total_mismatches
    s = _src(spark, sf_dir)
    item = F.explode("items").alias("it")
    per = {"mssql": (s["mssql"]["Orden"], "OrdenId", F.col("Total"), s["mssql"]["OrdenDetalle"], F.col("OrdenId"),
                     F.col("Cantidad") * F.col("PrecioUnit") * (1 - F.coalesce("DescuentoPct", F.lit(0)) / 100)),
           "mysql": (s["mysql"]["Orden"], "id", parse_amount(F.col("total")), s["mysql"]["OrdenDetalle"], F.col("orden_id"),
                     F.col("cantidad") * parse_amount(F.col("precio_unit"))),
           "supabase": (s["supabase"]["orden"], "orden_id", F.col("total"), s["supabase"]["orden_detalle"], F.col("orden_id"),
                        F.col("cantidad") * F.col("precio_unit")),
           "mongo": (s["mongo"]["ordenes"], "_id", F.col("total"), s["mongo"]["ordenes"].select("_id", item), F.col("_id"),
                     F.col("it.cantidad") * F.col("it.precio_unit")),
           "neo4j": (s["neo4j"]["Orden"], "id", F.col("total"), s["neo4j"]["CONTIENE"], F.col("from_id"),
                     F.col("cantidad") * F.col("precio_unit"))}
    parts = []
    for k, (o, key, total, d, ref, amount) in per.items():
        o = o.select(F.col(key).alias("orden_id"), total.cast("decimal(18,2)").alias("total"))
        d = d.select(ref.alias("orden_id"), amount.cast("decimal(18,2)").alias("_line"))
        j = total_mismatches(o, d, "orden_id", "total", F.col("_line"), keep_all=True)
        parts.append(j.agg(F.count(F.lit(1)).alias("ordenes_revisadas"), F.count_if("sin_lineas").alias("sin_lineas"),
                           F.count_if("descuadre").alias("descuadres")).select(F.lit(k).alias("fuente"), "*"))
    return _union(parts)


@register("duplicate_products_in_orders_all")
def duplicate_products_in_orders_all(spark, sf_dir):
    """FL18: graph and document orders that list a product twice."""
    from ..operators.orders import duplicate_products
    s = _src(spark, sf_dir)
    graph = _nested_items(s["neo4j"]["Orden"].select("id"), s["neo4j"]["CONTIENE"], "id", "from_id", "to_id")
    orders = {"neo4j": graph.select(F.col("id").alias("orden_id"), "items"),
              "mongo": s["mongo"]["ordenes"].select(F.col("_id").alias("orden_id"), "items")}
    return _union(duplicate_products(o.where(F.col("items").isNotNull())).select(F.lit(k).alias("fuente"), "orden_id")
                  for k, o in orders.items())


@register("codes_to_skus_all")
def codes_to_skus_all(spark, sf_dir):
    """JN12: product codes of every Mongo and Supabase order line -> official SKU."""
    from ..operators.rules import codes_to_skus
    s, w = _src(spark, sf_dir), _w(spark, sf_dir)
    ids = {"mongo": s["mongo"]["productos"].select(F.col("_id").alias("producto_id"), F.col("codigo_mongo").alias("code")),
           "supabase": s["supabase"]["producto"].select("producto_id", F.coalesce(F.when(F.trim("sku") != "", F.col("sku")),
                                                                                  F.col("producto_id")).alias("code"))}
    lines = {"mongo": s["mongo"]["ordenes"].select(F.explode("items.producto_id").alias("producto_id")),
             "supabase": s["supabase"]["orden_detalle"].select("producto_id")}
    return _union(codes_to_skus(lines[k].distinct().join(ids[k], "producto_id").select("code").distinct(),
                                w["map_producto"], w["dim_producto"], k).select(F.lit(k).alias("fuente"), "code", "SKU") for k in ids)


@register("stream_daily_channel_sales")
def stream_daily_channel_sales_q(spark, sf_dir):
    """SM3: purchase events per 1-day tumbling window and channel (of the buyer: ``user_id % 5``) with a watermark."""
    from ..sources.fixtures import FIXTURE_CHANNELS, pick
    from ..streaming.ingest import daily_sales_stream, read_latest_by_key
    base = _stream_dir(spark, "daily_channel")
    daily_sales_stream(spark, f"{sf_dir.rstrip('/')}/events.parquet", f"{base}/out", f"{base}/ckpt",
                       channel=pick((F.col("user_id") % 5).cast("int"), FIXTURE_CHANNELS))
    r = read_latest_by_key(spark, f"{base}/out", "dia", "canal")
    return r.select("dia", "canal", "compras", F.round("valor", 4).alias("valor"))


@register("fx_rates_today")
def fx_rates_today(spark, sf_dir):
    """AG11: the two rates as of the last order date of the data."""
    from ..operators.quality import rates_of_day
    w = _w(spark, sf_dir)
    today = w["stg_orden_items"].agg(F.max("fecha_dt")).first()[0]
    return rates_of_day(w["tipo_cambio"], today).select(*[F.col(c).cast("double").alias(c) for c in ("tasa_usd_crc", "tasa_crc_usd")])


@register("bulk_append_clients")
def bulk_append_clients(spark, sf_dir):
    """BL2: every MySQL client uploaded once more: all appended with new ids, no e-mail is merged."""
    from ..operators import bulk
    c = _src(spark, sf_dir)["mysql"]["Cliente"]
    up = c.withColumnRenamed("id", "_row")
    t = bulk.append_clients(c, up, "id", {"genero": "M"})
    return t.agg(F.count(F.lit(1)).alias("filas"), F.countDistinct("id").alias("ids"), F.max("id").cast("long").alias("ultimo"),
                 F.countDistinct("correo").alias("correos"))


@register("bulk_upsert_products")
def bulk_upsert_products(spark, sf_dir):
    """BL3: every part uploaded as a product of SQL Server (by SKU) and MySQL (by codigo_alt): updates and inserts."""
    from ..operators import bulk
    from ..sources import fixtures
    s = _src(spark, sf_dir)
    p = fixtures.read_table(spark, sf_dir, "part")
    pk = F.col("p_partkey")
    up = p.select(pk.alias("_row"), fixtures.sku_of(pk).alias("SKU"), F.concat(F.lit("ALT-"), pk.cast("string")).alias("codigo_alt"),
                  F.lit("nuevo").alias("nombre"), F.col("p_type").alias("categoria"))
    parts = []
    for fuente, key, i, names in [("mssql", "SKU", "ProductoId", {"nombre": "Nombre", "categoria": "Categoria"}),
                                  ("mysql", "codigo_alt", "id", {})]:
        table, actions = bulk.upsert_products(
            s[fuente]["Producto"], up.select("_row", key, "nombre", "categoria").withColumnsRenamed(names), key, i)
        f = F.lit(fuente).alias("fuente")
        parts += [actions.groupBy("accion").agg(F.count(F.lit(1)).alias("filas")).select(f, "accion", "filas"),
                  table.agg(F.countDistinct(i).alias("filas")).select(f, F.lit("total_tabla").alias("accion"), "filas")]
    return _union(parts)


# ------------------------------------------------------------------ modules of their own

from . import detail_queries, rule_queries, run_queries, stream_queries, upload_queries  # noqa: E402

QUERIES |= upload_queries.QUERIES | rule_queries.QUERIES | stream_queries.QUERIES | detail_queries.QUERIES | run_queries.QUERIES
