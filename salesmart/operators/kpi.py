"""Sales KPI marts over the fact (KP1-KP12, SC40).

One filter builder is shared by every KPI.  Growth compares each (year,
month) with the same month of the previous year by an equi join on
(year - 1, month), so missing months never shift the comparison.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import clean


def sales_base(fact: DataFrame, dim_c: DataFrame | None = None, dim_p: DataFrame | None = None) -> DataFrame:
    x = fact
    if dim_p is not None:
        x = x.join(dim_p.select("ProductoID", "SKU", F.col("Nombre").alias("Producto"), "Categoria"), "ProductoID")
    if dim_c is not None:
        x = x.join(dim_c.select("ClienteID", F.col("SourceSystem").alias("ClienteSistema"),
                                F.col("SourceKey").alias("ClienteKey")), "ClienteID")
    return x


def apply_filters(df: DataFrame, date_from=None, date_to=None, cliente=None, producto=None,
                  categoria=None, canal=None) -> DataFrame:
    """KP1 filter builder (date range on TiempoID yyyyMMdd ints)."""
    # the implied year bounds prune the fact's Anio=/Mes= partitions
    if date_from is not None:
        df = df.where(F.col("TiempoID") >= F.lit(int(str(date_from).replace("-", ""))))
        df = df.where(F.col("Anio") >= F.lit(int(str(date_from)[:4])))
    if date_to is not None:
        df = df.where(F.col("TiempoID") <= F.lit(int(str(date_to).replace("-", ""))))
        df = df.where(F.col("Anio") <= F.lit(int(str(date_to)[:4])))
    if cliente is not None:
        df = df.where(F.col("ClienteID") == cliente)
    if producto is not None:
        df = df.where(F.col("SKU") == producto)
    if categoria is not None:
        df = df.where(F.col("Categoria") == categoria)
    if canal is not None:
        df = df.where(F.col("Canal") == canal)
    return df


def money(c) -> F.Column:
    return F.round(c, 2).cast("double")


def total_sales(df: DataFrame) -> DataFrame:
    """KP1."""
    return df.agg(money(F.sum("TotalUSD")).alias("ventas_usd"), F.count(F.lit(1)).alias("lineas"))


def monthly(df: DataFrame) -> DataFrame:
    return df.groupBy("Anio", "Mes").agg(F.sum("TotalUSD").alias("_v"))


def growth_vs_last_year(df: DataFrame) -> DataFrame:
    """KP2 / KP11: month vs same month of the previous year (percent)."""
    # one scan: the monthly table is small, last year's month is one step back in its window
    last_year = Window.partitionBy("Mes").orderBy("Anio").rangeBetween(-1, -1)
    j = monthly(df).withColumn("_pv", F.max("_v").over(last_year))
    pct = F.try_divide((F.col("_v") - F.col("_pv")).cast("double") * 100, F.col("_pv").cast("double"))
    return j.select("Anio", "Mes", money(F.col("_v")).alias("ventas_usd"), money(F.col("_pv")).alias("ventas_anio_anterior"),
                    F.round(pct, 4).alias("crecimiento_pct"))


def top_clients(df: DataFrame, k: int = 10) -> DataFrame:
    """KP3: top k clients by sales; ties broken by the business key (D13)."""
    s = df.groupBy(F.col("ClienteSistema").alias("SourceSystem"), F.col("ClienteKey").alias("SourceKey")) \
        .agg(F.sum("TotalUSD").alias("_v"))
    w = Window.orderBy(F.desc("_v"), "SourceSystem", "SourceKey")
    # TakeOrderedAndProject: per-partition top-k, then k rows merged; the window sees k rows
    top = s.orderBy(F.desc("_v"), "SourceSystem", "SourceKey").limit(k)
    return top.select("SourceSystem", "SourceKey", money(F.col("_v")).alias("ventas_usd"),
                      F.row_number().over(w).alias("rank"))


def top_products(df: DataFrame, k: int = 10) -> DataFrame:
    """KP4."""
    s = df.groupBy("SKU").agg(F.sum("TotalUSD").alias("_v"))
    top = s.orderBy(F.desc("_v"), "SKU").limit(k)
    w = Window.orderBy(F.desc("_v"), "SKU")
    return top.select("SKU", money(F.col("_v")).alias("ventas_usd"), F.row_number().over(w).alias("rank"))


def sales_by_category(df: DataFrame) -> DataFrame:
    """KP5: sales and share of total per category."""
    s = df.groupBy("Categoria").agg(F.sum("TotalUSD").alias("_v"))
    tot = df.agg(F.sum("TotalUSD")).first()[0]             # a scalar total
    t = float(tot) if tot is not None else None
    return s.select("Categoria", money(F.col("_v")).alias("ventas_usd"),
                    F.round(F.col("_v").cast("double") * 100 / F.lit(t), 4).alias("participacion_pct"))


def sales_vs_targets(df: DataFrame, metas: DataFrame) -> DataFrame:
    """KP12 / KP6: client-product-month sales against targets (full outer),
    attainment percent and colour band."""
    s = df.groupBy("ClienteID", "ProductoID", "Anio", "Mes").agg(F.sum("TotalUSD").alias("_v"))
    return _attainment(s.join(metas, ["ClienteID", "ProductoID", "Anio", "Mes"], "full_outer"))


def _attainment(j: DataFrame) -> DataFrame:
    """Sales ``_v`` and target ``MetaUSD`` per key, either may be null -> attainment percent and band."""
    pct = F.try_divide(F.coalesce(F.col("_v"), F.lit(0)).cast("double") * 100, F.col("MetaUSD").cast("double"))
    return j.select("ClienteID", "ProductoID", "Anio", "Mes", money(F.coalesce("_v", F.lit(0))).alias("ventas_usd"),
                    F.col("MetaUSD").cast("double").alias("meta_usd"),
                    F.round(pct.cast("double"), 4).alias("cumplimiento_pct"),
                    clean.attainment_band(F.round(pct, 4)).alias("banda"))


def sales_vs_prior_year_targets(fact: DataFrame, factor: float = 1.10) -> DataFrame:
    """KP12 / KP6 with DW10 targets (factor x the same month of the previous year), in one shuffle.

    The fact is dealt by (client, product, month); sums by year, and sums moved
    a year on as targets, then meet in the same partition."""
    key = ["ClienteID", "ProductoID", "Anio", "Mes"]
    s = (fact.select(*key, "TotalUSD").repartition("ClienteID", "ProductoID", "Mes")
         .groupBy(*key).agg(F.sum("TotalUSD").alias("_v")))
    meta = (F.col("_v") * F.lit(Decimal(str(factor)))).cast("decimal(18,2)")
    both = F.array(F.struct(F.col("Anio").alias("Anio"), F.col("_v").alias("v"), F.lit(None).cast("decimal(18,2)").alias("m")),
                   F.struct((F.col("Anio") + 1).alias("Anio"), F.lit(None).alias("v"), meta.alias("m")))
    j = (s.select("ClienteID", "ProductoID", "Mes", F.explode(both).alias("b"))
         .groupBy("ClienteID", "ProductoID", F.col("b.Anio").alias("Anio"), "Mes")
         .agg(F.max("b.v").alias("_v"), F.max("b.m").alias("MetaUSD")))
    return _attainment(j)


def average_ticket(df: DataFrame) -> DataFrame:
    """KP7: sales / distinct orders (order = (Fuente, transaction id))."""
    txn = clean.transaction_id(F.col("Fuente"), F.col("SourceKey"))
    per_order = df.groupBy("Fuente", txn.alias("_t")).agg(F.sum("TotalUSD").alias("_v"))
    return per_order.agg(F.count(F.lit(1)).alias("ordenes"), money(F.sum("_v")).alias("ventas_usd"),
                         F.round(F.sum("_v").cast("double") / F.count(F.lit(1)), 4).alias("ticket_promedio"))


def active_clients(df: DataFrame) -> DataFrame:
    """KP8 (per month and overall via rollup)."""
    return (df.rollup("Anio").agg(F.countDistinct("ClienteID").alias("clientes_activos"))
            .withColumn("Anio", F.coalesce("Anio", F.lit(0))))


def sales_by_channel_month(df: DataFrame) -> DataFrame:
    """KP9."""
    return df.groupBy("Anio", "Mes", "Canal").agg(money(F.sum("TotalUSD")).alias("ventas_usd"))


def mom_accumulated(df: DataFrame) -> DataFrame:
    """KP10 (D9): running sum within the year of the month-over-month percent
    change; January compares with the previous December when present."""
    idx = F.col("Anio") * 12 + F.col("Mes")
    # a single window over the monthly table (12 rows a year)
    j = monthly(df).withColumn("_pv", F.max("_v").over(Window.orderBy(idx).rangeBetween(-1, -1)))
    pct = F.coalesce(F.try_divide((F.col("_v") - F.col("_pv")).cast("double") * 100, F.col("_pv").cast("double")),
                     F.lit(0.0))
    w = Window.partitionBy("Anio").orderBy("Mes").rowsBetween(Window.unboundedPreceding, 0)
    return j.select("Anio", "Mes", F.round(pct, 4).alias("mom_pct"),
                    F.round(F.sum(pct).over(w), 4).alias("mom_acumulado_pct"))
