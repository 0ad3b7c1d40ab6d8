"""Quality reports and load diagnostics (AG1-AG11, AG18-AG19, FL5).

All are aggregates over whole tables; AG6 does the six reasons in one pass
over the candidate rows (left joins with match flags), not six scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .keys import lookup
from .warehouse import fact_candidates


def bridge_stats(bridge: DataFrame) -> DataFrame:
    """AG1."""
    return bridge.groupBy("source_system").agg(
        F.count(F.lit(1)).alias("productos"), F.countDistinct("sku_oficial").alias("skus_distintos"),
        F.sum(F.col("es_servicio").cast("int")).alias("servicios"))


def client_stats(stg_clientes: DataFrame) -> DataFrame:
    """AG2."""
    return stg_clientes.groupBy("source_system").agg(
        F.count(F.lit(1)).alias("clientes"), F.countDistinct("cliente_email").alias("emails_distintos"),
        F.countDistinct("pais_raw").alias("paises_distintos"))


def item_stats(stg_items: DataFrame) -> DataFrame:
    """AG3: lines, distinct orders and the summed source total per source and currency."""
    return stg_items.groupBy("source_system", "moneda").agg(
        F.count(F.lit(1)).alias("lineas"), F.countDistinct("source_key_orden").alias("ordenes"),
        F.round(F.sum("line_total_num"), 2).alias("monto"))


def dw_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """AG4: row count per table as one union of tiny aggregates."""
    parts = [df.agg(F.count(F.lit(1)).alias("filas")).select(F.lit(name).alias("tabla"), "filas")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def fact_stats(fact: DataFrame) -> DataFrame:
    """AG5: per source plus a grand total row (rollup)."""
    return (fact.rollup("Fuente").agg(
        F.count(F.lit(1)).alias("filas"), F.round(F.sum("TotalUSD"), 2).cast("double").alias("ventas_usd"),
        F.min("TiempoID").alias("primer_tiempo"), F.max("TiempoID").alias("ultimo_tiempo"))
        .withColumn("Fuente", F.coalesce("Fuente", F.lit("TOTAL"))))


def load_diagnostics(items: DataFrame, dim_t: DataFrame, dim_c: DataFrame, bridge: DataFrame,
                     dim_p: DataFrame, fact: DataFrame | None = None) -> DataFrame:
    """AG6 + SE1: staged rows that cannot load, by reason (reasons overlap;
    zero counts hidden) - the reference's UNION ALL of six counts becomes one
    pass with conditional counts and a ``stack`` unpivot."""
    x = fact_candidates(items, dim_t, dim_c, bridge, dim_p)
    sk = F.concat(F.col("source_key_orden"), F.lit("-"), F.col("source_key_item"))
    if fact is not None:
        f = fact.select(F.col("Fuente").alias("_ff"), F.col("SourceKey").alias("_fk"), F.lit(True).alias("_loaded"))
        f = lookup(f)
        x = x.join(f, (x.source_system == f._ff) & (sk == f._fk), "left")
    else:
        x = x.withColumn("_loaded", F.lit(None).cast("boolean"))
    counts = x.agg(
        F.count(F.when(F.col("TiempoID").isNull(), 1)).alias("sin_fecha"),
        F.count(F.when(F.col("ClienteID").isNull(), 1)).alias("sin_cliente"),
        F.count(F.when(F.col("_sku").isNull(), 1)).alias("sin_mapeo"),
        F.count(F.when(F.col("_sku").isNotNull() & F.col("ProductoID").isNull(), 1)).alias("sin_producto"),
        F.count(F.when(F.col("_loaded"), 1)).alias("duplicado"),
        F.count(F.when((F.col("moneda") == "CRC") & F.col("TiempoID").isNotNull()
                       & F.col("TC_CRC_USD").isNull(), 1)).alias("crc_sin_tasa"))
    st = counts.select(F.expr(
        "stack(6, 'sin_fecha', sin_fecha, 'sin_cliente', sin_cliente, 'sin_mapeo', sin_mapeo, "
        "'sin_producto', sin_producto, 'duplicado', duplicado, 'crc_sin_tasa', crc_sin_tasa) as (motivo, filas)"))
    return st.where(F.col("filas") > 0)


def fx_coverage(items: DataFrame, dim_t: DataFrame) -> DataFrame:
    """AG7: distinct dates and rows of CRC sales with no rate for the day."""
    t = dim_t.select(F.col("Fecha").alias("_f"), "TC_CRC_USD")
    x = items.where(F.col("moneda") == "CRC").join(t, F.col("fecha_dt") == F.col("_f"), "inner")
    x = x.where(F.col("TC_CRC_USD").isNull())
    return x.agg(F.countDistinct("fecha_dt").alias("fechas_sin_tasa"), F.count(F.lit(1)).alias("filas_sin_tasa"))


def currency_assumed(items: DataFrame) -> DataFrame:
    """D7: rows in a currency other than USD/CRC, taken at face value."""
    return (items.where(~F.col("moneda").isin("USD", "CRC"))
            .groupBy("source_system", "moneda").agg(F.count(F.lit(1)).alias("filas")))


def loaded_by_source(new_fact: DataFrame) -> DataFrame:
    """AG8: rows appended per source."""
    return new_fact.groupBy("Fuente").agg(F.count(F.lit(1)).alias("cargadas"))


def rate_availability(tipo_cambio: DataFrame, start, end) -> DataFrame:
    """AG9: rates in a date range: count, first and last date."""
    x = tipo_cambio.where(F.col("fecha").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    return x.agg(F.count(F.lit(1)).alias("filas"), F.min("fecha").alias("desde"), F.max("fecha").alias("hasta"))


def rate_status(tipo_cambio: DataFrame, today) -> DataFrame:
    """AG11 + SC36: last load, distinct days, today's rates and a status."""
    t = F.lit(today).cast("date")
    agg = tipo_cambio.agg(
        F.max("fecha").alias("ultima_fecha"), F.countDistinct("fecha").alias("dias"),
        F.count(F.when(F.col("fecha") == t, 1)).alias("tasas_hoy"))
    from ..functions.clean import fx_status
    return agg.withColumn("estado", fx_status(F.col("ultima_fecha"), F.col("tasas_hoy"), today))


def rates_of_day(tipo_cambio: DataFrame, today) -> DataFrame:
    """AG11: the day's two rates in one row; null where one is missing."""
    t = tipo_cambio.where(F.col("fecha") == F.lit(today).cast("date"))
    rate = lambda de, a: F.max(F.when((F.col("de") == de) & (F.col("a") == a), F.col("tasa")))
    return t.agg(rate("USD", "CRC").alias("tasa_usd_crc"), rate("CRC", "USD").alias("tasa_crc_usd"))


def last_log_rows(log: DataFrame, n: int = 10) -> DataFrame:
    """AG11: the last ``n`` rows of the run log (SNK8), newest first."""
    return log.orderBy(F.desc("ts"), "tipo", "estado", "mensaje").limit(n)


def last_load(df: DataFrame, col: str = "LoadTS") -> DataFrame:
    """AG18: max load timestamp with the 1900-01-01 default."""
    return df.agg(F.coalesce(F.max(col), F.lit("1900-01-01").cast("timestamp")).alias("last_load"))


def rejects_by_reason(items_all: DataFrame) -> DataFrame:
    """FL5: processed / rejected counts per source and reason."""
    return (items_all.groupBy("source_system", F.coalesce("reject_reason", F.lit("ok")).alias("motivo"))
            .agg(F.count(F.lit(1)).alias("filas")))
