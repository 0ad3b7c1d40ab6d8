"""Dimensions and the sales fact (DW1-DW10, JN4-JN7, FL6-FL7, SC27-SC28).

Sizes drive the join strategy: the date dimension is one row per day of a
bounded range and is left to Spark; the client dimension, bridge and
product dimension are broadcast when under the threshold and of few rows
(``keys.lookup``), shuffled otherwise; staged items are the large side and are never
broadcast.  Fact keys are hashes of the business key, so no global ordering
touches the large table.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import clean
from .keys import hash_key, lookup, surrogate_keys

# Product-dimension source priority (D8).
DIM_PRODUCT_PRIORITY = ["mssql", "neo4j", "mysql", "supabase", "mongo"]


# ------------------------------------------------------------------ FX

def rates_by_date(tipo_cambio: DataFrame) -> DataFrame:
    """JN8: one row per date with both directions (a pivot, not a self join)."""
    return (tipo_cambio.groupBy("fecha")
            .agg(F.max(F.when((F.col("de") == "CRC") & (F.col("a") == "USD"), F.col("tasa"))).alias("crc_usd"),
                 F.max(F.when((F.col("de") == "USD") & (F.col("a") == "CRC"), F.col("tasa"))).alias("usd_crc")))


def rates_view(tipo_cambio: DataFrame) -> DataFrame:
    """JN8/JN9: dates with both buy and sell rates."""
    r = rates_by_date(tipo_cambio)
    return r.where(F.col("crc_usd").isNotNull() & F.col("usd_crc").isNotNull()).select(
        "fecha", F.col("crc_usd").alias("tasa_compra"), F.col("usd_crc").alias("tasa_venta"))


# ----------------------------------------------------------------- DW1/2

def dim_tiempo(bounds: DataFrame, tipo_cambio: DataFrame | None = None,
               existing: DataFrame | None = None) -> DataFrame:
    """DW1 + DW2 + SE5: date dimension over ``bounds`` (one row, columns lo, hi);
    ``sequence`` replaces the recursive CTE.

    New dates only when ``existing`` is given; FX columns synced with
    ``coalesce(new, old)`` so a missing direction never nulls a rate (D6)."""
    days = bounds.select(F.explode(F.sequence(F.col("lo").cast("date"), F.col("hi").cast("date"),
                                              F.expr("interval 1 day"))).alias("Fecha"))
    base = days.select(clean.date_key(F.col("Fecha")).alias("TiempoID"), "Fecha",
                       F.year("Fecha").alias("Anio"), F.month("Fecha").alias("Mes"),
                       F.dayofmonth("Fecha").alias("Dia"))
    if existing is not None:
        new = base.join(existing.select("Fecha"), "Fecha", "left_anti")
        base = existing.select("TiempoID", "Fecha", "Anio", "Mes", "Dia",
                               F.col("TC_CRC_USD").alias("_old_buy"), F.col("TC_USD_CRC").alias("_old_sell")) \
            .unionByName(new, allowMissingColumns=True)
    else:
        base = base.withColumn("_old_buy", F.lit(None).cast("decimal(18,6)")) \
                   .withColumn("_old_sell", F.lit(None).cast("decimal(18,6)"))
    if tipo_cambio is not None:
        r = rates_by_date(tipo_cambio).withColumnRenamed("fecha", "_rfecha")
        base = base.join(r, base.Fecha == r._rfecha, "left").drop("_rfecha")
    else:
        base = base.withColumn("crc_usd", F.lit(None).cast("decimal(18,6)")) \
                   .withColumn("usd_crc", F.lit(None).cast("decimal(18,6)"))
    return base.select("TiempoID", "Fecha", "Anio", "Mes", "Dia",
                       F.coalesce("crc_usd", "_old_buy").cast("decimal(18,6)").alias("TC_CRC_USD"),
                       F.coalesce("usd_crc", "_old_sell").cast("decimal(18,6)").alias("TC_USD_CRC"))


def spine_bounds(*frames_and_cols: tuple[DataFrame, str], first: str = "1900-01-01", last: str = "2199-12-31") -> DataFrame:
    """Min/max date over several (frame, date column) pairs, as a 1-row frame.

    Dates outside ``first`` .. ``last`` do not stretch the spine: their rows find
    no day and are counted as without a date (AG6)."""
    parts = [df.select(F.col(c).cast("date").alias("d")) for df, c in frames_and_cols]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    u = u.where(F.col("d").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    return u.agg(F.min("d").alias("lo"), F.max("d").alias("hi"))


# ------------------------------------------------------------------ DW3

def dim_cliente(stg_clientes: DataFrame, dim_t: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """New clients joined to their creation date (inner: dates outside the
    spine are not inserted), keys after the existing maximum."""
    t = dim_t.select("Fecha", "TiempoID")
    c = stg_clientes.join(t, stg_clientes.fecha_creado_dt == t.Fecha, "inner")
    c = c.select(F.col("source_system").alias("SourceSystem"), F.col("source_code").alias("SourceKey"),
                 F.col("cliente_email").alias("Email"), F.col("cliente_nombre").alias("Nombre"),
                 F.col("genero_norm").alias("Genero"), F.col("pais_raw").alias("Pais"),
                 F.col("TiempoID").alias("FechaCreacionID"))
    start = 0
    if existing is not None:
        c = c.join(lookup(existing.select("SourceSystem", "SourceKey")), ["SourceSystem", "SourceKey"], "left_anti")
        start = existing.agg(F.coalesce(F.max("ClienteID"), F.lit(0))).first()[0]
    new = surrogate_keys(c, ["SourceSystem", "SourceKey"], "ClienteID", start)
    cols = ["ClienteID", "SourceSystem", "SourceKey", "Email", "Nombre", "Genero", "Pais", "FechaCreacionID"]
    return new.select(*cols) if existing is None else existing.select(*cols).unionByName(new.select(*cols))


# ------------------------------------------------------------- DW4/DW5

def dim_producto(bridge: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """One row per SKU, picked by source priority then source code; new only."""
    b = bridge
    if existing is not None:
        b = b.join(lookup(existing.select(F.col("SourceSystem").alias("source_system"),
                                          F.col("SourceKey").alias("source_code"))),
                   ["source_system", "source_code"], "left_anti")
    rank = F.coalesce(*[F.when(F.col("source_system") == s, F.lit(i)) for i, s in enumerate(DIM_PRODUCT_PRIORITY)],
                      F.lit(len(DIM_PRODUCT_PRIORITY)))
    w = Window.partitionBy("sku_oficial").orderBy(rank, F.col("source_code"))
    best = (b.where(F.col("sku_oficial").isNotNull())
            .withColumn("_rn", F.row_number().over(w)).where("_rn = 1")
            .select(F.col("sku_oficial").alias("SKU"), F.col("nombre_norm").alias("Nombre"),
                    F.col("categoria_norm").alias("Categoria"), F.col("es_servicio").alias("EsServicio"),
                    F.col("source_system").alias("SourceSystem"), F.col("source_code").alias("SourceKey")))
    start = 0
    if existing is not None:
        best = best.join(lookup(existing.select("SKU")), "SKU", "left_anti")
        start = existing.agg(F.coalesce(F.max("ProductoID"), F.lit(0))).first()[0]
    new = surrogate_keys(best, ["SKU"], "ProductoID", start)
    cols = ["ProductoID", "SKU", "Nombre", "Categoria", "EsServicio", "SourceSystem", "SourceKey"]
    return new.select(*cols) if existing is None else existing.select(*cols).unionByName(new.select(*cols))


# ------------------------------------------------------------------ DW7

FACT_COLS = ["FactID", "TiempoID", "ClienteID", "ProductoID", "Canal", "Fuente", "Cantidad",
             "PrecioUnitUSD", "TotalUSD", "MonedaOriginal", "PrecioUnitOriginal", "TotalOriginal",
             "SourceKey", "Anio", "Mes"]


def fact_candidates(items: DataFrame, dim_t: DataFrame, dim_c: DataFrame, bridge: DataFrame,
                    dim_p: DataFrame, by_month: bool = False) -> DataFrame:
    """JN4 with left joins and match flags: used by the fact load and by the
    one-pass diagnostics (AG6).

    The dates join last, so lines are shuffled without the columns of the spine.
    ``by_month``: lines of a month are brought together before that."""
    # no hint: the spine spans the dates of the data, so Spark decides by its size
    t = dim_t.select(F.col("Fecha").alias("_fecha"), "TiempoID", "Anio", "Mes", "TC_CRC_USD")
    c = dim_c.select(F.col("SourceSystem").alias("_cs"), F.col("SourceKey").alias("_ck"), "ClienteID")
    m = bridge.select(F.col("source_system").alias("_ms"), F.col("source_code").alias("_mc"),
                      F.col("sku_oficial").alias("_sku"))
    p = dim_p.select(F.col("SKU").alias("_psku"), "ProductoID")
    # the two product tables meet first: the lines are shuffled once for both
    c, p = lookup(c), lookup(p)
    m = m.join(p, m._sku == p._psku, "left")
    x = (items.join(c, (items.cliente_key == c._ck) & (items.source_system == c._cs), "left")
         .join(m, (items.source_code_prod == m._mc) & (items.source_system == m._ms), "left"))
    if by_month:
        x = x.withColumn("_month", F.trunc("fecha_dt", "month")).hint("rebalance", "_month").drop("_month")
    return x.join(t, x.fecha_dt == t._fecha, "left")


def unloaded_items(items: DataFrame, fact: DataFrame | None) -> DataFrame:
    """JN5 before JN4: staged lines that ``fact`` lacks, so that a re-run joins the dimensions to new lines only."""
    if fact is None:
        return items
    key = fact.select(F.col("Fuente").alias("source_system"), F.col("SourceKey").alias("_sk"))
    return (items.withColumn("_sk", clean.business_key("source_key_orden", "source_key_item"))
            .join(lookup(key), ["source_system", "_sk"], "left_anti").drop("_sk"))


def fact_ventas(items: DataFrame, dim_t: DataFrame, dim_c: DataFrame, bridge: DataFrame,
                dim_p: DataFrame, existing: DataFrame | None = None, total_basis: str = "line",
                high_water=None, by_month: bool = False) -> DataFrame:
    """DW7: new fact rows.

    * inner semantics of JN4 via the match flags of ``fact_candidates``
    * FL6: CRC rows need a rate for the day; other non-USD currencies pass
      through unchanged (D7)
    * JN5: rows already in the fact (Fuente, SourceKey) are skipped, so a
      re-run adds nothing (IN1); FL7 high-water filtering only on request (D5)
    * ``total_basis``: 'line' = qty * price (* discount), 'source' = the
      source's own total column (D1)
    * ``by_month``: the rows of a month lie together, as ``write_fact`` needs them
    """
    it = items
    if high_water is not None:
        if "load_ts" not in it.columns:
            raise ValueError("high_water needs a load_ts column in the staged items")
        it = it.where(F.col("load_ts") > F.lit(high_water))
    it = it.withColumn("_sk", clean.business_key("source_key_orden", "source_key_item"))
    x = fact_candidates(it, dim_t, dim_c, bridge, dim_p, by_month)
    ok = (F.col("TiempoID").isNotNull() & F.col("ClienteID").isNotNull() & F.col("_sku").isNotNull()
          & F.col("ProductoID").isNotNull()
          & ((F.col("moneda") != "CRC") | F.col("TC_CRC_USD").isNotNull()))
    x = x.where(ok)
    total = F.col("line_total_num") if total_basis == "line" else F.col("total_num")
    rate = F.col("TC_CRC_USD").cast("double")
    sk = F.col("_sk")
    out = x.select(
        hash_key("source_system", sk).alias("FactID"),
        "TiempoID", "ClienteID", "ProductoID",
        F.col("canal_raw").alias("Canal"), F.col("source_system").alias("Fuente"),
        F.col("cantidad_num").cast("decimal(18,4)").alias("Cantidad"),
        clean.to_usd(F.col("precio_unit_num"), F.col("moneda"), rate).cast("decimal(18,6)").alias("PrecioUnitUSD"),
        clean.to_usd(total, F.col("moneda"), rate).cast("decimal(18,6)").alias("TotalUSD"),
        F.col("moneda").alias("MonedaOriginal"),
        F.col("precio_unit_num").cast("decimal(18,6)").alias("PrecioUnitOriginal"),
        total.cast("decimal(18,6)").alias("TotalOriginal"),
        sk.alias("SourceKey"), "Anio", "Mes")
    if existing is not None:
        out = out.join(lookup(existing.select("Fuente", "SourceKey")), ["Fuente", "SourceKey"], "left_anti")
    return out


# ------------------------------------------------------------------ DW8

def should_run(last_loads: DataFrame, stg_max: DataFrame, now=None, max_age_hours: int = 24) -> DataFrame:
    """DW8: run when a table's last load is older than ``max_age_hours`` or
    staging holds newer rows.  Inputs: ``last_loads`` (table, last_ts) and
    ``stg_max`` (table, max_ts).  Output: one row (run, reason) with the
    reasons sorted, so the text does not depend on row order."""
    now_c = F.current_timestamp() if now is None else F.lit(now).cast("timestamp")
    floor = F.lit("1900-01-01").cast("timestamp")
    j = last_loads.join(stg_max, "table", "full_outer")
    stale = F.coalesce(F.col("last_ts"), floor) < now_c - F.expr(f"interval {int(max_age_hours)} hours")
    newer = F.coalesce(F.col("max_ts") > F.coalesce(F.col("last_ts"), floor), F.lit(False))
    reasons = j.select(F.explode(F.array_compact(F.array(
        F.when(stale, F.concat(F.col("table"), F.lit(" stale"))),
        F.when(newer, F.concat(F.col("table"), F.lit(" has new rows")))))).alias("r"))
    return reasons.agg(F.array_join(F.array_sort(F.collect_list("r")), "; ").alias("reason")) \
        .select((F.col("reason") != "").alias("run"), "reason")


# ----------------------------------------------------------------- DW10

def targets_from_prior_year(fact: DataFrame, factor: float = 1.10) -> DataFrame:
    """DW10 fixture: MetaUSD per (client, product, year, month) = factor x the
    same month's sales of the previous year."""
    s = (fact.groupBy("ClienteID", "ProductoID", "Anio", "Mes")
         .agg(F.sum("TotalUSD").alias("_v")))
    return s.select("ClienteID", "ProductoID", (F.col("Anio") + 1).alias("Anio"), "Mes",
                    (F.col("_v") * F.lit(Decimal(str(factor)))).cast("decimal(18,2)").alias("MetaUSD"))


def target_duplicates(metas: DataFrame) -> DataFrame:
    """DW10 uniqueness rule: keys present more than once."""
    return (metas.groupBy("ClienteID", "ProductoID", "Anio", "Mes").agg(F.count(F.lit(1)).alias("n"))
            .where("n > 1"))


# ---------------------------------------------------------------- IN2/IN3

def new_rate_days(feed: DataFrame, tipo_cambio: DataFrame) -> DataFrame:
    """IN2: feed days not yet loaded (both directions present counts as loaded)."""
    have = (rates_by_date(tipo_cambio).where(F.col("crc_usd").isNotNull() & F.col("usd_crc").isNotNull())
            .select("fecha"))
    return feed.join(have, "fecha", "left_anti")


def backfill_range(tipo_cambio: DataFrame, today, years: int = 3, min_rows: int = 100) -> DataFrame:
    """IN3: one row (desde, hasta, cargar) - load ``years`` of history only
    when fewer than ``min_rows`` rates exist."""
    t = F.lit(today).cast("date")
    return tipo_cambio.agg(F.count(F.lit(1)).alias("_n")).select(
        F.add_months(t, -12 * years).alias("desde"), t.alias("hasta"), (F.col("_n") < min_rows).alias("cargar"))
