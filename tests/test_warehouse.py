"""Fact and FX golden case (FIXTURES C7) and idempotent re-run."""
import datetime as dt

from pyspark.sql import functions as F

from salesmart.operators import merge, warehouse


def _setup(spark):
    feed = spark.createDataFrame([(dt.date(2024, 1, 1), 500.0, 510.0)], "fecha date, compra double, venta double")
    tc = merge.upsert_rates(None, feed)
    bounds = spark.createDataFrame([(dt.date(2024, 1, 1), dt.date(2024, 1, 2))], "lo date, hi date")
    dim_t = warehouse.dim_tiempo(bounds, tc)
    dim_c = spark.createDataFrame([(1, "s", "c1", None, None, None, None, 20240101)],
                                  "ClienteID long, SourceSystem string, SourceKey string, Email string, Nombre string, "
                                  "Genero string, Pais string, FechaCreacionID int")
    bridge = spark.createDataFrame([("s", "p1", "SKU-0001", "n", "c", False)],
                                   "source_system string, source_code string, sku_oficial string, nombre_norm string, "
                                   "categoria_norm string, es_servicio boolean")
    dim_p = warehouse.dim_producto(bridge)
    items = spark.createDataFrame([
        ("s", "o1", "1", "p1", "c1", "CRC", dt.date(2024, 1, 1), 1.0, 5000.0, 5000.0, 5000.0),
        ("s", "o2", "1", "p1", "c1", "CRC", dt.date(2024, 1, 2), 1.0, 5000.0, 5000.0, 5000.0),
        ("s", "o3", "1", "p1", "c1", "EUR", dt.date(2024, 1, 2), 1.0, 7.0, 7.0, 7.0),
    ], "source_system string, source_key_orden string, source_key_item string, source_code_prod string, "
       "cliente_key string, moneda string, fecha_dt date, cantidad_num double, precio_unit_num double, "
       "total_num double, line_total_num double").withColumn("canal_raw", F.lit("WEB"))
    return items, dim_t, dim_c, bridge, dim_p


def test_fx_conversion_exclusion_and_rerun(spark):
    items, dim_t, dim_c, bridge, dim_p = _setup(spark)
    f = warehouse.fact_ventas(items, dim_t, dim_c, bridge, dim_p)
    got = {r.SourceKey: float(r.TotalUSD) for r in f.collect()}
    assert got == {"o1-1": 10.0, "o3-1": 7.0}     # no rate on day 2 -> CRC line excluded; EUR unchanged
    again = warehouse.fact_ventas(items, dim_t, dim_c, bridge, dim_p, existing=f)
    assert again.count() == 0


def test_rate_rows_and_sync_keeps_old_rate(spark):
    feed = spark.createDataFrame([(dt.date(2024, 1, 1), 500.0, 510.0)], "fecha date, compra double, venta double")
    tc = merge.upsert_rates(None, feed)
    assert sorted((r.de, r.a, float(r.tasa)) for r in tc.collect()) == [("CRC", "USD", 500.0), ("USD", "CRC", 510.0)]
    bounds = spark.createDataFrame([(dt.date(2024, 1, 1), dt.date(2024, 1, 1))], "lo date, hi date")
    d1 = warehouse.dim_tiempo(bounds, tc)
    only_buy = tc.where("de = 'CRC'").withColumn("tasa", F.lit(505).cast("decimal(18,6)"))
    d2 = warehouse.dim_tiempo(bounds, only_buy, existing=d1).first()
    assert float(d2.TC_CRC_USD) == 505.0 and float(d2.TC_USD_CRC) == 510.0   # D6


def test_merges(spark):
    t = spark.createDataFrame([("a", 1, "x", 1)], "k string, v int, w string, seq int")
    b = spark.createDataFrame([("a", None, "y", 2), ("b", 5, "z", 3), ("b", 6, "q", 4)], "k string, v int, w string, seq int")
    over = {r.k: (r.v, r.w) for r in merge.merge_overwrite(t, b, ["k"]).collect()}
    assert over == {"a": (None, "y"), "b": (6, "q")}
    co = {r.k: (r.v, r.w) for r in merge.merge_coalesce(t, b, ["k"]).collect()}
    assert co["a"] == (1, "y")
    ins = {r.k: r.v for r in merge.merge_insert_only(t, b, ["k"]).collect()}
    assert ins == {"b": 5}                        # first row of a new key wins; existing key ignored
