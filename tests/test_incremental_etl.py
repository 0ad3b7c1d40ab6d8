"""The published run and its incremental successor."""
import datetime as dt

from pyspark.sql import functions as F

from salesmart.operators.warehouse import should_run
from salesmart.plans import etl
from salesmart.sources import fixtures

SF = "/root/testdata/sf0.001"
KEYS = ["Fuente", "SourceKey"]


def test_second_run_keeps_keys_and_adds_only_what_is_new(spark, tmp_path):
    src = fixtures.fixture_sources(spark, SF)
    rates = fixtures.fixture_rates(spark, SF)
    early = {**src, "mssql": {**src["mssql"], "Orden": src["mssql"]["Orden"].where(F.col("OrdenId") % 2 == 0),
                              "Cliente": src["mssql"]["Cliente"].where(F.col("ClienteId") % 10 == 0)},
             "mongo": {**src["mongo"], "productos": src["mongo"]["productos"].where(F.xxhash64("_id") % 3 != 0)}}
    out = str(tmp_path / "dw")
    t1, t2 = dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 2)
    one = etl.run_etl(spark, early, rates, out, load_ts=t1)
    two = etl.run_etl(spark, src, rates, out, previous=one["manifest"], load_ts=t2)
    three = etl.run_etl(spark, src, rates, out, previous=two["manifest"], load_ts=dt.datetime(2020, 1, 3))
    whole = etl.run_etl(spark, src, rates, str(tmp_path / "once"))
    m1, m2, m3, mw = (etl.read_manifest(spark, r["manifest"]) for r in (one, two, three, whole))
    tab = lambda m, n: etl.manifest_table(spark, m, n)

    for name, key, business in (("dim_cliente", "ClienteID", ["SourceSystem", "SourceKey"]), ("dim_producto", "ProductoID", ["SKU"])):
        a, b = ({tuple(r[c] for c in business): (r[key], r["LoadTS"]) for r in tab(m, name).collect()} for m in (m1, m2))
        assert a and all(b[k] == v for k, v in a.items())
        assert len(b) > len(a) or name == "dim_producto"
        assert len({v[0] for v in b.values()}) == len(b) and {v[1] for k, v in b.items() if k not in a} <= {t2}
    sku = lambda m: {(r.source_system, r.source_code): r.sku_oficial for r in tab(m, "map_producto").collect()}
    assert all(sku(m2)[k] == v for k, v in sku(m1).items())

    f1, f2, fw = (tab(m, "fact_ventas") for m in (m1, m2, mw))
    assert f2.count() == f2.select(*KEYS).distinct().count() == fw.count() > f1.count()
    total = lambda f: f.agg(F.sum("TotalUSD")).first()[0]
    assert total(f2) == total(fw)
    added = lambda m: tab({**m, "tables": {"fact_ventas": m["tables"]["fact_ventas"][-1:]}}, "fact_ventas").count()
    assert added(m2) == f2.count() - f1.count() and added(m3) == 0 and tab(m3, "fact_ventas").count() == f2.count()
    assert tab(m3, "run_log").count() == 3

    gate = should_run(etl.last_loads(spark, m2), etl.staged_maxima(spark, m2), now=dt.datetime(2020, 1, 2, 1))
    assert gate.count() == 1
    stamps = {r["table"]: r.last_ts for r in etl.last_loads(spark, m2).collect()}
    assert set(stamps) == {"dim_cliente", "dim_producto", "fact_ventas", "tipo_cambio"} and stamps["fact_ventas"] == t2


def test_high_water_looks_only_at_newer_lines(spark, tmp_path):
    src = fixtures.fixture_sources(spark, SF)
    rates = fixtures.fixture_rates(spark, SF)
    run = etl.run_etl(spark, src, rates, str(tmp_path), load_ts=dt.datetime(2020, 1, 1), high_water="2020-01-01 00:00:00")
    assert etl.manifest_table(spark, etl.read_manifest(spark, run["manifest"]), "fact_ventas").count() == 0
