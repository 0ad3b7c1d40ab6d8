"""Tables with many rows in small files are not broadcast: the driver would have to hold them (findings F2, F7 of round 4)."""
import pytest

from salesmart.operators import keys
from salesmart.operators.quality import load_diagnostics
from salesmart.plans import etl

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def few_rows(monkeypatch):
    monkeypatch.setattr(keys, "MAX_LOOKUP_ROWS", 10)


def test_diagnostics_do_not_broadcast_long_dimensions(spark, few_rows):
    w = etl.warehouse_tables(spark, SF)
    args = (w["stg_orden_items"], w["dim_tiempo"], w["dim_cliente"], w["map_producto"], w["dim_producto"], w["fact_ventas"])
    tree = _plan(load_diagnostics(*args))
    for c in ("_ck", "_psku", "_fk"):                          # clients, products, loaded lines
        side = next(x for x in tree.splitlines() if "Join" in x and f"{c}#" in x)
        assert "SortMergeJoin" in side, side
    got = sorted(map(tuple, load_diagnostics(*args).collect()))
    keys.MAX_LOOKUP_ROWS = 200_000
    assert got == sorted(map(tuple, load_diagnostics(*args).collect()))


def test_reruns_do_not_broadcast_long_tables(spark, few_rows):
    from salesmart.operators.warehouse import dim_cliente, dim_producto, fact_ventas, unloaded_items
    w = etl.warehouse_tables(spark, SF)
    args = (w["dim_tiempo"], w["dim_cliente"], w["map_producto"], w["dim_producto"])
    again = fact_ventas(unloaded_items(w["stg_orden_items"], w["fact_ventas"]), *args)
    sides = [x for x in _plan(again).splitlines() if "Join" in x and ("_ck#" in x or "LeftAnti, [source_system" in x or "source_system#" in x and "_sk#" in x)]
    assert sides and not any("Broadcast" in x for x in sides), sides
    assert again.count() == 0 == fact_ventas(w["stg_orden_items"], *args, existing=w["fact_ventas"]).count()
    assert "BroadcastHashJoin" not in _plan(fact_ventas(w["stg_orden_items"], *args, existing=w["fact_ventas"])).split("LeftAnti")[0].splitlines()[-1]
    assert dim_cliente(w["stg_clientes"], w["dim_tiempo"], w["dim_cliente"]).count() == w["dim_cliente"].count()
    assert dim_producto(w["map_producto"], w["dim_producto"]).count() == w["dim_producto"].count()
