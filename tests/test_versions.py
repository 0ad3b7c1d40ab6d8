"""Versions behind one manifest: resets in order, and what a commit leaves alone."""
from salesmart.operators import versions as V


def test_reset_orders_and_untouched_tables(spark, tmp_path):
    base = str(tmp_path)
    rows = lambda n: spark.createDataFrame([(i, "mysql" if i % 2 else "mongo") for i in range(n)], "id long, source_system string")
    names = ["association_rules", "fact_ventas", "dim_tiempo", "stg_clientes", "map_producto", "stg_orden_items", "tipo_cambio"]
    first = V.commit(spark, base, {n: rows(4) for n in names})
    count = lambda m: {n: V.version_table(spark, V.read_version(spark, m), n).count() for n in names}

    utility, order = V.reset_warehouse(spark, base, first, "utility")
    assert order == ["fact_ventas", "association_rules", "dim_tiempo"]
    assert count(utility) == {n: 0 if n in order else 4 for n in names}
    full, order = V.reset_warehouse(spark, base, first, "full")
    assert order == ["fact_ventas", "dim_tiempo", "map_producto", "stg_orden_items", "stg_clientes", "tipo_cambio"]
    assert count(full) == {n: 4 if n == "association_rules" else 0 for n in names}
    one = V.reset_staging(spark, base, first, "mysql")
    assert count(one) == {n: 2 if n in V.STAGING_TABLES else 4 for n in names}
    assert count(first) == {n: 4 for n in names}                       # an old version stays as it was
    old, new = (V.read_version(spark, m)["tables"] for m in (first, one))
    assert new["fact_ventas"] == old["fact_ventas"] and new["stg_clientes"] != old["stg_clientes"]
