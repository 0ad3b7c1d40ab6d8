"""The warehouse build at size: what is not asked for is not built, unique lines are not shuffled."""
from pyspark.sql import functions as F

from salesmart.operators import staging
from salesmart.plans import etl

SF = "/root/testdata/sf0.001"


def test_rates_do_not_wait_for_the_fact(spark):
    w = etl.Warehouse(spark, SF, "line", etl.ensure_checkpoint_dir(spark) + "/rates_only")
    assert w["tipo_cambio"].count() > 0
    assert "fact_ventas" not in w and "items_all" not in w
    w["stg_orden_items"]
    assert "fact_ventas" not in w and "eq_map" not in w


def _lines(spark, rows):
    cols = {c: F.lit(None).cast("string") for c in staging.ITEM_COLS}
    df = spark.createDataFrame(rows, "source_system string, source_key_orden string, source_key_item string, seq long, reject_reason string")
    return df.select(*[F.col(c) if c in df.columns else v.alias(c) for c, v in cols.items()])


def test_only_repeated_lines_are_grouped(spark, tmp_path, monkeypatch):
    rows = [("a", str(i), "x", 0, None) for i in range(200)] + [("a", "7", "x", -1, None), ("a", None, "x", 5, None), ("a", None, "x", 3, None),
                                                                ("b", "1", None, 1, None), ("a", "300", "x", 0, "orphan")]
    items = _lines(spark, rows)
    want = sorted(map(str, staging.stage_items(items).select(*items.columns).collect()))
    got = staging.stage_landed_items(items, str(tmp_path / "r"))
    assert sorted(map(str, got.select(*items.columns).collect())) == want and len(want) == 202
    once = got._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti, BuildRight" in once and "LeftSemi, BuildRight" in once and "SortMergeJoin" not in once
    monkeypatch.setattr(staging, "MAX_REPEATED", 1)           # too many to broadcast: the grouping of all lines
    got = staging.stage_landed_items(items, str(tmp_path / "r2"))
    assert sorted(map(str, got.select(*items.columns).collect())) == want


def test_rerun_joins_only_new_lines(spark):
    w = etl.warehouse_tables(spark, SF)
    from salesmart.operators.warehouse import fact_ventas, unloaded_items
    args = (w["dim_tiempo"], w["dim_cliente"], w["map_producto"], w["dim_producto"])
    again = fact_ventas(unloaded_items(w["stg_orden_items"], w["fact_ventas"]), *args)
    tree = again._jdf.queryExecution().optimizedPlan().toString()
    assert tree.index("Join Inner, ((cliente_key") < tree.index("Join LeftAnti, ((source_system")        # the anti join is below the dimension joins
    assert again.count() == 0
    some = w["fact_ventas"].where("ProductoID % 3 = 0")
    new = fact_ventas(unloaded_items(w["stg_orden_items"], some), *args)
    assert new.count() == w["fact_ventas"].count() - some.count()
    assert new.join(some, ["Fuente", "SourceKey"]).count() == 0


def test_baskets_are_mined_once(spark, monkeypatch):
    from salesmart.operators import rules as R
    from salesmart.plans import rule_queries
    calls, real = [], R.mining_baskets
    monkeypatch.setattr(R, "mining_baskets", lambda *a, **k: calls.append(1) or real(*a, **k))
    monkeypatch.setattr(etl, "_RULES_CACHE", {})
    rule_queries._rules(spark, SF)
    assert len(calls) == 1


def test_lines_by_year_are_read_once(spark, tmp_path):
    from salesmart.streaming.ingest import write_lines_by_year
    seen = spark.sparkContext.accumulator(0)
    items = etl.warehouse_tables(spark, SF)["stg_orden_items"].select("source_system", "source_key_orden", "source_key_item", "fecha_dt")

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b
    n = items.count()
    write_lines_by_year(items.mapInPandas(count, items.schema), str(tmp_path / "in"))
    assert seen.value == n == spark.read.parquet(str(tmp_path / "in")).count()
