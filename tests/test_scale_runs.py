"""Re-runs of the load: only new lines are written, only keys are shuffled to find them (findings F1, F4 of round 4)."""
from pyspark.sql import functions as F

from salesmart.operators import staging
from salesmart.plans import etl, run_queries

SF = "/root/testdata/sf0.001"


def test_staged_lines_are_kept_in_one_folder_a_run(spark):
    _, runs = run_queries._runs(spark, SF)
    ms = [etl.read_manifest(spark, r["manifest"]) for r in runs]
    folders = [m["tables"]["stg_orden_items"] for m in ms]
    assert [len(f) for f in folders] == [1, 2, 3] and folders[2][:2] == folders[1]
    tables = [etl.manifest_table(spark, m, "stg_orden_items") for m in ms]
    rows = [t.count() for t in tables]
    assert rows[0] < rows[1] == rows[2] == etl.warehouse_tables(spark, SF)["stg_orden_items"].count()
    assert tables[2].select(*staging.ITEM_KEYS).distinct().count() == rows[2]
    assert spark.read.parquet(folders[2][2]).count() == 0


def test_lines_new_to_the_staged_ones(spark, tmp_path, monkeypatch):
    cols = "source_system string, source_key_orden string, source_key_item string, n int"
    items = spark.createDataFrame([("a", str(i), "x", i) for i in range(300)] + [("a", None, "x", -1), ("b", "1", "x", -2)], cols)
    had = items.where("n >= 0 and n % 3 > 0").drop("n").withColumn("other", F.lit(1))
    want = sorted(map(str, items.join(had, staging.ITEM_KEYS, "left_anti").select(*items.columns).collect()))
    for words in (staging.WORDS, 2, 1):                       # 1, 2: most old lines meet the mark of a new one
        monkeypatch.setattr(staging, "WORDS", words)
        got = staging.unstaged_items(items, had, str(tmp_path / f"n{words}"))
        assert sorted(map(str, got.select(*items.columns).collect())) == want and len(want) == 102
    tree = got._jdf.queryExecution().optimizedPlan().toString()
    assert tree.index("LeftAnti") < tree.index("Join Inner")       # marks are looked at below the comparison
    none = staging.unstaged_items(items.where("n >= 0"), items.drop("n"), str(tmp_path / "none"))
    assert none.count() == 0
