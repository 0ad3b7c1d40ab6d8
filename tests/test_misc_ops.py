"""Small sinks and helpers: source selection, resets, run log, high-water,
FX feed parse, text helpers, regex id filter, absent sources."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from salesmart.functions import clean
from salesmart.operators import equivalence as eqv
from salesmart.operators import merge
from salesmart.plans.etl import select_sources
from salesmart.sources.readers import fx_feed_pair, parse_fx_feed


def test_select_sources():
    assert select_sources(None) == ["mssql", "mysql", "supabase", "mongo", "neo4j"]
    assert select_sources(["mysql, mongo", "mysql"]) == ["mongo", "mysql"]
    assert select_sources(["all"]) == sorted(["mssql", "mysql", "supabase", "mongo", "neo4j"])
    with pytest.raises(ValueError):
        select_sources(["oracle"])


def test_reset_log_high_water(spark):
    t = spark.createDataFrame([("mssql", 1), ("mysql", 2)], "source_system string, v int")
    assert [r.source_system for r in merge.reset_source(t, "mssql").collect()] == ["mysql"]
    assert merge.reset_source(t, None).count() == 0 and merge.empty_like(t).count() == 0
    log = merge.append_log(None, spark, "carga", "OK", "dias=3", 1.5)
    log = merge.append_log(log, spark, "carga", "ERROR", "x", 0.1)
    assert log.count() == 2
    d = spark.createDataFrame([(dt.date(2024, 1, 5),)], "fecha date")
    hw = merge.advance_high_water(None, d)
    older = spark.createDataFrame([(dt.date(2023, 1, 1),)], "fecha date")
    assert merge.advance_high_water(hw, older).first().hw == dt.date(2024, 1, 5)   # only moves forward


def test_fx_feed_parse(spark):
    xml = ("<R><DES_FECHA>2024-01-02T00:00:00-06:00</DES_FECHA><NUM_VALOR> 505.12 </NUM_VALOR></R>"
           "<R><DES_FECHA></DES_FECHA><NUM_VALOR>1</NUM_VALOR></R>"
           "<R><DES_FECHA>2024-01-03T00:00:00-06:00</DES_FECHA><NUM_VALOR>abc</NUM_VALOR></R>")
    buy = parse_fx_feed(spark.createDataFrame([(xml,)], "xml string"))
    rows = sorted((r.fecha, None if r.valor is None else float(r.valor)) for r in buy.collect())
    assert rows == [(dt.date(2024, 1, 2), 505.12), (dt.date(2024, 1, 3), None)]
    sell = buy.withColumn("valor", F.col("valor") + 10)
    assert fx_feed_pair(buy, sell).count() == 2


def test_text_helpers_and_id_filter(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 5, 6, 7, 8, 9), 3, 2.5, "ORD-12"), (None, 1, 1.0, "X-1")],
                               "ts timestamp, q int, p double, id string")
    r = df.select(clean.date_text(F.col("ts")).alias("a"), clean.date_text(F.col("ts"), True).alias("b"),
                  clean.line_total(F.col("q"), F.col("p")).alias("c"),
                  F.col("id").rlike(r"^(ORD-\d+|O\d+)$").alias("ok")).collect()
    assert (r[0].a, r[0].b, r[0].c, r[0].ok) == ("2024-05-06", "2024-05-06 07:08:09", 7.5, True)
    assert r[1].ok is False


def test_absent_sources_tolerated(spark):
    m = spark.createDataFrame([(1, "SKU-0005", "A", "c")], "ProductoId int, SKU string, Nombre string, Categoria string")
    out = eqv.build_equivalence_map({"mssql": m, "mysql": None, "supabase": None, "mongo": None, "neo4j": None})
    assert [r.sku_oficial for r in out.collect()] == ["SKU-0005"]


def test_sql_functions_match_columns(spark):
    from salesmart.functions.sql_functions import register_sql_functions
    register_sql_functions(spark)
    vals = ["m", "HOMBRE", " f ", "mujer", "X", "", None, "online", "retail", "fax", " SKU1234 ", "SKU-7", "ALT-1"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v string")
    df.createOrReplaceTempView("sm_vals")
    a = spark.sql("SELECT i, sm_gender(v) g, sm_channel(v) c, sm_normalize_sku(v) s, sm_sku_number(v) n, "
                  "sm_match_key(v) k FROM sm_vals ORDER BY i").collect()
    b = df.orderBy("i").select("i", clean.gender_shared(F.col("v")).alias("g"), clean.channel_shared(F.col("v")).alias("c"),
                               clean.normalize_sku(F.col("v")).alias("s"), clean.sku_number(F.col("v")).alias("n"),
                               clean.match_key(F.col("v")).alias("k")).collect()
    assert a == b


def test_json_items_and_validations(spark):
    from salesmart.operators import orders
    df = spark.createDataFrame([('[{"producto_id": "p1", "cantidad": 2, "precio_unitario": 3.5}]',), ("not json",)],
                               "items string")
    r = df.select(clean.items_from_json(F.col("items"), "producto_id string, cantidad int, precio_unitario double")
                  .alias("it")).collect()
    assert r[0].it[0].cantidad == 2 and r[1].it is None
    ids = spark.createDataFrame([("ORD-000001",), ("O77",), ("XORD-1",), ("ORD-1x",)], "id string")
    assert sorted(x.id for x in orders.valid_order_ids(ids).collect()) == ["O77", "ORD-000001"]
    bridge = spark.createDataFrame([("SKU-1", "TV", "Elec")], "sku_oficial string, nombre_norm string, categoria_norm string")
    p = spark.createDataFrame([("sku-1", "tv", "ELEC"), ("SKU-2", "TV", "Elec")], "s string, n string, c string")
    got = {r.s: r.valido for r in orders.validate_against_bridge(p, bridge, "s", "n", "c").collect()}
    assert got == {"sku-1": True, "SKU-2": False}


def test_rate_loading_helpers(spark):
    from salesmart.operators import warehouse
    feed = spark.createDataFrame([(dt.date(2024, 1, 1), 500.0, 510.0), (dt.date(2024, 1, 2), 501.0, 511.0)],
                                 "fecha date, compra double, venta double")
    tc = merge.upsert_rates(None, feed.where("fecha = '2024-01-01'"))
    assert [r.fecha for r in warehouse.new_rate_days(feed, tc).collect()] == [dt.date(2024, 1, 2)]
    b = warehouse.backfill_range(tc, "2024-06-30", 3).first()
    assert b.cargar is True and b.desde == dt.date(2021, 6, 30)


def test_safe_casts_and_shared_dates(spark):
    df = spark.createDataFrame([("1,234.5", "12", "2024/05/06"), ("x", None, "06-05-2024")], "a string, b string, d string")
    r = df.select(clean.safe_decimal(F.col("a"), 18, 2, 0).alias("dec"), clean.safe_int(F.col("b"), -1).alias("i"),
                  clean.safe_float(F.col("a")).alias("f"), clean.safe_date(F.col("d")).alias("t")).collect()
    assert float(r[0].dec) == 1234.5 and r[0].i == 12 and r[0].f == 1234.5 and r[0].t == dt.datetime(2024, 5, 6)
    assert float(r[1].dec) == 0 and r[1].i == -1 and r[1].f is None and r[1].t == dt.datetime(2024, 5, 6)


def test_rule_products_json(spark):
    from salesmart.operators import rules
    r = spark.createDataFrame([("A", "B, C", ["B", "C"])], "Antecedent string, Consequent string, consequents array<string>")
    p = spark.createDataFrame([("B", "Bolt", "11"), ("C", "Cog", "12")], "SKU string, Nombre string, SourceKey string")
    j = rules.rule_products_json(r, p).first().productos_json
    assert j == '[{"SKU":"B","Nombre":"Bolt","codigo":"11"},{"SKU":"C","Nombre":"Cog","codigo":"12"}]'


def test_product_upsert_on_code(spark):
    stored = spark.createDataFrame([("ALT-1", "old", "c", 0)], "codigo_alt string, nombre string, categoria string, seq int")
    up = spark.createDataFrame([("ALT-1", "new", "c", 1), ("ALT-2", "n2", "c", 2)],
                               "codigo_alt string, nombre string, categoria string, seq int")
    got = {r.codigo_alt: r.nombre for r in merge.merge_overwrite(stored, up, ["codigo_alt"]).collect()}   # BL3
    assert got == {"ALT-1": "new", "ALT-2": "n2"}


def test_run_etl_on_extracts(spark, tmp_path):
    """Entry A on real-shaped extracts: the fixture sources of sf0.001 handed
    in as plain frames, every table published to a version folder."""
    from salesmart.plans import etl
    from salesmart.sources import fixtures
    sf = "/root/testdata/sf0.001"
    paths = etl.run_etl(spark, fixtures.fixture_sources(spark, sf), fixtures.fixture_rates(spark, sf), str(tmp_path))
    fact = spark.read.parquet(paths["fact_ventas"])
    assert fact.count() > 0 and "/v-" in paths["dim_producto"]
    assert fact.groupBy("Fuente", "SourceKey").count().where("count > 1").count() == 0


def test_bucketed_fact_rerun_does_not_shuffle_the_fact(spark, tmp_path):
    import contextlib
    import io
    import re
    from salesmart.plans import etl
    from salesmart.operators import warehouse
    from salesmart.sources import fixtures
    sf = "/root/testdata/sf0.001"
    paths = etl.run_etl(spark, fixtures.fixture_sources(spark, sf), fixtures.fixture_rates(spark, sf),
                        str(tmp_path), fact_buckets=4, fact_table="fact_bucketed_test")
    fact = spark.table("fact_bucketed_test")
    r = lambda n: spark.read.parquet(paths[n])
    again = warehouse.fact_ventas(r("stg_orden_items"), r("dim_tiempo"), r("dim_cliente"), r("map_producto"),
                                  r("dim_producto"), existing=fact)
    assert again.count() == 0                                     # idempotent re-run
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        again.explain("formatted")
    plan = buf.getvalue()
    blocks = [b for b in plan.split("\n\n") if re.match(r"\(\d+\) Scan parquet spark_catalog\.default\.fact_bucketed_test", b)]
    assert blocks and "Bucketed: true" in blocks[0]                 # read bucket by bucket
    # the fact side of the anti join reaches the join without an exchange
    tree = plan.split("\n\n")[0]
    fact_branch = tree[tree.index("SortMergeJoin"):]
    fact_branch = fact_branch[fact_branch.rindex("+- Sort"):]     # the join's right child: the fact
    assert "Exchange" not in fact_branch


def test_streaming_load_into_bucketed_fact(spark, tmp_path):
    """SM1 into a bucketed fact: two streams over the same lines (fresh
    checkpoints) - the second adds nothing; totals equal the batch load."""
    from salesmart.plans import etl
    from salesmart.streaming import ingest
    sf = "/root/testdata/sf0.001"
    w = etl.warehouse_tables(spark, sf)
    ingest.write_lines_by_year(w["stg_orden_items"], str(tmp_path / "in"))
    for run in ("a", "b"):
        ingest.stream_fact_load_bucketed(spark, str(tmp_path / "in"), w, str(tmp_path / "fact"),
                                         str(tmp_path / f"ckpt_{run}"), "fact_stream_test", 4)
    got = spark.table("fact_stream_test")
    assert got.count() == w["fact_ventas"].count()
    assert got.groupBy("Fuente", "SourceKey").count().where("count > 1").count() == 0


def test_relationship_triplets_of_all_types(spark):
    from salesmart.sources.readers import relationship_triplets
    graph = {"Cliente": spark.createDataFrame([("c1", "Ana", None)], "id string, nombre string, pais string"),
             "Orden": spark.createDataFrame([("o1", 2.5)], "id string, total double"),
             "Producto": spark.createDataFrame([], "id string, nombre string"),
             "Categoria": spark.createDataFrame([("k1",)], "id string"),
             "REALIZO": spark.createDataFrame([("c1", "o1"), ("c1", "o1"), ("c9", None)], "from_id string, to_id string"),
             "CONTIENE": spark.createDataFrame([("o1", "p1", 3)], "from_id string, to_id string, cantidad int"),
             "PERTENECE_A": spark.createDataFrame([], "from_id string, to_id string")}
    got = sorted(((r.type, r.from_label, r.from_id, r.from_props, r.to_label, r.to_id, r.to_props, r.props)
                  for r in relationship_triplets(graph).collect()), key=repr)
    ana, order = {"nombre": "Ana", "pais": None}, {"total": "2.5"}
    assert got == sorted([("REALIZO", "Cliente", "c1", ana, "Orden", "o1", order, {})] * 2
                         + [("REALIZO", "Cliente", "c9", None, "Orden", None, None, {}),
                            ("CONTIENE", "Orden", "o1", order, "Producto", "p1", None, {"cantidad": "3"})], key=repr)
