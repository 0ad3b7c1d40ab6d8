"""Failures are raised, rejects are complete, ties are settled: the cases a small run hides."""
import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from salesmart.functions import clean
from salesmart.functions.country import country_codes, country_table
from salesmart.operators import bulk, orders
from salesmart.operators.warehouse import fact_ventas, spine_bounds
from salesmart.sources.readers import read_bulk, read_jdbc_table, uuid_predicates

SF = "/root/testdata/sf0.01"
KEYED = ["dim_cliente", "dim_producto", "dim_tiempo", "fact_ventas", "baskets", "vw_ventas_mensuales", "kpi_total", "kpi_growth_yoy",
         "kpi_top_clients", "kpi_top_products", "kpi_category_share", "kpi_avg_ticket", "kpi_active_clients", "kpi_channel_month",
         "kpi_mom_accum", "ventas_vs_metas", "equivalence_map"]


@pytest.mark.parametrize("name", KEYED)
def test_keyed_queries_at_the_larger_scale(spark, name):
    from test_queries_oracle import TABLES, _norm
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = E.queries()[name](spark, SF)
    cols = sorted(df.columns)
    cur = con.execute(E.oracle_sql()[name])
    at = {d[0]: i for i, d in enumerate(cur.description)}
    want = sorted((tuple(_norm(r[at[c]]) for c in cols) for r in cur.fetchall()), key=repr)
    assert sorted((tuple(_norm(r[c]) for c in cols) for r in df.select(*cols).collect()), key=repr) == want


def test_country_table_is_complete(spark):
    t = country_table(spark)
    assert t.count() >= 245 and t.select("alpha_2").distinct().count() == t.count()
    v = spark.createDataFrame([("Iceland",), ("korea",), ("cr",), ("nowhere at all",), ("Kenya",), (None,)], "p string")
    got = {r.p: r.c for r in country_codes(v, "p", "c", t).collect()}
    assert got == {"Iceland": "IS", "korea": "KR", "cr": "CD", "nowhere at all": "", "Kenya": "KE", None: ""}


def test_long_sku_is_not_cut(spark):
    text = "SKU" + "7" * 2_000_000
    df = spark.createDataFrame([(text,)], "s string")
    assert df.select(F.length(clean.normalize_sku("s"))).first()[0] == len(text) + 1


def test_high_water_needs_a_timestamp(spark):
    df = spark.createDataFrame([(1,)], "x int")
    with pytest.raises(ValueError):
        fact_ventas(df, df, df, df, df, high_water="2020-01-01")


def test_stray_dates_do_not_stretch_the_spine(spark):
    df = spark.createDataFrame([("1999-01-05",), ("9999-12-31",), ("0001-01-01",), ("1998-03-01",)], "d string")
    lo, hi = spine_bounds((df, "d"), first="1990-01-01", last="2030-12-31").first()
    assert (str(lo), str(hi)) == ("1998-03-01", "1999-01-05")


def test_absent_sheet_is_none_and_a_broken_one_raises(spark, tmp_path):
    (tmp_path / "Cliente.parquet").mkdir()
    (tmp_path / "Cliente.parquet" / "part.parquet").write_bytes(b"not parquet")
    with pytest.raises(Exception, match="(?i)parquet"):
        read_bulk(spark, str(tmp_path), fmt="parquet")
    out = read_bulk(spark, str(tmp_path / "nothing"))
    assert set(out.values()) == {None}


def test_sheet_rows_follow_the_files(spark, tmp_path):
    d = tmp_path / "Producto.csv"
    d.mkdir()
    (d / "a.csv").write_text("SKU,Nombre,Categoria\n" + "\n".join(f"S{i},n,c" for i in range(50)))
    (d / "b.csv").write_text("SKU,Nombre,Categoria\n" + "\n".join(f"S{i},n,c" for i in range(50, 4000)))
    rows = read_bulk(spark, str(tmp_path))["Producto"].select("SKU", "_row").collect()
    assert {r.SKU: r["_row"] for r in rows} == {f"S{i}": i + 1 for i in range(4000)}


def test_jdbc_reads_must_say_how_they_split(spark):
    with pytest.raises(ValueError):
        read_jdbc_table(spark, "jdbc:none", "t", {})
    con = duckdb.connect()
    con.execute("CREATE TABLE t AS SELECT CASE WHEN i % 50 = 0 THEN NULL ELSE uuid() END AS id FROM range(5000) r(i)")
    for parts in (1, 2, 7, 64):
        hits = [con.execute(f"SELECT count(*) FROM t WHERE {p}").fetchone()[0] for p in uuid_predicates("id", parts)]
        assert sum(hits) == 5000 and len(hits) == parts


def test_every_event_is_applied_or_rejected(spark):
    o = spark.createDataFrame([("a", "WEB", 5.0), ("b", "APP", 6.0), ("c", "WEB", 7.0)], "orden_id string, canal string, total double")
    ln = spark.createDataFrame([("a", "l1", 1, 5.0), ("b", "l2", 2, 3.0)], "orden_id string, orden_detalle_id string, cantidad int, precio_unit double")
    items = "items array<struct<cantidad:int,precio_unit:double>>"
    ev = spark.createDataFrame([("create", "a", "X", None, 1), ("create", "n", "APP", [(2, 4.0), (1, 0.5)], 1), ("update", "b", None, [(3, 2.0)], 1),
                                ("delete", "c", None, None, 1), ("delete", "zz", None, None, 1), ("upsert", "b2", None, None, 1),
                                (None, "b3", None, None, 1), ("create", "empty", "WEB", None, 1)],
                               f"op string, orden_id string, canal string, {items}, seq int")
    out, lines, rej = orders.apply_order_changes(o, ln, ev)
    assert {tuple(r) for r in out.collect()} == {("a", "WEB", 5.0), ("n", "APP", 8.5), ("b", "APP", 6.0), ("empty", "WEB", 0.0)}
    assert {(r.orden_id, r.orden_detalle_id, r.cantidad) for r in lines.collect()} == {("a", "l1", 1), ("n", "n-1", 2), ("n", "n-2", 1), ("b", "b-1", 3)}
    assert {(r.orden_id, r.motivo) for r in rej.collect()} == {("a", "existing_order"), ("zz", "unknown_order"), ("b2", "unknown_op"), ("b3", "unknown_op")}


def test_upload_rules(spark):
    def codes(df, rules):
        return sorted(c for r in bulk.sheet_violations(df, rules).collect() for c in r.violaciones)
    c = spark.createDataFrame([(1, "", "x@y", "Otro", "p" * 61)], "_row long, Nombre string, Email string, Genero string, Pais string")
    assert codes(c, bulk.client_rules_mssql()) == ["email_invalido", "genero_invalido", "nombre_requerido", "pais_largo"]
    p = spark.createDataFrame([(1, "s" * 41, None, "c")], "_row long, SKU string, Nombre string, Categoria string")
    assert codes(p, bulk.product_rules_mssql()) == ["nombre_requerido", "sku_largo"]
    o = spark.createDataFrame([(1, "a@b.co", None, "USD", 1.0)], "_row long, Email string, Canal string, Moneda string, Total double")
    assert codes(o, bulk.order_rules_mssql()) == ["canal_invalido"]
    m = spark.createDataFrame([(1, "a@b.co", "c" * 21, "EUR", "-5"), (2, "a@b.co", "free text", None, "0")],
                              "_row long, correo string, canal string, moneda string, total string")
    assert codes(m, bulk.order_rules_mysql()) == ["canal_largo", "moneda_invalida"]
    ln = spark.createDataFrame([(1, 0, "", 0, None)], "_row long, OrdenIndex int, codigo_alt string, cantidad int, precio_unit string")
    assert codes(ln, bulk.line_rules_mysql()) == ["cantidad_invalida", "codigo_requerido", "orden_index_invalido", "precio_requerido"]


def test_first_registration_date_of_a_new_email(spark):
    stored = spark.createDataFrame([(1, "old", "a@b.co", "2001-01-01")], "ClienteId int, Nombre string, Email string, FechaRegistro string")
    up = spark.createDataFrame([(1, "n1", "new@b.co", "2010-01-01"), (2, "n2", "new@b.co", "2020-01-01"), (3, "upd", "a@b.co", "2022-01-01")],
                               "_row int, Nombre string, Email string, FechaRegistro string")
    t, _ = bulk.upsert_clients_by_email(stored, up)
    assert {(r.Email, r.Nombre, r.FechaRegistro) for r in t.collect()} == {("new@b.co", "n2", "2010-01-01"), ("a@b.co", "upd", "2001-01-01")}


def test_plans_join_only_what_they_name(spark):
    def tree(name):
        return E.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    for name in ("kpi_growth_yoy", "kpi_mom_accum", "kpi_channel_month", "kpi_active_clients"):
        assert "Join" not in tree(name) and tree(name).count("FileScan") == 1
    assert tree("ventas_vs_metas").count("Anio#") and tree("ventas_vs_metas").split("Join", 1)[1].count("REPARTITION") <= 1


def test_keyset_pages_are_the_offset_pages(spark):
    from salesmart.operators.listing import PageSpec, page, page_after
    df = spark.range(60).select(F.col("id").alias("k"), F.when(F.col("id") % 7 > 0, F.col("id") % 5).alias("v"))
    for sort_by, order in (("v", "asc"), ("v", "desc"), (None, "asc"), (None, "desc")):
        last = None
        for n in range(1, 10):
            want = [tuple(r) for r in page(df, "k", PageSpec(page=n, limit=7, sort_by=sort_by, sort_order=order), ("v",)).collect()]
            got = [tuple(r) for r in page_after(df, "k", PageSpec(limit=7, sort_by=sort_by, sort_order=order), ("v",), last).collect()]
            assert got == want
            last = (got[-1][1], got[-1][0])
