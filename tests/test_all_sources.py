"""Queries over all the sources (or sheets) their feature covers: each shows up in the result."""
import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def _rows(spark, name):
    return E.queries()[name](spark, SF).collect()


def test_bulk_violations_cover_both_sources(spark):
    got = {(r.fuente, r.hoja, r.regla) for r in _rows(spark, "bulk_violations_all")}
    assert {("mssql", "Orden", "canal_invalido"), ("mssql", "OrdenDetalle", "sku_requerido"), ("mysql", "Orden", "correo_invalido"),
            ("mysql", "OrdenDetalle", "codigo_requerido")} <= got


def test_every_named_source_shows_up(spark):
    five = {"mssql", "mysql", "supabase", "mongo", "neo4j"}
    for name, sources in [("order_payload_violations_all", {"mongo", "supabase", "neo4j"}), ("lookup_by_name_all", five),
                          ("bridge_validation_all", {"supabase", "neo4j", "mongo"}), ("sku_by_name_fallback_all", five - {"mssql"}),
                          ("order_total_check_all", five), ("codes_to_skus_all", {"mongo", "supabase"})]:
        assert {r.fuente for r in _rows(spark, name)} == sources, name


def test_orders_without_lines_are_checked(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet").count()
    got = _rows(spark, "order_total_check_all")
    assert sum(r.ordenes_revisadas for r in got) == orders and sum(r.sin_lineas for r in got) == 27


def test_total_mismatches_keeps_orders_without_lines(spark):
    from pyspark.sql import functions as F
    from salesmart.operators.orders import total_mismatches
    o = spark.createDataFrame([(1, 5.0), (2, 3.0), (3, 0.0), (4, None)], "k int, total double")
    d = spark.createDataFrame([(1, 5.0), (4, 1.0)], "k int, v double")
    assert {r.k for r in total_mismatches(o, d, "k", "total", F.col("v")).collect()} == {2, 4}


def test_append_and_upsert_keep_ids(spark):
    from salesmart.operators import bulk
    stored = spark.createDataFrame([(3, "a", "x"), (7, "b", "y")], "id int, codigo_alt string, nombre string")
    up = spark.createDataFrame([(1, "b", "y1"), (2, "c", "z"), (3, "b", "y2"), (4, "d", "w"), (5, "c", "z2")],
                               "_row int, codigo_alt string, nombre string")
    table, actions = bulk.upsert_products(stored, up, "codigo_alt", "id")
    assert sorted(map(tuple, table.collect())) == [(3, "a", "x"), (7, "b", "y2"), (8, "c", "z2"), (9, "d", "w")]
    assert sorted(map(tuple, actions.collect())) == [("b", "actualizado"), ("c", "insertado"), ("d", "insertado")]
    clients = spark.createDataFrame([(4, "e@x.y", "F")], "id int, correo string, genero string")
    more = spark.createDataFrame([(2, None, None), (1, "e@x.y", "X")], "_row int, correo string, genero string")
    got = sorted(map(tuple, bulk.append_clients(clients, more, "id", {"genero": "M"}).collect()))
    assert got == [(4, "e@x.y", "F"), (5, "e@x.y", "X"), (6, None, "M")]


def test_last_log_rows_and_rates(spark):
    from salesmart.operators.quality import last_log_rows, rates_of_day
    log = spark.sql("SELECT 'etl' AS tipo, 'OK' AS estado, CAST(id AS string) AS mensaje, timestamp_seconds(id) AS ts FROM range(15)")
    assert [r.mensaje for r in last_log_rows(log).collect()] == [str(i) for i in range(14, 4, -1)]
    rates = spark.sql("SELECT DATE'2020-01-01' AS fecha, 'USD' AS de, 'CRC' AS a, 510.0 AS tasa")
    assert [(r[0] and float(r[0]), r[1]) for r in rates_of_day(rates, "2020-01-01").collect()] == [(510.0, None)]
