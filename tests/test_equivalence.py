"""Product equivalence golden cases (FIXTURES C1) and the free-number allocation."""
import pytest
from pyspark.sql import functions as F

from salesmart.operators import equivalence as eqv
from salesmart.operators.keys import global_row_number


def _frames(spark, mssql=(), mysql=(), supabase=(), mongo=(), neo4j=()):
    return {
        "mssql": spark.createDataFrame(list(mssql), "ProductoId int, SKU string, Nombre string, Categoria string"),
        "mysql": spark.createDataFrame(list(mysql), "id int, codigo_alt string, nombre string, categoria string"),
        "supabase": spark.createDataFrame(list(supabase), "producto_id string, sku string, nombre string, categoria string"),
        "mongo": spark.createDataFrame(list(mongo), "_id string, codigo_mongo string, nombre string, categoria string, "
                                                     "equivalencias struct<sku:string, codigo_alt:string>"),
        "neo4j": spark.createDataFrame(list(neo4j), "id string, nombre string, categoria string, sku string, "
                                                     "codigo_alt string, codigo_mongo string"),
    }


def _bridge(spark, frames, max_sku=0):
    std = eqv.standardize_products(frames)
    m = eqv.build_equivalence_map(frames, max_sku)
    b = eqv.bridge_rows(std, m, frames)
    return {(r.source_system, r.source_code): (r.sku_oficial, r.es_servicio) for r in b.collect()}


def test_in_mssql(spark):
    f = _frames(spark, mssql=[(1, "SKU-1000", "TV", "Elec")], mysql=[(1, "ALT-AB12", "tv ", "elec")],
                mongo=[("m1", "MN-4000", "TV", "Elec", ("SKU-1000", None))],
                neo4j=[("SKU1000", "TV", "Elec", "SKU1000", None, None)])
    b = _bridge(spark, f)
    assert {v[0] for v in b.values()} == {"SKU-1000"}
    assert ("neo4j", "SKU1000") in b          # bridge keeps the raw graph sku


def test_mongo_has_it_and_generated(spark):
    f = _frames(spark, mysql=[(1, "ALT-ZZ99", "Radio", "Audio"), (2, "ALT-NEW1", "Lamp", "Home")],
                mongo=[("m9", "MN-9999", "Radio", "Audio", ("SKU-2000", None))])
    b = _bridge(spark, f, max_sku=500)
    assert b[("mysql", "ALT-ZZ99")][0] == "SKU-2000"
    assert b[("mongo", "MN-9999")][0] == "SKU-2000"
    assert b[("mysql", "ALT-NEW1")][0] == "SKU-0501"


def test_service_flag(spark):
    f = _frames(spark, mysql=[(1, "ALT-NEW1", "Lamp", "Home")],
                supabase=[("uuid-1", None, "Install", "Service")])
    b = _bridge(spark, f, max_sku=500)
    assert b[("supabase", "uuid-1")] == ("SKU-0502", True)
    assert b[("mysql", "ALT-NEW1")] == ("SKU-0501", False)


def test_free_number_skip(spark):
    f = _frames(spark, mssql=[(1, "SKU-0001", "A", "c"), (3, "SKU-0003", "C", "c")],
                mysql=[(1, "ALT-B", "B", "c"), (2, "ALT-D", "D", "c")])
    b = _bridge(spark, f, max_sku=0)
    assert b[("mysql", "ALT-B")][0] == "SKU-0002"
    assert b[("mysql", "ALT-D")][0] == "SKU-0004"


def test_last_product_of_a_source_wins(spark):
    f = _frames(spark, mongo=[("m1", "MN-1", "X", "c", ("SKU-0100", None)), ("m2", "MN-2", "x", "C", ("SKU-0200", None))])
    m = eqv.build_equivalence_map(f, 0).collect()
    assert len(m) == 1 and m[0].sku_oficial == "SKU-0200" and m[0].nombre == "X"


def test_allocate_free_numbers_matches_brute_force(spark):
    used = [3, 4, 5, 9, 12, 13, 40]
    req = spark.range(1, 21).select(F.col("id").alias("k"))
    got = {r.k: r.number for r in eqv.allocate_free_numbers(req, spark.createDataFrame([(u,) for u in used], "n long"), 2).collect()}
    free = [n for n in range(2, 200) if n not in used][:20]
    assert [got[k] for k in range(1, 21)] == free


def test_global_row_number(spark):
    df = spark.range(0, 5000).select(((F.col("id") * 7919) % 5003).alias("v"))
    out = global_row_number(df, ["v"], "rn", num_partitions=7).orderBy("v").collect()
    assert [r.rn for r in out] == list(range(1, 5001))


@pytest.mark.parametrize("parts", [2, 4, 8, 200])
def test_global_row_number_beyond_the_range_sample(spark, parts):
    # a wide payload and more rows than one partition's sample: counts and rows must come from one layout
    df = spark.range(0, 25000, 1, 6).select(((F.col("id") * 7919) % 25000).alias("v"),
                                            F.repeat(F.lit("x"), 300).alias("payload"))
    out = global_row_number(df, ["v"], "rn", num_partitions=parts)
    got = out.agg(F.count("rn"), F.countDistinct("rn"), F.min("rn"), F.max("rn"),
                  F.sum(F.abs(F.col("rn") - F.col("v") - 1))).first()
    assert tuple(got) == (25000, 25000, 1, 25000, 0)


def test_free_sku_numbers_skip_used_ones_at_scale(spark):
    used = spark.range(1, 20001, 2).select(F.col("id").alias("n"))
    req = spark.range(0, 12000).select((F.col("id") + 1).alias("k"))
    got = {r.k: r.number for r in eqv.allocate_free_numbers(req, used, 1).collect()}
    free = list(range(2, 20001, 2)) + list(range(20001, 22001))
    assert [got[k] for k in range(1, 12001)] == free
