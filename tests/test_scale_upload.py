"""Uploads land only the sources they change, and keep numbered sheets as compressed files (findings F15, F19 of round 3)."""
from pyspark.sql import functions as F

from salesmart.operators.keys import global_row_number
from salesmart.plans import etl, upload_queries

SF = "/root/testdata/sf0.001"


def test_only_the_uploaded_sources_are_landed(spark, monkeypatch):
    monkeypatch.setattr(etl, "_SRC_CACHE", {})
    upload_queries._stored(spark, SF, "mysql")
    (landed,) = etl._SRC_CACHE.values()
    assert set(landed) == {"mssql", "mysql"}
    mysql = landed["mysql"]
    every = etl.source_tables(spark, SF)
    assert list(every) == etl.fixtures.SOURCES and every["mysql"] is mysql
    lazy = etl.fixtures.fixture_sources(spark, SF)
    for source in ("mysql", "neo4j"):
        for name, df in lazy[source].items():
            assert every[source][name].select(*df.columns).exceptAll(df).count() == 0 and every[source][name].count() == df.count()


def test_numbers_of_a_sheet_kept_as_files(spark):
    sheet = spark.range(5000, numPartitions=3).select((F.col("id") * 37 % 5000).alias("_row"), F.lit("x").alias("texto"))
    out = global_row_number(sheet, ["_row"], "_k", num_partitions=7, files=True)
    assert out.where("_k <> _row + 1").count() == 0 and out.count() == 5000
    assert "ranged_" in " ".join(out.inputFiles())
