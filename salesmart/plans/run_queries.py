"""Queries over whole runs of the load: stored high-water mark and run log, with their SQL."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.quality import last_log_rows
from ..session import session_key, work_path
from ..sources import fixtures
from . import etl

_RUNS: dict = {}


def _runs(spark, sf_dir) -> tuple[str, list[dict]]:
    """(base folder, published runs): half of SQL Server's orders, a run that fails, everything, everything again.

    The later runs take the mark that the run before has stored; none gets a value from here."""
    key = (session_key(spark), sf_dir.rstrip("/"))
    if key not in _RUNS:
        src = etl.source_tables(spark, sf_dir)
        rates = fixtures.fixture_rates(spark, sf_dir)
        half = src | {"mssql": src["mssql"] | {"Orden": src["mssql"]["Orden"].where("OrdenId % 2 = 0")}}
        base = work_path(spark, f"runs_{uuid.uuid4().hex}")
        day = lambda d: dt.datetime(2001, 8, d)
        one = etl.run_etl(spark, half, rates, base, load_ts=day(1), high_water="stored")
        broken = src | {"mysql": src["mysql"] | {"Cliente": src["mysql"]["Cliente"].drop("correo")}}
        try:
            etl.run_etl(spark, broken, rates, base, previous=one["manifest"], load_ts=day(2), high_water="stored")
        except Exception:  # noqa: BLE001  what failed is in the run log
            pass
        two = etl.run_etl(spark, src, rates, base, previous=one["manifest"], load_ts=day(3), high_water="stored")
        three = etl.run_etl(spark, src, rates, base, previous=two["manifest"], load_ts=day(4), high_water="stored")
        _RUNS[key] = (base, [one, two, three])
    return _RUNS[key]


def etl_high_water(spark, sf_dir) -> DataFrame:
    """FL7 + SNK9: rows that each of three runs adds to the fact, and the mark it stores."""
    _, runs = _runs(spark, sf_dir)
    out, had = None, 0
    for i, run in enumerate(runs):
        m = etl.read_manifest(spark, run["manifest"])
        mark = etl.manifest_table(spark, m, "high_water").select(F.date_format("hw", "yyyy-MM-dd").alias("marca"))
        fact = etl.manifest_table(spark, m, "fact_ventas")
        n = fact.count()
        part = mark.select(F.lit(i + 1).alias("corrida"), F.lit(n - had).cast("long").alias("filas_nuevas"), "marca")
        out, had = (part if out is None else out.unionByName(part)), n
    return out


def etl_run_log(spark, sf_dir) -> DataFrame:
    """SNK8 + AG11: type and status of the last log rows, a failed run among them."""
    base, runs = _runs(spark, sf_dir)
    return last_log_rows(etl.run_log(spark, base, runs[-1]["manifest"])).groupBy("tipo", "estado").agg(F.count(F.lit(1)).alias("filas"))


QUERIES = {f.__name__: f for f in (etl_high_water, etl_run_log)}


def oracle() -> dict[str, str]:
    from .oracle import with_lines
    return {
        "etl_high_water": with_lines("""
SELECT 1 AS corrida, count(*) FILTER (WHERE NOT (src = 0 AND ok % 2 = 1)) AS filas_nuevas, '2001-08-01' AS marca FROM fact
UNION ALL SELECT 2, count(*) FILTER (WHERE src = 0 AND ok % 2 = 1), '2001-08-03' FROM fact
UNION ALL SELECT 3, CAST(0 AS BIGINT), '2001-08-03' FROM (SELECT 1)
"""),
        "etl_run_log": "SELECT 'etl' AS tipo, 'ERROR' AS estado, CAST(count(*) > 0 AS BIGINT) AS filas FROM orders "
                       "UNION ALL SELECT 'etl', 'OK', 3 * CAST(count(*) > 0 AS BIGINT) FROM orders",
    }
