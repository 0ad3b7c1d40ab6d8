"""Queries for streams whose cost or lateness the first ones don't show, with their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..session import work_path
from ..sources import fixtures
from ..streaming import ingest
from .etl import warehouse_tables

#: Arrivals of the event stream, and days by which every tenth event comes late.
ARRIVALS, LATE_DAYS = 6, 9


def _base(spark, name):
    return work_path(spark, f"stream/{name}-{uuid.uuid4().hex[:8]}")


def stream_fact_load_bucketed(spark, sf_dir):
    """SM1: lines streamed into a fact table bucketed on its load key; a micro-batch shuffles only its own lines."""
    w = warehouse_tables(spark, sf_dir)
    base = _base(spark, "fact_b")
    ingest.write_lines_by_year(w["stg_orden_items"], f"{base}/in")
    table = f"sm_fact_{uuid.uuid4().hex[:8]}"
    ingest.stream_fact_load_bucketed(spark, f"{base}/in", w, f"{base}/fact", f"{base}/ckpt", table, buckets=8)
    f = spark.read.parquet(f"{base}/fact")
    spark.sql(f"DROP TABLE {table}")                      # the folder stays
    return f.groupBy("Fuente").agg(F.count(F.lit(1)).alias("filas"), F.round(F.sum("TotalUSD"), 2).cast("double").alias("ventas_usd"))


def stream_dedup_state(spark, sf_dir):
    """SM2: every line sent twice, repeats found in a state store instead of in what was written."""
    w = warehouse_tables(spark, sf_dir)
    base = _base(spark, "dedup_s")
    items = w["stg_orden_items"]
    ingest.write_lines_by_year(items.unionByName(items), f"{base}/in")
    ingest.dedup_stream_state(spark, f"{base}/in", f"{base}/out", f"{base}/ckpt")
    return spark.read.parquet(f"{base}/out").groupBy("source_system").agg(F.count(F.lit(1)).alias("filas"))


def stream_late_sales(spark, sf_dir):
    """SM3: events in several arrivals, every tenth one days late; purchases in time and late rows by day."""
    ev = fixtures.read_table(spark, sf_dir, "events")
    base = _base(spark, "late")
    micros = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', CAST(ts AS TIMESTAMP_NTZ))")
    came = micros + F.when(F.col("event_id") % 10 == 3, F.lit(LATE_DAYS * 86_400_000_000)).otherwise(F.lit(0))
    span = ev.agg(F.min(micros).alias("lo"), F.max(micros).alias("hi")).first()                            # two scalars
    step = (span["hi"] - span["lo"]) // ARRIVALS + 1
    arrival = F.least(F.floor((came - F.lit(span["lo"])) / F.lit(step)), F.lit(ARRIVALS - 1)).cast("int")
    for i in range(ARRIVALS):
        ev.where(arrival == i).write.mode("append").parquet(f"{base}/in")
        ingest.late_sales_stream(spark, f"{base}/in", f"{base}/out", f"{base}/ckpt")
    in_time = spark.read.parquet(f"{base}/out/dias").groupBy("dia").agg(
        F.sum("compras").alias("compras"), F.round(F.sum("valor"), 4).alias("valor"))
    late = spark.read.parquet(f"{base}/out/tarde").groupBy(F.to_date("ts").alias("dia")).agg(F.count(F.lit(1)).alias("tarde"))
    return in_time.join(late, "dia", "full_outer").select("dia", "compras", "valor", F.coalesce("tarde", F.lit(0).cast("long")).alias("tarde"))


QUERIES = {f.__name__: f for f in (stream_fact_load_bucketed, stream_dedup_state, stream_late_sales)}


def oracle() -> dict[str, str]:
    from .oracle import ORACLE
    return {
        "stream_fact_load_bucketed": ORACLE["stream_fact_load"],
        "stream_dedup_state": ORACLE["stream_dedup"],
        "stream_late_sales": f"""
WITH e AS (SELECT *, epoch_us(CAST(ts AS TIMESTAMP)) AS us FROM events),
span AS (SELECT min(us) AS lo, (max(us) - min(us)) // {ARRIVALS} + 1 AS step FROM e),
a AS (
  SELECT e.*, least(CAST(floor((us + CASE WHEN event_id % 10 = 3 THEN {LATE_DAYS} * 86400000000 ELSE 0 END - lo) / step) AS INTEGER), {ARRIVALS - 1}) AS b
  FROM e, span),
tops AS (SELECT b, max(us) AS top FROM a GROUP BY b),
marks AS (SELECT x.b, (SELECT max(top) FROM tops t WHERE t.b < x.b) - 86400000000 AS mark FROM tops x),
split AS (SELECT a.*, coalesce(us < mark, false) AS late FROM a JOIN marks USING (b)),
intime AS (
  SELECT CAST(ts AS DATE) AS dia, count(*) AS compras, round(sum(value), 4) AS valor
  FROM split WHERE NOT late AND event_type = 'purchase' GROUP BY 1),
tard AS (SELECT CAST(ts AS DATE) AS dia, count(*) AS n FROM split WHERE late GROUP BY 1)
SELECT coalesce(i.dia, t.dia) AS dia, i.compras, i.valor, coalesce(t.n, 0) AS tarde FROM intime i FULL JOIN tard t ON i.dia = t.dia
""",
    }
