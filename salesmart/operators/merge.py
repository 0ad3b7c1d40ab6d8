"""Upsert / insert-only merge emulation on immutable tables (SNK1-SNK9).

Plain parquet has no MERGE, so each merge is expressed as joins producing
the *new* table; the caller writes it to a new location and switches the
pointer (``publish``), never overwriting a path that is being read.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def _dedup(batch: DataFrame, keys: list[str], order_col: str, last: bool) -> DataFrame:
    """Keep one row per key: last (or first) by ``order_col`` (D4).

    An aggregate (``max_by``/``min_by`` of the whole row) rather than a
    window: it combines map-side before the shuffle, so a key holding a
    large share of the rows never lands whole in one task."""
    rest = [c for c in batch.columns if c not in keys]
    if not rest:
        return batch.dropDuplicates(keys)
    pick = F.max_by if last else F.min_by
    row = F.struct(*[F.col(c) for c in rest])
    return (batch.groupBy(*keys).agg(pick(row, F.col(order_col)).alias("_r"))
            .select(*keys, *[F.col("_r")[c].alias(c) for c in rest]))


def merge_overwrite(target: DataFrame | None, batch: DataFrame, keys: list[str],
                    order_col: str = "seq") -> DataFrame:
    """SNK1: upsert replacing every attribute; last row of a key in the batch wins."""
    b = _dedup(batch, keys, order_col, last=True)
    if target is None:
        return b
    kept = target.join(b.select(*keys), keys, "left_anti")
    return kept.unionByName(b, allowMissingColumns=True)


def merge_coalesce(target: DataFrame | None, batch: DataFrame, keys: list[str],
                   order_col: str = "seq", keep_from_target=("load_ts",),
                   insert_defaults: dict | None = None) -> DataFrame:
    """SNK2: COALESCE(new, old) per attribute; ``keep_from_target`` columns are
    not touched on update; ``insert_defaults`` apply to inserted rows only."""
    b = _dedup(batch, keys, order_col, last=True)
    if insert_defaults:
        for c, v in insert_defaults.items():
            b = b.withColumn(c, F.coalesce(F.col(c), F.lit(v)))
    if target is None:
        return b
    attrs = [c for c in b.columns if c not in keys]
    t = target.alias("t")
    n = b.alias("b")
    j = t.join(n, keys, "full_outer")
    cols = [F.col(k) for k in keys]
    for c in attrs:
        if c in keep_from_target and c in target.columns:
            cols.append(F.coalesce(F.col(f"t.{c}"), F.col(f"b.{c}")).alias(c))
        elif c in target.columns:
            cols.append(F.coalesce(F.col(f"b.{c}"), F.col(f"t.{c}")).alias(c))
        else:
            cols.append(F.col(f"b.{c}").alias(c))
    return j.select(*cols)


def merge_insert_only(target: DataFrame | None, batch: DataFrame, keys: list[str],
                      order_col: str = "seq") -> DataFrame:
    """SNK3: only new keys are appended; the FIRST row of a key in the batch wins.

    Returns the rows to append (not the whole table)."""
    b = _dedup(batch, keys, order_col, last=False)
    if target is None:
        return b
    return b.join(target.select(*keys), keys, "left_anti")


def fx_rows(feed: DataFrame, fuente: str = "BCCR", load_ts=None) -> DataFrame:
    """SNK4: (fecha, compra, venta) -> two directed rows.

    CRC->USD carries the buy rate and USD->CRC the sell rate; ``tasa`` is CRC
    per USD in both directions."""
    ts = F.current_timestamp() if load_ts is None else F.lit(load_ts).cast("timestamp")
    return (feed.select("fecha", F.expr("stack(2, 'CRC', 'USD', compra, 'USD', 'CRC', venta) as (de, a, tasa)"))
            .where(F.col("tasa").isNotNull())
            .select(F.col("fecha").cast("date").alias("fecha"), "de", "a",
                    F.col("tasa").cast("decimal(18,6)").alias("tasa"),
                    F.lit(fuente).alias("fuente"), ts.alias("LoadTS"), F.unix_date(F.col("fecha").cast("date")).cast("long").alias("seq")))


def upsert_rates(target: DataFrame | None, feed: DataFrame, fuente: str = "BCCR") -> DataFrame:
    rows = fx_rows(feed, fuente)
    return merge_overwrite(target, rows, ["fecha", "de", "a"], "seq").drop("seq")


def reset_source(table: DataFrame, source: str | None, col: str = "source_system") -> DataFrame:
    """SNK6: staging without one source (or empty when ``source`` is None)."""
    if source is None:
        return table.limit(0)
    return table.where(F.col(col) != source)


def empty_like(df: DataFrame) -> DataFrame:
    """SNK7: an empty frame with the same schema."""
    return df.sparkSession.createDataFrame([], df.schema)


def append_log(log: DataFrame | None, spark: SparkSession, tipo: str, estado: str, mensaje: str,
               duracion_seg: float) -> DataFrame:
    """SNK8: one run-log row."""
    row = spark.createDataFrame(
        [(tipo, estado, mensaje, float(duracion_seg))],
        "tipo string, estado string, mensaje string, duracion_seg double").withColumn(
        "ts", F.current_timestamp())
    return row if log is None else log.unionByName(row)


def advance_high_water(state: DataFrame | None, new_dates: DataFrame, col: str = "fecha") -> DataFrame:
    """SNK9: one-row state keeping the max date loaded, only moving forward."""
    m = new_dates.select(F.col(col).alias("hw"))
    if state is None:
        return m.agg(F.max("hw").alias("hw"))
    return state.select("hw").unionByName(m).agg(F.max("hw").alias("hw"))


def publish(df: DataFrame, base_path: str, name: str) -> str:
    """Write a table version to a fresh folder and return its path (DW9 / BL5).

    Readers use the returned path; an old version is never overwritten while
    it may be read.  The folder lives under the caller's shared base path.
    """
    path = f"{base_path.rstrip('/')}/{name}/v-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").option("compression", "zstd").parquet(path)
    return path
