"""Stable keys without a single-partition window.

``global_row_number`` gives each row its 1-based position in a total order.
A plain ``row_number().over(Window.orderBy(...))`` moves every row into one
task; instead the frame is range-partitioned on the order, each partition
is sorted, and the position is the row's index inside its partition plus
the number of rows in all earlier partitions (a table of one count per
partition, broadcast).  Work and memory stay spread over all tasks.

The range-partitioned rows are materialised **once** (a reliable checkpoint
in the shared folder, or compressed files there) before anything is derived from them.  A range shuffle
draws its boundaries from a sample of its input, so a plan that evaluates it
twice, once for the counts and once for the rows, sees two different
layouts, and offsets of one do not fit positions in the other.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, work_path


def global_row_number(df: DataFrame, order_cols: list, name: str = "rn",
                      num_partitions: int | None = None, files: bool = False) -> DataFrame:
    """``df`` plus ``name``: 1-based position of each row in the order of ``order_cols``.

    Without ``num_partitions`` the range shuffle is unnumbered, so adaptive
    execution sizes its partitions.  Rows that tie get consecutive numbers
    in the order in which the materialised partition holds them.
    """
    cols = [F.col(c) if isinstance(c, str) else c for c in order_cols]
    ensure_checkpoint_dir(df.sparkSession)
    ranged = df.repartitionByRange(num_partitions, *cols) if num_partitions else df.repartitionByRange(*cols)
    parted = (ranged.sortWithinPartitions(*cols)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_local", F.monotonically_increasing_id()
                          - F.shiftleft(F.col("_pid").cast("long"), 33)))
    if files:
        path = work_path(df.sparkSession, f"ranged_{uuid.uuid4().hex}")
        parted.write.option("compression", "zstd").parquet(path)
        parted = df.sparkSession.read.schema(parted.schema).parquet(path)
    else:
        parted = parted.checkpoint()
    counts = parted.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    # one row per partition: a tiny window is fine here
    offsets = counts.select(
        "_pid",
        F.coalesce(F.sum("_cnt").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_off"))
    out = parted.join(F.broadcast(offsets), "_pid", "inner")
    return out.withColumn(name, (F.col("_off") + F.col("_local") + 1).cast("long")).drop("_pid", "_local", "_off")


def surrogate_keys(df: DataFrame, order_cols: list, name: str, start_after: int | Column = 0) -> DataFrame:
    """IDENTITY-like keys: ``start_after + position`` in a business-key order (DW6)."""
    out = global_row_number(df, order_cols, "_pos")
    base = start_after if isinstance(start_after, Column) else F.lit(int(start_after))
    return out.withColumn(name, (base + F.col("_pos")).cast("long")).drop("_pos")


def hash_key(*cols) -> Column:
    """Deterministic 64-bit key for fact rows (no global ordering needed)."""
    return F.xxhash64(*[F.col(c) if isinstance(c, str) else c for c in cols])


#: Rows up to which a table may be broadcast to the lines.
MAX_LOOKUP_ROWS = 200_000


def lookup(table: DataFrame) -> DataFrame:
    """``table`` (a written one) as the small side of a join: merged by sorting if it has too many rows to broadcast.

    Spark goes by the bytes of files.  Sorted keys pack so well there (4 bytes a
    client) that millions of rows pass for a few MB, which the driver would have
    to hold in full.  The rows are counted, which reads the files' footers only."""
    return table.hint("merge") if table.count() > MAX_LOOKUP_ROWS else table
