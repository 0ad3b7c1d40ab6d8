"""SimHash near-duplicates by anchor-point covering.

Fingerprints are 64-bit majority votes over shingle hashes.  The anchors are
the words of a covering code: 21 blocks of three bits, each the repetition
code {000, 111} (a perfect code of radius 1), and the last bit on its own.
Every fingerprint has one *home* anchor, the majority of each block, within
the covering radius.  It also visits every other anchor within covering
radius plus threshold that can be the home of a fingerprint within the
threshold: anchors that differ in blocks whose majority at most ``max_bits``
flips can turn (one flip for a mixed block or the last bit, two for a uniform
block).  Two fingerprints within the threshold therefore meet at the home of
either, and are compared there.

Equal fingerprints collapse before anything is replicated.  An anchor that is
home to more than ``dense`` distinct fingerprints (thousands of near copies)
is not compared pair by pair: its visitors are replicated once more to all
points within half the threshold, the anchors of the trivial code of radius 0.
Two fingerprints share such a point exactly if they are within the threshold,
no point has more visitors than the ball has points, and one link to the
smallest visitor keeps the component.  Both ways are exact; nothing is capped.
"""

from __future__ import annotations

from itertools import islice

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import own_columns, written

BITS, SEED = 64, 42
#: First bits of the 21 three-bit blocks; the 64th bit is a block of its own.
BLOCK_STARTS = [3 * i for i in range(21)]
LAST_BIT = -(1 << 63)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """SimHash of the lower-cased (A-Z) text as a signed 64-bit integer; 0 without words.

    Words are runs without white space (0x20, 0x09-0x0D).  Bit i is set if over
    half of the shingles' XXH64 hashes have it; a text of fewer words than a
    shingle is one shingle.  Hashes are counted in blocks, so a text of any
    length needs bounded extra memory.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        grams, n = iter([b" ".join(words)]), 1
    else:
        n = len(words) - shingle + 1
        grams = map(b" ".join, zip(*[islice(words, i, None) for i in range(shingle)]))
    counts, digest = np.zeros(BITS, np.int64), xxhash.xxh64_intdigest
    while block := [digest(g, SEED) for g in islice(grams, 1 << 16)]:
        bits = np.unpackbits(np.array(block, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<i8")[0])


def fingerprint_column(text: Column, shingle: int = 3) -> Column:
    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")
    return of(text)


def home_anchor(fp: Column) -> Column:
    """The block majorities (at the blocks' first bits) and the last bit."""
    x, y, z = fp, F.shiftrightunsigned(fp, 1), F.shiftrightunsigned(fp, 2)
    majority = x.bitwiseAND(y).bitwiseOR(x.bitwiseAND(z)).bitwiseOR(y.bitwiseAND(z))
    mask = sum(1 << p for p in BLOCK_STARTS) | (1 << 63)
    keep_last = fp.bitwiseAND(F.lit(LAST_BIT))
    return majority.bitwiseAND(F.lit(mask & ~(1 << 63))).bitwiseOR(keep_last)


def anchors(fp: Column, max_bits: int) -> Column:
    """Home anchor and all anchors whose cell lies within ``max_bits`` of ``fp``, as an array."""
    def cost(p: int) -> Column:
        block = F.shiftrightunsigned(fp, p).bitwiseAND(F.lit(7))
        return F.when((block == 0) | (block == 7), F.lit(2)).otherwise(F.lit(1))
    turns = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(1 << p).cast("long").alias("m"), cost(p).alias("c"))
                      for i, p in enumerate(BLOCK_STARTS)],
                    F.struct(F.lit(len(BLOCK_STARTS)).alias("i"), F.lit(LAST_BIT).cast("long").alias("m"), F.lit(1).alias("c")))
    sets = F.array(F.struct(F.lit(0).cast("long").alias("m"), F.lit(-1).alias("i"), F.lit(0).alias("c")))
    every = sets
    for _ in range(max_bits):
        sets = F.flatten(F.transform(sets, lambda s: F.transform(
            F.filter(turns, lambda t: (t["i"] > s["i"]) & (t["c"] + s["c"] <= max_bits)),
            lambda t: F.struct(t["m"].bitwiseXOR(s["m"]).alias("m"), t["i"].alias("i"), (t["c"] + s["c"]).alias("c")))))
        every = F.concat(every, sets)
    return F.transform(every, lambda s: home_anchor(fp).bitwiseXOR(s["m"]))


def ball(fp: Column, radius: int) -> Column:
    """All 64-bit points within ``radius`` of ``fp``."""
    points = F.array(F.struct(fp.alias("x"), F.lit(-1).alias("i")))
    every = points
    bits = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(_signed(1 << i)).cast("long").alias("m")) for i in range(BITS)])
    for _ in range(radius):
        points = F.flatten(F.transform(points, lambda p: F.transform(
            F.filter(bits, lambda b: b["i"] > p["i"]),
            lambda b: F.struct(p["x"].bitwiseXOR(b["m"]).alias("x"), b["i"].alias("i")))))
        every = F.concat(every, points)
    return F.transform(every, lambda p: p["x"])


def links(fps: DataFrame, max_bits: int = 2, dense: int = 64) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints whose closure equals that of all pairs within ``max_bits``.

    ``fps``: one row per distinct fingerprint, column ``fp``.  ``max_bits`` is even.
    """
    if max_bits < 0 or max_bits % 2:
        raise ValueError("max_bits must be an even number of bits")
    homes = fps.select(F.col("fp").alias("h_fp"), home_anchor(F.col("fp")).alias("anchor"))
    # a narrow file is few splits: deal the fingerprints out before each becomes a hundred and more rows
    tasks = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    visits = fps.repartition(tasks, "fp").select("fp", F.explode(anchors(F.col("fp"), max_bits)).alias("anchor"))
    crowded = written(homes.groupBy("anchor").count().where(F.col("count") > dense).select("anchor"), "simhash_dense")
    any_crowded = not crowded.isEmpty()
    light = homes.join(crowded, "anchor", "left_anti") if any_crowded else homes
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("h_fp"))) <= max_bits
    out = (visits.join(light.hint("shuffle_hash"), "anchor").where((F.col("fp") != F.col("h_fp")) & near)
           .select(F.greatest("fp", "h_fp").alias("a"), F.least("fp", "h_fp").alias("b")))
    if any_crowded:
        members = visits.join(crowded, "anchor", "left_semi").select("fp").distinct()
        met = (members.select("fp", F.explode(ball(F.col("fp"), max_bits // 2)).alias("point"))
               .groupBy("point").agg(F.collect_set("fp").alias("g")).where(F.size("g") > 1)      # at most a ball
               .select(F.explode("g").alias("a"), F.array_min("g").alias("b")).where("a != b"))
        out = out.unionByName(met)
    return out.distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b", salts: int = 8) -> DataFrame:
    """(node, root) for every node of the edges, root: the smallest node reachable (star contraction).

    Alternates large and small stars until nothing changes; the number of
    rounds grows with the logarithm of the component size.  Each round is
    written to the shared folder.  A hub's edges are dealt over ``salts`` tasks.
    """
    spark = edges.sparkSession

    def star_join(e: DataFrame, m: DataFrame) -> DataFrame:
        dealt = m.withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        return e.withColumn("s", F.pmod(F.xxhash64("v"), F.lit(salts)).cast("int")).join(dealt, ["u", "s"])

    def mark(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % 1_000_003)).first())

    e = written(edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "links")
    before = mark(e)
    while before[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        m = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = star_join(both, m).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = written(large, "links")
        m = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (star_join(large, m).select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(m.select("u", F.col("m").alias("v"))).where("u != v").distinct())
        e = written(small, "links")
        now = mark(e)
        if now == before:
            break
        before = now
    return spark.createDataFrame([], e.schema).select(F.col("u").alias("node"), F.col("v").alias("root")) if not before[0] else \
        e.select(F.col("u").alias("node"), F.col("v").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 2,
                    dense: int = 64, keys: list[Column] | None = None) -> DataFrame:
    """One row per row of ``docs``: the id, ``fp``, ``component_id`` (smallest id reachable), ``component`` (its smallest
    fingerprint, which tells components apart even where ids repeat) and any ``keys``.

    Null, empty and blank texts have fingerprint 0 and link like any other.
    Null ids are classed but never name a component (null if all are).
    Repeated rows stay repeated; other columns of ``docs`` do not enter, so
    their names cannot clash.  No rows: an empty result.
    """
    rows = written(docs.select(F.col(id_col).alias("_id"), fingerprint_column(F.col(text_col), shingle).alias("fp"), *(keys or [])),
                   "simhash_rows")
    fps = written(rows.groupBy("fp").agg(F.min("_id").alias("first_id")), "simhash_fps")
    roots = components(links(fps.select("fp"), max_bits, dense)).withColumnRenamed("node", "fp")
    rooted = fps.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    ids = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classed = written(rooted.join(ids, "root").select("fp", "component_id", F.col("root").alias("component")), "simhash_classes")
    return rows.join(classed, "fp").withColumnRenamed("_id", id_col)


def fingerprint_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


@own_columns("id_col", "text_col")
def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component the row with the smallest id.

    Ids decide, then the text digest (one id with several texts), then the
    other columns, so a rerun keeps the same row.  A component without any id
    keeps its row with the smallest digest.  Texts are shuffled once, to meet
    the kept ids; columns and their order stay.
    """
    digest = F.md5(F.col(text_col))
    rows = near_duplicates(docs, id_col, text_col, shingle, max_bits, keys=[digest.alias("_md5")])
    order = F.struct(F.col(id_col).isNull().alias("n"), F.col(id_col).alias("i"), F.col("_md5").alias("d"))
    kept = rows.groupBy("component").agg(F.min(order).alias("o")).select(F.col("o.i").alias("_k_id"), F.col("o.d").alias("_k_md5"))
    kept = written(kept.distinct(), "simhash_kept")
    met = docs.withColumn("_md5", digest).join(
        kept, F.col(id_col).eqNullSafe(F.col("_k_id")) & F.col("_md5").eqNullSafe(F.col("_k_md5")))
    others = [F.col(c) for c, t in docs.dtypes if not t.startswith(("map", "variant"))]
    first = Window.partitionBy("_k_id", "_k_md5").orderBy(*others)
    return met.withColumn("_n", F.row_number().over(first)).where("_n = 1").select(*docs.columns)
