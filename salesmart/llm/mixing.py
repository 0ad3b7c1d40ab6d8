"""Mixing sources to target weights with a low-discrepancy slot schedule.

Targets: weights share the words of all sources; a source's target stops at
``epochs`` times its words and the excess is shared again by weight.  The mix
is a sequence of slots of ``block`` words.  Slot k's golden-ratio point
frac(k / phi) falls into one source's interval of the cumulative targets, so
every stretch of the sequence is close to the weights.  The slots of a source
are ranked; its documents, in an order hashed from a seed, form a word stream
that is cut into equal blocks and repeated for the next epoch; the slot of
rank j takes block j.

All of it is DataFrame work: hot sources are ranked and summed in buckets, and
the only rows that reach the driver are sums over sources.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.keys import global_row_number
from .common import n_words, own_columns, written
from .ranks import _join, running_sum, running_sum_in_buckets

BLOCK, EPOCHS = 64, 3
#: Points are integers below 2^40: multiples of the odd integer nearest to 2^40 / phi (golden ratio).
POINT_BITS, GOLDEN = 40, 679535888379
CHUNK_BITS, CELL_BITS = 13, 10


def point(k: Column) -> Column:
    """frac(k / phi) times 2^40 for 0 <= k < 2^40, without overflowing a long."""
    half = 1 << (POINT_BITS // 2)
    low, high = k % half, F.shiftright(k, POINT_BITS // 2)
    return (low * GOLDEN + (high * GOLDEN % half) * half) % (1 << POINT_BITS)


def cycling_weights(sources: DataFrame, cycle: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """``sources`` plus rank (code point order, null last) and ``weight``: the cycle, repeated by rank."""
    ranked = global_row_number(sources, [F.col("source").asc_nulls_last()], "rank")
    at = F.pmod(F.col("rank") - 1, F.lit(len(cycle))).cast("int")
    return ranked.withColumn("weight", F.get(F.array(*[F.lit(c) for c in cycle]), at).cast("long"))


def water_fill(sources: DataFrame, epochs: int = EPOCHS) -> DataFrame:
    """``sources`` (source, source_size, weight) plus ``target`` (double): capped shares of the total.

    Rounds of one small aggregate each: sources above their cap are fixed
    there, the rest of the total is shared among the others by weight.
    """
    t = written(sources.withColumn("_fixed", F.lit(False)), "mix_sources")
    total = t.agg(F.sum("source_size")).first()[0] or 0
    cap = F.col("source_size") * epochs
    fixed = F.lit(False)
    while True:
        w, taken, n = t.agg(F.sum(F.when(~fixed, F.col("weight"))), F.sum(F.when(fixed, cap)), F.count_if(fixed)).first()
        left, w = total - (taken or 0), w or 0
        above = fixed | (F.col("weight") * left > cap * w)
        if not w or t.where(above).count() == n:
            share = (F.col("weight") * left).cast("double") / F.lit(float(w or 1))
            return t.withColumn("target", F.when(fixed, cap.cast("double")).otherwise(share)).drop("_fixed")
        t = written(t.withColumn("_fixed", above), "mix_sources")
        fixed = F.col("_fixed")


def slots(sources: DataFrame, block: int = BLOCK) -> DataFrame:
    """slot, source and block (0-based rank of the slot in its source) of the whole schedule."""
    spark = sources.sparkSession
    total = sources.agg(F.sum("target")).first()[0] or 0.0
    n = round(total / block)
    # cumulative targets by rank, as points; one row a source, windowed over chunks of ranks
    cut = running_sum_in_buckets(
        sources.select("source", "rank", F.round(F.col("target") * 1000).cast("long").alias("w"), F.lit(0).alias("g"),
                       F.shiftright("rank", CHUNK_BITS).alias("chunk")), ["g"], "chunk", ["rank"], F.col("w"), "lo")
    scale = (1 << POINT_BITS) / max(total * 1000, 1.0)
    cut = cut.where("w > 0").select("source", F.floor(F.col("lo") * scale).alias("lo"),
                                    F.floor((F.col("lo") + F.col("w")) * scale).alias("hi"))
    top = written(cut, "mix_cuts")
    last = top.agg(F.max("hi")).first()[0] or 0
    top = top.withColumn("hi", F.when(F.col("hi") == last, F.lit(1 << POINT_BITS)).otherwise(F.col("hi")))
    shift = POINT_BITS - CELL_BITS
    cells = top.where("hi > lo").select("source", "lo", "hi", F.explode(F.sequence(
        F.shiftright("lo", shift), F.shiftright(F.col("hi") - 1, shift))).alias("cell"))
    cells = written(cells, "mix_cells")
    points = spark.range(n).select(F.col("id").alias("slot"), point(F.col("id") + 1).alias("u"))
    drawn = (points.withColumn("cell", F.shiftright("u", shift)).join(cells, "cell")
             .where((F.col("u") >= F.col("lo")) & (F.col("u") < F.col("hi")))
             .select("slot", "source", F.shiftright("slot", CHUNK_BITS).alias("chunk")))
    return running_sum_in_buckets(drawn, ["source"], "chunk", ["slot"], F.lit(1), "block").drop("chunk")


def streams(rows: DataFrame, seed: int = 0) -> DataFrame:
    """``rows`` (id, key, source, size) with words plus ``start``: where the document begins in its source's stream."""
    hashed = F.xxhash64(F.lit(seed), "id", "key")
    return running_sum(rows.where("size > 0"), ["source"], hashed, ["id", "key", "size"], F.col("size"), "start")


def schedule(sources: DataFrame, streamed: DataFrame, block: int = BLOCK, epochs: int = EPOCHS) -> DataFrame:
    """The mix: slot, source, block, id, start, epoch, first (word of the document) and n_words (words taken).

    A slot's block is one or several pieces of documents.  The stream of a
    source ends after ``epochs`` passes; the last block may be shorter.
    """
    used = slots(sources, block)
    counts = written(used.groupBy("source").agg(F.count(F.lit(1)).alias("n_slots")), "mix_slot_counts")
    sized = _join(counts, sources.select("source", "source_size"), ["source"])
    copies = (_join(streamed, sized, ["source"])
              .withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
              .withColumn("at", F.col("epoch") * F.col("source_size") + F.col("start"))
              .where(F.col("at") < F.col("n_slots") * block))
    pieces = (copies.withColumn("block", F.explode(F.sequence(
        F.floor(F.col("at") / block), F.floor((F.col("at") + F.col("size") - 1) / block))))
        .withColumn("from", F.greatest(F.col("at"), F.col("block") * block))
        .withColumn("to", F.least(F.col("at") + F.col("size"), (F.col("block") + 1) * block))
        .select("source", "block", "id", "key", "start", "size", "epoch", (F.col("from") - F.col("at")).alias("first"),
                (F.col("to") - F.col("from")).alias("n_words")))
    right = used.select(F.col("source").alias("_s"), F.col("block").alias("_b"), "slot")
    return pieces.join(right, F.col("source").eqNullSafe(F.col("_s")) & (F.col("block") == F.col("_b"))).drop("_s", "_b")


def rows_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """id, key (text digest), source and size (words) of every row, written once."""
    text = F.col(text_col)
    return written(docs.select(F.col(id_col).alias("id"), F.coalesce(F.md5(text), F.lit("")).alias("key"),
                               F.col(source_col).alias("source"), n_words(text).alias("size")), "mix_rows")


def sources_of(rows: DataFrame, cycle: tuple[int, ...] = (1, 2, 3), epochs: int = EPOCHS) -> DataFrame:
    """source, source_size, rank, weight and target of every source."""
    sums = written(rows.groupBy("source").agg(F.sum("size").alias("source_size")), "mix_sums")
    return written(water_fill(cycling_weights(sums, cycle), epochs), "mix_targets")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", block: int = BLOCK,
        epochs: int = EPOCHS, seed: int = 0) -> DataFrame:
    """id, key, size, source, source_size, target and taken (words the mix takes, repeats counted) of every row.

    * Null and empty texts have no words: size and taken are 0.
    * A null source is a source of its own, the last in the order.
    * Repeated rows are documents of their own; equal ones may swap what they take.
    * No document exceeds ``epochs`` times its size; a source comes within a few blocks of its target.
    * The order is hashed from ids, texts and ``seed``: reruns agree.  No rows: an empty result.
    """
    rows = rows_of(docs, id_col, text_col, source_col)
    sources = sources_of(rows, epochs=epochs)
    streamed = written(streams(rows, seed), "mix_streams")
    taken = (schedule(sources, streamed, block, epochs).groupBy("source", "start").agg(F.sum("n_words").alias("taken")))
    right = taken.select(F.col("source").alias("_s"), F.col("start").alias("_t"), "taken")
    with_words = streamed.join(right, F.col("source").eqNullSafe(F.col("_s")) & (F.col("start") == F.col("_t")), "left").drop("_s", "_t", "start")
    every = with_words.unionByName(rows.where("size = 0").withColumn("taken", F.lit(0).cast("long")))
    out = _join(every, sources.select("source", "source_size", "target"), ["source"])
    return out.select("id", "key", "size", "source", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


@own_columns("id_col", "text_col", "source_col")
def repeat_to_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **kw) -> DataFrame:
    """``docs`` in the mix's proportions: each row as often as the mix takes it, to the nearest whole time (half: up).

    Rows the mix leaves out go; rows without words stay once.  Columns and their order stay.
    """
    takes = mix(docs, id_col, text_col, source_col, **kw)
    times = F.when(F.col("size") == 0, F.lit(1)).otherwise(F.floor((F.col("taken") + F.col("size") / 2) / F.col("size")))
    # equal rows are interchangeable: their times are summed and dealt out again
    per = (takes.groupBy(F.col("id").alias("_id"), F.col("key").alias("_key"), F.col("source").alias("_src"))
           .agg(F.sum(times.cast("long")).alias("_times"), F.count(F.lit(1)).alias("_rows")))
    per = written(per.where("_times > 0"), "mix_times")
    keyed = docs.withColumn("_k", F.coalesce(F.md5(F.col(text_col)), F.lit("")))
    met = keyed.join(per, F.col(id_col).eqNullSafe(F.col("_id")) & (F.col("_k") == F.col("_key"))
                     & F.col(source_col).eqNullSafe(F.col("_src")))
    others = [F.col(c) for c, t in docs.dtypes if not t.startswith(("map", "variant"))]
    nth = F.row_number().over(Window.partitionBy("_id", "_key", "_src").orderBy(*others))
    each = F.floor(F.col("_times") / F.col("_rows")) + F.when(F.col("_nth") <= F.col("_times") % F.col("_rows"), 1).otherwise(0)
    return (met.withColumn("_nth", nth).withColumn("_each", each.cast("int")).where("_each > 0")
            .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_each")))).select(*docs.columns))
