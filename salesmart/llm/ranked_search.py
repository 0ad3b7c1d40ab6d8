"""Ranked lexical search over bit-sliced Bloom signatures.

1. *Index.*  One scan turns every text into the set of keys (term, level); a
   term has level l if it occurs at least ``LEVELS[l]`` times.  Keys set bits in a
   Bloom signature whose width follows the number of keys, so texts of like
   size share a block.  A block holds its signatures as slices: one bitmap over
   its documents for each bit position.  It also keeps each text's digest,
   length and largest term count.
2. *Bounds.*  The bitmap of a query key is the AND of its slices and marks every
   document that holds the key, and a few more.  Per level, the sum of term
   weights over the marked documents times what the level adds to the score
   bounds the score from above, in the integers the score itself is made of.
3. *Threshold.*  The documents with the highest bounds are scored exactly; the
   lowest of the best ``k`` of these scores can only rise.
4. *Rescoring.*  Every document whose bound reaches the threshold is scored
   exactly from its whole text.  Nothing else is excluded, so the result is exact.

Equal texts have equal scores: candidates are digests, and a text stands for
its smallest ids.  Texts are read where they lie; only digests, bounds and scores
are shuffled.  Items go through in blocks of at most ``ITEM_BYTES``.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

#: Smallest number of occurrences of a term at each level.
LEVELS = (1, 2, 3, 4, 6, 9, 15)
#: Signature bits a key and bits that a key sets.
KEY_BITS, HASHES = 12, 4
#: Most documents of a block, and most keys over all of them (a text with more has a block of its own).
BLOCK_DOCS, BLOCK_KEYS = 1024, 1 << 19
#: Bytes of item texts that one block of items holds on the driver and in each task.
ITEM_BYTES = 4 << 20

#: Bytes of the contract's terms, lower-cased; all others separate.
_FOLD = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 32 for b in range(256))
_U = np.uint64


def terms(text: str | None) -> list[bytes]:
    """The terms of a text, in order; none for null."""
    return (text or "").encode().translate(_FOLD).split()


class _Hashes(dict):
    """Term -> 64-bit hash, kept for the terms seen lately."""

    def __missing__(self, term: bytes) -> int:
        if len(self) > 1 << 19:
            self.clear()
        h = self[term] = xxhash.xxh64_intdigest(term)
        return h


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def _keys(hashes: np.ndarray, level: int) -> np.ndarray:
    return _mix(hashes + _U(0x9E3779B97F4A7C15 * (level + 1) & 0xFFFFFFFFFFFFFFFF))


def _positions(keys: np.ndarray, width: int) -> np.ndarray:
    """(keys, HASHES) bit positions in a signature of ``width`` bits."""
    first, step = keys >> _U(32), (keys & _U(0xFFFFFFFF)) | _U(1)
    return ((first[:, None] + np.arange(HASHES, dtype=_U)[None, :] * step[:, None]) % _U(width)).astype(np.int64)


def _width(n_keys: int) -> int:
    """Signature bits for a text: ``KEY_BITS`` a key, keys rounded up to a power of two."""
    return KEY_BITS * max(16, 1 << (n_keys - 1).bit_length())


_INDEX = ("docs int, width int, digests binary, lengths binary, most binary, slices binary, "
          "n_docs long, n_terms long, df_term array<int>, df array<long>")


def index(docs: DataFrame, vocabulary: list[bytes], text_col: str = "text") -> DataFrame:
    """Signature blocks of the texts of ``docs``; each also counts its documents with each term of ``vocabulary``.

    Texts without a term have no place in it.
    """
    number = {t: i for i, t in enumerate(vocabulary)}

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, filling = _Hashes(), {}

        def close(width: int) -> pd.DataFrame:
            block = filling.pop(width)
            rows = block["texts"]
            bits = np.zeros((width, len(rows)), bool)
            for j, (_, _, keys) in enumerate(rows.values()):
                bits[_positions(keys, width).ravel(), j] = True
            seen = sorted(block["df"])
            return pd.DataFrame([{
                "docs": len(rows), "width": width, "digests": b"".join(rows), "lengths": np.array([r[0] for r in rows.values()], np.int64).tobytes(),
                "most": np.array([r[1] for r in rows.values()], np.int64).tobytes(), "slices": np.packbits(bits, axis=1).tobytes(),
                "n_docs": block["n_docs"], "n_terms": block["n_terms"], "df_term": seen, "df": [block["df"][i] for i in seen]}])

        for batch in batches:
            for digest, text in zip(batch["digest"], batch["text"]):
                words = terms(text)
                if not words:
                    continue
                tf = Counter(words)
                counts = np.fromiter(tf.values(), np.int64, len(tf))
                width = _width(sum(int((counts >= low).sum()) for low in LEVELS))
                block = filling.setdefault(width, {"texts": {}, "keys": 0, "n_docs": 0, "n_terms": 0, "df": Counter()})
                block["n_docs"] += 1
                block["n_terms"] += len(words)
                block["df"].update([number[t] for t in (tf.keys() & number.keys())])
                if (digest := bytes(digest)) not in block["texts"]:    # copies share a signature
                    h = np.fromiter(map(hashes.__getitem__, tf), _U, len(tf))
                    keys = np.concatenate([_keys(h[counts >= low], i) for i, low in enumerate(LEVELS)])
                    block["texts"][digest] = (len(words), int(counts.max()), keys)
                    block["keys"] += len(keys)
                    if len(block["texts"]) >= BLOCK_DOCS or block["keys"] >= BLOCK_KEYS:
                        yield close(width)
        for width in list(filling):
            yield close(width)

    return (docs.where(F.col(text_col).isNotNull())
            .select(F.unhex(F.md5(F.col(text_col))).alias("digest"), F.col(text_col).alias("text")).mapInPandas(blocks, _INDEX))


def document_counts(docs: DataFrame, vocabulary: list[bytes], text_col: str = "text") -> DataFrame:
    """(df_term, df): documents with each term of ``vocabulary``, as far as there are any."""
    number = {t: i for i, t in enumerate(vocabulary)}

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        df = Counter()
        for batch in batches:
            for text in batch["text"]:
                df.update(number[t] for t in set(terms(text)) & number.keys())
        yield pd.DataFrame({"df_term": list(df), "df": list(df.values())}).astype({"df_term": "int32", "df": "int64"})

    return (docs.select(F.col(text_col).alias("text")).mapInPandas(count, "df_term int, df long")
            .groupBy("df_term").agg(F.sum("df").alias("df")))


class Ranking:
    """Score and upper bound for one block of items: terms, weights and corpus figures."""

    def __init__(self, items: list[tuple[object, list[bytes]]], vocabulary: list[bytes], df: dict[int, int], n_docs: int, n_terms: int):
        self.n_docs, self.n_terms = n_docs, n_terms
        number = {t: i for i, t in enumerate(vocabulary)}
        self.weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df.get(i, 0) + 1))) if df.get(i, 0) else 0
                                for i in range(len(vocabulary))], np.int64)
        self.items = [np.array([j for t in ts if self.weight[j := number[t]] > 0], np.int64) for _, ts in items]
        self.number = {t: i for t, i in number.items() if self.weight[i] > 0}
        self.hashes = np.array([xxhash.xxh64_intdigest(t) for t in vocabulary], _U)
        self.sets = [set(x.tolist()) for x in self.items]

    def part(self, tf, length):
        """(1000000000 * tf) div (1000 * tf + 20 * m), which grows with tf."""
        m = 100 - 50 + (50 * length * self.n_docs) // self.n_terms
        return (1_000_000_000 * tf) // (1000 * tf + 20 * m)

    def score(self, text: str, wanted: list[int]) -> list[int]:
        """Exact scores of a text for the wanted items."""
        words = terms(text)
        tf = Counter(words)
        value = {i: int(self.weight[i]) * self.part(tf[t], len(words)) for t in (tf.keys() & self.number.keys()) for i in (self.number[t],)}
        return [sum(v for i, v in value.items() if i in self.sets[x]) for x in wanted]

    def bounds(self, block) -> np.ndarray:
        """(items, documents) upper bounds of the scores in a block."""
        n, width = int(block["docs"]), int(block["width"])
        slices = np.frombuffer(block["slices"], np.uint8).reshape(width, -1)
        length, most = np.frombuffer(block["lengths"], np.int64), np.frombuffer(block["most"], np.int64)
        out, below = np.zeros((len(self.items), n), np.int64), np.zeros(n, np.int64)
        alive = np.arange(len(self.hashes))
        for level, low in enumerate(LEVELS):
            # what one occurrence more than the level below can add, at most
            high = most if level + 1 == len(LEVELS) else np.minimum(LEVELS[level + 1] - 1, most)
            reach = np.where(most >= low, self.part(np.maximum(high, 1), length), below)
            adds, below = reach - below, reach
            maps = np.bitwise_and.reduce(slices[_positions(_keys(self.hashes[alive], level), width)], axis=1)
            some = maps.any(axis=1)
            alive, maps = alive[some], maps[some]                      # a term that misses a level has none above it
            if not len(alive):
                break
            marked = np.unpackbits(maps, axis=1, count=n)
            row = np.full(len(self.hashes), -1)
            row[alive] = np.arange(len(alive))
            for q, own in enumerate(self.items):
                at = own[row[own] >= 0]
                if len(at):
                    out[q] += (self.weight[at] @ marked[row[at]]) * adds
        return out


def _digests(block) -> np.ndarray:
    return np.frombuffer(block["digests"], "V16")


def best_bounds(blocks: DataFrame, ranking: Ranking, keep: int) -> DataFrame:
    """(item, digest): per task the texts with the ``keep`` highest bounds above 0 of each item, and then of all tasks."""
    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = [{} for _ in ranking.items]
        for batch in batches:
            for block in batch.to_dict("records"):
                bounds, digests = ranking.bounds(block), _digests(block)
                for q, row in enumerate(bounds):
                    top = np.argpartition(-row, min(keep, len(row) - 1))[:keep] if len(row) > keep else np.arange(len(row))
                    mine = best[q]
                    mine |= {digests[j].tobytes(): int(row[j]) for j in top if row[j] > 0}
                    if len(mine) > keep:
                        best[q] = dict(sorted(mine.items(), key=lambda x: (-x[1], x[0]))[:keep])
        yield pd.DataFrame([(q, d, b) for q, mine in enumerate(best) for d, b in mine.items()], columns=["item", "digest", "bound"])

    found = blocks.mapInPandas(scan, "item int, digest binary, bound long").dropDuplicates(["item", "digest"])
    w = Window.partitionBy("item").orderBy(F.col("bound").desc(), "digest")
    return found.withColumn("r", F.row_number().over(w)).where(F.col("r") <= keep).select("item", "digest")


def not_excluded(blocks: DataFrame, ranking: Ranking, threshold: dict[int, int]) -> DataFrame:
    """(item, digest) of every text whose bound is above 0 and reaches the item's threshold."""
    least = np.array([max(1, threshold.get(q, 1)) for q in range(len(ranking.items))])

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for block in batch.to_dict("records"):
                q, j = np.nonzero(ranking.bounds(block) >= least[:, None])
                yield pd.DataFrame({"item": q.astype(np.int32), "digest": [d.tobytes() for d in _digests(block)[j]]}).drop_duplicates()

    return blocks.mapInPandas(scan, "item int, digest binary").distinct()


def exact_scores(docs: DataFrame, candidates: DataFrame, ranking: Ranking, text_col: str = "text") -> DataFrame:
    """(item, digest, score) of the candidates (item, digest), from their whole texts."""
    asked = written(candidates.groupBy("digest").agg(F.collect_set("item").alias("items")), "search_asked")      # at most the block's items
    texts = docs.where(F.col(text_col).isNotNull()).select(F.unhex(F.md5(F.col(text_col))).alias("digest"), F.col(text_col).alias("text"))

    @F.pandas_udf("array<struct<item:int,score:bigint>>")
    def scored(it: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        last: tuple = (None, None, None)
        for texts, wanted in it:
            out = []
            for text, items in zip(texts, wanted):
                items = sorted(items)
                if last[0] != text or last[1] != items:                # copies often follow each other
                    last = (text, items, [{"item": i, "score": s} for i, s in zip(items, ranking.score(text, items))])
                out.append(last[2])
            yield pd.Series(out, dtype=object)

    found = texts.join(asked, "digest").select("digest", F.explode(scored("text", "items")).alias("x"))
    return written(found.select(F.col("x.item").alias("item"), "digest", F.col("x.score").alias("score")).distinct(), "search_scores")


def _item_blocks(items: DataFrame, item_col: str, text_col: str, limit: int) -> Iterator[list[tuple[object, list[bytes]]]]:
    """Items with their distinct terms, in blocks of at most ``limit`` bytes of text."""
    rows = items.where(F.col(text_col).isNotNull()).select(F.col(item_col).alias("i"), F.col(text_col).alias("t")).distinct()
    block: dict = {}
    size = 0
    for r in rows.orderBy("i", "t").toLocalIterator():
        if size + len(r["t"]) > limit and r["i"] not in block and block:
            yield [(i, sorted(ts)) for i, ts in block.items() if ts]
            block, size = {}, 0
        block.setdefault(r["i"], set()).update(terms(r["t"]))
        size += len(r["t"])
    if block:
        yield [(i, sorted(ts)) for i, ts in block.items() if ts]


def rank(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
         item_text_col: str = "text", k: int = 50, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """(item, rank, id, score): the ``k`` documents with the highest score above 0 for each item; equal scores by ascending id.

    * Null, empty and term-free texts are no documents; items without a term get no rows.
    * Several texts under one item id are one item with the terms of all; a null item id is an item of its own.
    * Every row of ``docs`` is a document: repeated rows rank one after the other; null ids come first among equal scores.
    * No documents or no items: no rows.  Texts of any length count as a whole.
    * Only the named columns enter, so no other name can clash.
    """
    spark = docs.sparkSession
    kinds = dict(docs.dtypes) | {f"i.{c}": t for c, t in items.dtypes}
    blocks, total, out = None, None, None
    for block in _item_blocks(items, item_col, item_text_col, item_bytes):
        vocabulary = sorted({t for _, ts in block for t in ts})
        if not vocabulary:
            continue
        if blocks is None:
            blocks = written(index(docs, vocabulary, text_col), "search_index")
            total = blocks.agg(F.sum("n_docs").alias("docs"), F.sum("n_terms").alias("terms")).first()
            counts = blocks.select(F.explode(F.arrays_zip("df_term", "df")).alias("x")).groupBy("x.df_term").agg(F.sum("x.df").alias("df"))
        else:
            counts = document_counts(docs, vocabulary, text_col)
        if not total["docs"]:
            break
        ranking = Ranking(block, vocabulary, {r["df_term"]: r["df"] for r in counts.collect()}, total["docs"], total["terms"])
        signatures = blocks.select("docs", "width", "digests", "lengths", "most", "slices")
        seeds = exact_scores(docs, best_bounds(signatures, ranking, k), ranking, text_col)
        w = Window.partitionBy("item").orderBy(F.col("score").desc())
        kth = seeds.withColumn("r", F.row_number().over(w)).where(F.col("r") == k).select("item", "score")
        threshold = {r["item"]: r["score"] for r in kth.collect()}
        rest = not_excluded(signatures, ranking, threshold).join(seeds.select("item", "digest"), ["item", "digest"], "left_anti")
        scores = seeds.unionByName(exact_scores(docs, rest, ranking, text_col)).where("score > 0")
        # of each text the k smallest ids; the limit applies to each task's rows first
        ids = docs.where(F.col(text_col).isNotNull()).select(F.unhex(F.md5(F.col(text_col))).alias("digest"), F.col(id_col).alias("id"))
        few = Window.partitionBy("digest").orderBy(F.col("id").asc_nulls_first())
        wanted = written(scores.select("digest").distinct(), "search_found")
        ids = ids.withColumn("r", F.row_number().over(few)).where(F.col("r") <= k).drop("r").join(wanted, "digest", "left_semi")
        first = ids.groupBy("digest").agg(F.min(F.struct(F.col("id").isNotNull(), F.col("id"))).alias("first"))
        by_text = Window.partitionBy("item").orderBy(F.col("score").desc(), "first")
        top = scores.join(first, "digest").withColumn("r", F.row_number().over(by_text)).where(F.col("r") <= k).drop("r", "first")
        by_row = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("id").asc_nulls_first())
        best = top.join(ids, "digest").withColumn("rank", F.row_number().over(by_row)).where(F.col("rank") <= k)
        names = spark.createDataFrame([(i, x) for i, (x, _) in enumerate(block)], f"item int, item_id {kinds[f'i.{item_col}']}")
        part = best.join(F.broadcast(names), "item").select(F.col("item_id").alias(item_col), "rank", F.col("id").alias(id_col), "score")
        out = part if out is None else out.unionByName(part)
    if out is None:
        return spark.createDataFrame([], f"`{item_col}` {kinds[f'i.{item_col}']}, rank int, `{id_col}` {kinds[id_col]}, score long")
    return out
