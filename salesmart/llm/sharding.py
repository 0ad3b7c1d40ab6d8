"""Sharding by minimax contiguous partition over atomic groups.

Groups (equal texts) keep together and are ordered by their digest, which
shuffles the corpus.  The smallest capacity for which a greedy left-to-right
fill needs at most ``n`` shards is found by binary search.  The cuts keep to
that capacity; where it leaves room (a plain greedy fill would starve the last
shards), each shard takes an even share of what is left.

The search runs on a bounded summary: sums by digest prefix, not by group.  A
prefix with several groups can only be cut somewhere inside, so greedy fills
are run twice, once as if it could be cut at any byte (a lower bound of the
capacity) and once only before it (an upper bound).  Prefixes in which a cut
may fall are split by two more hex digits with one aggregate on the executors,
until every cut falls between single groups; the result is exact.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import own_columns, values, written
from .ranks import running_sum

#: Hex digits of the first summary (at most 16^4 rows) and prefixes split in one round.
FIRST_DIGITS, SPLITS = 4, 512


def text_key(text: Column) -> Column:
    """Digest that orders and identifies groups of equal texts; '' for null, so null texts are a group of their own."""
    return F.coalesce(F.md5(text), F.lit(""))


def text_size(text: Column) -> Column:
    """UTF-8 bytes of the text (null: none) plus 8."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long")


def minimax(totals: list[int], n: int) -> tuple[int, list[int]]:
    """Smallest capacity and the first item of each part but the first, for atomic items in order."""
    cum = [0, *accumulate(totals)]
    search = _Search(cum, [True] * len(totals), n)
    cap = search.least(False)
    return cap, search.cuts(cap)


class _Search:
    """Greedy fills over segments with running sums ``cum``; a segment is one group (``atomic``) or several."""

    def __init__(self, cum: list[int], atomic: list[bool], n: int):
        self.cum, self.atomic, self.n, self.total = cum, atomic, n, cum[-1]

    def step(self, start: int, cap: int, inside: bool) -> int:
        """Where the next part may start at the latest; ``inside``: segments of several groups are cut at any byte."""
        to = start + cap
        if to >= self.total:
            return self.total
        i = bisect_right(self.cum, to) - 1
        return to if inside and not self.atomic[i] else self.cum[i]

    def fits(self, cap: int, inside: bool) -> bool:
        at = 0
        for _ in range(self.n):
            if (to := self.step(at, cap, inside)) == self.total:
                return True
            if to <= at:
                return False
            at = to
        return False

    def least(self, inside: bool) -> int:
        lo, hi = -(-self.total // self.n), self.total
        while lo < hi:
            mid = (lo + hi) // 2
            lo, hi = (lo, mid) if self.fits(mid, inside) else (mid + 1, hi)
        return lo

    def cuts(self, cap: int) -> list[int]:
        """First segments of the parts: no part above ``cap``, and each near an even share of what is left.

        ``need[j]`` is the earliest start from which the last parts still fit, found by a greedy fill from the right.
        """
        need = [self.total]
        for _ in range(self.n - 1):
            need.append(self.cum[bisect_left(self.cum, need[-1] - cap)] if need[-1] > cap else 0)
        at, out = 0, []
        for j in range(1, self.n):
            left = self.n - j
            ideal = at + (self.total - at) / (left + 1)
            low, high = bisect_left(self.cum, max(need[left], at + 1)), bisect_right(self.cum, at + cap) - 1
            i = bisect_left(self.cum, ideal)
            i = i if i == 0 or self.cum[min(i, len(self.cum) - 1)] - ideal < ideal - self.cum[i - 1] else i - 1
            i = max(min(i, high), min(low, high))
            at = self.cum[i]
            if at >= self.total:
                break
            out.append(i)
        return out

    def open_segments(self, low: int, high: int) -> list[int]:
        """Segments of several groups in which a cut may fall for some capacity from ``low`` to ``high``."""
        a = b = 0
        found: set[int] = set()
        for _ in range(self.n):
            first = bisect_right(self.cum, a + low) - 1
            last = bisect_right(self.cum, min(b + high, self.total - 1)) - 1
            found.update(i for i in range(first, min(last, len(self.atomic) - 1) + 1) if not self.atomic[i])
            a, b = max(a, self.step(a, low, False)), min(self.total, b + high)
            if a >= self.total:
                break
        return sorted(found, key=lambda i: self.cum[i] - self.cum[i + 1])


def borders(groups: DataFrame, n: int) -> tuple[int, list[str]]:
    """(capacity, n - 1 or fewer border keys) of ``groups`` (key, bytes): a key belongs to the shard after its last border at or below it."""
    spark = groups.sparkSession

    def summary(df: DataFrame, digits) -> list[tuple[str, int, int]]:
        rows = df.groupBy(F.substr("key", F.lit(1), digits).alias("p")).agg(
            F.sum("bytes").alias("b"), F.count(F.lit(1)).alias("n"), F.min("key").alias("k")).collect()
        # a single group is named by its whole key, so that no border has to be split again
        return [(r["k"] if r["n"] == 1 else r["p"], r["b"], r["n"]) for r in rows]

    segments = sorted(summary(groups, F.lit(FIRST_DIGITS)))
    if not segments:
        return 0, []
    while True:
        search = _Search([0, *accumulate(s[1] for s in segments)], [s[2] == 1 for s in segments], n)
        low, high = search.least(True), search.least(False)
        split = search.open_segments(low, high)[:SPLITS]
        if not split:
            return high, [segments[i][0] for i in search.cuts(high)]
        chosen = values(spark, "p string, digits int", [(segments[i][0], len(segments[i][0])) for i in split])
        lengths = sorted({len(segments[i][0]) for i in split})
        finer: list[tuple[str, int, int]] = []
        for d in lengths:
            part = groups.join(F.broadcast(chosen.where(F.col("digits") == d)), F.substr("key", F.lit(1), F.lit(d)) == F.col("p"), "left_semi")
            finer += summary(part, F.lit(d + 2))
        gone = set(split)
        segments = sorted([s for i, s in enumerate(segments) if i not in gone] + finer)


def shard_of(key: Column, border_keys: list[str]) -> Column:
    """0-based shard: how many borders are at or below the key."""
    if not border_keys:
        return F.lit(0)
    return F.size(F.filter(F.array(*[F.lit(b) for b in border_keys]), lambda b: b <= key))


def rows_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, size, text_crc32 and group key of every row, written once."""
    text = F.col(text_col)
    return written(docs.select(F.col(id_col).alias("_id"), text_size(text).alias("size"),
                               F.crc32(F.coalesce(text, F.lit(""))).cast("long").alias("text_crc32"), text_key(text).alias("key")),
                   "shard_rows")


def plan(rows: DataFrame, n: int) -> tuple[int, list[str]]:
    """Capacity and border keys for ``rows`` (key, size).  A group's copies are summed before they are shuffled."""
    return borders(written(rows.groupBy("key").agg(F.sum("size").alias("bytes")), "shard_groups"), n)


def assign(docs: DataFrame, n: int = 24, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, size, text_crc32, shard (0 to n - 1) and slot of every row of ``docs``.

    * Equal texts share a shard; so do all null texts (empty texts are another group).
    * The fullest shard is as small as contiguous groups in digest order allow; a
      group larger than an even share makes its own shard that large.
    * Slots run from 0 without a gap in each shard, in an order hashed from id and
      digest; repeated rows get a slot each.  Other columns of ``docs`` do not enter.
    * No rows: an empty result.  Fewer groups than shards leave shards empty.
    """
    rows = rows_of(docs, id_col, text_col)
    _, border_keys = plan(rows, n)
    placed = rows.withColumn("shard", shard_of(F.col("key"), border_keys).cast("int"))
    out = running_sum(placed, ["shard"], F.xxhash64("_id", "key"), ["_id", "key"], F.lit(1), "slot")
    return out.select(F.col("_id").alias(id_col), "size", "text_crc32", "shard", "slot")


@own_columns("text_col")
def with_shard(docs: DataFrame, n: int = 24, text_col: str = "text", name: str = "shard") -> DataFrame:
    """``docs`` plus the shard, from the border keys: texts are read once more and not shuffled.

    Equal texts share a shard, and so do all null texts; a column called ``name`` is replaced, all others stay.  No rows: an empty result."""
    _, border_keys = plan(docs.select(text_key(F.col(text_col)).alias("key"), text_size(F.col(text_col)).alias("size")), n)
    return docs.withColumn(name, shard_of(text_key(F.col(text_col)), border_keys).cast("int"))
