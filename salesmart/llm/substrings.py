"""Exact removal of long repeated substrings (every byte inside a string of ``length`` bytes that also starts elsewhere).

Texts are UTF-8 bytes; matches never cross texts.

1. *Anchors.*  Winnowing over rolling hashes of ``gram`` bytes picks positions
   so that every string of ``length`` bytes holds at least one whole anchor
   gram that the string alone decides: equal strings hold the same anchors at
   the same offsets.  One row a text is written, no text is shuffled.
2. *Candidates.*  Grams with two or more occurrences, from one aggregate with a
   constant-size state.  Only texts with such a gram go on.
3. *Contexts.*  The strings around a repeated anchor lie in its context, the
   bytes from ``length - gram`` before it to ``length`` after its start.  Equal
   contexts of a gram collapse to one; what occurs twice is settled at once.
4. *Comparison.*  Among the different contexts of a gram, strings at the same
   offset are compared by 64-bit multilinear hashes (random multipliers, so
   unequal strings agree with a chance under 2^-56).  All strings that share an
   anchor overlap in it, so per context only the first and the last repeated
   offset matter.  A gram with more than ``GROUP`` contexts is not held in one
   task: its strings are dealt by content and counted with aggregates; rows of
   a range that very many share are found without a shuffle.
   The comparison can also be done by external induced suffix sorting
   (``induced``), which needs no hashes but far more time per byte.
5. *Spans.*  Covered intervals go back to every occurrence, are merged per
   distinct text, and the remaining bytes are hashed.

Each step is a shuffle on a content hash; texts that occur twice as a whole are
processed once.
"""

from __future__ import annotations

from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written
from .induced import scratch_folder, suffixes

LENGTH, GRAM = 400, 200
#: Contexts of one gram that a task compares in memory (about 0.6 kB each); more are dealt by content (``_crowded``).
GROUP = 256
#: Offsets that ``_crowded`` takes together.
RANGE = 25
#: A key of ``_crowded`` with more than 1 / HOT of all rows is broadcast.
HOT = 1024
_BLOCK = 1 << 18
_POS_BITS = 24
_U = np.uint64

_ODD = 0x9E3779B97F4A7C15


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, _U)
    out[0] = 1
    return np.cumprod(out, dtype=_U)


class Anchors:
    """Winnowed positions and gram hashes of byte strings."""

    def __init__(self, length: int = LENGTH, gram: int = GRAM):
        if not 0 < gram < length:
            raise ValueError("gram must be shorter than length")
        self.length, self.gram, self.window = length, gram, length - gram + 1
        size = _BLOCK + length
        self.pow, self.inv = _powers(_ODD, size), _powers(pow(_ODD, -1, 1 << 64), size)

    def of(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """(positions, hashes); empty for texts shorter than ``length``.  Long texts go through in blocks."""
        pos, hashes = [], []
        if len(data) >= self.length:
            for b in range(0, len(data) - self.length + 1, _BLOCK):
                p, h = self._block(data[b:b + _BLOCK + self.length - 1])
                pos.append(p + b)
                hashes.append(h)
        if not pos:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        p, first = np.unique(np.concatenate(pos), return_index=True)
        return p, np.concatenate(hashes)[first].view(np.int64)

    def _block(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        n, k = len(data), self.gram
        x = np.frombuffer(data, np.uint8).astype(_U) + _U(1)
        total = np.zeros(n + 1, _U)
        np.cumsum(x * self.pow[:n], dtype=_U, out=total[1:])
        h = (total[k:] - total[:-k]) * self.inv[:n - k + 1]
        h ^= h >> _U(31)
        h *= _U(0xBF58476D1CE4E5B9)
        h ^= h >> _U(29)
        h *= _U(0x94D049BB133111EB)
        h ^= h >> _U(32)
        low = (1 << _POS_BITS) - 1
        least = (h & ~_U(low)) | (_U(low) - np.arange(len(h), dtype=_U))      # the last of equal minima
        done = 1
        while done * 2 <= self.window:
            least = np.minimum(least[:-done], least[done:])
            done *= 2
        if rest := self.window - done:
            least = np.minimum(least[:-rest], least[rest:])
        at = np.unique(low - (least & _U(low)).astype(np.int64))
        return at, h[at]


def _context(data: bytes, pos: int, length: int, gram: int) -> tuple[int, bytes]:
    """(bytes before the anchor, context)."""
    start = max(0, pos - (length - gram))
    return pos - start, data[start:pos + length]


def repeated_offsets(groups: np.ndarray, before: np.ndarray, contexts: list[bytes], twice: np.ndarray, length: int = LENGTH,
                     gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Per context the largest and smallest number of bytes before the anchor at which a repeated string starts (-1: none).

    ``twice``: contexts that occur more than once, all of whose strings repeat.
    """
    h = _window_hashes(before, contexts, length, gram)
    n_off = length - gram + 1
    sizes = np.array([len(c) for c in contexts])
    lowest = np.maximum(0, length - (sizes - before))          # strings must end inside the text
    offs = np.arange(n_off)
    valid = (offs[None, :] <= before[:, None]) & (offs[None, :] >= lowest[:, None])
    key = (h ^ (groups.view(_U)[:, None] * _U(_ODD))) + offs[None, :].astype(_U) * _U(0xD6E8FEB86659FD93)
    key ^= key >> _U(29)
    flat = key[valid]
    _, inverse, count = np.unique(flat, return_inverse=True, return_counts=True)
    again = np.zeros(valid.shape, bool)
    again[valid] = count[inverse] > 1
    again |= valid & twice[:, None]
    some = again.any(axis=1)
    first, last = again.argmax(axis=1), n_off - 1 - again[:, ::-1].argmax(axis=1)
    return np.where(some, last, -1), np.where(some, first, -1)


def repeated_offsets_induced(groups: np.ndarray, before: np.ndarray, contexts: list[bytes], twice: np.ndarray, length: int = LENGTH,
                             gram: int = GRAM, memory: int = 1 << 18) -> tuple[np.ndarray, np.ndarray]:
    """``repeated_offsets`` by external induced suffix sorting of the contexts, without hashes.

    The contexts are one sequence with a separator of its own after each.
    Neighbouring suffixes with a common prefix of ``length`` form a run; in a
    run, suffixes of one gram at one offset are occurrences of one string.
    """
    symbols, owner = array("q"), array("q")
    starts = []
    for i, c in enumerate(contexts):
        starts.append(len(symbols))
        symbols.extend(x + len(contexts) for x in c)
        symbols.append(i)
        owner.extend([i] * (len(c) + 1))
    hi, lo = np.full(len(contexts), -1), np.full(len(contexts), -1)

    def settle(run: list[tuple[int, int]]) -> None:
        n = Counter((int(groups[i]), a) for i, a in run)
        for i, a in run:
            if n[int(groups[i]), a] > 1 or twice[i]:
                hi[i] = max(hi[i], a)
                lo[i] = a if lo[i] < 0 else min(lo[i], a)

    with scratch_folder() as folder:
        run: list[tuple[int, int]] = []
        for pos, lcp in suffixes(symbols, folder, memory):
            if lcp < length:
                settle(run)
                run = []
            if pos == len(symbols):
                continue
            i = owner[pos]
            a = int(before[i]) - (pos - starts[i])
            if 0 <= a <= length - gram and pos + length <= starts[i] + len(contexts[i]):
                run.append((i, a))
        settle(run)
    return hi, lo


def _sums(before: np.ndarray, contexts: list[bytes], length: int, gram: int) -> np.ndarray:
    """Running sums of a multilinear hash over each context, aligned at the anchor: any stretch is one difference."""
    lead, width = length - gram, 2 * length - gram
    table = np.zeros((len(contexts), width), np.uint8)
    for i, (b, c) in enumerate(zip(before, contexts)):
        table[i, lead - b:lead - b + len(c)] = np.frombuffer(c, np.uint8)
    mult = np.random.default_rng(20240229).integers(0, 1 << 64, width, dtype=_U)
    total = np.zeros((len(contexts), width + 1), _U)
    np.cumsum((table.astype(_U) + _U(1)) * mult[None, :], axis=1, dtype=_U, out=total[:, 1:])
    return total


def _window_hashes(before: np.ndarray, contexts: list[bytes], length: int, gram: int) -> np.ndarray:
    """Hash of the string that starts a bytes before the anchor, for a = 0 .. length - gram."""
    total, lead = _sums(before, contexts, length, gram), length - gram
    a = np.arange(lead + 1)
    return total[:, lead - a + length] - total[:, lead - a]


def _texts(docs: DataFrame, text_col: str) -> DataFrame:
    return docs.select(F.unhex(F.md5(F.coalesce(F.col(text_col), F.lit("")))).alias("key"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def copies(rows: DataFrame, length: int = LENGTH) -> DataFrame:
    """key of the texts of ``rows`` (key, n_bytes) that occur twice as a whole and are long enough to count."""
    return written(rows.where(F.col("n_bytes") >= length).groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key"), "copies")


def repeated_spans(docs: DataFrame, text_col: str = "text", length: int = LENGTH, gram: int = GRAM, group: int = GROUP,
                   engine: str = "windows") -> DataFrame:
    """key (MD5 of the text), text and spans (array of start, end in bytes) of every distinct text that holds a string of
    ``length`` bytes which also starts elsewhere, in this or another distinct text.

    Null and shorter texts have no such string.  Spans are maximal and in order.
    Texts that occur twice (``copies``) are one text here.  ``engine``: how the
    contexts of a gram are compared, by hashes of their "windows" or by
    "induced" suffix sorting; both give the same spans.
    """
    compared_by = {"windows": repeated_offsets, "induced": repeated_offsets_induced}[engine]
    if docs.isEmpty():
        return docs.sparkSession.createDataFrame([], "key binary, text string, spans array<struct<s:int,e:int>>")
    long_texts = _texts(docs, text_col).where(F.octet_length("text") >= length)

    @F.pandas_udf("struct<pos:array<int>,gram:array<bigint>>")
    def anchors(it: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        finder = Anchors(length, gram)
        for texts in it:
            found = [finder.of(t.encode()) for t in texts]
            yield pd.DataFrame({"pos": [p.astype(np.int32) for p, _ in found], "gram": [g for _, g in found]})

    marked = written(long_texts.select("key", anchors("text").alias("a")).select("key", "a.pos", "a.gram"), "anchors")
    each = marked.select("key", F.explode(F.arrays_zip("pos", "gram")).alias("a")).select("key", "a.pos", "a.gram")
    again = written(each.groupBy("gram").agg(F.min(F.xxhash64("key", "pos")).alias("x"), F.max(F.xxhash64("key", "pos")).alias("y"))
                    .where("x <> y").select("gram"), "anchors_again")
    at = each.join(again, "gram", "left_semi").groupBy("key").agg(F.collect_set(F.struct("pos", "gram")).alias("at"))
    # whole texts are shuffled once; copies of a text are merged before and after
    one = long_texts.dropDuplicates(["key"])
    cand = written(one.join(at, "key").select("key", "text", "at"), "candidates")

    @F.pandas_udf("array<struct<pos:int,gram:bigint,ctx:bigint>>")
    def digests(texts: pd.Series, ats: pd.Series) -> pd.Series:
        out = []
        for t, places in zip(texts, ats):
            data = t.encode()
            row = []
            for x in places:
                before, c = _context(data, x["pos"], length, gram)
                d = xxhash.xxh64_intdigest(c, before)
                row.append({"pos": x["pos"], "gram": x["gram"], "ctx": d - (1 << 64) if d >> 63 else d})
            out.append(row)
        return pd.Series(out, dtype=object)

    placed = written(cand.select("key", F.explode(digests("text", "at")).alias("a")).select("key", "a.pos", "a.gram", "a.ctx"), "contexts")
    kinds = placed.groupBy("gram", "ctx").agg(F.min(F.struct("key", "pos")).alias("first"), F.max(F.struct("key", "pos")).alias("last"))
    kinds = kinds.select("gram", "ctx", F.col("first.key").alias("key"), F.col("first.pos").alias("pos"),
                         (F.col("first") != F.col("last")).alias("twice"))
    kinds = written(kinds, "context_kinds")
    per_gram = written(kinds.groupBy("gram").agg(F.count(F.lit(1)).alias("n_ctx")), "context_counts")
    compared = kinds.join(per_gram.where("n_ctx > 1"), "gram")
    wanted = compared.groupBy("key").agg(F.collect_list(F.struct("pos", "gram", "ctx", "twice", "n_ctx")).alias("w"))

    @F.pandas_udf("array<struct<before:int,body:binary,gram:bigint,ctx:bigint,twice:boolean,n_ctx:bigint>>")
    def bodies(texts: pd.Series, wants: pd.Series) -> pd.Series:
        out = []
        for t, places in zip(texts, wants):
            data = t.encode()
            row = []
            for x in places:
                before, c = _context(data, x["pos"], length, gram)
                row.append({"before": before, "body": c, "gram": x["gram"], "ctx": x["ctx"], "twice": bool(x["twice"]), "n_ctx": x["n_ctx"]})
            out.append(row)
        return pd.Series(out, dtype=object)

    bytes_of = (cand.select("key", "text").join(wanted, "key").select(F.explode(bodies("text", "w")).alias("b")).select("b.*"))
    found_kind = "gram long, ctx long, hi int, lo int"

    def compare(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows sorted by gram: whole grams are compared, the last one waits for the next batch."""
        def settle(rows: pd.DataFrame) -> pd.DataFrame:
            hi, lo = compared_by(rows["gram"].to_numpy(np.int64), rows["before"].to_numpy(np.int64), list(rows["body"]),
                                      rows["twice"].to_numpy(bool), length, gram)
            return pd.DataFrame({"gram": rows["gram"].to_numpy(), "ctx": rows["ctx"].to_numpy(), "hi": hi.astype(np.int32),
                                 "lo": lo.astype(np.int32)})[hi >= 0]
        rest = None
        for batch in it:
            rows = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            while len(rows):
                # blocks of a few thousand contexts that end where a gram ends
                grams = rows["gram"].to_numpy()
                borders = np.flatnonzero(grams[1:] != grams[:-1]) + 1
                if not len(borders):
                    break
                cut = int(borders[max(0, np.searchsorted(borders, 4000, side="right") - 1)])
                yield settle(rows.iloc[:cut])
                rows = rows.iloc[cut:].reset_index(drop=True)
            rest = rows if len(rows) else None
        if rest is not None:
            yield settle(rest)

    small = bytes_of.where(F.col("n_ctx") <= group).repartition("gram").sortWithinPartitions("gram").mapInPandas(compare, found_kind)
    settled = kinds.join(per_gram.where("n_ctx = 1"), "gram").select("gram", "ctx", F.lit(length - gram).alias("hi"), F.lit(0).alias("lo"))
    found = small.unionByName(settled)
    if not per_gram.where(F.col("n_ctx") > group).isEmpty():
        found = found.unionByName(_crowded(bytes_of.where(F.col("n_ctx") > group), length, gram))
    found = written(found, "context_results")
    covered = (placed.join(found, ["gram", "ctx"])
               .select("key", F.struct((F.col("pos") - F.col("hi")).alias("s"), (F.col("pos") - F.col("lo") + length).alias("e")).alias("span"))
               .groupBy("key").agg(F.collect_set("span").alias("spans")))
    # settled contexts may reach over the text's ends: clip to the strings that fit
    size = F.octet_length("text")
    clipped = F.transform("spans", lambda x: F.struct(F.greatest(x["s"], F.lit(0)).alias("s"), F.least(x["e"], size).alias("e")))
    return cand.select("key", "text").join(covered, "key").select("key", "text", _merged(clipped).alias("spans"))


def _crowded(rows: DataFrame, length: int, gram: int) -> DataFrame:
    """The comparison of ``repeated_offsets`` for grams with many contexts, dealt by content and counted by aggregates.

    Offsets are taken in ranges.  All strings that start in a range share its
    *core*, and its *window* holds them all.  A window that two contexts share
    repeats every string of the range; a core that only one window has repeats
    none.  What is left, different windows around one core, is compared string
    by string, one context a window.
    """
    lead = length - gram
    rows = written(rows, "crowded")
    ranges = [(lo, min(lo + RANGE - 1, lead)) for lo in range(0, lead + 1, RANGE)]

    @F.pandas_udf("array<struct<lo:int,hi:int,core:bigint,window:bigint>>")
    def parts_of(before: pd.Series, body: pd.Series, ctx: pd.Series) -> pd.Series:
        b, size = before.to_numpy(np.int64), body.str.len().to_numpy(np.int64)
        total = _sums(b, list(body), length, gram)
        first, last = np.maximum(0, length - (size - b)), np.minimum(b, lead)
        own = ctx.to_numpy(np.int64).view(_U) * _U(_ODD)
        out = [[] for _ in b]
        for lo, hi in ranges:
            core = total[:, lead - hi + length] - total[:, lead - lo]
            window = total[:, lead - lo + length] - total[:, lead - hi]
            whole = (first <= lo) & (last >= hi)
            window = np.where(whole, window, window ^ own)             # a range that a text's end cuts is like no other
            for i in np.flatnonzero((first <= hi) & (last >= lo)):
                out[i].append({"lo": lo, "hi": hi, "core": int(core[i].view(np.int64)), "window": int(window[i].view(np.int64))})
        return pd.Series(out, dtype=object)

    @F.pandas_udf("array<bigint>")
    def hashes(before: pd.Series, body: pd.Series) -> pd.Series:
        h = _window_hashes(before.to_numpy(np.int64), list(body), length, gram)
        return pd.Series(list(h.view(np.int64)), dtype=object)

    parts = rows.select("gram", "ctx", F.explode(parts_of("before", "body", "ctx")).alias("p")).select("gram", "ctx", "p.*")
    parts = written(parts, "crowded_ranges")
    windows = parts.groupBy("gram", "lo", "core", "window").agg(F.min("ctx").alias("ctx"), F.max("ctx").alias("other"), F.count(F.lit(1)).alias("n"))
    windows = written(windows, "crowded_windows")
    by_window = _rows_of(parts, windows.where("ctx <> other"), ["gram", "lo", "window"]).select("gram", "ctx", "hi", "lo")
    mixed = (windows.groupBy("gram", "lo", "core").agg(F.min("window").alias("x"), F.max("window").alias("y"), F.count(F.lit(1)).alias("n"))
             .where("x <> y").select("gram", "lo", "core", "n"))
    asked = _rows_of(windows, written(mixed, "crowded_cores"), ["gram", "lo", "core"])
    asked = written(asked.groupBy("gram", "ctx").agg(F.collect_set("lo").alias("los")), "crowded_asked")       # at most the ranges
    size = F.octet_length("body")
    each = (rows.join(asked, ["gram", "ctx"]).select("gram", "ctx", "los", "before", size.alias("size"), F.posexplode(hashes("before", "body")).alias("a", "h"))
            .where((F.col("a") <= F.col("before")) & (F.col("a") >= length - (F.col("size") - F.col("before"))) & (F.col("a") <= lead)
                   & F.array_contains("los", F.expr(f"CAST(a - a % {RANGE} AS INT)"))))
    each = written(each.select("gram", "ctx", "a", "h"), "strings")
    again = each.groupBy("gram", "a", "h").agg(F.min("ctx").alias("x"), F.max("ctx").alias("y")).where("x <> y").select("gram", "a", "h")
    a = F.col("a").cast("int")
    by_string = each.join(again, ["gram", "a", "h"], "left_semi").select("gram", "ctx", a.alias("hi"), a.alias("lo"))
    twice = rows.where("twice").select("gram", "ctx", F.least(F.col("before"), F.lit(lead)).alias("hi"),
                                       F.greatest(F.lit(0), length - (size - F.col("before"))).alias("lo"))
    return (by_window.unionByName(by_string).unionByName(twice.where("lo <= hi"))
            .groupBy("gram", "ctx").agg(F.max("hi").cast("int").alias("hi"), F.min("lo").cast("int").alias("lo")))


def _rows_of(rows: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """``rows`` whose ``on`` is among ``keys``, which hold each with its number ``n`` of rows.

    A key with a large share of the rows (fewer than ``HOT`` can have one) is
    broadcast and its rows stay in place; only the others are shuffled.
    """
    bound = rows.count() // HOT
    hot = F.broadcast(keys.where(F.col("n") > bound).select(*on))
    others = keys.where(F.col("n") <= bound).select(*on)
    return rows.join(hot, on, "left_semi").unionByName(rows.join(hot, on, "left_anti").join(others, on, "left_semi"))


def _merged(spans: Column) -> Column:
    """Intervals joined where they touch or overlap, in order."""
    kind = "array<struct<s:int,e:int>>"
    start = F.struct(F.array().cast(kind).alias("done"), F.lit(-1).alias("s"), F.lit(-1).alias("e"))

    def add(acc, x):
        joins = x["s"] <= acc["e"]
        closed = F.when(joins | (acc["s"] < 0), acc["done"]).otherwise(F.concat(acc["done"], F.array(F.struct(acc["s"].alias("s"), acc["e"].alias("e")))))
        return F.struct(closed.alias("done"), F.when(joins, acc["s"]).otherwise(x["s"]).alias("s"),
                        F.when(joins, F.greatest(acc["e"], x["e"])).otherwise(x["e"]).alias("e"))

    def finish(acc):
        return F.when(acc["s"] < 0, acc["done"]).otherwise(F.concat(acc["done"], F.array(F.struct(acc["s"].alias("s"), acc["e"].alias("e")))))
    return F.aggregate(F.array_sort(spans), start, add, finish)


def cut_spans(text: Column, spans: Column) -> Column:
    """The bytes of ``text`` outside ``spans`` (binary)."""
    @F.pandas_udf("binary")
    def of(texts: pd.Series, cuts: pd.Series) -> pd.Series:
        out = []
        for t, c in zip(texts, cuts):
            data, at, parts = t.encode(), 0, []
            for x in c:
                parts.append(data[at:x["s"]])
                at = x["e"]
            out.append(b"".join([*parts, data[at:]]))
        return pd.Series(out, dtype=object)
    return of(text, spans)


def _left_over(text: Column, spans: Column) -> Column:
    """``text`` without ``spans``, put together from the pieces between them; bytes of a character that a cut splits become U+FFFD."""
    data = text.cast("binary")
    ends = F.concat(F.array(F.lit(0)), F.transform(spans, lambda x: x["e"]))
    starts = F.concat(F.transform(spans, lambda x: x["s"]), F.array(F.octet_length(text)))
    pieces = F.zip_with(ends, starts, lambda e, s: F.hex(F.substr(data, e + 1, s - e)))
    return F.make_valid_utf8(F.unhex(F.array_join(pieces, "")).cast("string"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM,
                   group: int = GROUP, engine: str = "windows", with_text: bool = False) -> DataFrame:
    """id, n_bytes, n_removed, n_spans and kept_sha256 of every row of ``docs``; ``with_text``: and the text that is left.

    * Null counts as empty; texts shorter than ``length`` bytes lose nothing.
    * A text that occurs twice as a whole, or a row repeated, loses all its bytes.
    * Ids may be null or repeated: the text decides.  Other columns do not enter.
    * The text that is left is '' for null; where a cut splits a character its remaining bytes are replaced by U+FFFD.
    * An empty table gives an empty result.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = written(docs.select(F.col(id_col).alias("_id"), F.unhex(F.md5(text)).alias("key"), F.octet_length(text).cast("long").alias("n_bytes"),
                               F.sha2(text, 256).alias("all_sha256")), "substring_rows")
    whole = copies(rows, length)
    spans = repeated_spans(docs, text_col, length, gram, group, engine).join(whole, "key", "left_anti")
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["e"] - x["s"])
    kept = [F.sha2(cut_spans(F.col("text"), F.col("spans")), 256).alias("kept_sha256"), "spans"]
    no_spans = F.lit(None).cast("array<struct<s:int,e:int>>").alias("spans")
    results = (spans.select("key", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), *kept)
               .unionByName(whole.select("key", F.lit(-1).cast("long").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"),
                                         F.sha2(F.lit(""), 256).alias("kept_sha256"), no_spans)))
    results = written(results, "substring_results")
    zero = F.lit(0).cast("long")
    taken = F.when(F.col("n_removed") < 0, F.col("n_bytes")).otherwise(F.coalesce("n_removed", zero))
    columns = [F.col("_id").alias(id_col), "n_bytes", taken.alias("n_removed"), F.coalesce("n_spans", zero).alias("n_spans"),
               F.coalesce("kept_sha256", "all_sha256").alias("kept_sha256")]
    if not with_text:
        return rows.join(results.drop("spans"), "key", "left").select(*columns)
    # texts are read again where they lie and meet what was found for them
    full = docs.select(F.col(id_col).alias("_id"), F.unhex(F.md5(text)).alias("key"), F.octet_length(text).cast("long").alias("n_bytes"),
                       text.alias("text"))
    left = (F.when(F.col("n_removed") < 0, F.lit("")).when(F.col("spans").isNull(), F.col("text"))
            .otherwise(_left_over(F.col("text"), F.col("spans"))))
    columns[-1] = F.coalesce("kept_sha256", F.sha2("text", 256)).alias("kept_sha256")
    return full.join(results, "key", "left").select(*columns, left.alias(text_col))
