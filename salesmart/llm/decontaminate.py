"""Benchmark decontamination: one Aho-Corasick automaton over normalised benchmark texts.

Texts become word sequences (A-Z lower-cased, words of digits, letters and all
non-ASCII characters).  Every window of ten consecutive words of a benchmark
item is a pattern; an item of fewer words is one pattern.  Each distinct
benchmark word gets a code point, so a document is one string of code points
and one C scan of the automaton finds every window, of any item, in one pass.
Matches map back to word numbers and to character offsets in the original.

The automaton is broadcast, so its source is bounded: a benchmark of more than
``BLOCK_BYTES`` is dealt into blocks by item hash, each scanned on its own, and
the hits of a text are put together again by its digest.
"""

from __future__ import annotations

import re
import uuid

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import own_columns, text_part, with_few, written

WINDOW = 10
#: Benchmark text that one automaton may hold (UTF-8 bytes); each byte costs some tens of bytes of automaton.
BLOCK_BYTES = 4 << 20

HITS = "struct<n_words:bigint,spans:array<struct<w0:int,w1:int,c0:int,c1:int>>,items:array<string>>"

_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_WORD = re.compile(rb"[^ ]+")


def normalised(text: str | None) -> bytes:
    """UTF-8 bytes with A-Z lowered and every non-word byte as a space; byte offsets are kept."""
    return (text or "").encode().translate(_FOLD)


class Scanner:
    """The automaton of a list of (item id, text)."""

    def __init__(self, items: list[tuple], window: int = WINDOW):
        self.code: dict[bytes, str] = {}
        owners: dict[str, set[str]] = {}
        for item, text in items:
            w = "".join(self._code(x) for x in normalised(text).split())
            for p in ([w[i:i + window] for i in range(len(w) - window + 1)] if len(w) >= window else [w] if w else []):
                owners.setdefault(p, set()).update([] if item is None else [str(item)])
        self.automaton = ahocorasick.Automaton()
        for p, own in owners.items():
            self.automaton.add_word(p, (len(p), sorted(own)))
        self.automaton.make_automaton()
        self.empty = not owners

    def _code(self, word: bytes) -> str:
        """A code point of its own for each word: from 1, without the surrogates."""
        if word not in self.code:
            n = len(self.code) + 1
            self.code[word] = chr(n if n < 0xD800 else n + 0x800)
        return self.code[word]

    def scan(self, text: str | None) -> tuple[int, list[tuple[int, int, int, int]], list[str]]:
        """Number of words, maximal hit runs (first word, past the last, first character, past the last), items."""
        norm = normalised(text)
        words = norm.split()
        if self.empty or not words:
            return len(words), [], []
        known = self.code.get
        runs: list[list[int]] = []
        items: set[str] = set()
        coded = "".join([known(w, "\0") for w in words])
        found = []
        for end, (n, own) in self.automaton.iter(coded):
            found.append((end - n + 1, end + 1))
            items.update(own)
        for a, b in sorted(found):
            if runs and a <= runs[-1][1]:
                runs[-1][1] = max(runs[-1][1], b)
            else:
                runs.append([a, b])
        if not runs:
            return len(words), [], []
        at = [m.span() for m in _WORD.finditer(norm)]
        raw = (text or "").encode()
        chars = lambda to: len(raw[:to].decode())
        return len(words), [(a, b, chars(at[a][0]), chars(at[b - 1][1])) for a, b in runs], sorted(items)


_SCANNERS: dict[str, Scanner] = {}


def _scanner(key: str, items: list[tuple], window: int) -> Scanner:
    """The worker's automaton for ``key``: built once a process, and only the last one is kept."""
    if key not in _SCANNERS:
        _SCANNERS.clear()
        _SCANNERS[key] = Scanner(items, window)
    return _SCANNERS[key]


def _scan_column(spark, items: list[tuple], text: Column, window: int) -> Column:
    shared, key = spark.sparkContext.broadcast(items), uuid.uuid4().hex

    @F.pandas_udf(HITS)
    def scan(texts: pd.Series) -> pd.DataFrame:
        scanner = _scanner(key, shared.value, window)
        rows = [scanner.scan(t) for t in texts]
        return pd.DataFrame({"n_words": [r[0] for r in rows],
                             "spans": [[dict(zip(("w0", "w1", "c0", "c1"), s)) for s in r[1]] for r in rows],
                             "items": [r[2] for r in rows]})
    return scan(text)


def _merged(spans: Column) -> Column:
    """Sorted spans with those that touch or overlap joined (blocks may each hold a part of a run)."""
    kind = "array<struct<w0:int,w1:int,c0:int,c1:int>>"
    def add(acc, s):
        last = F.element_at(acc, -1)
        joined = F.struct(last["w0"].alias("w0"), F.greatest(last["w1"], s["w1"]).alias("w1"),
                          last["c0"].alias("c0"), F.greatest(last["c1"], s["c1"]).alias("c1"))
        return F.when((F.size(acc) > 0) & (F.get(acc, F.size(acc) - 1)["w1"] >= s["w0"]),
                      F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(joined))).otherwise(F.concat(acc, F.array(s)))
    return F.aggregate(F.array_sort(spans), F.array().cast(kind), add)


@own_columns("text_col")
def mark(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
         name: str = "hits", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` plus the struct ``name``: n_words, spans (hit runs as word numbers and character offsets), items.

    * Null and empty texts have no words and no hits; items without words have no window.
    * A null item id marks words but is not listed; repeated items count once.
    * Whole texts are scanned; runs that touch are one run.  Repeated rows stay repeated.
    * An empty benchmark marks nothing.  A column of ``docs`` called ``name`` is replaced.
    """
    spark = docs.sparkSession
    bench = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(item_text).alias("body")).where("body IS NOT NULL")
    size = bench.agg(F.sum(F.octet_length("body") + F.lit(16))).first()[0] or 0
    n_blocks = max(1, -(-size // block_bytes))
    if n_blocks == 1:
        return docs.withColumn(name, _scan_column(spark, [tuple(r) for r in bench.distinct().collect()], F.col(text_col), window))
    parts = []
    for k in range(n_blocks):
        items = bench.where(F.pmod(F.xxhash64("item", "body"), F.lit(n_blocks)) == k).distinct().collect()
        seen = docs.where(F.col(text_col).isNotNull()).select(F.sha2(text_col, 256).alias("_d"), text_part(F.col(text_col)).alias("_part"),
                                                              F.col(text_col).alias("_t"))
        seen = seen.select("_d", "_part", _scan_column(spark, [tuple(r) for r in items], F.col("_t"), window).alias("h"))
        parts.append(written(seen.where(F.size("h.spans") > 0).dropDuplicates(["_d"]), "decontaminate_block"))
    hits = parts[0]
    for p in parts[1:]:
        hits = hits.unionByName(p)
    hits = hits.groupBy("_d", "_part").agg(F.flatten(F.collect_list("h.spans")).alias("s"), F.flatten(F.collect_list("h.items")).alias("i"))
    hit = F.struct(_merged(F.col("s")).alias("spans"), F.array_sort(F.array_distinct("i")).alias("items"))
    hits = written(hits.select("_d", "_part", hit.alias("_hit")), "decontaminate_hits")
    out = with_few(docs.drop(name), text_col, hits, "_hit")
    words = _scan_column(spark, [], F.col(text_col), window)["n_words"]
    kind = "array<struct<w0:int,w1:int,c0:int,c1:int>>"
    return out.withColumn(name, F.struct(words.alias("n_words"), F.coalesce("_hit.spans", F.array().cast(kind)).alias("spans"),
                                         F.coalesce("_hit.items", F.array().cast("array<string>")).alias("items"))).drop("_hit")


def n_hit(hits: Column) -> Column:
    """Words inside the hit runs."""
    return F.aggregate(hits["spans"], F.lit(0).cast("long"), lambda n, s: n + s["w1"] - s["w0"])


@own_columns("text_col")
def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **kw) -> DataFrame:
    """The rows of ``docs`` without any hit word, with their own columns, whatever these are called.

    Null and empty texts have no words and stay; repeated rows stay or go together; an empty table or benchmark changes nothing."""
    marked = mark(docs, benchmark, text_col, name="_hits", **kw)
    return marked.where(F.size("_hits.spans") == 0).select(*docs.columns)
