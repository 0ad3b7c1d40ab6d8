"""Windows found by the automaton against brute force."""
import hashlib
import re

from pyspark.sql import functions as F

from salesmart.llm import decontaminate as dc
from salesmart.llm.queries import QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(t):
    return WORD.findall((t or "").translate(LOWER))


def brute(text, items):
    w, hit, found = words(text), set(), set()
    at = {}
    for n in {min(10, len(words(t))) for _, t in items} - {0}:
        for i in range(len(w) - n + 1):
            at.setdefault(tuple(w[i:i + n]), []).append(i)
    for item, t in items:
        x = words(t)
        for win in [tuple(x[i:i + 10]) for i in range(len(x) - 9)] or ([tuple(x)] if x else []):
            for i in at.get(win, []):
                hit |= set(range(i, i + len(win)))
                found |= set() if item is None else {str(item)}
    return len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)


def test_query_matches_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op7_decontaminate"](spark, sf).collect()}
    assert got == {d.doc_id: brute(d.text, items) for d in docs}
    assert any(v[-1] for v in got.values())


ITEMS = [(1, "One two, THREE four five six seven eight nine ten eleven"), (2, "kurz É"), (2, "kurz É"), (10, None), (11, "..."),
         (None, "no id but words"), (3, "a a a a a a a a a a a")]
TEXTS = [None, "", "... !", "x one TWO three\nfour-five six seven eight nine ten eleven y", "two three four five six seven eight nine ten eleven",
         "kurz é", "say kurz É, kurz É!", "no id but words", "a " * 30, "b " * 40000 + "kurz É", "one two three"]


def test_edges_and_blocks(spark):
    docs = spark.createDataFrame([(i, t, "h", 2) for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], "h", 2)],
                                 "doc_id long, text string, hits string, item_id int")
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    for block in (1 << 20, 60):
        rows = dc.mark(docs, bench, block_bytes=block).select("doc_id", "hits", dc.n_hit(F.col("hits")).alias("n")).collect()
        assert len(rows) == len(TEXTS) + 1
        for r in rows:
            n_words, n_hit, n_items, digest, _ = brute(TEXTS[r.doc_id], ITEMS)
            assert (r.hits.n_words, r.n, len(r.hits["items"])) == (n_words, n_hit, n_items)
            assert hashlib.sha256(",".join(sorted(r.hits["items"])).encode()).hexdigest() == digest
        kept = dc.clean(docs, bench, block_bytes=block)
        assert kept.columns == docs.columns
        assert {r.doc_id for r in kept.collect()} == {i for i, t in enumerate(TEXTS) if not brute(t, ITEMS)[1]}
    three = next(r for r in dc.mark(docs, bench).collect() if r.doc_id == 3)
    assert [TEXTS[3][s.c0:s.c1] for s in three.hits.spans] == ["one TWO three\nfour-five six seven eight nine ten eleven"]


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert dc.mark(docs, none).first().hits.n_words == 2
    assert dc.clean(docs, none).count() == 1 and dc.clean(docs.limit(0), none).count() == 0
