"""op13: ranked search over signatures against a full scan."""

import math
import random
import re
from collections import Counter

import duckdb
import numpy as np

from salesmart.llm import queries, ranked_search
from salesmart.llm.ranked_search import Ranking, index, rank, terms

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}
SCHEMA = "doc_id long, text string, digest string, id long, items string, score int, r int, rank int"


def words(text):
    return [w.translate(UPPER) for w in TERM.findall(text or "")]


def brute(docs, items, k=50):
    """[(item, rank, id, score)]: every document scored for every item."""
    bags = [(i, words(t)) for i, t in docs]
    bags = [(i, Counter(w), len(w)) for i, w in bags if w]
    total, n_terms = len(bags), sum(n for _, _, n in bags)
    df = Counter(t for _, tf, _ in bags for t in tf)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(words(t))
    out = []
    for item, ts in asked.items():
        w = {t: math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) for t in ts if df[t]}
        scored = []
        for i, tf, n in bags:
            m = 50 + (50 * n * total) // n_terms
            s = sum(x * ((10 ** 9 * tf[t]) // (1000 * tf[t] + 20 * m)) for t, x in w.items() if t in tf)
            if s > 0:
                scored.append((-s, i is not None, i or 0, i))
        out += [(item, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(scored)[:k])]
    return sorted(out, key=lambda x: (x[0] is not None, x[0] or 0, x[1]))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda x: (x[0] is not None, x[0] or 0, x[1]))


def made(seed, n):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)] + ["Été", "naïve", "日本語", "a1B2"]
    weights = [1 / (i + 1) for i in range(len(vocab))]
    docs = []
    for i in range(n):
        size = rnd.choice([1, 3, 20, 80, 300, 2500 if i % 50 == 0 else 40])
        docs.append((i, rnd.choice([" ", ", ", "_", "\x1c"]).join(rnd.choices(vocab, weights, k=size))))
    return docs, [(i, " ".join(rnd.sample(vocab, rnd.randint(1, 12)))) for i in range(15)]


def test_equals_full_scan(spark, monkeypatch):
    docs, items = made(1, 700)
    docs += [(7, docs[7][1])] * 3 + [(9000 + i, docs[20][1]) for i in range(120)] + [(None, docs[3][1]), (1, None), (2, ""), (3, " _-! "), (None, None)]
    items += [(20, None), (21, ""), (22, "zzz unseen"), (0, "w1 W2"), (None, "w5 w9"), (23, "été ÉTÉ Été")]
    d = spark.createDataFrame([r + ("x", 1, "y", 2, 3, 4) for r in docs], SCHEMA).repartition(6)
    i = spark.createDataFrame([r + ("x", 1, "y", 2, 3, 4) for r in items], SCHEMA.replace("doc_id", "item_id"))
    want = brute(docs, items)
    assert rows(rank(d, i)) == want
    assert rows(rank(d, i, k=7, item_bytes=200)) == brute(docs, items, 7)


def test_bounds_hold_and_exclude(spark):
    docs, items = made(2, 600)
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    asked = [(i, sorted(set(terms(t)))) for i, t in items]
    vocabulary = sorted({t for _, ts in asked for t in ts})
    blocks = index(d, vocabulary).toPandas()
    assert blocks["n_docs"].sum() == 600 and blocks["n_terms"].sum() == sum(len(words(t)) for _, t in docs)
    df = Counter(t for _, x in docs for t in set(terms(x)))
    r = Ranking(asked, vocabulary, {i: df[t] for i, t in enumerate(vocabulary)}, 600, int(blocks["n_terms"].sum()))
    by_digest = {__import__("hashlib").md5(t.encode()).digest(): t for _, t in docs}
    above = exact = 0
    for b in blocks.to_dict("records"):
        bounds = r.bounds(b)
        for j, digest in enumerate(ranked_search._digests(b)):
            scores = r.score(by_digest[digest.tobytes()], list(range(len(items))))
            assert (bounds[:, j] >= scores).all()
            above, exact = above + bounds[:, j].sum(), exact + sum(scores)
    assert above < 1.3 * exact                                         # bounds are tight enough to exclude


def test_empty_tables(spark):
    docs, items = (spark.createDataFrame([], s) for s in ("doc_id long, text string", "item_id long, text string"))
    some_docs, some_items = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id long, text string")
    for d, i in ((docs, items), (docs, some_items), (some_docs, items)):
        assert rank(d, i).collect() == []
    assert [tuple(r) for r in rank(some_docs, some_items).collect()] == brute([(1, "a b")], [(1, "a")])


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.01"
    got = rows(queries.QUERIES["op13_ranked_search"](spark, sf))
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    assert got == con.execute("SELECT item_id, rank, doc_id, score FROM (" + queries.ORACLE["op13_ranked_search"] + ") ORDER BY 1, 2").fetchall()
