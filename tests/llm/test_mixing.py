"""Targets, schedule and taken words against plain Python."""
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from salesmart.llm import mixing as mx
from salesmart.llm.queries import QUERIES


def brute_targets(sizes, epochs=3):
    """{source: target} of {source: size}: share, cap, share the excess again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in fixed]
        left, w = total - sum(fixed.values()), sum(weight[s] for s in free)
        above = [s for s in free if weight[s] * left > epochs * sizes[s] * w]
        if not above:
            return {**fixed, **{s: weight[s] * left / w for s in free}}
        fixed |= {s: epochs * sizes[s] for s in above}


def n_words(t):
    return len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))


def check(rows, docs, block=mx.BLOCK):
    sizes, taken = Counter(), Counter()
    for _, t, s in docs:
        sizes[s] += n_words(t)
    want = brute_targets(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source], rel=1e-12, abs=1e-9)
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 4 * block and taken[s] <= 3 * sizes[s]


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rows = QUERIES["op6_mixing"](spark, sf).collect()
    assert sorted((r.doc_id, r.size) for r in rows) == sorted((d, n_words(t)) for d, t, _ in docs)
    check(rows, docs)
    assert sorted(map(tuple, QUERIES["op6_mixing"](spark, sf).collect())) == sorted(map(tuple, rows))


def test_points_and_slots(spark):
    ks = [0, 1, 2, 5, (1 << 20) - 1, 1 << 20, (1 << 40) - 1, 123456789012]
    got = [r.p for r in spark.createDataFrame([(k,) for k in ks], "k long").select(mx.point(F.col("k")).alias("p")).collect()]
    assert got == [k * mx.GOLDEN % (1 << 40) for k in ks]
    src = spark.createDataFrame([("a", 1, 64000.0), (None, 2, 128000.0), ("z", 3, 0.0), ("b", 4, 64.0)], "source string, rank long, target double")
    slots = mx.slots(src).collect()
    assert sorted(r.slot for r in slots) == list(range(round(192064 / 64)))
    by = defaultdict(list)
    for r in sorted(slots, key=lambda r: r.slot):
        by[r.source].append(r.block)
    assert all(v == list(range(len(v))) for v in by.values())
    assert abs(len(by["a"]) - 1000) <= 3 and abs(len(by[None]) - 2000) <= 3 and "z" not in by
    # low discrepancy: every prefix is near the weights
    seen = 0
    for i, r in enumerate(sorted(slots, key=lambda r: r.slot), 1):
        seen += r.source == "a"
        assert abs(seen - i / 3) <= 5


def test_schedule_tiles_the_streams(spark):
    rows = spark.createDataFrame([(i, f"k{i}", "ab"[i % 2], 37 + 11 * i) for i in range(20)], "id long, key string, source string, size long")
    sources = mx.sources_of(rows)
    got = mx.schedule(sources, mx.streams(rows), 16).collect()
    by = defaultdict(set)
    for r in got:
        for w in range(r.first, r.first + r.n_words):
            assert w < r.size
            key = (r.id, r.epoch, w)
            assert key not in by[r.source]
            by[r.source].add(key)
    filled = Counter()
    for r in got:
        filled[r.slot] += r.n_words
    assert all(v <= 16 for v in filled.values()) and sum(v < 16 for v in filled.values()) <= 2


def test_edges_of_the_input(spark):
    docs = [(1, None, "a"), (2, "", None), (None, "w " * 500, None), (3, "w " * 500, "a"), (3, "w " * 500, "a"), (4, "v " * 30000, "big"),
            (5, "x", "tiny"), (6, " \n", "blank")]
    df = spark.createDataFrame([(*d, "t", 1) for d in docs], "doc_id long, text string, source string, target string, size int")
    rows = mx.mix(df).collect()
    assert len(rows) == len(docs)
    check(rows, docs)
    out = mx.repeat_to_mix(df)
    assert out.columns == df.columns
    n = Counter((r.doc_id, r.source) for r in out.collect())
    assert n[(1, "a")] == 1 and n[(6, "blank")] == 1 and n[(None, None)] in (2, 3)
    assert mx.mix(df.limit(0)).count() == 0 and mx.repeat_to_mix(df.limit(0)).count() == 0
