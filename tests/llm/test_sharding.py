"""Capacity against dynamic programming, borders against the driver-only search, and the query's law."""
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from salesmart.llm import sharding as sd
from salesmart.llm.queries import QUERIES


def best_capacity(totals, n):
    best = {0: 0}
    for _ in range(n):
        now = {}
        for start, cap in best.items():
            s = 0
            for end in range(start, len(totals) + 1):
                c = max(cap, s)
                now[end] = min(now.get(end, c), c)
                if end < len(totals):
                    s += totals[end]
        best = now
    return best[len(totals)]


@pytest.mark.parametrize("seed", range(30))
def test_minimax_is_optimal_and_balanced(seed):
    rnd = random.Random(seed)
    totals = [rnd.randrange(1, 60) for _ in range(rnd.randrange(1, 40))]
    if seed % 3 == 0:
        totals[rnd.randrange(len(totals))] = 900
    n = rnd.randrange(1, 8)
    cap, cuts = sd.minimax(totals, n)
    assert cap == best_capacity(totals, n)
    edges = [0, *cuts, len(totals)]
    parts = [sum(totals[a:b]) for a, b in zip(edges, edges[1:])]
    assert len(parts) <= n and edges == sorted(set(edges)) and max(parts) == cap


def test_borders_on_many_groups_equal_the_exact_search(spark):
    rnd = random.Random(1)
    rows = [(f"{rnd.getrandbits(128):032x}", rnd.randrange(9, 3000)) for _ in range(3000)]
    rows += [(f"0123{rnd.getrandbits(112):028x}", rnd.randrange(9, 3000)) for _ in range(1500)]      # one crowded prefix
    rows += [("", 500), (f"{rnd.getrandbits(128):032x}", 10**6)]
    rows.sort()
    for n in (3, 24):
        cap, keys = sd.borders(spark.createDataFrame(rows, "key string, bytes long"), n)
        assert cap == sd.minimax([b for _, b in rows], n)[0]
        sums = Counter()
        for k, b in rows:
            sums[sum(x <= k for x in keys)] += b
        assert max(sums.values()) == cap and len(sums) == n


def test_query_law(spark):
    sf = "/root/testdata/sf0.01"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = QUERIES["op2_sharding"](spark, sf).collect()
    assert {r.doc_id for r in rows} == set(docs) and len(rows) == len(docs)
    slots, shard_of, total = defaultdict(list), {}, Counter()
    for r in rows:
        t = docs[r.doc_id]
        assert r.size == len((t or "").encode()) + 8 and r.text_crc32 == zlib.crc32((t or "").encode())
        assert shard_of.setdefault(t, r.shard) == r.shard and r.law == "bytes" and r.grown_shard is None
        slots[r.shard].append(r.slot)
        total[r.shard] += r.size
    assert set(slots) == set(range(24)) and all(sorted(v) == list(range(len(v))) for v in slots.values())
    groups = Counter()
    for t in docs.values():
        groups[t] += len((t or "").encode()) + 8
    assert max(total.values()) <= sum(groups.values()) / 24 + max(groups.values())


def test_edges_of_the_input(spark):
    rows = [(1, None, 5), (None, None, 5), (2, "", 5), (3, "x" * 200000, 5), (4, "same", 5), (4, "same", 5), (5, "same", 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard int")
    got = sd.assign(docs, 4).collect()
    assert len(got) == len(rows)
    by = defaultdict(set)
    for r in got:
        by[(r.size, r.text_crc32)].add(r.shard)
    assert all(len(v) == 1 for k, v in by.items() if k[0] > 8) and len(by) == 3
    assert len({(r.shard, r.slot) for r in got}) == len(rows)
    assert sd.assign(docs.limit(0), 4).count() == 0
    out = sd.with_shard(docs, 4)
    assert out.columns == docs.columns and out.count() == len(rows)
    assert out.groupBy(F.coalesce("text", F.lit("\0"))).agg(F.countDistinct("shard").alias("n")).where("n > 1").count() == 0
