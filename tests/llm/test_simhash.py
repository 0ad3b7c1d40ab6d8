"""Fingerprints, links and components against brute force."""
import random
import re

import xxhash
from pyspark.sql import functions as F

from salesmart.llm import simhash as sh
from salesmart.llm.queries import QUERIES

LOWER = {c: c + 32 for c in range(65, 91)}


def brute_fp(text, k=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not w:
        return 0
    grams = [" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_classes(pairs, bits=2):
    """{row number: smallest id reachable} of (id, unsigned fingerprint) rows."""
    fps = sorted({f for _, f in pairs})
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= bits:
                root[find(a)] = find(b)
    ids = {}
    for d, f in pairs:
        if d is not None:
            ids[find(f)] = min(d, ids.get(find(f), d))
    return [ids.get(find(f)) for _, f in pairs]


def test_fingerprints():
    for t in (None, "", " \n", "A", "a b", "A b C d", "É b c d e", "x " * 5000, " ".join(map(str, range(70000)))):
        assert sh.fingerprint(t) & (1 << 64) - 1 == brute_fp(t)


def test_query_matches_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    fps = [(d.doc_id, brute_fp(d.text)) for d in docs]
    want = {(d, f"{f:016x}", c) for (d, f), c in zip(fps, brute_classes(fps))}
    got = QUERIES["op10_simhash"](spark, sf).collect()
    assert len(got) == len(docs) and {tuple(r) for r in got} == want


def _near_random(n_random, n_near, seed):
    rnd = random.Random(seed)
    fps = {rnd.getrandbits(64) for _ in range(n_random)}
    for f in list(fps)[: n_random // 2]:
        fps.add(f ^ 1 << rnd.randrange(64) ^ 1 << rnd.randrange(64))
        fps.add(f ^ 1 << rnd.randrange(64) ^ 1 << rnd.randrange(64) ^ 1 << rnd.randrange(64))
    centre = rnd.getrandbits(64)
    while len(fps) < n_random * 2 + n_near:
        f = centre
        for _ in range(rnd.randrange(5)):
            f ^= 1 << rnd.randrange(64)
        fps.add(f)
    return sorted(fps)


def test_components_with_sparse_and_dense_anchors(spark):
    fps = _near_random(300, 500, 3)
    pairs = list(enumerate(fps))
    df = spark.createDataFrame([(sh._signed(f),) for f in fps], "fp long")
    for dense in (4, 10**6):
        roots = {r.node: r.root for r in sh.components(sh.links(df, 2, dense)).collect()}
        group = {}
        for i, c in enumerate(brute_classes(pairs)):
            f = sh._signed(fps[i])
            assert group.setdefault(roots.get(f, f), c) == c
        assert len(set(group.values())) == len(group)


def test_anchors_cover_the_threshold(spark):
    rnd = random.Random(5)
    rows = []
    for _ in range(300):
        f = rnd.getrandbits(64)
        g = f ^ 1 << rnd.randrange(64) ^ 1 << rnd.randrange(64)
        rows.append((sh._signed(f), sh._signed(g)))
    df = spark.createDataFrame(rows, "f long, g long")
    assert df.where(~F.array_contains(sh.anchors(F.col("g"), 2), sh.home_anchor(F.col("f")))).count() == 0


def test_long_chain_and_hub(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5, 5)]
    got = {r.node: r.root for r in sh.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 201)}, **{1000 + i: 1000 for i in range(1, 300)}}
    assert sh.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_edges_of_the_input(spark):
    long_text = " ".join(f"w{i % 977}" for i in range(30000))
    rows = [(3, "", "x", 1), (2, None, "x", 1), (None, " \t", "y", 2), (7, long_text, "z", 3), (7, long_text, "z", 3),
            (9, long_text + " end", "z", 3), (None, "only one here", "n", 4), (7, "another text under the same id", "q", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string, component_id int")
    got = sh.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    fps = [(r[0], brute_fp(r[1])) for r in rows]
    want = sorted(((d, f, c) for (d, f), c in zip(fps, brute_classes(fps))), key=repr)
    assert sorted(((r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in got), key=repr) == want
    kept = sh.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, r.component_id) for r in kept.collect()) == [(0, 4), (2, 1), (7, 3), (7, 5)]
    assert sh.near_duplicates(docs.limit(0)).count() == 0 and sh.keep_one(docs.limit(0)).count() == 0
