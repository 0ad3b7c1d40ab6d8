"""op12: graph search against brute force."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from salesmart.llm import queries
from salesmart.llm.graph_search import Graph, nearest

SCHEMA = "vec_id long, embedding array<float>, v string, id string, shard int, score string"


def exact(rows, k=20):
    """{query: [(id, score)]} over rows (id, vector)."""
    ok = [(i, v) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    ids, out = np.array([i for i, _ in ok]), {}
    by_dim = {}
    for i, v in ok:
        by_dim.setdefault(len(v), []).append((i, np.array(v, np.float32).astype(float)))
    for group in by_dim.values():
        x = np.stack([v for _, v in group])
        g_ids = np.array([i for i, _ in group])
        for i, v in group:
            if i % 20 == 0:
                score = x @ v
                order = [j for j in np.lexsort((g_ids, -np.round(score, 12))) if g_ids[j] != i][:k]
                out[i] = [(int(g_ids[j]), float(score[j])) for j in order]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        got = out.setdefault(r["query_id"], [])
        assert r["rank"] == len(got) + 1
        got.append((r["vec_id"], r["score"]))
    return out


def recall(got, want):
    hits = sum(len({i for i, _ in got.get(q, [])} & {i for i, _ in w}) for q, w in want.items())
    return hits / sum(map(len, want.values()))


def test_graph_reaches_every_node_and_keeps_its_degree():
    x = np.random.default_rng(3).normal(size=(700, 12))
    x[:300] *= 0.01
    g = Graph(x, degree=8, beam=24).build()
    assert g.edges.shape == (700, 9) and (g.edges < 700).all()
    seen, wave = {g.entry}, [g.entry]
    while wave:
        wave = [int(j) for i in wave for j in g.edges[i] if j >= 0 and int(j) not in seen]
        seen.update(wave)
    assert len(seen) == 700
    hung = Graph(np.random.default_rng(4).normal(size=(60, 3)), degree=2, beam=4)
    hung._reach_all()                                                  # no edges at all: every node hangs by the kept slot
    assert len(hung.search(hung.points[:1], 60)[0][0]) == 60 and (hung.search(hung.points[:1], 60)[0] >= 0).all()


def test_recall_over_norms(spark):
    rng = np.random.default_rng(5)
    x = (rng.normal(size=(3000, 24)) * rng.lognormal(0, 0.7, size=(3000, 1))).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got, want = found(nearest(df, F.col("vec_id") % 20 == 0)), exact(rows)
    assert set(got) == set(want) and all(len(g) == 20 for g in got.values())
    assert recall(got, want) >= 0.9
    for q, g in got.items():
        assert np.allclose([s for _, s in g], [x[i].astype(float) @ x[q].astype(float) for i, _ in g], rtol=1e-12)


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [0.0, 1.0]), (40, None), (60, []), (80, [0.0, 0.0]), (100, [nan, 1.0]), (120, [inf, 1.0]), (140, [None, 1.0]),
            (None, [1.0, 1.0]), (1, [1.0, 0.0]), (2, [2.0, 0.5]), (3, [-1.0, -1.0]), (160, [1.0, 2.0, 3.0]), (0, [1.0, 0.0])]
    rows += [(1000 + i, [0.5, 0.5]) for i in range(200)]
    df = spark.createDataFrame([r + ("x", "y", 7, "z") for r in rows], SCHEMA)
    got = found(nearest(df, F.col("vec_id") % 20 == 0, spread=2))
    want = exact(list(dict.fromkeys((i, None if v is None else tuple(v)) for i, v in rows)))
    want = {q: w for q, w in want.items() if w}
    assert got == want
    assert [i for i, _ in got[0]][:2] == [2, 1] and got[0][2] == (1000, 0.5)
    assert found(nearest(df.where("vec_id < 0"), F.lit(True))) == {}
    assert found(nearest(df, F.lit(False))) == {}


def test_blocks_of_queries_change_nothing(spark):
    rng = np.random.default_rng(9)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.normal(size=(400, 6)))], "vec_id long, embedding array<double>")
    one = found(nearest(df, F.col("vec_id") % 2 == 0, k=5, shard_rows=90, spread=1))
    assert one == found(nearest(df, F.col("vec_id") % 2 == 0, k=5, shard_rows=90, spread=1, query_rows=17))


def test_query_recall(spark):
    sf = "/root/testdata/sf0.1"
    t = pd.read_parquet(f"{sf}/embeddings.parquet")
    want = exact(list(zip(t["vec_id"].tolist(), [v.tolist() for v in t["embedding"]])))
    got = found(queries.QUERIES["op12_graph_search"](spark, sf))
    assert set(got) == set(want)
    assert recall(got, want) >= 0.95
