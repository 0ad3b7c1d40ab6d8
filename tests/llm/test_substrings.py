"""Removed bytes against a brute-force scan of every string."""
import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from salesmart.llm import substrings as ss
from salesmart.llm.queries import QUERIES


def brute(texts, length):
    """[(n_bytes, n_removed, n_spans, sha256 of the rest)]."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        hit = np.zeros(len(d), bool)
        for i in range(len(d) - length + 1):
            if seen[d[i:i + length]] > 1:
                hit[i:i + length] = True
        runs = int((hit[1:] & ~hit[:-1]).sum() + (hit[:1].sum() if len(hit) else 0))
        out.append((len(d), int(hit.sum()), runs, hashlib.sha256(bytes(np.frombuffer(d, np.uint8)[~hit])).hexdigest()))
    return out


def made_up(seed, length):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdefé") for _ in range(rnd.randrange(1, 7)))
    passages = [" ".join(word() for _ in range(n)) for n in (length // 6, length // 4, length // 2, length)]
    texts = [None, "", "short", passages[3], passages[3], "x" * (3 * length), "ab" * length + "q" + "ab" * length]
    base = " ".join(word() for _ in range(length))
    for _ in range(40):
        parts = [" ".join(word() for _ in range(rnd.randrange(1, 60)))]
        for _ in range(rnd.randrange(0, 4)):
            p = rnd.choice(passages)
            cut = rnd.randrange(len(p))
            parts += [rnd.choice([p, p[cut:], p[:cut]]), word()]
        texts.append(rnd.choice(["", " "]).join(parts))
        w = base.split(" ")
        for _ in range(rnd.randrange(0, 5)):
            w[rnd.randrange(len(w))] = word()
        texts.append(" ".join(w))
    texts += [texts[10], texts[10], texts[12]]
    return texts


@pytest.mark.parametrize("length,gram,group,engine", [(60, 30, 10**6, "windows"), (60, 30, 3, "windows"), (100, 40, 10**6, "windows"),
                                                      (100, 40, 3, "windows"), (90, 20, 1, "windows"), (60, 30, 10**6, "induced")])
def test_brute_force(spark, length, gram, group, engine):
    texts = made_up(length + group % 7, length)
    df = spark.createDataFrame([(i, t, "k", 1) for i, t in enumerate(texts)], "doc_id long, text string, key string, spans int")
    got = {r.doc_id: tuple(r)[1:] for r in ss.remove_repeats(df, length=length, gram=gram, group=group, engine=engine).collect()}
    want = brute(texts, length)
    assert [got[i] for i in range(len(texts))] == want


def test_text_that_is_left(spark):
    texts = made_up(11, 60)
    df = spark.createDataFrame([(i, t, "k", 1) for i, t in enumerate(texts)], "doc_id long, text string, key string, spans int")
    rows = ss.remove_repeats(df, length=60, gram=30, with_text=True).collect()
    want = brute(texts, 60)
    assert [tuple(r)[1:5] for r in sorted(rows, key=lambda r: r.doc_id)] == want
    whole = 0
    for r in rows:
        if "\ufffd" not in r.text:
            whole += 1
            assert hashlib.sha256(r.text.encode()).hexdigest() == r.kept_sha256
        assert len(r.text.replace("\ufffd", "").encode()) <= r.n_bytes - r.n_removed
    assert whole > len(texts) // 2


def test_blocks_give_the_same_anchors(monkeypatch):
    data = "".join(random.Random(1).choice("abcd ") for _ in range(5000)).encode()
    whole = ss.Anchors(60, 30).of(data)
    monkeypatch.setattr(ss, "_BLOCK", 700)
    assert all((a == b).all() for a, b in zip(whole, ss.Anchors(60, 30).of(data)))
    p, _ = whole
    assert p[0] <= 30 and (np.diff(p) <= 31).all() and len(data) - 30 - p[-1] <= 31


def test_query_matches_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    got = {r.doc_id: tuple(r)[1:5] for r in QUERIES["op5_substrings"](spark, sf).collect()}
    assert [got[d.doc_id] for d in docs] == brute([d.text for d in docs], 400)


def test_edges(spark):
    long = "word " * 200
    df = spark.createDataFrame([(1, long + "a"), (None, "q" + long), (1, None), (1, None)], "doc_id long, text string")
    rows = sorted(tuple(r)[1:3] for r in ss.remove_repeats(df).collect())
    assert rows == [(0, 0), (0, 0), (1001, 1000), (1001, 1000)]
    assert ss.remove_repeats(df.limit(0)).count() == 0
    assert ss.remove_repeats(df.where("text is null")).count() == 2


def test_rows_of_a_hot_key_stay_in_place(spark):
    rows = spark.range(0, 8000, 1, 8).selectExpr("IF(id % 8 < 6, 7, 1000 + id DIV 16) AS gram", "IF(id % 8 < 6, 3, id % 2) AS lo", "id AS ctx")
    keys = rows.where("gram = 7 OR gram % 3 = 0").groupBy("gram", "lo").agg(F.count(F.lit(1)).alias("n"))
    got = ss._rows_of(rows, keys, ["gram", "lo"])
    want = rows.join(keys, ["gram", "lo"], "left_semi")
    ids = [r.ctx for r in got.collect()]
    assert sorted(ids) == sorted(r.ctx for r in want.collect()) and len(ids) == len(set(ids)) > 6000
    held = got.where("gram = 7").groupBy(F.spark_partition_id()).count().collect()
    assert len(held) == 8 and max(r["count"] for r in held) == 750


def test_one_core_with_many_windows(spark, monkeypatch):
    """Copies of one passage between changing ends: the joins over ranges of offsets leave large keys in place."""
    joins = []

    def seen(rows, keys, on):
        out = rows_of(rows, keys, on)
        n, bound = {tuple(r)[:-1]: r["n"] for r in keys.select(*on, "n").collect()}, rows.count() // ss.HOT
        joins.append((tuple(on), max(n.values(), default=0) > bound, rows.join(keys, on, "left_semi").count() == out.count()))
        return out
    rows_of = ss._rows_of
    monkeypatch.setattr(ss, "_rows_of", seen)
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("abcdef") for _ in range(rnd.randrange(2, 7)))
    passage = " ".join(word() for _ in range(20))
    texts = [" ".join([*(word() for _ in range(12)), passage, *(word() for _ in range(12))]) for _ in range(150)]
    texts += [t[:40] + "#" + t[41:] for t in texts[:40]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: tuple(r)[1:] for r in ss.remove_repeats(df, length=60, gram=30, group=20).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts, 60)
    assert joins and {j[0] for j in joins} == {("gram", "lo", "window"), ("gram", "lo", "core")}
    assert all(j[1] and j[2] for j in joins)
