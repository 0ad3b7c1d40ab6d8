"""The ordinal model on constructed and held-out rows."""
import math
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from salesmart.llm import toxicity as tx
from salesmart.llm.queries import QUERIES


def test_grades_follow_the_share_of_toxic_words():
    rnd = np.random.default_rng(0)
    clean = [f"w{i}" for i in range(300)]
    clean = ["".join(chr(97 + int(x)) for x in rnd.integers(0, 26, 7)) for _ in clean]
    bad = ["badword", "worseword", "awfulword"]
    texts, toxic = [], []
    for i in range(600):
        words = list(rnd.choice(clean, 60))
        n = (0, 0, 3, 15)[i % 4]
        texts.append(" ".join(words + list(rnd.choice(bad, n))))
        toxic.append(n > 0)
    m = tx.fit_texts(texts[:400], toxic[:400])
    assert m.thresholds[0] < m.thresholds[1]
    got = [m.severity(t) for t in texts[400:]]
    for i, (e, p1, p2, g) in enumerate(got):
        assert abs(e - p1 - p2) < 1e-12 and p1 >= p2
    mean = [np.mean([e for i, (e, *_) in enumerate(got) if (i % 4) in k]) for k in ((0, 1), (2,), (3,))]
    assert mean[0] < 0.1 < mean[1] < mean[2]


def test_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    model = tx.fit(docs, labels.where(F.col("doc_id") % 2 == 0))
    held = tx.judge(docs, model).join(labels.where(F.col("doc_id") % 2 == 1), "doc_id")
    hit, n, wrong, clean = held.agg(*[F.count_if(c) for c in (
        (F.col("severity.p_ge_1") >= 0.5) & (F.col("toxic") == 1), F.col("toxic") == 1,
        (F.col("severity.p_ge_1") >= 0.5) & (F.col("toxic") == 0), F.col("toxic") == 0)]).first()
    assert hit >= 0.88 * n and wrong <= 0.01 * clean


def _labelled_rows(pad):
    rnd = np.random.default_rng(1)
    clean = ["".join(chr(97 + int(x)) for x in rnd.integers(0, 26, 7)) for _ in range(300)]
    bad = ["badword", "worseword", "awfulword"]
    rows = []
    for i in range(200):
        words = list(rnd.choice(clean, 60)) + ["of", "the", "in", "and"] * (1 + (pad if i % 2 else 0)) + (list(rnd.choice(bad, 6 if i % 4 == 1 else 40)) if i % 2 else [])
        rows.append((i, " ".join(words)))
    return rows, [(i, i % 2) for i in range(200)]


def _labelled(spark, pad):
    """200 documents, every other toxic; ``pad`` times four words that all have, in the toxic ones."""
    rows, labels = _labelled_rows(pad)
    return rows, spark.createDataFrame(labels, "doc_id long, toxic int")


def test_long_toxic_texts_are_fitted(spark):
    # all toxic texts are longer than 60,000 bytes
    rows, labels = _labelled(spark, 4500)
    assert min(len(t) for i, t in rows if i % 2) > 60_000
    model = tx.fit(spark.createDataFrame(rows, "doc_id long, text string"), labels)
    assert model.weights.get("badword", 0) > 0 and model.severity(rows[1][1])[1] > 0.5 > model.severity(rows[0][1])[1]


def test_fit_equals_fit_texts_and_repeats_count_once(spark):
    rows, labels = _labelled(spark, 0)
    repeated = rows + rows[:1] * 500 + [(1, None)]
    got = tx.fit(spark.createDataFrame(repeated, "doc_id long, text string"), labels)
    want = tx.fit_texts([t for _, t in rows], [bool(i % 2) for i, _ in rows])
    assert got.weights.keys() == want.weights.keys()
    assert all(abs(got.weights[t] - w) < 1e-6 for t, w in want.weights.items()) and np.allclose(got.thresholds, want.thresholds, atol=1e-6)


def test_one_id_with_many_texts_is_bounded(spark, monkeypatch):
    rows, labels = _labelled(spark, 0)
    many = rows + [(0, f"text number{i} of one id") for i in range(3000)]
    seen = []
    train = tx._train
    monkeypatch.setattr(tx, "_train", lambda *a, **k: seen.append(len(a[5])) or train(*a, **k))
    tx.fit(spark.createDataFrame(many, "doc_id long, text string"), labels, max_labelled=1000)
    assert 850 < seen[0] < 1150


def test_edges(spark):
    assert tx.fit_texts([], []).severity("any words") [3] == 0
    assert tx.fit_texts(["a", "b"], [True, True]).severity("a")[0] < 1e-6
    docs = spark.createDataFrame([(1, None, "s"), (None, "", "s"), (1, "word " * 50000, "s")], "doc_id long, text string, severity string")
    labels = spark.createDataFrame([(1, 1), (1, None), (None, 0)], "doc_id long, toxic int")
    model = tx.fit(docs, labels)
    out = tx.judge(docs, model)
    assert out.columns == docs.columns and [r.severity.grade for r in out.collect()] == [0, 0, 0]
    assert tx.judge(docs.limit(0), model).count() == 0


def own_counts(text):
    """Counts of a text's lower-cased words and of their first four and five letters, marked with ^."""
    out = Counter()
    for w in re.findall(r"[^\W\d_]+", (text or "").lower()):
        out[w] += 1
        for k in (4, 5):
            if len(w) > k:
                out["^" + w[:k]] += 1
    return out


def test_query_matches_plain_python(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    model = tx.fit(docs, labels)
    b1, b2 = model.thresholds
    assert model.weights and b1 < b2
    want = {}
    for r in docs.collect():
        z = sum(math.log1p(n) * model.weights.get(t, 0.0) for t, n in own_counts(r.text).items())
        p1, p2 = (1 / (1 + math.exp(min(700, b - z))) for b in (b1, b2))
        chances = [1 - p1, p1 - p2, p2]
        want[r.doc_id] = (p1 + p2, p1, p2, chances.index(max(chances)))
    rows = QUERIES["op4_toxicity"](spark, sf).collect()
    assert len(rows) == len(want)
    for r in rows:
        e, p1, p2, grade = want[r.doc_id]
        assert abs(r.expected_severity - e) < 1e-6 and abs(r.p_ge_1 - p1) < 1e-6 and abs(r.p_ge_2 - p2) < 1e-6
        assert r.grade == grade


def test_training_ends_near_the_least_loss():
    rows, _ = _labelled_rows(0)
    texts, y = [t for _, t in rows], np.array([i % 2 == 1 for i, _ in rows])
    vocab = sorted({t for x in texts for t in own_counts(x)})
    x = np.array([[math.log1p(own_counts(t)[v]) for v in vocab] for t in texts])
    share = np.array([sum(n for w, n in own_counts(t).items() if w in ("badword", "worseword", "awfulword")) / len(t.split()) for t in texts])
    grade = np.where(y, 1 + (share > np.median(share[y])), 0)
    ridge = 0.01

    def loss(w, b):
        s = 1 / (1 + np.exp(b[None, :] - (x @ w)[:, None]))
        p = np.column_stack([1 - s[:, 0], s[:, 0] - s[:, 1], s[:, 1]])
        return -np.log(np.maximum(p[np.arange(len(p)), grade], 1e-300)).mean() + ridge / 2 * (w @ w)

    at = np.nonzero(x)
    model = tx._train(vocab, at[0], at[1], np.expm1(x[at]), share, y, 500, ridge)
    w, b = np.array([model.weights.get(v, 0.0) for v in vocab]), np.array(model.thresholds)
    least, rnd = loss(w, b), np.random.default_rng(2)
    assert least < 0.5 * loss(np.zeros(len(w)), np.array([0.0, math.log(3)]))
    for size in (0.03, 0.1, 0.3):
        for _ in range(20):
            step = rnd.normal(size=len(w) + 2)
            step *= size / np.linalg.norm(step)
            assert loss(w + step[:-2], b + step[-2:]) > least - 1e-4


def test_query(spark):
    rows = QUERIES["op4_toxicity"](spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()
    assert all(r.toxic == (r.p_ge_1 >= 0.5) for r in rows)
