"""Toxicity: cumulative-link (proportional odds) ordinal regression on sparse text features.

P(grade >= k | x) = sigmoid(w . x - b_k) with one weight vector for all grades
and ordered thresholds b_1 <= b_2 <= ...; the output is the expected severity,
the sum of these probabilities.  Features are damped word counts and the same of word beginnings (four and five letters, which catch
inflected forms), over a vocabulary taken from the labelled sample.

Labels say toxic or not.  Toxic documents get their grade from how much of the
text is toxic: words that toxic documents use far more often than clean ones
(log-odds with a document-frequency floor) are counted per word, and documents
above the median share are grade 2, the others grade 1.

The model is fitted with NumPy on a bounded sample of labelled texts
(``MAX_LABELLED``, drawn by hash), of any length: words are counted on the
executors, once an id and text, and the driver gets the vocabulary (at most
``max_vocab`` terms) and each text's counts of it.  Thresholds are set by held-out halves (``_fitted``); scoring runs inside Arrow batches on
every document and its whole text, with the model (at most ``max_vocab``
weights) in the closure.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import own_columns, written

#: Upper bound (expected size) of the labelled documents the model is fitted on.
MAX_LABELLED = 8_000
GRADES = 2
#: Largest share of held-out clean texts that may reach an even chance of grade 1.
MAX_FLAGGED = 0.01

_WORD = re.compile(r"[^\W\d_]+")

COUNTS = "struct<terms:array<string>,ns:array<long>>"
KNOWN_COUNTS = "struct<at:array<int>,ns:array<long>,share:double>"
SCORE = "struct<expected_severity:double,p_ge_1:double,p_ge_2:double,grade:int>"


#: Lengths of the word beginnings that are features beside whole words ("^" marks them).
STEMS = (4, 5)


def word_counts(text: str | None) -> Counter:
    """Lower-cased word counts of a whole text."""
    return Counter(_WORD.findall((text or "").lower()))


def counts(text: str | None) -> Counter:
    """Counts of words and word beginnings of a whole text."""
    out = word_counts(text)
    for w, n in list(out.items()):
        for k in STEMS:
            if len(w) > k:
                out["^" + w[:k]] += n
    return out


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


@dataclass
class OrdinalModel:
    weights: dict[str, float] = field(default_factory=dict)
    thresholds: list[float] = field(default_factory=lambda: [20.0, 21.0])

    def severity(self, text: str | None) -> tuple[float, float, float, int]:
        """Expected severity, P(grade >= 1), P(grade >= 2), most likely grade; a text without words is grade 0."""
        c = counts(text)
        if not c:
            return 0.0, 0.0, 0.0, 0
        w = self.weights
        z = sum(w[t] * _value(c[t]) for t in sorted(c.keys() & w.keys()))
        p1, p2 = (float(x) for x in _sigmoid(z - np.array(self.thresholds)))
        grade = int(np.argmax([1 - p1, p1 - p2, p2]))
        return p1 + p2, p1, p2, grade


def _value(n: int) -> float:
    return float(np.log1p(n))


MAX_VOCAB, MIN_DF = 1024, 4


def _odds(df: tuple[int, int], n: tuple[int, int]) -> tuple[float, float]:
    """Log-odds of a term for toxic documents, and its size in units of its error."""
    odds = np.log((df[1] + 0.5) / (n[1] + 1)) - np.log((df[0] + 0.5) / (n[0] + 1))
    return odds, abs(odds) / np.sqrt(1 / (df[1] + 0.5) + 1 / (df[0] + 0.5))


def _vocabulary(df: dict[str, tuple[int, int]], n: tuple[int, int], max_vocab: int) -> tuple[list[str], set[str]]:
    """What toxic documents use more, of the terms ranked by the log-odds in units of its error; and the toxic words."""
    odds = {t: _odds(x, n) for t, x in df.items()}
    vocab = [t for t in sorted(odds, key=lambda t: (-odds[t][1], t))[:max_vocab] if odds[t][0] > 0 and odds[t][1] > 2.5]
    return vocab, {t for t in vocab if odds[t][0] > np.log(8) and odds[t][1] > 3}


def _known(terms, ns, at: dict[str, int], marked: set[str]) -> tuple[list[int], list[int], float]:
    """The counts of the vocabulary as (numbers, counts), and the share of toxic words."""
    own = [(at[t], int(k)) for t, k in zip(terms, ns) if t in at]
    share = sum(k for t, k in zip(terms, ns) if t in marked) / max(1, sum(ns))
    return [i for i, _ in own], [k for _, k in own], share


def fit_texts(texts: list[str], toxic: list[bool], max_vocab: int = MAX_VOCAB, min_df: int = MIN_DF, rounds: int = 500,
              ridge: float = 1e-5) -> OrdinalModel:
    """The model of labelled texts.  No rows, or rows of one class: a model that grades everything 0."""
    y = np.array(toxic, bool)
    if not len(y) or y.all() or not y.any():
        return OrdinalModel()
    df = [Counter(), Counter()]
    for text, t in zip(texts, y):           # counts are made twice rather than held for every text
        df[int(t)].update(counts(text).keys())
    n = (int((~y).sum()), int(y.sum()))
    vocab, marked = _vocabulary({t: (df[0][t], df[1][t]) for t in df[0].keys() | df[1].keys() if df[0][t] + df[1][t] >= min_df}, n, max_vocab)
    at = {t: i for i, t in enumerate(vocab)}
    docs = [_known(c.keys(), c.values(), at, marked) for c in map(counts, texts)]
    return _fitted(vocab, np.repeat(np.arange(len(docs)), [len(d[0]) for d in docs]), np.array([i for d in docs for i in d[0]], int),
                  np.array([k for d in docs for k in d[1]], float), np.array([d[2] for d in docs]), y, rounds, ridge)


def _fitted(vocab: list[str], rows: np.ndarray, cols: np.ndarray, ns: np.ndarray, share: np.ndarray, y: np.ndarray, *how) -> OrdinalModel:
    """The trained model, its thresholds moved together by what its two halves show of each other.

    Toxic texts are few, so the likelihood's own thresholds let many of them
    pass.  Each half of the rows is scored by a model of the other half; the
    thresholds go down as far as at most ``MAX_FLAGGED`` of the clean texts
    reach an even chance of grade 1, but no further than that share of the
    toxic ones needs, and never up.
    """
    model = _train(vocab, rows, cols, ns, share, y, *how)
    half = np.arange(len(y)) // 2 % 2
    z = np.zeros(len(y))
    for f in (0, 1):
        train = half != f
        if y[train].all() or not y[train].any():
            return model
        own, number = train[rows], np.cumsum(train) - 1
        other = _train(vocab, number[rows[own]], cols[own], ns[own], share[train], y[train], *how)
        w = np.array([other.weights.get(t, 0.0) for t in vocab])
        z[~train] = (np.bincount(rows, np.log1p(ns) * w[cols], len(y)) - other.thresholds[0])[~train]
    clean, toxic = np.sort(z[~y]), np.sort(z[y])
    cut = max(clean[len(clean) - 1 - int(MAX_FLAGGED * len(clean))], toxic[int(MAX_FLAGGED * len(toxic))])
    model.thresholds = [b + min(0.0, float(cut) + 1e-6) for b in model.thresholds]
    return model


def _train(vocab: list[str], rows: np.ndarray, cols: np.ndarray, ns: np.ndarray, share: np.ndarray, y: np.ndarray, rounds: int = 500,
           ridge: float = 1e-5) -> OrdinalModel:
    """The model of term counts ``ns`` at (row, term number), shares of toxic words and labels."""
    median = float(np.median(share[y]))
    grade = np.where(y, 1 + (share > median), 0)
    vals = np.log1p(ns)
    w = np.zeros(len(vocab))
    b = np.array([np.log((grade < k).sum() / max(1, (grade >= k).sum())) for k in (1, 2)])
    weight = np.full(len(y), 1 / len(y))
    m = [np.zeros(len(w) + 2), np.zeros(len(w) + 2)]
    for step in range(1, rounds + 1):         # Adam on the exact gradient of the cumulative-link likelihood
        z = np.bincount(rows, vals * w[cols], len(y))
        s = _sigmoid(z[:, None] - b[None, :])                   # P(grade >= 1), P(grade >= 2)
        upper = np.column_stack([np.ones(len(y)), s])        # P(>= 0), P(>= 1), P(>= 2)
        lower = np.column_stack([s, np.zeros(len(y))])
        i = np.arange(len(y))
        p = np.maximum(upper[i, grade] - lower[i, grade], 1e-9)
        slope = np.column_stack([np.zeros(len(y)), s * (1 - s), np.zeros(len(y))])
        up, low = slope[i, grade], slope[i, grade + 1]
        dz = -weight * (up - low) / p
        db = np.zeros(2)
        for k in (0, 1):
            db[k] = (weight * up / p)[grade == k + 1].sum() - (weight * low / p)[grade == k].sum()
        g = np.concatenate([np.bincount(cols, vals * dz[rows], len(w)) + ridge * w, db])
        m[0] = 0.9 * m[0] + 0.1 * g
        m[1] = 0.99 * m[1] + 0.01 * g * g
        move = 0.1 * (m[0] / (1 - 0.9 ** step)) / (np.sqrt(m[1] / (1 - 0.99 ** step)) + 1e-8)
        w, b = w - move[:-2], b - move[-2:]
        b[1] = max(b[1], b[0] + 1e-3)                           # thresholds stay in order
    return OrdinalModel({t: float(x) for t, x in zip(vocab, w) if abs(x) > 1e-6}, [float(x) for x in b])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        max_labelled: int = MAX_LABELLED) -> OrdinalModel:
    """The model of ``labels`` (id, 0 or 1) over the documents they name.

    Null ids, labels and texts are left out; the higher of several labels of an
    id holds.  A text counts once an id, whatever its length.  Beyond
    ``max_labelled`` ids, and then beyond as many texts, a hash share of that
    expected size is used, which bounds the broadcast and what the driver holds.
    """
    lab = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
           .groupBy(F.col(id_col).alias("_id")).agg((F.max(label_col) > 0).alias("toxic")))
    n = lab.count()
    if n > max_labelled:
        lab = lab.where(F.pmod(F.xxhash64("_id"), F.lit(1_000_000)) < int(1_000_000 * max_labelled / n))

    @F.pandas_udf(COUNTS)
    def counted(texts: pd.Series) -> pd.DataFrame:
        cs = [counts(t) for t in texts]
        return pd.DataFrame({"terms": [list(c) for c in cs], "ns": [list(c.values()) for c in cs]})
    named = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).where(F.col("_text").isNotNull())
    rows = (named.join(F.broadcast(lab), "_id").withColumn("_d", F.sha2("_text", 256)).withColumn("c", counted("_text"))
            .groupBy("_id", "_d").agg(F.any_value("toxic").alias("toxic"), F.any_value("c").alias("c")))
    rows = written(rows.select("_id", "_d", "toxic", "c.terms", "c.ns"), "toxicity_counts")
    n = rows.count()
    if n > max_labelled:
        rows = rows.where(F.pmod(F.xxhash64("_id", "_d"), F.lit(1_000_000)) < int(1_000_000 * max_labelled / n))
    class_n = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(class_n) < 2:
        return OrdinalModel()
    n2 = (class_n[False], class_n[True])
    # the same ranking as _vocabulary, which sees the terms that can be in it; ties beyond the last keep the term order
    a, b = F.col("df0") + 0.5, F.col("df1") + 0.5
    z = F.abs(F.log(b / (n2[1] + 1)) - F.log(a / (n2[0] + 1))) / F.sqrt(1 / b + 1 / a)
    terms = (rows.select("toxic", F.explode("terms").alias("t")).groupBy("t")
             .agg(F.count_if(~F.col("toxic")).alias("df0"), F.count_if("toxic").alias("df1"))
             .where(F.col("df0") + F.col("df1") >= MIN_DF).orderBy(z.desc(), "t").limit(MAX_VOCAB))
    vocab, marked = _vocabulary({r["t"]: (r["df0"], r["df1"]) for r in terms.collect()}, n2, MAX_VOCAB)
    at = {t: i for i, t in enumerate(vocab)}

    @F.pandas_udf(KNOWN_COUNTS)
    def known(terms: pd.Series, ns: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_known(t, k, at, marked) for t, k in zip(terms, ns)], columns=["at", "ns", "share"])
    got = rows.select("_id", "_d", "toxic", known("terms", "ns").alias("k")).select(
        "_id", "_d", "toxic", "k.at", "k.ns", "k.share").orderBy("_id", "_d").drop("_id", "_d").toArrow().combine_chunks()
    flat = lambda c: np.array(got[c].combine_chunks().flatten())
    lengths = np.array([len(x) for x in got["at"]])
    return _fitted(vocab, np.repeat(np.arange(len(lengths)), lengths), flat("at").astype(int), flat("ns").astype(float),
                  np.array(got["share"]), np.array(got["toxic"]).astype(bool))


def score(model: OrdinalModel, text: Column) -> Column:
    """Struct of expected_severity, p_ge_1, p_ge_2 and grade (the most likely); null text: grade 0."""
    @F.pandas_udf(SCORE)
    def of(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([model.severity(t) for t in texts], columns=["expected_severity", "p_ge_1", "p_ge_2", "grade"])
    return of(text)


@own_columns("text_col")
def judge(docs: DataFrame, model: OrdinalModel, text_col: str = "text", name: str = "severity") -> DataFrame:
    """``docs`` plus the struct ``name``; a column of that name is replaced, rows and their number stay.

    Texts of any length are scored whole; null, empty and wordless ones are
    grade 0.  Of equally likely grades the lower is given.  Equal texts are judged alike."""
    return docs.withColumn(name, score(model, F.col(text_col)))
