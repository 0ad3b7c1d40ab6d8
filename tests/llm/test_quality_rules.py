"""Text statistics against plain Python, learning on separable rows, and the edge cases."""
import re

from pyspark.sql import functions as F

from salesmart.llm import quality_rules as q
from salesmart.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def brute(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen, hit = {}, set()
    for i in range(len(w) - 2):
        seen.setdefault(tuple(w[i:i + 3]), []).append(i)
    for at in seen.values():
        if len(at) > 1:
            hit |= {i + k for i in at for k in range(3)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(hit))


def test_statistics_match_brute_force(spark):
    texts = [None, "", " \t\n", "a", "a a a a", "a b c a b c a b", "x\ny\nx\n \n\nx", "é#|ü\x0b<b>\x0cc\u00a0d",
             " ".join(str(i % 40) for i in range(3000)), " ".join(f"w{i}" for i in range(200)) + " w0 w1 w2"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r.doc_id: tuple(r._st[k] for k in q.STATS[:5]) for r in q.with_stats(df).collect()}
    assert got == {i: brute(t) for i, t in enumerate(texts)}


def test_query_base_columns(spark):
    rows = {r.doc_id: r for r in QUERIES["op1_quality_rules"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(rows) == len(docs)
    for d in docs:
        r, b = rows[d.doc_id], brute(d.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == b
        assert r.base_failed == (b[0] < 50 or 100 * b[4] > 50 * b[0])
        assert not (r.base_failed and r.kept)


def test_labels_are_followed_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    rules = q.fit(docs, labels.where(F.col("doc_id") % 2 == 0))
    assert rules.rules
    held = q.judge(docs, rules).join(labels.where(F.col("doc_id") % 2 == 1), "doc_id").where("not base_failed")
    n, right, lost = held.agg(F.count("*"), F.count_if(F.col("kept") == (F.col("quality") == 1)),
                              F.count_if(~F.col("kept") & (F.col("quality") == 1))).first()
    assert right >= 0.95 * n and lost <= 0.02 * n


def test_learn_finds_a_conjunction(spark):
    rows = [(float(a), float(b), a > 5 and b <= 3, i % 3) for i, (a, b) in enumerate((a, b) for a in range(10) for b in range(10) for _ in range(6))]
    df = spark.createDataFrame(rows, "a double, b double, reject boolean, fold int")
    rules = q.learn(df, ["a", "b"], min_precision=0.99)
    feats = {"a": F.col("a"), "b": F.col("b")}
    assert df.where(rules.fired(feats).isNotNull() != F.col("reject")).count() == 0


def test_no_labels_no_rules_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a " * 60, "x", 7), (None, None, "y", 8), (1, "a " * 60, "x", 7)],
                                 "doc_id long, text string, kept string, rule int")
    none = spark.createDataFrame([], "doc_id long, quality int")
    nulls = spark.createDataFrame([(None, 1), (1, None)], "doc_id long, quality int")
    for labels in (none, nulls):
        rules = q.fit(docs, labels)
        assert rules.rules == []
        assert sorted((r.base_failed, r.kept) for r in q.judge(docs, rules).collect()) == [(True, False)] * 3
    words60 = " ".join(f"w{i}" for i in range(60))
    two = spark.createDataFrame([(1, words60, "x", 7)] * 2, "doc_id long, text string, kept string, rule int")
    assert q.keep_good(two, q.DecisionList()).columns == two.columns
    assert q.keep_good(two, q.DecisionList()).count() == 2
    assert q.keep_good(two.limit(0), q.DecisionList()).count() == 0
