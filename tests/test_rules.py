"""Rules golden case (FIXTURES C6) and recommendation."""
from pyspark.sql import functions as F

from salesmart.operators import rules


def _lines(spark):
    baskets = [("t1", ["a", "b", "c"]), ("t2", ["a", "b", "c"]), ("t3", ["a", "b"]), ("t4", ["c"])]
    rows = [("s", t, i) for t, items in baskets for i in items]
    return spark.createDataFrame(rows, "Fuente string, transaction_id string, item string")


def test_itemsets_and_multi_item_consequents(spark):
    mb = rules.mining_baskets(_lines(spark), min_item_frequency=1)
    assert mb.count() == 3                      # {c} dropped by the >= 2 lines rule
    fi = {",".join(r["items"]): r["count"] for r in rules.frequent_itemsets(mb, 0.25).collect()}
    assert fi == {"a": 3, "b": 3, "c": 2, "a,b": 3, "a,c": 2, "b,c": 2, "a,b,c": 2}
    r = rules.association_rules(rules.frequent_itemsets(mb, 0.25), 0.0, 0.0)
    got = {(x.Antecedent, x.Consequent): (round(x.support, 6), round(x.confidence, 6), round(x.lift, 6))
           for x in r.collect()}
    assert got[("c", "a, b")] == (round(2 / 3, 6), 1.0, 1.0)
    assert len(got) == 12                       # 3 pairs x 2 + 1 triple x 6


def test_recommend_exact_antecedent(spark):
    mb = rules.mining_baskets(_lines(spark), min_item_frequency=1)
    r = rules.association_rules(rules.frequent_itemsets(mb, 0.25), 0.0, 0.0)
    b = spark.createDataFrame([("q1", ["a"]), ("q2", ["a", "b"])], "basket_id string, items array<string>")
    rec = rules.recommend(b, r, 5).collect()
    assert {x.Antecedent for x in rec if x.basket_id == "q1"} == {"a"}
    q1 = sorted([(x["rank"], x.Consequent) for x in rec if x.basket_id == "q1"])
    assert [c for _, c in q1] == ["b", "b, c", "c"]   # conf 1, 2/3 (lift 1) then 2/3: text tie-break
    assert all(x.Antecedent == "a, b" for x in rec if x.basket_id == "q2")
