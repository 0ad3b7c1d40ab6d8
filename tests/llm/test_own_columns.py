"""Columns of the caller keep their values, whatever they are called."""

import pytest
from pyspark.sql import functions as F

from salesmart.llm import decontaminate, licenses, mixing, quality_rules, sharding, simhash, surrogates, toxicity

HELPERS = ["_st", "_st_x", "_md5", "_hits", "_k", "_new", "_d", "_late", "_id", "_key", "_n", "_one", "key", "spans", "a.b", "a b", "c0_", "`q`", "s", "i"]
WORDS = "plain words that make a text of some length without any repeats or odd signs in it at all "


def frame(spark, n=6):
    rows = []
    for i in range(n):
        text = None if i == 4 else " ".join(f"w{i}x{j} {WORDS.split()[j % 17]}" for j in range(60))
        rows.append((i, text, f"src{i % 2}", *[f"{h}-{i}" for h in HELPERS]))
    return spark.createDataFrame(rows, ["doc_id", "text", "source", *[f"h{k}" for k in range(len(HELPERS))]]).toDF("doc_id", "text", "source", *HELPERS)


RULES = quality_rules.DecisionList([])
CASES = {
    "judge": lambda d: quality_rules.judge(d, RULES, name="stats"),
    "keep_good": lambda d: quality_rules.keep_good(d, RULES),
    "keep_one": lambda d: simhash.keep_one(d),
    "mark": lambda d: decontaminate.mark(d, d.sparkSession.createDataFrame([(1, "nothing of this kind")], "item_id long, text string")),
    "clean": lambda d: decontaminate.clean(d, d.sparkSession.createDataFrame([(1, "nothing of this kind")], "item_id long, text string")),
    "repeat_to_mix": lambda d: mixing.repeat_to_mix(d),
    "pseudonymise": lambda d: surrogates.pseudonymise(d, b"k"),
    "with_shard": lambda d: sharding.with_shard(d, 3),
    "toxicity": lambda d: toxicity.judge(d, toxicity.OrdinalModel()),
    "licenses": lambda d: licenses.scan(d),
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_values_stay(spark, name):
    docs = frame(spark)
    out = CASES[name](docs)
    assert out.columns[:len(docs.columns)] == docs.columns
    got = [tuple(r)[3:len(docs.columns)] for r in out.collect()]
    want = {tuple(r)[3:] for r in docs.collect()}
    assert got and set(got) <= want


def test_an_added_column_replaces_one_of_its_name(spark):
    docs = frame(spark).withColumn("shard", F.lit("mine"))
    out = sharding.with_shard(docs, 3)
    assert out.columns.count("shard") == 1 and {type(r.shard) for r in out.collect()} == {int}


def test_unknown_column(spark):
    with pytest.raises(ValueError, match="no column"):
        sharding.with_shard(frame(spark), 3, text_col="body")
