"""The corpus pipeline: quality rules, near-duplicates, benchmark passages, source mix, shards.

``STAGES`` lists (name, function); each function takes ``(spark, docs, sf_dir)``
and returns a frame that is written as Parquet and read again as the next
stage's ``docs``.  All but the last return the columns of ``documents``.
Texts are shuffled only where a stage has to meet a decision made by id
(near-duplicates, mix); quality rules, passages and shards are one scan each.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from salesmart.llm import decontaminate, mixing, quality_rules, sharding, simhash
from salesmart.llm.queries import MAX_BITS, SHARDS, SHINGLE, table
from salesmart.session import work_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the decision list learned on this stage's input.

    Null and empty texts go; equal texts stay or go together; no labels: the base rule alone; columns stay whatever their names."""
    return quality_rules.keep_good(docs, quality_rules.fit(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash component the document with the smallest id (then the smallest text digest).

    Null and empty texts are one component; a repeated row stays once; no rows: an empty result; columns stay whatever their names."""
    return simhash.keep_one(docs, shingle=SHINGLE, max_bits=MAX_BITS)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a word inside a benchmark window.

    Null and empty texts stay; an empty benchmark changes nothing; columns stay whatever their names."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, to the nearest whole time.

    Texts without words stay once; a null source is a source of its own; equal rows may swap what they take; no rows: an empty result."""
    return mixing.repeat_to_mix(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its shard: sizes near equal, repeats of a text together, null texts too.

    A column called ``shard`` is replaced; fewer texts than shards leave shards empty."""
    return sharding.with_shard(docs, SHARDS)


STAGES = [("quality_rules", quality), ("near_duplicates", near_duplicates), ("benchmark_passages", benchmark_passages),
          ("source_mix", source_mix), ("shards", shards)]

#: The learned list and the near-duplicate components have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = work_path(spark, f"pipeline_{name}_{uuid.uuid4().hex}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
