"""The stages of the corpus pipeline on the smallest tables."""
import re
from collections import defaultdict

import corpus_pipeline as cp
from test_decontaminate import brute as brute_hits
from test_quality_rules import brute as brute_stats
from test_simhash import brute_classes, brute_fp

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs.collect()
    kept = {}
    for i, (name, stage) in enumerate(cp.STAGES):
        out = stage(spark, docs, SF)
        assert i == len(cp.STAGES) - 1 or out.columns == columns
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept[name] = docs.collect()
    good, one, clean, mixed, sharded = kept.values()
    failed = {r.doc_id for r in before if (s := brute_stats(r.text))[0] < 50 or 100 * s[4] > 50 * s[0]}
    assert not failed & {r.doc_id for r in good} and len(good) > 0.6 * (len(before) - len(failed))
    fps = [(r.doc_id, brute_fp(r.text)) for r in good]
    assert {r.doc_id for r in one} == set(brute_classes(fps)) and len(one) == len(set(brute_classes(fps)))
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    assert {r.doc_id for r in clean} == {r.doc_id for r in one if not brute_hits(r.text, items)[1]}
    assert {r.doc_id for r in mixed} <= {r.doc_id for r in clean}
    words, total = defaultdict(int), 0
    for r in mixed:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
        words[r.source] += n
        total += n
    all_words = sum(len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in clean)
    assert abs(total - all_words) < 0.25 * all_words        # whole documents, few per source at this size
    assert sorted(r.doc_id for r in sharded) == sorted(r.doc_id for r in mixed)
    by_text = defaultdict(set)
    for r in sharded:
        by_text[r.text].add(r.shard)
        assert 0 <= r.shard < 24
    assert all(len(s) == 1 for s in by_text.values())


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in cp.STAGES:
        assert stage(spark, docs, SF).count() == 0
