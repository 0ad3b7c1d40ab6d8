"""The op<N> queries over the given tables, and DuckDB SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (decontaminate, graph_search, licenses, mixing, quality_rules, ranked_search, sharding, simhash, substrings, surrogates, toxicity,
               trie, url_filter)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register
def op1_quality_rules(spark, sf_dir):
    """Statistics, base rule and learned decision list for every document."""
    docs = table(spark, sf_dir, "documents")
    rules = quality_rules.fit(docs, table(spark, sf_dir, "labels"))
    st = F.col("_st")
    return quality_rules.judge(docs, rules).select(
        "doc_id", *[st[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        "base_failed", "kept", "rule")


#: (verdict, host, path): the rules of the contract.
URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
             ("allow", "com", "/fr/"), ("block", "com", "/de/")]


@register
def op3_url_filter(spark, sf_dir):
    """Verdict of the longest fitting rule for every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge(pages, url_filter.rule_table(spark, URL_RULES)).select(
        "page_id", "host", "path", "rule", "verdict")


ORACLE["op3_url_filter"] = r"""
WITH p AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages),
u AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM p),
r(verdict, rhost, rpath) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'),
  ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
best AS (
  SELECT u.page_id, max_by(rhost || rpath, length(rhost || rpath)) AS rule, max_by(r.verdict, length(rhost || rpath)) AS verdict
  FROM u JOIN r ON (u.host = rhost OR ends_with(u.host, '.' || rhost)) AND starts_with(u.path, rpath)
  GROUP BY u.page_id)
SELECT u.page_id, u.host, u.path, best.rule, coalesce(best.verdict, 'allow') AS verdict
FROM u LEFT JOIN best USING (page_id)
"""


@register
def op7_decontaminate(spark, sf_dir):
    """Benchmark windows found in every document."""
    marked = decontaminate.mark(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    hits = F.col("hits")
    return marked.select(
        "doc_id", hits["n_words"].alias("n_words"), decontaminate.n_hit(hits).alias("n_hit"),
        F.size(hits["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(hits["items"]), ","), 256).alias("items_sha256"),
        (F.size(hits["spans"]) > 0).alias("contaminated"))


#: Shingle length and largest bit distance of the near-duplicate contract.
SHINGLE, MAX_BITS = 3, 2


@register
def op10_simhash(spark, sf_dir):
    """Fingerprint and near-duplicate component of every document."""
    return (simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=SHINGLE, max_bits=MAX_BITS)
            .select("doc_id", simhash.fingerprint_hex(F.col("fp")).alias("fingerprint"), "component_id"))


SHARDS = 24


@register
def op2_sharding(spark, sf_dir):
    """Shard and slot of every document; sizes near equal, equal texts together."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.assign(docs, SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@register
def op6_mixing(spark, sf_dir):
    """Words the source mix takes of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", "source")


@register
def op4_toxicity(spark, sf_dir):
    """Expected severity of every document; toxic where a grade of at least 1 is likelier than not."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    s = F.col("severity")
    scored = toxicity.judge(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", s["expected_severity"].alias("expected_severity"), s["p_ge_1"].alias("p_ge_1"),
                         s["p_ge_2"].alias("p_ge_2"), s["grade"].alias("grade"), (s["p_ge_1"] >= 0.5).alias("toxic"))


@register
def op9_licenses(spark, sf_dir):
    """Licence passages of every document."""
    m = F.col("matches")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.scan(docs, name="matches").select(
        "doc_id", F.size(m).cast("long").alias("n_matches"),
        F.array_join(F.array_sort(F.array_distinct(m["license"])), ",").alias("licenses"),
        F.array_join(F.array_sort(F.array_distinct(m["family"])), ",").alias("families"),
        F.coalesce(F.array_max(m["dice"]), F.lit(0.0)).alias("best_dice"))


#: Key of the surrogates; a deployment passes its own secret.
SURROGATE_KEY = b"op8 surrogate key"


@register
def op8_surrogates(spark, sf_dir):
    """Every document with its personal data replaced."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    e = F.col("entities")
    return surrogates.pseudonymise(docs, SURROGATE_KEY).select(
        "doc_id", "text", F.size(e).cast("long").alias("n_entities"),
        F.array_join(F.array_sort(F.array_distinct(e["kind"])), ",").alias("kinds"))


@register
def op5_substrings(spark, sf_dir):
    """Bytes of every document inside 400-byte strings that also start elsewhere, and the text that is left."""
    return substrings.remove_repeats(table(spark, sf_dir, "documents"), with_text=True)


@register
def op11_conversation_trie(spark, sf_dir):
    """Prefix trie of the rebuilt conversations, one row a node."""
    return trie.conversation_trie(table(spark, sf_dir, "conversations"))


ORACLE["op11_conversation_trie"] = r"""
WITH own AS (
  SELECT conv_id, list(k ORDER BY turn NULLS FIRST, r, k) AS ks, list(b ORDER BY turn NULLS FIRST, r, k) AS bs
  FROM (SELECT conv_id, turn, r, sha256(strlen(r) || ':' || r || ':' || x) AS k, strlen(x) AS b
        FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL))
  GROUP BY conv_id),
hashed AS (
  SELECT conv_id, ks, bs, conv_id - conv_id % 5 AS base,
    xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
      lambda acc, b: list_reduce(list_concat([xor(acc, b)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
        lambda y, z: xor(y >> 1, (y & 1) * 3988292384::BIGINT))), 4294967295::BIGINT) % 9 AS h
  FROM own),
seqs AS (
  SELECT c.conv_id, array_to_string(list_concat(coalesce(c0.ks[1:h], []), c.ks[h + 1:]), '') AS k,
         list_concat(coalesce(c0.bs[1:h], []), c.bs[h + 1:]) AS bs
  FROM hashed c LEFT JOIN own c0 ON c0.conv_id = c.base),
parts AS (
  SELECT conv_id, d, k[1:64 * d] AS node, len(bs) = d AS ends, CASE WHEN d > 0 THEN bs[d] ELSE 0 END AS b
  FROM (SELECT *, unnest(range(0, len(bs) + 1)) AS d FROM seqs)),
nodes AS (
  SELECT d, node, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(b) AS saved,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
  FROM parts GROUP BY d, node),
kids AS (SELECT d - 1 AS d, node[1:64 * (d - 1)] AS node, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1, 2),
whole AS (SELECT nodes.*, coalesce(kids.n, 0) AS n_children FROM nodes LEFT JOIN kids USING (d, node)),
subtrees AS (
  SELECT a AS d, node[1:64 * a] AS node, sum(saved)::BIGINT AS saved_tokens, count(*) FILTER (WHERE n_children = 0) AS n_leaves
  FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM whole) GROUP BY 1, 2)
SELECT w.conv_id, w.d AS depth, up.conv_id AS parent_conv_id, w.n_convs, w.n_children, s.n_leaves, s.saved_tokens, w.ends_sha256
FROM whole w JOIN subtrees s ON s.d = w.d AND s.node = w.node
LEFT JOIN nodes up ON up.d = w.d - 1 AND up.node = w.node[1:64 * (w.d - 1)]
"""


@register
def op12_graph_search(spark, sf_dir):
    """The 20 nearest vectors found for every vector whose id is divisible by 20."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return graph_search.nearest(vectors, F.col("vec_id") % 20 == 0)


@register
def op13_ranked_search(spark, sf_dir):
    """The 50 documents with the highest score for every benchmark item."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return ranked_search.rank(docs, table(spark, sf_dir, "benchmark"))


ORACLE["op13_ranked_search"] = r"""
WITH words AS (
  SELECT d.doc_id, d.row, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT doc_id, text, row_number() OVER () AS row FROM documents) d),
counts AS (SELECT doc_id, row, term, count(*) AS tf FROM words GROUP BY ALL),
sizes AS (SELECT row, sum(tf)::BIGINT AS n FROM counts GROUP BY row),
corpus AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM sizes),
freqs AS (SELECT term, count(*)::BIGINT AS df FROM counts GROUP BY term),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
weights AS (
  SELECT item_id, term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
  FROM asked JOIN freqs USING (term) CROSS JOIN corpus),
scores AS (
  SELECT item_id, doc_id, row, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // terms))))::BIGINT AS score
  FROM weights JOIN counts USING (term) JOIN sizes USING (row) CROSS JOIN corpus
  GROUP BY item_id, doc_id, row),
ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST) AS rank, doc_id, score
  FROM scores WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 50
"""
