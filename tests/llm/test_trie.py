"""op11: the prefix trie against a trie built by hand."""

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import pytest

from salesmart.llm import queries
from salesmart.llm.trie import conversation_trie

SCHEMA = "conv_id long, turn long, role string, text string, n long, block int, key string, seq string"


def brute(rows):
    own = defaultdict(list)
    for r in rows:
        if r[0] is not None:
            role, text = r[2] or "", r[3] or ""
            tie = hashlib.sha256(f"{len(role.encode())}:{role}:{text}".encode()).digest()
            own[r[0]].append((r[1] is not None, r[1] or 0, role, tie, text))
    own = {c: [(x[2], x[4]) for x in sorted(t)] for c, t in own.items()}
    seqs = {}
    for c, t in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        seqs[c] = tuple(own.get(c - c % 5, [])[:h] + t[h:])
    nodes = defaultdict(list)
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            nodes[s[:d]].append(c)
    kids, saved, leaves = defaultdict(int), defaultdict(int), defaultdict(int)
    for s in nodes:
        if s:
            kids[s[:-1]] += 1
    for s, c in nodes.items():
        value = (len(c) - 1) * (len(s[-1][1].encode()) if s else 0)
        for d in range(len(s) + 1):
            saved[s[:d]] += value
            leaves[s[:d]] += kids[s] == 0
    return sorted((min(c), len(s), min(nodes[s[:-1]]) if s else None, len(c), kids[s], leaves[s], saved[s],
                   hashlib.sha256(",".join(str(x) for x in sorted(c) if len(seqs[x]) == len(s)).encode()).hexdigest())
                  for s, c in nodes.items())


def result(df):
    cols = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=lambda r: (r[0], r[1]))


def made(seed, convs, depth, words):
    rnd = random.Random(seed)
    rows = []
    for c in rnd.sample(range(convs * 2), convs):
        for t in range(rnd.randint(1, depth)):
            rows.append((c, t, rnd.choice(["user", "bot"]), rnd.choice(words)))
    return rows


@pytest.mark.parametrize("seed,convs,depth,words,block", [(1, 60, 4, ["a", "bé"], 3), (2, 200, 12, ["a", "b", "cc"], 7),
                                                          (3, 90, 25, ["a"], 2), (4, 40, 3, ["x", "y"], 1000), (5, 300, 14, ["a"], 5)])
def test_equals_brute_force(spark, seed, convs, depth, words, block):
    rows = made(seed, convs, depth, words)
    rows += [(5, None, None, "first"), (5, 0, "user", None), (5, 0, "user", None), (7, 9, "", ""), (None, 1, "user", "lost"), (1005, 1, "a", "end")]
    rows += [(c, 1, "user", "hello") for c in range(2000, 2040)]
    rows = [r + (1, 2, "k", "s") for r in rows]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert result(conversation_trie(df, block=block)) == brute(rows)


def test_long_conversation_and_ties(spark):
    rows = [(c, t, "u", "x" * (t % 7)) for c in (0, 1, 2, 5, 6, 9) for t in range(700 if c % 2 else 300)]
    rows += [(10, 1, "b", "same turn"), (10, 1, "a", "same turn")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert result(conversation_trie(df, block=2)) == brute(rows)


def test_empty(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert conversation_trie(df).collect() == []
    only_null = spark.createDataFrame([(None, 1, "a", "b")], "conv_id long, turn long, role string, text string")
    assert conversation_trie(only_null).collect() == []


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.01"
    got = result(queries.QUERIES["op11_conversation_trie"](spark, sf))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{sf}/conversations.parquet'")
    want = con.execute("SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 FROM ("
                       + queries.ORACLE["op11_conversation_trie"] + ") ORDER BY 1, 2").fetchall()
    assert got == want
