"""Baskets: the lines are read once, and rare or infrequent items change nothing but the work (findings F6, F13 of round 3)."""
import itertools
import math
import random
from collections import Counter, defaultdict

import pytest

from salesmart.operators import rules


def _rows(seed=5, n=400):
    r = random.Random(seed)
    return [("s" + str(t % 3), f"t{t}", f"i{int(r.paretovariate(0.7)) % 60:02d}") for t in range(n) for _ in range(r.randint(1, 5))]


def _expected(rows, min_frequency, support, min_baskets=0):
    lines = defaultdict(list)
    for f, t, i in rows:
        lines[f, t].append(i)
    multi = [v for v in lines.values() if len(v) >= 2]
    times = Counter(i for v in multi for i in v)
    baskets = [s for v in multi if (s := frozenset(i for i in v if times[i] >= min_frequency))]
    needed = math.ceil(max(support, min_baskets / len(baskets)) * len(baskets))
    sets = Counter(c for b in baskets for k in range(1, len(b) + 1) for c in itertools.combinations(sorted(b), k))
    return len(baskets), {c: k for c, k in sets.items() if k >= needed}


@pytest.mark.parametrize("min_frequency,support,min_baskets", [(1, 0.02, 0), (5, 0.02, 0), (12, 0.1, 0), (5, 0.000001, 2), (5, 0.9, 0), (10_000, 0.1, 0)])
def test_itemsets_match_brute_force(spark, min_frequency, support, min_baskets):
    rows = _rows()
    lines = spark.createDataFrame(rows, "Fuente string, transaction_id string, item string")
    if min_frequency == 10_000:
        assert rules.mine_rules(lines, support, 0.0, 0.0, min_frequency).count() == 0
        return
    n, sets = _expected(rows, min_frequency, support, min_baskets)
    got = rules.frequent_itemsets(rules.mining_baskets(lines, min_frequency), support, cut_lineage=False, min_baskets=min_baskets).collect()
    assert {tuple(r["items"]): r["count"] for r in got} == sets
    assert {r["n_baskets"] for r in got} <= {n}


def test_lines_are_read_once(spark):
    rows = _rows()
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b
    lines = spark.createDataFrame(rows, "Fuente string, transaction_id string, item string").repartition(2)
    rules.mine_rules(lines.mapInPandas(count, lines.schema), 0.02, 0.1, 0.0).collect()
    assert seen.value == len(rows)
