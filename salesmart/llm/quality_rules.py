"""Quality rules: a learned decision list over text statistics, as Spark expressions.

Statistics of a text are native column expressions.  From labelled documents a
decision list is learned by sequential covering: a rule *grows* by adding the
threshold literal with the best FOIL gain on the grow part, is *pruned* back to
its best prefix on the prune part, and the rows it covers leave both parts
before the next rule starts.  The list is emitted as ordered ``CASE WHEN``
expressions, so judging a corpus is one scan without a shuffle.

Learning needs only counts by (feature, bin, class): each step is one small
aggregate on the executors and the driver sees that histogram, whose size
depends on the number of features and bins, never on the data.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import UPPER, let, once, own_columns, words, written

#: Upper bound of the labelled rows a list is fitted on (expected size; the rows are drawn by id hash).
MAX_LABELLED = 20_000

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
         "n_upper", "n_digits", "n_exclaims", "n_stops", "n_lines")


#: Characters that the features count; spelled out, since a class of single characters is one table look-up.
SYMBOLS, UPPERS, DIGITS, STOPS = "#*$%&|<>", UPPER, "0123456789", ".,;:?"


def _kept(text: Column, keep: str) -> Column:
    """The code points of ``text`` among the characters ``keep``."""
    return F.regexp_replace(text, f"[^{keep}]+", "")


def _kept_length(text: Column, keep: str) -> Column:
    return F.length(_kept(text, keep)).cast("long")


def _covered(at: Column) -> Column:
    """Words in the 3-word windows that start at the ascending positions ``at``."""
    start = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(at, start, lambda a, p: F.struct(
        p.alias("last"), (a["n"] + F.least(F.lit(3), p - a["last"])).cast("long").alias("n")), lambda a: a["n"])


def _repeat_words(h: Column) -> Column:
    """Words covered by 3-word windows whose hash occurs twice or more; ``h``: the windows' hashes in order.

    Texts without a repeated window stop at the distinct count.  A few repeated
    hashes are looked up in place; with many, (hash, position) pairs are
    sorted, which puts equal hashes side by side.  Both ways are exact.
    """
    def equals(z: Column, i: Column, x: Column, get=lambda e: e) -> Column:
        return F.coalesce(get(F.get(z, i)) == x, F.lit(False))

    def few(d: Column) -> Column:
        return _covered(F.filter(F.transform(h, lambda x, i: F.when(F.array_contains(d, x), i)), lambda i: i.isNotNull()))

    def many(z: Column) -> Column:
        hash_of = lambda e: e["h"]
        twice = F.filter(z, lambda e, i: equals(z, i - 1, e["h"], hash_of) | equals(z, i + 1, e["h"], hash_of))
        return _covered(F.array_sort(F.transform(twice, lambda e: e["p"])))

    pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p"))))
    repeated = let(F.sort_array(h), lambda s: F.array_distinct(F.filter(s, lambda x, i: equals(s, i - 1, x))))
    return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(
        let(repeated, lambda d: F.when(F.size(d) <= 12, few(d)).otherwise(let(pairs, many))))


def with_stats(df: DataFrame, text_col: str = "text", name: str = "_st") -> DataFrame:
    """``df`` plus a struct of the text's counts (``STATS``, all long; a null text has none of anything)."""
    t = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    out = once(df, F.struct(words(t).alias("w"), lines.alias("l"),
                            _kept(t, SYMBOLS + UPPERS + DIGITS + STOPS + "!").alias("m")), f"{name}_x")
    w, ln, marks = (F.col(f"{name}_x")[k] for k in "wlm")
    windows = let(w, lambda v: F.when(F.size(v) >= 3, F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(v) - 3, F.lit(0))),
        lambda i: F.xxhash64(F.get(v, i), F.get(v, i + 1), F.get(v, i + 2)))).otherwise(F.array().cast("array<bigint>")))
    stats = {
        "n_words": F.size(w).cast("long"),
        "word_chars": F.length(F.array_join(w, "")).cast("long"),
        "n_symbols": _kept_length(marks, SYMBOLS),
        "n_dup_lines": (F.size(ln) - F.size(F.array_distinct(ln))).cast("long"),
        "n_repeat_words": let(windows, _repeat_words),
        "n_upper": _kept_length(marks, UPPERS),
        "n_digits": _kept_length(marks, DIGITS),
        "n_exclaims": _kept_length(marks, "!"),
        "n_stops": _kept_length(marks, STOPS),
        "n_lines": F.size(ln).cast("long"),
    }
    return once(out, F.struct(*[stats[k].alias(k) for k in STATS]), name).drop(f"{name}_x")


def features(st: Column) -> dict[str, Column]:
    """Length-free features of a statistics struct, as doubles (0 where there are no words)."""
    def per(a: str, b: str) -> Column:
        return F.coalesce(F.try_divide(st[a].cast("double"), st[b].cast("double")), F.lit(0.0))
    return {
        "symbols_per_char": per("n_symbols", "word_chars"),
        "upper_per_char": per("n_upper", "word_chars"),
        "digits_per_char": per("n_digits", "word_chars"),
        "exclaims_per_word": per("n_exclaims", "n_words"),
        "stops_per_word": per("n_stops", "n_words"),
        "chars_per_word": per("word_chars", "n_words"),
        "words_per_line": per("n_words", "n_lines"),
        "dup_line_share": per("n_dup_lines", "n_lines"),
        "repeat_word_share": per("n_repeat_words", "n_words"),
    }


def base_failed(st: Column) -> Column:
    """The fixed base rule: under 50 words, or over half of the words in repeated 3-word windows."""
    return (st["n_words"] < 50) | (100 * st["n_repeat_words"] > 50 * st["n_words"])


@dataclass(frozen=True)
class Literal:
    feature: str
    above: bool
    cut: float

    def column(self, feats: dict[str, Column]) -> Column:
        f = feats[self.feature]
        return f > F.lit(self.cut) if self.above else f <= F.lit(self.cut)

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.cut:.6g}"


@dataclass
class DecisionList:
    """Ordered conjunctions; the first that holds rejects.  No rule: every text passes."""

    rules: list[list[Literal]] = field(default_factory=list)

    def fired(self, feats: dict[str, Column]) -> Column:
        """0-based index of the first rule that holds, else null: one ordered CASE WHEN."""
        out = F.lit(None).cast("int")
        for k in reversed(range(len(self.rules))):
            holds = reduce(lambda a, b: a & b, [x.column(feats) for x in self.rules[k]])
            out = F.when(holds, F.lit(k)).otherwise(out)
        return out

    def __str__(self) -> str:
        return "\n".join(" and ".join(map(str, r)) + " -> reject" for r in self.rules) or "(no rule)"


def _bins(cuts: list[float], f: Column) -> Column:
    """How many cuts lie below the value."""
    return F.size(F.filter(F.array(*[F.lit(float(c)) for c in cuts]), lambda c: c < f))


def _gain(p0: int, n0: int, p1: int, n1: int) -> float:
    return 0.0 if not p1 else p1 * (math.log2(p1 / (p1 + n1)) - math.log2(p0 / (p0 + n0)))


def learn(labelled: DataFrame, names: list[str], reject: str = "reject", fold: str = "fold", max_rules: int = 8,
          max_literals: int = 4, n_bins: int = 48, min_cover: int = 4, min_precision: float = 0.95) -> DecisionList:
    """Sequential covering over ``labelled``: feature columns ``names``, boolean ``reject``, ``fold`` 0-2 (2: prune part).

    Every step aggregates the labelled rows to (feature, bin) counts.  A rule
    enters the list if it covers ``min_cover`` rows of the grow part and its
    precision on the prune part (grow part where that is empty of covered rows)
    is at least ``min_precision``; the first rule that does not ends the list.
    No rows, or rows of one class: an empty list.
    """
    probs = [(i + 1) / (n_bins + 1) for i in range(n_bins)]
    # cuts from each class on its own: a junk share of a few per cent still gets its own cuts
    per_class = labelled.groupBy(reject).agg(*[F.percentile_approx(n, probs, 2000).alias(n) for n in names]).collect()
    seen = {n: sorted({float(v) for row in per_class for v in (row[n] or [])}) for n in names}
    cuts = {n: [(a + b) / 2 for a, b in zip(v, v[1:])] for n, v in seen.items()}    # half-way: the widest margin
    if len(per_class) < 2:
        return DecisionList()
    binned = written(labelled.select(reject, (F.col(fold) == 2).alias("prune"),
                                     F.array(*[_bins(cuts[n], F.col(n)) for n in names]).alias("b"))
                     .coalesce(4), "quality_bins")
    at = {n: i for i, n in enumerate(names)}

    def holds(literals: list[Literal]) -> Column:
        def one(x: Literal) -> Column:
            k = cuts[x.feature].index(x.cut)
            b = F.col("b")[at[x.feature]]
            return b > k if x.above else b <= k
        return reduce(lambda a, c: a & c, [one(x) for x in literals], F.lit(True))

    def histogram(left: Column, literals: list[Literal]) -> dict[tuple[int, int], list[int]]:
        rows = (binned.where(~F.col("prune") & left & holds(literals))
                .select(reject, F.posexplode("b").alias("f", "bin"))
                .groupBy("f", "bin").agg(F.count_if(F.col(reject)).alias("p"), F.count_if(~F.col(reject)).alias("n")).collect())
        return {(r["f"], r["bin"]): [r["p"], r["n"]] for r in rows}

    out, left = DecisionList(), F.lit(True)
    while len(out.rules) < max_rules:
        rule: list[Literal] = []
        while len(rule) < max_literals:
            h = histogram(left, rule)
            p0, n0 = (sum(h[k][i] for k in h if k[0] == 0) for i in (0, 1))
            if p0 < min_cover or n0 == 0:
                break
            best = (1e-9, None)
            for name, f in at.items():
                p = n = 0
                for k, cut in enumerate(cuts[name]):
                    dp, dn = h.get((f, k), [0, 0])
                    p, n = p + dp, n + dn
                    for above, (p1, n1) in ((False, (p, n)), (True, (p0 - p, n0 - n))):
                        if p1 >= min_cover and (g := _gain(p0, n0, p1, n1)) > best[0]:
                            best = (g, Literal(name, above, cut))
            if best[1] is None:
                break
            rule.append(best[1])
        if not rule:
            break
        prefixes = [rule[: i + 1] for i in range(len(rule))]
        counted = binned.where(left).agg(*[
            F.count_if(holds(x) & (F.col("prune") == part) & (F.col(reject) == c)).alias(f"{i}_{int(part)}_{int(c)}")
            for i, x in enumerate(prefixes) for part in (True, False) for c in (True, False)]).first()

        def precision(i: int) -> tuple[float, int]:
            p, n = counted[f"{i}_1_1"], counted[f"{i}_1_0"]
            if p + n == 0:
                p, n = counted[f"{i}_0_1"], counted[f"{i}_0_0"]
            return (p / (p + n) if p + n else 0.0), p
        # the shortest prefix among the best: (p - n) / (p + n) orders like precision
        best_i = max(range(len(prefixes)), key=lambda i: (round(precision(i)[0], 3), precision(i)[1], -i))
        if precision(best_i)[0] < min_precision or counted[f"{best_i}_0_1"] < min_cover:
            break
        out.rules.append(prefixes[best_i])
        left = left & ~holds(prefixes[best_i])
    return out


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        max_labelled: int = MAX_LABELLED, **params) -> DecisionList:
    """A decision list from ``labels`` (id, label: 0 means reject) over the documents they name.

    Null ids and null labels are left out; the lower of several labels of one
    id holds.  With more than ``max_labelled`` labelled ids, an id-hash share
    of that expected size is used, which also bounds the broadcast.
    """
    lab = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
           .groupBy(F.col(id_col).alias("_id")).agg((F.min(label_col) == 0).alias("reject")))
    n = lab.count()
    h = F.xxhash64("_id")
    if n > max_labelled:
        lab = lab.where(F.pmod(h, F.lit(1_000_000)) < int(1_000_000 * max_labelled / n))
    named = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(F.broadcast(lab), "_id")
    st = with_stats(named, "_text").where(~base_failed(F.col("_st")))
    feats = features(F.col("_st"))
    table = written(st.select("reject", F.pmod(F.xxhash64(F.lit("fold"), F.col("_id")), F.lit(3)).alias("fold"),
                              *[c.alias(k) for k, c in feats.items()]), "quality_labelled")
    return learn(table, list(feats), **params)


@own_columns("text_col")
def judge(docs: DataFrame, rules: DecisionList, text_col: str = "text", name: str = "_st") -> DataFrame:
    """``docs`` plus ``name`` (statistics struct), ``base_failed``, ``rule`` (index of the rule that fired) and ``kept``.

    A null or empty text has no words, so it fails the base rule.  Texts of any
    length are judged whole.  Columns of ``docs`` with these names are replaced, all others stay as they are.
    """
    out = with_stats(docs.drop("base_failed", "rule", "kept"), text_col, name)
    st = F.col(name)
    fired = rules.fired(features(st))
    return out.withColumns({"base_failed": base_failed(st), "rule": fired}).withColumn(
        "kept", ~F.col("base_failed") & F.col("rule").isNull())


@own_columns("text_col")
def keep_good(docs: DataFrame, rules: DecisionList, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns only, whatever these are called.

    Null and empty texts fail the base rule and go; texts of any length are judged whole; repeated rows stay or go together.
    An empty table stays empty."""
    out = with_stats(docs.select("*", F.lit(0).alias("_one")), text_col)
    st = F.col("_st")
    return out.where(~base_failed(st) & rules.fired(features(st)).isNull()).select(*[docs[c] for c in docs.columns])
