"""URL filters: hashed host-suffix and path-prefix expressions against a rule list.

Each rule is a pair (host, path) with a verdict.  It fits a URL whose host is
the rule's host or a subdomain of it and whose path starts with the rule's
path.  A URL expands into every host suffix (cut at label borders) times every
path prefix, as far as their label counts and lengths occur among the rules.
The expressions meet the rules on the first four bytes of a SHA-256 digest (an
equi-join), the full digests confirm, and the longest confirmed rule wins.

Work grows with the distinct URLs: equal (host, path) pairs are judged once, so
a URL that a third of all rows repeat costs one row in that join.  On the way
back its rows stay where they are: the verdicts of the few URLs with a large
share of the rows are broadcast, only the rows of the others are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, values, written

#: Hex digits of the digest on which URLs and rules meet (four bytes).
PREFIX_HEX = 8
#: A URL of at most ``HOT_CHARS`` characters with more than one ``HOT_PART``-th of all rows, and ``HOT_ROWS`` at least, is
#: hot.  There are fewer than ``HOT_PART`` such URLs, with their rules at most 8 MB of text to broadcast.
HOT_PART, HOT_ROWS, HOT_CHARS = 1024, 4096, 1024


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased; '' for null or no ``://``."""
    rest = F.substr(url, F.instr(url, "://") + 3)
    return F.when(F.instr(url, "://") > 0, ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0))).otherwise(F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ``? #`` or the end; '' for null or no ``://``."""
    rest = F.substr(url, F.instr(url, "://") + 3)
    return F.when(F.instr(url, "://") > 0, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)).otherwise(F.lit(""))


def rule_table(spark, rules: list[tuple[str, str, str]]) -> DataFrame:
    """(verdict, host, path) triples as the rule frame ``judge`` takes."""
    return values(spark, "host string, path string, verdict string", [(h, p, v) for v, h, p in rules])


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\t"), path), 256)


def judge(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow",
          names: tuple[str, str, str, str] = ("host", "path", "rule", "verdict")) -> DataFrame:
    """Every row of ``pages`` plus host, path, the rule that won and the verdict.

    * Null URL or no ``://``: host and path are empty, no rule fits (unless a rule has an empty host and path).
    * Rules with a null host, path or verdict are ignored.  One (host, path) with both verdicts blocks.
    * The longest rule wins (host plus path), then the longer host, then the greater rule text.
    * No fitting rule: ``rule`` is null and the verdict is ``default``.
    * Repeated rows stay repeated; columns of ``pages`` with the names given in ``names`` are replaced.
    * Empty pages or empty rules give an empty result or the default verdict.
    """
    host, path, rule, verdict = names
    out = pages.withColumns({host: url_host(F.col(url_col)), path: url_path(F.col(url_col))}).drop(rule, verdict)

    r = (rules.where(F.col("host").isNotNull() & F.col("path").isNotNull() & F.col("verdict").isNotNull())
         .groupBy("host", "path").agg(F.max("verdict").alias("verdict")))      # 'block' > 'allow'
    # label counts and path lengths that occur: at most as many as the longest rule has labels or characters
    shape = r.agg(F.collect_set(F.size(F.split("host", r"\."))).alias("labels"),
                  F.collect_set(F.length("path")).alias("lengths")).first()
    labels, lengths = sorted(shape["labels"]), sorted(shape["lengths"])
    r = r.select(_digest(F.col("host"), F.col("path")).alias("r_digest"), "verdict",
                 F.concat("host", "path").alias("rule"), F.length("host").alias("host_len"),
                 (F.length("host") + F.length("path")).alias("len"))
    r = r.withColumn("key", F.substring("r_digest", 1, PREFIX_HEX))

    urls = written(out.groupBy(F.col(host).alias("u_host"), F.col(path).alias("u_path")).agg(F.count(F.lit(1)).alias("n")), "urls")
    ints = lambda xs: F.array(*[F.lit(int(x)) for x in xs]).cast("array<int>")
    parts = F.split("u_host", r"\.")
    suffixes = F.transform(F.filter(ints(labels), lambda n: n <= F.size(parts)),
                           lambda n: F.array_join(F.slice(parts, -n, n), "."))
    prefixes = F.transform(F.filter(ints(lengths), lambda n: n <= F.length("u_path")),
                           lambda n: F.substr(F.col("u_path"), F.lit(1), n))
    # a narrow file is few splits: deal the URLs out before each becomes many expressions
    tasks = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    exprs = (urls.repartition(tasks, "u_host", "u_path").withColumn("s", F.explode(suffixes)).withColumn("p", F.explode(prefixes))
             .select("u_host", "u_path", _digest(F.col("s"), F.col("p")).alias("digest"))
             .withColumn("key", F.substring("digest", 1, PREFIX_HEX)))
    fits = exprs.join(r, "key").where(F.col("digest") == F.col("r_digest"))
    best = (fits.groupBy("u_host", "u_path").agg(F.max(F.struct("len", "host_len", "rule", "verdict")).alias("best"))
            .select("u_host", "u_path", F.col("best.rule").alias(rule), F.col("best.verdict").alias(verdict)))
    best = written(urls.join(best, ["u_host", "u_path"], "left")
                   .select(F.col("u_host").alias(host), F.col("u_path").alias(path), rule,
                           F.coalesce(F.col(verdict), F.lit(default)).alias(verdict), F.col("n").alias("_n")), "url_verdicts")
    rows = best.agg(F.sum("_n")).first()[0] or 0
    # every (host, path) has its verdict, so inner joins keep all rows
    crowded = (F.col("_n") > max(rows // HOT_PART, HOT_ROWS)) & (F.length(host) + F.length(path) <= HOT_CHARS)
    hot, others = F.broadcast(best.where(crowded).drop("_n")), best.where(~crowded).drop("_n")
    cold = out.join(hot.select(host, path), [host, path], "left_anti").join(others, [host, path])
    return out.join(hot, [host, path]).union(cold)
