"""Baskets, frequent itemsets, association rules, recommendation (AR1-AR10, JN11-JN12).

* baskets: facts grouped by (source, transaction id) - or by transaction id
  only with ``merge_sources=True`` (the reference's grouping, D2)
* frequent itemsets: ``pyspark.ml.fpm.FPGrowth`` (parallel FP-growth)
* rules: every antecedent/consequent split of every frequent itemset,
  multi-item consequents included.  Spark's own ``associationRules`` only
  emits single-item consequents, so the splits are generated here with a
  bit-mask ``transform`` over ``sequence`` and the subset supports are found
  by equi joins on a canonical text key.
* recommendation: baskets joined to rules on the canonical antecedent key
  (set equality as a hash key), top-k per basket by window.
"""

from __future__ import annotations

import math
import uuid

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import clean
from ..session import work_path

# Thresholds used by the reference rule job.
MIN_SUPPORT = 0.002
MIN_CONFIDENCE = 0.10
MIN_LIFT = 1.5
MIN_ITEM_FREQUENCY = 5

SEP = ", "


def canon(items) -> F.Column:
    """AR6: canonical text of an item set: sorted, joined with ', '."""
    c = F.col(items) if isinstance(items, str) else items
    return F.array_join(F.array_sort(c), SEP)


# ------------------------------------------------------------------ AR1

def basket_lines(fact: DataFrame, dim_p: DataFrame, item_col: str = "SKU", merge_sources: bool = False) -> DataFrame:
    """Fact rows with their basket id and item (valid, non-empty items only)."""
    p = dim_p.select("ProductoID", F.col(item_col).alias("item"))
    x = fact.select("Fuente", "SourceKey", "ProductoID").join(p, "ProductoID")
    x = x.where(F.col("item").isNotNull() & (F.col("item") != ""))
    txn = clean.transaction_id(F.col("Fuente"), F.col("SourceKey"))
    src = F.lit("*") if merge_sources else F.col("Fuente")
    return x.select(src.alias("Fuente"), txn.alias("transaction_id"), "item")


def baskets(fact: DataFrame, dim_p: DataFrame, item_col: str = "SKU", merge_sources: bool = False) -> DataFrame:
    """AR1 + AR2: one row per transaction, sorted item list (duplicates kept)
    and its ', ' text; ``n_lines`` counts fact rows."""
    # pre-aggregate (basket, item) counts map-side; the basket shuffle then
    # carries one row per distinct item, and duplicates are re-expanded
    counted = (basket_lines(fact, dim_p, item_col, merge_sources)
               .groupBy("Fuente", "transaction_id", "item").agg(F.count(F.lit(1)).alias("_n")))
    b = (counted.groupBy("Fuente", "transaction_id")
         .agg(F.array_sort(F.collect_list(F.struct("item", "_n"))).alias("_pairs"))
         .select("Fuente", "transaction_id",
                 F.flatten(F.transform("_pairs", lambda x: F.array_repeat(x["item"], x["_n"].cast("int"))))
                 .alias("items")))
    return b.select("Fuente", "transaction_id", "items", F.array_join("items", SEP).alias("item"),
                    F.size("items").alias("n_lines"))


def mining_baskets(lines: DataFrame, min_item_frequency: int = MIN_ITEM_FREQUENCY) -> DataFrame:
    """AR2 + AR3 as a distributed job (no one-hot matrix):

    keep transactions with >= 2 lines, count item occurrences over those
    (duplicates count), drop rare items, keep distinct item arrays.
    Baskets left empty vanish, so the support denominator is the number of
    baskets with at least one frequent item.

    The lines are shuffled once, into baskets that are written; only the rare
    items travel back to them.  The frame returned reads written files."""
    key = ["Fuente", "transaction_id"]
    named = lines.where(F.col("Fuente").isNotNull() & F.col("transaction_id").isNotNull())
    multi = _written(named.groupBy(*key).agg(F.collect_list("item").alias("_all"), F.count(F.lit(1)).alias("_n"))
                     .where((F.col("_n") >= 2) & (F.size("_all") > 0)).drop("_n"), "baskets")
    rare = _written(multi.select(F.explode("_all").alias("item")).groupBy("item").agg(F.count(F.lit(1)).alias("_c"))
                    .where(F.col("_c") < min_item_frequency).select("item"), "rare_items")
    whole = multi.select(*key, F.array_sort(F.array_distinct("_all")).alias("items"))
    if rare.isEmpty():
        return whole
    gone = _written(whole.select(*key, F.explode("items").alias("item")).join(rare, "item", "left_semi")
                    .groupBy(*key).agg(F.collect_list("item").alias("_rare")), "rare_in_baskets")
    left = F.when(F.col("_rare").isNull(), F.col("items")).otherwise(F.array_except("items", "_rare"))
    return _written(whole.join(gone, key, "left").select(*key, left.alias("items")).where(F.size("items") > 0), "baskets")


def _written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared work folder and read back."""
    path = work_path(df.sparkSession, f"{name}_{uuid.uuid4().hex}")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# ------------------------------------------------------------------ AR4

def frequent_itemsets(mb: DataFrame, min_support: float = MIN_SUPPORT, cut_lineage: bool = True,
                      min_baskets: int = 0) -> DataFrame:
    """AR4: FP-Growth itemsets with count and support (denominator = baskets).

    The item arrays are written once (``cut_lineage``; not needed for the
    frames of ``mining_baskets``), so the passes read files instead of
    re-running the basket shuffles; only counts (scalars) reach the driver.
    ``min_baskets`` raises the support to that many baskets at least.

    An itemset is no more frequent than any of its items, so FP-Growth gets the
    baskets without the items that are below the support themselves; its
    threshold stays the same number of baskets."""
    mb = mb.select("items")
    if cut_lineage:
        mb = _written(mb, "baskets")
    n = mb.count()
    min_support = max(min_support, min_baskets / max(n, 1))
    needed = max(math.ceil(min_support * n), 1)
    found = _written(mb.select(F.explode("items").alias("item")).groupBy("item").agg(F.count(F.lit(1)).alias("_b")), "item_baskets")
    strong = F.col("_b") >= needed
    sizes = found.agg(F.count(F.lit(1)).alias("all"), F.count_if(strong).alias("strong")).first()       # two scalars
    kept, n_kept = mb, n
    if sizes["strong"] < sizes["all"]:
        keep = _written(found.where(strong).select("item"), "strong_items")
        kept = _written(mb.withColumn("_id", F.monotonically_increasing_id()).select("_id", F.explode("items").alias("item"))
                        .join(keep, "item", "left_semi").groupBy("_id").agg(F.collect_list("item").alias("items")).select("items"), "baskets")
        n_kept = kept.count()
    model = FPGrowth(itemsCol="items", minSupport=(needed - 0.5) / max(n_kept, needed), minConfidence=1.0).fit(kept)
    fi = model.freqItemsets
    return fi.select(F.array_sort("items").alias("items"), F.col("freq").alias("count"),
                     (F.col("freq") / F.lit(float(n) if n else None)).alias("support"),
                     F.lit(n).cast("long").alias("n_baskets"))


# ------------------------------------------------------------------ AR5

def association_rules(itemsets: DataFrame, min_confidence: float = MIN_CONFIDENCE,
                      min_lift: float = MIN_LIFT) -> DataFrame:
    """AR5: all splits of each frequent itemset (size >= 2).

    Every subset of a frequent itemset is frequent, so antecedent and
    consequent supports are found by exact key joins against the itemsets."""
    sup = itemsets.select(canon("items").alias("_k"), F.col("support").alias("_s"))
    big = itemsets.where(F.size("items") >= 2)
    n = F.size("items")
    masks = F.sequence(F.lit(1), F.pow(F.lit(2), n).cast("long") - 2)

    def bit(i):
        return F.pow(F.lit(2), i).cast("long")

    splits = big.select("items", "support", F.explode(masks).alias("m"))
    splits = splits.select(
        "items", F.col("support"),
        F.filter("items", lambda x, i: F.col("m").bitwiseAND(bit(i)) != 0).alias("antecedents"),
        F.filter("items", lambda x, i: F.col("m").bitwiseAND(bit(i)) == 0).alias("consequents"))
    a = sup.select(F.col("_k").alias("_ak"), F.col("_s").alias("antecedent_support"))
    c = sup.select(F.col("_k").alias("_ck"), F.col("_s").alias("consequent_support"))
    r = (splits.withColumn("_ak", canon("antecedents")).withColumn("_ck", canon("consequents"))
         .join(a, "_ak").join(c, "_ck"))
    conf = F.col("support") / F.col("antecedent_support")
    lift = conf / F.col("consequent_support")
    r = r.select("antecedents", "consequents", "support", "antecedent_support", "consequent_support",
                 conf.alias("confidence"), lift.alias("lift"),
                 F.col("_ak").alias("Antecedent"), F.col("_ck").alias("Consequent"))
    return r.where(F.col("confidence") >= min_confidence).where(F.col("lift") >= min_lift)


def mine_rules(lines: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE,
               min_lift: float = MIN_LIFT, min_item_frequency: int = MIN_ITEM_FREQUENCY, min_baskets: int = 0) -> DataFrame:
    """AR2-AR7 composed: the rules table to publish (computed first, then
    the caller overwrites the published table - D11)."""
    mb = mining_baskets(lines, min_item_frequency)
    return association_rules(frequent_itemsets(mb, min_support, cut_lineage=False, min_baskets=min_baskets), min_confidence, min_lift)


# ------------------------------------------------------------- JN11/AR8

def recommend(baskets_df: DataFrame, rules: DataFrame, k: int = 5, items_col: str = "items",
              id_cols=("basket_id",)) -> DataFrame:
    """AR8 + WN1 for many baskets at once.

    A rule applies when its antecedent set equals the basket's item set
    (JN11).  Rules are ranked per antecedent first (confidence, lift desc,
    consequent text as tie-break, D13) and cut to k before the join, so a
    popular antecedent never multiplies basket rows beyond k."""
    ranked = rules.withColumn("_r", F.row_number().over(
        Window.partitionBy("Antecedent").orderBy(F.desc("confidence"), F.desc("lift"), F.asc("Consequent"))))
    top = ranked.where(F.col("_r") <= k)
    b = baskets_df.withColumn("_key", canon(F.array_distinct(F.col(items_col))))
    j = b.join(top, b._key == top.Antecedent, "inner")
    # the consequent is disjoint from the antecedent by construction; keep the check
    j = j.where(~F.arrays_overlap(F.col("consequents"), F.array_distinct(F.col(items_col))))
    return j.select(*id_cols, "Antecedent", "Consequent", "support", "confidence", "lift",
                    F.col("_r").alias("rank"))


def codes_to_skus(codes: DataFrame, bridge: DataFrame, dim_p: DataFrame, source: str,
                  code_col: str = "code") -> DataFrame:
    """JN12: source codes -> official SKU via bridge then product dim; unresolved dropped."""
    m = bridge.where(F.col("source_system") == source).select(F.col("source_code").alias("_c"), "sku_oficial")
    p = dim_p.select(F.col("SourceKey").alias("_pk"), F.col("SourceSystem").alias("_ps"), F.col("SKU").alias("_psku"))
    x = codes.join(m, codes[code_col] == m._c, "left")
    x = x.join(p, (x[code_col] == p._pk) & (p._ps == source), "left")
    return (x.withColumn("SKU", F.coalesce("sku_oficial", "_psku")).where(F.col("SKU").isNotNull())
            .drop("_c", "sku_oficial", "_pk", "_ps", "_psku"))


def rule_products_json(rules: DataFrame, dim_p: DataFrame, side: str = "consequents") -> DataFrame:
    """SC34/AR10: products of one rule side as a JSON array (SKU, Nombre, code)."""
    x = rules.select("Antecedent", "Consequent", F.posexplode(side).alias("_pos", "SKU"))
    p = dim_p.select("SKU", "Nombre", F.col("SourceKey").alias("codigo"))
    j = x.join(p, "SKU", "left")
    return (j.groupBy("Antecedent", "Consequent")
            .agg(F.to_json(F.transform(F.array_sort(F.collect_list(F.struct("_pos", "SKU", "Nombre", "codigo"))),
                                       lambda s: F.struct(s["SKU"].alias("SKU"), s["Nombre"].alias("Nombre"),
                                                          s["codigo"].alias("codigo")))).alias("productos_json")))


def side_products_json(rules: DataFrame, side: str, dim_p: DataFrame, bridge: DataFrame, source: str, code_name: str, name: str) -> DataFrame:
    """(Antecedent, Consequent, ``name``): the products of one side as a JSON array of SKU, Nombre and, where the
    source has one, its own code under ``code_name`` (SC34, AR10)."""
    x = rules.select("Antecedent", "Consequent", F.explode(side).alias("SKU"))
    own = bridge.where(F.col("source_system") == source).select(F.col("sku_oficial").alias("_sku"), F.col("source_code").alias("_code"))
    j = x.join(dim_p.select("SKU", "Nombre"), "SKU").join(own, F.col("SKU") == F.col("_sku"), "left")
    row = F.struct("SKU", "Nombre", F.col("_code").alias(code_name))
    return j.groupBy("Antecedent", "Consequent").agg(F.to_json(F.sort_array(F.collect_set(row))).alias(name))


def recommend_from_codes(lines: DataFrame, rules: DataFrame, bridge: DataFrame, dim_p: DataFrame, source: str, code_name: str, k: int = 5,
                         basket_col: str = "basket", code_col: str = "code") -> DataFrame:
    """AR9: baskets of source codes to recommendations with the products of both sides.

    ``lines``: (basket, code).  Codes meet the bridge once each, not once a
    line; codes without a SKU are dropped, and a basket asks with the set of
    SKUs that is left (JN12, then JN11/AR8).  The sides of a rule are written
    out once a rule, however many baskets get it (AR10).
    """
    skus = codes_to_skus(lines.select(code_col).distinct(), bridge, dim_p, source, code_col).select(code_col, "SKU")
    asked = (lines.select(basket_col, code_col).join(skus, code_col).groupBy(basket_col)
             .agg(F.array_sort(F.collect_set("SKU")).alias("items")))
    found = recommend(asked, rules, k, "items", (basket_col,))
    for side, name in (("antecedents", "productos_antecedente"), ("consequents", "productos_consecuente")):
        found = found.join(side_products_json(rules, side, dim_p, bridge, source, code_name, name), ["Antecedent", "Consequent"], "left")
    return found
