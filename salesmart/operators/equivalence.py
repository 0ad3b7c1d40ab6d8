"""Product entity resolution across the five sources (ER1-ER10).

Products are grouped by the match key (lower/trim of name and category).
Inside a group, the *last* product of each source wins (read order ``seq``),
the official SKU comes from the first source in the priority list that has
one, and groups with none get a new ``SKU-%04d`` number: the k-th such group
(in first-seen order) takes the k-th number at or after the start that no
source already uses.

All steps are DataFrame jobs: one shuffle on the match key for the group
aggregate, and a range-partitioned ranking for the number allocation.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import clean
from .keys import global_row_number

# Order in which sources are added (first-seen order).
ADD_ORDER = ["mssql", "mysql", "supabase", "mongo", "neo4j"]
# Priority for the official SKU.
SKU_PRIORITY = ["mssql", "supabase", "mongo", "neo4j"]

def _blank_to_null(c: Column) -> Column:
    return F.when(c != "", c)


def _rank(source: str) -> Column:
    return F.lit(ADD_ORDER.index(source))


# ------------------------------------------------------------------ ER1

def std_mssql(producto: DataFrame) -> DataFrame:
    return producto.select(
        F.lit("mssql").alias("source"),
        F.col("ProductoId").cast("string").alias("source_code"),
        _blank_to_null(F.col("SKU")).alias("sku"),
        F.coalesce("Nombre", F.lit("")).alias("nombre"),
        F.coalesce("Categoria", F.lit("")).alias("categoria"),
        F.col("ProductoId").cast("long").alias("seq"),
        _rank("mssql").alias("source_rank"))


def std_mysql(producto: DataFrame) -> DataFrame:
    return producto.select(
        F.lit("mysql").alias("source"),
        F.coalesce("codigo_alt", F.lit("")).alias("source_code"),
        F.lit(None).cast("string").alias("sku"),
        F.coalesce("nombre", F.lit("")).alias("nombre"),
        F.coalesce("categoria", F.lit("")).alias("categoria"),
        F.col("id").cast("long").alias("seq"),
        _rank("mysql").alias("source_rank"))


def std_supabase(producto: DataFrame) -> DataFrame:
    sku = _blank_to_null(F.col("sku"))
    return producto.select(
        F.lit("supabase").alias("source"),
        F.coalesce(sku, F.col("producto_id").cast("string")).alias("source_code"),
        sku.alias("sku"),
        F.col("nombre"), F.col("categoria"),
        F.col("producto_id").alias("seq_text"),
        _rank("supabase").alias("source_rank"))


def std_mongo(productos: DataFrame) -> DataFrame:
    eq_sku = _blank_to_null(F.col("equivalencias.sku"))
    return productos.select(
        F.lit("mongo").alias("source"),
        F.col("codigo_mongo").alias("source_code"),
        F.when(eq_sku.isNotNull(), clean.normalize_sku(eq_sku)).alias("sku"),
        F.col("nombre"), F.col("categoria"),
        F.col("_id").alias("seq_text"),
        _rank("mongo").alias("source_rank"))


def std_neo4j(producto: DataFrame) -> DataFrame:
    raw = F.coalesce(_blank_to_null(F.col("sku")), F.col("id"))
    sku = F.when(raw.isNotNull() & (raw != ""), clean.normalize_sku(raw))
    return producto.select(
        F.lit("neo4j").alias("source"),
        F.coalesce(sku, F.lit("")).alias("source_code"),
        sku.alias("sku"),
        F.col("nombre"), F.col("categoria"),
        F.col("id").alias("seq_text"),
        _rank("neo4j").alias("source_rank"))


def standardize_products(products: dict[str, DataFrame | None]) -> DataFrame:
    """ER1 + SRC9: union of the standardised product frames of present sources.

    ``seq`` is the read order inside a source (D4): numeric ids for the
    relational sources, the id text order for the others.
    """
    makers = {"mssql": std_mssql, "mysql": std_mysql, "supabase": std_supabase,
              "mongo": std_mongo, "neo4j": std_neo4j}
    frames = []
    for src in ADD_ORDER:
        df = products.get(src)
        if df is None:
            continue
        s = makers[src](df)
        if "seq_text" in s.columns:
            s = s.withColumn("seq", F.lit(None).cast("long"))
        else:
            s = s.withColumn("seq_text", F.lit(None).cast("string"))
        frames.append(s.select("source", "source_code", "sku", "nombre", "categoria",
                               "source_rank", "seq", "seq_text"))
    out = reduce(lambda a, b: a.unionByName(b), frames)
    # a single sortable position: (source_rank, numeric seq, text seq)
    return (out.withColumn("pos", F.struct("source_rank", "seq", "seq_text"))
            .withColumn("key_nombre", clean.match_key(F.col("nombre")))
            .withColumn("key_categoria", clean.match_key(F.col("categoria"))))


# ------------------------------------------------------------- ER2 / ER3

def group_products(std: DataFrame) -> DataFrame:
    """One row per match key: first-seen name/category/position and the
    last product's SKU per source (one shuffle on the key)."""
    aggs = [
        F.min("pos").alias("first_pos"),
        F.min_by(F.struct("nombre", "categoria"), "pos").alias("first"),
    ]
    for src in ADD_ORDER:
        # max_by ignores rows whose ordering value is null: only this source's rows count
        last = F.max_by(F.struct(F.col("sku").alias("v")), F.when(F.col("source") == src, F.col("pos")))
        aggs.append(last["v"].alias(f"sku_{src}"))
        aggs.append(F.max(F.when(F.col("source") == src, F.lit(True))).alias(f"has_{src}"))
    g = std.groupBy("key_nombre", "key_categoria").agg(*aggs)
    resolved = F.coalesce(*[_blank_to_null(F.col(f"sku_{s}")) for s in SKU_PRIORITY])
    return (g.withColumn("nombre", F.col("first.nombre"))
            .withColumn("categoria", F.col("first.categoria")).drop("first")
            .withColumn("sku_resolved", resolved))


# ------------------------------------------------------------- ER4 / ER5

def max_existing_sku(bridge: DataFrame | None) -> DataFrame:
    """ER5 + FL8: highest numeric SKU among bridge SKUs starting 'SKU' (0 when none), as a 1-row frame."""
    if bridge is None:
        raise ValueError("bridge required")
    n = F.regexp_extract(F.col("sku_oficial"), r"^SKU-?(\d+)", 1).try_cast("long")
    return (bridge.where(F.col("sku_oficial").startswith("SKU"))
            .agg(F.coalesce(F.max(n), F.lit(0)).alias("max_sku")))


def allocate_free_numbers(requests: DataFrame, used: DataFrame, start: int) -> DataFrame:
    """k-th request (column ``k``, 1..K) -> k-th integer >= start not in ``used.n``.

    For used numbers u_1 < u_2 < ... (>= start), g_i = u_i - start - (i-1) is
    how many free numbers lie below u_i.  Request k lands on
    start + (k-1) + #{i : g_i <= k-1}.  Sorting used rows (pos = g_i) and
    requests (pos = k-1) together, that count is the request's global
    position minus k.
    """
    u = used.select(F.col("n").cast("long")).where(F.col("n") >= start).distinct()
    u = global_row_number(u, ["n"], "i")
    gaps = u.select((F.col("n") - start - (F.col("i") - 1)).alias("pos"), F.lit(0).alias("kind"),
                    F.col("n").alias("tb"), F.lit(None).cast("long").alias("k"))
    reqs = requests.select((F.col("k") - 1).cast("long").alias("pos"), F.lit(1).alias("kind"),
                           F.col("k").cast("long").alias("tb"), F.col("k").cast("long").alias("k"))
    both = global_row_number(gaps.unionByName(reqs), ["pos", "kind", "tb"], "rn")
    return (both.where(F.col("kind") == 1)
            .select("k", (F.lit(start) + F.col("k") - 1 + (F.col("rn") - F.col("k"))).alias("number")))


def used_sku_numbers(groups: DataFrame) -> DataFrame:
    """Numbers whose canonical text equals a SKU some source already has."""
    skus = groups.select(F.explode(F.array(*[F.col(f"sku_{s}") for s in SKU_PRIORITY])).alias("s"))
    n = clean.sku_number(F.col("s"))
    return (skus.where(n.isNotNull()).select(F.col("s"), n.alias("n"))
            .where(clean.sku_text(F.col("n")) == F.col("s")).select("n").distinct())


def resolve_skus(groups: DataFrame, existing_max_sku: int = 0, cut_lineage: bool = True) -> DataFrame:
    """ER3 + ER4: official SKU per group; generated ones flagged.

    The group table feeds several ranking jobs; with ``cut_lineage`` it is
    checkpointed once (reliable checkpoint in ``spark.checkpoint.dir``) so
    the five source scans and the group shuffle run once, and a lost
    executor restarts from the checkpoint files."""
    start = existing_max_sku + 1 if existing_max_sku > 0 else 1
    if cut_lineage:
        groups = groups.checkpoint(eager=True)
    todo = groups.where(F.col("sku_resolved").isNull()).select("key_nombre", "key_categoria", "first_pos")
    if cut_lineage and todo.isEmpty():
        return (groups.withColumn("sku_generated", F.lit(None).cast("string"))
                .withColumn("sku_oficial", F.col("sku_resolved"))
                .withColumn("sku_origin", F.coalesce(
                    *[F.when(_blank_to_null(F.col(f"sku_{s}")) == F.col("sku_oficial"), F.lit(s)) for s in SKU_PRIORITY],
                    F.lit("generated"))))
    todo = global_row_number(todo, ["first_pos", "key_nombre", "key_categoria"], "k")
    numbers = allocate_free_numbers(todo.select("k"), used_sku_numbers(groups), start)
    gen = todo.join(numbers, "k").select("key_nombre", "key_categoria",
                                          clean.sku_text(F.col("number")).alias("sku_generated"))
    out = groups.join(gen, ["key_nombre", "key_categoria"], "left")
    return (out.withColumn("sku_oficial", F.coalesce("sku_resolved", "sku_generated"))
            .withColumn("sku_origin", F.coalesce(
                *[F.when(_blank_to_null(F.col(f"sku_{s}")) == F.col("sku_oficial"), F.lit(s)) for s in SKU_PRIORITY],
                F.lit("generated"))))


def build_equivalence_map(products: dict[str, DataFrame | None], existing_max_sku: int = 0) -> DataFrame:
    """ER10: standardise -> group -> resolve.  One row per product group."""
    std = standardize_products(products)
    return resolve_skus(group_products(std), existing_max_sku)


# ------------------------------------------------------------------ ER6

def lookup_by_name(df: DataFrame, eq_map: DataFrame, nombre: str, categoria: str,
                   out: str = "sku_oficial") -> DataFrame:
    """ER6: SKU by (name, category) as an equi join on the match key."""
    m = eq_map.select("key_nombre", "key_categoria", F.col("sku_oficial").alias(out))
    d = (df.withColumn("_kn", clean.match_key(F.col(nombre)))
         .withColumn("_kc", clean.match_key(F.col(categoria))))
    return (d.join(m, (d._kn == m.key_nombre) & (d._kc == m.key_categoria), "left")
            .drop("_kn", "_kc", "key_nombre", "key_categoria"))


# ------------------------------------------------------------------ ER7

def equivalence_stats(eq_map: DataFrame) -> DataFrame:
    """ER7: groups, groups per source, SKU origin counts (one row)."""
    aggs = [F.count(F.lit(1)).alias("total_products")]
    for s in ADD_ORDER:
        aggs.append(F.count(F.col(f"has_{s}")).alias(f"in_{s}"))
    for s in SKU_PRIORITY + ["generated"]:
        aggs.append(F.count(F.when(F.col("sku_origin") == s, 1)).alias(f"sku_from_{s}"))
    return eq_map.agg(*aggs)


# ------------------------------------------------------------------ ER8

def bridge_rows(std: DataFrame, eq_map: DataFrame, products: dict[str, DataFrame | None]) -> DataFrame:
    """ER8 + ER9: one bridge row per source product with its official SKU.

    Bridge source codes follow each source's own rule (the Neo4j bridge keeps
    the raw sku, D14).  The service flag is set, as documented, for Supabase
    products with no SKU whose group received a generated SKU (D3).
    """
    m = eq_map.select("key_nombre", "key_categoria", "sku_oficial", "sku_origin")
    rows = std.join(m, ["key_nombre", "key_categoria"], "left")
    code = F.col("source_code")
    if products.get("neo4j") is not None:
        neo = products["neo4j"].select(F.col("id").alias("_nid"),
                                       F.coalesce(_blank_to_null(F.col("sku")), F.col("id")).alias("_raw"))
        rows = rows.join(neo, (rows.source == "neo4j") & (rows.seq_text == neo._nid), "left")
        code = F.when(F.col("source") == "neo4j", F.col("_raw")).otherwise(code)
    es_serv = ((F.col("source") == "supabase") & F.col("sku").isNull() & (F.col("sku_origin") == "generated"))
    return rows.select(
        F.col("source").alias("source_system"),
        F.coalesce(_blank_to_null(code), F.lit("Sin código")).alias("source_code"),
        F.coalesce(F.col("sku_oficial"), F.col("sku")).alias("sku_oficial"),
        F.col("nombre").alias("nombre_norm"),
        F.col("categoria").alias("categoria_norm"),
        es_serv.alias("es_servicio"),
        F.col("pos"))


# ------------------------------------------------------------- WN2 / JN21

# Source priority of the name+category bridge lookup.
NAME_LOOKUP_PRIORITY = ["mssql", "supabase"]


def best_bridge_by_name(names: DataFrame, bridge: DataFrame, nombre: str, categoria: str,
                        newest_col: str = "source_code") -> DataFrame:
    """WN2/JN21: SKU of the best bridge row whose lower(name), lower(category)
    equal the input's (no trim, as the lookup does): mssql first, then
    supabase, then any other source, newest (``newest_col`` desc) first.
    One aggregate per input key (map-side combined), then joined back."""
    rank = F.coalesce(*[F.when(F.col("source_system") == s, F.lit(i)) for i, s in enumerate(NAME_LOOKUP_PRIORITY)],
                      F.lit(len(NAME_LOOKUP_PRIORITY)))
    b = (bridge.where(F.col("sku_oficial").isNotNull() & (F.col("sku_oficial") != ""))
         .select(F.lower("nombre_norm").alias("_n"), F.lower("categoria_norm").alias("_c"), "sku_oficial",
                 rank.alias("_rank"), F.col(newest_col).alias("_newest")))
    # max of (-rank, newest): best priority first, then the newest row
    best = b.groupBy("_n", "_c").agg(
        F.max_by("sku_oficial", F.struct((-F.col("_rank")).alias("r"), F.col("_newest").alias("n"))).alias("_sku"))
    k = names.withColumn("_n", F.lower(F.col(nombre))).withColumn("_c", F.lower(F.col(categoria)))
    return k.join(best, ["_n", "_c"], "left").withColumnRenamed("_sku", "sku_por_nombre").drop("_n", "_c")
