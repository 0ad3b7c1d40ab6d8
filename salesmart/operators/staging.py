"""Per-source staging transforms (ST1-ST5, FL1-FL5, JN1-JN3, SE2).

Each source frame set becomes three shared shapes:

* ``clients``  -> stg_clientes columns (CLIENT_COLS)
* ``items``    -> stg_orden_items columns (ITEM_COLS) plus ``reject_reason``
                  (null for clean rows: the first failing rule otherwise)
* ``products`` -> the raw product frame handed to the equivalence step

Rejections are a column, not a side effect: ``split_rejects`` gives the
clean and the rejected frames from one pass.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import clean
from ..functions.country import country_codes, country_or_default
from .keys import lookup
from .merge import merge_insert_only

CLIENT_COLS = ["source_system", "source_code", "cliente_email", "cliente_nombre", "genero_raw",
               "pais_raw", "fecha_creado_raw", "fecha_creado_dt", "genero_norm", "seq"]
ITEM_COLS = ["source_system", "source_key_orden", "source_key_item", "source_code_prod", "cliente_key",
             "fecha_raw", "canal_raw", "moneda", "cantidad_raw", "precio_unit_raw", "total_raw",
             "fecha_dt", "cantidad_num", "precio_unit_num", "total_num", "line_total_num", "seq",
             "reject_reason"]

ITEM_KEYS = ["source_system", "source_key_orden", "source_key_item"]
CLIENT_KEYS = ["source_system", "source_code"]

# Default texts.
NO_CODE = "Sin código"
NO_EMAIL = "Sin correo"
MISSING_DATE_RAW = "1900-01-01"
NEO4J_CLIENT_DATE = "2024-06-01"


def _s(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _first_reason(*rules: tuple[Column, str]) -> Column:
    e = None
    for cond, reason in rules:
        cond = F.coalesce(cond, F.lit(False))
        e = F.when(cond, F.lit(reason)) if e is None else e.when(cond, F.lit(reason))
    return e if e is not None else F.lit(None).cast("string")


# ------------------------------------------------------------ SQL Server

def mssql_clients(src: dict[str, DataFrame]) -> DataFrame:
    c = src["Cliente"]
    return c.select(
        F.lit("mssql").alias("source_system"), _s("ClienteId").alias("source_code"),
        F.col("Email").alias("cliente_email"), F.col("Nombre").alias("cliente_nombre"),
        F.col("Genero").alias("genero_raw"), F.col("Pais").alias("pais_raw"),
        _s("FechaRegistro").alias("fecha_creado_raw"),
        F.to_date("FechaRegistro").alias("fecha_creado_dt"),
        clean.gender_exact("Genero").alias("genero_norm"),
        F.col("ClienteId").cast("long").alias("seq"))


def mssql_items(src: dict[str, DataFrame]) -> DataFrame:
    d = src["OrdenDetalle"]
    o = src["Orden"]
    j = d.join(o.select("OrdenId", "ClienteId", "Fecha", "Canal", "Moneda", F.lit(True).alias("_has_order")),
               "OrdenId", "left")
    total = clean.line_total_discount("Cantidad", "PrecioUnit", "DescuentoPct")
    return j.select(
        F.lit("mssql").alias("source_system"), _s("OrdenId").alias("source_key_orden"),
        _s("OrdenDetalleId").alias("source_key_item"), _s("ProductoId").alias("source_code_prod"),
        _s("ClienteId").alias("cliente_key"), _s("Fecha").alias("fecha_raw"),
        clean.channel_upper_default("Canal").alias("canal_raw"), F.col("Moneda").alias("moneda"),
        _s("Cantidad").alias("cantidad_raw"), _s("PrecioUnit").alias("precio_unit_raw"),
        total.cast("string").alias("total_raw"),
        F.to_date("Fecha").alias("fecha_dt"),
        F.col("Cantidad").cast("double").alias("cantidad_num"),
        F.col("PrecioUnit").cast("double").alias("precio_unit_num"),
        total.alias("total_num"), total.alias("line_total_num"),
        F.col("OrdenDetalleId").cast("long").alias("seq"),
        _first_reason((F.col("_has_order").isNull(), "orphan")).alias("reject_reason"))


# ----------------------------------------------------------------- MySQL

def mysql_clients(src: dict[str, DataFrame]) -> DataFrame:
    c = src["Cliente"]
    return c.select(
        F.lit("mysql").alias("source_system"), _s("id").alias("source_code"),
        F.col("correo").alias("cliente_email"), F.col("nombre").alias("cliente_nombre"),
        F.col("genero").alias("genero_raw"), F.col("pais").alias("pais_raw"),
        F.coalesce(F.when(F.col("created_at") != "", _s("created_at")), F.lit(MISSING_DATE_RAW)).alias("fecha_creado_raw"),
        clean.parse_date_mysql("created_at").alias("fecha_creado_dt"),
        clean.gender_mysql("genero").alias("genero_norm"),
        F.col("id").cast("long").alias("seq"))


def mysql_items(src: dict[str, DataFrame], run_date) -> DataFrame:
    d = src["OrdenDetalle"]
    o = src["Orden"].select(F.col("id").alias("orden_id"), "cliente_id", "fecha", "canal", "moneda",
                            F.lit(True).alias("_has_order"))
    p = src["Producto"].select(F.col("id").alias("producto_id"), "codigo_alt")
    # product side is a catalogue: let AQE broadcast it when small enough; orders
    # join last, so that lines of an order lie together and pack well
    j = d.join(p, "producto_id", "left").join(o, "orden_id", "left")
    qty = F.coalesce(F.when(F.col("cantidad") != 0, F.col("cantidad").cast("double")), F.lit(0.0))
    price = clean.parse_amount("precio_unit")
    total = qty * price
    return j.select(
        F.lit("mysql").alias("source_system"), _s("orden_id").alias("source_key_orden"),
        _s("id").alias("source_key_item"),
        F.coalesce(F.col("codigo_alt"), F.concat(F.lit("PROD-"), _s("producto_id"))).alias("source_code_prod"),
        _s("cliente_id").alias("cliente_key"), _s("fecha").alias("fecha_raw"),
        clean.channel_mysql("canal").alias("canal_raw"),
        F.coalesce(F.when(F.col("moneda") != "", F.col("moneda")), F.lit("USD")).alias("moneda"),
        _s("cantidad").alias("cantidad_raw"), _s("precio_unit").alias("precio_unit_raw"),
        total.cast("string").alias("total_raw"),
        clean.date_or_run_date(clean.parse_date_mysql("fecha"), run_date).alias("fecha_dt"),
        qty.alias("cantidad_num"), price.alias("precio_unit_num"),
        total.alias("total_num"), total.alias("line_total_num"),
        F.col("id").cast("long").alias("seq"),
        _first_reason((F.col("_has_order").isNull(), "orphan")).alias("reject_reason"))


# -------------------------------------------------------------- Supabase

def supabase_clients(src: dict[str, DataFrame], countries: DataFrame) -> DataFrame:
    c = country_codes(src["cliente"], "pais", "_iso", countries)
    fecha = clean.iso_local_date("fecha_registro")
    return c.select(
        F.lit("supabase").alias("source_system"), _s("cliente_id").alias("source_code"),
        F.col("email").alias("cliente_email"), F.col("nombre").alias("cliente_nombre"),
        F.coalesce(F.when(F.col("genero") != "", F.col("genero")), F.lit(clean.NOT_SPECIFIED)).alias("genero_raw"),
        country_or_default(F.col("_iso"), F.col("pais")).alias("pais_raw"),
        F.when(fecha.isNotNull(), F.col("fecha_registro")).otherwise(F.lit(MISSING_DATE_RAW)).alias("fecha_creado_raw"),
        fecha.alias("fecha_creado_dt"),
        clean.gender_letters_or_words("genero").alias("genero_norm"),
        F.lit(0).cast("long").alias("seq"))


def supabase_items(src: dict[str, DataFrame]) -> DataFrame:
    d = src["orden_detalle"]
    o = src["orden"].select(F.col("orden_id"), F.col("cliente_id"), F.col("fecha"), F.col("canal"),
                            F.col("moneda"), F.col("total"), F.lit(True).alias("_has_order"))
    p = src["producto"].select(F.col("producto_id"),
                               F.coalesce(F.when(F.col("sku") != "", F.col("sku")), _s("producto_id")).alias("_code"))
    j = d.join(p, "producto_id", "left").join(o, "orden_id", "left")
    fecha = clean.iso_local_date("fecha")
    qty = F.col("cantidad").cast("string").try_cast("double")
    price = F.col("precio_unit").cast("string").try_cast("double")
    total = F.coalesce(F.col("total").cast("string").try_cast("double"), F.lit(0.0))
    reason = _first_reason(
        (F.col("_has_order").isNull(), "orphan"),
        (F.col("fecha").isNull() | (F.col("fecha") == "") | fecha.isNull(), "bad_date"),
        (qty.isNull() | (qty <= 0), "bad_quantity"),
        (price.isNull(), "bad_price"),
        (F.col("producto_id").isNull() | (F.col("producto_id") == ""), "no_product_id"))
    return j.select(
        F.lit("supabase").alias("source_system"), _s("orden_id").alias("source_key_orden"),
        _s("orden_detalle_id").alias("source_key_item"),
        F.coalesce(F.when(F.col("_code") != "", F.col("_code")), F.lit(NO_CODE)).alias("source_code_prod"),
        _s("cliente_id").alias("cliente_key"), _s("fecha").alias("fecha_raw"),
        F.col("canal").alias("canal_raw"), F.col("moneda").alias("moneda"),
        _s("cantidad").alias("cantidad_raw"), _s("precio_unit").alias("precio_unit_raw"),
        _s("total").alias("total_raw"), fecha.alias("fecha_dt"),
        qty.alias("cantidad_num"), price.alias("precio_unit_num"),
        total.alias("total_num"), (qty * price).alias("line_total_num"),
        F.lit(0).cast("long").alias("seq"), reason.alias("reject_reason"))


# ----------------------------------------------------------------- Mongo

def mongo_clients(src: dict[str, DataFrame]) -> DataFrame:
    c = src["clientes"]
    return c.select(
        F.lit("mongo").alias("source_system"), _s("_id").alias("source_code"),
        F.col("email").alias("cliente_email"), F.col("nombre").alias("cliente_nombre"),
        F.col("genero").alias("genero_raw"), F.col("pais").alias("pais_raw"),
        F.coalesce(_s("creado"), F.lit(MISSING_DATE_RAW)).alias("fecha_creado_raw"),
        F.to_date("creado").alias("fecha_creado_dt"),
        clean.gender_exact("genero").alias("genero_norm"),
        F.lit(0).cast("long").alias("seq"))


def mongo_items(src: dict[str, DataFrame]) -> DataFrame:
    """ST4: one row per array element (``explode``: a null array gives no rows).

    The item key is the product id, so a product repeated in one order keeps
    only its first line (D12; SNK3 first-wins on ``seq`` = array position)."""
    o = src["ordenes"]
    x = o.select("_id", "cliente_id", "fecha", "canal", "moneda", "total",
                 F.posexplode("items").alias("pos", "it"))
    p = src["productos"].select(F.col("_id").alias("_pid"), F.col("codigo_mongo"))
    x = x.join(p, x["it.producto_id"] == p["_pid"], "left")
    qty = F.col("it.cantidad").cast("string").try_cast("double")
    price = F.col("it.precio_unit").cast("string").try_cast("double")
    total = F.col("total").cast("string").try_cast("double")
    pid = F.col("it.producto_id")
    reason = _first_reason(
        (F.col("fecha").isNull(), "no_date"),
        (qty.isNull() | (qty <= 0), "bad_quantity"),
        (price.isNull() | total.isNull(), "bad_price"),
        (pid.isNull() | (pid == ""), "no_product_id"),
        (F.col("codigo_mongo").isNull() | (F.col("codigo_mongo") == ""), "unknown_product"))
    return x.select(
        F.lit("mongo").alias("source_system"), _s("_id").alias("source_key_orden"),
        _s(pid).alias("source_key_item"), F.col("codigo_mongo").alias("source_code_prod"),
        _s("cliente_id").alias("cliente_key"), _s("fecha").alias("fecha_raw"),
        F.col("canal").alias("canal_raw"), F.col("moneda").alias("moneda"),
        _s("it.cantidad").alias("cantidad_raw"), _s("it.precio_unit").alias("precio_unit_raw"),
        _s("total").alias("total_raw"), F.to_date("fecha").alias("fecha_dt"),
        qty.alias("cantidad_num"), price.alias("precio_unit_num"),
        total.alias("total_num"), (qty * price).alias("line_total_num"),
        F.col("pos").cast("long").alias("seq"), reason.alias("reject_reason"))


# ----------------------------------------------------------------- Neo4j

def neo4j_clients(src: dict[str, DataFrame], countries: DataFrame) -> DataFrame:
    c = country_codes(src["Cliente"], "pais", "_iso", countries)
    return c.select(
        F.lit("neo4j").alias("source_system"), _s("id").alias("source_code"),
        F.lit(NO_EMAIL).alias("cliente_email"), F.col("nombre").alias("cliente_nombre"),
        F.coalesce(F.col("genero"), F.lit(clean.NOT_SPECIFIED)).alias("genero_raw"),
        country_or_default(F.col("_iso"), F.col("pais")).alias("pais_raw"),
        F.lit(NEO4J_CLIENT_DATE).alias("fecha_creado_raw"),
        F.lit(NEO4J_CLIENT_DATE).cast("date").alias("fecha_creado_dt"),
        clean.gender_letters_or_words("genero").alias("genero_norm"),
        F.lit(0).cast("long").alias("seq"))


def join_order_edges(realizo: DataFrame, contiene: DataFrame) -> DataFrame:
    """JN3: client->order and order->product edges joined on the order node.

    Orders with no client edge are dropped; with several, the last one wins
    (a per-order reduction before the join, so no row multiplication)."""
    r = realizo
    if "seq" not in r.columns:
        r = r.withColumn("seq", F.lit(0).cast("long"))
    last_client = (r.groupBy(F.col("to_id").alias("orden_id"))
                   .agg(F.max_by("from_id", F.struct("seq", "from_id")).alias("cliente_id")))
    c = contiene.withColumnRenamed("from_id", "orden_id").withColumnRenamed("to_id", "producto_id")
    if "seq" not in c.columns:
        c = c.withColumn("seq", F.lit(0).cast("long"))
    return c.join(last_client, "orden_id", "inner")


def neo4j_items(src: dict[str, DataFrame]) -> DataFrame:
    p = src["Producto"].select(F.col("id").alias("to_id"), F.col("sku").alias("_sku"))
    c = src["CONTIENE"].join(p, "to_id", "left")
    e = join_order_edges(src["REALIZO"], c)
    o = src["Orden"].select(F.col("id").alias("orden_id"), "fecha", "canal", "moneda", "total",
                            F.lit(True).alias("_has_order"))
    x = e.join(o, "orden_id", "left")
    qty = F.col("cantidad").cast("string").try_cast("double")
    price = F.col("precio_unit").cast("string").try_cast("double")
    total = F.col("total").cast("string").try_cast("double")
    raw_sku = F.coalesce(F.when(F.col("_sku") != "", F.col("_sku")), F.col("producto_id"))
    reason = _first_reason(
        (F.col("_has_order").isNull(), "orphan"),
        (F.col("fecha").isNull(), "bad_date"),
        (qty.isNull() | (qty <= 0), "bad_quantity"),
        (price.isNull() | total.isNull(), "bad_price"),
        (F.col("_sku").isNull() | F.col("producto_id").isNull(), "no_product"))
    return x.select(
        F.lit("neo4j").alias("source_system"), _s("orden_id").alias("source_key_orden"),
        clean.normalize_sku(raw_sku).alias("source_key_item"), raw_sku.alias("source_code_prod"),
        _s("cliente_id").alias("cliente_key"), _s("fecha").alias("fecha_raw"),
        F.col("canal").alias("canal_raw"), F.col("moneda").alias("moneda"),
        _s("cantidad").alias("cantidad_raw"), _s("precio_unit").alias("precio_unit_raw"),
        _s("total").alias("total_raw"), F.to_date("fecha").alias("fecha_dt"),
        qty.alias("cantidad_num"), price.alias("precio_unit_num"),
        total.alias("total_num"), (qty * price).alias("line_total_num"),
        F.col("seq").cast("long").alias("seq"), reason.alias("reject_reason"))


# ------------------------------------------------------------ composition

def product_frames(sources: dict[str, dict[str, DataFrame]]) -> dict[str, DataFrame | None]:
    names = {"mssql": "Producto", "mysql": "Producto", "supabase": "producto",
             "mongo": "productos", "neo4j": "Producto"}
    return {s: (sources[s][n] if s in sources else None) for s, n in names.items()}


def all_clients(sources: dict[str, dict[str, DataFrame]], countries: DataFrame) -> DataFrame:
    makers = {"mssql": mssql_clients, "mysql": mysql_clients,
              "supabase": lambda s: supabase_clients(s, countries), "mongo": mongo_clients,
              "neo4j": lambda s: neo4j_clients(s, countries)}
    frames = [makers[k](v).select(*CLIENT_COLS) for k, v in sources.items()]
    return reduce(lambda a, b: a.unionByName(b), frames)


def all_items(sources: dict[str, dict[str, DataFrame]], run_date) -> DataFrame:
    """SE2: union of the five staged item shapes (with reject reasons)."""
    makers = {"mssql": mssql_items, "mysql": lambda s: mysql_items(s, run_date),
              "supabase": supabase_items, "mongo": mongo_items, "neo4j": neo4j_items}
    frames = [makers[k](v).select(*ITEM_COLS) for k, v in sources.items()]
    return reduce(lambda a, b: a.unionByName(b), frames)


def split_rejects(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    return (items.where(F.col("reject_reason").isNull()),
            items.where(F.col("reject_reason").isNotNull()))


def stage_items(items: DataFrame, target: DataFrame | None = None) -> DataFrame:
    """SNK3 over clean rows: first row per (source, order, item) wins; only new keys."""
    ok, _ = split_rejects(items)
    return merge_insert_only(target, ok, ITEM_KEYS, "seq")


#: Repeated keys (8 bytes each) up to which their set is broadcast.
MAX_REPEATED = 2_000_000


def stage_landed_items(items: DataFrame, path: str) -> DataFrame:
    """``stage_items`` of written lines: only lines whose key comes again are grouped.

    Hashes of keys that occur more than once are written to ``path``; lines
    outside them are first of their key already and keep their place, so the
    wide rows are neither shuffled nor sorted.  A hash shared by two keys only
    sends both through the grouping, which goes by the keys themselves.  If too
    many keys repeat to broadcast them, all lines are grouped."""
    ok, _ = split_rejects(items)
    key = F.xxhash64(*ITEM_KEYS)
    repeated = ok.select(key.alias("_h")).groupBy("_h").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_h")
    repeated.write.mode("overwrite").parquet(path)
    repeated = items.sparkSession.read.schema("_h long").parquet(path)
    if repeated.count() > MAX_REPEATED:
        return stage_items(items)
    repeated = F.broadcast(repeated)
    ok = ok.withColumn("_h", key)
    once = ok.join(repeated, "_h", "left_anti").drop("_h")
    again = merge_insert_only(None, ok.join(repeated, "_h", "left_semi").drop("_h"), ITEM_KEYS, "seq")
    return once.unionByName(again)


#: Rows of 64 bits in which the hashes of new keys are marked; the whole set is broadcast.
WORDS = 1 << 20


def unstaged_items(items: DataFrame, staged: DataFrame, path: str) -> DataFrame:
    """SNK3 against an earlier run: lines of ``items`` whose key ``staged`` lacks.

    Only the keys of both sides are shuffled to find the new ones; their hashes are
    marked in a bit set of bounded size, written to ``path``.  Lines of both sides
    that meet a mark are then compared by the keys themselves, so the wide rows of
    other lines keep their place, and lines that share a mark are told apart."""
    had = lookup(staged.select(*ITEM_KEYS))
    new = items.select(*ITEM_KEYS).join(had, ITEM_KEYS, "left_anti")
    h = F.xxhash64(*ITEM_KEYS)
    word, bit = F.pmod(F.shiftright(h, 6), F.lit(WORDS)), h.bitwiseAND(F.lit(63)).cast("int")
    marks = new.select(word.alias("_w"), F.call_function("shiftleft", F.lit(1).cast("long"), bit).alias("_b")).groupBy("_w").agg(F.bit_or("_b").alias("_b"))
    marks.write.mode("overwrite").option("compression", "zstd").parquet(path)
    marks = F.broadcast(items.sparkSession.read.schema("_w long, _b long").parquet(path))

    def marked(df):
        hit = F.call_function("shiftrightunsigned", F.col("_b"), bit).bitwiseAND(F.lit(1)) == 1
        return df.join(marks, word == F.col("_w")).where(hit).select(*df.columns, "_w")
    # the mark is a key too, else Spark would compare all lines before it looks at marks
    return marked(items).join(marked(staged.select(*ITEM_KEYS)), [*ITEM_KEYS, "_w"], "left_anti").drop("_w")


def collapsed_items(items: DataFrame) -> DataFrame:
    """D12 report: how many clean lines were dropped as repeated item keys."""
    ok, _ = split_rejects(items)
    return (ok.groupBy(*ITEM_KEYS).agg(F.count(F.lit(1)).alias("n"))
            .where("n > 1").groupBy("source_system")
            .agg(F.sum(F.col("n") - 1).alias("collapsed_lines")))
