"""Order views, nested orders, reference checks and order changes
(JN13-JN17, JN20, AG13-AG17, CH1-CH4, SE3, FL17-FL18).

Per-order work is keyed by the order id: ``collect_list`` nests at most one
order's lines (bounded by the order size), and change batches are applied
with anti joins on the order key - no per-row loop, no driver round trip.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import clean


def orden_completa(orden: DataFrame, detalle: DataFrame, producto: DataFrame, cliente: DataFrame) -> DataFrame:
    """JN16: order x line x product x client, all inner (Supabase view)."""
    d = detalle.select("orden_detalle_id", "orden_id", "producto_id", "cantidad", "precio_unit")
    o = orden.select("orden_id", "cliente_id", "fecha", "canal", "moneda", "total")
    p = producto.select("producto_id", F.col("nombre").alias("producto_nombre"), "sku")
    c = cliente.select("cliente_id", F.col("nombre").alias("cliente_nombre"), "email")
    return (d.join(o, "orden_id").join(p, "producto_id").join(c, "cliente_id")
            .withColumn("subtotal", (F.col("cantidad") * F.col("precio_unit")).cast("decimal(18,2)")))


def graph_order_lines(orden: DataFrame, realizo: DataFrame, contiene: DataFrame, producto: DataFrame,
                      pertenece: DataFrame | None = None, categoria: DataFrame | None = None) -> DataFrame:
    """JN13: Cliente-Orden path plus OPTIONAL Orden-Producto-Categoria half."""
    o = orden.join(realizo.select(F.col("to_id").alias("id"), F.col("from_id").alias("cliente_id")), "id")
    lines = contiene.select(F.col("from_id").alias("id"), F.col("to_id").alias("producto_id"), "cantidad",
                            "precio_unit", *(["seq"] if "seq" in contiene.columns else []))
    p = producto.select(F.col("id").alias("producto_id"), F.col("nombre").alias("producto_nombre"), "sku")
    lines = lines.join(p, "producto_id", "left")
    if pertenece is not None and categoria is not None:
        pc = pertenece.join(categoria.select(F.col("id").alias("to_id"), F.col("nombre").alias("categoria")), "to_id")
        lines = lines.join(pc.select(F.col("from_id").alias("producto_id"), "categoria"), "producto_id", "left")
    return o.join(lines, "id", "left")


def graph_orders_page(orden: DataFrame, realizo: DataFrame, contiene: DataFrame, producto: DataFrame, pertenece: DataFrame,
                      categoria: DataFrame, page: int = 1, limit: int = 20, newest: bool = False) -> DataFrame:
    """JN13 with its paging: orders that have a client are cut to one page by date (SO2), then expanded.

    Only the page's lines meet products and categories.  A line whose product
    or category is absent does not count; an order without any line keeps one row with nulls.
    """
    o = orden.join(realizo.select(F.col("to_id").alias("id"), F.col("from_id").alias("cliente_id")), "id")
    by = [F.col("fecha").desc(), F.col("id").desc()] if newest else [F.col("fecha").asc(), F.col("id").asc()]
    one = o.orderBy(*by).offset((page - 1) * limit).limit(limit)
    lines = one.select(F.col("id").alias("_id")).join(contiene, F.col("_id") == F.col("from_id"))
    lines = lines.join(producto.select(F.col("id").alias("to_id"), F.col("nombre").alias("producto_nombre")), "to_id")
    belongs = pertenece.select(F.col("from_id").alias("to_id"), F.col("to_id").alias("categoria_id"))
    lines = lines.join(belongs, "to_id").join(categoria.select(F.col("id").alias("categoria_id"), F.col("nombre").alias("categoria")), "categoria_id")
    lines = lines.select("_id", F.col("to_id").alias("producto_id"), "producto_nombre", "categoria", "cantidad", "precio_unit",
                         (F.col("cantidad") * F.col("precio_unit")).alias("subtotal"), *(["seq"] if "seq" in contiene.columns else []))
    return one.join(lines, F.col("id") == F.col("_id"), "left").drop("_id")


def include_related(parents: DataFrame, children: DataFrame, key: str, item_cols: list[str], order_by: str, name: str = "items") -> DataFrame:
    """JN20: ``parents`` plus ``name``, the array of their children (structs of ``item_cols``, by ``order_by``; empty if there are none).

    Two calls nest two levels: the inner one's array is a column like any other
    of the children.  A parent's array is one cell, so page the parents first.
    """
    item = F.struct(F.col(order_by).alias("_o"), F.struct(*item_cols).alias("v"))
    arrays = children.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(item)), lambda x: x["v"]).alias(name))
    kind = dict(arrays.dtypes)[name]
    return parents.join(arrays, key, "left").withColumn(name, F.coalesce(name, F.array().cast(kind)))


def nested_orders(lines: DataFrame, order_cols: list[str], item_cols: list[str], seq_col: str | None = None) -> DataFrame:
    """AG16: one row per order with its items as an array of structs (orders
    without items keep an empty array); AG13 total = sum(qty * price)."""
    item = F.struct(*[F.col(c) for c in ([seq_col] if seq_col else []) + item_cols])
    has_item = F.col(item_cols[0]).isNotNull()
    g = lines.groupBy(*order_cols).agg(
        F.array_sort(F.collect_list(F.when(has_item, item))).alias("items"),
        F.sum((F.col("cantidad") * F.col("precio_unit")).cast("decimal(18,2)")).alias("items_total"))
    return g.withColumn("items", F.coalesce("items", F.array())).withColumn("n_items", F.size("items"))


def merge_repeated_products(lines: DataFrame, order_col: str, product_col: str, seq_col: str) -> DataFrame:
    """AG15: repeated product inside one order -> quantity summed, first price kept."""
    return (lines.groupBy(order_col, product_col)
            .agg(F.sum("cantidad").alias("cantidad"), F.min_by("precio_unit", F.col(seq_col)).alias("precio_unit")))


def total_mismatches(orders: DataFrame, lines: DataFrame, key: str, total_col: str, line_total: F.Column,
                     tolerance: float = 0.01, keep_all: bool = False) -> DataFrame:
    """AG14: stored order total vs sum of its lines, beyond a tolerance
    (``keep_all``: every order, flagged in ``descuadre``).  An order without
    lines should have a total of 0 (``sin_lineas`` marks it), one without a
    total matches no sum."""
    s = lines.groupBy(key).agg(F.coalesce(F.sum(line_total), F.lit(0)).alias("_lines"))
    j = orders.select(key, F.col(total_col).alias("_stored")).join(s, key, "left")
    j = j.withColumn("sin_lineas", F.col("_lines").isNull()).withColumn("_lines", F.coalesce("_lines", F.lit(0)))
    j = j.withColumn("descuadre", F.coalesce(F.abs(F.col("_stored") - F.col("_lines")) > tolerance, F.lit(True)))
    return j if keep_all else j.where("descuadre")


def missing_references(requested: DataFrame, existing: DataFrame, col: str, existing_col: str | None = None) -> DataFrame:
    """JN17 / SE3 / SE4: distinct requested ids (string, trimmed) that do not exist."""
    r = requested.select(F.trim(F.col(col).cast("string")).alias(col)).distinct()
    e = existing.select(F.trim(F.col(existing_col or col).cast("string")).alias(col))
    return r.join(e, col, "left_anti")


def duplicate_products(orders_items: DataFrame, items_col: str = "items", id_field: str = "producto_id") -> DataFrame:
    """FL18: orders listing one product twice."""
    ids = F.transform(F.col(items_col), lambda x: x[id_field])
    return orders_items.where(F.size(F.array_distinct(ids)) < F.size(ids))


def apply_order_changes(orders: DataFrame, lines: DataFrame, events: DataFrame, key: str = "orden_id",
                        total_col: str = "total", qty: str = "cantidad", price: str = "precio_unit",
                        line_id: str = "orden_detalle_id") -> tuple[DataFrame, DataFrame, DataFrame]:
    """CH1-CH3 as one batch.

    ``events``: (op create|update|delete, orden_id, header columns..., items
    array<struct>).  The last event per order wins (``seq`` column).

    * create: a new header and its lines; an id that exists is rejected.
    * update: header values given by the event replace the stored ones, all lines are replaced.
    * delete: order and lines go.  Update or delete of an unknown id is rejected.
    * create and update: the total, where orders have one and items a price, is the
      sum of quantity x price of the items (0 without items); new lines get the id ``<order>-<position>``.
    * Any other op is rejected.

    Returns (orders, lines, rejects)."""
    from .merge import _dedup
    ev = _dedup(events, [key], "seq", last=True)     # map-side combined, not a per-order window
    known = orders.select(key).withColumn("_known", F.lit(True))
    ev = ev.join(known, key, "left")
    is_known = F.col("_known").isNotNull()
    reason = (F.when(F.col("op").isin("update", "delete") & ~is_known, F.lit("unknown_order"))
              .when((F.col("op") == "create") & is_known, F.lit("existing_order"))
              .when(F.col("op").isNull() | ~F.col("op").isin("create", "update", "delete"), F.lit("unknown_op")))
    ev = ev.withColumn("_motivo", reason)
    rejects = ev.where(F.col("_motivo").isNotNull()).select(key, "op", F.col("_motivo").alias("motivo"))
    ok = ev.where(F.col("_motivo").isNull())
    written_ev = ok.where(F.col("op") != "delete")
    header_cols = [c for c in orders.columns if c != key]
    item_type = events.schema["items"].dataType
    total = F.lit(None).cast("double")
    if total_col in header_cols and {qty, price} <= set(item_type.elementType.names):
        total = F.aggregate(F.coalesce("items", F.array().cast(item_type)), F.lit(0).cast("double"),
                            lambda acc, x: acc + F.coalesce((x[qty] * x[price]).cast("double"), F.lit(0.0)))
    given = [c for c in header_cols if c in events.columns and c != total_col]
    e = written_ev.select(F.col(key), *[F.col(c).alias(f"_e_{c}") for c in given], total.alias("_e_total"))
    stored = orders.select(key, *[F.col(c).alias(f"_o_{c}") for c in header_cols])
    j = e.join(stored, key, "left")
    types = {f.name: f.dataType for f in orders.schema.fields}
    new_orders = j.select(key, *[
        (F.col("_e_total").cast(types[c]) if c == total_col
         else F.coalesce(F.col(f"_e_{c}"), F.col(f"_o_{c}")) if c in given else F.col(f"_o_{c}")).alias(c) for c in header_cols])
    new_lines = (written_ev.select(key, F.posexplode("items").alias("_pos", "_it")).select(key, "_pos", "_it.*"))
    if line_id in lines.columns and line_id not in new_lines.columns:
        new_lines = new_lines.withColumn(line_id, F.concat_ws("-", F.col(key).cast("string"), F.col("_pos") + 1))
    touched = ok.select(key)
    out_orders = orders.join(touched, key, "left_anti").unionByName(new_orders)
    out_lines = lines.join(touched, key, "left_anti").unionByName(new_lines.drop("_pos"), allowMissingColumns=True)
    return out_orders, out_lines, rejects


def next_order_ids(existing_ids: DataFrame, new_orders: DataFrame, order_cols: list[str], id_col: str = "id",
                   prefix: str = "ORD-", width: int = 6) -> DataFrame:
    """CH4 + WN4: sequential ids after the current maximum order number,
    keeping prefix and width."""
    from .keys import global_row_number
    mx = existing_ids.agg(F.coalesce(F.max(clean.order_number(F.col(id_col))), F.lit(0))).first()[0]   # a scalar
    n = global_row_number(new_orders, order_cols, "_k")
    return (n.withColumn("nuevo_id", F.concat(F.lit(prefix), F.format_string(f"%0{width}d", F.lit(mx) + F.col("_k"))))
            .drop("_k"))


# Order payload domains per source (FL17).
PAYLOAD_CHANNELS = {"mongo": ["WEB", "TIENDA"], "supabase": ["WEB", "APP", "PARTNER"],
                    "neo4j": ["WEB", "TIENDA", "APP", "PARTNER"]}
PAYLOAD_CURRENCIES = {"mongo": ["CRC"], "supabase": ["USD", "CRC"], "neo4j": ["USD", "CRC"]}


def payload_rules(source: str, items_col: str = "items", qty: str = "cantidad", price: str = "precio_unit"):
    """FL17: at least one item, qty >= 1, price >= 0, channel and currency in the source's enums."""
    it = F.col(items_col)
    return [
        ("sin_items", it.isNull() | (F.size(it) < 1)),
        ("cantidad_invalida", F.exists(F.coalesce(it, F.array()), lambda x: x[qty] < 1)),
        ("precio_invalido", F.exists(F.coalesce(it, F.array()), lambda x: x[price] < 0)),
        ("canal_invalido", ~F.col("canal").isin(PAYLOAD_CHANNELS[source])),
        ("moneda_invalida", ~F.col("moneda").isin(PAYLOAD_CURRENCIES[source])),
    ]


def valid_order_ids(df: DataFrame, col: str = "id") -> DataFrame:
    """FL9: ids shaped 'ORD-<digits>' or 'O<digits>' (anchored, like a whole-string match)."""
    return df.where(F.col(col).rlike(r"^(ORD-\d+|O\d+)$"))


def validate_against_bridge(products: DataFrame, bridge: DataFrame, sku: str, nombre: str, categoria: str) -> DataFrame:
    """JN22: does (SKU, name, category) exist in the bridge, case-insensitive?"""
    b = (bridge.select(F.lower("sku_oficial").alias("_s"), F.lower("nombre_norm").alias("_n"),
                       F.lower("categoria_norm").alias("_c")).distinct()   # SE4
         .withColumn("valido", F.lit(True)))
    k = (products.withColumn("_s", F.lower(F.col(sku))).withColumn("_n", F.lower(F.col(nombre)))
         .withColumn("_c", F.lower(F.col(categoria))))
    return (k.join(b, ["_s", "_n", "_c"], "left").withColumn("valido", F.coalesce("valido", F.lit(False)))
            .drop("_s", "_n", "_c"))


def order_by_id(orden: DataFrame, realizo: DataFrame, contiene: DataFrame, producto: DataFrame,
                order_id: str) -> DataFrame:
    """JN14: one order's full path (client, lines, products), every hop mandatory."""
    o = orden.where(F.col("id") == order_id)
    r = realizo.select(F.col("to_id").alias("id"), F.col("from_id").alias("cliente_id"))
    lines = contiene.select(F.col("from_id").alias("id"), F.col("to_id").alias("producto_id"), "cantidad",
                            "precio_unit")
    p = producto.select(F.col("id").alias("producto_id"), F.col("nombre").alias("producto_nombre"))
    return o.join(r, "id").join(lines, "id").join(p, "producto_id")
