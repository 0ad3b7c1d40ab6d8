"""Multi-sheet bulk upload as one job: references, appended rows, and the gate before the commit (BL4, BL5).

The four sheets are frames with ``_row``, the position key of a row in its
sheet.  Nothing is written row by row: new ids are positions in sheet order
after the largest stored id, an order's id follows from its row index, and
lines find their order by that index without a join.  ``load_upload`` only
publishes if one aggregate over rule violations and missing references is empty.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bulk, versions
from .keys import global_row_number

SHEETS = ("Cliente", "Producto", "Orden", "OrdenDetalle")


@dataclass(frozen=True)
class Flavour:
    """Column names, rules and client policy of one kind of upload."""

    client_id: str
    email: str
    product_id: str
    code: str
    order_id: str
    order_client: str
    date: str
    currency: str
    line_id: str
    line_order: str
    line_product: str
    append_clients: bool                       # every client row is new (else upsert by e-mail)
    rules: dict[str, Callable] = field(hash=False)


MSSQL = Flavour("ClienteId", "Email", "ProductoId", "SKU", "OrdenId", "ClienteId", "Fecha", "Moneda", "OrdenDetalleId", "OrdenId", "ProductoId",
                False, {"Cliente": bulk.client_rules_mssql, "Producto": bulk.product_rules_mssql, "Orden": bulk.order_rules_mssql,
                        "OrdenDetalle": bulk.line_rules_mssql})
MYSQL = Flavour("id", "correo", "id", "codigo_alt", "id", "cliente_id", "fecha", "moneda", "id", "orden_id", "producto_id",
                True, {"Cliente": bulk.client_rules_mysql, "Producto": bulk.product_rules_mysql, "Orden": bulk.order_rules_mysql,
                       "OrdenDetalle": bulk.line_rules_mysql})


def _after(stored: DataFrame, id_col: str, position: Column) -> Column:
    """``position`` after the largest stored id, in the id's own type."""
    largest = stored.agg(F.coalesce(F.max(id_col), F.lit(0))).first()[0]     # a scalar
    return (F.lit(largest) + position).cast(stored.schema[id_col].dataType)


def append_orders(stored: DataFrame, sheet: DataFrame, clients_before: DataFrame, uploaded: DataFrame | None, f: Flavour, now: str,
                  currency: str = "USD") -> DataFrame:
    """BL4: the order sheet with ``OrdenIndex`` (1-based row of the sheet), new ids and client ids (null where no client has the e-mail).

    A client of the same upload comes before a stored one (``uploaded``: id and
    e-mail of the upload's clients, the last of an e-mail counts).  A missing
    date is ``now``, a missing currency ``currency``.
    """
    indexed = global_row_number(sheet, ["_row"], "OrdenIndex", files=True)
    named = bulk.resolve_emails(indexed.drop("cliente_id"), uploaded, clients_before, f.email, f.client_id, latest=f.append_clients)
    out = named.withColumn("_client", F.col("cliente_id").cast(stored.schema[f.order_client].dataType)).drop("cliente_id")
    kind = stored.schema[f.date].dataType
    return out.withColumns({
        f.order_id: _after(stored, f.order_id, F.col("OrdenIndex")), f.order_client: F.col("_client"),
        f.date: F.coalesce(F.col(f.date).cast(kind), F.lit(now).cast(kind)),
        f.currency: F.coalesce(F.col(f.currency), F.lit(currency))}).drop("_client")


def append_lines(stored: DataFrame, sheet: DataFrame, orders_before: DataFrame, n_orders: int, products: DataFrame, f: Flavour) -> DataFrame:
    """BL4: the line sheet with new ids, the id of its order by row index and of its product by code (null where there is none)."""
    known = F.col("OrdenIndex").between(1, n_orders)
    code = products.select(F.col(f.code).alias("_code"), F.col(f.product_id).alias("_product"))
    found = sheet.join(code, sheet[f.code] == F.col("_code"), "left").drop("_code")
    out = global_row_number(found, ["_row"], "_k", files=True)
    return out.withColumns({
        f.line_order: F.when(known, _after(orders_before, f.order_id, F.col("OrdenIndex"))),
        f.line_product: F.col("_product"), f.line_id: _after(stored, f.line_id, F.col("_k"))}).drop("_product", "_k")


def prepare_upload(stored: dict[str, DataFrame], sheets: dict[str, DataFrame], f: Flavour, now: str) -> dict[str, DataFrame]:
    """The tables after the upload, the rows it appends (``nuevas_Orden``, ``nuevas_OrdenDetalle``) and why it may not
    be published (``rechazos``: hoja, motivo, filas; empty if it may)."""
    empty = {s: stored[s].limit(0).withColumn("_row", F.lit(0).cast("long")) for s in SHEETS}
    sheet = {s: sheets.get(s) if sheets.get(s) is not None else empty[s] for s in SHEETS}
    out: dict[str, DataFrame] = {}
    # clients
    if "Cliente" not in sheets:
        out["Cliente"], uploaded = stored["Cliente"], None
    else:
        if f.append_clients:
            out["Cliente"] = bulk.append_clients(stored["Cliente"], sheet["Cliente"], f.client_id)
            new = out["Cliente"].join(stored["Cliente"].select(f.client_id), f.client_id, "left_anti")
        else:
            out["Cliente"], _ = bulk.upsert_clients_by_email(stored["Cliente"], sheet["Cliente"], f.email, f.client_id)
            new = out["Cliente"].join(sheet["Cliente"].select(f.email).distinct(), f.email, "left_semi")
        uploaded = new.select(f.client_id, f.email)
    # products
    out["Producto"] = stored["Producto"] if "Producto" not in sheets else \
        bulk.upsert_products(stored["Producto"], sheet["Producto"], f.code, f.product_id)[0]
    # orders and lines
    orders = append_orders(stored["Orden"], sheet["Orden"].drop(f.order_id, f.order_client), stored["Cliente"], uploaded, f, now)
    n_orders = sheet["Orden"].count()
    lines = append_lines(stored["OrdenDetalle"], sheet["OrdenDetalle"].drop(f.line_id, f.line_order, f.line_product), stored["Orden"],
                         n_orders, out["Producto"], f)
    out["nuevas_Orden"], out["nuevas_OrdenDetalle"] = orders, lines
    for name, new in (("Orden", orders), ("OrdenDetalle", lines)):
        cols = [c for c in stored[name].columns if c in new.columns]
        out[name] = stored[name].unionByName(new.select(*cols), allowMissingColumns=True)
    # why not: broken rules of the sheets, and references that lead nowhere
    reasons = [bulk.sheet_violations(sheet[s], f.rules[s]()).select(F.lit(s).alias("hoja"), F.explode("violaciones").alias("motivo"))
               for s in SHEETS if s in sheets]
    reasons += [orders.where(F.col(f.order_client).isNull()).select(F.lit("Orden").alias("hoja"), F.lit("cliente_no_encontrado").alias("motivo")),
                lines.where(F.col(f.line_order).isNull()).select(F.lit("OrdenDetalle").alias("hoja"), F.lit("orden_no_encontrada").alias("motivo")),
                lines.where(F.col(f.line_product).isNull()).select(F.lit("OrdenDetalle").alias("hoja"), F.lit("producto_no_encontrado").alias("motivo"))]
    out["rechazos"] = (reduce(lambda x, y: x.unionByName(y), reasons).groupBy("hoja", "motivo").agg(F.count(F.lit(1)).alias("filas")))
    return out


def load_upload(spark: SparkSession, base: str, current: str, sheets: dict[str, DataFrame], f: Flavour, now: str) -> tuple[str, DataFrame]:
    """BL5: publish the upload as one new version, or nothing of it.

    Returns the manifest that holds afterwards (``current`` itself if the upload
    was refused) and the reasons, read back from a table written once.
    """
    version = versions.read_version(spark, current)
    stored = {s: versions.version_table(spark, version, s) for s in SHEETS}
    done = prepare_upload(stored, sheets, f, now)
    path = versions.publish(done["rechazos"], base, "rechazos")
    reasons = spark.read.schema(done["rechazos"].schema).parquet(path)
    if not reasons.isEmpty():
        return current, reasons
    return versions.commit(spark, base, {s: done[s] for s in SHEETS}, current), reasons
