"""Bulk upload of the four sheets (BL1-BL5, FL15-FL16, JN18-JN19, AG19).

The upload is all-or-nothing: violations and unresolved references are
computed first as DataFrames; only when both are empty are the merged
tables produced (and the caller publishes them to new version folders).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.validate import violations
from .merge import merge_overwrite

EMAIL_RE = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"

# SQL Server bulk domains.
MSSQL_GENDERS = ["Masculino", "Femenino"]
MSSQL_CHANNELS = ["WEB", "TIENDA", "APP"]
# MySQL bulk domains.
MYSQL_GENDERS = ["M", "F", "X"]
MYSQL_CURRENCIES = ["USD", "CRC"]


def _len_gt(c: str, n: int):
    return F.length(F.col(c)) > n


def _text(code: str, c: str, longest: int):
    """A required text of 1 to ``longest`` characters; a blank one counts as absent."""
    return [(f"{code}_requerido", F.col(c).isNull() | (F.trim(F.col(c)) == "")), (f"{code}_largo", _len_gt(c, longest))]


def _email(code: str, c: str, required: bool):
    bad = ~F.col(c).rlike(EMAIL_RE)
    return (f"{code}_invalido", F.col(c).isNull() | bad if required else F.col(c).isNotNull() & bad)


# Fixed values in the rules below: codes, lengths, enums and bounds of the upload sheets.

def client_rules_mssql():
    return [
        *_text("nombre", "Nombre", 120),
        _email("email", "Email", False), ("email_largo", _len_gt("Email", 150)),
        ("genero_invalido", F.col("Genero").isNotNull() & ~F.col("Genero").isin(MSSQL_GENDERS)),
        *_text("pais", "Pais", 60),
    ]


def product_rules_mssql():
    return [*_text("sku", "SKU", 40), *_text("nombre", "Nombre", 150), *_text("categoria", "Categoria", 80)]


def order_rules_mssql():
    return [
        _email("email", "Email", True),
        ("canal_invalido", F.col("Canal").isNull() | ~F.col("Canal").isin(MSSQL_CHANNELS)),
        ("moneda_invalida", F.col("Moneda").isNotNull() & (F.length(F.col("Moneda")) != 3)),
        ("total_invalido", F.col("Total").isNull() | (F.col("Total") <= 0)),
    ]


def line_rules_mssql():
    return [
        ("orden_index_invalido", F.col("OrdenIndex").isNull() | (F.col("OrdenIndex") < 1)),
        *_text("sku", "SKU", 40),
        ("cantidad_invalida", F.col("Cantidad").isNull() | (F.col("Cantidad") <= 0)),
        ("precio_invalido", F.col("PrecioUnit").isNull() | (F.col("PrecioUnit") <= 0)),
        ("descuento_invalido", F.col("DescuentoPct").isNotNull()
         & ((F.col("DescuentoPct") < 0) | (F.col("DescuentoPct") > 100))),
    ]


def client_rules_mysql():
    return [
        *_text("nombre", "nombre", 120),
        _email("correo", "correo", False), ("correo_largo", _len_gt("correo", 150)),
        ("genero_invalido", ~F.coalesce(F.col("genero"), F.lit("M")).isin(MYSQL_GENDERS)),
        *_text("pais", "pais", 60),
    ]


def product_rules_mysql():
    return [*_text("codigo", "codigo_alt", 64), *_text("nombre", "nombre", 150), *_text("categoria", "categoria", 80)]


def order_rules_mysql():
    """Amounts are text here: any present total passes, whatever it says."""
    return [
        _email("correo", "correo", True),
        *_text("canal", "canal", 20),
        ("moneda_invalida", ~F.coalesce(F.col("moneda"), F.lit("USD")).isin(MYSQL_CURRENCIES)),
        ("total_requerido", F.col("total").isNull()),
    ]


def line_rules_mysql():
    return [
        ("orden_index_invalido", F.col("OrdenIndex").isNull() | (F.col("OrdenIndex") < 1)),
        *_text("codigo", "codigo_alt", 64),
        ("cantidad_invalida", F.col("cantidad").isNull() | (F.col("cantidad") <= 0)),
        ("precio_requerido", F.col("precio_unit").isNull()),
    ]


def sheet_violations(df: DataFrame, rules, row_col: str = "_row") -> DataFrame:
    """FL15/FL16: rows with at least one violated rule and the rule codes."""
    return (df.withColumn("violaciones", violations(rules))
            .where(F.size("violaciones") > 0).select(row_col, "violaciones"))


def resolve_emails(orders: DataFrame, batch_clients: DataFrame | None, stored_clients: DataFrame,
                   email_col: str, id_col: str, latest: bool) -> DataFrame:
    """JN18 + WN3: client id for each order email - same upload first, then
    the stored table (latest id per email when duplicates are allowed)."""
    st = stored_clients.where(F.col(email_col).isNotNull())
    st = (st.groupBy(email_col).agg((F.max if latest else F.min)(id_col).alias("_stored_id")))
    o = orders.join(st, email_col, "left")
    if batch_clients is not None:
        b = batch_clients.where(F.col(email_col).isNotNull()).groupBy(email_col).agg(F.max(id_col).alias("_batch_id"))
        o = o.join(b, email_col, "left")
    else:
        o = o.withColumn("_batch_id", F.lit(None).cast("long"))
    return o.withColumn("cliente_id", F.coalesce("_batch_id", "_stored_id")).drop("_batch_id", "_stored_id")


def upsert_clients_by_email(stored: DataFrame, upload: DataFrame, key_col: str = "Email",
                            id_col: str = "ClienteId", keep_cols=("FechaRegistro",)) -> tuple[DataFrame, DataFrame]:
    """BL1: rows with an email update the stored row of that email (``keep_cols``
    stay as stored) or insert; rows without email always insert.  The last
    upload row of an email wins.  Returns (new table, per-row action)."""
    from .keys import global_row_number
    cols = stored.columns
    keep = [c for c in keep_cols if c in cols]
    from .merge import _dedup
    named = upload.where(F.col(key_col).isNotNull())
    with_email = _dedup(named, [key_col], "_row", last=True)
    # of a repeated new email the first row inserts and later rows only update: kept columns come from the first
    up_keep = [c for c in keep if c in upload.columns]
    if up_keep:
        first = named.groupBy(key_col).agg(*[F.min_by(c, "_row").alias(f"_first_{c}") for c in up_keep])
        with_email = with_email.join(first, key_col)
        for c in up_keep:
            with_email = with_email.withColumn(c, F.col(f"_first_{c}")).drop(f"_first_{c}")
    st = stored.where(F.col(key_col).isNotNull()).groupBy(key_col).agg(F.min(id_col).alias("_sid"))
    matched = with_email.join(st, key_col, "left")
    updates = (matched.where(F.col("_sid").isNotNull()).drop(*keep)
               .join(stored.select(F.col(id_col).alias("_sid"), *keep), "_sid")
               .withColumn(id_col, F.col("_sid")))
    inserts = matched.where(F.col("_sid").isNull()).unionByName(
        upload.where(F.col(key_col).isNull()), allowMissingColumns=True)
    max_id = stored.agg(F.coalesce(F.max(id_col), F.lit(0))).first()[0]     # a scalar
    inserts = (global_row_number(inserts, ["_row"], "_k", files=True)
               .withColumn(id_col, (F.lit(max_id) + F.col("_k")).cast(stored.schema[id_col].dataType)))
    kept = stored.join(updates.select(id_col), id_col, "left_anti")
    new_table = kept.unionByName(updates.select(*cols)).unionByName(inserts.select(*cols))
    actions = (updates.select("_row", F.lit("actualizado").alias("accion"))
               .unionByName(inserts.select("_row", F.lit("insertado").alias("accion"))))
    return new_table, actions


def append_clients(stored: DataFrame, upload: DataFrame, id_col: str = "id", defaults: dict | None = None) -> DataFrame:
    """BL2: every uploaded client becomes a new row, also with an e-mail that is
    stored already; ids follow the largest one in the order of ``_row``.
    ``defaults`` fill missing values.  Orders of the upload find their client
    by ``resolve_emails`` (the last of an e-mail wins)."""
    from .keys import global_row_number
    new = upload
    for c, v in (defaults or {}).items():
        new = new.withColumn(c, F.coalesce(F.col(c), F.lit(v)) if c in upload.columns else F.lit(v))
    max_id = stored.agg(F.coalesce(F.max(id_col), F.lit(0))).first()[0]     # a scalar
    new = (global_row_number(new, ["_row"], "_k", files=True)
           .withColumn(id_col, (F.lit(max_id) + F.col("_k")).cast(stored.schema[id_col].dataType)))
    return stored.unionByName(new.select(*[c for c in stored.columns if c in new.columns]), allowMissingColumns=True)


def upsert_products(stored: DataFrame, upload: DataFrame, key_col: str, id_col: str) -> tuple[DataFrame, DataFrame]:
    """BL3: a stored product of the same ``key_col`` (SKU or codigo_alt) keeps its
    id and takes the values of the last uploaded row; other keys get new ids,
    by the first row that names them.  Returns (new table, per-key action)."""
    from .keys import global_row_number
    last = merge_overwrite(None, upload, [key_col], "_row").drop("_row", id_col)
    first = upload.groupBy(key_col).agg(F.min("_row").alias("_first"))
    j = last.join(first, key_col).join(stored.select(key_col, F.col(id_col).alias("_sid")), key_col, "left")
    updates = j.where(F.col("_sid").isNotNull()).withColumn(id_col, F.col("_sid"))
    max_id = stored.agg(F.coalesce(F.max(id_col), F.lit(0))).first()[0]     # a scalar
    inserts = (global_row_number(j.where(F.col("_sid").isNull()), ["_first"], "_k", files=True)
               .withColumn(id_col, (F.lit(max_id) + F.col("_k")).cast(stored.schema[id_col].dataType)))
    kept = stored.join(updates.select(key_col), key_col, "left_anti").select(*stored.columns)
    # columns the upload does not have stay as stored
    own = [c for c in stored.columns if c not in upload.columns and c != id_col]
    updates = updates.join(stored.select(key_col, *own), key_col) if own else updates
    table = kept.unionByName(updates.select(*stored.columns)).unionByName(
        inserts.select(*[c for c in stored.columns if c in inserts.columns]), allowMissingColumns=True)
    actions = (updates.select(key_col, F.lit("actualizado").alias("accion"))
               .unionByName(inserts.select(key_col, F.lit("insertado").alias("accion"))))
    return table, actions
