"""Queries for bulk loads, their gate, and resets, with their SQL (registered by ``queries``)."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from ..operators import upload, versions
from ..session import work_path
from ..sources import fixtures
from .etl import warehouse_tables

NOW = "2001-08-01 00:00:00"
FLAVOURS = {"mssql": (0, upload.MSSQL), "mysql": (1, upload.MYSQL)}


def _frame(spark, sf_dir, name):
    return fixtures.read_table(spark, sf_dir, name)


def upload_sheets(spark, sf_dir, stored: dict, source: str, good: bool) -> dict:
    """An upload of every order of a source as new orders, with client and product sheets.

    A quarter of the clients come under the e-mail they have, a quarter under a
    new one; a sixth of the products are renamed, some that the source lacks
    are added.  The bad upload keeps what the good one leaves out: orders whose
    client has no e-mail, lines of products nobody has; and has quantities of 0.
    """
    k, f = FLAVOURS[source]
    mine = lambda c: fixtures.src_index(F.col(c)) == k
    email = lambda c: F.when(F.col(c) % 4 == 1, F.concat(F.lit("nuevo"), F.col(c).cast("string"), F.lit("@correo.test"))).otherwise(
        fixtures.email_of(F.col(c)))
    customers = _frame(spark, sf_dir, "customer").where(mine("c_custkey") & (F.col("c_custkey") % 4).isin(0, 1))
    ms = source == "mssql"
    genders = ["Masculino", "Femenino"] if ms else ["M", "F"]
    clients = customers.select(
        F.col("c_custkey").cast("long").alias("_row"), F.upper("c_name").alias("Nombre" if ms else "nombre"), email("c_custkey").alias(f.email),
        F.when(F.col("c_custkey") % 2 == 0, genders[0]).otherwise(genders[1]).alias("Genero" if ms else "genero"),
        F.lit("CR").alias("Pais" if ms else "pais"),
        F.lit("2001-01-01").cast(stored["Cliente"].schema["FechaRegistro" if ms else "created_at"].dataType).alias("FechaRegistro" if ms else "created_at"))
    p = F.col("p_partkey")
    present = fixtures.present_in(p, k)
    code = fixtures.sku_of(p) if ms else F.concat(F.lit("ALT-"), p.cast("string"))
    products = _frame(spark, sf_dir, "part").where((present & (p % 6 == 0)) | (~present & (p % 6 == 1))).select(
        p.cast("long").alias("_row"), code.alias(f.code), F.upper("p_name").alias("Nombre" if ms else "nombre"),
        F.col("p_type").alias("Categoria" if ms else "categoria"))
    oc = F.col(f.order_client)
    no_client = (oc % 7 == 0) & (oc % 4).isin(2, 3) if not ms else F.lit(False)
    orders = stored["Orden"].where(~no_client) if good else stored["Orden"]
    sheet_orders = orders.select(
        F.col(f.order_id).cast("long").alias("_row"), email(f.order_client).alias(f.email),
        F.when(F.col(f.order_id) % 9 == 0, F.lit(None)).otherwise(F.col(f.date)).alias(f.date),
        F.col("Canal" if ms else "canal"), F.when(F.col(f.order_id) % 5 == 0, F.lit(None)).otherwise(F.col(f.currency)).alias(f.currency),
        F.col("Total" if ms else "total"))
    if ms:       # this flavour only takes three channels
        sheet_orders = sheet_orders.withColumn("Canal", F.when(F.col("Canal").isin("TIENDA", "APP"), F.col("Canal")).otherwise("WEB"))
    from ..operators.keys import global_row_number
    index = global_row_number(sheet_orders.select(F.col("_row").alias("_ok")), ["_ok"], "OrdenIndex", files=True)
    q = "Cantidad" if ms else "cantidad"
    lp = F.col(f.line_product)
    has_product = fixtures.present_in(lp, k) | (lp % 6 == 1)
    lines = stored["OrdenDetalle"].join(index, F.col(f.line_order) == F.col("_ok"))
    lines = lines.where(has_product) if good else lines
    line_code = fixtures.sku_of(lp) if ms else F.concat(F.lit("ALT-"), lp.cast("string"))
    amount = F.col(q) if good else F.when(F.col(f.line_id) % 50 == 0, F.lit(0)).otherwise(F.col(q))
    sheet_lines = lines.select(F.col(f.line_id).cast("long").alias("_row"), "OrdenIndex", line_code.alias(f.code), amount.alias(q),
                               *(["PrecioUnit", "DescuentoPct"] if ms else ["precio_unit"]))
    return {"Cliente": clients, "Producto": products, "Orden": sheet_orders, "OrdenDetalle": sheet_lines}


def _stored(spark, sf_dir, source):
    from .etl import source_tables
    t = source_tables(spark, sf_dir, FLAVOURS)[source]
    return {s: t[s] for s in upload.SHEETS}


def bulk_orders_load(spark, sf_dir):
    """BL4 (JN18, JN19): every order that a bulk upload appends, with its client, lines and units, for both flavours."""
    out = None
    for source, (_, f) in FLAVOURS.items():
        stored = _stored(spark, sf_dir, source)
        done = upload.prepare_upload(stored, upload_sheets(spark, sf_dir, stored, source, True), f, NOW)
        q = "Cantidad" if source == "mssql" else "cantidad"
        lines = done["nuevas_OrdenDetalle"].select(
            F.col(f.line_order).alias("orden_id"), F.col(f.line_id).alias("_l"), F.col(f.line_product).alias("_p"), F.col(q).alias("_q"))
        per = lines.groupBy("orden_id").agg(F.count(F.lit(1)).alias("lineas"), F.sum("_q").cast("long").alias("unidades"),
                                            F.min("_l").alias("linea_min"), F.max("_l").alias("linea_max"), F.max("_p").alias("producto_max"))
        orders = done["nuevas_Orden"].select(
            F.lit(source).alias("fuente"), F.col(f.order_id).alias("orden_id"), F.col(f.order_client).alias("cliente_id"),
            F.col(f.date).cast("string").substr(1, 10).alias("dia"), F.col(f.currency).alias("moneda"))
        part = orders.join(per, "orden_id", "left").select("fuente", "orden_id", "cliente_id", "dia", "moneda", "lineas", "unidades", "linea_min",
                                                           "linea_max", "producto_max")
        out = part if out is None else out.unionByName(part)
    return out


def _uploads(spark, sf_dir):
    """[(source, upload, manifest before, manifest after, reasons)] of a bad and then a good upload of each flavour, the flavours side by side."""
    def uploads(source):
        f, out = FLAVOURS[source][1], []
        stored = _stored(spark, sf_dir, source)
        base = work_path(spark, f"upload_{source}_{uuid.uuid4().hex}")
        current = versions.commit(spark, base, stored)
        for name, good in (("mala", False), ("buena", True)):
            after, reasons = upload.load_upload(spark, base, current, upload_sheets(spark, sf_dir, stored, source, good), f, NOW)
            out.append((source, name, current, after, reasons))
            current = after
        return out
    with ThreadPoolExecutor(max_workers=len(FLAVOURS)) as ex:
        return [x for done in ex.map(uploads, FLAVOURS) for x in done]


def bulk_upload_gate(spark, sf_dir):
    """BL5: a bad and a good upload against the same version; rows of each table after either, read through the manifest."""
    parts = []
    for source, name, before, after, _ in _uploads(spark, sf_dir):
        version = versions.read_version(spark, after)
        for table in upload.SHEETS:
            rows = versions.version_table(spark, version, table)
            parts.append(rows.agg(F.count(F.lit(1)).alias("filas")).select(
                F.lit(source).alias("fuente"), F.lit(name).alias("carga"), F.lit(after != before).alias("aceptada"),
                F.lit(table).alias("tabla"), "filas"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def bulk_upload_rejects(spark, sf_dir):
    """BL5: why the bad upload of each flavour was refused, by sheet and reason."""
    out = None
    for source, name, _, _, reasons in _uploads(spark, sf_dir):
        part = reasons.select(F.lit(source).alias("fuente"), F.lit(name).alias("carga"), "hoja", "motivo", "filas")
        out = part if out is None else out.unionByName(part)
    return out


def warehouse_resets(spark, sf_dir):
    """SNK6 + SNK7: rows of each table after both kinds of warehouse reset, a full staging reset and the reset of one source."""
    w = warehouse_tables(spark, sf_dir)
    names = ["stg_orden_items", "stg_clientes", "map_producto", "tipo_cambio", "dim_tiempo", "dim_cliente", "dim_producto", "fact_ventas"]
    base = work_path(spark, f"resets_{uuid.uuid4().hex}")
    first = versions.commit(spark, base, {}, folders={n: w.folder(n) for n in names})
    after = {"utility": versions.reset_warehouse(spark, base, first, "utility")[0], "full": versions.reset_warehouse(spark, base, first, "full")[0],
             "staging": versions.reset_staging(spark, base, first), "staging_mysql": versions.reset_staging(spark, base, first, "mysql")}
    out = None
    for kind, manifest in after.items():
        version = versions.read_version(spark, manifest)
        for n in names:
            part = versions.version_table(spark, version, n).agg(F.count(F.lit(1)).alias("filas")).select(
                F.lit(kind).alias("reinicio"), F.lit(n).alias("tabla"), "filas")
            out = part if out is None else out.unionByName(part)
    return out


QUERIES = {"bulk_orders_load": bulk_orders_load, "bulk_upload_gate": bulk_upload_gate, "bulk_upload_rejects": bulk_upload_rejects,
           "warehouse_resets": warehouse_resets}

# ------------------------------------------------------------------ SQL

_UPLOAD_CTE = """
src(k, fuente) AS (VALUES (0, 'mssql'), (1, 'mysql')),
has(k, p, code_new) AS (
  SELECT k, p_partkey, p_partkey % 6 = 1 FROM part, src
  WHERE CASE WHEN p_partkey % 97 = 0 THEN k = 1 WHEN p_partkey % 97 = 1 THEN k = 2 ELSE p_partkey % 10 <> k END),
added AS (
  SELECT src.k, p_partkey AS p, row_number() OVER (PARTITION BY src.k ORDER BY p_partkey) AS n
  FROM part, src WHERE p_partkey % 6 = 1 AND NOT EXISTS (SELECT 1 FROM has WHERE has.k = src.k AND has.p = p_partkey)),
prods AS (
  SELECT k, p, CAST(p AS BIGINT) AS id FROM has
  UNION ALL
  SELECT added.k, p, (SELECT max(p) FROM has h WHERE h.k = added.k) + n FROM added),
cust AS (
  SELECT c_custkey AS ck, CAST(c_custkey % 5 AS INTEGER) AS k, c_custkey % 4 AS r,
         c_custkey % 5 = 1 AND c_custkey % 7 = 0 AS nameless FROM customer WHERE c_custkey % 5 IN (0, 1)),
top_client AS (SELECT k, max(ck) AS m FROM cust GROUP BY k),
new_client AS (
  SELECT cust.k, ck, m + row_number() OVER (PARTITION BY cust.k ORDER BY ck) AS id
  FROM cust JOIN top_client USING (k) WHERE CASE WHEN cust.k = 0 THEN r = 1 ELSE r IN (0, 1) END),
client AS (
  SELECT cust.k, cust.ck, CASE WHEN n.id IS NOT NULL THEN n.id WHEN NOT nameless THEN cust.ck END AS id
  FROM cust LEFT JOIN new_client n ON n.k = cust.k AND n.ck = cust.ck),
ords AS (
  SELECT o_orderkey AS ok, o_orderdate AS d, o_custkey AS ck, CAST(o_custkey % 5 AS INTEGER) AS k, client.id AS cid
  FROM orders LEFT JOIN client ON client.ck = o_custkey WHERE o_custkey % 5 IN (0, 1)),
lns AS (
  SELECT lx.*, ok * 10 + line_id AS line_key FROM lx WHERE src IN (0, 1))
"""

def _with(body: str) -> str:
    from .oracle import LINES_CTE
    return "WITH " + LINES_CTE.strip() + ",\n" + _UPLOAD_CTE.strip() + "\n" + body


def oracle() -> dict[str, str]:
    """The SQL of these queries (built late: it shares the line rules of ``oracle``)."""
    from .oracle import CUST_CTE, ORACLE, PRESENT_CTE, with_all, with_lines
    counts = {"stg_orden_items": with_lines("SELECT count(*) AS n, count(*) FILTER (WHERE src = 1) AS mine FROM staged"),
              "stg_clientes": with_all("SELECT count(*) AS n, count(*) FILTER (WHERE src = 1) AS mine FROM cz", CUST_CTE),
              "map_producto": with_all("SELECT count(*) AS n, count(*) FILTER (WHERE k = 1) AS mine FROM pres", PRESENT_CTE)}
    counts |= {t: f"SELECT count(*) AS n, 0 AS mine FROM ({ORACLE[t]})" for t in ("tipo_cambio", "dim_tiempo", "dim_cliente", "dim_producto", "fact_ventas")}
    before = " UNION ALL ".join(f"SELECT '{t}' AS tabla, n, mine FROM ({q})" for t, q in counts.items())
    return {
        "warehouse_resets": f"""
WITH antes AS ({before}), r(reinicio) AS (VALUES ('utility'), ('full'), ('staging'), ('staging_mysql'))
SELECT reinicio, tabla, CAST(CASE
    WHEN reinicio = 'full' THEN 0
    WHEN reinicio = 'utility' AND tabla IN ('fact_ventas', 'dim_producto', 'dim_cliente', 'dim_tiempo') THEN 0
    WHEN reinicio = 'staging' AND tabla IN ('stg_orden_items', 'stg_clientes', 'map_producto') THEN 0
    WHEN reinicio = 'staging_mysql' THEN n - mine ELSE n END AS BIGINT) AS filas
FROM antes, r
""",
        "bulk_orders_load": _with("""
, sheet AS (
  SELECT *, (SELECT max(ok) FROM ords o WHERE o.k = ords.k) + row_number() OVER (PARTITION BY k ORDER BY ok) AS oid FROM ords WHERE cid IS NOT NULL),
sl AS (
  SELECT s.k, s.oid, l.qty, prods.id AS pid,
    (SELECT max(line_key) FROM lns x WHERE x.src = l.src) + row_number() OVER (PARTITION BY l.src ORDER BY l.line_key) AS lid
  FROM lns l JOIN sheet s ON s.ok = l.ok JOIN prods ON prods.k = l.src AND prods.p = l.p)
SELECT src.fuente, CAST(s.oid AS INTEGER) AS orden_id, CAST(s.cid AS INTEGER) AS cliente_id,
  CASE WHEN s.ok % 9 = 0 THEN '2001-08-01' ELSE strftime(s.d, '%Y-%m-%d') END AS dia,
  CASE WHEN s.ok % 5 = 0 OR s.k = 0 OR s.ok % 2 = 0 THEN 'USD' ELSE 'CRC' END AS moneda,
  a.lineas, a.unidades, a.linea_min, a.linea_max, a.producto_max
FROM sheet s JOIN src USING (k) LEFT JOIN (
  SELECT k, oid, count(*) AS lineas, CAST(sum(qty) AS BIGINT) AS unidades, CAST(min(lid) AS INTEGER) AS linea_min,
         CAST(max(lid) AS INTEGER) AS linea_max, CAST(max(pid) AS INTEGER) AS producto_max FROM sl GROUP BY 1, 2) a ON a.k = s.k AND a.oid = s.oid
"""),
        "bulk_upload_gate": _with("""
, good AS (
  SELECT k, (SELECT count(*) FROM new_client n WHERE n.k = src.k) AS c, (SELECT count(*) FROM added a WHERE a.k = src.k) AS p,
    (SELECT count(*) FROM ords o WHERE o.k = src.k AND cid IS NOT NULL) AS o,
    (SELECT count(*) FROM lns l JOIN ords o ON o.ok = l.ok JOIN prods ON prods.k = l.src AND prods.p = l.p WHERE l.src = src.k AND cid IS NOT NULL) AS d
  FROM src),
was AS (
  SELECT k, (SELECT count(*) FROM cust c WHERE c.k = src.k) AS c, (SELECT count(*) FROM has h WHERE h.k = src.k) AS p,
    (SELECT count(*) FROM ords o WHERE o.k = src.k) AS o, (SELECT count(*) FROM lns l WHERE l.src = src.k) AS d FROM src),
both_ AS (
  SELECT k, 'mala' AS carga, false AS aceptada, c, p, o, d FROM was
  UNION ALL SELECT k, 'buena', true, was.c + good.c, was.p + good.p, was.o + good.o, was.d + good.d FROM was JOIN good USING (k))
SELECT fuente, carga, aceptada, unnest(['Cliente', 'Producto', 'Orden', 'OrdenDetalle']) AS tabla, unnest([c, p, o, d]) AS filas
FROM both_ JOIN src USING (k)
"""),
        "bulk_upload_rejects": _with("""
SELECT fuente, 'mala' AS carga, hoja, motivo, filas FROM (
  SELECT k, 'Orden' AS hoja, 'cliente_no_encontrado' AS motivo, count(*) AS filas FROM ords WHERE cid IS NULL GROUP BY k
  UNION ALL
  SELECT src, 'OrdenDetalle', 'producto_no_encontrado', count(*) FROM lns l
  WHERE NOT EXISTS (SELECT 1 FROM prods WHERE prods.k = l.src AND prods.p = l.p) GROUP BY 1
  UNION ALL
  SELECT src, 'OrdenDetalle', 'cantidad_invalida', count(*) FROM lns WHERE line_key % 50 = 0 GROUP BY 1
) t JOIN src USING (k)
"""),
    }
