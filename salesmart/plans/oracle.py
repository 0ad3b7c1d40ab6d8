"""DuckDB oracle SQL for the registered queries.

Computed from the raw given tables with the fixture rules written out in
SQL, so the oracle shares no parsing/formatting path with the Spark job
(no money text, no date text, no equivalence step): it states directly
which line ends up in the fact and with which amount.
"""

from __future__ import annotations

# Lines with their order, source, currency, catalogue presence, rate and
# amounts, as the fixture rules define them.
LINES_CTE = """
li AS (
  SELECT l.*, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey,
         l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate, l_returnflag, l_linestatus) AS line_id
  FROM lineitem l
),
ln AS (
  SELECT li.l_orderkey AS ok, li.line_id, li.l_partkey AS p, CAST(li.l_quantity AS INTEGER) AS qty,
         CAST(floor(li.l_extendedprice * 100 / li.l_quantity) AS BIGINT) AS cents, li.l_discount,
         o.o_custkey AS ck, CAST(o.o_orderdate AS DATE) AS d,
         CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER) AS prio,
         CAST(o.o_custkey % 5 AS INTEGER) AS src
  FROM li JOIN orders o ON li.l_orderkey = o.o_orderkey
),
lx AS (
  SELECT ln.*,
    ['mssql','mysql','supabase','mongo','neo4j'][src + 1] AS fuente,
    CASE WHEN src = 0 THEN 'USD' WHEN src = 3 THEN 'CRC' WHEN ok % 2 = 1 THEN 'CRC' ELSE 'USD' END AS cur,
    CASE WHEN p % 97 = 0 THEN src = 1 WHEN p % 97 = 1 THEN src = 2 ELSE p % 10 <> src END AS present,
    CASE WHEN dayofyear(d) % 37 = 0 THEN NULL ELSE CAST(500 + dayofyear(d) % 50 AS DOUBLE) END AS rate,
    CASE WHEN src = 0 AND line_id % 3 <> 0 THEN CAST(CAST(round(l_discount * 100) AS DECIMAL(5,2)) AS DOUBLE)
         ELSE 0.0 END AS pct,
    ['WEB','TIENDA','APP','PARTNER','WEB'][prio] AS canal
  FROM ln
),
lp AS (
  SELECT lx.*,
    CASE WHEN cur = 'CRC' THEN CAST(cents * 5 AS DOUBLE)
         ELSE CAST(CAST(cents / 100.0 AS DECIMAL(18,2)) AS DOUBLE) END AS price,
    row_number() OVER (PARTITION BY ok, p, present ORDER BY line_id) AS dup_rank
  FROM lx
),
staged AS (
  -- mongo / neo4j: absent products are rejected and a repeated product keeps its first line
  SELECT lp.*, CAST(qty AS DOUBLE) * price * (1 - pct / 100.0) AS line_total
  FROM lp
  WHERE NOT (src IN (3, 4) AND (NOT present OR dup_rank > 1))
),
fact AS (
  SELECT staged.*,
    CAST(CASE WHEN cur = 'CRC' THEN line_total / rate ELSE line_total END AS DECIMAL(18,6)) AS total_usd,
    CAST(CASE WHEN cur = 'CRC' THEN price / rate ELSE price END AS DECIMAL(18,6)) AS price_usd,
    CAST(year(d) AS INTEGER) AS anio, CAST(month(d) AS INTEGER) AS mes
  FROM staged
  WHERE present AND (cur <> 'CRC' OR rate IS NOT NULL)
),
parts AS (
  SELECT p_partkey AS p, concat_ws(' ', p_name, p_brand, CAST(p_partkey AS VARCHAR)) AS nm, p_type AS cat,
         CASE WHEN p_partkey % 97 IN (0, 1) THEN row_number() OVER (
              PARTITION BY (p_partkey % 97 IN (0, 1)) ORDER BY p_partkey % 97, p_partkey) END AS gen_rank
  FROM part
),
prod AS (
  SELECT p, cat,
    CASE WHEN gen_rank IS NOT NULL THEN printf('SKU-%04d', gen_rank)
         ELSE 'SKU-' || CAST(1000 + p AS VARCHAR) END AS sku,
    CASE WHEN p % 97 = 0 THEN upper(nm)
         WHEN p % 97 = 1 THEN '  ' || nm || '  '
         WHEN p % 10 <> 0 THEN nm
         WHEN p % 10 <> 4 THEN nm
         ELSE upper(nm) END AS nombre,
    (p % 97 = 1) AS es_servicio
  FROM parts
)
"""


def with_lines(body: str) -> str:
    return "WITH " + LINES_CTE.strip() + "\n" + body


ORACLE: dict[str, str] = {}

ORACLE["vw_ventas_mensuales"] = with_lines("""
SELECT f.anio AS Anio, f.mes AS Mes, pr.sku AS SKU, pr.nombre AS Producto, pr.cat AS Categoria,
       CAST(sum(f.qty) AS DOUBLE) AS Qty, CAST(round(sum(f.total_usd), 2) AS DOUBLE) AS VentasUSD
FROM fact f JOIN prod pr ON f.p = pr.p
GROUP BY 1, 2, 3, 4, 5
""")


# ------------------------------------------------------------------ helpers

SRC_NAMES = "['mssql','mysql','supabase','mongo','neo4j']"

# parts present per source, with the bridge row each source writes
PRESENT_CTE = """
srcs AS (SELECT * FROM (VALUES (0, 'mssql'), (1, 'mysql'), (2, 'supabase'), (3, 'mongo'), (4, 'neo4j')) t(k, s)),
pres AS (
  SELECT pr.p, pr.cat, pr.sku, pr.nombre AS dim_nombre, pr.es_servicio, pa.nm, srcs.k, srcs.s,
    CASE srcs.k WHEN 0 THEN CAST(pr.p AS VARCHAR)
                WHEN 1 THEN 'ALT-' || CAST(pr.p AS VARCHAR)
                WHEN 2 THEN CASE WHEN pr.p % 97 = 1 OR pr.p % 10 = 5
                                 THEN '00000000-0000-0000-0000-' || printf('%012d', pr.p)
                                 ELSE 'SKU-' || CAST(1000 + pr.p AS VARCHAR) END
                WHEN 3 THEN 'MN-' || CAST(4000 + pr.p AS VARCHAR)
                ELSE 'SKU' || CAST(1000 + pr.p AS VARCHAR) END AS source_code,
    CASE srcs.k WHEN 1 THEN upper(pa.nm) WHEN 2 THEN '  ' || pa.nm || '  ' ELSE pa.nm END AS nombre_norm,
    (srcs.k = 2 AND pr.p % 97 = 1) AS es_serv_row
  FROM prod pr JOIN parts pa ON pr.p = pa.p CROSS JOIN srcs
  WHERE CASE WHEN pr.p % 97 = 0 THEN srcs.k = 1 WHEN pr.p % 97 = 1 THEN srcs.k = 2 ELSE pr.p % 10 <> srcs.k END
)
"""

CUST_CTE = """
cu AS (
  SELECT c_custkey AS ck, c_name, c_nationkey, CAST(c_custkey % 5 AS INTEGER) AS src FROM customer
),
cx AS (
  SELECT cu.*,
    """ + SRC_NAMES + """[src + 1] AS source_system,
    CASE src WHEN 2 THEN '00000000-0000-0000-0000-' || printf('%012d', ck) WHEN 3 THEN printf('%024d', ck)
             WHEN 4 THEN printf('C%05d', ck) ELSE CAST(ck AS VARCHAR) END AS source_code,
    CASE WHEN src = 4 THEN 'Sin correo' WHEN src = 1 AND ck % 7 = 0 THEN NULL
         ELSE 'cliente' || CAST(ck AS VARCHAR) || '@correo.test' END AS cliente_email,
    ['Masculino', 'Femenino', 'No especificado'][CAST(ck % 3 AS INTEGER) + 1] AS genero_norm,
    ['Costa Rica', 'México', 'Spain', 'Panama', 'Estados Unidos', 'Korea', 'United States', 'CR'][CAST(c_nationkey % 8 AS INTEGER) + 1] AS pais0,
    CASE WHEN src = 4 THEN DATE '2024-06-01' ELSE CAST(DATE '1995-01-01' + CAST(ck % 2000 AS INTEGER) AS DATE) END AS fecha_creado_dt
  FROM cu
),
cz AS (
  SELECT cx.*,
    CASE WHEN src IN (2, 4) THEN CASE pais0 WHEN 'Costa Rica' THEN 'CR' WHEN 'Spain' THEN 'ES' WHEN 'Panama' THEN 'PA'
                                             WHEN 'Korea' THEN 'KR' WHEN 'United States' THEN 'US' WHEN 'CR' THEN 'CD'
                                             ELSE pais0 END
         ELSE pais0 END AS pais_raw
  FROM cx
),
dimc AS (
  SELECT cz.*, row_number() OVER (ORDER BY source_system, source_code) AS cliente_id FROM cz
)
"""

# fact rows with their business keys (client, SourceKey, transaction id)
FACTK_CTE = """
factk AS (
  SELECT f.*, pr.sku, pr.cat, pr.nombre AS producto,
    CASE f.src WHEN 2 THEN '00000000-0000-0000-0000-' || printf('%012d', f.ck) WHEN 3 THEN printf('%024d', f.ck)
               WHEN 4 THEN printf('C%05d', f.ck) ELSE CAST(f.ck AS VARCHAR) END AS client_key,
    CASE f.src WHEN 2 THEN '00000000-0000-0000-0000-' || printf('%012d', f.ok) WHEN 3 THEN printf('%024d', f.ok)
               WHEN 4 THEN printf('ORD-%06d', f.ok) ELSE CAST(f.ok AS VARCHAR) END AS txn,
    CASE f.src WHEN 2 THEN '00000000-0000-0000-0000-' || printf('%012d', f.ok) || '-' || '00000000-0000-0000-0000-' || printf('%012d', f.ok * 10 + f.line_id)
               WHEN 3 THEN printf('%024d', f.ok) || '-' || printf('%024d', f.p)
               WHEN 4 THEN printf('ORD-%06d', f.ok) || '-SKU-' || CAST(1000 + f.p AS VARCHAR)
               ELSE CAST(f.ok AS VARCHAR) || '-' || CAST(f.ok * 10 + f.line_id AS VARCHAR) END AS source_key,
    CAST(strftime(f.d, '%Y%m%d') AS INTEGER) AS tiempo_id
  FROM fact f JOIN prod pr ON f.p = pr.p
)
"""


def with_all(body: str, *ctes: str) -> str:
    parts = [LINES_CTE.strip()] + [c.strip() for c in ctes]
    return "WITH " + ",\n".join(parts) + "\n" + body


ORACLE["equivalence_map"] = with_lines("""
SELECT lower(pa.nm) AS key_nombre, lower(pa.cat) AS key_categoria, pr.sku AS sku_oficial,
       CASE WHEN pa.p % 97 IN (0, 1) THEN 'generated' WHEN pa.p % 10 <> 0 THEN 'mssql' ELSE 'supabase' END AS sku_origin
FROM parts pa JOIN prod pr ON pa.p = pr.p
""")

ORACLE["equivalence_stats"] = with_all("""
SELECT (SELECT count(*) FROM parts) AS total_products,
  count(*) FILTER (WHERE k = 0) AS in_mssql, count(*) FILTER (WHERE k = 1) AS in_mysql,
  count(*) FILTER (WHERE k = 2) AS in_supabase, count(*) FILTER (WHERE k = 3) AS in_mongo,
  count(*) FILTER (WHERE k = 4) AS in_neo4j,
  (SELECT count(*) FROM parts WHERE p % 97 NOT IN (0, 1) AND p % 10 <> 0) AS sku_from_mssql,
  (SELECT count(*) FROM parts WHERE p % 97 NOT IN (0, 1) AND p % 10 = 0) AS sku_from_supabase,
  CAST(0 AS BIGINT) AS sku_from_mongo, CAST(0 AS BIGINT) AS sku_from_neo4j,
  (SELECT count(*) FROM parts WHERE p % 97 IN (0, 1)) AS sku_from_generated
FROM pres
""", PRESENT_CTE)

ORACLE["map_producto"] = with_all("""
SELECT s AS source_system, source_code, sku AS sku_oficial, nombre_norm, cat AS categoria_norm, es_serv_row AS es_servicio
FROM pres
""", PRESENT_CTE)

ORACLE["stg_clientes"] = with_all("""
SELECT source_system, source_code, cliente_email, c_name AS cliente_nombre, genero_norm, pais_raw, fecha_creado_dt
FROM cz
""", CUST_CTE)

ORACLE["rejects_by_reason"] = with_lines("""
SELECT fuente AS source_system,
  CASE WHEN src = 3 AND NOT present THEN 'unknown_product' WHEN src = 4 AND NOT present THEN 'no_product'
       ELSE 'ok' END AS motivo, count(*) AS filas
FROM lx GROUP BY 1, 2
""")

ORACLE["staging_stats_items"] = with_lines("""
SELECT fuente AS source_system, cur AS moneda, count(*) AS lineas, count(DISTINCT ok) AS ordenes,
  CAST(round(sum(CAST(line_total AS DECIMAL(18,6))), 2) AS DOUBLE) AS monto
FROM staged GROUP BY 1, 2
""")

ORACLE["staging_stats_bridge"] = with_all("""
SELECT s AS source_system, count(*) AS productos, count(DISTINCT sku) AS skus_distintos,
  CAST(sum(CAST(es_serv_row AS BIGINT)) AS BIGINT) AS servicios
FROM pres GROUP BY 1
""", PRESENT_CTE)

ORACLE["staging_stats_clients"] = with_all("""
SELECT source_system, count(*) AS clientes, count(DISTINCT cliente_email) AS emails_distintos,
  count(DISTINCT pais_raw) AS paises_distintos
FROM cz GROUP BY 1
""", CUST_CTE)

RATE_DAYS_CTE = """
rb AS (SELECT CAST(min(o_orderdate) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) AS hi FROM orders),
rdays AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS fecha FROM rb),
rates AS (
  SELECT fecha, CAST(500 + dayofyear(fecha) % 50 AS DOUBLE) AS buy, CAST(510 + dayofyear(fecha) % 50 AS DOUBLE) AS sell
  FROM rdays WHERE dayofyear(fecha) % 37 <> 0
)
"""

ORACLE["tipo_cambio"] = with_all("""
SELECT fecha, 'CRC' AS de, 'USD' AS a, buy AS tasa FROM rates
UNION ALL
SELECT fecha, 'USD' AS de, 'CRC' AS a, sell AS tasa FROM rates
""", RATE_DAYS_CTE)

ORACLE["dim_tiempo"] = with_all("""
SELECT CAST(strftime(days.Fecha, '%Y%m%d') AS INTEGER) AS TiempoID, days.Fecha AS Fecha, CAST(year(days.Fecha) AS INTEGER) AS Anio,
       CAST(month(days.Fecha) AS INTEGER) AS Mes, CAST(day(days.Fecha) AS INTEGER) AS Dia, r.buy AS TC_CRC_USD, r.sell AS TC_USD_CRC
FROM days LEFT JOIN rates r ON r.fecha = days.Fecha
""", RATE_DAYS_CTE, CUST_CTE, """
bounds AS (
  SELECT least((SELECT min(d) FROM staged), (SELECT min(fecha_creado_dt) FROM cz)) AS lo,
         greatest((SELECT max(d) FROM staged), (SELECT max(fecha_creado_dt) FROM cz)) AS hi
),
days AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS Fecha FROM bounds)
""")

ORACLE["dim_cliente"] = with_all("""
SELECT cliente_id AS ClienteID, source_system AS SourceSystem, source_code AS SourceKey, genero_norm AS Genero,
       pais_raw AS Pais, CAST(strftime(fecha_creado_dt, '%Y%m%d') AS INTEGER) AS FechaCreacionID
FROM dimc
""", CUST_CTE)

DIMP_CTE = """
dimp0 AS (
  SELECT *, row_number() OVER (PARTITION BY sku ORDER BY CASE k WHEN 0 THEN 0 WHEN 4 THEN 1 WHEN 1 THEN 2
                                                               WHEN 2 THEN 3 ELSE 4 END, source_code) AS rk
  FROM pres
),
dimp AS (
  SELECT row_number() OVER (ORDER BY sku) AS producto_id, sku, nombre_norm, cat, es_serv_row, s, source_code
  FROM dimp0 WHERE rk = 1
)
"""

ORACLE["dim_producto"] = with_all("""
SELECT producto_id AS ProductoID, sku AS SKU, nombre_norm AS Nombre, cat AS Categoria, es_serv_row AS EsServicio,
       s AS SourceSystem, source_code AS SourceKey
FROM dimp
""", PRESENT_CTE, DIMP_CTE)

ORACLE["fact_ventas"] = with_all("""
SELECT fuente AS Fuente, source_key AS SourceKey, tiempo_id AS TiempoID, sku AS SKU, canal AS Canal,
       CAST(qty AS DOUBLE) AS Cantidad, CAST(price_usd AS DOUBLE) AS PrecioUnitUSD,
       CAST(total_usd AS DOUBLE) AS TotalUSD, cur AS MonedaOriginal
FROM factk
""", FACTK_CTE)

ORACLE["incremental_load"] = with_lines("""
SELECT 1 AS lote, count(*) FILTER (WHERE d < DATE '2001-01-01') AS filas FROM fact
UNION ALL SELECT 2 AS lote, count(*) FILTER (WHERE d >= DATE '2001-01-01') AS filas FROM fact
UNION ALL SELECT 3 AS lote, CAST(0 AS BIGINT) AS filas
""")

ORACLE["dw_stats"] = with_all("""
SELECT coalesce(fuente, 'TOTAL') AS Fuente, count(*) AS filas, CAST(round(sum(total_usd), 2) AS DOUBLE) AS ventas_usd,
       min(tiempo_id) AS primer_tiempo, max(tiempo_id) AS ultimo_tiempo
FROM factk GROUP BY ROLLUP (fuente)
""", FACTK_CTE)

ORACLE["load_diagnostics"] = with_lines("""
SELECT motivo, filas FROM (
  SELECT 'sin_mapeo' AS motivo, count(*) FILTER (WHERE NOT present) AS filas FROM staged
  UNION ALL SELECT 'duplicado', (SELECT count(*) FROM fact)
  UNION ALL SELECT 'crc_sin_tasa', count(*) FILTER (WHERE cur = 'CRC' AND rate IS NULL) FROM staged
) t WHERE filas > 0
""")

ORACLE["fx_coverage"] = with_lines("""
SELECT count(DISTINCT d) AS fechas_sin_tasa, count(*) AS filas_sin_tasa
FROM staged WHERE cur = 'CRC' AND rate IS NULL
""")

ORACLE["kpi_total"] = with_all("""
SELECT CAST(round(sum(total_usd), 2) AS DOUBLE) AS ventas_usd, count(*) AS lineas
FROM factk WHERE tiempo_id BETWEEN 19970101 AND 19991231 AND canal = 'WEB'
""", FACTK_CTE)

MONTHLY_CTE = """
mon AS (SELECT anio, mes, sum(total_usd) AS v FROM fact GROUP BY 1, 2)
"""

ORACLE["kpi_growth_yoy"] = with_all("""
SELECT m.anio AS Anio, m.mes AS Mes, CAST(round(m.v, 2) AS DOUBLE) AS ventas_usd,
       CAST(round(p.v, 2) AS DOUBLE) AS ventas_anio_anterior,
       round(CAST(m.v - p.v AS DOUBLE) * 100 / CAST(p.v AS DOUBLE), 4) AS crecimiento_pct
FROM mon m LEFT JOIN mon p ON p.anio = m.anio - 1 AND p.mes = m.mes
""", MONTHLY_CTE)

ORACLE["kpi_top_clients"] = with_all("""
SELECT fuente AS SourceSystem, client_key AS SourceKey, CAST(round(sum(total_usd), 2) AS DOUBLE) AS ventas_usd,
       CAST(row_number() OVER (ORDER BY sum(total_usd) DESC, fuente, client_key) AS INTEGER) AS rank
FROM factk GROUP BY 1, 2 ORDER BY rank LIMIT 10
""", FACTK_CTE)

ORACLE["kpi_top_products"] = with_all("""
SELECT sku AS SKU, CAST(round(sum(total_usd), 2) AS DOUBLE) AS ventas_usd,
       CAST(row_number() OVER (ORDER BY sum(total_usd) DESC, sku) AS INTEGER) AS rank
FROM factk GROUP BY 1 ORDER BY rank LIMIT 10
""", FACTK_CTE)

ORACLE["kpi_category_share"] = with_all("""
SELECT cat AS Categoria, CAST(round(sum(total_usd), 2) AS DOUBLE) AS ventas_usd,
       round(CAST(sum(total_usd) AS DOUBLE) * 100 / CAST((SELECT sum(total_usd) FROM fact) AS DOUBLE), 4) AS participacion_pct
FROM factk GROUP BY 1
""", FACTK_CTE)

ORACLE["kpi_avg_ticket"] = with_all("""
SELECT count(*) AS ordenes, CAST(round(sum(v), 2) AS DOUBLE) AS ventas_usd,
       round(CAST(sum(v) AS DOUBLE) / count(*), 4) AS ticket_promedio FROM per
""", FACTK_CTE, "per AS (SELECT fuente, txn, sum(total_usd) AS v FROM factk GROUP BY 1, 2)")

ORACLE["kpi_active_clients"] = with_lines("""
SELECT coalesce(anio, 0) AS Anio, count(DISTINCT (src, ck)) AS clientes_activos FROM fact GROUP BY ROLLUP (anio)
""")

ORACLE["kpi_channel_month"] = with_lines("""
SELECT anio AS Anio, mes AS Mes, canal AS Canal, CAST(round(sum(total_usd), 2) AS DOUBLE) AS ventas_usd
FROM fact GROUP BY 1, 2, 3
""")

ORACLE["kpi_mom_accum"] = with_all("""
SELECT anio AS Anio, mes AS Mes, round(pct, 4) AS mom_pct,
       round(sum(pct) OVER (PARTITION BY anio ORDER BY mes ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 4) AS mom_acumulado_pct
FROM (
  SELECT m.anio, m.mes, coalesce(CAST(m.v - p.v AS DOUBLE) * 100 / CAST(p.v AS DOUBLE), 0.0) AS pct
  FROM mon m LEFT JOIN mon p ON p.anio * 12 + p.mes + 1 = m.anio * 12 + m.mes
) t
""", MONTHLY_CTE)

ORACLE["ventas_vs_metas"] = with_all("""
SELECT coalesce(s.fuente, t.fuente) AS SourceSystem, coalesce(s.client_key, t.client_key) AS SourceKey,
       coalesce(s.sku, t.sku) AS SKU, coalesce(s.anio, t.anio) AS Anio, coalesce(s.mes, t.mes) AS Mes,
       CAST(round(coalesce(s.v, 0), 2) AS DOUBLE) AS ventas_usd, CAST(t.meta AS DOUBLE) AS meta_usd,
       round(CAST(coalesce(s.v, 0) AS DOUBLE) * 100 / CAST(t.meta AS DOUBLE), 4) AS cumplimiento_pct,
       CASE WHEN t.meta IS NULL THEN NULL
            WHEN round(CAST(coalesce(s.v, 0) AS DOUBLE) * 100 / CAST(t.meta AS DOUBLE), 4) > 100 THEN 'green'
            WHEN round(CAST(coalesce(s.v, 0) AS DOUBLE) * 100 / CAST(t.meta AS DOUBLE), 4) >= 80 THEN 'amber'
            ELSE 'red' END AS banda
FROM sales s FULL OUTER JOIN metas t
  ON s.fuente = t.fuente AND s.client_key = t.client_key AND s.sku = t.sku AND s.anio = t.anio AND s.mes = t.mes
""", FACTK_CTE,
    "sales AS (SELECT fuente, client_key, sku, anio, mes, sum(total_usd) AS v FROM factk GROUP BY 1, 2, 3, 4, 5)",
    "metas AS (SELECT fuente, client_key, sku, anio + 1 AS anio, mes, CAST(v * 1.10 AS DECIMAL(18,2)) AS meta FROM sales)")


# ------------------------------------------------------------------ M5

ORACLE["baskets"] = with_all("""
SELECT fuente AS Fuente, txn AS transaction_id, string_agg(sku, ', ' ORDER BY sku) AS item, CAST(count(*) AS INTEGER) AS n_lines
FROM factk GROUP BY 1, 2
""", FACTK_CTE)

ORACLE["baskets_merged_sources"] = with_all("""
SELECT txn AS transaction_id, string_agg(sku, ', ' ORDER BY sku) AS item, CAST(count(*) AS INTEGER) AS n_lines
FROM factk GROUP BY 1
""", FACTK_CTE)


def _mining_ctes(item: str, min_support: float, min_item_count: int = 5) -> list[str]:
    return [
        FACTK_CTE,
        f"bl AS (SELECT fuente, txn, {item} AS item FROM factk)",
        "multi AS (SELECT fuente, txn FROM bl GROUP BY 1, 2 HAVING count(*) >= 2)",
        "kl AS (SELECT bl.* FROM bl JOIN multi USING (fuente, txn))",
        f"fi AS (SELECT item FROM kl GROUP BY item HAVING count(*) >= {min_item_count})",
        "mb AS (SELECT fuente, txn, list_sort(list_distinct(list(item))) AS items FROM kl "
        "WHERE item IN (SELECT item FROM fi) GROUP BY 1, 2)",
        "nb AS (SELECT count(*) AS n FROM mb)",
        "subs AS (SELECT list_filter(items, lambda x, i: ((m >> (i - 1)) & 1) = 1) AS s "
        "FROM mb, LATERAL (SELECT unnest(range(1, (1 << len(items)))) AS m))",
        f"isets AS (SELECT s, count(*) AS cnt FROM subs GROUP BY s "
        f"HAVING count(*) >= ceil({min_support} * (SELECT n FROM nb)))",
    ]


def _itemsets_sql(item: str, min_support: float) -> str:
    return with_all("""
SELECT array_to_string(s, ', ') AS itemset, CAST(len(s) AS INTEGER) AS n_items, cnt AS count,
       round(cnt / (SELECT n FROM nb), 9) AS support
FROM isets
""", *_mining_ctes(item, min_support))


RULE_CTES = """
sets AS MATERIALIZED (SELECT s, cnt, array_to_string(s, ', ') AS t FROM isets),
splits AS MATERIALIZED (
  SELECT cnt, array_to_string(list_filter(s, lambda x, i: ((m >> (i - 1)) & 1) = 1), ', ') AS a,
         array_to_string(list_filter(s, lambda x, i: ((m >> (i - 1)) & 1) = 0), ', ') AS c
  FROM (SELECT s, cnt, unnest(range(1, (1 << len(s)) - 1)) AS m FROM sets WHERE len(s) >= 2)
),
total AS MATERIALIZED (SELECT n FROM nb),
rules AS MATERIALIZED (
  SELECT sp.a, sp.c, sp.cnt / n AS sup, (sp.cnt / n) / (ia.cnt / n) AS conf, ((sp.cnt / n) / (ia.cnt / n)) / (ic.cnt / n) AS lift
  FROM splits sp JOIN sets ia ON ia.t = sp.a JOIN sets ic ON ic.t = sp.c, total
)
"""


def _rules_sql(item: str, min_support: float, min_conf: float, min_lift: float) -> str:
    # the splits of frequent itemsets meet their sides by text: joins on lists compare every pair
    return with_all(f"""
SELECT a AS Antecedent, c AS Consequent, round(sup, 9) AS support, round(conf, 9) AS confidence, round(lift, 9) AS lift
FROM rules WHERE conf >= {min_conf} AND lift >= {min_lift}
""", *_mining_ctes(item, min_support), RULE_CTES)


ORACLE["frequent_itemsets_sku"] = _itemsets_sql("sku", 0.002)
ORACLE["frequent_itemsets_category"] = _itemsets_sql("cat", 0.002)
ORACLE["association_rules_sku"] = _rules_sql("sku", 0.002, 0.10, 1.5)
ORACLE["association_rules_category"] = _rules_sql("cat", 0.002, 0.10, 0.0)

ORACLE["recommend_top5"] = with_all("""
SELECT fuente AS Fuente, txn AS transaction_id, Consequent, CAST(rank AS INTEGER) AS rank FROM (
  SELECT b.fuente, b.txn, array_to_string(r.c, ', ') AS Consequent,
         row_number() OVER (PARTITION BY b.fuente, b.txn ORDER BY r.conf DESC, r.lift DESC,
                            array_to_string(r.c, ', ')) AS rank
  FROM bsets b JOIN rules r ON array_to_string(r.a, ', ') = b.k
  WHERE r.conf >= 0.10
) t WHERE rank <= 5
""", *_mining_ctes("cat", 0.002), """
splits AS (
  SELECT s, cnt, list_filter(s, lambda x, i: ((m >> (i - 1)) & 1) = 1) AS a,
         list_filter(s, lambda x, i: ((m >> (i - 1)) & 1) = 0) AS c
  FROM isets, LATERAL (SELECT unnest(range(1, (1 << len(s)) - 1)) AS m) WHERE len(s) >= 2
),
rules AS (
  SELECT sp.a, sp.c, (sp.cnt / nb.n) / (ia.cnt / nb.n) AS conf,
         ((sp.cnt / nb.n) / (ia.cnt / nb.n)) / (ic.cnt / nb.n) AS lift
  FROM splits sp JOIN isets ia ON ia.s = sp.a JOIN isets ic ON ic.s = sp.c CROSS JOIN nb
),
bsets AS (SELECT fuente, txn, array_to_string(list_sort(list_distinct(list(cat))), ', ') AS k FROM factk GROUP BY 1, 2)
""")

ORACLE["codes_to_skus"] = with_lines("""
SELECT DISTINCT 'MN-' || CAST(4000 + lx.p AS VARCHAR) AS code, pr.sku AS SKU
FROM lx JOIN prod pr ON lx.p = pr.p
WHERE lx.src = 3 AND CASE WHEN lx.p % 97 = 0 THEN false WHEN lx.p % 97 = 1 THEN false ELSE lx.p % 10 <> 3 END
""")


# ------------------------------------------------------------------ M7

MSSQL_ORDERS_CTE = """
mo AS (
  SELECT CAST(o_orderkey AS INTEGER) AS OrdenId, CAST(o_custkey AS INTEGER) AS ClienteId, o_orderdate AS Fecha,
         ['WEB','TIENDA','APP','PARTNER','WEB'][CAST(substr(o_orderpriority, 1, 1) AS INTEGER)] AS Canal,
         CAST(o_totalprice AS DECIMAL(18,2)) AS Total
  FROM orders WHERE o_custkey % 5 = 0
),
mof AS (
  SELECT * FROM mo WHERE Canal = 'WEB' AND Total >= 1000
    AND Fecha BETWEEN TIMESTAMP '1996-01-01 00:00:00' AND TIMESTAMP '1998-12-31 23:59:59'
)
"""

ORACLE["list_ordenes"] = with_all("""
SELECT OrdenId, ClienteId, Fecha, Canal, CAST(Total AS DOUBLE) AS Total FROM mof
ORDER BY Total DESC, OrdenId DESC LIMIT 20 OFFSET 20
""", MSSQL_ORDERS_CTE)

ORACLE["list_ordenes_count"] = with_all("""
SELECT count(*) AS total, CAST(ceil(count(*) / 20) AS BIGINT) AS paginas FROM mof
""", MSSQL_ORDERS_CTE)

ORACLE["list_clientes"] = with_all("""
SELECT CAST(ck AS INTEGER) AS ClienteId, c_name AS Nombre, pais0 AS Pais FROM cx
WHERE src = 0 AND lower(pais0) = 'spain' AND genero_norm = 'Femenino' AND contains(lower(c_name), 'customer#0000')
  AND ck % 3 = 1
ORDER BY c_name, ck LIMIT 20
""", CUST_CTE)

SUPA_PRICE = ("CASE WHEN cur = 'CRC' THEN CAST(cents * 5 AS DECIMAL(18,2)) "
              "ELSE CAST(cents / 100.0 AS DECIMAL(18,2)) END")

ORACLE["orden_completa"] = with_all(f"""
SELECT '00000000-0000-0000-0000-' || printf('%012d', l.ok) AS orden_id,
       '00000000-0000-0000-0000-' || printf('%012d', l.ok * 10 + l.line_id) AS orden_detalle_id,
       '  ' || pa.nm || '  ' AS producto_nombre, c.c_name AS cliente_nombre, l.qty AS cantidad,
       CAST({SUPA_PRICE} AS DOUBLE) AS precio_unit,
       CAST(CAST(l.qty * {SUPA_PRICE} AS DECIMAL(18,2)) AS DOUBLE) AS subtotal
FROM lx l JOIN parts pa ON pa.p = l.p JOIN customer c ON c.c_custkey = l.ck
WHERE l.src = 2 AND l.present
""")

ORACLE["orders_nested"] = with_lines(f"""
SELECT printf('ORD-%06d', o.o_orderkey) AS orden_id, printf('C%05d', o.o_custkey) AS cliente_id,
       CAST(count(l.ok) AS INTEGER) AS n_items,
       CAST(sum(CAST(qty * {SUPA_PRICE} AS DECIMAL(18,2))) AS DOUBLE) AS items_total,
       arg_min('SKU' || CAST(1000 + p AS VARCHAR), line_id) AS primer_producto
FROM orders o LEFT JOIN lx l ON l.ok = o.o_orderkey
WHERE o.o_custkey % 5 = 4 GROUP BY o.o_orderkey, o.o_custkey
""")

ORACLE["merge_repeated_products"] = with_lines(f"""
SELECT printf('ORD-%06d', ok) AS orden_id, 'SKU' || CAST(1000 + p AS VARCHAR) AS producto_id,
       CAST(sum(qty) AS BIGINT) AS cantidad, CAST(arg_min({SUPA_PRICE}, line_id) AS DOUBLE) AS precio_unit
FROM lx WHERE src = 4 GROUP BY ok, p
""")

ORACLE["order_total_check"] = with_lines("""
SELECT count(DISTINCT ok) AS ordenes_revisadas, CAST(0 AS BIGINT) AS descuadres FROM lx WHERE src = 1
""")

ORACLE["orders_after_changes"] = with_lines("""
SELECT pre || '00000000-0000-0000-0000-' || printf('%012d', ok) AS orden_id, count(*) AS n_lineas,
       CAST(sum(qty + more) AS BIGINT) AS unidades, count(*) AS ids_linea, true AS cuadra
FROM (SELECT ok, qty, '' AS pre, CASE WHEN ok % 13 = 0 THEN 1 ELSE 0 END AS more FROM lx WHERE src = 2 AND ok % 11 <> 0
      UNION ALL SELECT ok, qty, '77777777-', 1 FROM lx WHERE src = 2 AND ok % 19 = 0 AND ok % 11 <> 0)
GROUP BY pre, ok
""")

ORACLE["order_change_rejects"] = """
SELECT op, motivo, count(*) AS filas FROM (
  SELECT 'delete' AS op, 'unknown_order' AS motivo FROM orders WHERE o_custkey % 5 = 2 AND o_orderkey % 101 = 0
  UNION ALL SELECT 'merge', 'unknown_op' FROM orders WHERE o_custkey % 5 = 2 AND o_orderkey % 103 = 0
  UNION ALL SELECT 'create', 'existing_order' FROM orders
  WHERE o_custkey % 5 = 2 AND o_orderkey % 17 = 0 AND o_orderkey % 11 <> 0 AND o_orderkey % 13 <> 0)
GROUP BY op, motivo
"""

ORACLE["new_order_ids"] = """
SELECT printf('C%05d', c_custkey) AS cliente_id,
       printf('ORD-%06d', (SELECT max(o_orderkey) FROM orders WHERE o_custkey % 5 = 4)
                          + row_number() OVER (ORDER BY printf('C%05d', c_custkey))) AS nuevo_id
FROM customer WHERE c_custkey % 5 = 4
"""

ORACLE["include_order_lines"] = with_lines("""
SELECT CAST(o.o_orderkey AS INTEGER) AS OrdenId, CAST(count(l.ok) AS INTEGER) AS n_lineas,
       coalesce(string_agg(CASE WHEN l.present THEN 'SKU-' || CAST(1000 + l.p AS VARCHAR) END, ', '
                           ORDER BY 'SKU-' || CAST(1000 + l.p AS VARCHAR)), '') AS skus
FROM orders o LEFT JOIN lx l ON l.ok = o.o_orderkey
WHERE o.o_custkey % 5 = 0 GROUP BY o.o_orderkey
""")

ORACLE["bulk_violations"] = with_lines("""
SELECT 'Orden' AS hoja, 'correo_invalido' AS regla, count(*) AS filas
FROM orders WHERE o_custkey % 5 = 1 AND o_custkey % 7 = 0 HAVING count(*) > 0
UNION ALL
SELECT 'OrdenDetalle', 'sku_requerido', count(*) FROM lx WHERE src = 0 AND NOT present HAVING count(*) > 0
""")

ORACLE["bulk_violations_all"] = with_lines("""
SELECT fuente, hoja, regla, count(*) AS filas FROM (
  SELECT ['mssql','mysql'][CAST(c_custkey % 5 AS INTEGER) + 1] AS fuente, 'Cliente' AS hoja,
         CASE WHEN trim(coalesce(c_name, '')) = '' THEN 'nombre_requerido' ELSE 'nombre_largo' END AS regla
  FROM customer WHERE c_custkey % 5 IN (0, 1) AND (trim(coalesce(c_name, '')) = '' OR length(c_name) > 120)
  UNION ALL
  SELECT k.s, 'Producto', CASE WHEN length(pa.nm) > 150 THEN 'nombre_largo' ELSE 'categoria_requerido' END
  FROM parts pa CROSS JOIN (VALUES (0, 'mssql'), (1, 'mysql')) k(k, s)
  WHERE CASE WHEN pa.p % 97 = 0 THEN k.k = 1 WHEN pa.p % 97 = 1 THEN false ELSE pa.p % 10 <> k.k END
    AND (length(pa.nm) > 150 OR trim(coalesce(pa.cat, '')) = '')
  UNION ALL
  SELECT 'mssql', 'Orden', 'canal_invalido' FROM orders WHERE o_custkey % 5 = 0 AND substr(o_orderpriority, 1, 1) = '4'
  UNION ALL
  SELECT 'mssql', 'Orden', 'total_invalido' FROM orders WHERE o_custkey % 5 = 0 AND coalesce(o_totalprice, 0) <= 0
  UNION ALL
  SELECT 'mssql', 'Orden', 'email_invalido' FROM orders
  WHERE o_custkey % 5 = 0 AND o_custkey NOT IN (SELECT c_custkey FROM customer)
  UNION ALL
  SELECT 'mysql', 'Orden', 'correo_invalido' FROM orders
  WHERE o_custkey % 5 = 1 AND (o_custkey % 7 = 0 OR o_custkey NOT IN (SELECT c_custkey FROM customer))
  UNION ALL
  SELECT fuente, 'OrdenDetalle', CASE src WHEN 0 THEN 'sku_requerido' ELSE 'codigo_requerido' END
  FROM lx WHERE src IN (0, 1) AND NOT present
  UNION ALL
  SELECT fuente, 'OrdenDetalle', 'cantidad_invalida' FROM lx WHERE src IN (0, 1) AND qty <= 0
  UNION ALL
  SELECT fuente, 'OrdenDetalle', 'precio_invalido' FROM lx WHERE src = 0 AND cents <= 0
) t GROUP BY 1, 2, 3
""")

ORACLE["bulk_upsert"] = """
SELECT 'actualizado' AS accion, count(*) AS filas FROM customer WHERE c_custkey % 5 = 0
UNION ALL SELECT 'insertado', count(*) FROM customer WHERE c_custkey % 5 = 1
UNION ALL SELECT 'total_tabla', count(*) FROM customer WHERE c_custkey % 5 IN (0, 1)
"""


# ------------------------------------------------------------------ M8

ORACLE["stream_fact_load"] = with_lines("""
SELECT fuente AS Fuente, count(*) AS filas, CAST(round(sum(total_usd), 2) AS DOUBLE) AS ventas_usd FROM fact GROUP BY 1
""")

ORACLE["stream_dedup"] = with_lines("""
SELECT fuente AS source_system, count(*) AS filas FROM staged GROUP BY 1
""")

ORACLE["stream_daily_sales"] = """
SELECT CAST(date_trunc('day', ts) AS DATE) AS dia, count(*) AS compras, round(sum(value), 4) AS valor
FROM events WHERE event_type = 'purchase' GROUP BY 1
"""


# ----------------------------------------------------- sources and cleaning

ORACLE["extraction_counts"] = with_all("""
SELECT source_system, entity, CAST(rows AS BIGINT) AS rows FROM (
  SELECT s AS source_system, CASE k WHEN 0 THEN 'Producto' WHEN 1 THEN 'Producto' WHEN 2 THEN 'producto'
                                    WHEN 3 THEN 'productos' ELSE 'Producto' END AS entity, count(*) AS rows
  FROM pres GROUP BY 1, 2
  UNION ALL
  SELECT """ + SRC_NAMES + """[CAST(c_custkey % 5 AS INTEGER) + 1],
         ['Cliente', 'Cliente', 'cliente', 'clientes', 'Cliente'][CAST(c_custkey % 5 AS INTEGER) + 1], count(*)
  FROM customer GROUP BY 1, 2
  UNION ALL
  SELECT """ + SRC_NAMES + """[CAST(o_custkey % 5 AS INTEGER) + 1],
         ['Orden', 'Orden', 'orden', 'ordenes', 'Orden'][CAST(o_custkey % 5 AS INTEGER) + 1], count(*)
  FROM orders GROUP BY 1, 2
  UNION ALL
  SELECT 'neo4j', 'REALIZO', count(*) FROM orders WHERE o_custkey % 5 = 4
  UNION ALL
  SELECT fuente, ['OrdenDetalle', 'OrdenDetalle', 'orden_detalle', NULL, 'CONTIENE'][src + 1], count(*)
  FROM lx WHERE src <> 3 GROUP BY 1, 2
  UNION ALL
  SELECT 'neo4j', 'Categoria', count(DISTINCT p_type) FROM part
  UNION ALL
  SELECT 'neo4j', 'PERTENECE_A', count(*) FROM pres WHERE k = 4
) t
""", PRESENT_CTE)

ORACLE["mongo_item_count"] = with_lines("""
SELECT count(*) AS items FROM lx WHERE src = 3
""")

ORACLE["graph_triplets"] = with_lines("""
SELECT printf('ORD-%06d', l.ok) AS orden_id, 'SKU' || CAST(1000 + l.p AS VARCHAR) AS producto_id, CAST(l.line_id AS INTEGER) AS seq,
       l.d AS fecha, CASE WHEN l.present THEN pa.nm END AS producto_nombre
FROM lx l JOIN parts pa ON pa.p = l.p WHERE l.src = 4
""")

ORACLE["fx_feed_parse"] = with_all("""
SELECT fecha, 'CRC' AS de, 'USD' AS a, buy AS tasa FROM rates
UNION ALL
SELECT fecha, 'USD' AS de, 'CRC' AS a, sell AS tasa FROM rates
""", RATE_DAYS_CTE)

ORACLE["clean_amounts"] = with_lines("""
SELECT CAST(ok * 10 + line_id AS INTEGER) AS id,
       CASE WHEN cur = 'CRC' THEN CAST(cents * 5 AS DOUBLE) ELSE CAST(CAST(cents / 100.0 AS DECIMAL(18,2)) AS DOUBLE) END
         AS precio_unit_num
FROM lx WHERE src = 1
""")

ORACLE["clean_dates"] = with_all("""
SELECT CAST(ck AS INTEGER) AS id, fecha_creado_dt AS fecha FROM cz WHERE src = 1
""", CUST_CTE)

ORACLE["country_iso"] = with_all("""
SELECT DISTINCT pais0 AS pais,
  CASE pais0 WHEN 'Costa Rica' THEN 'CR' WHEN 'Spain' THEN 'ES' WHEN 'Panama' THEN 'PA' WHEN 'Korea' THEN 'KR'
             WHEN 'United States' THEN 'US' WHEN 'CR' THEN 'CD' ELSE '' END AS codigo
FROM cz WHERE src IN (2, 4)
""", CUST_CTE)

ORACLE["lookup_by_name"] = with_all("""
SELECT source_code AS codigo_alt, sku AS sku_oficial FROM pres WHERE k = 1
""", PRESENT_CTE)

ORACLE["collapsed_items"] = with_lines("""
SELECT fuente AS source_system, count(*) AS collapsed_lines FROM lp
WHERE src IN (3, 4) AND present AND dup_rank > 1 GROUP BY 1
""")

ORACLE["missing_product_refs"] = with_lines("""
SELECT DISTINCT 'SKU' || CAST(1000 + p AS VARCHAR) AS producto_id FROM lx WHERE src = 4 AND NOT present
""")

ORACLE["duplicate_products_in_orders"] = with_lines("""
SELECT DISTINCT printf('%024d', ok) AS orden_id FROM lx WHERE src = 3 GROUP BY ok, p HAVING count(*) > 1
""")

ORACLE["rate_availability"] = with_all("""
SELECT count(*) * 2 AS filas, min(fecha) AS desde, max(fecha) AS hasta FROM rates
WHERE fecha BETWEEN DATE '1998-01-01' AND DATE '1998-12-31'
""", RATE_DAYS_CTE)

ORACLE["fx_status"] = with_all("""
SELECT (SELECT max(fecha) FROM rates) AS ultima_fecha, (SELECT count(*) FROM rates) AS dias,
       (SELECT count(*) * 2 FROM rates WHERE fecha = (SELECT max(d) FROM staged)) AS tasas_hoy,
       CASE WHEN (SELECT count(*) * 2 FROM rates WHERE fecha = (SELECT max(d) FROM staged)) >= 2 THEN 'OK'
            WHEN (SELECT max(fecha) FROM rates) >= (SELECT max(d) FROM staged) - 1 THEN 'WARNING'
            ELSE 'ERROR' END AS estado
""", RATE_DAYS_CTE)


# ----------------------------------------------------- more reports and lists

ORACLE["dw_counts"] = with_all("""
SELECT 'dim_tiempo' AS tabla, (SELECT count(*) FROM days) AS filas
UNION ALL SELECT 'dim_cliente', (SELECT count(*) FROM cz)
UNION ALL SELECT 'dim_producto', (SELECT count(*) FROM parts)
UNION ALL SELECT 'fact_ventas', (SELECT count(*) FROM fact)
UNION ALL SELECT 'map_producto', (SELECT count(*) FROM pres)
UNION ALL SELECT 'stg_clientes', (SELECT count(*) FROM cz)
UNION ALL SELECT 'stg_orden_items', (SELECT count(*) FROM staged)
UNION ALL SELECT 'tipo_cambio', (SELECT count(*) * 2 FROM rates)
""", RATE_DAYS_CTE, CUST_CTE, PRESENT_CTE, """
bounds AS (
  SELECT least((SELECT min(d) FROM staged), (SELECT min(fecha_creado_dt) FROM cz)) AS lo,
         greatest((SELECT max(d) FROM staged), (SELECT max(fecha_creado_dt) FROM cz)) AS hi
),
days AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS Fecha FROM bounds)
""")

ORACLE["loaded_by_source"] = with_lines("""
SELECT fuente AS Fuente, count(*) AS cargadas FROM fact WHERE d >= DATE '2001-01-01' GROUP BY 1
""")

ORACLE["orders_newest_page"] = """
SELECT '00000000-0000-0000-0000-' || printf('%012d', o_orderkey) AS orden_id,
       strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '-06:00' AS fecha,
       CAST(coalesce(t.total, 0) AS DOUBLE) AS total
FROM orders o LEFT JOIN (
  SELECT l.l_orderkey, CAST(sum(l.l_quantity * CASE WHEN l.l_orderkey % 2 = 1
           THEN CAST(floor(l.l_extendedprice * 100 / l.l_quantity) * 5 AS DECIMAL(18,2))
           ELSE CAST(floor(l.l_extendedprice * 100 / l.l_quantity) / 100.0 AS DECIMAL(18,2)) END) AS DECIMAL(18,2)) AS total
  FROM lineitem l GROUP BY 1) t ON t.l_orderkey = o.o_orderkey
WHERE o_custkey % 5 = 2
ORDER BY fecha DESC, orden_id DESC LIMIT 20
"""

ORACLE["list_orden_detalles"] = with_lines("""
SELECT CAST(ok * 10 + line_id AS INTEGER) AS OrdenDetalleId, qty AS Cantidad,
       CAST(CAST(cents / 100.0 AS DECIMAL(18,2)) AS DOUBLE) AS PrecioUnit, pct AS DescuentoPct
FROM lx WHERE src = 0 AND qty BETWEEN 10 AND 20 AND line_id % 3 <> 0 AND pct >= 5
ORDER BY PrecioUnit DESC, OrdenDetalleId DESC LIMIT 20
""")

ORACLE["list_productos"] = with_all("""
SELECT CAST(p AS INTEGER) AS ProductoId, 'SKU-' || CAST(1000 + p AS VARCHAR) AS SKU, nm AS Nombre
FROM pres WHERE k = 0 AND contains(nm, 'widget') AND cat = 'LARGE'
ORDER BY nm, p LIMIT 20
""", PRESENT_CTE)

ORACLE["order_payload_violations"] = """
SELECT regla, count(*) AS filas FROM (
  SELECT 'sin_items' AS regla FROM orders o WHERE o_custkey % 5 = 3
    AND NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)
  UNION ALL
  SELECT 'canal_invalido' FROM orders WHERE o_custkey % 5 = 3 AND substr(o_orderpriority, 1, 1) IN ('3', '4')
) t GROUP BY 1
"""

ORACLE["product_categories"] = with_all("""
SELECT 'SKU' || CAST(1000 + p AS VARCHAR) AS producto_id, nm AS nombre, cat AS categoria FROM pres WHERE k = 4
""", PRESENT_CTE)

ORACLE["sku_by_name_fallback"] = with_all("""
SELECT source_code AS codigo_mongo, sku AS sku_por_nombre FROM pres WHERE k = 3
""", PRESENT_CTE)

ORACLE["bulk_sheets_roundtrip"] = """
SELECT 'Cliente' AS hoja, count(*) AS filas, count(*) FILTER (WHERE c_custkey % 7 = 0) AS correo_nulo
FROM customer WHERE c_custkey % 5 = 1
UNION ALL
SELECT 'Producto', count(*), 0 FROM part WHERE CASE WHEN p_partkey % 97 = 0 THEN true WHEN p_partkey % 97 = 1 THEN false
                                                  ELSE p_partkey % 10 <> 1 END
UNION ALL
SELECT 'Orden', count(*), count(*) FILTER (WHERE o_custkey % 7 = 0) FROM orders WHERE o_custkey % 5 = 1
UNION ALL
SELECT 'OrdenDetalle', 0, 0
"""

ORACLE["fx_new_days"] = with_all("""
SELECT count(*) AS dias, min(fecha) AS desde, max(fecha) AS hasta FROM rates WHERE fecha >= DATE '1998-01-01'
""", RATE_DAYS_CTE)

ORACLE["bridge_validation"] = with_all("""
SELECT (p % 10 NOT IN (6, 7, 8)) AS valido, count(*) AS filas FROM pres WHERE k = 3 GROUP BY 1
""", PRESENT_CTE)

ORACLE["order_items_json"] = with_lines("""
SELECT count(*) AS items, CAST(sum(qty) AS BIGINT) AS unidades, count(DISTINCT ok) AS ordenes FROM lx WHERE src = 3
""")

ORACLE["run_gate"] = with_all("""
SELECT reason <> '' AS run, reason FROM (
  SELECT array_to_string(list_sort(list_filter([
      CASE WHEN (SELECT max(d) FROM fact WHERE d < DATE '2001-01-01') < (SELECT max(d) FROM staged) - INTERVAL 1 DAY
           THEN 'fact_ventas stale' END,
      CASE WHEN (SELECT max(d) FROM staged) > (SELECT max(d) FROM fact WHERE d < DATE '2001-01-01')
           THEN 'fact_ventas has new rows' END,
      CASE WHEN (SELECT max(fecha_creado_dt) FROM cz) < (SELECT max(d) FROM staged) - INTERVAL 1 DAY
           THEN 'dim_cliente stale' END
    ], lambda x: x IS NOT NULL)), '; ') AS reason
) t
""", CUST_CTE)

ORACLE["max_existing_sku"] = """
SELECT CAST(max(1000 + p_partkey) AS BIGINT) AS max_sku FROM part
WHERE p_partkey % 97 NOT IN (0, 1)
"""

ORACLE["bulk_orders_fk"] = """
SELECT count(*) FILTER (WHERE o_custkey % 7 <> 0) AS resueltas, count(*) FILTER (WHERE o_custkey % 7 = 0) AS sin_resolver,
       count(*) FILTER (WHERE o_custkey % 7 = 0) = 0 AS carga_aceptada
FROM orders WHERE o_custkey % 5 = 1
"""

ORACLE["sql_clean_functions"] = """
SELECT 'genero' AS campo, ['Masculino', 'Femenino', 'No especificado'][CAST(c_custkey % 3 AS INTEGER) + 1] AS valor,
       count(*) AS filas
FROM customer WHERE c_custkey % 5 = 1 GROUP BY 2
UNION ALL
SELECT 'canal', ['WEB', 'TIENDA', 'APP', 'PARTNER', 'WEB'][CAST(substr(o_orderpriority, 1, 1) AS INTEGER)], count(*)
FROM orders WHERE o_custkey % 5 = 1 GROUP BY 2
"""


ORACLE["safe_casts"] = """
SELECT CAST(o_orderkey AS BIGINT) AS id,
  CASE o_orderkey % 4 WHEN 0 THEN o_orderkey + 0.25 WHEN 2 THEN o_orderkey ELSE 0 END::DOUBLE AS decimal_0,
  CASE o_orderkey % 4 WHEN 2 THEN o_orderkey ELSE -1 END::INTEGER AS entero,
  CASE o_orderkey % 4 WHEN 0 THEN o_orderkey + 0.25 WHEN 2 THEN o_orderkey END::DOUBLE AS flotante
FROM orders
"""

ORACLE["safe_dates"] = """
SELECT CAST(o_orderkey AS BIGINT) AS id, CASE WHEN o_orderkey % 6 < 5 THEN strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') END AS fecha
FROM orders
"""

ORACLE["split_lists"] = """
SELECT CAST(o_orderkey AS BIGINT) AS id, 'a' || CAST(o_orderkey % 3 AS VARCHAR) || '|b' || CAST(o_orderkey % 5 AS VARCHAR) AS valores,
  CAST(2 AS INTEGER) AS n
FROM orders
"""

ORACLE["object_ids"] = """
SELECT CAST(o_orderkey AS BIGINT) AS id, CASE WHEN o_orderkey % 3 < 2 THEN printf('%024X', o_orderkey) END AS objeto FROM orders
"""

ORACLE["valid_order_ids"] = """
SELECT CAST(o_orderkey AS BIGINT) AS id, CASE o_orderkey % 4 WHEN 0 THEN 'ORD-' ELSE 'O' END || CAST(o_orderkey AS VARCHAR) AS orden
FROM orders WHERE o_orderkey % 4 < 2
"""

ORACLE["rate_backfill"] = """
SELECT DATE '1995-08-02' AS desde, DATE '1998-08-02' AS hasta, caso = 'enero' AS cargar, caso FROM (VALUES ('enero'), ('todas')) t(caso)
"""


# ------------------------------------------------------- features over all the sources they cover

ORACLE["order_payload_violations_all"] = """
SELECT ['mongo','supabase','neo4j'][k] AS fuente, regla, count(*) AS filas FROM (
  SELECT CASE o_custkey % 5 WHEN 3 THEN 1 WHEN 2 THEN 2 ELSE 3 END AS k, 'sin_items' AS regla FROM orders o
  WHERE o_custkey % 5 IN (2, 3, 4) AND NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)
  UNION ALL
  SELECT 1, 'canal_invalido' FROM orders WHERE o_custkey % 5 = 3 AND substr(o_orderpriority, 1, 1) IN ('3', '4')
  UNION ALL
  SELECT 2, 'canal_invalido' FROM orders WHERE o_custkey % 5 = 2 AND substr(o_orderpriority, 1, 1) = '2'
) t GROUP BY 1, 2
"""

ORACLE["bridge_validation_all"] = with_all("""
SELECT s AS fuente, CASE k WHEN 2 THEN NOT (p % 97 = 1 OR p % 10 = 5) WHEN 3 THEN p % 10 NOT IN (6, 7, 8) ELSE true END AS valido,
       count(*) AS filas
FROM pres WHERE k IN (2, 3, 4) GROUP BY 1, 2
""", PRESENT_CTE)

ORACLE["lookup_by_name_all"] = with_all("""
SELECT s AS fuente, source_code AS codigo, sku AS sku_oficial FROM pres
""", PRESENT_CTE)

ORACLE["sku_by_name_fallback_all"] = with_all("""
SELECT s AS fuente, source_code AS codigo, sku AS sku_por_nombre FROM pres WHERE k <> 0
""", PRESENT_CTE)

# only SQL Server stores a total that is not the sum of its lines; order totals there carry tax
ORACLE["order_total_check_all"] = with_lines("""
SELECT """ + SRC_NAMES + """[CAST(o.o_custkey % 5 AS INTEGER) + 1] AS fuente, count(*) AS ordenes_revisadas,
       count(*) FILTER (WHERE s.ok IS NULL) AS sin_lineas,
       count(*) FILTER (WHERE o.o_custkey % 5 = 0
                        AND abs(CAST(o.o_totalprice AS DECIMAL(18,2)) - coalesce(s.total, 0)) > 0.01) AS descuadres
FROM orders o LEFT JOIN (
  SELECT ok, sum(CAST(round(qty * cents * (100 - CAST(pct AS INTEGER)) / 10000.0, 2) AS DECIMAL(18,2))) AS total
  FROM lx GROUP BY ok) s ON s.ok = o.o_orderkey
GROUP BY 1
""")

ORACLE["duplicate_products_in_orders_all"] = with_lines("""
SELECT DISTINCT fuente, CASE src WHEN 3 THEN printf('%024d', ok) ELSE printf('ORD-%06d', ok) END AS orden_id
FROM lx WHERE src IN (3, 4) GROUP BY fuente, src, ok, p HAVING count(*) > 1
""")

ORACLE["codes_to_skus_all"] = with_all("""
SELECT DISTINCT pres.s AS fuente, pres.source_code AS code, pres.sku AS SKU
FROM lx JOIN pres ON lx.p = pres.p AND lx.src = pres.k WHERE lx.src IN (2, 3)
""", PRESENT_CTE)

ORACLE["stream_daily_channel_sales"] = """
SELECT CAST(date_trunc('day', ts) AS DATE) AS dia, ['WEB','TIENDA','APP','PARTNER','WEB'][CAST(user_id % 5 AS INTEGER) + 1] AS canal,
       count(*) AS compras, round(sum(value), 4) AS valor
FROM events WHERE event_type = 'purchase' GROUP BY 1, 2
"""

ORACLE["fx_rates_today"] = with_all("""
SELECT max(sell) AS tasa_usd_crc, max(buy) AS tasa_crc_usd FROM rates WHERE fecha = (SELECT max(d) FROM staged)
""", RATE_DAYS_CTE)

ORACLE["bulk_append_clients"] = """
SELECT count(*) * 2 AS filas, count(*) * 2 AS ids, CAST(max(c_custkey) + count(*) AS BIGINT) AS ultimo,
       count(*) FILTER (WHERE c_custkey % 7 <> 0) AS correos
FROM customer WHERE c_custkey % 5 = 1
"""

ORACLE["bulk_upsert_products"] = """
WITH x AS (SELECT k.s AS fuente, CASE WHEN p_partkey % 97 = 0 THEN k.k = 1 WHEN p_partkey % 97 = 1 THEN false
                                      ELSE p_partkey % 10 <> k.k END AS stored
           FROM part CROSS JOIN (VALUES (0, 'mssql'), (1, 'mysql')) k(k, s))
SELECT fuente, CASE WHEN stored THEN 'actualizado' ELSE 'insertado' END AS accion, count(*) AS filas FROM x GROUP BY 1, 2
UNION ALL
SELECT fuente, 'total_tabla', count(*) FROM x GROUP BY 1
"""

from . import detail_queries, rule_queries, run_queries, stream_queries, upload_queries  # noqa: E402

ORACLE |= upload_queries.oracle() | rule_queries.oracle() | stream_queries.oracle() | detail_queries.oracle() | run_queries.oracle()
