"""Versions of several tables behind one manifest (BL5, SNK6, SNK7).

A version is a manifest: one small file that names the folders of every table.
It is written last, so it is the commit; readers that go through a manifest see
all of a version or nothing of it, and a failed or rejected change leaves the
manifest before it as it was.  Tables that a change does not touch keep their
folders.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from .merge import publish


def read_version(spark: SparkSession, path: str) -> dict:
    return json.loads("\n".join(r[0] for r in spark.read.text(path).collect()))


def version_table(spark: SparkSession, version: dict, name: str) -> DataFrame:
    """A table of a version: the union of its folders, with the schema the version keeps (a folder may be empty)."""
    r = spark.read
    if name in version["schemas"]:
        r = r.schema(StructType.fromJson(version["schemas"][name]))
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), [r.parquet(p) for p in version["tables"][name]])


def commit(spark: SparkSession, base: str, tables: dict[str, DataFrame], previous: str | None = None,
           folders: dict[str, str] | None = None) -> str:
    """Write ``tables`` to new folders and then one manifest that names them and what ``previous`` had besides.

    ``folders``: tables that are written already, taken over where they lie."""
    old = read_version(spark, previous) if previous else {"tables": {}, "schemas": {}}
    paths, schemas = dict(old["tables"]), dict(old["schemas"])
    for name, df in tables.items():
        paths[name] = [publish(df, base, name)]
        schemas[name] = df.schema.jsonValue()
    for name, path in (folders or {}).items():
        paths[name], schemas[name] = [path], spark.read.parquet(path).schema.jsonValue()
    run = uuid.uuid4().hex
    path = f"{base.rstrip('/')}/manifest/v-{run}"
    body = json.dumps({"run": run, "previous": previous, "tables": paths, "schemas": schemas})
    spark.createDataFrame([(body,)], "value string").coalesce(1).write.mode("errorifexists").text(path)
    return path


# Tables in the order in which they are cleared (rows that refer to others first).
STAGING_TABLES = ("stg_orden_items", "stg_clientes", "map_producto")
RESET_ORDERS = {
    "utility": ("fact_ventas", "metas_ventas", "association_rules", "dim_producto", "dim_cliente", "dim_tiempo"),
    "full": ("fact_ventas", "dim_producto", "dim_cliente", "dim_tiempo", "map_producto", "stg_orden_items", "stg_clientes", "tipo_cambio"),
}


def reset_warehouse(spark: SparkSession, base: str, previous: str, variant: str = "utility") -> tuple[str, list[str]]:
    """SNK7: a version in which the tables of ``variant`` are empty; returns its manifest and the tables in the order cleared.

    "utility" clears targets and rules too, "full" clears staging and rates
    instead.  Tables the version does not have are passed over.
    """
    version = read_version(spark, previous)
    cleared = [t for t in RESET_ORDERS[variant] if t in version["tables"]]
    return commit(spark, base, {t: version_table(spark, version, t).limit(0) for t in cleared}, previous), cleared


def reset_staging(spark: SparkSession, base: str, previous: str, source: str | None = None) -> str:
    """SNK6: a version whose staging tables are empty, or hold nothing of one source."""
    version = read_version(spark, previous)
    out = {}
    for t in STAGING_TABLES:
        if t in version["tables"]:
            df = version_table(spark, version, t)
            out[t] = df.limit(0) if source is None else df.where(df["source_system"] != source)
    return commit(spark, base, out, previous)
