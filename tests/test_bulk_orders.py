"""Bulk upload (FIXTURES C8), validation rules, order changes, paging."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from salesmart.operators import bulk, listing, orders


def test_upsert_by_email(spark):
    stored = spark.createDataFrame([(1, "Ana", "ana@x.com", None, "CR", dt.date(2020, 1, 1))],
                                   "ClienteId int, Nombre string, Email string, Genero string, Pais string, "
                                   "FechaRegistro date")
    up = spark.createDataFrame([(1, "Ana B", "ana@x.com", None, "CR", dt.date(2024, 1, 1)),
                                (2, "Sin", None, None, "CR", None),
                                (3, "Bo", "bo@x.com", None, "PA", None)],
                               "_row long, Nombre string, Email string, Genero string, Pais string, FechaRegistro date")
    table, actions = bulk.upsert_clients_by_email(stored, up)
    rows = {r.ClienteId: r for r in table.collect()}
    assert len(rows) == 3
    assert rows[1].Nombre == "Ana B" and rows[1].FechaRegistro == dt.date(2020, 1, 1)
    assert sorted(r.accion for r in actions.collect()) == ["actualizado", "insertado", "insertado"]


def test_violations(spark):
    df = spark.createDataFrame([(1, "A", "bad-email", "Otro", "CR"), (2, "B", "b@x.com", "Femenino", "CR")],
                               "_row long, Nombre string, Email string, Genero string, Pais string")
    v = {r._row: sorted(r.violaciones) for r in bulk.sheet_violations(df, bulk.client_rules_mssql()).collect()}
    assert v == {1: ["email_invalido", "genero_invalido"]}


def test_order_changes(spark):
    o = spark.createDataFrame([("o1", "c"), ("o2", "c")], "orden_id string, cliente_id string")
    lines = spark.createDataFrame([("o1", "p1", 1), ("o2", "p2", 2)], "orden_id string, producto_id string, cantidad int")
    ev = spark.createDataFrame([
        ("o1", "delete", None, 1), ("o2", "update", [("p3", 5)], 1), ("o9", "delete", None, 1),
        ("o3", "create", [("p4", 1)], 1)],
        "orden_id string, op string, items array<struct<producto_id:string, cantidad:int>>, seq int")
    oo, ll, rej = orders.apply_order_changes(o, lines, ev)
    assert sorted(r.orden_id for r in oo.collect()) == ["o2", "o3"]
    assert sorted((r.orden_id, r.producto_id, r.cantidad) for r in ll.collect()) == [("o2", "p3", 5), ("o3", "p4", 1)]
    assert [r.orden_id for r in rej.collect()] == ["o9"]


def test_paging_rules(spark):
    with pytest.raises(ValueError):
        listing.PageSpec(limit=101)
    df = spark.range(1, 51).select(F.col("id").alias("k"), (F.col("id") % 3).alias("v"))
    p = listing.page(df, "k", listing.PageSpec(page=2, limit=5, sort_by="v"), ("v",)).collect()
    assert [(r.v, r.k) for r in p] == [(0, 18), (0, 21), (0, 24), (0, 27), (0, 30)]
    f = listing.apply_filter_spec(df, {"v": ("eq", 0), "k": ("gte", 0)})   # a 0 bound is honoured (D16)
    assert f.count() == 16


def test_order_by_id_path(spark):
    o = spark.createDataFrame([("ORD-1", "WEB"), ("ORD-2", "APP")], "id string, canal string")
    r = spark.createDataFrame([("C1", "ORD-1"), ("C2", "ORD-2")], "from_id string, to_id string")
    c = spark.createDataFrame([("ORD-1", "P1", 2, 1.5), ("ORD-1", "P9", 1, 2.0)],
                              "from_id string, to_id string, cantidad int, precio_unit double")
    p = spark.createDataFrame([("P1", "Lamp")], "id string, nombre string")
    rows = orders.order_by_id(o, r, c, p, "ORD-1").collect()
    assert [(x.cliente_id, x.producto_id, x.producto_nombre) for x in rows] == [("C1", "P1", "Lamp")]
