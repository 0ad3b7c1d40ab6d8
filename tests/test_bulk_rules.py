"""Per-field accept/reject of the bulk sheet rules (the reference's own
strongest test area): emails, enums, non-positive numbers, discount bounds,
optional fields."""
import pytest

from salesmart.operators import bulk


def _codes(spark, schema, row, rules):
    df = spark.createDataFrame([(1,) + row], "_row long, " + schema)
    out = bulk.sheet_violations(df, rules).collect()
    return sorted(out[0].violaciones) if out else []


CLIENT = "Nombre string, Email string, Genero string, Pais string"


@pytest.mark.parametrize("row,expected", [
    (("Ana", "ana@x.com", "Femenino", "CR"), []),
    (("Ana", None, None, "CR"), []),                                  # email and gender optional
    (("Ana", "ana.x.com", "Femenino", "CR"), ["email_invalido"]),
    (("Ana", "a@b", "Femenino", "CR"), ["email_invalido"]),
    (("", "ana@x.com", "Femenino", "CR"), ["nombre_requerido"]),
    (("A" * 121, "ana@x.com", "Femenino", "CR"), ["nombre_largo"]),
    (("Ana", "ana@x.com", "F", "CR"), ["genero_invalido"]),
    (("Ana", "ana@x.com", "Femenino", " "), ["pais_requerido"]),
])
def test_client_rules_mssql(spark, row, expected):
    assert _codes(spark, CLIENT, row, bulk.client_rules_mssql()) == expected


LINE = "OrdenIndex int, Cantidad int, PrecioUnit int, DescuentoPct int, SKU string"


@pytest.mark.parametrize("row,expected", [
    ((1, 2, 10, None), []),
    ((1, 2, 10, 0), []),
    ((1, 2, 10, 100), []),
    ((1, 2, 10, 101), ["descuento_invalido"]),
    ((1, 2, 10, -1), ["descuento_invalido"]),
    ((0, 2, 10, None), ["orden_index_invalido"]),
    ((1, 0, 10, None), ["cantidad_invalida"]),
    ((1, -3, 10, None), ["cantidad_invalida"]),
    ((1, 2, 0, None), ["precio_invalido"]),
])
def test_line_rules_mssql(spark, row, expected):
    assert _codes(spark, LINE, (*row, "SKU-0001"), bulk.line_rules_mssql()) == expected


ORDER_MYSQL = "correo string, moneda string, total string, canal string"


@pytest.mark.parametrize("row,expected", [
    (("a@x.com", "USD", "1,200.50"), []),
    (("a@x.com", None, "1200,50"), []),                              # currency defaults to USD
    (("a@x.com", "EUR", "10"), ["moneda_invalida"]),
    (("a@x.com", "CRC", "abc"), []),                                 # any text is accepted as a total
    (("a@x.com", "CRC", None), ["total_requerido"]),
    ((None, "CRC", "10"), ["correo_invalido"]),
])
def test_order_rules_mysql(spark, row, expected):
    assert _codes(spark, ORDER_MYSQL, (*row, "web"), bulk.order_rules_mysql()) == expected


def test_mysql_gender_default(spark):
    schema = "nombre string, correo string, genero string, pais string"
    assert _codes(spark, schema, ("A", None, None, "CR"), bulk.client_rules_mysql()) == []
    assert _codes(spark, schema, ("A", None, "Q", "CR"), bulk.client_rules_mysql()) == ["genero_invalido"]
