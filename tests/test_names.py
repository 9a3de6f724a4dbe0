import pytest
from hypothesis import given
from hypothesis import strategies as st

from quayside.functions.names import external_name, normalize_names, plain_name, safe_name, sanitize_names
from quayside.functions.names import rename_all
from pyspark.sql import functions as F


@pytest.mark.parametrize(
    "given_name, expected",
    [
        ("Código do Produto", "CODIGO_DO_PRODUTO"),
        ("  Preço (R$)  ", "PRECO_R"),
        ("AÇÃO", "ACAO"),
        ("já_feito", "JA_FEITO"),
        ("a   b", "A_B"),
        ("a\tb", "AB"),
        ("№ 1", "1"),
    ],
)
def test_plain_name(given_name, expected):
    assert plain_name(given_name) == expected


@given(st.text())
def test_plain_name_twice_is_once(name):
    assert plain_name(plain_name(name)) == plain_name(name)


def test_safe_name():
    assert safe_name("a.b$c d") == "a_b_c_d"


def test_collision_raises(spark):
    df = spark.range(1).selectExpr("id as `Preço`", "id as `preco`")
    with pytest.raises(ValueError, match="collide"):
        normalize_names(df)
    with pytest.raises(ValueError, match="empty"):
        rename_all(spark.range(1).selectExpr("id as `???`"), plain_name)


def test_dotted_names_can_be_renamed(spark):
    df = spark.range(1).selectExpr("id as `a.b`", "id as `$c`")
    assert sanitize_names(df).columns == ["a_b", "_c"]


def test_external_name(spark):
    df = spark.createDataFrame([("Vendas__Dia",)], "t string")
    assert df.select(external_name(F.col("t"))).first()[0] == "ext_vendas_dia"
