import pytest
from pyspark.sql import functions as F

from metaskein.functions import text as X


def one(spark, expr, **values):
    types = {str: "string", int: "int", float: "double", bool: "boolean", type(None): "string"}
    schema = ", ".join(f"{k} {types[type(v)]}" for k, v in values.items()) or "z int"
    return spark.createDataFrame([tuple(values.values()) or (1,)], schema).select(expr.alias("x")).first().x


@pytest.mark.parametrize("value, text", [(0.0, "0"), (0.99, "0"), (12.5, "12.50"), (1.005, "1.00"), (100.0, "100.00"), (None, None)])
def test_null_percentage_text(spark, value, text):
    df = spark.createDataFrame([(value,)], "c double")
    assert df.select(X.null_percentage_text("c").alias("x")).first().x == text


@pytest.mark.parametrize("value, numbers", [
    ("1,1,0,-1", [1, 1, 0, -1]), (" 2 ,x", [2, 0]), ("", [1, 1, 0, -1]), (None, [1, 1, 0, -1]), ("3,,4", [3, 0, 4])])
def test_cardinality(spark, value, numbers):
    assert one(spark, X.cardinality_array("c"), c=value) == numbers


def test_cardinality_text(spark):
    df = spark.sql("select array(1.0D, 2.9D, -1.0D) c")
    assert df.select(X.cardinality_text("c").alias("x")).first().x == "1,2,-1"


@pytest.mark.parametrize("value, kept", [("a", "a"), (" a ", " a "), ("", None), ("  ", None), (None, None)])
def test_blank_to_null(spark, value, kept):
    assert one(spark, X.blank_to_null("c"), c=value) == kept


def test_names(spark):
    assert one(spark, X.fqdn("a", "b"), a="s", b=None) == "s."
    assert one(spark, X.fqdn_strict("a", "b"), a="s", b=None) is None
    assert one(spark, X.fqdn_part("a", 2), a="s.t") is None
    assert one(spark, X.fqdn_part("a", 1), a="s.t") == "t"
    assert one(spark, X.set_id("a"), a=None) == "___DOES_NOT_EXIST___"
    assert one(spark, X.item_id("a"), a=" S.T ") == "s.t"
    assert one(spark, X.endpoint_stub("f", "s", "t", "i"), f="", s="S", t="T", i="I") == "s.t.i"
    assert one(spark, X.endpoint_stub("f", "s", "t", "i"), f="F.x", s="S", t="T", i="I") == "f.x"
    assert one(spark, X.pair_id("a", "b"), a="P", b="C") == "p::c"
    assert one(spark, X.strip_array_prefix("a"), a="__int4") == "int4"


def test_schema_patterns(spark):
    df = spark.createDataFrame([("sales",), ("salesX",), ("pg_catalog",), ("Sales",), ("a1",)], "s string")
    match = lambda p: sorted(r.s for r in df.where(X.schema_matches("s", p)).collect())
    assert match(None) == ["Sales", "a1", "sales", "salesX"]
    assert match(["sales*"]) == ["sales", "salesX"]
    assert match(["a_", "pg*"]) == ["a1", "pg_catalog"]


def test_primary_key_is_first_by_name(spark):
    df = spark.sql("""select array(named_struct('name','b','type','PRIMARY key'), named_struct('name','a','type','primary'),
        named_struct('name','0','type','foreign')) keys""")
    assert df.select(X.primary_key_of("keys")["name"].alias("x")).first().x == "a"
    assert df.select(X.primary_key_of(F.filter("keys", lambda k: k["name"] == "0"))["name"].alias("x")).first().x is None
