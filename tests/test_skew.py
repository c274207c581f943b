"""Joins that can be split and part numbering must not change results, whatever a key's share of the rows."""

import re

import pytest
from pyspark.sql import functions as F

from checks.queries import Inputs
from conftest import rows
from metaskein.operators import catalog, delta, skew, snapshot


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one key; NULL keys occur too."""
    return spark.range(600).select(
        F.expr("case when id % 3 = 0 then 'hot' when id % 50 = 1 then null else concat('k', id % 97) end").alias("k"),
        F.col("id").alias("v"))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("keys_kept", ["k in ('hot', 'k1', 'k5')", "k in ('k2')"])
def test_split_join_is_the_plain_join(skewed, how, keys_kept):
    right = skewed.select("k").distinct().where(keys_kept).withColumn("w", F.lit(1))
    plain = skewed.join(right, "k", how)
    assert rows(skew.split_join(skewed, right, ["k"], how).select(*plain.columns)) == rows(plain)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_hashed_split_join_is_the_plain_join(skewed, how):
    right = skewed.select("k").distinct().where("k is null or k in ('hot', 'k1', 'k5')").withColumn("w", F.lit(1))
    plain = skewed.join(right, "k", how)
    got = skew.split_join(skewed, right, ["k"], how, hashed=True)
    assert set(got.columns) == set(plain.columns) and rows(got.select(*plain.columns)) == rows(plain)


def test_without_allows_repeated_keys(skewed):
    right = skewed.where("k in ('hot', 'k4')")
    got = skew.without(skewed.dropna(), right, ["k"])
    assert rows(got.select("k", "v")) == rows(skewed.where("k not in ('hot', 'k4')"))


def test_parts_are_complete_and_without_gaps(skewed):
    parts = skew.number_in_parts(skewed, ["k"], ["v"], 7)
    assert rows(parts.select("k", "v")) == rows(skewed)
    sizes = {}
    for r in parts.groupBy("k", "part").count().collect():
        sizes.setdefault(r["k"], {})[r["part"]] = r["count"]
    for of_key in sizes.values():
        assert sorted(of_key) == list(range(len(of_key)))
        assert all(n == 7 for part, n in of_key.items() if part < len(of_key) - 1)
        assert 1 <= of_key[len(of_key) - 1] <= 7


def test_parts_depend_on_the_rows_alone(skewed):
    once = skew.number_in_parts(skewed.coalesce(1), ["k"], ["v"], 7)
    again = skew.number_in_parts(skewed.repartition(5, "v"), ["k"], ["v"], 7)
    assert rows(once) == rows(again)


def test_reset_is_an_empty_table_of_the_same_columns(skewed, tmp_path):
    snapshot.reset(skewed).write.parquet(f"{tmp_path}/v2")
    written = skewed.sparkSession.read.parquet(f"{tmp_path}/v2")
    assert written.count() == 0
    assert written.columns == skewed.columns


@pytest.mark.parametrize("large", [3, 50, 10_000])
def test_large_keys_are_numbered_alike(skewed, large):
    parts = skew.number_in_parts(skewed, ["k"], ["v"], 7, large)
    assert rows(parts) == rows(skew.number_in_parts(skewed, ["k"], ["v"], 7))


def test_parts_follow_buckets_then_order(skewed):
    got = rows(skew.number_in_parts(skewed.where("k = 'hot'"), ["k"], ["v"], 7, 20).select("v", "part"))
    listed = skewed.where("k = 'hot'").select("v").withColumn("b", skew.bucket(["v"])).orderBy("b", "v").collect()
    assert got == sorted(((r.v, n // 7) for n, r in enumerate(listed)), key=lambda t: (str(t[0]), str(t[1])))


def test_rows_to_number_are_made_once_and_grouped_without_a_shuffle(spark, skewed):
    source = skewed.withColumn("w", F.col("v") * 2)
    made = skew.number_in_parts(source, ["k"], ["v"], 7).groupBy("k", "part").agg(F.collect_list("w"))
    text = made._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1 and text.count("Scan parquet") == 1 and "Join" not in text


@pytest.fixture
def plain_shuffles(spark):
    """Every join shuffles, into 16 partitions that nothing coalesces or splits."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def largest_share(df):
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    return max(sizes) / sum(sizes)


def test_spread_join_is_the_plain_join_and_deals_out_missing_keys(spark, plain_shuffles):
    left = spark.range(2000).selectExpr("case when id % 10 < 3 then id % 7 end as a", "case when id % 9 > 0 then cast(id % 4 as int) end as b", "id as v")
    right = spark.range(40).selectExpr("case when id > 0 then id % 8 end as c", "id % 5 as d", "id as w")  # keys repeat, and one is NULL
    plain = left.join(right, (F.col("c") == F.col("a")) & (F.col("d") == F.col("b")), "left")
    spread = skew.spread_join(left, right, {"a": "c", "b": "d"}, ["v"])
    assert spread.columns == plain.columns and rows(spread) == rows(plain)
    one = left.withColumn("b", F.lit(1))
    assert largest_share(skew.spread_join(one, right, {"a": "c", "b": "d"}, ["v"])) < 0.5


def test_columns_without_a_key_or_comment_do_not_meet_in_one_task(spark, plain_shuffles):
    i = Inputs(spark, "/root/testdata/sf0.001")
    tables = i.catalog("columns", "pg_class", "pg_namespace", "pg_attribute", "pg_index", "description", "key_column_usage", "table_constraints")
    columns = tables["columns"].selectExpr("table_schema as _schema", "table_name as _table", "column_name as _column", "ordinal_position as position")
    tables["key_column_usage"] = tables["key_column_usage"].where("ordinal_position > 1")  # most columns are in no key
    assert largest_share(catalog._with_keys_and_comments(columns, tables, True)) < 0.3


def test_comments_of_foreign_keys_are_found_by_name(spark, plain_shuffles):
    text = Inputs(spark, "/root/testdata/sf0.001").foreign_keys()._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"SortMergeJoin \[relid#\d+L?, _x_name#\d+\]", text)  # not for every key with all of its columns


def test_requests_that_need_no_id_do_not_meet_in_one_task(spark, plain_shuffles):
    made = spark.range(1000).selectExpr("3 as phase_no", "'update' as phase", "'item' as entity", "concat('S', id % 7) as target_id", "id as part",
                                        "'{}' as body", "cast(null as string) as target_name")
    replies = spark.createDataFrame([], "request_id string, ok boolean, id string")
    left = delta.requests_after_replies(made, replies)
    assert left.count() == 1000 and largest_share(left) < 0.3
