"""What the change feed and its readers leave on disk, and that leaving it out changes no rows."""

import re
import time

import pytest
from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.queries import Inputs
from conftest import rows
from metaskein.operators import cascade, delta
from metaskein.operators.snapshot import latest_rows
from metaskein.session import FREE_SHUFFLES, cut, handed_over
from metaskein.sources import schemas


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffle_files(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return set(re.findall(r"shuffle_\d+_\d+_\d+\.data", manager.getAllFiles().mkString(" ")))


def test_shuffles_of_a_stage_are_deleted_when_it_is_handed_over(spark):
    made = lambda: spark.range(1000).groupBy((F.col("id") % 100).alias("k")).count()
    before, own = shuffle_files(spark), made()
    out = handed_over(own)
    for _ in range(50):  # they are deleted in the background
        if shuffle_files(spark) <= before:
            break
        time.sleep(0.2)
    assert shuffle_files(spark) <= before and spark.conf.get(FREE_SHUFFLES) == "false"
    assert rows(out) == rows(own) == rows(own)
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        handed_over(made().select(F.expr("k / (count - count)")))
    assert spark.conf.get(FREE_SHUFFLES) == "false"


def test_the_states_of_relationships_are_handed_over(spark, sf_dir):
    before = shuffle_files(spark)
    joins = Inputs(spark, sf_dir).all_changes()[3]
    for _ in range(50):
        if shuffle_files(spark) <= before:
            break
        time.sleep(0.2)
    assert shuffle_files(spark) <= before
    assert "o_orderkey" not in plan(joins) and "Scan ExistingRDD" not in plan(joins)


BASE = ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, "
        "l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz")


@pytest.mark.parametrize("name", [f"{side}_{t}" for side in ("db", "dh", "wdb", "wdh") for t in fx.UPSERTED])
def test_the_last_row_of_a_key_is_found_without_the_numbers_beside_it(name, spark):
    """Against the rule over whole rows, with repeated keys and with NULL in each number."""
    some = lambda n, k: f"case when id % {k} = 0 then null else {n} end"
    lines = spark.range(4000).selectExpr(
        f"{some('id % 37 - 3', 41)} as l_orderkey", f"{some('id % 5 + 20', 43)} as l_partkey", f"{some('id % 3', 47)} as l_suppkey",
        f"cast({some('id % 2 + 1', 53)} as int) as l_linenumber", f"{some('cast(id % 7 as double)', 59)} as l_quantity", "id / 10d as l_extendedprice",
        "0.1d as l_discount", "0.2d as l_tax", f"{some('substring(hex(id % 3 + 10), 1, 1)', 61)} as l_returnflag", "'F' as l_linestatus",
        "cast(date_add(date'1995-01-01', cast(id % 11 as int)) as timestamp_ntz) as l_shipdate").to(spark.createDataFrame([], BASE).schema)
    side, table = name.split("_", 1)
    keys = schemas.KEYS[table]
    got = fx.snapshot({"lineitem": lines}.get, name)
    rule = "true" if side in fx.WHOLE else fx.SNAPSHOT[table][1][fx.SIDE[side]]
    made = {c: F.expr(e) for c, e in fx._columns(table, side).items()}
    last = latest_rows(lines.where(rule).withColumns({k: made[k] for k in keys}), keys, [*fx.ORDER, *fx.NUMBERS])
    want = last.select(*[F.col(c) if c in keys else e.alias(c) for c, e in made.items()])
    assert got.schema == want.schema and got.count() > 100
    assert rows(got) == rows(want)


def test_shuffles_of_the_sides_carry_no_column_that_the_key_holds(spark, sf_dir, monkeypatch):
    """What the key holds stands in one column, which is NULL for a key without NULL; of items only the order is needed beside it."""
    shuffled = []
    monkeypatch.setattr(fx, "latest_rows", lambda df, *a: (shuffled.append(df), latest_rows(df, *a))[1])
    for name, rest in (("db_join", []), ("dh_dataitem", fx.ORDER)):
        Inputs(spark, sf_dir)._make(name)
        assert shuffled[-1].columns == [*schemas.KEYS[name.split("_", 1)[1]], *rest, "_held"]
        assert shuffled[-1].count() > 0 and shuffled[-1].where("_held is not null").count() == 0


ITEM = ("dataset_id string, physical_nm string, logical_nm string, type string, description string, is_pk boolean, key_nm string, "
        "nullable boolean, example string, default_val string, metadata string")
SET = "physical_nm string, logical_nm string, schema string, description string, type string, definition string"


def test_updates_alone_are_looked_up_among_deletions(spark):
    """The name of an update is compared without case, and rows that cannot be dropped are shuffled no second time."""
    item = lambda d, n, kind, *more: (d, n, n, kind, "", False, "", False, "", "", None, *more)
    db = spark.createDataFrame([item("s", "a", "int4"), item("s", "b", "int4"), item("s", "New", "int4"), item(None, "x", "int4"), item("s", None, "t")], ITEM)
    dh = spark.createDataFrame([item("s", "a", "text", "1"), item("s", "A", "text", "2"), item("s", "b", "text", "3"), item("s", "new", "text", "4"),
                                item(None, "x", "text", "5"), item("s", None, "u", "6")], f"{ITEM}, id string")
    sets = spark.createDataFrame([("s", "s", "p", "", "", "")], SET)
    found = cascade.item_changes(db, dh, sets, sets.withColumn("id", F.lit("S")), store=True)
    plain = cascade.item_changes(db, dh, sets, sets.withColumn("id", F.lit("S")))
    assert found.columns == plain.columns and rows(found) == rows(plain)
    assert rows(found.select("change_type", "dataset_id", "physical_nm")) == rows(spark.createDataFrame(
        [("add", "s", "New"), ("add", None, "x"), ("add", "s", None), ("delete", "s", "A"), ("delete", "s", "new"), ("delete", "s", None), ("update", "s", "b")],
        "a string, b string, c string"))
    assert "Window" not in plan(found) and plan(found).count("FullOuter") == 0


def test_only_pairs_of_the_relationships_at_hand_are_numbered(spark, monkeypatch):
    pairs = spark.range(60).selectExpr(
        "case when id % 30 = 0 then null else concat('fk_', id % 6) end as db_relationship_id", "concat('p.s.', id) as parent_fqdn", "concat('p.t.', id) as child_fqdn",
        "cast(id as int) as position", "'1,1,0,-1' as cardinality", "'p' as parent_schema", "'s' as parent_set", "'p' as child_schema", "'t' as child_set")
    names = spark.createDataFrame([("fk_1",), ("fk_4",), ("fk_9",), (None,)], "physical_nm string")
    rels = names.selectExpr("'add' as change_type", "physical_nm", "'' as logical_nm", "'' as on_update", "'' as on_delete", "'' as on_match")
    numbered, number = [], delta.number_in_parts
    monkeypatch.setattr(delta, "number_in_parts", lambda df, *a: (numbered.append(df.count()), number(df, *a))[1])
    parts = delta.relationship_bodies(rels, pairs, 3)
    assert rows(parts.groupBy("physical_nm").agg(F.count("*"), F.sum(F.size("body.items")))) == [("fk_1", 4, 10), ("fk_4", 4, 10)]
    assert numbered == [20]


def test_entries_of_the_feed_are_made_after_they_are_numbered(spark, monkeypatch):
    feed = spark.range(25).selectExpr("'item' as entity", "'add' as change_type", "concat('i', id) as entity_id", "cast(null as string) as catalog_id",
                                      "'p' as schema", "'s' as set_nm", "concat('n\"', id) as name")
    columns, number = [], delta.number_in_parts
    monkeypatch.setattr(delta, "number_in_parts", lambda df, *a: (columns.extend(df.columns), number(df, *a))[1])
    found = delta.diff_json(feed, 10)
    assert "entry" not in columns and set(columns) == set(feed.columns)
    entry = F.from_json("json", "add array<struct<entity_id:string,schema:string,set_nm:string,name:string>>")["add"]
    listed = found.select(F.explode(entry).alias("e")).select("e.*")
    assert found.count() == 3 and rows(listed) == rows(feed.select("entity_id", "schema", "set_nm", "name"))
    assert not found.where("json like '%catalog_id%'").count()


def test_join_keys_are_not_shuffled_beside_their_columns(spark):
    from metaskein.operators.skew import split_join
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = cut(spark.range(50).selectExpr("case when id % 9 = 0 then null else concat('k', id % 7) end as k", "id as v"))
        text = plan(split_join(left, left.select("k").distinct(), ["k"], "left_semi"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "AS _key#" not in text and "struct(k, k#" in text
