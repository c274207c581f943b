"""Plans hold no nested loops, no cartesian products and no single-task windows."""

import re

import pytest
from pyspark.sql import functions as F

from checks.queries import OPERATIONS, Inputs
from conftest import rows
from metaskein.operators import cascade, document
from metaskein.operators.skew import number_in_parts

CHECKED = ["sets_new", "sets_deleted", "sets_updated", "items_new", "items_deleted", "items_new_scoped", "items_deleted_scoped",
           "items_updated", "relationships_new", "relationships_deleted", "relationships_updated", "joins_new", "joins_deleted",
           "joins_updated", "set_delta_cascade", "item_delta_cascade", "relationship_delta_cascade", "join_delta_cascade",
           "change_feed", "delta_preview", "entities_flatten", "entities_flatten_strict", "matview_columns", "fk_resolution",
           "endpoint_resolution", "set_id_resolution", "payload_items", "merge_sets", "set_links"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("big", [False, True])
@pytest.mark.parametrize("name", CHECKED)
def test_no_nested_loops(name, big, spark, sf_dir):
    if big:  # as if no table were small enough to broadcast by size
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(OPERATIONS[name](Inputs(spark, sf_dir)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "NestedLoop" not in text and "Cartesian" not in text
    assert "Window [" not in text or "SinglePartition" not in text


def test_upsert_limits_before_the_shuffle(spark, sf_dir):
    text = plan(Inputs(spark, sf_dir).db_dataitem)
    assert text.count("WindowGroupLimit") == 2  # in each task, and after the exchange


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    text = plan(OPERATIONS["sets_updated"](Inputs(spark, sf_dir)))
    assert "p_retailprice" not in text and "PushedFilters: [IsNotNull(p_partkey)" in text


def test_documents_are_parsed_once(spark, sf_dir):
    text = plan(OPERATIONS["catalog_sets"](Inputs(spark, sf_dir)))
    assert text.count("from_json(") == 1


@pytest.mark.parametrize("name", ["stash_items", "catalog_sets", "catalog_relationships"])
def test_documents_are_made_before_they_are_parsed(name, spark, sf_dir):
    """Spark compiles nothing that from_json reads."""
    lines = [x for x in plan(OPERATIONS[name](Inputs(spark, sf_dir))).splitlines() if "Project [from_json(" in x]
    assert lines and not any("StructsToJson" in x for x in lines)


def test_parts_need_no_single_task(spark):
    text = plan(number_in_parts(spark.range(100).selectExpr("id % 3 as k", "id as v"), ["k"], ["v"], 5))
    assert "SinglePartition" not in text


def test_pair_cascade_joins_the_sides_once(spark, sf_dir):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        i = Inputs(spark, sf_dir)
        for name in ("db_join", "dh_join", "db_relationship", "dh_relationship", "db_dataset", "dh_dataset"):  # as stored, so that only the cascade's shuffles count
            i._made[name] = spark.createDataFrame([], getattr(i, name).schema).union(spark.createDataFrame([], getattr(i, name).schema))
        text = plan(i.join_changes())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("Exchange hashpartitioning") <= 15 and text.count("FullOuter") == 3


def test_cascades_shuffle_each_side_once_and_carry_only_changes(spark, sf_dir):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        i = Inputs(spark, sf_dir)
        text = plan(i.join_changes())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    shuffles = [line for line in text.split("\n") if re.search(r"[-:] Exchange hashpartitioning\(db_relationship_id#\d+, parent_fqdn", line)]
    assert len(shuffles) == 2 and text.count("ReusedExchange") >= 2  # the lookup of pairs reads the two sides' shuffles again
    assert not {"db", "dh"} & set(cascade._item_states(i.db_dataitem, i.dh_dataitem, i.db_dataset, i.dh_dataset).columns)
    states = cascade.relationship_states(i.db_relationship, i.dh_relationship, i.db_dataset, i.dh_dataset)
    same = states.where("change_type is null")
    assert same.count() > 0 and same.where("db is null or dh is null or dh.id is null or db.comment is not null").count() == 0


def test_endpoints_are_found_in_one_pass_and_sorted_by_number(spark, sf_dir):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        text = plan(OPERATIONS["endpoint_resolution"](Inputs(spark, sf_dir)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert text.count("Window [row_number()") == 2  # pairs are ranked for their endpoints and for the joins, not once for each end
    assert len(re.findall(r"Sort \[xxhash64\(", text)) == 4


def test_a_name_that_is_its_id_is_merged_once(spark):
    df = spark.createDataFrame([("Ds", "c", "x", 1), ("ds", "C", "", 2), ("t", "u", None, 1), (None, "u", "y", 1), ("t", None, "z", 2), (None, "u", "w", 0)],
                               "dataset_id string, physical_nm string, description string, seq int").withColumn("type", F.lit("text"))
    out = document.merge_items(df, ["seq"])
    assert out.columns == ["set_id", "item_id", "dataset_id", "physical_nm", "type", "description"]
    assert rows(out) == rows(spark.createDataFrame(
        [("ds", "c", "Ds", "c", "text", "x"), ("t", "u", "t", "u", "text", ""), (None, "u", None, "u", "text", "y"), ("t", None, "t", None, "text", "z")], out.schema))
    sorted_rows = plan(out).split("Sort [")[-1]
    assert "CASE WHEN NOT (physical_nm" in sorted_rows and "CASE WHEN NOT (dataset_id" in sorted_rows
