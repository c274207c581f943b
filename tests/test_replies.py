"""Requests after replies: what is done, what is sent again, and which ids new sets brought."""

from pyspark.sql import functions as F

from metaskein.operators import cascade, delta

SETS = "change_type string, physical_nm string, logical_nm string, schema string, description string, definition string, catalog_id string"
ITEMS = ("change_type string, logical_nm string, physical_nm string, dataset_id string, nullable boolean, description string, type string, default_val string, "
         "key_name string, key_type string, metadata string, example string, set_id string, item_id string, new_set string")


def item(change, name, set_id, new_set=None, item_id=None):
    return (change, "", name, "t", True, "", "text", "", None, None, None, "", set_id, item_id, new_set)


def requests(spark):
    sets = spark.createDataFrame([("add", "a", "", "s", "", "", None), ("add", "b", "", "s", "", "", None), ("delete", "c", "", "s", "", "", "3"),
                                  ("delete", "lost", "", "s", "", "", None), ("update", "blank", "", "s", "", "", " ")], SETS)
    items = spark.createDataFrame([item("add", "x", None, "s.a"), item("add", "y", None, "s.b"), item("update", "z", "9"),
                                   item("delete", "g", None, item_id="5"), item("delete", "h", None), item("add", "nowhere", None)], ITEMS)
    assert sorted(r.physical_nm for r in delta.unsendable_sets(sets).collect()) == ["blank", "lost"]
    assert sorted(r.physical_nm for r in delta.unsendable_items(items).collect()) == ["h", "nowhere"]
    return delta.set_payloads(sets).unionByName(delta.item_payloads(items, 10))


def after(spark, made, answers):
    ids = {(r.entity, r.phase, r.target_id, r.target_name): r.request_id for r in delta.with_request_ids(made).collect()}
    replies = spark.createDataFrame([(ids.get(k, k), ok, i) for k, ok, i in answers], "request_id string, ok boolean, id string")
    return {(r.entity, r.phase, r.target_id, r.target_name, r.ready) for r in delta.requests_after_replies(made, replies).collect()}


def test_replies(spark):
    made = requests(spark)
    whole = {("set", "add", None, "s.a", True), ("set", "add", None, "s.b", True), ("set", "delete", "3", None, True),
             ("item", "add", None, "s.a", False), ("item", "add", None, "s.b", False), ("item", "update", "9", None, True), ("item", "delete", "5", None, True)}
    assert after(spark, made, []) == whole
    a, b, c = ("set", "add", None, "s.a"), ("set", "add", None, "s.b"), ("set", "delete", "3", None)
    got = after(spark, made, [(a, True, "A2"), (a, True, "A1"), (b, False, None), (c, True, None), ("unknown", True, "U")])
    assert got == whole - {(*a, True), (*c, True), ("item", "add", None, "s.a", False)} | {("item", "add", "A1", "s.a", True)}
    assert after(spark, made, [(b, True, " ")]) == whole - {(*b, True)}  # accepted, but no id came


def test_unplaced_items(spark):
    fields = "dataset_id string, physical_nm string, logical_nm string, type string, description string, is_pk boolean, key_nm string, nullable boolean, example string, default_val string, metadata string"
    row = lambda s, n: (s, n, "", "text", "", False, "", True, "", "", None)
    db = spark.createDataFrame([row("known", "a"), row("nowhere", "a"), row("remote", "a")], fields)
    dh = spark.createDataFrame([(*row("known", "b"), "1"), (*row("nowhere", "b"), "2"), (*row("remote", "b"), "3"), (*row("plain", "b"), "4")], f"{fields}, id string")
    db_sets = spark.createDataFrame([("known", "s"), ("plain", "s")], "physical_nm string, schema string")
    dh_sets = spark.createDataFrame([("known", "s", "9"), ("remote", "s", "8"), ("plain", None, "7")], "physical_nm string, schema string, id string")
    got = {(r.change_type, r.dataset_id, r.physical_nm, r.item_id, r.in_source, r.in_catalog) for r in cascade.unresolved_items(db, dh, db_sets, dh_sets).collect()}
    assert got == {("add", "nowhere", "a", None, False, False), ("add", "remote", "a", None, False, True),
                   ("delete", "nowhere", "b", "2", False, False), ("delete", "plain", "b", "4", True, True)}
    changed = {(r.change_type, r.dataset_id) for r in cascade.item_changes(db, dh, db_sets, dh_sets).collect()}
    assert ("delete", "plain") not in changed and ("delete", "known") in changed


def test_same_delta_same_ids(spark):
    one, two = ({r.request_id for r in delta.with_request_ids(requests(spark)).collect()} for _ in range(2))
    assert one == two and len(one) == 7
    assert delta.with_request_ids(requests(spark)).select(F.countDistinct("request_id")).first()[0] == 7
