import pytest
from pyspark.sql import functions as F

from checks.queries import Inputs
from conftest import rows
from metaskein.operators import cascade as K
from metaskein.operators import diff as D
from metaskein.operators import snapshot as N
from metaskein.sources import schemas


@pytest.fixture(scope="module")
def i(spark, sf_dir):
    return Inputs(spark, sf_dir)


def test_a_snapshot_does_not_differ_from_itself(i):
    dh = {t: getattr(i, f"dh_{t}") for t in schemas.TABLES}
    assert K.set_changes(dh["dataset"], dh["dataset"]).isEmpty()
    assert K.item_changes(dh["dataitem"], dh["dataitem"], dh["dataset"], dh["dataset"]).isEmpty()
    assert K.relationship_changes(dh["relationship"], dh["relationship"], dh["dataset"], dh["dataset"]).isEmpty()
    assert D.joins_updated(dh["join"], dh["join"], dh["relationship"]).isEmpty()


def test_new_and_deleted_are_disjoint(i):
    new = D.items_new_scoped(i.db_dataitem, i.dh_dataitem, i.db_dataset)
    gone = D.items_deleted_scoped(i.db_dataitem, i.dh_dataitem, i.dh_dataset)
    assert new.join(gone, ["dataset_id", "physical_nm"], "left_semi").isEmpty()


def test_upsert_is_idempotent_and_last_wins(spark):
    old = spark.createDataFrame([("a", "1"), ("b", "1")], "k string, v string")
    new = spark.createDataFrame([("b", "2", 1), ("b", "3", 2), ("c", "4", 1), ("b", "0", None)], "k string, v string, seq int")
    once = N.upsert(old, new, ["k"], ["seq"])
    assert rows(once) == [("a", "1"), ("b", "3"), ("c", "4")]
    assert rows(N.upsert(once, new, ["k"], ["seq"])) == rows(once)
    assert rows(N.reset(once)) == [] and N.reset(once).schema == once.schema


def test_applying_the_changes_gives_the_source(i):
    """add + update - delete on the catalog's names yields exactly the source's items."""
    changes = K.item_changes(i.db_dataitem, i.dh_dataitem, i.db_dataset, i.dh_dataset)
    keys = ["dataset_id", "physical_nm"]
    named = i.dh_dataitem.join(i.dh_dataset.select(F.col("physical_nm").alias("dataset_id")), "dataset_id", "left_semi")
    live_sets = i.db_dataset.select(F.col("physical_nm").alias("dataset_id"))
    live = named.join(live_sets, "dataset_id", "left_semi").select(*keys)
    gone = changes.where("change_type = 'delete'").select(*keys)
    added = changes.where("change_type = 'add'").select(*keys)
    applied = live.join(gone, keys, "left_anti").union(added).distinct()
    wanted = i.db_dataitem.select(*keys)
    assert applied.exceptAll(wanted).isEmpty()
    missing = wanted.exceptAll(applied)
    # What is left out belongs to sets the catalog lists no set row for, hence cannot compare.
    assert missing.join(i.dh_dataset.select(F.col("physical_nm").alias("dataset_id")), "dataset_id", "left_semi").isEmpty()


def test_names_with_separators_stay_apart(spark):
    """A pair is compared as two columns, so '::' inside a name cannot glue two pairs together."""
    db = spark.createDataFrame([("f", "a::b", "c", 1, "")], schemas.JOIN)
    dh = spark.createDataFrame([("g", "a", "b::c", 1, "")], schemas.JOIN)
    rel = spark.createDataFrame([("z",)], "physical_nm string")
    assert D.joins_new(db, dh, rel).count() == 1


def test_item_updated_and_deleted_under_one_name_is_not_updated(spark):
    sets = spark.createDataFrame([("t", "t", "s", "", "TABLE", "")], schemas.DATASET)
    make = lambda r, side: spark.createDataFrame(r, schemas.snapshot_schema("dataitem", side))
    row = lambda nm, ty, *more: ("t", nm, "", ty, "", False, "", True, "", "", None, *more)
    db = make([row("a", "int4")], "source")
    dh = make([row("a", "text", "I1"), row("A", "text", "I2")], "catalog")
    out = K.item_changes(db, dh, sets, sets.withColumn("id", F.lit("S")))
    assert [(r.change_type, r.physical_nm) for r in out.collect()] == [("delete", "A")]
