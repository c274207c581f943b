"""Commit records: interrupted versions, reruns, the last committed version, and the plans of stored snapshots."""

import pytest
from pyspark.sql import functions as F

from checks.queries import Inputs
from conftest import rows
from metaskein.operators import cascade, diff
from metaskein.plans import sync
from metaskein.sources import schemas, snapshots


@pytest.fixture(scope="module")
def i(spark, sf_dir):
    return Inputs(spark, sf_dir)


def side_of(i, prefix):
    return {t: getattr(i, f"{prefix}_{t}") for t in schemas.TABLES}


def broken(df):
    """A table whose tasks fail."""
    return df.withColumn(df.columns[0], F.raise_error(F.lit("executor lost")).cast("string"))


def test_an_interrupted_version_is_invisible_and_can_be_rerun(spark, i, tmp_path):
    root, side = str(tmp_path), side_of(i, "db")
    assert snapshots.latest_version(spark, root, "source") is None and snapshots.latest_snapshot(spark, root, "source") is None
    snapshots.write_snapshot(side, root, "1", "source", 3)
    with pytest.raises(Exception, match="executor lost"):  # after two of the four tables
        snapshots.write_snapshot(side | {"relationship": broken(side["relationship"])}, root, "2", "source", 3)
    assert snapshots.latest_version(spark, root, "source") == "1"
    with pytest.raises(FileNotFoundError):
        snapshots.read_snapshot(spark, root, "2", "source")
    less = side | {"dataset": side["dataset"].limit(5)}
    snapshots.write_snapshot(less, root, "2", "source", 5)
    assert snapshots.latest_version(spark, root, "source") == "2"
    assert snapshots.latest_snapshot(spark, root, "source")["dataset"].count() == 5
    assert rows(snapshots.read_snapshot(spark, root, "1", "source")["dataset"]) == rows(side["dataset"])
    with pytest.raises(FileExistsError):
        snapshots.write_snapshot(side, root, "2", "source")
    assert snapshots.latest_version(spark, root, "catalog") is None


def test_a_lost_record_is_no_record(spark, i, tmp_path):
    """A job that dies while it writes the record leaves only Spark's temporary folder."""
    root = str(tmp_path)
    (tmp_path / "commits/version=1/part=source/_temporary/0").mkdir(parents=True)
    assert snapshots.latest_version(spark, root, "source") is None
    snapshots.write_snapshot(side_of(i, "db"), root, "1", "source", 2)
    assert snapshots.latest_version(spark, root, "source") == "1"


def test_upsert_makes_a_new_version_once(spark, i, tmp_path):
    root, order = str(tmp_path), {"dataset": ["physical_nm"]}
    first = i.db_dataset.where("physical_nm < 'ds_5'")
    new = i.db_dataset.withColumn("description", F.lit("new"))
    one = snapshots.upsert_snapshot({"dataset": first}, root, "1", "source", order, spark=spark, buckets=2)
    two = snapshots.upsert_snapshot({"dataset": new}, root, "2", "source", order, spark=spark, buckets=2)
    again = snapshots.upsert_snapshot({"dataset": first.limit(0)}, root, "2", "source", order, spark=spark, buckets=2)
    assert rows(one["dataset"]) == rows(first) and rows(two["dataset"]) == rows(new) == rows(again["dataset"])
    assert two["dataitem"].count() == 0


def test_a_sync_goes_on_where_it_was_lost(spark, i, tmp_path, monkeypatch):
    db, dh, root = side_of(i, "db"), side_of(i, "dh"), str(tmp_path / "a")
    whole = sync.full_sync(spark, db, dh, str(tmp_path / "b"), "1", buckets=2)
    for lost, left in (("set_changes", {"source", "catalog"}), ("relationships_of_joins", {"source", "catalog", "changes"})):
        real = getattr(cascade, lost)
        monkeypatch.setattr(cascade, lost, lambda *a, real=real: broken(real(*a)))
        with pytest.raises(Exception, match="executor lost"):
            sync.full_sync(spark, db, dh, root, "1", buckets=2)
        monkeypatch.setattr(cascade, lost, real)
        assert {r.part for r in snapshots.committed(spark, root).collect()} == left
    empty = {t: df.limit(0) for t, df in db.items()}  # the stored sides count, not what comes now
    assert rows(sync.full_sync(spark, empty, empty, root, "1", buckets=2)) == rows(whole)
    for folder in ("payloads", "reports", "outgoing"):
        assert snapshots.is_committed(spark, root, "1", folder)
    assert rows(spark.read.text(f"{root}/payloads/version=1")) == rows(spark.read.text(f"{tmp_path}/b/payloads/version=1"))
    with pytest.raises(FileExistsError):
        sync.full_sync(spark, db, dh, root, "1")


def test_key_joins_of_stored_snapshots_need_no_shuffle(spark, i, tmp_path):
    for side, prefix in (("source", "db"), ("catalog", "dh")):
        snapshots.write_snapshot(side_of(i, prefix), str(tmp_path), "1", side, 4)
    db, dh = (snapshots.read_snapshot(spark, str(tmp_path), "1", s) for s in ("source", "catalog"))
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Exchange" not in plan(diff.sets_updated(db["dataset"], dh["dataset"]))
        assert "Exchange" not in plan(cascade.set_changes(db["dataset"], dh["dataset"]))
        text = plan(cascade.item_changes(db["dataitem"], dh["dataitem"], db["dataset"], dh["dataset"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("Bucketed: true") >= 4
    on_item_key = [line for line in text.splitlines() if "Exchange hashpartitioning(dataset_id" in line and "physical_nm" in line]
    assert "Exchange" in text and not on_item_key  # the sets are looked up by one of the two columns
