import json

import pytest
from pyspark.sql import functions as F

from checks import queries as q
from checks.queries import Inputs
from conftest import rows
from metaskein.operators import cascade, delta, document, profile
from metaskein.plans import sync
from metaskein.session import checkpoint_dir, cut
from metaskein.sources import schemas, sinks, snapshots
from metaskein.sources.tables import CATALOG_TABLES, catalog_tables


@pytest.fixture(scope="module")
def i(spark, sf_dir):
    return Inputs(spark, sf_dir)


def test_full_sync(spark, i, tmp_path):
    db = {t: getattr(i, f"db_{t}") for t in schemas.TABLES}
    dh = {t: getattr(i, f"dh_{t}") for t in schemas.TABLES}
    root = str(tmp_path)
    preview = sync.full_sync(spark, db, dh, root, "1", preview_rows=3, chunk=10)
    shown = preview.where("entity = 'set' and change_type = 'delete'").orderBy("seq").collect()
    assert [r.seq for r in shown] == [1, 2, 3, 4]
    assert shown[0].line.startswith("- ds_") and shown[-1].line == "- and more..."

    sent = spark.read.text(f"{root}/payloads/version=1")
    assert {r.phase for r in sent.select("phase").distinct().collect()} == {"1_delete", "2_add", "3_update"}
    changes = {n: spark.read.parquet(f"{root}/changes/version=1/{n}") for n in sync.CHANGES}
    report = {n: spark.read.parquet(f"{root}/reports/version=1/{n}") for n in ("items", "relationships", "unresolved_relationships")}
    requests = {(e, p): [json.loads(r.value) for r in sent.where(f"entity = '{e}' and phase = '{p}'").collect()]
                for e in ("item", "relationship") for p in ("1_delete", "2_add", "3_update")}
    # Every change of an item is in a request or in the report.
    for phase, change in (("2_add", "add"), ("3_update", "update")):
        bodies = requests["item", phase]
        assert all(0 < len(b["body"]["items"]) <= 10 for b in bodies)
        reported = report["items"].where(f"change_type = '{change}'").count()
        assert sum(len(b["body"]["items"]) for b in bodies) + reported == changes["items"].where(f"change_type = '{change}'").count()
    assert len(requests["item", "1_delete"]) == changes["items"].where("change_type = 'delete'").count()
    named = [b for b in requests["item", "2_add"] if "target_id" not in b]
    new_sets = {f"{r.schema}.{r.physical_nm}" for r in changes["sets"].where("change_type = 'add'").collect()}
    assert named and {b["target_name"] for b in named} <= new_sets
    # So is every relationship that changed, or of which a column pair did.
    own = changes["relationships"].select("physical_nm").union(changes["joins"].select("db_relationship_id"))
    only_pairs = own.distinct().count() - changes["relationships"].select("physical_nm").distinct().count()
    assert only_pairs > 0
    sent_names = {x["name"]["physical"] for p in ("2_add", "3_update") for b in requests["relationship", p] for x in b["body"]["relationships"]}
    deleted = changes["relationships"].where("change_type = 'delete'").select("physical_nm")
    names = lambda df: {r[0] for r in df.collect()}
    assert sent_names | names(report["relationships"].select("physical_nm")) | names(deleted) == names(own)
    with pytest.raises(Exception):  # a version is never overwritten
        sync.full_sync(spark, db, dh, root, "1")


def test_empty_source_is_refused(spark, i, tmp_path):
    empty = snapshots.empty_snapshot(spark, "source")
    dh = {t: getattr(i, f"dh_{t}") for t in schemas.TABLES}
    with pytest.raises(ValueError, match="no sets"):
        sync.full_sync(spark, empty, dh, str(tmp_path / "a"), "1")
    sync.full_sync(spark, empty, dh, str(tmp_path / "b"), "1", allow_empty_source=True, commit=False)
    gone = spark.read.parquet(str(tmp_path / "b/changes/version=1/sets"))
    assert gone.where("change_type = 'delete'").count() == dh["dataset"].count()


def test_unknown_side():
    assert schemas.side_prefix(" Source ") == "db_" and schemas.side_prefix("CATALOG") == "dh_"
    with pytest.raises(ValueError):
        schemas.side_prefix("other")


def test_catalog_side_from_documents(i):
    made = sync.catalog_snapshot(q._set_docs(i), q._item_docs(i), q._relationship_docs(i))
    for table, df in made.items():
        assert df.columns == schemas.snapshot_schema(table, "catalog").fieldNames()
        assert df.groupBy(*schemas.KEYS[table]).count().where("count > 1").isEmpty()


def test_catalog_tables_are_lazy_scans(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "tables.parquet"))
    assert catalog_tables(spark, str(tmp_path), ["tables"])["tables"].count() == 3
    assert set(catalog_tables(spark, lambda n: spark.range(1))) == set(CATALOG_TABLES)


def test_json_columns_of_several_tables(spark):
    items = spark.createDataFrame(
        [("s", "T", "a", "json", "s.T.a"), ("s", "T", "b", "JSONB", "s.T.b"), ("s", "V", "c", "json", "s.V.c"), ("s", "T", "x", "text", "s.T.x")],
        "schema string, dataset_id string, physical_nm string, type string, fqdn string")
    sets = spark.createDataFrame([("s", "T", "TABLE"), ("s", "V", "VIEW")], "schema string, physical_nm string, type string")
    data = {"s.T": spark.createDataFrame([('{"k":1,"z":2}', '[1]'), ('bad', '{"k":{"n":1}}')], "a string, b string"),
            "s.V": spark.createDataFrame([('{"v":1}',)], "c string")}
    got = sync.expand_json_columns(items, sets, data.__getitem__, skip_views=True)
    assert rows(got.select("dataset_id", "physical_nm", "fqdn")) == [("T", "a::k", "s.T.k"), ("T", "a::z", "s.T.z"), ("T", "b::k", "s.T.k")]
    assert rows(sync.expand_json_columns(items, sets, data.__getitem__, fields=["s.v.c"]).select("physical_nm")) == [("c::v",)]
    assert sync.expand_json_columns(items.where("type = 'text'"), sets, data.__getitem__) is None
    assert profile.json_expansion_key("Ab")["name"] == "ab_json_expansion_key"


def test_document_sink_keeps_everything(spark, i, tmp_path):
    doc = document.assemble(i.db_dataset, i.db_dataitem, i.db_relationship.withColumn("schema", F.lit("s")), i.db_join, "lake", chunk=5)
    path = str(tmp_path / "doc")
    sinks.write_document(doc, path)
    lines = [json.loads(r.value) for r in spark.read.text(path).collect()]
    assert all("comment" not in line and line["name"] == "lake" for line in lines)
    seen = [item for line in lines for s in line["schemas"].values() for t in s.get("sets", {}).values() for item in t.get("items", {})]
    known = i.db_dataitem.join(i.db_dataset.selectExpr("physical_nm as dataset_id"), "dataset_id", "left_semi")
    assert len(seen) == known.count()


def test_diff_sink(spark, i, tmp_path):
    feed = cascade.change_feed(i.set_changes(), i.item_changes(), i.relationship_changes(), i.join_changes()).where("entity = 'set'")
    sinks.write_diff(delta.diff_json(feed, 10), str(tmp_path / "diff"))
    lines = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "diff")).collect()]
    assert sum(len(line[c]) for line in lines for c in ("add", "delete", "update")) == feed.count()


class FakeSession:
    """A session whose launch settings name a checkpoint folder, or not."""

    def __init__(self, configured, current=None, master="local[4]"):
        self.conf = self.sparkContext = self
        self.configured, self.current, self.master = configured, current, master

    def get(self, key, default):
        return self.configured or default

    def getCheckpointDir(self):
        return self.current

    def setCheckpointDir(self, path):
        self.current = path


def test_checkpoint_folder_comes_from_the_session():
    assert checkpoint_dir(FakeSession("/shared")) == "/shared"
    assert checkpoint_dir(FakeSession(None, "/given")) == "/given"
    own = FakeSession(None)
    assert checkpoint_dir(own) == own.current
    with pytest.raises(ValueError, match="share"):  # executors could not reach a folder of the driver's
        checkpoint_dir(FakeSession(None, master="spark://host:7077"))


def test_cut_keeps_the_rows(spark):
    assert cut(spark.range(5)).count() == 5


def test_payload_bodies(spark):
    items = spark.createDataFrame(
        [("", "c", "t", True, "", "int4", "", "pk", "primary", '{"most_common_value":"5","null_percentage":12.5,"n":{"x":1}}', "e")],
        "logical_nm string, physical_nm string, dataset_id string, nullable boolean, description string, type string, "
        "default_val string, key_name string, key_type string, metadata string, example string")
    body = json.loads(delta.item_bodies(items).select(F.to_json("body").alias("b")).first().b)
    assert body == {"name": {"physical": "c"}, "nullable": True, "udt_type": "int4", "keys": [{"name": "pk", "primary": True}],
                    "metadata": {"n": {"x": 1}}, "attributes": {"Most Common Value": "5", "Null Percentage": "12.50"}, "example": "e"}
    sets = spark.createDataFrame([("L", "t", "d", "select 1", '{"a":1}')],
                                 "logical_nm string, physical_nm string, description string, definition string, metadata string")
    body = json.loads(delta.set_bodies(sets).select(F.to_json("body").alias("b")).first().b)
    assert body == {"name": {"logical": "L", "physical": "t"}, "description": "d", "metadata": {"a": 1, "view_source": "select 1"}}
