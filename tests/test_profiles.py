"""Most common values by sketch and exact counts, and JSON expansion over many stored tables, against brute force."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import rows
from metaskein.operators import document, profile
from metaskein.plans import sync


def common(values):
    counts = Counter(v for v in values if v is not None)
    best = min(((-n, v) for v, n in counts.items() if n > 1), default=None)
    return (best[1], -best[0]) if best else (None, None)


@pytest.mark.parametrize(("tracked", "candidates"), [(10_000, 64), (16, 2), (8, 1)])
def test_most_common_values(spark, tracked, candidates):
    r = random.Random(tracked)
    n = 3_000
    columns = {
        "heavy": [r.choice(["a", "a", "a", "b", str(r.random())]) for _ in range(n)],
        "tie": [("x" if i % 2 else "é") if i < 600 else f"u{i}" for i in range(n)],
        "nearly": [f"v{i // 2 if i < 8 else i}" for i in range(n)],  # four pairs among distinct values
        "distinct": [f"d{i}" for i in range(n)],
        "none": [None] * n,
        "mostly_none": ["q" if i in (5, 7) else None for i in range(n)],
        "flat": [f"f{i % 700}" for i in range(n)],
        "empty_text": ["" if i % 3 else "z" for i in range(n)],
        "long": ["L" * 50_000 if i < 2 else "s" if i < 4 else f"l{i}" for i in range(n)],
    }
    df = spark.createDataFrame(list(zip(*columns.values())), ", ".join(f"`{c}` string" for c in columns)).repartition(3)
    got = {x.item: (x.most_common_value, x.frequency) for x in profile.most_common_values(df, tracked=tracked, candidates=candidates).collect()}
    assert got == {c: common(v) for c, v in columns.items()}


def test_most_common_values_of_an_empty_table(spark):
    df = spark.createDataFrame([], "item string, value long")  # names that the operator uses inside
    assert rows(profile.most_common_values(df)) == [("item", None, None), ("value", None, None)]
    one = spark.createDataFrame([("a", 1), ("a", 2)], "item string, value long")
    assert rows(profile.most_common_values(one)) == [("item", "a", 2), ("value", None, None)]


def test_scans_part_only_where_names_clash():
    wanted = [("a", "j"), ("b", "j"), ("b", "k"), ("c", "k"), ("d", "J")]
    assert profile._scans(wanted, []) == [(["a", "b", "c"], ["j", "k"]), (["d"], ["J"])]
    assert profile._scans(wanted[:4], [("a", "K")]) == [(["a"], ["j"]), (["b", "c"], ["j", "k"])]
    assert profile._scans([], []) == []


def test_json_tables(spark, tmp_path):
    spark.createDataFrame([('{"k":1,"z":{"y":2}}', 5, 1), (None, 6, 1), ("[1]", 7, 2), ('{"a b":0,"k":2}', 8, 2)], "j string, n long, part long") \
        .write.partitionBy("part").parquet(str(tmp_path / "one"))
    spark.createDataFrame([(1, '{"q":1}')], "j long, `o.ther` string").write.parquet(str(tmp_path / "two=2"))
    spark.createDataFrame([('{"v":1}',)], "j string").coalesce(1).write.parquet(str(tmp_path / "files"))
    single = next(str(f) for f in (tmp_path / "files").glob("*.parquet"))
    items = spark.createDataFrame([("s", "One", "j", "jsonb", "s.One.j"), ("s", "One", "n", "int8", "s.One.n"), ("s", "two", "j", "int8", "s.two.j"),
                                   ("s", "two", "o.ther", "JSON", "s.two.o.ther"), ("t", "file", "j", "json", "t.file.j"), ("t", "view", "j", "json", "t.view.j"),
                                   ("t", "untyped", "j", None, "t.untyped.j")],
                                  "schema string, dataset_id string, physical_nm string, type string, fqdn string")
    sets = spark.createDataFrame([("s", "One", "TABLE"), ("s", "two", "TABLE"), ("t", "file", "TABLE"), ("t", "view", "VIEW")], "schema string, physical_nm string, type string")
    places = spark.createDataFrame([("s", "One", f"file://{tmp_path}/one/"), ("s", "two", str(tmp_path / "two=2")), ("t", "file", single), ("t", "view", single)],
                                   "schema string, dataset_id string, path string")
    names = lambda **o: rows(profile.expand_json_tables(items, sets, places, **o).select("dataset_id", "physical_nm", "fqdn"))
    one = [("One", "j::a b", "s.One.a b"), ("One", "j::k", "s.One.k"), ("One", "j::z", "s.One.z")]
    assert names(skip_views=True, fields=["s.one.j", "t.view.j"]) == one
    assert names(fields=["t.file.j"]) == [("file", "j::v", "t.file.v")]
    # In compat the row with the greatest key counts.
    assert names(mode="compat", fields=["s.one.j"]) == one[1:]
    assert names(fields=["no.such.field"]) == []
    with pytest.raises(ValueError):
        names(mode="other")
    keys = profile.expansion_keys(profile.expand_json_tables(items, sets, places, fields=["s.one.j"]))
    assert rows(keys) == [("s", "One", "one_json_expansion_key", "json", "Generated by JSON autoexpansion of the One item.", "j")]
    assert document.merge_keys(keys.withColumn("seq", F.lit(1)), ["seq"]).count() == 1


def test_one_scan_for_all_tables(spark, tmp_path):
    """The plan of forty tables is that of two."""
    for k in range(40):
        (tmp_path / f"t{k}").mkdir()
    spark.createDataFrame([('{"a":1}',)], "j string").write.mode("overwrite").parquet(str(tmp_path / "t0"))
    spark.createDataFrame([('{"b":1}',)], "j string").write.mode("overwrite").parquet(str(tmp_path / "t1"))

    def plan(n):
        items = spark.createDataFrame([("s", f"t{k}", "j", "json", f"s.t{k}.j") for k in range(n)], "schema string, dataset_id string, physical_nm string, type string, fqdn string")
        sets = spark.createDataFrame([("s", "t0", "TABLE")], "schema string, physical_nm string, type string")
        places = spark.createDataFrame([("s", f"t{k}", str(tmp_path / f"t{k}")) for k in range(n)], "schema string, dataset_id string, path string")
        df = profile.expand_json_tables(items, sets, places)
        assert rows(df.select("physical_nm")) == [("j::a",), ("j::b",)]
        return df._jdf.queryExecution().optimizedPlan().toString().count("\n")

    assert plan(40) == plan(2)


def test_source_snapshot_expands_json_columns(spark, sf_dir, tmp_path):
    from checks.queries import Inputs
    from metaskein.sources.tables import CATALOG_TABLES

    i = Inputs(spark, sf_dir)
    tables = i.catalog(*CATALOG_TABLES)
    a = tables["columns"]
    one = a.join(tables["tables"].select("table_schema", "table_name"), ["table_schema", "table_name"]).where("ordinal_position = 1").orderBy("table_name").first()
    tables["columns"] = a.withColumn("udt_name", F.when((F.col("table_name") == one.table_name) & (F.col("ordinal_position") == 1), "jsonb").otherwise(F.col("udt_name")))
    spark.createDataFrame([('{"k":1}',)], f"`{one.column_name}` string").write.parquet(str(tmp_path / "t"))
    places = spark.createDataFrame([(one.table_schema, one.table_name, str(tmp_path / "t"))], "schema string, dataset_id string, path string")
    got = sync.source_snapshot(tables, json_places=places)["dataitem"].where("physical_nm like '%::%'").collect()
    assert [(r.dataset_id, r.physical_nm, r.type, r.nullable, r.metadata) for r in got] == [
        (one.table_name, f"{one.column_name}::k", "text", True, f'{{"source":"{one.column_name}"}}')]
