"""A total order over partitions and files, and the statements of JDBC scans (no database is asked)."""

import random

import pytest
from pyspark.sql import functions as F

from metaskein.operators import catalog, order
from metaskein.sources import tables


def test_places_and_files_keep_the_order(spark, tmp_path):
    r = random.Random(1)
    values = [(r.choice(["hot", "hot", "é", "Z", "a", None]), r.randint(0, 50), i) for i in range(2_000)]
    df = spark.createDataFrame(values, "s string, n int, i int").repartition(5)
    key = lambda v: (v[0] is not None, (v[0] or "").encode(), -v[1], v[2])
    by = ["s", F.desc("n"), "i"]
    want = sorted(values, key=key)
    got = order.numbered(df, by).collect()
    assert [tuple(x)[:3] for x in sorted(got, key=lambda x: x.seq)] == want and sorted(x.seq for x in got) == list(range(1, len(values) + 1))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # the rows are few
    try:
        order.write_ordered(df, by, str(tmp_path / "o"), source="json")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    read = []
    files = sorted((tmp_path / "o").glob("part-*"))
    for f in files:
        read += [(x.s, x.n, x.i) for x in spark.read.schema("s string, n int, i int").json(str(f)).coalesce(1).collect()]
    assert len(files) > 1 and read == want
    assert order.numbered(df.limit(0), ["i"]).count() == 0
    text = order.in_order(df, by)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" in text and "SinglePartition" not in text


def test_operators_can_sort(spark, sf_dir):
    from checks.queries import Inputs

    i = Inputs(spark, sf_dir)
    rows = catalog.flatten_entities(i.catalog("tables", "columns", "pg_class", "pg_namespace", "pg_attribute", "pg_index", "description",
                                              "key_column_usage", "table_constraints", "views"), strict_keys=True, ordered=True)
    got = [(r.schema, r.entity, r.position) for r in rows.select("schema", "entity", "position").collect()]
    assert got == sorted(got) and len(got) > 100


# --- JDBC ---------------------------------------------------------------------------


@pytest.mark.parametrize("name", tables.CATALOG_TABLES)
def test_a_statement_for_every_table(name):
    text = tables.jdbc_statement(name)
    assert text.startswith("SELECT ") and " FROM " in text and "*" not in text.split(" FROM ")[0].replace("[]", "")
    options = tables.jdbc_options(name, partitions=8)
    assert options["dbtable"] == f"({text}) {name}"
    assert ("partitionColumn" in options) == (name != "pg_namespace")
    assert "numPartitions" not in tables.jdbc_options(name)


def test_statements_hold_the_columns_that_operators_read(spark, sf_dir):
    from checks.queries import Inputs

    made = Inputs(spark, sf_dir).catalog(*tables.CATALOG_TABLES)
    for name, df in made.items():
        columns = [c.split(" AS ")[-1] for c in tables.STATEMENTS[name].columns]
        assert sorted(columns) == sorted(df.columns), name


def test_schema_predicates():
    assert tables.schema_predicate("s", None) == "s NOT IN ('pg_catalog', 'information_schema')"
    assert tables.schema_predicate("s", ["a*", "o'b"]) == "(s LIKE 'a%' OR s LIKE 'o''b')"
    assert "WHERE (table_schema LIKE 'sales%')" in tables.jdbc_statement("columns", ["sales*"])
    assert "WHERE" not in tables.jdbc_statement("key_column_usage", ["sales*"])  # keys refer to other schemas


class FakeReader:
    """Notes what a scan asks Spark's reader for."""

    def __init__(self):
        self.read, self.asked = self, {}

    def format(self, name):
        self.asked["format"] = name
        return self

    def options(self, **options):
        self.asked |= options
        return self

    def load(self):
        return self

    def drop(self, *columns):
        self.asked["dropped"] = columns
        return self


def test_scan_options():
    fake = FakeReader()
    tables.catalog_tables(fake, tables.jdbc_scan(fake, ["x*"], partitions=4, url="jdbc:postgresql://host/db", fetchsize="1000"), ["pg_attribute"])
    assert fake.asked["format"] == "jdbc" and fake.asked["url"] == "jdbc:postgresql://host/db" and fake.asked["fetchsize"] == "1000"
    assert fake.asked["dbtable"] == ("(SELECT attrelid::bigint AS attrelid, attname, attnum::int AS attnum, format_type(atttypid, atttypmod) AS atttype, "
                                     "mod(abs(attrelid::bigint), 1024)::int AS _part FROM pg_catalog.pg_attribute) pg_attribute")
    assert (fake.asked["partitionColumn"], fake.asked["numPartitions"], fake.asked["dropped"]) == ("_part", "4", ("_part",))
