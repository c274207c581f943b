"""Registered queries: each runs one operator over whole tables of the check inputs."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metaskein.functions import text as X
from metaskein.operators import cascade as K
from metaskein.operators import catalog as C
from metaskein.operators import delta as L
from metaskein.operators import diff as D
from metaskein.operators import document as M
from metaskein.operators import order as O
from metaskein.operators import profile as P
from metaskein.operators import resolve as R
from metaskein.operators import snapshot as N
from metaskein.session import checkpoint_dir, configure, cut, handed_over
from metaskein.sources import documents as J
from metaskein.plans import sync as S
from metaskein.sources import schemas
from metaskein.sources import snapshots as V
from metaskein.sources.tables import CATALOG_TABLES

from . import fixtures as fx

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
OPERATIONS: dict[str, Callable[["Inputs"], DataFrame]] = {}
CHUNK = 10  # small, so that groups really are cut into parts
FK_CATALOG = ("columns", "key_column_usage", "table_constraints", "referential_constraints", "pg_class",
              "pg_stat_all_indexes", "pg_constraint", "description")


class Inputs:
    """Lazy access to the check inputs of one scale folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._made: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._make(name)
        return self._made[name]

    def _make(self, name: str) -> DataFrame:
        if name in fx.BASE:
            return fx.base(self.spark, self.sf_dir, name)
        if name in fx.SHARED:  # read by many catalog tables, so made once
            return cut(fx.catalog_table(self.spark, self._read, name))
        return fx.snapshot(self._read, name)

    def _read(self, name: str) -> DataFrame:
        return getattr(self, name)

    def raw(self, name: str) -> DataFrame:
        return fx.raw(self._read, name)

    def catalog(self, *names: str) -> dict[str, DataFrame]:
        return {n: fx.catalog_table(self.spark, self._read, n) for n in names}

    def entities(self, strict: bool) -> DataFrame:
        return C.flatten_entities(
            self.catalog("tables", "columns", "pg_class", "pg_namespace", "pg_attribute", "pg_index", "description",
                         "key_column_usage", "table_constraints", "views"), strict_keys=strict)

    def foreign_keys(self) -> DataFrame:
        return C.resolve_foreign_keys(self.catalog(*FK_CATALOG))

    # Changes, as the cascades see them.
    def set_changes(self) -> DataFrame:
        return K.set_changes(self.db_dataset, self.dh_dataset)

    def item_changes(self) -> DataFrame:
        return K.item_changes(self.db_dataitem, self.dh_dataitem, self.db_dataset, self.dh_dataset, store=True)

    def relationship_changes(self) -> DataFrame:
        return K.relationship_changes(self.db_relationship, self.dh_relationship, self.db_dataset, self.dh_dataset)

    def join_changes(self) -> DataFrame:
        return K.join_changes(self.db_join, self.dh_join, self.db_relationship, self.dh_relationship,
                              self.db_dataset, self.dh_dataset)

    def feed(self) -> DataFrame:
        return K.change_feed(*self.all_changes())

    def all_changes(self) -> list[DataFrame]:
        """The four kinds, as the full flow makes them."""
        db, dh = ({t: getattr(self, f"{side}_{t}") for t in schemas.TABLES} for side in ("db", "dh"))
        return list(S.changes_between(db, dh).values())


class StoredInputs(Inputs):
    """The same inputs read back from Parquet, as the flows read their snapshots.

    With ``changes`` the four change tables are read back too, as the preview and the
    payloads of the full flow read them.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, root: str, changes: bool = False):
        super().__init__(spark, sf_dir)
        self.root = root
        if changes:
            self.set_changes = lambda: self._stored("changes/sets")
            self.item_changes = lambda: self._stored("changes/items")
            self.relationship_changes = lambda: self._stored("changes/relationships")
            self.join_changes = lambda: self._stored("changes/joins")
            self.all_changes = lambda: [self._stored(f"changes/{n}") for n in S.CHANGES]

    def _stored(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}")

    def _make(self, name: str) -> DataFrame:
        return fx.base(self.spark, self.sf_dir, name) if name in fx.BASE else self._stored(name)

    def raw(self, name: str) -> DataFrame:
        return self._stored(f"raw_{name}")

    def catalog(self, *names: str) -> dict[str, DataFrame]:
        return {n: self._stored(n) for n in names}


def store_inputs(spark: SparkSession, sf_dir: str, root: str) -> None:
    """Write every snapshot and catalog table below ``root``, one file per core."""
    i = Inputs(configure(spark), sf_dir)
    whole = tuple(f"{side}_{t}" for side in fx.WHOLE for t in fx.SNAPSHOT)
    made = {n: getattr(i, n) for n in fx.ALL_SNAPSHOTS + whole} | {f"raw_{n}": i.raw(n) for n in fx.ALL_SNAPSHOTS}
    for name, df in (made | i.catalog(*CATALOG_TABLES)).items():
        df.repartition(spark.sparkContext.defaultParallelism).write.parquet(f"{root}/{name}")
    sides = [{t: i._stored(f"{side}_{t}") for t in schemas.TABLES} for i in [StoredInputs(spark, sf_dir, root)]
             for side in ("db", "dh")]
    S.write_changes(*sides, f"{root}/changes")


def query(fn: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(Inputs(configure(spark), sf_dir))

    QUERIES[fn.__name__] = run
    OPERATIONS[fn.__name__] = fn
    return fn


# --- diffs ---------------------------------------------------------------------


@query
def sets_new(i):
    return D.sets_new(i.db_dataset, i.dh_dataset)


@query
def sets_deleted(i):
    return D.sets_deleted(i.db_dataset, i.dh_dataset)


@query
def sets_updated(i):
    return D.sets_updated(i.db_dataset, i.dh_dataset)


@query
def items_new(i):
    return D.items_new(i.db_dataitem, i.dh_dataitem, i.db_dataset)


@query
def items_deleted(i):
    return D.items_deleted(i.db_dataitem, i.dh_dataitem, i.dh_dataset)


@query
def items_new_scoped(i):
    return D.items_new_scoped(i.db_dataitem, i.dh_dataitem, i.db_dataset)


@query
def items_deleted_scoped(i):
    return D.items_deleted_scoped(i.db_dataitem, i.dh_dataitem, i.dh_dataset)


@query
def items_updated(i):
    return D.items_updated(i.db_dataitem, i.dh_dataitem, i.db_dataset, i.dh_dataset)


@query
def relationships_new(i):
    return D.relationships_new(i.db_relationship, i.dh_relationship, i.db_dataset)


@query
def relationships_deleted(i):
    return D.relationships_deleted(i.db_relationship, i.dh_relationship, i.db_dataset)


@query
def relationships_updated(i):
    return D.relationships_updated(i.db_relationship, i.dh_relationship, i.db_dataset)


@query
def joins_new(i):
    return D.joins_new(i.db_join, i.dh_join, i.dh_relationship)


@query
def joins_deleted(i):
    return D.joins_deleted(i.db_join, i.dh_join, i.db_relationship)


@query
def joins_updated(i):
    return D.joins_updated(i.db_join, i.dh_join, i.dh_relationship)


# --- cascades and feed ------------------------------------------------------------


@query
def set_delta_cascade(i):
    return i.set_changes()


@query
def item_delta_cascade(i):
    return i.item_changes()


@query
def relationship_delta_cascade(i):
    return i.relationship_changes()


@query
def join_delta_cascade(i):
    return i.join_changes()


@query
def unresolved_relationships(i):
    return K.unresolved_relationships(
        i.db_relationship, i.dh_relationship, i.db_dataset, i.dh_dataset,
    ).select("change_type", "physical_nm", "dataset_id")


@query
def change_feed(i):
    return i.feed().drop("set_body", "item_body", "relationship_body", "join_body")


@query
def change_feed_bodies(i):
    """What the four kinds of changes carry, as text."""
    shown = {"set": ["logical_nm", "description", "type", "definition", "fqdn"],
             "item": ["logical_nm", "type", "description", "key_type", "key_name", "nullable", "example", "default_val", "set_id", "item_id", "metadata"],
             "relationship": ["logical_nm", "comment", "on_update", "on_delete", "on_match", "type", "catalog_id"],
             "join": ["db_relationship_id", "relationship_id", "creates_relationship", "parent_item", "child_schema", "child_item", "position", "cardinality"]}
    text = F.lit(None).cast("string")
    for entity, columns in shown.items():
        parts = [F.coalesce(F.col(f"{entity}_body.{c}").cast("string"), F.lit("-")) for c in columns]
        text = F.when(F.col("entity") == entity, F.concat_ws("|", *parts)).otherwise(text)
    return i.feed().select("entity", "change_type", "entity_id", "name", text.alias("body"))


@query
def addition_membership(i):
    ids = i.wdb_dataset.select(X.set_id("physical_nm").alias("entity_id"))
    return K.has_change(ids, i.feed().where("entity = 'set'"), "add")


@query
def diff_membership(i):
    ids = i.dh_dataset.select(X.set_id("physical_nm").alias("entity_id"))
    sets = i.feed().where("entity = 'set'")
    return K.has_change(K.has_change(ids, sets, "delete"), sets, "update")


@query
def delta_counts(i):
    return L.counts(i.feed())


@query
def delta_preview(i):
    return L.preview(i.feed())


@query
def diff_json(i):
    kinds = ("add", "delete", "update")
    body = F.from_json("json", ", ".join(f"{k} array<struct<entity_id:string,name:string>>" for k in kinds))
    out = L.diff_json(i.feed(), CHUNK).select("entity", "part", body.alias("body"))
    entry = lambda k: F.transform(f"body.{k}", lambda x: F.concat(F.lit(k), F.lit(":"), x["entity_id"], F.lit(":"), x["name"]))
    return out.select("entity", "part", *[F.size(f"body.{k}").cast("long").alias(f"n_{k}") for k in kinds],
                      F.array_join(F.array_sort(F.concat(*map(entry, kinds))), ";").alias("entries"))


# --- payloads ---------------------------------------------------------------------


def _items_with_sets(i: Inputs) -> DataFrame:
    items = i.item_changes()
    ids = i.dh_dataset.select("schema", "physical_nm", "id")
    return R.resolve_set_ids(items, ids, ids, ids)


@query
def payload_sets(i):
    body = L.set_bodies(i.set_changes().withColumn("metadata", F.lit(None).cast("string")))
    return body.select(
        "change_type", "catalog_id", F.col("body.name.physical").alias("physical"), F.col("body.name.logical").alias("logical"),
        F.col("body.description").alias("description"), F.col("body.metadata")["view_source"].cast("string").alias("view_source"))


@query
def payload_items(i):
    rows = L.item_bodies(i.item_changes())
    key = F.get("body.keys", F.lit(0))
    return rows.select(
        "change_type", "dataset_id", F.col("body.name.physical").alias("physical"),
        F.col("body.name.logical").alias("logical"), F.col("body.nullable").alias("nullable"),
        F.col("body.description").alias("description"), F.col("body.udt_type").alias("udt_type"),
        F.col("body.default").alias("default_val"), key["name"].alias("key_name"), key["primary"].alias("key_primary"),
        F.col("body.attributes")[L.NULL_SHARE].alias("null_percentage"), F.col("body.example").alias("example"))


@query
def payload_metadata(i):
    """Bodies of sets and items with metadata: what moves to the attributes, and what stays."""
    made = F.expr("""concat('{"most_common_value":"', coalesce(example, ''), '","null_percentage":', length(physical_nm), '.25,"n":', length(dataset_id), '}')""")
    items = L.item_bodies(i.item_changes().withColumn("metadata", F.when(F.col("physical_nm").endswith("_1"), made)))
    sets = L.set_bodies(i.set_changes().withColumn("metadata", F.expr("""concat('{"view_source":"old","most_common_value":"m","n":', length(physical_nm), '}')""")))
    at = lambda c: F.col("body.metadata")[c].cast("string")
    shown = lambda df, entity, key: df.select(
        F.lit(entity).alias("entity"), "change_type", key.alias("key"), F.col("body.attributes")[L.MOST_COMMON].alias("most_common"),
        F.col("body.attributes")[L.NULL_SHARE].alias("null_share"), at("n").alias("n"), at("view_source").alias("view_source"), F.size("body.metadata").alias("kept"))
    return shown(items, "item", F.concat_ws(".", "dataset_id", "physical_nm")).unionByName(shown(sets, "set", F.col("physical_nm")))


def _pairs(joins: DataFrame) -> DataFrame:
    return joins.select(
        "*", *[X.fqdn_part(f"{end}_fqdn", n).alias(f"{end}_{part}")
               for end in ("parent", "child") for n, part in enumerate(("schema", "set", "item"))])


@query
def payload_relationships(i):
    rows = L.relationship_bodies(i.relationship_changes(), _pairs(i.db_join), 3)
    b = lambda c: F.col(f"body.{c}")
    return rows.select(
        "change_type", "physical_nm", "part", b("parent_set").alias("parent_set"), b("child_set").alias("child_set"),
        b("name.logical").alias("logical"), F.array_join(b("cardinality").cast("array<string>"), ",").alias("cardinality"),
        b("referential_integrity.on_update").alias("on_update"),
        b("referential_integrity.on_delete").alias("on_delete"), b("match_type").alias("match_type"),
        F.array_join(F.transform(b("items"), lambda x: F.concat(x["parent"], F.lit(">"), x["child"])), ";").alias("items"))


@query
def payload_requests(i):
    out = L.payloads(i.set_changes(), handed_over(_items_with_sets(i)), handed_over(i.relationship_changes()), _pairs(i.db_join), CHUNK)
    size = lambda c: F.json_array_length(F.get_json_object("body", f"$.{c}"))
    return out.select("phase_no", "phase", "entity", "target_id", "part",
                      F.coalesce(size("items"), size("relationships")).alias("n"))


def _replied(i: Inputs) -> tuple[DataFrame, DataFrame]:
    """Requests, and replies of a receiver that accepts some, refuses others, and says nothing to the rest."""
    sets = i.set_changes()
    items = cut(S.send_items({"sets": sets, "items": i.item_changes()}, i.dh_dataset))
    requests = L.set_payloads(sets).unionByName(L.item_payloads(items, CHUNK))
    number = F.regexp_extract("target_name", "([0-9]+)$", 1).try_cast("long")
    answered = L.with_request_ids(requests).where((F.col("entity") == "set") & (F.col("phase") == "add") & (number % 4 != 0))
    accepted = number % 3 != 1
    return requests, answered.select("request_id", accepted.alias("ok"), F.when(accepted, F.concat(F.lit("NEW"), number)).alias("id"))


@query
def requests_after_replies(i):
    out = L.requests_after_replies(*_replied(i))
    size = F.json_array_length(F.get_json_object("body", "$.items"))
    return out.select("phase", "entity", "target_id", "target_name", "part", size.alias("n"), "ready")


@query
def unresolved_items(i):
    """Items of two sides that lost every seventh set."""
    left = lambda df: df.where("cast(substring(physical_nm, 4) as int) % 7 <> 0")
    return K.unresolved_items(i.db_dataitem, i.dh_dataitem, left(i.db_dataset), left(i.dh_dataset))


# --- snapshots ----------------------------------------------------------------------


def _upsert(i: Inputs, table: str) -> DataFrame:
    existing = getattr(i, f"db_{table}")
    order = fx.ORDER if table in fx.UPSERTED else schemas.KEYS[table]
    return N.upsert(existing, i.raw(f"dh_{table}"), schemas.KEYS[table], order)


@query
def upsert_sets(i):
    return _upsert(i, "dataset")


@query
def upsert_items(i):
    return _upsert(i, "dataitem")


@query
def upsert_relationships(i):
    return _upsert(i, "relationship")


@query
def upsert_joins(i):
    return _upsert(i, "join")


def _store_root(i: Inputs) -> str:
    return f"{checkpoint_dir(i.spark).rstrip('/')}/store-{uuid.uuid4().hex}"


@query
def versioned_upsert_items(i):
    """The last committed version after an upsert, with an interrupted version in between."""
    root, side = _store_root(i), {t: getattr(i, f"db_{t}") for t in schemas.TABLES}
    V.write_snapshot(side, root, "1", "source")
    side["dataitem"].limit(0).write.parquet(f"{root}/version=2/db_dataitem")  # as a lost job leaves it: a table, no record
    incoming = {"dataitem": i.raw("dh_dataitem")}
    V.upsert_snapshot(incoming, root, "3", "source", {"dataitem": fx.ORDER}, spark=i.spark)
    return V.latest_snapshot(i.spark, root, "source")["dataitem"]


@query
def item_cascade_from_versions(i):
    """The items' cascade from two stored sides, whose key join needs no shuffle."""
    root, sides = _store_root(i), []
    for side, prefix in (("source", "db"), ("catalog", "dh")):
        V.write_snapshot({t: getattr(i, f"{prefix}_{t}") for t in schemas.TABLES}, root, "1", side)
        sides.append(V.read_snapshot(i.spark, root, "1", side))
    db, dh = sides
    return K.item_changes(db["dataitem"], dh["dataitem"], db["dataset"], dh["dataset"])


@query
def snapshot_sql(i):
    return N.query(i.spark, """
        SELECT s.schema, s.type, count(*) AS n_items, sum(CASE WHEN c.is_pk THEN 1 ELSE 0 END) AS n_keys
        FROM db_dataitem c JOIN db_dataset s ON s.physical_nm = c.dataset_id GROUP BY s.schema, s.type""",
        {"db_dataitem": i.wdb_dataitem, "db_dataset": i.wdb_dataset})


@query
def stash_items(i):
    """Item rows from the catalog documents, shaped for the snapshot table."""
    return N.dataitem_rows(J.parse_catalog_items(_item_docs(i), "doc"), "catalog")


@query
def stash_relationships(i):
    pairs = J.parse_catalog_relationships(_relationship_docs(i), "doc").withColumn("type", F.lit(None).cast("string"))
    return N.relationship_rows(pairs, "catalog")


@query
def stash_joins(i):
    return N.join_rows(J.parse_catalog_relationships(_relationship_docs(i), "doc"))


# --- lookups --------------------------------------------------------------------------


@query
def set_lookup(i):
    names = i.supplier.select(F.expr("concat(' DS_', s_suppkey, ' ')").alias("name"))
    return N.lookup_sets(i.wdh_dataset, names).select("physical_nm", "schema", "id")


@query
def set_id_resolution(i):
    items = D.items_new_scoped(i.db_dataitem, i.dh_dataitem, i.db_dataset).select(
        "schema", "dataset_id", "physical_nm",
        F.when(F.col("physical_nm").endswith("_2"), F.concat(F.lit("OWN"), "dataset_id")).alias("set_id"))
    ids = i.dh_dataset.select("schema", "physical_nm", "id")
    in_schema = ids.withColumn("schema", F.when(F.col("schema") == "sch_0", "other").otherwise(F.col("schema")))
    remote = i.part.select(F.expr("concat(' DS_', p_partkey, ' ')").alias("physical_nm"),
                           F.expr("case when p_partkey % 2 = 0 then concat('REM', p_partkey) end").alias("id"))
    return R.resolve_set_ids(items, in_schema, ids, remote)


@query
def endpoint_resolution(i):
    out = R.resolve_endpoints(_pairs(i.wdb_join), i.wdb_dataset, _columns_as_items(i))
    return out.select("db_relationship_id", "parent_fqdn", "child_fqdn", "parent_set_found", "parent_item_found",
                      "child_set_found", "child_item_found")


def _columns_as_items(i: Inputs) -> DataFrame:
    return i.lineitem.select(F.expr("concat('DS_', l_partkey)").alias("dataset_id"),
                             F.expr("concat('C_', l_linenumber)").alias("physical_nm"))


@query
def outdated_relationships(i):
    """Both phases of the relationship-only flow: ids to delete, names to create or update."""
    gone = R.outdated_relationships(i.dh_relationship, i.db_relationship).select(
        F.lit("delete").alias("phase"), "physical_nm", "id")
    fresh = i.db_relationship.select(F.lit("upsert").alias("phase"), "physical_nm",
                                     F.lit(None).cast("string").alias("id"))
    return gone.unionByName(fresh)


# --- catalog documents ------------------------------------------------------------------


def _malformed(doc, rule: str):
    return F.when(F.expr(rule), F.substring(doc, F.lit(1), F.length(doc) - 5)).otherwise(doc)


def _set_docs(i: Inputs) -> DataFrame:
    one = """named_struct('id', concat('S', p_partkey, '{0}'), 'name', named_struct('logical', p_name,
        'physical', concat('ds_', p_partkey, '{0}')), 'description', p_brand,
        'stub', concat('sch_', p_size % 5, '.ds_', p_partkey, '{0}'),
        'definition', case when p_partkey % 4 = 0 then 'SELECT 1' when p_partkey % 6 = 0 then '  ' end,
        'metadata', case when p_partkey % 3 = 0 then named_struct('view_source', concat('V ', p_partkey), 'x', 1)
          when p_partkey % 5 = 0 then named_struct('view_source', null, 'x', 2) end)"""
    doc = F.expr(f"""to_json(named_struct('id', concat('D', p_partkey), 'name', named_struct('logical', p_brand,
        'physical', concat('sch_', p_size % 5)), 'description', p_type, 'metadata', named_struct('a', 1),
        'sets', array({one.format('')}, {one.format('b')})))""")
    return i.part.select(_malformed(doc, "p_partkey % 101 = 0").alias("doc"))


def _item_docs(i: Inputs) -> DataFrame:
    key = """case l_linenumber when 1 then parse_json(concat('{"is_key":true,"primary":true,"name":"pk_', l_partkey, '"}'))
        when 2 then parse_json(concat('[{"is_key":true,"primary":false,"name":"fk_', l_orderkey,
          '"},{"is_key":false,"primary":false,"name":"no"},{"is_key":true,"primary":true,"name":"pk_', l_partkey, '"}]'))
        when 3 then parse_json('{"is_key":false,"primary":true,"name":"no"}') end"""
    one = f"""named_struct('id', concat('I', l_orderkey, '_', l_linenumber, '@'), 'name', named_struct(
        'logical', concat('C ', l_orderkey), 'physical', concat('c_', l_orderkey, '_', l_linenumber, '@')),
        'description', l_linestatus, 'type', 'text', 'nullable', l_linenumber <> 1,
        'stub', concat('s.ds_', l_partkey, '.c_', l_orderkey, '_', l_linenumber, '@'),
        'default', case when l_suppkey % 5 = 0 then 'now' end, 'example', case when l_suppkey % 3 = 0 then 'e' end,
        'metadata', case when l_suppkey % 2 = 0 then named_struct('n', l_linenumber) end, 'key', {key})"""
    doc = F.expr(f"""to_json(named_struct('sets', array(named_struct('name', named_struct('logical', '',
        'physical', concat('ds_', l_partkey)), 'items', array({one.replace('@', '')}, {one.replace('@', 'b')})))))""")
    return i.lineitem.select(_malformed(doc, "l_orderkey % 101 = 0").alias("doc"))


def _relationship_docs(i: Inputs) -> DataFrame:
    end = """named_struct('stub', concat('sch_{1}.ds_', {0}, '.c_{2}'), 'name', named_struct('logical', '', 'physical', 'c_{2}'),
        'set', named_struct('name', named_struct('logical', '', 'physical', concat('ds_', {0})),
          'source', named_struct('stub', 'sch_{1}')))"""
    pair = "named_struct('parent', {}, 'child', {})"
    first = pair.format(f"case when o_orderkey % 19 <> 0 then {end.format('o_custkey', 0, 1)} end", end.format("o_orderkey", 1, 1))
    second = pair.format(end.format("o_custkey", 0, 2), end.format("o_orderkey", 1, 2))
    doc = F.expr(f"""to_json(named_struct('relationships', array(named_struct('id', concat('R', o_orderkey),
        'name', named_struct('logical', concat('FK ', o_orderkey), 'physical', concat('fk_', o_orderkey)),
        'description', o_orderpriority, 'match_type', 'none',
        'referential_integrity', named_struct('on_update', 'cascade', 'on_delete', o_orderstatus),
        'cardinality', named_struct('raw', array(1, 1, o_custkey % 3, -1)), 'items', array({first}, {second})))))""")
    return i.orders.select(_malformed(doc, "o_orderkey % 101 = 0").alias("doc"))


@query
def catalog_sets(i):
    return J.parse_catalog_sets(_set_docs(i), "doc")


@query
def catalog_items(i):
    rows = J.parse_catalog_items(_item_docs(i), "doc")
    text = F.array_join(F.transform("keys", lambda k: F.concat_ws(":", k["name"], k["type"], F.array_join(k["items"], "+"))), ",")
    return rows.withColumn("keys", text)


@query
def catalog_relationships(i):
    return J.parse_catalog_relationships(_relationship_docs(i), "doc")


@query
def malformed_documents(i):
    docs = i.orders.select("o_orderkey", F.expr(
        "case when o_orderkey % 101 = 0 then '{\"relationships\":[' when o_orderkey % 103 = 0 then '[1]' else '{\"relationships\":[]}' end").alias("doc"))
    return J.malformed_documents(docs, "doc").select("o_orderkey", "doc")


# --- database catalog ---------------------------------------------------------------------


@query
def schema_filter(i):
    t = i.catalog("tables")["tables"]
    picked = C.schema_filter(t, "table_schema", ["sch_1", "*h_3"]).withColumn("rule", F.lit("patterns"))
    return picked.unionByName(C.schema_filter(t, "table_schema").withColumn("rule", F.lit("default")))


@query
def entities_flatten(i):
    return i.entities(strict=False)


@query
def entities_flatten_strict(i):
    return i.entities(strict=True)


#: The order of entity rows: schema, set, position, and what tells equal ones apart.
ENTITY_ORDER = ["schema", "entity", "position", "key_name", "key_type"]


@query
def entities_ordered(i):
    """Each entity row's place in the total order, and the file it is read back from."""
    path = f"{checkpoint_dir(i.spark).rstrip('/')}/ordered-{uuid.uuid4().hex}"
    rows = C.flatten_entities(i.catalog("tables", "columns", "pg_class", "pg_namespace", "pg_attribute", "pg_index", "description",
                                        "key_column_usage", "table_constraints", "views"), strict_keys=True)
    O.write_ordered(rows.select(*ENTITY_ORDER, "fqdn"), ENTITY_ORDER, path)
    return O.numbered(i.spark.read.parquet(path), ENTITY_ORDER).select("seq", *ENTITY_ORDER, "fqdn")


@query
def entity_sets(i):
    return C.entity_sets(i.entities(strict=True))


@query
def entity_items(i):
    rows = C.entity_items(i.entities(strict=True))
    return rows.select(*[c for c in rows.columns if c != "key"], F.col("key.name").alias("key_name"),
                       F.col("key.type").alias("key_type"))


@query
def fk_resolution(i):
    return i.foreign_keys()


@query
def fk_documents(i):
    docs = C.relationship_documents(i.foreign_keys(), "src", 1)
    items = F.array_join(F.transform("items", lambda x: F.concat(x["parent"], F.lit(">"), x["child"])), ";")
    return docs.withColumn("items", items)


@query
def matview_columns(i):
    return C.resolve_matview_columns(i.catalog(
        "matviews", "columns", "pg_class", "pg_namespace", "pg_attribute", "pg_index", "description", "key_column_usage",
        "table_constraints"), strict_keys=True)


@query
def matview_columns_loose(i):
    return C.resolve_matview_columns(i.catalog(
        "matviews", "columns", "pg_class", "pg_namespace", "pg_attribute", "pg_index", "description", "key_column_usage",
        "table_constraints")).select("fqdn", "position", "key_name", "entity_comment")


# --- profiles -----------------------------------------------------------------------------


def _with_nulls(i: Inputs) -> DataFrame:
    return i.lineitem.select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_returnflag",
        F.expr("case when l_orderkey % 4 <> 0 then l_shipdate end").alias("l_shipdate"),
        F.expr("case when l_linenumber > 6 then l_linestatus end").alias("l_linestatus"))


@query
def profile_nulls(i):
    return P.null_percentages(_with_nulls(i)).withColumn("null_percentage", F.round("null_percentage", 9))


@query
def profile_mcv(i):
    shown = _with_nulls(i).withColumns({"l_shipdate": F.date_format("l_shipdate", "yyyy-MM-dd"),
                                        "l_quantity": F.col("l_quantity").cast("int")})
    return P.most_common_values(shown)


@query
def profile_documents(i):
    return P.profile_columns(i.documents, ["doc_id", "lang", "source", "text"]).withColumn(
        "null_percentage", F.round("null_percentage", 9))


# JSON text with varying keys, arrays and malformed text in between.
PROPS = """case when event_id % 50 = 0 then '[1]' when event_id % 51 = 0 then 'bad'
    else concat('{"', event_type, '":1,"u', user_id % 7, '":2}') end"""


def _props(i: Inputs) -> DataFrame:
    return i.events.select("event_id", F.expr(PROPS).alias("props"))


@query
def json_keys_full(i):
    return P.json_keys(_props(i), ["props"])


@query
def json_keys_compat(i):
    return P.json_keys(_props(i), ["props"], mode="compat")


@query
def json_expansion(i):
    two = i.events.select(F.expr(PROPS).alias("props"), F.col("props").alias("raw"))
    return P.expand_json_columns(two, ["props", "raw"], "Events", "lake.Events")


def _stored_tables(i: Inputs) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Columns, sets and places of three stored tables: events, a partitioned one, and one where ``props`` is a number."""
    root = f"{checkpoint_dir(i.spark).rstrip('/')}/tables-{uuid.uuid4().hex}"
    i.events.select(F.expr(PROPS).alias("extra"), F.expr("event_id % 3").alias("day"), F.expr("""case when event_id % 4 = 0
        then concat('{"p', user_id % 5, '":{"deep":1}}') else '"text"' end""").alias("props")).write.partitionBy("day").parquet(f"{root}/parts")
    i.documents.select(F.length("text").alias("props"), F.to_json(F.expr("map(concat('l_', lang), source)")).alias("doc")).write.parquet(f"{root}/docs")
    columns = [("lake", "Events", "props", "json"), ("lake", "Events", "event_type", "text"), ("lake", "parts", "extra", "JSONB"), ("lake", "parts", "props", "json"),
               ("web", "docs", "props", "int4"), ("web", "docs", "doc", "json"), ("web", "elsewhere", "doc", "json")]
    places = [("lake", "Events", f"{i.sf_dir}/events.parquet"), ("lake", "parts", f"{root}/parts/"), ("web", "docs", f"{root}/docs"), ("web", "unused", f"{root}/none")]
    spark = i.spark
    return (spark.createDataFrame([(*c, ".".join(c[:3])) for c in columns], "schema string, dataset_id string, physical_nm string, type string, fqdn string"),
            spark.createDataFrame(sorted({(*c[:2], "TABLE") for c in columns}), "schema string, physical_nm string, type string"),
            spark.createDataFrame(places, "schema string, dataset_id string, path string"))


@query
def json_expansion_tables(i):
    """JSON columns of several stored tables, found by one scan for each set of columns that do not clash."""
    return P.expand_json_tables(*_stored_tables(i))


@query
def json_expansion_tables_compat(i):
    return P.expand_json_tables(*_stored_tables(i), mode="compat").select("dataset_id", "physical_nm")


@query
def json_expansion_keys(i):
    return P.expansion_keys(P.expand_json_tables(*_stored_tables(i)))


@query
def stats_enrich(i):
    items = i.catalog("columns")["columns"].select(
        F.upper("table_schema").alias("schema"), F.upper("table_name").alias("dataset_id"),
        F.col("column_name").alias("physical_nm"), F.col("udt_name").alias("example"))
    stats = P.stats_from_catalog(i.catalog("stats")["stats"])
    extra = items.withColumn("physical_nm", F.concat("physical_nm", F.lit("_x")))
    return P.enrich_with_stats(items.unionByName(extra), stats)


# --- merges and documents --------------------------------------------------------------------


def _both(i: Inputs, table: str) -> DataFrame:
    """Rows of both sides in arrival order: source first, then catalog with upper-case names."""
    a = getattr(i, f"wdb_{table}").withColumn("seq", F.lit(1))
    b = getattr(i, f"wdh_{table}").withColumn("seq", F.lit(2))
    if table != "join":
        b = b.withColumn("physical_nm", F.upper("physical_nm"))
    return a.unionByName(b, allowMissingColumns=True)


@query
def merge_sets(i):
    return M.merge_sets(_both(i, "dataset"), ["seq"])


@query
def merge_schemas(i):
    rows = i.part.select(F.expr("case when p_partkey % 2 = 0 then concat('sch_', p_size % 5) else concat('SCH_', p_size % 5) end").alias("schema"),
                         F.expr("case when p_partkey % 3 = 0 then p_name else ' ' end").alias("comment"),
                         F.col("p_partkey").alias("seq"))
    return M.merge_schemas(rows, ["seq"])


@query
def merge_items(i):
    return M.merge_items(_both(i, "dataitem").drop("id", "metadata"), ["seq"])


def _key_rows(i: Inputs) -> DataFrame:
    return i.lineitem.select(
        F.expr("concat('ds_', l_partkey)").alias("dataset_id"),
        F.expr("case when l_orderkey % 2 = 0 then concat('PK_', l_linenumber) else concat('pk_', l_linenumber) end").alias("name"),
        F.expr("case when l_orderkey % 5 = 0 then '' else l_returnflag end").alias("type"),
        F.expr("case when l_orderkey % 7 = 0 then '' else l_linestatus end").alias("comment"),
        F.expr("concat('c_', l_suppkey % 10)").alias("item"), *fx.ORDER, "l_orderkey")


@query
def merge_keys(i):
    return M.merge_keys(_key_rows(i), ["l_orderkey", *fx.ORDER])


@query
def merge_key_items(i):
    return M.merge_key_items(_key_rows(i), ["l_orderkey"]).withColumn("first_seen", F.col("first_seen.l_orderkey"))


def _relationship_rows(i: Inputs) -> DataFrame:
    a = i.orders.select(
        F.expr("concat('fk_', o_orderkey)").alias("physical_nm"), F.expr("concat('ds_', o_custkey)").alias("dataset_id"),
        F.expr("case when o_orderkey % 2 = 0 then concat('R', o_orderkey) end").alias("id"), F.lit("foreign key").alias("type"),
        F.col("o_orderpriority").alias("comment"), F.lit("cascade").alias("on_update"), F.lit("restrict").alias("on_delete"),
        F.lit(None).cast("string").alias("on_match"), F.lit(1).alias("seq"))
    b = i.orders.select(
        F.expr("concat('FK_', o_orderkey)").alias("physical_nm"),
        F.expr("concat('DS_', o_custkey + case when o_orderkey % 31 = 0 then 1 else 0 end)").alias("dataset_id"),
        F.expr("case when o_orderkey % 6 = 0 then ' ' when o_orderkey % 22 = 0 then 'X' else concat('R', o_orderkey) end").alias("id"),
        F.expr("case when o_orderkey % 27 = 0 then 'other' else 'foreign key' end").alias("type"),
        F.expr("case when o_orderkey % 4 = 0 then '  ' else o_orderstatus end").alias("comment"),
        F.expr("case when o_orderkey % 3 = 0 then 'set null' end").alias("on_update"),
        F.lit(None).cast("string").alias("on_delete"), F.lit(None).cast("string").alias("on_match"), F.lit(2).alias("seq"))
    return a.unionByName(b)


@query
def merge_relationships(i):
    return M.merge_relationships(_relationship_rows(i), ["seq"])


@query
def relationship_conflicts(i):
    return M.relationship_conflicts(_relationship_rows(i))


@query
def merge_joins(i):
    return M.merge_joins(_both(i, "join"), ["seq"])


@query
def set_links(i):
    return M.set_links(_pairs(i.wdb_join))


@query
def dangling_links(i):
    return M.dangling_links(M.set_links(_pairs(i.dh_join)), i.db_relationship)


@query
def linked_relationships(i):
    out = M.relationships_of(M.set_links(_pairs(i.wdb_join)), i.wdh_relationship)
    return out.select("set_id", "relationship_id", "id", "on_delete")


def _document(i: Inputs) -> DataFrame:
    rels = i.wdb_relationship.withColumn("schema", F.lit("sch_0"))
    return M.assemble(i.wdb_dataset, i.wdb_dataitem, rels, i.wdb_join, "lake", chunk=CHUNK)


@query
def document_roundtrip(i):
    return M.flatten_items(_document(i))


@query
def document_sets(i):
    return M.flatten_sets(_document(i))


@query
def document_relationships(i):
    return M.flatten_relationships(_document(i))


@query
def document_joins(i):
    return M.flatten_pairs(_document(i))


@query
def items_by_type(i):
    return M.items_by_type(i.wdb_dataitem, ["_INT4", "Text", "json"]).select("wanted", "dataset_id", "physical_nm", "type")


@query
def views_nonviews(i):
    a = M.views(i.wdb_dataset).withColumn("kind", F.lit("view"))
    return a.unionByName(M.non_views(i.wdb_dataset).withColumn("kind", F.lit("other"))).select("kind", "physical_nm", "type")


# --- flows -----------------------------------------------------------------------------------


@query
def source_snapshot_items(i):
    """Item rows of a source snapshot made from the database catalog, with statistics."""
    return S.source_snapshot(i.catalog(*CATALOG_TABLES))["dataitem"]


@query
def relationships_only(i):
    out = S.relationships_only(i.catalog(*FK_CATALOG), _relationship_docs(i))
    return out.select("phase", "physical_nm", "target_id", "part",
                      F.json_array_length(F.get_json_object("body", "$.items")).alias("n_items"))
