"""The two flows: full synchronization, and foreign keys only.

Stages hand over Parquet tables in a shared folder, never data on the driver. Each stage is a committed part of
a version: a run that fails or loses its executors goes on after the last committed part.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import cascade, catalog, delta, profile, resolve, snapshot
from ..operators.skew import split_join
from ..session import handed_over
from ..sources import documents, schemas, sinks, snapshots

CHANGES = ("sets", "items", "relationships", "joins")


def source_snapshot(
    tables: dict[str, DataFrame], patterns: list[str] | None = None, extra_items: DataFrame | None = None, *,
    json_places: DataFrame | None = None, json_fields: list[str] | None = None, skip_views: bool = False,
) -> dict[str, DataFrame]:
    """The four snapshot tables of the source side, out of its catalog tables.

    Keys are matched strictly, so the fan-out of the loose join never arises.
    ``extra_items`` are item rows from JSON columns (see ``expand_json_columns``); with ``json_places`` they are found here,
    in the stored tables that it names (see ``profile.expand_json_tables``).
    """
    views = catalog.resolve_matview_columns(tables, patterns, strict_keys=True)
    entities = catalog.flatten_entities(tables, patterns, strict_keys=True).unionByName(
        views.drop("source_schema", "source_entity"))
    sets = catalog.entity_sets(entities)
    items = catalog.item_snapshot(catalog.entity_items(entities), profile.stats_from_catalog(tables["stats"]))
    if json_places is not None:
        found = profile.expand_json_tables(catalog.entity_items(entities), sets, json_places, skip_views=skip_views, fields=json_fields)
        items = items.unionByName(found.drop("source", "identity", "fqdn"), allowMissingColumns=True)
    if extra_items is not None:
        items = items.unionByName(extra_items, allowMissingColumns=True)
    fk = catalog.resolve_foreign_keys(tables, patterns)
    pairs = catalog.snapshot_pairs(fk)
    return {
        "dataset": _unique(snapshot.dataset_rows(sets, "source"), "dataset"),
        "dataitem": _unique(_typed(items, "dataitem", "source"), "dataitem"),
        "relationship": _unique(snapshot.relationship_rows(pairs, "source"), "relationship"),
        "join": _unique(snapshot.join_rows(pairs), "join"),
    }


def catalog_snapshot(set_docs: DataFrame, item_docs: DataFrame, rel_docs: DataFrame, col: str = "doc") -> dict[str, DataFrame]:
    """The four snapshot tables of the catalog side, out of its JSON documents."""
    none = F.lit(None).cast("string")
    sets = documents.parse_catalog_sets(set_docs, col).withColumn("type", none)
    items = documents.parse_catalog_items(item_docs, col)
    pairs = documents.parse_catalog_relationships(rel_docs, col).withColumn("type", none)
    return {
        "dataset": _unique(snapshot.dataset_rows(sets, "catalog"), "dataset"),
        "dataitem": _unique(snapshot.dataitem_rows(items, "catalog"), "dataitem"),
        "relationship": _unique(snapshot.relationship_rows(pairs, "catalog"), "relationship"),
        "join": _unique(snapshot.join_rows(pairs), "join"),
    }


def _typed(df: DataFrame, table: str, side: str) -> DataFrame:
    schema = schemas.snapshot_schema(table, side)
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def _unique(df: DataFrame, table: str) -> DataFrame:
    """One row per key; of several, the greatest by all columns."""
    keys = schemas.KEYS[table]
    return snapshot.latest_rows(df, keys, [c for c in df.columns if c not in keys])


def expand_json_columns(
    items: DataFrame, sets: DataFrame, open_table: Callable[[str], DataFrame], *,
    skip_views: bool = False, fields: list[str] | None = None, mode: str = "full",
) -> DataFrame | None:
    """Item rows for the keys of all wanted JSON columns, or None if there are none.

    Only names reach the driver: one row per table with JSON columns. Each such table
    is scanned once, for all its JSON columns together, by executors.
    """
    wanted = profile.json_items(items, sets, skip_views=skip_views, fields=fields)
    per_table = wanted.groupBy("schema", "dataset_id").agg(F.sort_array(F.collect_set("physical_nm")).alias("columns"))
    out = None
    for row in per_table.toLocalIterator():
        full = f"{row.schema}.{row.dataset_id}"
        found = profile.expand_json_columns(open_table(full), row.columns, row.dataset_id, full, mode=mode)
        out = found if out is None else out.unionByName(found)
    return out


def changes_between(db: dict[str, DataFrame], dh: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The changes of all four kinds, in dependency order. What relationships and pairs need of the relationships is made once."""
    states = handed_over(cascade.relationship_states(db["relationship"], dh["relationship"], db["dataset"], dh["dataset"]))
    return {
        "sets": cascade.set_changes(db["dataset"], dh["dataset"]),
        "items": cascade.item_changes(db["dataitem"], dh["dataitem"], db["dataset"], dh["dataset"], store=True),
        "relationships": cascade.relationship_changes(
            db["relationship"], dh["relationship"], db["dataset"], dh["dataset"], states=states),
        "joins": cascade.join_changes(
            db["join"], dh["join"], db["relationship"], dh["relationship"], db["dataset"], dh["dataset"], states),
    }


def write_changes(db: dict[str, DataFrame], dh: dict[str, DataFrame], path: str) -> dict[str, DataFrame]:
    """Compute the changes and store them; returns the stored tables."""
    made = changes_between(db, dh)
    for name in CHANGES:
        made[name].write.mode("errorifexists").parquet(f"{path}/{name}")
    spark = db["dataset"].sparkSession
    return {name: spark.read.schema(made[name].schema).parquet(f"{path}/{name}") for name in CHANGES}


def send_items(changes: dict[str, DataFrame], dh_sets: DataFrame, remote_sets: DataFrame | None = None) -> DataFrame:
    """Item changes with the id of the set they are to be sent to, or as ``new_set`` the name of a set that is added too."""
    ids = dh_sets.select("schema", "physical_nm", "id")
    found = resolve.resolve_set_ids(changes["items"], ids, ids, ids if remote_sets is None else remote_sets)
    added = changes["sets"].where(F.col("change_type") == cascade.ADD).select(
        "schema", F.col("physical_nm").alias("dataset_id")).distinct().withColumn("_added", F.lit(True))
    name = F.when(X.is_blank("set_id") & F.col("_added"), X.fqdn("schema", "dataset_id"))
    return split_join(found, added, ["schema", "dataset_id"], "left").withColumn("new_set", name).drop("_added")


def write_requests(
    changes: dict[str, DataFrame], db: dict[str, DataFrame], dh: dict[str, DataFrame], root: str, version: str,
    chunk: int = 1000, remote_sets: DataFrame | None = None,
) -> None:
    """Store the payload requests and, under ``reports``, every change that no request carries."""
    spark = db["dataset"].sparkSession

    def outgoing() -> dict[str, DataFrame]:
        touched = cascade.relationships_of_joins(
            changes["joins"], changes["relationships"], db["relationship"], dh["relationship"])
        return {"items": send_items(changes, dh["dataset"], remote_sets),
                "relationships": changes["relationships"].unionByName(touched)}

    once = lambda make, part: snapshots.part_once(make, root, version, part, f"{part}/version={version}", spark=spark)
    sent = once(outgoing, "outgoing")
    pairs = db["join"].select(
        "*", *[X.fqdn_part(f"{end}_fqdn", i).alias(f"{end}_{part}")
               for end in ("parent", "child") for i, part in enumerate(("schema", "set"))])
    once(lambda: {
        "sets": delta.unsendable_sets(changes["sets"]),
        "unresolved_items": cascade.unresolved_items(db["dataitem"], dh["dataitem"], db["dataset"], dh["dataset"]),
        "items": delta.unsendable_items(sent["items"]),
        "relationships": delta.unsendable_relationships(sent["relationships"], pairs),
        "unresolved_relationships": cascade.unresolved_relationships(
            db["relationship"], dh["relationship"], db["dataset"], dh["dataset"]),
    }, "reports")
    requests = delta.payloads(changes["sets"], sent["items"], sent["relationships"], pairs, chunk)
    once(lambda: {"": lambda path: sinks.write_payloads(requests, path, mode="overwrite")}, "payloads")


def full_sync(
    spark: SparkSession, source: dict[str, DataFrame], remote: dict[str, DataFrame], root: str, version: str,
    *, allow_empty_source: bool = False, preview_rows: int = delta.DEFAULT_PREVIEW, chunk: int = 1000,
    commit: bool = True, remote_sets: DataFrame | None = None, buckets: int | None = None,
) -> DataFrame:
    """Stash both sides, store their changes and payloads, and return the preview.

    ``source`` and ``remote`` are the tables of ``source_snapshot`` and
    ``catalog_snapshot``. Written below ``root``: the snapshot version, its changes
    and, with ``commit``, its payload requests and reports of what could not be sent. A relationship of which only
    column pairs changed is sent as an update. ``remote_sets`` (schema, physical_nm, id) is the remote list of sets,
    looked up after the catalog snapshot.

    Each of these is a part of the version with its own commit record. A run that was interrupted is continued by calling this
    again with the same version: committed parts are read, whatever ``source`` and ``remote`` are by then, the others are made. A version
    of which all parts are committed is an error, as it is never written over. ``buckets`` is that of ``snapshots.write_snapshot``.
    """
    if snapshots.is_committed(spark, root, version, "sync"):
        raise FileExistsError(f"version {version} is complete")
    sides = []
    for side, tables in (("source", source), ("catalog", remote)):
        if not snapshots.is_committed(spark, root, version, side):
            snapshots.write_snapshot(tables, root, version, side, buckets)
        sides.append(snapshots.read_snapshot(spark, root, version, side))
    db, dh = sides
    cascade.require_source(db["dataset"], allow_empty_source)

    changes = snapshots.part_once(lambda: changes_between(db, dh), root, version, "changes", f"changes/version={version}", spark=spark)
    feed = cascade.change_feed(*[changes[n] for n in CHANGES])
    if commit:
        write_requests(changes, db, dh, root, version, chunk, remote_sets)
        snapshots.commit(spark, root, version, "sync", [("", "", None, None, None)])
    return delta.preview(feed, preview_rows)


def relationships_only(
    tables: dict[str, DataFrame], rel_docs: DataFrame, patterns: list[str] | None = None, col: str = "doc",
) -> DataFrame:
    """Requests of the foreign-key flow: ids of outdated relationships, bodies of all fresh ones."""
    fk = catalog.resolve_foreign_keys(tables, patterns)
    fresh = catalog.relationship_documents(fk)
    known = documents.parse_catalog_relationships(rel_docs, col).select("physical_nm", "id").distinct()
    gone = resolve.outdated_relationships(known, fresh.select("physical_nm"))
    body = F.to_json(F.struct(
        "parent_set", "child_set",
        F.struct(F.col("physical_nm").alias("physical"), F.col("logical_nm").alias("logical")).alias("name"),
        F.struct("on_update", "on_delete").alias("referential_integrity"), "items"))
    return gone.select(F.lit("delete").alias("phase"), F.col("physical_nm"), F.col("id").alias("target_id"),
                       F.lit(0).cast("bigint").alias("part"), F.lit(None).cast("string").alias("body")).unionByName(
        fresh.select(F.lit("upsert").alias("phase"), "physical_nm", F.lit(None).cast("string").alias("target_id"),
                     "part", body.alias("body")))
