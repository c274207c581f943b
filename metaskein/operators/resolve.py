"""Finding ids and endpoints: which set does this row belong to, and does it exist."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from .skew import split_join


def resolve_set_ids(
    items: DataFrame, schema_sets: DataFrame, snapshot_sets: DataFrame, remote_sets: DataFrame
) -> DataFrame:
    """Set id of each item, from the first place that knows it.

    Order: the item's own ``set_id``; the set of that name in the item's schema; the
    catalog snapshot; the remote list. Names of the last two are compared normalized,
    and the smallest id is taken where several sets share a name. ``resolved_by``
    names the place and is NULL for an item that belongs to no known set.
    """
    in_schema = schema_sets.where(~X.is_blank("id")).groupBy(
        F.col("schema").alias("_schema"), F.lower("physical_nm").alias("_set")
    ).agg(F.min("id").alias("_schema_id"))

    def by_name(sets: DataFrame, out: str) -> DataFrame:
        return sets.where(~X.is_blank("id")).groupBy(X.norm("physical_nm").alias(f"_nm{out}")).agg(
            F.min("id").alias(out))

    # Every set is looked up once, however many items it has.
    sets = items.select("schema", "dataset_id").distinct()
    tiers = (
        sets.join(
            in_schema,
            (F.col("schema") == F.col("_schema")) & (F.lower("dataset_id") == F.col("_set")), "left",
        )
        .join(by_name(snapshot_sets, "_snapshot_id"), X.norm("dataset_id") == F.col("_nm_snapshot_id"), "left")
        .join(by_name(remote_sets, "_remote_id"), X.norm("dataset_id") == F.col("_nm_remote_id"), "left")
        .select("schema", "dataset_id", "_schema_id", "_snapshot_id", "_remote_id")
    )
    found = split_join(items, tiers, ["schema", "dataset_id"], "left")
    own = X.blank_to_null("set_id")
    return found.select(
        *[c for c in items.columns if c != "set_id"],
        F.coalesce(own, "_schema_id", "_snapshot_id", "_remote_id").alias("set_id"),
        F.when(own.isNotNull(), "own")
        .when(F.col("_schema_id").isNotNull(), "schema")
        .when(F.col("_snapshot_id").isNotNull(), "snapshot")
        .when(F.col("_remote_id").isNotNull(), "remote")
        .alias("resolved_by"),
    )


def resolved(items: DataFrame) -> DataFrame:
    return items.where(F.col("resolved_by").isNotNull())


def unresolved(items: DataFrame) -> DataFrame:
    """Items to report: no set id could be found for them."""
    return items.where(F.col("resolved_by").isNull())


def resolve_endpoints(pairs: DataFrame, sets: DataFrame, items: DataFrame) -> DataFrame:
    """Foreign-key endpoints with flags whether their set and item exist (case ignored).

    ``pairs`` has {parent,child}_{schema,set,item,fqdn}. Sets are looked up in the
    endpoint's schema, items in its set; filter on the flags for hits or misses.
    """
    parts = ("schema", "set", "item")
    ends = ("parent", "child")
    known_sets = sets.select(F.lower("schema").alias("_schema"), F.lower("physical_nm").alias("_set")).distinct()
    known_items = items.select(F.lower("dataset_id").alias("_set"), F.lower("physical_nm").alias("_item")).distinct()

    # Every endpoint is looked up once, however many pairs refer to it.
    both = F.array(*[F.struct(*[F.lower(f"{e}_{p}").alias(f"_{p}") for p in parts]) for e in ends])
    found = (
        pairs.select(F.inline(both)).distinct()
        .join(known_sets.withColumn("_set_hit", F.lit(True)), ["_schema", "_set"], "left")
        .join(known_items.withColumn("_item_hit", F.lit(True)), ["_set", "_item"], "left")
        .withColumn("_set_hit", F.coalesce("_set_hit", F.lit(False)))
        .withColumn("_item_hit", F.col("_set_hit") & F.coalesce("_item_hit", F.lit(False)))
        .select("_schema", "_set", "_item", "_set_hit", "_item_hit")
    )
    out = pairs
    for end in ends:
        keyed = out.withColumns({f"_{p}": F.lower(f"{end}_{p}") for p in parts})
        out = split_join(keyed, found, [f"_{p}" for p in parts], "left", hashed=True)
        out = out.select(
            *pairs.columns, *[c for c in out.columns if c.endswith("_found")],
            F.coalesce("_set_hit", F.lit(False)).alias(f"{end}_set_found"),
            F.coalesce("_item_hit", F.lit(False)).alias(f"{end}_item_found"),
        )
    return out


def outdated_relationships(catalog_rels: DataFrame, fresh: DataFrame) -> DataFrame:
    """Catalog relationships (with id) that the fresh extraction no longer has."""
    return catalog_rels.join(fresh.select("physical_nm"), "physical_nm", "left_anti")
