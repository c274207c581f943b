"""Snapshot differences between the source of truth (db) and the remote catalog (dh).

Membership tests are equi anti-joins: keys are never NULL in a snapshot, and rows
with a NULL key are left out on both sides. (SQL ``NOT IN`` would broadcast the
whole sub-select and return nothing at all once it holds a NULL.)

In the result columns the suffix ``_database`` marks the value of the source side
and ``_catalog`` that of the catalog side.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from .skew import without


def new_rows(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``left`` whose key is missing in ``right``; both unique on ``keys``."""
    return left.dropna(subset=keys).join(right.select(*keys), keys, "left_anti").select(*left.columns)


def deleted_rows(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``right`` whose key is missing in ``left``; both unique on ``keys``."""
    return new_rows(right, left, keys)


def _schema_of(sets: DataFrame) -> DataFrame:
    return sets.select(F.col("physical_nm").alias("dataset_id"), "schema")


# --- sets -------------------------------------------------------------------


def sets_new(db_sets: DataFrame, dh_sets: DataFrame) -> DataFrame:
    return new_rows(db_sets, dh_sets, ["physical_nm"])


def sets_deleted(db_sets: DataFrame, dh_sets: DataFrame) -> DataFrame:
    return deleted_rows(db_sets, dh_sets, ["physical_nm"])


def definition_differs(db: str, dh: str) -> Column:
    """The flag: trimmed texts differ; a NULL on either side is no difference."""
    return F.coalesce(F.trim(db) != F.trim(dh), F.lit(False))


def definition_changed(db: str, dh: str) -> Column:
    """The row filter: NULL counts as empty text, and the db side must be filled."""
    return ~X.is_blank(db) & (F.trim(X.or_empty(db)) != F.trim(X.or_empty(dh)))


def sets_updated(db_sets: DataFrame, dh_sets: DataFrame) -> DataFrame:
    """Sets on both sides whose trimmed definition differs and is filled on the db side.

    Rows are chosen with NULL as empty text, the flag is not: a NULL definition on
    the catalog side keeps the row with ``differing_definition`` false.
    """
    db = db_sets.select("physical_nm", "schema", F.col("definition").alias("db_def"))
    dh = dh_sets.select("physical_nm", "id", F.col("definition").alias("dh_def"))
    differs = definition_differs("db_def", "dh_def")
    return (
        db.join(dh, "physical_nm")
        .where(definition_changed("db_def", "dh_def"))
        .select(
            "physical_nm",
            "schema",
            "id",
            differs.alias("differing_definition"),
            F.when(differs, F.col("dh_def")).alias("dh_definition"),
            F.when(differs, F.col("db_def")).alias("db_definition"),
        )
    )


# --- items ------------------------------------------------------------------


def items_new(db_items: DataFrame, dh_items: DataFrame, db_sets: DataFrame) -> DataFrame:
    """Source items whose column name occurs nowhere in the catalog, in whatever set.

    The name alone is the key, and names such as ``id`` may hold much of a fleet:
    the join can be split. ``items_new_scoped`` compares within the set.
    """
    new = without(db_items.dropna(subset=["physical_nm"]), dh_items, ["physical_nm"])
    return new.join(_schema_of(db_sets), "dataset_id", "left").select(*db_items.columns, "schema")


def items_new_scoped(db_items: DataFrame, dh_items: DataFrame, db_sets: DataFrame) -> DataFrame:
    new = new_rows(db_items, dh_items, ["dataset_id", "physical_nm"])
    return new.join(_schema_of(db_sets), "dataset_id", "left").select(*db_items.columns, "schema")


def items_deleted(db_items: DataFrame, dh_items: DataFrame, dh_sets: DataFrame) -> DataFrame:
    """Catalog items whose name occurs nowhere in the source and whose set has a schema."""
    gone = without(dh_items.dropna(subset=["physical_nm"]), db_items, ["physical_nm"])
    return _under_known_schema(gone, dh_sets, dh_items.columns)


def items_deleted_scoped(db_items: DataFrame, dh_items: DataFrame, dh_sets: DataFrame) -> DataFrame:
    gone = deleted_rows(db_items, dh_items, ["dataset_id", "physical_nm"])
    return _under_known_schema(gone, dh_sets, dh_items.columns)


def _under_known_schema(items: DataFrame, sets: DataFrame, columns: list[str]) -> DataFrame:
    known = _schema_of(sets).where(F.col("schema").isNotNull())
    return items.join(known, "dataset_id").select(*columns, "schema")


@dataclass(frozen=True)
class ItemField:
    """A compared item column: result name, and how its flag and its filter see it."""

    name: str
    column: str
    shown: str = "plain"  # plain | trim | array_prefix
    if_null: object = None  # value NULL stands for when rows are chosen; None: no default
    only_filled: bool = False  # a blank source value does not count as a change

    def seen(self, side: str) -> Column:
        c = F.col(f"{side}.{self.column}")
        return {"plain": c, "trim": F.trim(c), "array_prefix": X.strip_array_prefix(c)}[self.shown]

    def selects(self) -> Column:
        db, dh = F.col(f"db.{self.column}"), F.col(f"dh.{self.column}")
        if self.if_null is None:
            return self.seen("db") != self.seen("dh")
        db, dh = F.coalesce(db, F.lit(self.if_null)), F.coalesce(dh, F.lit(self.if_null))
        return (db != dh) & (F.length(db) > 0) if self.only_filled else db != dh

    def changed(self) -> Column:
        return F.coalesce(self.seen("db") != self.seen("dh"), F.lit(False))

    def outputs(self) -> list[Column]:
        changed = self.changed()
        return [
            changed.alias(f"{self.name}_changed"),
            F.when(changed, self.seen("db")).alias(f"{self.name}_database"),
            F.when(changed, self.seen("dh")).alias(f"{self.name}_catalog"),
        ]


ITEM_FIELDS = (
    ItemField("type", "type", shown="array_prefix"),
    ItemField("pk", "is_pk", if_null=False),
    ItemField("keyname", "key_nm", shown="trim", if_null=""),
    ItemField("nullable", "nullable", if_null=True),
    ItemField("example", "example", shown="trim", if_null="", only_filled=True),
    ItemField("default", "default_val", shown="trim", if_null=""),
)


def items_updated(
    db_items: DataFrame, dh_items: DataFrame, db_sets: DataFrame, dh_sets: DataFrame
) -> DataFrame:
    """Items on both sides with at least one compared column different.

    The row filter gives NULL a default, the flags do not, and flags compare trimmed
    text: a row may therefore be kept with all flags false.

    The two set tables are joined first, so the large item rows are shuffled once
    for the item key and once for the set key.
    """
    chosen = ITEM_FIELDS[0].selects()
    for field in ITEM_FIELDS[1:]:
        chosen = chosen | field.selects()
    both = (
        db_items.alias("db")
        .join(dh_items.alias("dh"), ["dataset_id", "physical_nm"])
        .where(chosen)
        .select(
            "physical_nm",
            "dataset_id",
            *[F.col(f"db.{c}") for c in ("logical_nm", "type", "description", "is_pk", "key_nm",
                                         "nullable", "example", "default_val")],
            F.col("dh.description").alias("dh_description"),
            F.col("dh.id").alias("id"),
            F.col("dh.id").alias("item_id"),
            *[c for field in ITEM_FIELDS for c in field.outputs()],
        )
    )
    sets = db_sets.select(F.col("physical_nm").alias("dataset_id"), "schema").join(
        dh_sets.select(F.col("physical_nm").alias("dataset_id"), F.col("id").alias("set_id")),
        "dataset_id",
    )
    flags = [f"{f.name}_{part}" for f in ITEM_FIELDS for part in ("changed", "database", "catalog")]
    return both.join(sets, "dataset_id").select(
        "physical_nm", "dataset_id", "schema", "logical_nm", "type", "description", "is_pk", "key_nm",
        "nullable", "example", "default_val", "dh_description", "id", "item_id", "set_id", *flags,
    )


# --- relationships ----------------------------------------------------------


def relationships_new(db_rels: DataFrame, dh_rels: DataFrame, db_sets: DataFrame) -> DataFrame:
    new = new_rows(db_rels, dh_rels, ["physical_nm"])
    return new.join(_schema_of(db_sets), "dataset_id", "left").select(*db_rels.columns, "schema")


def relationships_deleted(db_rels: DataFrame, dh_rels: DataFrame, db_sets: DataFrame) -> DataFrame:
    """The schema comes from the source side and is NULL once the set is gone there."""
    gone = deleted_rows(db_rels, dh_rels, ["physical_nm"])
    return gone.join(_schema_of(db_sets), "dataset_id", "left").select(*dh_rels.columns, "schema")


def relationships_updated(db_rels: DataFrame, dh_rels: DataFrame, db_sets: DataFrame) -> DataFrame:
    """Relationships whose update, delete or match rule differs (case and spaces ignored)."""
    rules = {"update": "on_update", "delete": "on_delete", "match": "on_match"}

    def differs(column: str) -> Column:
        return X.folded(f"dh.{column}") != X.folded(f"db.{column}")

    changed = differs("on_update") | differs("on_delete") | differs("on_match")
    both = (
        db_rels.alias("db")
        .join(dh_rels.alias("dh"), F.col("db.physical_nm") == F.col("dh.physical_nm"))
        .where(changed)
        .select(
            F.col("db.physical_nm").alias("physical_nm"),
            F.col("db.dataset_id").alias("dataset_id"),
            F.col("dh.dataset_id").alias("_dh_dataset"),
            X.first_filled("dh.comment", "db.comment").alias("comment"),
            X.folded("dh.comment").alias("dh_comment"),
            X.folded("db.comment").alias("db_comment"),
            *[
                c
                for short, column in rules.items()
                for c in (
                    X.first_filled(f"db.{column}", f"dh.{column}").alias(column),
                    X.folded(f"dh.{column}").alias(f"dh_{short}"),
                    X.folded(f"db.{column}").alias(f"db_{short}"),
                )
            ],
            X.first_filled("db.logical_nm", "dh.physical_nm", "db.physical_nm").alias("logical_nm"),
            F.col("dh.id").alias("id"),
            *[differs(column).alias(f"{short}_changed") for short, column in rules.items()],
        )
    )
    schema = db_sets.select(F.col("physical_nm").alias("_dh_dataset"), "schema")
    out = [c for c in both.columns if c != "_dh_dataset"]
    return both.join(schema, "_dh_dataset", "left").select(*out[:2], "schema", *out[2:])


# --- joins (column pairs of relationships) ----------------------------------


def joins_new(db_joins: DataFrame, dh_joins: DataFrame, dh_rels: DataFrame) -> DataFrame:
    """Column pairs unknown to the catalog that belong to a relationship unknown to it.

    The relationship test comes first: its table is small and unique, and it leaves
    few rows for the pair test. The pair test can be split, since one pair may recur.
    """
    known = dh_rels.select(F.col("physical_nm").alias("db_relationship_id"))
    pair = ["parent_fqdn", "child_fqdn"]
    candidates = new_rows(db_joins.dropna(subset=pair), known, ["db_relationship_id"])
    return without(candidates, dh_joins, pair).select(*db_joins.columns)


def joins_deleted(db_joins: DataFrame, dh_joins: DataFrame, db_rels: DataFrame) -> DataFrame:
    return joins_new(dh_joins, db_joins, db_rels)


def joins_updated(db_joins: DataFrame, dh_joins: DataFrame, dh_rels: DataFrame) -> DataFrame:
    """Column pairs on both sides whose position or cardinality differs.

    A comparison with NULL is no difference. Position: catalog's unless 0, else the
    source's; cardinality: source's unless blank, else the catalog's, else the default.
    """
    nonzero = lambda c: F.when(F.col(c) != 0, F.col(c))
    keys = ["db_relationship_id", "parent_fqdn", "child_fqdn"]
    both = (
        db_joins.alias("db")
        .join(dh_joins.alias("dh"), keys)
        .where((F.col("dh.position") != F.col("db.position"))
               | (F.col("dh.cardinality") != F.col("db.cardinality")))
        .select(
            *keys,
            F.coalesce(nonzero("dh.position"), nonzero("db.position"), F.lit(0)).alias("position"),
            F.coalesce(
                X.first_filled("db.cardinality", "dh.cardinality"), F.lit(X.DEFAULT_CARDINALITY)
            ).alias("cardinality"),
        )
    )
    ids = dh_rels.select(F.col("physical_nm").alias("db_relationship_id"),
                         F.col("id").alias("relationship_id"))
    return both.join(ids, "db_relationship_id").select(*keys, "position", "cardinality", "relationship_id")
