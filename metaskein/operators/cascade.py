"""Cascaded changes between two snapshots, and the change feed built from them.

A change to something inside a set, or inside a relationship, that is itself being
deleted is dropped. Each function reads every snapshot table once: one full outer
join on the entity key tells new, deleted and common rows apart, so three diffs
cost one shuffle per side. All results carry a ``change_type`` of ``add``,
``delete`` or ``update``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..session import handed_over
from . import diff as D
from .skew import split_join, without

ADD, DELETE, UPDATE = "add", "delete", "update"


def _sides(db: DataFrame, dh: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer join on ``keys`` with the rows of each side as structs ``db`` and ``dh``.

    The struct of an absent side is NULL.
    """
    pack = lambda df, side: df.select(*keys, F.struct(*[c for c in df.columns if c not in keys]).alias(side))
    return pack(db, "db").join(pack(dh, "dh"), keys, "full")


def _change(updated: Column) -> Column:
    """Change type of a row of ``_sides``; NULL where both sides agree."""
    return (
        F.when(F.col("dh").isNull(), ADD).when(F.col("db").isNull(), DELETE).when(updated, UPDATE)
    )


def _by_change(**values) -> Column:
    """A value per change type; a missing one is NULL."""
    out = None
    for change, value in values.items():
        condition, v = F.col("change_type") == change, X.col(value)
        out = F.when(condition, v) if out is None else out.when(condition, v)
    return out


# --- sets -------------------------------------------------------------------


def set_changes(db_sets: DataFrame, dh_sets: DataFrame) -> DataFrame:
    """Set changes: added sets with their texts, deleted and updated ones with the catalog id."""
    updated = D.definition_changed("db.definition", "dh.definition")
    shown = D.definition_differs("db.definition", "dh.definition")
    return (
        _sides(db_sets, dh_sets, ["physical_nm"])
        .withColumn("change_type", _change(updated))
        .where(F.col("change_type").isNotNull())
        .select(
            "change_type", X.set_id("physical_nm").alias("entity_id"), "physical_nm",
            _by_change(add="db.logical_nm", delete="dh.logical_nm").alias("logical_nm"),
            F.coalesce("db.schema", "dh.schema").alias("schema"),
            _by_change(add="db.description", delete="dh.description").alias("description"),
            _by_change(add=X.blank_to_null("db.type")).alias("type"),
            _by_change(add=F.col("db.definition"), update=F.when(shown, F.col("db.definition"))).alias("definition"),
            F.col("dh.id").alias("catalog_id"),
        )
        .withColumn("fqdn", X.fqdn("schema", "physical_nm"))
    )


def _set_state(db_sets: DataFrame, dh_sets: DataFrame) -> DataFrame:
    """Both sides' view of a set by exact name: schemas, catalog id, and whether it goes."""
    return _sides(db_sets.select("physical_nm", "schema"), dh_sets.select("physical_nm", "schema", "id"),
                  ["physical_nm"]).select(
        F.col("physical_nm").alias("dataset_id"),
        F.col("db").isNotNull().alias("_in_db"), F.col("dh").isNotNull().alias("_in_dh"),
        F.col("db.schema").alias("_db_schema"), F.col("dh.schema").alias("_dh_schema"),
        F.col("dh.id").alias("_set_id"),
    )


# --- items ------------------------------------------------------------------


def key_type(is_pk: Column | str, key_nm: Column | str) -> Column:
    """'primary' for a primary key, 'foreign' for any other named key, else NULL."""
    return F.when(F.coalesce(X.col(is_pk), F.lit(False)), "primary").when(
        F.length(X.or_empty(key_nm)) > 0, "foreign"
    )


def _item_states(db_items: DataFrame, dh_items: DataFrame, db_sets: DataFrame, dh_sets: DataFrame) -> DataFrame:
    """Items that differ between the sides, as they are to be changed, with what the sides know of their set.

    The values of the change are chosen before the item meets its set, so that no shuffle carries both sides' texts.
    """
    fields = {f.name: f for f in D.ITEM_FIELDS}

    def taken(name: str) -> Column:
        f = fields[name]
        return F.when(f.changed(), f.seen("db")).otherwise(F.col(f"db.{f.column}"))

    def value(column: str, update: Column) -> Column:
        return _by_change(add=f"db.{column}", delete=f"dh.{column}", update=update).alias(column)

    lost_pk = fields["pk"].changed() & ~F.col("db.is_pk")
    own_metadata = F.coalesce("db.metadata", "dh.metadata")
    name = X.blank_to_null
    updated = reduce(lambda a, b: a | b, [f.selects() for f in D.ITEM_FIELDS])
    differing = _sides(db_items, dh_items, ["dataset_id", "physical_nm"]).withColumn("change_type", _change(updated))
    rows = differing.where(F.col("change_type").isNotNull()).select(
        "change_type", "dataset_id", "physical_nm",
        value("logical_nm", F.col("db.logical_nm")),
        value("type", taken("type")),
        value("description", F.coalesce(F.when(F.length("dh.description") > 0, F.col("dh.description")),
                                        F.col("db.description"))),
        _by_change(
            add=key_type("db.is_pk", "db.key_nm"), delete=key_type("dh.is_pk", "dh.key_nm"),
            update=F.when(lost_pk, F.lit("foreign")).otherwise(key_type("db.is_pk", "db.key_nm")),
        ).alias("key_type"),
        _by_change(add=name("db.key_nm"), delete=name("dh.key_nm"), update=name(taken("keyname"))).alias("key_name"),
        value("nullable", taken("nullable")),
        value("example", taken("example")),
        value("default_val", taken("default")),
        F.col("dh.id").alias("item_id"),
        _by_change(**{c: F.when(F.json_object_keys(own_metadata).isNotNull(), own_metadata) for c in (ADD, DELETE)})
        .alias("metadata"),
    )
    return rows.join(_set_state(db_sets, dh_sets), "dataset_id", "left")


def unresolved_items(db_items: DataFrame, dh_items: DataFrame, db_sets: DataFrame, dh_sets: DataFrame) -> DataFrame:
    """Item changes that cannot be placed, to be reported: neither side has their set, or a deleted item's set has no schema.

    An addition is listed too if only the source lacks its set. Items of a set that is being deleted go with it and are not listed.
    """
    known = lambda c: F.coalesce(c, F.lit(False))
    in_db, in_dh = known(F.col("_in_db")), known(F.col("_in_dh"))
    lost = _by_change(add=~in_db, delete=~in_dh | (in_db & F.col("_dh_schema").isNull()), update=~in_db & ~in_dh)
    rows = _item_states(db_items, dh_items, db_sets, dh_sets).where(lost)
    return rows.select("change_type", "dataset_id", "physical_nm", "item_id", in_db.alias("in_source"), in_dh.alias("in_catalog"))


def item_changes(
    db_items: DataFrame, dh_items: DataFrame, db_sets: DataFrame, dh_sets: DataFrame, store: bool = False
) -> DataFrame:
    """Item changes within their set, without those of deleted sets and of sets that no side knows (``unresolved_items``).

    Updated items take the source's value where the flag is set and keep their own
    otherwise; an item that is also deleted (same name without case) is not updated.
    Malformed metadata JSON becomes NULL. With ``store`` the rows are made and stored first; after that, only updates and the names of deletions meet.
    """
    rows = _item_states(db_items, dh_items, db_sets, dh_sets).where(_by_change(
        add=F.lit(True),
        delete=F.col("_dh_schema").isNotNull() & F.col("_in_db"),
        update=F.col("_in_db") & F.col("_in_dh"),
    )).withColumns({
        "schema": _by_change(add="_db_schema", delete="_dh_schema", update="_db_schema"),
        "set_id": _by_change(update="_set_id"),
    }).drop("_in_db", "_in_dh", "_db_schema", "_dh_schema", "_set_id")
    columns = [
        "change_type", "dataset_id", "physical_nm", "schema", "logical_nm", "type", "description", "key_type", "key_name", "nullable",
        "example", "default_val", "set_id", "item_id", "metadata"]
    change = F.col("change_type")
    if not store:
        same_name = Window.partitionBy(F.lower("dataset_id"), F.lower("physical_nm"))
        return rows.withColumn("_gone", F.max(change == DELETE).over(same_name)).where((change != UPDATE) | ~F.col("_gone")).select(*columns)
    rows = handed_over(rows.select(*columns))
    gone = rows.where(change == DELETE).select(F.lower("dataset_id").alias("_set"), F.lower("physical_nm").alias("_item"))
    same = (F.lower("dataset_id") == F.col("_set")) & (F.lower("physical_nm") == F.col("_item"))  # an update's names are never NULL
    return rows.where(change != UPDATE).unionByName(rows.where(change == UPDATE).join(gone, same, "left_anti"))


# --- relationships ----------------------------------------------------------


def relationship_states(
    db_rels: DataFrame, dh_rels: DataFrame, db_sets: DataFrame, dh_sets: DataFrame
) -> DataFrame:
    """Every relationship of either side with its change (NULL if none) and its owning set.

    Unchanged ones go along with their id alone, as only their name and sides matter later; updated ones without the fields that no update shows.
    ``_known``: some side has the owning set; ``_set_gone``: that set is being deleted.
    Owners are compared without case. The join can be split, since one
    set may own a large share of all relationships.
    """
    rules = ("on_update", "on_delete", "on_match")
    updated = reduce(lambda a, b: a | b, [X.folded(f"dh.{r}") != X.folded(f"db.{r}") for r in rules])
    states = _sides(db_rels, dh_rels, ["physical_nm"]).withColumn("change_type", _change(updated)).withColumn(
        "dataset_id", F.coalesce("db.dataset_id", "dh.dataset_id"))
    changed, one_sided = F.col("change_type").isNotNull(), F.col("change_type").isin(ADD, DELETE)
    unseen = {"db": ("type",), "dh": ("type", "logical_nm")}  # by an update

    def slim(side: str) -> Column:
        """The side's row but its owner; of one that agrees with the other side only the id."""
        def wanted(f: str) -> Column:
            return F.lit(f == "id") if f in ("id", "dataset_id") else one_sided if f in unseen[side] else changed

        fields = [F.when(wanted(f), F.col(f"{side}.{f}")).alias(f) for f in states.schema[side].dataType.fieldNames()]
        return F.when(F.col(side).isNotNull(), F.struct(*fields))

    states = states.withColumns({side: slim(side) for side in ("db", "dh")})
    owner = (
        _set_state(db_sets, dh_sets)
        .groupBy(F.lower("dataset_id").alias("_owner"))
        .agg(F.min("_db_schema").alias("_db_schema"), F.min("_dh_schema").alias("_dh_schema"),
             F.min(~F.col("_in_db")).alias("_set_gone"))
        .withColumn("_known", F.lit(True))
    )
    rels = states.withColumn("_owner", F.lower("dataset_id"))
    return split_join(rels, owner, ["_owner"], "left").withColumns(
        {"_known": F.coalesce("_known", F.lit(False)), "_set_gone": F.coalesce("_set_gone", F.lit(False))})


def relationship_changes(
    db_rels: DataFrame, dh_rels: DataFrame, db_sets: DataFrame, dh_sets: DataFrame,
    default_schema: str | None = None, states: DataFrame | None = None,
) -> DataFrame:
    """Relationship changes whose owning set is known and stays.

    The schema is the source's, else the catalog's, else ``default_schema``.
    """
    states = relationship_states(db_rels, dh_rels, db_sets, dh_sets) if states is None else states
    return _relationship_columns(states.where(F.col("_known") & ~F.col("_set_gone")), default_schema)


def unresolved_relationships(
    db_rels: DataFrame, dh_rels: DataFrame, db_sets: DataFrame, dh_sets: DataFrame, states: DataFrame | None = None,
) -> DataFrame:
    """Relationship changes whose owning set neither side knows."""
    states = relationship_states(db_rels, dh_rels, db_sets, dh_sets) if states is None else states
    return _relationship_columns(states.where(~F.col("_known")), None)


def relationships_of_joins(
    joins: DataFrame, relationships: DataFrame, db_rels: DataFrame, dh_rels: DataFrame
) -> DataFrame:
    """Relationships with changed column pairs and no change of their own, as updates: their bodies carry the pairs."""
    names = without(
        joins.select(F.col("db_relationship_id").alias("physical_nm")).distinct(), relationships, ["physical_nm"])
    none = F.lit(None).cast("string")
    states = _sides(db_rels, dh_rels, ["physical_nm"]).join(names, "physical_nm", "left_semi").withColumns({
        "change_type": F.lit(UPDATE), "dataset_id": F.coalesce("db.dataset_id", "dh.dataset_id"),
        "_db_schema": none, "_dh_schema": none})
    return _relationship_columns(states, None)


def _relationship_columns(states: DataFrame, default_schema: str | None) -> DataFrame:
    def value(column: str, update: Column) -> Column:
        return _by_change(add=f"db.{column}", delete=f"dh.{column}", update=update).alias(column)

    rule = lambda c: value(c, X.first_filled(f"db.{c}", f"dh.{c}"))
    return states.where(F.col("change_type").isNotNull()).select(
        "change_type", "physical_nm", "dataset_id",
        value("logical_nm", X.first_filled("db.logical_nm", "physical_nm")),
        value("comment", X.first_filled("dh.comment", "db.comment")),
        rule("on_update"), rule("on_delete"), rule("on_match"),
        _by_change(add="db.type", delete="dh.type").alias("type"),
        F.col("dh.id").alias("catalog_id"),
        F.coalesce("_db_schema", "_dh_schema", F.lit(default_schema)).alias("schema"),
    )


# --- joins ------------------------------------------------------------------


def join_changes(
    db_joins: DataFrame, dh_joins: DataFrame, db_rels: DataFrame, dh_rels: DataFrame,
    db_sets: DataFrame, dh_sets: DataFrame, states: DataFrame | None = None,
) -> DataFrame:
    """Column-pair changes whose relationship stays.

    ``states`` are those of ``relationship_states``, if the caller has stored them.

    Adds and deletes need a relationship known to their side whose set is not being
    deleted. An update of a relationship the source does not know creates it with its
    catalog id.

    One full outer join tells the three kinds apart. Pairs on both sides that agree go no further; what is left meets its
    relationship. One-sided pairs are looked up on the other side once more, since another relationship may have the same two columns.
    """
    keys, pair = ["db_relationship_id", "parent_fqdn", "child_fqdn"], ["parent_fqdn", "child_fqdn"]
    differs = (F.col("dh.position") != F.col("db.position")) | (F.col("dh.cardinality") != F.col("db.cardinality"))
    found = _sides(db_joins, dh_joins, keys).withColumn("change_type", _change(differs)).where(F.col("change_type").isNotNull())
    nonzero = lambda c: F.when(F.col(c) != 0, F.col(c))
    changes = found.select(
        "change_type", *keys,
        _by_change(add="db.position", delete="dh.position", update=F.coalesce(nonzero("dh.position"), nonzero("db.position"), F.lit(0))).alias("position"),
        _by_change(add="db.cardinality", delete="dh.cardinality", update=X.first_filled("db.cardinality", "dh.cardinality")).alias("cardinality"))
    states = relationship_states(db_rels, dh_rels, db_sets, dh_sets) if states is None else states
    # Gone: the relationship's own deletion is in the feed (its set is known and stays).
    gone = Window.partitionBy(F.lower("physical_nm"))
    owner = states.select(  # before the window, so that its shuffle carries no texts, and the name not once more in lower case
        "physical_nm", F.col("dh.id").alias("relationship_id"),
        F.col("db").isNotNull().alias("_in_db"), F.col("dh").isNotNull().alias("_in_dh"), "_set_gone",
        F.coalesce((F.col("change_type") == DELETE) & F.col("_known") & ~F.col("_set_gone"), F.lit(False)).alias("_goes"),
    ).repartition(F.lower("physical_nm")).withColumn("_gone", F.max("_goes").over(gone)).drop("_goes").withColumnRenamed("physical_nm", "db_relationship_id")
    complete = F.col("parent_fqdn").isNotNull() & F.col("child_fqdn").isNotNull()
    kept = changes.join(owner, "db_relationship_id").where(~F.col("_gone")).where(_by_change(
        add=F.col("_in_db") & ~F.col("_in_dh") & ~F.col("_set_gone") & complete,
        delete=F.col("_in_dh") & ~F.col("_in_db") & ~F.col("_set_gone") & complete, update=F.col("_in_dh")))
    other = dh_joins.select(*pair, F.lit(ADD).alias("change_type")).unionByName(db_joins.select(*pair, F.lit(DELETE).alias("change_type")))
    # Told by the owner too, so that the lookup stays behind the join with it, where there are fewer rows. One side always has it here.
    kept = kept.withColumn("_change", F.when(F.col("_in_db") | F.col("_in_dh"), F.col("change_type"))).drop("change_type")
    kept = split_join(kept, other.withColumnRenamed("change_type", "_change"), [*pair, "_change"], "left_anti").withColumnRenamed("_change", "change_type")
    return kept.select(
        "change_type", "db_relationship_id", _by_change(update="relationship_id").alias("relationship_id"),
        _by_change(update=~F.col("_in_db")).alias("creates_relationship"),
        *[X.fqdn_part(f"{end}_fqdn", i).alias(f"{end}_{part}")
          for end in ("parent", "child") for i, part in enumerate(("schema", "set", "item"))],
        "parent_fqdn", "child_fqdn",
        X.default_to("position", 0).alias("position"),
        F.coalesce(X.blank_to_null("cardinality"), F.lit(X.DEFAULT_CARDINALITY)).alias("cardinality"),
    )


# --- feed -------------------------------------------------------------------


def _stack(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def change_feed(
    sets: DataFrame, items: DataFrame, relationships: DataFrame, joins: DataFrame
) -> DataFrame:
    """All changes in one table: who changed and how, with the full change in ``body``.

    ``entity_id`` is the id used for membership tests, ``catalog_id`` the remote one.
    """

    def feed(df: DataFrame, entity: str, ident: Column, catalog: str, name: Column, set_nm: Column) -> DataFrame:
        return df.select(
            F.lit(entity).alias("entity"),
            "change_type",
            ident.alias("entity_id"),
            F.col(catalog).alias("catalog_id"),
            "schema",
            set_nm.alias("set_nm"),
            name.alias("name"),
            F.struct(*[c for c in df.columns if c not in ("change_type", "schema")]).alias(f"{entity}_body"),
        )

    pairs = joins.withColumn("schema", F.col("parent_schema"))
    return _stack(
        feed(sets, "set", F.col("entity_id"), "catalog_id", F.col("physical_nm"), F.col("physical_nm")),
        feed(items, "item", X.item_id(X.fqdn("schema", "dataset_id", "physical_nm")), "item_id",
             F.col("physical_nm"), F.col("dataset_id")),
        feed(relationships, "relationship", X.set_id("physical_nm"), "catalog_id", F.col("physical_nm"),
             F.col("dataset_id")),
        feed(pairs, "join", X.pair_id("parent_fqdn", "child_fqdn"), "relationship_id",
             F.concat_ws(" -> ", "parent_fqdn", "child_fqdn"), F.col("parent_set")),
    )


def require_source(db_sets: DataFrame, allow_empty_source: bool = False) -> None:
    """Refuse a diff against an empty source side: it would delete the whole catalog."""
    if not allow_empty_source and db_sets.isEmpty():
        raise ValueError("the source snapshot has no sets; pass allow_empty_source=True to delete everything")


def has_change(ids: DataFrame, feed: DataFrame, change_type: str, id_col: str = "entity_id") -> DataFrame:
    """``ids`` with a boolean ``has_<change>``: is that id in the feed? Blank ids never are."""
    listed = (
        feed.where((F.col("change_type") == change_type) & (F.length("entity_id") > 0))
        .select(F.col("entity_id").alias(id_col))
        .distinct()
        .withColumn("_hit", F.lit(True))
    )
    return ids.join(listed, id_col, "left").select(
        *ids.columns, F.coalesce("_hit", F.lit(False)).alias(f"has_{change_type}")
    )
