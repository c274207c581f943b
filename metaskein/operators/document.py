"""Merging of entity rows that arrive several times, and nested documents.

``order_by`` gives the arrival order and must be total; where a rule says "first" or
"later", it means that order. All merges are aggregates that combine before the
shuffle and keep a bounded state per key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from .skew import number_in_parts


def _first(column: str, seq: Column, only: Column | None = None) -> Column:
    return F.min_by(column, F.when(only, seq) if only is not None else seq).alias(column)


def _last(column: str, seq: Column, only: Column) -> Column:
    return F.max_by(column, F.when(only, seq)).alias(column)


def merge_schemas(df: DataFrame, order_by: list[str]) -> DataFrame:
    """One row per schema: the first non-blank comment, else first values."""
    seq = F.struct(*order_by)
    rest = [c for c in df.columns if c not in ("schema", "comment", *order_by)]
    return df.groupBy(F.lower("schema").alias("schema_id")).agg(
        _first("schema", seq), _first("comment", seq, ~X.is_blank("comment")), *[_first(c, seq) for c in rest])


def merge_sets(df: DataFrame, order_by: list[str]) -> DataFrame:
    """One row per set of a schema: a later non-empty description wins, all else is first."""
    return _merge_named(df, {"schema": "schema_id", "physical_nm": "set_id"}, order_by)


def merge_items(df: DataFrame, order_by: list[str]) -> DataFrame:
    """One row per item of a set: a later non-empty description wins, all else is first."""
    return _merge_named(df, {"dataset_id": "set_id", "physical_nm": "item_id"}, order_by)


def _merge_named(df: DataFrame, named: dict[str, str], order_by: list[str]) -> DataFrame:
    """One row per lower-case name; ``named`` gives the id that each name column makes.

    A name that is its own id is not sorted and shuffled a second time beside the id.
    """
    seq = F.struct(*order_by)
    rest = [c for c in df.columns if c not in ("description", *order_by)]
    short = df.withColumns({f"_{i}": F.lower(c) for c, i in named.items()})
    short = short.withColumns({c: F.when(F.col(c) != F.col(f"_{i}"), F.col(c)) for c, i in named.items()})
    merged = short.groupBy(*[F.col(f"_{i}").alias(i) for i in named.values()]).agg(
        F.min_by(F.struct(*rest), seq).alias("f"),
        _last("description", seq, F.length("description") > 0),
    )
    return merged.select(*named.values(), *[(F.coalesce(f"f.{c}", named[c]) if c in named else F.col(f"f.{c}")).alias(c) for c in rest],
                         X.or_empty("description").alias("description"))


def merge_keys(df: DataFrame, order_by: list[str]) -> DataFrame:
    """One row per key of a set (names without case): type and comment.

    The type is the first non-empty one, the comment the last non-empty one. The
    items of the keys are in ``merge_key_items``.
    """
    seq = F.struct(*order_by)
    return df.groupBy("dataset_id", F.lower("name").alias("key_id")).agg(
        _first("name", seq),
        _first("type", seq, F.length("type") > 0),
        _last("comment", seq, F.length("comment") > 0),
    )


def merge_key_items(df: DataFrame, order_by: list[str], item_col: str = "item") -> DataFrame:
    """Distinct (set, key, item) with the place of first arrival, one row per item.

    A flat list: a key over any number of items never becomes one row.
    """
    return df.where(F.col(item_col).isNotNull()).groupBy(
        "dataset_id", F.lower("name").alias("key_id"), F.col(item_col).alias("item")
    ).agg(F.min(F.struct(*order_by)).alias("first_seen"))


def merge_relationships(df: DataFrame, order_by: list[str]) -> DataFrame:
    """One row per relationship name: last non-blank comment, first id, last integrity rules."""
    seq = F.struct(*order_by)
    has_rules = F.coalesce("on_update", "on_delete", "on_match").isNotNull()
    rules = F.max_by(F.struct("on_update", "on_delete", "on_match"), F.when(has_rules, seq))
    return df.groupBy(F.lower("physical_nm").alias("relationship_id")).agg(
        _first("physical_nm", seq), _first("dataset_id", seq),
        _first("id", seq, ~X.is_blank("id")), _first("type", seq, F.length("type") > 0),
        _last("comment", seq, ~X.is_blank("comment")), rules.alias("r"),
    ).select("relationship_id", "physical_nm", "dataset_id", "id", "type", "comment", "r.*")


def relationship_conflicts(df: DataFrame) -> DataFrame:
    """Relationship names whose rows cannot be merged, one row per (name, reason).

    Two values differ exactly if the smallest and the largest do, so no list of
    values is held.
    """
    ident = F.when(~X.is_blank("id"), F.col("id"))
    kind = F.when(F.length("type") > 0, F.col("type"))
    owner = X.set_id("dataset_id")
    found = df.groupBy(F.lower("physical_nm").alias("relationship_id")).agg(
        (F.min(ident) != F.max(ident)).alias("different ids"),
        (F.min(kind) != F.max(kind)).alias("different types"),
        (F.min(owner) != F.max(owner)).alias("different sets"),
    )
    reasons = F.array(*[F.when(F.col(c), F.lit(c)) for c in found.columns[1:]])
    return found.select("relationship_id", F.explode(F.array_compact(reasons)).alias("reason"))


def merge_joins(df: DataFrame, order_by: list[str]) -> DataFrame:
    """One row per column pair: last non-zero position and last non-blank cardinality."""
    seq = F.struct(*order_by)
    return df.groupBy(
        F.lower("db_relationship_id").alias("relationship_id"),
        X.pair_id("parent_fqdn", "child_fqdn").alias("join_id"),
    ).agg(
        _first("db_relationship_id", seq), _first("parent_fqdn", seq), _first("child_fqdn", seq),
        _last("position", seq, F.col("position") != 0),
        _last("cardinality", seq, F.length("cardinality") > 0),
    ).withColumns({"position": X.default_to("position", 0), "cardinality": X.or_empty("cardinality")})


# --- links between sets and relationships ------------------------------------


def set_links(pairs: DataFrame) -> DataFrame:
    """Distinct (set, role, relationship): which relationships touch a set, and how.

    One row per link, so a set in any number of relationships stays distributed.
    ``link`` is the text form ``role=relationship``.
    """
    ends = F.array(
        F.struct(F.lit("parent").alias("role"), F.lower("parent_set").alias("set_id")),
        F.struct(F.lit("child").alias("role"), F.lower("child_set").alias("set_id")),
    )
    links = pairs.select(F.lower("db_relationship_id").alias("relationship_id"), F.inline(ends))
    return links.where(F.col("set_id").isNotNull()).distinct().withColumn(
        "link", F.concat("role", F.lit("="), "relationship_id"))


def relationships_of(links: DataFrame, rels: DataFrame) -> DataFrame:
    """The relationships each set is linked to."""
    known = rels.withColumn("relationship_id", F.lower("physical_nm"))
    return links.select("set_id", "relationship_id").distinct().join(known, "relationship_id")


def dangling_links(links: DataFrame, rels: DataFrame) -> DataFrame:
    """Links to relationships that do not exist."""
    known = rels.select(F.lower("physical_nm").alias("relationship_id"))
    return links.join(known, "relationship_id", "left_anti").select(*links.columns)


# --- nested documents ---------------------------------------------------------


def items_by_type(items: DataFrame, types: list[str]) -> DataFrame:
    """Items of the wanted types, one row each; a wanted type without items has one
    row whose item columns are NULL."""
    names = sorted({t.lower() for t in types})
    wanted = items.sparkSession.createDataFrame([(t,) for t in names], "wanted string")
    hits = items.where(F.lower("type").isin(*names)).withColumn("wanted", F.lower("type"))
    empty = wanted.join(F.broadcast(hits.select("wanted").distinct()), "wanted", "left_anti")
    return hits.unionByName(empty, allowMissingColumns=True)


def views(sets: DataFrame) -> DataFrame:
    return sets.where(X.is_view("type"))


def non_views(sets: DataFrame) -> DataFrame:
    return sets.where(~X.is_view("type"))


def assemble(
    sets: DataFrame, items: DataFrame, relationships: DataFrame, pairs: DataFrame,
    name: str, comment: str | None = None, chunk: int = 1000,
) -> DataFrame:
    """The nested document, in fragments of one shape: ``{name, comment, schemas}``.

    ``schemas`` maps schema id to ``{name, comment, sets, relationships}``; a fragment
    carries one set with up to ``chunk`` of its items, or one relationship with up to
    ``chunk`` of its pairs. Merging the maps of all fragments key by key gives the
    whole document, which as one row would not fit a task. Inputs must be unique per
    id (see the merges above).
    """
    sets = sets.withColumn("set_id", X.set_id("physical_nm"))
    item_cols = [c for c in items.columns if c != "dataset_id"]
    item_entry = F.struct(X.norm("physical_nm").alias("key"), F.struct(*item_cols).alias("value"))
    item_parts = (
        number_in_parts(items.withColumn("set_id", F.lower("dataset_id")), ["set_id"], ["physical_nm"], chunk)
        .groupBy("set_id", "part").agg(F.map_from_entries(F.collect_list(item_entry)).alias("items"))
    )
    set_cols = [c for c in sets.columns if c not in ("set_id", "schema")]
    set_doc = sets.join(item_parts, "set_id", "left").select(
        "schema",
        F.create_map("set_id", F.struct(*set_cols, "items")).alias("sets"),
    )

    rel_cols = [c for c in relationships.columns if c != "schema"]
    rels = relationships.withColumn("rel_id", F.lower("physical_nm"))
    pair_cols = [c for c in pairs.columns if c != "db_relationship_id"]
    pair_parts = (
        number_in_parts(pairs.withColumn("rel_id", F.lower("db_relationship_id")), ["rel_id"],
                        ["position", "parent_fqdn", "child_fqdn"], chunk)
        .groupBy("rel_id", "part")
        .agg(F.array_sort(F.collect_list(F.struct("position", *[c for c in pair_cols if c != "position"])))
             .alias("items"))
    )
    rel_doc = rels.join(pair_parts, "rel_id", "left").select(
        "schema",
        F.create_map("rel_id", F.struct(*rel_cols, "items")).alias("relationships"),
    )
    both = set_doc.unionByName(rel_doc, allowMissingColumns=True)
    schema_id = F.lower(X.or_empty("schema"))
    return both.select(
        F.lit(name).alias("name"),
        F.lit(comment).cast("string").alias("comment"),
        F.create_map(schema_id, F.struct(F.col("schema").alias("name"), "sets", "relationships")).alias("schemas"),
    )


def flatten_sets(doc: DataFrame) -> DataFrame:
    """All sets of a document, once each."""
    s = _schemas(doc).where("s.sets is not null").select("schema", F.explode("s.sets").alias("set_id", "v"))
    cols = [c for c in s.select("v.*").columns if c != "items"]
    # A set cut into parts repeats its own fields in every part.
    return s.select("schema", *[F.col(f"v.{c}") for c in cols]).dropDuplicates(["schema", "physical_nm"])


def flatten_items(doc: DataFrame) -> DataFrame:
    """All items of a document with the name of their set."""
    s = _schemas(doc).where("s.sets is not null").select(F.explode("s.sets").alias("set_id", "v"))
    i = s.where("v.items is not null").select(F.col("v.physical_nm").alias("dataset_id"),
                                              F.explode("v.items").alias("item_id", "i"))
    return i.select("dataset_id", "i.*")


def flatten_relationships(doc: DataFrame) -> DataFrame:
    """All relationships of a document, once each."""
    r = _relationships(doc)
    cols = [c for c in r.select("v.*").columns if c != "items"]
    return r.select("schema", *[F.col(f"v.{c}") for c in cols]).dropDuplicates(["schema", "physical_nm"])


def flatten_pairs(doc: DataFrame) -> DataFrame:
    """All column pairs of a document with the name of their relationship."""
    r = _relationships(doc).where("v.items is not null")
    p = r.select(F.col("v.physical_nm").alias("db_relationship_id"), F.explode("v.items").alias("p"))
    return p.select("db_relationship_id", "p.*")


def _schemas(doc: DataFrame) -> DataFrame:
    return doc.select(F.explode("schemas").alias("schema_id", "s")).withColumn("schema", F.col("s.name"))


def _relationships(doc: DataFrame) -> DataFrame:
    return _schemas(doc).where("s.relationships is not null").select(
        "schema", F.explode("s.relationships").alias("rel_id", "v"))
