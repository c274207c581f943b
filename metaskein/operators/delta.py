"""What becomes of a change feed: counts, a capped preview, and grouped payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from .skew import number_in_parts, split_join, spread_join

# Order of the phases, preview marks, and attribute names in payloads.
PHASES = {"delete": 1, "add": 2, "update": 3}
MARKS = {"add": "+", "delete": "-", "update": "!"}
MORE = "and more..."
MOST_COMMON, NULL_SHARE = "Most Common Value", "Null Percentage"
DEFAULT_PREVIEW = 35
_BUCKETS = 64


def counts(feed: DataFrame) -> DataFrame:
    """Number of changes per entity kind and change type."""
    return feed.groupBy("entity", "change_type").agg(F.count("*").alias("n"))


def preview(feed: DataFrame, max_rows: int = DEFAULT_PREVIEW) -> DataFrame:
    """The first ``max_rows`` changes of each kind by name, and one line if there are more.

    A kind may hold most of the feed, so the top rows are taken per hash bucket first
    (Spark also limits each task before the shuffle) and then over the buckets' winners.
    """
    mark = F.element_at(F.create_map(*[F.lit(x) for kv in MARKS.items() for x in kv]), F.col("change_type"))
    label = F.when(F.col("entity") == "item", F.concat_ws(".", "set_nm", "name")).otherwise(F.col("name"))
    with_id = (F.col("entity") != "join") & (F.col("change_type") != "add")
    line = F.concat(mark, F.lit(" "), label,
                    F.when(with_id, F.concat(F.lit(" ("), X.or_empty("catalog_id"), F.lit(")"))).otherwise(""))
    rows = feed.select("entity", "change_type", label.alias("label"), line.alias("line"),
                       F.pmod(F.xxhash64("entity_id"), F.lit(_BUCKETS)).alias("bucket"))
    order = ("label", "line")
    per_bucket = Window.partitionBy("entity", "change_type", "bucket").orderBy(*order)
    overall = Window.partitionBy("entity", "change_type").orderBy(*order)
    # One row above the cap tells whether there is more.
    top = (
        rows.withColumn("seq", F.row_number().over(per_bucket)).where(F.col("seq") <= max_rows + 1)
        .withColumn("seq", F.row_number().over(overall)).where(F.col("seq") <= max_rows + 1)
    )
    return top.select(
        "entity", "change_type", "seq",
        F.when(F.col("seq") > max_rows, F.concat(mark, F.lit(f" {MORE}"))).otherwise(F.col("line")).alias("line"),
    )


def diff_json(feed: DataFrame, chunk: int = 1000) -> DataFrame:
    """The feed as JSON objects ``{add, delete, update}``, up to ``chunk`` changes each."""
    told = ["entity_id", "catalog_id", "schema", "set_nm", "name"]
    parts = number_in_parts(  # of the columns that the entries are made of: the entries would hold the same texts once more
        feed.select("entity", "change_type", *told), ["entity"], ["change_type", "entity_id", "catalog_id", "name"], chunk
    ).withColumn("entry", F.to_json(F.struct(*told)))
    lists = parts.groupBy("entity", "part").agg(*[
        F.array_sort(F.collect_list(F.when(F.col("change_type") == c, F.col("entry")))).alias(c)
        for c in ("add", "delete", "update")
    ])
    body = F.concat(
        F.lit('{"add":['), F.array_join("add", ","), F.lit('],"delete":['), F.array_join("delete", ","),
        F.lit('],"update":['), F.array_join("update", ","), F.lit("]}"))
    return lists.select("entity", "part", body.alias("json"))


# --- payload bodies -----------------------------------------------------------


def _filled(c: Column | str) -> Column:
    """NULL for the empty string, so that the field is left out of the JSON."""
    return F.when(F.length(X.col(c)) > 0, X.col(c))


def _name() -> Column:
    return F.struct(_filled("logical_nm").alias("logical"), F.col("physical_nm").alias("physical")).alias("name")


def _metadata(c: str, *moved: str) -> Column:
    """Metadata JSON as map<string,variant> without the fields shown as attributes."""
    return F.map_filter(F.from_json(c, "map<string,variant>"), lambda k, v: ~k.isin(*moved))


def _attributes(**entries: Column) -> Column:
    """Attribute map of the entries that have a value; NULL if none has."""
    pairs = F.array(*[F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in entries.items()])
    kept = F.filter(pairs, lambda p: p["value"].isNotNull())
    return F.when(F.size(kept) > 0, F.map_from_entries(kept))


def set_bodies(sets: DataFrame) -> DataFrame:
    """Add ``body``: name, description, metadata (with the view source), attributes."""
    source = X.blank_to_null("definition")
    own = F.coalesce(_metadata("metadata", "most_common_value", "view_source"),
                     F.from_json(F.lit("{}"), "map<string,variant>"))
    view = F.when(source.isNotNull(), F.create_map(F.lit("view_source"), source.cast("variant")))
    metadata = F.when(F.col("metadata").isNotNull() | source.isNotNull(),
                      F.when(source.isNotNull(), F.map_concat(own, view)).otherwise(
                          F.coalesce(_metadata("metadata", "most_common_value"), own)))
    return sets.withColumn("body", F.struct(
        _name(), _filled("description").alias("description"), metadata.alias("metadata"),
        _attributes(**{MOST_COMMON: F.get_json_object("metadata", "$.most_common_value")}).alias("attributes"),
    ))


def item_bodies(items: DataFrame) -> DataFrame:
    """Add ``body``: name, nullable, texts, keys, metadata and attributes of an item.

    A key without a name is left out; the most common value and the null percentage
    move from the metadata to the attributes.
    """
    share = F.get_json_object("metadata", "$.null_percentage").try_cast("double")
    keys = F.when(~X.is_blank("key_name"), F.array(
        F.struct(F.col("key_name").alias("name"), X.is_primary("key_type").alias("primary"))))
    return items.withColumn("body", F.struct(
        _name(), "nullable", _filled("description").alias("description"), _filled("type").alias("udt_type"),
        _filled("default_val").alias("default"), keys.alias("keys"),
        _metadata("metadata", "most_common_value", "null_percentage").alias("metadata"),
        _attributes(**{
            MOST_COMMON: F.get_json_object("metadata", "$.most_common_value"),
            NULL_SHARE: X.null_percentage_text(share),
        }).alias("attributes"),
        _filled("example").alias("example"),
    ))


def relationship_bodies(rels: DataFrame, pairs: DataFrame, chunk: int = 1000) -> DataFrame:
    """Relationships with ``body``; one without column pairs has none and no row.

    Sets and cardinality come from the first pair. More than ``chunk`` pairs make
    several bodies with ``part`` 0, 1, …, each pair in exactly one. Pairs of other relationships are left out before any is numbered.
    """
    order = ["position", "parent_fqdn", "child_fqdn"]
    names = rels.select(F.col("physical_nm").alias("db_relationship_id"))
    p = split_join(pairs, names, ["db_relationship_id"], "left_semi").select(
        F.col("db_relationship_id").alias("physical_nm"), *order, "cardinality",
        X.fqdn("parent_schema", "parent_set").alias("parent_set"),
        X.fqdn("child_schema", "child_set").alias("child_set"))
    lists = number_in_parts(p, ["physical_nm"], order, chunk).groupBy("physical_nm", "part").agg(
        F.array_sort(F.collect_list(F.struct(*order))).alias("pairs"),
        F.min(F.struct(*order, "parent_set", "child_set", "cardinality")).alias("h"))
    head = lists.groupBy("physical_nm").agg(F.min("h").alias("h"))  # a row for each part, where the pairs would be many
    lists = lists.drop("h")
    items = F.transform("pairs", lambda x: F.struct(x["parent_fqdn"].alias("parent"), x["child_fqdn"].alias("child")))
    upper = lambda c: F.upper(X.or_empty(c))
    return rels.join(head, "physical_nm").join(lists, "physical_nm").select(
        *rels.columns, "part",
        F.struct(
            F.col("h.parent_set").alias("parent_set"), F.col("h.child_set").alias("child_set"), _name(),
            X.cardinality_array("h.cardinality").alias("cardinality"),
            F.struct(upper("on_update").alias("on_update"), upper("on_delete").alias("on_delete"))
            .alias("referential_integrity"),
            F.upper(_filled("on_match")).alias("match_type"),
            items.alias("items"),
        ).alias("body"),
    )


# --- payloads -----------------------------------------------------------------


def set_payloads(sets: DataFrame) -> DataFrame:
    """One request per set: deletions carry the id only, the others a body.

    A new set's ``target_name`` is the name that its items' requests wait for. Deletions and updates without an id cannot be
    sent; ``unsendable_sets`` lists them.
    """
    rows = set_bodies(sets.where(~_without_id("catalog_id")).withColumn("metadata", F.lit(None).cast("string")))
    body = F.when(F.col("change_type") != "delete", F.to_json("body"))
    name = F.when(F.col("change_type") == "add", X.fqdn("schema", "physical_nm"))
    return _requests(rows, "set", F.col("catalog_id"), F.lit(0), body, name)


def item_payloads(items: DataFrame, chunk: int = 1000) -> DataFrame:
    """One deletion per item; additions and updates grouped by set, ``chunk`` items each.

    Items of a set that is itself new have no set id yet; an optional column ``new_set`` holds the set's name, which
    becomes ``target_name``, for the sender to put the id in. Items with neither cannot be sent; ``unsendable_items``
    lists them.
    """
    if "new_set" not in items.columns:
        items = items.withColumn("new_set", F.lit(None).cast("string"))
    gone = items.where((F.col("change_type") == "delete") & ~_without_id("item_id")).withColumn("new_set", F.lit(None).cast("string"))
    keys = ["change_type", "set_id", "new_set"]
    rest = item_bodies(items.where((F.col("change_type") != "delete") & ~_nowhere(items))).select(
        *keys, "physical_nm", "dataset_id", F.to_json("body").alias("json"))
    grouped = number_in_parts(rest, keys, ["physical_nm", "dataset_id"], chunk).groupBy(*keys, "part").agg(
        F.array_sort(F.collect_list(F.struct("physical_nm", "json"))).alias("all"))
    joined = F.array_join(F.transform("all", lambda x: x["json"]), ",")
    body = F.concat(F.lit('{"items":['), joined, F.lit("]}"))
    return _requests(gone, "item", F.col("item_id"), F.lit(0), F.lit(None), F.col("new_set")).unionByName(
        _requests(grouped, "item", F.col("set_id"), F.col("part"), body, F.col("new_set")))


def _nowhere(items: DataFrame) -> Column:
    """Neither a set id nor the name of a new set."""
    blank = X.is_blank("set_id")
    return blank & F.col("new_set").isNull() if "new_set" in items.columns else blank


def _without_id(column: str) -> Column:
    """A deletion or update whose target has no id."""
    return (F.col("change_type") != "add") & X.is_blank(column)


def unsendable_sets(sets: DataFrame) -> DataFrame:
    """Deletions and updates of sets without an id."""
    return sets.where(_without_id("catalog_id"))


def unsendable_items(items: DataFrame) -> DataFrame:
    """Deletions without an id, and other changes whose set has neither an id nor a name in this delta."""
    gone = F.col("change_type") == "delete"
    return items.where((gone & X.is_blank("item_id")) | (~gone & _nowhere(items)))


def unsendable_relationships(rels: DataFrame, pairs: DataFrame) -> DataFrame:
    """Changes without a request: deletions without an id, and others whose source has no column pair."""
    known = pairs.select(F.col("db_relationship_id").alias("physical_nm")).distinct()
    gone = F.col("change_type") == "delete"
    return rels.where(gone & F.col("catalog_id").isNull()).unionByName(
        rels.where(~gone).join(known, "physical_nm", "left_anti").select(*rels.columns))


def relationship_payloads(rels: DataFrame, pairs: DataFrame, chunk: int = 1000) -> DataFrame:
    """Bulk requests: lists of ids to delete, lists of bodies to add or update.

    The column pairs travel inside the bodies, which is how a changed pair is sent.
    """
    gone = rels.where((F.col("change_type") == "delete") & F.col("catalog_id").isNotNull()).select(
        "change_type", F.lit(0).cast("bigint").alias("n"), F.col("catalog_id").alias("k"),
        F.to_json(F.col("catalog_id").cast("variant")).alias("json"))
    sent = relationship_bodies(rels.where(F.col("change_type") != "delete"), pairs, chunk).select(
        "change_type", F.col("part").alias("n"), F.col("physical_nm").alias("k"), F.to_json("body").alias("json"))
    lists = number_in_parts(gone.unionByName(sent), ["change_type"], ["k", "n"], chunk).groupBy("change_type", "part").agg(
        F.array_sort(F.collect_list(F.struct("k", "n", "json"))).alias("all"))
    joined = F.array_join(F.transform("all", lambda x: x["json"]), ",")
    body = F.concat(F.lit('{"relationships":['), joined, F.lit("]}"))
    return _requests(lists, "relationship", F.lit(None), F.col("part"), body)


def _requests(
    df: DataFrame, entity: str, target: Column, part: Column, body: Column, name: Column | None = None
) -> DataFrame:
    phase = F.element_at(F.create_map(*[F.lit(x) for kv in PHASES.items() for x in kv]), F.col("change_type"))
    return df.select(
        phase.alias("phase_no"), F.col("change_type").alias("phase"), F.lit(entity).alias("entity"),
        target.cast("string").alias("target_id"), part.cast("bigint").alias("part"),
        body.cast("string").alias("body"), (F.lit(None) if name is None else name).cast("string").alias("target_name"))


def payloads(
    sets: DataFrame, items: DataFrame, relationships: DataFrame, pairs: DataFrame, chunk: int = 1000
) -> DataFrame:
    """All requests of a delta. They are to be sent by ``phase_no``, within it sets,
    items, then relationships."""
    return (
        set_payloads(sets)
        .unionByName(item_payloads(items, chunk))
        .unionByName(relationship_payloads(relationships, pairs, chunk))
    )


# --- replies ------------------------------------------------------------------


def with_request_ids(requests: DataFrame) -> DataFrame:
    """Add ``request_id``: a hash of what the request is, so that making the same delta again gives the same ids."""
    parts = ("phase", "entity", "target_id", "target_name", "part", "body")
    written = F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in parts]))
    return requests.withColumn("request_id", F.md5(written.cast("binary")))


def requests_after_replies(requests: DataFrame, replies: DataFrame) -> DataFrame:
    """What is to be sent after the receiver's replies, with the ids they brought.

    ``replies`` has ``request_id``, ``ok`` boolean and ``id``: the id that a new set was given. A request that has an accepting reply
    is done and left out; one that was refused or not answered is sent again, under the same ``request_id``. The reply to the
    request that creates a set puts its id into ``target_id`` of all requests that name the set in ``target_name`` (of several ids,
    the smallest). ``ready`` tells whether a request can be sent now: its target has an id, or it needs none.
    A set's requests may be many; they are joined so that they can be split, and those that need no id are dealt out. Replies to unknown
    requests change nothing.
    """
    numbered = with_request_ids(requests)
    accepted = replies.where("ok").groupBy("request_id").agg(F.min(X.blank_to_null("id")).alias("_id"))
    creating = (F.col("entity") == "set") & (F.col("phase") == "add")
    made = numbered.where(creating).select("request_id", F.col("target_name").alias("_made")).join(accepted, "request_id") \
        .groupBy("_made").agg(F.min("_id").alias("_id"))
    left = numbered.join(accepted.select("request_id"), "request_id", "left_anti").withColumn("_made", F.when(~creating & X.is_blank("target_id"), F.col("target_name")))
    named = spread_join(left, made.withColumnRenamed("_made", "_of"), {"_made": "_of"}, ["request_id"])
    target = F.coalesce(X.blank_to_null("target_id"), "_id")
    ready = creating | (F.col("entity") == "relationship") | target.isNotNull()
    return named.select(*[c for c in requests.columns if c != "target_id"], target.alias("target_id"), "request_id", ready.alias("ready"))
