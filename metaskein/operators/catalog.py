"""Flattening of a database's catalog tables into entities and foreign keys.

Inputs are the DataFrames of ``sources.tables.catalog_tables``. The statements are
chains of left equi-joins: small catalogs are broadcast by Spark at run time,
fleet-sized ones shuffle on the join keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from .profile import enrich_with_stats
from .skew import number_in_parts, spread_join

# Column description fields passed through, and those that hold numbers as text.
_PLAIN = ("character_maximum_length", "numeric_precision", "numeric_precision_radix", "numeric_scale")
_BIG = ("identity_increment", "identity_start", "identity_minimum", "identity_maximum",
        "datetime_precision", "interval_precision")

ENTITY_COLUMNS = (
    "schema", "schema_comment", "entity", "entity_fqdn", "name", "fqdn", "position", "type", "nullable",
    "default", "max_length", "numeric_precision", "numeric_precision_radix", "numeric_scale",
    "identity_cycle", "identity_increment", "identity_generation", "identity_start", "identity",
    "identity_minimum", "identity_maximum", "udt_type", "datetime_precision", "interval_type",
    "interval_precision", "entity_type", "view", "primary_key", "entity_comment", "comment", "key",
    "key_position", "key_type", "key_name", "definition",
)


def schema_filter(df: DataFrame, col: str, patterns: list[str] | None = None) -> DataFrame:
    """Rows of the wanted schemas; applied next to the scan, it is pushed into it."""
    return df.where(X.schema_matches(col, patterns))


def _object_comments(tables: dict[str, DataFrame]) -> DataFrame:
    """Comments on whole objects: oid -> text."""
    return tables["description"].where(F.col("objsubid") == 0).select("objoid", "description")


def _schema_comments(tables: dict[str, DataFrame]) -> DataFrame:
    d = _object_comments(tables)
    return tables["pg_namespace"].join(d, F.col("oid") == F.col("objoid")).select(
        F.col("nspname").alias("_c_schema"), F.col("description").alias("schema_comment"))


def _classes(tables: dict[str, DataFrame]) -> DataFrame:
    """Catalog objects with the name of their schema."""
    n = tables["pg_namespace"].select(F.col("oid").alias("relnamespace"), "nspname")
    return tables["pg_class"].join(n, "relnamespace")


def index_members(tables: dict[str, DataFrame]) -> DataFrame:
    """(schema, table, column, is primary) for every column of every index.

    The key array is exploded, so column lookup stays a hash join at any size.
    """
    # An index may name a column twice; membership counts once.
    member = tables["pg_index"].select(
        "indrelid", "indisprimary", F.explode(F.array_distinct("indkey")).alias("attnum"))
    attr = tables["pg_attribute"].select("attrelid", "attname", "attnum")
    cls = _classes(tables).select("oid", "relname", "nspname")
    return (
        member.join(attr, (member["indrelid"] == attr["attrelid"]) & (member["attnum"] == attr["attnum"]))
        .join(cls, F.col("indrelid") == F.col("oid"))
        .select(F.col("nspname").alias("_k_schema"), F.col("relname").alias("_k_table"),
                F.col("attname").alias("_k_column"), "indisprimary")
    )


def _column_facts() -> list[Column]:
    """Column description from ``information_schema.columns`` rows."""
    return [
        X.yes_flag("is_nullable").alias("nullable"),
        F.col("column_default").alias("default"),
        F.col("character_maximum_length").alias("max_length"),
        *_PLAIN[1:],
        X.yes_flag("identity_cycle").alias("identity_cycle"),
        F.lower("identity_generation").alias("identity_generation"),
        X.yes_flag("is_identity").alias("identity"),
        *[F.col(c).cast("bigint").alias(c) for c in _BIG],
        F.col("udt_name").alias("udt_type"),
        "interval_type",
    ]


def _with_keys_and_comments(
    columns: DataFrame, tables: dict[str, DataFrame], strict: bool
) -> DataFrame:
    """Join primary-key membership, comments and constraints onto column rows.

    Expects ``_schema``, ``_table``, ``_column`` (where the column is defined) and
    ``position``. Loose form: object comments match the table name in any schema and
    key usage matches the column name in any table of the schema, so a column may
    come out several times. Strict form: both also match schema and table.
    """
    members = index_members(tables)
    classes = _classes(tables)
    object_comment = _object_comments(tables).select(F.col("objoid").alias("_eo"),
                                                     F.col("description").alias("entity_comment"))
    named = classes.select(F.col("relname").alias("_e_table"), F.col("nspname").alias("_e_schema"),
                           F.col("oid").alias("_e_oid"))
    named = named.join(object_comment, F.col("_e_oid") == F.col("_eo"), "left").drop("_eo", "_e_oid")
    # Tables, materialized views and their like carry column comments; views do not.
    commented = classes.where(F.col("relkind").isin("r", "t", "m")).select(
        F.col("nspname").alias("_d_schema"), F.col("relname").alias("_d_table"), F.col("oid").alias("_d_oid"))
    column_comment = tables["description"].select(
        F.col("objoid").alias("_co"), F.col("objsubid").alias("_cn"), F.col("description").alias("comment"))
    usage = tables["key_column_usage"].select(
        F.col("constraint_schema").alias("_u_schema"), F.col("column_name").alias("_u_column"),
        F.col("table_name").alias("_u_table"), F.col("constraint_name").alias("_u_name"),
        F.col("ordinal_position").alias("key_position"))
    constraints = tables["table_constraints"].select(
        F.col("constraint_schema").alias("_t_schema"), F.col("constraint_name").alias("key_name"),
        F.lower("constraint_type").alias("key_type"))
    # Most columns are in no key: the constraints are looked up for the key usage, where their names are known, and not for all columns,
    # whose missing names would meet in one task.
    keys = usage.join(
        constraints, (F.col("key_name") == F.col("_u_name")) & (F.col("_t_schema") == F.col("_u_schema")), "left")

    entity_on = F.col("_e_table") == F.col("_table")
    usage_on = (F.col("_u_column") == F.col("_column")) & (F.col("_u_schema") == F.col("_schema"))
    if strict:
        entity_on = entity_on & (F.col("_e_schema") == F.col("_schema"))
        usage_on = usage_on & (F.col("_u_table") == F.col("_table"))
    described = (
        columns.join(
            members, (F.col("_k_table") == F.col("_table")) & (F.col("_k_column") == F.col("_column"))
            & (F.col("_k_schema") == F.col("_schema")), "left")
        .join(named, entity_on, "left")
        .join(commented, (F.col("_d_schema") == F.col("_schema")) & (F.col("_d_table") == F.col("_table")), "left")
    )
    described = spread_join(described, column_comment, {"_d_oid": "_co", "position": "_cn"}, ["_schema", "_table", "_column"])
    return (
        described.join(keys, usage_on, "left")
        .withColumn("primary_key", X.default_to("indisprimary", False))
        .withColumn("key", F.col("_u_column").isNotNull())
    )


def flatten_entities(
    tables: dict[str, DataFrame], patterns: list[str] | None = None, *, strict_keys: bool = False,
    ordered: bool = False,
) -> DataFrame:
    """One row per column of every table and view, with key and comment information.

    The default joins key usage by column name and schema and object comments by
    table name, as the original statement does; rows then repeat for every match, and
    on fleets where names recur often the result grows with the product of the
    matches. ``strict_keys=True`` also matches the table (and schema): one row per
    column and own constraint. Use it for anything but comparison.
    """
    t = schema_filter(tables["tables"], "table_schema", patterns)
    c = tables["columns"].select(
        F.col("table_schema").alias("_schema"), F.col("table_name").alias("_table"),
        F.col("column_name").alias("_column"), F.col("ordinal_position").alias("position"),
        F.col("data_type").alias("type"), *_column_facts())
    base = (
        t.join(c, (t["table_schema"] == F.col("_schema")) & (t["table_name"] == F.col("_table")), "left")
    )
    full = _with_keys_and_comments(base, tables, strict_keys)
    views = tables["views"].select(F.col("schemaname").alias("_v_schema"), F.col("viewname").alias("_v_name"),
                                   F.trim("definition").alias("_v_definition"))
    is_view = F.col("table_type") == "VIEW"
    rows = (
        full.join(_schema_comments(tables), F.col("_c_schema") == F.col("_schema"), "left")
        .join(views, is_view & (F.col("_v_schema") == F.col("_schema")) & (F.col("_v_name") == F.col("_table")), "left")
        .withColumns({
            "schema": F.col("_schema"), "entity": F.col("_table"), "name": F.col("_column"),
            "entity_fqdn": X.fqdn("_schema", "_table"), "fqdn": X.fqdn("_schema", "_table", "_column"),
            "entity_type": F.lower("table_type"), "view": F.coalesce(is_view, F.lit(False)),
            "definition": F.col("_v_definition"),
        })
        .select(*ENTITY_COLUMNS)
    )
    return rows.orderBy("schema", "entity", "position") if ordered else rows


# FROM schema.table, an optional AS, then something more. Fixed pattern; dot matches newline.
SOURCE_PATTERN = r"(?s)FROM (\w+)\.(\w+)(?: AS)? (.+)"


def resolve_matview_columns(
    tables: dict[str, DataFrame], patterns: list[str] | None = None, *, strict_keys: bool = False,
    ordered: bool = False,
) -> DataFrame:
    """Columns of materialized views, described by the table their definition reads from.

    The source is the first FROM of the definition that is followed by more text; a
    view whose definition has none, or whose column is not in the source, has no row.
    """
    m = schema_filter(tables["matviews"], "schemaname", patterns).select(
        "schemaname", "matviewname", "definition",
        F.regexp_extract("definition", SOURCE_PATTERN, 1).alias("_schema"),
        F.regexp_extract("definition", SOURCE_PATTERN, 2).alias("_table"),
    ).where(F.col("_schema") != "")
    c = _classes(tables).where(F.col("relkind") == "m").select(
        F.col("nspname").alias("_m_schema"), F.col("relname").alias("_m_name"), F.col("oid").alias("_m_oid"))
    a = tables["pg_attribute"].where(F.col("attnum") >= 1).select(
        F.col("attrelid").alias("_a_oid"), F.col("attname").alias("_column"), F.col("attnum").alias("position"),
        F.col("atttype").alias("type"))
    source = tables["columns"].select(
        F.col("table_schema").alias("_s_schema"), F.col("table_name").alias("_s_table"),
        F.col("column_name").alias("_s_column"), *_column_facts())
    base = (
        m.join(c, (F.col("_m_schema") == F.col("schemaname")) & (F.col("_m_name") == F.col("matviewname")))
        .join(a, F.col("_a_oid") == F.col("_m_oid"))
        .join(source, (F.col("_s_column") == F.col("_column")) & (F.col("_s_schema") == F.col("_schema"))
              & (F.col("_s_table") == F.col("_table")))
    )
    full = _with_keys_and_comments(base, tables, strict_keys)
    rows = (
        full.join(_schema_comments(tables), F.col("_c_schema") == F.col("schemaname"), "left")
        .withColumns({
            "schema": F.col("schemaname"), "entity": F.col("matviewname"), "name": F.col("_column"),
            "entity_fqdn": X.fqdn("schemaname", "matviewname"),
            "fqdn": X.fqdn("schemaname", "matviewname", "_column"),
            "entity_type": F.lit("materialized view"), "view": F.lit(True),
        })
        .select(*ENTITY_COLUMNS, F.col("_schema").alias("source_schema"), F.col("_table").alias("source_entity"))
    )
    return rows.orderBy("source_schema", "source_entity", "position") if ordered else rows


def classify_entities(entities: DataFrame) -> DataFrame:
    """Add ``set_type`` to entity rows; the definition is NULL when blank."""
    other = F.when(F.col("entity_type") == "base table", "TABLE").otherwise(F.upper(X.or_empty("entity_type")))
    kind = F.when(
        F.coalesce("view", F.lit(False)),
        F.when(F.col("entity_type") == "materialized view", "MATERIALIZED VIEW").otherwise("VIEW"),
    ).otherwise(other)
    definition = X.blank_to_null("definition")
    return entities.withColumn(
        "set_type", F.when((kind == "") & definition.isNotNull(), "VIEW").otherwise(kind)
    ).withColumn("definition", definition)


def entity_items(entities: DataFrame) -> DataFrame:
    """Item rows (one per entity row) with the defaults of missing catalog values.

    Default 'NULL', identity false, nullable true. The key of a row is the struct
    ``key`` (name, type without ' key', items), NULL when the column is in no key.
    """
    kind = F.when(X.default_to("primary_key", False), "primary").otherwise(
        F.replace(X.default_to("key_type", "foreign"), F.lit(" key"), F.lit("")))
    return entities.select(
        "schema",
        F.col("entity").alias("dataset_id"),
        F.col("name").alias("physical_nm"),
        X.or_empty("fqdn").alias("fqdn"),
        X.or_empty("comment").alias("description"),
        X.or_empty("udt_type").alias("type"),
        X.default_to("identity", False).alias("identity"),
        X.default_to("default", "NULL").alias("default_val"),
        X.default_to("nullable", True).alias("nullable"),
        F.when(F.col("key"), F.struct(
            X.or_empty("key_name").alias("name"), kind.alias("type"), F.array("fqdn").alias("items"),
        )).alias("key"),
    )


def entity_sets(entities: DataFrame) -> DataFrame:
    """One row per set out of entity rows: type, definition and comments."""
    first = lambda c: F.min(c).alias(c)
    return classify_entities(entities).groupBy("schema", F.col("entity").alias("physical_nm")).agg(
        F.min("set_type").alias("type"), first("definition"), first("schema_comment"),
        F.min("entity_comment").alias("description"),
    ).withColumn("logical_nm", F.col("physical_nm"))


def item_snapshot(items: DataFrame, stats: DataFrame | None = None) -> DataFrame:
    """Snapshot columns of items out of ``entity_items`` rows, one row per item.

    Repeated rows of a column differ only in their key: the first primary key by name
    counts. Statistics, if given, fill the example and the metadata.
    """
    primary = F.when(X.is_primary("key.type"), F.col("key.name"))
    rest = ("description", "type", "default_val", "nullable")
    one = items.where(F.col("physical_nm").isNotNull()).groupBy("schema", "dataset_id", "physical_nm").agg(
        F.min(primary).alias("key_nm"), *[F.min(c).alias(c) for c in rest])
    shaped = one.select(
        "schema", "dataset_id", "physical_nm", F.lit("").alias("logical_nm"), *rest,
        F.col("key_nm").isNotNull().alias("is_pk"), X.or_empty("key_nm").alias("key_nm"), F.lit("").alias("example"))
    if stats is None:
        return shaped.withColumn("metadata", F.lit(None).cast("string"))
    measured = F.when(F.col("null_percentage").isNotNull() | F.col("most_common_value").isNotNull(),
                      F.to_json(F.struct("most_common_value", "null_percentage")))
    return enrich_with_stats(shaped, stats).withColumn("metadata", measured).drop("most_common_value", "null_percentage")


def snapshot_pairs(fk: DataFrame) -> DataFrame:
    """Column pairs of foreign-key rows, owned by the parent set, in snapshot form."""
    return fk.select(
        F.col("name").alias("physical_nm"), F.col("source_field_entity").alias("dataset_id"),
        F.lit("").alias("logical_nm"), "type", "comment", "on_update", "on_delete", "on_match",
        F.col("source_fqdn").alias("parent_fqdn"), F.col("foreign_fqdn").alias("child_fqdn"),
        F.col("key_number").alias("position"), F.lit(X.DEFAULT_CARDINALITY).alias("cardinality"))


def resolve_foreign_keys(
    tables: dict[str, DataFrame], patterns: list[str] | None = None, *, ordered: bool = False
) -> DataFrame:
    """One row per column pair of every complete foreign key.

    Composite keys pair by position. Only a column of a foreign-key constraint that
    finds its referenced column stays, so the joins that decide this are inner.
    """
    usage = tables["key_column_usage"]
    constraints = tables["table_constraints"]
    foreign = constraints.where(F.col("constraint_type") == "FOREIGN KEY").select(
        "constraint_schema", "constraint_name")
    kcu = usage.join(foreign, ["constraint_schema", "constraint_name"]).select(
        F.col("constraint_schema").alias("_c_schema"), F.col("constraint_name").alias("name"),
        F.col("table_schema").alias("_schema"), F.col("table_name").alias("_table"),
        F.col("column_name").alias("_column"), F.col("ordinal_position").alias("key_number"),
        "position_in_unique_constraint")
    col = schema_filter(tables["columns"], "table_schema", patterns).select(
        F.col("table_schema").alias("foreign_field_schema"), F.col("table_name").alias("foreign_field_entity"),
        F.col("column_name").alias("foreign_field_name"), F.col("ordinal_position").alias("col_id"))
    rco = tables["referential_constraints"].select(
        F.col("constraint_schema").alias("_r_schema"), F.col("constraint_name").alias("_r_name"),
        "unique_constraint_schema", "unique_constraint_name", F.lower("match_option").alias("on_match"),
        F.lower("update_rule").alias("on_update"), F.lower("delete_rule").alias("on_delete"))
    rel = usage.where(F.col("column_name").isNotNull()).select(
        F.col("constraint_schema").alias("_p_schema"), F.col("constraint_name").alias("_p_name"),
        F.col("ordinal_position").alias("_p_position"), F.col("table_schema").alias("source_field_schema"),
        F.col("table_name").alias("source_field_entity"), F.col("column_name").alias("source_field_name"))
    tco = constraints.select(F.col("constraint_schema").alias("_t_schema"),
                             F.col("constraint_name").alias("_t_name"), F.lower("constraint_type").alias("type"))
    # Comment of the constraint: its index by name, the table of that index, then the constraint there.
    index = tables["pg_class"].select(F.col("relname").alias("_x_name"), F.col("oid").alias("_x_oid"))
    stat = tables["pg_stat_all_indexes"].select("indexrelid", "relid")
    constraint = tables["pg_constraint"].select(F.col("oid").alias("_k_oid"), F.col("conname").alias("_k_name"),
                                                "conrelid")
    described = tables["description"].select("objoid", F.col("description").alias("comment"))
    # Found by name for all indexes, in narrow rows, and not for each key: keys without a comment would meet in one task.
    comments = (
        index.where(F.col("_x_name").isNotNull()).join(stat, F.col("indexrelid") == F.col("_x_oid"), "left")
        .join(constraint.join(described, F.col("objoid") == F.col("_k_oid"), "left"),
              (F.col("conrelid") == F.col("relid")) & (F.col("_k_name") == F.col("_x_name")), "left")
        .select("_x_name", "comment").distinct()
    )
    rows = (
        kcu.where(F.col("name").isNotNull())
        .join(col, (F.col("foreign_field_schema") == F.col("_schema"))
              & (F.col("foreign_field_entity") == F.col("_table"))
              & (F.col("foreign_field_name") == F.col("_column")))
        .join(rco, (F.col("_r_name") == F.col("name")) & (F.col("_r_schema") == F.col("_schema")))
        .join(rel, (F.col("_p_name") == F.col("unique_constraint_name"))
              & (F.col("_p_schema") == F.col("unique_constraint_schema"))
              & (F.col("_p_position") == F.col("position_in_unique_constraint")))
        .join(tco, (F.col("_t_schema") == F.col("_c_schema")) & (F.col("_t_name") == F.col("name")), "left")
        .join(comments, F.col("_x_name") == F.col("_r_name"), "left")
        .select(
            "comment",
            X.fqdn_strict("foreign_field_schema", "foreign_field_entity", "foreign_field_name").alias("foreign_fqdn"),
            "foreign_field_schema", "foreign_field_entity", "foreign_field_name", "col_id",
            X.fqdn_strict("source_field_schema", "source_field_entity", "source_field_name").alias("source_fqdn"),
            "source_field_schema", "source_field_entity", "source_field_name",
            "key_number", "name", "on_match", "on_update", "on_delete", "type",
        )
        .distinct()
    )
    return rows.orderBy("foreign_field_schema", "foreign_field_entity", "col_id") if ordered else rows


def relationship_pairs(fk: DataFrame, source: str | None = None) -> DataFrame:
    """Distinct (name, position, parent, child) of foreign-key rows.

    With ``source`` sets are written ``schema.source:table``.
    """
    mark = F.lit(f"{source}:" if source else "")

    def set_name(kind: str) -> Column:
        return F.concat(F.col(f"{kind}_field_schema"), F.lit("."), mark, F.col(f"{kind}_field_entity"))

    named = fk.select(
        "name", "key_number", "col_id", F.upper("on_update").alias("on_update"),
        F.upper("on_delete").alias("on_delete"), set_name("source").alias("parent_set"),
        set_name("foreign").alias("child_set"),
        X.fqdn_strict(set_name("source"), "source_field_name").alias("parent"),
        X.fqdn_strict(set_name("foreign"), "foreign_field_name").alias("child"),
    )
    pairs = named.groupBy("name", "parent", "child").agg(
        F.min(F.struct("key_number", "col_id", "parent_set", "child_set", "on_update", "on_delete")).alias("f"))
    return pairs.select("name", "parent", "child", "f.*")


def relationship_documents(fk: DataFrame, source: str | None = None, chunk: int = 1000) -> DataFrame:
    """Relationship documents: one per name, its column pairs in key order.

    A relationship with more than ``chunk`` rows' worth of pairs comes as several
    documents with the same head and ``part`` 0, 1, …; each pair is in exactly one.
    """
    pairs = relationship_pairs(fk, source)
    head = pairs.groupBy("name").agg(
        F.min(F.struct("key_number", "child", "parent", "parent_set", "child_set", "on_update",
                       "on_delete")).alias("h"))
    numbered = number_in_parts(pairs, ["name"], ["key_number", "parent", "child"], chunk)
    bodies = numbered.groupBy("name", "part").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("key_number", "parent", "child"))),
                    lambda p: F.struct(p["parent"].alias("parent"), p["child"].alias("child"))).alias("items"))
    return bodies.join(head, "name").select(
        F.col("name").alias("physical_nm"), F.col("name").alias("logical_nm"), "part",
        F.col("h.parent_set").alias("parent_set"), F.col("h.child_set").alias("child_set"),
        F.col("h.on_update").alias("on_update"), F.col("h.on_delete").alias("on_delete"), "items",
    )
