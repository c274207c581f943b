"""Scans of the database's own catalog tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

CATALOG_TABLES = (
    "tables", "columns", "pg_class", "pg_namespace", "pg_attribute", "pg_index", "description",
    "key_column_usage", "table_constraints", "referential_constraints", "pg_constraint",
    "pg_stat_all_indexes", "views", "matviews", "stats",
)


def catalog_tables(
    spark: SparkSession,
    source: str | Callable[[str], DataFrame],
    names: Iterable[str] = CATALOG_TABLES,
) -> dict[str, DataFrame]:
    """Lazy scans by table name.

    ``source`` is a folder with one Parquet dataset per table, or a function from
    table name to DataFrame (for example ``jdbc_scan``). Nothing is read here.
    """
    read = source if callable(source) else lambda n: spark.read.parquet(f"{source}/{n}.parquet")
    return {n: read(n) for n in names}


# --- JDBC ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Statement:
    """How a catalog table is read from the database: relation, columns, the column with the schema's name, what parts its rows."""

    relation: str
    columns: tuple[str, ...]
    schema: str | None = None
    #: A whole number that differs between rows, or a text column, whose hash is used.
    parted_by: str = ""
    is_text: bool = False


# PostgreSQL's catalog relations and the columns that the operators read of them. Object ids become bigint, since they
# are unsigned; vectors and anyarray become arrays that JDBC can carry.
_ISO, _NAME = "information_schema", "table_name"
STATEMENTS = {
    "tables": Statement(f"{_ISO}.tables", ("table_schema", "table_name", "table_type"), "table_schema", _NAME, True),
    "columns": Statement(f"{_ISO}.columns", (
        "table_schema", "table_name", "column_name", "ordinal_position", "data_type", "is_nullable", "column_default", "udt_name",
        "character_maximum_length", "numeric_precision", "numeric_precision_radix", "numeric_scale", "identity_cycle", "identity_increment",
        "identity_generation", "identity_start", "is_identity", "identity_minimum", "identity_maximum", "datetime_precision", "interval_type",
        "interval_precision"), "table_schema", _NAME, True),
    "pg_class": Statement("pg_catalog.pg_class", ("oid::bigint AS oid", "relname", "relnamespace::bigint AS relnamespace", "relkind::text AS relkind"), None, "oid::bigint"),
    "pg_namespace": Statement("pg_catalog.pg_namespace", ("oid::bigint AS oid", "nspname")),
    "pg_attribute": Statement("pg_catalog.pg_attribute", ("attrelid::bigint AS attrelid", "attname", "attnum::int AS attnum", "format_type(atttypid, atttypmod) AS atttype"),
                              None, "attrelid::bigint"),
    "pg_index": Statement("pg_catalog.pg_index", ("indrelid::bigint AS indrelid", "indisprimary", "indkey::int2[]::int4[] AS indkey"), None, "indrelid::bigint"),
    "description": Statement("pg_catalog.pg_description", ("objoid::bigint AS objoid", "objsubid", "description"), None, "objoid::bigint"),
    "key_column_usage": Statement(f"{_ISO}.key_column_usage", ("constraint_schema", "constraint_name", "table_schema", "table_name", "column_name", "ordinal_position",
                                                               "position_in_unique_constraint"), None, _NAME, True),
    "table_constraints": Statement(f"{_ISO}.table_constraints", ("constraint_schema", "constraint_name", "constraint_type"), None, "constraint_name", True),
    "referential_constraints": Statement(f"{_ISO}.referential_constraints", ("constraint_schema", "constraint_name", "unique_constraint_schema", "unique_constraint_name",
                                                                             "match_option", "update_rule", "delete_rule"), None, "constraint_name", True),
    "pg_constraint": Statement("pg_catalog.pg_constraint", ("oid::bigint AS oid", "conname", "conrelid::bigint AS conrelid"), None, "oid::bigint"),
    "pg_stat_all_indexes": Statement("pg_catalog.pg_stat_all_indexes", ("indexrelid::bigint AS indexrelid", "relid::bigint AS relid"), None, "indexrelid::bigint"),
    "views": Statement("pg_catalog.pg_views", ("schemaname", "viewname", "definition"), "schemaname", "viewname", True),
    "matviews": Statement("pg_catalog.pg_matviews", ("schemaname", "matviewname", "definition"), "schemaname", "matviewname", True),
    "stats": Statement("pg_catalog.pg_stats", ("schemaname", "tablename", "attname", "null_frac::float8 AS null_frac", "most_common_vals::text::varchar[] AS most_common_vals"),
                       "schemaname", "tablename", True),
}
SYSTEM_SCHEMAS = ("pg_catalog", "information_schema")


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def schema_predicate(column: str, patterns: list[str] | None) -> str:
    """The schema filter as SQL: any of the patterns (``*`` for any text), without patterns all but the system's schemas."""
    if not patterns:
        return f"{column} NOT IN ({', '.join(map(_quoted, SYSTEM_SCHEMAS))})"
    return "(" + " OR ".join(f"{column} LIKE {_quoted(p.replace('*', '%'))}" for p in patterns) + ")"


def jdbc_statement(name: str, patterns: list[str] | None = None) -> str:
    """The one statement that reads a catalog table: only the columns that are used, only the schemas that are wanted.

    Tables that foreign keys and comments are looked up in hold other schemas' rows too and are not restricted.
    """
    s = STATEMENTS[name]
    where = f" WHERE {schema_predicate(s.schema, patterns)}" if s.schema else ""
    part = f", {_part_of(s)} AS _part" if s.parted_by else ""
    return f"SELECT {', '.join(s.columns)}{part} FROM {s.relation}{where}"


#: Values of the column that parts a table's rows; a scan's tasks share them.
PARTS = 1024


def _part_of(s: Statement) -> str:
    number = f"hashtext({s.parted_by}::text)::bigint" if s.is_text else s.parted_by
    return f"mod(abs({number}), {PARTS})::int"


def jdbc_options(name: str, patterns: list[str] | None = None, partitions: int = 1) -> dict[str, str]:
    """Options of Spark's JDBC source that read a catalog table in ``partitions`` tasks."""
    statement = jdbc_statement(name, patterns)
    options = {"dbtable": f"({statement}) {name}", "pushDownPredicate": "true"}
    if partitions > 1 and STATEMENTS[name].parted_by:
        options |= {"partitionColumn": "_part", "lowerBound": "0", "upperBound": str(PARTS), "numPartitions": str(min(partitions, PARTS))}
    return options


def jdbc_scan(spark: SparkSession, patterns: list[str] | None = None, *, partitions: int = 1, **options) -> Callable[[str], DataFrame]:
    """Reader for ``catalog_tables`` over JDBC; further ``options`` (url, user, fetchsize) are those of Spark's source.

    A large catalog is read by several tasks, each with its share of the tables or objects. Columns and filters that
    operators use are pushed into the statement by Spark.
    """
    def read(name: str) -> DataFrame:
        return spark.read.format("jdbc").options(**options, **jdbc_options(name, patterns, partitions)).load().drop("_part")
    return read
