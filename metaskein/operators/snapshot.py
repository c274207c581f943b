"""Snapshot tables: shaping rows, keyed upsert, reset and SQL access."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..sources import schemas


def latest_rows(
    df: DataFrame, keys: list[str], order_by: list[str], columns: list[str] | None = None
) -> DataFrame:
    """The last row of every key in ``order_by`` order (NULLs first).

    Spark applies the rank limit in every task before the shuffle, so a key repeated
    in a third of all rows sends one row per task. Ties must be equal rows.
    """
    last = Window.partitionBy(*keys).orderBy(*[F.desc_nulls_last(c) for c in order_by])
    return (
        df.withColumn("_rank", F.row_number().over(last)).where(F.col("_rank") == 1).select(*(columns or df.columns))
    )


def upsert(
    existing: DataFrame | None, incoming: DataFrame, keys: list[str], order_by: list[str]
) -> DataFrame:
    """Insert-or-replace by key; within ``incoming`` the last row in order wins.

    ``existing`` must be unique on ``keys`` (as every result of this function is).
    Columns of ``incoming`` that ``existing`` lacks serve for ordering only.
    """
    new = latest_rows(incoming, keys, order_by, existing.columns if existing is not None else None)
    if existing is None:
        return new
    kept = existing.join(new.select(*keys), keys, "left_anti").select(*existing.columns)
    return kept.unionByName(new)


def reset(df: DataFrame) -> DataFrame:
    """Empty table of the same schema, to be written as the next version."""
    return df.sparkSession.createDataFrame([], df.schema)


# --- rows of the four tables from entities ---------------------------------


def dataset_rows(sets: DataFrame, side: str) -> DataFrame:
    """Snapshot rows of sets; missing text is stored as the empty string."""
    fields = schemas.snapshot_schema("dataset", side).fieldNames()
    return sets.select(*[X.or_empty(f).alias(f) for f in fields])


def dataitem_rows(items: DataFrame, side: str) -> DataFrame:
    """Snapshot rows of items. ``keys`` (array<struct<name,type,…>>) gives is_pk and key_nm;
    ``metadata`` is JSON text or NULL."""
    fields = schemas.snapshot_schema("dataitem", side).fieldNames()
    primary = X.primary_key_of("keys")
    made = {
        "is_pk": primary.isNotNull(),
        "key_nm": X.or_empty(primary["name"]),
        "nullable": X.default_to("nullable", False),
        "metadata": F.col("metadata"),
    }
    return items.select(*[(made[f] if f in made else X.or_empty(f)).alias(f) for f in fields])


def relationship_rows(pairs: DataFrame, side: str) -> DataFrame:
    """One snapshot row per relationship out of its column pairs; one without pairs has none."""
    fields = schemas.snapshot_schema("relationship", side).fieldNames()
    rest = [f for f in fields if f != "physical_nm"]
    picked = pairs.groupBy("physical_nm").agg(
        F.min_by(F.struct(*[X.or_empty(f).alias(f) for f in rest]), F.struct("position", "parent_fqdn",
                 "child_fqdn")).alias("r")
    )
    return picked.select(*[F.col(f) if f == "physical_nm" else F.col(f"r.{f}").alias(f) for f in fields])


def join_rows(pairs: DataFrame) -> DataFrame:
    """One snapshot row per column pair; a missing position is 0."""
    return pairs.select(
        F.col("physical_nm").alias("db_relationship_id"),
        "parent_fqdn",
        "child_fqdn",
        X.default_to("position", 0).cast("int").alias("position"),
        X.or_empty("cardinality").alias("cardinality"),
    )


# --- SQL over snapshots -----------------------------------------------------


def register(spark: SparkSession, tables: dict[str, DataFrame]) -> None:
    """Make the tables visible to ``spark.sql`` under their names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def query(spark: SparkSession, statement: str, tables: dict[str, DataFrame] | None = None) -> DataFrame:
    """Run a SELECT over the snapshot tables; columns are those of the statement."""
    register(spark, tables or {})
    return spark.sql(statement)


def lookup_sets(sets: DataFrame, names: DataFrame, name_col: str = "name") -> DataFrame:
    """Sets whose normalized name equals a wanted one; a wanted name may occur often."""
    wanted = names.select(X.norm(name_col).alias("_nm")).distinct()
    return sets.withColumn("_nm", X.norm("physical_nm")).join(wanted, "_nm", "left_semi").drop("_nm")
