"""Remote-catalog JSON documents, one per row, flattened to snapshot rows.

A document that is not valid JSON yields no rows here; ``malformed_documents``
lists those, so none is lost unnoticed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from . import schemas


def _elements(df: DataFrame, json_col: str, ddl: str, array: str, *keep: Column) -> DataFrame:
    """One row per element of a top-level array of the parsed document, as column ``e``.

    The outer explode keeps the parser from running again: for a plain explode Spark
    infers filters on the array, each of which would parse the text once more.

    The text passes an explode of its own first: Spark compiles no expression that from_json reads, so a text that is made by an
    expression would be made step by step.
    """
    text = df.select(F.explode_outer(F.array(json_col)).alias("text"))
    doc = text.select(F.from_json("text", ddl).alias("doc"))
    return doc.select(*keep, F.explode_outer(f"doc.{array}").alias("e")).where(F.col("e").isNotNull())


def malformed_documents(df: DataFrame, json_col: str) -> DataFrame:
    """Rows whose document is not a JSON object."""
    return df.where(F.col(json_col).isNotNull() & F.json_object_keys(json_col).isNull())


def parse_catalog_sets(df: DataFrame, json_col: str) -> DataFrame:
    """One row per set. The definition text gives way to ``metadata.view_source``."""
    one = _elements(
        df, json_col, schemas.SETS_JSON, "sets", F.col("doc.name.physical").alias("schema"),
        F.col("doc.description").alias("schema_comment"),
    ).withColumnRenamed("e", "s")
    view_source = F.get_json_object("s.metadata", "$.view_source")
    return one.select(
        "schema",
        "schema_comment",
        F.col("s.id").alias("id"),
        F.col("s.name.physical").alias("physical_nm"),
        F.col("s.name.logical").alias("logical_nm"),
        F.col("s.description").alias("description"),
        F.col("s.stub").alias("fqdn"),
        F.coalesce(view_source, X.blank_to_null("s.definition"), F.lit("")).alias("definition"),
        F.col("s.metadata").alias("metadata"),
    )


def _keys(raw: Column, item_name: Column) -> Column:
    """Keys of an item from JSON that holds either one object or an array of them."""
    ddl = f"array<{schemas.KEY_JSON}>"
    as_array = F.when(F.ltrim(raw).startswith("["), raw).otherwise(
        F.concat(F.lit("["), raw, F.lit("]"))
    )
    declared = F.filter(F.from_json(as_array, ddl), lambda k: k["is_key"])
    return F.transform(
        F.coalesce(declared, F.from_json(F.lit("[]"), ddl)),
        lambda k: F.struct(
            k["name"].alias("name"),
            F.when(k["primary"], "primary").otherwise("foreign").alias("type"),
            F.array(item_name).alias("items"),
        ),
    )


def parse_catalog_items(df: DataFrame, json_col: str) -> DataFrame:
    """One row per item with ``keys`` as array<struct<name,type,items>>."""
    one = (
        _elements(df, json_col, schemas.ITEMS_JSON, "sets")
        .select(F.col("e.name.physical").alias("dataset_id"), F.explode_outer("e.items").alias("i"))
        .where(F.col("i").isNotNull())
    )
    return one.select(
        "dataset_id",
        F.col("i.id").alias("id"),
        F.col("i.name.physical").alias("physical_nm"),
        F.col("i.name.logical").alias("logical_nm"),
        F.col("i.description").alias("description"),
        F.col("i.type").alias("type"),
        F.col("i.nullable").alias("nullable"),
        F.col("i.stub").alias("fqdn"),
        F.col("i.default").alias("default_val"),
        F.col("i.example").alias("example"),
        F.col("i.metadata").alias("metadata"),
        _keys(F.col("i.key"), F.col("i.name.physical")).alias("keys"),
    )


def parse_catalog_relationships(df: DataFrame, json_col: str) -> DataFrame:
    """One row per column pair of each relationship whose first item has a parent.

    ``position`` is the pair's place in the document, counted from 1.
    """
    rel = (
        _elements(df, json_col, schemas.RELATIONSHIPS_JSON, "relationships")
        .withColumnRenamed("e", "r")
        .where(F.get("r.items", F.lit(0))["parent"].isNotNull())
        .select("r", F.get("r.items", F.lit(0))["parent"]["set"]["name"]["physical"].alias("owner"),
                F.posexplode("r.items").alias("at", "pair"))
    )

    def endpoint(side: str) -> list[Column]:
        p = f"pair.{side}"
        return [
            F.col(f"{p}.set.source.stub").alias(f"{side}_schema"),
            F.col(f"{p}.set.name.physical").alias(f"{side}_set"),
            F.col(f"{p}.name.physical").alias(f"{side}_item"),
            F.col(f"{p}.stub").alias(f"{side}_fqdn"),
        ]

    return rel.select(
        F.col("r.id").alias("id"),
        F.col("r.name.physical").alias("physical_nm"),
        F.col("r.name.logical").alias("logical_nm"),
        F.col("owner").alias("dataset_id"),
        F.col("r.description").alias("comment"),
        F.col("r.referential_integrity.on_update").alias("on_update"),
        F.col("r.referential_integrity.on_delete").alias("on_delete"),
        F.col("r.match_type").alias("on_match"),
        *endpoint("parent"),
        *endpoint("child"),
        (F.col("at") + 1).alias("position"),
        X.cardinality_text("r.cardinality.raw").alias("cardinality"),
    )
