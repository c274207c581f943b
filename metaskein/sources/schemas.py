"""Fixed schemas of the four snapshot tables and their keys."""

from __future__ import annotations

from pyspark.sql import types as T

S, B, I = T.StringType(), T.BooleanType(), T.IntegerType()


def _schema(**fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields.items()])


DATASET = _schema(physical_nm=S, logical_nm=S, schema=S, description=S, type=S, definition=S)
DATAITEM = _schema(
    dataset_id=S, physical_nm=S, logical_nm=S, type=S, description=S, is_pk=B, key_nm=S,
    nullable=B, example=S, default_val=S, metadata=S,
)
RELATIONSHIP = _schema(
    physical_nm=S, dataset_id=S, logical_nm=S, type=S, comment=S, on_update=S, on_delete=S,
    on_match=S,
)
JOIN = _schema(db_relationship_id=S, parent_fqdn=S, child_fqdn=S, position=I, cardinality=S)

KEYS = {
    "dataset": ["physical_nm"],
    "dataitem": ["dataset_id", "physical_nm"],
    "relationship": ["physical_nm"],
    "join": ["db_relationship_id", "parent_fqdn", "child_fqdn"],
}
_BASE = {"dataset": DATASET, "dataitem": DATAITEM, "relationship": RELATIONSHIP, "join": JOIN}
TABLES = tuple(_BASE)

# Sides of a snapshot pair: the source of truth and the remote catalog.
SIDES = {"source": "db_", "catalog": "dh_"}


def side_prefix(side: str) -> str:
    """Table prefix of a side; the name is trimmed and case does not matter."""
    try:
        return SIDES[side.strip().lower()]
    except KeyError:
        raise ValueError(f"unknown snapshot side {side!r}: use 'source' or 'catalog'") from None


def snapshot_schema(table: str, side: str) -> T.StructType:
    """Schema of a snapshot table; the catalog side also carries the catalog's id."""
    base = _BASE[table]
    if side_prefix(side) == "dh_" and table != "join":
        return T.StructType(base.fields + [T.StructField("id", S, True)])
    return base


# Nested JSON of the remote catalog. ``metadata`` and ``key`` stay raw JSON text:
# the first is free-form, the second holds an object or an array of objects.
NAME = "name struct<logical:string,physical:string>"
SETS_JSON = (
    f"id string, {NAME}, description string, metadata string, "
    f"sets array<struct<id:string,{NAME.replace(' ', ':', 1)},description:string,stub:string,"
    "definition:string,metadata:string>>"
)
ITEMS_JSON = (
    f"sets array<struct<{NAME.replace(' ', ':', 1)},items:array<struct<id:string,"
    f"{NAME.replace(' ', ':', 1)},description:string,type:string,nullable:boolean,stub:string,"
    "default:string,example:string,metadata:string,key:string>>>>"
)
KEY_JSON = "struct<is_key:boolean,primary:boolean,name:string>"
_ENDPOINT = (
    f"struct<stub:string,{NAME.replace(' ', ':', 1)},"
    f"set:struct<{NAME.replace(' ', ':', 1)},source:struct<stub:string>>>"
)
RELATIONSHIPS_JSON = (
    f"relationships array<struct<id:string,{NAME.replace(' ', ':', 1)},description:string,"
    "match_type:string,referential_integrity:struct<on_update:string,on_delete:string>,"
    "cardinality:struct<raw:array<double>>,"
    f"items:array<struct<parent:{_ENDPOINT},child:{_ENDPOINT}>>>>"
)
