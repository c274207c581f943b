"""Versioned Parquet storage with a commit record.

A version consists of parts (the two sides of a snapshot, its changes, its requests). A part's tables are written first, its record
last, and readers take only what a record names. So a job that is lost between two tables leaves nothing that looks whole, the
part is written again by a rerun, and the version before it stays the one that readers see. What a record names is never written over.

Snapshot tables are bucketed and sorted on their entity key. Two sides with equally many buckets are joined on that key,
and grouped or deduplicated by it, without a shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import snapshot as N
from . import schemas

RECORD = "name string, path string, ddl string, keys array<string>, buckets int, written timestamp"


# --- commit records ---------------------------------------------------------------


def committed(spark: SparkSession, root: str) -> DataFrame:
    """All records: (version, part) and the tables they name, with path below ``root``, columns, keys, buckets and time."""
    schema = T._parse_datatype_string(f"{RECORD}, version string, part string")
    try:
        return spark.read.schema(schema).json(f"{root}/commits")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def is_committed(spark: SparkSession, root: str, version: str, part: str) -> bool:
    return not committed(spark, root).where((F.col("version") == version) & (F.col("part") == part)).isEmpty()


def latest_version(spark: SparkSession, root: str, part: str) -> str | None:
    """The version of this part that was committed last; None if there is none."""
    last = committed(spark, root).where(F.col("part") == part).groupBy("version").agg(F.max("written").alias("at"))
    found = last.orderBy(F.desc("at"), F.desc("version")).limit(1).collect()
    return found[0].version if found else None


def commit(spark: SparkSession, root: str, version: str, part: str, entries: list[tuple]) -> None:
    """Write the record of a part whose data is complete. It is one file, which appears whole or not at all."""
    rows = spark.createDataFrame(entries, "name string, path string, ddl string, keys array<string>, buckets int")
    rows.withColumn("written", F.current_timestamp()).coalesce(1).write.mode("overwrite").json(f"{root}/commits/version={version}/part={part}")


# --- parts ------------------------------------------------------------------------


def write_part(
    tables: dict[str, DataFrame | Callable[[str], None]], root: str, version: str, part: str, folder: str, *,
    spark: SparkSession, keys: dict[str, list[str]] | None = None, buckets: int | None = None,
) -> None:
    """Write the tables below ``root/folder`` and then the part's record.

    A table is a DataFrame, or a function that writes its files to a path. Those with ``keys`` are bucketed. What an
    interrupted attempt left behind is written over; a committed part is an error. One writer at a time for a version.
    """
    if is_committed(spark, root, version, part):
        raise FileExistsError(f"{part} of version {version} is committed and is not written again")
    entries = []
    for name, table in tables.items():
        path = f"{folder}/{name}" if name else folder
        if callable(table) and not isinstance(table, DataFrame):
            table(f"{root}/{path}")
            entries.append((name, path, None, None, None))
            continue
        by = (keys or {}).get(name)
        n = (buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))) if by else None
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema.fields)
        if by:
            _write_bucketed(table, f"{root}/{path}", by, n)
        else:
            table.write.mode("overwrite").parquet(f"{root}/{path}")
        entries.append((name, path, ddl, by, n))
    commit(spark, root, version, part, entries)


def read_part(spark: SparkSession, root: str, version: str, part: str) -> dict[str, DataFrame]:
    """The tables of a committed part, with the columns of its record (no inference)."""
    entries = committed(spark, root).where((F.col("version") == version) & (F.col("part") == part) & F.col("ddl").isNotNull()).collect()
    if not entries and not is_committed(spark, root, version, part):
        raise FileNotFoundError(f"{part} of version {version} is not committed below {root}")
    return {e.name: _read_bucketed(spark, f"{root}/{e.path}", e.ddl, e["keys"], e.buckets) if e.buckets
            else spark.read.schema(e.ddl).parquet(f"{root}/{e.path}") for e in entries}


def part_once(
    make: Callable[[], dict[str, DataFrame | Callable[[str], None]]], root: str, version: str, part: str, folder: str, *,
    spark: SparkSession, keys: dict[str, list[str]] | None = None, buckets: int | None = None,
) -> dict[str, DataFrame]:
    """The tables of a part: read if it is committed, else made and written first."""
    if not is_committed(spark, root, version, part):
        write_part(make(), root, version, part, folder, spark=spark, keys=keys, buckets=buckets)
    return read_part(spark, root, version, part)


def _table_name(path: str, buckets: int) -> str:
    return f"metaskein_{hashlib.md5(f'{path}|{buckets}'.encode()).hexdigest()}"


def _write_bucketed(df: DataFrame, path: str, keys: list[str], buckets: int) -> None:
    """One file a bucket, sorted; the session's catalog is only a way to say so and forgets the table at once."""
    spark, name = df.sparkSession, _table_name(path, buckets)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    rows = df.repartition(buckets, *keys).sortWithinPartitions(*keys)
    rows.write.mode("overwrite").option("path", path).bucketBy(buckets, *keys).sortBy(*keys).format("parquet").saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")  # an external table: its files stay


def _read_bucketed(spark: SparkSession, path: str, ddl: str, keys: list[str], buckets: int) -> DataFrame:
    name, by = _table_name(path, buckets), ", ".join(f"`{k}`" for k in keys)
    place = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet LOCATION '{place}' CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS")
    return spark.table(name)


# --- snapshots --------------------------------------------------------------------


def _names(side: str) -> dict[str, str]:
    return {table: f"{schemas.side_prefix(side)}{table}" for table in schemas.TABLES}


def write_snapshot(tables: dict[str, DataFrame], root: str, version: str, side: str, buckets: int | None = None) -> None:
    """Write the four tables of one side as a part of a version, bucketed on their keys.

    ``buckets`` (as many as the session's shuffle partitions if not given) replaces the number of partitions of the
    shuffles it saves, and should be the same on both sides.
    """
    names = _names(side)
    write_part({names[t]: tables[t] for t in names}, root, version, _part(side), f"version={version}", spark=tables["dataset"].sparkSession,
               keys={names[t]: schemas.KEYS[t] for t in names}, buckets=buckets)


def read_snapshot(spark: SparkSession, root: str, version: str, side: str) -> dict[str, DataFrame]:
    """The four tables of one side of a committed version."""
    found = read_part(spark, root, version, _part(side))
    return {t: found[n] for t, n in _names(side).items()}


def _part(side: str) -> str:
    return "source" if schemas.side_prefix(side) == "db_" else "catalog"


def latest_snapshot(spark: SparkSession, root: str, side: str) -> dict[str, DataFrame] | None:
    """One side as committed last; None before the first version."""
    version = latest_version(spark, root, _part(side))
    return None if version is None else read_snapshot(spark, root, version, side)


def upsert_snapshot(
    incoming: dict[str, DataFrame], root: str, version: str, side: str, order_by: dict[str, list[str]], *,
    spark: SparkSession, buckets: int | None = None,
) -> dict[str, DataFrame]:
    """Insert-or-replace rows into the last committed version of a side, as a new version of all four tables.

    ``incoming`` may lack tables; those stay as they are. ``order_by`` tells which of several rows with one key is the last. If the
    version is committed already, nothing is written: a rerun gives the same tables.
    """
    if not is_committed(spark, root, version, _part(side)):
        before = latest_snapshot(spark, root, side) or empty_snapshot(spark, side)
        after = {t: N.upsert(before[t], incoming[t], schemas.KEYS[t], order_by[t]) if t in incoming else before[t] for t in schemas.TABLES}
        write_snapshot(after, root, version, side, buckets)
    return read_snapshot(spark, root, version, side)


def empty_snapshot(spark: SparkSession, side: str) -> dict[str, DataFrame]:
    return {t: spark.createDataFrame([], schemas.snapshot_schema(t, side)) for t in schemas.TABLES}
