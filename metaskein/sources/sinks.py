"""Sinks: payload requests, nested documents and diffs as JSON lines. Executors write."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_payloads(requests: DataFrame, path: str, *, mode: str = "errorifexists") -> None:
    """One folder per phase and entity, one JSON line per request.

    Folder names start with the phase number, so their order is the order of sending. ``target_name`` is the name of a
    set that is created in the same delta, whose id only the sender learns.
    """
    line = F.to_json(F.struct("target_id", "target_name", "part", F.try_parse_json("body").alias("body")))
    requests.select(
        F.concat_ws("_", "phase_no", "phase").alias("phase"), "entity", line.alias("value")
    ).write.mode(mode).partitionBy("phase", "entity").text(path)


def write_document(doc: DataFrame, path: str, *, pretty: bool = False) -> None:
    """Document fragments, one JSON object each; absent fields (such as the comment) are left out."""
    text = F.to_json(F.struct(*doc.columns), {"ignoreNullFields": "true", "pretty": str(pretty).lower()})
    doc.select(text.alias("value")).write.mode("errorifexists").text(path)


def write_diff(diff: DataFrame, path: str) -> None:
    """``delta.diff_json`` rows, one folder per entity."""
    diff.select("entity", F.col("json").alias("value")).write.mode("errorifexists").partitionBy("entity").text(path)
