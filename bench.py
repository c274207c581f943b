"""Time the headline operators and print one JSON line.

The inputs (snapshots, catalog tables and, for preview and payloads, the changes) are
first stored as Parquet, as the flows store them; that is not part of the figures. Each query then runs in
full into Spark's no-op sink: one warm-up, then the median of two runs.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import SparkSession

from checks.queries import OPERATIONS, StoredInputs, store_inputs
from metaskein.session import configure

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = (
    "upsert_items", "sets_updated", "items_new", "items_new_scoped", "items_deleted", "items_updated",
    "relationships_updated", "joins_new", "joins_updated", "item_delta_cascade", "join_delta_cascade", "change_feed",
    "delta_counts", "delta_preview", "payload_items", "payload_relationships", "set_id_resolution",
    "entities_flatten_strict", "fk_resolution", "matview_columns", "profile_nulls", "profile_mcv", "json_keys_full",
    "merge_items", "set_links", "document_roundtrip",
)
# These read the stored changes, as they do in the full flow.
CONSUMERS = ("delta_counts", "delta_preview", "payload_items", "payload_relationships")


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]").appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def run(spark: SparkSession, name: str, root: str) -> float:
    start = time.perf_counter()
    OPERATIONS[name](StoredInputs(spark, SF_DIR, root, name in CONSUMERS)).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main(names: list[str]) -> None:
    spark = session()
    root = tempfile.mkdtemp(prefix="run-bench-", dir="/tmp")
    store_inputs(spark, SF_DIR, root)
    times = {}
    for name in names:
        run(spark, name, root)
        times[name] = round(statistics.median(run(spark, name, root) for _ in range(2)), 3)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": times,
                      "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main(sys.argv[1:] or list(HEADLINE))
