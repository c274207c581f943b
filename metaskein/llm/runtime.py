"""What the operators of this package share: code on executors, stored intermediate tables, tables of a folder."""

from __future__ import annotations

import ctypes
import os
import re
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Hashable, Iterator
from pathlib import Path
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from metaskein.session import checkpoint_dir

PACKAGE = Path(__file__).resolve().parent.parent
_shipped: set[str] = set()
_held: dict[tuple[str, Hashable], Any] = {}


#: Bytes of text that a task and its worker pass each other at once, and the session setting that says so.
BATCH_BYTES, BATCH_SETTING = 8 << 20, "spark.sql.execution.arrow.maxBytesPerBatch"


def ship(spark: SparkSession) -> None:
    """Give executors this package's modules, once per application; they need no copy of the repository.

    Also bounds the session's Arrow batches by BATCH_BYTES, unless it has a smaller bound: ten thousand long texts at once are
    held several times over by an executor and its workers.
    """
    sc = spark.sparkContext
    current = re.fullmatch(r"([0-9]+)b?", spark.conf.get(BATCH_SETTING, f"{BATCH_BYTES + 1}b"))
    if current and int(current[1]) > BATCH_BYTES:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))
    if sc.applicationId in _shipped:
        return
    path = os.path.join(tempfile.mkdtemp(prefix="metaskein-code-"), "metaskein_code.zip")
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(PACKAGE.rglob("*.py")):
            z.write(f, f.relative_to(PACKAGE.parent))
    sc.addPyFile(path)  # the driver serves it; executors fetch their own copy
    _shipped.add(sc.applicationId)


def held(kind: str, key: Hashable, make: Callable[[], Any], most: int = 1) -> Any:
    """A model that a worker keeps from task to task: up to ``most`` of one kind.

    Workers outlive stages, so a model of another kind, left by an earlier stage, is given up first.
    """
    at = (kind, key)
    if at not in _held:
        if len(_held) >= most or any(k != kind for k, _ in _held):
            _held.clear()
        _held[at] = make()
    return _held[at]


def give_up() -> None:
    """Frees the models that earlier stages left in this worker."""
    if _held:
        _held.clear()
        _give_back()


def _give_back() -> None:
    """Returns freed memory to the system, where its library can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run``, after which the worker gives freed memory back; it would keep it for as long as the application lives."""
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            _give_back()
    return wrapped


def stored(df: DataFrame) -> DataFrame:
    """``df`` as a written table in the shared checkpoint folder.

    It cuts lineage, survives lost executors and is read with column pruning. Tables live as long as the
    application's checkpoint folder does.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
