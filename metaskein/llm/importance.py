"""Importance resampling towards a target: documents whose words are those of the target are drawn more often.

Features (runs of words) are hashed into buckets by CRC-32. The buckets' shares in all documents and in the target give each bucket
a gain, a document's weight is the sum of the gains of its features, and a Gumbel number from its id turns the largest weights into a
draw without replacement.

CRCs are computed for all new features of a batch together: features of one length are the rows of a byte matrix, and each
of its columns updates all CRCs of that length at once.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .runtime import lean, ship, stored

#: Features a task remembers the buckets of; at this many it starts afresh. Bounds memory only.
CACHE_FEATURES = 300_000
#: Longer features are not remembered, so that the cache is bounded in bytes too.
CACHE_BYTES = 64
#: Bytes up to which features form matrices. A longer one would be a matrix of a row or two and as many steps as bytes; it goes to the library.
MATRIX_BYTES = 1_024
#: Texts looked at together.
TEXTS = 1_000

# What a word byte is, after lower-casing A-Z, and the reflected CRC-32 polynomial.
_to_words = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
POLYNOMIAL = 0xEDB88320


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, table >> 1 ^ np.uint32(POLYNOMIAL), table >> 1).astype(np.uint32)
    return table


_table = _crc_table()


def crc32(features: list[bytes]) -> np.ndarray:
    """CRC-32 of each, by one matrix for each length."""
    sizes = np.fromiter(map(len, features), np.int64, len(features))
    out = np.empty(len(features), np.uint32)
    order = np.argsort(sizes, kind="stable")
    cuts = np.flatnonzero(np.diff(sizes[order])) + 1
    for rows in np.split(order, cuts) if len(order) else ():
        length = int(sizes[rows[0]])
        if length > MATRIX_BYTES:
            out[rows] = [zlib.crc32(features[i]) for i in rows.tolist()]
            continue
        matrix = np.frombuffer(b"".join([features[i] for i in rows.tolist()]), np.uint8).reshape(len(rows), length)
        crc = np.full(len(rows), 0xFFFFFFFF, np.uint32)
        for column in np.ascontiguousarray(matrix.T):
            crc = _table[(crc ^ column) & 0xFF] ^ crc >> 8
        out[rows] = ~crc
    return out


class Hasher:
    """Buckets of the features of texts; each distinct feature of a task is hashed once."""

    def __init__(self, buckets: int, words: int):
        self.buckets, self.words = buckets, words
        self.known: dict[bytes, int] = {}

    def features(self, text: bytes | None) -> list[bytes]:
        words = (text or b"").translate(_to_words).split()
        out = words
        for n in range(2, self.words + 1):
            out = out + [b" ".join(words[i:i + n]) for i in range(len(words) - n + 1)]
        return out

    def of(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """Buckets of all features in order, and how many each text has."""
        sizes, features = np.zeros(len(texts), np.int64), []
        for i, text in enumerate(texts):
            found = self.features(text)
            sizes[i] = len(found)
            features += found
        distinct = set(features)
        if len(self.known) + len(distinct) > CACHE_FEATURES:
            self.known.clear()
        new = list(distinct.difference(self.known))
        self.known.update(zip(new, (crc32(new) % np.uint32(self.buckets)).tolist(), strict=True))
        flat = np.fromiter(map(self.known.__getitem__, features), np.int64, len(features))
        for f in new:
            if len(f) > CACHE_BYTES:
                del self.known[f]
        return flat, sizes


def _batches(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, list[bytes | None]]]:
    for batch in batches:
        for at in range(0, batch.num_rows, TEXTS):
            part = batch.slice(at, TEXTS)
            yield part, part.column(column).cast(pa.large_binary()).to_pylist()


def bucket_counts(texts: DataFrame, buckets: int, words: int, *, text_col: str = "text") -> np.ndarray:
    """How many features of all texts each bucket holds. A task sends one row a bucket."""
    ship(texts.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, total = Hasher(buckets, words), np.zeros(buckets, np.int64)
        for _, part in _batches(batches, 0):
            total += np.bincount(hasher.of(part)[0], minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some])], names=["bucket", "n"])

    found = texts.select(F.col(text_col).cast("string")).mapInArrow(lean(run), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets, np.int64)
    out[found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of the ratio of the smoothed shares) of each bucket, in doubles."""
    s_all, t_all, n = float(source.sum()), float(target.sum()), float(len(source))
    return np.array([math.floor(1000 * math.log((t + 1.0) * (s_all + n) / ((s + 1.0) * (t_all + n)))) for s, t in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def _gumbel(id_: Column, seed: int) -> Column:
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit(""))).cast("binary"), 256), 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def resample(docs: DataFrame, target: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text",
             buckets: int = 10_000, words: int = 1, least_words: int = 20, percent: int = 10, seed: int = 2024) -> DataFrame:
    """Weight every whole text by its likeness to ``target`` and draw ``floor(percent * N / 100)`` of the N with ``least_words`` words and more.

    Returns ``id_col``, ``n_features``, ``weight``, ``score`` and ``rank`` (all long; rank is null where not drawn). One row per input
    row. Null, empty and wordless texts have no features and weight 0 and are never drawn while ``least_words`` is positive; an empty target or table still
    gives each bucket a gain. Equal scores go to the smaller id (null ids, which hash as the empty string, first), then to the smaller
    weight and count; rows that repeat all of these are interchangeable and drawn one by one. Other columns are ignored.

    Two passes over the texts. The first sends one row a bucket and task, the second reads the gains (8 bytes a bucket) as a
    broadcast. Ranks come from a range shuffle of five numbers a row: a row's place in its partition plus what the partitions before it
    hold, so no key, tie or score meets in one task. Only partition sizes reach the driver.
    """
    spark = docs.sparkSession
    ship(spark)
    gain = gains(bucket_counts(docs, buckets, words, text_col=text_col), bucket_counts(target, buckets, words, text_col=target_text_col))
    shared = spark.sparkContext.broadcast(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(buckets, words)
        for batch, part in _batches(batches, 1):
            flat, sizes = hasher.of(part)
            total = np.concatenate([[0], np.cumsum(shared.value[flat])])
            ends = np.cumsum(sizes)
            # Of n words, the runs of 1 to k have n + (n - 1) + ... members; the single words are what is asked for.
            n_words = sizes if words == 1 else np.array([len((t or b"").translate(_to_words).split()) for t in part], np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes), pa.array(total[ends] - total[ends - sizes]), pa.array(n_words, pa.int64())],
                                             names=["id", "n_features", "weight", "n_words"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    weighed = rows.mapInArrow(lean(run), f"id {kind}, n_features long, weight long, n_words long")
    weighed = stored(weighed.withColumn("score", F.col("weight") + _gumbel(F.col("id"), seed)))

    able = F.col("n_words") >= least_words
    drawn = percent * weighed.where(able).count() // 100
    order = [F.desc("score"), F.asc("id"), F.asc("weight"), F.asc("n_features")]
    # The id that Spark numbers rows by holds the partition above its lowest 33 bits and the place in it below.
    placed = weighed.where(able).repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    placed = stored(placed.withColumn("part", F.shiftright("at", 33)).withColumn("place", F.col("at").bitwiseAND((1 << 33) - 1)).drop("at"))
    sizes = sorted((r.part, r.n) for r in placed.groupBy("part").agg(F.count("*").alias("n")).collect())
    starts, before = [], 0
    for part, n in sizes:
        starts.append((part, before))
        before += n
    starts = F.broadcast(spark.createDataFrame(starts, "part long, before long"))
    rank = F.col("before") + F.col("place") + 1
    placed = placed.join(starts, "part").withColumn("rank", F.when(rank <= drawn, rank))
    rest = weighed.where(~able).withColumn("rank", F.lit(None).cast("long"))
    names = ["id", "n_features", "weight", "score", "rank"]
    return placed.select(names).union(rest.select(names)).withColumnRenamed("id", id_col)
