"""Exact removal of repeated passages by suffix sorting.

A byte goes if a string of ``length`` bytes over it also starts anywhere else. Suffixes that could share so long a prefix are
brought together by content: every window of ``length`` bytes picks the gram of least hash in it as its anchor, so equal windows have equal
anchors at equal places. Windows in a row with one anchor are a run, and what they cover is the run's context. Contexts whose
anchors occur once are settled at once, and so are contexts that occur twice. The others of one anchor are sorted
as suffixes, once by what follows the anchor and once, read backwards, by what precedes it. Prefix polynomial hashes and binary
search give the common extension of two suffixes, so a comparison of the merge sort takes logarithmic time, and the
extensions of neighbours are verified byte by byte against hash collisions. From the two orders follows which windows are equal.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cmp_to_key
from itertools import pairwise

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import lean, ship, stored
from .shingles import _mix, _power, chunks, few

#: Bytes of an anchor gram; the rest of a window is where the anchor can lie.
GRAM = 100
#: Bits of a hash that a filter looks at (broadcast, 8 MB); more bits let fewer others pass, and any number gives the same result.
FILTER_BITS = 26
#: Contexts of an anchor that one task sorts; the windows of a larger group are counted by hash instead, with the same result.
SORTED = 5_000
#: Removed stretches up to which they are broadcast (16 bytes each); beyond, documents are shuffled to them.
BROADCAST_ROWS = 1_000_000
#: Bytes of a text looked at together.
SEGMENT = 1 << 21
#: Texts cut together.
TEXTS = 1_000

_PLACE = np.uint64((1 << 26) - 1)
_ALL = (1 << 64) - 1


def _windows(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows: first start, last start, anchor place, anchor hash."""
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < length:
        return none, none, none, np.zeros(0, np.uint64)
    inside = np.zeros(n + 1, np.int8)
    long_ = np.flatnonzero(np.diff(offsets) >= length)
    inside[offsets[long_]] = 1
    inside[offsets[long_ + 1] - length + 1] -= 1
    starts = np.flatnonzero(np.cumsum(inside[:n], dtype=np.int8))
    if not len(starts):
        return none, none, none, np.zeros(0, np.uint64)
    power, inverse = _power(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:n], out=total[1:])
    h = _mix((total[gram:] - total[:-gram]) * inverse[:n - gram + 1])
    width = length - gram + 1
    count = len(h)
    padded = np.full(-(-count // width) * width, _ALL, np.uint64)
    np.bitwise_or(h & ~_PLACE, np.arange(count, dtype=np.uint64), out=padded[:count])
    tiles = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(tiles, axis=1).ravel()
    behind = np.minimum.accumulate(tiles[:, ::-1], axis=1)[:, ::-1].ravel()
    anchor = (np.minimum(behind[starts], ahead[starts + width - 1]) & _PLACE).astype(np.int64)
    edge = np.flatnonzero((anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1)) + 1
    first, last = starts[np.append(0, edge)], starts[np.append(edge, len(starts)) - 1]
    place = anchor[np.append(0, edge)]
    return first, last, place, h[place]


def _runs(column: pa.Array, length: int, gram: int) -> Iterator[tuple]:
    """(row of each run, start in its text, first, last, anchor place, anchor hash, bytes) for stretches of the texts."""
    for row, offsets, data in chunks(column):
        if len(data) <= SEGMENT * 2:
            first, last, place, h = _windows(data, offsets, length, gram)
            text = np.searchsorted(offsets, first, side="right") - 1
            yield row + text, first - offsets[text], first, last, place, h, data
        else:  # one long text: its windows, stretch by stretch
            for at in range(0, len(data), SEGMENT):
                part = data[at:at + SEGMENT + length - 1]
                first, last, place, h = _windows(part, np.array([0, len(part)]), length, gram)
                yield np.full(len(first), row), first + at, first, last, place, h, part


def _extension(total: list[int] | np.ndarray, inverse: np.ndarray, a: int, b: int, most: int) -> int:
    """Common prefix of the suffixes at ``a`` and ``b``, at most ``most``, by binary search over prefix hashes."""
    item, inv = total.item, inverse.item
    ta, tb, ia, ib = item(a), item(b), inv(a), inv(b)
    if (item(a + most) - ta) * ia & _ALL == (item(b + most) - tb) * ib & _ALL:
        return most
    low, high = 0, most - 1
    while low < high:
        mid = (low + high + 1) >> 1
        if (item(a + mid) - ta) * ia & _ALL == (item(b + mid) - tb) * ib & _ALL:
            low = mid
        else:
            high = mid - 1
    return low


def suffix_order(parts: list[bytes]) -> tuple[list[int], list[int]]:
    """Order of the strings, and how much each but the first shares with the one before."""
    data = np.frombuffer(b"".join(parts), np.uint8)
    power, inverse = _power(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:len(data)], out=total[1:])
    size = [len(p) for p in parts]
    start = [0]
    for n in size[:-1]:
        start.append(start[-1] + n)

    def before(i: int, j: int) -> int:
        most = min(size[i], size[j])
        k = _extension(total, inverse, start[i], start[j], most)
        return size[i] - size[j] if k == most else parts[i][k] - parts[j][k]

    order = sorted(range(len(parts)), key=cmp_to_key(before))  # a merge sort
    shared = [_extension(total, inverse, start[i], start[j], min(size[i], size[j])) for i, j in pairwise(order)]
    for (i, j), k in zip(pairwise(order), shared, strict=True):
        p, q = parts[i], parts[j]
        if p[:k] != q[:k] or k < min(len(p), len(q)) and p[k] >= q[k] or k == len(q) < len(p):
            return _plain_order(parts)  # a collision of hashes
    return order, shared


def _plain_order(parts: list[bytes]) -> tuple[list[int], list[int]]:
    order = sorted(range(len(parts)), key=parts.__getitem__)
    shared = []
    for i, j in pairwise(order):
        p, q = parts[i], parts[j]
        k = 0
        while k < min(len(p), len(q)) and p[k] == q[k]:
            k += 1
        shared.append(k)
    return order, shared


def equal_windows(contexts: list[bytes], places: list[int], length: int) -> list[list[tuple[int, int]]]:
    """For each of different contexts of one anchor, the (first, last) window starts that another has too."""
    g = len(contexts)
    after, of_after = suffix_order([c[p:] for c, p in zip(contexts, places, strict=True)])
    prior, of_prior = suffix_order([c[:p][::-1] for c, p in zip(contexts, places, strict=True)])
    place = np.array(places)
    lowest = place - (np.array([len(c) for c in contexts]) - length)  # of the anchor in the window
    reach = np.arange(lowest.min(), place.max() + 1)
    found: list[list[tuple[int, int]]] = [[] for _ in range(g)]
    equal = np.zeros((len(reach), g), bool)
    step = max(1, 500_000 // g)
    for at in range(0, len(reach), step):
        o = reach[at:at + step, None]
        follow, precede = np.zeros((len(o), g), np.int64), np.zeros((len(o), g), np.int64)
        follow[:, after[1:]] = np.cumsum(np.array(of_after)[None, :] < length - o, axis=1)
        precede[:, prior[1:]] = np.cumsum(np.array(of_prior)[None, :] < o, axis=1)
        # Equal windows agree in the class of what follows and of what precedes the anchor.
        kind = (np.arange(len(o))[:, None] * g + follow) * g + precede
        valid = (o >= lowest) & (o <= place)
        _, back, count = np.unique(kind[valid], return_inverse=True, return_counts=True)
        part = equal[at:at + step]
        part[valid] = count[back] > 1
    for i in np.flatnonzero(equal.any(axis=0)).tolist():
        hits = place[i] - reach[equal[:, i]][::-1]
        cut = np.flatnonzero(np.diff(hits) > 1)
        found[i] = list(zip(hits[np.append(0, cut + 1)].tolist(), hits[np.append(cut, len(hits) - 1)].tolist(), strict=True))
    return found


def _bitmap(anchors: DataFrame):
    """A broadcast set of bits, one for the first FILTER_BITS bits of each hash: of one size, however many there are."""
    at = F.call_function("shiftrightunsigned", anchors.columns[0], F.lit(64 - FILTER_BITS))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (at % 64).cast("int"))
    words = anchors.groupBy(F.floor(at / 64).cast("int").alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
    bitmap = np.zeros(1 << FILTER_BITS - 6, np.int64)
    bitmap[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return anchors.sparkSession.sparkContext.broadcast(bitmap.view(np.uint64))


def _in(bitmap: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = h >> np.uint64(64 - FILTER_BITS)
    return (bitmap[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)


def _place_hash(k1: np.ndarray, k2: np.ndarray, start: np.ndarray) -> np.ndarray:
    """A number for a place in a text, the same wherever the text is read."""
    return _mix(k1.view(np.uint64) ^ _mix(k2.view(np.uint64) + start.astype(np.uint64) * np.uint64(0xA0761D6478BD642F)))


def _leaders(k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
    """For each text of a batch the first equal one: copies add to counts only."""
    seen: dict[tuple[int, int], int] = {}
    return np.array([seen.setdefault(k, i) for i, k in enumerate(zip(k1.tolist(), k2.tolist(), strict=True))], np.int64)


_STRETCHES = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_INTERVALS = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = 400, gram: int = GRAM, sorted_most: int = SORTED) -> DataFrame:
    """Cut all passages of ``length`` bytes and more that occur again, in the same or another text, all their copies included.

    Returns ``id_col``, ``n_bytes`` long (of the UTF-8 text), ``removed`` array of (start, end) byte stretches, maximal and in order, and
    ``kept`` binary: the remaining bytes. One row per input row. Null and empty texts have no bytes. Matches never cross documents; repeated rows
    are copies of each other. Cut bytes may be parts of characters. Other columns are ignored.

    Three passes over the texts. Shuffles: one hash for each run (about 150 bytes of text), then hashes of the contexts of runs whose
    anchor occurs again, the contexts of anchors that have several, and lists of stretches. Equal contexts are told by 128-bit hashes and
    combined in each task; of all runs with one context only the run of least place hash sends it. A group with more than ``sorted_most``
    different ones is not sorted in one task, its windows become hashed counts.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("k1", F.xxhash64("text")).withColumn("k2", F.xxhash64(F.lit(1), "text"))

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for *_, h, _ in _runs(batch.column(0), length, gram):
                h, n = np.unique(h, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n, pa.int64())], names=["anchor", "n"])

    again = rows.select("text").mapInArrow(lean(anchors), "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1")
    again = _bitmap(again)

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1, k2 = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            leader = _leaders(k1, k2)
            copies = np.bincount(leader, minlength=batch.num_rows)
            for row, start, first, last, place, h, data in _runs(batch.column(0), length, gram):
                some = np.flatnonzero(_in(again.value, h) & (leader[row] == row))
                raw, ends = memoryview(data), last[some] + length
                names = [xxhash.xxh3_128_digest(raw[a:z]) for a, z in zip(first[some].tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(k1[row[some]]), pa.array(k2[row[some]]), pa.array(start[some], pa.int64()), pa.array(h[some].view(np.int64)), pa.array(names, pa.binary()),
                     pa.array(copies[row[some]], pa.int64()), pa.array(ends - first[some], pa.int32()),
                     pa.array(_place_hash(k1[row[some]], k2[row[some]], start[some]).view(np.int64))],
                    names=["k1", "k2", "start", "anchor", "name", "n", "bytes", "sender"])

    texts = rows.select("text", "k1", "k2")
    runs = stored(texts.mapInArrow(lean(candidates), "k1 long, k2 long, start long, anchor long, name binary, n long, bytes int, sender long"))

    counts = stored(runs.groupBy("anchor", "name").agg(F.sum("n").alias("n"), F.min("sender").alias("sender")))
    size = stored(counts.groupBy("anchor").agg(F.count("*").alias("different")).where("different > 1"))
    whole = counts.where("n > 1").select("name", F.lit(None).cast("array<struct<first:int,last:int>>").alias("windows"))
    several = _bitmap(counts.join(size, "anchor").select("sender"))

    def differing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1, k2 = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            leader = _leaders(k1, k2)
            shown: set[bytes] = set()
            for row, start, first, last, place, h, data in _runs(batch.column(0), length, gram):
                some = np.flatnonzero(_in(several.value, _place_hash(k1[row], k2[row], start)) & _in(again.value, h) & (leader[row] == row))
                raw, out = memoryview(data), []
                for a, z, p, anchor in zip(first[some].tolist(), (last[some] + length).tolist(), (place[some] - first[some]).tolist(), h[some].view(np.int64).tolist(), strict=True):
                    name = xxhash.xxh3_128_digest(raw[a:z])
                    if name not in shown:
                        shown.add(name)
                        out.append((anchor, name, p, bytes(raw[a:z])))
                kinds = (pa.int64(), pa.binary(), pa.int32(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], kind) for k, kind in enumerate(kinds)], names=["anchor", "name", "place", "context"])

    shown = texts.mapInArrow(lean(differing), "anchor long, name binary, place int, context binary")
    large = stored(size.where(F.col("different") > sorted_most).select("anchor"))
    any_large = not large.isEmpty()
    small = shown.join(few(large), "anchor", "left_anti") if any_large else shown
    small = small.repartition("anchor").sortWithinPartitions("anchor", "name")

    def sort_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def settle(names: list[bytes], places: list[int], contexts: list[bytes]) -> Iterator[tuple]:
            if len(names) > 1:
                for name, windows in zip(names, equal_windows(contexts, places, length), strict=True):
                    if windows:
                        yield name, [{"first": a, "last": b} for a, b in windows]

        def batch_of(out: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.binary()), pa.array([x[1] for x in out], _INTERVALS)], names=["name", "windows"])

        anchor, names, places, contexts, out = None, [], [], [], []
        for batch in batches:
            for a, name, place, context in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if a != anchor:
                    out.extend(settle(names, places, contexts))
                    anchor, names, places, contexts = a, [], [], []
                    if len(out) > 5_000:
                        yield batch_of(out)
                        out = []
                if not names or names[-1] != name:  # tasks that saw one context each sent it
                    names.append(name), places.append(place), contexts.append(context)
        out.extend(settle(names, places, contexts))
        yield batch_of(out)

    partly = small.mapInArrow(lean(sort_groups), "name binary, windows array<struct<first:int,last:int>>")

    def hash_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                name, first, found = [], [], []
                for n, context in zip(*(batch.column(k).slice(at, 200).to_pylist() for k in (0, 1)), strict=True):
                    for t in range(len(context) - length + 1):
                        name.append(n), first.append(t), found.append(xxhash.xxh3_128_digest(context[t:t + length]))
                yield pa.RecordBatch.from_arrays([pa.array(name, pa.binary()), pa.array(first, pa.int32()), pa.array(found, pa.binary())], names=["name", "first", "window"])

    if any_large:
        big = shown.join(few(large), "anchor", "left_semi").select("name", "context").dropDuplicates(["name"])
        hashed = stored(big.mapInArrow(lean(hash_windows), "name binary, first int, window binary"))
        twice = stored(hashed.groupBy("window").agg(F.count("*").alias("n")).where("n > 1").select("window"))
        hits = hashed.join(twice, "window").groupBy("name").agg(F.transform(F.array_sort(F.collect_list("first")), lambda t: F.struct(t.alias("first"), t.alias("last"))).alias("windows"))
        partly = partly.union(hits)

    # A context that occurs twice goes as a whole; else the windows that other contexts have.
    settled = stored(partly.union(whole).groupBy("name").agg(F.max(F.col("windows").isNull()).alias("whole"), F.first("windows", ignorenulls=True).alias("windows")))
    hit = runs.select("k1", "k2", "start", "name", "bytes").join(settled, "name")
    windows = F.when(F.col("whole"), F.array(F.struct(F.lit(0).alias("first"), (F.col("bytes") - length).alias("last")))).otherwise(F.col("windows"))
    stretches = F.transform(windows, lambda w: F.struct((F.col("start") + w["first"]).alias("start"), (F.col("start") + w["last"] + length).alias("end")))
    # Copies of a text in several batches have the same stretches.
    removed = hit.groupBy("k1", "k2").agg(F.flatten(F.collect_set(stretches)).alias("stretches"))
    removed = stored(removed.mapInArrow(lean(_merge_rows), "k1 long, k2 long, stretches array<struct<start:bigint,end:bigint>>"))
    if (removed.agg(F.sum(F.size("stretches") + 2)).first()[0] or 0) <= BROADCAST_ROWS:
        removed = F.broadcast(removed)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, TEXTS):
                batch = whole.slice(at, TEXTS)
                kept, removed, sizes = [], [], []
                for text, stretches in zip(batch.column(1), batch.column(2), strict=True):
                    raw, end, parts = text.as_py().encode("utf-8", "surrogatepass"), 0, []
                    gone = [(x["start"], x["end"]) for x in stretches.as_py() or ()]
                    for a, z in gone:
                        parts.append(raw[end:a])
                        end = z
                    kept.append(b"".join([*parts, raw[end:]]))
                    removed.append([{"start": a, "end": z} for a, z in gone])
                    sizes.append(len(raw))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(removed, _STRETCHES), pa.array(kept, pa.binary())],
                                                 names=["id", "n_bytes", "removed", "kept"])

    joined = rows.join(removed, ["k1", "k2"], "left").select("id", "text", "stretches")
    kind = rows.schema["id"].dataType.simpleString()
    return joined.mapInArrow(lean(cut), f"id {kind}, n_bytes long, removed array<struct<start:bigint,end:bigint>>, kept binary").withColumnRenamed("id", id_col)


def _merge_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = [[{"start": a, "end": z} for a, z in merged([(x["start"], x["end"]) for x in found.as_py()])] for found in batch.column(2)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(lists, _STRETCHES)], names=["k1", "k2", "stretches"])


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans in order, overlapping and touching ones joined."""
    out: list[tuple[int, int]] = []
    for a, z in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], z))
        else:
            out.append((a, z))
    return out
