"""Near-duplicate documents: an exact Jaccard join on word shingles.

Two documents can only link if their shingle sets are of similar size and share one of the first few shingles in a
common order (the prefix bound). Rare shingles come first in that order, so what many documents share is hardly ever
a key. Candidates are compared by hashed bitmaps: a bit set in one signature and not in the other stands for a shingle
that the other lacks, so bit counts bound the overlap from above. Only pairs that pass are intersected exactly.

Candidates of one key are never all paired. The documents of a key are first compared with one centre; where that
leaves them in one component, nothing is left to find. Only members of different components of a key are compared in
tiles of a size band. A pair becomes a row at the first key of a run of keys that both have one after the other, and there only
if the bitmaps, and what of the two sets comes after that key, allow the overlap.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .components import connected
from .runtime import give_up, lean, ship, stored

#: Text bytes hashed at once in a task.
CHUNK_BYTES = 500_000
#: Longs of the short bitmap signature; a wide one has at least two bits for each shingle.
SIGNATURE = 8
#: Most frequent shingles that are put last in the common order (8 bytes each, broadcast). Any order gives the same result.
LATE_SHINGLES = 500_000
#: Copies of a shingle in one batch of documents from which it is counted over all documents.
LATE_FROM = 4
#: Members of a key in one tile.
TILE = 512
#: Rows of ids up to which a filter on documents is broadcast (16 bytes each); beyond, the join is shuffled.
BROADCAST_ROWS = 500_000

_ODD = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_ODD), -1, 1 << 64))
_lower = np.arange(1, 257, dtype=np.uint64)
_lower[65:91] += np.uint64(32)
_space = np.zeros(256, bool)
_space[[32, *range(9, 14)]] = True
_powers: list[np.ndarray] = []


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        n = max(n, CHUNK_BYTES + 1)
        made = []
        for base in (_ODD, _INVERSE):
            p = np.full(n, base, np.uint64)
            p[0] = 1
            made.append(np.multiply.accumulate(p))
        _powers[:] = made
    return _powers[0], _powers[1]


def chunks(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, offsets, bytes) of runs of texts of about CHUNK_BYTES; nulls are empty."""
    column = column.cast(pa.large_binary()) if not column.null_count else column.cast(pa.large_binary()).fill_null(b"")
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64, n + 1, column.offset * 8)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    start = 0
    while start < n:
        end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + CHUNK_BYTES, side="right")) - 1)
        yield start, offsets[start:end + 1] - offsets[start], data[offsets[start]:offsets[end]]
        start = end


def shingle_sets(offsets: np.ndarray, data: np.ndarray, words: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text."""
    n = len(offsets) - 1
    if not len(data):
        return [np.zeros(0, np.uint64)] * n
    power, inverse = _power(len(data) + 1)
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    blank = _space[data]
    before = np.concatenate([[True], blank[:-1]]) | first[:-1]
    after = np.concatenate([blank[1:], [True]]) | first[1:]
    start, end = np.flatnonzero(~blank & before), np.flatnonzero(~blank & after) + 1
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_lower[data] * power[:len(data)], out=total[1:])
    word = _mix((total[end] - total[start]) * inverse[start])
    bounds = np.searchsorted(start, offsets)
    if len(word) >= words:
        rolled = np.zeros(len(word) - words + 1, np.uint64)
        for k in range(words):
            rolled = rolled * np.uint64(0xD6E8FEB86659FD93) + word[k:len(word) - words + 1 + k]
        rolled = _mix(rolled)
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= words:
            out.append(np.unique(rolled[a:b - words + 1]))
        elif b > a:
            h = np.uint64(b - a)
            with np.errstate(over="ignore"):
                for w in word[a:b]:
                    h = h * np.uint64(0xA0761D6478BD642F) + w
            out.append(_mix(np.array([h])))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _lists(values: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, values)])
    flat = np.concatenate(values) if values else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.view(np.int64), pa.int64()))


def _signature(shingles: np.ndarray, longs: int = SIGNATURE) -> np.ndarray:
    bits = np.zeros(longs * 64, np.uint8)
    bits[(shingles % np.uint64(longs * 64)).astype(np.int64)] = 1
    return np.packbits(bits).view(np.uint64)


def _wide(shingles: np.ndarray) -> np.ndarray:
    """A signature whose length is a power of two that grows with the set."""
    return _signature(shingles, max(SIGNATURE, 1 << (max(1, 2 * len(shingles)) // 64).bit_length()))


def late_shingles(texts: DataFrame, words: int) -> np.ndarray:
    """Hashes of the most frequent shingles of all texts, rarest first: at most LATE_SHINGLES."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_up()
        others = LATE_FROM - 1
        for batch in batches:
            found = [s for _, offsets, data in chunks(batch.column(0)) for s in shingle_sets(offsets, data, words)]
            h = np.concatenate(found) if found else np.zeros(0, np.uint64)
            del found
            h.sort()  # in place: a batch has as many shingles as words
            h, n = np.unique(h[:-others][h[others:] == h[:-others]], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n + others, pa.int64())], names=["h", "n"])

    counted = texts.select("text").mapInArrow(lean(count), "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    top = counted.orderBy(F.desc("n"), "h").limit(LATE_SHINGLES).toArrow()
    return top.column("h").to_numpy().view(np.uint64)[::-1].copy()


def _sketches(texts: DataFrame, kind: str, words: int, percent: int, late: np.ndarray) -> DataFrame:
    order = np.argsort(late, kind="stable")
    shared = texts.sparkSession.sparkContext.broadcast((late[order], order.astype(np.uint64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, rank = shared.value
        for batch in batches:
            for row, offsets, data in chunks(batch.column(1)):
                sets = shingle_sets(offsets, data, words)
                keys, signatures, wide = [], [], []
                for s in sets:
                    place = s >> np.uint64(1)
                    if len(known) and len(s):
                        at = np.minimum(np.searchsorted(known, s), len(known) - 1)
                        is_late = known[at] == s
                        place[is_late] = rank[at[is_late]] + np.uint64(1 << 63)
                    need = -(-percent * len(s) // 100)
                    n = len(s) - need + 1 if len(s) else 0
                    first = np.argpartition(place, n - 1)[:n] if 0 < n < len(s) else np.arange(len(s))
                    keys.append(s[first[np.argsort(place[first])]])
                    signatures.append(_signature(s))
                    wide.append(_wide(s))
                raw = [x.tobytes() for x in sets]
                bits = np.array(signatures).reshape(len(sets), SIGNATURE).view(np.int64)
                part = batch.slice(row, len(sets))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2),
                     pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([xxhash.xxh3_128_digest(x) if x else None for x in raw], pa.binary()), _lists(keys), _lists(wide),
                     *(pa.array(bits[:, k]) for k in range(SIGNATURE))],
                    names=["id", "text_hash", "n", "class", "keys", "wide", *(f"s{k}" for k in range(SIGNATURE))])

    bitmaps = ", ".join(f"s{k} long" for k in range(SIGNATURE))
    return texts.mapInArrow(lean(run), f"id {kind}, text_hash long, n long, class binary, keys array<long>, wide array<long>, {bitmaps}")


def _sets(texts: DataFrame, words: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, offsets, data in chunks(batch.column(0)):
                sets = shingle_sets(offsets, data, words)
                yield pa.RecordBatch.from_arrays([pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()), _lists(sets)],
                                                 names=["class", "shingles"])
    return texts.select("text").mapInArrow(lean(run), "class binary, shingles array<long>")


def _intersect(percent: int):
    """Pairs whose sorted sets ``sa`` and ``sb`` of ``na`` and ``nb`` shingles overlap enough."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            na, nb = (batch.column(k).to_numpy() for k in (2, 3))
            sides = []
            for k in (4, 5):
                column = batch.column(k)
                ends = column.offsets.to_numpy()
                sides.append((ends, column.values.to_numpy(zero_copy_only=False).view(np.uint64)))
            both = np.zeros(batch.num_rows, np.int64)
            for i in range(batch.num_rows):
                x, y = (flat[ends[i]:ends[i + 1]] for ends, flat in sides)
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                both[i] = np.count_nonzero(y[at] == x)
            enough = pa.array((100 + percent) * both >= percent * (na + nb))
            yield pa.RecordBatch.from_arrays([batch.column(k).filter(enough) for k in (0, 1)], names=["a", "b"])
    return run


def with_text_hash(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds ``text_hash`` long, which with the id names a row; rows that repeat both are equal."""
    return docs.withColumn("text_hash", F.xxhash64(text_col))


def few(df: DataFrame) -> DataFrame:
    """``df`` (stored, of ids), to be broadcast if it has few rows; else its join is shuffled."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _may_link(a: str, b: str, percent: int) -> Column:
    """Sizes within the bound, and bit counts that allow the overlap: inter >= p (na + nb) / (100 + p)."""
    na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
    alone = lambda x, y: sum((F.bit_count(F.col(f"{x}.s{k}").bitwiseAND(F.bitwise_not(F.col(f"{y}.s{k}")))) for k in range(1, SIGNATURE)),
                             F.bit_count(F.col(f"{x}.s0").bitwiseAND(F.bitwise_not(F.col(f"{y}.s0")))))
    bound = F.least(na - alone(a, b), nb - alone(b, a))
    return (100 * F.least(na, nb) >= percent * F.greatest(na, nb)) & ((100 + percent) * bound >= percent * (na + nb))


def _folded(c: Column, n: Column) -> Column:
    """A wide signature at length ``n``, its own or half of it: bits are hashes modulo a power of two."""
    half = F.zip_with(F.slice(c, F.lit(1), n), F.slice(c, n + 1, n), lambda p, q: p.bitwiseOR(q))
    return F.when(F.size(c) == n, c).otherwise(half)


def _wide_may_link(percent: int) -> Column:
    """The bound of ``_may_link`` by the wide signatures ``wa`` and ``wb`` of sets of ``na`` and ``nb``; lengths differ by one doubling at most."""
    n = F.least(F.size("wa"), F.size("wb"))
    alone = lambda x, y: F.aggregate(F.zip_with(_folded(F.col(x), n), _folded(F.col(y), n), lambda p, q: F.bit_count(p.bitwiseAND(F.bitwise_not(q)))), F.lit(0), lambda s, v: s + v)
    bound = F.least(F.col("na") - alone("wa", "wb"), F.col("nb") - alone("wb", "wa"))
    return (100 + percent) * bound >= percent * (F.col("na") + F.col("nb"))


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """Components of documents whose shingle sets have ``100 * intersection >= percent * union``.

    Returns ``id_col``, ``text_hash`` long (of the raw text), ``n_shingles`` long, ``component_id`` (smallest id reachable
    by links, itself included), ``kept`` boolean (true for one row of each component, of smallest id). One row per input row.
    Null, empty and blank texts have an empty set, link with nothing and are kept. A text with fewer words than ``words`` is
    one shingle. Equal sets always link; null ids are no component's smallest id unless all are null. Other columns are ignored.

    Shuffles: prefix keys of distinct sets (about a fifth of the shingles, 16 bytes each), then only candidates. Sets are
    compared as 64-bit shingle hashes; equal sets are told by 128 bits.
    """
    spark = docs.sparkSession
    ship(spark)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    texts = with_text_hash(texts)
    kind = texts.schema["id"].dataType.simpleString()
    late = late_shingles(texts, words)
    sketches = stored(_sketches(texts, kind, words, percent, late).withColumn("row", F.monotonically_increasing_id()))

    # One row stands for all equal sets: map-side minimum, so thousands of copies cost no more than one.
    classes = stored(sketches.where("class is not null").groupBy("class").agg(F.min("row").alias("node"), F.min("id").alias("low")))
    others = stored(sketches.select("row", "class").join(classes.select("class", "node"), "class").where("row != node").select("row"))
    nodes = sketches.where("class is not null").join(few(others), "row", "left_anti").withColumnRenamed("row", "node")
    bitmaps = ["n", *(f"s{k}" for k in range(SIGNATURE))]

    by_key = Window.partitionBy("key").orderBy("node")
    shared = nodes.select(F.posexplode("keys").alias("pos", "key"), "node") \
        .select("key", "node", "pos", F.lag("node").over(by_key).alias("before"), F.lead("node").over(by_key).alias("after"))
    members = stored(shared.where("before is not null or after is not null").select("key", "node", "pos"))
    weight = stored(members.groupBy("node").agg(F.count("*").alias("shared")))
    about = stored(nodes.select("node", "id", "class", "wide", *bitmaps).join(weight, "node"))

    # Round 1: each key's members against the one whose keys are shared most, which in a family of copies is the original.
    rated = members.join(about.select("node", (F.col("shared") / F.col("n")).alias("rate")), "node")
    centres = stored(rated.groupBy("key").agg(F.max(F.struct("rate", -F.col("node"))).alias("top")).select("key", (-F.col("top")["col2"]).alias("centre")))
    edges = members.join(centres, "key").where("node != centre").select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b")).distinct()
    small = about.select("node", *bitmaps)
    sides = lambda pairs: pairs.join(small.alias("x"), F.col("a") == F.col("x.node")).join(small.alias("y"), F.col("b") == F.col("y.node"))
    first = sides(edges).where(_may_link("x", "y", percent)).select("a", "b")

    def linked(pairs: DataFrame) -> DataFrame:
        """The pairs that pass the wide signatures and whose sets, made anew from just their texts, overlap enough."""
        wx, wy = (about.select(F.col("node").alias(c), F.col("n").alias(f"n{c}"), F.col("wide").alias(f"w{c}")) for c in "ab")
        pairs = stored(pairs.join(wx, "a").join(wy, "b").where(_wide_may_link(percent)).select("a", "b"))
        some = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
        some = stored(about.select("node", "id", "class", "n").join(some, "node"))
        ids = few(stored(some.select(F.col("id").alias("w")).distinct()))
        sets = _sets(texts.join(ids, F.col("id").eqNullSafe(F.col("w")), "left_semi"), words)
        sets = sets.join(few(some.select("class", "node", "n")), "class").drop("class")
        repeated = sketches.join(ids, F.col("id").eqNullSafe(F.col("w")), "left_semi").groupBy("id").count().where("count > 1")
        sets = stored(sets if repeated.isEmpty() else sets.dropDuplicates(["node"]))
        x, y = (sets.select(F.col("node").alias(c), F.col("n").alias(f"n{c}"), F.col("shingles").alias(f"s{c}")) for c in "ab")
        both = pairs.join(x, "a").join(y, "b").select("a", "b", "na", "nb", "sa", "sb")
        return stored(both.mapInArrow(lean(_intersect(percent)), "a long, b long"))

    links = linked(first)
    found = connected(links)

    # Round 2: keys whose members, the centre left out, are in more than one component.
    placed = members.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    split = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("size")) \
        .where("low < high and size > 2").select("key", F.ceil(F.col("size") / TILE).cast("int").alias("tiles"))
    open_ = stored(placed.join(split.join(centres, "key"), "key").where("node != centre").drop("centre"))
    # Of the keys that two members both have and that are open for both, one comes first; there they have no open key before it in common.
    open_ = open_.withColumn("prior", F.lag("key").over(Window.partitionBy("node").orderBy("pos")))
    band = F.floor(F.log("n") / F.log(F.lit(100 / percent))).cast("int")
    open_ = open_.join(about.select("node", *bitmaps), "node").withColumn("band", band).withColumn("tile", F.pmod(F.xxhash64("node"), "tiles").cast("int"))
    # A row's tile meets every tile of its own band and of the next.
    left = open_.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).withColumn("reach", F.explode(F.array(F.lit(0), F.lit(1))))
    left = left.withColumn("meets", F.col("band") + F.col("reach"))
    right = open_.withColumn("from", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    first_common = F.col("x.prior").isNull() | F.col("y.prior").isNull() | (F.col("x.prior") != F.col("y.prior"))
    rest = F.least(F.col("x.n") - F.col("x.pos"), F.col("y.n") - F.col("y.pos"))  # of the sets, from their first common key on
    pairs = left.alias("x").join(
        right.alias("y"),
        (F.col("x.key") == F.col("y.key")) & (F.col("x.tile") == F.col("y.from")) & (F.col("x.other") == F.col("y.tile")) & (F.col("x.meets") == F.col("y.band"))
        & (F.col("x.component") != F.col("y.component")) & ((F.col("x.reach") == 1) | (F.col("x.node") < F.col("y.node")))
        & first_common & ((100 + percent) * rest >= percent * (F.col("x.n") + F.col("y.n"))) & _may_link("x", "y", percent)) \
        .select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()
    more = linked(pairs)
    if not more.isEmpty():
        found = connected(links.union(more))

    low = classes.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    low = stored(low.select("class", "node", "component", "low"))
    least = low.groupBy("component").agg(F.min("low").alias("component_id"), F.count("*").alias("size"))
    result = sketches.select("id", "text_hash", "n", "class", "row").join(
        low.select("class", "component").join(least.select("component", "component_id"), "component"), "class", "left")
    result = stored(result.withColumn("component_id", F.coalesce("component_id", "id")))
    chosen = result.where("component is not null and id <=> component_id").groupBy("component").agg(F.min("row").alias("chosen"))
    result = result.join(chosen, "component", "left").withColumn("kept", F.col("component").isNull() | (F.col("row") == F.col("chosen")))
    return result.select(F.col("id").alias(id_col), "text_hash", F.col("n").alias("n_shingles"), "component_id", "kept")
