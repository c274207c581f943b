"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

A pre-token starts as a linked list of single bytes. Every adjacent pair whose bytes are a vocabulary entry sits in
the bucket of that entry's rank. A bitmap of two levels marks the buckets that are not empty: find-first-set on each
level gives the lowest rank, so the next merge costs the same for 10 bytes and for a million.
Entries are never searched for and deleted; one whose pair has changed meanwhile is skipped when it comes up.

Pre-tokens do not touch each other, so the short ones of many texts share one queue: a bucket then holds positions of all of them for
all ranks of one bit of the upper level. A step takes the lowest bit, and each pre-token found there merges its own lowest rank,
leftmost first, all at once. A long pre-token has a queue of its own, with both levels.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterable, Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import give_up, lean, ship

#: Pre-tokens a worker remembers: at half as many new ones, the older ones not used since are forgotten. Bounds memory only.
CACHE_ENTRIES = 150_000
#: Longer pre-tokens have a queue of their own and are not remembered, so that the cache is bounded in bytes too.
SHARED_BYTES = 64
#: Texts encoded together, and pre-tokens in one queue.
TEXTS, QUEUE_WORDS = 128, 16_000
#: Ranks that a bit of the upper level stands for.
SPAN = 256


class Coder:
    """Encodes and decodes with one vocabulary: ``ranks`` maps bytes to ids, lower ids merge first."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        # White space as Unicode defines it, which leaves out the separators U+001C to U+001F.
        self.pattern = pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")
        self._prepare()
        found = {(ranks[t[:k]] << 32 | ranks[t[k:]]): i for t, i in ranks.items() for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks}
        found = sorted(found.items())
        self.pair_keys = np.array([k for k, _ in found], np.int64)
        self.pair_ranks = np.array([r for _, r in found], np.int64)
        self.single = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int64)

    def _prepare(self) -> None:
        """What is not sent from the driver to workers."""
        self.split = regex.compile(self.pattern).findall
        self.tokens = {i: b for b, i in self.ranks.items()}
        self.cache = _Packed(self)
        self.older: dict[str, bytes] = {}

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("split", "tokens", "cache", "older")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._prepare()

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merge ranks of token pairs; -1: none."""
        keys = left << 32 | right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], -1)

    def merge_many(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of each pre-token."""
        ids, bounds = self._merge_many(words)
        return np.split(ids, bounds[1:-1]) if words else []

    def _merge_many(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pre-tokens, through one queue: those of all, and where each one's begin and the last one's end."""
        sizes = np.array([len(w) for w in words])
        ends = np.cumsum(sizes)
        data = np.frombuffer(b"".join(words), np.uint8)
        n = len(data)
        if not n or not len(self.pair_keys):
            return self.single[data], np.append(ends - sizes, n)
        owner = np.repeat(np.arange(len(words)), sizes)
        token = self.single[data]
        after = np.arange(1, n + 1)
        after[ends[sizes > 0] - 1] = n  # n stands for none; arrays have one more place for it
        before = np.arange(-1, n)
        before[(ends - sizes)[sizes > 0]] = n
        before[n] = n
        token = np.append(token, -1)
        pair = np.full(n + 1, -1, np.int64)
        inner = np.flatnonzero(after < n)
        pair[inner] = self._pairs(token[inner], token[after[inner]])
        buckets: dict[int, list[np.ndarray]] = {}  # positions by the upper level's bit: SPAN ranks
        top = 0

        def push(positions: np.ndarray) -> None:
            nonlocal top
            spans = pair[positions] // SPAN
            order = np.argsort(spans, kind="stable")
            positions, spans = positions[order], spans[order]
            cuts = np.flatnonzero(spans[1:] != spans[:-1]) + 1
            bounds = [0, *cuts.tolist(), len(positions)]
            for k, w in enumerate(spans[bounds[:-1]].tolist()):
                buckets.setdefault(w, []).append(positions[bounds[k]:bounds[k + 1]])
                top |= 1 << w

        inner = inner[pair[inner] >= 0]
        if len(inner):
            push(inner)
        gone = np.zeros(n, bool)
        while top:
            w = (top & -top).bit_length() - 1
            top &= top - 1
            parts = buckets.pop(w)
            at = parts[0] if len(parts) == 1 else np.concatenate(parts)
            rank = pair[at]
            # Lower spans are empty, so the lowest rank of a pre-token that is here is its lowest of all; of equals the leftmost.
            key = np.sort(((owner[at] * SPAN + rank % SPAN) << 32 | at)[rank // SPAN == w])  # the others are stale
            if not len(key):
                continue
            at, word = key & 0xFFFFFFFF, (key >> 32) // SPAN
            first = np.append(True, word[1:] != word[:-1])
            if not first.all():
                at, rest = at[first], at[~first]
                buckets[w] = [rest]
                top |= 1 << w
            right = after[at]
            token[at] = pair[at]
            gone[right] = True
            pair[right] = -1
            following = after[right]
            after[at] = following
            before[following] = at
            before[n] = n
            left = before[at]
            changed = np.concatenate([at, left[left < n]])
            new = np.where(after[changed] < n, self._pairs(token[changed], token[after[changed]]), -1)
            changed_now = new != pair[changed]
            pair[changed] = new
            changed = changed[changed_now & (new >= 0)]
            if len(changed):
                push(changed)
        alive = np.flatnonzero(~gone)
        return token[alive], np.append(np.searchsorted(alive, ends - sizes), len(alive))

    def remember(self, words: Iterable[str]) -> None:
        """Puts the short ones of ``words`` into the cache."""
        if len(self.cache) >= CACHE_ENTRIES // 2:
            self.cache, self.older = _Packed(self), dict(self.cache)
        new = []
        for w in words:
            if w not in self.cache:
                if w in self.older:
                    self.cache[w] = self.older[w]
                else:
                    new.append(w)
        raw = [w.encode() for w in new]
        short = [(w, r) for w, r in zip(new, raw, strict=True) if len(r) <= SHARED_BYTES]
        for at in range(0, len(short), QUEUE_WORDS):
            part = short[at:at + QUEUE_WORDS]
            ids, bounds = self._merge_many([r for _, r in part])
            packed, bounds = ids.astype("<u4").tobytes(), (4 * bounds).tolist()
            for k, (w, r) in enumerate(part):
                whole = self.ranks.get(r)
                self.cache[w] = struct.pack("<I", whole) if whole is not None else packed[bounds[k]:bounds[k + 1]]

    def merge(self, word: bytes) -> list[int]:
        """Ids of one pre-token. The queue is local variables, since a call for each step would cost more than the step."""
        rank_of = self.ranks.get
        whole = rank_of(word)
        if whole is not None:
            return [whole]
        n = len(word)
        end = list(range(1, n + 1))  # of the token that starts here
        before = list(range(-1, n - 1))  # start of the token to the left
        pair: list[int | None] = [None] * n  # rank of the pair that starts here; None: none, or merged away
        buckets: dict[int, list[int]] = {}  # positions by rank, each a heap
        low: dict[int, int] = {}  # bits of the buckets in use, by 256 ranks
        top = 0  # bits of ``low`` that are not zero
        for i in range(n - 1):
            rank = rank_of(word[i:i + 2])
            if rank is not None:
                pair[i] = rank
                if rank in buckets:
                    buckets[rank].append(i)  # positions rise, so the list is a heap
                else:
                    buckets[rank] = [i]
                    w = rank >> 8
                    low[w] = low.get(w, 0) | 1 << (rank & 255)
                    top |= 1 << w
        while top:
            w = (top & -top).bit_length() - 1
            bits = low[w]
            rank = (w << 8) + (bits & -bits).bit_length() - 1
            bucket = buckets[rank]
            if len(bucket) > 1:
                i = heappop(bucket)
            else:
                i = bucket[0]
                del buckets[rank]
                bits &= bits - 1
                low[w] = bits
                if not bits:
                    top &= top - 1
            if pair[i] != rank:
                continue  # stale
            j = end[i]
            end[i] = k = end[j]
            pair[j] = None
            pushes = []
            if k < n:
                before[k] = i
                pair[i] = new = rank_of(word[i:end[k]])
                if new is not None:
                    pushes.append((new, i))
            else:
                pair[i] = None
            h = before[i]
            if h >= 0:
                new = rank_of(word[h:k])
                if new != pair[h]:
                    pair[h] = new
                    if new is not None:
                        pushes.append((new, h))
            for rank, i in pushes:
                if rank in buckets:
                    heappush(buckets[rank], i)
                else:
                    buckets[rank] = [i]
                    w = rank >> 8
                    low[w] = low.get(w, 0) | 1 << (rank & 255)
                    top |= 1 << w
        out, i = [], 0
        while i < n:
            out.append(self.ranks[word[i:end[i]]])
            i = end[i]
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        words: dict[str, str] = {}
        parts = []
        for t in texts:
            found = self.split(t)
            parts.append(list(map(words.setdefault, found, found)))  # equal pre-tokens become one object
        self.remember(words)
        return [b"".join(map(self.cache.__getitem__, p)) for p in parts]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, memoryview(ids).cast("I")))


class _Packed(dict):
    """Pre-token to packed ids; those not kept are encoded when asked for."""

    def __init__(self, coder: Coder):
        super().__init__()
        self.coder = coder

    def __missing__(self, word: str) -> bytes:
        ids = self.coder.merge(word.encode())
        return struct.pack(f"<{len(ids)}I", *ids)


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a vocabulary file: a base64 token and its rank on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, *, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """Encode every whole text, decode the ids again, and give both.

    Returns ``id_col``, ``n_tokens`` long, ``ids`` binary (little-endian unsigned 32-bit), ``decoded`` binary. One row
    per input row, repeated rows and null ids included; null and empty texts give no ids and empty bytes. Other columns are
    ignored. ``ranks`` is a vocabulary (under 2 MB for 50,000 entries) and goes to executors as a broadcast variable.
    No shuffle. A task holds one batch of rows and a cache bounded by CACHE_ENTRIES and SHARED_BYTES.
    """
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(Coder(ranks, pattern))  # made once, on the driver

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_up()
        coder = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):  # the ids of a whole batch would be several times its text
                part = batch.slice(at, TEXTS)
                ids = coder.encode([x.as_py() or "" for x in part.column(1)])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary()),
                     pa.array([coder.decode(x) for x in ids], pa.binary())],
                    names=["id", "n_tokens", "ids", "decoded"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(lean(run), f"id {kind}, n_tokens long, ids binary, decoded binary").withColumnRenamed("id", id_col)
