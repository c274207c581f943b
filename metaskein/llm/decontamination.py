"""Benchmark decontamination with one Aho-Corasick automaton over normalised item windows.

Items and documents are lower-cased (A-Z) and cut into words of digits, letters and any character beyond ASCII. The
automaton's alphabet is the benchmark's words, so an automaton match ends at a document word, and the word's place in
the original text gives the span. Each text is scanned once by each automaton.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import held, lean, ship

#: Benchmark bytes in one automaton (about ten nodes a word). A larger benchmark gets several automata, one after the other.
BLOCK_BYTES = 2_000_000

#: Fixed value: what a word is, after lower-casing.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
IN_ORIGINAL = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")  # the same before lower-casing
_to_words = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_to_words).split()


class Scanner:
    """An automaton over the windows of some items: (item id, words) pairs."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        owners: dict[tuple[int, ...], set[str]] = {}
        self.codes: dict[bytes, int] = {}
        for item, text in items:
            coded = tuple(self.codes.setdefault(w, len(self.codes) + 1) for w in words_of(text))
            for at in range(max(1, len(coded) - window + 1) if coded else 0):
                owners.setdefault(coded[at:at + window], set()).add(item)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for key, ids in owners.items():
            self.automaton.add_word(key, (len(key), ids))
        self.empty = not owners
        if owners:
            self.automaton.make_automaton()

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Word intervals of all occurrences, and the items they come from."""
        if self.empty or not words:
            return [], set()
        code = self.codes.get
        hits, items = [], set()
        for end, (n, ids) in self.automaton.iter(tuple([code(w, 0) for w in words])):
            hits.append((end + 1 - n, end + 1))
            items |= ids
        return hits, items


def union(hits: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(hits):
        if out and a <= out[-1][1]:
            if b > out[-1][1]:
                out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def _scanner(key: str, items: list[tuple[str, str]], window: int) -> Scanner:
    return held("decontamination", key, lambda: Scanner(items, window), most=2)


def find_contamination(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                       item_id_col: str = "item_id", item_text_col: str = "text", window: int = 10,
                       block_bytes: int = BLOCK_BYTES, keep_text: bool = False) -> DataFrame:
    """Occurrences of the items' windows in every whole text.

    Returns ``id_col``, ``n_words`` long, ``n_hit`` long (words inside any occurrence), ``items`` array of item ids as
    strings, sorted, and ``spans`` array of (start, end) in code points of the original text, merged. One row per
    input row; null and empty texts have no words. An item with fewer words than ``window`` is one window, one with
    none is ignored; equal items count each under its own id, equal ids once. Null item ids are ignored. Other columns
    are ignored; ``keep_text`` gives the text back, as ``text``. No shuffle of documents.

    The benchmark is split by item hash into blocks of about ``block_bytes`` (its size is measured first). Only one block
    is on the driver at a time, and each is one pass of the same job that adds to what the passes before it found.
    """
    spark = docs.sparkSession
    ship(spark)
    bench = items.select(F.col(item_id_col).cast("string").alias("item"), F.col(item_text_col).cast("string").alias("words"))
    bench = bench.where("item is not null and words is not null")
    total = bench.agg(F.sum(F.octet_length("words") + 16)).first()[0] or 0
    blocks = -(-total // block_bytes) or 1
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    intervals = "array<struct<start:int,end:int>>"
    rows = rows.select("id", "text", F.array().cast(intervals).alias("hits"), F.array().cast("array<string>").alias("items"))
    for block in range(blocks):
        part = bench if blocks == 1 else bench.where(F.pmod(F.xxhash64("item", "words"), F.lit(blocks)) == block)
        pairs = sorted({(r.item, r.words) for r in part.collect()})  # bounded: block_bytes
        key = hashlib.sha256(repr((window, pairs)).encode("utf-8", "surrogatepass")).hexdigest()
        rows = rows.mapInArrow(
            lean(_pass(spark.sparkContext.broadcast(pairs), key, window, block == blocks - 1, keep_text)),
            f"id {kind}, n_words long, n_hit long, items array<string>, spans {intervals}" + ", text string" * keep_text if block == blocks - 1
            else f"id {kind}, text string, hits {intervals}, items array<string>")
    return rows.withColumnRenamed("id", id_col)


def _pass(shared, key: str, window: int, last: bool, keep_text: bool):
    interval = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    as_rows = lambda pairs: [{"start": a, "end": b} for a, b in pairs]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _scanner(key, shared.value, window)
        for batch in batches:
            n_words, hits, found, spans = [], [], [], []
            for text, old_hits, old_items in zip(*(batch.column(k) for k in (1, 2, 3)), strict=True):
                text = text.as_py()
                words = words_of(text)
                mine, items = scanner.scan(words)
                mine = union(mine + [(x["start"], x["end"]) for x in old_hits.as_py()])
                n_words.append(len(words))
                hits.append(mine)
                found.append(sorted(items.union(old_items.as_py())))
                if last:
                    at = [m.span() for m in IN_ORIGINAL.finditer(text)] if mine else []
                    spans.append([(at[a][0], at[b - 1][1]) for a, b in mine])
            items = pa.array(found, pa.list_(pa.string()))
            if last:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(n_words, pa.int64()), pa.array([sum(b - a for a, b in h) for h in hits], pa.int64()),
                     items, pa.array([as_rows(x) for x in spans], interval), *[batch.column(1)] * keep_text],
                    names=["id", "n_words", "n_hit", "items", "spans", *["text"] * keep_text])
            else:
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([as_rows(h) for h in hits], interval), items],
                                                 names=["id", "text", "hits", "items"])
    return run
