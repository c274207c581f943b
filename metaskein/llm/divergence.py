"""Divergence between the sources of a language: which of their vocabularies differ, and by which terms.

A term's share in a source depends on nothing but its count there, so terms fall into cells of equal counts. The divergence of a term is
evaluated once for a cell and weighed by the number of its terms. Cells are ranked by what the cells before them hold, cells of equal
value become one, and only the cells within the limit are expanded into their terms. All numbers are integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .runtime import lean, ship, stored

#: Bytes of distinct terms a task counts before it sends them. Bounds memory only.
TERM_BYTES = 16_000_000
#: Texts looked at together.
TEXTS = 500

# What a term byte is, after lower-casing A-Z, and the scale of a share.
_to_terms = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))
SCALE = 1_000_000_000

_COUNTS = "lang string, source string, term string, n long, docs long"


class _Counts:
    """Occurrences and documents of terms by group, of the texts of a task."""

    def __init__(self) -> None:
        self.code: dict[bytes, int] = {}
        self.groups: dict[tuple[str, str], int] = {}
        self.bytes = 0
        self.parts: list[np.ndarray] = []

    def add(self, langs: list[str], sources: list[str], texts: list[bytes]) -> None:
        group = np.fromiter((self.groups.setdefault(k, len(self.groups)) for k in zip(langs, sources, strict=True)), np.int64, len(texts))
        words: list[bytes] = []
        sizes = np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            found = text.translate(_to_terms).split()
            sizes[i] = len(found)
            words += found
        for w in set(words).difference(self.code):
            self.code[w] = len(self.code)
            self.bytes += len(w)
        codes = np.fromiter(map(self.code.__getitem__, words), np.int64, len(words))
        # (text, term) once each with its count, then (group, term) with the counts' sum and number.
        keys, n = np.unique(np.repeat(np.arange(len(texts)), sizes) << 32 | codes, return_counts=True)
        self.parts.append(self._summed(group[keys >> 32] << 32 | keys & 0xFFFFFFFF, n, np.ones(len(n), np.int64)))

    @staticmethod
    def _summed(keys: np.ndarray, n: np.ndarray, docs: np.ndarray) -> np.ndarray:
        order = np.argsort(keys, kind="stable")
        keys, n, docs = keys[order], n[order], docs[order]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
        return np.array([keys[first], np.add.reduceat(n, first), np.add.reduceat(docs, first)]) if len(first) else np.zeros((3, 0), np.int64)

    def pack(self) -> None:
        """Makes one part of all."""
        if len(self.parts) > 1:
            self.parts = [self._summed(*np.concatenate(self.parts, axis=1))]

    def sent(self) -> Iterator[pa.RecordBatch]:
        """All counts, and each group once without a term; starts afresh."""
        self.pack()
        keys, n, docs = self.parts[0] if self.parts else np.zeros((3, 0), np.int64)
        langs, sources = (pa.array([g[k] for g in self.groups], pa.string()) for k in (0, 1))
        terms = pa.array(list(self.code), pa.binary()).cast(pa.string())
        none = len(self.groups)
        names = ["lang", "source", "term", "n", "docs"]
        yield pa.RecordBatch.from_arrays([langs, sources, pa.nulls(none, pa.string()), pa.array([0] * none, pa.int64()), pa.array([0] * none, pa.int64())], names=names)
        for at in range(0, len(keys), 50_000):
            k = keys[at:at + 50_000]
            yield pa.RecordBatch.from_arrays([langs.take(pa.array(k >> 32)), sources.take(pa.array(k >> 32)), terms.take(pa.array(k & 0xFFFFFFFF)),
                                              pa.array(n[at:at + 50_000]), pa.array(docs[at:at + 50_000])], names=names)
        self.__init__()


def term_counts(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """Occurrences ``n`` and documents ``docs`` of each term of each (lang, source); a row with a null term for each group."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _Counts()
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                counts.add(part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2).cast(pa.large_binary()).to_pylist())
                if len(counts.parts) >= 32:
                    counts.pack()
                if counts.bytes > TERM_BYTES:
                    yield from counts.sent()
        yield from counts.sent()

    plain = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))]
    return docs.select(plain).mapInArrow(lean(run), _COUNTS).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE (count + 1) / (total + terms)), exactly."""
    wide = lambda c: c.cast("decimal(28,0)")
    return F.lit(1).cast("long") + F.call_function("div", F.lit(SCALE).cast("decimal(10,0)") * wide(count + 1), wide(total + terms))


def divergence(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q). Shares are at most SCALE + 1, so the square fits a long."""
    return F.call_function("div", (p - q) * (p - q), q)


def audit(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", least_docs: int = 3, top: int = 200) -> DataFrame:
    """Divergence of each (lang, source) from the other sources of its language, and the terms that it favours most.

    A lang's terms are those in at least ``least_docs`` of its documents. Returns ``lang``, ``source``, ``part``, ``item``, ``value`` long,
    ``rank`` int. Part ``pair``: a row for each other source of the lang, its value the sum over all terms. Part ``term``: the terms with a larger
    share in the source than in the whole lang, down to rank ``top``. Ranks run by value descending, then item in UTF-8 order.
    Null text, lang and source are empty strings; a group without terms still has its ``pair`` rows; a lang of one source has none.
    Repeated rows count each. An empty table gives no rows. Other columns are ignored.

    Each task sends its counts summed. Shuffles: (lang, source, term) counts, then cells. A term that two sources share is
    joined once for the two and summed into a cell in the same task; terms that a source lacks are told from the sums. No group of
    terms is collected: the first ``top`` values of a group are found by partial limits in each task.
    """
    keys = ["lang", "source"]
    counts = stored(term_counts(docs, text_col=text_col, lang_col=lang_col, source_col=source_col))
    groups = counts.where("term is null").select(keys)
    terms = counts.where("term is not null")
    kept = terms.groupBy("lang", "term").agg(F.sum("n").alias("n_lang"), F.sum("docs").alias("docs")).where(F.col("docs") >= least_docs).drop("docs")
    found = stored(terms.drop("docs").join(kept, ["lang", "term"]))
    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("n_lang").alias("all_lang"))
    of_group = found.groupBy(keys).agg(F.sum("n").alias("all"), F.count("*").alias("present"))
    zero = lambda *names: [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in names]
    groups = stored(groups.join(of_group, keys, "left").join(langs, "lang", "left").select(*keys, *zero("all", "present", "v", "all_lang")))
    return _terms(found, groups, keys, top).union(_pairs(found, groups, keys))


def _terms(found: DataFrame, groups: DataFrame, keys: list[str], top: int) -> DataFrame:
    cells = found.groupBy(*keys, "n", "n_lang").agg(F.count("*").alias("size")).join(groups, keys)
    cells = cells.withColumn("p", share(F.col("n"), F.col("all"), F.col("v"))).withColumn("q", share(F.col("n_lang"), F.col("all_lang"), F.col("v")))
    cells = stored(cells.where("p > q").select(*keys, "n", "n_lang", "size", divergence(F.col("p"), F.col("q")).alias("value")))
    by_value = Window.partitionBy(*keys).orderBy(F.desc("value"))
    # A value has at least one term, so none beyond the first ``top`` values of a group is within the limit.
    values = cells.groupBy(*keys, "value").agg(F.sum("size").alias("size")).withColumn("k", F.row_number().over(by_value)).where(F.col("k") <= top)
    before = F.sum("size").over(by_value.rowsBetween(Window.unboundedPreceding, -1))
    values = values.withColumn("before", F.coalesce(before, F.lit(0))).where(F.col("before") < top).select(*keys, "value", "before")
    inside = cells.join(values, [*keys, "value"]).select(*keys, "n", "n_lang", "value", "before")
    expanded = found.join(inside, [*keys, "n", "n_lang"])
    in_value = F.row_number().over(Window.partitionBy(*keys, "value", "before").orderBy("term"))
    ranked = expanded.withColumn("k", in_value).where(F.col("k") <= top).withColumn("rank", (F.col("before") + F.col("k")).cast("int")).where(F.col("rank") <= top)
    return ranked.select(*keys, F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")


def _pairs(found: DataFrame, groups: DataFrame, keys: list[str]) -> DataFrame:
    named = lambda a: groups.select("lang", F.col("source").alias(a), F.col("all").alias(f"{a}_all"), F.col("present").alias(f"{a}_present"), *["v"] * (a == "x"))
    pairs = stored(named("x").join(named("y"), "lang").where("x != y"))  # as many rows as the result has
    x, y = (found.select("lang", "term", F.col("source").alias(a), F.col("n").alias(f"{a}_n")) for a in "xy")
    # Terms that both have, once for the two sources; the cells of the other direction are the same, turned round.
    both = stored(x.join(y, ["lang", "term"]).where("x < y").groupBy("lang", "x", "y", "x_n", "y_n").agg(F.count("*").alias("size")))
    both = both.union(both.select("lang", F.col("y").alias("x"), F.col("x").alias("y"), F.col("y_n").alias("x_n"), F.col("x_n").alias("y_n"), "size"))
    shared = F.count("*")
    single = stored(found.groupBy(*keys, F.col("n")).agg(shared.alias("size")))
    none = F.lit(0).cast("long")
    number = F.col("size").cast("decimal(38,0)")
    # All terms = those of x alone, of y alone, of both and of neither. The first two are all of x or y less those of both.
    only_x = pairs.select("lang", "x", "y").join(single.select("lang", F.col("source").alias("x"), F.col("n").alias("x_n"), "size"), ["lang", "x"])
    only_y = pairs.select("lang", "x", "y").join(single.select("lang", F.col("source").alias("y"), F.col("n").alias("y_n"), "size"), ["lang", "y"])
    cells = both.select("lang", "x", "y", "x_n", "y_n", number.alias("size")) \
        .union(both.select("lang", "x", "y", "x_n", none, -number)).union(both.select("lang", "x", "y", none, "y_n", -number)).union(both.select("lang", "x", "y", none, none, number)) \
        .union(only_x.select("lang", "x", "y", "x_n", none, number)).union(only_y.select("lang", "x", "y", none, "y_n", number)) \
        .union(pairs.select("lang", "x", "y", none, none, (F.col("v") - F.col("x_present") - F.col("y_present")).cast("decimal(38,0)")))
    cells = cells.groupBy("lang", "x", "y", "x_n", "y_n").agg(F.sum("size").cast("decimal(19,0)").alias("size")).where("size != 0")
    cells = cells.join(pairs, ["lang", "x", "y"])
    p, q = share(F.col("x_n"), F.col("x_all"), F.col("v")), share(F.col("y_n"), F.col("y_all"), F.col("v"))
    value = F.sum(divergence(p, q).cast("decimal(19,0)") * F.col("size")).cast("long")
    summed = pairs.select("lang", "x", "y").join(cells.groupBy("lang", "x", "y").agg(value.alias("value")), ["lang", "x", "y"], "left")
    summed = summed.select("lang", F.col("x").alias("source"), F.lit("pair").alias("part"), F.col("y").alias("item"), F.coalesce("value", none).alias("value"))
    return summed.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("value"), "item")))
