"""Language identification by cross-parsing entropy.

For each language a suffix automaton holds every substring of a sample of its labelled text. A document is parsed
greedily: each phrase is the longest match with the language's text. Few phrases mean a close language; the count is
normalised by the logarithm of the sample's length, so that samples of different sizes compare. Many documents are
parsed in step with each other, one letter at a time, by looking up arrays; the few longest are finished one by one.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .runtime import give_up, lean, ship

#: Letters of sample text for each language, and of all languages; the second is shared equally where there are many.
#: They bound the model: a letter has two states and three transitions at most, of 8 bytes and a little more.
SAMPLE_CHARS, MODEL_CHARS = 40_000, 4_000_000
#: Labelled documents for each language that the sample is taken from, and letters taken from one of them.
SAMPLE_DOCS = 100
SAMPLE_PIECE = 2_000
#: Texts of a batch parsed together; once no more than so many go on, each is finished on its own.
TEXTS, FEW = 4_000, 24

UNKNOWN = "und"


class Automaton:
    """Transitions of a suffix automaton, states' rows laid into each other's gaps: two lookups find one.

    ``owner[base[state] + code]`` is the state if it has a transition for the code, which then leads to ``target`` at the same place.
    State 0 has none, 1 is the start.
    """

    def __init__(self, following: list[dict[int, int]], width: int):
        n = len(following)
        self.base = np.zeros(n, np.int32)
        size = sum(map(len, following)) + 2 * width
        used, owner, target = bytearray(size), np.full(size, -1, np.int32), np.zeros(size, np.int32)
        low, tries = 0, {}
        for state in sorted(range(n), key=lambda s: -len(following[s])):
            codes = sorted(following[state])
            if not codes:
                continue
            # Rows of several codes go on where the last of their size found a gap; rows of one fill what is left.
            at = low if len(codes) == 1 else tries.get(len(codes), 0)
            while True:
                at = used.find(0, at)
                if at < 0 or at - codes[0] + codes[-1] >= len(used):
                    at = max(at, 0) if at >= 0 else len(used)
                    more = len(used) // 2 + 2 * width
                    used.extend(bytes(more))
                    owner, target = np.append(owner, np.full(more, -1, np.int32)), np.append(target, np.zeros(more, np.int32))
                    continue
                b = at - codes[0]
                if b >= 0 and not any(used[b + c] for c in codes):
                    break
                at += 1
            self.base[state] = b
            for c in codes:
                used[b + c] = 1
                owner[b + c], target[b + c] = state, following[state][c]
            tries[len(codes)] = at
            low = used.find(0, low)
        end = int(self.base.max(initial=0)) + width
        short = max(0, end - len(owner))
        self.owner = np.append(owner, np.full(short, -1, np.int32))[:end]
        self.target = np.append(target, np.zeros(short, np.int32))[:end]
        self.first = np.array([self[1, c] for c in range(width)], np.int32)

    def __getitem__(self, at: tuple[int, int]) -> int:
        place = int(self.base[at[0]]) + at[1]
        return int(self.target[place]) if self.owner[place] == at[0] else 0


def suffix_automaton(codes: list[int], width: int) -> Automaton:
    """The automaton of all substrings."""
    following: list[dict[int, int]] = [{}, {}]
    link, length = [0, 0], [0, 0]
    last = 1
    for c in codes:
        new = len(following)
        following.append({})
        length.append(length[last] + 1)
        link.append(1)
        p = last
        while p and c not in following[p]:
            following[p][c] = new
            p = link[p]
        if p:
            q = following[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                copy = len(following)
                following.append(following[q].copy())
                length.append(length[p] + 1)
                link.append(link[q])
                while p and following[p].get(c) == q:
                    following[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    return Automaton(following, width)


class Parser:
    """Automata of all languages, made on the driver, and the parse of many texts at once."""

    def __init__(self, samples: list[tuple[str, str]]):
        counts = Counter(c for _, text in samples for c in text.lower() if c.isalpha())
        letters = sorted(counts, key=lambda c: (-counts[c], c))
        # 0: a letter that no sample has, 1: anything that is no letter, from 2 on: the letters.
        self.width = len(letters) + 2
        self.code = np.ones(0x110000, np.min_scalar_type(self.width))
        for i, c in enumerate(letters):
            self.code[[ord(c), *(ord(x) for x in (c.upper(), c.title()) if len(x) == 1)]] = i + 2
        self.languages = [name for name, _ in samples]
        coded = [self.codes(text) for _, text in samples]
        self.weights = np.array([math.log2(max(2, len(c))) for c in coded])
        automata = [suffix_automaton(c.tolist(), self.width) for c in coded]
        # One set of arrays for all languages, so that a step is one lookup for all of them. State 0 stays the one that leads nowhere.
        states, places = (np.cumsum([0, *(len(x) for x in xs)])[:-1] for xs in ([a.base for a in automata], [a.owner for a in automata]))
        joined = lambda parts: np.concatenate([np.zeros(0, np.int32), *parts]).astype(np.int32)
        self.base = joined([a.base + p for a, p in zip(automata, places.tolist(), strict=True)])
        self.owner = joined([np.where(a.owner > 0, a.owner + n, -1) for a, n in zip(automata, states.tolist(), strict=True)])
        self.target = joined([np.where(a.owner > 0, a.target + n, 0) for a, n in zip(automata, states.tolist(), strict=True)])
        self.first = np.array([np.where(a.first > 0, a.first + n, 0) for a, n in zip(automata, states.tolist(), strict=True)], np.int32)

    def codes(self, text: str) -> np.ndarray:
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        coded = self.code[points]
        odd = np.flatnonzero(coded == 1)
        foreign = odd[points[odd] > 127]
        for i in foreign.tolist():  # letters that no sample has; few where a language is known
            if chr(points[i]).isalpha():
                coded[i] = 0
        # One separator for a run of them: layout says nothing about language.
        keep = np.ones(len(coded), bool)
        keep[1:] = (coded[1:] != 1) | (coded[:-1] != 1)
        return coded[keep]

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """Phrase counts [text, language]."""
        total = np.zeros((len(texts), len(self.languages)), np.int64)
        order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
        sizes = np.array([len(texts[i]) for i in order], np.int64)
        if not self.languages or not len(sizes) or not sizes[0]:
            return total
        flat = np.concatenate([texts[i] for i in order])
        start = np.cumsum(sizes) - sizes
        steps = int(sizes[FEW]) if len(sizes) > FEW else 0
        active = np.searchsorted(-sizes, -np.arange(steps), side="left")  # texts longer than the step
        state, count = np.zeros((len(self.languages), len(order)), np.int32), np.zeros((len(self.languages), len(order)), np.int64)
        # State 0 leads nowhere: the next character begins a phrase. So does the one after a character the language lacks.
        for step, n in enumerate(active.tolist()):
            column = flat[start[:n] + step]
            now = state[:, :n]
            place = self.base[now] + column
            goes_on = self.owner[place] == now
            count[:, :n] += ~goes_on
            state[:, :n] = np.where(goes_on, self.target[place], self.first[:, column])
        for k in range(min(FEW, len(order))):
            if sizes[k] > steps:
                rest = flat[start[k] + steps:start[k] + sizes[k]]
                for language in range(len(self.languages)):
                    count[language, k] += self._finish(language, int(state[language, k]), rest)
        total[order] = count.T
        return total

    def _finish(self, language: int, state: int, rest: np.ndarray) -> int:
        """Phrases begun in the rest of one text."""
        base, owner, target, first = map(memoryview, (self.base, self.owner, self.target, self.first[language]))
        count = 0
        for c in memoryview(rest):
            place = base[state] + c
            if owner[place] == state:
                state = target[place]
            else:
                count += 1
                state = first[c]
        return count

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        names, scores = [], []
        coded = [self.codes(t or "") for t in texts]
        has_letter = [bool((c != 1).any()) for c in coded]
        counts = self.phrases([c if ok else c[:0] for c, ok in zip(coded, has_letter, strict=True)])
        for row, ok in zip(counts, has_letter, strict=True):
            if not ok or not self.languages:
                names.append(UNKNOWN)
                scores.append(0.0)
                continue
            cost = row * self.weights
            order = sorted(range(len(cost)), key=lambda k: (cost[k], self.languages[k]))
            names.append(self.languages[order[0]])
            scores.append(float(1 - cost[order[0]] / cost[order[1]]) if len(order) > 1 else 1.0)
        return names, scores


def sample(labelled: DataFrame, *, text_col: str = "text", lang_col: str = "lang", docs: int = SAMPLE_DOCS,
           chars: int = SAMPLE_CHARS) -> list[tuple[str, str]]:
    """(language, text) of at most ``docs`` documents and ``chars`` characters each, chosen by hash of the text.

    The rank filter is applied in each task before the shuffle, so a language with most rows costs no more. Where there are more than
    MODEL_CHARS / ``chars`` languages, each gives its equal share of MODEL_CHARS, so that what the driver collects is bounded.
    """
    rows = labelled.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    rows = rows.where("lang is not null and text is not null and text rlike '[\\\\p{L}]'")
    order = Window.partitionBy("lang").orderBy("hash", "text")
    chosen = rows.select("lang", F.xxhash64("text").alias("hash"), F.substring("text", 1, SAMPLE_PIECE).alias("text")) \
        .withColumn("n", F.row_number().over(order)).where(F.col("n") <= docs).groupBy("lang") \
        .agg(F.substring(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "text"))), lambda x: x.text), "\n"), 1, chars).alias("text"))
    languages = rows.select("lang").distinct().count()
    chars = min(chars, max(1, MODEL_CHARS // max(1, languages)))
    chosen = chosen.select("lang", F.substring("text", 1, chars).alias("text"))
    return sorted((r.lang, r.text) for r in chosen.collect())


def held_out(id_col: str | Column) -> Column:
    """Documents that nothing is learned from: crc32 of the id as text leaves 1 by 3. Null ids are not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def identify(docs: DataFrame, samples: list[tuple[str, str]], *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Language of every whole text.

    Returns the input's columns with ``lang_pred`` string and ``score`` double (0 to 1: share of phrases that the
    winner saves against the next). ``und`` and 0 where the text is null, empty or has no letter, or nothing was
    learned. Equal counts go to the language first by name. One row per input row; the text alone decides, so repeated
    rows agree. Columns named lang_pred or score are replaced. No shuffle.
    """
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(Parser(samples))
    kept = docs.drop("lang_pred", "score")
    at = kept.columns.index(text_col)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields) + ", lang_pred string, score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_up()
        parser = shared.value
        for batch in batches:
            for start in range(0, batch.num_rows, TEXTS):
                part = batch.slice(start, TEXTS)
                names, scores = parser.predict([None if (v := x.as_py()) is None else str(v) for x in part.column(at)])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                                                 names=[*part.schema.names, "lang_pred", "score"])

    return kept.mapInArrow(lean(run), schema)
