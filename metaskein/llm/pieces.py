"""SentencePiece merge-type encoding by backtracking, and decoding.

A merge-type encoder joins the adjacent pair of best score until no pair is a piece. Its result is the one sequence of pieces in
which each piece, and each two neighbours, come out of that merging unchanged. So a text is encoded from the left: an Aho-Corasick
automaton finds the longest piece at each place, and it stands if it and the piece before it survive re-merging. If not, its next
shorter prefix is tried; where none is left, the place is marked as failed in a bitfield and the piece before gives way. A place has one
valid encoding of what lies before it, so it fails once for all, and the work is linear in the text.

Characters that no piece joins, directly or by others, are always parted: letters of one script and those of another, or letters and
punctuation. Texts are cut there first, and short runs that come again are remembered.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import held, lean, ship

#: Runs a worker remembers: at half as many new ones, the older ones not used since are forgotten. Pairs of neighbours it remembers; at
#: this many it starts afresh. Bounds memory only.
CACHE_RUNS, CACHE_PAIRS = 200_000, 150_000
#: Longer runs are not remembered, so that the cache is bounded in bytes too.
CACHE_CHARS = 64
#: Texts encoded together.
TEXTS = 512

# The white space symbol, what an undecodable byte becomes, and kinds of pieces in a model file.
SPACE = "▁"
BROKEN = "�"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6


@dataclass(frozen=True)
class Vocabulary:
    """Pieces of a model in order of their ids: text, score, kind."""

    pieces: tuple[tuple[str, float, int], ...]
    begin: int
    end: int
    unknown_text: str

    def digest(self) -> str:
        return hashlib.sha256(repr(self).encode("utf-8", "surrogatepass")).hexdigest()


def read_model(path: str) -> Vocabulary:
    """Vocabulary of a model file. Only what ``Pieces`` encodes exactly is accepted: merge type, bytes for unknown characters, a space
    put before the text, and no other normalisation. Anything else is an error."""
    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    trained, normal = model.trainer_spec, model.normalizer_spec
    pieces = tuple((p.piece, p.score, p.type) for p in model.pieces)
    plain = not normal.precompiled_charsmap and not normal.normalization_rule_tsv and normal.add_dummy_prefix \
        and normal.escape_whitespaces and not normal.remove_extra_whitespaces and not trained.treat_whitespace_as_suffix
    whole = {p for p, _, kind in pieces if kind == BYTE} == {f"<0x{b:02X}>" for b in range(256)}
    if trained.model_type != trained.BPE or not plain or not whole or {kind for *_, kind in pieces} - {NORMAL, UNKNOWN, CONTROL, BYTE}:
        raise ValueError(f"{path} is no merge-type model with byte fallback and identity normalisation")
    return Vocabulary(pieces, trained.bos_id, trained.eos_id, trained.unk_surface)


class Pieces:
    """Encodes and decodes with one vocabulary."""

    def __init__(self, vocabulary: Vocabulary):
        normal = {p: (i, score) for i, (p, score, kind) in enumerate(vocabulary.pieces) if kind == NORMAL}
        order = {score: k for k, score in enumerate(sorted({s for _, s in normal.values()}, reverse=True))}
        self.rank = {p: order[score] for p, (_, score) in normal.items()}
        self.ids = {p: struct.pack("<I", i) for p, (i, _) in normal.items()}
        self.bytes = [b""] * 256
        self.surface: list[bytes] = []
        self.raw: set[int] = set()
        for i, (p, _, kind) in enumerate(vocabulary.pieces):
            if kind == BYTE:
                self.bytes[int(p[3:5], 16)] = struct.pack("<I", i)
                self.raw.add(i)
            self.surface.append(bytes([int(p[3:5], 16)]) if kind == BYTE else b"" if kind == CONTROL
                                else vocabulary.unknown_text.encode() if kind == UNKNOWN else p.replace(SPACE, " ").encode())
        self.opens = {i for i, (p, _, kind) in enumerate(vocabulary.pieces) if kind == NORMAL and p.startswith(SPACE)}
        self.silent = {i for i, (_, _, kind) in enumerate(vocabulary.pieces) if kind == CONTROL}
        self.begin, self.end = struct.pack("<I", vocabulary.begin), struct.pack("<I", vocabulary.end)

        # A piece that merging its own characters does not give can be in no result.
        parted = {p: self.merged(p, 2) for p in self.rank if len(p) > 1}
        sound = {p: tuple(parts) for p, parts in parted.items() if len(parts) == 2}
        self.halves = sound
        # Ranks of the pieces, and -1 for single characters, that merging makes in the order of their ranks, which are theirs alone.
        alone = Counter(self.rank.values())
        self.formed = dict.fromkeys(chain.from_iterable(self.rank), -1)
        for p in sorted(sound, key=len):
            if alone[self.rank[p]] == 1 and all(half in self.formed and self.formed[half] < self.rank[p] for half in sound[p]):
                self.formed[p] = self.rank[p]
        self.automaton = ahocorasick.Automaton()
        for p in sound:
            self.automaton.add_word(p, (len(p) - 1, p))
        if sound:
            self.automaton.make_automaton()
        self.longer = bool(sound)
        self.shorter = {p: next((p[:k] for k in range(len(p) - 1, 1, -1) if p[:k] in sound), p[0]) for p in sound}
        self.cut = re.compile(self._runs()).findall
        self.pairs: dict[tuple[str, str], bool] = {}
        self.cache = _Packed(self)

    def _runs(self) -> str:
        """A pattern whose matches no piece crosses: characters that pieces join to each other, directly or by others, or one other."""
        several = [p for p in self.rank if len(p) > 1]
        joined = set().union(*several) if several else set()
        lead = SPACE in joined and not any(SPACE in p.lstrip(SPACE) for p in several)  # only ever at the beginning of a run
        kin = {c: {c} for c in sorted(joined - {SPACE} if lead else joined)}
        for p in several:
            inside = p.lstrip(SPACE) if lead else p
            for a, b in zip(inside, inside[1:]):
                if kin[a] is not kin[b]:
                    few, many = sorted((kin[a], kin[b]), key=len)
                    many |= few
                    kin.update(dict.fromkeys(few, many))
        groups = sorted({id(g): "".join(sorted(g)) for g in kin.values()}.values(), key=lambda g: (-len(g), g))
        choices = [f"{SPACE}*[{re.escape(g)}]+" if lead else f"[{re.escape(g)}]+" for g in groups]
        return "|".join([*choices, *[f"{SPACE}+"] * lead, r"[\s\S]"])

    def merged(self, text: str, least: int = 1) -> list[str]:
        """Merging as defined: the adjacent pair of best score first, of equals the leftmost, down to ``least`` parts. For short texts."""
        parts = list(text)
        while len(parts) > least:
            best, at = None, 0
            for k in range(len(parts) - 1):
                rank = self.rank.get(parts[k] + parts[k + 1])
                if rank is not None and (best is None or rank < best):
                    best, at = rank, k
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def fits(self, left: str, right: str) -> bool:
        """Whether two neighbours survive re-merging."""
        pair = (left, right)
        known = self.pairs.get(pair)
        if known is None:
            if len(self.pairs) >= CACHE_PAIRS:
                self.pairs.clear()
            known = self.pairs[pair] = self._apart(left, right) if left in self.formed and right in self.formed else self.merged(left + right) == [left, right]
        return known

    def _apart(self, left: str, right: str) -> bool:
        """The same where pieces form in the order of their ranks: undoes the merges at the border of the two, the last one first, and
        looks whether the parts that met there would have merged with each other before."""
        rank, formed, halves = self.rank.get, self.formed, self.halves
        before = None
        while True:
            whole = rank(left + right)
            if whole is not None and (before is None or whole < before):
                return False
            x, y = formed[left], formed[right]
            if x > y:
                before, left = x, halves[left][1]
            elif y >= 0:  # of equal ranks the left one is first
                before, right = y + 1, halves[right][0]
            else:
                return True

    def split(self, run: str) -> list[str]:
        """The pieces of a run, by backtracking; a character that is no piece stands for itself."""
        n = len(run)
        longest = list(run)
        if self.longer:
            for end, (back, piece) in self.automaton.iter(run):  # of one start the longest comes last
                longest[end - back] = piece
        # Mostly the longest pieces one after another are the result; where one does not fit, it goes on with backtracking.
        pairs, piece = self.pairs, longest[0]
        out, at = [piece], len(piece)
        while at < n:
            follows = longest[at]
            if not (pairs.get((piece, follows)) or self.fits(piece, follows)):
                break
            out.append(follows)
            at += len(follows)
            piece = follows
        else:
            return out
        failed = bytearray((n >> 3) + 1)
        piece = longest[at]
        while at < n:
            end = at + len(piece)
            if not failed[end >> 3] >> (end & 7) & 1 and (not out or self.fits(out[-1], piece)):
                out.append(piece)
                at = end
                piece = longest[at] if at < n else ""
            elif piece in self.shorter:
                piece = self.shorter[piece]
            else:
                failed[at >> 3] |= 1 << (at & 7)
                piece = out.pop()
                at -= len(piece)
        return out

    def packed(self, run: str) -> bytes:
        ids, parts = self.ids, self.split(run)
        try:
            return b"".join(map(ids.__getitem__, parts))
        except KeyError:  # a character that is no piece
            return b"".join(ids[p] if p in ids else b"".join(self.bytes[b] for b in p.encode("utf-8", "surrogatepass")) for p in parts)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers, with begin and end."""
        if not text:
            return self.begin + self.end
        runs = self.cut(SPACE + text.replace(" ", SPACE))
        if len(self.cache) >= CACHE_RUNS // 2:
            self.cache = _Packed(self, self.cache)
        return b"".join([self.begin, *map(self.cache.__getitem__, runs), self.end])

    def decode(self, ids: bytes) -> str:
        numbers = memoryview(ids).cast("I")
        text = b"".join(map(self.surface.__getitem__, numbers))
        first = next((i for i in numbers if i not in self.silent), None)
        if first in self.opens:
            text = text[1:]
        try:
            return text.decode()
        except UnicodeDecodeError:  # ids that no text has
            return self._decode_broken(list(numbers), first in self.opens)

    def _decode_broken(self, numbers: list[int], opens: bool) -> str:
        """Runs of byte pieces give the characters they hold, and BROKEN for each byte that belongs to none."""
        out, run = [], b""

        def characters(raw: bytes) -> Iterator[str]:
            at = 0
            while at < len(raw):
                for n in range(1, 5):
                    try:
                        yield raw[at:at + n].decode()
                    except UnicodeDecodeError:
                        continue
                    at += n
                    break
                else:
                    yield BROKEN
                    at += 1

        for i in numbers:
            if i in self.raw:
                run += self.surface[i]
            else:
                out.extend(characters(run))
                run = b""
                out.append(self.surface[i].decode())
        out.extend(characters(run))
        return "".join(out)[opens:]


class _Packed(dict):
    """Run to packed ids; long ones are encoded when asked for. ``older``: what was remembered before, of which the used comes over."""

    def __init__(self, pieces: Pieces, older: _Packed | None = None):
        super().__init__()
        self.pieces = pieces
        self.older: dict[str, bytes] = {} if older is None else older
        if older is not None:
            older.older = {}

    def __missing__(self, run: str) -> bytes:
        ids = self.older.get(run)
        if ids is None:
            ids = self.pieces.packed(run)
        if len(run) <= CACHE_CHARS and len(self) < 2 * CACHE_RUNS:
            self[run] = ids
        return ids


def encode(docs: DataFrame, vocabulary: Vocabulary, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every whole text with begin and end ids, decode the ids again, and give both.

    Returns ``id_col``, ``n_tokens`` long (all ids), ``ids`` binary (little-endian unsigned 32-bit), ``decoded`` string. One row per
    input row, repeated rows and null ids included; null and empty texts give the two ids and an empty text. Decoding is that of the
    model: the white space symbol, where a text holds it, comes back as a space. Other columns are ignored. The vocabulary (about 1 MB for 32,000
    pieces) goes to executors as a broadcast variable. No shuffle. A task holds one batch of rows and caches bounded by
    CACHE_RUNS, CACHE_PAIRS and CACHE_CHARS; a run of n characters without a cut takes about 16 n bytes while it is encoded.
    """
    spark = docs.sparkSession
    ship(spark)
    key, shared = vocabulary.digest(), spark.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = held("pieces", key, lambda: Pieces(shared.value))
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):  # the ids of a whole batch would be several times its text
                part = batch.slice(at, TEXTS)
                ids = [pieces.encode(x.as_py() or "") for x in part.column(1)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary()),
                     pa.array(map(pieces.decode, ids), pa.string())],
                    names=["id", "n_tokens", "ids", "decoded"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(lean(run), f"id {kind}, n_tokens long, ids binary, decoded string").withColumnRenamed("id", id_col)
