"""Importance resampling, the divergence audit and piece encoding against brute-force versions."""

import math
import random
import re
import struct
import zlib
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from test_operators import docs_of, prose, sha

from metaskein.llm import divergence, importance, pieces, queries

# --- importance resampling --------------------------------------------------------


def test_crcs_by_matrices():
    r = random.Random(1)
    features = [r.randbytes(n) for n in [*range(70)] * 3 + [1023, 1024, 1025, 4000]]
    assert importance.crc32(features).tolist() == [zlib.crc32(f) for f in features]
    assert importance.crc32([]).tolist() == []


def features_of(text, words=1):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return w, [" ".join(w[i:i + n]) for n in range(1, words + 1) for i in range(len(w) - n + 1)]


def resampled(docs, target, buckets, words, least, percent):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = (Counter(bucket(f) for x in texts for f in features_of(x, words)[1]) for texts in ([x for _, x in docs], target))
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets)))) for b in range(buckets)]
    rows = []
    for i, x in docs:
        w, f = features_of(x, words)
        weight = sum(gain[bucket(y)] for y in f)
        h = int(sha(f"2024:{'' if i is None else i}")[:8], 16)
        rows.append((i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(w)))
    able = sorted((x for x in rows if x[4] >= least), key=lambda x: (-x[3], x[0] is not None, x[0] or 0, x[2], x[1]))
    drawn = percent * len(able) // 100
    out = Counter((*x[:4], k + 1 if k < drawn else None) for k, x in enumerate(able))
    return out + Counter((*x[:4], None) for x in rows if x[4] < least)


TARGET = ["Quick tests of WORDS", "words words", None, ""]


@pytest.mark.parametrize(("buckets", "words", "least", "percent"), [(10_000, 1, 20, 10), (7, 3, 2, 50), (50, 2, 0, 100)])
def test_resampling(spark, monkeypatch, buckets, words, least, percent):
    monkeypatch.setattr(importance, "CACHE_FEATURES", 40)
    docs = [(i, prose(i, 5 + i)) for i in range(60)] + [(100, None), (101, ""), (102, "- _ !"), (103, "Ünï Çödé 123 x" * 9), (104, "w" * 3000 + " a" * 30)]
    docs += [(200, prose(1, 40))] * 7 + [(None, prose(2, 50)), (-1, "same words " * 20), (-1, "same words " * 20)] + [(300 + i, "tie " * 30) for i in range(20)]
    target = spark.createDataFrame([(x, 1) for x in TARGET], "text string, bucket long")
    got = importance.resample(docs_of(spark, docs), target, buckets=buckets, words=words, least_words=least, percent=percent)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert Counter(map(tuple, got.collect())) == resampled(docs, TARGET, buckets, words, least, percent)


def test_resampling_without_rows(spark):
    docs, target = docs_of(spark, [(1, prose(1, 30))]), spark.createDataFrame([("x",)], "text string")
    assert importance.resample(docs.limit(0), target).count() == 0
    assert [tuple(r) for r in importance.resample(docs, target.limit(0), percent=100).collect()] == list(resampled([(1, prose(1, 30))], [], 10_000, 1, 20, 100))


# --- divergence audit -------------------------------------------------------------


def audited(rows, least, top):
    """The definition: every term of every group."""
    rows = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))) for lang, source, text in rows]
    out = Counter()
    for lang in {r[0] for r in rows}:
        here = [r for r in rows if r[0] == lang]
        in_docs = Counter(t for r in here for t in set(r[2]))
        kept = [t for t in in_docs if in_docs[t] >= least]
        count = {s: Counter(t for r in here if r[1] == s for t in r[2]) for s in {r[1] for r in here}}
        whole = sum(count.values(), Counter())
        def shares(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (c[t] + 1) // (n + len(kept)) for t in kept}
        p, q = {s: shares(c) for s, c in count.items()}, shares(whole)
        f = lambda a, b: (a - b) ** 2 // b
        for s in count:
            pairs = {o: sum(f(p[s][t], p[o][t]) for t in kept) for o in count if o != s}
            terms = {t: f(p[s][t], q[t]) for t in kept if count[s][t] and p[s][t] > q[t]}
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                ranked = sorted(found.items(), key=lambda x: (-x[1], x[0].encode()))[:most]
                out.update((lang, s, part, item, value, k + 1) for k, (item, value) in enumerate(ranked))
    return out


@pytest.mark.parametrize(("least", "top", "small"), [(3, 200, False), (1, 5, True), (2, 1, False), (1000, 9, False)])
def test_audit(spark, monkeypatch, least, top, small):
    if small:  # counts sent many times a task
        monkeypatch.setattr(divergence, "TERM_BYTES", 50)
        monkeypatch.setattr(divergence, "TEXTS", 3)
    r = random.Random(least)
    rows = [(r.choice(["en", "de", None, ""]), r.choice(["a", "b", "ç", "Z", None]), prose(r.randint(0, 9), r.randint(0, 60), 120)) for _ in range(150)]
    rows += [("en", "hot", "spam Spam SPAM 123 ünï " * 400)] * 50 + [("en", "none", None), ("en", "empty", ""), ("one", "alone", "w w w"), ("x", "p", None), ("x", "q", "12 34")]
    rows += [("en", "a", "tie" + chr(97 + i)) for i in range(26) for _ in range(3)] + [("en", "long", "z" * 200_000)]
    df = spark.createDataFrame([(*x, 1, 2, "t") for x in rows], "lang string, source string, text string, n long, v long, term string")
    got = divergence.audit(df, least_docs=least, top=top)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert Counter(map(tuple, got.collect())) == audited(rows, least, top)
    assert divergence.audit(df.limit(0)).count() == 0


def test_large_counts_stay_exact(spark):
    """Shares of counts whose scaled value is beyond a long."""
    big = 10 ** 13
    df = spark.createDataFrame([(big, 3 * big + 1, 7), (0, 2 ** 62, 1)], "n long, total long, v long")
    got = [r[0] for r in df.select(divergence.share(df.n, df.total, df.v)).collect()]
    assert got == [1 + 1_000_000_000 * (n + 1) // (t + v) for n, t, v in [(big, 3 * big + 1, 7), (0, 2 ** 62, 1)]]


# --- pieces -----------------------------------------------------------------------

MODEL = public_tokenizers.path(queries.PIECES)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def coder():
    return pieces.Pieces(pieces.read_model(MODEL))


def numbers(ids):
    return list(struct.unpack(f"<{len(ids) // 4}I", ids))


def test_pieces_are_those_of_the_library(coder, library):
    r = random.Random(1)
    known = [p for p, _, kind in pieces.read_model(MODEL).pieces if kind == pieces.NORMAL]
    texts = ["".join(r.choice("aaabcdeehilnorst  ▁\n\t01é日語のab́<s>[]ß😀\x00") for _ in range(r.randint(0, 40))) for _ in range(2_000)]
    texts += ["".join(r.choice(known) for _ in range(r.randint(0, 12))) for _ in range(2_000)]
    texts += ["a" * 20_000, " " * 3_000, "ab" * 9_000, "日本" * 9_000, "".join(r.choice("aeinrst") for _ in range(30_000)), "<0x0A></s>", "▁", " ▁ "]
    for text in texts:
        ids = library.encode(text, add_bos=True, add_eos=True)
        assert numbers(coder.encode(text)) == ids
        assert coder.decode(coder.encode(text)) == library.decode(ids)


def test_any_ids_decode_as_in_the_library(coder, library):
    r = random.Random(2)
    for _ in range(3_000):
        ids = [r.randrange(32_000) if r.random() < 0.5 else r.randrange(259) for _ in range(r.randint(0, 12))]
        assert coder.decode(struct.pack(f"<{len(ids)}I", *ids)) == library.decode(ids)


def vocabulary_of(scores):
    """A small one: pieces by score, after the special ones and bytes."""
    fixed = [("<unk>", 0.0, pieces.UNKNOWN), ("<s>", 0.0, pieces.CONTROL), ("</s>", 0.0, pieces.CONTROL)] + [(f"<0x{b:02X}>", 0.0, pieces.BYTE) for b in range(256)]
    return pieces.Vocabulary((*fixed, *((p, s, pieces.NORMAL) for p, s in scores.items())), 1, 2, "?")


def test_backtracking_is_merging():
    """On vocabularies where the longest piece is often wrong, some pieces cannot come out, scores tie and spaces are inside pieces."""
    r = random.Random(4)
    for round_ in range(150):
        alphabet = "ab▁" if round_ % 2 else "abc"
        scores = {c: -100.0 for c in alphabet[:r.randint(0, 3)]}
        for _ in range(r.randint(0, 14)):
            scores["".join(r.choice(alphabet) for _ in range(r.randint(2, 5)))] = -float(r.randint(1, 9))
        coder = pieces.Pieces(vocabulary_of(scores))
        for _ in range(60):
            text = "".join(r.choice(alphabet.replace("▁", " ") + "é") for _ in range(r.randint(1, 14)))
            want = coder.merged(pieces.SPACE + text.replace(" ", pieces.SPACE))
            flat = [coder.ids[p] if p in coder.ids else b"".join(coder.bytes[b] for b in p.encode()) for p in want]
            assert coder.encode(text) == coder.begin + b"".join(flat) + coder.end


def test_pieces_table(spark, coder, monkeypatch):
    monkeypatch.setattr(pieces, "TEXTS", 3)
    rows = docs_of(spark, [(1, None), (2, ""), (None, "x y"), (3, "same"), (3, "same"), (4, "long " * 20_000), (5, "ﬁ ")])
    got = pieces.encode(rows, pieces.read_model(MODEL))
    assert got.columns == ["doc_id", "n_tokens", "ids", "decoded"]
    for x in got.collect():
        assert x.n_tokens == len(x.ids) // 4 and bytes(x.ids) == coder.encode(x.decoded)
    assert sorted(x.n_tokens for x in got.collect())[:2] == [2, 2] and got.where("doc_id = 3").count() == 2
    assert pieces.encode(rows.limit(0), pieces.read_model(MODEL)).count() == 0


def test_other_models_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto()
    with open(MODEL, "rb") as f:
        model.ParseFromString(f.read())
    for change in ({"model_type": 1}, {"treat_whitespace_as_suffix": True}):
        other = proto.ModelProto()
        other.CopyFrom(model)
        for k, v in change.items():
            setattr(other.trainer_spec, k, v)
        path = tmp_path / "m.model"
        path.write_bytes(other.SerializeToString())
        with pytest.raises(ValueError):
            pieces.read_model(str(path))


def test_runs_are_cut_where_no_piece_joins(coder):
    assert coder.cut("▁one,two▁(три).") == ["▁one", ",", "two", "▁(", "три", ")."]


def test_neighbours_are_told_without_merging_again(coder, monkeypatch):
    r = random.Random(6)
    text = " ".join("".join(r.choice("aaabcdeehilnorst") for _ in range(r.randint(1, 12))) for _ in range(60))
    merged = coder.merged(pieces.SPACE + text.replace(" ", pieces.SPACE))
    plain = pieces.Pieces(pieces.read_model(MODEL))
    monkeypatch.setattr(plain, "merged", None)
    assert plain.encode(text) == plain.begin + b"".join(plain.ids[p] for p in merged) + plain.end


def test_used_runs_outlive_the_turn_of_the_cache(monkeypatch):
    monkeypatch.setattr(pieces, "CACHE_RUNS", 8)
    coder, made = pieces.Pieces(pieces.read_model(MODEL)), []
    packed = coder.packed
    monkeypatch.setattr(coder, "packed", lambda run: made.append(run) or packed(run))
    for k in range(40):
        assert coder.decode(coder.encode(f"often w{chr(97 + k % 26)}{chr(97 + k // 26)}x")) == f"often w{chr(97 + k % 26)}{chr(97 + k // 26)}x"
    assert made.count("▁often") == 1 and len(coder.cache) + len(coder.cache.older) <= 12
