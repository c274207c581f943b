"""Each operator against a brute-force version, on rows with nulls, empty, long, repeated and tied values."""

import hashlib
import json
import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pytest
import tiktoken
from pyspark.sql import functions as F

from metaskein.llm import chat, components, decontamination, embeddings, html, language, pii, queries, repeats, sharding, shingles, tokenizing

DOCS = "doc_id long, text string, lang string, key string, node long, row long, n long, anchor string, label string, term string, id string"


def docs_of(spark, pairs):
    """Rows with further columns whose names operators use inside."""
    return spark.createDataFrame([(i, t, "en", "k", 1, 2, 3, "a", "l", "t", "x") for i, t in pairs], DOCS)


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def prose(seed, n, words=40):
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdefghij") for _ in range(r.randint(2, 8))) for _ in range(words)]
    return " ".join(r.choice(vocabulary) for _ in range(n))


# --- extraction -----------------------------------------------------------------

PAGE = ('<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><nav><a href="/">Home</a></nav><div id="sidebar">side</div>'
        '<main><h1>Big &amp; small</h1><p><b>First<br>para<p>Second \n  one.<script>x("<p>no</p>")</script><ul><li>a<li>b</ul>'
        '<div class="comments"><p>A long comment of a reader, longer than all the rest of this page together.</p></div></main>'
        '<form>Mail <input></form><footer>&copy; us</footer></body></html>')


def test_main_text():
    assert html.main_text(PAGE) == "Big & small\nFirst para\nSecond one.\na\nb"
    assert html.main_text("<p>one paragraph") == "one paragraph"
    assert html.main_text("plain &lt; text") == "plain < text"
    for page in (None, "", "   ", "<nav>menu</nav>", "<a href='never ends", "<script>x"):
        assert html.main_text(page) == ""


@pytest.mark.parametrize("page", ["<div>" * 20_000 + "x", "<a '" * 20_000, "<" * 50_000, "</div>" * 20_000, "<p>a" * 20_000])
def test_pages_built_to_be_slow(page):
    html.main_text(page)


def test_pages_table(spark):
    pages = spark.createDataFrame([(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (2, None, None, "y"), (None, "v", "", "z")], "page_id long, url string, html string, text string")
    got = sorted((r.page_id or 0, r.url or "", r.text, r.n_chars) for r in html.extract(pages).collect())
    assert got == [(0, "v", "", 0), (1, "u", html.main_text(PAGE), 38), (1, "u", html.main_text(PAGE), 38), (2, "", "", 0)]
    assert html.extract(pages.limit(0)).count() == 0


# --- tokens ---------------------------------------------------------------------


@pytest.fixture(scope="module")
def vocabulary():
    return queries.vocabulary()


def test_tokens_are_those_of_the_library(spark, vocabulary):
    ranks, pattern = vocabulary
    known = tiktoken.Encoding("known", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    r = random.Random(3)
    pieces = ["a", "aa", "é", "\x1c", "\x85", " ", " ", "1", "٣", "!", "ß", "中", "'s", "\n", "\t", "𝒳", "<|endoftext|>", "the", "ing"]
    texts = ["".join(r.choice(pieces) for _ in range(r.randint(0, 60))) for _ in range(300)]
    texts += [None, "", "x" * 5_000, "abcdefgh" * 3_000, texts[0], texts[0]]
    rows = docs_of(spark, list(enumerate(texts)) + [(None, "null id")])
    got = {x.doc_id: x for x in tokenizing.encode(rows, ranks, pattern).collect()}
    assert len(got) == len(texts) + 1
    for i, text in enumerate(texts):
        ids = known.encode_ordinary(text or "")
        assert list(memoryview(got[i].ids).cast("I")) == ids and got[i].n_tokens == len(ids)
        assert bytes(got[i].decoded) == (text or "").encode()
    assert tokenizing.encode(rows.limit(0), ranks, pattern).count() == 0


def test_one_queue_for_one_or_many(vocabulary):
    ranks, pattern = vocabulary
    coder = tokenizing.Coder(ranks, pattern)
    r = random.Random(5)
    words = ["".join(r.choice("aabtheinrs") for _ in range(r.randint(1, 30))).encode() for _ in range(500)]
    assert [x.tolist() for x in coder.merge_many(words)] == [coder.merge(w) if w not in ranks else x.tolist() for w, x in zip(words, coder.merge_many(words))]


def test_a_step_serves_many_ranks(vocabulary, monkeypatch):
    """One queue takes few steps: as many as the ranks in use would be one for each merge of rare words."""
    ranks, pattern = vocabulary
    coder = tokenizing.Coder(ranks, pattern)
    r = random.Random(8)
    words = sorted({"".join(r.choice("aabtheinrs") for _ in range(r.randint(1, 30))).encode() for _ in range(2_000)})
    steps, pairs = [], coder._pairs
    monkeypatch.setattr(coder, "_pairs", lambda a, b: steps.append(1) or pairs(a, b))
    many = coder.merge_many(words)
    used = {x for ids in many for x in ids.tolist() if x > 255}
    assert len(steps) < len(used) + 300 and all(ids.tolist() == coder.merge(w) for w, ids in zip(words, many) if w not in ranks)


def test_used_words_outlive_the_turn_of_the_cache(vocabulary, monkeypatch):
    ranks, pattern = vocabulary
    monkeypatch.setattr(tokenizing, "CACHE_ENTRIES", 8)
    coder, made = tokenizing.Coder(ranks, pattern), []
    merge = coder._merge_many
    monkeypatch.setattr(coder, "_merge_many", lambda words: made.extend(words) or merge(words))
    for k in range(40):
        assert coder.decode(coder.encode([f"often w{k}x"])[0]) == f"often w{k}x".encode()
    assert made.count(b"often") == 1 and len(coder.cache) + len(coder.older) <= 16


def test_equal_words_of_a_group_are_held_once(vocabulary):
    """200,000 pre-tokens of two kinds: one object of text for each would be over 10 MB."""
    ranks, pattern = vocabulary
    coder = tokenizing.Coder(ranks, pattern)
    texts = [" ab cd" * 1000] * 100
    want = coder.encode(texts[:1])
    tracemalloc.start()
    try:
        assert coder.encode(texts) == want * 100
        assert tracemalloc.get_traced_memory()[1] < 6_000_000
    finally:
        tracemalloc.stop()
    assert tokenizing.TEXTS <= 128


# --- personal data --------------------------------------------------------------

EXPRESSIONS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"), "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def valid(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(x) <= 255 for x in value.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and sum(int(c) if i % 2 == 0 else sum(map(int, str(2 * int(c)))) for i, c in enumerate(reversed(digits))) % 10 == 0
    return kind != "phone" or 8 <= len(digits) <= 15


def test_base_spans(spark):
    r = random.Random(7)
    pieces = ["a@b.c", "x_y", "_d@e.f", "@", ".", "1.2.3.4", "300.1.1.1", "0001.2.3.255", "4111 1111 1111 1111", "4111-1111", " ", "-", "+49 30 1234567", "+1(2", "é", "𝒳", "\n", "5", "99999999999999999999.1.1.1"]
    texts = ["".join(r.choice(pieces) for _ in range(r.randint(0, 14))) for _ in range(400)]
    texts += [None, "", "9" * 30_000, "a" * 30_000, "1 " * 9_000, "1." * 9_000, "+1" * 5_000, "x@y.z " * 300]
    got = {x.doc_id: x for x in pii.find_personal_data(docs_of(spark, enumerate(texts))).collect()}
    for i, text in enumerate(texts):
        for kind, e in EXPRESSIONS.items():
            want = [(m.start(), m.end(), m.group()) for m in e.finditer(text or "") if valid(kind, m.group())]
            assert [tuple(x) for x in got[i][kind]] == want, (kind, text)


def test_terms_that_disclose(spark):
    rows = [(i, f"{prose(i, 30)} write to kestrel ann@site.org or the desk {prose(i + 50, 30)}") for i in range(5)]
    rows += [(100 + i, f"{prose(i, 40)} write to the desk or wait") for i in range(40)]
    got = {x.doc_id: x for x in pii.find_personal_data(docs_of(spark, rows)).collect()}
    for i, text in rows[:5]:
        assert [x.value for x in got[i].term] == ["kestrel"]
        x = got[i].term[0]
        assert text[x.start:x.end] == "kestrel"
        assert got[i].sanitized == text.replace("kestrel", "").replace("ann@site.org", "[EMAIL]")
    assert all(got[i].sanitized is None and not got[i].term for i, _ in rows[5:])
    assert pii.find_personal_data(docs_of(spark, [])).count() == 0


# --- decontamination ------------------------------------------------------------


def test_contamination(spark):
    words = [f"w{i}" for i in range(60)]
    items = [(1, " ".join(words[:14])), (2, "Short ITEM here"), (3, ""), (4, None), (5, " ".join(words[5:20])), (6, "Short ITEM here"), (None, "w50 w51")]
    texts = ["x " + ", ".join(words[2:13]) + " y", "a short, item\nhere!", None, "", " ".join(words[:9]), "Short ITEM here " * 3, "ÄÖ é short", " ".join(words[:20])]
    bench = spark.createDataFrame(items, "item_id long, text string")

    def brute(text):
        w = re.findall(decontamination.WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        hit, found = set(), set()
        for item, t in items:
            v = re.findall(decontamination.WORD, re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
            if item is None:
                continue
            for win in {tuple(v[k:k + 10]) for k in range(max(1, len(v) - 9))} - {()}:
                for k in range(len(w) - len(win) + 1):
                    if tuple(w[k:k + len(win)]) == win:
                        hit |= set(range(k, k + len(win)))
                        found.add(str(item))
        return len(w), len(hit), sorted(found)

    for block in (decontamination.BLOCK_BYTES, 40):
        got = {x.doc_id: x for x in decontamination.find_contamination(docs_of(spark, enumerate(texts)), bench, block_bytes=block).collect()}
        for i, text in enumerate(texts):
            assert (got[i].n_words, got[i].n_hit, got[i]["items"]) == brute(text)
    assert [texts[1][s.start:s.end] for s in got[1].spans] == ["short, item\nhere"]
    none = decontamination.find_contamination(docs_of(spark, [(1, "a b")]), bench.limit(0)).first()
    assert (none.n_words, none.n_hit) == (2, 0)


# --- repeats --------------------------------------------------------------------


def brute_repeats(texts, n):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[k:k + n] for b in raw for k in range(len(b) - n + 1))
    out = []
    for b in raw:
        mark = bytearray(len(b))
        for k in range(len(b) - n + 1):
            if seen[b[k:k + n]] > 1:
                mark[k:k + n] = b"\1" * n
        out.append(bytes(x for x, m in zip(b, mark) if not m))
    return out


@pytest.mark.parametrize("most", [5_000, 1])
def test_repeats(spark, most):
    r = random.Random(11)
    passage = [prose(k, 30) for k in range(4)]
    texts = []
    for i in range(60):
        parts = [prose(1_000 + i, r.randint(0, 30))]
        for _ in range(r.randint(0, 2)):
            p = r.choice(passage)
            a, b = sorted((r.randint(0, len(p)), r.randint(0, len(p))))
            parts += [p[a:b], prose(r.random(), 5)]
        texts.append("é".join(parts))
    texts += [None, "", "ha " * 200, "a" * 500, texts[3], texts[3], "x" + texts[4][1:], passage[0], "q" * 39, "q" * 39]
    want = brute_repeats(texts, 40)
    rows = docs_of(spark, [(i, t) for i, t in enumerate(texts)]).repartition(3)
    got = {x.doc_id: bytes(x.kept) for x in repeats.remove_repeats(rows, length=40, gram=12, sorted_most=most).collect()}
    assert [got[i] for i in range(len(texts))] == want
    assert repeats.remove_repeats(rows.limit(0), length=40, gram=12).count() == 0


def test_suffix_order():
    r = random.Random(2)
    parts = ["".join(r.choice("ab") for _ in range(r.randint(0, 30))).encode() for _ in range(200)]
    order, shared = repeats.suffix_order(parts)
    assert [parts[i] for i in order] == sorted(parts)
    assert shared == repeats._plain_order(parts)[1]


def test_long_texts_are_read_in_stretches(monkeypatch):
    import pyarrow as pa

    text = prose(1, 400).encode()
    windows = lambda: sorted((s + k, (p - f) - k) for _, start, first, last, place, _, _ in repeats._runs(pa.array([text.decode()]), 60, 20)
                             for s, f, z, p in zip(start.tolist(), first.tolist(), last.tolist(), place.tolist()) for k in range(z - f + 1))
    whole = windows()
    monkeypatch.setattr(repeats, "SEGMENT", 100)
    assert windows() == whole and len(whole) == len(text) - 59


# --- language -------------------------------------------------------------------


def test_automaton_knows_exactly_the_substrings():
    codes = [2, 3, 2, 3, 3, 2, 4, 2, 3]
    table = language.suffix_automaton(codes, 5)
    have = {tuple(codes[i:j]) for i in range(len(codes)) for j in range(i + 1, len(codes) + 1)}
    for n in range(1, 5):
        for word in np.ndindex(*(5,) * n):
            state = 1
            for c in word:
                state = table[state, c] if state else 0
            assert bool(state) == (word in have)


def test_phrases_are_longest_matches():
    samples = [("a", "the cat sat on the mat"), ("b", "le chat noir sur le lit")]
    parser = language.Parser(samples)
    for text in ("the hat sat", "le chat", "zzz the", "x", "noir cat!!  on"):
        coded = parser.codes(text)
        for k, (_, sample) in enumerate(samples):
            known = bytes(parser.codes(sample))
            n = at = 0
            while at < len(coded):
                end = at + 1
                while end < len(coded) and bytes(coded[at:end + 1]) in known:
                    end += 1
                n, at = n + 1, end
            assert parser.phrases([coded])[0, k] == n


def test_language(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    got = queries.op6_language_id(spark, sf_dir.replace("0.001", "0.01")).where("held_out").collect()
    assert sum(r.lang_pred == truth[r.doc_id] for r in got) >= 0.97 * len(got) > 0
    samples = language.sample(docs)
    odd = docs_of(spark, [(1, None), (2, ""), (3, "12 !? 34"), (4, "und der die das nicht ein " * 50), (None, "x"), (4, "und der die das nicht ein " * 50)])
    rows = language.identify(odd, samples).collect()
    assert {r.doc_id: r.lang_pred for r in rows if r.doc_id in (1, 2, 3)} == {1: "und", 2: "und", 3: "und"}
    assert [r.lang_pred for r in rows if r.doc_id == 4] == ["de", "de"] and all(0 <= r.score <= 1 for r in rows)
    assert {r.lang_pred for r in language.identify(odd, language.sample(odd.limit(0))).collect()} == {"und"}


# --- pairs ----------------------------------------------------------------------


def closed(n, linked):
    low = list(range(n))
    for _ in range(n):
        for a in range(n):
            for b in range(n):
                if linked(a, b) and low[b] < low[a]:
                    low[a] = low[b]
    return low


def test_components(spark):
    r = random.Random(1)
    edges = [(r.randint(0, 80), r.randint(0, 80)) for _ in range(60)] + [(i, i + 1) for i in range(100, 160)] + [(200, k) for k in range(201, 240)] + [(5, 5)]
    got = dict(components.connected(spark.createDataFrame(edges, "a long, b long")).collect())
    low = {x: x for e in edges for x in e}
    for _ in range(200):
        for a, b in edges:
            low[a] = low[b] = min(low[a], low[b])
    assert got == low
    assert components.connected(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_documents(spark):
    r = random.Random(4)
    base = [prose(k, 60, 200).split() for k in range(5)]
    texts = [None, "", " \t\n", "one two", "ONE  two", "one two three"]
    for b in base:
        texts += [" ".join(b), " ".join(b).upper(), " ".join(b)]
        for _ in range(8):
            c = list(b)
            for _ in range(r.randint(0, 4)):
                c[r.randrange(len(c))] = "new" + str(r.random())
            texts.append(" ".join(c[: r.randint(50, 60)]))
    texts += [prose(77, 25, 300) + " " + " ".join(base[0][:30]) for _ in range(2)] + ["word " * 3_000]

    def shingle(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        return {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} - {()}

    sets = [shingle(t) for t in texts]
    want = closed(len(texts), lambda a, b: 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) and bool(sets[a]))
    got = shingles.near_duplicates(docs_of(spark, [(i, t) for i, t in enumerate(texts)])).collect()
    assert {x.doc_id: (x.n_shingles, x.component_id) for x in got} == {i: (len(sets[i]), want[i]) for i in range(len(texts))}
    assert {x.doc_id for x in got if x.kept} == set(want)
    twice = shingles.near_duplicates(docs_of(spark, [(7, "a b c d e f"), (7, "a b c d e f"), (7, "other words are in this one"), (None, "null id")])).collect()
    assert sorted((x.n_shingles, x.kept) for x in twice) == [(1, True), (2, False), (2, True), (2, True)]
    assert shingles.near_duplicates(docs_of(spark, [])).count() == 0


def test_near_vectors(spark):
    r = np.random.default_rng(0)
    x = r.normal(size=(60, 24))
    x[30:45] = x[:15] + 0.15 * r.normal(size=(15, 24))
    x[45:50] = x[0]
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)] + [
        (100, None, 0), (101, [], 0), (102, [0.0] * 24, 0), (103, [float("nan")] * 24, 0), (104, [None] + [1.0] * 23, 0), (105, [1.0, 2.0], 0), (106, [2.0, 4.0], 0), (None, [9.0, -1.0], 0)]
    got = {v.vec_id: v for v in embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, node long")).collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = u @ u.T >= 0.9
    np.fill_diagonal(near, False)
    low = closed(60, lambda a, b: near[a, b])
    assert [(got[i].n_links, got[i].component_id, got[i].kept) for i in range(60)] == [(int(near[i].sum()), low[i], low[i] == i) for i in range(60)]
    assert all((got[i].n_links, got[i].kept) == (0, True) for i in (100, 101, 102, 103, 104, None))
    assert (got[105].n_links, got[106].component_id, got[106].kept) == (1, 105, False)
    assert embeddings.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


@pytest.mark.parametrize("one", [True, False])
def test_tiles_give_what_one_product_gives(monkeypatch, one):
    monkeypatch.setattr(embeddings, "TILE", 16)
    r = np.random.default_rng(1)
    z = r.normal(size=(90, 40))
    z[50:80] = z[0] + 0.1 * r.normal(size=(30, 40))
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    w = r.integers(1, 4, 90)
    axes = np.linalg.eigh(z.T @ z)[1][:, ::-1]
    counts, links = embeddings.compare(z if one else z[:40], None if one else z[40:], axes, w if one else w[:40], None if one else w[40:], 0.9)
    near = z @ z.T >= 0.9
    np.fill_diagonal(near, False)
    if not one:
        near[:40, :40] = near[40:, 40:] = False
    assert counts.tolist() == (near @ w).tolist()
    assert all(near[a, b] for a, b in links)


# --- shards and chats -----------------------------------------------------------


def test_shards(spark):
    texts = [(i, "x" * random.Random(i).randint(0, 200)) for i in range(300)] + [(7, "y" * 5_000), (8, None), (None, "z" * 10), (9, "same"), (9, "same")]
    got = sharding.shards(docs_of(spark, texts), 1_000).collect()
    assert sorted(x.n_bytes for x in got) == sorted(len(t or "") for _, t in texts)
    rows = []
    for i, t in texts:
        bits = int(hashlib.md5(f"{'' if i is None else i}:{t or ''}".encode()).hexdigest()[:12], 16)
        rows.append((f"{bits:048b}", i, len(t or "")))

    def split(prefix, part):
        if sum(n for *_, n in part) <= 1_000 or len(prefix) == 48:
            return [(prefix, i, n) for _, i, n in part]
        return [x for b in "01" for x in split(prefix + b, [p for p in part if p[0].startswith(prefix + b)])]

    assert Counter((x.shard, x.doc_id, x.n_bytes) for x in got) == Counter(split("", rows))
    assert {x.doc_id for x in got if not x.fits} == {7} and all(x.depth == len(x.shard) for x in got)
    assert sharding.shards(docs_of(spark, []), 10).count() == 0


def test_layouts(spark):
    records = [
        (1, {"prompt": "p", "response": "r"}), (2, {"output": "o", "instruction": "i"}), (3, {"input": None, "instruction": "i", "output": "o"}),
        (4, {"messages": [{"role": "user", "content": "u"}, {"content": "a", "role": "assistant"}]}), (5, {"conversations": [{"from": "human", "value": "h"}, {"from": "gpt", "value": "g"}]}),
        (6, {"who": "knows"}), (7, {"question": "q", "answer": 5}),
    ]
    rows = spark.createDataFrame([(i, json.dumps(x), "extra") for i, x in records] + [(8, None, ""), (9, "{bad", "")], "id long, record string, turns string")
    got = {x.id: (x.layout, x.turns and [tuple(t) for t in x.turns]) for x in chat.canonical(rows).collect()}
    assert got == {
        1: ("prompt", [("user", "p"), ("assistant", "r")]), 2: ("instruction", [("user", "i"), ("assistant", "o")]),
        3: ("instruction_input", [("system", "i"), ("user", ""), ("assistant", "o")]), 4: ("messages", [("user", "u"), ("assistant", "a")]),
        5: ("conversations", [("user", "h"), ("assistant", "g")]), 6: (None, None), 7: ("question", [("user", "q"), ("assistant", "5")]), 8: (None, None), 9: (None, None)}


def test_chats_are_read_back(spark):
    texts = ["", "plain", chat.OPEN, chat.CLOSE + chat.AFTER_ROLE, "&lt;|turn|>", "&amp;lt;", "a\nb", "𝒳é", "</s>[INST] ok [/INST]", queries.HOSTILE]
    r = random.Random(6)
    rows = [(c, t, r.choice(["user", "assistant", "system", "<|end|>", None]), r.choice([*texts, None]), 1) for c in range(30) for t in range(r.randint(1, 6))]
    rows += [(99, 0, "user", "tie", 1), (99, 0, "assistant", "tie", 1), (99, 0, "user", "tie", 1), (None, 0, "user", "x", 1), (98, None, "assistant", None, 1)]
    talks = chat.formatted(chat.grouped(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted int")))
    got = talks.select("conv_id", chat.read_back(F.col("formatted")).alias("turns"), chat.masked_text(F.col("formatted"), F.col("mask")).alias("loss")).collect()
    assert len(got) == len({c for c, *_ in rows})
    for x in got:
        want = sorted(((t, role or "", text or "") for c, t, role, text, _ in rows if c == x.conv_id), key=lambda k: (k[0] is not None, k))
        assert [tuple(t) for t in x.turns] == [k[1:] for k in want]
        assert x.loss == "".join(k[2] for k in want if k[1] == "assistant")
    assert chat.formatted(chat.grouped(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))).count() == 0
