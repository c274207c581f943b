"""Cases at the edges of single operators: telling names on articles, equal rows beyond a shard, rows without an id, many lengths."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_operators import docs_of, prose

from metaskein.llm import chat, embeddings, html, language, sharding, shingles

# --- main text ----------------------------------------------------------------

SENTENCES = [f"Sentence number {i} of the article is long enough to be a paragraph." for i in range(20)]
ARTICLE = "<h1>Title</h1>" + "".join(f"<p>{s}</p>" for s in SENTENCES)
WANT = "\n".join(["Title", *SENTENCES])
MENU = "<nav><ul><li><a href='/'>Home</a></li></ul></nav>"


@pytest.mark.parametrize("name", ["sidebar-right", "content sidebar", "search-results", "ad-free", "social-policy", "login-required", "share-price", "nav-open",
                                  "comments-open", "no-comments", "post"])
def test_a_name_does_not_cut_the_article(name):
    for page in (f"<body>{MENU}<div class='{name}'>{ARTICLE}</div><footer>f</footer></body>",
                 f"<body>{MENU}<div id='{name}'><article>{ARTICLE}</article></div><div class='ad'>Buy this.</div></body>",
                 f"<body class='{name}'>{MENU}<div>{ARTICLE}</div></body>"):
        assert html.main_text(page) == WANT


@pytest.mark.parametrize("name", ["ad", "sidebar", "related-posts", "cookie-notice", "share"])
def test_a_name_still_cuts_what_is_beside_an_article(name):
    beside = f"<div class='{name}'>" + "".join(f"<p>{s} More words in here than in the article itself.</p>" for s in SENTENCES * 2) + "</div>"
    assert html.main_text(f"<body>{beside}<article>{ARTICLE}</article></body>") == WANT
    assert html.main_text(f"<body><main>{ARTICLE}</main>{beside}</body>") == WANT


def test_all_blocks_of_the_article():
    page = ("<article><section><h2>A</h2>" + "".join(f"<p>{s}</p>" for s in SENTENCES) + "</section><section><p>Short closing section.</p></section>"
            "<h2>End</h2><p>One more line.</p><ul><li><a href='/x'>only a link</a></li></ul></article>")
    assert html.main_text(f"<body>{MENU}{page}<div><p>Loose text elsewhere.</p></div></body>") == \
        "\n".join(["A", *SENTENCES, "Short closing section.", "End", "One more line."])


def test_densities_by_definition():
    """Characters per tag with links weighed, and their sums, from a walk over a page's elements."""
    page = "<html><body><div><p>Some <b>bold</b> words <a href=x>link</a> here.</p><p>Second one.</p></div><div><a href=y>alone</a></div></body></html>"
    root, _ = html.parse(page)
    nodes = {x.tag + str(i): x for i, x in enumerate(html._weigh(root))}
    # tags below, link characters, links below, by hand
    known = {"html1": (8, 9, 2), "body2": (7, 9, 2), "div3": (4, 4, 1), "p4": (2, 4, 1), "b5": (0, 0, 0), "a6": (0, 4, 0), "p7": (0, 0, 0), "div8": (1, 5, 1), "a9": (0, 5, 0)}
    chars = {"p4": len("Some") + len("bold") + len("words") + len("link") + len("here."), "b5": 4, "a6": 4, "p7": len("Second one."), "a9": 5, "div8": 5}
    chars["div3"] = chars["p4"] + chars["p7"]
    chars["body2"] = chars["html1"] = chars["div3"] + 5
    share = 9 / chars["body2"]
    for name, (t, lc, lt) in known.items():
        x, c = nodes[name], chars[name]
        assert (x.chars, x.tags, x.link_chars, x.link_tags) == (c, t, lc, lt), name
        lc_, t, lt = max(1, lc), max(1, t), max(1, lt)
        base = math.log(c / max(1, c - lc) * lc + share * c + math.e)
        assert x.density == pytest.approx(max(0.0, c / t * math.log(max(c / lc_ * t / lt, 1.0) + 1e-9, base))), name
    for x in nodes.values():
        assert x.total == pytest.approx(sum(c.density for c in x.children))


# --- shards -------------------------------------------------------------------


def test_equal_rows_are_parted(spark):
    rows = [(5, "same text " * 10)] * 400 + [(1000 + i, prose(i, 10)) for i in range(20)] + [(99, "z" * 3_000)]
    got = sharding.shards(docs_of(spark, rows), 1_000).collect()
    assert len(got) == len(rows)
    assert {x.doc_id for x in got if not x.fits} == {99}
    held = {}
    for x in got:
        held.setdefault(x.shard, []).append(x.n_bytes)
    assert all((sum(v), len(v)) == (x.shard_bytes, x.shard_rows) for x in got for v in [held[x.shard]])
    names = sorted(held)
    assert not any(b.startswith(a) for a, b in zip(names, names[1:])) and all(x.depth == len(x.shard) for x in got)
    assert {x.depth > 48 for x in got if x.doc_id == 5} == {True}


# --- chats --------------------------------------------------------------------


def test_rows_without_a_conversation_stand_alone(spark):
    rows = [(None, 1, "user", "a"), (None, 1, "user", "b"), (1, 2, "assistant", "d"), (1, 1, "user", "c")]
    got = chat.grouped(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert sorted((x.conv_id or 0, [tuple(t) for t in x.turns]) for x in got) == [(0, [("user", "a")]), (0, [("user", "b")]), (1, [("user", "c"), ("assistant", "d")])]


@pytest.mark.parametrize(("columns", "layout"), [("conv_id long, turn long, role string, text string, more int", "turns"), ("conversation_id long, position long, role string, content string, x int", "messages"),
                                                 ("conversation_id long, position long, `from` string, value string, x int", "conversations")])
def test_row_layouts_go_through_the_mappings(spark, columns, layout):
    records = chat.records_of(spark.createDataFrame([(1, 1, "human", "q", 0), (1, 2, "gpt", None, 0)], columns))
    got = chat.canonical(records, id_col="conv_id").first()
    assert got.layout == layout and [tuple(t) for t in got.turns] == [("user", "q"), ("assistant", "")]
    with pytest.raises(ValueError):
        chat.records_of(spark.createDataFrame([(1, 2)], "a int, b int"))


def test_nested_columns_and_json_records_agree(spark):
    nested = spark.createDataFrame([(1, ("p", None))], "id long, record struct<response:string,prompt:string>")
    as_json = nested.select("id", F.to_json("record", {"ignoreNullFields": "false"}).alias("record"))
    assert chat.canonical(nested).collect() == chat.canonical(as_json).collect()
    odd = spark.createDataFrame([(1, ("p",))], "id long, record struct<other:string>")
    assert [tuple(r) for r in chat.canonical(odd).collect()] == [(1, None, None)]


# --- embeddings, language, sets ---------------------------------------------------


def test_any_number_of_lengths(spark):
    rows = [(10 * n + k, [1.0] * n) for n in range(1, 20) for k in (0, 1)]
    got = embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {(x.vec_id, x.n_links, x.component_id) for x in got} == {(i, 1, i // 10 * 10) for i, _ in rows}


def test_ties_at_the_threshold_do_not_depend_on_the_way(monkeypatch):
    """Cosines that are the threshold but for rounding, few and many in a tile."""
    a = np.zeros((40, 30))
    a[:, 0], a[:, 1] = 0.9, math.sqrt(1 - 0.81)
    a[0, :2] = 1.0, 0.0
    a[1:, 1:] = np.linalg.qr(np.random.default_rng(0).normal(size=(29, 29)))[0][np.arange(39) % 29] * math.sqrt(1 - 0.81)
    one = [embeddings.compare(a, None, np.eye(30), np.ones(40, np.int64), None, 0.9)[0].tolist()]
    monkeypatch.setattr(embeddings, "TILE", 3)
    one.append(embeddings.compare(a, None, np.eye(30), np.ones(40, np.int64), None, 0.9)[0].tolist())
    assert one[0] == one[1]


def test_any_number_of_languages_and_letters(spark):
    alphabet = [chr(0x4E00 + i) for i in range(400)]
    rows = [(i, "".join(alphabet[(7 * i + k) % 400] for k in range(60)), f"l{i}") for i in range(130)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    samples = language.sample(df)
    assert len(samples) == 130
    assert sum(len(t) for _, t in language.sample(df, chars=language.MODEL_CHARS)) == sum(len(t) for _, t, _ in rows)
    found = {r.doc_id: r.lang_pred for r in language.identify(df.where("doc_id < 5"), samples).collect()}
    assert found == {i: f"l{i}" for i in range(5)}


def test_phrases_cross_any_length():
    """A long text is parsed whole, as one of a batch and when it goes on alone."""
    samples = [("a", prose(1, 300)), ("b", prose(2, 300))]
    parser = language.Parser(samples)
    texts = [parser.codes(t) for t in (prose(1, 3_000, 60), prose(3, 50), "", samples[0][1] * 3, *(prose(k, k) for k in range(5, 60)))]
    got = parser.phrases(texts)
    known = [bytes(parser.codes(s)) for _, s in samples]
    for t, row in zip(texts, got):
        for k, sample in enumerate(known):
            n = at = 0
            while at < len(t):
                end = at + 1
                while end < len(t) and bytes(t[at:end + 1]) in sample:
                    end += 1
                n, at = n + 1, end
            assert row[k] == n


def test_pairs_that_share_many_keys_meet_once(spark):
    """Families of near copies around several originals that share most of their text, against all pairs."""
    base = prose(1, 120, 400).split()
    docs = []
    for i in range(70):
        words = list(base)
        for k in range(i % 23):
            words[(11 * i + 17 * k) % 120] = f"w{i}x{k}"
        docs.append((i, " ".join(words)))
    docs += [(100, " ".join(base)), (101, " ".join(base[:100])), (102, " ".join(base + base[:30]))]
    sets = {i: {tuple(t.split()[k:k + 5]) for k in range(len(t.split()) - 4)} for i, t in docs}
    low = {i: i for i in sets}
    for _ in sets:
        for i in sets:
            for j in sets:
                if i != j and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                    low[i] = min(low[i], low[j])
    got = {x.doc_id: x.component_id for x in shingles.near_duplicates(docs_of(spark, docs)).collect()}
    assert got == low and len(set(low.values())) > 3
