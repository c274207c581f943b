"""Disclosing terms and sanitised texts against the definition, on tables with known answers, and texts full of matches."""

import math
import random
import time
from collections import Counter

import pytest
import regex
from test_operators import EXPRESSIONS, docs_of, prose, valid

from metaskein.llm import pii

WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*+")


def entities_of(kind, value):
    plain = value.lower() if kind == "email" else value if kind == "ip" else "".join(c for c in value if c in "0123456789")
    group = plain.rsplit("@", 1)[-1] if kind == "email" else ".".join(plain.split(".")[:3]) if kind == "ip" else plain[:6] if kind == "card" else plain[:5]
    return (f"{kind}:{plain}", f"{kind}~{group}", kind)


def brute(texts, support, generalise, remove):
    """(terms, sanitised text or None) of each text."""
    spans, near = [], []
    for text in texts:
        text = text or ""
        mine = [(m.start(), m.end(), k, m.group()) for k, e in EXPRESSIONS.items() for m in e.finditer(text) if valid(k, m.group())]
        spans.append(mine)
        beside = []
        for w in WORD.finditer(text) if mine else ():
            if any(a < w.end() and w.start() < z for a, z, *_ in mine):
                continue
            found = []
            before = [(z, entities_of(k, v)) for a, z, k, v in mine if z <= w.start()]
            after = [(a, entities_of(k, v)) for a, z, k, v in mine if a >= w.end()]
            if before and w.start() - max(before)[0] <= pii.CONTEXT:
                found += max(before)[1]
            if after and min(after)[0] - w.end() <= pii.CONTEXT:
                found += min(after)[1]
            if found:
                beside.append((w.start(), w.end(), w.group().lower(), found))
        near.append(beside)
    in_docs = Counter(w for t in texts for w in set(regex.split(r"[^\p{L}\p{M}]+", (t or "").lower())))
    of_entity = Counter(e for s in spans for e in {e for *_, k, v in s for e in entities_of(k, v)})
    of_pair = Counter(p for b in near for p in {(e, w) for *_, w, es in b for e in es})
    total = len(texts)
    share = {}
    for (e, w), n in of_pair.items():
        bits = math.log2(total / of_entity[e])
        if n >= support and bits > 0:
            s = math.log2(n * total / (max(in_docs[w], n) * of_entity[e])) / bits
            if s >= generalise:
                share[e, w] = s
    out = []
    for text, mine, beside in zip(texts, spans, near):
        terms = {(a, z, w): max(share[e, w] for e in es if (e, w) in share) for a, z, w, es in beside if any((e, w) in share for e in es)}
        tags = sorted([(a, z, f"[{k.upper()}]") for a, z, k, _ in mine] + [(a, z, "" if s >= remove else "[TERM]") for (a, z, _), s in terms.items()])
        clean, at = "", 0
        for a, z, tag in tags:
            if a >= at:
                clean += text[at:a] + tag
            at = max(at, z)
        out.append((sorted(terms), clean + text[at:] if mine else None))
    return out


@pytest.mark.parametrize(("support", "generalise", "remove"), [(2, 0.8, 0.95), (1, 0.3, 0.6), (3, 0.5, 2.0)])
def test_terms_and_sanitised_texts(spark, support, generalise, remove):
    r = random.Random(support)
    vocabulary = [f"{a}{b}" for a in ("ka", "lö", "mi", "nu", "é") for b in ("ra", "so", "ti", "wen")]
    marks = ["ann@site.org", "Bob@Site.org", "cy@other.net", "10.0.0.1", "10.0.0.2", "192.168.1.1", "4111 1111 1111 1111", "4111111111111111",
             "+49 30 1234567", "+49 30 7654321", "ö4@b.c", "x@y.z1.2.3.4"]
    texts = []
    for i in range(120):
        words = [r.choice(vocabulary) for _ in range(r.randint(0, 60))]
        for _ in range(r.choice([0, 0, 1, 1, 2, 5])):
            at = r.randint(0, len(words))
            mark = r.choice(marks)
            words[at:at] = [mark] if r.random() < 0.5 else ["Kestrel" if "site" in mark.lower() else "token", mark, "x,"]
        texts.append(r.choice([" ", " ", "; "]).join(words))
    texts += [None, "", texts[3], texts[3], "only ann@site.org", "ann@site.org" * 3]
    got = {x.doc_id: x for x in pii.find_personal_data(docs_of(spark, enumerate(texts)), support=support, generalise=generalise, remove=remove).collect()}
    want = brute(texts, support, generalise, remove)
    assert sum(len(t) for t, _ in want) > 10
    for i, (terms, clean) in enumerate(want):
        assert [tuple(x) for x in got[i].term] == terms, texts[i]
        assert got[i].sanitized == clean, texts[i]


def test_a_text_full_of_matches(spark):
    text = " ".join(f"user{i}@mail{i % 7}.example.com" for i in range(5_000))
    start = time.time()
    x = pii.find_personal_data(docs_of(spark, [(1, text)])).first()
    assert len(x.email) == 5_000 and x.sanitized == " ".join(["[EMAIL]"] * 5_000)
    assert time.time() - start < 120


def test_long_text_between_matches(spark):
    text = "a@b.c " + prose(1, 40_000) + " 1.2.3.4"
    x = pii.find_personal_data(docs_of(spark, [(1, text), (2, prose(2, 10))])).collect()[0]
    assert [tuple(s) for s in x.ip] == [(len(text) - 7, len(text), "1.2.3.4")] and x.sanitized.endswith("[IP]")
