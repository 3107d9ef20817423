"""Personal data against the patterns as written, and disclosure against a plain count."""

from __future__ import annotations

import hashlib
import math
import re
import time
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sensorlake.llm import pii, queries

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def plain(text):
    digits = lambda m: [c for c in m[0] if c in "0123456789"]
    tests = {
        "email": (EMAIL, lambda m: True),
        "ip": (IP, lambda m: all(int(x) <= 255 for x in m[0].split("."))),
        "card": (CARD, lambda m: 13 <= len(digits(m)) <= 19 and luhn(digits(m))),
        "phone": (PHONE, lambda m: 9 <= len(digits(m)) <= 15),
    }
    return [(kind, m.start(), m.end()) for kind, (pattern, good) in tests.items() for m in pattern.finditer(text or "") if good(m)]


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet="a1.@+- (%é2", max_size=40))
def test_patterns_on_hard_alphabets(text):
    assert pii.base_spans(text) == plain(text)


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.sampled_from(["1.2.3.4", "255", "256", ".", "4111 1111-1111 1111", "+1 (017) 555-7713", "a%b@c.d", "@", "x", " ", "0", "٣", "-", "+"]), max_size=12).map("".join))
def test_patterns_on_glued_parts(text):
    assert pii.base_spans(text) == plain(text)


@pytest.mark.parametrize("text", ["a" * 300_000, "1" * 300_000, "1." * 150_000, "+1" + " (" * 150_000, "a@" * 150_000, "1 " * 150_000, "a.b@c." * 50_000])
def test_long_runs_take_linear_time(text):
    pii.base_spans(text)


def test_query_equals_the_patterns(spark, sf_dir):
    docs = queries.table(spark, sf_dir, "documents").collect()
    rows = {r.doc_id: r for r in queries.op4_pii(spark, sf_dir).collect()}
    assert len(rows) == len(docs)
    for doc in docs:
        spans = plain(doc.text)
        said = ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
        row = rows[doc.doc_id]
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(k == kind for k, _, _ in spans) for kind in pii.KINDS]
        assert row.base_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert row.spans == said or row.spans.startswith(said) and "term" in row.spans


def plain_terms(texts):
    """The terms, with what they tell, as the module's description has it: every count by hand."""
    word = re.compile(r"[0-9A-Za-z\x80-\U0010ffff]+")
    seen, values, n, total = defaultdict(Counter), defaultdict(set), Counter(), 0
    for text in texts:
        words = [m.span() for m in word.finditer(text or "")]
        total += len(words)
        n.update(text[s:e].lower() for s, e in words)
        spans, met = plain(text), set()
        for kind, start, end in spans:
            said = text[start:end]
            name = said.lower() if kind == "email" else re.sub("[^0-9]+", "." if kind == "ip" else "", said)
            before = [(s, min(e, start)) for s, e in words if s < start][-pii.NEAR :]
            after = [(max(s, end), e) for s, e in words if e > end][: pii.NEAR]
            near = [
                (text[s:e].lower(), s) for s, e in before + after
                if e - s >= 3 and not text[s:e].isdigit() and not any(a < e and s < b for _, a, b in spans)
            ]
            context = " ".join(w for w, _ in near)
            for w, at in near:
                if (kind, name, at) not in met:
                    seen[kind, name, w][context] += 1
                    values[kind, name].add(context)
            met.update((kind, name, at) for _, at in near)
    windows, told = max(total / (2 * pii.NEAR), 1.0), {}
    for (kind, name, w), contexts in seen.items():
        share = min(len(values[kind, name]) / windows, 0.5)
        given = min(sum(contexts.values()) / n[w], 1.0)
        drawn = (len(contexts) * given + pii.PRIOR * share) / (len(contexts) + pii.PRIOR)
        told[w] = max(told.get(w, 0.0), (math.log(drawn) - math.log(share)) / -math.log(share))
    return {w: t for w, t in told.items() if t >= pii.GENERALISE}


def test_terms_equal_a_count_by_hand(spark):
    """Every term span of every document of a table in which terms are found."""
    docs = queries.table(spark, "/root/testdata/sf0.1", "documents").select("doc_id", "text")
    texts = {r.doc_id: r.text for r in docs.collect()}
    terms = plain_terms(texts.values())
    assert len(terms) > 100
    word = re.compile(r"[0-9A-Za-z\x80-\U0010ffff]+")
    got = {r.doc_id: [(s["start"], s["end"], s["told"]) for s in r.pii_spans if s["kind"] == pii.TERM] for r in pii.with_spans(docs, keep=["doc_id"]).collect()}
    for doc_id, text in texts.items():
        spans = plain(text)
        want = [(m.start(), m.end(), terms[m[0].lower()]) for m in word.finditer(text or "") if m[0].lower() in terms]
        want = [w for w in want if not any(s < w[1] and w[0] < e for _, s, e in spans)]
        assert [g[:2] for g in got[doc_id]] == [w[:2] for w in want]
        assert [g[2] for g in got[doc_id]] == pytest.approx([w[2] for w in want])


def test_very_many_spans_in_one_text(spark):
    """A log of 60,000 addresses takes seconds, in both passes."""
    text = " ".join(f"user{i} wrote from 10.{i % 256}.{i // 256 % 256}.7 to name{i % 900}@corp.example.com again" for i in range(30_000))
    df = spark.createDataFrame([(1, text), (2, "nothing here")], "doc_id long, text string")
    begin = time.perf_counter()
    rows = {r.doc_id: r for r in pii.with_spans(df).collect()}
    assert time.perf_counter() - begin < 60
    assert sum(s["kind"] == "ip" for s in rows[1].pii_spans) == sum(s["kind"] == "email" for s in rows[1].pii_spans) == 30_000


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["word", "éa", "+1 (017) 555-7713", "me@x.org", "10.0.0.1", " ", ",", "12345", "x" * 900, "ab"]), max_size=30).map("".join))
def test_contexts_equal_a_plain_search(text):
    spans = pii.base_spans(text)
    near = pii._Near(text, spans)
    words = [m.span() for m in re.finditer(r"[0-9A-Za-z\x80-\U0010ffff]+", text)]
    for span in spans:
        _, start, end = span
        both = [(s, min(e, start)) for s, e in words if s < start][-pii.NEAR :] + [(max(s, end), e) for s, e in words if e > end][: pii.NEAR]
        free = [(s, e) for s, e in both if e - s >= 3 and not text[s:e].isdigit() and not any(a < e and s < b for _, a, b in spans)]
        assert near.of(span) == [(text[s:e], s) for s, e in free]


def test_shapes_of_generalised_terms():
    assert [pii.general(w) for w in ("Zanzibar", "zanzibar", "NATO", "b52", "É", "éa", "X")] == ["<NAME>", "<WORD>", "<ACRONYM>", "<CODE>", "<NAME>", "<WORD>", "<NAME>"]


def test_terms_are_generalised_or_removed(spark):
    rows = [(1, "Told near here", [("term", 0, 4, 0.95), ("term", 5, 9, 0.99), ("email", 10, 14, None)])]
    df = spark.createDataFrame(rows, "doc_id long, text string, pii_spans array<struct<kind:string,start:int,end:int,told:double>>")
    spans, text = df.first().pii_spans, rows[0][1]
    assert [pii._instead(s.asDict(), text) for s in spans] == ["<NAME>", "", "<EMAIL>"]


def revealing(spark, more=()):
    common = "the quick house and garden words stay around here"
    rows = [(i, f"{common} number{i} {'zanzibar lima'.split()[i % 2]} {common.title()} {i} {'contact write'.split()[i % 2]} boss.{i % 2}@corp.example.com {common} fill{i}", "s", 5) for i in range(12)]
    rows += [(100 + i, f"{common} again {common} other{i} " * 40, "s", 5) for i in range(200)]
    rows += [(400, None, "s", 5), (401, "", "s", 5), (402, "x " * 100_000, "s", 5), (None, "me@here.org", "s", 5), (0, rows[0][1], "s", 5), *more]
    return spark.createDataFrame(rows, "doc_id long, text string, pii_spans string, n_chars long")


def test_terms_that_occur_only_near_a_value_are_found(spark):
    df = revealing(spark)
    told = {}
    for r in pii.with_spans(df).collect():
        told[r.doc_id] = [r.text[s["start"] : s["end"]] for s in r.pii_spans if s["kind"] == pii.TERM]
    assert all(told[i] == ["zanzibar lima".split()[i % 2], "contact write".split()[i % 2]] for i in range(12))
    # Words of other documents, and those of a single context, tell nothing.
    assert not any(w.lower() in ("the", "garden", "number3", "fill3") for ws in told.values() for w in ws)
    assert told[400] == told[401] == told[402] == told[None] == []


def test_texts_are_sanitised(spark):
    df = revealing(spark)
    out = pii.sanitised(df, length="n_chars")
    assert out.columns == df.columns
    texts = {r.doc_id: r for r in out.collect()}
    assert out.count() == df.count()
    assert {r.pii_spans for r in out.collect()} == {"s"}
    assert "<EMAIL>" in texts[3].text and "@" not in texts[3].text and "lima" not in texts[3].text
    assert texts[3].n_chars == len(texts[3].text)
    assert texts[400].text is None and texts[401].text == "" and texts[None].text == "<EMAIL>"
    assert texts[150].text == next(r.text for r in df.collect() if r.doc_id == 150)


def test_copies_are_no_evidence(spark):
    rows = [(i, "secretword near one@two.org") for i in range(50)] + [(100 + i, f"plain text {i}") for i in range(50)]
    found = pii.with_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(s["kind"] != pii.TERM for r in found for s in r.pii_spans)


def test_no_rows(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert pii.with_spans(none).collect() == []
    assert pii.sanitised(none).collect() == []


def test_terms_are_found_wherever_they_stand(spark):
    far = "É Zanzibar, " + "so many words stand between " * 20 + "ZANZIBAR and zanzibar@corp.example.com"
    df = revealing(spark, [(500, far, "s", 5), (501, "éé lima alone", "s", 5)])
    rows = {r.doc_id: r for r in pii.with_spans(df).collect()}
    terms = {i: [(rows[i].text[s["start"] : s["end"]]) for s in rows[i].pii_spans if s["kind"] == pii.TERM] for i in (500, 501)}
    assert terms == {500: ["Zanzibar", "ZANZIBAR"], 501: ["lima"]}
    texts = {r.doc_id: r.text for r in pii.sanitised(df).collect()}
    assert "zanzibar" not in texts[500].lower() and "lima" not in texts[501]


def test_values_with_two_contexts_are_judged(spark):
    common = "the quick house and garden words stay around here"
    more = [(600 + i, f"{common} one{i} zebediah {common} rare.one@corp.example.com {common} two{i}", "s", 5) for i in range(2)]
    rows = {r.doc_id: r for r in pii.with_spans(revealing(spark, more)).collect()}
    terms = {i: [rows[i].text[s["start"] : s["end"]] for s in rows[i].pii_spans if s["kind"] == pii.TERM] for i in (600, 601)}
    assert terms == {600: ["zebediah"], 601: ["zebediah"]}


def test_an_occurrence_near_a_repeated_value_counts_once(spark):
    common = "the quick house and garden words stay around here"
    more = [(600, f"{common} zebediah rare.one@corp.example.com or rare.one@corp.example.com {common}", "s", 5), (601, "zebediah alone", "s", 5)]
    rows = {r.doc_id: r for r in pii.with_spans(revealing(spark, more)).collect()}
    assert all(s["kind"] != pii.TERM for i in (600, 601) for s in rows[i].pii_spans)
