"""Source divergence: the transducer against sorted lists, and whole results against a plain version and SQL."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import compare
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sensorlake.llm import divergence, oracles, queries
from sensorlake.llm.words import column_bytes

WORDS = st.lists(st.text(alphabet="abcdé中", min_size=1, max_size=6), min_size=1, max_size=60)


def spans(words):
    data, bounds = column_bytes(pa.array(words))
    return data, bounds[:-1], bounds[1:]


@settings(max_examples=300, deadline=None)
@given(WORDS, WORDS)
def test_ordinals_are_places_in_the_sorted_list(terms, others):
    terms = sorted({t.encode() for t in terms})
    made = divergence.Transducer.unpacked(divergence.Transducer.of(terms).packed())
    asked = [t.decode() for t in terms] + others + ["", "a" * 50]
    want = [terms.index(w.encode()) if w.encode() in terms else -1 for w in asked]
    assert made.ordinals(*spans(asked)).tolist() == want


@settings(max_examples=100, deadline=None)
@given(WORDS)
def test_it_is_minimal(terms):
    """As many states as there are different sets of endings."""
    terms = sorted({t.encode() for t in terms})
    starts = {t[:i] for t in terms for i in range(len(t) + 1)}
    endings = {frozenset(t[len(s) :] for t in terms if t.startswith(s)) for s in starts}
    assert divergence.Transducer.of(terms).final.size == len(endings)


@settings(max_examples=200, deadline=None)
@given(WORDS, WORDS, st.integers(1, 5))
def test_parts_give_the_ordinals_of_the_whole(terms, others, size):
    terms = sorted({t.encode() for t in terms})
    rows = []
    for i in range(0, len(terms), size):
        part = terms[i : i + size]
        rows.append({"first": part[0].decode(), "last": part[-1].decode(), "base": i, **divergence.Transducer.of(part).packed()})
    asked = [t.decode() for t in terms] + others
    want = [terms.index(w.encode()) if w.encode() in terms else -1 for w in asked]
    assert divergence.Vocabulary(rows).ordinals(*spans(asked)).tolist() == want


@settings(max_examples=300, deadline=None)
@given(st.integers(1, 9 * 10**15 - 1), st.integers(1, 9 * 10**15 - 1))
def test_shares_are_exact(a, b):
    above, below = sorted((a, b))
    assert divergence.scaled(np.array([above]), np.array([below])).tolist() == [10**9 * above // below]


def plain(rows, least=3, top=200):
    """The audit as its definition says."""
    tokens = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))) for text, lang, source in rows]
    holds = Counter((lang, term) for lang, _, words in tokens for term in set(words))
    counts = defaultdict(Counter)
    for lang, source, words in tokens:
        counts[lang, source].update(w for w in words if holds[lang, w] >= least)
    out = []
    for lang in {lang for lang, _ in counts}:
        kept = [term for (spoken, term), n in holds.items() if spoken == lang and n >= least]
        sources = sorted((s for spoken, s in counts if spoken == lang), key=str.encode)
        whole = sum((counts[lang, s] for s in sources), Counter())

        def share(count, kept=kept):
            return {t: 1 + 10**9 * (count[t] + 1) // (sum(count.values()) + len(kept)) for t in kept}

        p, q = {s: share(counts[lang, s]) for s in sources}, share(whole)
        for s in sources:
            pairs = [(sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in sources if o != s]
            terms = [((p[s][t] - q[t]) ** 2 // q[t], t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, items, last in (("pair", pairs, None), ("term", terms, top)):
                ordered = sorted(items, key=lambda x: (-x[0], x[1].encode()))[:last]
                out += [(lang, s, part, item, value, n) for n, (value, item) in enumerate(ordered, 1)]
    return sorted(out)


def rows_of(df):
    return sorted((r["lang"], r["source"], r["part"], r["item"], r["value"], r["rank"]) for r in df.collect())


ODD = [
    (None, None, None), ("", "en", "a"), ("Été été ÉTÉ Die die the The", None, "b"), ("the THE die", "en", None), ("the die été", None, "b"), ("the die the", None, "c"),
    ("die", "", "c"), ("die the", "en", "a"), ("the cat", "en", "a"), ("the cat", "en", "a"), ("the cat 1the2 cat", "en", "ü"), ("x", "only", "one"),
    ("z " * 2000, "en", "hot"), ("中文文本" * 500, "zh", "a"), ("中文文本" * 500, "zh", "b"), ("中文文本" * 500 + " 中", "zh", "c"), ("中", "zh", "c"), ("中", "zh", "d"),
    *((f"word{'abcdefghij'[i % 10]} common {'rare' if i % 17 == 0 else 'usual'} Z", "en", f"s{i % 5}") for i in range(200)),
]
SCHEMA = "text string, lang string, source string, ordinal int, Terms string"


@pytest.mark.parametrize("limits", [(1 << 20, 32 << 20), (8, 200)])
def test_odd_rows(spark, monkeypatch, limits):
    monkeypatch.setattr(divergence, "PART_BYTES", limits[0])
    monkeypatch.setattr(divergence, "PASS_BYTES", limits[1])
    df = spark.createDataFrame([(*row, 1, "x") for row in ODD], SCHEMA).repartition(4)
    assert rows_of(divergence.audit(df)) == plain(ODD)


def test_limits_of_the_caller(spark):
    df = spark.createDataFrame([(*row, 1, "x") for row in ODD], SCHEMA)
    assert rows_of(divergence.audit(df, least=1, top=2)) == plain(ODD, 1, 2)


def test_many_sources(spark):
    rows = [(f"common t{'abcdefgh'[i % 8]}", "en", f"s{i}") for i in range(1100)]
    got = divergence.audit(spark.createDataFrame(rows, "text string, lang string, source string"), top=1).where("part = 'pair' AND source = 's7'")
    p = Counter()
    kept = 9
    for i in range(1100):
        p[i] = {t: 1 + 10**9 * ((t in (8, i % 8)) + 1) // (2 + kept) for t in range(kept)}
    want = {f"s{i}": sum((p[7][t] - p[i][t]) ** 2 // p[i][t] for t in range(kept)) for i in range(1100) if i != 7}
    assert {r["item"]: r["value"] for r in got.collect()} == want


def test_no_rows(spark):
    assert divergence.audit(spark.createDataFrame([], "text string, lang string, source string")).collect() == []


def test_query_equals_sql(spark, sf_dir):
    got = compare.spark_rows(queries.op13_source_divergence(spark, sf_dir))
    assert got == compare.sql_rows(compare.connect(sf_dir), oracles.OP13)
