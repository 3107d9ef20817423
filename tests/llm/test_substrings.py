"""Substring dedup against SQL, brute force and hand-made documents."""

from __future__ import annotations

import random

import compare

from sensorlake.llm import oracles, queries, substrings

N = substrings.WINDOW


def brute(rows):
    """{row number: removed words} by comparing every window of every document."""
    first = {}
    split = [(i, (text or "").encode().split()) for i, text in rows]
    for doc, words in split:
        for k in range(len(words) - N + 1 if doc is not None else 0):
            key = tuple(words[k : k + N])
            first[key] = min(first.get(key, doc), doc)
    out = []
    for doc, words in split:
        gone = set()
        for k in range(len(words) - N + 1 if doc is not None else 0):
            if first[tuple(words[k : k + N])] < doc:
                gone.update(range(k, k + N))
        out.append(gone)
    return out


def removed(df):
    got = substrings.with_repeats(df).collect()
    return sorted((r.doc_id is None, r.doc_id or 0, r.text or "", r.n_words, [k for s in r.repeats for k in range(s["start"], s["end"])]) for r in got)


def expected(rows):
    return sorted((d is None, d or 0, t or "", len((t or "").split()), sorted(g)) for (d, t), g in zip(rows, brute(rows)))


def test_the_cover_holds_every_distance():
    assert {(a - b) % substrings.PERIOD for a in substrings.COVER for b in substrings.COVER} == set(range(substrings.PERIOD))


def test_shared_passages_at_any_alignment(spark):
    rng = random.Random(5)
    word = lambda: f"w{rng.randrange(10**6)}"
    passages = [[word() for _ in range(n)] for n in (49, 50, 51, 63, 120, 400)]
    rows = []
    for doc in range(240):
        text = [word() for _ in range(rng.randrange(40))]
        for _ in range(rng.randrange(4)):
            p = rng.choice(passages)
            start = rng.randrange(max(1, len(p) - N)) if rng.random() < 0.5 else 0
            text += p[start:] + [word() for _ in range(rng.randrange(3))]
        rows.append((doc * 3 % 241, rng.choice([" ", "\n", "\t  "]).join(text)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert removed(df) == expected(rows)
    assert any(brute(rows))


def test_hand_made_rows(spark):
    long = " ".join(f"a{i}" for i in range(60))
    loop = "same line of words " * 5_000
    rows = [(5, long), (5, long), (7, long), (3, "x " + long + " y"), (None, long), (8, None), (9, ""), (10, " \n "), (11, loop), (12, loop), (2, "a1 a2")]
    df = spark.createDataFrame([(*r, "s", 1) for r in rows], "doc_id long, text string, source string, N_WORDS int")
    assert removed(df) == expected(rows)
    out = substrings.deduplicated(df)
    assert out.columns == df.columns
    kept = {(r.doc_id, r.text) for r in out.collect()}
    assert {(r.source, r["N_WORDS"]) for r in out.collect()} == {("s", 1)}
    assert {(7, ""), (5, ""), (3, "x " + long + " y"), (None, long), (8, None), (10, " \n "), (11, loop), (12, "")} <= kept


def test_no_rows(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert substrings.with_repeats(none).collect() == []


def test_query_equals_sql(spark, sf_dir):
    got = compare.spark_rows(queries.op9_substring_dedup(spark, sf_dir))
    assert got == compare.sql_rows(compare.connect(sf_dir), oracles.OP9)
