"""Fill in the middle: units against a regular expression, whole rows against a plain version and SQL."""

from __future__ import annotations

import hashlib
import re

import compare
import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from sensorlake.llm import middle, oracles, queries
from sensorlake.llm.words import column_bytes

UNIT = re.compile("[\x20\x09-\x0d]*[^\x20\x09-\x0d]+|[\x20\x09-\x0d]+")
ALPHABET = "ab \t\n\x0b\x0c\r\x00\x08\x0e\x1c\x1f\x21\x7f\u0080\u0085 é 中😀"


@settings(max_examples=500, deadline=None)
@given(st.lists(st.text(alphabet=ALPHABET, max_size=40), min_size=1, max_size=6), st.integers(0, 10**6))
def test_units_equal_the_expression(texts, draw):
    data, bounds = column_bytes(pa.array(texts))
    units = [UNIT.findall(text) for text in texts]
    found = middle.Units(data, bounds)
    assert found.counts.tolist() == [len(u) for u in units]
    some = np.array([draw % (len(u) + 1) for u in units])
    assert found.end_of(some).tolist() == [int(b) + len("".join(u[:n]).encode()) for b, u, n in zip(bounds, units, some, strict=False)]


def test_every_byte_is_told_apart():
    data = np.arange(256, dtype=np.uint8)
    marks = middle.spaces(middle.as_words(data)).view(np.uint8)[:256]
    assert np.flatnonzero(marks).tolist() == [9, 10, 11, 12, 13, 32]


def plain(doc_id, text):
    """One row as the definition says."""
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]
    low, high = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    prefix, mid, suffix = ("".join(u) for u in (units[:low], units[low:high], units[high:]))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return len(units), "plain", None, None, text
    if h[3] % 100 < 80:
        return len(units), "spm", len(prefix), len(mid), f"<S>{suffix}<P>{prefix}<M>{mid}"
    return len(units), "psm", len(prefix), len(mid), f"<P>{prefix}<S>{suffix}<M>{mid}"


ROWS = [
    (None, "a null id", 1), (None, None, 1), (1, None, 2), (2, "", 2), (3, " \n ", 2), (3, " \n ", 2), (4, "holds <M> itself", 3),
    *((i, "naïve 😀 < S> <P < S>> ends in space \n" * (i % 7), i) for i in range(10, 90)), (90, "x" * 100_000, 4), (91, "long text " * 50_000, 4),
    (92, "<", 5), (93, "P> <S", 5), (94, "tail <", 5),
]


def test_odd_rows_and_restoring(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, OUTPUT int").repartition(3)
    made = middle.transformed(df)
    assert made.columns == ["doc_id", "text", "n_units", "form", "prefix_chars", "middle_chars", "output"]
    rows = made.withColumn("again", middle.restored()).collect()
    assert len(rows) == len(ROWS)
    for r in rows:
        assert (r.n_units, r.form, r.prefix_chars, r.middle_chars, r.output) == plain(r.doc_id, r.text)
        assert r.again == (r.text or "")
    assert {r.form for r in rows} == {"plain", "spm", "psm"}


def test_a_sentinel_over_two_texts_is_none(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(["a<", "P>b", "<S", ">", "<P", "><M>"] * 9)], "doc_id long, text string").coalesce(1)
    for r in middle.transformed(df).collect():
        assert r.output == plain(r.doc_id, r.text)[4]


def test_rates(spark):
    df = spark.createDataFrame([(i, "some words here") for i in range(50)], "doc_id long, text string")
    assert {r.form for r in middle.transformed(df, rate=0).collect()} == {"plain"}
    assert {r.form for r in middle.transformed(df, rate=100, spm_rate=0).collect()} == {"psm"}


def test_no_rows(spark):
    assert middle.transformed(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_query_equals_sql(spark, sf_dir):
    got = compare.spark_rows(queries.op12_fill_in_middle(spark, sf_dir))
    assert got == compare.sql_rows(compare.connect(sf_dir), oracles.OP12)
