"""Decontamination against SQL and hand-made documents."""

from __future__ import annotations

import compare
import pytest

from sensorlake.llm import decontamination as dc
from sensorlake.llm import oracles, queries

ITEM = "a b c d e f g h i j k l m n o"
DOCS = [
    (1, "x A, b-c d e f g h i j k l m y"),
    (2, "A b c d e f g h i j k l"),
    (3, None),
    (4, ""),
    (5, "short ITEM here"),
    (6, "short item here " * 3),
    (7, ITEM),
    (7, ITEM),
    (None, ITEM),
    (8, "w " * 30_000 + ITEM),
]


@pytest.fixture(scope="module")
def found(spark):
    docs = spark.createDataFrame([(*row, "kept", 5) for row in DOCS], "doc_id long, text string, N_words string, items int")
    benchmark = spark.createDataFrame([(10, ITEM), (9, "short item"), (11, None), (12, "?!"), (13, ITEM.upper())], "item_id long, text string")
    marked = dc.with_hits(docs, benchmark)
    return marked.select("*", dc.n_hit().alias("n_hit"), dc.contaminated().alias("bad")).collect()


def test_hand_made_rows(found):
    got = [(r.doc_id, r.n_words, r.n_hit, r["items"], r.bad) for r in found]
    both = ["10", "13"]
    assert got == [
        (1, 15, 13, both, True),
        (2, 12, 0, [], False),
        (3, 0, 0, [], False),
        (4, 0, 0, [], False),
        (5, 3, 2, ["9"], True),
        (6, 9, 6, ["9"], True),
        (7, 15, 15, both, True),
        (7, 15, 15, both, True),
        (None, 15, 15, both, True),
        (8, 30_015, 15, both, False),
    ]


def test_several_parts_give_the_same(spark, found):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    benchmark = spark.createDataFrame([(10, ITEM), (9, "short item"), (13, ITEM.upper())], "item_id long, text string")
    marked = dc.with_hits(docs, benchmark, part_bytes=200)
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.n_words)
    same = [(r.n_words, r.hits, r["items"]) for r in sorted(found, key=key)]
    assert [(r.n_words, r.hits, r["items"]) for r in sorted(marked.collect(), key=key)] == same


def test_removal_of_documents_and_of_spans(spark):
    docs = spark.createDataFrame([(*r, "s") for r in DOCS], "doc_id long, text string, hits string")
    benchmark = spark.createDataFrame([(10, ITEM)], "item_id long, text string")
    kept = dc.decontaminate(docs, benchmark)
    assert kept.columns == docs.columns[:2] + ["hits"]
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 4, 5, 6, 8]
    assert {r.hits for r in kept.collect()} == {"s"}
    cut = {r.doc_id: r.text for r in dc.decontaminate(docs, benchmark, spans=True).collect()}
    assert cut[1] == "x\ny"
    assert cut[7] == ""
    assert cut[3] is None
    assert cut[8] == ("w " * 30_000).strip()


def test_empty_tables(spark):
    docs, none = spark.createDataFrame(DOCS, "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    assert {len(r.hits) for r in dc.with_hits(docs, none).collect()} == {0}
    assert dc.with_hits(docs.limit(0), spark.createDataFrame([(1, ITEM)], "item_id long, text string")).collect() == []


def test_query_equals_sql(spark, sf_dir):
    got = compare.spark_rows(queries.op1_decontamination(spark, sf_dir))
    assert got == compare.sql_rows(compare.connect(sf_dir), oracles.OP1)


def test_a_full_part_has_the_bytes_it_says():
    import pyarrow as pa

    words = [" ".join(f"word{i * 13 + k}" for k in range(13)).encode() for i in range(40_000)]
    rows = pa.table({
        "item": [f"item-{i}" for i in range(len(words))], "length": pa.array([13] * len(words), pa.int32()),
        "hash": pa.array([i * 7919 * (-1) ** i for i in range(len(words))], pa.int64()), "words": pa.array(words, pa.binary()),
    })
    said = sum(len(w) for w in words) + sum(len(f"item-{i}") for i in range(len(words))) + 25 * len(words)
    held = dc.NgramSet(rows).nbytes - (1 << dc._BITS)
    assert abs(held - said) < 64
    # So a part of PART_BYTES takes its size and a megabyte per length of windows, of which there are at most 13.
    assert dc.PART_BYTES + 13 * (1 << dc._BITS) < 150e6


def test_an_item_without_an_id_hits_and_has_no_name(spark):
    docs = spark.createDataFrame([(1, "one two three"), (2, "four five")], "doc_id long, text string")
    benchmark = spark.createDataFrame([(None, "one two"), (7, "two three"), (None, None)], "item_id long, text string")
    rows = {r.doc_id: r for r in dc.with_hits(docs, benchmark).collect()}
    assert rows[1]["items"] == ["7"] and [tuple(h) for h in rows[1].hits] == [(0, 3)]
    assert rows[2]["items"] == []
