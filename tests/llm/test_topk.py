"""Exact top-k against brute force, SQL and hand-made vectors."""

from __future__ import annotations

import random

import compare
import pytest
from pyspark.sql import functions as F

from sensorlake.llm import oracles, queries, topk


def brute(rows, k, is_query):
    whole = {i: v for i, v in rows}
    out = []
    for q in (i for i in whole if is_query(i)):
        scores = sorted((-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in whole.items() if i != q and len(v) == len(whole[q]))
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize("block", [3, 4096])
def test_ties_and_ranges(spark, block):
    rows = [(i, [(i * 7) % 5 - 2, i % 3, -(i % 2)]) for i in range(400)] + [(i, [1, 1, 1]) for i in range(400, 900)]
    df = spark.createDataFrame([(i, [float(x) / 256 for x in v]) for i, v in rows], "vec_id long, embedding array<double>").repartition(7)
    got = topk.top_k(df, F.col("vec_id") % 50 == 0, block=block).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == brute(rows, 5, lambda i: i % 50 == 0)


def test_rows_that_take_no_part(spark):
    rows = [
        (0, [1.0, 0.5], 1), (1, [0.5, 0.5], 2), (2, None, 3), (3, [1.0, None], 4), (4, [float("nan"), 1.0], 5),
        (5, [float("inf"), 1.0], 6), (None, [1.0, 1.0], 7), (6, [1.0], 8), (50, [2.0, -0.001], 9), (7, [], 10),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int")
    got = topk.top_k(df, F.col("vec_id") % 50 == 0).collect()
    assert sorted(map(tuple, got)) == [(0, 1, 50, 131072 - 128), (0, 2, 1, 49152), (50, 1, 0, 131072 - 128), (50, 2, 1, 65536 - 128)]


@pytest.mark.parametrize("size", [1, 2**21, 2**26 - 3, 2**27, 2**30])
def test_scores_on_both_sides_of_what_a_float_holds(spark, size):
    """Neighbouring scores, ties, and both signs, up to nearly the range of LONG."""
    rng = random.Random(size)
    # Components that floor(256 x) gives back exactly.
    rows = [(i, [size * rng.choice([1, -1]) + rng.randrange(-2, 3), size - rng.randrange(3), rng.randrange(-1, 2)]) for i in range(240)]
    rows += [(300 + i, [size, size - 1, 1]) for i in range(8)]  # ties
    df = spark.createDataFrame([(i, [x / 256 for x in v], 1, False) for i, v in rows], "vec_id long, embedding array<double>, score int, IS_QUERY boolean")
    got = topk.top_k(df.repartition(5), F.col("vec_id") % 50 == 0, block=3).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == brute(rows, 5, lambda i: i % 50 == 0)


def test_components_four_hundred_thousand(spark):
    """Scores that differ by one beyond 2**53."""
    rows = [(0, [400_000 * 256, 1]), *((i, [400_000 * 256, 5 - i]) for i in range(1, 6))]
    df = spark.createDataFrame([(i, [x / 256 for x in v]) for i, v in rows], "vec_id long, embedding array<double>")
    got = topk.top_k(df, F.col("vec_id") == 0).collect()
    assert [(r["rank"], r.vec_id, r.score) for r in sorted(got, key=lambda r: r["rank"])] == [(n, n, 10485760000000000 + 5 - n) for n in range(1, 6)]


def test_a_score_that_is_no_long_is_an_error(spark):
    df = spark.createDataFrame([(i, [2.0**30, 2.0**30]) for i in (0, 1)], "vec_id long, embedding array<double>")
    with pytest.raises(ValueError, match="LONG"):
        topk.top_k(df, F.col("vec_id") == 0)


def test_no_rows(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(none, F.col("vec_id") % 50 == 0).collect() == []


def test_query_equals_sql(spark, sf_dir):
    got = compare.spark_rows(queries.op6_exact_top_k(spark, sf_dir))
    assert got == compare.sql_rows(compare.connect(sf_dir), oracles.OP6)
