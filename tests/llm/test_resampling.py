"""Importance resampling against a plain Python version, held-out labels and hand-made rows."""

from __future__ import annotations

import math
import random
import re

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from sensorlake.llm import queries, resampling

TOKEN = re.compile(rb"[0-9A-Za-z\x80-\xff]+|[^0-9A-Za-z\x80-\xff\x20\x09-\x0d]+")


def test_features_are_those_of_a_plain_reading():
    texts = ["Ab c-d d d", "", None, " \n", "d c Ab", "x" * 70_000]
    buckets, owner, count, _ = resampling._features(pa.array(texts))
    tokens = [TOKEN.findall((t or "").encode()) for t in texts]
    assert count.tolist() == [len(t) for t in tokens]
    flat = [(i, t) for i, ts in enumerate(tokens) for t in ts]
    pairs = [(i, ("repeat",) if a == b else (a, b)) for i, ts in enumerate(tokens) for a, b in zip(ts, ts[1:])]
    assert owner.tolist() == [i for i, _ in flat + pairs]
    named = {}
    for (_, feature), bucket in zip(flat + pairs, buckets.tolist(), strict=True):
        assert named.setdefault(feature, bucket) == bucket
    assert len(set(named.values())) == len(named)


def test_log_ratio_of_counts():
    total = np.zeros((2, 2 * resampling.BUCKETS), dtype=np.int64)
    total[0, :2], total[1, 1] = [6, 2], 2
    ratio = resampling.log_ratios(total)
    size = resampling.BUCKETS
    assert ratio[1] == pytest.approx(math.log(3 / (2 + size)) - math.log(3 / (8 + size)))
    assert ratio[0] == pytest.approx(math.log(1 / (2 + size)) - math.log(7 / (8 + size)))
    assert ratio[size] == 0


def test_noise_is_standard_gumbel_and_repeats():
    ids = pa.array(range(100_000), pa.int64())
    noise = resampling.gumbel(ids, np.zeros(100_000, np.uint64), 3)
    assert abs(noise.mean() - 0.5772) < 0.02
    assert abs(noise.std() - math.pi / math.sqrt(6)) < 0.02
    assert (noise == resampling.gumbel(ids, np.zeros(100_000, np.uint64), 3)).all()
    assert (noise != resampling.gumbel(ids, np.zeros(100_000, np.uint64), 4)).any()


@pytest.mark.parametrize("kept", [5, 10_000])
def test_kth_largest(spark, monkeypatch, kept):
    monkeypatch.setattr(resampling, "_KEPT_ROWS", kept)
    rng = random.Random(kept)
    values = [rng.choice([rng.gauss(0, 1), rng.gauss(0, 1e6), 3.0]) for _ in range(3000)]
    rows = spark.createDataFrame([(v,) for v in values], "x double")
    for k in (1, 2, 700, 1500, 2999, 3000):
        assert resampling.kth_largest(rows, "x", k) == sorted(values, reverse=True)[k - 1]
    assert resampling.kth_largest(rows, "x", 0) is None
    assert resampling.kth_largest(rows, "x", 3001) is None


def test_cut():
    assert resampling.cut(np.array([5.0, 6.0]), np.array([1.0, 2.0])) == 3.5
    assert resampling.cut(np.array([5.0]), np.array([])) == -np.inf


def test_rows_drawn_are_the_largest_draws(spark, sf_dir):
    docs, labels = (queries.table(spark, sf_dir, name) for name in ("documents", "labels"))
    fit, _, _ = resampling.labelled(labels.select("doc_id", "quality"))
    draws = sorted(((r.draw, r.doc_id) for r in resampling.weighted(docs, resampling.fitted_ratio(docs, fit), keep=["doc_id"]).where("n_tokens > 0").collect()), reverse=True)
    got = {r.doc_id for r in resampling.resampled(docs, labels, k=40).where("sampled").collect()}
    assert got == {i for _, i in draws[:40]}


def test_weights_equal_a_plain_version(spark, sf_dir):
    docs, labels = (queries.table(spark, sf_dir, name) for name in ("documents", "labels"))
    fit, _, _ = resampling.labelled(labels.select("doc_id", "quality"))
    table = pq.read_table(f"{sf_dir}/documents.parquet")
    buckets, owner, _, _ = resampling._features(table.column("text").combine_chunks())
    ids = np.array(table.column("doc_id").to_pylist())
    total = np.stack([np.bincount(buckets[m[owner]], minlength=2 * resampling.BUCKETS) for m in (np.ones(ids.size, bool), np.isin(ids, fit))])
    want = np.bincount(owner, weights=resampling.log_ratios(total)[buckets], minlength=ids.size)
    got = {r.doc_id: r.log_weight for r in resampling.weighted(docs, resampling.fitted_ratio(docs, fit), keep=["doc_id"]).collect()}
    assert [got[i] for i in ids.tolist()] == pytest.approx(want.tolist())


def test_hand_made_rows(spark):
    good, junk = "a fine plain sentence of words. ", "%%% ### $$$ &&& "
    rows = [(i, good * 5) for i in range(40)] + [(100 + i, junk * 9) for i in range(20)]
    rows += [(200, None), (201, ""), (202, " \n"), (None, good * 5), (203, good * 5 + " " * 300_000), (203, good * 5), (204, junk * 5_000)]
    docs = spark.createDataFrame([(*r, "s", 1.0) for r in rows], "doc_id long, text string, N_TOKENS string, log_weight double")
    labels = spark.createDataFrame([(i, 1, "x") for i in range(20)] + [(100 + i, 0, "x") for i in range(10)] + [(None, 1, "x"), (5, None, "x")], "doc_id long, quality int, text string")
    kept = resampling.accepted(docs, labels)
    assert kept.columns == docs.columns
    assert {(r["N_TOKENS"], r.log_weight) for r in kept.collect()} == {("s", 1.0)}
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [*range(40), 203, 203]
    assert None in ids


def test_no_rows_and_no_labels(spark):
    docs = spark.createDataFrame([(1, "some words"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.doc_id: r.sampled for r in resampling.resampled(docs, labels).collect()} == {1: True, 2: False}
    assert resampling.resampled(docs.limit(0), labels).collect() == []


def test_held_out_labels(spark):
    sf_dir = "/root/testdata/sf0.1"
    labels = queries.table(spark, sf_dir, "labels")
    fit, _, _ = resampling.labelled(labels.select("doc_id", "quality"))
    rows = queries.op10_quality_classifier(spark, sf_dir).join(labels, "doc_id").where(~F.col("doc_id").isin(fit.tolist())).collect()
    kept = {q: sum(r.sampled for r in rows if r.quality == q) / sum(r.quality == q for r in rows) for q in (0, 1)}
    assert kept[1] > 0.99
    assert kept[0] < 0.05
