"""Similarity join against SQL, brute force and hand-made documents."""

from __future__ import annotations

import random
import re

import compare
import numpy as np
import pytest

from sensorlake.llm import graph, jaccard, oracles, queries


def shingles(text):
    words = re.findall(r"[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    sets = [frozenset(shingles(text)) for _, text in rows]
    distinct = sorted({s for s in sets if s}, key=sorted)
    near = {s: [t for t in distinct if t != s and 5 * len(s & t) >= 4 * len(s | t)] for s in distinct}
    low = lambda ids: min((i for i in ids if i is not None), default=None)
    copy = {s: low(d for (d, _), t in zip(rows, sets) if t == s) for s in distinct}
    out = []
    for (doc, _), s in zip(rows, sets):
        if not s:
            out.append((doc, doc, doc, 0))
            continue
        seen, todo = {s}, [s]
        while todo:
            for t in near[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        out.append((doc, low(copy[t] for t in seen), copy[s], len(near[s])))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in jaccard.near_duplicates(df).collect()), key=str)


def near_copies(rng, groups, most):
    """Groups of texts that differ from their base in a few words, more or less than the threshold."""
    rows = []
    for _ in range(groups):
        base = [f"w{rng.randrange(10**6)}" for _ in range(rng.randrange(4, 120))]
        for _ in range(rng.randrange(1, most)):
            text = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                text[rng.randrange(len(text))] = f"x{rng.randrange(10**6)}"
            rows.append((len(rows) * 7 % 10007, " ".join(text)))
    return rows


@pytest.mark.parametrize("bucket, block", [(512, 512), (16, 8)])
def test_groups_of_near_copies(spark, monkeypatch, bucket, block):
    monkeypatch.setattr(jaccard, "BUCKET", bucket)
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rows = near_copies(random.Random(bucket), 12, 60)
    assert found(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)) == brute(rows)


def test_hand_made_rows(spark):
    long = " ".join(f"w{i}" for i in range(200))
    rows = [
        (9, long), (4, long.upper()), (4, long), (6, long + " more"), (None, long + "!"), (1, None), (2, ""), (3, "?!"),
        (7, "two words"), (8, "Two, words"), (10, "two"), (None, "alone here"), (11, "la " * 40_000), (12, "la la la la la"),
    ]
    df = spark.createDataFrame([(*r, "s", 3, 4) for r in rows], "doc_id long, text string, s string, class_id int, size int")
    assert found(df) == brute(rows)
    kept = jaccard.one_of_each(df)
    assert kept.columns == df.columns
    ids = sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect())
    # Rows without an id share that, so both stay: one of them is first in its class.
    assert ids == [(False, 1), (False, 2), (False, 3), (False, 4), (False, 4), (False, 7), (False, 10), (False, 11), (True, 0), (True, 0)]


def test_no_rows(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert found(none) == []
    assert jaccard.one_of_each(none).collect() == []


def test_recall_of_the_walk():
    assert jaccard._caught(0.8, 1) == pytest.approx(0.84)
    assert 1 - jaccard._caught(0.8, 4) == pytest.approx(0.4237, abs=1e-3)


def test_sampled_tokens_estimate_the_similarity():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 1 << 48, 1200).astype(np.uint64)
    both = np.concatenate([np.sort(values[:1000]), np.sort(values[200:])])
    tokens = jaccard._tokens(both, np.array([0, 1000, 2000]))
    assert abs((tokens[0] == tokens[1]).mean() - 800 / 1200) < 0.15


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(300)] + [(1000, i) for i in range(1001, 1200)] + [(5000, 5000), (7, 3), (7, 3)]
    got = graph.components(spark.createDataFrame(links, "a long, b long")).collect()
    assert len({r.root for r in got if r.node <= 300}) == 1
    assert len({r.root for r in got if 1000 <= r.node < 1200}) == 1
    assert len({r.root for r in got}) == 2
    assert len(got) == 301 + 200


def test_components_by_contraction_alone(spark, monkeypatch):
    monkeypatch.setattr(graph, "LAST", 0)
    test_components_of_chains_and_stars(spark)


def test_groups_are_whole_and_large_ones_passed_over():
    import pyarrow as pa

    nodes = np.repeat(np.arange(40), [1, 7, 300, 2, 30] * 8)
    whole = pa.RecordBatch.from_arrays([pa.array(nodes)], ["node"])
    for size in (1, 5, 64, 10_000):
        batches = [whole.slice(i, size) for i in range(0, nodes.size, size)]
        for most in (None, 100):
            got = [g.column("node").to_numpy() for g in jaccard._groups(iter(batches), 50, most)]
            seen = np.concatenate(got)
            counted = {n: (seen == n).sum() for n in range(40)}
            for n in range(40):
                assert counted[n] in ((nodes == n).sum(), 0 if most and (nodes == n).sum() > most else -1) or (nodes == n).sum() > (most or 10**9)
            assert sum(n in set(g.tolist()) for g in got for n in set(g.tolist())) == len(set(seen.tolist()))


def test_a_large_group_of_near_copies_and_common_passages(spark, monkeypatch):
    """A hot group, split over blocks, beside many texts that share a passage."""
    monkeypatch.setattr(jaccard, "BUCKET", 32)
    rng = random.Random(3)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(300):
        text = list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 3])):
            text[rng.randrange(150)] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(text)))
    passage = " ".join(f"p{i}" for i in range(30))
    rows += [(1000 + i, f"{passage} " + " ".join(f"y{rng.randrange(10**6)}" for _ in range(20))) for i in range(300)]
    assert found(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)) == brute(rows)


def unlike_texts_and_copies(rng):
    rows = near_copies(rng, 6, 20)
    passage = " ".join(f"p{i}" for i in range(30))
    return rows + [(20_000 + i, f"{passage} " + " ".join(f"y{rng.randrange(10**6)}" for _ in range(20))) for i in range(200)]


@pytest.mark.parametrize("bucket", [512, 8])
def test_runs_do_not_follow_the_size_of_nodes(spark, monkeypatch, bucket):
    monkeypatch.setattr(jaccard, "BUCKET", bucket)
    made, walk = [], jaccard._walk
    monkeypatch.setattr(jaccard, "_walk", lambda sets, runs: made.append(runs) or walk(sets, runs))
    rows = unlike_texts_and_copies(random.Random(5))
    assert found(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)) == brute(rows)
    assert made == [range(2), range(2, 11)]
    assert (1 - jaccard._caught(0.8, jaccard.DEPTH)) ** 11 < 1e-4 < (1 - jaccard._caught(0.8, jaccard.DEPTH)) ** 10


def test_what_is_moved_for_each_set_is_small(spark, monkeypatch):
    """Sets go to nodes as sketches, and only linked ones meet their roots with their tokens."""
    monkeypatch.setattr(jaccard, "BUCKET", 32)
    nodes, roots, by_node, stored = [], [], jaccard._by_node, jaccard.stored

    def seen_by_node(rows):
        if "root" in rows.columns:
            wide = [c for c, kind in rows.dtypes if kind == "binary"]
            nodes.extend(len(r[0]) for r in rows.select(*wide).collect())
        return by_node(rows)

    def seen_stored(df):
        out = stored(df)
        if {"root", "tokens"} <= set(out.columns):
            roots.append(out.count())
        return out

    monkeypatch.setattr(jaccard, "_by_node", seen_by_node)
    monkeypatch.setattr(jaccard, "stored", seen_stored)
    rows = unlike_texts_and_copies(random.Random(6))
    assert found(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)) == brute(rows)
    assert set(nodes) == {jaccard.COORDINATES * jaccard.SKETCH_BITS // 8}
    assert len(roots) == 1 and 0 < roots[0] < len({frozenset(shingles(text)) for _, text in rows}) - 150


def test_sketches_agree_where_tokens_do_and_seldom_elsewhere():
    rng = np.random.default_rng(2)
    tokens = rng.integers(0, 1 << 32, (3, jaccard.COORDINATES)).astype(np.uint32)
    tokens[1, :100] = tokens[0, :100]
    bits = jaccard._opened(jaccard._sketches(tokens))
    assert bits.shape == tokens.shape and bits.max() < 1 << jaccard.SKETCH_BITS
    assert 100 <= (bits[0] == bits[1]).sum() <= 108
    assert (bits[0] == bits[2]).sum() < 24
    # Texts of one shingle: the token of a pair differs at each coordinate, and so do its bits.
    one = jaccard._tokens(np.array([5 << 16, (5 + (1 << 12)) << 16], np.uint64), np.array([0, 1, 2]))
    bits = jaccard._opened(jaccard._sketches(one))
    assert (bits[0] == bits[1]).sum() < 24


def test_packed_shingles_come_back():
    values = np.array([0, 1, (1 << 48) - 1, 0x123456789ABC], dtype=np.uint64)
    packed = np.frombuffer(jaccard._packed(values), np.uint8)
    assert packed.size == 4 * jaccard.SHINGLE_BYTES
    assert (jaccard._unpacked(packed) == values).all()


def test_query_equals_sql(spark, sf_dir):
    got = compare.spark_rows(queries.op7_ngram_jaccard(spark, sf_dir))
    assert got == compare.sql_rows(compare.connect(sf_dir), oracles.OP7)
