"""Packing: ids against the tokenizers library, the plan against placing pieces one by one, and whole results."""

from __future__ import annotations

import random
import sys
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sensorlake.llm import packing, queries

FILE = public_tokenizers.path(queries.TOKENIZER_FILE)
OTHER = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(FILE)
ENCODER = packing.encoder(FILE)


def ids(texts, encoder=ENCODER):
    return [np.frombuffer(one, dtype="<u4").tolist() for one in encoder(texts)]


def expected(texts, library=LIBRARY):
    return [one.ids for one in library.encode_batch(texts, add_special_tokens=False)]


# --- ids ------------------------------------------------------------------------------------


def test_documents_equal_the_library(sf_dir):
    texts = pq.read_table(f"{sf_dir}/documents.parquet").column("text").to_pylist()
    assert ids(texts) == expected(texts)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(max_size=60), min_size=1, max_size=5))
def test_any_text_equals_the_library(texts):
    assert ids(texts) == expected(texts)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab aeinrst\n\t'<|endoftext> ", max_size=200))
def test_repeats_and_special_tokens_equal_the_library(text):
    assert ids([text, "a<|endoftext|>" + text]) == expected([text, "a<|endoftext|>" + text])


def test_every_character_equals_the_library():
    points = [c for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    texts = [" a".join(map(chr, points[i : i + 500])) + "1" for i in range(0, len(points), 500)]
    assert ids(texts) == expected(texts)


def test_a_file_of_another_kind_is_left_to_the_library():
    texts = ["A Little text", "", "twice  the\nspace"]
    other = packing.encoder(OTHER)
    assert other._ranked is None
    assert ids(texts, other) == expected(texts, Tokenizer.from_file(OTHER))


# --- the plan -------------------------------------------------------------------------------


def one_by_one(lengths, capacity, rule):
    """Number of sequences when every piece is placed by itself."""
    whole = capacity.whole
    demand = sum(n * capacity.of(length) for length, n in Counter(lengths).items()) / whole
    weight = demand / demand.sum()
    left = []
    for length in sorted(lengths, reverse=True):
        asked = capacity.of(length)
        room = [i for i, one in enumerate(left) if (one >= asked).all()]
        if not room:
            left.append(whole - asked)
            continue
        scores = rule((np.array([left[i] for i in room]) - asked) / whole, asked / whole, weight)
        best = room[int(np.argmin(scores))]
        left[best] = left[best] - asked
    return len(left)


def places(plan, counts):
    """{sequence: [(offset, length)]} of all pieces."""
    out = defaultdict(list)
    keys = plan.length << packing._NUMBER_BITS | plan.first
    for length, n in counts.items():
        for number in range(n):
            row = np.searchsorted(keys, length << packing._NUMBER_BITS | number, side="right") - 1
            into, within = divmod(number - int(plan.first[row]), int(plan.each[row]))
            out[int(plan.sequence[row]) + into].append((int(plan.used[row]) + within * length, length))
    return out


def check_places(found, capacity):
    for pieces in found.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity.tokens
        assert len(pieces) <= capacity.documents
        assert sum(length**2 for _, length in pieces) <= capacity.attention


@pytest.mark.parametrize("rule", packing.RULES.values())
@pytest.mark.parametrize("capacity", [packing.Capacity(20, 20, 400), packing.Capacity(50, 3, 2500), packing.Capacity(50, 50, 2600), packing.Capacity(30, 4, 901)])
def test_groups_are_filled_as_one_by_one(rule, capacity):
    draw = random.Random(1)
    for _ in range(15):
        lengths = [min(capacity.tokens, int(draw.paretovariate(0.7))) for _ in range(draw.randint(1, 120))]
        plan = packing.plan(Counter(lengths), capacity, rule)
        assert plan.sequences == one_by_one(lengths, capacity, rule)
        found = places(plan, Counter(lengths))
        assert sorted(found) == list(range(plan.sequences))
        check_places(found, capacity)


def test_a_plan_does_not_grow_with_the_corpus():
    counts = {length: 1 + 977 * (1 + 7 * length % 13) for length in range(1, 1025)}
    small, large = (packing.best_plan({k: n * times for k, n in counts.items()}, packing.Capacity()) for times in (1, 10**6))
    assert large.length.size < 2 * small.length.size + 4096
    tokens = sum(k * n for k, n in counts.items()) * 10**6
    assert large.sequences < 1.02 * tokens / 1024


def test_no_pieces():
    assert packing.best_plan({}, packing.Capacity()).sequences == 0


def test_a_capacity_below_one_piece_is_refused():
    with pytest.raises(ValueError):
        packing.Capacity(10, 1, 99)


# --- whole results --------------------------------------------------------------------------


def crc(words):
    return zlib.crc32(np.array(words, dtype="<u4").tobytes())


def check(rows, texts, tokens=1024):
    """Every piece of every document is there once and in its place; the sequences it uses."""
    want = Counter()
    for doc, text in texts:
        words = [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 2]
        first = (len(words) - 1) % tokens + 1
        cuts = [0, *range(first, len(words) + 1, tokens)]
        for number, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            want[doc, number, a, b - a, crc(words[a:b])] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    used = defaultdict(list)
    for r in rows:
        used[r.sequence_id].append((r.offset, r.length))
    check_places(used, packing.Capacity(tokens, 10**9, 10**18))
    return used


def test_query(spark, sf_dir):
    texts = [(r.doc_id, r.text) for r in queries.table(spark, sf_dir, "documents").collect()]
    rows = queries.op11_best_fit_packing(spark, sf_dir).collect()
    used = check(rows, texts)
    tokens = sum(r.length for r in rows)
    assert -(-tokens // 1024) <= len(used) <= 1.02 * tokens / 1024 + 1


ROWS = [
    (1, None, 9, 9), (2, "", 9, 9), (3, "one two three", 9, 9), (3, "one two three", 9, 9), (None, "a b c d", 9, 9), (None, None, 9, 9),
    (4, "word " * 3000, 9, 9), (5, "x" * 5000, 9, 9), (6, "naïve 😀\n\n  end ", 9, 9), *((10 + i, "same text again", 9, 9) for i in range(300)),
]


def frame(spark, rows, parts=5):
    return spark.createDataFrame(rows, "doc_id long, text string, length int, Sequence_ID int").repartition(parts)


def test_odd_rows(spark):
    rows = packing.packed(frame(spark, ROWS), FILE).collect()
    assert rows[0].asDict().keys() == {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"}
    check(rows, [r[:2] for r in ROWS])


def test_no_rows(spark):
    assert packing.packed(frame(spark, [], 1), FILE).collect() == []


def test_documents_per_sequence_and_attention_bind(spark):
    capacity = packing.Capacity(64, 3, 64 * 64)
    rows = packing.packed(frame(spark, ROWS), FILE, capacity).collect()
    used = check(rows, [r[:2] for r in ROWS], 64)
    check_places(used, capacity)


def test_sequences_hold_their_documents(spark):
    placed = packing.packed(frame(spark, ROWS), FILE, packing.Capacity(256, 256, 65536), ids=True)
    rows = placed.collect()
    check(rows, [r[:2] for r in ROWS], 256)
    for r in packing.sequences(placed).collect():
        at = 0
        assert len(r.ids) <= 256
        for part in r.documents:
            words = r.ids[at : at + part.length]
            at += part.length
            assert any(x.doc_id == part.doc_id and x.piece == part.piece and x.ids == words for x in rows)
        assert at == len(r.ids)


def test_texts_without_an_end_token(spark):
    rows = packing.packed(frame(spark, ROWS[:4]), FILE, end_id=None).collect()
    empty = [r for r in rows if r.doc_id in (1, 2)]
    assert [(r.length, r.sequence_id, r.offset) for r in empty] == [(0, None, None)] * 2
