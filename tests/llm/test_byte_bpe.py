"""Byte-level BPE against the tiktoken library, and round trips."""

from __future__ import annotations

import base64
import hashlib
import sys

import public_tokenizers
import pyarrow.parquet as pq
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from sensorlake.llm import bytebpe, queries

FILE, PATTERN = public_tokenizers.path(queries.RANK_FILE), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def reference():
    with open(FILE, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("reference", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids(texts):
    return [one.ids for one in bytebpe.byte_bpe(FILE, PATTERN).encode(texts)]


def test_every_document_equals_the_reference_library(reference, sf_dir):
    texts = pq.read_table(f"{sf_dir}/documents.parquet").column("text").to_pylist()
    assert ids(texts) == [reference.encode_ordinary(t) for t in texts]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(max_size=60), min_size=1, max_size=5))
def test_any_text_equals_the_reference_library(reference, texts):
    assert ids(texts) == [reference.encode_ordinary(t) for t in texts]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab aeinrst\n\t'", max_size=200))
def test_repeated_letters_equal_the_reference_library(reference, text):
    assert ids([text]) == [reference.encode_ordinary(text)]


def test_every_character_equals_the_reference_library(reference):
    points = [c for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    texts = [" a".join(map(chr, points[i : i + 500])) + "1" for i in range(0, len(points), 500)]
    wrong = [i for i, (a, b) in enumerate(zip(ids(texts), map(reference.encode_ordinary, texts), strict=True)) if a != b]
    assert not wrong


def test_hand_made_rows(spark):
    rows = [(1, None, 7), (2, "", 7), (3, "naïve 😀 x", 7), (3, "naïve 😀 x", 7), (None, "ab " * 50_000, 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, IDS int")
    out = bytebpe.decoded(bytebpe.encoded(df, FILE, PATTERN, offsets=True), FILE, PATTERN).collect()
    assert [c for c in out[0].asDict()] == ["doc_id", "text", "ids", "offsets", "decoded"]
    for row in out:
        text = row.text or ""
        assert bytes(row.decoded) == text.encode()
        assert len(row.ids) == len(row.offsets)
        covered = {i for span in row.offsets for i in range(span["start"], span["end"])}
        assert covered == set(range(len(text)))


def test_a_split_character_decodes_to_its_bytes(spark):
    model = bytebpe.byte_bpe(FILE, PATTERN)
    found = next(c for c in map(chr, range(0x2600, 0x3000)) if len(ids([c])[0]) > 1)
    parts = [[i] for i in ids([found])[0]]
    out = bytebpe.decoded(spark.createDataFrame([(p,) for p in parts], "ids array<int>"), FILE, PATTERN).collect()
    assert b"".join(bytes(r.decoded) for r in out) == found.encode()
    assert model.decode([]) == b""


def test_no_rows(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert bytebpe.encoded(none, FILE, PATTERN).collect() == []


def test_query(spark, sf_dir, reference):
    rows = {r.doc_id: r for r in queries.op5_byte_bpe(spark, sf_dir).collect()}
    docs = pq.read_table(f"{sf_dir}/documents.parquet").to_pylist()
    assert len(rows) == len(docs)
    for doc in docs:
        want, text = reference.encode_ordinary(doc["text"] or ""), (doc["text"] or "").encode()
        got = rows[doc["doc_id"]]
        assert got.n_tokens == len(want)
        assert got.ids_sha256 == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()
        assert got.decoded_sha256 == hashlib.sha256(text).hexdigest()
