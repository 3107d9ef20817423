"""Language identification against an enumeration of segmentations, held-out rows and hand-made texts."""

from __future__ import annotations

import math
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sensorlake.llm import langid, queries

VOCABULARY = sorted({b" a", b" ab", b"ab", b"ba", b"aba", b"b", *(bytes([b]) for b in range(256))})


def segmentations(word):
    if not word:
        yield ()
    for n in range(1, len(word) + 1):
        if word[:n] in VOCABULARY:
            for rest in segmentations(word[n:]):
                yield (word[:n], *rest)


@pytest.fixture(scope="module")
def small():
    return langid.fit({"x": {b"abab": 5, b"a": 2}, "y": {b"ba": 3, b"bb": 4}}, VOCABULARY)


def test_probability_is_the_sum_over_segmentations(small):
    chance = {p: small.chance[i] for i, p in enumerate(VOCABULARY)}
    for word in (b"a", b"abab", b"babba", b"zab"):
        want = sum(math.prod(chance[p][k] for p in s) for s in segmentations(b" " + word) for k in [0])
        got = small.log_words(langid.Distinct.listed([word]))
        assert got[0, 0] == pytest.approx(math.log(want))


def test_probabilities_sum_to_one_and_fitting_raises_the_likelihood(small):
    assert small.chance.sum(axis=0) == pytest.approx([1, 1])
    words = {"x": {b"abab": 5, b"a": 2, b"bab": 1}}
    likelihood = []
    for rounds in (1, 2, 6):
        model = langid.fit(words, VOCABULARY, rounds)
        logs = model.log_words(langid.Distinct.listed(list(words["x"])))[:, 0]
        likelihood.append(float(logs @ np.array(list(words["x"].values()))))
    assert likelihood == sorted(likelihood)


def test_texts_add_up_their_words(small):
    logs = small.log_texts(pa.array(["Abab, ba!", None, "12", "b" * 1000]))
    parts = small.log_words(langid.Distinct.listed([b"abab", b"ba", b"b" * 1000]))
    assert logs[0] == pytest.approx(parts[0] + parts[1])
    assert logs[1].tolist() == logs[2].tolist() == [0, 0]
    assert logs[3] == pytest.approx(parts[2])


def exact(word, pieces):
    """The sum over all segmentations of a space and the word, in fractions of any size."""
    said = b" " + word
    longest = max(map(len, pieces))
    sums = [Fraction(1)] + [Fraction(0)] * len(said)
    for end in range(1, len(said) + 1):
        for n in range(1, min(longest, end) + 1):
            if said[end - n : end] in pieces:
                sums[end] += sums[end - n] * pieces[said[end - n : end]]
    return math.log(sums[-1].numerator) - math.log(sums[-1].denominator)


def test_whole_vocabulary_and_whole_words():
    """Sums over every segmentation into any piece, for words from one byte to thousands, far below what a float holds."""
    vocabulary = langid.vocabulary(public_tokenizers.path(queries.PIECE_FILE))
    assert max(map(len, vocabulary)) == 25
    rng = random.Random(5)
    letters = [p.strip() for p in vocabulary if p.strip().isalpha() or p.strip()[:1] >= b"\x80"]
    words = {"x": {w: rng.randrange(1, 9) for w in (b"".join(rng.choices(letters, k=3)) for _ in range(200)) if w}}
    model = langid.fit(words, vocabulary, 2)
    chance = {p: Fraction(float(model.chance[i, 0])) for i, p in enumerate(vocabulary)}
    asked = ["a", "information", "translationgovernment", "международный", "これは日本語の長い文章です" * 12, "ж" * 700, "abcdefgh" * 60, "中文"]
    asked += ["".join(rng.choices("abcdeéж日", k=rng.randrange(1, 90))) for _ in range(25)]
    got = model.log_words(langid.Distinct.listed([w.encode() for w in asked]))[:, 0]
    assert got == pytest.approx([exact(w.encode(), chance) for w in asked])


def test_predictions_equal_a_plain_version(spark):
    """Every document of a table, scored piece by piece from the same probabilities."""
    sf_dir = "/root/testdata/sf0.01"
    docs = queries.table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    vocabulary = langid.vocabulary(public_tokenizers.path(queries.PIECE_FILE))
    fold = F.crc32(F.col("doc_id").cast("string")) % 5
    model = langid.learned(docs, fold != 0, vocabulary)
    pieces = {p: model.chance[i] for i, p in enumerate(vocabulary)}
    known = {}

    def logs(word):
        if word not in known:
            said = b" " + word
            sums = [np.ones(len(model.languages))] + [np.zeros(len(model.languages)) for _ in said]
            for end in range(1, len(said) + 1):
                for n in range(1, min(25, end) + 1):
                    piece = pieces.get(said[end - n : end])
                    if piece is not None:
                        sums[end] = sums[end] + sums[end - n] * piece
            known[word] = np.log(sums[-1])
        return known[word]

    got = {r.doc_id: (r.lang_pred, r.score) for r in queries.op3_language_id(spark, sf_dir).collect()}
    for r in docs.collect():
        words = re.findall(rb"[a-z\x80-\xff]+", (r.text or "").lower().encode())
        total = sum((logs(w) for w in words), np.zeros(len(model.languages)))
        share = np.exp(total - total.max())
        assert got[r.doc_id][0] == model.languages[int(np.argmax(total))]
        assert got[r.doc_id][1] == pytest.approx(1 / share.sum(), abs=1e-9)


def test_hand_made_rows(spark):
    rows = [(i, "the house and the garden of the king", "en") for i in range(8)] + [(20 + i, "das haus und der garten des königs", "de") for i in range(8)]
    rows += [(50, None, "en"), (51, "", "en"), (52, "123 – ?", None), (53, "the garden", None), (None, "der garten", None), (54, "DAS HAUS " * 20_000, "en"), (53, "the garden", None)]
    docs = spark.createDataFrame([(*r, 9, "s") for r in rows], "doc_id long, text string, lang string, score int, LANG_PRED string")
    model = langid.learned(docs, F.col("doc_id") < 50, langid.vocabulary(public_tokenizers.path(queries.PIECE_FILE)), 5)
    got = {(r.doc_id, r.lang_pred, r.score > 0.5) for r in langid.predicted(docs, model).collect()}
    assert {(50, "und", False), (51, "und", False), (52, "und", False), (53, "en", True), (None, "de", True), (54, "de", True), (0, "en", True), (20, "de", True)} <= got


def test_no_rows_and_no_languages(spark):
    docs = spark.createDataFrame([(1, "words", None)], "doc_id long, text string, lang string")
    out = langid.identified(docs, public_tokenizers.path(queries.PIECE_FILE), F.lit(True)).collect()
    assert [(r.lang_pred, r.score) for r in out] == [("und", 0.0)]
    assert langid.identified(docs.limit(0), public_tokenizers.path(queries.PIECE_FILE), F.lit(True)).collect() == []


def test_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = {r.doc_id: r for r in queries.table(spark, sf_dir, "documents").collect()}
    rows = queries.op3_language_id(spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in held) >= 0.97 * len(held)
