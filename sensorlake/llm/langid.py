"""Language identification with segmentation-marginalised unigrams.

The pieces of a fixed public vocabulary get a probability per language. The probability of a word
is the sum over all its segmentations into pieces, by a forward pass; a text's is the product over
its words, whose logs add up, so only the distinct words of a slice of texts are scored. Passes add
logarithms, so a word may be as long as a text. The piece probabilities are fitted by expectation
maximisation over the words of at most ``ROWS_PER_LANGUAGE`` labelled texts per language, each
language in a task of its own.

A word is a run of letters a-z and bytes outside ASCII, lower-cased, with a space ahead. Single bytes
are pieces as well, so that every word has a segmentation.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField

from sensorlake.llm.rows import annotate
from sensorlake.llm.words import RangeHash, byte_set, byte_values, column_bytes, mixed, pieces, runs
from sensorlake.sources.shared import stored

ROWS_PER_LANGUAGE = 400
ROUNDS = 4
#: Count added to each piece.
SMOOTHING = 0.05
UNKNOWN = "und"

PREDICTION = [StructField("lang_pred", StringType()), StructField("score", DoubleType())]

_LETTERS = byte_set((0x61, 0x7A), (0x80, 0xFF))
_SPACE = 0x20
#: Bytes of words, with what fills them up to one length, that are passed over together.
_BLOCK = 1 << 18
_BASE = 0x9E3779B97F4A7C15
_BITS = 20


def vocabulary(model_file: str) -> list[bytes]:
    """Pieces of a sentencepiece model as bytes, word starts as a space, and all single bytes."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    usable = (i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)))
    found = {model.id_to_piece(i).replace("▁", " ").encode() for i in usable}
    return sorted(found | {bytes([b]) for b in range(256)})


@dataclass
class Distinct:
    """The distinct words of a column piece, and where each word stands."""

    data: np.ndarray
    starts: np.ndarray  # of the distinct words
    lengths: np.ndarray
    place: np.ndarray  # distinct word of each word
    first: np.ndarray  # first word of each text

    @classmethod
    def of(cls, texts: pa.Array) -> Distinct:
        data, bounds = column_bytes(pc.utf8_lower(texts.cast(pa.large_string())))
        starts, ends = runs(_LETTERS[data], bounds)
        hashes = RangeHash(byte_values(data), _BASE)(starts, ends)
        _, one, place = np.unique(hashes, return_index=True, return_inverse=True)
        return cls(data, starts[one], (ends - starts)[one], place, np.searchsorted(starts, bounds))

    @classmethod
    def listed(cls, words: list[bytes]) -> Distinct:
        lengths = np.array([len(w) for w in words], dtype=np.int64)
        return cls(np.frombuffer(b"".join(words), dtype=np.uint8), np.cumsum(lengths) - lengths, lengths, np.arange(len(words)), np.arange(len(words)))

    def words(self) -> list[bytes]:
        return [self.data[s : s + n].tobytes() for s, n in zip(self.starts.tolist(), self.lengths.tolist(), strict=True)]

    def blocks(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(words, matrix, widths): words of like length, as a space, their bytes and zeros."""
        order = np.argsort(self.lengths, kind="stable")
        low = 0
        while low < order.size:
            # Up to a quarter longer than the shortest, and no more bytes than a block has.
            most = int(self.lengths[order[low]]) * 5 // 4 + 4
            high = int(np.searchsorted(self.lengths[order], most, side="right"))
            high = min(high, low + max(1, _BLOCK // (most + 1)))
            rows = order[low:high]
            widths = self.lengths[rows] + 1
            matrix = np.zeros((rows.size, int(widths.max())), dtype=np.uint8)
            matrix[:, 0] = _SPACE
            column = np.arange(matrix.shape[1] - 1)
            inside = column[None, :] < self.lengths[rows][:, None]
            matrix[:, 1:][inside] = self.data[(self.starts[rows][:, None] + column[None, :])[inside]]
            yield rows, matrix, widths
            low = high


#: For each end in a block of words: the words that have a piece there, its length, and its place in the vocabulary.
Matches = list[list[tuple[int, np.ndarray, np.ndarray]]]


class Pieces:
    """Finds the vocabulary's pieces inside words."""

    def __init__(self, vocabulary: list[bytes]):
        self.size = len(vocabulary)
        self.longest = max(map(len, vocabulary))
        hashes = np.zeros(self.size, dtype=np.uint64)
        begins = np.zeros(1 << _BITS, dtype=bool)
        for length in range(1, self.longest + 1):
            own = [i for i, p in enumerate(vocabulary) if len(p) >= length]
            hashes[own] = self._next(hashes[own], np.array([vocabulary[i][length - 1] for i in own], dtype=np.uint8))
            begins[hashes[own] >> np.uint64(64 - _BITS)] = True
        self.begins = begins  # whether a hash may be that of the beginning of a piece
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]

    @staticmethod
    def _next(hashes: np.ndarray, data: np.ndarray) -> np.ndarray:
        return mixed(hashes * np.uint64(_BASE) + data + np.uint64(1))

    def matches(self, matrix: np.ndarray, widths: np.ndarray) -> Matches:
        found: Matches = [[] for _ in range(matrix.shape[1] + 1)]
        for start in range(matrix.shape[1]):
            rows = np.flatnonzero(widths > start)
            h = np.zeros(rows.size, dtype=np.uint64)
            for length in range(1, min(self.longest, matrix.shape[1] - start) + 1):
                h = self._next(h, matrix[rows, start + length - 1])
                # Only what begins like a piece, and has another byte, goes on.
                some = self.begins[h >> np.uint64(64 - _BITS)]
                rows, h = rows[some], h[some]
                if not rows.size:
                    break
                at = np.minimum(np.searchsorted(self.hashes, h), self.size - 1)
                hit = self.hashes[at] == h
                if hit.any():
                    found[start + length].append((length, rows[hit], self.order[at[hit]]))
                more = widths[rows] > start + length
                rows, h = rows[more], h[more]
        return found


def _forward(matches: Matches, words: int, logs: np.ndarray) -> np.ndarray:
    """[end, word, language]: log probability of the first ``end`` bytes, over all segmentations."""
    alpha = np.full((len(matches), words, logs.shape[1]), -np.inf)
    alpha[0] = 0
    for end, found in enumerate(matches):
        for length, rows, piece in found:
            alpha[end, rows] = np.logaddexp(alpha[end, rows], alpha[end - length, rows] + logs[piece])
    return alpha


def _ends(matches: Matches, widths: np.ndarray, longest: int, logs: np.ndarray) -> np.ndarray:
    """[word, language]: log probability of each whole word, from a forward pass that keeps the last ``longest`` ends."""
    ring = np.full((longest + 1, widths.size, logs.shape[1]), -np.inf)
    ring[0] = 0
    out = np.zeros((widths.size, logs.shape[1]))
    for end, found in enumerate(matches[1:], start=1):
        here = ring[end % (longest + 1)]
        here[:] = -np.inf
        for length, rows, piece in found:
            here[rows] = np.logaddexp(here[rows], ring[(end - length) % (longest + 1), rows] + logs[piece])
        over = widths == end
        out[over] = here[over]
    return out


@dataclass
class LanguageModel:
    languages: list[str]
    pieces: Pieces
    chance: np.ndarray  # [piece, language]

    def log_words(self, words: Distinct) -> np.ndarray:
        """[word, language]: log probability of each distinct word."""
        out, logs = np.zeros((words.lengths.size, len(self.languages))), np.log(self.chance)
        for rows, matrix, widths in words.blocks():
            out[rows] = _ends(self.pieces.matches(matrix, widths), widths, self.pieces.longest, logs)
        return out

    def log_texts(self, texts: pa.Array) -> np.ndarray:
        """[text, language]: log probability of each text; 0 for one without words."""
        words = Distinct.of(texts)
        logs = self.log_words(words)[words.place]
        total = np.zeros((words.first.size - 1, len(self.languages)))
        filled = np.flatnonzero(np.diff(words.first))
        if filled.size:
            total[filled] = np.add.reduceat(logs, words.first[filled], axis=0)
        return total


def _expected(matches: Matches, widths: np.ndarray, logs: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Expected number of times each piece is used in the words, for one language."""
    words = np.arange(widths.size)
    alpha = _forward(matches, widths.size, logs[:, None])[:, :, 0]
    beta = np.full_like(alpha, -np.inf)
    beta[widths, words] = 0
    for end in range(len(matches) - 1, 0, -1):
        for length, rows, piece in matches[end]:
            beta[end - length, rows] = np.logaddexp(beta[end - length, rows], beta[end, rows] + logs[piece])
    counts = np.zeros(logs.size)
    whole = alpha[widths, words]
    for end, found in enumerate(matches):
        for length, rows, piece in found:
            used = np.exp(alpha[end - length, rows] + logs[piece] + beta[end, rows] - whole[rows]) * weights[rows]
            counts += np.bincount(piece, weights=used, minlength=counts.size)
    return counts


def fitted(words: dict[bytes, int], found: Pieces, rounds: int = ROUNDS) -> np.ndarray:
    """Piece probabilities of one language from its word counts, by expectation maximisation."""
    known = Distinct.listed(list(words))
    weights = np.array(list(words.values()), dtype=np.float64)
    blocks = [(rows, found.matches(matrix, widths), widths) for rows, matrix, widths in known.blocks()]
    chance = np.full(found.size, 1 / found.size)
    for _ in range(rounds):
        logs = np.log(chance)
        counts = sum((_expected(matches, widths, logs, weights[rows]) for rows, matches, widths in blocks), np.full(found.size, SMOOTHING))
        chance = counts / counts.sum()
    return chance


def fit(words: dict[str, dict[bytes, int]], vocabulary: list[bytes], rounds: int = ROUNDS) -> LanguageModel:
    """A model from the word counts of each language."""
    found = Pieces(vocabulary)
    languages = sorted(words)
    chance = [fitted(words[language], found, rounds) for language in languages]
    return LanguageModel(languages, found, np.stack(chance, axis=1) if chance else np.zeros((found.size, 0)))


def learned(docs: DataFrame, trainable: Column, vocabulary: list[bytes], rows: int = ROWS_PER_LANGUAGE, rounds: int = ROUNDS) -> LanguageModel:
    """A model from at most ``rows`` texts per language, taken by the order of hashed ids; texts that share an id go together.

    Every language is fitted by a task of its own. The piece probabilities of all languages come to the driver,
    a quarter of a megabyte each, as they are broadcast.
    """
    known = docs.where(trainable & F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    # The least of all hashes, of which ``rows`` are nearly surely among four times as many: what is ranked stays small.
    hash_, order = F.xxhash64("doc_id"), W.partitionBy("lang").orderBy("hash", "doc_id")
    shares = stored(known.groupBy("lang").agg((F.lit(4 * rows) / F.count("*")).alias("share")))
    few = known.select("doc_id", "lang", hash_.alias("hash")).join(shares, "lang").where(F.col("hash") / F.lit(2.0**64) + 0.5 <= F.col("share"))
    # Stored, so that its size decides how texts are joined with it.
    chosen = stored(few.withColumn("n", F.row_number().over(order)).where(F.col("n") <= rows).select("doc_id", "lang").distinct())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            for language in pc.unique(piece.column("lang")).to_pylist():
                found = Distinct.of(piece.column("text").filter(pc.equal(piece.column("lang"), language)))
                counts = np.bincount(found.place, minlength=found.lengths.size)
                said = found.words()
                yield pa.RecordBatch.from_arrays([pa.array([language] * len(said), pa.string()), pa.array(said, pa.binary()), pa.array(counts, pa.int64())], ["lang", "word", "n"])

    def one(language: tuple, counted: pa.Table) -> pa.Table:
        words = dict(zip(counted.column("word").to_pylist(), counted.column("n").to_pylist(), strict=True))
        chance = fitted(words, Pieces(vocabulary), rounds)
        return pa.table({"lang": [language[0].as_py()], "chance": pa.array([chance.astype("<f8").tobytes()], pa.binary())})

    texts = known.select("doc_id", "lang", "text").join(chosen, ["doc_id", "lang"]).select("lang", "text")
    counted = texts.mapInArrow(count, "lang string, word binary, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    models = {row.lang: np.frombuffer(bytes(row.chance), dtype="<f8") for row in counted.groupBy("lang").applyInArrow(one, "lang string, chance binary").collect()}
    languages = sorted(models)
    found = Pieces(vocabulary)
    return LanguageModel(languages, found, np.stack([models[x] for x in languages], axis=1) if models else np.zeros((found.size, 0)))


def predicted(
    docs: DataFrame, model: LanguageModel, text: str = "text", keep: list[str] | None = None,
) -> DataFrame:
    """``docs`` with ``PREDICTION``: the likeliest language and its share of the likelihood.

    ``und`` with score 0 for a null text, a text without a letter, or a model without languages.
    Equally likely languages are settled by name. Columns named as the new ones are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(piece: pa.RecordBatch) -> dict[str, pa.Array]:
        model, rows = shared.value, piece.num_rows
        column = piece.column(text)
        if not model.languages:
            return {"lang_pred": pa.array([UNKNOWN] * rows), "score": pa.array(np.zeros(rows))}
        logs = model.log_texts(column)
        letters = pc.match_substring_regex(column, r"\p{L}").fill_null(False).to_numpy(zero_copy_only=False)
        best = np.argmax(logs, axis=1)
        share = np.exp(logs - logs.max(axis=1, keepdims=True))
        names = np.where(letters, np.array(model.languages, dtype=object)[best], UNKNOWN)
        return {"lang_pred": pa.array(names, pa.string()), "score": pa.array(np.where(letters, 1 / share.sum(axis=1), 0.0))}

    return annotate(docs, text, PREDICTION, run, keep)


def identified(
    docs: DataFrame, model_file: str, trainable: Column, rows: int = ROWS_PER_LANGUAGE, keep: list[str] | None = None,
) -> DataFrame:
    """Fit on the rows of ``docs`` (doc_id, text, lang) for which ``trainable`` holds, and predict all rows."""
    return predicted(docs, learned(docs, trainable, vocabulary(model_file), rows), keep=keep)
