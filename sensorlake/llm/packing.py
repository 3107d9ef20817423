"""Packing documents into sequences by vector best fit.

A piece of a document asks for three things of its sequence: tokens, one place among the documents,
and attention, the square of its length. All three follow from the length, so equal lengths are
one kind of piece, and a corpus has at most as many kinds as a sequence has tokens. Best fit
therefore runs on the numbers of pieces per kind instead of the pieces: sequences in the same state
are one group, a kind is placed into whole groups at a time, and the result is that of placing all
pieces of the corpus one by one, longest first. Its work and memory do not grow with the corpus.

Spark encodes the documents, counts the kinds, numbers the pieces of each kind over all tasks, and
looks up each piece's place by its number. No group of pieces is ever brought together.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from sensorlake.llm.bytebpe import byte_characters
from sensorlake.llm.rows import list_array
from sensorlake.llm.words import pieces as slices
from sensorlake.sources.shared import stored

#: Texts that the ``tokenizers`` library encodes in one call.
_CALL_ROWS = 64
# Fixed value: how a byte-level file splits texts.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Bits for the number of a piece within its length.
_NUMBER_BITS = 43


@dataclass(frozen=True)
class Capacity:
    """What a sequence holds. ``attention`` is the sum of the squared lengths of its pieces."""

    tokens: int = 1024
    documents: int = 1024
    attention: int = 1024 * 1024

    def __post_init__(self):
        if not 0 < self.tokens < 1 << 20 or self.documents < 1 or self.attention < self.tokens**2:
            raise ValueError("a sequence has to hold at least one piece of its full length, of less than 2**20 tokens")

    def of(self, length: int) -> np.ndarray:
        """What a piece of this length asks for."""
        return np.array([length, 1, length * length], dtype=np.int64)

    @property
    def whole(self) -> np.ndarray:
        return np.array([self.tokens, self.documents, self.attention], dtype=np.int64)


# --- encoding -------------------------------------------------------------------------------


class Encoder:
    """Ids of texts by a file of the ``tokenizers`` library, as little-endian 32-bit words.

    For a plain byte-level file the merges are run by the ``tiktoken`` library, which is four times as
    fast: it joins the pair whose joint token comes first, and so does the file if every token is what
    the file makes of the token's own bytes, which is tested as the file is read. Any other file is
    left to ``tokenizers``.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a Spark task has one core
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            self._ranked = _ranked(self._library, json.load(file))

    def __call__(self, texts: Sequence[str]) -> Iterator[bytes]:
        if self._ranked is not None:
            for text in texts:
                ids = self._ranked.encode_to_numpy(text, allowed_special="all")
                yield ids.astype("<u4", copy=False).tobytes()
            return
        for i in range(0, len(texts), _CALL_ROWS):
            for one in self._library.encode_batch_fast(texts[i : i + _CALL_ROWS], add_special_tokens=False):
                yield np.array(one.ids, dtype="<u4").tobytes()


def _ranked(library, file: dict):
    """The ``tiktoken`` encoding that gives the file's ids, or None where that is not certain."""
    import tiktoken

    model, splitter = file["model"], file["pre_tokenizer"] or {}
    added = {t["content"]: t["id"] for t in file["added_tokens"]}
    whole = all(t["special"] and not (t["lstrip"] or t["rstrip"] or t["single_word"]) for t in file["added_tokens"])
    unusual = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk", "byte_fallback", "ignore_merges")
    plain = (
        whole and model["type"] == "BPE" and not any(model.get(name) for name in unusual) and file["normalizer"] is None
        and splitter.get("type") == "ByteLevel" and splitter.get("use_regex") and not splitter.get("add_prefix_space")
    )
    if not plain:
        return None
    byte_of = {c: b for b, c in enumerate(byte_characters())}
    tokens = {token: i for token, i in model["vocab"].items() if token not in added}
    if not all(c in byte_of for token in tokens for c in token) or not all(c in tokens for c in byte_of):
        return None
    ranks = {bytes(map(byte_of.__getitem__, token)): i for token, i in tokens.items()}
    # The model applied to a token's own characters, without the splitter, leads to the token; ids are in the order of merges.
    from tokenizers import models

    bare = models.BPE(vocab=model["vocab"], merges=[tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]])
    reached = all([t.id for t in bare.tokenize(token)] == [i] for token, i in tokens.items())
    made = [tokens.get("".join(m.split(" ") if isinstance(m, str) else m), -1) for m in model["merges"]]
    if not reached or made != sorted(set(made)):
        return None
    return tiktoken.Encoding("file", pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens=added)


@lru_cache(maxsize=2)
def _loaded(path: str) -> Encoder:
    return Encoder(path)


def encoder(tokenizer: str) -> Encoder:
    """The encoder of a file that every machine has, or that was sent with ``SparkContext.addFile``."""
    return _loaded(tokenizer if os.path.exists(tokenizer) else SparkFiles.get(tokenizer))


# --- best fit on kinds ----------------------------------------------------------------------


@dataclass
class Plan:
    """Where the pieces of each length go, by their number within the length.

    Row i holds the pieces of ``length[i]`` numbered from ``first[i]``: ``each[i]`` of them in each
    sequence from ``sequence[i]`` on, behind ``used[i]`` tokens. Rows ascend by length and number.
    """

    length: np.ndarray
    first: np.ndarray
    sequence: np.ndarray
    each: np.ndarray
    used: np.ndarray
    sequences: int


def dot_product(left: np.ndarray, asked: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted dot product of what a sequence would have left with what the piece asks for."""
    return (left * (weight * asked)).sum(axis=1)


def residual_norm(left: np.ndarray, asked: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted squared norm of what a sequence would have left."""
    return (weight * left * left).sum(axis=1)


RULES = {"dot_product": dot_product, "residual_norm": residual_norm}


def plan(counts: dict[int, int], capacity: Capacity, rule=residual_norm) -> Plan:
    """Best fit of ``counts`` pieces per length, longest first; a new sequence only where none has room.

    A piece goes to the sequence with room under every constraint that scores least, ties to the
    first. Scores fall as a sequence fills, so further pieces of the length go to the same one until
    it has no room: a group of sequences in one state takes them all alike.
    """
    whole = capacity.whole
    demand = sum(n * capacity.of(length) for length, n in counts.items()) / whole if counts else np.zeros(3)
    weight = demand / max(1e-300, demand.sum())
    left, first, number = np.zeros((0, 3), np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    rows, sequences = [], 0
    for length in sorted(counts, reverse=True):
        asked, todo, done = capacity.of(length), int(counts[length]), 0
        # Sequences without room for the shortest piece are done with.
        open_ = (left >= capacity.of(min(counts))).all(axis=1)
        left, first, number = left[open_], first[open_], number[open_]
        fits = np.flatnonzero((left >= asked).all(axis=1))
        score = rule((left[fits] - asked) / whole, asked / whole, weight)
        for group in fits[np.lexsort((first[fits], score))]:
            if not todo:
                break
            each = int((left[group] // asked).min())
            taken = min(todo, int(number[group]) * each)
            rows.append((length, done, int(first[group]), each, capacity.tokens - int(left[group, 0])))
            left, first, number = _placed(left, first, number, group, taken, each, asked)
            done, todo = done + taken, todo - taken
        if todo:
            each = int((whole // asked).min())
            rows.append((length, done, sequences, each, 0))
            new = -(-todo // each)
            left, first, number = np.vstack([left, whole]), np.append(first, sequences), np.append(number, new)
            left, first, number = _placed(left, first, number, first.size - 1, todo, each, asked)
            sequences += new
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)
    return Plan(*(np.ascontiguousarray(table[:, i]) for i in range(5)), sequences)


def _placed(left, first, number, group: int, taken: int, each: int, asked: np.ndarray):
    """A group after ``taken`` pieces: full ones, one with the rest, and those still as they were."""
    full, rest = divmod(taken, each)
    states = [(left[group] - each * asked, full), (left[group] - rest * asked, int(rest > 0))]
    states.append((left[group].copy(), int(number[group]) - full - int(rest > 0)))
    begin, new_first, new_number, new_left = int(first[group]), [], [], []
    for state, n in states:
        if n:
            new_left.append(state)
            new_first.append(begin)
            new_number.append(n)
            begin += n
    # The first takes the group's place, so that the places of other groups stay.
    left[group], first[group], number[group] = new_left[0], new_first[0], new_number[0]
    if len(new_left) > 1:
        left = np.vstack([left, *new_left[1:]])
        first, number = np.append(first, new_first[1:]), np.append(number, new_number[1:])
    return left, first, number


def best_plan(counts: dict[int, int], capacity: Capacity) -> Plan:
    """The plan with the fewest sequences among the rules."""
    return min((plan(counts, capacity, rule) for rule in RULES.values()), key=lambda p: p.sequences)


# --- Spark ----------------------------------------------------------------------------------


def _cut(n: int, tokens: int) -> list[tuple[int, int]]:
    """Start and length of each piece of n tokens; all but the first have full length."""
    parts = max(1, -(-n // tokens))
    first = n - (parts - 1) * tokens
    return [(0, first), *((first + i * tokens, tokens) for i in range(parts - 1))]


def _pieces(docs: DataFrame, tokenizer: str, end_id: int | None, tokens: int, doc_id: str, text: str, ids: bool) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, task, nth) and with ``ids`` the ids of every piece.

    ``nth`` numbers the pieces of a length in the task that made them.
    """
    schema = StructType([
        StructField("doc_id", docs.schema[doc_id].dataType),
        StructField("piece", IntegerType()),
        *(StructField(name, LongType()) for name in ("start", "length", "ids_crc32")),
        StructField("task", IntegerType()),
        StructField("nth", LongType()),
        *([StructField("ids", ArrayType(IntegerType()))] if ids else []),
    ])
    end = b"" if end_id is None else np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, seen, task = encoder(tokenizer), np.zeros(tokens + 1, dtype=np.int64), TaskContext.get().partitionId()
        for batch in slices(batches, "text"):
            row, table, words = [], [], []
            for i, packed in enumerate(encode(batch.column("text").fill_null("").to_pylist())):
                packed += end
                for number, (start, length) in enumerate(_cut(len(packed) // 4, tokens)):
                    said = packed[4 * start : 4 * (start + length)]
                    row.append(i)
                    table.append((number, start, length, zlib.crc32(said), seen[length]))
                    seen[length] += 1
                    if ids:
                        words.append(said)
            found = np.array(table, dtype=np.int64).reshape(-1, 5)
            columns = [
                batch.column("doc_id").take(pa.array(row, pa.int64())),
                pa.array(found[:, 0].astype(np.int32)),
                *(pa.array(found[:, i]) for i in (1, 2, 3)),
                pa.array(np.full(len(row), task, dtype=np.int32)),
                pa.array(found[:, 4]),
            ]
            if ids:
                columns.append(list_array(pa.array(np.frombuffer(b"".join(words), dtype="<i4")), found[:, 2]))
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, schema)


def packed(
    docs: DataFrame, tokenizer: str, capacity: Capacity = Capacity(), end_id: int | None = 2, doc_id: str = "doc_id", text: str = "text",
    ids: bool = False,
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) per piece, and with ``ids`` its ids.

    A document is its ids by the ``tokenizers`` file followed by ``end_id``; only one of over
    ``capacity.tokens`` is cut, and only its first piece may be short. Sequences are numbered from 0
    and filled from offset 0 without gaps, each within all three capacities. ``ids_crc32`` is the CRC of
    the ids as little-endian 32-bit words. A null or empty text is ``end_id`` alone (without one: a piece
    of length 0). Rows with a null or repeated id are documents like others. Further columns are
    ignored; no rows give no rows.
    """
    spark = docs.sparkSession
    made = stored(_pieces(docs, tokenizer, end_id, capacity.tokens, doc_id, text, ids))
    counted = stored(made.where("length > 0").groupBy("length", "task").agg(F.count("*").alias("n")))
    # At most one row for each length up to capacity.tokens.
    kinds = {r.length: r.n for r in counted.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    chosen = spark.sparkContext.broadcast(best_plan(kinds, capacity))
    before = F.sum("n").over(W.partitionBy("length").orderBy("task").rowsBetween(W.unboundedPreceding, -1))
    starts = stored(counted.select("length", "task", F.coalesce(before, F.lit(0)).alias("before")))
    # Rows of one length and task are at most those of one input split, however common the length.
    numbered = made.join(starts, ["length", "task"], "left").withColumn("nth", F.col("nth") + F.coalesce("before", F.lit(0)))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if ids else [])]
    placed = StructType([*(made.schema[c] for c in columns), StructField("sequence_id", LongType()), StructField("offset", LongType())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = chosen.value
        keys = p.length << _NUMBER_BITS | p.first
        for batch in batches:
            length, nth = batch.column("length").to_numpy(), batch.column("nth").to_numpy()
            some = length > 0
            if some.any():
                row = np.maximum(np.searchsorted(keys, length << _NUMBER_BITS | nth, side="right") - 1, 0)
                into, within = np.divmod(nth - p.first[row], p.each[row])
                sequence, offset = p.sequence[row] + into, p.used[row] + within * length
            else:
                sequence = offset = np.zeros(length.size, dtype=np.int64)
            columns_ = [batch.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays(
                [*columns_, pa.array(np.where(some, sequence, 0), mask=~some), pa.array(np.where(some, offset, 0), mask=~some)], placed.names
            )

    return numbered.select(*columns, "nth").mapInArrow(place, placed)


def sequences(placed: DataFrame) -> DataFrame:
    """(sequence_id, ids, documents): each sequence's ids, and whose they are, from ``packed`` with its ids.

    A sequence holds no more than its capacity of tokens, which bounds what comes together.
    """
    part = F.struct("offset", "doc_id", "piece", "start", "length", "ids")
    told = placed.where("sequence_id IS NOT NULL").groupBy("sequence_id").agg(F.array_sort(F.collect_list(part)).alias("parts"))
    return told.select(
        "sequence_id",
        F.flatten("parts.ids").alias("ids"),
        F.transform("parts", lambda p: F.struct(p["doc_id"].alias("doc_id"), p["piece"].alias("piece"), p["start"].alias("start"), p["length"].alias("length"))).alias("documents"),
    )
