"""Byte-level BPE: the ``tokenizers`` library over Arrow batches, and decoding by the byte table.

The rank file of a public vocabulary becomes a BPE model of the library. Its bytes are written as
printable characters through the usual byte-to-character table; a token's merge has the token's
rank as its priority, for every split of the token into two tokens, which is how rank files
are applied. Decoding joins the tokens' bytes, so characters split over tokens come back whole.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, IntegerType, LongType, StructField, StructType

from sensorlake.llm.rows import annotate, list_array

#: Bytes of text that the library encodes in one call; it keeps several objects per token.
CALL_BYTES = 256 << 10

_OFFSET = StructType([StructField("start", IntegerType()), StructField("end", IntegerType())])
IDS = StructField("ids", ArrayType(IntegerType()))
OFFSETS = StructField("offsets", ArrayType(_OFFSET))
DECODED = StructField("decoded", BinaryType())


def byte_characters() -> list[str]:
    """A printable character for each byte: itself where it prints in Latin-1, else one from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = {b: chr(b) for b in printable}
    others = (b for b in range(256) if b not in table)
    table.update({b: chr(256 + i) for i, b in enumerate(others)})
    return [table[b] for b in range(256)]


class ByteBpe:
    """One rank file: the library's encoder and the bytes of every id."""

    def __init__(self, rank_file: str, pattern: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a Spark task has one core
        from tokenizers import Regex, Tokenizer, models, pre_tokenizers

        with open(rank_file, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        shown = byte_characters()
        text = {token: "".join(shown[b] for b in token) for token in ranks}
        merges = [
            (text[token[:cut]], text[token[cut:]])
            for token in sorted(ranks, key=ranks.__getitem__)
            for cut in range(1, len(token))
            if token[:cut] in ranks and token[cut:] in ranks
        ]
        model = models.BPE(vocab={text[token]: rank for token, rank in ranks.items()}, merges=merges, ignore_merges=True)
        self.encoder = Tokenizer(model)
        self.encoder.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.Split(Regex(pattern), "isolated"),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
        ])
        self.bytes_of: list[bytes] = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        self.text_of = [str(i) for i in range(len(self.bytes_of))]

    def encode(self, texts: list[str], offsets: bool = False) -> Iterator:
        """Encodings in order, from calls of at most ``CALL_BYTES`` of text or one text."""
        run = self.encoder.encode_batch if offsets else self.encoder.encode_batch_fast
        start, size = 0, 0
        for i, text in enumerate(texts):
            if i > start and size + len(text) > CALL_BYTES:
                yield from run(texts[start:i], add_special_tokens=False)
                start, size = i, 0
            size += len(text)
        yield from run(texts[start:], add_special_tokens=False)

    def decode(self, ids: list[int]) -> bytes:
        table = self.bytes_of
        return b"".join([table[i] for i in ids])


@lru_cache(maxsize=4)
def _loaded(rank_file: str, pattern: str) -> ByteBpe:
    return ByteBpe(rank_file, pattern)


def byte_bpe(rank_file: str, pattern: str) -> ByteBpe:
    """The model of a rank file, read once per Python process.

    ``rank_file`` is a path that every machine has, or the name of a file sent with
    ``SparkContext.addFile``.
    """
    return _loaded(rank_file if os.path.exists(rank_file) else SparkFiles.get(rank_file), pattern)


def encoded(docs: DataFrame, rank_file: str, pattern: str, text: str = "text", offsets: bool = False, keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``ids``, and with ``offsets`` the code points each token covers.

    A null or empty text has no ids. A token that holds part of a character covers that whole
    character. Columns named as the new ones are replaced.
    """

    def run(piece: pa.RecordBatch) -> dict[str, pa.Array]:
        said = piece.column(text).fill_null("").to_pylist()
        ids, spans, lengths = [], [], []
        for one in byte_bpe(rank_file, pattern).encode(said, offsets):
            got = np.array(one.ids, dtype=np.int32)
            ids.append(got)
            lengths.append(got.size)
            if offsets:
                spans.append(np.array(one.offsets, dtype=np.int32).reshape(-1, 2))
        out = {"ids": list_array(pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32)), lengths)}
        if offsets:
            both = np.concatenate(spans) if spans else np.zeros((0, 2), np.int32)
            out["offsets"] = list_array(pa.StructArray.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["start", "end"]), lengths)
        return out

    return annotate(docs, text, [IDS, *([OFFSETS] if offsets else [])], run, keep)


def encoded_and_checked(docs: DataFrame, rank_file: str, pattern: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``ids``, ``n_tokens`` and ``round_trip``: whether the ids decode to the text's bytes."""

    def run(piece: pa.RecordBatch) -> dict[str, pa.Array]:
        model = byte_bpe(rank_file, pattern)
        said = piece.column(text).fill_null("").to_pylist()
        ids = [one.ids for one in model.encode(said)]
        lengths = [len(x) for x in ids]
        flat = np.concatenate([np.array(x, dtype=np.int32) for x in ids]) if ids else np.zeros(0, np.int32)
        same = [model.decode(x) == t.encode() for x, t in zip(ids, said, strict=True)]
        return {"ids": list_array(pa.array(flat), lengths), "n_tokens": pa.array(lengths, pa.int64()), "round_trip": pa.array(same)}

    return annotate(docs, text, [IDS, StructField("n_tokens", LongType()), StructField("round_trip", BooleanType())], run, keep)


def decoded(tokens: DataFrame, rank_file: str, pattern: str, ids: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """``tokens`` with ``decoded``, the bytes of each list of ids; null ids give null bytes.

    The bytes of a list that ends inside a character are returned as they are; an id outside the
    table is an error.
    """
    kept = [c for c in (tokens.columns if keep is None else keep) if c.lower() != "decoded"]
    schema = StructType([*(tokens.schema[c] for c in kept), DECODED])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = byte_bpe(rank_file, pattern)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                piece = batch.slice(start, 256)
                out = [None if x is None else model.decode(x) for x in (one.as_py() for one in piece.column(ids))]
                yield pa.RecordBatch.from_arrays([*(piece.column(c) for c in kept), pa.array(out, pa.binary())], [*kept, "decoded"])

    return tokens.mapInArrow(run, schema)
