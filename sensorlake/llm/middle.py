"""Fill-in-the-middle transformation of whole texts, cut at units of white space and what follows it.

A unit is a run of white space with the run of other characters behind it, or white space at the
end of a text. Texts are read as 64-bit words of eight UTF-8 bytes. Arithmetic on whole words marks
the bytes that end a unit; counting the marks of every word and summing the counts says in which word
the k-th unit ends, and clearing the lower marks of that word says at which byte. So both cuts of
all texts of a batch are found without a loop over texts, units or bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField

from sensorlake.llm.rows import annotate
from sensorlake.llm.words import column_bytes

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SENTINELS = (PREFIX, SUFFIX, MIDDLE)

_ONES = np.uint64(0x0101010101010101)
_HIGH = np.uint64(0x8080808080808080)
_LOW7 = np.uint64(0x7F7F7F7F7F7F7F7F)


def _each(byte: int) -> np.uint64:
    return np.uint64(byte) * _ONES


def _below(words: np.ndarray, limit: int) -> np.ndarray:
    """The high bit of each byte whose low seven bits are below ``limit``, of 1 to 128."""
    # 128 + limit - 1 - b has its high bit set just where b < limit, and never borrows.
    return (_each(0x80 + limit - 1) - (words & _LOW7)) & _HIGH


def spaces(words: np.ndarray) -> np.ndarray:
    """The high bit of each byte that is a space or one of the controls 0x09 to 0x0D."""
    ascii_ = ~words & _HIGH
    control = _below(words, 0x0E) & ~_below(words, 0x09)
    space = _below(words, 0x21) & ~_below(words, 0x20)
    return (control | space) & ascii_


def as_words(data: np.ndarray) -> np.ndarray:
    """Bytes as little-endian 64-bit words, with zeros behind the last."""
    padded = np.zeros(-(-data.size // 8) * 8 + 8, dtype=np.uint8)
    padded[: data.size] = data
    return padded.view("<u8")


def unit_ends(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Words with the high bit of each byte that ends a unit; texts lie between the bounds."""
    space = spaces(as_words(data))
    # The byte behind the last of a word is the first of the next word.
    following = space >> np.uint64(8)
    following[:-1] |= space[1:] << np.uint64(56)
    ends = ~space & following & _HIGH
    last = bounds[1:][bounds[1:] > bounds[:-1]] - 1
    np.bitwise_or.at(ends, last >> 3, np.uint64(0x80) << ((last & 7) * 8).astype(np.uint64))
    return ends


class Units:
    """The units of the texts between ``bounds``."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray):
        self._ends = unit_ends(data, bounds)
        self._counted = np.concatenate([[0], np.cumsum(np.bitwise_count(self._ends), dtype=np.int64)])
        self._bounds = bounds
        self._before = self._ends_before(bounds)

    def _ends_before(self, place: np.ndarray) -> np.ndarray:
        """Marks below each byte position."""
        word, byte = place >> 3, (place & 7).astype(np.uint64)
        lower = self._ends[word] & ((np.uint64(1) << (byte * np.uint64(8))) - np.uint64(1))
        return self._counted[word] + np.bitwise_count(lower)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self._before)

    def end_of(self, n: np.ndarray) -> np.ndarray:
        """The byte behind the first ``n`` units of each text."""
        rank = self._before[:-1] + n  # among all marks, from 1
        word = np.maximum(np.searchsorted(self._counted, rank, side="left") - 1, 0)
        marks = self._ends[word].copy()
        skip = rank - self._counted[word] - 1
        for _ in range(7):  # clear the lowest mark where more than one is to be passed
            more = skip > 0
            if not more.any():
                break
            marks = np.where(more, marks & (marks - np.uint64(1)), marks)
            skip -= more
        lowest = marks & (~marks + np.uint64(1))
        # A mark is bit 7 of its byte, so the bits below it tell the byte.
        byte = np.bitwise_count(lowest - np.uint64(1)).astype(np.int64) >> 3
        return np.where(n > 0, (word << 3) + byte + 1, self._bounds[:-1])


def _contains(data: np.ndarray, bounds: np.ndarray, sentinels: tuple[str, ...]) -> np.ndarray:
    """Whether each text holds a sentinel."""
    if not data.size:
        return np.zeros(bounds.size - 1, dtype=bool)
    found = np.zeros(bounds.size - 1, dtype=bool)
    for sentinel in sentinels:
        wanted = sentinel.encode()
        hit = np.flatnonzero(data[: data.size - len(wanted) + 1] == wanted[0]) if data.size >= len(wanted) else np.zeros(0, np.int64)
        for i, byte in enumerate(wanted[1:], start=1):
            hit = hit[data[hit + i] == byte]
        text = np.searchsorted(bounds, hit, side="right") - 1
        inside = hit + len(wanted) <= bounds[text + 1]
        found[text[inside]] = True
    return found


def _code_points(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    heads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80, dtype=np.int64)])
    return heads[end] - heads[start]


ADDED = [
    StructField("n_units", LongType()),
    StructField("form", StringType()),
    StructField("prefix_chars", LongType()),
    StructField("middle_chars", LongType()),
    StructField("output", StringType()),
]


def draws(key: Column, seed: int = 42) -> list[Column]:
    """Four unsigned 32-bit draws from a key; they depend on the seed and the key alone."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def transformed(
    docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = 42, rate: int = 50, spm_rate: int = 80, keep: list[str] | None = None,
) -> DataFrame:
    """``docs`` with ``n_units``, ``form``, ``prefix_chars``, ``middle_chars`` and ``output``.

    The draws of ``key`` choose two places among the unit ends and the start, and the form: ``rate`` per cent
    of the texts are transformed, ``spm_rate`` per cent of these with the suffix first (``spm``), the others
    with the prefix first (``psm``). A text that is null, empty or holds a sentinel stays as it is (``plain``, a
    null one as an empty text) and has no lengths. Equal keys draw alike; a null key draws as an empty one.
    Texts are taken whole. Input columns named as the new ones are replaced.
    """
    free = "_" * (1 + max(map(len, docs.columns)))  # longer than any name that is there
    names = [f"{free}{i}" for i in range(4)]
    keyed = docs.withColumns(dict(zip(names, draws(F.col(f"`{key}`"), seed), strict=True)))
    kept = list(docs.columns) if keep is None else keep

    def run(piece: pa.RecordBatch) -> dict[str, pa.Array]:
        data, bounds = column_bytes(piece.column(text))
        units = Units(data, bounds)
        n = units.counts
        h1, h2, h3, h4 = (piece.column(name).to_numpy() for name in names)
        one, two = h1 % (n + 1), h2 % (n + 1)
        a, b = units.end_of(np.minimum(one, two)), units.end_of(np.maximum(one, two))
        plain = (np.diff(bounds) == 0) | _contains(data, bounds, SENTINELS) | (h3 % 100 >= rate)
        spm = h4 % 100 < spm_rate
        out, raw, edges = [], data.tobytes(), zip(bounds[:-1].tolist(), a.tolist(), b.tolist(), bounds[1:].tolist(), strict=True)
        p, s, m = (sentinel.encode() for sentinel in SENTINELS)
        for (start, low, high, end), same, suffix_first in zip(edges, plain.tolist(), spm.tolist(), strict=True):
            if same:
                out.append(raw[start:end])
            elif suffix_first:
                out.append(b"".join((s, raw[high:end], p, raw[start:low], m, raw[low:high])))
            else:
                out.append(b"".join((p, raw[start:low], s, raw[high:end], m, raw[low:high])))
        return {
            "n_units": pa.array(n.astype(np.int64)),
            "form": pa.array(np.where(plain, "plain", np.where(spm, "spm", "psm")).astype(object), pa.string()),
            "prefix_chars": pa.array(_code_points(data, bounds[:-1], a), mask=plain),
            "middle_chars": pa.array(_code_points(data, a, b), mask=plain),
            "output": pa.array(out, pa.binary()).cast(pa.string()),
        }

    return annotate(keyed, text, ADDED, run, kept)


def restored(form: str = "form", output: str = "output") -> Column:
    """The text that an output was made from.

    A transformed text holds no sentinel, and no sentinel ends in what another or a text begins
    with, so cutting at the sentinels gives its three parts.
    """
    part = F.split(output, "|".join(SENTINELS), -1)
    psm = F.concat(F.get(part, F.lit(1)), F.get(part, F.lit(3)), F.get(part, F.lit(2)))
    spm = F.concat(F.get(part, F.lit(2)), F.get(part, F.lit(3)), F.get(part, F.lit(1)))
    return F.when(F.col(form) == "plain", F.col(output)).when(F.col(form) == "psm", psm).otherwise(spm)
