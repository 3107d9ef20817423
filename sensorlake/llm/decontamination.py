"""Benchmark decontamination by a broadcast set of normalised n-grams.

Benchmark windows become a sorted set of 64-bit hashes. Every document's windows are looked up in
it with a few vector operations, and each hit is verified against the window's own words, so a
hash collision never counts. The set is broadcast in parts of at most ``part_windows`` windows,
counted beforehand; a larger benchmark takes several passes over the documents.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from sensorlake.llm.rows import annotate, list_array, set_aside
from sensorlake.llm.words import ALPHANUMERIC, Words, column_bytes, pieces
from sensorlake.sources.shared import stored

WINDOW = 13
#: Bytes of a part: words, names and 25 bytes more for each window.
PART_BYTES = 64 << 20
_BITS = 20

_SPAN = StructType([StructField("start", IntegerType()), StructField("end", IntegerType())])
#: Words of a document, its hit word ranges (sorted, disjoint) and the items whose windows occur in it.
HITS = [StructField("n_words", LongType()), StructField("hits", ArrayType(_SPAN)), StructField("items", ArrayType(StringType()))]


def benchmark_windows(benchmark: DataFrame, item: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """Distinct (item, length, hash, words) of all items; a shorter item is one window.

    Items without words, or with a null text, have none. ``words`` are joined by one space.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, text):
            words = Words.of(piece.column(text), ALPHANUMERIC, lower=True)
            short = np.flatnonzero((words.counts > 0) & (words.counts < window))
            starts = np.concatenate([words.window_starts(window), words.first[short]])
            lengths = np.concatenate([np.full(starts.size - short.size, window), words.counts[short]])
            if not starts.size:
                continue
            names = piece.column(item).cast(pa.string()).take(pa.array(words.text_of[starts]))
            said = [b" ".join(words.word(k) for k in range(j, j + n)) for j, n in zip(starts, lengths, strict=True)]
            hashes = words.window_hashes(starts, lengths)
            yield pa.RecordBatch.from_arrays([names, pa.array(lengths, pa.int32()), pa.array(hashes.view(np.int64)), pa.array(said, pa.binary())], ["item", "length", "hash", "words"])

    return benchmark.select(item, text).mapInArrow(run, "item string, length int, hash long, words binary").distinct()


def _strings(column: pa.ChunkedArray) -> tuple[bytes, np.ndarray]:
    """All bytes of a column, null as empty, and where each value begins."""
    values = column.cast(pa.large_binary()).combine_chunks().fill_null(b"")
    _, offsets, data = values.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[values.offset : values.offset + len(values) + 1]
    return (b"" if data is None else data.to_pybytes()[bounds[0] : bounds[-1]]), bounds - bounds[0]


class NgramSet:
    """Windows of one part: sorted hashes with a bit table per length, and the words and the item of each, end to end."""

    def __init__(self, rows: pa.Table):
        rows = rows.sort_by([("length", "ascending"), ("hash", "ascending")])
        self.hashes = rows.column("hash").to_numpy()
        self.words, self.words_at = _strings(rows.column("words"))
        self.named = rows.column("item").is_valid().to_numpy()
        self.items, self.items_at = _strings(rows.column("item"))
        lengths = rows.column("length").to_numpy()
        self.tables = []
        for length in np.unique(lengths).tolist():
            low, high = np.searchsorted(lengths, [length, length + 1]).tolist()
            bits = np.zeros(1 << _BITS, dtype=bool)
            bits[self.hashes[low:high].view(np.uint64) >> np.uint64(64 - _BITS)] = True
            self.tables.append((length, low, high, bits))

    @property
    def nbytes(self) -> int:
        arrays = (self.hashes, self.words_at, self.items_at, self.named, *(bits for *_, bits in self.tables))
        return len(self.words) + len(self.items) + sum(a.nbytes for a in arrays)

    def _found(self, low: int, high: int, window: bytes) -> list[str | None]:
        """Items, None for one without a name, of the rows from ``low`` to ``high`` that are this very window."""
        at, items = self.words_at, self.items_at
        same = [i for i in range(low, high) if self.words[at[i] : at[i + 1]] == window]
        return [self.items[items[i] : items[i + 1]].decode() if self.named[i] else None for i in same]

    def occurrences(self, words: Words) -> Iterator[tuple[int, int, list[str | None]]]:
        """Verified (first word, length, items), in no order."""
        for length, low, high, bits in self.tables:
            starts = words.window_starts(length)
            seen = words.window_hashes(starts, length)
            maybe = np.flatnonzero(bits[seen >> np.uint64(64 - _BITS)])
            starts, seen = starts[maybe], seen[maybe].view(np.int64)
            first = low + np.searchsorted(self.hashes[low:high], seen, side="left")
            last = low + np.searchsorted(self.hashes[low:high], seen, side="right")
            hit = last > first
            for j, a, b in zip(starts[hit].tolist(), first[hit].tolist(), last[hit].tolist(), strict=True):
                items = self._found(a, b, b" ".join(words.word(k) for k in range(j, j + length)))
                if items:
                    yield j, length, items


def _scan(piece: pa.RecordBatch, text: str, ngrams: NgramSet) -> dict[str, pa.Array]:
    words = Words.of(piece.column(text), ALPHANUMERIC, lower=True)
    rise = np.zeros(words.starts.size + 1, dtype=np.int64)
    items: dict[int, set[str]] = defaultdict(set)
    for j, length, names in ngrams.occurrences(words):
        rise[j] += 1
        rise[j + length] -= 1
        items[int(words.text_of[j])].update(n for n in names if n is not None)
    rows = piece.num_rows
    if "hits" in piece.schema.names:  # found by an earlier part
        for i, (spans, names) in enumerate(zip(piece.column("hits").to_pylist(), piece.column("items").to_pylist(), strict=True)):
            for span in spans:
                rise[words.first[i] + span["start"]] += 1
                rise[words.first[i] + span["end"]] -= 1
            items[i].update(names)
    hit = np.cumsum(rise)[:-1] > 0
    border = np.zeros(hit.size + 1, dtype=bool)
    border[words.first] = True
    before, after = np.zeros(hit.size, dtype=bool), np.zeros(hit.size, dtype=bool)
    before[1:], after[:-1] = hit[:-1], hit[1:]
    first = np.flatnonzero(hit & (~before | border[:-1]))
    last = np.flatnonzero(hit & (~after | border[1:])) + 1
    owner = words.text_of[first]
    base = words.first[owner]
    spans = pa.StructArray.from_arrays([pa.array(first - base, pa.int32()), pa.array(last - base, pa.int32())], ["start", "end"])
    return {
        "n_words": pa.array(words.counts, pa.int64()),
        "hits": list_array(spans, np.bincount(owner, minlength=rows)),
        "items": pa.array([sorted(items.get(i, ())) for i in range(rows)], pa.list_(pa.string())),
    }


def with_hits(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
    window: int = WINDOW, part_bytes: int = PART_BYTES, keep: list[str] | None = None,
) -> DataFrame:
    """``docs`` with the columns of ``HITS``.

    A document word is hit if it lies inside an occurrence of a benchmark window. A null or
    wordless text has 0 words and no hits; an empty benchmark hits nothing. Repeated rows are
    judged alike. A benchmark item without an id hits, and is not named. Columns named as those of ``HITS`` are
    replaced.
    """
    spark = docs.sparkSession
    windows = stored(benchmark_windows(benchmark, item, item_text, window))
    size = windows.agg(F.sum(F.octet_length("words") + F.coalesce(F.octet_length("item"), F.lit(0)) + 25)).first()[0] or 0
    parts = max(1, -(-size // part_bytes))
    names = list(docs.columns if keep is None else keep)
    clash = {field.name for field in HITS}
    result = docs.select(*dict.fromkeys([*(n for n in names if n.lower() not in clash), text]))
    for part in range(parts):
        rows = windows.where(F.pmod(F.xxhash64("item", "words"), F.lit(parts)) == part).toArrow()
        ngrams = spark.sparkContext.broadcast(NgramSet(rows))
        last = part == parts - 1
        kept = [n for n in names if n.lower() not in clash] if last else list(dict.fromkeys(n for n in result.columns if n not in clash))
        result = annotate(result, text, HITS, lambda piece, ngrams=ngrams: _scan(piece, text, ngrams.value), kept)
        if not last:
            result = stored(result)
    return result


def n_hit() -> Column:
    return F.aggregate("hits", F.lit(0).cast("long"), lambda n, span: n + span["end"] - span["start"])


def contaminated(share: int = 20) -> Column:
    """At least one word in ``share`` lies inside a benchmark window."""
    return (n_hit() > 0) & (share * n_hit() >= F.col("n_words"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, share: int = 20, spans: bool = False, text: str = "text") -> DataFrame:
    """``docs`` without contaminated documents.

    With ``spans`` documents stay and lose the hit words with the text between them instead; what is
    left around a removed span is joined by a line break. All columns come back as they were.
    """
    docs, own = set_aside(docs, [field.name for field in HITS])
    marked = with_hits(docs, benchmark, text)
    if not spans:
        return marked.where(~contaminated(share)).select(*own)

    def cut(piece: pa.RecordBatch) -> dict[str, pa.Array]:
        column = piece.column(text)
        words = Words.of(column, ALPHANUMERIC)
        _, bounds = column_bytes(column)
        out = []
        for i, (said, hits) in enumerate(zip(column.to_pylist(), piece.column("hits").to_pylist(), strict=True)):
            if hits:
                raw, base, begin = said.encode(), int(bounds[i]), int(words.first[i])
                kept, at = [], 0
                for span in hits:
                    kept.append(raw[at : int(words.starts[begin + span["start"]]) - base])
                    at = int(words.ends[begin + span["end"] - 1]) - base
                kept.append(raw[at:])
                said = "\n".join(x for x in (k.decode().strip() for k in kept) if x)
            out.append(said)
        return {text: pa.array(out, pa.string())}

    return annotate(marked, text, [StructField(text, StringType())], cut, marked.columns).select(*own)
