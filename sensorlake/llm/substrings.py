"""Removal of word sequences that occur in an earlier document, by difference-cover anchors.

Two equal windows of ``WINDOW`` words lie at any two places of their documents. Positions modulo
``PERIOD`` that belong to the difference cover ``COVER`` have every distance modulo the period, so
among the first ``PERIOD`` offsets of the windows there is one at which both documents have an
anchor. Anchors cover ``WINDOW - PERIOD + 1`` words and so lie inside the window. Hence:

1. hash the anchors of all documents, and each document as a whole, and find what two share;
2. a document equal to a smaller one repeats it from end to end, and is done with;
3. extend: for the others, hash every whole window that holds a shared anchor, and take the
   smallest document of each window hash (96 bits);
4. remove the words of windows that have a smaller document.

Shared anchors reach the tasks as a bit table of fixed size. Its false hits only make more windows
candidates; the result is decided by window hashes. A slice of documents settles its own repeats
before the shuffle, so that a passage in very many documents sends one row per slice, and the join
that follows is one that adaptive execution can split. Only texts of which something goes, and
texts that have copies, are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from sensorlake.llm.bits import BitTable
from sensorlake.llm.rows import Compute, annotate, list_array, set_aside
from sensorlake.llm.words import NON_SPACE, Words, column_bytes, pieces
from sensorlake.sources.shared import stored

WINDOW = 50
PERIOD = 31
#: A perfect difference set, each distance modulo 31 occurs.
COVER = (1, 5, 11, 24, 25, 27)
TABLE_BITS = 27
DOCUMENT_BITS = 24

_SPAN = StructType([StructField("start", IntegerType()), StructField("end", IntegerType())])
#: Words of a document and the word ranges (sorted, disjoint) that repeat an earlier document.
REPEATS = [StructField("n_words", LongType()), StructField("repeats", ArrayType(_SPAN))]

_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
_IN_COVER = np.isin(np.arange(PERIOD), COVER)


def _anchors(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """First words and hashes of all anchors."""
    size = WINDOW - PERIOD + 1
    starts = words.window_starts(size)
    place = starts - words.first[words.text_of[starts]]
    # A document shorter than a window has no anchor to offer.
    starts = starts[_IN_COVER[place % PERIOD] & (words.counts[words.text_of[starts]] >= WINDOW)]
    return starts, words.window_hashes(starts, size)


def _named(piece: pa.RecordBatch) -> pa.RecordBatch:
    return piece.filter(piece.column("doc_id").is_valid()) if piece.column("doc_id").null_count else piece


def _wholes(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents of at least a window, and two hashes of all their words; the second is never 0."""
    long = np.flatnonzero(words.counts >= WINDOW)
    second = (words.text_hashes(second=True) >> np.uint64(33)).astype(np.int32) | np.int32(1)
    return long, words.text_hashes()[long], second[long]


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h, h2, doc_id) of anchors, with h2 = 0, and of whole documents."""
    for piece in map(_named, pieces(batches, "text")):
        words = Words.of(piece.column("text"), NON_SPACE)
        starts, hashes = _anchors(words)
        long, one, two = _wholes(words)
        # Anchors only choose candidates, so 48 bits do.
        h = np.concatenate([hashes >> np.uint64(16), one]).view(np.int64)
        docs = piece.column("doc_id").take(pa.array(np.concatenate([words.text_of[starts], long])))
        yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(np.concatenate([np.zeros(starts.size, np.int32), two])), docs], ["h", "h2", "doc_id"])


def _window_rows(shared: BitTable, piece: pa.RecordBatch) -> pa.RecordBatch:
    """Candidate windows of a slice.

    Of the documents that share a window the smallest leaves a row with the window's hash; for
    the others, which are settled, ranges of first words are left, with ``until``.
    """
    words = Words.of(piece.column("text"), NON_SPACE)
    ids = piece.column("doc_id").to_numpy()
    starts, hashes = _anchors(words)
    starts = starts[shared.holds(hashes >> np.uint64(16))]
    text = words.text_of[starts]
    low = np.maximum(starts - (PERIOD - 1), words.first[text])
    high = np.minimum(starts, words.first[text + 1] - WINDOW)
    rise = np.zeros(words.starts.size + 1, dtype=np.int64)
    np.add.at(rise, low, 1)
    np.add.at(rise, high + 1, -1)
    starts = np.flatnonzero(np.cumsum(rise)[:-1] > 0)
    w1 = words.window_hashes(starts, WINDOW)
    w2 = (words.window_hashes(starts, WINDOW, second=True) >> np.uint64(33)).astype(np.int32)
    text = words.text_of[starts]
    doc = ids[text]
    order = np.lexsort((doc, w2, w1))
    fresh = np.ones(order.size, dtype=bool)
    fresh[1:] = (w1[order][1:] != w1[order][:-1]) | (w2[order][1:] != w2[order][:-1])
    smallest = doc[order][np.flatnonzero(fresh)][np.cumsum(fresh) - 1] if order.size else doc
    settled = np.zeros(order.size, dtype=bool)
    settled[order] = doc[order] > smallest
    open_ = ~settled
    at = starts - words.first[text]
    done, where = at[settled], text[settled]
    begin = np.ones(done.size, dtype=bool)
    begin[1:] = (done[1:] != done[:-1] + 1) | (where[1:] != where[:-1])
    end = np.flatnonzero(np.append(begin[1:], True)) if done.size else np.zeros(0, np.int64)
    begin = np.flatnonzero(begin)
    n = int(open_.sum())
    rows = n + begin.size
    blank = np.arange(rows) >= n
    fill = np.zeros(begin.size, dtype=np.int64)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate([w1[open_].view(np.int64), fill]), mask=blank),
            pa.array(np.concatenate([w2[open_], fill.astype(np.int32)]), mask=blank),
            pa.array(np.concatenate([doc[open_], ids[where[begin]]])),
            pa.array(np.concatenate([at[open_], done[begin]]).astype(np.int32)),
            pa.array(np.concatenate([at[open_], done[end]]).astype(np.int32), mask=~blank),
        ],
        ["w1", "w2", "doc_id", "at", "until"],
    )


def _apply(piece: pa.RecordBatch, text: str, found: str | None) -> dict[str, pa.Array]:
    """Merge ranges of first words of windows into ranges of words; none without ``found``."""
    words = Words.of(piece.column(text), NON_SPACE)
    n_words = pa.array(words.counts, pa.int64())
    if found is None:
        return {"n_words": n_words, "repeats": pa.array([[]] * piece.num_rows, _SPANS)}
    lists = piece.column(found)
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    base = np.repeat(words.first[:-1], lengths)
    flat = lists.flatten()
    begin = base + flat.field("at").to_numpy(zero_copy_only=False)
    end = base + flat.field("until").to_numpy(zero_copy_only=False) + WINDOW
    rise = np.zeros(words.starts.size + 1, dtype=np.int64)
    np.add.at(rise, begin, 1)
    np.add.at(rise, end, -1)
    gone = np.cumsum(rise)[:-1] > 0
    border = np.zeros(gone.size + 1, dtype=bool)
    border[words.first] = True
    before, after = np.zeros(gone.size, dtype=bool), np.zeros(gone.size, dtype=bool)
    before[1:], after[:-1] = gone[:-1], gone[1:]
    first = np.flatnonzero(gone & (~before | border[:-1]))
    last = np.flatnonzero(gone & (~after | border[1:])) + 1
    owner = words.text_of[first]
    spans = pa.StructArray.from_arrays(
        [pa.array((first - words.first[owner]).astype(np.int32)), pa.array((last - words.first[owner]).astype(np.int32))], ["start", "end"]
    )
    return {"n_words": n_words, "repeats": list_array(spans, np.bincount(owner, minlength=piece.num_rows))}


_ROWS = "w1 long, w2 int, doc_id long, at int, until int"


def _copies_settled(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Rows for documents that equal a smaller one: all their windows are repeats."""
    words = Words.of(batch.column("text"), NON_SPACE)
    n = batch.num_rows
    none = pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32())
    until = pa.array((words.counts - WINDOW).astype(np.int32))
    return pa.RecordBatch.from_arrays([*none, batch.column("doc_id"), pa.array(np.zeros(n, np.int32)), until], ["w1", "w2", "doc_id", "at", "until"])


def repeated_windows(docs: DataFrame) -> DataFrame:
    """(doc_id, found): first words of windows that also start in a smaller document, as ranges at..until."""
    docs = docs.select("doc_id", "text")
    context = docs.sparkSession.sparkContext
    hashed = docs.mapInArrow(_anchor_rows, "h long, h2 int, doc_id long")
    shared = stored(hashed.groupBy("h", "h2").agg(F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc")).where("first_doc < last_doc").drop("last_doc"))
    anchors = context.broadcast(BitTable.of(shared.where("h2 = 0").select("h"), TABLE_BITS))
    copies = shared.where("h2 <> 0")
    copied = context.broadcast(BitTable.of(copies.select("h"), DOCUMENT_BITS))

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Windows of documents that have no copies."""
        for piece in map(_named, pieces(batches, "text")):
            words = Words.of(piece.column("text"), NON_SPACE)
            yield _window_rows(anchors.value, piece.filter(pa.array(~copied.value.holds(words.text_hashes()))))

    def with_copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in map(_named, pieces(batches, "text")):
            words = Words.of(piece.column("text"), NON_SPACE)
            long, one, two = _wholes(words)
            held = copied.value.holds(one)
            # Shorter documents hold no window, whatever the table says.
            chosen = piece.take(pa.array(long[held]))
            yield pa.RecordBatch.from_arrays([pa.array(one[held].view(np.int64)), pa.array(two[held]), chosen.column("doc_id"), chosen.column("text")], ["h", "h2", "doc_id", "text"])

    def copy_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            later = piece.column("later")
            yield _window_rows(anchors.value, piece.filter(pc.invert(later)))
            yield _copies_settled(piece.filter(later))

    doubled = docs.mapInArrow(with_copies, "h long, h2 int, doc_id long, text string").join(copies, ["h", "h2"], "left")
    later = doubled.select("doc_id", "text", F.coalesce(F.col("doc_id") > F.col("first_doc"), F.lit(False)).alias("later"))
    rows = stored(docs.mapInArrow(windows, _ROWS).unionByName(later.mapInArrow(copy_rows, _ROWS)))
    unsettled = rows.where("until IS NULL").select("w1", "w2", "doc_id", "at")
    # Stored, so that the join reads plain exchanges on both sides, which adaptive execution can split.
    spread = unsettled.groupBy("w1", "w2").agg(F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc"))
    smallest = stored(spread.where("first_doc < last_doc").drop("last_doc"))
    repeated = unsettled.join(smallest, ["w1", "w2"]).where("doc_id > first_doc").select("doc_id", "at", F.col("at").alias("until"))
    settled = rows.where("until IS NOT NULL").select("doc_id", "at", "until")
    return repeated.unionByName(settled).groupBy("doc_id").agg(F.collect_list(F.struct("at", "until")).alias("found"))


def with_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: list[str] | None = None,
    also: tuple[list[StructField], Compute] | None = None,
) -> DataFrame:
    """``docs`` with the columns of ``REPEATS``, and those that ``also`` computes from them in the same pass.

    A window is ``WINDOW`` consecutive words of one document; a word is repeated if it lies in a
    window that also starts in a document with a smaller id. Null texts have no words. Rows with a
    null id are never repeats nor sources; rows that share an id are one document's, each judged
    on its own text, and no source for each other. Columns named as the new ones are replaced.
    """
    found = stored(repeated_windows(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))))
    own = [c for c in (docs.columns if keep is None else keep) if c.lower() not in ("n_words", "repeats")]
    carried = docs.select(*dict.fromkeys([*own, doc_id, text]))
    place, name = "_repeats_found", "_repeats_id"
    affected = docs.sparkSession.sparkContext.broadcast(BitTable.of(found.select(F.col("doc_id").alias("h")), DOCUMENT_BITS))

    def affects(batch: pa.RecordBatch) -> np.ndarray:
        """Rows whose document may have repeats."""
        ids = batch.column(doc_id)
        return affected.value.holds(pc.fill_null(ids.cast(pa.int64()), 0).to_numpy().view(np.uint64)) & ids.is_valid().to_numpy(zero_copy_only=False)

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(affects(batch)))

    def compute(found: str | None) -> Compute:
        def run(piece: pa.RecordBatch) -> dict[str, pa.Array]:
            out = _apply(piece, text, found)
            if also is not None:
                known = [n for n in piece.schema.names if n not in out]
                out |= also[1](pa.RecordBatch.from_arrays([*(piece.column(n) for n in known), *out.values()], [*known, *out]))
            return out

        return run

    added = [*REPEATS, *(also[0] if also else [])]
    # Texts without repeats are finished where they are read; only the others meet what was found.
    whole = annotate(carried, text, added, compute(None), own, where=lambda piece: pa.array(~affects(piece)))
    joined = carried.mapInArrow(chosen, carried.schema).join(
        found.select(F.col("doc_id").alias(name), F.col("found").alias(place)), F.col(doc_id) == F.col(name), "left"
    ).drop(name)
    return whole.unionByName(annotate(joined, text, added, compute(place), own))


def kept_words(piece: pa.RecordBatch, text: str = "text", repeats: str = "repeats") -> Iterator[bytes]:
    """Each text's words outside its repeats, joined by one space."""
    data, bounds = column_bytes(piece.column(text))
    raw = data.tobytes()
    for start, end, spans in zip(bounds[:-1].tolist(), bounds[1:].tolist(), piece.column(repeats).to_pylist(), strict=True):
        words = raw[start:end].split()
        for span in reversed(spans):
            del words[span["start"] : span["end"]]
        yield b" ".join(words)


def deduplicated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with each text that has repeats reduced to its other words, joined by one space.

    All other columns come back as they were.
    """

    def cut(piece: pa.RecordBatch) -> dict[str, pa.Array]:
        old, spans = piece.column(text).to_pylist(), piece.column("repeats").to_pylist()
        new = [said.decode() if span else whole for said, span, whole in zip(kept_words(piece, text), spans, old, strict=True)]
        return {text: pa.array(new, pa.string())}

    docs, own = set_aside(docs, [field.name for field in REPEATS])
    marked = with_repeats(docs, doc_id, text)
    return annotate(marked, text, [StructField(text, StringType())], cut, marked.columns).select(*own)
