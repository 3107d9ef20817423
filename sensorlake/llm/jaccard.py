"""Similarity join of documents on their word shingles, by a chosen-path join.

A document is the set of its five-word shingles. Every set gets ``COORDINATES`` sampled tokens,
the least shingle under as many hash functions; two sets of Jaccard similarity s share each of
them with probability s. A run walks down from all sets: a node samples one coordinate, at times
two, and splits its sets by the token there. Nodes of at most ``BUCKET`` sets are compared by
brute force on a few bits of every token; larger ones are split again. A node that is still large after
``DEPTH`` splits holds sets that mostly resemble one another and is compared in pairs of blocks.
There are as many runs as make the chance that all of them miss a pair fall below 1 - recall where every
node is ``DEPTH`` splits deep, so their number does not follow the size of the nodes. Later runs skip
nodes whose sets are linked already.

A path follows from the tokens of a set alone, so nothing is moved while nodes are split: tasks count the
nodes of a level, a bit table says which of them are compared and which are split again, and the
sets of all runs go to their nodes once, as sketches. Tokens are shuffled to make copies one, and again
only for sets that a first round has linked.

Sets linked so far, directly or through others, come together a last time with their whole sets,
and every pair among them is decided by its exact similarity. Equal sets count once, so copies
are never paired. No task holds more than a few blocks of sets, and only spanning links leave it.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField

from sensorlake.llm.bits import BitTable
from sensorlake.llm.graph import components, forest
from sensorlake.llm.rows import annotate
from sensorlake.llm.words import ALPHANUMERIC, Words, mixed, pieces
from sensorlake.sources.shared import stored

SHINGLE = 5
#: Bytes of a shingle's hash.
SHINGLE_BYTES = 6
#: Similarity of a link as a fraction: 4/5.
NUMERATOR, DENOMINATOR = 4, 5
COORDINATES = 128
#: Bits of a token in a sketch; sets that share the token share them, others at times.
SKETCH_BITS = 4
#: Coordinates with equal bits from which a pair goes to the exact comparison: five deviations below 0.8.
LEAST_SHARED = 80
#: Chance of a second coordinate, so that 1 / similarity are sampled on average.
SECOND = DENOMINATOR / NUMERATOR - 1
BUCKET = 512
DEPTH = 4
BLOCK = 512
RECALL = 0.9999
WANTED_BITS = 26
#: Runs of the first round; sets linked in it are not compared in the next.
FIRST_RUNS = 2
#: Sets aside what a node is to be: compared, or split again.
_COMPARED, _SPLIT = 0x1E3779B97F4A7C15, 0x2545F4914F6CDD1D

_SCALES = (mixed(np.arange(1, COORDINATES + 1, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_SHIFTS = (mixed(np.arange(7001, COORDINATES + 7001, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)

Rooted = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]

SET = [StructField("s", LongType()), StructField("check", LongType()), StructField("size", LongType())]


def _shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text, sorted, as 48-bit hashes, and where each text's begin.

    A text of fewer words, but not none, is one shingle.
    """
    words = Words.of(texts, ALPHANUMERIC, lower=True)
    short = np.flatnonzero((words.counts > 0) & (words.counts < SHINGLE))
    starts = np.concatenate([words.window_starts(SHINGLE), words.first[short]])
    lengths = np.concatenate([np.full(starts.size - short.size, SHINGLE), words.counts[short]])
    hashes = words.window_hashes(starts, lengths) >> np.uint64(16)
    keys = np.sort(hashes | words.text_of[starts].astype(np.uint64) << np.uint64(48))
    keys = keys[np.append(True, keys[1:] != keys[:-1])] if keys.size else keys
    first = np.searchsorted(keys, np.arange(len(texts) + 1, dtype=np.uint64) << np.uint64(48))
    return keys & np.uint64((1 << 48) - 1), first


def _packed(shingles: np.ndarray) -> bytes:
    """The bytes of shingles that are not always zero."""
    return np.ascontiguousarray(shingles, dtype="<u8").view(np.uint8).reshape(-1, 8)[:, :SHINGLE_BYTES].tobytes()


def _unpacked(packed: np.ndarray) -> np.ndarray:
    out = np.zeros((packed.size // SHINGLE_BYTES, 8), dtype=np.uint8)
    out[:, :SHINGLE_BYTES] = packed.reshape(-1, SHINGLE_BYTES)
    return out.view("<u8").ravel()


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.zeros(values.size + 1, dtype=np.uint64)
    np.cumsum(values, out=total[1:])
    return total[first[1:]] - total[first[:-1]]


def _named_sets(shingles: np.ndarray, first: np.ndarray) -> dict[str, pa.Array]:
    """Two hashes and the size of each set; null for an empty one."""
    size = np.diff(first)
    one = mixed(_sums(mixed(shingles), first) + size.astype(np.uint64)).view(np.int64)
    two = mixed(_sums(mixed(shingles ^ np.uint64(0x5BD1E995)), first)).view(np.int64)
    return {"s": pa.array(one, mask=size == 0), "check": pa.array(two, mask=size == 0), "size": pa.array(size, pa.int64())}


def _tokens(shingles: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The sampled token of each set (not empty) and coordinate."""
    filled = np.flatnonzero(np.diff(first))
    short = (shingles >> np.uint64(16)).astype(np.uint32)
    out = np.zeros((first.size - 1, COORDINATES), dtype=np.uint32)
    if filled.size:
        for t in range(COORDINATES):
            out[filled, t] = np.minimum.reduceat(short * _SCALES[t] + _SHIFTS[t], first[filled])
    return out


def _binary(rows: np.ndarray) -> pa.Array:
    width = rows.shape[1] * rows.itemsize
    bounds = np.arange(rows.shape[0] + 1, dtype=np.int32) * np.int32(width)
    return pa.Array.from_buffers(pa.binary(), rows.shape[0], [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(rows))])


def _matrix(column: pa.Array, kind: type = np.uint32) -> np.ndarray:
    bounds = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], dtype=np.uint8)[bounds[0] : bounds[-1]].view(kind).reshape(len(column), -1)


def _sketches(tokens: np.ndarray) -> np.ndarray:
    """The top ``SKETCH_BITS`` bits of each token's hash, two coordinates to a byte."""
    bits = (mixed(tokens) >> np.uint64(64 - SKETCH_BITS)).astype(np.uint8)
    return bits[:, ::2] << np.uint8(SKETCH_BITS) | bits[:, 1::2]


def _opened(sketches: np.ndarray) -> np.ndarray:
    """The bits of each coordinate, in a byte of its own."""
    return np.concatenate([sketches >> np.uint8(SKETCH_BITS), sketches & np.uint8((1 << SKETCH_BITS) - 1)], axis=1)


def with_sets(docs: DataFrame, text: str = "text", tokens: bool = False, keep: list[str] | None = None) -> DataFrame:
    """``docs`` with the columns of ``SET``, and with ``tokens`` the sampled tokens."""

    def run(piece: pa.RecordBatch) -> dict[str, pa.Array]:
        shingles, first = _shingles(piece.column(text))
        out = _named_sets(shingles, first)
        return out | ({"tokens": _binary(_tokens(shingles, first))} if tokens else {})

    return annotate(docs, text, [*SET, *([StructField("tokens", BinaryType())] if tokens else [])], run, keep)


# --- the walk -------------------------------------------------------------------------------


def _sampled(nodes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows and coordinates of each node's first, and where it has one second, sample."""
    draw = mixed(nodes)
    yield np.arange(nodes.size), (draw % np.uint64(COORDINATES)).astype(np.int64)
    again = mixed(draw + np.uint64(1))
    second = np.flatnonzero((again >> np.uint64(40)).astype(np.float64) < SECOND * (1 << 24))
    yield second, (again[second] % np.uint64(COORDINATES)).astype(np.int64)


def _children(nodes: np.ndarray, rows: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes one level down and the rows of ``tokens`` in them: a child is named by its parent, coordinate and token."""
    names, places = [], []
    for sampled, coordinate in _sampled(nodes):
        path = mixed(nodes[sampled] + coordinate.astype(np.uint64) + np.uint64(1))
        names.append(mixed(path ^ tokens[rows[sampled], coordinate]))
        places.append(rows[sampled])
    return np.concatenate(names), np.concatenate(places)


def _levels(tokens: np.ndarray, runs: range, tables: list[BitTable]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(nodes, rows) of every level whose parents are split, from the first to one below the last table."""
    rows = np.tile(np.arange(tokens.shape[0]), len(runs))
    nodes, rows = _children(np.repeat(np.array(runs, dtype=np.uint64), tokens.shape[0]), rows, tokens)
    yield nodes, rows
    for table in tables:
        split = table.holds(nodes ^ np.uint64(_SPLIT))
        nodes, rows = _children(nodes[split], rows[split], tokens)
        yield nodes, rows


def _rooted(linked: Broadcast | None) -> Rooted:
    """(s, root, tokens) of batches (s, tokens): sets that are their own root, being in no link of the bit table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if linked is not None:
                batch = batch.filter(pa.array(~linked.value.holds(batch.column("s").to_numpy().view(np.uint64))))
            if not batch.num_rows:
                continue
            yield pa.RecordBatch.from_arrays([batch.column("s"), batch.column("s"), batch.column("tokens")], ["s", "root", "tokens"])

    return run


def _counted(rooted: Rooted, runs: range, tables: list) -> Callable:
    """(node, root) of the level below the tables."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rooted(batches):
            *_, (nodes, rows) = _levels(_matrix(batch.column("tokens")), runs, [t.value for t in tables])
            yield pa.RecordBatch.from_arrays([pa.array(nodes.view(np.int64)), batch.column("root").take(pa.array(rows))], ["node", "root"])

    return run


def _sent(rooted: Rooted, runs: range, tables: list, last: bool) -> Callable:
    """(node, side, s, root, sketch): sets to the nodes that are compared, or with ``last`` to those still to be split at the end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [t.value for t in tables]
        for batch in rooted(batches):
            tokens = _matrix(batch.column("tokens"))
            sketches = _sketches(tokens)
            levels = list(zip(_levels(tokens, runs, known[:-1]), known, strict=True))
            for (nodes, rows), table in levels[-1:] if last else levels:
                wanted = np.flatnonzero(table.holds(nodes ^ np.uint64(_SPLIT if last else _COMPARED)))
                some = batch.select(["s", "root"]).take(pa.array(rows[wanted]))
                columns = [pa.array(nodes[wanted].view(np.int64)), pa.array(np.zeros(wanted.size, np.int32)), *some.columns]
                yield pa.RecordBatch.from_arrays([*columns, _binary(sketches[rows[wanted]])], ["node", "side", "s", "root", "sketch"])

    return run


def _groups(batches: Iterator[pa.RecordBatch], least: int = 20_000, most: int | None = None) -> Iterator[pa.RecordBatch]:
    """Batches of whole groups from rows sorted by the column ``node``; groups of over ``most`` rows are passed over."""
    waiting: list[pa.RecordBatch] = []
    rows, due, passed = 0, least, None
    for batch in batches:
        if passed is not None:
            begin = int((batch.column("node").to_numpy() == passed).sum())
            batch = batch.slice(begin)
        if not batch.num_rows:
            continue
        passed = None
        waiting.append(batch)
        rows += batch.num_rows
        if rows < due:
            continue
        together = pa.concat_batches(waiting)
        nodes = together.column("node").to_numpy()
        cut = int(np.searchsorted(nodes, nodes[-1]))
        if cut:
            yield together.slice(0, cut)
        rows = rows - cut
        if most is not None and rows > most:
            waiting, rows, passed = [], 0, nodes[-1]
        else:
            waiting = [together.slice(cut)]
        due = max(least, 2 * rows)
    if waiting:
        yield pa.concat_batches(waiting)


def _linked(most: int | None) -> Callable:
    """Spanning links, between roots, of the sets of each node whose sketches agree at enough coordinates.

    A bit table takes few nodes for compared ones that are not; those of over ``most`` sets are split elsewhere.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _groups(batches, most=most):
            nodes = batch.column("node").to_numpy()
            first = np.searchsorted(nodes, nodes)
            end = np.searchsorted(nodes, nodes, side="right")
            if most is not None and (end - first > most).any():
                batch = batch.filter(pa.array(end - first <= most))
                nodes = batch.column("node").to_numpy()
                first, end = np.searchsorted(nodes, nodes), np.searchsorted(nodes, nodes, side="right")
            if nodes.size:
                yield _links(batch, first, end)

    return run


def _links(batch: pa.RecordBatch, first: np.ndarray, end: np.ndarray) -> pa.RecordBatch:
    sides, bits = batch.column("side").to_numpy(), _opened(_matrix(batch.column("sketch"), np.uint8))
    roots, own = np.unique(batch.column("root").to_numpy(), return_inverse=True)
    joined = np.arange(roots.size)
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]

    def compare(a: np.ndarray, b: np.ndarray) -> None:
        # Sides 1 and 2 are two blocks of one node; each block by itself is another group.
        pair = (joined[own[a]] != joined[own[b]]) & ((sides[a] == 0) | (sides[a] != sides[b]))
        a, b = a[pair], b[pair]
        for i in range(0, a.size, 20_000):
            near = (bits[a[i : i + 20_000]] == bits[b[i : i + 20_000]]).sum(axis=1) >= LEAST_SHARED
            left.append(own[a[i : i + 20_000][near]])
            right.append(own[b[i : i + 20_000][near]])

    rows = np.arange(first.size)
    # Sets near the first, or the last, of their node need no comparison among themselves.
    for leader in (first, end - 1):
        compare(leader, rows)
        joined = forest(roots.size, np.concatenate(left), np.concatenate(right))
    step = 0
    while rows.size:
        step += 1
        rows = rows[rows + step < end[rows]]
        compare(rows, rows + step)
    joined = forest(roots.size, np.concatenate(left), np.concatenate(right))
    child = np.flatnonzero(joined != np.arange(roots.size))
    return pa.RecordBatch.from_arrays([pa.array(roots[child]), pa.array(roots[joined[child]])], ["a", "b"])


def _blocks(rows: DataFrame, size: str, block: int) -> DataFrame:
    """Rows of large groups, once for each pair of blocks that their own block is part of.

    A group of n rows has n / block blocks by hash; a pair of blocks becomes a group of its own.
    ``side`` tells the two blocks of a pair apart and is 0 in a block taken with itself.
    """
    count = F.ceil(F.col(size) / block).cast("int")
    own = F.pmod(F.xxhash64("s", F.lit(3)), count).cast("int")
    spread = rows.withColumns({"own": own, "count": count}).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("count") - 1)))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    side = F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2)
    return spread.select(F.xxhash64("node", low, high).alias("node"), side.alias("side"), *[c for c in rows.columns if c not in ("node", size)])


def _by_node(rows: DataFrame) -> DataFrame:
    return rows.repartition("node").sortWithinPartitions("node")


def _caught(similarity: float, depth: int) -> float:
    """Chance that a run keeps a pair together down to nodes of this depth."""
    kept = 1.0
    for _ in range(depth):
        miss = 1 - similarity * kept
        kept = 1 - ((1 - SECOND) * miss + SECOND * miss**2)
    return kept


def _walk(sets: list[tuple[DataFrame, Rooted]], runs: range) -> DataFrame:
    """Links between roots that these runs find among the sets, in parts with a function that gives (s, root, tokens) of each."""
    spark = sets[0][0].sparkSession

    def of_all(step: Callable, shape: str) -> DataFrame:
        return reduce(DataFrame.unionByName, [part.mapInArrow(step(rooted), shape) for part, rooted in sets])

    tables: list = []
    while True:
        level = of_all(lambda rooted: _counted(rooted, runs, list(tables)), "node long, root long")
        sizes = level.groupBy("node").agg(F.count("*").alias("n"), F.min("root").alias("low"), F.max("root").alias("high"))
        # A node whose sets are linked already is neither compared nor split.
        open_ = stored(sizes.where("low < high").select("node", "n"))
        largest = open_.agg(F.max("n")).first()[0] or 0
        kind = F.when(F.col("n") <= BUCKET, F.lit(_COMPARED)).otherwise(F.lit(_SPLIT))
        tables.append(spark.sparkContext.broadcast(BitTable.of(open_.select(F.col("node").bitwiseXOR(kind).alias("h")), WANTED_BITS)))
        if largest <= BUCKET or len(tables) == DEPTH:
            break
    shape = "node long, side int, s long, root long, sketch binary"
    found = _by_node(of_all(lambda rooted: _sent(rooted, runs, tables, False), shape)).mapInArrow(_linked(BUCKET), "a long, b long")
    if largest > BUCKET:
        large = of_all(lambda rooted: _sent(rooted, runs, tables, True), shape).drop("side").join(open_.where(F.col("n") > BUCKET), "node")
        blocks = _blocks(large, "n", BUCKET // 2)
        found = found.unionByName(_by_node(blocks).mapInArrow(_linked(None), "a long, b long"))
    return found


def _runs(recall: float) -> int:
    """Runs that together find a pair of the least similarity with this chance, however deep its nodes are."""
    return max(FIRST_RUNS, math.ceil(math.log(1 - recall) / math.log(1 - _caught(NUMERATOR / DENOMINATOR, DEPTH))))


def candidates(sets: DataFrame, recall: float = RECALL) -> DataFrame:
    """(s, root): sets, of distinct (s, tokens), that the walk joins, directly or through others."""
    linked = _extended(None, stored(components(_walk([(sets, _rooted(None))], range(FIRST_RUNS)))))
    if (count := _runs(recall)) == FIRST_RUNS:
        return linked
    # Only tokens of sets that may be linked are shuffled to meet their roots; the others are their own.
    table = sets.sparkSession.sparkContext.broadcast(BitTable.of(linked.select(F.col("s").alias("h")), WANTED_BITS))

    def doubtful(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(table.value.holds(batch.column("s").to_numpy().view(np.uint64))))

    met = sets.mapInArrow(doubtful, sets.schema).join(linked, "s", "left").select("s", F.coalesce("root", "s").alias("root"), "tokens")
    parts = [(sets, _rooted(table)), (stored(met), lambda batches: batches)]
    return _extended(linked, stored(components(_walk(parts, range(FIRST_RUNS, count)))))


def _extended(linked: DataFrame | None, joined: DataFrame) -> DataFrame:
    """(s, root) with roots joined further, as (node, root); a node that is no root yet is a set by itself."""
    if linked is None:
        return joined.select(F.col("node").alias("s"), "root")
    further = joined.select("node", F.col("root").alias("further"))
    moved = linked.join(further, linked["root"] == further["node"], "left").select("s", F.coalesce("further", "root").alias("root"))
    fresh = further.join(linked, further["node"] == linked["s"], "left_anti").select(F.col("node").alias("s"), F.col("further").alias("root"))
    return stored(moved.unionByName(fresh))


# --- exact comparison -----------------------------------------------------------------------


def _exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of each group by exact similarity: how many each set has, and spanning ones.

    Rows are (a, b, n): n links of set a if b is null; else a link of a to b. In a whole group,
    side -1, those with n = 1 lead to the least set of the component.
    """
    for batch in _groups(batches, 2_000):
        nodes = batch.column("node").to_numpy()
        bounds = np.append(np.flatnonzero(np.append(True, nodes[1:] != nodes[:-1])), nodes.size)
        for start, end in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            if end - start > 1:
                yield _compared(batch.slice(start, end - start))


def _compared(group: pa.RecordBatch) -> pa.RecordBatch:
    sides, sets = group.column("side").to_numpy(), group.column("s").to_numpy()
    column = group.column("shingles")
    bounds = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    flat = _unpacked(np.frombuffer(column.buffers()[2], dtype=np.uint8)[bounds[0] : bounds[-1]])
    sizes = np.diff(bounds) // SHINGLE_BYTES
    row = np.repeat(np.arange(sets.size), sizes)
    _, place, seen = np.unique(flat, return_inverse=True, return_counts=True)
    common = seen[place] > 1  # a shingle of one set alone is in no intersection
    number = np.cumsum(seen > 1) - 1
    row, place = row[common], number[place[common]]
    width = int((seen > 1).sum())
    whole = sides[0] < 0
    left = np.flatnonzero(sides < 2)
    right = np.flatnonzero(sides == 2) if (sides == 2).any() else left
    both = np.zeros((left.size, right.size), dtype=np.float32)
    step = max(64, (8 << 20) // max(1, sets.size))
    order = np.argsort(place, kind="stable")
    row, place = row[order], place[order]
    for low in range(0, width, step):
        a, b = np.searchsorted(place, [low, low + step])
        part = np.zeros((sets.size, min(step, width - low)), dtype=np.float32)
        part[row[a:b], place[a:b] - low] = 1
        both += part[left] @ part[right].T
    total = sizes[left][:, None] + sizes[right][None, :]
    # both / (total - both) >= numerator / denominator, in whole numbers.
    near = (NUMERATOR + DENOMINATOR) * both.astype(np.int64) >= NUMERATOR * total
    if right is left:
        np.fill_diagonal(near, False)
        degree = near.sum(axis=1)
    else:
        degree = np.concatenate([near.sum(axis=1), near.sum(axis=0)])
    a, b = np.nonzero(near)
    owner = np.concatenate([left, right]) if right is not left else left
    root = forest(sets.size, left[a], right[b])
    child = np.flatnonzero(root != np.arange(root.size))
    some = np.flatnonzero(degree)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate([sets[owner[some]], sets[child]])),
            pa.array(np.concatenate([np.zeros(some.size, np.int64), sets[root[child]]]), mask=np.arange(some.size + child.size) < some.size),
            pa.array(np.concatenate([degree[some], np.full(child.size, int(whole))]).astype(np.int64)),
        ],
        ["a", "b", "n"],
    )


def _whole_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(s, shingles) of the wanted sets, computed anew from one document of each.

    A bit table of the wanted (s, doc_id) keeps nearly all other documents in their task.
    """

    def name(batch: pa.RecordBatch) -> np.ndarray:
        ids = pc.fill_null(batch.column("doc_id"), -1).to_numpy().view(np.uint64)
        return mixed(pc.fill_null(batch.column("s"), 0).to_numpy().view(np.uint64) ^ mixed(ids))

    def names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(name(batch).view(np.int64))], ["h"])

    table = docs.sparkSession.sparkContext.broadcast(BitTable.of(wanted.select("s", "doc_id").mapInArrow(names, "h long"), WANTED_BITS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            shingles, first = _shingles(piece.column("text"))
            s = _named_sets(shingles, first)["s"]
            ids = piece.column("doc_id").cast(pa.int64())
            rows = np.flatnonzero(table.value.holds(name(pa.RecordBatch.from_arrays([s, ids], ["s", "doc_id"]))) & (np.diff(first) > 0))
            sets = [_packed(shingles[first[i] : first[i + 1]]) for i in rows]
            yield pa.RecordBatch.from_arrays([s.take(pa.array(rows)), pa.array(sets, pa.binary())], ["s", "shingles"])

    found = docs.select("doc_id", "text").mapInArrow(run, "s long, shingles binary")
    return found.groupBy("s").agg(F.first("shingles").alias("shingles")).join(wanted.select("s"), "s", "left_semi")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", recall: float = RECALL) -> DataFrame:
    """(doc_id, class_id, copy_id, n_links) for every row of ``docs``.

    Two texts are linked if the Jaccard similarity of their shingle sets is at least 4/5.
    ``copy_id`` is the smallest id among documents of an equal set, ``class_id`` the smallest among
    documents joined by links, directly or through others, and ``n_links`` the number of other
    sets linked to this one. A text of one to four words is one shingle. A null or wordless text
    is a class of its own: its ids are its own id, and it has no links. Rows with a null id take
    part; their class's id is null if no other id is there. Further columns are ignored.
    """
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    base = stored(with_sets(docs, keep=["doc_id"]))
    # Copies have equal tokens; they are made one in their tasks, before the shuffle.
    distinct = with_sets(docs, tokens=True, keep=["doc_id"]).where("s IS NOT NULL").groupBy("s").agg(F.first("tokens").alias("tokens"))
    named = base.where("s IS NOT NULL")
    copies = named.groupBy("s", "check").agg(F.min("doc_id").alias("copy_id"))
    linked = candidates(stored(distinct), recall)
    wanted = stored(linked.join(copies.groupBy("s").agg(F.min("copy_id").alias("doc_id")), "s"))
    counts = wanted.groupBy("root").agg(F.count("*").alias("n"))
    rows = wanted.join(counts, "root").select(F.col("root").alias("node"), "s", "n")
    rows = rows.join(_whole_sets(docs, wanted), "s").select("node", "s", "n", "shingles")
    whole = rows.where(F.col("n") <= 2 * BLOCK).select("node", F.lit(-1).alias("side"), "s", "shingles")
    split = _blocks(rows.where(F.col("n") > 2 * BLOCK), "n", BLOCK)
    compared = stored(_by_node(whole.unionByName(split)).mapInArrow(_exact, "a long, b long, n long"))
    degrees = compared.where("b IS NULL").groupBy(F.col("a").alias("s")).agg(F.sum("n").alias("n_links"))
    # A component settled in one group is its least set, as its own root, and those that lead to it.
    settled = compared.where("b IS NOT NULL AND n = 1").select(F.explode(F.array("a", "b")).alias("s"), F.col("b").alias("root"))
    blocks = components(compared.where("b IS NOT NULL AND n = 0")).select(F.col("node").alias("s"), "root")
    members = settled.distinct().unionByName(blocks).join(copies, "s")
    first = members.groupBy("root").agg(F.min("copy_id").alias("class_id"))
    classes = members.join(first, "root").select("s", "check", "class_id")
    sets = stored(copies.join(degrees, "s", "left").join(classes, ["s", "check"], "left").select(
        "s", "check", "copy_id", F.coalesce("class_id", "copy_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links")
    ))
    found = base.select("doc_id", "s", "check").join(sets, ["s", "check"], "left")
    own = F.col("s").isNull()
    return found.select(
        "doc_id",
        F.when(own, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(own, F.col("doc_id")).otherwise(F.col("copy_id")).alias("copy_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
    )


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with only the smallest id of each class.

    Rows that share an id, or have none, stay or go together; they stay if one of them is first in
    its class.
    """
    found = stored(near_duplicates(docs, doc_id, text))
    first = F.col("doc_id").eqNullSafe(F.col("class_id"))
    others = found.where(~first).select(F.coalesce("doc_id", F.lit(0)).alias("h"))
    table = docs.sparkSession.sparkContext.broadcast(BitTable.of(others, WANTED_BITS))

    def rows(doubtful: bool) -> DataFrame:
        """Rows whose id may belong to a later member of a class, or those whose id surely does not."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids = pc.fill_null(batch.column(doc_id).cast(pa.int64()), 0).to_numpy().view(np.uint64)
                yield batch.filter(pa.array(table.value.holds(ids) == doubtful))

        return docs.mapInArrow(run, docs.schema)

    # Only the texts in doubt are shuffled to meet the ids that stay.
    kept = found.where(first).select(F.col("doc_id").alias("_kept_id")).distinct()
    doubtful = rows(True)
    return rows(False).unionByName(doubtful.join(kept, doubtful[doc_id].eqNullSafe(kept["_kept_id"]), "left_semi"))
