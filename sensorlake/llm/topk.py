"""Exact top-k inner-product search by distributed histogram selection.

Vectors become integers and scores stay integers: floats multiply them only where every sum is whole in a
float. For a block of queries every candidate is scored in
every pass, and nothing but histograms moves: each pass counts scores per query in equal bins of
the range that holds the k-th best score and narrows the range to one bin, until the k-th score
itself is known. A last pass keeps what scores at least that, ties to the smaller id.

A block holds at most ``block`` queries, which bounds what is broadcast and what comes back to
the driver; more queries take more passes over the candidates and no shuffle of vectors. The result of
a block is stored, so that the plan does not grow with the number of blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sensorlake.sources.shared import stored

QUERY_BLOCK = 4096
BINS = 256
_SCORES = 1 << 22  # scores held at once by a task
#: Sums below this are whole in a float; scores beyond the second are no LONG.
_FLOAT_WHOLE, _LONG = 1 << 53, (1 << 63) - 1


def quantised(
    vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", scale: int = 256, is_query: Column | None = None
) -> DataFrame:
    """(vec_id, v, is_query): floor(scale * x) of each component, and whether the row asks. Null or not finite components, null vectors and null ids drop out."""
    x = F.col(vector)
    usable = x.isNotNull() & F.col(vec_id).isNotNull() & (F.size(x) > 0) & F.forall(
        x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))
    )
    whole = F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("long"))
    asks = F.lit(False) if is_query is None else F.coalesce(is_query, F.lit(False))
    return vectors.where(usable).select(F.col(vec_id).alias("vec_id"), whole.alias("v"), asks.alias("is_query"))


@dataclass
class _Queries:
    """A block of queries of one dimension; ``low`` to ``high`` holds each one's k-th best score.

    The matrix is of floats where all sums of products are whole in one, else of integers, whose products
    take longer.
    """

    ids: np.ndarray
    matrix: np.ndarray
    k: int
    low: np.ndarray
    high: np.ndarray


def _blocks(batches: Iterator[pa.RecordBatch], queries: _Queries) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Candidate ids and their scores for every query; a query's own row scores below all others."""
    count, width = queries.matrix.shape
    step = max(1, _SCORES // count)
    for batch in batches:
        lists = batch.column("v")
        lengths = np.diff(lists.offsets.to_numpy())
        fits = np.flatnonzero(lengths == width)
        ids = batch.column("vec_id").to_numpy()[fits]
        if not fits.size:
            continue
        matrix = lists.take(pa.array(fits)).flatten().to_numpy().reshape(-1, width).astype(queries.matrix.dtype)
        for i in range(0, fits.size, step):
            scores = (matrix[i : i + step] @ queries.matrix.T).astype(np.int64)
            own = ids[i : i + step, None] == queries.ids[None, :]
            yield ids[i : i + step], np.where(own, np.iinfo(np.int64).min, scores)


def _widths(queries: _Queries) -> np.ndarray:
    """The width of the bins of each query's range, which all of them together cover."""
    return (queries.high.view(np.uint64) - queries.low.view(np.uint64)) // np.uint64(BINS) + np.uint64(1)


def _histogram(queries: _Queries):
    """Scores per query and bin, with those above the range in one more bin."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = queries.ids.size
        width = _widths(queries)
        total = np.zeros((count, BINS + 1), dtype=np.int64)
        for _, scores in _blocks(batches, queries):
            row, query = np.nonzero(scores >= queries.low)
            # Unsigned, as a range may be as wide as all LONG values.
            above = scores[row, query].view(np.uint64) - queries.low[query].view(np.uint64)
            place = np.minimum(above // width[query], np.uint64(BINS)).astype(np.int64)
            flat = query * (BINS + 1) + place
            total += np.bincount(flat, minlength=total.size).reshape(total.shape)
        # The k-th best overall is no worse than the k-th best of these rows: lower bins can't matter.
        above = np.cumsum(total[:, ::-1], axis=1)[:, ::-1]
        query, place = np.nonzero((total > 0) & (above - total < queries.k))
        yield pa.RecordBatch.from_arrays([pa.array(query), pa.array(place), pa.array(total[query, place])], ["q", "bin", "n"])

    return run


def _narrowed(queries: _Queries, rows: list) -> None:
    """Set each range to the bin that holds the k-th best score, or to all if there are fewer."""
    total = np.zeros((queries.ids.size, BINS + 1), dtype=np.int64)
    for row in rows:
        total[row.q, row.bin] += row.n
    above = np.cumsum(total[:, ::-1], axis=1)[:, ::-1]
    enough = above >= queries.k
    place = np.where(enough.any(axis=1), BINS - np.argmax(enough[:, ::-1], axis=1), 0)
    few = ~enough.any(axis=1)
    # Modulo 2**64 the sums come out right; a bin lies within the range.
    low = queries.low.view(np.uint64) + place.astype(np.uint64) * _widths(queries)
    room = queries.high.view(np.uint64) - low
    high = low + np.minimum(_widths(queries) - np.uint64(1), room)
    queries.high = np.where(few, queries.low, high.view(np.int64))
    queries.low = np.where(few, queries.low, low.view(np.int64))


def _best(queries: _Queries):
    """Rows at or above the k-th score: per task at most k of a query, ties to the smaller id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [np.zeros(0, np.int64) for _ in range(3)]
        for ids, scores in _blocks(batches, queries):
            row, query = np.nonzero(scores >= queries.low)
            new = [query, scores[row, query], ids[row]]
            query, score, ident = (np.concatenate(pair) for pair in zip(best, new, strict=True))
            order = np.lexsort((ident, -score, query))
            first = np.searchsorted(query[order], np.arange(queries.ids.size))
            place = np.arange(order.size) - first[query[order]]
            order = order[place < queries.k]
            best = [query[order], score[order], ident[order]]
        query, score, ident = best
        yield pa.RecordBatch.from_arrays([pa.array(queries.ids[query]), pa.array(ident), pa.array(score)], ["query_id", "vec_id", "score"])

    return run


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding", scale: int = 256,
    block: int = QUERY_BLOCK,
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` highest scores, ties to the smaller id.

    Queries are the rows for which ``is_query`` holds, candidates all rows but those with the
    query's id. Only vectors of the query's own dimension are its candidates. Queries whose rows
    repeat give one answer per distinct id; with several vectors under one id the answer is that
    of the first in vector order, and repeated candidates stand in it as often as there are rows. No
    queries, or no vectors, give no rows. Further columns, whatever their names, are ignored. Where a
    score might not fit into a LONG, that is an error.
    """
    spark = vectors.sparkSession
    usable = stored(quantised(vectors, vec_id, vector, scale, is_query))
    asked = stored(usable.where("is_query").groupBy("vec_id").agg(F.min("v").alias("v")))
    widths = [(r.width, r.n) for r in asked.groupBy(F.size("v").alias("width")).agg(F.count("*").alias("n")).orderBy("width").collect()]
    found: list[DataFrame] = []
    for width, n in widths:
        same = usable.where(F.size("v") == width).select("vec_id", "v")
        ends = same.agg(F.max(F.array_max("v")), F.min(F.array_min("v"))).first()
        largest = max(abs(ends[0]), abs(ends[1]))
        groups = -(-n // block)
        for group in range(groups):
            # Hash groups are uneven, so they are cut again into whole blocks.
            rows = asked.where((F.size("v") == width) & (F.pmod(F.xxhash64("vec_id"), F.lit(groups)) == group)).collect()
            for i in range(0, len(rows), block):
                found.append(_of_block(same, sorted(rows[i : i + block], key=lambda r: r.vec_id), largest, k))
    answers = _together(spark, found)
    place = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return answers.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _of_block(same: DataFrame, rows: list, largest: int, k: int) -> DataFrame:
    """(query_id, vec_id, score) of what may be among the best of a block of queries."""
    bound = [sum(map(abs, r.v)) * largest for r in rows]
    if max(bound) > _LONG:
        raise ValueError("scores beyond the range of LONG")
    ids, ends = np.array([r.vec_id for r in rows], dtype=np.int64), np.array(bound, dtype=np.int64)
    matrix = np.array([r.v for r in rows], dtype=np.float64 if max(bound) < _FLOAT_WHOLE else np.int64)
    queries = _Queries(ids, matrix, k, -ends, ends)
    while (queries.low < queries.high).any():
        counted = same.mapInArrow(_histogram(queries), "q long, bin long, n long")
        _narrowed(queries, counted.groupBy("q", "bin").agg(F.sum("n").alias("n")).collect())
    return stored(same.mapInArrow(_best(queries), "query_id long, vec_id long, score long"))


def _together(spark: SparkSession, found: list[DataFrame]) -> DataFrame:
    """The stored blocks as one table: a list of files instead of a plan per block."""
    shape = "query_id long, vec_id long, score long"
    files = [file for block in found for file in block.inputFiles()]
    return spark.read.schema(shape).parquet(*files) if files else spark.createDataFrame([], shape)
