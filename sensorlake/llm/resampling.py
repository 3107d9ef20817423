"""Quality classifier by importance resampling with hashed n-gram models.

Two bag models over hashed unigrams and bigrams, one of good documents (the target) and one of
all documents, give each document the log of its importance weight: the sum over its n-grams of
the log ratio of the two models. Adding Gumbel noise to the log weights and taking the k largest
draws k documents without replacement in proportion to their weights.

The target model is fitted on at most ``SAMPLE`` labelled documents, a bound on what the driver
holds; the model of all documents is counted over all of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField

from sensorlake.llm.rows import annotate, set_aside
from sensorlake.llm.words import ALPHANUMERIC, NON_SPACE, RangeHash, byte_values, column_bytes, mixed, pieces, runs
from sensorlake.sources.shared import stored

BUCKETS = 1 << 12
SAMPLE = 20_000
#: Losing a good document counts as much as keeping this many bad ones when the cut is chosen.
GOOD_WEIGHT = 4
SEED = 17

SCORES = [StructField("n_tokens", LongType()), StructField("log_weight", DoubleType()), StructField("draw", DoubleType())]

_REPEAT = np.uint64(0x2545F4914F6CDD1D)
_BINS = 1024
_KEPT_ROWS = 10_000


def _features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all unigrams, then of all bigrams, the text of each, tokens per text, and a hash per text.

    Tokens are runs of alphanumeric or of other visible characters, unchanged. A token that
    repeats the one before it makes the same bigram whatever it is.
    """
    data, bounds = column_bytes(texts)
    starts, ends = (np.concatenate(pair) for pair in zip(runs(ALPHANUMERIC[data], bounds), runs((NON_SPACE & ~ALPHANUMERIC)[data], bounds), strict=True))
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], ends[order]
    hashing = RangeHash(byte_values(data), 0x9E3779B97F4A7C15)
    tokens = hashing(starts, ends)
    first = np.searchsorted(starts, bounds)
    count = np.diff(first)
    owner = np.repeat(np.arange(count.size), count)
    inside = np.flatnonzero(owner[1:] == owner[:-1])
    left, right = tokens[inside], tokens[inside + 1]
    pairs = np.where(left == right, _REPEAT, mixed(left * np.uint64(3) + right))
    low = np.uint64(BUCKETS - 1)
    buckets = np.concatenate([(tokens & low).astype(np.int64), (pairs & low).astype(np.int64) + BUCKETS])
    return buckets, np.concatenate([owner, owner[inside]]), count, hashing(bounds[:-1], bounds[1:])


def _counts(docs: DataFrame, target: np.ndarray) -> np.ndarray:
    """N-grams by bucket: of all documents, and of those whose id is in ``target`` (sorted)."""
    ids = docs.sparkSession.sparkContext.broadcast(target)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 2 * BUCKETS), dtype=np.int64)
        for piece in pieces(batches, "text"):
            buckets, owner, _, _ = _features(piece.column("text"))
            column = piece.column("doc_id")
            chosen = np.isin(column.fill_null(0).to_numpy(), ids.value) & column.is_valid().to_numpy(zero_copy_only=False)
            total[0] += np.bincount(buckets, minlength=2 * BUCKETS)
            total[1] += np.bincount(buckets[chosen[owner]], minlength=2 * BUCKETS)
        seen = np.flatnonzero(total[0])
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[0, seen]), pa.array(total[1, seen])], ["bucket", "n", "n_target"])

    rows = docs.mapInArrow(run, "bucket long, n long, n_target long").groupBy("bucket").agg(F.sum("n").alias("n"), F.sum("n_target").alias("n_target")).collect()
    total = np.zeros((2, 2 * BUCKETS), dtype=np.int64)
    for row in rows:
        total[:, row.bucket] = row.n, row.n_target
    return total


def log_ratios(total: np.ndarray) -> np.ndarray:
    """Log ratio of target to all, by bucket, smoothed by one; unigrams and bigrams are two models."""
    shaped = total.reshape(2, 2, BUCKETS).astype(np.float64)
    logs = np.log((shaped + 1) / (shaped.sum(axis=2, keepdims=True) + BUCKETS))
    return (logs[1] - logs[0]).reshape(-1)


def gumbel(ids: pa.Array, texts: np.ndarray, seed: int) -> np.ndarray:
    """Standard Gumbel noise from id, text and seed: the same in every run and for repeated rows."""
    named = mixed(ids.fill_null(-1).to_numpy().view(np.uint64) + np.uint64(seed * 0x9E3779B97F4A7C15 % (1 << 64)))
    uniform = ((mixed(named ^ texts) >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)
    return -np.log(-np.log(uniform))


def fitted_ratio(docs: DataFrame, target: np.ndarray) -> np.ndarray:
    """Log ratios by bucket, fitted on the documents (doc_id LONG, text) whose ids are in ``target``."""
    return log_ratios(_counts(docs.select("doc_id", "text"), np.sort(target))) if target.size else np.zeros(2 * BUCKETS)


def weighted(docs: DataFrame, ratio: np.ndarray, doc_id: str = "doc_id", text: str = "text", keep: list[str] | None = None, seed: int = SEED) -> DataFrame:
    """``docs`` with ``SCORES``: tokens, log weight, and log weight with Gumbel noise."""
    shared = docs.sparkSession.sparkContext.broadcast(ratio)

    def run(piece: pa.RecordBatch) -> dict[str, pa.Array]:
        buckets, owner, count, texts = _features(piece.column(text))
        weight = np.bincount(owner, weights=shared.value[buckets], minlength=piece.num_rows)
        draw = weight + gumbel(piece.column(doc_id).cast(pa.int64()), texts, seed)
        return {"n_tokens": pa.array(count, pa.int64()), "log_weight": pa.array(weight), "draw": pa.array(draw)}

    return annotate(docs, text, SCORES, run, keep)


def kth_largest(rows: DataFrame, column: str, k: int) -> float | None:
    """The k-th largest value, exactly, by refining a histogram; None if there are fewer rows or k < 1."""
    low, high, n = rows.agg(F.min(column), F.max(column), F.count(column)).first()
    if k < 1 or n < k:
        return None
    x = F.col(column)
    while True:
        inside = rows.where((x >= low) & (x <= high))
        if n <= _KEPT_ROWS or low == high:
            # Few values are left, or all are equal.
            distinct = inside.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc(column)).collect()
            for row in distinct:
                k -= row.n
                if k <= 0:
                    return row[column]
        place = F.least(F.floor((x - low) / ((high - low) / _BINS)), F.lit(_BINS - 1))
        bins = inside.groupBy(place.alias("place")).agg(F.min(column).alias("low"), F.max(column).alias("high"), F.count("*").alias("n"))
        for row in sorted(bins.collect(), key=lambda r: -r.place):
            if row.n >= k:
                low, high, n = row.low, row.high, row.n
                break
            k -= row.n


def labelled(labels: DataFrame, quality: str = "quality", most: int = SAMPLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of good documents to fit on, and of good and of bad documents to calibrate with.

    At most ``most`` good and ``most`` bad documents are taken, by the order of their hashed ids;
    three quarters of the good ones, by hash, are for fitting.
    """
    order = F.xxhash64("doc_id")
    known = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(quality).alias("q"))
    ids = {
        q: [r.doc_id for r in known.where(F.col("q") == q).orderBy(order, "doc_id").limit(most).select("doc_id").collect()] for q in (0, 1)
    }
    good, bad = np.array(ids[1], dtype=np.int64), np.array(ids[0], dtype=np.int64)
    fit = mixed(good.view(np.uint64)) % np.uint64(4) != 0
    return good[fit], good[~fit], bad


def cut(good: np.ndarray, bad: np.ndarray) -> float:
    """The log weight that best parts good from bad documents, by shares of each and ``GOOD_WEIGHT``.

    Of equally good cuts it is the middle of the first longest range; minus infinity without good
    or bad ones.
    """
    if not good.size or not bad.size:
        return -np.inf
    values = np.unique(np.concatenate([good, bad]))
    score = GOOD_WEIGHT * (good.size - np.searchsorted(np.sort(good), values)) / good.size + np.searchsorted(np.sort(bad), values) / bad.size
    best = np.flatnonzero(score >= score.max() - 1e-12)
    below = np.where(best > 0, values[best - 1], values[best])
    widest = np.argmax(values[best] - below)
    return float((values[best][widest] + below[widest]) / 2)


def _drawn(least: float | None) -> Column:
    return F.lit(False) if least is None else (F.col("n_tokens") > 0) & (F.col("draw") >= least)


def _fitted(docs: DataFrame, labels: DataFrame, k: int | None, sample: int, seed: int) -> tuple[np.ndarray, DataFrame, float | None]:
    """Log ratios, the scores of all rows, and the least draw that is taken."""
    fit, good, bad = labelled(labels, "quality", sample)
    ratio = fitted_ratio(docs, fit)
    scored = stored(weighted(docs, ratio, keep=["doc_id"], seed=seed))
    usable = scored.where("n_tokens > 0")
    if k is None:
        both = np.concatenate([good, bad])
        known = docs.sparkSession.createDataFrame(list(zip(both.tolist(), [True] * good.size + [False] * bad.size, strict=True)), "doc_id long, good boolean")
        # A row per labelled id, however often it stands there.
        seen = usable.join(known, "doc_id").groupBy("doc_id", "good").agg(F.max("log_weight").alias("log_weight")).collect()
        weights = {q: np.array([r.log_weight for r in seen if r.good == q]) for q in (True, False)}
        k = usable.where(F.col("log_weight") >= cut(weights[True], weights[False])).count()
    return ratio, scored, kth_largest(usable, "draw", min(k, usable.count()))


def _shaped(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, quality: str) -> tuple[DataFrame, DataFrame]:
    return (
        docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")),
        labels.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(quality).alias("quality")),
    )


def resampled(
    docs: DataFrame, labels: DataFrame, k: int | None = None, doc_id: str = "doc_id", text: str = "text", quality: str = "quality",
    sample: int = SAMPLE, seed: int = SEED,
) -> DataFrame:
    """(doc_id, n_tokens, log_weight, sampled) for every row of ``docs``.

    ``k`` documents are drawn by the Gumbel top-k rule; by default as many as have a log weight
    above the cut that parts the labelled documents left out of fitting. Rows whose noisy weights tie
    with the k-th, such as repeated rows, are drawn together. A null text, or one without visible
    characters, has no tokens and is never drawn. Labels with a null id or quality are ignored;
    without good labels all weights are equal, and without bad ones all documents are drawn. Of a labelled
    id that repeats, the largest weight is compared. Further columns, whatever their names, are ignored.
    """
    _, scored, least = _fitted(*_shaped(docs, labels, doc_id, text, quality), k, sample, seed)
    return scored.select("doc_id", "n_tokens", "log_weight", _drawn(least).alias("sampled"))


def accepted(
    docs: DataFrame, labels: DataFrame, k: int | None = None, doc_id: str = "doc_id", text: str = "text", quality: str = "quality",
    sample: int = SAMPLE, seed: int = SEED,
) -> DataFrame:
    """``docs`` without the rows that ``resampled`` does not draw; all columns come back as they were.

    Weights and noise depend on a row alone, so the rows are weighed again where they are read, and
    no text is shuffled.
    """
    ratio, _, least = _fitted(*_shaped(docs, labels, doc_id, text, quality), k, sample, seed)
    renamed, own = set_aside(docs, [field.name for field in SCORES])
    return weighted(renamed, ratio, doc_id, text, seed=seed).where(_drawn(least)).select(*own)
