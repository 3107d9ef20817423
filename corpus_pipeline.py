"""The corpus pipeline: stages over documents, each stored and read again by the next.

Further columns of the documents come back from all stages but the last. No documents give none.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sensorlake.llm import bytebpe, decontamination, jaccard, pii, resampling
from sensorlake.llm.queries import table, tokenizer
from sensorlake.llm.rows import small_batches
from sensorlake.sources.shared import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling does not draw go.

    A null or empty text is never drawn. Rows that repeat stay or go together. Without labels all with a token stay.
    """
    small_batches(spark)
    return resampling.accepted(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the smallest id stays.

    A null or empty text, or one without words, is a group by itself. Rows that share an id stay or go together.
    """
    small_batches(spark)
    return jaccard.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go; a null or empty text never is."""
    small_batches(spark)
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def sanitise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced in the texts; no document goes, and null and empty texts stay as they are."""
    small_batches(spark)
    return pii.sanitised(docs, length="n_chars")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with their number, and whether they decode to the text; a null text has none."""
    small_batches(spark)
    rank_file, pattern = tokenizer()
    return bytebpe.encoded_and_checked(docs, rank_file, pattern, keep=["doc_id", "lang", "source"])


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", decontaminate),
    ("pii", sanitise),
    ("byte_bpe", encode),
]

#: SQL cannot express the first stage, nor the last; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token rows of the documents that all stages keep."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
