"""Registered queries of this package: each operator over its whole table, with digests of its results."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField

from sensorlake.llm import bytebpe, decontamination, divergence, jaccard, langid, licenses, middle, packing, pii, preference, resampling, substrings, topk
from sensorlake.llm.rows import annotate, small_batches

#: Rank file of op5 and the pipeline, and vocabulary of op3.
RANK_FILE = "byte_bpe_multi_50k.tiktoken"
PIECE_FILE = "piece_bpe_32k.model"
#: Tokenizer of op11.
TOKENIZER_FILE = "byte_bpe_50k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the driver, for a session whose batches between Spark and Python are small."""
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer() -> tuple[str, str]:
    """Path of the rank file and the splitting pattern that belongs to it."""
    import public_tokenizers

    return public_tokenizers.path(RANK_FILE), public_tokenizers.PATTERN


def _hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in a 13-word window of a benchmark item."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = decontamination.with_hits(docs, table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return marked.select(
        "doc_id",
        "n_words",
        decontamination.n_hit().alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        decontamination.contaminated().alias("contaminated"),
    )


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence of every document, as a file of its source's directory tree.

    Documents have no paths, so one is made from source and id: two levels of directories below
    the source, and in each tenth group of twenty documents a licence file, placed in the
    directory itself or in one of its parents.
    """
    i = F.col("doc_id")
    upper, lower = F.floor(i / 20_000), F.floor(i / 1000)
    kind = F.floor(i / 20) % 30
    inner = F.concat_ws("/", "source", F.concat(F.lit("d"), upper), F.concat(F.lit("d"), lower))
    path = (
        F.when(kind == 0, F.concat(F.col("source"), F.lit("/LICENSE."), i))
        .when(kind == 10, F.concat(F.col("source"), F.lit("/d"), upper, F.lit("/LICENSE."), i))
        .when(kind == 20, F.concat(inner, F.lit("/LICENSE."), i))
        .otherwise(F.concat(inner, F.lit("/"), i, F.lit(".txt")))
    )
    files = table(spark, sf_dir, "documents").select(path.alias("path"), "text")
    return licenses.scan(files)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document; a fifth of the documents is held out from learning."""
    import public_tokenizers

    fold = F.crc32(F.col("doc_id").cast("string")) % 5
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = langid.identified(docs, public_tokenizers.path(PIECE_FILE), fold != 0, keep=["doc_id"])
    return found.select("doc_id", F.coalesce(fold == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: base counts, their spans' digest, and all spans."""
    marked = pii.with_spans(table(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id"])
    base = F.filter("pii_spans", lambda s: s["kind"] != pii.TERM)

    def count(kind: str) -> Column:
        return F.size(F.filter("pii_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def said(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    return marked.select(
        "doc_id",
        *map(count, pii.KINDS),
        F.sha2(said(base), 256).alias("base_sha256"),
        said(F.col("pii_spans")).alias("spans"),
    )


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document by the rank file, and the bytes they decode to, as digests."""
    rank_file, pattern = tokenizer()

    def digests(piece: pa.RecordBatch) -> dict[str, pa.Array]:
        model = bytebpe.byte_bpe(rank_file, pattern)
        counts, ids, back = [], [], []
        texts = piece.column("text").fill_null("").to_pylist()
        for one in model.encode(texts):
            got = one.ids
            counts.append(len(got))
            ids.append(_hex(",".join([model.text_of[i] for i in got]).encode()))
            back.append(_hex(model.decode(got)))
        return {"n_tokens": pa.array(counts, pa.int64()), "ids_sha256": pa.array(ids, pa.string()), "decoded_sha256": pa.array(back, pa.string())}

    added = [StructField("n_tokens", LongType()), StructField("ids_sha256", StringType()), StructField("decoded_sha256", StringType())]
    return annotate(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", added, digests, ["doc_id"])


def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best inner products of every fiftieth vector against all others."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document and its number of links, at 0.8 of five-word shingles."""
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation in a pair at the longest prefix it shares: the prompt and two masked completions."""
    conversations = table(spark, sf_dir, "conversations")
    made = preference.formatted(preference.pairs_by_longest_prefix(conversations), conversations)

    def said(mask: str) -> Column:
        return F.array_join(F.transform(mask, lambda s: F.concat_ws(":", s["start"], s["end"])), ",").alias(mask)

    return made.select("chosen_id", "rejected_id", "n_prompt_turns", "prompt", "chosen", "rejected", said("chosen_mask"), said("rejected_mask"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document left after removing 50-word sequences of smaller documents."""

    def digests(piece: pa.RecordBatch) -> dict[str, pa.Array]:
        return {"kept_sha256": pa.array([_hex(kept) for kept in substrings.kept_words(piece)], pa.string())}

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = substrings.with_repeats(docs, keep=["doc_id"], also=([StructField("kept_sha256", StringType())], digests))
    removed = F.aggregate("repeats", F.lit(0).cast("long"), lambda n, span: n + span["end"] - span["start"])
    return marked.select("doc_id", "n_words", removed.alias("n_removed"), "kept_sha256")


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log importance weight of every document, and whether it is drawn."""
    return resampling.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every document's pieces in sequences of 1,024 tokens."""
    import public_tokenizers

    return packing.packed(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER_FILE))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form, parts and digests of every document's transformed text, and of the text made from that again."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    made = middle.transformed(docs, keep=["doc_id"])
    return made.select(
        "doc_id",
        F.col("n_units").alias("n"),
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(middle.restored(), 256).alias("restored_sha256"),
    )


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What sets the sources of each language apart: every pair of sources, and each source's own terms."""
    return divergence.audit(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_license_scan": op2_license_scan,
    "op3_language_id": op3_language_id,
    "op4_pii": op4_pii,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_exact_top_k": op6_exact_top_k,
    "op7_ngram_jaccard": op7_ngram_jaccard,
    "op8_chat_formatting": op8_chat_formatting,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_best_fit_packing": op11_best_fit_packing,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_source_divergence": op13_source_divergence,
}
