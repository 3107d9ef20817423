"""The pipeline against a stage-by-stage brute-force version, and its contract."""

from __future__ import annotations

import base64
import importlib
import re

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from sensorlake.llm import queries, resampling

SF = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
jaccard_test = importlib.import_module("test_jaccard")
pii_test = importlib.import_module("test_pii")

_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return _WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


@pytest.fixture(scope="module")
def stages(spark):
    """Documents before the first stage and after each one."""
    docs = [queries.table(spark, SF, "documents")]
    for _, stage in corpus_pipeline.STAGES:
        docs.append(stage(spark, docs[-1], SF).cache())
    return docs


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages_return_the_columns_of_documents(stages):
    assert [df.columns for df in stages[:-1]] == [COLUMNS] * 5
    assert [df.dtypes for df in stages[:-1]] == [stages[0].dtypes] * 5
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_classifier", "ngram_jaccard_join", "benchmark_decontamination", "pii", "byte_bpe"]


def test_rejected_documents_go(spark, stages):
    drawn = resampling.resampled(stages[0], queries.table(spark, SF, "labels")).where("sampled").collect()
    assert rows(stages[1]).keys() == {r.doc_id for r in drawn}
    assert 0 < stages[1].count() < stages[0].count()


def test_one_document_of_each_group_stays(stages):
    before = [(r.doc_id, r.text) for r in stages[1].collect()]
    first = {doc for doc, class_id, _, _ in jaccard_test.brute(before) if doc == class_id}
    assert rows(stages[2]).keys() == first
    assert len(first) < len(before)


def test_contaminated_documents_go(spark, stages):
    windows = set()
    for r in queries.table(spark, SF, "benchmark").collect():
        w = words(r.text)
        windows |= {tuple(w[i : i + 13]) for i in range(max(1, len(w) - 12))} if w else set()
    kept = set()
    for r in stages[2].collect():
        w = words(r.text)
        hit = {k for n in {len(x) for x in windows} for i in range(len(w) - n + 1) if tuple(w[i : i + n]) in windows for k in range(i, i + n)}
        if not hit or 20 * len(hit) < len(w):
            kept.add(r.doc_id)
    assert rows(stages[3]).keys() == kept


def test_personal_data_is_replaced(stages):
    before, after = rows(stages[3]), rows(stages[4])
    assert before.keys() == after.keys()
    for doc, row in after.items():
        spans = pii_test.plain(before[doc].text)
        assert not pii_test.plain(row.text)
        assert row.n_chars == len(row.text)
        if not spans:
            assert row == before[doc]
        else:
            assert all(f"<{kind.upper()}>" in row.text for kind, s, e in spans if not any(a < e and s < b and (k, a, b) != (kind, s, e) for k, a, b in spans))


def test_tokens_are_those_of_the_reference_library(stages):
    with open(public_tokenizers.path(queries.RANK_FILE), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    reference = tiktoken.Encoding("reference", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts, tokens = rows(stages[4]), rows(stages[5])
    assert texts.keys() == tokens.keys()
    for doc, row in tokens.items():
        assert row.ids == reference.encode_ordinary(texts[doc].text)
        assert row.n_tokens == len(row.ids) and row.round_trip


def test_run_is_the_stages_in_order(spark, stages):
    assert rows(corpus_pipeline.run(spark, SF)) == rows(stages[5])


@pytest.mark.parametrize("kind", ["empty", "odd"])
def test_odd_documents_pass_through(spark, stages, kind):
    if kind == "empty":
        docs = stages[0].limit(0)
    else:
        odd = spark.createDataFrame([(10**6, None, None, None, None), (10**6 + 1, "", "en", "s", 0), (None, "mail me@x.org now", "en", "s", 17)], stages[0].schema)
        docs = stages[0].unionByName(odd).withColumn("extra", F.lit("x")).withColumn("tokens", F.lit(1)).withColumn("n_tokens", F.lit("y"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        columns = docs.columns
        docs = stage(spark, docs, SF).cache()
        assert docs.columns == columns
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert (len(out) > 0) == (kind == "odd")
    assert all(r.round_trip for r in out)
