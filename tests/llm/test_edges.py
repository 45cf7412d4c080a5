"""Every operator on nulls, empty and long texts, repeated rows, empty tables, clashing names."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lakewright.llm import contamination, language, lines, neardup, pieces, quality, secrets, tokens, toxicity, urls

MODEL = "piece_bpe_32k.model"


def _path(name):
    import public_tokenizers

    return public_tokenizers.path(name)


def _operators(spark, folder):
    labels = spark.createDataFrame([(4, 1, 0), (6, 0, 1), (None, 1, None)], "doc_id long, quality int, toxic int")
    items = spark.createDataFrame([(1, "word1 word2 word3 word4 word5 word6"), (2, None), (3, ""), (None, "one id")], "item_id long, text string")
    return {
        "tokens": lambda d: tokens.token_counts(d, _path("word_bpe_49k.json"), f"{folder}/cache", by_word=True),
        "language": lambda d: language.identified(d, language.fit_languages(d)),
        "toxicity": lambda d: toxicity.toxicity(d, toxicity.fit_toxicity(toxicity.gathered_sample(d, labels))),
        "quality": lambda d: quality.quality(d, quality.fit_quality(d, labels)),
        "secrets": lambda d: secrets.secret_spans(d, secrets.fit_dictionary(d)),
        "neardup": neardup.near_duplicates,
    }, {
        "contamination": lambda d: contamination.contaminated(d, items),
        "pieces": lambda d: pieces.encoded(d, _path(MODEL)),
        "lines": lambda d: lines.without_boilerplate(d, F.col("source"), F.col("text")),
        "urls": lambda d: urls.judged_urls(d, "doc_id", "text", "lang"),
    }


ONE_ROW = ["tokens", "language", "toxicity", "quality", "secrets", "neardup"]
OTHERS = ["contamination", "pieces", "lines", "urls"]


@pytest.mark.parametrize("name", ONE_ROW + OTHERS)
def test_odd_rows_and_clashing_columns(spark, odd_documents, clashing, tmp_path, name):
    one, other = _operators(spark, tmp_path)
    run = {**one, **other}[name]
    plain = sorted(map(repr, run(odd_documents).drop("row").collect()))
    assert sorted(map(repr, run(clashing(odd_documents)).drop("row").collect())) == plain
    if name in ONE_ROW or name in ("lines", "urls"):
        assert len(plain) == odd_documents.count()


@pytest.mark.parametrize("name", ONE_ROW + OTHERS)
def test_empty_tables(spark, documents, tmp_path, name):
    one, other = _operators(spark, tmp_path)
    empty = documents((1, "x")).filter("doc_id < 0")
    assert {**one, **other}[name](empty).count() == 0


@pytest.mark.parametrize("stage", range(4))
def test_stages_keep_the_columns(spark, odd_documents, clashing, stage):
    docs = clashing(odd_documents)
    out = corpus_pipeline.STAGES[stage][1](spark, docs, "/root/testdata/sf0.001")
    assert out.columns == docs.columns
    out.collect()


def test_last_stage_on_odd_rows(spark, odd_documents, clashing):
    out = corpus_pipeline.STAGES[4][1](spark, clashing(odd_documents), "/root/testdata/sf0.001")
    assert out.select("doc_id", "text_key").distinct().count() == 10
