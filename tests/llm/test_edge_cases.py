"""Nulls, empty and very long texts, repeated rows, empty tables and clashing columns, for every operator and stage."""

import numpy as np
import pytest

import corpus_pipeline
from sitegauge.llm import (host_rules, licenses, mixing, packing, pii_crf, quality_gam, rp_forest, simhash_bk, token_cache, toxicity_cnn)

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, score double, fp long, `a.b` string, "
          "component_id string, block string, label string, digest string, host string, kept boolean")
EXTRA = (0.5, 7, "x", "c", "b", "l", "d", "h", True)
PROSE = " ".join(f"word{k} and more" for k in range(40))
ROWS = [
    (1, None, "en", "s", None), (2, "", "en", "s", 0), (3, " \n\t ", None, None, 4), (None, PROSE, "en", "s", 9),
    (4, PROSE + " one", "en", "t", 5), (4, PROSE + " one", "en", "t", 5), (5, "short text", "fr", "t", 10),
    (5, PROSE + " Licensed under the Apache License, Version 2.0. mail a.b@c.example.org", "fr", "t", 11),
    (6, " ".join(f"w{k % 977}x{k % 13}" for k in range(60_000)), "en", "s", None), (7, "x" * 100_000, "en", None, 1),
    (8, "é\U0001f600 <|endoftext|> ퟿", "en", "s", 3),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, *EXTRA) for r in ROWS], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(4, 1, 0), (5, 0, 1), (None, 1, 1), (6, None, None), (99, 1, 0)], "doc_id long, quality int, toxic int")


def _models(docs, labels):
    return quality_gam.train(docs, labels), toxicity_cnn.train(docs, labels), pii_crf.Tagger()


PER_ROW = {
    "tokens": lambda d, m: token_cache.count_tokens(d),
    "quality": lambda d, m: quality_gam.score_quality(d, m[0]),
    "toxicity": lambda d, m: toxicity_cnn.score_toxicity(d, m[1]),
    "personal": lambda d, m: pii_crf.find_personal_data(d, m[2]),
    "rules": lambda d, m: host_rules.judge(d),
    "licenses": lambda d, m: licenses.find_licenses(d),
    "simhash": lambda d, m: simhash_bk.near_duplicates(d),
}


@pytest.fixture(scope="module")
def models(docs, labels):
    return _models(docs, labels)


@pytest.mark.parametrize("name", PER_ROW)
def test_one_row_per_document(docs, models, name):
    got = [r["doc_id"] for r in PER_ROW[name](docs, models).collect()]
    assert sorted(map(str, got)) == sorted(str(r[0]) for r in ROWS)


@pytest.mark.parametrize("name", PER_ROW)
def test_empty_table(empty, models, name):
    assert PER_ROW[name](empty, models).count() == 0


def test_values(docs, models):
    by_id = lambda df: {r["doc_id"]: r for r in df.collect()}
    tokens = by_id(token_cache.count_tokens(docs))
    assert tokens[1]["n_tokens"] == tokens[2]["n_tokens"] == tokens[1]["n_bytes"] == 0 and tokens[7]["n_bytes"] == 100_000
    rules = by_id(host_rules.judge(docs))
    assert rules[1]["n_words"] == 0 and rules[1]["base_failed"] and not rules[1]["kept"]
    assert rules[6]["n_words"] == 60_000
    prints = by_id(simhash_bk.near_duplicates(docs))
    assert prints[1]["fingerprint"] == prints[3]["fingerprint"] == "0" * 16 and prints[3]["component_id"] == 1
    found = [r for r in licenses.find_licenses(docs).collect() if r["n_licenses"]]
    assert [(r["doc_id"], r["licenses"]) for r in found] == [(5, "apache-2.0")]
    personal = [r for r in pii_crf.find_personal_data(docs, models[2]).collect() if r["n_email"]]
    assert [r["doc_id"] for r in personal] == [5]


def test_training_without_labels(docs, empty, labels):
    quality, toxic, _ = _models(docs, labels.limit(0))
    assert {r["score"] for r in quality_gam.score_quality(docs, quality).collect()} == {0.5}
    assert {r["score"] for r in toxicity_cnn.score_toxicity(docs, toxic).collect()} == {0.5}
    quality, toxic, _ = _models(empty, labels)
    assert quality.start == 0.0
    assert pii_crf.train(empty).decode(np.zeros((1, pii_crf.WINDOW), int))[0].shape == (1, pii_crf.WINDOW)


def test_packing_and_mixture(docs, empty):
    pieces = packing.pack_documents(docs).collect()
    assert sum(p["length"] for p in pieces if p["doc_id"] == 1) == 1
    assert packing.pack_documents(empty).count() == 0 and mixing.mix(empty).count() == 0
    rows = mixing.mix(docs).collect()
    assert len([r for r in rows if r[f"{mixing.OWN}epoch"] == 0]) == len(ROWS)
    assert mixing.mix(docs, budget=0).count() == 0


def test_stages_keep_the_columns(spark, docs, empty, models, monkeypatch):
    monkeypatch.setattr(pii_crf, "train", lambda documents: models[2])  # training has its own tests
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, "")
        assert got.columns == docs.columns and got.dtypes == docs.dtypes, name
        assert stage(spark, empty, "").count() == 0, name
    kept = [(r["doc_id"], r["text"]) for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()]
    assert kept.count((4, PROSE + " one")) <= 1 and (1, None) in kept and (2, "") not in kept
    redacted = {r["doc_id"]: r for r in corpus_pipeline.personal_data(spark, docs, "").collect() if r["source"] == "t"}
    assert "[EMAIL]" in redacted[5]["text"] or "short" in redacted[5]["text"]
    texts = [r["text"] for r in corpus_pipeline.personal_data(spark, docs, "").collect()]
    assert None in texts and not any("@c.example.org" in (t or "") for t in texts)


def test_vectors(spark):
    rows = [
        (1, [1.0, 0.0], 1, "x"), (2, [1.0, 0.0], 1, "x"), (3, [2.0, 0.01], 1, "x"), (4, [1.0, 0.0], 2, "x"), (5, [1.0, 0.0], None, "x"),
        (6, None, 1, "x"), (7, [0.0, 0.0], 1, "x"), (8, [float("nan"), 1.0], 1, "x"), (9, [None, 1.0], 1, "x"), (10, [float("inf"), 1.0], 1, "x"),
        (11, [1.0, 0.0, 0.0], 1, "x"), (12, [], 1, "x"), (13, [1.0, -0.0], 1, "x"), (None, [0.0, 1.0], 1, "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, rep string")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in rp_forest.near_vectors(df).collect()}
    for k in (1, 2, 3, 13):
        assert got[k] == (3, 1), k
    for k in (4, 5, 6, 7, 8, 9, 10, 11, 12):
        assert got[k] == (0, k), k
    assert got[None] == (0, None) and len(got) == len(rows)
    assert rp_forest.near_vectors(df.limit(0)).count() == 0
