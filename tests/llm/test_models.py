"""Plain loops beside the vectorised models, and cases of hot keys and odd numbers."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sitegauge.llm import mixing, quality_gam, rp_forest, token_cache, toxicity_cnn
from sitegauge.llm.common import labelled_sample
from sitegauge.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def test_additive_model_by_looking_up_each_table():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, len(quality_gam.FEATURES)))
    y = (x[:, 0] * x[:, 1] + x[:, 2] + rng.normal(size=400) * 0.2 > 0).astype(float)
    model = quality_gam.fit(x, y)
    assert model.pairs
    for row, got in zip(x[:60], model.score(x[:60]), strict=True):
        total = model.start
        for k, edges in enumerate(model.edges):
            total += model.tables[k][sum(1 for e in edges if e <= row[k])]
        for (a, b), cells in zip(model.pairs, model.pair_tables, strict=True):
            total += cells[sum(1 for e in model.coarse[a] if e <= row[a])][sum(1 for e in model.coarse[b] if e <= row[b])]
        assert got == pytest.approx(1 / (1 + np.exp(-total)))
    assert ((model.score(x) > 0.5) == y).mean() > 0.9


def _small_model(seed=1):
    rng = np.random.default_rng(seed)
    size, filters = toxicity_cnn.SIZE, toxicity_cnn.FILTERS
    embeddings = rng.normal(size=(12, size))
    embeddings[0] = 0
    return rng, toxicity_cnn.Convolution(
        np.arange(11), embeddings, [rng.normal(size=(w, size, filters)) for w in toxicity_cnn.WIDTHS], [rng.normal(size=filters) for _ in toxicity_cnn.WIDTHS],
        rng.normal(size=filters * len(toxicity_cnn.WIDTHS)), 0.3, {})


def test_convolution_by_loops():
    rng, m = _small_model()
    texts = [rng.integers(0, 12, size=(n, 2)) for n in (0, 1, 2, 7, 30)]
    for rows, got in zip(texts, m.score(texts), strict=True):
        pooled = []
        words = [m.embeddings[a] + m.embeddings[b] for a, b in rows]
        gap = max(toxicity_cnn.WIDTHS) - 1
        for filters, biases in zip(m.filters, m.biases, strict=True):
            for f in range(len(biases)):
                # behind its words a text has a gap of empty ones
                places = [biases[f] + sum(words[p + k] @ filters[k][:, f] for k in range(len(filters)) if p + k < len(words)) for p in range(len(words) + gap)]
                pooled.append(max(0, *places))
        assert got == pytest.approx(1 / (1 + np.exp(-(np.array(pooled) @ m.top + m.top_bias))), abs=1e-5)


def test_gradients_of_the_convolution_are_the_slopes():
    rng, m = _small_model(4)
    rows, y = [rng.integers(1, 12, size=(n, 2)) for n in (3, 6, 9)], np.array([1.0, 0.0, 1.0])

    def loss():
        z = m.logits(rows).astype(float)
        return np.mean(np.log1p(np.exp(-np.where(y == 1, z, -z)))) + 0.5e-4 * (m.top**2).sum()

    grads = toxicity_cnn._gradients(m, rows, y)
    values = [m.embeddings, *m.filters, *m.biases, m.top]
    for value, grad in zip(values, grads[:-1], strict=True):
        flat, slopes = value.reshape(-1), np.asarray(grad).reshape(-1)
        for k in rng.choice(len(flat), size=min(12, len(flat)), replace=False):
            if value is m.embeddings and k < toxicity_cnn.SIZE:
                continue  # the zero row stays zero
            before = flat[k]
            flat[k] = before + 1e-2
            up = loss()
            flat[k] = before - 1e-2
            down = loss()
            flat[k] = before
            assert (up - down) / 2e-2 == pytest.approx(slopes[k], abs=2e-3)


def test_rows_of_hashes():
    known = np.array([3, 5, 9])
    assert toxicity_cnn.rows_of(known, np.array([[3, 4], [9, 10], [0, 5]])).tolist() == [[1, 0], [3, 0], [0, 2]]
    assert toxicity_cnn.rows_of(np.zeros(0, np.int64), np.array([[3, 4]])).tolist() == [[0, 0]]


def test_the_sample_of_labels_is_bounded_by_rows(spark):
    docs = spark.createDataFrame([(1, f"text {k}", "en") for k in range(3000)] + [(k, "t", "en") for k in range(2, 400)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(400)], "doc_id long, toxic int")
    assert labelled_sample(docs, labels, "toxic", 4, 2, 100).count() <= 100
    assert labelled_sample(docs, labels, "toxic", 4, 2, 100_000).where("doc_id = 1").count() <= 1


def test_rows_without_an_id_are_dealt_to_many_blocks(spark):
    docs = spark.createDataFrame([(None, f"a b {k}", "s") for k in range(3000)], "doc_id long, text string, source string")
    blocks = [r["n"] for r in mixing.mix(docs).groupBy(f"{mixing.OWN}block").agg(F.count("*").alias("n")).collect()]
    assert len(blocks) == 6 and max(blocks) < 700 and sum(blocks) == 3000


def test_a_budget_never_repeats_a_source_beyond_the_limit(spark):
    rows = [(k, "w " * 9, "large") for k in range(1000)] + [(k, "w " * 9, "small") for k in range(1000, 1100)] + [(k, "w " * 9, "tiny") for k in range(1100, 1110)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    tokens = {"large": 10_000, "small": 1_000, "tiny": 100}
    for budget in (500, 5_000, 9_000, 300_000):
        got = {r["source"]: r["n"] for r in mixing.mix(docs, budget=budget, repetition=1.5).groupBy("source").agg(F.sum(f"{mixing.OWN}n_tokens").alias("n")).collect()}
        assert all(n < 1.5 * tokens[s] + 10 for s, n in got.items())
        assert abs(sum(got.values()) - min(budget, 16_650)) <= 30
    plan = mixing.quotas(mixing.source_tokens(docs), 0, 6_000).collect()
    # equal weights: the two small ones are full, the rest goes to the large one
    assert {r["s"]: r["quota"] for r in plan}["tiny"] == 150 and {r["s"]: r["quota"] for r in plan}["small"] == 1500
    assert abs({r["s"]: r["quota"] for r in plan}["large"] - 4350) <= 2


def test_the_second_run_is_answered_from_the_first(spark, tmp_path, monkeypatch):
    spark.conf.set(token_cache.FOLDER, str(tmp_path / "cache"))
    try:
        first = sorted(map(tuple, QUERIES["op9_token_cache"](spark, SF_DIR).collect()))
        stored = spark.read.parquet(str(tmp_path / "cache")).count()
        second = sorted(map(tuple, QUERIES["op9_token_cache"](spark, SF_DIR).collect()))
        assert first == second and spark.read.parquet(str(tmp_path / "cache")).count() == stored
    finally:
        spark.conf.unset(token_cache.FOLDER)


def test_a_much_copied_text_is_encoded_once(spark, tmp_path):
    docs = spark.createDataFrame([(k, "the same text") for k in range(2000)] + [(None, "the same text"), (5, None), (6, "other")], "doc_id long, text string").repartition(7)
    got = token_cache.count_tokens(docs, str(tmp_path / "c")).collect()
    assert len(got) == 2003 and spark.read.parquet(str(tmp_path / "c")).count() == 3


def test_wide_and_extreme_vectors(spark):
    wide = [1.0] + [0.0] * 8999
    rows = [(1, wide, 1), (2, [2.0] + [0.001] * 8999, 1), (3, [0.0, 1e-200], 1), (4, [0.0, 3e-200], 1), (5, [0.0, 1e300], 1), (6, [1e300, 0.0], 1), (7, [1e300, 1e299], 1), (8, [0.0] * 8999 + [1.0], 1)]
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in rp_forest.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    assert got == {1: (1, 1), 2: (1, 1), 3: (2, 3), 4: (2, 3), 5: (2, 3), 6: (1, 6), 7: (1, 6), 8: (0, 8)}


def test_links_in_a_group_of_a_third_of_the_rows(spark):
    rng = np.random.default_rng(7)
    centre = rng.normal(size=64)
    group = centre / np.linalg.norm(centre) + rng.normal(size=(2000, 64)) * 0.0125
    x = np.concatenate([group, rng.normal(size=(4000, 64))])
    x[5990:] = x[2000:2010] + rng.normal(size=(10, 64)) * 0.02
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    links = (unit @ unit.T >= 0.98).sum(1) - 1
    assert links[:2000].mean() > 500 and links[2000:].sum() >= 20
    df = spark.createDataFrame([(k, v.tolist(), 1) for k, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: r["n_links"] for r in rp_forest.near_vectors(df).collect()}
    found = np.array([got[k] for k in range(len(x))])
    assert (found <= links).all() and found.sum() >= 0.9 * links.sum() and found[2000:].sum() >= 0.9 * links[2000:].sum()
