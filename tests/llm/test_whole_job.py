"""Cases that the operators once cut short."""

from pathlib import Path

import numpy as np
import pytest

import corpus_pipeline
from sitegauge.llm import mixing, near_copies, packing, tokens, toxicity_cnn
from sitegauge.llm.common import shared_dir
from sitegauge.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def test_mixture_of_equal_sources(spark):
    docs = spark.createDataFrame([(k, "a b c", f"s{k % 2}") for k in range(10)], "doc_id long, text string, source string")
    assert mixing.find_exponent(mixing.source_tokens(docs)) == mixing.SECTION**2
    assert sorted(r["doc_id"] for r in mixing.mix(docs).collect()) == list(range(10))


def test_token_query_stores_its_counts(spark):
    before = set(Path(shared_dir(spark)).glob("token-cache-*"))
    rows = QUERIES["op9_token_cache"](spark, SF_DIR).collect()
    added = [p for p in Path(shared_dir(spark)).glob("token-cache-*") if p not in before]
    assert len(added) == 1
    stored = spark.read.parquet(str(added[0])).collect()
    texts = {r["text"] or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    assert len(rows) == 200 and len(stored) == len(texts) and {r["n_tokens"] for r in stored} == {r["n_tokens"] for r in rows}


def _near_texts():
    rng = np.random.default_rng(4)
    bases = [[f"w{k}" for k in rng.integers(0, 5000, size=200)] for _ in range(30)]
    texts = [" ".join(b) for b in bases]
    for k, b in enumerate(bases):
        for changed in (1, 3, 9):
            copy = list(b)
            for at in rng.choice(200, size=changed, replace=False):
                copy[at] = f"new{k}x{at}x{changed}"
            texts.append(" ".join(copy))
    for k in range(60):  # near the first text, often not near each other
        copy = list(bases[0])
        copy[k * 3], copy[(k * 7 + 50) % 200] = f"hot{k}", f"warm{k}"
        texts.append(" ".join(copy))
    return texts


@pytest.mark.parametrize("block", [20, 1000])
def test_near_copies_with_a_few_changed_words(spark, block):
    texts = _near_texts()
    sets = []
    for t in texts:
        w = t.split()
        sets.append({tuple(w[k:k + 5]) for k in range(len(w) - 4)})
    root = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both >= 0.8 * (len(sets[a]) + len(sets[b]) - both) and root[a] != root[b]:
                low, high = sorted((root[a], root[b]))
                root = [low if r == high else r for r in root]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    assert len(set(root)) < 100
    assert {r["doc_id"] for r in near_copies.one_of_each(docs, block=block).collect()} == set(root)
    if block == 1000:
        assert {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()} == set(root)


def test_long_labelled_texts_are_learned_from(spark):
    rng = np.random.default_rng(6)
    rows = [(k, " ".join(f"w{x}" for x in "abcdefghij"[j % 5] * 3 + str(k)) + " plain" * 600 + " vile" * (k % 2), "en") for k, j in enumerate(rng.integers(0, 9, 60).tolist())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(60)], "doc_id long, toxic int")
    got = {r["doc_id"]: r["score"] for r in toxicity_cnn.score_toxicity(docs, toxicity_cnn.train(docs, labels)).collect()}
    assert min(got[k] for k in range(1, 60, 2)) > max(got[k] for k in range(0, 60, 2))


def test_training_batches_are_bounded():
    rows = [np.zeros((n, 2), np.int64) for n in [10] * 300 + [250_000, 60_000, 60_000]]
    made = list(toxicity_cnn.batches(np.arange(len(rows)), rows))
    assert np.concatenate(made).tolist() == list(range(len(rows)))
    assert all(len(b) == 1 or len(b) <= toxicity_cnn.BATCH and sum(len(rows[k]) for k in b) <= toxicity_cnn.LEARNED for b in made)


def test_packing_keeps_remainders_and_not_whole_documents():
    packer = packing.Packer(8, 0)
    packer.add(1, np.arange(8 * 1000 + 3, dtype="<u4"))
    packer.add(2, np.arange(5, dtype="<u4"))
    held = [ids if ids.base is None else ids.base for items in packer.by_length for _, _, ids, _ in items]
    assert sorted(len(x) for x in held) == [3, 5]


def test_remembered_words_are_bounded():
    words = tokens.WordIds("word_bpe_49k.json")
    for part in range(5):
        text = " ".join(f"w{k}q" for k in range(part * 90_000, (part + 1) * 90_000))
        (ids,) = words.batch([text])
        assert len(words.words) <= 250_001 and len(words.words) == len(words.lengths)
        assert ids[:400].tolist() == words.direct(text[:2000])[:400].tolist()
