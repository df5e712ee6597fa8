"""The operators against their SQL, brute force, exact round trips and held-out labels."""

import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from sitegauge.llm import components, host_rules, licenses, mixing, packing, pii_crf, rp_forest, simhash_bk, token_cache, tokens
from sitegauge.llm.queries import ORACLES, QUERIES
from tests.oracle import compare, connect

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
LARGER = os.path.join(os.path.dirname(SF_DIR), "sf0.01")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, name):
    assert compare(spark, connect(SF_DIR), QUERIES[name], ORACLES[name], SF_DIR) is None


def test_every_operator_has_a_query():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))


# packing

def _check_packing(texts, rows, capacity=2048):
    library = tokens.WordIds("word_bpe_49k.json").library
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    assert set(by_doc) == set(texts)
    for doc_id, pieces in by_doc.items():
        ids = np.array([*library.encode(texts[doc_id], add_special_tokens=False).ids, 1], dtype="<u4")
        at = 0
        for p in sorted(pieces, key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(ids)
            assert p["ids_crc32"] == zlib.crc32(ids[at:at + p["length"]].tobytes())
            at += p["length"]
        assert at == len(ids)
    padding = 0
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert 0 < at <= capacity
        padding += 0 if at & (at - 1) == 0 else capacity - at
    assert padding == 0


def test_packing_round_trip(spark, texts):
    _check_packing(texts, QUERIES["op1_packing"](spark, SF_DIR).collect())


def test_packing_in_small_windows(spark, texts):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").repartition(3)
    _check_packing(texts, packing.pack_documents(docs, window_tokens=5_000).collect())


def test_fill_is_the_best_sum():
    rng = random.Random(4)
    for _ in range(200):
        room = rng.randint(1, 40)
        counts = np.zeros(64, np.int64)
        for _ in range(rng.randint(0, 6)):
            counts[rng.randint(1, 30)] += 1
        sums = {0}
        for length in np.repeat(np.arange(64), counts).tolist():
            sums |= {s + length for s in sums}
        chosen = packing.fill(counts, room)
        assert sum(a * b for a, b in chosen) == max(s for s in sums if s <= room)
        assert all(0 < b <= counts[a] for a, b in chosen)


# tokens

def test_ids_and_counts_are_the_library_s(texts):
    odd = ["Hello's THE<|endoftext|>x it's'S don't. a<|b ÀÉ%%% ǅ. İstanbul. ΑΣ. \x1c x\x1dy é. ﬁ. x²! 5th. 12.5, ...,",
           "", " \n", "日本 語。", "ß. ẞ. µ! ª.", "a  b\n\n c\t\t d   ", "x" * 3000, "<|endoftext|> <|startoftext|>a", "\xa0\x85 b c"]
    words, counts = tokens.WordIds("word_bpe_49k.json"), tokens.ByteCounts("byte_bpe_50k.json", "byte_bpe_50k.tiktoken")
    every = odd + list(texts.values())
    for text, ids in zip(every, words.batch(every), strict=True):
        assert ids.tolist() == words.library.encode(text, add_special_tokens=False).ids
        assert counts.count(text) == len(counts.library.encode(text, add_special_tokens=False).ids)


def test_cache_answers_and_grows(spark, tmp_path, texts):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    path = str(tmp_path / "cache")
    half = docs.where("doc_id % 2 = 0")
    token_cache.count_tokens(half, path).count()
    first = spark.read.parquet(path).count()
    assert first == len({texts[k] for k in texts if k % 2 == 0})
    got = {r["doc_id"]: r["n_tokens"] for r in token_cache.count_tokens(docs, path).collect()}
    assert spark.read.parquet(path).count() == len(set(texts.values()))
    plain = {r["doc_id"]: r["n_tokens"] for r in token_cache.count_tokens(docs).collect()}
    assert got == plain
    version = token_cache.tokenizer_version("byte_bpe_50k.json")
    stored = token_cache.read_cache(spark, path, version)
    assert stored.count() == len(set(texts.values())) and token_cache.read_cache(spark, path, "other").count() == 0


# personal data

def _plain_spans(text):
    found = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p.lstrip("0")[:4] or "0") <= 255 for p in m[0].split(".")):
            found.append((1, *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        total = sum(int(d) if k % 2 == 0 else sum(divmod(2 * int(d), 10)) for k, d in enumerate(digits[::-1]))
        if 13 <= len(digits) <= 19 and total % 10 == 0:
            found.append((2, *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            found.append((3, *m.span()))
    return found


def test_digit_runs_of_any_length():
    for run, address in (("0" * 5000, True), ("7" * 5000, False), ("0" * 4998 + "25", True), ("0" * 5000 + "256", False)):
        for text in (f"{run}.1.1.1", f"1.{run}.1.1", f"1.1.1.{run}"):
            assert pii_crf.base_spans(text) == _plain_spans(text)
            assert [k for k, *_ in pii_crf.base_spans(text)] == ([1] if address else [])


def test_base_spans_are_the_patterns(texts):
    rng = np.random.default_rng(0)
    for _ in range(3000):
        text = "".join(rng.choice(list("0123456789.@+-ab (%"), size=rng.integers(0, 60)))
        assert pii_crf.base_spans(text) == _plain_spans(text), text
    for text in texts.values():
        assert pii_crf.base_spans(text) == _plain_spans(text)


def test_long_runs_take_linear_time():
    for text in ("1" * 200_000, "1." * 100_000, "a" * 200_000 + "@", "+1" * 50_000, "1 " * 100_000):
        pii_crf.base_spans(text)


def test_tagger_gradients():
    tagger = pii_crf.Tagger()
    for k in tagger.p:
        tagger.p[k] = tagger.p[k].astype(np.float64)
    rng = np.random.default_rng(2)
    x = rng.integers(1, pii_crf.CLASSES, size=(2, 12))
    y = pii_crf.tag_array([(1, 3, 6)], 12)[None, :12].repeat(2, 0)

    def loss():
        em, _ = tagger.emissions(x)
        _, _, whole, chain = tagger.posteriors(em)
        paths = [em[0, k, y[k, 0]] + sum(chain[y[k, t - 1], y[k, t]] + em[t, k, y[k, t]] for t in range(1, 12)) for k in range(2)]
        return (whole - np.array(paths)).mean()

    grad, _ = tagger.step(x, y)
    for name in grad:
        place = tuple(rng.integers(0, s) for s in tagger.p[name].shape)
        tagger.p[name][place] += 1e-5
        up = loss()
        tagger.p[name][place] -= 2e-5
        down = loss()
        tagger.p[name][place] += 1e-5
        assert abs((up - down) / 2e-5 - grad[name][place]) < 1e-6, name


def test_tagger_adds_spans(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdefghij", k=rng.randint(2, 8)))
    prose = lambda n: " ".join(word() for _ in range(n))
    digits = lambda n: "".join(rng.choices("0123456789", k=n))
    made = []
    for k in range(500):
        kind = [f"+1 ({digits(3)}) {digits(3)}-{digits(4)}", f"{word()}.{digits(2)}@{word()}.example.com", f"in {digits(4)} and", f"v {digits(1)}.{digits(1)}"][k % 4]
        made.append((k, f"{prose(12)} {kind} {prose(12)}"))
    docs = spark.createDataFrame(made, "doc_id long, text string")
    tagger = pii_crf.train(docs)
    tests = [f"{prose(8)} ({digits(3)}) {digits(3)}-{digits(4)} {prose(8)}" for _ in range(20)]
    added = [a for _, a in pii_crf.find(tests, tagger)]
    assert sum(len(a) == 1 and a[0][0] == 3 for a in added) >= 14
    clean = [f"{prose(8)} in {digits(4)} and v {digits(1)}.{digits(1)} {prose(8)}" for _ in range(20)]
    assert sum(len(a) for _, a in pii_crf.find(clean, tagger)) <= 1


# classifiers

def test_held_out_labels(spark):
    labels = spark.read.parquet(f"{LARGER}/labels.parquet")
    quality = QUERIES["op2_quality_gam"](spark, LARGER).where("held_out").join(labels, "doc_id").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in quality]) > 0.9
    toxic = QUERIES["op5_toxicity_cnn"](spark, LARGER).join(labels, "doc_id").collect()
    assert all(0 <= r["score"] <= 1 for r in toxic)
    held = [r for r in toxic if r["held_out"]]
    assert {r["doc_id"] for r in held} == {r["doc_id"] for r in toxic if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2}
    assert np.mean([r["predicted"] == r["toxic"] for r in held]) > 0.85


# near duplicates

def _roots(n, pairs):
    parent = list(range(n))

    def find(a):
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a
    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(a) for a in range(n)]


def test_components(spark):
    rng = random.Random(5)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(k, k + 1) for k in range(400, 460)] + [(7, 7)]
    got = {r["node"]: r["root"] for r in components.connected(spark.createDataFrame(pairs, "a long, b long")).collect()}
    want = _roots(500, pairs)
    assert got == {k: want[k] for p in pairs if p[0] != p[1] for k in p}


@pytest.mark.parametrize("shard_size", [64, 8192])
def test_simhash_links(spark, shard_size):
    rng = np.random.default_rng(8)
    fps = []
    for base in rng.integers(0, 2**63, size=150, dtype=np.uint64).tolist() + [0] * 60:
        for _ in range(3):
            x = base
            for bit in rng.integers(0, 64, size=rng.integers(0, 4)).tolist():
                x ^= 1 << bit
            fps.append(x)
    fps = sorted(set(fps))
    signed = [x - 2**64 if x >> 63 else x for x in fps]
    prints = spark.createDataFrame([(k, x) for k, x in enumerate(signed)], "doc_id long, fp long").repartition(5)
    got = {r["fp"]: r["component_id"] for r in simhash_bk.classes(prints, shard_size).collect()}
    pairs = [(a, b) for a in range(len(fps)) for b in range(a) if (fps[a] ^ fps[b]).bit_count() <= 2]
    assert [got[x] for x in signed] == _roots(len(fps), pairs)


def test_fingerprints(spark, texts):
    from xxhash import xxh64_intdigest

    rows = QUERIES["op8_simhash"](spark, SF_DIR).collect()
    assert len(rows) == len(texts)
    for r in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), texts[r["doc_id"]]))
        parts = [" ".join(words[k:k + 3]) for k in range(max(1, len(words) - 2))] if words else []
        ones = Counter(b for p in parts for b in range(64) if xxh64_intdigest(p.encode(), seed=42) >> b & 1)
        assert int(r["fingerprint"], 16) == sum(1 << b for b in range(64) if 2 * ones[b] > len(parts))


@pytest.mark.parametrize("block", [50, 2000])
def test_vector_links(spark, block):
    rng = np.random.default_rng(9)
    vectors = rng.normal(size=(300, 16))
    near = [v + rng.normal(scale=0.12 / 4, size=16) * np.linalg.norm(v) / 4 for v in vectors[:60] for _ in range(4)]
    hot = [vectors[0] * 2 + rng.normal(scale=0.02, size=16) for _ in range(150)]
    x = np.vstack([vectors, near, hot, vectors[:20]])
    labels = rng.integers(0, 2, size=len(x)).tolist()
    df = spark.createDataFrame([(k, v.tolist(), labels[k]) for k, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: r for r in rp_forest.near_vectors(df, block=block, leaf=40).collect()}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    link = (unit @ unit.T >= 0.98) & (np.array(labels)[:, None] == np.array(labels)[None])
    np.fill_diagonal(link, False)
    counts = np.array([got[k]["n_links"] for k in range(len(x))])
    assert (counts <= link.sum(1)).all() and counts.sum() >= 0.9 * link.sum()
    roots = _roots(len(x), np.argwhere(link).tolist())
    assert np.mean([got[k]["component_id"] == roots[k] for k in range(len(x))]) > 0.95
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got.values())


# rules, mixture, licences

def test_a_bad_host_goes_as_a_whole(spark):
    good = " ".join(f"w{k}" for k in range(60))
    rows = [(k, good if k % 10 == 0 else "too short", "bad") for k in range(200)] + [(1000 + k, good, f"h{k % 20}") for k in range(400)]
    got = {r["doc_id"]: r for r in host_rules.judge(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert got[0]["host_failed"] and not got[0]["base_failed"] and not got[0]["kept"]
    assert all(got[1000 + k]["kept"] for k in range(400))


def test_mixture_meets_its_budget(spark):
    rows = [(k, "a b c", "large") for k in range(3000)] + [(5000 + k, "a b c d", f"small{k % 5}") for k in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    own = mixing.OWN
    for options in ({}, {"budget": 9000}, {"entropy": 1.0, "repetition": 4.0}, {"block_docs": 7}):
        sources = mixing.source_tokens(docs)
        exponent = mixing.find_exponent(sources, options.get("entropy", mixing.ENTROPY), options.get("repetition", mixing.REPETITION))
        quota = {r["s"]: r["quota"] for r in mixing.quotas(sources, exponent, options.get("budget")).collect()}
        got = mixing.mix(docs, **options).collect()
        spent = Counter()
        for r in got:
            spent[r["source"]] += r[f"{own}n_tokens"]
        for source, tokens_spent in spent.items():
            assert 0 <= tokens_spent - quota[source] < 6
        if "budget" not in options:
            assert {r["doc_id"] for r in got} == {r[0] for r in rows}
            assert max(r[f"{own}epoch"] for r in got) + 1 <= np.ceil(options.get("repetition", mixing.REPETITION))


def test_licenses_with_changed_words(spark):
    mit = licenses.TEMPLATES["mit"]
    rows = [(1, f"x y z {mit} more"), (2, mit.replace("copy", "duplicate")), (3, "Permission is hereby granted"), (4, mit.upper()), (5, "license " * 30)]
    got = {r["doc_id"]: r["licenses"] for r in licenses.find_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: "mit", 2: "", 3: "", 4: "mit", 5: ""}


# the pipeline

def _first_of_each_class(rows, least=0.8, width=5):
    """Smallest id of each class of texts whose word shingles are alike, every pair compared."""
    sets = {}
    for r in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), r["text"] or ""))
        sets[r["doc_id"]] = {tuple(words[k:k + width]) for k in range(max(1, len(words) - width + 1))}
    root = {k: k for k in sets}
    for a in sorted(sets):
        for b in (x for x in sorted(sets) if x < a):
            both = len(sets[a] & sets[b])
            if both >= least * (len(sets[a]) + len(sets[b]) - both) and root[a] != root[b]:
                low, high = sorted((root[a], root[b]))
                root = {k: low if v == high else v for k, v in root.items()}
    return set(root.values())


def test_pipeline_stages(spark, texts):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    taken = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = simhash_bk.staged(stage(spark, docs, SF_DIR), f"test-{name}")
        taken[name] = docs.collect()
    judged = {r["doc_id"] for r in host_rules.judge(spark.read.parquet(f"{SF_DIR}/documents.parquet")).where("kept").collect()}
    assert {r["doc_id"] for r in taken["quality_rules"]} == judged
    kept = _first_of_each_class(taken["quality_rules"])
    assert {r["doc_id"] for r in taken["near_duplicates"]} == kept
    assert {r["doc_id"] for r in taken["personal_data"]} == kept == {r["doc_id"] for r in taken["mixture"]}
    assert not any(pii_crf.base_spans(r["text"]) for r in taken["personal_data"])
    pieces, library = Counter(), tokens.WordIds("word_bpe_49k.json").library
    for r in taken["packing"]:
        pieces[r["doc_id"]] += r["length"]
    want = Counter()
    for r in taken["mixture"]:
        want[r["doc_id"]] += len(library.encode(r["text"], add_special_tokens=False).ids) + 1
    assert pieces == want
    assert corpus_pipeline.run(spark, SF_DIR).count() == len(taken["packing"])
