"""WARC bundles, importance resampling and centroid clustering against brute force, and their edge cases."""

import hashlib
import io
import math
import os
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import zstandard

from sitegauge.llm import hadamard, importance, warc_bundles
from sitegauge.llm.queries import ORACLES, QUERIES
from tests.oracle import compare, connect

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


# bundles

PAGES = "page_id long, url string, html string, digest string, size long, refers_to long, `a.b` string"


def _pages():
    long, other = "x" * 1500, "é" * 700
    rows = [
        (1, "https://a.example.org/", long), (2, "https://b.example.org/ä b\r\nX: y", long), (9, None, long), (3, "u", "short"), (4, "u", "short"),
        (5, "u", None), (6, "u", ""), (7, "u", other), (8, "u", other), (8, "u", other), (None, "u", long), (None, "u", "only" * 400), (None, None, "only" * 400),
        (10, "u", "\r\n\r\nWARC/1.1\r\n" * 100), (11, "u", "y" * 3_000_000), (12, "u", "a" * 999), (13, "u", "a" * 999), (14, "u", "a" * 1000), (15, "u", "a" * 1000)]
    return rows


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*r, "d", 1, 2, "c") for r in _pages()], PAGES).repartition(3)


def _expected(rows):
    groups = {}
    for page_id, _, html in rows:
        groups.setdefault(html or "", []).append(page_id)
    for page_id, _, html in rows:
        payload = (html or "").encode()
        known = [k for k in groups[html or ""] if k is not None]
        refers = max(known) if len(payload) >= 1000 and known and max(known) != page_id else None
        yield page_id, len(payload), hashlib.sha1(payload).hexdigest(), "response" if refers is None else "revisit", refers


def test_records_come_back(pages):
    archive = warc_bundles.write_archive(pages, frame=2_000, bundle=200)
    got = Counter(tuple(r) for r in warc_bundles.pages_of(archive).collect())
    assert got == Counter(_expected(_pages()))
    # the index names every record's place
    read = warc_bundles.read_archive(archive, payloads=True).collect()
    place = lambda r: (r["record_id"], r["bundle"], r["frame"], r["offset"], r["record_type"])
    assert Counter(map(place, read)) == Counter(map(place, archive.index.collect()))
    assert len({r["bundle"] for r in read}) > 3 and len({(r["bundle"], r["frame"]) for r in read}) > 5
    whole = {r["page_id"]: r["payload"] for r in read if r["record_type"] == "response"}
    for page_id, _, html in _pages():
        if page_id in whole and page_id is not None:
            assert bytes(whole[page_id]) == (html or "").encode()
    urls = {r["page_id"]: r["url"] for r in read}
    assert urls[2] == "https://b.example.org/ä%20b%0D%0AX:%20y" and urls[9] is None


def test_bundles_are_plain_zstandard(pages):
    archive = warc_bundles.write_archive(pages, frame=2_000)
    raw = b""
    for name in sorted({r["bundle"] for r in archive.index.collect()}):
        with open(os.path.join(archive.folder.removeprefix("file:"), name), "rb") as file:
            raw += zstandard.ZstdDecompressor().stream_reader(file, read_across_frames=True).read()
    assert len(list(warc_bundles.parse(raw))) == len(_pages())


def test_single_records_are_found(spark, pages):
    archive = warc_bundles.write_archive(pages, frame=2_000)
    ids = {r["record_id"] for r in archive.index.collect() if r["record_type"] == "response"}
    wanted = sorted(ids)[:4]
    asked = spark.createDataFrame([(w,) for w in [*wanted, wanted[0], "urn:page:77:none", None]], "record_id string")
    got = warc_bundles.find_records(archive, asked).collect()
    assert {r["record_id"] for r in got} == set(wanted)
    assert all(hashlib.sha1(bytes(r["payload"])).hexdigest() == r["payload_digest"] for r in got)


def test_frames_by_the_seek_table():
    out = pa.BufferOutputStream()
    writer = warc_bundles.BundleWriter(out)
    frames = [b"a" * 10, b"", b"bc" * 100_000]
    stream = io.BytesIO()
    writer.stream = stream
    stream.close = lambda: None
    for f in frames:
        writer.frame(f)
    writer.close()
    reader = warc_bundles.BundleReader(pa.PythonFile(io.BytesIO(stream.getvalue()), "r"))
    assert [reader.frame(k) for k in (2, 0, 1)] == [frames[2], frames[0], frames[1]]
    broken = stream.getvalue()[:-1] + b"\0"
    with pytest.raises(ValueError):
        warc_bundles.BundleReader(pa.PythonFile(io.BytesIO(broken), "r"))


def test_empty_archive(pages):
    archive = warc_bundles.write_archive(pages.limit(0))
    assert archive.index.count() == 0 and warc_bundles.pages_of(archive).count() == 0


# resampling

def _by_hand(documents, target, percent=25, least=20, seed=7, buckets=10_000):
    def features(text):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        return words, [zlib.crc32(f.encode()) % buckets for f in [*words, *(f"{a} {b}" for a, b in zip(words, words[1:], strict=False))]]

    corpus, wanted = Counter(), Counter()
    for _, text in documents:
        corpus.update(features(text)[1])
    for text in target:
        wanted.update(features(text)[1])
    s, t = sum(corpus.values()), sum(wanted.values())
    gain = {b: math.floor(1000 * math.log((wanted[b] + 1) * (s + buckets) / ((corpus[b] + 1) * (t + buckets)))) for b in range(buckets)}
    rows = []
    for doc_id, text in documents:
        words, found = features(text)
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append([doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words)])
    able = sorted((r for r in rows if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    rank = {id(r): k + 1 for k, r in enumerate(able[:len(able) * percent // 100])}
    return [(*r[:4], rank.get(id(r))) for r in rows]


def test_resampling_is_the_formula(spark):
    documents = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    target = [r["text"] for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    got = Counter(tuple(r) for r in QUERIES["op12_importance"](spark, SF_DIR).collect())
    assert got == Counter(_by_hand(documents, target))


def test_resampling_of_odd_texts(spark, monkeypatch):
    prose = " ".join(f"Word{k % 37} É{k}" for k in range(30))
    documents = [
        (1, None), (2, ""), (3, " \x00\x7f--"), (4, "one"), (5, prose), (5, prose), (6, prose + " more"), (None, prose), (7, "ß'日本—xİ " * 9),
        (8, " ".join(f"w{k % 997}é{k % 13}" for k in range(60_000))), (9, "x" * 100_000), (10, "A-b_c " * 40), (11, "é" * 50_000 + " z")]
    docs = spark.createDataFrame([(a, b, 1, 2.0, 3, "r") for a, b in documents], "doc_id long, text string, n_words long, score double, rank int, buckets string")
    target = ["WORD1 word2", None, "é " * 30, ""]
    goal = spark.createDataFrame([(t, 1) for t in target], "text string, weight long")
    want = Counter(_by_hand(documents, target, percent=50))
    assert Counter(tuple(r) for r in importance.resample(docs, goal, percent=50).collect()) == want
    kept = {r["doc_id"] for r in importance.selected_documents(docs, goal, percent=50).collect()}
    assert kept == {k[0] for k in want if k[4] is not None and k[0] is not None}
    assert importance.selected_documents(docs, goal).columns == docs.columns
    assert importance.resample(docs.limit(0), goal).count() == 0
    flat = importance.resample(docs, goal.limit(0)).collect()
    assert Counter(tuple(r) for r in flat) == Counter(_by_hand(documents, []))


@pytest.mark.parametrize("part", [1, 7, 64])
def test_long_texts_in_parts(monkeypatch, part):
    text = "".join(np.random.default_rng(part).choice(list("aB1é日 -\x00Z"), size=3000))
    whole = importance.Features(10_000).of(text)
    monkeypatch.setattr(importance, "PART", part)
    assert sorted(importance.Features(10_000).of(text).tolist()) == sorted(whole.tolist())


# clusters

def _plain_clusters(rows, k=16, rounds=3):
    kept = [(i, [math.floor(64 * float(x)) for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted((hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in kept)[:k]
    centroids = [v for _, v in first]

    def assign():
        out = []
        for _, v in kept:
            d = [sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in centroids]
            out.append((d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        at = assign()
        for c in range(len(centroids)):
            own = [v for (_, v), (n, _) in zip(kept, at, strict=True) if n == c]
            if own:
                centroids[c] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    at = assign()
    inertia = Counter()
    for c, d in at:
        inertia[c] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    large = 2**63 - 1
    return [(i, c, min(d, large), min(inertia[c], large), min(sum(inertia.values()), large), digest[c]) for (i, _), (c, d) in zip(kept, at, strict=True)]


def test_progressive_search_is_exact():
    rng = np.random.default_rng(2)
    for scale in (1, 30, 2**23):
        x = rng.integers(-scale, scale + 1, size=(500, 64))
        c = np.concatenate([x[:10], x[3:6], rng.integers(-scale, scale + 1, size=(3, 64))])
        d = ((x[:, None].astype(object) - c[None].astype(object)) ** 2).sum(2)
        number, distance, finished = hadamard.Centroids(c).nearest(x)
        assert number.tolist() == d.argmin(1).tolist() and distance.tolist() == d.min(1).tolist()
        assert finished.min() >= 1 and finished.max() <= len(c)
    centres = rng.integers(-60, 61, size=(16, 64))
    x = centres[rng.integers(0, 16, size=500)] + rng.integers(-8, 9, size=(500, 64))
    assert hadamard.Centroids(centres).nearest(x)[2].mean() < 2  # most are dropped early
    signs = hadamard.coefficients(np.eye(64, dtype=np.int64)).T
    assert (signs @ signs.T == 64 * np.eye(64)).all() and [(np.diff(r) != 0).sum() for r in signs] == list(range(64))


def test_clusters_of_the_table(spark):
    assert compare(spark, connect(SF_DIR), QUERIES["op13_hadamard"], ORACLES["op13_hadamard"], SF_DIR) is None
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    assert Counter(tuple(r) for r in QUERIES["op13_hadamard"](spark, SF_DIR).collect()) == Counter(_plain_clusters(rows))


@pytest.mark.parametrize("large", [1.0, 2.0**30, 1e300])
def test_odd_vectors(spark, large):
    rng = np.random.default_rng(5)
    rows = [(k, (rng.normal(size=64) * (large if k % 9 == 0 else 1)).tolist()) for k in range(60)]
    rows += [(60, [0.0] * 64), (61, [-0.0] * 64), (61, [-0.0] * 64), (62, [1 / 64 - 1e-12] * 64), (None, [0.25] * 64)]
    bad = [(70, None), (71, [1.0] * 63), (72, [1.0] * 65), (73, [None] + [1.0] * 63), (74, [float("nan")] * 64), (75, [float("inf")] * 64), (76, [])]
    df = spark.createDataFrame([(i, v, 3, 1, "x") for i, v in rows + bad], "vec_id long, embedding array<double>, cluster int, distance long, `a.b` string").repartition(4)
    got = Counter(tuple(r) for r in hadamard.cluster(df).drop("finished").collect())
    assert got == Counter(_plain_clusters(rows + bad))
    few = hadamard.cluster(df.where("vec_id < 3")).drop("finished")
    assert Counter(tuple(r) for r in few.collect()) == Counter(_plain_clusters(rows[:3]))
    assert hadamard.cluster(df.limit(0)).count() == 0
