"""Near copies through fingerprints and BK-trees."""

import numpy as np
import pytest
from xxhash import xxh64_intdigest

from sitegauge.llm import near_copies, simhash_bk


@pytest.mark.parametrize("shard_size", [64, 8192])
def test_links_within_three_bits(spark, shard_size):
    rng = np.random.default_rng(9)
    fps = set()
    for base in rng.integers(0, 2**63, size=60, dtype=np.uint64).tolist() + [0] * 30:
        for _ in range(3):
            x = base
            for bit in rng.choice(64, size=rng.integers(0, 5), replace=False).tolist():
                x ^= 1 << bit
            fps.add(x)
    fps = sorted(fps)
    root = list(range(len(fps)))
    for a in range(len(fps)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= 3 and root[a] != root[b]:
                low, high = sorted((root[a], root[b]))
                root = [low if r == high else r for r in root]
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    links = simhash_bk.near_links(spark.createDataFrame([(x,) for x in signed], "fp long"), shard_size, 3).collect()
    got = list(range(len(fps)))
    for a, b in ((signed.index(r["a"]), signed.index(r["b"])) for r in links):
        if got[a] != got[b]:
            low, high = sorted((got[a], got[b]))
            got = [low if r == high else r for r in got]
    assert got == root


def test_copies_are_found_by_trees_and_decided_on_their_shingles(spark):
    """No two documents share a band here."""
    words = [f"w{k * 7 % 400}" for k in range(400)]
    texts = [" ".join(words), " ".join([*words[:-1], "other"]), " ".join(["first", *words[1:]]),
             " ".join(f"v{k}" for k in range(300))]
    sets = [near_copies.shingle_set(t) for t in texts]
    nodes = np.array([xxh64_intdigest(s.tobytes()) for s in sets], np.uint64).view(np.int64).tolist()
    fps = np.array([simhash_bk.fingerprint_of(s) for s in sets], np.uint64)
    assert max(int(a ^ fps[0]).bit_count() for a in fps[:3].tolist() for a in [np.uint64(a)]) <= near_copies.RADIUS
    fps[3] = fps[0]  # a fingerprint alone joins nothing
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    hashes = {r["doc_id"]: r["h"] for r in docs.select("doc_id", simhash_bk.row_hash().alias("h")).collect()}
    prints = spark.createDataFrame(
        [(k, hashes[k], n, f, [k]) for k, (n, f) in enumerate(zip(nodes, fps.view(np.int64).tolist(), strict=True))],
        "doc_id long, text_hash long, node long, fp long, keys array<long>")
    got = {r["node"]: r["root"] for r in near_copies.classes(prints, docs).collect()}
    assert got == dict.fromkeys(nodes[:3], min(nodes[:3]))
