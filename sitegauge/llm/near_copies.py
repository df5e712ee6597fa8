"""Near copies by the exact Jaccard similarity of their word shingles.

Pairs that may be similar are found by their SimHash fingerprints, which BK-trees link at three or fewer differing bits
(see simhash_bk); each class that the trees find is a group.  A pair at similarity 0.8 may differ in more bits than trees
can search.  For what the trees leave apart, documents that agree in a band of MinHash values are further groups: a pair
at the least similarity is missed with a chance of (1 - 0.8**4)**20 = 0.00003.  Every pair is decided on the shingles
themselves.  First each document of a group is compared with the group's smallest one; what links have joined is not
compared again.  In groups that still hold several components all pairs of different components are compared, block by
block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitegauge.llm.common import staged, whole_text
from sitegauge.llm.components import connected
from sitegauge.llm.simhash_bk import fingerprint_of, near_links, row_hash, shingle_hashes, stay_first

SHINGLE, SIMILARITY, BANDS, BAND_ROWS = 5, 0.8, 20, 4
#: Differing bits at which the trees link fingerprints: shards agree in one of four blocks of 16 bits.
RADIUS = 3
#: Documents of a group that are compared in one task.
BLOCK = 1_000
_RNG = np.random.default_rng(11)
_ADD, _TIMES = (_RNG.integers(0, 2**64, size=BANDS * BAND_ROWS, dtype=np.uint64) for _ in range(2))
_TIMES |= np.uint64(1)


def shingle_set(text: str, shingle: int = SHINGLE) -> np.ndarray:
    """The distinct shingles as sorted hashes; empty for a text without words."""
    return np.unique(shingle_hashes(text, shingle))


def band_keys(hashes: np.ndarray) -> list[int]:
    """One signed key per band; none for an empty set."""
    from xxhash import xxh64_intdigest

    if not len(hashes):
        return []
    least = np.full(BANDS * BAND_ROWS, 2**64 - 1, np.uint64)
    for at in range(0, len(hashes), 10_000):
        part = hashes[at:at + 10_000, None]
        for k in range(0, len(least), 16):
            least[k:k + 16] = np.minimum(least[k:k + 16], ((part ^ _ADD[k:k + 16]) * _TIMES[k:k + 16] >> np.uint64(20)).min(0))
    bands = least.reshape(BANDS, BAND_ROWS)
    return np.array([xxh64_intdigest(b.tobytes(), seed=k) for k, b in enumerate(bands)], np.uint64).view(np.int64).tolist()


def _sets(documents: DataFrame, shingle: int, *more: str) -> DataFrame:
    """Of every row node (the set's hash) and the set; or `more`, node, the set's fingerprint and band keys."""
    from pyspark.sql.types import BinaryType, LongType, StructField, StructType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest

        for batch in batches:
            for low in range(0, batch.num_rows, 500):
                part = batch.slice(low, 500)
                raw = [shingle_set(t.as_py(), shingle).tobytes() for t in part.column(0)]
                nodes = np.array([xxh64_intdigest(r) for r in raw], np.uint64).view(np.int64)
                if more:
                    found = [np.frombuffer(r, "<u8") for r in raw]
                    fps = np.array([fingerprint_of(f) for f in found], np.uint64).view(np.int64)
                    keys = pa.array([band_keys(f) for f in found], pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_arrays([*part.columns[1:], pa.array(nodes), pa.array(fps), keys], names=[*more, "node", "fp", "keys"])
                else:
                    yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(raw, pa.binary())], names=["node", "shingles"])

    fields = ", ".join(f"{c} bigint" for c in more)
    schema = f"{fields}, node bigint, fp bigint, keys array<bigint>" if more else StructType([StructField("node", LongType()), StructField("shingles", BinaryType())])
    return documents.select("text", *more).mapInArrow(run, schema)


def _similar(a: int, b: int, both: np.ndarray | int, similarity: float):
    return both >= similarity * (a + b - both) - 1e-9


def _decided(links: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The links (a, b) whose sets are similar."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for a, b in zip(batch.column(2), batch.column(3), strict=True):
                a, b = np.frombuffer(a.as_py(), "<u8"), np.frombuffer(b.as_py(), "<u8")
                low, high = sorted((len(a), len(b)))
                kept.append(low >= similarity * high - 1e-9 and bool(_similar(low, high, len(np.intersect1d(a, b, assume_unique=True)), similarity)))
            yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    return links.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(run, "a bigint, b bigint")


def block_links(similarity: float):
    """For applyInPandas over one block pair of a group: links (a, b) that span its similar documents."""
    def run(group: pd.DataFrame) -> pd.DataFrame:
        node, found = group["node"].to_numpy(), [np.frombuffer(s, "<u8") for s in group["shingles"]]
        size = np.array([len(s) for s in found])
        values, flat = np.unique(np.concatenate(found), return_inverse=True)
        starts = np.concatenate([[0], np.cumsum(size)[:-1]])
        known = np.unique(group["component"].to_numpy(), return_inverse=True)[1]
        first = np.full(known.max() + 1, len(node))
        np.minimum.at(first, known, np.arange(len(node)))
        root, mark, pairs = first[known], np.zeros(len(values), np.int32), []
        for k in range(len(node)):
            if (root == root[k]).all():
                break
            mine = flat[starts[k]:starts[k] + size[k]]
            mark[mine] = 1
            near = _similar(size[k], size, np.add.reduceat(mark[flat], starts), similarity) & (root != root[k])
            mark[mine] = 0
            for other in np.unique(root[near]):
                b = int(np.flatnonzero(near & (root == other))[0])
                pairs.append((node[k], node[b]))
                root[root == other] = root[k]
        return pd.DataFrame(pairs, columns=["a", "b"], dtype=np.int64)
    return run


def _shared(rows: DataFrame, name: str) -> DataFrame:
    """The rows (node, key) whose key several have."""
    # counted in the map tasks first; the join back may split a key that many documents share
    several = staged(rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"), "near-keys")
    return staged(rows.join(several, "key"), name)


def _compared(shared: DataFrame, sets: DataFrame, links: DataFrame | None, similarity: float, block: int) -> DataFrame:
    """`links` and those that join the similar documents of each group: rows (node, key) with one key."""
    def placed(known: DataFrame) -> DataFrame:
        roots = connected(known).withColumnRenamed("root", "component")
        return staged(shared.join(roots, "node", "left").withColumn("component", F.coalesce("component", "node")), "near-open")

    def several(rows: DataFrame) -> DataFrame:
        """key, pivot and n of groups with several components."""
        counted = rows.groupBy("key").agg(F.min(F.struct("node", "component")).alias("pivot"), F.count("*").alias("n"),
                                          F.min("component").alias("low"), F.max("component").alias("high"))
        return counted.where("low < high").select("key", "pivot", "n")

    rows = shared.withColumn("component", F.col("node")) if links is None else placed(links)
    stars = rows.join(staged(several(rows), "near-pivots"), "key").where("component != pivot.component")
    found = staged(_decided(stars.select(F.col("node").alias("a"), F.col("pivot.node").alias("b")).distinct(), sets, similarity), "near-pairs")
    if links is not None:
        found = links.unionByName(found)
    rows = placed(found)
    # two documents of a group have been compared; so have all where one component is left
    left = rows.join(several(rows).where("n > 2").select("key", "n"), "key")
    left = left.withColumn("blocks", F.ceil(F.col("n") / block)).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    left = left.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    left = left.select("key", "node", "component", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"))
    more = left.join(sets, "node").groupBy("key", "one", "two").applyInPandas(block_links(similarity), "a bigint, b bigint")
    return staged(found.unionByName(more), "near-links")


def classes(prints: DataFrame, documents: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY, block: int = BLOCK,
            radius: int = RADIUS) -> DataFrame:
    """node and root of every node that is similar to another; `prints`: doc_id, text_hash, node, fp, keys of `documents`."""
    # an empty set is like no other; it has no keys
    nodes = staged(prints.where(F.size("keys") > 0).groupBy("node").agg(F.first("fp").alias("fp"), F.first("keys").alias("keys")), "near-nodes")
    linked = connected(near_links(nodes.select("fp").distinct(), radius=radius)).select(F.col("node").alias("fp"), "root")
    trees = _shared(nodes.select("fp", "node").join(linked, "fp", "left").select("node", F.coalesce("root", "fp").alias("key")), "near-trees")
    bands = _shared(nodes.select("node", F.explode("keys").alias("key")), "near-bands")

    either = trees.select("node").unionByName(bands.select("node")).distinct()
    some = prints.select("node", "text_hash").join(either, "node", "left_semi").groupBy("node").agg(F.min("text_hash").alias("text_hash"))
    texts = documents.select(row_hash().alias("text_hash"), whole_text().alias("text")).join(some.select("text_hash"), "text_hash", "left_semi")
    sets = staged(_sets(texts, shingle).groupBy("node").agg(F.first("shingles").alias("shingles")), "near-sets")

    links = _compared(trees, sets, None, similarity, block)
    return connected(_compared(bands, sets, links, similarity, block))


def one_of_each(documents: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY, block: int = BLOCK) -> DataFrame:
    """One row of each class of near copies, with the columns of `documents`: that with the smallest id.

    Rows without an id stay only where their class has none with an id.  Of repeated rows one stays; null texts and texts
    without words are one class.
    """
    narrow = documents.select(F.col("doc_id").cast("long").alias("doc_id"), row_hash().alias("text_hash"), whole_text().alias("text"))
    prints = staged(_sets(narrow, shingle, "doc_id", "text_hash"), "near-prints")
    roots = classes(prints, documents, shingle, similarity, block).withColumnRenamed("node", "of")
    placed = prints.join(roots, F.col("node") == F.col("of"), "left").select("doc_id", "text_hash", F.coalesce("root", "node").alias("root"))
    return stay_first(documents, placed)
