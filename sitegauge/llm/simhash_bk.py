"""SimHash near duplicates: fingerprints linked through BK-trees.

Two fingerprints that differ in at most two of 64 bits agree in at least one of three blocks of bits (with a wider radius
there are as many more blocks).  A shard is the set
of distinct fingerprints that agree in a block; each shard has a BK-tree whose children are keyed by their Hamming
distance to the parent, and every fingerprint of the shard is searched in it along the edges within the radius.  Trees
and searches meet in the shard's task: all trees together grow with the corpus, so none is sent to all executors.  A
shard that is larger than a bound is cut anew by as many blocks of its remaining bits, until it cannot be: no pair is
lost and no task holds more than the bound.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sitegauge.llm.common import OWN, named, staged, whole_text
from sitegauge.llm.components import connected

RADIUS, SHINGLE, SEED = 2, 3, 42
#: Distinct fingerprints of one shard, and rows whose trees a task builds at once.
SHARD, AT_ONCE = 8192, 60_000
_PAIRS_AT_ONCE = 300_000


def shingle_hashes(text: str, shingle: int = SHINGLE) -> np.ndarray:
    """One hash per run of `shingle` words; a shorter text is one run, a text without words has none."""
    from xxhash import xxh64_intdigest

    words = text.encode("utf-8", "surrogatepass").lower().split()  # ASCII letters and ASCII white space only
    if not words:
        return np.zeros(0, "<u8")
    if len(words) < shingle:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[k:] for k in range(shingle)), strict=False))
    return np.fromiter(map(xxh64_intdigest, shingles, repeat(SEED)), dtype="<u8")


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    return fingerprint_of(shingle_hashes(text, shingle))


def fingerprint_of(hashes: np.ndarray) -> int:
    """Unsigned 64 bits; a bit is set if it is in over half the shingles' hashes."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 100_000):
        part = hashes[at:at + 100_000]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(documents: DataFrame) -> DataFrame:
    """doc_id, text_hash, fp (as a signed long) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t.as_py()) for t in batch.column(2)], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps)], names=["doc_id", "text_hash", "fp"])

    narrow = documents.select(F.col("doc_id").cast("long").alias("doc_id"), row_hash().alias("text_hash"), whole_text().alias("text"))
    return narrow.mapInArrow(run, "doc_id bigint, text_hash bigint, fp bigint")


def row_hash():
    """Tells rows with the same id and different texts apart; a null text counts as empty."""
    return F.xxhash64(whole_text(), F.col("doc_id").isNull())


class Forest:
    """BK-trees over many shards at once, as arrays: nodes are rows, children of a node are sorted by their distance to it."""

    def __init__(self, shard: np.ndarray, fp: np.ndarray):
        """`shard`: sorted shard numbers of the rows; the first row of a shard is its root."""
        n = len(fp)
        self.fp, self.shard = fp, shard
        self.root = np.flatnonzero(np.append(True, shard[1:] != shard[:-1])) if n else np.zeros(0, np.int64)
        root_of = self.root[np.cumsum(np.append(True, shard[1:] != shard[:-1])) - 1] if n else np.zeros(0, np.int64)
        self.root_of = root_of
        parent, edge = np.full(n, -1), np.zeros(n, np.int64)
        waiting = np.setdiff1d(np.arange(n), self.root)
        at = root_of[waiting]
        while len(waiting):
            d = np.bitwise_count(fp[waiting] ^ fp[at]).astype(np.int64)
            slot = at * 65 + d
            order = np.lexsort((waiting, slot))
            waiting, at, d, slot = waiting[order], at[order], d[order], slot[order]
            first = np.append(True, slot[1:] != slot[:-1])
            child = waiting[first]
            parent[child], edge[child] = at[first], d[first]
            at = np.repeat(child, np.diff(np.append(np.flatnonzero(first), len(slot))))
            waiting, at = waiting[~first], at[~first]
        inner = np.flatnonzero(parent >= 0)
        self.slots = parent[inner] * 65 + edge[inner]
        order = np.argsort(self.slots, kind="stable")
        self.slots, self.children = self.slots[order], inner[order]

    def links(self, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(searched row, found row) pairs within the radius, in bounded parts."""
        for low in range(0, len(self.fp), 20_000):
            rows = np.arange(low, min(low + 20_000, len(self.fp)))
            stack = [(rows, self.root_of[rows])]
            while stack:
                query, node = stack.pop()
                if len(query) > _PAIRS_AT_ONCE:
                    half = len(query) // 2
                    stack += [(query[half:], node[half:]), (query[:half], node[:half])]
                    continue
                d = np.bitwise_count(self.fp[query] ^ self.fp[node]).astype(np.int64)
                near = (d <= radius) & (query != node)
                if near.any():
                    yield query[near], node[near]
                first = np.searchsorted(self.slots, node * 65 + np.maximum(d - radius, 0), side="left")
                last = np.searchsorted(self.slots, node * 65 + np.minimum(d + radius, 64), side="right")
                many = last - first
                if many.sum():
                    place = np.repeat(first - np.append(0, np.cumsum(many)[:-1]), many) + np.arange(many.sum())
                    stack.append((np.repeat(query, many), self.children[place]))


def spanning(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The smallest row that each of n rows reaches over the pairs: labels sink until they rest."""
    root = np.arange(n)
    for a, b in pairs:
        while True:
            low = np.minimum(root[a], root[b])
            if (root[a] == low).all() and (root[b] == low).all():
                break
            np.minimum.at(root, root[a], low)
            np.minimum.at(root, root[b], low)
            while (root[root] != root).any():
                root = root[root]
    return root


def shard_links(shard_size: int = SHARD, radius: int = RADIUS):
    """For mapInArrow over rows (key, fp) sorted by key: links (a, b) that span each key's near pairs, or the key as too large."""
    def search(key: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        start = np.append(True, key[1:] != key[:-1])
        size = np.diff(np.append(np.flatnonzero(start), len(key)))
        hot = key[start][size > shard_size]
        kept = np.repeat((size > 1) & (size <= shard_size), size)
        key, fp = key[kept], fp[kept]
        root = spanning(len(fp), Forest(key, fp.view(np.uint64)).links(radius))
        linked = root != np.arange(len(fp))
        a, b = fp[linked], fp[root[linked]]
        empty = len(hot)
        return pa.RecordBatch.from_arrays(
            [pa.array(list(a) + [None] * empty, pa.int64()), pa.array(list(b) + [None] * empty, pa.int64()),
             pa.array([None] * len(a) + hot.tolist(), pa.int64())], names=["a", "b", "hot"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, fps = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            keys = np.append(keys, batch.column(0).to_numpy(zero_copy_only=False))
            fps = np.append(fps, batch.column(1).to_numpy(zero_copy_only=False))
            if len(keys) >= AT_ONCE:
                last = int(np.searchsorted(keys, keys[-1]))  # where the last, perhaps unfinished key begins
                if len(keys) - last > shard_size:  # that key is too large already: enough of it to tell is kept
                    keep = np.append(np.arange(last), np.arange(last, last + shard_size + 1))
                    keys, fps = keys[keep], fps[keep]
                if last:
                    yield search(keys[:last], fps[:last])
                    keys, fps = keys[last:], fps[last:]
        if len(keys):
            yield search(keys, fps)
    return run


def _split(bits: list[int], parts: int) -> list[list[int]]:
    return [list(map(int, p)) for p in np.array_split(bits, parts)]


def _signed(bits: list[int]) -> int:
    mask = sum(1 << b for b in bits)
    return mask - (1 << 64) if mask >> 63 else mask


def near_links(nodes: DataFrame, shard_size: int = SHARD, radius: int = RADIUS) -> DataFrame:
    """Links (a, b) between the distinct fingerprints `nodes` (column fp) that connect all pairs within the radius."""
    parts = radius + 1
    if shard_size < 64:
        raise ValueError("a shard below 64 fingerprints would take too many cuts")
    level = {0: ([], list(range(64)))}  # path -> bits that agree, bits that may differ
    rows, found = nodes.withColumn("path", F.lit(0)), []
    while True:
        below, steps = {}, []
        for path, (agreed, free) in level.items():
            cuts = []
            for k, bits in enumerate(_split(free, parts)):
                below[parts * path + k + 1] = (agreed + bits, [b for b in free if b not in bits])
                cuts.append(F.struct(F.lit(parts * path + k + 1).alias("path"), F.lit(_signed(agreed + bits)).cast("long").alias("mask")))
            steps += [F.lit(path), F.array(*cuts)]
        cut = rows.select("fp", F.explode(F.element_at(F.create_map(*steps), F.col("path"))).alias("c"))
        cut = cut.select(F.xxhash64("c.path", F.col("fp").bitwiseAND(F.col("c.mask"))).alias("key"), "fp", F.col("c.path").alias("path"))
        dealt = cut.select("key", "fp").repartition("key").sortWithinPartitions("key", "fp")
        links = staged(dealt.mapInArrow(shard_links(shard_size, radius), "a bigint, b bigint, hot bigint"), "near-links")
        found.append(links.where("hot IS NULL").select("a", "b"))
        hot = links.where("hot IS NOT NULL").select(F.col("hot").alias("key"))
        if hot.isEmpty():
            break
        rows, level = staged(cut.join(hot, "key", "left_semi").select("fp", "path").distinct(), "large-shards"), below
    whole = found[0]
    for more in found[1:]:
        whole = whole.unionByName(more)
    return whole


def classes(prints: DataFrame, shard_size: int = SHARD) -> DataFrame:
    """fp, root, component_id of every distinct fingerprint of the staged table `prints`."""
    nodes = staged(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprints")
    roots = connected(near_links(nodes.select("fp"), shard_size))
    placed = nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    smallest = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    return placed.join(smallest, "root").select("fp", "root", "component_id")


def near_duplicates(documents: DataFrame, shard_size: int = SHARD) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits), component_id of every row.

    Null and texts without words have the fingerprint zero and are linked like any other; repeated rows are each
    returned; rows with a null id take part, and component_id is the smallest id that is not null; an empty table gives no
    rows; other columns are ignored.
    """
    prints = staged(fingerprints(documents).select("doc_id", "fp"), "prints")
    return prints.join(classes(prints, shard_size), "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def stay_first(documents: DataFrame, placed: DataFrame) -> DataFrame:
    """The row of `documents` with the smallest id of each root; `placed`: doc_id, text_hash, root of every row."""
    best = placed.groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("best"))
    own_id, own_hash, rank = f"{OWN}id", f"{OWN}hash", f"{OWN}rank"
    stays = best.select(F.coalesce("best.doc_id", F.lit(-1).cast("long")).alias(own_id), F.col("best.text_hash").alias(own_hash))
    keyed = documents.withColumns({own_id: F.coalesce(F.col("doc_id").cast("long"), F.lit(-1).cast("long")), own_hash: row_hash()})
    first = Window.partitionBy(own_id, own_hash).orderBy(F.xxhash64(*(F.col(f"`{c}`") for c, kind in documents.dtypes if "map<" not in kind and kind != "variant")))
    return keyed.join(stays, [own_id, own_hash]).withColumn(rank, F.row_number().over(first)).where(F.col(rank) == 1).select(*named(documents))
