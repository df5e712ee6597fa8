"""Embedding near duplicates with a forest of random-projection trees.

A tree splits the vectors again and again at the median of a random projection; vectors close to a split go down both
sides.  Medians are taken from a bounded sample, every vector is dealt to leaves.  Vectors are compared within leaves
only, with equal labels and exact cosines in double precision.  A pair that meets in several leaves counts in the first of
them alone: each row carries all its leaves, so partners are counted without writing pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitegauge.llm.common import sampled, staged
from sitegauge.llm.components import connected

COSINE, TREES, LEAF = 0.98, 8, 192
#: Vectors that splits are fitted on at most; deepest level; projections (in standard deviations) within which both sides are taken.
SAMPLE, DEEPEST, SPILL = 20_000, 16, 0.08
#: Rows of a leaf that are compared in one task; larger leaves are compared block by block.
BLOCK = 2_000
#: Quantiles at which a node may be split; share of its vectors within the link radius of a split above which it stays whole.
CUTS, CROWDED = np.linspace(0.1, 0.9, 33), 0.25
SEED = 29


@dataclass
class Trees:
    """thresholds[t]: of the nodes of tree t in breadth-first order; margins likewise."""

    depth: int
    thresholds: np.ndarray
    margins: np.ndarray

    def directions(self, size: int) -> np.ndarray:
        """One random direction per tree and level, the same for all its nodes."""
        rng = np.random.default_rng([SEED, size])
        d = rng.normal(size=(len(self.thresholds) * self.depth, size))
        return d / np.linalg.norm(d, axis=1, keepdims=True) if len(d) else d

    def leaves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) of every place of unit vectors; leaf numbers differ between trees."""
        rows, found = [], []
        for t in range(len(self.thresholds)):
            at = x @ self.directions(x.shape[1])[t * self.depth:(t + 1) * self.depth].T if self.depth else x[:, :0]
            row, node = np.arange(len(x)), np.zeros(len(x), np.int64)
            for level in range(self.depth):
                off = at[row, level] - self.thresholds[t, node]
                left, right = off <= self.margins[t, node], off > -self.margins[t, node]
                row, node = np.concatenate([row[left], row[right]]), np.concatenate([2 * node[left] + 1, 2 * node[right] + 2])
            rows.append(row)
            found.append((t << 40) + node)
        return np.concatenate(rows), np.concatenate(found)


def cut(at: np.ndarray, radius: float) -> float:
    """Where to split the projections: at the median, or away from it where a group of near copies lies there.

    Infinity, so that all go left, where every split would part a group: such a leaf is compared block by block.
    """
    at = np.sort(at)
    near = lambda x: (np.searchsorted(at, x + radius, "right") - np.searchsorted(at, x - radius, "left")) / len(at)
    middle = float(np.median(at))
    # what a bell-shaped spread of the bulk would have near its median
    usual = 2 * radius * 0.4 / max(float(np.quantile(at, 0.9) - np.quantile(at, 0.1)) / 2.56, 1e-12)
    if near(middle) <= min(1.5 * usual, CROWDED):
        return middle
    places = np.quantile(at, CUTS)
    share = near(places)
    best = int(np.lexsort((np.abs(CUTS - 0.5), np.round(share, 2)))[0])
    return float(places[best]) if share[best] <= CROWDED else np.inf


def fit(sample: np.ndarray, total: int, trees: int = TREES, leaf: int = LEAF, cosine: float = COSINE) -> Trees:
    """Splits node by node; a node that too few sampled vectors reach takes its parent's.

    A group of near copies is not parted: its projections differ by about the link radius over the root of the size.
    """
    radius = float(np.sqrt(max(2 - 2 * cosine, 0) / max(sample.shape[-1], 1))) if len(sample) else 0.0
    depth = int(np.clip(np.ceil(np.log2(max(total, 1) / leaf)), 0, DEEPEST))
    made = Trees(depth, np.zeros((trees, 2**depth - 1)), np.zeros((trees, 2**depth - 1)))
    directions = made.directions(sample.shape[1]) if len(sample) else None
    for t in range(trees if len(sample) else 0):
        held = {0: (np.arange(len(sample)), 0.0, 1.0)}
        for level in range(depth):
            at, below = sample @ directions[t * depth + level], {}
            for node, (rows, middle, spread) in held.items():
                if len(rows) >= 8:
                    middle, spread = cut(at[rows], radius), float(at[rows].std())
                made.thresholds[t, node], made.margins[t, node] = middle, SPILL * spread
                left = at[rows] <= middle
                below[2 * node + 1], below[2 * node + 2] = (rows[left], middle, spread), (rows[~left], middle, spread)
            held = below
    return made


def unit(vectors: list) -> np.ndarray:
    """Vectors of length 1; where the squares of the components leave the range of doubles, these are scaled first."""
    x = np.array(vectors, dtype=np.float64)
    with np.errstate(over="ignore", under="ignore"):
        norm = np.linalg.norm(x, axis=1, keepdims=True)
    odd = ~((norm > 1e-140) & np.isfinite(norm))[:, 0]
    if odd.any():
        x[odd] /= np.abs(x[odd]).max(axis=1, keepdims=True)
        norm[odd] = np.linalg.norm(x[odd], axis=1, keepdims=True)
    return x / norm


def usable(embedding, label):
    """A label, and a vector of finite numbers that are not all zero."""
    limit = F.lit(float("inf"))
    finite = F.forall(embedding, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < limit))
    return F.coalesce(label.isNotNull() & (F.size(embedding) > 0) & finite & F.exists(embedding, lambda v: v != 0), F.lit(False))


def _first_meeting(leaves: np.ndarray, a: np.ndarray, b: np.ndarray, here: int) -> np.ndarray:
    """Whether `here` is the smallest leaf that rows a and b share; leaves: rows x places, sorted, padded by row."""
    first = np.ones(len(a), bool)
    mine = leaves[a]
    for k in range(leaves.shape[1]):
        earlier = (mine[:, k] >= 0) & (mine[:, k] < here)
        if not earlier.any():
            break
        some = np.flatnonzero(earlier & first)
        first[some] &= ~(leaves[b[some]] == mine[some, k][:, None]).any(1)
    return first


def _compare(left: pd.DataFrame, right: pd.DataFrame | None, here: int, cosine: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(id, id, weight of the other) for linked pairs that meet here first; right None: within left."""
    both = left if right is None else pd.concat([left, right], ignore_index=True)
    x = unit([np.frombuffer(v, "<f8") for v in both["vector"]])
    label = both["label"].to_numpy()
    lists = [np.frombuffer(v, "<i8") for v in both["leaves"]]
    leaves = np.full((len(both), max(map(len, lists))), -1, np.int64)
    for k, one in enumerate(lists):
        leaves[k, :len(one)] = one
    n, columns = len(left), np.arange(len(both)) if right is None else np.arange(len(left), len(both))
    for low in range(0, n, 256):
        rows = np.arange(low, min(low + 256, n))
        near = (x[rows] @ x[columns].T >= cosine) & (label[rows][:, None] == label[columns][None])
        a, b = np.nonzero(near)
        a, b = rows[a], columns[b]
        a, b = a[a < b], b[a < b]
        if len(a):
            kept = _first_meeting(leaves, a, b, here)
            yield a[kept], b[kept]


def leaf_links(cosine: float):
    """For applyInPandas over one block pair of a leaf: partners per class (rep, partners) and links that span them (a, b)."""
    def run(group: pd.DataFrame) -> pd.DataFrame:
        here = int(group["leaf"].iloc[0])
        low, high = int(group["low"].iloc[0]), int(group["high"].iloc[0])
        if low == high:
            both, pairs = group.reset_index(drop=True), None
            pairs = _compare(both, None, here, cosine)
        else:
            left, right = group[group["block"] == low], group[group["block"] == high]
            both = pd.concat([left, right], ignore_index=True)
            pairs = _compare(left.reset_index(drop=True), right.reset_index(drop=True), here, cosine) if len(left) and len(right) else iter(())
        rep, size = both["rep"].to_numpy(), both["size"].to_numpy()
        partners, root = np.zeros(len(both), np.int64), np.arange(len(both))
        for a, b in pairs:
            np.add.at(partners, a, size[b])
            np.add.at(partners, b, size[a])
            while True:
                least = np.minimum(root[a], root[b])
                if (root[a] == least).all() and (root[b] == least).all():
                    break
                np.minimum.at(root, root[a], least)
                np.minimum.at(root, root[b], least)
                while (root[root] != root).any():
                    root = root[root]
        linked = partners > 0
        return pd.DataFrame({"rep": rep[linked], "partners": partners[linked], "to": rep[root[linked]]})
    return run


def near_vectors(
    embeddings: DataFrame, cosine: float = COSINE, trees: int = TREES, leaf: int = LEAF, block: int = BLOCK, sample: int = SAMPLE,
) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row.

    Vectors that are null, empty, zero or hold null or non-finite components, and rows without a label, link with
    nothing and are their own component.  Vectors of different length never link.  Equal vectors of one label are
    compared once and always linked; repeated rows count as vectors of their own; a null vec_id has a null component
    unless it is linked to one that is not null; an empty table gives no rows; other columns are ignored.
    """
    spark = embeddings.sparkSession
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), F.col("label").cast("long").alias("label"))
    good = usable(F.col("embedding"), F.col("label"))
    # -0.0 and 0.0 are one value; equal vectors are told by two 64-bit hashes, the vector itself stays in its row
    plain = F.transform("embedding", lambda v: v + F.lit(0.0))
    hashed = rows.withColumn("good", good).withColumn("embedding", F.when(F.col("good"), plain)).withColumns({
        "h1": F.when(F.col("good"), F.xxhash64("label", "embedding")), "h2": F.when(F.col("good"), F.xxhash64("embedding", "label", F.lit(SEED)))})
    members = staged(hashed.select("vec_id", "good", "h1", "h2"), "vectors")
    grouped = hashed.where("good").groupBy("h1", "h2").agg(
        F.min("vec_id").alias("least"), F.count("*").alias("size"), F.first("embedding").alias("embedding"), F.first("label").alias("label"))
    classes = staged(grouped.withColumn("rep", F.monotonically_increasing_id()), "vector-classes")

    total = classes.count()
    drawn = sampled(classes, sample, "h1", "h2").select("embedding").toPandas()["embedding"]
    by_size: dict[int, list] = {}
    for v in drawn:
        by_size.setdefault(len(v), []).append(np.asarray(v))
    fitted = {n: fit(unit(v), total * len(v) // max(len(drawn), 1), trees, leaf, cosine) for n, v in by_size.items()}

    def deal(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for n, part in frame.groupby(frame["embedding"].map(len)):
                forest = fitted.get(n) or Trees(0, np.zeros((1, 0)), np.zeros((1, 0)))
                x = unit(list(part["embedding"]))
                row, place = forest.leaves(x)
                order = np.lexsort((place, row))
                row, place = row[order], place[order]
                cut = np.searchsorted(row, np.arange(len(part) + 1))
                lists = [place[a:b].astype("<i8").tobytes() for a, b in zip(cut, cut[1:], strict=False)]
                raw = [v.astype("<f8").tobytes() for v in x]
                rep, size, label = part["rep"].to_numpy(), part["size"].to_numpy(), part["label"].to_numpy()
                yield pd.DataFrame({"dim": np.int32(n), "leaf": place, "rep": rep[row], "size": size[row], "label": label[row],
                                    "vector": [raw[k] for k in row], "leaves": [lists[k] for k in row]})

    dealt = classes.select("rep", "size", "label", "embedding").mapInPandas(deal, "dim int, leaf long, rep long, size long, label long, vector binary, leaves binary")
    dealt = staged(dealt, "leaves")
    # leaves larger than a block: every pair of their blocks is a group of its own
    blocks = dealt.groupBy("dim", "leaf").agg(F.ceil(F.count("*") / block).alias("blocks"))
    spread = dealt.join(blocks, ["dim", "leaf"]).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")))
    pairs = F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), lambda b: F.struct(F.least(b, F.col("block")).alias("low"), F.greatest(b, F.col("block")).alias("high")))
    groups = spread.withColumn("pair", F.explode(pairs)).select("dim", "leaf", "rep", "size", "label", "vector", "leaves", "block", "pair.low", "pair.high")
    links = staged(groups.groupBy("dim", "leaf", "low", "high").applyInPandas(leaf_links(cosine), "rep long, partners long, to long"), "vector-links")

    counts = links.groupBy("rep").agg(F.sum("partners").alias("partners"))
    roots = connected(links.select(F.col("rep").alias("a"), F.col("to").alias("b")))
    placed = classes.select("rep", "h1", "h2", "least", "size").join(counts, "rep", "left").join(roots, F.col("rep") == F.col("node"), "left")
    placed = placed.withColumn("root", F.coalesce("root", "rep"))
    smallest = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    placed = placed.join(smallest, "root").select(
        "h1", "h2", "component_id", (F.coalesce("partners", F.lit(0)) + F.col("size") - 1).alias("n_links"))
    linked = members.where("good").join(placed, ["h1", "h2"]).select("vec_id", "n_links", "component_id")
    alone = members.where("NOT good").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
