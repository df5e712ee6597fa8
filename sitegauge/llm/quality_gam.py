"""A quality score from a generalised additive model with pairwise interactions.

Each feature has a lookup table over bins, learned by boosting shallow trees on one feature after another, round by
round; then the strongest pairs of features get small two-dimensional tables in the same way.  A score is the sum of
the looked-up values, so scoring is binning and adding.  The model is fitted in numpy on a bounded labelled sample.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitegauge.llm.common import fold, labelled_sample, whole_text

#: Labelled documents that the model is fitted on at most.
SAMPLE_ROWS = 12_000
BINS, COARSE, ROUNDS, PAIR_ROUNDS, PAIRS, RATE = 48, 8, 120, 40, 6, 0.1
FEATURES = ("chars", "words", "word_length", "upper", "digits", "symbols", "exclaim", "stops", "spaces", "other", "distinct_words",
            "repeats", "distinct_pairs", "duplicate_lines", "line_length", "top_word", "capitalised", "sentence_length")

# character classes: 0 other, 1 upper, 2 lower, 3 digit, 4 space, 5 symbol, 6 ! and ?, 7 sentence marks
_KIND = np.zeros(256, np.uint8)
for _c in range(256):
    _s = chr(_c)
    _KIND[_c] = (1 if _s.isupper() else 2 if _s.islower() else 3 if _s.isdigit() else 4 if _s.isspace() else
                 5 if _s in "#*$%&|<>" else 6 if _s in "!?" else 7 if _s in ".,;:" else 0)


def features(text: str) -> list[float]:
    """The numbers that the model sees of a whole text; all zero for an empty one."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    kinds = np.bincount(_KIND[np.minimum(codes, 255)], minlength=8)
    words = text.split()
    n, size = len(words) or 1, len(text) or 1
    counts = Counter(words)
    lines = [x for x in text.split("\n") if x.strip()]
    letters = kinds[1] + kinds[2] or 1
    return [
        np.log1p(len(text)), np.log1p(len(words)), (size - kinds[4]) / n, kinds[1] / letters, kinds[3] / size, kinds[5] / size,
        kinds[6] / size, kinds[7] / size, kinds[4] / size, kinds[0] / size, len(counts) / n,
        sum(map(str.__eq__, words, words[1:])) / n, len(set(zip(words, words[1:], strict=False))) / n,
        1 - len(set(lines)) / (len(lines) or 1), len(words) / (len(lines) or 1), max(counts.values(), default=0) / n,
        sum(map(str.istitle, words)) / n, n / (1 + text.count(".")),
    ]


def _tree(g: np.ndarray, h: np.ndarray, leaves: int) -> np.ndarray:
    """Leaf values per bin of a tree with so many leaves, each split where the gain is largest."""
    parts, value = [(0, len(g))], np.zeros(len(g))
    while len(parts) < leaves:
        best = (1e-9, None)
        for a, b in parts:
            if b - a < 2:
                continue
            left_g, left_h = np.cumsum(g[a:b])[:-1], np.cumsum(h[a:b])[:-1]
            all_g, all_h = g[a:b].sum(), h[a:b].sum()
            gain = left_g**2 / (left_h + 1) + (all_g - left_g) ** 2 / (all_h - left_h + 1) - all_g**2 / (all_h + 1)
            gain[(left_h < 2) | (all_h - left_h < 2)] = 0
            if gain.max() > best[0]:
                best = (gain.max(), (a, b, a + 1 + int(gain.argmax())))
        if best[1] is None:
            break
        a, b, m = best[1]
        parts.remove((a, b))
        parts += [(a, m), (m, b)]
    for a, b in parts:
        value[a:b] = g[a:b].sum() / (h[a:b].sum() + 1)
    return value


def _tree_2d(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """Values per cell of a tree that splits on the first feature and each side on the second; and its gain."""
    best, value = 0.0, np.zeros_like(g)
    for m in range(1, g.shape[0]):
        out, gain = np.zeros_like(g), -(g.sum() ** 2) / (h.sum() + 1)
        for side in (slice(0, m), slice(m, None)):
            column_g, column_h = g[side].sum(0), h[side].sum(0)
            out[side] = _tree(column_g, column_h, 2)
            gain += (out[side][0] * column_g).sum()
        if gain > best:
            best, value = gain, out
    return value, best


@dataclass
class Additive:
    """Bin edges and tables: everything a score needs."""

    edges: list[np.ndarray]
    coarse: list[np.ndarray]
    start: float
    tables: np.ndarray
    pairs: list[tuple[int, int]]
    pair_tables: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        for k, edges in enumerate(self.edges):
            total += self.tables[k, np.searchsorted(edges, x[:, k], side="right")]
        for (a, b), cells in zip(self.pairs, self.pair_tables, strict=True):
            total += cells[np.searchsorted(self.coarse[a], x[:, a], side="right"), np.searchsorted(self.coarse[b], x[:, b], side="right")]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray) -> Additive:
    """Cyclic boosting on the logistic loss.  Without two kinds of labels every score is the (smoothed) share of ones."""
    n, k = x.shape
    share = (y.sum() + 1) / (n + 2)
    cut = lambda bins: [np.unique(np.quantile(x[:, j], np.arange(1, bins) / bins)) if n else np.zeros(0) for j in range(k)]
    model = Additive(cut(BINS), cut(COARSE), float(np.log(share / (1 - share))), np.zeros((k, BINS + 1)), [], np.zeros((0, COARSE + 1, COARSE + 1)))
    if n == 0 or y.min() == y.max():
        return model
    bins = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(model.edges)]
    cells = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(model.coarse)]
    total = np.full(n, model.start)

    def slopes():
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for j in range(k):
            r, w = slopes()
            step = RATE * _tree(np.bincount(bins[j], r, BINS + 1), np.bincount(bins[j], w, BINS + 1), 4)
            model.tables[j] += step
            total += step[bins[j]]
    side = COARSE + 1
    flat = lambda a, b, v: np.bincount(cells[a] * side + cells[b], v, side * side).reshape(side, side)
    r, w = slopes()
    gains = {(a, b): _tree_2d(flat(a, b, r), flat(a, b, w))[1] for a in range(k) for b in range(a + 1, k)}
    model.pairs = sorted(gains, key=gains.get, reverse=True)[:PAIRS]
    model.pair_tables = np.zeros((len(model.pairs), side, side))
    for _ in range(PAIR_ROUNDS):
        for j, (a, b) in enumerate(model.pairs):
            r, w = slopes()
            step = RATE * _tree_2d(flat(a, b, r), flat(a, b, w))[0]
            model.pair_tables[j] += step
            total += step[cells[a], cells[b]]
    return model


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [features(t.as_py()) for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.float64()))], names=["label", "x"])


def train(documents: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, modulus: int = 5, out: int = 0) -> Additive:
    """Fitted on at most `rows` labelled documents outside the held-out fold; only their features reach the driver."""
    sample = labelled_sample(documents, labels, "quality", modulus, out, rows)
    found = sample.select("label", "text").mapInArrow(_feature_rows, "label int, x array<double>").collect()
    found.sort(key=lambda r: (r["label"], r["x"]))
    x = np.array([r["x"] for r in found], float).reshape(len(found), len(FEATURES))
    return fit(x, np.array([r["label"] for r in found], float))


def score_quality(documents: DataFrame, model: Additive, threshold: float = 0.3, modulus: int = 5, out: int = 0) -> DataFrame:
    """doc_id, held_out, score, predicted of every row.

    Null and empty texts are scored alike; repeated rows are each returned with the same score; a null doc_id is not
    held out; an empty table gives no rows; columns other than doc_id and text are ignored.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([features(t.as_py()) for t in batch.column(2)], float).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(model.score(x))], names=["doc_id", "held_out", "score"])

    narrow = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), (fold(F.col("doc_id"), modulus) == out).alias("held_out"), whole_text().alias("text"))
    return narrow.mapInArrow(run, "doc_id bigint, held_out boolean, score double").withColumn(
        "predicted", (F.col("score") >= threshold).cast("int"))
