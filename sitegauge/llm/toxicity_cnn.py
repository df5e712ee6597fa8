"""A toxicity score from a convolutional text classifier trained in numpy.

Words and their first letters are hashed; hashes seen in enough training texts have an embedding, all others share
the zero one, and a word's embedding is the sum of its own and that of its beginning.  Filters of
several widths run over the words of the whole text, each filter's largest value is kept, and a logistic layer scores
those.  One dimension of the embeddings starts from how much more often the training texts with the word are toxic;
everything is then trained together.  A threshold per language is calibrated on the training sample; the score itself
knows neither language nor source.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitegauge.llm.common import fold, labelled_sample, whole_text

#: Labelled documents that training takes at most, with their whole texts.
SAMPLE_ROWS = 8_000
SEEN_IN, SIZE, WIDTHS, FILTERS, EPOCHS, BATCH, BEGINNING = 5, 8, (1, 2, 3), 8, 5, 128, 5
POSITIONS = 200_000  # words that are scored at once
LEARNED = 100_000  # words of a training batch, unless one text alone has more
REMEMBERED = 400_000
_WORD = re.compile(r"[^\W\d_]+")
_GAP = max(WIDTHS) - 1


def hashes_of(word: str) -> tuple[int, int]:
    """Of the word and of its beginning; a short word has the same twice."""
    raw = word.encode("utf-8", "surrogatepass")
    start = word[:BEGINNING].encode("utf-8", "surrogatepass") + b"~" if len(word) > BEGINNING else raw
    return zlib.crc32(raw), zlib.crc32(start)


def hashed(text: str) -> np.ndarray:
    """words x 2"""
    return np.array([hashes_of(w) for w in _WORD.findall(text.lower())], dtype="<u4").reshape(-1, 2)


class Rows(dict):
    """Word -> its two rows of the embeddings, 0 for hashes without one; bounded."""

    def __init__(self, known: np.ndarray):
        super().__init__()
        self.of_hash = {h: k + 1 for k, h in enumerate(known.tolist())}

    def __missing__(self, word: str) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        a, b = hashes_of(word)
        row = self[word] = self.of_hash.get(a, 0) << 32 | self.of_hash.get(b, 0)
        return row

    def of(self, text: str) -> np.ndarray:
        pairs = np.array([self[w] for w in _WORD.findall(text.lower())], np.int64)
        return np.stack([pairs >> 32, pairs & 0xFFFFFFFF], axis=1)


@dataclass
class Convolution:
    """known: the hashes with an embedding, sorted; embeddings has the zero row first."""

    known: np.ndarray
    embeddings: np.ndarray
    filters: list[np.ndarray]  # width x size x filters
    biases: list[np.ndarray]
    top: np.ndarray
    top_bias: float
    thresholds: dict[str, float]

    def pooled(self, rows: list[np.ndarray]):
        """Largest filter values of each text: texts x all filters; their places; the joined rows; the places behind each text.

        Texts stand one behind the other with gaps between them.  A window that begins in a gap holds no word, so its value
        is the bias, whatever text comes next.
        """
        lengths = np.array([len(r) + _GAP for r in rows])
        flat = np.zeros((lengths.sum() + _GAP, 2), np.int64)
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        gap = np.ones(lengths.sum(), bool)
        for s, r in zip(starts, rows, strict=True):
            flat[s:s + len(r)] = r
            gap[s:s + len(r)] = False
        best, n = [], lengths.sum()
        values = []
        for w, b in zip(self.filters, self.biases, strict=True):
            out = np.broadcast_to(b.astype(np.float32), (n, len(b))).copy()
            for k in range(len(w)):
                through = (self.embeddings @ w[k]).astype(np.float32)
                out += through[flat[k:k + n, 0]]
                out += through[flat[k:k + n, 1]]
            out[gap] = b
            values.append(out)
            best.append(np.maximum.reduceat(out, starts, axis=0))
        return np.maximum(np.concatenate(best, 1), 0), values, flat, starts, lengths, gap

    def logits(self, rows: list[np.ndarray]) -> np.ndarray:
        return self.pooled(rows)[0] @ self.top + self.top_bias

    def score(self, rows: list[np.ndarray]) -> np.ndarray:
        parts, some, size = [np.zeros(0)], [], 0
        for r in rows:
            some.append(r)
            size += len(r)
            if size > POSITIONS:
                parts.append(self.logits(some))
                some, size = [], 0
        if some:
            parts.append(self.logits(some))
        return 1 / (1 + np.exp(-np.clip(np.concatenate(parts), -30, 30)))


def _start(hashes: list[np.ndarray], y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes seen in enough texts, and how far the share of toxic texts among them is from the overall share."""
    each = [np.unique(h) for h in hashes]
    every = np.concatenate([*each, np.zeros(0, np.int64)]).astype(np.int64)
    toxic = np.repeat(y, [len(h) for h in each])
    known, at, seen = np.unique(every, return_inverse=True, return_counts=True)
    positive, share = np.bincount(at, toxic, len(known)), (y.sum() + 1) / (len(y) + 2)
    kept = seen >= SEEN_IN
    z = (positive - seen * share) / np.sqrt(seen * share * (1 - share))
    return known[kept], np.tanh(z[kept] / 10) * 2


def rows_of(known: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Row of the embeddings of each hash, 0 for those without one; `known` is sorted."""
    if not len(known):
        return np.zeros(hashes.shape, np.int64)
    at = np.searchsorted(known, hashes)
    return np.where(known[np.minimum(at, len(known) - 1)] == hashes, at + 1, 0)


def fit(hashes: list[np.ndarray], y: np.ndarray, languages: list[str | None], seed: int = 3) -> Convolution:
    """Without two kinds of labels every score is the smoothed share of ones."""
    rng = np.random.default_rng(seed)
    share = (y.sum() + 1) / (len(y) + 2)
    known, lead = _start(hashes, y)
    embeddings = np.vstack([np.zeros(SIZE), rng.normal(scale=0.05, size=(len(known), SIZE))])
    embeddings[1:, 0] = lead
    m = Convolution(known, embeddings, [rng.normal(scale=0.3, size=(w, SIZE, FILTERS)) for w in WIDTHS],
                    [np.zeros(FILTERS) for _ in WIDTHS], rng.normal(scale=0.2, size=FILTERS * len(WIDTHS)), float(np.log(share / (1 - share))), {})
    for w in m.filters:
        w[:, 0, :FILTERS // 2] = np.abs(w[:, 0, :FILTERS // 2]) + 0.5
    if len(y) == 0 or y.min() == y.max():
        m.top[:] = 0
        return m
    rows = [rows_of(known, h) for h in hashes]
    values = [m.embeddings, *m.filters, *m.biases, m.top]
    first, second, n = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values], 0
    for _ in range(EPOCHS):
        for some in batches(rng.permutation(len(y)), rows):
            n += 1
            grads = _gradients(m, [rows[k] for k in some], y[some])
            m.top_bias -= 0.05 * grads.pop()
            for k, (v, g) in enumerate(zip(values, grads, strict=True)):
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                v -= 0.01 * (first[k] / (1 - 0.9**n)) / (np.sqrt(second[k] / (1 - 0.999**n)) + 1e-8)
            m.embeddings[0] = 0
    score = m.score(rows)
    for lang in sorted({x for x in languages if x is not None}):
        own = np.array([x == lang for x in languages])
        m.thresholds[lang] = calibrated(score[own], y[own])
    return m


def batches(order: np.ndarray, rows: list[np.ndarray]) -> Iterator[np.ndarray]:
    """At most BATCH texts and LEARNED words at once; a longer text is a batch of its own."""
    start, words = 0, 0
    for at, k in enumerate(order):
        if at > start and (at - start == BATCH or words + len(rows[k]) > LEARNED):
            yield order[start:at]
            start, words = at, 0
        words += len(rows[k])
    if len(order):
        yield order[start:]


def _gradients(m: Convolution, rows: list[np.ndarray], y: np.ndarray) -> list:
    pooled, values, flat, starts, lengths, gap = m.pooled(rows)
    d = (1 / (1 + np.exp(-(pooled @ m.top + m.top_bias))) - y) / len(y)
    d_pooled = d[:, None] * m.top * (pooled > 0)
    d_e, d_w, d_b = np.zeros_like(m.embeddings), [np.zeros_like(w) for w in m.filters], []
    place = np.arange(lengths.sum())
    for j, out in enumerate(values):
        part = slice(j * FILTERS, (j + 1) * FILTERS)
        largest = np.repeat(np.maximum.reduceat(out, starts, axis=0), lengths, axis=0)
        at = -np.maximum.reduceat(np.where(out == largest, -place[:, None], -len(out) - 1), starts, axis=0)  # texts x filters
        g = d_pooled[:, part]
        d_b.append(g.sum(0))
        for k in range(len(m.filters[j])):
            for ids in (flat[at + k, 0], flat[at + k, 1]):
                ids = np.where(gap[at], 0, ids)
                d_w[j][k] += np.einsum("nfs,nf->sf", m.embeddings[ids], g)
                np.add.at(d_e, ids, g[:, :, None] * m.filters[j][k].T[None])
    return [d_e, *d_w, *d_b, pooled.T @ d + 1e-4 * m.top, float(d.sum())]


def calibrated(score: np.ndarray, y: np.ndarray, usual: float = 0.3) -> float:
    """The threshold with the best F1 on a language's sample; the usual one where a kind of label is missing."""
    if len(y) == 0 or y.min() == y.max():
        return usual
    order = np.argsort(-score, kind="stable")
    hits = np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(y) + 1) + y.sum())
    f1[:-1][np.diff(score[order]) == 0] = 0
    k = int(f1.argmax())
    below = score[order[k + 1]] if k + 1 < len(y) else 0.0
    return float((score[order[k]] + below) / 2)


def train(documents: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, modulus: int = 4, out: int = 2) -> Convolution:
    """Fitted on the whole texts of at most `rows` labelled documents outside the held-out fold."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([hashed(t.as_py()).tobytes() for t in batch.column(2)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), found], names=["label", "lang", "hashes"])

    sample = labelled_sample(documents, labels, "toxic", modulus, out, rows, F.col("lang").cast("string").alias("lang"))
    found = sample.select("label", "lang", "text").mapInArrow(read, "label int, lang string, hashes binary").collect()
    found.sort(key=lambda r: (r["label"], bytes(r["hashes"]), r["lang"] or ""))
    hashes = [np.frombuffer(r["hashes"], dtype="<u4").astype(np.int64).reshape(-1, 2) for r in found]
    return fit(hashes, np.array([r["label"] for r in found], float), [r["lang"] for r in found])


def score_toxicity(documents: DataFrame, model: Convolution, threshold: float = 0.3, modulus: int = 4, out: int = 2) -> DataFrame:
    """doc_id, held_out, score, predicted, lang_threshold, lang_flagged of every row.

    Null and empty texts are scored alike; repeated rows are each returned with the same score; a null doc_id is not
    held out; a language without calibration takes `threshold`; an empty table gives no rows; other columns are ignored.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = Rows(model.known)
        for batch in batches:
            start, words, rows = 0, 0, []
            for k, t in enumerate(batch.column(2)):
                rows.append(get.of(t.as_py()))
                words += len(rows[-1])
                if words > POSITIONS or k == batch.num_rows - 1:
                    part = batch.slice(start, len(rows))
                    limits = [model.thresholds.get(x, threshold) for x in part.column(3).to_pylist()]
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0), part.column(1), pa.array(model.score(rows), pa.float64()), pa.array(limits, pa.float64())],
                        names=["doc_id", "held_out", "score", "lang_threshold"])
                    start, words, rows = k + 1, 0, []

    narrow = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), (fold(F.col("doc_id"), modulus) == out).alias("held_out"), whole_text().alias("text"),
        F.col("lang").cast("string").alias("lang"))
    return narrow.mapInArrow(run, "doc_id bigint, held_out boolean, score double, lang_threshold double").select(
        "doc_id", "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "lang_threshold",
        (F.col("score") >= F.col("lang_threshold")).alias("lang_flagged"))
