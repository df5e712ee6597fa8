"""Importance resampling towards a target distribution.

Words come, with their offsets, from an untrained regex split of the tokenizers library over the text in ASCII lower
case.  The offsets of one word, and of each pair of neighbouring words, give the features; a feature's bucket is the CRC
of its bytes.  One pass over the texts leaves the buckets of every document as a narrow column; the histograms of
the corpus and of the target, the gains of the buckets and the documents' weights are all made from that column.  Gumbel
noise from a hash of the id turns the weights into a draw without replacement: the highest scores win.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitegauge.llm.common import staged, whole_text

BUCKETS, LEAST_WORDS, PERCENT, SEED = 10_000, 20, 25, 7
#: What separates words; all characters beyond ASCII belong to words.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Bytes of a text that are split at once; a longer text is cut between words.  Bytes of buckets in a batch of rows.
PART, BATCH = 16_000, 16_000_000
_GAP_BYTE = re.compile(GAP[:-1].encode())


class Features:
    """The buckets of texts."""

    def __init__(self, buckets: int):
        from tokenizers import PreTokenizedString, Regex, pre_tokenizers

        self.string = PreTokenizedString
        self.split = pre_tokenizers.Split(Regex(GAP.replace("[", "[^", 1)), "removed", invert=True)
        self.buckets = buckets

    def words(self, raw: bytes) -> Iterator[list[bytes]]:
        """The words of a lower-case text by the byte offsets of the split, part by part: a part ends where no word goes on."""
        at = 0
        while at < len(raw):
            gap = _GAP_BYTE.search(raw, at + PART)  # ASCII: no character is cut
            part = raw[at:gap.start() if gap else len(raw)]
            at += len(part)
            found = self.string(part.decode("utf-8"))
            self.split.pre_tokenize(found)
            yield [part[a:b] for _, (a, b), _ in found.get_splits(offset_referential="original", offset_type="byte")]

    def of(self, text: str) -> np.ndarray:
        """One bucket per word and one per pair of neighbours; repeats stay.  A long text is held part by part."""
        raw = text.encode("utf-8").lower()  # lower() of bytes changes A to Z only
        found, last = [np.zeros(0, "<u2")], []
        for words in self.words(raw):
            ones = list(map(zlib.crc32, words))
            # the CRC of a pair goes on from that of its first word, the last one of the part before included
            before = [*last, *ones[:-1]]
            pairs = map(zlib.crc32, words[len(words) - len(before):], map(zlib.crc32, repeat(b" "), before))
            found.append((np.array([*ones, *pairs], np.int64) % self.buckets).astype("<u2"))
            last = ones[-1:] or last
        return np.concatenate(found)


def featured(rows: DataFrame, text: str, *more: str, buckets: int = BUCKETS) -> DataFrame:
    """The columns `more`, n_words and the features' buckets (16-bit integers in a binary column)."""
    if not 0 < buckets <= 1 << 16:
        raise ValueError("buckets: from 1 to 65,536")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(buckets)
        for batch in batches:
            start, size, found = 0, 0, []
            for k, t in enumerate(batch.column(0)):
                found.append(features.of(t.as_py()).tobytes())
                size += len(found[-1])
                if size > BATCH or k == batch.num_rows - 1:
                    part = batch.slice(start, len(found))
                    n_words = pa.array([(len(f) // 2 + 1) // 2 for f in found], pa.int64())
                    yield pa.RecordBatch.from_arrays([*part.columns[1:], n_words, pa.array(found, pa.binary())], names=[*more, "n_words", "buckets"])
                    start, size, found = k + 1, 0, []

    fields = "".join(f"{c} bigint, " for c in more)
    return rows.select(whole_text(text).alias("text"), *more).mapInArrow(run, f"{fields}n_words bigint, buckets binary")


def histogram(found: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features in each bucket over all rows of `found`; each task sends one row per bucket it has seen."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(buckets, np.int64)
        for batch in batches:
            for f in batch.column(0):
                seen += np.bincount(np.frombuffer(f.as_py(), "<u2"), minlength=buckets)
        some = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(seen[some], pa.int64())], names=["bucket", "n"])

    total = np.zeros(buckets, np.int64)
    for row in found.select("buckets").mapInArrow(run, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        total[row["bucket"]] = row["n"]
    return total


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of the smoothed shares, rounded down."""
    n = len(corpus)
    share = ((target + 1.0) * (float(corpus.sum()) + n)) / ((corpus + 1.0) * (float(target.sum()) + n))
    return np.floor(1000.0 * np.log(share)).astype(np.int64)


def weighed(found: DataFrame, gain: np.ndarray, *more: str) -> DataFrame:
    """`more`, n_words and weight: the mean gain of a row's features, rounded down; 0 without features."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            taken = [np.frombuffer(f.as_py(), "<u2") for f in batch.column(batch.num_columns - 1)]
            weight = [int(gain[b].sum()) // len(b) if len(b) else 0 for b in taken]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(weight, pa.int64())], names=[*more, "n_words", "weight"])

    fields = "".join(f"{c} bigint, " for c in more)
    return found.select(*more, "n_words", "buckets").mapInArrow(run, f"{fields}n_words bigint, weight bigint")


def noise(doc_id: Column, seed: int) -> Column:
    """Thousandths of Gumbel noise, rounded down, from the hash of the seed and the id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def drawn(scored: DataFrame, percent: int) -> DataFrame:
    """`scored` (doc_id, score, ...) with `rank` for the best percentage of its rows, by score, then id.

    The rows are sorted over all tasks and written; places come from the row counts of the sorted parts.
    """
    part, place = "__llm_part", "__llm_place"
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features"), F.col("weight")]
    at = F.monotonically_increasing_id()
    rows = staged(scored.orderBy(*order).withColumn("__llm_at", at), "importance-order")
    rows = rows.withColumn(part, F.shiftright("__llm_at", 33)).withColumn(place, F.col("__llm_at").bitwiseAND(F.lit((1 << 33) - 1))).drop("__llm_at")
    # one row per sorted part
    parts = rows.groupBy(part).agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select(part, before.alias("__llm_before"))
    rank = F.col("__llm_before") + F.col(place) + 1
    kept = rows.count() * percent // 100
    return rows.join(parts, part).withColumn("rank", F.when(rank <= kept, rank)).drop(part, place, "__llm_before")


def resample(
    documents: DataFrame, target: DataFrame, buckets: int = BUCKETS, least_words: int = LEAST_WORDS,
    percent: int = PERCENT, seed: int = SEED,
) -> DataFrame:
    """doc_id, n_features, weight, score, rank of every row of `documents`; `rank` numbers the drawn ones from 1.

    `documents`: doc_id, text; `target`: text.  A null text has no words.  Rows without features have weight 0.  Rows
    with fewer than `least_words` words have a score but are never drawn.  A null id is hashed as an empty one
    and loses ties; repeated rows are rows of their own with ranks one after the other; an empty target gives gains against a
    flat distribution; an empty table gives no rows; other columns are ignored.
    """
    found = staged(featured(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "text", "doc_id", buckets=buckets), "importance-buckets")
    wanted = histogram(featured(target.select("text"), "text", buckets=buckets), buckets)
    weights = weighed(found, gains(histogram(found, buckets), wanted), "doc_id")
    scored = staged(weights.select(
        "doc_id", "n_words", F.greatest(2 * F.col("n_words") - 1, F.lit(0)).cast("long").alias("n_features"), "weight",
        (F.col("weight") + noise(F.col("doc_id"), seed)).cast("long").alias("score")), "importance-scores")
    columns = ["doc_id", "n_features", "weight", "score"]
    others = scored.where(F.col("n_words") < least_words).select(*columns, F.lit(None).cast("long").alias("rank"))
    return drawn(scored.where(F.col("n_words") >= least_words).select(*columns), percent).select(*columns, "rank").unionByName(others)


def selected_documents(documents: DataFrame, target: DataFrame, percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """The drawn rows of `documents` with their own columns.

    Rows are found again by id; rows that share an id are kept together if one of them is drawn; rows without an id go.
    """
    own = "__llm_id"
    ids = resample(documents, target, percent=percent, seed=seed).where(F.col("rank").isNotNull() & F.col("doc_id").isNotNull())
    return documents.join(ids.select(F.col("doc_id").alias(own)).distinct(), F.col("doc_id").cast("long") == F.col(own), "left_semi")
