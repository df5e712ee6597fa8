"""Packing documents into fixed-size training sequences by minimum bin slack.

Each task streams over its documents in windows of bounded size.  Whole sequences are cut from the front of long
documents; what remains of each document has a length below the capacity.  Sequences are then filled one by one: the
longest remainder is taken, and a bitset subset-sum over the multiset of remaining lengths finds those that fill the
rest closest.  Where no multiset meets the capacity, one remainder is cut to fill it.  The tail of a task, less than
one sequence, goes into sequences whose lengths are powers of two.  There is no shuffle and no corpus-wide state, so
a lost task is simply run again.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitegauge.llm.common import whole_text
from sitegauge.llm.tokens import word_ids

CAPACITY = 2048
#: Ids that a task holds before it packs them (4 bytes each).
WINDOW_TOKENS = 3_000_000
#: Bytes of text that are encoded at once.
TEXTS_AT_ONCE = 3_000_000
PIECES = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, "
          "offset bigint, sequence_length bigint")


def fill(counts: np.ndarray, room: int) -> list[tuple[int, int]]:
    """(length, how many) of the multiset with the largest sum up to `room`; counts[n] are at hand of length n.

    reached holds the sums as bits of one integer; the integers before each length are kept, and the counts are
    read back from them, as few of the shorter lengths as possible.
    """
    full, reached = 1 << room, 1
    within = (1 << (room + 1)) - 1
    steps: list[tuple[int, int]] = []
    for length in np.flatnonzero(counts[: room + 1])[::-1].tolist():
        steps.append((length, reached))
        left, part = min(int(counts[length]), room // length), 1
        while left > 0:
            take = min(part, left)
            reached |= (reached << (take * length)) & within
            left -= take
            part *= 2
        if reached & full:
            break
    total, chosen = reached.bit_length() - 1, []
    for length, before in reversed(steps):
        used = 0
        while not before >> (total - used * length) & 1:
            used += 1
        if used:
            chosen.append((length, used))
            total -= used * length
    return chosen


class Packer:
    """The open window of one task: remainders by length, and the pieces found so far."""

    def __init__(self, capacity: int, first_sequence: int):
        self.capacity, self.sequence = capacity, first_sequence
        self.counts = np.zeros(capacity, dtype=np.int64)
        self.by_length: list[list[tuple]] = [[] for _ in range(capacity)]
        self.waiting = 0
        self.pieces: list[tuple] = []

    def put(self, doc_id, start: int, ids: np.ndarray, total: int) -> None:
        self.by_length[len(ids)].append((doc_id, start, ids, total))
        self.counts[len(ids)] += 1
        self.waiting += len(ids)

    def take(self, length: int) -> tuple:
        self.counts[length] -= 1
        self.waiting -= length
        return self.by_length[length].pop()

    def close(self, items: list[tuple]) -> None:
        """One sequence of these remainders."""
        offset, size = 0, sum(len(x[2]) for x in items)
        for doc_id, start, ids, total in items:
            self.pieces.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes()), total, self.sequence, offset, size))
            offset += len(ids)
        self.sequence += 1

    def add(self, doc_id, ids: np.ndarray) -> None:
        whole = len(ids) // self.capacity * self.capacity
        for start in range(0, whole, self.capacity):
            self.close([(doc_id, start, ids[start:start + self.capacity], len(ids))])
        if whole < len(ids):
            # a copy: a view would keep the ids of the whole document until its remainder is packed
            self.put(doc_id, whole, ids[whole:].copy() if whole else ids, len(ids))

    def cut(self, items: list[tuple], room: int) -> None:
        """Fill `room` with the front of the longest remainder."""
        doc_id, start, ids, total = self.take(int(np.flatnonzero(self.counts)[-1]))
        items.append((doc_id, start, ids[:room], total))
        if room < len(ids):
            self.put(doc_id, start + room, ids[room:], total)

    def pack(self) -> None:
        """Fill sequences until less than one is left."""
        while self.waiting >= self.capacity:
            items = [self.take(int(np.flatnonzero(self.counts)[-1]))]
            room = self.capacity - len(items[0][2])
            for length, used in fill(self.counts, room):
                items += [self.take(length) for _ in range(used)]
                room -= length * used
            if room:
                self.cut(items, room)
            self.close(items)

    def end(self) -> None:
        self.pack()
        while self.waiting:
            room, items = 1 << (self.waiting.bit_length() - 1), []
            while room:
                longest = int(np.flatnonzero(self.counts)[-1])
                if longest <= room:
                    items.append(self.take(longest))
                    room -= longest
                else:
                    self.cut(items, room)
                    room = 0
            self.close(items)

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.pieces, strict=True)) or [()] * 8
        self.pieces = []
        names = [c.split()[0] for c in PIECES.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, type=pa.int64()) for c in columns], names=names)


def pack_documents(
    documents: DataFrame, tokenizer: str = "word_bpe_49k.json", capacity: int = CAPACITY, end_id: int = 1,
    window_tokens: int = WINDOW_TOKENS,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, sequence_length.

    A null or empty text is the end id alone; a null doc_id stays null; repeated rows are packed each; an empty table
    gives no rows; columns other than doc_id and text are ignored.  Ties in length are broken by arrival.
    Every sequence is full, but for those of power-of-two length at the end of each task.
    """
    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_ids(tokenizer)
        packer = Packer(capacity, TaskContext.get().partitionId() << 33)
        for batch in batches:
            doc_ids, texts = batch.column(0).to_pylist(), batch.column(1)
            size = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
            at = 0
            while at < len(doc_ids):
                # as many texts as hold so many bytes, one at least
                end = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + TEXTS_AT_ONCE)))
                for doc_id, ids in zip(doc_ids[at:end], encoder.batch(texts.slice(at, end - at)), strict=True):
                    packer.add(doc_id, np.append(ids, np.uint32(end_id)).astype("<u4", copy=False))
                at = end
                if packer.waiting >= window_tokens or len(packer.pieces) > 100_000:
                    packer.pack()
                    yield packer.batch()
        packer.end()
        yield packer.batch()

    narrow = documents.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return narrow.mapInArrow(packed, PIECES)
