"""Packing of token ids into windows of fixed length by Karmarkar-Karp multiway differencing.

Each Spark task encodes its documents and packs them as they come: no shuffle, and what a task holds is one
group of windows. A document's full windows stand alone. The rest of each document is cut into parts of at
most a quarter window; parts are gathered until they fill a group of `group` windows, but for `slack` ids a
window. Differencing then deals the parts into near-equal windows: it starts with one partial partition for
each part, always merges the two whose window sums differ most, largest sums against smallest, and ends with
one. Where a window exceeds the capacity, the count of windows rises by one and the group is dealt again.
The last, short group of a task is dealt in the same way into the windows that it fills; what then remains becomes
windows whose sizes are powers of two, which need no padding.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD_MODEL, byte_groups, text_bytes, text_or_empty, tokenizer_path, unit_encoder

SCHEMA = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def difference(sizes: np.ndarray, k: int) -> list[list[int]]:
    """Deal items of the given sizes into k windows with near-equal sums."""
    if k == 1:
        return [list(range(len(sizes)))]
    left, right = [], []
    heap = []
    for i, size in enumerate(sizes.tolist()):
        sums, node = np.zeros(k, np.int64), np.full(k, -1, np.int64)
        sums[0], node[0] = size, i
        heap.append((-size, i, sums, node))
    heapq.heapify(heap)
    n = made = len(heap)
    while len(heap) > 1:
        _, _, s, a = heapq.heappop(heap)
        _, _, t, b = heapq.heappop(heap)
        s, b = s + t[::-1], b[::-1]
        both = np.flatnonzero((a >= 0) & (b >= 0))
        node = np.where(a >= 0, a, b)
        if len(both):
            left += a[both].tolist()
            right += b[both].tolist()
            node[both] = n + len(left) - len(both) + np.arange(len(both))
        order = np.argsort(-s, kind="stable")
        s, node = s[order], node[order]
        made += 1
        heapq.heappush(heap, (int(s[-1] - s[0]), made, s, node))
    windows = []
    for root in heap[0][3].tolist():
        items, stack = [], [root] if root >= 0 else []
        while stack:
            x = stack.pop()
            if x < n:
                items.append(x)
            else:
                stack += (left[x - n], right[x - n])
        windows.append(items)
    return windows


def near_equal(sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Windows of at most `capacity`; their count rises until none exceeds it."""
    k = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        windows = difference(sizes, k)
        if all(sizes[w].sum() <= capacity for w in windows):
            return [w for w in windows if w]
        k += 1


class _Packer:
    def __init__(self, capacity: int, group: int, slack: int, task: int):
        self.capacity, self.part = capacity, max(1, capacity // 4)
        self.fill = capacity - slack
        self.full = group * self.fill
        self.next = task << 33
        self.parts: list[tuple] = []
        self.held = 0
        self.rows: list[tuple] = []

    def add(self, doc_id, ids: np.ndarray) -> None:
        n, at = len(ids), 0
        while n - at >= self.capacity:
            self._place([(doc_id, at, ids[at : at + self.capacity], n)])
            at += self.capacity
        while at < n:
            take = min(self.part, n - at, self.full - self.held)
            self.parts.append((doc_id, at, ids[at : at + take], n))
            self.held += take
            at += take
            if self.held == self.full:
                self._deal(self.parts)
                self.parts, self.held = [], 0

    def _deal(self, parts: list[tuple]) -> None:
        sizes = np.fromiter((len(p[2]) for p in parts), np.int64, len(parts))
        for window in near_equal(sizes, self.capacity):
            self._place([parts[i] for i in sorted(window)])

    def _place(self, parts: list[tuple]) -> None:
        offset, last = 0, None
        for doc_id, at, ids, n in parts:
            if last is not None and last[0] == doc_id and last[1] + last[2] == at:
                last[2] += len(ids)  # neighbours of one document in one window stay one piece
                last[6].append(ids)
            else:
                last = [doc_id, at, len(ids), n, self.next, offset, [ids]]
                self.rows.append(last)
            offset += len(ids)
        self.next += 1

    def finish(self) -> None:
        """What is left: as many near-equal windows as it fills, then windows of falling powers of two."""
        whole, tail = [], []
        room = self.held // self.capacity * self.fill
        for doc_id, at, ids, n in self.parts:
            if room:
                whole.append((doc_id, at, ids[:room], n))
            if len(ids) > room:
                tail.append((doc_id, at + room, ids[room:], n))
            room = max(0, room - len(ids))
        if whole:
            self._deal(whole)
        left = sum(len(p[2]) for p in tail)
        window, room = [], 0
        for doc_id, at, ids, n in tail:
            while len(ids):
                room = room or (self.capacity if left >= self.capacity else 1 << (left.bit_length() - 1))
                took = ids[:room]
                window.append((doc_id, at, took, n))
                at, ids, room, left = at + len(took), ids[len(took) :], room - len(took), left - len(took)
                if not room:
                    self._place(window)
                    window = []
        self.parts, self.held = [], 0

    def take(self) -> pa.RecordBatch:
        rows, self.rows = self.rows, []
        columns = list(zip(*rows, strict=True)) if rows else [[] for _ in range(7)]
        ids = [b"".join(x.astype("<u4").tobytes() for x in parts) for parts in columns[6]]
        names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset"]
        return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns[:6]), pa.array(ids, pa.binary())], names=[*names, "ids"])


def pack(
    docs: DataFrame, *, tokenizer: str | None = None, capacity: int = 2048, end_id: int = 1, group: int = 256, slack: int = 12, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Pieces of all documents, dealt into sequences of at most `capacity` ids.

    Returns doc_id, start, length, doc_tokens, sequence_id, offset and ids (unsigned, little-endian, 32 bits).
    A null or empty text is the end id alone; a null id is kept as null; repeated rows are packed as often as
    they occur; other columns are ignored; an empty table gives no rows. `capacity` must be a power of two.
    """
    if capacity < 4 or capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two, 4 at least")
    path = tokenizer or tokenizer_path(WORD_MODEL)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = unit_encoder(path, words=True)
        packer = _Packer(capacity, group, slack, TaskContext.get().partitionId())
        for batch in batches:
            names = batch.column(0).to_pylist()
            data, at = text_bytes(batch.column(1))
            for a, b in byte_groups(np.diff(at), 2 << 20):
                ids, offsets = encoder.encode(data[at[a] : at[b]], at[a : b + 1] - at[a], end_id)
                for i in range(a, b):
                    packer.add(names[i], ids[offsets[i - a] : offsets[i - a + 1]])
                yield packer.take()
        packer.finish()
        yield packer.take()

    return docs.select(F.col(id_column).cast("long").alias("doc_id"), text_or_empty(text_column).alias("text")).mapInArrow(run, SCHEMA)


def digest(pieces: DataFrame) -> DataFrame:
    """Pieces with the CRC-32 of their ids in place of the ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op1_packing(spark, sf_dir: str) -> DataFrame:
    return digest(pack(spark.read.parquet(f"{sf_dir}/documents.parquet")))
