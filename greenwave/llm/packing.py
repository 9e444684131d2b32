"""Packing documents into windows by Karmarkar-Karp multiway differencing."""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from greenwave.llm.common import slices
from greenwave.llm.tokens import encoder, with_end

COLUMNS = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def differencing(sizes: list[int], k: int) -> np.ndarray:
    """The window, 0 to k - 1, of each item.

    A partial partition holds the sums of its windows in descending order and the items of each.
    The two partitions with the largest spread (largest less smallest sum) are merged with
    opposing order, the fullest window of one onto the emptiest of the other, until one is left.
    """
    parts = {n: (np.array([s], np.int64), [[n]]) for n, s in enumerate(sizes)}
    heap = [(-s if k > 1 else 0, n) for n, s in enumerate(sizes)]
    heapq.heapify(heap)
    number = len(sizes)
    while len(heap) > 1:
        (sums, items), (less, more) = (parts.pop(heapq.heappop(heap)[1]) for _ in range(2))
        if len(sums) < len(less):
            sums, items, less, more = less, more, sums, items
        empty = k - len(sums)
        sums, items = np.concatenate([sums, np.zeros(empty, np.int64)]), items + [[] for _ in range(empty)]
        sums[k - len(less):] += less[::-1]
        for j, x in enumerate(more):
            items[k - 1 - j] = items[k - 1 - j] + x
        order = np.argsort(-sums, kind="stable")
        order = order[: int((sums > 0).sum()) or 1]
        sums, items = sums[order], [items[j] for j in order]
        parts[number] = (sums, items)
        heapq.heappush(heap, (int(sums[-1]) * (len(sums) == k) - int(sums[0]), number))
        number += 1
    window = np.zeros(len(sizes), np.int64)
    for _, items in parts.values():
        for w, x in enumerate(items):
            window[x] = w
    return window


def windows_of(sizes: list[int], capacity: int) -> np.ndarray:
    """Near-equal windows for items of at most ``capacity``; their number rises while one is too full."""
    sums = np.asarray(sizes, np.int64)
    k = max(1, -(-int(sums.sum()) // capacity))
    while True:
        window = differencing(sizes, k)
        if np.bincount(window, sums, k).max() <= capacity:
            return window
        k += 1


def lengths_of_pieces(n: int, capacity: int) -> list[int]:
    """Full windows first; the rest is cut into a large, a small and a very small piece, which evens windows out."""
    rest = n % capacity
    return [capacity] * (n // capacity) + [x for x in (rest - rest // 8 - rest // 32, rest // 8, rest // 32) if x]


def pack(docs: DataFrame, path: str, end_id: int = 0, capacity: int = 1024, windows: int = 128) -> DataFrame:
    """One row per piece: which ids of which document (``start``, ``length``) stand where (``sequence_id``, ``offset``).

    Every row of ``docs`` is encoded whole and gets ``end_id`` after it; a null or empty text is
    that id alone.  Rows that share a doc_id are packed separately.  Pieces that fill a window
    are windows of their own.  All other pieces are differenced in groups of about ``windows``
    windows, each task over its own rows as they come: no shuffle, no group that grows with
    the data.  An empty table gives no rows.  Other columns of ``docs`` are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        sequence = TaskContext.get().partitionId() << 40
        waiting: list[tuple] = []
        size = 0

        def dealt(last: bool = False):
            nonlocal sequence, waiting, size
            if waiting and (last or size > (windows - 1) * capacity):
                window = windows_of([p[2] for p in waiting], capacity)
                filled = np.zeros(int(window.max()) + 1, np.int64)
                for p, w in zip(waiting, window.tolist(), strict=True):
                    yield (*p, sequence + w, int(filled[w]))
                    filled[w] += p[2]
                sequence += len(filled)
                waiting, size = [], 0

        def as_batch(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows, strict=True)], list(COLUMNS))

        for batch in slices(batches):
            flat, at = with_end(*enc.encode(batch.column("text").to_pylist()), end_id)
            rows: list[tuple] = []
            for doc, a, b in zip(batch.column("doc_id").to_pylist(), at[:-1].tolist(), at[1:].tolist(), strict=True):
                start, n = 0, b - a
                pieces = []
                for length in lengths_of_pieces(n, capacity):
                    pieces.append((doc, start, length, zlib.crc32(flat[a + start:a + start + length].astype("<u4", copy=False)), n))
                    start += length
                for p in pieces[: n // capacity]:
                    rows.append((*p, sequence, 0))
                    sequence += 1
                rest = pieces[n // capacity:]
                if rest and size + n % capacity > windows * capacity:
                    rows.extend(dealt(True))
                waiting.extend(rest)
                size += n % capacity
            if rows:
                yield as_batch(rows)
        if rows := list(dealt(True)):
            yield as_batch(rows)

    return docs.select("doc_id", "text").mapInArrow(run, ", ".join(f"{c} long" for c in COLUMNS))
