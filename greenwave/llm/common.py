"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from greenwave.session import stored  # noqa: F401  (the operators import it from here)

#: One or more of the six white-space characters that end a word.
GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def small_batches(spark: SparkSession, rows: int = 500) -> Iterator[None]:
    """Jobs that run inside send so many rows at a time to Python; the session's setting comes back afterwards.

    For rows that are large by nature (all tokens of a text), where the usual 10,000 would take much memory at once.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def digest(text: str = "text") -> Column:
    """Equal texts share it; a null text counts as empty."""
    return F.sha2(F.coalesce(F.col(text), F.lit("")), 256)


def words_of(text: Column) -> Column:
    """Words between white space, unchanged; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), GAP), lambda w: w != "")


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", max_bytes: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Batches cut so that the texts of each come to about ``max_bytes`` at most, or are one text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 64)
        at = 0
        while at < batch.num_rows:
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + max_bytes, "right")))
            yield batch.slice(at, to - at)
            at = to


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions start, start + 1, ... of all the runs, one run after another."""
    ends = np.cumsum(lengths)
    return np.arange(int(ends[-1]) if len(ends) else 0, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (splitmix64 finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POWERS: list[np.ndarray] = []
_STEP = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the step and of its inverse modulo 2**64, at least n of each."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, 1 << 16)
        both = []
        for base in (_STEP, pow(_STEP, -1, 1 << 64)):
            out = np.full(size, base, np.uint64)
            out[0] = 1
            both.append(np.multiply.accumulate(out))
        _POWERS[:] = both
    return _POWERS[0], _POWERS[1]


#: A scrambled value for each byte.
_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_STEP))


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans of ``data``; equal spans have equal hashes."""
    up, down = _powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[data] * up[: len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_spans(data: np.ndarray, inside: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words in ``data``, and how many each text has.

    ``inside`` says which of the 256 bytes belong to words; ``bounds`` are the offsets of the
    texts, which must be apart by at least one byte that is outside.
    """
    flag = np.zeros(len(data) + 2, np.int8)
    flag[1:-1] = inside[data]
    edge = np.diff(flag)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    return starts, ends, np.diff(np.searchsorted(starts, bounds))


def joined_texts(texts: list[str | None], gap: bytes = b" ") -> tuple[bytes, np.ndarray]:
    """The texts as UTF-8 with a gap after each, and their offsets with the end."""
    coded = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    sizes = np.fromiter((len(c) + len(gap) for c in coded), np.int64, len(coded))
    return gap.join(coded) + gap, np.concatenate([[0], np.cumsum(sizes)])
