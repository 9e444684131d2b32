"""Removal of repeated passages: windows of words, sent to buckets as super-k-mers and sorted there.

All windows of a text that share a minimiser (the smallest hash among the short runs of words inside the window)
stand together and form a super-k-mer: one packed string holds all of them.  Equal windows have
equal minimisers, so they meet in the bucket of their minimiser.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from greenwave.llm.common import hash_spans, joined_texts, mix, slices, spread, word_spans
from greenwave.session import cut_lineage

WINDOW, SHORT = 20, 5
#: A super-k-mer has at most so many windows; longer ones are cut.
LONGEST = 4096
#: A bucket of more super-k-mers than this, or of more than ``HOT_WINDOWS`` times as many windows, is not sorted in one place.
#: A window held for sorting takes about 260 bytes, so a bucket never takes more than 170 MB; equal packed strings take one entry.
HOT, HOT_WINDOWS = 10_000, 64

_INSIDE = np.ones(256, bool)
_INSIDE[[0x20, *range(0x09, 0x0E)]] = False
_K = np.uint64(0x9E3779B97F4A7C15)


def super_k_mers(texts: list[str | None], window: int = WINDOW, short: int = SHORT) -> tuple[np.ndarray, ...]:
    """Text, minimiser, first word, windows, and whether a short run repeats, for each super-k-mer."""
    data, bounds = joined_texts(texts)
    raw = np.frombuffer(data, np.uint8)
    starts, ends, counts = word_spans(raw, _INSIDE, bounds)
    places = np.maximum(counts - window + 1, 0)
    if not places.any():
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    h = hash_spans(raw, starts, ends)
    n = len(h) - short + 1
    with np.errstate(over="ignore"):
        runs = np.zeros(n, np.uint64)
        for j in range(short):
            runs = mix(runs + h[j:j + n] * _K + np.uint64(j))
    width = window - short + 1  # short runs in a window
    low, have = runs, 1
    while have < width:  # the smallest of ever longer stretches
        step = min(have, width - have)
        low = np.minimum(low[:-step], low[step:])
        have += step
    begin = np.cumsum(counts) - counts
    at = spread(begin, places)
    owner = np.repeat(np.arange(len(counts)), places)
    least = low[at]
    new = np.ones(len(at), bool)
    new[1:] = (least[1:] != least[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, len(at)))
    pieces = -(-size // LONGEST)
    offset = spread(np.zeros(len(pieces), np.int64), pieces) * LONGEST
    size = np.minimum(np.repeat(size, pieces) - offset, LONGEST)
    first = np.repeat(first, pieces) + offset
    inside = size + width - 1
    equal = runs[spread(at[first], inside)] == np.repeat(least[first], inside)
    again = np.add.reduceat(equal, np.cumsum(inside) - inside, dtype=np.int64) > 1
    return owner[first], least[first].view(np.int64), at[first] - begin[owner[first]], size, again


def _code(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """First word and number of windows in one integer."""
    return first * (2 * LONGEST) + size


def references(docs: DataFrame, window: int) -> DataFrame:
    """minimiser, doc, tie, place (first word and windows; negative if a short run repeats) of every super-k-mer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            owner, least, first, size, again = super_k_mers(batch.column("text").to_pylist(), window)
            place = _code(first, size)
            who = pa.array(owner, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(least, pa.int64()), batch.column("__doc").take(who), batch.column("__tie").take(who), pa.array(np.where(again, -place, place), pa.int64())],
                                             ["minimiser", "doc", "tie", "place"])

    return docs.select("__doc", "__tie", "text").mapInArrow(run, "minimiser long, doc long, tie long, place long")


def packed(docs: DataFrame, window: int, single: bool) -> DataFrame:
    """The super-k-mers of ``docs`` named in the column ``__places``, as strings of words; with ``single``, their windows one by one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, max_bytes=1 << 20):
            texts = batch.column("text").to_pylist()
            owner, least, first, size, _ = super_k_mers(texts, window)
            wanted = [set(p) for p in batch.column("__places").to_pylist()]
            words, last = [], -1
            docs_, ties = batch.column("__doc").to_pylist(), batch.column("__tie").to_pylist()
            out: list[list] = [[] for _ in range(6)]
            for k, m, a, n, code in zip(owner.tolist(), least.tolist(), first.tolist(), size.tolist(), _code(first, size).tolist(), strict=True):
                if code not in wanted[k]:
                    continue
                if k != last:
                    words, last = texts[k].encode("utf-8", "surrogatepass").split(), k
                for b, c in ((a + j, 1) for j in range(n)) if single else ((a, n),):
                    for column, value in zip(out, (m, docs_[k], ties[k], b, c, b" ".join(words[b:b + c + window - 1])), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in out[:5]], pa.array(out[5], pa.binary())],
                                             ["minimiser", "doc", "tie", "first", "n", "words"])

    return docs.mapInArrow(run, "minimiser long, doc long, tie long, first long, n long, words binary")


def sorted_bucket(rows: list[tuple], window: int) -> list[tuple[int, int, int, int]]:
    """doc, tie, first word and windows of the stretches of windows of one bucket that start earlier elsewhere.

    ``rows`` come in the order of doc, tie and first word.  A packed string seen before repeats whole; the windows of
    the others are sorted, and of equal neighbours all but the earliest are repeats.
    """
    out, seen, fresh = [], set(), []
    for r, (doc, tie, first, n, words) in enumerate(rows):
        if words in seen:
            out.append((doc, tie, first, n))
        else:
            seen.add(words)
            fresh.append(r)
    if len(fresh) == 1 and rows[fresh[0]][3] == 1:
        return out
    windows = []
    for r in fresh:
        n, words = rows[r][3:]
        cuts = [0]
        for _ in range(n + window - 1):
            cuts.append(words.find(b" ", cuts[-1]) + 1)
        cuts[-1] = len(words) + 1
        windows.extend((words[cuts[j]:cuts[j + window] - 1], r, j) for j in range(n))
    windows.sort()
    again = sorted(x[1:] for x, y in zip(windows[1:], windows, strict=False) if x[0] == y[0])
    for r, j in again:
        doc, tie, first = rows[r][:3]
        if out and out[-1][:2] == (doc, tie) and out[-1][2] + out[-1][3] == first + j:
            out[-1] = (*out[-1][:3], out[-1][3] + 1)
        else:
            out.append((doc, tie, first + j, 1))
    return out


def sort_buckets(rows: DataFrame, window: int) -> DataFrame:
    """The repeated stretches of all buckets; rows are laid out by minimiser and each bucket (bounded by ``HOT``) is held alone."""
    laid = rows.repartition("minimiser").sortWithinPartitions("minimiser", "doc", "tie", "first")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def result(found: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in range(4)], ["doc", "tie", "first", "n"])

        bucket, held, found = None, [], []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("minimiser", "doc", "tie", "first", "n", "words")]
            for m, *row in zip(*columns, strict=True):
                if m != bucket:
                    found += sorted_bucket(held, window) if held else []
                    bucket, held = m, []
                held.append(tuple(row))
            if len(found) > 10_000:
                yield result(found)
                found = []
        found += sorted_bucket(held, window) if held else []
        yield result(found)

    return laid.mapInArrow(run, "doc long, tie long, first long, n long")


def repeats(docs: DataFrame, window: int = WINDOW, hot: int = HOT) -> DataFrame:
    """__doc, __tie, __stretches (first word and words of each stretch to remove), for the documents of ``keyed`` (one row of each) that have any.

    1. Only the minimisers are counted first (numbers, no text).  A minimiser that stands in one
       super-k-mer, and once in that, has no equal windows.
    2. The others travel as packed strings to the bucket of their minimiser and are sorted there.
    3. Buckets of more than ``hot`` super-k-mers (a common line in very many documents) or ``HOT_WINDOWS`` times as many
       windows (one word over and over in long texts) take another way: their windows are grouped by their whole words, the
       earliest place is found by a sum that each task begins on its own, and joined back; Spark splits such joins.
    """
    refs = references(docs, window)
    counts = refs.groupBy("minimiser").agg(F.count(F.lit(1)).alias("n"), F.sum(F.abs("place") % (2 * LONGEST)).alias("windows"))
    is_hot = (F.col("n") > hot) | (F.col("windows") > hot * HOT_WINDOWS)
    live = refs.join(counts, "minimiser").where("n > 1 OR place < 0").select("doc", "tie", F.abs("place").alias("place"), is_hot.alias("hot"))
    live = cut_lineage(live)

    def named(which) -> DataFrame:
        lists = live.where(which).groupBy(F.col("doc").alias("__doc"), F.col("tie").alias("__tie")).agg(F.collect_set("place").alias("__places"))
        return docs.join(lists, ["__doc", "__tie"])  # with all columns, so that Spark lays the texts out once for this and for ``strip``

    parts = [sort_buckets(packed(named(~F.col("hot")), window, False), window)]
    if not live.where("hot").isEmpty():
        each = packed(named(F.col("hot")), window, True)
        place = F.struct("doc", "tie", "first")
        earliest = each.groupBy("words").agg(F.min(place).alias("earliest"), F.count(F.lit(1)).alias("times")).where("times > 1")
        parts.append(each.join(earliest, "words").where(place > F.col("earliest")).select("doc", "tie", "first", "n"))
    found = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    stretch = F.struct("first", (F.col("n") + (window - 1)).alias("n"))
    return found.groupBy(F.col("doc").alias("__doc"), F.col("tie").alias("__tie")).agg(F.collect_set(stretch).alias("__stretches"))


def keyed(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``docs`` with the columns __doc and __tie, which order documents: by doc_id, null first, then by text where an id comes twice;
    and the same with one row of each document, as equal rows must not count as repeats of each other."""
    single = docs.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL").isEmpty()
    tie = F.lit(0).cast("long") if single else F.xxhash64("text")
    own = docs.withColumn("__doc", F.coalesce("doc_id", F.lit(-(1 << 63)))).withColumn("__tie", tie)
    return own, own if single else own.select("__doc", "__tie", "text").dropDuplicates(["__doc", "__tie"])


def _flags(n: int, stretches: list[dict] | None) -> np.ndarray:
    gone = np.zeros(n + 1, np.int64)
    for s in stretches or ():
        gone[s["first"]] += 1
        gone[min(n, s["first"] + s["n"])] -= 1
    return np.cumsum(gone)[:n] > 0


def strip(docs: DataFrame, window: int = WINDOW, hot: int = HOT) -> DataFrame:
    """Every row of ``docs``, with all its columns and __n_words, __n_removed, __kept (its words that stay, joined by one space).

    A word goes if a window of ``window`` words that covers it also starts earlier: in a document with a smaller
    doc_id or earlier in the same one.  Windows are judged on the input.  Null and empty texts have no words;
    texts of fewer words than a window lose none.  Equal rows are one document and get the same result; of
    different texts with the same doc_id the one with the smaller hash comes first; null ids
    come before all others.  An empty table gives no rows.
    """
    own, once = keyed(docs)
    joined = own.join(repeats(once, window, hot), ["__doc", "__tie"], "left").select(*docs.columns, "__stretches")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            total, removed, kept = [], [], []
            for text, stretches in zip(batch.column("text").to_pylist(), batch.column("__stretches").to_pylist(), strict=True):
                words = (text or "").encode("utf-8", "surrogatepass").split()
                flags = _flags(len(words), stretches)
                total.append(len(words))
                removed.append(int(flags.sum()))
                kept.append(b" ".join(words if not removed[-1] else [w for w, f in zip(words, flags.tolist(), strict=True) if not f]).decode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                                             [*names, "__n_words", "__n_removed", "__kept"])

    names = docs.columns
    return joined.mapInArrow(run, f"{kinds}, __n_words long, __n_removed long, __kept string")


def removal(docs: DataFrame, window: int = WINDOW, hot: int = HOT) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every row; see ``strip``."""
    out = strip(docs.select("doc_id", "text"), window, hot)
    return out.select("doc_id", F.col("__n_words").alias("n_words"), F.col("__n_removed").alias("n_removed"), F.sha2("__kept", 256).alias("kept_sha256"))


def without_repeats(docs: DataFrame, window: int = WINDOW, hot: int = HOT) -> DataFrame:
    """The rows of ``docs``; texts that lose words become the words that stay, joined by one space, with n_chars to match."""
    changed = F.col("__n_removed") > 0
    out = strip(docs, window, hot).withColumn("text", F.when(changed, F.col("__kept")).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(changed, F.char_length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


#: The same question in SQL.
SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM w),
g AS (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS g FROM p),
late AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS n FROM g) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM late),
one AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM w),
k AS (SELECT o.doc_id, count(*) FILTER (g.i IS NOT NULL) AS n_removed, coalesce(string_agg(word, ' ' ORDER BY o.i) FILTER (g.i IS NULL), '') AS kept
      FROM one o LEFT JOIN gone g ON g.doc_id = o.doc_id AND g.i = o.i GROUP BY o.doc_id)
SELECT w.doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN k ON k.doc_id = w.doc_id
"""
