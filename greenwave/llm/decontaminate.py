"""Benchmark passages in documents by Wu-Manber multi-pattern search over words.

The patterns are windows of benchmark words.  For a window length m and blocks of two words, a
shift table says how far the search may move when a block stands at the end of the current
position; shift 0 leads to the bucket of that block, a prefix test, and a direct
comparison of the words.  Many stretches of text are searched at once, step by step.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from greenwave.llm.common import digest, hash_spans, joined_texts, mix, slices, spread, word_spans
from greenwave.session import cut_lineage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Digits, letters and everything beyond ASCII; upper case is lowered first.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

_LOWERED = np.arange(256, dtype=np.uint8)
_LOWERED[0x41:0x5B] += 0x20
_INSIDE = np.zeros(256, bool)
_INSIDE[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_K = np.uint64(0xC2B2AE3D27D4EB4F)
_TABLE = 1 << 20
_STRETCH = 256


def words(text: str = "text") -> Column:
    lowered = F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, LOWER)
    return F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))


def windows(items: DataFrame, size: int = 10, nameless: bool = False) -> DataFrame:
    """item_id, window, m: the distinct windows of ``size`` words of each item; an item of fewer words, but not none, is one window.
    With ``nameless``, items without an id have windows too."""
    w = items.where(F.lit(nameless) | F.col("item_id").isNotNull()).select("item_id", words().alias("w")).where(F.size("w") > 0)
    at = F.sequence(F.lit(1), F.greatest(F.size("w") - (size - 1), F.lit(1)))
    each = w.select("item_id", "w", F.explode(at).alias("i")).select("item_id", F.slice("w", F.col("i"), size).alias("p"))
    return each.select("item_id", F.array_join("p", " ").alias("window"), F.size("p").alias("m")).distinct()


class Patterns:
    """The tables for one block of windows; one set of tables for each window length."""

    def __init__(self, rows: list[tuple[int | None, str]]) -> None:
        by_length: dict[int, list[bytes]] = defaultdict(list)
        self.items: dict[bytes, list[int | None]] = defaultdict(list)
        for item, window in rows:
            coded = window.encode("utf-8", "surrogatepass")
            if coded not in self.items:
                by_length[window.count(" ") + 1].append(coded)
            self.items[coded].append(item)
        self.lengths = {m: self._tables(m, p) for m, p in sorted(by_length.items())}

    @staticmethod
    def _tables(m: int, patterns: list[bytes]) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
        b = min(2, m)
        raw = np.frombuffer(b" ".join(patterns) + b" ", np.uint8)
        starts, ends, _ = word_spans(raw, _INSIDE, np.zeros(1, np.int64))
        h = hash_spans(raw, starts, ends)
        blocks = block_hashes(h, b)
        shift = np.full(_TABLE, m - b + 1, np.int64)
        first = np.arange(len(patterns)) * m
        for q in range(m - b + 1):
            np.minimum.at(shift, slot(blocks[first + q]), m - b - q)
        return b, shift, np.unique(blocks[first + m - b]), np.unique(blocks[first])


def block_hashes(h: np.ndarray, b: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(h * _K) if b == 1 else mix(mix(h[:-1] * _K) + h[1:])


def slot(blocks: np.ndarray) -> np.ndarray:
    return (blocks & np.uint64(_TABLE - 1)).astype(np.int64)


def among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(known, values), len(known) - 1)
    return known[at] == values


def occurrences(texts: list[str | None], patterns: Patterns) -> tuple[np.ndarray, list[tuple[int, int, int, list[int | None]]]]:
    """Words of each text; text, first word, words and items of each occurrence of a window."""
    data, bounds = joined_texts(texts)
    raw = _LOWERED[np.frombuffer(data, np.uint8)]
    starts, ends, counts = word_spans(raw, _INSIDE, bounds)
    lowered, found = raw.tobytes(), []
    if not len(starts):
        return counts, found
    h = hash_spans(raw, starts, ends)
    begin = np.cumsum(counts) - counts
    for m, (b, shift, last, head) in patterns.lengths.items():
        places = np.maximum(counts - m + 1, 0)
        if not places.any():
            continue
        blocks = block_hashes(h, b)
        table = slot(blocks)
        # stretches of at most so many places, all searched side by side
        pieces = -(-places // _STRETCH)
        owner = np.repeat(np.arange(len(counts)), pieces)
        at = begin[owner] + (spread(np.zeros(len(pieces), np.int64), pieces)) * _STRETCH
        stop = np.minimum(at + _STRETCH, begin[owner] + places[owner])
        hits = []
        while len(at):
            step = shift[table[at + m - b]]
            hits.append(at[step == 0])
            at = at + np.maximum(step, 1)
            go = at < stop
            at, stop = at[go], stop[go]
        place = np.concatenate(hits)
        place = place[among(blocks[place + m - b], last)]
        place = place[among(blocks[place], head)]
        for p, k in zip(place.tolist(), (np.searchsorted(begin, place, "right") - 1).tolist(), strict=True):
            window = b" ".join(lowered[x:y] for x, y in zip(starts[p:p + m].tolist(), ends[p:p + m].tolist(), strict=True))
            if window in patterns.items:
                found.append((k, p - int(begin[k]), m, patterns.items[window]))
    return counts, found


def search(docs: DataFrame, rows: list[tuple[int | None, str]]) -> DataFrame:
    """Every row of ``docs`` (all columns) with __n_words, __runs (hit words from ``a`` to before ``b``) and __items."""
    sent = docs.sparkSession.sparkContext.broadcast(rows)
    kept: list[Patterns] = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not kept:
            kept.append(Patterns(sent.value))
        for batch in slices(batches):
            counts, found = occurrences(batch.column("text").to_pylist(), kept[0])
            runs: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            items: list[set[int | None]] = [set() for _ in range(batch.num_rows)]
            for k, place, m, who in sorted(found, key=lambda x: x[:2]):
                if runs[k] and runs[k][-1]["b"] >= place:
                    runs[k][-1]["b"] = max(runs[k][-1]["b"], place + m)
                else:
                    runs[k].append({"a": place, "b": place + m})
                items[k].update(who)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(counts, pa.int64()),
                 pa.array(runs, pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))), pa.array([sorted(x, key=lambda i: (i is None, i)) for x in items], pa.list_(pa.int64()))],
                [*batch.schema.names, "__n_words", "__runs", "__items"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{kinds}, __n_words long, __runs array<struct<a:bigint,b:bigint>>, __items array<bigint>")


def mark(docs: DataFrame, items: DataFrame, size: int = 10, block: int = 100_000, nameless: bool = False) -> DataFrame:
    """Every row of ``docs`` with all its columns and __n_words, __runs, __items.

    The windows go out in blocks of about ``block`` rows (cut by hash), so what is broadcast does not grow with the benchmark.  With
    one block nothing is shuffled; with more, the few documents hit by later blocks are joined by id and text.
    Null and empty texts have no words and are never hit; an empty benchmark hits nothing; repeated items
    count once; items without an id are left out, or with ``nameless`` are one item, whose id is null.
    """
    pairs = cut_lineage(windows(items, size, nameless))
    count = pairs.count()
    blocks = max(1, -(-count // block))
    part = F.pmod(F.xxhash64("item_id", "window"), F.lit(blocks))

    def rows(k: int) -> list[tuple[int | None, str]]:
        return [(r.item_id, r.window) for r in pairs.where(part == k).select("item_id", "window").collect()]

    out = search(docs, rows(0))
    if blocks == 1:
        return out
    slim = docs.select(F.col("doc_id").alias("__doc"), digest().alias("__key"), "text")
    more = None
    for k in range(1, blocks):
        got = cut_lineage(search(slim, rows(k)).where(F.size("__runs") > 0).select("__doc", "__key", F.col("__runs").alias("__r"), F.col("__items").alias("__i")))
        more = got if more is None else more.unionByName(got)
    more = more.groupBy("__doc", "__key").agg(F.flatten(F.collect_set("__r")).alias("__r"), F.flatten(F.collect_set("__i")).alias("__i"))
    none = F.array().cast
    joined = out.withColumn("__k", digest()).join(more, F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("__k") == F.col("__key")), "left")
    return (joined.withColumn("__runs", F.concat("__runs", F.coalesce("__r", none("array<struct<a:bigint,b:bigint>>"))))
            .withColumn("__items", F.array_distinct(F.concat("__items", F.coalesce("__i", none("array<bigint>")))))
            .drop("__doc", "__key", "__k", "__r", "__i"))


def n_hit() -> Column:
    """Words inside any run; runs may overlap."""
    return F.size(F.array_distinct(F.flatten(F.transform("__runs", lambda r: F.sequence(r["a"], r["b"] - 1))))).cast("long")


def contamination(docs: DataFrame, items: DataFrame, size: int = 10, nameless: bool = False) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 (without the null id), contaminated of every row; see ``mark``."""
    marked = mark(docs.select("doc_id", "text"), items.select("item_id", "text"), size, nameless=nameless)
    names = F.array_sort(F.transform("__items", lambda x: x.cast("string")))
    out = marked.select("doc_id", F.col("__n_words").alias("n_words"), n_hit().alias("n_hit"), F.size("__items").cast("long").alias("n_items"),
                        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"))
    return out.withColumn("contaminated", F.col("n_hit") > 0)


def drop_contaminated(docs: DataFrame, items: DataFrame, size: int = 10, nameless: bool = False) -> DataFrame:
    """The rows of ``docs`` without a word inside an occurrence of a benchmark window; all columns unchanged."""
    return mark(docs, items.select("item_id", "text"), size, nameless=nameless).where(F.size("__runs") == 0).drop("__n_words", "__runs", "__items")


#: The same question in SQL.
SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
p AS (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0),
n AS (SELECT DISTINCT item_id, w[i:i + 9] AS g, least(len(w), 10) AS m FROM p),
e AS (SELECT r, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, (SELECT DISTINCT m FROM n)),
f AS (SELECT r, i, e.m, item_id FROM e JOIN n ON n.m = e.m AND n.g = w[i:i + e.m - 1]),
h AS (SELECT r, count(DISTINCT x) AS n_hit FROM (SELECT r, unnest(range(i, i + m)) AS x FROM f) GROUP BY r),
t AS (SELECT r, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS s FROM (SELECT DISTINCT r, item_id::VARCHAR AS s FROM f) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h ON h.r = d.r LEFT JOIN t ON t.r = d.r
"""
