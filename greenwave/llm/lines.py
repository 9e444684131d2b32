"""Removal of frequent lines that can be undone: exact reference counts and sharded cuckoo filters.

The state has two tables.  ``counts`` says of every line how many documents have it: one row for each key, a 128-bit hash.
``filters`` has one row for each shard of the keys: a cuckoo filter of the shard's frequent lines, and
the few other known lines that the filter takes for one of them.  Inserting or deleting documents adds to or takes from the counts;
a line that becomes frequent enters its filter, one that no longer is leaves it, which a Bloom filter could not do.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from greenwave.llm.common import mix, slices
from greenwave.session import cut_lineage

#: A line is frequent if its key has at least so many code points and so many documents have it.
MIN_CHARS, MIN_DOCS = 1, 10
#: Keys in a shard, about; the number of shards is a power of two and grows with the keys.
SHARD_KEYS = 1 << 18
#: Filters of up to so many bytes together are sent to all tasks; beyond, the lines travel to their shards.
SENT = 32 << 20
#: Over how many tasks the lines of one shard spread there, so that a line of very many documents does not land in one.
SALTS = 16
#: Lines that a task counts before it hands the counts on.
HELD = 400_000

SPACE = b" \t\n\x0b\x0c\r"
SLOTS = 4
_K1, _K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_REF = "hi long, lo long"
_FILTER = "shard long, slots binary, not_hi array<long>, not_lo array<long>"


def key_of(line: bytes, min_chars: int = MIN_CHARS) -> bytes | None:
    """The hash of a line without white space at its ends and with A-Z in lower case; none for lines that are too short."""
    key = line.strip(SPACE).lower()  # of bytes, so A-Z only
    if not key or min_chars > 1 and len(key.decode("utf-8", "surrogatepass")) < min_chars:
        return None
    return hashlib.blake2b(key, digest_size=16).digest()


def lines_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split(b"\n")


def numbers(keys: list[bytes]) -> np.ndarray:
    """Keys as rows of two integers."""
    return np.frombuffer(b"".join(keys), "<i8").reshape(-1, 2)


def line_counts(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """hi, lo, n: how many rows of ``docs`` have each line.  Each task sums its own lines first, so a line of all documents is a row a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, int] = {}

        def result() -> pa.RecordBatch:
            k = numbers(list(held))
            return pa.RecordBatch.from_arrays([pa.array(k[:, 0]), pa.array(k[:, 1]), pa.array(list(held.values()), pa.int64())], ["hi", "lo", "n"])

        for batch in batches:
            for text in batch.column("text").to_pylist():
                for key in {key_of(x, min_chars) for x in lines_of(text)}:
                    if key is not None:
                        held[key] = held.get(key, 0) + 1
                if len(held) > HELD:
                    yield result()
                    held.clear()
        if held:
            yield result()

    return docs.select("text").mapInArrow(run, f"{_REF}, n long").groupBy("hi", "lo").agg(F.sum("n").alias("n"))


class Filters:
    """Cuckoo filters side by side: ``slots`` has a row for each bucket, and a filter's buckets start at its ``base``.

    A key has a fingerprint of 16 bits and two buckets; each can be found from the other and the fingerprint.
    """

    def __init__(self, slots: list[np.ndarray]) -> None:
        self.slots = np.concatenate(slots) if slots else np.zeros((0, SLOTS), np.uint16)
        sizes = np.array([len(s) for s in slots], np.int64)
        self.base, self.mask = np.cumsum(sizes) - sizes, np.maximum(sizes - 1, 0).astype(np.uint64)

    @staticmethod
    def fingerprints(keys: np.ndarray) -> np.ndarray:
        return (keys[:, 1].astype(np.uint64) >> np.uint64(48)) % np.uint64(65535) + np.uint64(1)

    @staticmethod
    def other(bucket: np.ndarray, print_: np.ndarray, mask: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return bucket ^ (mix(print_ * _K2) & mask)

    def buckets(self, keys: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Fingerprint and both buckets of the keys in the filters ``which``."""
        p, m = self.fingerprints(keys), self.mask[which]
        with np.errstate(over="ignore"):
            first = mix(keys[:, 1].astype(np.uint64) * _K1) & m
        return p, first, self.other(first, p, m)

    def holds(self, keys: np.ndarray, which: np.ndarray) -> np.ndarray:
        """Whether the filters hold the keys: always true for those put in, and by chance for one in 8,000 others."""
        p, a, b = self.buckets(keys, which)
        rows = [self.base[which] + x.astype(np.int64) for x in (a, b)]
        p = p.astype(np.uint16)[:, None]
        return ((self.slots[rows[0]] == p) | (self.slots[rows[1]] == p)).any(axis=1)


class Cuckoo(Filters):
    """One filter that can change; slots in use stand first in their bucket."""

    def __init__(self, slots: np.ndarray) -> None:
        super().__init__([slots])

    @classmethod
    def of_size(cls, n: int) -> Cuckoo:
        buckets = 1
        while buckets * SLOTS * 0.84 < n:
            buckets *= 2
        return cls(np.zeros((buckets, SLOTS), np.uint16))

    def _all(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self.buckets(keys, np.zeros(len(keys), np.int64))

    def _put(self, bucket: np.ndarray, p: np.ndarray) -> np.ndarray:
        """Put fingerprints where their bucket has room; the places of those left over."""
        order = np.argsort(bucket, kind="stable")
        b = bucket[order].astype(np.int64)
        rank = np.arange(len(b)) - np.searchsorted(b, b)
        slot = (self.slots[b] != 0).sum(axis=1) + rank
        fits = slot < SLOTS
        self.slots[b[fits], slot[fits]] = p[order[fits]]
        return order[~fits]

    def insert(self, keys: np.ndarray) -> bool:
        """Put in all keys; false if there is no room (the filter is then of no use)."""
        p, a, b = self._all(keys)
        left = self._put(a, p)
        left = left[self._put(b[left], p[left])]
        mask, turn = self.mask[0], 0
        for print_, bucket in zip(p[left], b[left], strict=True):
            for _ in range(500):
                turn += 1
                row = self.slots[int(bucket)]
                if not row[-1]:
                    row[np.count_nonzero(row)] = print_
                    break
                out = np.uint64(row[turn % SLOTS])  # push another one out to its other bucket
                row[turn % SLOTS], print_ = print_, out
                bucket = self.other(np.array([bucket]), np.array([print_]), mask)[0]
            else:
                return False
        return True

    def delete(self, keys: np.ndarray) -> None:
        """Take out keys that were put in; a copy of the same fingerprint in the same buckets may go in place of it, which comes to the same."""
        for p, a, b in zip(*self._all(keys), strict=True):
            for bucket in (int(a), int(b)):
                row = self.slots[bucket]
                at = np.flatnonzero(row == np.uint16(p))
                if len(at):
                    row[at[0]:-1], row[-1] = row[at[0] + 1:].copy(), 0
                    break


def grown(keys: np.ndarray) -> Cuckoo:
    """A filter of the keys, as large as it takes."""
    size = len(keys)
    for _ in range(16):
        made = Cuckoo.of_size(size)
        if made.insert(keys):
            return made
        size = max(4, 2 * size)
    raise ValueError("too many lines share a fingerprint and both buckets")


@dataclass(frozen=True)
class Index:
    """The state: two tables in the shared folder, and the parameters they were made with."""

    counts: DataFrame
    filters: DataFrame
    bits: int  # of a key's hash that name its shard
    min_docs: int
    min_chars: int


def _shard(bits: int) -> Column:
    return F.shiftrightunsigned("hi", 64 - bits) if bits else F.lit(0).cast("long")


def _shards(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys[:, 0].astype(np.uint64) >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)


def _update(changed: DataFrame, filters: DataFrame | None, bits: int, min_docs: int) -> DataFrame:
    """The filters after a change; ``changed`` has every key with its documents before (was) and now (n)."""

    def made(rows: pa.Table, old: pa.Table | None) -> pa.Table:
        column = lambda name: rows.column(name).to_numpy()
        keys, was, now = np.stack([column("hi"), column("lo")], axis=1).astype(np.int64), column("was") >= min_docs, column("n") >= min_docs
        cuckoo = None
        if old is not None and old.num_rows:
            cuckoo = Cuckoo(np.frombuffer(old.column("slots")[0].as_py(), "<u2").reshape(-1, SLOTS).copy())
            cuckoo.delete(keys[was & ~now])
            size = cuckoo.slots.size
            if now.sum() > 0.95 * size or now.sum() < 0.2 * size or not cuckoo.insert(keys[now & ~was]):
                cuckoo = None
        if cuckoo is None:
            cuckoo = grown(keys[now])
        others = keys[~now & (column("n") > 0)]
        wrong = others[cuckoo.holds(others, np.zeros(len(others), np.int64))]
        shard = _shards(keys[:1], bits)[0] if len(keys) else old.column("shard")[0].as_py()
        return pa.table({"shard": pa.array([int(shard)], pa.int64()), "slots": pa.array([cuckoo.slots.astype("<u2").tobytes()], pa.binary()),
                         "not_hi": pa.array([wrong[:, 0].tolist()], pa.list_(pa.int64())), "not_lo": pa.array([wrong[:, 1].tolist()], pa.list_(pa.int64()))})

    by_shard = changed.withColumn("shard", _shard(bits)).groupBy("shard")
    if filters is None:
        return by_shard.applyInArrow(lambda rows: made(rows, None), _FILTER)
    return by_shard.cogroup(filters.groupBy("shard")).applyInArrow(made, _FILTER)


def _change(index: Index | None, docs: DataFrame, sign: int, min_docs: int, min_chars: int) -> Index:
    delta = line_counts(docs, min_chars).select("hi", "lo", F.lit(0).cast("long").alias("was"), (F.col("n") * sign).alias("n"))
    if index is not None:
        known = index.counts.select("hi", "lo", F.col("n").alias("was"), "n")
        delta = known.unionByName(delta).groupBy("hi", "lo").agg(F.sum("was").alias("was"), F.sum("n").alias("n"))
    below = F.raise_error(F.lit("documents are deleted that were never inserted")).cast("long")
    changed = cut_lineage(delta.withColumn("n", F.when(F.col("n") < 0, below).otherwise(F.col("n"))))
    bits = max(0, (changed.count() // SHARD_KEYS)).bit_length()
    same = index is not None and index.bits == bits
    filters = cut_lineage(_update(changed, index.filters if same else None, bits, min_docs))
    return Index(changed.where("n > 0").select("hi", "lo", "n"), filters, bits, min_docs, min_chars)


def build(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> Index:
    """The state after inserting ``docs`` into an empty one.  Each row is a document, also where rows share a doc_id."""
    return _change(None, docs, 1, min_docs, min_chars)


def insert(index: Index, docs: DataFrame) -> Index:
    """The state with more documents; only counts of their lines change, and filters where a line became frequent."""
    return _change(index, docs, 1, index.min_docs, index.min_chars)


def delete(index: Index, docs: DataFrame) -> Index:
    """The state as if ``docs`` had never been inserted; fails if some of them were not."""
    return _change(index, docs, -1, index.min_docs, index.min_chars)


def _probe(bits: int, rows: list) -> tuple[np.ndarray, Filters, set[tuple[int, int]]]:
    """Number of the filter for each shard (-1: none), the filters, and the keys they hold wrongly."""
    which = np.full(1 << bits, -1, np.int64)
    for k, r in enumerate(rows):
        which[r["shard"]] = k
    wrong = {pair for r in rows for pair in zip(r["not_hi"], r["not_lo"], strict=True)}
    return which, Filters([np.frombuffer(r["slots"], "<u2").reshape(-1, SLOTS) for r in rows]), wrong


def _frequent(keys: np.ndarray, bits: int, which: np.ndarray, filters: Filters, wrong: set[tuple[int, int]]) -> np.ndarray:
    """Whether the keys are frequent lines: in their filter, and not there by chance."""
    number = which[_shards(keys, bits)]
    out = number >= 0
    out[out] = filters.holds(keys[out], number[out])
    if wrong:
        for k in np.flatnonzero(out).tolist():
            out[k] = (int(keys[k, 0]), int(keys[k, 1])) not in wrong
    return out


def _by_shards(docs: DataFrame, index: Index) -> DataFrame:
    """__key (hash of the text) and __drop, the hashes of its frequent lines, for every text that has any.

    The distinct lines of each text go to one of ``SALTS`` tasks of their shard, where a copy of its filter comes first.
    """
    bits, min_chars = index.bits, index.min_chars

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            owner, found = [], []
            for k, text in enumerate(batch.column("text").to_pylist()):
                mine = {key_of(x, min_chars) for x in lines_of(text)} - {None}
                owner += [k] * len(mine)
                found += mine
            pairs = numbers(found)
            yield pa.RecordBatch.from_arrays([batch.column("__key").take(pa.array(owner, pa.int64())), pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["__key", "hi", "lo"])

    text_key = F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256))
    lines = (docs.select(text_key.alias("__key"), "text").mapInArrow(keys, f"__key binary, {_REF}")
             .withColumns({"shard": _shard(bits), "salt": F.pmod(F.xxhash64("__key"), F.lit(SALTS)).cast("int")}))
    copies = index.filters.withColumn("salt", F.explode(F.array(*[F.lit(k) for k in range(SALTS)])))
    both = copies.unionByName(lines, allowMissingColumns=True).repartition("shard", "salt").sortWithinPartitions("shard", "salt", F.col("slots").isNull())

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        for batch in batches:
            shards = batch.column("shard").to_numpy()
            starts = np.flatnonzero(batch.column("slots").is_valid().to_numpy(zero_copy_only=False))
            edges = np.unique(np.concatenate([[0], starts, starts + 1, [batch.num_rows]]))
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                part = batch.slice(a, b - a)
                if part.column("slots")[0].is_valid:
                    row = {c: part.column(c)[0].as_py() for c in ("slots", "not_hi", "not_lo")} | {"shard": 0}
                    now = (int(shards[a]), Filters([np.frombuffer(row["slots"], "<u2").reshape(-1, SLOTS)]), set(zip(row["not_hi"], row["not_lo"], strict=True)))
                    continue
                mine = np.flatnonzero(shards[a:b] == now[0]) if now else np.zeros(0, np.int64)
                pairs = np.stack([part.column(c).to_numpy() for c in ("hi", "lo")], axis=1)[mine].astype(np.int64)
                if len(mine):
                    hit = pa.array(mine[_frequent(pairs, 0, np.zeros(1, np.int64), now[1], now[2])])
                    yield pa.RecordBatch.from_arrays([part.column(c).take(hit) for c in ("__key", "hi", "lo")], ["__key", "hi", "lo"])

    found = both.select("shard", "salt", "slots", "not_hi", "not_lo", "__key", "hi", "lo").mapInArrow(probe, f"__key binary, {_REF}")
    return found.groupBy("__key").agg(F.collect_set(F.struct("hi", "lo")).alias("__drop"))


def mark(docs: DataFrame, index: Index, sent: int = SENT) -> DataFrame:
    """Every row of ``docs`` with all its columns and __n_lines, __n_dropped and __kept (the lines that stay, joined by line breaks).

    All lines whose key is frequent in ``index`` go, in every document; documents that were not inserted
    are judged by the counts of the others.  Null counts as empty; an empty text is one empty line, and
    lines of white space have no key and always stay.  Equal rows get the same result; an empty table gives no rows.
    Column names that begin with two underscores are reserved.
    """
    for name in docs.columns:
        if name.startswith("__"):
            raise ValueError(f"{name}: names that begin with two underscores are reserved")
    spark: SparkSession = docs.sparkSession
    bits, min_chars = index.bits, index.min_chars
    size = index.filters.agg(F.coalesce(F.sum(F.length("slots") + 16 * F.size("not_hi") + 64), F.lit(0))).first()[0]
    own, handed = docs, None
    if size <= sent:
        handed = spark.sparkContext.broadcast([r.asDict() for r in index.filters.collect()])
    else:
        text_key = F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256))
        own = docs.withColumn("__key", text_key).join(_by_shards(docs, index), "__key", "left").select(*docs.columns, "__drop")
    names = docs.columns
    kept_probe: list = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if handed is not None and not kept_probe:
            kept_probe.append(_probe(bits, handed.value))
        for batch in slices(batches):
            texts = [lines_of(t) for t in batch.column("text").to_pylist()]
            keys = [key_of(x, min_chars) for lines in texts for x in lines]
            if handed is not None:
                have = np.flatnonzero(np.array([k is not None for k in keys], bool))
                gone = np.zeros(len(keys), bool)
                gone[have] = _frequent(numbers([keys[k] for k in have.tolist()]), bits, *kept_probe[0])
                flags = gone.tolist()
            else:
                drop = [{np.array([d["hi"], d["lo"]], "<i8").tobytes() for d in x or ()} for x in batch.column("__drop").to_pylist()]
                at = iter(keys)
                flags = [next(at) in mine for mine, lines in zip(drop, texts, strict=True) for _ in lines]
            at, total, dropped, kept = 0, [], [], []
            for lines in texts:
                mine = flags[at:at + len(lines)]
                at += len(lines)
                total.append(len(lines))
                dropped.append(sum(mine))
                kept.append(b"\n".join(x for x, f in zip(lines, mine, strict=True) if not f).decode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(total, pa.int64()), pa.array(dropped, pa.int64()), pa.array(kept, pa.string())],
                                             [*names, "__n_lines", "__n_dropped", "__kept"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return own.mapInArrow(run, f"{kinds}, __n_lines long, __n_dropped long, __kept string")


def without_lines(docs: DataFrame, index: Index) -> DataFrame:
    """The rows of ``docs`` without their frequent lines, with n_chars to match; see ``mark``."""
    changed = F.col("__n_dropped") > 0
    out = mark(docs, index).withColumn("text", F.when(changed, F.col("__kept")).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(changed, F.char_length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def removal(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, sent: int = SENT) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 of every row, by the lines of ``docs`` itself; see ``mark``."""
    slim = docs.select("doc_id", "text")
    out = mark(slim, build(slim, min_docs, min_chars), sent)
    return out.select("doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_dropped").alias("n_dropped"), F.sha2("__kept", 256).alias("kept_sha256"))


#: The same question in SQL.
SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT r, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS i FROM d),
k AS (SELECT r, i, line, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM l),
f AS (SELECT k FROM k WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT r) >= 10),
m AS (SELECT r, count(f.k) AS n_dropped, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (f.k IS NULL), '') AS kept FROM k LEFT JOIN f ON f.k = k.k GROUP BY r)
SELECT doc_id, len(lines)::BIGINT AS n_lines, n_dropped, sha256(kept) AS kept_sha256 FROM d JOIN m ON m.r = d.r
"""
