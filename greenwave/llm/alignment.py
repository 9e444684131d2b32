"""Alignment of two tokenizers' tokens: pointer jumping over byte ranges, and counts of linked id pairs.

The tokens of both sides cover the same bytes.  Every token points to the token of the other side that overlaps it
and reaches farthest to the right.  Following the pointers ends at the last token of a stretch that both sides
cut alike; doubling the pointers (each takes over its target's pointer) gets there in a logarithmic
number of steps, for the tokens of many texts at once, and that last token names the group.
"""

from __future__ import annotations

import gc
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from greenwave.llm.common import slices, small_batches, spread, stored
from greenwave.llm.tokens import _FIRST, BYTE_LETTERS, Encoder
from greenwave.session import cut_lineage

#: An id pair is common if at least one in so many (document, pair) links is its; there are no more than ``COMMON`` such pairs, whatever the corpus.
COMMON = 1 << 20
#: Links that a task sums before it hands the counts on.
HELD = 1 << 20
#: Groups of more links than this are summed by distinct ids before their pairs are made.
LARGE = 64

_PACKED = "row long, doc_id long, id_bytes int, a_ids binary, b_ids binary, a_last binary, b_last binary"
_ALIGNED = "row long, doc_id long, a_ids array<int>, b_ids array<int>, a_sizes array<int>, b_sizes array<int>"


class Sides(Encoder):
    """Both tokenizers, with one bounded memory of chunks, and the bytes of each of their tokens.

    Side A is byte-level.  Side B has pieces with byte fallback; none of its pieces goes on behind a space or holds a line break, so
    the chunks of A can be encoded on their own by B too.
    """

    def __init__(self, path_a: str, path_b: str, most: int = 250_000) -> None:
        import sentencepiece

        super().__init__(path_a, most)
        self.tokenizer.encode_special_tokens = True  # special strings in a text are plain text
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=path_b)
        back = {c: k for k, c in enumerate(BYTE_LETTERS)}
        words = {i: w for w, i in self.tokenizer.get_vocab(with_added_tokens=True).items()}
        self.bytes_a = [bytes(back.get(c, 0) for c in words.get(k, "")) for k in range(max(words) + 1)]
        names = [self.pieces.id_to_piece(k) for k in range(self.pieces.get_piece_size())]
        if any("▁" in p.lstrip("▁") or "\n" in p for p in names):
            raise ValueError("a piece goes on behind a space or a line break")
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.pieces.is_byte(k) else p.replace("▁", " ").encode() for k, p in enumerate(names)]
        self.len_a, self.len_b = (np.array([len(x) for x in side], np.int64) for side in (self.bytes_a, self.bytes_b))
        self.space = self.pieces.piece_to_id("▁")
        self.start_b, self.length_b = np.zeros_like(self.start), np.zeros_like(self.length)  # -1: the text must be encoded whole
        self.ids_b, self.used_b = np.zeros(1 << 18, np.uint32), 0

    def _learn(self) -> None:
        known = len(self.numbers) - len(self.numbers.new)
        super()._learn()
        new = list(islice(self.numbers, known, None))
        if len(self.start_b) < len(self.start):
            more = np.zeros(len(self.start) - len(self.start_b), np.int64)
            self.start_b, self.length_b = np.concatenate([self.start_b, more]), np.concatenate([self.length_b, more])
        # a line break before a chunk without a space stands in for the space that B would add
        got = self.pieces.encode(["\n" + c[1:] if c[:1] == _FIRST else c for c in new], num_threads=1)
        sizes, flat, spell = [], [], self.bytes_b.__getitem__
        for c, ids in zip(new, got, strict=True):
            ids, want = (ids[2:], c[1:]) if c[:1] == _FIRST else (ids[1:], c) if c == "\n" else (ids or [self.space], " " + c)
            right = b"".join(map(spell, ids)) == want.encode("utf-8", "surrogatepass")
            sizes.append(len(ids) if right else -1)
            flat += ids if right else []
        while len(self.ids_b) < self.used_b + len(flat):
            self.ids_b = np.concatenate([self.ids_b, np.zeros_like(self.ids_b)])
        self.ids_b[self.used_b:self.used_b + len(flat)] = flat
        size = np.array(sizes, np.int64)
        self.length_b[known:known + len(new)] = size
        real = np.maximum(size, 0)
        self.start_b[known:known + len(new)] = self.used_b + np.cumsum(real) - real
        self.used_b += len(flat)

    def _trim(self) -> None:
        n = len(self.numbers)
        if n <= self.most:
            return
        kept = np.argsort(-self.uses[:n], kind="stable")[: self.most // 2]  # as in the memory of A
        super()._trim()
        size = np.maximum(self.length_b[kept], 0)
        ids = self.ids_b[spread(self.start_b[kept], size)]
        self.start_b[:len(kept)], self.length_b[:len(kept)] = np.cumsum(size) - size, self.length_b[kept]
        self.ids_b[:len(ids)], self.used_b = ids, len(ids)

    def both(self, texts: list[str | None]) -> tuple[np.ndarray, ...]:
        """The ids of all texts one after another and how many each text has, for A and then for B.

        Texts that are null or empty, or whose tokens do not spell a space and the text, have no tokens.
        """
        self._trim()
        chunks: list[int] = []
        counts, slow = np.zeros(len(texts), np.int64), []
        number = self.numbers.__getitem__
        for k, t in enumerate(texts):
            if not t:
                continue
            if t[0] == " " or "  " in t or "\n\n" in t or " \n" in t or "\n " in t or t[0] == "\n" or _FIRST in t or "<|" in t:
                slow.append(k)
                continue
            before = len(chunks)
            chunks.extend(map(number, t.replace("\n", " \n " + _FIRST).split(" ")))
            counts[k] = len(chunks) - before
        if self.numbers.new:
            self._learn()
        which = np.array(chunks, np.int64)
        self.uses += np.bincount(which, minlength=len(self.uses))
        odd = np.flatnonzero((self.length[which] < 0) | (self.length_b[which] < 0))
        if len(odd):
            ends = np.cumsum(counts)
            again = np.unique(np.searchsorted(ends, odd, "right"))
            slow += again.tolist()
            keep = np.ones(len(texts), bool)
            keep[again] = False
            which, counts = which[np.repeat(keep, counts)], counts * keep
        ends = np.concatenate([[0], np.cumsum(counts)])
        out = []
        for ids, start, length in ((self.ids, self.start, self.length), (self.ids_b, self.start_b, self.length_b)):
            size = length[which]
            out.append([ids[spread(start[which], size)].astype(np.int64), np.diff(np.concatenate([[0], np.cumsum(size)])[ends])])
        if slow:
            whole = {k: self._whole(texts[k]) for k in slow}
            for s, side in enumerate(out):
                at = np.concatenate([[0], np.cumsum(side[1])])
                side[0] = np.concatenate([whole[k][s] if k in whole else side[0][at[k]:at[k + 1]] for k in range(len(texts))])
                side[1] = np.array([len(whole[k][s]) if k in whole else n for k, n in enumerate(side[1].tolist())], np.int64)
        return *out[0], *out[1]

    def _whole(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """The ids of one text by both libraries; none if one of them does not spell it."""
        none = np.zeros(0, np.int64)
        try:
            want = b" " + text.encode()
        except UnicodeEncodeError:  # half a surrogate pair
            return none, none
        a, b = self.whole([" " + text])[0].astype(np.int64), np.array(self.pieces.encode(text), np.int64)
        spelled_alike = all(b"".join(map(side.__getitem__, ids.tolist())) == want for side, ids in ((self.bytes_a, a), (self.bytes_b, b)))
        return (a, b) if spelled_alike else (none, none)


def terminals(end_a: np.ndarray, end_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every token of A and of B the number of the A token that ends its group.

    The arguments are the byte offsets where the tokens end, in one sequence of bytes that both sides cover from 0.
    """
    n = len(end_a)
    # the token of the other side that holds a token's last byte reaches farthest among those it overlaps
    holds = lambda ends: np.repeat(np.arange(len(ends), dtype=np.int32), np.diff(ends, prepend=0))
    to_b, to_a = holds(end_b)[end_a - 1], holds(end_a)[end_b - 1]
    ends = end_b[to_b] == end_a  # both sides end here: the A token is the last of its group
    point = np.concatenate([np.where(ends, np.arange(n), n + to_b), to_a])
    while True:
        far = point[point]
        if np.array_equal(far, point):
            return point[:n], point[n:]
        point = far


def last_of_group(len_a: np.ndarray, len_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each token of A and of B is the last of its side in its group, from the bytes of each token; texts end at common offsets."""
    if not len(len_a):
        return np.zeros(0, bool), np.zeros(0, bool)
    end_a, end_b = np.cumsum(len_a), np.cumsum(len_b)
    groups = terminals(end_a, end_b)
    return tuple(np.append(g[1:] != g[:-1], True) for g in groups)


def align_packed(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """What ``align`` gives, in the small form that is stored: ids as unsigned integers of ``id_bytes`` bytes, and for every
    token a bit that says whether it is the last of its side in its group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = _sides(path_a, path_b)
        size = 2 if max(len(sides.bytes_a), len(sides.bytes_b)) <= 1 << 16 else 4
        for batch in slices(batches, max_bytes=1 << 19):
            ids_a, n_a, ids_b, n_b = sides.both(batch.column("text").to_pylist())
            last = last_of_group(sides.len_a[ids_a], sides.len_b[ids_b])
            ids = [_binary(x.astype(f"<u{size}"), n) for x, n in ((ids_a, n_a), (ids_b, n_b))]
            bits = [pa.array([np.packbits(x).tobytes() for x in np.split(flag, np.cumsum(n)[:-1])], pa.binary()) for flag, n in zip(last, (n_a, n_b), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("doc_id"), pa.array([size] * len(n_a), pa.int32()), *ids, *bits],
                                             ["row", "doc_id", "id_bytes", "a_ids", "b_ids", "a_last", "b_last"])

    return docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text").mapInArrow(run, _PACKED)


def align(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """row, doc_id, a_ids, b_ids, a_sizes, b_sizes of every row: the ids of both sides, and how many of each every group has, in order.

    A encodes a space and the text, B (which adds the space itself) the text; both cover the same bytes.  Null and empty texts, and texts that
    a side does not spell back to the byte, have empty arrays.  Rows that share a doc_id stay apart; ``row`` numbers
    the rows and is fixed once the result is stored.  An empty table gives no rows.  Other columns of ``docs`` are not read.
    """
    return unpacked(align_packed(docs, path_a, path_b))


def unpacked(packed: DataFrame) -> DataFrame:
    """The arrays of ``align`` from the stored form."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _small(batches):
            t = Tokens.of(batch)
            lists = [_lists(x, n) for x, n in ((t.a, t.n_a), (t.b, t.n_b), (t.size_a, t.n_groups), (t.size_b, t.n_groups))]
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("doc_id"), *lists], ["row", "doc_id", "a_ids", "b_ids", "a_sizes", "b_sizes"])

    return packed.mapInArrow(run, _ALIGNED)


@dataclass(frozen=True)
class Tokens:
    """The tokens of a batch of rows: ids one row after another, tokens and groups of each row, tokens of each group."""

    a: np.ndarray
    b: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    size_a: np.ndarray
    size_b: np.ndarray
    n_groups: np.ndarray

    @classmethod
    def of(cls, batch: pa.RecordBatch) -> Tokens:
        kind = f"<u{batch.column('id_bytes')[0].as_py()}" if batch.num_rows else "<u2"
        ids = [np.frombuffer(b"".join(batch.column(c).to_pylist()), kind).astype(np.int64) for c in ("a_ids", "b_ids")]
        n = [pc.binary_length(batch.column(c)).to_numpy().astype(np.int64) // int(kind[2]) for c in ("a_ids", "b_ids")]
        sizes = []
        for c, many in zip(("a_last", "b_last"), n, strict=True):
            packed = np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8)
            padded = (many + 7) // 8 * 8  # the bits of each row begin with a new byte
            at = spread(np.cumsum(padded) - padded, many)
            last = np.flatnonzero(np.unpackbits(packed)[at]) if len(packed) else np.zeros(0, np.int64)
            sizes.append((np.diff(last, prepend=-1), np.diff(np.searchsorted(last, np.concatenate([[0], np.cumsum(many)])))))
        return cls(*ids, *n, sizes[0][0], sizes[1][0], sizes[0][1])


_SIDES: dict[tuple[str, str], Sides] = {}


def _sides(path_a: str, path_b: str) -> Sides:
    """The worker's tokenizers; they live on from task to task."""
    if (path_a, path_b) not in _SIDES:
        _SIDES[path_a, path_b] = Sides(path_a, path_b)
    return _SIDES[path_a, path_b]


def _forget() -> None:
    """Free the worker's tokenizers, which later steps do not need."""
    if _SIDES:
        _SIDES.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()


def _binary(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    at = (np.concatenate([[0], np.cumsum(sizes)]) * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(at), pa.py_buffer(values.tobytes())])


def _lists(flat: np.ndarray, sizes: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(flat, pa.int32()))


def _summed(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(times[order], first) if len(first) else times[:0]


def links(t: Tokens, large: int = LARGE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row in the batch, id pair (A id times 2^32 plus B id) and number of links, one for each different pair of each row."""
    a, b, size_a, size_b, n_groups = t.a, t.b, t.size_a, t.size_b, t.n_groups
    times_a, times_b = np.ones(len(a), np.int64), np.ones(len(b), np.int64)
    is_large = size_a * size_b > large
    if is_large.any():  # in large groups equal ids count as one with a weight, so that long runs of one character stay small
        (a, times_a, size_a), (b, times_b, size_b) = (_merged(*x, is_large) for x in ((a, size_a), (b, size_b)))
    owner = np.repeat(np.arange(len(n_groups)), n_groups)
    made = size_a * size_b
    inside = spread(np.zeros(len(made), np.int64), made)
    start_a, start_b = np.cumsum(size_a) - size_a, np.cumsum(size_b) - size_b
    wide = np.repeat(np.maximum(size_b, 1), made)
    at_a, at_b = np.repeat(start_a, made) + inside // wide, np.repeat(start_b, made) + inside % wide
    row = np.repeat(owner, made)
    # a batch has fewer than 2^20 rows, ids are below 2^22
    keys, times = _summed(row << 44 | a[at_a] << 22 | b[at_b], times_a[at_a] * times_b[at_b])
    return keys >> 44, (keys >> 22 & 0x3FFFFF) << 32 | keys & 0x3FFFFF, times


def _merged(ids: np.ndarray, sizes: np.ndarray, large: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, how often each occurs, and ids of each group, with equal ids of the large groups taken together."""
    group = np.repeat(np.arange(len(sizes)), sizes)
    alone = np.where(large[group], 0, np.arange(len(ids)))  # ids of the other groups stay apart, in any order
    order = np.lexsort((alone, ids, group))
    g, i, s = group[order], ids[order], alone[order]
    first = np.flatnonzero(np.concatenate([[True], (g[1:] != g[:-1]) | (i[1:] != i[:-1]) | (s[1:] != s[:-1])]))
    return i[first], np.diff(np.append(first, len(ids))), np.bincount(g[first], minlength=len(sizes))


def pair_counts(aligned: DataFrame) -> DataFrame:
    """pair, n: in how many rows each id pair is linked.  Each task sums its own links first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _forget()
        held: list[tuple[np.ndarray, np.ndarray]] = []
        seen = 0
        for batch in _small(batches):
            pairs = links(Tokens.of(batch))[1]
            held.append(_summed(pairs, np.ones(len(pairs), np.int64)))
            seen += len(held[-1][0])
            if seen > HELD:
                held = [_summed(*(np.concatenate(x) for x in zip(*held, strict=True)))]
                seen = len(held[0][0])
                if seen > HELD // 2:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in held[0]], ["pair", "n"])
                    held, seen = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in _summed(*(np.concatenate(x) for x in zip(*held, strict=True)))], ["pair", "n"])

    return aligned.mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def _small(batches: Iterator[pa.RecordBatch], most: int = 1 << 18) -> Iterator[pa.RecordBatch]:
    """Batches cut so that each has about ``most`` tokens at most, or is one row."""
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column("a_ids")).to_numpy().astype(np.int64) // 2 + 16)
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, "right")))
            yield batch.slice(at, to - at)
            at = to


def judged(counts: DataFrame) -> DataFrame:
    """pair, n, best: whether no other pair of the same A id has a higher count."""
    a = F.shiftright("pair", 32)
    top = counts.groupBy(a.alias("a")).agg(F.max("n").alias("top"))
    return counts.withColumn("a", a).join(top, "a").select("pair", "n", (F.col("n") == F.col("top")).alias("best"))


def _strings(sides: int) -> list[np.ndarray]:
    """Decimal ids with each of the four marks that can follow one: next A id, end of the A ids, next B id, end of the group."""
    plain = [str(k) for k in range(sides)]
    return [np.array([p + mark for p in plain], object) for mark in ",|,;"]


def spelled(t: Tokens) -> list[str]:
    """The groups of each row as text: a1,a2|b1;a3|b2,b3."""
    a, b, n_a, n_b, size_a, size_b = t.a, t.b, t.n_a, t.n_b, t.size_a, t.size_b
    table = _strings_up_to(int(max(a.max(initial=0), b.max(initial=0))) + 1)
    out = np.empty(len(a) + len(b), object)
    before = np.cumsum(size_a + size_b) - size_a - size_b
    last_a, last_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
    last_a[np.cumsum(size_a) - 1], last_b[np.cumsum(size_b) - 1] = True, True
    for ids, sizes, start, last, (inner, final) in ((a, size_a, before, last_a, (0, 1)), (b, size_b, before + size_a, last_b, (2, 3))):
        at = spread(start, sizes)
        out[at[~last]] = table[inner][ids[~last]]
        out[at[last]] = table[final][ids[last]]
    ends = np.concatenate([[0], np.cumsum(n_a + n_b)])
    parts = out.tolist()
    return ["".join(parts[x:y])[:-1] for x, y in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]


_TABLES: list[list[np.ndarray]] = []


def _strings_up_to(n: int) -> list[np.ndarray]:
    if not _TABLES or len(_TABLES[0][0]) < n:
        _TABLES[:] = [_strings(max(n, 1 << 16))]
    return _TABLES[0]


_RESULT = ("row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string, "
           "rare array<struct<pair:bigint,times:bigint>>")


def weighed(aligned: DataFrame, common: int = COMMON) -> DataFrame:
    """row, doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row of a stored result of ``align_packed``.

    1. The linked id pairs are counted: every task sums its own, then they are summed by pair.
    2. Pairs that make up at least 1/``common`` of all (row, pair) links are common.  There cannot be more than ``common`` of these, so
       their counts (17 MB at the very most) are sent to all tasks and looked up where the row is read.
    3. All other pairs are joined by pair; none of them is frequent, so no task gets more than its share.
    """
    spark = aligned.sparkSession
    with small_batches(spark):
        counts = cut_lineage(judged(pair_counts(aligned)))
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    is_common = F.col("n") * common >= F.lit(total)
    rows = counts.where(is_common).toArrow()
    order = np.argsort(rows.column("pair").to_numpy())
    sent = spark.sparkContext.broadcast(tuple(rows.column(c).to_numpy()[order] for c in ("pair", "n", "best")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _forget()
        known, n, best = sent.value
        for batch in _small(batches):
            tokens = Tokens.of(batch)
            row, pair, times = links(tokens)
            at = np.minimum(np.searchsorted(known, pair), max(0, len(known) - 1))
            found = known[at] == pair if len(known) else np.zeros(len(pair), bool)
            t, at = times[found], at[found]
            sizes = (tokens.n_a, tokens.n_b, tokens.n_groups)
            rest = ~found
            rare = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(np.bincount(row[rest], minlength=batch.num_rows))]), pa.int32()),
                                            pa.StructArray.from_arrays([pa.array(pair[rest]), pa.array(times[rest])], ["pair", "times"]))
            n_links = _exact_sums(row, times, batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"), *[pa.array(s) for s in sizes], n_links,
                 _exact_sums(row[found], t * best[at], batch.num_rows), _exact_sums(row[found], t * n[at], batch.num_rows),
                 pa.array([hashlib.sha256(s.encode()).hexdigest() if s else "" for s in spelled(tokens)]), rare],
                ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "rare"])

    names = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    with small_batches(spark):
        near = stored(aligned.mapInArrow(run, _RESULT), "aligned-counts")
    far = (near.where(F.size("rare") > 0).select("row", F.inline("rare")).join(counts.where(~is_common), "pair")
           .groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("times") * F.col("n")).alias("more")))
    more = lambda name, extra: (F.col(name) + F.coalesce(extra, F.lit(0))).alias(name)
    return near.join(far, "row", "left").select(*[more("n_best", "more_best") if c == "n_best" else more("count_sum", "more") if c == "count_sum" else c for c in names])


def _exact_sums(row: np.ndarray, values: np.ndarray, n: int) -> pa.Array:
    """Sums by row; rows come in ascending order."""
    total = np.concatenate([[0], np.cumsum(values.astype(np.int64))])
    edges = np.searchsorted(row, np.arange(n + 1))
    return pa.array(total[edges[1:]] - total[edges[:-1]])


def alignment(docs: DataFrame, path_a: str, path_b: str, common: int = COMMON) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row; see ``align`` and ``weighed``.

    Rows without tokens get zeros and an empty digest.  A pair that several rows with the same doc_id link counts once for each row.
    """
    with small_batches(docs.sparkSession):
        packed = stored(align_packed(docs, path_a, path_b), "aligned")
    return weighed(packed, common).drop("row")
