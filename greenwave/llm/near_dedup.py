"""Near-duplicate documents: DartMinHash signatures, banded candidates, exact checks, classes.

Documents are weighted sets: an element is a run of five words (in lower case, without punctuation),
its weight how often the document has it.  An element of weight w owns the region [0, w) of the weight axis; hashed darts
(a Poisson process that depends on the element only) fall on regions and ranks, and each dart
names one coordinate of the signature.  A coordinate keeps its earliest dart.  Two
documents agree in a coordinate with the probability of their weighted Jaccard similarity.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import MapType, VariantType

from greenwave.llm.common import digest, hash_spans, joined_texts, mix, slices, stored, word_spans
from greenwave.session import cut_lineage

WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 24, 4  # a pair of similarity 0.8 shares no band with a chance of (1 - 0.8^4)^24 = 3e-6

# Words are compared in lower case and without punctuation: digits, letters and everything beyond ASCII.
_LOWERED = np.arange(256, dtype=np.uint8)
_LOWERED[0x41:0x5B] += 0x20
_INSIDE = np.zeros(256, bool)
_INSIDE[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_K1, _K2, _K3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def elements(texts: list[str | None], words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the unit regions of all texts, and how many each text has.

    The n-th occurrence of a run of words in a text is its n-th unit of weight.  A text of fewer words,
    but not none, has one run.
    """
    data, bounds = joined_texts(texts)
    raw = _LOWERED[np.frombuffer(data, np.uint8)]
    starts, ends, counts = word_spans(raw, _INSIDE, bounds)
    h = hash_spans(raw, starts, ends)
    first = np.cumsum(counts) - counts
    with np.errstate(over="ignore"):
        runs = np.zeros(len(h), np.uint64)
        short = np.flatnonzero((counts > 0) & (counts < words))
        for j in range(words):
            runs[: max(0, len(h) - j)] += mix(h[j:] + np.uint64(j + 1) * _K1)
        doc = np.repeat(np.arange(len(texts)), counts)
        place = np.arange(len(h)) - first[doc]
        use = place <= counts[doc] - words
        for k in short.tolist():
            a = first[k]
            runs[a] = np.bitwise_xor.reduce(mix(h[a:a + counts[k]] + np.arange(1, counts[k] + 1, dtype=np.uint64) * _K2))
            use[a] = True
        runs, doc = mix(runs[use]), doc[use]
        order = np.lexsort((runs, doc))
        runs, doc = runs[order], doc[order]
        new = np.ones(len(runs), bool)
        new[1:] = (runs[1:] != runs[:-1]) | (doc[1:] != doc[:-1])
        at = np.flatnonzero(new)
        nth = np.arange(len(runs)) - np.repeat(at, np.diff(np.append(at, len(runs))))
        return mix(runs + nth.astype(np.uint64) * _K3), np.bincount(doc, minlength=len(texts))


def _slabs() -> Iterator[tuple[float, float]]:
    """Rank intervals: three below 1 (long texts need few ranks), then one after another."""
    yield from ((0.0, 1 / 16), (1 / 16, 3 / 16), (1 / 4, 3 / 4))
    low = 1.0
    while True:
        yield low, 1.0
        low += 1


def _poisson(width: float) -> np.ndarray:
    """The chances of at most 0, 1, 2, ... darts in a slab."""
    terms = [math.exp(-width)]
    while terms[-1] > 1e-18:
        terms.append(terms[-1] * width / len(terms))
    return np.cumsum(terms)


def signatures(units: np.ndarray, counts: np.ndarray, size: int = BANDS * ROWS) -> np.ndarray:
    """For each text the rank of the earliest dart in each coordinate; infinite where a text has no words."""
    n = len(counts)
    best = np.full(n * size, np.inf)
    doc = np.repeat(np.arange(n), counts)
    with np.errstate(over="ignore"):
        for s, (low, width) in enumerate(_slabs()):
            if not len(units):
                break
            seed = mix(np.array([s + 1], np.uint64) * _K2)
            u = (mix(units ^ seed) >> np.uint64(11)).astype(np.float64) * 2.0**-53
            darts = np.searchsorted(_poisson(width), u, "right")
            who = np.repeat(np.arange(len(units)), darts)
            if len(who):
                j = np.arange(len(who)) - np.repeat(np.cumsum(darts) - darts, darts)
                d = mix(units[who] + seed * (j.astype(np.uint64) * np.uint64(2) + np.uint64(3)))
                rank = low + width * (mix(d + _K3) >> np.uint64(11)).astype(np.float64) * 2.0**-53
                np.minimum.at(best, doc[who] * size + ((d >> np.uint64(32)) % np.uint64(size)).astype(np.int64), rank)
            # a text is done once each coordinate has a dart: those of later slabs rank behind
            open_ = np.isinf(best.reshape(n, size)).any(axis=1)
            keep = open_[doc]
            units, doc = units[keep], doc[keep]
    return best.reshape(n, size)


def bands_of(best: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key for each band; the number of the band is part of the key."""
    n, size = best.shape
    bits = best.view(np.uint64).reshape(n, size // rows, rows)
    with np.errstate(over="ignore"):
        out = np.broadcast_to(mix(np.arange(1, size // rows + 1, dtype=np.uint64) * _K1), (n, size // rows)).copy()
        for j in range(rows):
            out = mix(out * _K2 + bits[:, :, j])
    return out


def first_copies(docs: DataFrame) -> DataFrame:
    """text_key, row and node for every different text, stored: its first row by doc_id (null last), then by the other columns, and a number.

    Copies are dropped in each task before the texts move, and the texts move only here.
    """
    others = [F.col(f"`{f.name}`") for f in docs.schema if f.name != "doc_id" and not isinstance(f.dataType, (MapType, VariantType))]
    rank = F.struct(F.col("doc_id").isNull(), "doc_id", *others)
    rows = docs.select(digest().alias("text_key"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), rank.alias("rank"))
    first = rows.groupBy("text_key").agg(F.min_by("row", "rank").alias("row"))
    return stored(first.withColumn("node", F.monotonically_increasing_id()), "texts")


def sign(texts: DataFrame) -> DataFrame:
    """node, text_key, copy_of, n_elements and the band keys of every text; no keys where there are no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            units, counts = elements(batch.column("text").to_pylist())
            keys = bands_of(signatures(units, counts))
            have = counts > 0
            at = np.concatenate([[0], np.cumsum(have * keys.shape[1])])
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("node", "text_key", "copy_of")], pa.array(counts, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(keys[have].ravel().view(np.int64), pa.int64()))],
                ["node", "text_key", "copy_of", "n_elements", "bands"])

    rows = texts.select("node", "text_key", F.col("row.doc_id").alias("copy_of"), F.col("row.text").alias("text"))
    return rows.mapInArrow(run, "node long, text_key string, copy_of long, n_elements long, bands array<long>")


def similarities(pairs: DataFrame) -> DataFrame:
    """a, b, both (elements in common), similarity: the weighted Jaccard similarity of text_a and text_b, from all their elements."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text_a", 1 << 20):
            n = batch.num_rows
            sides = []
            for name in ("text_a", "text_b"):
                units, counts = elements(batch.column(name).to_pylist())
                owner = np.repeat(np.arange(n), counts)
                with np.errstate(over="ignore"):
                    sides.append((mix(units + mix(np.arange(1, n + 1, dtype=np.uint64) * _K2)[owner]), owner, counts))
            (ua, oa, na), (ub, _, nb) = sides
            _, at, _ = np.intersect1d(ua, ub, assume_unique=True, return_indices=True)
            both = np.bincount(oa[at], minlength=n)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(both, pa.int64()), pa.array(both / np.maximum(1, na + nb - both), pa.float64())],
                                             ["a", "b", "both", "similarity"])

    return pairs.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long, both long, similarity double")


def element_rows(texts: DataFrame) -> DataFrame:
    """node, element for every element of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            units, counts = elements(batch.column("text").to_pylist())
            owner = pa.array(np.repeat(np.arange(batch.num_rows), counts), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("node").take(owner), pa.array(units.view(np.int64), pa.int64())], ["node", "element"])

    return texts.select("node", "text").mapInArrow(run, "node long, element long")


#: A key that more than one in so many rows have is a hub; there are fewer than ``HUBS`` of these, so their labels are sent to all tasks.
HUBS = 64
#: Rows of a graph that one task takes; small graphs then stay in few tasks and files.
ROWS_A_TASK = 200_000


def _hubs(rows: DataFrame, key: str, total: int) -> list[int]:
    return [r[0] for r in rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") * HUBS > total).select(key).collect()]


def _labelled(rows: DataFrame, key: str, labels: DataFrame, hubs: list[int]) -> DataFrame:
    """``rows`` with ``comp``, the label of the node in ``key``; rows of hubs stay where they are."""
    of = labels.select(F.col("node").alias(key), "comp")
    if not hubs:
        return rows.join(of, key)
    is_hub = F.col(key).isin(hubs)
    return rows.where(~is_hub).join(of.where(~is_hub), key).unionByName(rows.where(is_hub).join(F.broadcast(of.where(is_hub)), key))


def components(edges: DataFrame) -> DataFrame:
    """node, comp for every node of the edges (a, b): the smallest node that can be reached.

    Labels spread to neighbours and then jump to their label's label, so the rounds grow with the logarithm
    of the longest chain.  Each round is written to the shared folder.
    """
    both = cut_lineage(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    total = both.count()
    few = lambda df: df.coalesce(-(-total // ROWS_A_TASK) or 1)
    near_hubs = _hubs(few(both), "b", total)
    labels = cut_lineage(few(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select("node", F.least("node", "low").alias("comp"))))
    while True:
        near = few(_labelled(both, "b", labels, near_hubs)).groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("best"))
        step = cut_lineage(few(labels.join(near, "node").select("node", F.least("comp", "best").alias("next"), F.col("comp").alias("was"))))
        jumped = _labelled(step, "next", step.select("node", F.col("next").alias("comp")), _hubs(step, "next", total))
        labels = cut_lineage(few(jumped.select("node", F.least("next", "comp").alias("comp"), "was")))
        if labels.where("comp < was").isEmpty():
            return labels.select("node", "comp")
        labels = labels.select("node", "comp")


def checked(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """a, b, both, similarity of pairs of nodes, from their texts."""
    full = (pairs.select("a", "b").join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
            .join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b"))
    return similarities(full)


#: Components with so many nodes in one bucket are compared by way of their head first.
MANY = 16


def completed(shared: DataFrame, comps: DataFrame, rank: DataFrame, tested: DataFrame, texts: DataFrame, counts: DataFrame,
              similarity: float) -> DataFrame | None:
    """The links between nodes of different components that share a bucket; None if there is no such bucket.

    Two exact bounds keep this far below all pairs where many copies lie just under the threshold.

    - A similarity s of texts with n and m elements takes s / (1 + s) (n + m) elements in common, so each of the two
      must have that many which occur in any other node of such buckets at all.  A heavily changed copy has too
      many elements of its own.  (Elements are counted once, by hash.)
    - Nodes are checked against the head of each component that has ``MANY`` nodes in their bucket.  What x and y have in
      common lies inside that head, at most as much as the lesser of the two has there, or outside, at
      most as much as the lesser of the two has there that any other node has.

    The pairs that remain, each taken in the smallest of its shared buckets, are checked by their texts.
    """
    here = shared.join(comps, "node", "left").select("key", "node", F.coalesce("comp", "node").alias("comp"))
    mixed = here.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low < high").select("key")
    left = cut_lineage(here.join(mixed, "key"))
    if left.isEmpty():
        return None
    able = counts
    for _ in range(2):  # the second time without the elements of nodes that are out already
        within = left.select("node").distinct().join(able.select("node"), "node")
        found = element_rows(texts.join(within, "node")).groupBy("element").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("node"))
        alone = found.where("n = 1").groupBy("node").agg(F.count(F.lit(1)).alias("alone"))
        able = (counts.join(within, "node").join(alone, "node", "left").withColumn("common", F.col("n_elements") - F.coalesce("alone", F.lit(0)))
                .where(F.col("common") >= F.col("n_elements") * (similarity - 1e-9)).select("node", "n_elements", "common"))
        able = cut_lineage(able)
    left = cut_lineage(left.join(able, "node"))

    head = left.join(rank, "node").groupBy("comp").agg(F.max(F.struct("rank", "node")).alias("head")).select("comp", F.col("head.node").alias("head"))
    large = left.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= MANY).join(head, "comp")
    to_head = cut_lineage(left.select("key", "node").join(large.select("key", F.col("comp").alias("of"), "head"), "key").select("node", "of", "head").distinct())
    pairs = to_head.where("node <> head").select(F.least("node", "head").alias("a"), F.greatest("node", "head").alias("b")).distinct()
    by_head = cut_lineage(checked(pairs, texts))
    size_of = able.select(F.col("node").alias("head"), F.col("n_elements").alias("size"))
    with_head = (to_head.withColumn("a", F.least("node", "head")).withColumn("b", F.greatest("node", "head")).join(by_head, ["a", "b"], "left").join(size_of, "head")
                 .groupBy("node").agg(F.map_from_entries(F.collect_list(F.struct("of", F.coalesce("both", "size")))).alias("inside")))
    keys = left.groupBy("node").agg(F.collect_set("key").alias("keys"))
    rows = cut_lineage(left.join(keys, "node").join(with_head, "node", "left"))

    x, y = rows.alias("x"), rows.alias("y")
    needed = (F.col("x.n_elements") + F.col("y.n_elements")) * (similarity / (1 + similarity) - 1e-9)
    enough = F.least("x.common", "y.common") >= needed

    def by_way_of(comp: str):
        """Whether x and y may have enough in common, by the head of a component."""
        in_x, in_y = (F.try_element_at(F.col(f"{p}.inside"), F.col(comp)) for p in "xy")
        return F.coalesce(F.least(in_x, in_y) + F.least(F.col("x.common") - in_x, F.col("y.common") - in_y) >= needed, F.lit(True))

    first = F.col("x.key") == F.array_min(F.array_intersect("x.keys", "y.keys"))
    met = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.node") < F.col("y.node")) & (F.col("x.comp") != F.col("y.comp")) & enough
                 & by_way_of("x.comp") & by_way_of("y.comp") & first)
    done = tested.unionByName(pairs)
    rest = met.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).join(done, ["a", "b"], "left_anti")
    found = checked(rest, texts).unionByName(by_head)
    return cut_lineage(found.where(F.col("similarity") >= similarity).select("a", "b"))


def text_classes(copies: DataFrame, similarity: float) -> DataFrame:
    """node, text_key, copy_of, class_id, class_text for every different text; ``copies`` as from ``first_copies``.

    1. Equal texts are one node already, so copies cost nothing here.
    2. In each bucket of a band all nodes are checked against one head: the node that shares most buckets
       with others.  That is one pair per node, not all pairs.
    3. Buckets that still hold more than one class are completed, see ``completed``.  In the end
       every candidate pair is joined by links, or was checked, or is proven to be less similar.
    """
    nodes = cut_lineage(sign(copies))
    placed = nodes.select("node", F.explode("bands").alias("key"))
    sizes = placed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = cut_lineage(placed.join(sizes, "key"))
    rank = cut_lineage(shared.groupBy("node").agg(F.sum("n").alias("rank")))
    heads = shared.join(rank, "node").groupBy("key").agg(F.max(F.struct("rank", "node")).alias("head")).select("key", F.col("head.node").alias("head"))
    starred = cut_lineage(shared.join(heads, "key").where("node <> head")
                          .select(F.least("node", "head").alias("a"), F.greatest("node", "head").alias("b")).distinct())

    # only texts that share a band with another one are compared; they move once here, the others stay where they are
    texts = stored(copies.select("node", F.col("row.text").alias("text")).join(rank.select("node"), "node"), "candidates")
    links = cut_lineage(checked(starred, texts).where(F.col("similarity") >= similarity).select("a", "b"))
    comps = components(links)
    more = completed(shared, comps, rank, starred, texts, nodes.select("node", "n_elements"), similarity)
    if more is not None:
        comps = components(links.unionByName(more))
    of_node = nodes.join(comps, "node", "left").select("node", "text_key", "copy_of", F.coalesce("comp", "node").alias("comp"))
    first = F.min(F.struct(F.col("copy_of").isNull().alias("unnamed"), "copy_of", "text_key")).alias("first")
    lowest = of_node.groupBy("comp").agg(first).select("comp", F.col("first.copy_of").alias("class_id"), F.col("first.text_key").alias("class_text"))
    return of_node.join(lowest, "comp").select("node", "text_key", "copy_of", "class_id", "class_text")


def classes(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, class_id, copy_of for every row: near copies share a class.

    Two different texts are linked if they share a band and their weighted Jaccard similarity on runs of five words
    is at least ``similarity``; a class is what links connect.  ``class_id`` is its smallest doc_id, ``copy_of`` the
    smallest doc_id with the same text.  Null texts count as empty; texts without words
    are linked to equal texts only; a class that has no doc_id gets null.  Rows that share a doc_id are
    judged by their texts.  An empty table gives no rows.  Other columns of ``docs`` are not read.
    """
    slim = docs.select("doc_id", "text")
    named = text_classes(first_copies(slim), similarity).select("text_key", "copy_of", "class_id")
    return docs.select("doc_id", digest().alias("text_key")).join(named, "text_key").select("doc_id", "class_id", "copy_of")


def keep_first(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row of each class, with all the columns of ``docs``, whatever their names: that with the smallest doc_id (null last), of several texts
    with that id the first by hash, and of equal texts the first by the other columns.

    Null texts count as empty.  An empty table gives no rows.
    """
    copies = first_copies(docs)
    kept = text_classes(copies, similarity).where("text_key = class_text").select("node")
    return copies.join(kept, "node", "left_semi").select("row.*")


#: The same question in SQL, over all pairs of texts that share a run of words.
SQL = r"""
WITH RECURSIVE t AS (SELECT sha256(coalesce(text, '')) AS k, any_value(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w, min(doc_id) AS copy_of FROM documents GROUP BY 1),
r AS (SELECT k, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT k, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM t WHERE len(w) > 0)),
g AS (SELECT k, g, count(*) AS n FROM r GROUP BY k, g),
s AS (SELECT k, sum(n) AS n FROM g GROUP BY k),
both_ AS (SELECT x.k AS a, y.k AS b, sum(least(x.n, y.n)) AS n FROM g x JOIN g y ON x.g = y.g AND x.k <> y.k GROUP BY ALL),
link AS (SELECT a, b FROM both_ JOIN s p ON p.k = a JOIN s q ON q.k = b WHERE both_.n >= 0.8 * (p.n + q.n - both_.n)),
reach AS (SELECT k AS a, k AS b FROM t UNION SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b),
c AS (SELECT a AS k, min(copy_of) AS class_id FROM reach JOIN t ON t.k = reach.b GROUP BY a)
SELECT doc_id, class_id, copy_of FROM documents d JOIN t ON t.k = sha256(coalesce(d.text, '')) JOIN c ON c.k = t.k
"""
