"""Audit of sources: how far the word shares of a source lie from those of the other sources and of its language.

A source's counts over a block of term ids are the leaves of a segment tree.  Trees are hash-consed: equal subtrees, of one
source or of several, are one node.  Two sources are compared by walking both trees at once from the
root; equal pairs of nodes are taken together with the number of their places, so each is followed and priced once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, Window as W

from greenwave.llm.common import hash_spans, joined_texts, slices, spread, stored, word_spans

#: Letters and everything beyond ASCII; upper case is lowered first.
_LOWERED = np.arange(256, dtype=np.uint8)
_LOWERED[0x41:0x5B] += 0x20
_INSIDE = np.zeros(256, bool)
_INSIDE[[*range(0x61, 0x7B), *range(0x80, 0x100)]] = True
TERM = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
_LOWER = {k: k + 32 for k in range(0x41, 0x5B)}
MIN_DOCS, TOP, SCALE = 3, 200, 1_000_000_000
#: Counts that a task holds before it hands them on.
HELD = 1_000_000
#: Counts in the trees of one task, about; a block has fewer terms the more sources a language has, but no fewer terms than sources.
CELLS = 1 << 18
#: Sources that are compared in one task; of more, every two stripes of so many meet in a task of their own.
STRIPE = 512


def counted(texts: list[str | None], group: np.ndarray) -> tuple[np.ndarray, list[bytes], np.ndarray, np.ndarray]:
    """Group, term, occurrences and texts of every term of every group of texts."""
    data, bounds = joined_texts(texts)
    raw = _LOWERED[np.frombuffer(data, np.uint8)]
    starts, ends, counts = word_spans(raw, _INSIDE, bounds)
    if not len(starts):
        return np.zeros(0, np.int64), [], np.zeros(0, np.int64), np.zeros(0, np.int64)
    _, first, word = np.unique(hash_spans(raw, starts, ends), return_index=True, return_inverse=True)
    size = ends - starts
    if (size != size[first][word]).any() or (raw[spread(starts, size)] != raw[spread(starts[first][word], size)]).any():
        raise ValueError("two terms share a hash")  # the caller then takes the texts in halves
    n_texts = len(texts)
    key = np.sort(word * n_texts + np.repeat(np.arange(n_texts), counts))
    at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    n, word, text = np.diff(np.append(at, len(key))), key[at] // n_texts, key[at] % n_texts
    n_groups = int(group.max()) + 1
    key = word * n_groups + group[text]
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    lowered = raw.tobytes()
    terms = [lowered[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]
    return key[at] % n_groups, [terms[w] for w in (key[at] // n_groups).tolist()], np.add.reduceat(n, at), np.diff(np.append(at, len(key)))


def _counted(texts: list[str | None], group: np.ndarray) -> Iterator[tuple[np.ndarray, list[bytes], np.ndarray, np.ndarray]]:
    try:
        yield counted(texts, group)
    except ValueError:
        if len(texts) == 1:
            found: dict[bytes, int] = {}
            for t in TERM.findall((texts[0] or "").translate(_LOWER)):
                found[t.encode()] = found.get(t.encode(), 0) + 1
            yield np.repeat(group, len(found)), list(found), np.array(list(found.values()), np.int64), np.ones(len(found), np.int64)
            return
        half = len(texts) // 2
        yield from _counted(texts[:half], group[:half])
        yield from _counted(texts[half:], group[half:])


def tallies(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences), docs: sums that each task makes of its own rows.

    Every lang and source also has a row without a term, so that sources without terms are known.
    """
    names = ["lang", "source", "term"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        rows = 0

        def summed() -> pa.Table:
            done = pa.concat_tables(held).group_by(["group", "term"]).aggregate([("n", "sum"), ("docs", "sum")])
            return done.rename_columns(["group", "term", "n", "docs"])

        def result(done: pa.Table) -> Iterator[pa.RecordBatch]:
            lang, source = (pa.array([g[k] for g in numbers], pa.string()) for k in range(2))
            for part in done.combine_chunks().to_batches(max_chunksize=100_000):
                g = part.column("group")
                yield pa.RecordBatch.from_arrays([lang.take(g), source.take(g), part.column("term").cast(pa.string()), part.column("n"), part.column("docs")], [*names, "n", "docs"])

        numbers: dict[tuple[str, str], int] = {}
        for batch in slices(batches, max_bytes=4 << 20):
            pairs = zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), strict=True)
            group = np.array([numbers.setdefault((lang or "", source or ""), len(numbers)) for lang, source in pairs], np.int64)
            for g, terms, n, in_docs in _counted(batch.column("text").to_pylist(), group):
                held.append(pa.table({"group": pa.array(g), "term": pa.array(terms, pa.binary()), "n": pa.array(n), "docs": pa.array(in_docs)}))
                rows += len(terms)
            if rows > HELD:
                done = summed()
                held, rows = [done], len(done)
                if rows > HELD // 2:
                    yield from result(done)
                    held, rows = [], 0
        if held:
            yield from result(summed())
        size = len(numbers)
        lang, source = (pa.array([g[k] for g in numbers], pa.string()) for k in range(2))
        yield pa.RecordBatch.from_arrays([lang, source, pa.nulls(size, pa.string()), *[pa.array([0] * size, pa.int64())] * 2], [*names, "n", "docs"])

    return docs.select("lang", "source", "text").mapInArrow(run, "lang string, source string, term string, n long, docs long")


def kept_terms(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """lang, source, term, n, n_lang (the term's count in the language), first (one row of each term), and a row without a term for each lang and source."""
    by_term = W.partitionBy("lang", "term")
    counts = (tallies(docs).repartition("lang", "term", F.when(F.col("term").isNull(), F.col("source")))
              .groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))
    counts = counts.repartition("lang", "term").withColumns({
        "in_docs": F.sum("docs").over(by_term), "n_lang": F.sum("n").over(by_term), "first": F.col("source") == F.min("source").over(by_term)})
    return counts.where(F.col("term").isNull() | (F.col("in_docs") >= min_docs)).select("lang", "source", "term", "n", "n_lang", "first")


def share(n: Column, total: Column, terms: Column, scale: int = SCALE) -> Column:
    """1 + floor(scale * (n + 1) / (total + terms)), exactly."""
    wide = lambda c: c.cast("decimal(19,0)")
    return F.call_function("div", wide(n + 1) * F.lit(scale).cast("decimal(19,0)"), wide(total + terms)) + 1


def excess(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q); both are at most 10^9 + 1."""
    return F.call_function("div", (p - q) * (p - q), q)


def groups_of(kept: DataFrame) -> DataFrame:
    """lang, source, total (its N), terms (V of the lang), number and sources (how many the lang has)."""
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    terms = kept.groupBy("lang").agg(F.count_if(F.col("first") & F.col("term").isNotNull()).alias("terms"))
    order = W.partitionBy("lang").orderBy("source")
    numbered = totals.select("*", (F.row_number().over(order) - 1).alias("number"), F.count(F.lit(1)).over(W.partitionBy("lang")).alias("sources"))
    return numbered.join(terms, "lang")


def telling_terms(kept: DataFrame, groups: DataFrame, top: int = TOP) -> DataFrame:
    """lang, source, item, value, rank: the terms a source has more of than its language, the ``top`` highest by value, then by term."""
    whole = groups.groupBy("lang").agg(F.sum("total").alias("total_lang"))
    rows = kept.where("term IS NOT NULL AND n > 0").join(groups.join(whole, "lang"), ["lang", "source"])
    rows = rows.withColumns({"p": share(F.col("n"), F.col("total"), F.col("terms")), "q": share(F.col("n_lang"), F.col("total_lang"), F.col("terms"))}).where("p > q")
    order = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = rows.select("lang", "source", F.col("term").alias("item"), excess(F.col("p"), F.col("q")).alias("value")).withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= top)


class Trees:
    """Hash-consed segment trees over the columns of a table of counts, one tree a row.

    ``levels[0]`` has the node of every leaf, the last level the roots; ``children[k]`` the two nodes one level
    below of each node of level k + 1.  Equal subtrees have one number.
    """

    def __init__(self, counts: np.ndarray) -> None:
        size = 1
        while size < counts.shape[1]:
            size *= 2
        padded = np.full((len(counts), size), -1, np.int64)  # -1: no term
        padded[:, : counts.shape[1]] = counts
        self.values, nodes = np.unique(padded, return_inverse=True)
        nodes = nodes.reshape(padded.shape)
        self.children: list[np.ndarray] = []
        while nodes.shape[1] > 1:
            pairs = nodes[:, 0::2] << 32 | nodes[:, 1::2]
            known, nodes = np.unique(pairs, return_inverse=True)
            nodes = nodes.reshape(pairs.shape)
            self.children.append(np.stack([known >> 32, known & 0xFFFFFFFF], axis=1))
        self.roots = nodes[:, 0]

    def meet(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Number of the comparison, both counts, and the number of places, for every different pair of leaves of the trees left[k] and right[k]."""
        task, x, y, times = np.arange(len(left)), self.roots[left], self.roots[right], np.ones(len(left), np.int64)
        for level in reversed(self.children):
            below = level[x], level[y]
            task, times = np.repeat(task, 2), np.repeat(times, 2)
            x, y = below[0].ravel(), below[1].ravel()
            order = np.lexsort((y, x, task))
            task, x, y, times = task[order], x[order], y[order], times[order]
            new = np.concatenate([[True], (task[1:] != task[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1])])
            first = np.flatnonzero(new)
            task, x, y, times = task[first], x[first], y[first], np.add.reduceat(times, first)
        real = self.values[x] >= 0
        return task[real], self.values[x[real]], self.values[y[real]], times[real]


def shares(n: np.ndarray, total: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """1 + floor(scale * (n + 1) / total) by long division in steps of 1,000, exact for totals below 9 * 10^15."""
    whole, rest = np.divmod(n + 1, total)
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, total)
        whole = whole * 1000 + digit
    if scale != SCALE:
        raise ValueError("three steps make 10^9")
    return whole + 1


def prices(trees: Trees, totals: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each comparison the summed excess of left over right and of right over left; ``totals`` are N + V of each tree."""
    out = np.zeros(len(left), np.int64), np.zeros(len(left), np.int64)
    step = max(1, (1 << 20) // max(1, int(len(trees.children) and 1 << len(trees.children))))
    for at in range(0, len(left), step):
        a, b = left[at:at + step], right[at:at + step]
        task, x, y, times = trees.meet(a, b)
        p, q = shares(x, totals[a[task]]), shares(y, totals[b[task]])
        square = (p - q) * (p - q)
        for sums, under in zip(out, (q, p), strict=True):
            np.add.at(sums, at + task, square // under * times)
    return out


def pair_sums(kept: DataFrame, groups: DataFrame, cells: int = CELLS, stripe: int = STRIPE) -> DataFrame:
    """lang, number, other, value for every two sources of a language: the excess summed over all its terms.

    Terms are dealt into blocks by hash, and each block of a language (and each two stripes of sources, where these are many) is
    priced in a task of its own; a common term is one of many in its block.  The sums of the blocks are added up.
    """
    together = F.least(F.col("sources"), F.lit(stripe))
    blocks = F.greatest(F.lit(1), F.ceil(F.col("terms") / F.greatest(F.lit(cells) / together, together))).cast("long")
    sized = groups.withColumns({"blocks": blocks, "stripes": F.ceil(F.col("sources") / F.lit(stripe)).cast("long"),
                                "mine": F.expr(f"number div {stripe}").cast("long")})
    meets = F.transform(F.sequence(F.lit(0).cast("long"), F.col("stripes") - 1), lambda s: F.struct(F.least(s, "mine").alias("low"), F.greatest(s, "mine").alias("high")))
    sized = sized.select("lang", "source", "total", "terms", "number", "blocks", F.inline(meets))
    block = F.pmod(F.xxhash64("term"), "blocks").alias("block")
    here = kept.where("term IS NOT NULL")
    counts = here.join(sized, ["lang", "source"]).select("lang", "number", block, "low", "high", "term", "n", F.lit(0).cast("long").alias("terms"), F.lit(0).cast("long").alias("in_block"))
    # every block also has a row without a term for each of its sources, with the source's total and the number of terms in the block
    in_block = (here.where("first").join(sized.where("number = 0 AND low = high").select("lang", "blocks"), "lang")
                .groupBy("lang", block).agg(F.count(F.lit(1)).alias("in_block")))
    known = (sized.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).join(in_block, ["lang", "block"], "left")
             .select("lang", "number", "block", "low", "high", F.lit(None).cast("string").alias("term"), F.col("total").alias("n"), "terms",
                     F.coalesce("in_block", F.lit(0)).alias("in_block")))

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        lang, low, high = key[0].as_py(), key[2].as_py(), key[3].as_py()
        is_term = rows.column("term").is_valid().to_numpy()
        number, n = rows.column("number").to_numpy(), rows.column("n").to_numpy()
        sources, place = np.unique(number[~is_term], return_index=True)
        totals = n[~is_term][place] + pc.max(rows.column("terms")).as_py()
        terms = rows.column("term").combine_chunks().dictionary_encode()
        ids = terms.indices.to_numpy(zero_copy_only=False)[is_term].astype(np.int64) if is_term.any() else np.zeros(0, np.int64)
        table = np.zeros((len(sources), pc.max(rows.column("in_block")).as_py()), np.int64)  # also terms that none of these sources has
        table[np.searchsorted(sources, number[is_term]), ids] = n[is_term]
        of_stripe = sources // stripe
        left, right = np.nonzero((sources[:, None] < sources[None, :]) & (((of_stripe[:, None] == low) & (of_stripe[None, :] == high)))
                                 if low != high else (sources[:, None] < sources[None, :]))
        if table.shape[1] and len(left):
            forth, back = prices(Trees(table), totals, left, right)
        else:
            forth = back = np.zeros(len(left), np.int64)
        a, b = sources[left], sources[right]
        size = 2 * len(left)
        return pa.table({"lang": pa.array([lang] * size, pa.string()), "number": pa.array(np.concatenate([a, b]), pa.int64()),
                         "other": pa.array(np.concatenate([b, a]), pa.int64()), "value": pa.array(np.concatenate([forth, back]), pa.int64())})

    priced = counts.unionByName(known).groupBy("lang", "block", "low", "high").applyInArrow(run, "lang string, number long, other long, value long")
    return priced.groupBy("lang", "number", "other").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, cells: int = CELLS, stripe: int = STRIPE) -> DataFrame:
    """lang, source, part, item, value, rank: for every source the other sources of its language (``pair``) and its telling terms (``term``).

    A term is kept if at least ``min_docs`` rows of its language have it.  The value of a pair is the sum, over all kept terms, of the squared
    difference of the two smoothed shares over the other's share; that of a term the same against the whole language.  Null text, lang
    and source count as empty; sources without terms are compared like others, and a language without kept terms gives pairs of
    value 0.  Ties stand in the order of their names' bytes.  Each row is a document, also where rows share a doc_id; an
    empty table gives no rows.  Other columns of ``docs`` are not read.
    """
    kept = stored(kept_terms(docs, min_docs), "kept-terms")
    groups = stored(groups_of(kept), "sources")
    names = groups.select("lang", "number", "source")
    order = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = (pair_sums(kept, groups, cells, stripe).join(names, ["lang", "number"])
             .join(names.select("lang", F.col("number").alias("other"), F.col("source").alias("item")), ["lang", "other"])
             .select("lang", "source", F.lit("pair").alias("part"), "item", "value").withColumn("rank", F.row_number().over(order)))
    terms = telling_terms(kept, groups, top).withColumn("part", F.lit("term"))
    return pairs.unionByName(terms).select("lang", "source", "part", "item", F.col("value").cast("long").alias("value"), F.col("rank").cast("int").alias("rank"))


#: The same question in SQL.
SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (SELECT r, lang, source, unnest(w) AS term FROM d),
k AS (SELECT lang, term, count(*) AS n_lang FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
v AS (SELECT lang, count(*) AS v, sum(n_lang) AS n FROM k GROUP BY lang),
c AS (SELECT t.lang, t.source, t.term, count(*) AS n FROM t JOIN k ON k.lang = t.lang AND k.term = t.term GROUP BY ALL),
g AS (SELECT lang, source, coalesce((SELECT sum(n) FROM c WHERE c.lang = x.lang AND c.source = x.source), 0) AS n FROM (SELECT DISTINCT lang, source FROM d) x),
s AS (SELECT g.lang, g.source, k.term, k.n_lang, coalesce(c.n, 0) AS n, v.n AS total_lang, v.v,
  1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 1) // (g.n + v.v) AS p FROM g JOIN k ON k.lang = g.lang JOIN v ON v.lang = g.lang
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
f AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value FROM s a JOIN s b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
p AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
q AS (SELECT *, 1 + 1000000000::HUGEINT * (n_lang + 1) // (total_lang + v) AS q FROM s WHERE n > 0),
m AS (SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // q AS value FROM q WHERE p > q)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM (FROM p UNION ALL FROM m)) WHERE part = 'pair' OR rank <= 200
"""
