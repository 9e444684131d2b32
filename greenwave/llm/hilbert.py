"""Shards along a Hilbert curve through metadata, so that a filter on any of the dimensions skips most files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T, Window as W

from greenwave.session import cut_lineage

BITS = 5


def let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def hilbert_index(cells: list[Column], bits: int = BITS) -> Column:
    """The place on the curve of a cell, given by one integer of ``bits`` bits for each dimension.

    Skilling's transform as an expression: rotate and reflect bit by bit from the top, apply the Gray code,
    then interleave the bits of the dimensions.
    """
    n = len(cells)
    tops = [1 << b for b in range(bits - 1, 0, -1)]
    steps = F.array(*[F.struct(F.lit(q).alias("q"), F.lit(i).alias("i")) for q in tops for i in range(n)])
    places = F.array(*[F.struct(F.lit(1 << b).alias("q"), F.lit(i).alias("i")) for b in range(bits - 1, -1, -1) for i in range(n)])

    def turned(x: Column, s: Column) -> Column:
        p, own, first = s["q"] - 1, F.get(x, s["i"]), F.get(x, F.lit(0))
        is_set = own.bitwiseAND(s["q"]) != 0
        swap = F.when(is_set, F.lit(0)).otherwise(first.bitwiseXOR(own).bitwiseAND(p))
        head = first.bitwiseXOR(F.when(is_set, p).otherwise(swap))
        return F.transform(x, lambda v, j: F.when(j == 0, head).when(j == s["i"], v.bitwiseXOR(swap)).otherwise(v))

    def gray(x: Column) -> Column:
        return F.transform(x, lambda _, j: F.aggregate(F.slice(x, F.lit(1), j + 1), F.lit(0), lambda a, v: a.bitwiseXOR(v)))

    def flips(g: Column) -> Column:
        return F.aggregate(F.array(*map(F.lit, tops)), F.lit(0), lambda t, q: F.when(F.get(g, F.lit(n - 1)).bitwiseAND(q) != 0, t.bitwiseXOR(q - 1)).otherwise(t))

    def woven(c: Column) -> Column:
        return F.aggregate(places, F.lit(0).cast("long"), lambda a, s: a * 2 + (F.get(c, s["i"]).bitwiseAND(s["q"]) != 0).cast("long"))

    axes = F.aggregate(steps, F.array(*[c.cast("int") for c in cells]), turned)
    return let(axes, lambda x: let(gray(x), lambda g: let(flips(g), lambda t: woven(F.transform(g, lambda v: v.bitwiseXOR(t))))))


def _number(c: Column, skip: int) -> Column:
    """Six bytes of a string after a prefix that all values share, as a number in the order of the strings."""
    code = F.rpad(F.substring(F.hex(F.encode(c, "UTF-8")), skip * 2 + 1, 12), 12, "0")
    return F.conv(code, 16, 10).cast("double")


def quantised(df: DataFrame, dimensions: dict[str, Column], bits: int = BITS) -> DataFrame:
    """``df`` with __cell_<name> for each dimension: 0 for null, else by the number of quantiles that the value exceeds or equals.

    Strings are taken by their order, after the bytes that smallest and largest value share.  All that
    reaches the driver is a bounded number of quantiles.
    """
    kinds = {f.name: f.dataType for f in df.select(*[c.alias(n) for n, c in dimensions.items()]).schema}
    strings = [n for n, k in kinds.items() if isinstance(k, T.StringType)]
    numbers = {n: c.cast("double") for n, c in dimensions.items() if n not in strings}
    if strings:
        ends = df.agg(*[f(F.encode(dimensions[n], "UTF-8")).alias(f"{n}_{k}") for n in strings for k, f in (("low", F.min), ("high", F.max))]).first()
        for n in strings:
            low, high = bytes(ends[f"{n}_low"] or b""), bytes(ends[f"{n}_high"] or b"")
            alike = next((k for k, (x, y) in enumerate(zip(low, high)) if x != y), min(len(low), len(high)))  # noqa: B905
            numbers[n] = _number(dimensions[n], alike)
    shares = [k / (1 << bits) for k in range(1, 1 << bits)]
    cuts = df.agg(*[F.percentile_approx(c, shares, 10_000).alias(n) for n, c in numbers.items()]).first()
    for n, c in numbers.items():
        bounds = sorted(set(cuts[n] or []))
        cell = reduce(lambda a, x: a + (c >= x).cast("int"), bounds, F.lit(0))
        # few different values are spread over the whole range, so that they count in the top bits
        cell = F.floor(cell * ((1 << bits) - 1) / max(1, len(bounds))).cast("int")
        df = df.withColumn(f"__cell_{n}", F.coalesce(cell, F.lit(0)))
    return df


def place(df: DataFrame, key: str, shards: int, order: list[str], slices: int = 2048) -> DataFrame:
    """``df`` with shard and slot: runs along ``key`` (then a hash, then ``order``) whose row counts differ by one at most.

    The place of a row is the number of rows in earlier groups and its place in its own.  A key value with many
    rows is cut by hash into slices of about total / ``slices`` rows, so that no group is large; repeated rows
    are told apart by a row number, written once.  There are at most as many groups as cells of the curve and ``slices``,
    whatever the number of rows; only their counts are added up in one place.
    """
    total = df.count()
    if not total:
        return df.withColumn("shard", F.lit(0)).withColumn("slot", F.lit(0).cast("long"))
    target = max(200, total // slices)
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("__n")).select(F.col(key).alias("__k"), F.ceil(F.col("__n") / target).alias("__parts"))
    salted = df.withColumn("__row", F.monotonically_increasing_id())
    sliced = cut_lineage(salted.join(F.broadcast(counts), F.col(key) == F.col("__k"))
                         .withColumn("__slice", F.pmod(F.xxhash64(*order, "__row"), F.col("__parts"))).drop("__k", "__parts"))
    before = (sliced.groupBy(key, "__slice").agg(F.count(F.lit(1)).alias("__n"))
              .select(F.col(key).alias("__k"), F.col("__slice").alias("__s"),
                      F.coalesce(F.sum("__n").over(W.orderBy(key, "__slice").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("__before")))
    own = W.partitionBy(key, "__slice").orderBy(*[F.col(c).asc_nulls_first() for c in order], "__row")
    ranked = (sliced.withColumn("__own", F.row_number().over(own) - 1)
              .join(F.broadcast(before), (F.col(key) == F.col("__k")) & (F.col("__slice") == F.col("__s")))
              .withColumn("__rank", F.col("__before") + F.col("__own")))
    return (ranked.withColumn("shard", F.expr(f"int(((__rank + 1) * {shards} - 1) div {total})"))
            .withColumn("slot", F.expr(f"__rank - (bigint(shard) * {total}) div {shards}"))
            .drop("__k", "__s", "__before", "__own", "__rank", "__slice", "__row"))


def shard_documents(docs: DataFrame, shards: int = 16) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard and the cells of every row.

    The dimensions are lang, source and size (UTF-8 bytes of the text and one more).  Shards are consecutive runs of
    the curve; their row counts differ by one at most (law ``rows``).  Null texts have size 1 and the
    checksum of nothing; null metadata fall into cell 0; rows that share a doc_id each get a slot of their own;
    with fewer rows than shards some shards are empty.  An empty table gives no rows.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    slim = docs.select("doc_id", "lang", "source", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"))
    cells = quantised(slim, {"lang": F.col("lang"), "source": F.col("source"), "size": F.col("size")})
    curve = cells.withColumn("__hilbert", hilbert_index([F.col(f"__cell_{n}") for n in ("lang", "source", "size")]))
    placed = place(curve.drop("__cell_lang", "__cell_source", "__cell_size"), "__hilbert", shards, ["doc_id", "size", "text_crc32"])
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
                         "lang", "source", F.col("__hilbert").alias("hilbert"))


def write_shards(docs: DataFrame, folder: str, shards: int = 16) -> None:
    """The documents with all their columns as Parquet, one folder a shard; rows are matched to shards by id, size and checksum.

    Rows alike in all three (null ids are alike) go to the shards that hold them, the n-th by the hash of all columns to the n-th.  A
    shard may be written by many tasks: Spark cuts it by ``spark.sql.adaptive.advisoryPartitionSizeInBytes``.  A column of the input that
    is itself named ``shard`` is stored as ``shard_in``, with as many more ``_in`` as it takes to be the only one.  Null texts and
    metadata stay null; an empty table writes no folder of a shard.
    """
    taken = {c.lower() for c in docs.columns}
    names = []
    for c in docs.columns:
        new = c
        while new.lower() == "shard" or (new != c and new.lower() in taken):
            new += "_in"
        names.append(new)
    # the row travels as one column, so no name of its own can clash with the keys
    row = docs.toDF(*names).select(F.struct("*").alias("row"))
    text = F.coalesce(F.col("row.text"), F.lit(""))
    own = row.select("row", F.col("row.doc_id").alias("a"), (F.octet_length(text) + 1).cast("long").alias("b"), F.crc32(F.encode(text, "UTF-8")).alias("c"), F.xxhash64("row").alias("h"))
    at = shard_documents(docs, shards).select(F.col("doc_id").alias("x"), F.col("size").alias("y"), F.col("text_crc32").alias("z"), "shard")
    own = own.withColumn("i", F.row_number().over(W.partitionBy("a", "b", "c").orderBy("h")))
    at = at.withColumn("j", F.row_number().over(W.partitionBy("x", "y", "z").orderBy("shard")))
    same = F.col("a").eqNullSafe(F.col("x")) & (F.col("b") == F.col("y")) & (F.col("c") == F.col("z")) & (F.col("i") == F.col("j"))
    placed = own.join(at, same).select("shard", *[F.col(f"row.`{n}`") for n in names])
    placed.hint("rebalance", "shard").write.partitionBy("shard").parquet(folder)


def manifest(placed: DataFrame) -> DataFrame:
    """For each shard its rows and the smallest and largest value of each dimension: what a reader prunes by."""
    ends = [f(n).alias(f"{k}_{n}") for n in ("lang", "source", "size") for k, f in (("min", F.min), ("max", F.max))]
    return placed.groupBy("shard").agg(F.count(F.lit(1)).alias("n_rows"), *ends)
