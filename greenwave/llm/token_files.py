"""Token ids as ORC files: integer run-length encoding, row indexes and Bloom filters on document ids."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, Window as W

from greenwave.llm.common import slices
from greenwave.llm.tokens import encoder, with_end

#: Settings of the files.  ORC stores the ids of a stripe by run-length encoding; the row index and the
#: Bloom filter (one of each for every ``row.index.stride`` rows) let a reader skip what a filter excludes.
ORC_OPTIONS = {
    "compression": "zstd",
    "orc.create.index": "true",
    "orc.row.index.stride": "1000",
    "orc.stripe.size": str(16 << 20),
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
}

#: ``place`` is the row's number in the task that wrote it
SCHEMA = "doc_id long, n_tokens long, ids array<int>, place long"


def encode(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """doc_id, n_tokens, ids and place of every whole text with ``end_id`` appended; null is empty.  One row per row, in the same order.

    The place counts the rows of a task, so in a file that the task writes it tells which row is which.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, done = encoder(path), 0
        for batch in slices(batches):
            ids, at = with_end(*enc.encode(batch.column("text").to_pylist()), end_id)
            sizes = at[1:] - at[:-1]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids.view("int32"), pa.int32())),
                 pa.array(range(done, done + len(sizes)), pa.int64())],
                ["doc_id", "n_tokens", "ids", "place"])
            done += len(sizes)

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


def write_tokens(docs: DataFrame, folder: str, path: str, end_id: int) -> None:
    """Write the ids of all documents in ascending doc_id order, across files by name and within each file.

    The texts are laid out by range and sorted, then encoded, so that no ids are shuffled.  Null ids come first;
    rows that share a doc_id are kept and stand together, ordered by their texts' hash; an empty table gives no rows.
    """
    key = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    laid = docs.select("doc_id", "text").repartitionByRange(*key).sortWithinPartitions(*key)
    writer = encode(laid, path, end_id).write.mode("error")
    for name, value in ORC_OPTIONS.items():
        writer = writer.option(name, value)
    writer.orc(folder)


def read_tokens(spark: SparkSession, folder: str, where: Column | None = None) -> DataFrame:
    """doc_id, n_tokens, ids, place and the file; a filter on doc_id reaches the row indexes and Bloom filters."""
    df = spark.read.schema(SCHEMA).orc(folder)
    df = df if where is None else df.where(where)
    return df.select("doc_id", "n_tokens", "ids", "place", F.col("_metadata.file_name").alias("file"))


def checksums(tokens: DataFrame) -> DataFrame:
    """doc_id, n_tokens, file, place and the CRC-32 of the ids as little-endian unsigned 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            flat = ids.values.to_numpy().astype("<u4", copy=False)
            at = ids.offsets.to_numpy()
            crc = [zlib.crc32(flat[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
            sizes = at[1:] - at[:-1]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int64()), batch.column("file"), batch.column("place"), pa.array(crc, pa.int64())],
                                             ["doc_id", "n_tokens", "file", "place", "ids_crc32"])

    return tokens.select("doc_id", "ids", "file", "place").mapInArrow(run, "doc_id long, n_tokens long, file string, place long, ids_crc32 long")


def _file_order() -> list[Column]:
    """Files in the order of the tasks that wrote them; names alone sort part-100000 before part-99999."""
    return [F.regexp_extract("file", r"^part-(\d+)", 1).cast("long"), F.col("file")]


def token_index(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of what the files hold.

    ``start`` counts the ids of all documents before.  The sums of whole files come from the
    n_tokens column alone; only they (one row a file) are added up in one place, the rest
    within each file, by the places that the files name, so rows that share a doc_id start where they lie.
    """
    all_files = W.orderBy(*_file_order()).rowsBetween(W.unboundedPreceding, -1)
    before = (read_tokens(spark, folder).groupBy("file").agg(F.sum("n_tokens").alias("n"))
              .select("file", F.coalesce(F.sum("n").over(all_files), F.lit(0)).alias("before")))
    in_file = W.partitionBy("file").orderBy("place").rowsBetween(W.unboundedPreceding, -1)
    return (checksums(read_tokens(spark, folder)).join(before, "file")
            .select("doc_id", (F.col("before") + F.coalesce(F.sum("n_tokens").over(in_file), F.lit(0))).alias("start"), "n_tokens", "ids_crc32"))
