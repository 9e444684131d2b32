"""Token counts without ids: pieces are counted once per distinct pre-token and joined to the documents."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from greenwave.llm.common import slices
from greenwave.llm.tokens import BYTE_LETTERS, as_letters
from greenwave.session import cut_lineage

# Fixed values of the tokenizer file: its special strings and its rule for pre-tokens.
SPECIAL = ("<|startoftext|>", "<|endoftext|>")
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{IsWhite_Space}\p{L}\p{N}]+"

#: Texts of these characters only, without "<|", are treated alike by Spark and by the library:
#: composed already, and with the same lower case, letters, digits and white space.
PLAIN = "^[\\x00-\\u012F\\u0131-\\u017F]*$"


def _tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def count_pieces(words: DataFrame, path: str) -> DataFrame:
    """The distinct pre-tokens with n_pieces, the BPE pieces of each; every other column is kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _tokenizer(path).model
        for batch in batches:
            words = batch.column("word").to_pylist()
            n = [len(model.tokenize(as_letters(w))) for w in words]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(n, pa.int64())], [*batch.schema.names, "n_pieces"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in words.schema)
    return words.mapInArrow(run, f"{kinds}, n_pieces long")


def _by_library(docs: DataFrame, path: str) -> DataFrame:
    """row_id, words of unusual texts: the library's own normalising and splitting; a special string is a word of its own."""
    kinds = "row_id long, words array<string>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = _tokenizer(path)
        back = {v: k for k, v in enumerate(BYTE_LETTERS)}
        cut = re.compile("(" + "|".join(map(re.escape, SPECIAL)) + ")")
        for batch in slices(batches):
            out = []
            for text in batch.column("text").to_pylist():
                words = []
                for part in cut.split(text):
                    if part in SPECIAL:
                        words.append(part)
                    else:
                        got = tok.pre_tokenizer.pre_tokenize_str(tok.normalizer.normalize_str(part))
                        words += [bytes(map(back.__getitem__, w)).decode() for w, _ in got]
                out.append(words)
            yield pa.RecordBatch.from_arrays([batch.column("row_id"), pa.array(out, pa.list_(pa.string()))], ["row_id", "words"])

    return docs.select("row_id", "text").mapInArrow(run, kinds)


def _rows(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", text.alias("text"), F.monotonically_increasing_id().alias("row_id"))


def pre_tokens(docs: DataFrame, path: str) -> DataFrame:
    """row_id, word: every pre-token of every text, as often as it occurs."""
    plain: Column = F.col("text").rlike(PLAIN) & ~F.contains("text", F.lit("<|"))
    usual = docs.where(plain).select("row_id", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(PRE_TOKEN), F.lit(0))).alias("word"))
    return usual.unionByName(_by_library(docs.where(~plain), path).select("row_id", F.explode("words").alias("word")))


def count_tokens(docs: DataFrame, path: str, limit: int = 2048, hot: int = 1 << 20, hot_bytes: int = 64) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row; null counts as empty, rows that share a doc_id stay apart.

    1. The distinct pre-tokens of the corpus are counted (summed in each task before the shuffle) and the
       BPE pieces of each are counted once.
    2. A pre-token that makes up at least 1/``hot`` of all occurrences and has at most ``hot_bytes`` bytes is hot.  There can be
       no more than ``hot`` of these, whatever the corpus, so that table (64 MB of strings at the very most) is
       broadcast and their pieces are summed where the text is read.
    3. All others are laid out by pre-token, counted per document there and joined; none of them is frequent, so no
       task gets more than its share.

    An empty table gives no rows.  Other columns of ``docs`` are not read.
    """
    rows = _rows(docs)
    words = pre_tokens(rows, path)
    vocabulary = cut_lineage(count_pieces(words.groupBy("word").agg(F.count(F.lit(1)).alias("n")), path))
    total = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    vocabulary = vocabulary.withColumn("n_pieces", F.when(F.col("word").isin(*SPECIAL), F.lit(1)).otherwise(F.col("n_pieces")))
    is_hot = (F.col("n") * hot >= F.lit(total)) & (F.octet_length("word") <= hot_bytes)
    known = F.broadcast(vocabulary.where(is_hot).select("word", "n_pieces"))
    near = words.join(known, "word").groupBy("row_id").agg(F.sum("n_pieces").alias("n"))
    rare = (words.join(known, "word", "left_anti").repartition("word").groupBy("word", "row_id").agg(F.count(F.lit(1)).alias("times"))
            .join(vocabulary.where(~is_hot).select("word", "n_pieces"), "word")
            .groupBy("row_id").agg(F.sum(F.col("times") * F.col("n_pieces")).alias("n")))
    none = rows.select("row_id", F.lit(0).cast("long").alias("n"), "doc_id", F.octet_length("text").cast("long").alias("n_bytes"))
    empty = (F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("long").alias("n_bytes"))
    total_of = (none.unionByName(near.select("row_id", "n", *empty)).unionByName(rare.select("row_id", "n", *empty))
                .groupBy("row_id").agg(F.max("doc_id").alias("doc_id"), F.max("n_bytes").alias("n_bytes"), F.sum("n").alias("n_tokens")))
    return total_of.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
