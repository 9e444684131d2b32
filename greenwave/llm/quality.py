"""Quality scores by a sparse rule ensemble over text statistics, compiled into one column expression.

Shallow trees are grown on labelled rows; every path from a root to a node becomes a conjunctive
rule; a lasso logistic regression keeps a few of them.  The result is plain data (rules
and weights) and scores any number of documents as a Spark expression.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from greenwave.llm.common import words_of
from greenwave.session import cut_lineage

#: At most so many labelled rows are used for fitting: those with the smallest hash of their id.
SAMPLE = 20_000
THRESHOLD = 0.3
FEATURES = ("log_words", "word_length", "distinct_words", "short_words", "symbols", "bars", "upper", "digits", "points", "distinct_lines", "line_words")

Condition = tuple[str, str, float]  # feature, "<=" or ">", bound


@dataclass(frozen=True)
class Ensemble:
    intercept: float
    rules: tuple[tuple[float, tuple[Condition, ...]], ...]

    def score(self) -> Column:
        """The chance of label 1 as an expression over the feature columns __<name>."""
        total = reduce(lambda a, r: a + F.when(holds(r[1]), F.lit(r[0])).otherwise(F.lit(0.0)), self.rules, F.lit(self.intercept))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def holds(conditions: tuple[Condition, ...]) -> Column:
    tests = [F.col(f"__{f}") <= b if op == "<=" else F.col(f"__{f}") > b for f, op, b in conditions]
    return reduce(lambda a, b: a & b, tests)


def with_statistics(docs: DataFrame) -> DataFrame:
    """``docs`` with the features __<name>, from the whole text and from nothing else; null counts as empty."""
    lines = F.filter(F.split("__t", "\n"), lambda x: x != "")
    df = docs.withColumn("__t", F.coalesce("text", F.lit(""))).withColumn("__w", words_of(F.col("text"))).withColumn("__l", lines)
    size, n, n_lines = F.char_length("__t"), F.size("__w"), F.size("__l")

    def share(count: Column, of: Column) -> Column:
        return F.coalesce(count / F.when(of > 0, of), F.lit(0.0)).cast("double")

    def of_kind(characters: str) -> Column:
        return share(size - F.char_length(F.translate("__t", characters, "")), size)

    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZÀÂÄÇÈÉÊËÎÏÔÖÙÛÜÁÍÓÚÑ"
    values = {
        "log_words": F.log1p(n.cast("double")),
        "word_length": share(F.char_length(F.translate("__t", " \t\n\x0b\x0c\r", "")), n),
        "distinct_words": share(F.size(F.array_distinct("__w")), n),
        "short_words": share(F.size(F.filter("__w", lambda w: F.char_length(w) <= 3)), n),
        "symbols": of_kind("#*$%&@^~<>{}[]=_\\/!"),
        "bars": of_kind("|"),
        "upper": of_kind(upper),
        "digits": of_kind("0123456789"),
        "points": of_kind(".,;:?"),
        "distinct_lines": share(F.size(F.array_distinct("__l")), n_lines),
        "line_words": share(n, n_lines),
    }
    return df.select(*docs.columns, *[values[f].alias(f"__{f}") for f in FEATURES])


def paths(tree: str) -> set[tuple[Condition, ...]]:
    """The conditions on the way to each node of a tree, from its printed form; the tightest bound on each side of a feature."""
    found: set[tuple[Condition, ...]] = set()
    way: list[tuple[int, Condition]] = []
    for line in tree.splitlines():
        if m := re.match(r"( *)(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)", line):
            depth = len(m[1])
            way = [x for x in way if x[0] < depth] + [(depth, (FEATURES[int(m[2])], m[3], float(m[4])))]
            tight: dict[tuple[str, str], float] = {}
            for _, (f, op, b) in way:
                tight[f, op] = b if (f, op) not in tight else min(tight[f, op], b) if op == "<=" else max(tight[f, op], b)
            found.add(tuple(sorted((f, op, b) for (f, op), b in tight.items())))
    return found


def fit(labelled: DataFrame, trees: int = 24, depth: int = 3, penalty: float = 0.002, seed: int = 7) -> Ensemble:
    """An ensemble from rows with the features and ``__label`` (0 or 1).

    Without two classes there is nothing to learn: the score is then the smoothed share of label 1, for no rows a half.
    """
    count = labelled.agg(F.count(F.lit(1)).alias("n"), F.sum("__label").alias("ones")).first()
    n, ones = count["n"], count["ones"] or 0
    share = (ones + 1) / (n + 2)
    constant = Ensemble(math.log(share / (1 - share)), ())
    if not 0 < ones < n:
        return constant
    rows = VectorAssembler(inputCols=[f"__{f}" for f in FEATURES], outputCol="__features").transform(labelled)
    forest = RandomForestClassifier(featuresCol="__features", labelCol="__label", numTrees=trees, maxDepth=depth, maxBins=64,
                                    minInstancesPerNode=10, subsamplingRate=0.7, featureSubsetStrategy="onethird", seed=seed).fit(rows)
    rules = sorted(set().union(*(paths(t.toDebugString) for t in forest.trees)))
    if not rules:
        return constant
    as_numbers = labelled.select("__label", *[holds(r).cast("double").alias(f"__r{k}") for k, r in enumerate(rules)])
    vectors = cut_lineage(VectorAssembler(inputCols=[f"__r{k}" for k in range(len(rules))], outputCol="__rules").transform(as_numbers).select("__label", "__rules"))
    lasso = LogisticRegression(featuresCol="__rules", labelCol="__label", elasticNetParam=1.0, regParam=penalty, standardization=False, maxIter=60).fit(vectors)
    weights = lasso.coefficients.toArray().tolist()
    return Ensemble(float(lasso.intercept), tuple((w, r) for w, r in zip(weights, rules, strict=True) if w))


def held_out() -> Column:
    """Rows that nothing is learned from; a null id counts as such."""
    return F.coalesce(F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 5 == 0, F.lit(True))


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Ensemble:
    """An ensemble from labelled rows that are not held out, at most ``sample`` of them.

    The labels are picked first, so that only the statistics of those few texts are worked out; their ids are broadcast.
    """
    marked = labels.where("quality IS NOT NULL").where(~held_out()).groupBy("doc_id").agg(F.max("quality").cast("double").alias("__label"))
    picked = cut_lineage(marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)).withColumnRenamed("doc_id", "__picked")
    rows = with_statistics(docs.select("doc_id", "text").join(F.broadcast(picked), F.col("doc_id") == F.col("__picked")))
    order = [F.xxhash64("doc_id"), "doc_id", *[f"__{f}" for f in FEATURES]]
    return fit(cut_lineage(rows.select("doc_id", "__label", *[f"__{f}" for f in FEATURES]).orderBy(*order).limit(sample).drop("doc_id")))


def with_score(docs: DataFrame, model: Ensemble) -> DataFrame:
    """``docs`` with __score and __row.

    The row number is there so that a filter on the score stays above it: else Catalyst would copy the statistics
    into every rule of the filter and work them out each time.
    """
    return with_statistics(docs).select(*docs.columns, model.score().alias("__score"), F.monotonically_increasing_id().alias("__row"))


def scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of every row.

    Null and empty texts are scored like any other, from statistics that are 0.  Of several labels for a document
    the higher counts; rows that share a doc_id are scored one by one; an empty table gives no rows.
    """
    out = with_score(docs.select("doc_id", "text"), learn(docs, labels)).select("doc_id", held_out().alias("held_out"), F.col("__score").alias("score"))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def drop_rejected(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose score reaches the threshold, with all columns unchanged."""
    scored = with_score(docs, learn(docs, labels))
    return scored.where((F.col("__score") >= threshold) & (F.col("__row") >= 0)).select(*docs.columns)
