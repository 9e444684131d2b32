"""Quality rules for texts, and verdicts on the hosts they come from, as DataFrame expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from greenwave.llm.common import words_of
from greenwave.session import cut_lineage

SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
#: A host is rejected by a rule if its shrunken failure rate, less DEVIATIONS standard deviations, is above MULTIPLE times
#: the rate of all documents; that limit is never below LOW nor above HIGH.
MULTIPLE, LOW, HIGH, DEVIATIONS = 2.0, 0.2, 0.5, 3.0
#: The prior is worth between one and a million documents.
LEAST, MOST = 1.0, 1e6


def without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def _run(i: Column) -> Column:
    w = lambda k: F.get("__w", i + k)
    return F.concat_ws(" ", w(0), w(1), w(2))


def statistics(docs: DataFrame) -> DataFrame:
    """``docs`` with __n_words, __word_chars, __n_symbols, __n_dup_lines, __n_repeat_words, __n_lines (lines with a word) and __base_failed.

    All of it is worked out within the row, so nothing is shuffled.  Windows of three words are
    compared by hash first; only texts in which two hashes agree sort the windows themselves.
    """
    t = F.col("__t")
    df = docs.withColumn("__t", F.coalesce("text", F.lit(""))).withColumn("__w", words_of(F.col("text")))
    df = df.withColumn("__lines", F.filter(F.split("__t", "\n"), lambda x: without(x, SPACE) != ""))
    starts = F.when(F.size("__w") >= 3, F.sequence(F.lit(0), F.size("__w") - 3)).otherwise(F.array().cast("array<int>"))
    df = df.withColumn("__hashes", F.transform(starts, lambda i: F.xxhash64(F.get("__w", i), F.get("__w", i + 1), F.get("__w", i + 2))))
    repeats = F.size(F.array_distinct("__hashes")) < F.size("__hashes")
    df = df.withColumn("__sorted", F.when(repeats, F.sort_array(F.transform(starts, lambda i: F.struct(_run(i).alias("t"), i.alias("i")))))
                       .otherwise(F.array().cast("array<struct<t:string,i:int>>")))

    def twice(x: Column, j: Column) -> Column:
        before = F.when(j > 0, F.get("__sorted", j - 1)["t"] == x["t"]).otherwise(F.lit(False))
        return before | F.coalesce(F.get("__sorted", j + 1)["t"] == x["t"], F.lit(False))

    covered = F.array_distinct(F.flatten(F.transform(F.filter("__sorted", twice), lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2))))
    df = df.select(
        *docs.columns,
        F.size("__w").cast("long").alias("__n_words"),
        F.char_length(without(t, SPACE)).cast("long").alias("__word_chars"),
        (F.char_length(t) - F.char_length(without(t, SYMBOLS))).cast("long").alias("__n_symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("__n_dup_lines"),
        F.size(covered).cast("long").alias("__n_repeat_words"),
        F.size("__lines").cast("long").alias("__n_lines"))
    return df.withColumn("__base_failed", (F.col("__n_words") < 50) | (100 * F.col("__n_repeat_words") > 50 * F.col("__n_words")))


def rules() -> dict[str, Column]:
    """Which rules a row of ``statistics`` fails: too short, repeated words, one symbol in ten characters, three repeated lines in ten."""
    return {"dup_lines": 10 * F.col("__n_dup_lines") > 3 * F.col("__n_lines"), "repeats": 100 * F.col("__n_repeat_words") > 50 * F.col("__n_words"),
            "short": F.col("__n_words") < 50, "symbols": 10 * F.col("__n_symbols") > F.col("__word_chars")}


def prior(n: int, failed: float, hosts: int, squares: float) -> tuple[float, float]:
    """Mean and weight, in documents, of a rule's beta prior, by moments.

    The mean is that of all documents; the weight comes from the spread of the hosts' rates beyond what chance gives.  ``squares`` is
    the sum of failed * failed / n over the hosts.
    """
    if not n:
        return 0.0, MOST
    mean = failed / n
    chance = mean * (1 - mean)
    spread = squares / n - mean * mean - chance * hosts / n
    return mean, min(MOST, max(LEAST, chance / spread - 1)) if spread > 0 else MOST


def host_verdicts(rows: DataFrame, host: str) -> DataFrame:
    """host, n, failed rows, rate and rejected of each host, the last three by rule, and the names of the rules that reject it.

    Each rule has a prior of its own, and a host's rate by a rule is the mean of its posterior: hosts with few documents stay near
    the rate of all.  The lower bound takes the posterior's standard deviation.  A few sums for each rule are all that reaches the driver.
    """
    flags = rules()
    hosts = rows.groupBy(F.col(host).alias("host")).agg(F.count(F.lit(1)).alias("n"), *[F.sum(c.cast("long")).alias(f"{r}_failed") for r, c in flags.items()])
    f = lambda r: F.col(f"{r}_failed")
    sums = hosts.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("h"),
                     *[x for r in flags for x in (F.sum(f(r)).alias(f"{r}_f"), F.sum(f(r) * f(r) / F.col("n")).alias(f"{r}_q"))]).first()
    for r in flags:
        mean, weight = prior(sums["n"], sums[f"{r}_f"], sums["h"], sums[f"{r}_q"])
        rate, docs = F.col(f"{r}_rate"), F.col("n") + F.lit(weight)
        limit = max(LOW, min(HIGH, MULTIPLE * mean))
        hosts = hosts.withColumn(f"{r}_rate", (f(r) + F.lit(mean * weight)) / docs).withColumn(
            f"{r}_rejected", rate - DEVIATIONS * F.sqrt(rate * (1 - rate) / (docs + 1)) > limit)
    return hosts.withColumn("host_rules", F.array_join(F.filter(F.array(*[F.when(F.col(f"{r}_rejected"), F.lit(r)) for r in flags]), lambda x: x.isNotNull()), ","))


def judge(docs: DataFrame, host: str = "source") -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, host_rules of every row.

    A row is kept if it does not fail the base rules and no rule rejects its host; ``host_rules`` names the rules that do.  Null texts have no words and
    fail; rows without a host count as one host; rows that share a doc_id are judged one by one; an empty table
    gives no rows.  The statistics (a few numbers a row) are written once, as the hosts are counted from them
    and then joined back; a host with many rows is summed in each task first, and Spark splits it in the join.
    """
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    rows = cut_lineage(statistics(docs.select("doc_id", "text", F.col(host).alias("__host"))).drop("text"))
    verdicts = host_verdicts(rows, "__host").select("host", "host_rules")
    joined = rows.join(verdicts, F.col("__host").eqNullSafe(F.col("host")), "left")
    return joined.select("doc_id", *[F.col(f"__{n}").alias(n) for n in names], (~F.col("__base_failed") & (F.col("host_rules") == "")).alias("kept"), "host_rules")


#: The same question in SQL.
SQL = r"""
WITH w AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM g) WHERE n > 1),
covered AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY r),
l AS (SELECT r, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM w),
s AS (SELECT w.r, doc_id, source, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
             (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
             (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, len(l) AS n_lines, coalesce(n, 0)::BIGINT AS n_repeat_words
      FROM w JOIN l ON l.r = w.r LEFT JOIN covered c ON c.r = w.r),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM s),
u AS (SELECT source, unnest(['dup_lines', 'repeats', 'short', 'symbols']) AS rule,
             unnest([10 * n_dup_lines > 3 * n_lines, 100 * n_repeat_words > 50 * n_words, n_words < 50, 10 * n_symbols > word_chars])::INT AS f FROM b),
h AS (SELECT source, rule, count(*) AS n, sum(f) AS f FROM u GROUP BY source, rule),
a AS (SELECT rule, sum(f) / sum(n) AS m, sum(f * f / n) / sum(n) AS q, count(*) / sum(n) AS hn FROM h GROUP BY rule),
p AS (SELECT rule, m, q - m * m - m * (1 - m) * hn AS v FROM a),
k AS (SELECT rule, m, CASE WHEN v > 0 THEN least(1e6, greatest(1.0, m * (1 - m) / v - 1)) ELSE 1e6 END AS s FROM p),
x AS (SELECT source, rule, m, (f + m * s) / (n + s) AS rate, n + s AS docs FROM h JOIN k USING (rule)),
j AS (SELECT source, string_agg(rule, ',' ORDER BY rule) AS rules FROM x WHERE rate - 3 * sqrt(rate * (1 - rate) / (docs + 1)) > greatest(0.2, least(0.5, 2 * m)) GROUP BY source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND rules IS NULL AS kept, coalesce(rules, '') AS host_rules
FROM b LEFT JOIN j ON j.source IS NOT DISTINCT FROM b.source
"""
