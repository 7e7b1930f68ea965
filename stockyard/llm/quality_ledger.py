"""Quality rules as a bitmask ledger (native: DataFrame functions only).

`ledger` evaluates every rule once and stores the measurements and one failure bit per rule. A policy is a named,
versioned set of rules; `apply_policy` compares its mask with the stored bits, so a new policy needs no second look at
the texts. `ablations` counts, by bitwise aggregation, what each rule of a policy removes alone.

Null and empty texts have no words and fail `few_words`. Repeated rows are judged one by one. Extra columns are ignored.
Windows are matched by hash and confirmed on their words.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import restored, texts

SPACE = r"[ \x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"

#: Rule name -> condition on the measurements under which a document fails; the position is the bit.
RULES: dict[str, str] = {
    "few_words": "n_words < 50",
    "repeated_windows": "100 * n_repeat_words > 50 * n_words",
    "many_words": "n_words > 1000000",
    "word_length": "word_chars < 2 * n_words OR word_chars > 15 * n_words",
    "symbols": "10 * n_symbols > 3 * n_words",
    "repeated_lines": "10 * n_dup_lines > 3 * n_lines",
}


@dataclass(frozen=True)
class Policy:
    name: str
    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(1 << list(RULES).index(r) for r in self.rules)


BASE = Policy("base", 1, ("few_words", "repeated_windows"))
STANDARD = Policy("standard", 1, tuple(RULES))


def measurements(docs: DataFrame) -> DataFrame:
    """doc_id and n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words."""
    df = texts(docs).select(
        "doc_id",
        F.array_remove(F.split("text", SPACE), "").alias("w"),
        F.length(F.regexp_replace("text", SPACE, "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.regexp_replace("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^ \x09-\x0D]")).alias("lines"),
    )
    df = df.select(
        "doc_id", "word_chars", "n_symbols", "w", F.size("w").alias("n"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
    )
    # One hash per window of three words; a document whose hashes all differ repeats nothing.
    df = df.withColumn(
        "h",
        F.expr("CASE WHEN n >= 3 THEN transform(sequence(0, n - 3), i -> xxhash64(w[i], w[i + 1], w[i + 2])) ELSE array() END"),
    ).withColumn("some", F.size(F.array_distinct("h")) < F.size("h"))
    # Hash and place in one integer: the upper bits keep equal windows adjacent after sorting, the lower bits give the place.
    df = df.withColumn("b", F.expr("CAST(ceil(log2(n + 1)) AS INT)")).withColumn(
        "s", F.expr("CASE WHEN some THEN sort_array(transform(h, (x, i) -> shiftleft(x, b) | i)) ELSE array() END")
    )
    same = "shiftrightunsigned(s[{0}], b) = shiftrightunsigned(s[{1}], b) AND {2}"
    place = "CAST(s[{0}] & (shiftleft(1L, b) - 1) AS INT)"
    words = " AND ".join(f"w[{place.format('{0}')} + {j}] = w[{place.format('{1}')} + {j}]" for j in range(3))
    pair = lambda a, b: same.format(a, b, words.format(a, b))
    df = df.withColumn(
        "q",
        F.expr(
            "CASE WHEN some THEN sort_array(transform(filter(sequence(0, size(s) - 1), k -> "
            f"(CASE WHEN k > 0 THEN {pair('k', 'k - 1')} ELSE false END) OR (CASE WHEN k < size(s) - 1 THEN {pair('k', 'k + 1')} ELSE false END)), "
            f"k -> {place.format('k')})) ELSE array() END"
        ),
    )
    covered = "CASE WHEN size(q) = 0 THEN 0 WHEN size(q) = 1 THEN 3 ELSE 3 + aggregate(sequence(1, size(q) - 1), 0, (a, k) -> a + least(3, q[k] - q[k - 1])) END"
    # A column that is not deterministic keeps later filters above this point; pushed below, they would repeat the work.
    repeated = F.when(F.monotonically_increasing_id() >= 0, F.expr(covered)).otherwise(0)
    return restored(df).select("doc_id", F.col("n").cast("long").alias("n_words"), "word_chars", "n_symbols", "n_lines", "n_dup_lines", repeated.cast("long").alias("n_repeat_words"))


def ledger(docs: DataFrame) -> DataFrame:
    """The measurements with `fail_bits` (long): bit k is set if the k-th rule of RULES fails."""
    bits: Column = F.lit(0).cast("long")
    for k, condition in enumerate(RULES.values()):
        bits = bits.bitwiseOR(F.when(F.expr(condition), F.lit(1 << k)).otherwise(F.lit(0)).cast("long"))
    return measurements(docs).withColumn("fail_bits", bits)


def apply_policy(entries: DataFrame, policy: Policy, verdict: str = "kept") -> DataFrame:
    """Adds a boolean: no rule of the policy failed."""
    return entries.withColumn(verdict, F.col("fail_bits").bitwiseAND(F.lit(policy.mask).cast("long")) == 0)


def ablations(entries: DataFrame, policy: Policy) -> DataFrame:
    """Per rule of the policy: documents that fail it, that only it removes, and that stay if it is left out.

    One aggregation of the stored bits; at most 2^rules partial rows leave a task.
    """
    failed = entries.select(F.col("fail_bits").bitwiseAND(F.lit(policy.mask).cast("long")).alias("bits")).groupBy("bits").agg(F.count(F.lit(1)).alias("n"))
    rules = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(1 << list(RULES).index(r)).cast("long").alias("bit")) for r in policy.rules]))
    rows = failed.select("bits", "n", rules.alias("r")).select("bits", "n", "r.*")
    count = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0)).cast("long")
    return rows.groupBy("rule").agg(
        count(F.col("bits").bitwiseAND(F.col("bit")) != 0).alias("n_failed"),
        count(F.col("bits") == F.col("bit")).alias("n_only"),
        count(F.col("bits").bitwiseAND(F.bitwise_not("bit")) == 0).alias("n_kept_without"),
    ).withColumns({"policy": F.lit(policy.name), "version": F.lit(policy.version)})


def query(spark, sf_dir: str) -> DataFrame:
    from .common import read

    entries = apply_policy(apply_policy(ledger(read(spark, sf_dir, "documents")), BASE, "base_kept"), STANDARD)
    return entries.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~F.col("base_kept")).alias("base_failed"), "kept", "fail_bits",
    )


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS r FROM documents),
w AS (SELECT r, doc_id, text, list_filter(string_split_regex(text, '[ \x09-\x0D]+'), lambda x: x <> '') AS words,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^ \x09-\x0D]')) AS lines FROM d),
t AS (SELECT r, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS win
      FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM w WHERE len(words) >= 3)),
rep AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS c FROM t) WHERE c >= 2),
cov AS (SELECT r, count(*) AS n FROM (SELECT DISTINCT r, i + j AS p FROM rep, (SELECT unnest([0, 1, 2]) AS j)) GROUP BY r),
m AS (SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
        CAST(length(regexp_replace(text, '[ \x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
        CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
        CAST(len(lines) AS BIGINT) AS n_lines, CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words
      FROM w LEFT JOIN cov USING (r)),
b AS (SELECT *, CASE WHEN n_words < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
        + CASE WHEN n_words > 1000000 THEN 4 ELSE 0 END + CASE WHEN word_chars < 2 * n_words OR word_chars > 15 * n_words THEN 8 ELSE 0 END
        + CASE WHEN 10 * n_symbols > 3 * n_words THEN 16 ELSE 0 END + CASE WHEN 10 * n_dup_lines > 3 * n_lines THEN 32 ELSE 0 END AS fb FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, fb % 4 <> 0 AS base_failed, fb = 0 AS kept,
       CAST(fb AS BIGINT) AS fail_bits FROM b
"""
