"""Operator 1, quality rules: a ledger of rule bits and measurements, and policies over it.

Every rule runs once per document. The ledger row keeps the measurements and one failure
bit per rule; policies are versioned masks over the bits, so changing a policy, or asking
what one rule alone rejects, never reads a text again. The ledger is row-local DataFrame
expressions: one scan, no Python on the executors. The query writes it once and takes from
it the verdicts of all policies and the ablation, whose counts (bitwise sums over bit
patterns) stand beside each document that one rule alone rejects.

Defined cases: a null or empty text has no words and fails ``few_words``; repeated rows
and repeated ids are judged row by row; extra columns pass through ``ledger`` unless they
carry the name of a ledger column, which is then replaced; an empty table gives an empty
ledger. Texts are read whole, however long.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkplate.llm.common import documents, let, materialise, words

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
            "n_letters", "n_upper")

#: Rules in bit order: name and the condition over the measurements that fails it.
#: Integer arithmetic only, so a verdict never depends on rounding. Append, never reorder.
RULES = (
    ("few_words", lambda m: m["n_words"] < 50),
    ("repeated_words", lambda m: 100 * m["n_repeat_words"] > 50 * m["n_words"]),
    ("symbols", lambda m: 10 * m["n_symbols"] > m["n_words"]),
    ("repeated_lines", lambda m: 100 * m["n_dup_lines"] > 50 * m["n_lines"]),
    ("word_length", lambda m: (m["word_chars"] < 2 * m["n_words"]) | (m["word_chars"] > 14 * m["n_words"])),
    ("capitals", lambda m: 100 * m["n_upper"] > 50 * m["n_letters"]),
    ("few_letters", lambda m: 100 * m["n_letters"] < 50 * m["word_chars"]),
)
BIT = {name: 1 << i for i, (name, _) in enumerate(RULES)}

#: Versioned policies: a document is rejected when any rule of the policy fails.
POLICIES = {
    "base-1": ("few_words", "repeated_words"),
    "web-1": ("few_words", "repeated_words", "symbols", "capitals"),
    "web-2": ("few_words", "repeated_words", "symbols", "repeated_lines", "word_length",
              "capitals", "few_letters"),
}


def mask(policy: str) -> int:
    return sum(BIT[r] for r in POLICIES[policy])


def _repeated_words(w: Column) -> Column:
    """Words inside 3-word windows that occur twice or more, each word counted once.

    Windows are compared as 64-bit hashes of three words within one text. Without a
    repeated window (a hash-set test) the rest is skipped; else equal windows meet by
    sorting (hash, position), and each repeated window covers three words, less what the
    next repeated one covers itself.
    """
    def windows(w: Column) -> Column:
        return F.transform(F.slice(w, 1, F.greatest(F.size(w) - 2, F.lit(0))),
                           lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))

    def covered(h: Column) -> Column:
        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p"))))
        repeated = let(ordered, lambda s: F.sort_array(F.transform(
            F.filter(s, lambda x, i: x["h"].eqNullSafe(F.get(s, i - 1)["h"])
                     | x["h"].eqNullSafe(F.get(s, i + 1)["h"])), lambda x: x["p"])))
        return let(repeated, lambda p: F.aggregate(
            F.transform(p, lambda x, i: F.least(F.coalesce(F.get(p, i + 1) - x, F.lit(3)), F.lit(3))),
            F.lit(0).cast("bigint"), lambda a, x: a + x))

    return let(w, lambda w: let(windows(w), lambda h: F.when(
        F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("bigint")).otherwise(covered(h))))


def _measure(text: Column) -> Column:
    """One struct with every measurement of a text."""
    def count(pattern: str, t: Column) -> Column:
        return (F.length(t) - F.length(F.regexp_replace(t, pattern, ""))).cast("bigint")

    def of(t: Column, w: Column) -> Column:
        lines = F.filter(F.split(t, "\n"), lambda x: F.length(F.btrim(x, F.lit(" \t\x0b\f\r"))) > 0)
        return let(lines, lambda ls: F.struct(
            F.size(w).cast("bigint").alias("n_words"),
            F.length(F.array_join(w, "")).cast("bigint").alias("word_chars"),
            count(r"[#*$%&|<>]", t).alias("n_symbols"),
            F.size(ls).cast("bigint").alias("n_lines"),
            (F.size(ls) - F.size(F.array_distinct(ls))).cast("bigint").alias("n_dup_lines"),
            _repeated_words(w).alias("n_repeat_words"),
            count(r"\p{L}+", t).alias("n_letters"),
            count(r"\p{Lu}+", t).alias("n_upper"),
        ))

    return let(F.coalesce(text, F.lit("")), lambda t: let(words(t), lambda w: of(t, w)))


def _fail_bits(m: Column) -> Column:
    return sum((F.when(failed(m), F.lit(BIT[name])).otherwise(F.lit(0)) for name, failed in RULES),
               F.lit(0)).cast("bigint")


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without the text, plus the measurements and ``fail_bits``."""
    own = [c for c in docs.columns if c != text and c not in (*MEASURES, "fail_bits")]
    measured = docs.select(*own, _measure(F.col(text)).alias("_measured"))
    m = F.col("_measured")
    return measured.select(*own, *[m[x].alias(x) for x in MEASURES], _fail_bits(m).alias("fail_bits"))


def judge(led: DataFrame, policy: str) -> DataFrame:
    """Apply a policy version to a ledger: ``kept`` and the bits that decided it."""
    hit = F.col("fail_bits").bitwiseAND(F.lit(mask(policy)))
    return led.withColumn("policy_bits", hit).withColumn("kept", hit == 0)


def ablation(led: DataFrame, policy: str) -> DataFrame:
    """Per rule of a policy: documents it fails, fails alone, and kept without it.

    Counts per bit pattern first (at most 2^rules rows leave the tasks), then bitwise sums
    over the patterns.
    """
    m = mask(policy)
    patterns = (led.groupBy(F.col("fail_bits").bitwiseAND(F.lit(m)).alias("bits"))
                .agg(F.count("*").alias("n")))
    rules = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(BIT[r]).cast("bigint").alias("bit"))
                      for r in POLICIES[policy]])
    each = patterns.select("bits", "n", F.explode(rules).alias("r")).select("bits", "n", "r.*")

    def total(cond: Column) -> Column:
        return F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0)).cast("bigint")

    return each.groupBy("rule").agg(
        total(F.col("bits").bitwiseAND(F.col("bit")) != 0).alias("failed"),
        total(F.col("bits") == F.col("bit")).alias("failed_alone"),
        total(F.col("bits").bitwiseAND(F.bitwise_not(F.col("bit"))) == 0).alias("kept_without"),
    )


def sole_rule(policy_bits: Column, policy: str) -> Column:
    """Name of the rule that alone rejects a document under a policy, else null."""
    return F.coalesce(*[F.when(policy_bits == BIT[r], F.lit(r)) for r in POLICIES[policy]])


POLICY = "web-2"


def keep_good(docs: DataFrame, policy: str = POLICY) -> DataFrame:
    """The rows of ``docs`` that the policy keeps, with their columns unchanged."""
    bits = let(_measure(F.col("text")), _fail_bits)
    return docs.where(bits.bitwiseAND(F.lit(mask(policy))) == 0)


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    led = materialise(ledger(documents(spark, sf_dir).select("doc_id", "text")), "ledger")
    verdicts = [(F.col("fail_bits").bitwiseAND(F.lit(mask(p))) == 0).alias("kept_" + p.replace("-", "_")) for p in POLICIES]
    judged = judge(led, POLICY).select("*", *verdicts, sole_rule(F.col("policy_bits"), POLICY).alias("sole_rule"))
    # at most one row per rule
    without = F.broadcast(ablation(led, POLICY).select(F.col("rule").alias("sole_rule"), F.col("failed").alias("rule_failed"),
                                                       F.col("failed_alone").alias("rule_failed_alone"),
                                                       F.col("kept_without").alias("kept_without_rule")))
    return judged.join(without, "sole_rule", "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~F.col("kept_base_1")).alias("base_failed"), "kept", "fail_bits", *["kept_" + p.replace("-", "_") for p in POLICIES],
        "sole_rule", "rule_failed", "rule_failed_alone", "kept_without_rule")


# The twin derives everything on its own; a window is compared as text here.
ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3)),
rep AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win) WHERE c > 1),
cov AS (
  SELECT doc_id, count(DISTINCT i + k) AS n
  FROM rep, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id),
lin AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT l) AS dup
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM d)
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY doc_id),
m AS (
  SELECT d.doc_id, len(w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         length(t) - length(regexp_replace(t, '\p{L}', '', 'g')) AS n_letters,
         length(t) - length(regexp_replace(t, '\p{Lu}', '', 'g')) AS n_upper,
         coalesce(n_lines, 0) AS n_lines, coalesce(dup, 0) AS n_dup_lines, coalesce(cov.n, 0) AS n_repeat_words
  FROM d LEFT JOIN lin USING (doc_id) LEFT JOIN cov USING (doc_id)),
b AS (
  SELECT *, (CASE WHEN n_words < 50 THEN 1 ELSE 0 END) + (CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END)
    + (CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END) + (CASE WHEN 100 * n_dup_lines > 50 * n_lines THEN 8 ELSE 0 END)
    + (CASE WHEN word_chars < 2 * n_words OR word_chars > 14 * n_words THEN 16 ELSE 0 END)
    + (CASE WHEN 100 * n_upper > 50 * n_letters THEN 32 ELSE 0 END)
    + (CASE WHEN 100 * n_letters < 50 * word_chars THEN 64 ELSE 0 END) AS bits FROM m),
r(rule, bit) AS (
  VALUES ('few_words', 1), ('repeated_words', 2), ('symbols', 4), ('repeated_lines', 8), ('word_length', 16),
         ('capitals', 32), ('few_letters', 64)),
a AS (
  SELECT rule, bit, count(*) FILTER (WHERE bits & bit <> 0) AS failed, count(*) FILTER (WHERE bits = bit) AS alone,
         count(*) FILTER (WHERE bits = 0 OR bits = bit) AS without FROM b, r GROUP BY rule, bit)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, bits = 0 AS kept, bits::BIGINT AS fail_bits,
       bits & 3 = 0 AS kept_base_1, bits & 39 = 0 AS kept_web_1, bits = 0 AS kept_web_2,
       rule AS sole_rule, failed::BIGINT AS rule_failed, alone::BIGINT AS rule_failed_alone, without::BIGINT AS kept_without_rule
FROM b LEFT JOIN a ON bits = bit
"""
