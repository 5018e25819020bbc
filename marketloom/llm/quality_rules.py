"""Quality rules as a bitmask ledger.

Every rule is evaluated once for each document. The ledger keeps what was measured and one failure bit for each rule.
A policy is a versioned set of bits that reject; applying another policy, or asking what a policy would keep without one
of its rules, is bitwise arithmetic on the ledger and never looks at a text again.

Only DataFrame functions: the plan has no Python and no shuffle.

Defined cases. A null text is an empty text: no words, fails MIN_WORDS. Words are runs of anything but code points 0x20 and
0x09-0x0D. Repeated rows give repeated ledger rows, and so do rows with null ids, which are judged like
any other. Very long texts are judged whole, a row at a time. Nothing is ranked, so there are no ties. Extra columns of the input are not read (keep passes all columns on). An empty table gives an empty
ledger. An 8-word window is recognised by the 64-bit hash of its words.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import BLANKS, table, text_or_empty

WINDOW = 8

#: Rule name -> failure condition over the measured columns. The bit of a rule is its place here; append, never reorder.
RULES: dict[str, str] = {
    "min_words": "n_words < 20",
    "repeated_windows": "100 * n_repeat_words > 30 * n_words",
    "symbol_density": "10 * n_symbols > 3 * n_words",
    "duplicate_lines": "n_lines >= 5 AND 10 * n_dup_lines > 5 * n_lines",
    "long_words": "word_chars > 40 * n_words",
    "exclamation": "10 * n_bangs > 3 * n_words",
}

BASE = ("min_words", "repeated_windows")


def bit(rule: str) -> int:
    return 1 << list(RULES).index(rule)


@dataclass(frozen=True)
class Policy:
    """A named, versioned choice of rejecting rules."""

    version: int
    rejects: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(bit(r) for r in self.rejects)


POLICIES = {p.version: p for p in (Policy(1, BASE), Policy(2, tuple(RULES)))}
CURRENT = POLICIES[2]


def _let(value: Column, body) -> Column:
    """body(value) with value computed once: bound as the variable of a one-element transform."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _covered(hashes: Column) -> Column:
    """Words under windows whose hash occurs twice or more; hashes[i] is the window that starts at word i."""

    def marked(order: Column) -> Column:
        same = lambda other, me: F.coalesce(other["h"] == me["h"], F.lit(False))
        twice = F.filter(order, lambda x, k: same(F.get(order, k - 1), x) | same(F.get(order, k + 1), x))
        return _let(F.sort_array(F.transform(twice, lambda x: x["i"])), spans)

    def spans(starts: Column) -> Column:
        steps = F.transform(starts, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, k + 1) - x, F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda total, x: total + x)

    def either(h: Column) -> Column:
        order = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(_let(order, marked))

    return _let(hashes, either)


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with the measured columns beside its own (which must not carry their names).

    All measurements of a row are one struct, laid out by a generator: filters on them can't be pushed below it, which would
    compute them twice, and the words of a text are split once.
    """
    body = text_or_empty(text)
    trimmed = F.btrim(body, F.lit(BLANKS))
    split = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    def of_words(words: Column) -> Column:
        n = F.size(words)
        windows = F.when(n > WINDOW, F.transform(F.sequence(F.lit(1), F.greatest(n - (WINDOW - 1), F.lit(1))), lambda i: F.xxhash64(F.slice(words, i, WINDOW))))
        return F.struct(
            n.cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            F.regexp_count(body, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
            F.regexp_count(body, F.lit("!!")).cast("long").alias("n_bangs"),
            _let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup"))).alias("lines"),
            F.coalesce(_covered(windows), F.lit(0)).cast("long").alias("n_repeat_words"),
        )

    rows = docs.select("*", F.inline(F.array(_let(split, of_words))))
    return rows.withColumns({"n_lines": F.col("lines.n"), "n_dup_lines": F.col("lines.dup")}).drop("lines")


def ledger(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, measurements, failed_bits): every rule evaluated once for every row."""
    measured = measure(docs.select(key, text), text)
    bits = sum((F.when(F.expr(condition), F.lit(bit(name))).otherwise(F.lit(0)) for name, condition in RULES.items()), F.lit(0))
    return measured.withColumn("failed_bits", bits.cast("int")).drop(text)


def apply_policy(rows: DataFrame, policy: Policy = CURRENT) -> DataFrame:
    """Ledger rows with kept and the version that decided."""
    return rows.withColumns({"kept": F.col("failed_bits").bitwiseAND(F.lit(policy.mask)) == 0, "policy_version": F.lit(policy.version)})


def ablations(rows: DataFrame, policy: Policy = CURRENT) -> DataFrame:
    """For each rule of a policy: rows it fails, rows only it fails, and rows kept with and without it.

    One aggregation over the ledger with a partial sum in every task.
    """
    failed = F.col("failed_bits").bitwiseAND(F.lit(policy.mask))
    aggs = [F.count_if(failed == 0).alias("kept")]
    for name in policy.rejects:
        aggs += [F.count_if(failed.bitwiseAND(F.lit(bit(name))) != 0).alias(f"fails_{name}"), F.count_if(failed == bit(name)).alias(f"only_{name}")]
    wide = rows.agg(*aggs)
    per_rule = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(f"fails_{n}").alias("n_failed"), F.col(f"only_{n}").alias("n_only"), F.col("kept").alias("kept_with"), (F.col("kept") + F.col(f"only_{n}")).alias("kept_without")) for n in policy.rejects])
    return wide.select(F.explode(per_rule).alias("r")).select("r.*")


def keep(docs: DataFrame, policy: Policy = CURRENT, text: str = "text") -> DataFrame:
    """The rows of docs that a policy keeps, with the columns of docs."""
    columns = docs.columns
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("__row"), F.col(f"`{text}`").alias("__text"))
    failed = sum((F.when(F.expr(RULES[name]), F.lit(bit(name))).otherwise(F.lit(0)) for name in policy.rejects), F.lit(0))
    return measure(held, "__text").filter(failed == 0).select("__row.*")


def op10_quality_rules(spark, sf_dir: str) -> DataFrame:
    rows = apply_policy(ledger(table(spark, sf_dir, "documents")))
    base = F.col("failed_bits").bitwiseAND(F.lit(sum(bit(r) for r in BASE))) != 0
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), "kept", "failed_bits", "policy_version")


OP10_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS body FROM documents
), w AS (
  SELECT r, doc_id, body, list_filter(string_split_regex(body, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
         list_filter(string_split(body, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d
), m AS (
  SELECT r, doc_id, len(words)::BIGINT AS n_words, coalesce(length(array_to_string(words, '')), 0)::BIGINT AS word_chars,
         (length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         ((length(body) - length(replace(body, '!!', ''))) // 2)::BIGINT AS n_bangs,
         len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, words FROM w
), p AS (
  SELECT r, unnest(range(1, greatest(len(words) - 6, 1)::BIGINT)) AS i, words FROM m WHERE len(words) > 8
), h AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, array_to_string(words[i:i+7], ' ')) AS c FROM p
), s AS (
  SELECT r, sum(least(8, coalesce(nxt - i, 8)))::BIGINT AS n_repeat_words
  FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nxt FROM h WHERE c > 1) GROUP BY r
), q AS (
  SELECT m.*, coalesce(s.n_repeat_words, 0)::BIGINT AS n_repeat_words FROM m LEFT JOIN s USING (r)
), f AS (
  SELECT *, ((n_words < 20)::INT + 2 * (100 * n_repeat_words > 30 * n_words)::INT + 4 * (10 * n_symbols > 3 * n_words)::INT
    + 8 * (n_lines >= 5 AND 10 * n_dup_lines > 5 * n_lines)::INT + 16 * (word_chars > 40 * n_words)::INT
    + 32 * (10 * n_bangs > 3 * n_words)::INT)::INT AS failed_bits FROM q
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (failed_bits & 3) <> 0 AS base_failed,
       failed_bits = 0 AS kept, failed_bits, 2::INT AS policy_version FROM f
"""
