"""Quality rules: a ledger of measurements and failure bits, policies as masks over it, ablations by bit counts.

Every rule is evaluated once per document into one bit of `failed`. A policy is a versioned set of rules; applying or
changing it only reads the ledger. Everything is a DataFrame expression: no shuffle, no Python.

Defined cases: a null text counts as empty and has no words; an empty text fails `few_words`; very long texts are
measured whole; repeated rows and null ids are judged row by row; an empty table gives no rows. Only doc_id and text are
read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, text_of

SYMBOLS = "#*$%&|<>"
WINDOW = 8
BASE = ("few_words", "repeated_windows")

# name -> condition under which a document fails; the order gives the bits and is only ever appended to
RULES: dict[str, str] = {
    "few_words": "n_words < 20",
    "repeated_windows": "100 * n_repeat_words > 30 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "repeated_lines": "2 * n_dup_lines > n_lines",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 15 * n_words",
    "shouting": "10 * n_shouts > n_words",
}

# version -> rules that reject
POLICIES: dict[str, tuple[str, ...]] = {
    "base-1": BASE,
    "web-1": tuple(RULES),
}
POLICY = "web-1"


def bit(rule: str) -> int:
    return 1 << list(RULES).index(rule)


def mask(policy: str) -> int:
    return sum(bit(r) for r in POLICIES[policy])


def _without(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and the measurements that the rules read."""
    text = text_of()
    split = docs.select(
        "doc_id",
        F.filter(F.split(text, "[ \\x09-\\x0D]+"), lambda w: w != "").alias("words"),
        F.filter(F.split(text, "\n"), lambda l: F.translate(l, BLANKS, "") != "").alias("lines"),
        F.length(F.translate(text, BLANKS, "")).cast("long").alias("word_chars"),
        _without(text, SYMBOLS).cast("long").alias("n_symbols"),
        F.floor((F.length(text) - F.length(F.replace(text, F.lit("!!"), F.lit("")))) / 2).cast("long").alias("n_shouts"),
    )
    # a window of words is named by a 64-bit hash of its words' hashes; one slice per window start
    hashed = split.select(
        "doc_id",
        "word_chars",
        "n_symbols",
        "n_shouts",
        F.size("words").cast("long").alias("n_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.expr(
            f"CASE WHEN size(words) > {WINDOW} THEN transform(sequence(1, size(words) - {WINDOW - 1}),"
            f" i -> xxhash64(slice(words, i, {WINDOW}))) ELSE array() END"
        ).alias("windows"),
    )
    # most texts repeat no window: only the others sort theirs
    paired = hashed.withColumn(
        "sorted",
        F.expr(
            "CASE WHEN size(array_distinct(windows)) < size(windows)"
            " THEN sort_array(transform(windows, (h, i) -> struct(h, i))) ELSE array() END"
        ),
    ).drop("windows")
    starts = paired.withColumn(
        "starts",
        F.expr(
            "sort_array(transform(filter(sorted, (x, i) -> coalesce(get(sorted, i - 1).h = x.h, false)"
            " OR coalesce(get(sorted, i + 1).h = x.h, false)), x -> x.i))"
        ),
    ).drop("sorted")
    covered = F.expr(
        f"aggregate(transform(starts, (p, i) -> least({WINDOW}, coalesce(get(starts, i + 1) - p, {WINDOW}))), 0L, (a, x) -> a + x)"
    )
    return starts.withColumn("n_repeat_words", covered).drop("starts")


def ledger(docs: DataFrame) -> DataFrame:
    """doc_id, measurements and `failed`, the bits of the rules that the document fails."""
    failed = F.lit(0).cast("long")
    for rule, condition in RULES.items():
        failed = failed + F.when(F.expr(condition), F.lit(bit(rule))).otherwise(0)
    return measured(docs).withColumn("failed", failed)


def judged(book: DataFrame, policy: str = POLICY) -> DataFrame:
    """Ledger rows with base_failed and kept under a policy; base rules always reject."""
    base = mask("base-1")
    return book.withColumn("base_failed", F.col("failed").bitwiseAND(base) != 0).withColumn(
        "kept", F.col("failed").bitwiseAND(base | mask(policy)) == 0
    )


def ablations(book: DataFrame, policy: str = POLICY) -> DataFrame:
    """Per rule of the policy: documents failing it, and documents that only this rule rejects (kept without it).

    One aggregate over the ledger; the rows out are the rules.
    """
    held = F.col("failed").bitwiseAND(mask(policy))
    counts = [F.count_if(held.bitwiseAND(bit(r)) != 0).alias(f"f_{r}") for r in POLICIES[policy]]
    alone = [F.count_if(held == bit(r)).alias(f"o_{r}") for r in POLICIES[policy]]
    wide = book.agg(F.count("*").alias("n_docs"), F.bit_or(held).alias("seen"), *counts, *alone)
    rows = F.array(
        *[
            F.struct(F.lit(r).alias("rule"), F.col(f"f_{r}").alias("n_failed"), F.col(f"o_{r}").alias("n_only"))
            for r in POLICIES[policy]
        ]
    )
    return wide.select(F.lit(policy).alias("policy"), "n_docs", F.explode(rows).alias("r")).select(
        "policy", "n_docs", "r.*"
    )


def quality(docs: DataFrame, policy: str = POLICY) -> DataFrame:
    return judged(ledger(docs), policy).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "n_lines",
        "n_shouts",
        "failed",
    )


def accepted(docs: DataFrame, policy: str = POLICY) -> DataFrame:
    """The documents that a policy keeps, in their own columns. Row by row: no join back to the text."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    carried = docs.select(row.alias("doc_id"), "text")  # the whole row travels where the ledger has the id
    # a row number keeps the filter above the ledger: pushed below it, every use of a measurement would compute it anew
    book = ledger(carried).withColumn("row_no", F.monotonically_increasing_id())
    return judged(book, policy).where("kept AND row_no >= 0").select("doc_id.*")


ORACLE = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws,
             [x FOR x IN string_split(text, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS ls FROM t),
win AS (SELECT doc_id, i, list_slice(ws, i, i + 7) AS k FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM w)),
dup AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, k) AS c FROM win) WHERE c > 1),
cov AS (SELECT doc_id, sum(least(8, coalesce(nx - i, 8))) AS n
        FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nx FROM dup) GROUP BY doc_id),
m AS (SELECT w.doc_id, len(ws)::BIGINT AS n_words,
             length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
             (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words,
             len(ls)::BIGINT AS n_lines, len(regexp_extract_all(text, '!!'))::BIGINT AS n_shouts
      FROM w LEFT JOIN cov ON w.doc_id = cov.doc_id),
j AS (SELECT *, (CASE WHEN n_words < 20 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END
             + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END + CASE WHEN 2 * n_dup_lines > n_lines THEN 8 ELSE 0 END
             + CASE WHEN word_chars < 2 * n_words THEN 16 ELSE 0 END + CASE WHEN word_chars > 15 * n_words THEN 32 ELSE 0 END
             + CASE WHEN 10 * n_shouts > n_words THEN 64 ELSE 0 END)::BIGINT AS failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed, failed = 0 AS kept, n_lines, n_shouts, failed
FROM j
"""
