"""Quality rules as a short-circuit cascade, ordered by rejection per cost.

Rules are boolean columns over the text. On a sample of bounded size each
rule is timed and its rejections are counted; then the rule with the most
rejections per second comes first, and the next is chosen in the same way
from the rows that the rules before it let through. The cascade is one CASE
expression, so a row that one rule rejects is not read by the later ones. The
order changes the cost, never the verdict.

Null and empty texts have no words; such rows fail the base rules. A text of
any length is read whole. Repeated rows are judged each on its own. Columns of
the same names are replaced.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playerflow.llm.native import BLANK, blank_words, covered, let, repeated_positions
from playerflow.llm.registry import query, table
from playerflow.llm.sampling import sample_rows
from playerflow.session import written

SYMBOLS = "[#*$%&|<>]"
WINDOW = 5
#: Rows, about, of the sample on which cost and selectivity are estimated.
SAMPLE_ROWS = 2_000


def window_keys(words: Column, width: int) -> Column:
    """One 64-bit key per window of ``width`` words; none for fewer words."""
    keys = F.transform(words, lambda w: F.xxhash64(w))
    return let(keys, lambda k: F.transform(
        F.slice(k, F.lit(1), F.greatest(F.size(k) - (width - 1), F.lit(0))),
        lambda _, i: F.xxhash64(*[F.get(k, i + j) for j in range(width)]),
    ))


def n_words(text: Column) -> Column:
    return F.size(blank_words(text)).cast("long")


def word_chars(text: Column) -> Column:
    return F.length(F.regexp_replace(text, f"[{BLANK}]+", "")).cast("long")


def n_symbols(text: Column) -> Column:
    return F.regexp_count(text, F.lit(SYMBOLS)).cast("long")


def n_dup_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(f"[^{BLANK}]"))
    return let(lines, lambda a: (F.size(a) - F.size(F.array_distinct(a))).cast("long"))


def n_repeat_words(words: Column) -> Column:
    """Words inside windows that the text holds twice or more, the first included."""
    return covered(let(window_keys(words, WINDOW), repeated_positions), WINDOW)


@dataclass(frozen=True)
class Rule:
    """``rejects`` is true for a text that has to go."""

    name: str
    rejects: Column


def base_rule(text: Column) -> Column:
    return let(blank_words(text), lambda w: (F.size(w) < 10) | (100 * n_repeat_words(w) > 20 * F.size(w)))


def rules(text: Column) -> list[Rule]:
    """The rules of the method; thresholds leave ordinary prose in any script or case alone."""
    words = F.greatest(n_words(text), F.lit(1))
    capitals, letters = F.regexp_count(text, F.lit(r"\p{Lu}")), F.regexp_count(text, F.lit(r"\p{Ll}"))
    return [
        Rule("symbols", n_symbols(text) * 100 > 50 * words),
        Rule("table", F.regexp_count(text, F.lit(r"(?<![^\x20\x09-\x0D])\|(?![^\x20\x09-\x0D])")) * 100 > 25 * words),
        Rule("shouting", let(F.struct(capitals.alias("u"), letters.alias("l")), lambda c: (c["u"] >= 20) & (c["u"] > 2 * c["l"]))),
        Rule("marks", F.regexp_count(text, F.lit(r"[!?]{2,}")) * 100 > 20 * words),
        Rule("long_words", word_chars(text) > 40 * words),
        Rule("repeated_lines", let(F.size(F.filter(F.split(text, "\n", -1), lambda line: line.rlike(f"[^{BLANK}]"))), lambda n: (n >= 4) & (2 * n_dup_lines(text) > n))),
    ]


def order_rules(df: DataFrame, text: str, candidates: list[Rule], rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Rules by rejection per second on a sample of about ``rows`` rows; the rules read ``text``."""
    sample = written(sample_rows(df, rows, *df.columns).select(text), "rule-sample")
    flags = [F.coalesce(r.rejects, F.lit(False)) for r in candidates]
    patterns = sample.groupBy(F.array(*flags).alias("flags")).count().collect()
    costs = []
    for flag in flags:
        start = time.perf_counter()
        sample.agg(F.count_if(flag)).collect()
        costs.append(max(time.perf_counter() - start, 1e-6))
    left, ordered, rest = [(r["flags"], r["count"]) for r in patterns], [], list(range(len(candidates)))
    while rest:
        best = max(rest, key=lambda i: (sum(n for f, n in left if f[i]) / costs[i], -costs[i]))
        ordered.append(candidates[best])
        rest.remove(best)
        left = [(f, n) for f, n in left if not f[best]]
    return ordered


def first_rejection(ordered: list[Rule]) -> Column:
    """Name of the first rule that rejects, null if none does; later rules are not evaluated."""
    verdict = F.lit(None).cast("string")
    for rule in reversed(ordered):
        verdict = F.when(F.coalesce(rule.rejects, F.lit(False)), F.lit(rule.name)).otherwise(verdict)
    return verdict


def metrics(df: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (all by default) with the base figures, base_failed and the text as ``__text``."""
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    kept = [c for c in (keep if keep is not None else df.columns) if c.lower() not in names]
    value = F.coalesce(df[text], F.lit(""))
    rows = df.select(*[df[c] for c in kept], value.alias("__text"), blank_words(value).alias("__words"))
    t, w = F.col("__text"), F.col("__words")
    counted = rows.select(
        *kept, "__text", F.size(w).cast("long").alias("n_words"), word_chars(t).alias("word_chars"), n_symbols(t).alias("n_symbols"),
        n_dup_lines(t).alias("n_dup_lines"), n_repeat_words(w).alias("n_repeat_words"),
    )
    return counted.withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))


def judge(df: DataFrame, text: str = "text", keep: list[str] | None = None, rows: int = SAMPLE_ROWS) -> DataFrame:
    """The figures of ``metrics`` with ``kept``: false where a base rule or the cascade rejects."""
    ordered = order_rules(df.withColumn("__text", F.coalesce(df[text], F.lit(""))), "__text", rules(F.col("__text")), rows)
    counted = metrics(df, text, keep)
    return counted.withColumn("kept", F.when(F.col("base_failed"), False).otherwise(first_rejection(ordered).isNull())).drop("__text")


def filter_documents(df: DataFrame, text: str = "text", rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows that no rule rejects, unchanged; the base rule takes its place in the cascade by its cost."""
    value = F.coalesce(F.col(text), F.lit(""))
    ordered = order_rules(df, text, [Rule("base", base_rule(value)), *rules(value)], rows)
    return df.where(first_rejection(ordered).isNull())


_SQL = r"""
WITH base AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    [x for x in string_split(coalesce(text, ''), chr(10)) if regexp_matches(x, '[^\x20\x09-\x0D]')] AS l
  FROM documents
), counted AS (
  SELECT *, len(w) AS n_words,
    coalesce(list_sum([length(x) for x in w]), 0)::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    len(l) - len(list_distinct(l)) AS n_dup_lines
  FROM base
), places AS (
  SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM base WHERE len(w) >= 5
), repeated AS (
  SELECT doc_id, i FROM places QUALIFY count(*) OVER (PARTITION BY doc_id, w[i : i + 4]) > 1
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM repeated) GROUP BY doc_id
), judged AS (
  SELECT c.*, coalesce(v.n, 0) AS n_repeat_words,
    c.n_words < 10 OR 100 * coalesce(v.n, 0) > 20 * c.n_words AS base_failed,
    length(regexp_replace(t, '[^\p{Lu}]', '', 'g')) AS u, length(regexp_replace(t, '[^\p{Ll}]', '', 'g')) AS s
  FROM counted c LEFT JOIN covered v USING (doc_id)
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
  n_repeat_words::BIGINT AS n_repeat_words, base_failed,
  NOT (base_failed OR n_symbols * 100 > 50 * n_words OR len([x for x in w if x = '|']) * 100 > 25 * n_words
    OR (u >= 20 AND u > 2 * s) OR len(regexp_extract_all(t, '[!?]{2,}')) * 100 > 20 * n_words
    OR word_chars > 40 * n_words OR (len(l) >= 4 AND 2 * n_dup_lines > len(l))) AS kept
FROM judged
"""


@query("op4_quality_rules", _SQL)
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"), keep=["doc_id"])
