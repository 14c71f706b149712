"""Quality rules as a short-circuit cascade.

Each rule rejects documents by one expression.  On a sample the rules' costs (time of a pass
that evaluates only the rule) and selectivities (which rows which rules reject, together) are
estimated; the cascade takes next the rule that rejects most of the rows still left per unit
of cost, and evaluates a rule only on documents that passed the ones before.  The order
changes the work and the name of the first failed rule, never the verdict.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskline.llm.common import WS_CLASS, staged, text_or_empty, words_of

#: Rows of the sample that costs and selectivities are estimated on, by hash of the id.
SAMPLE_ROWS = 2000
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

#: Rejection rules over the features below; shares are whole percents so that SQL agrees.
RULES = {
    "short": f"n_words < {MIN_WORDS}",
    "repeats": f"100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words",
    "symbols": "10 * n_symbols > n_words",
    "duplicate_lines": "100 * n_dup_lines > 50 * n_lines",
    "word_length": "word_chars < 3 * n_words or word_chars > 10 * n_words",
    "capitals": "100 * n_capitals > 40 * word_chars",
    "exclamations": "100 * n_exclamations > 30 * n_words",
    "stutter": "100 * n_stutters > 30 * n_words",
}
BASE_RULES = ("short", "repeats")


def _repeat_words(words: Column, hashes: Column) -> Column:
    """Words in windows found twice or more, given the windows' hashes.  Only a document with
    a repeated window sorts its windows; covered words are summed over the sorted starts."""
    placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    m = F.size(hashes)
    pairs = F.zip_with(
        F.slice(placed, 1, m - 1), F.slice(placed, 2, m - 1),
        lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])).otherwise(F.array().cast("array<int>")),
    )
    starts = F.array_sort(F.array_distinct(F.flatten(pairs)))
    covered = F.aggregate(
        starts,
        F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n")),
        lambda acc, p: F.struct(p.alias("last"), (acc["n"] + F.least(F.lit(WINDOW), p - acc["last"])).alias("n")),
        lambda acc: acc["n"],
    )
    return F.when((m < 2) | (F.size(F.array_distinct(hashes)) == m), F.lit(0)).otherwise(covered).cast("long")


def features(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the features as further columns (names as in the rules).

    Windows are compared by a 64-bit hash of their words."""
    text = F.col("_text")
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(f"[^{WS_CLASS}]"))
    hashes = F.when(
        F.size("_words") > WINDOW,
        F.transform(F.sequence(F.lit(1), F.size("_words") - WINDOW + 1), lambda i: F.xxhash64(F.slice(F.col("_words"), i, WINDOW))),
    ).otherwise(F.array().cast("array<bigint>"))
    n = F.size("_words")
    again = F.when(n > 1, F.zip_with(F.slice("_words", F.lit(1), n - 1), F.slice("_words", F.lit(2), n - 1), lambda a, b: a == b)).otherwise(F.array().cast("array<boolean>"))
    only = lambda cls: F.length(F.regexp_replace(text, f"[^{cls}]+", "")).cast("long")
    return (
        docs.withColumn("_text", text_or_empty(text_col))
        .withColumn("_words", words_of(text))
        .withColumn("_lines", lines)
        .withColumn("_hashes", hashes)
        .withColumn("n_words", F.size("_words").cast("long"))
        .withColumn("word_chars", F.length(F.regexp_replace(text, f"[{WS_CLASS}]+", "")).cast("long"))
        .withColumn("n_symbols", only("#*$%&|<>"))
        .withColumn("n_lines", F.size("_lines").cast("long"))
        .withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
        .withColumn("n_repeat_words", _repeat_words(F.col("_words"), F.col("_hashes")))
        .withColumn("n_capitals", only("A-Z"))
        .withColumn("n_exclamations", only("!"))
        .withColumn("n_stutters", F.size(F.filter(again, lambda x: x)).cast("long"))
    )


def _sample(docs: DataFrame, id_col: str, text_col: str, rows: int) -> DataFrame:
    every = max(1, docs.count() // rows)
    picked = docs.where(F.pmod(F.xxhash64(F.col(id_col), F.lit("quality")), F.lit(every)) == 0)
    return staged(picked.select(F.col(text_col).cast("string").alias("text")).repartition(4), "sample")


def plan_cascade(docs: DataFrame, rules: dict[str, str] = RULES, id_col: str = "doc_id", text_col: str = "text", rows: int = SAMPLE_ROWS) -> list[str]:
    """The rules' names in the order of the cascade."""
    sample = _sample(docs, id_col, text_col, rows)
    told = features(sample)
    flags = told.select(*[F.coalesce(F.expr(r), F.lit(False)).alias(k) for k, r in rules.items()])
    # which rules reject together: at most 2 ** rules rows
    seen = [(r.asDict(), r["count"]) for r in flags.groupBy(*rules).count().collect()]

    def seconds(expr: str) -> float:
        best = float("inf")
        for _ in range(2):
            t = time.perf_counter()
            told.agg(F.count_if(F.expr(expr))).collect()
            best = min(best, time.perf_counter() - t)
        return best

    floor = seconds("_text is null")
    cost = {k: max(seconds(r) - floor, 1e-3) for k, r in rules.items()}
    order, left = [], list(rules)
    while left:
        rejects = {k: sum(n for row, n in seen if row[k]) for k in left}
        best = max(left, key=lambda k: (rejects[k] / cost[k], -list(rules).index(k)))
        order.append(best)
        left.remove(best)
        seen = [(row, n) for row, n in seen if not row[best]]
    return order


def _cascade(order: list[str], rules: dict[str, str]) -> Column:
    first = F.when(F.lit(False), F.lit(None).cast("string"))
    for k in order:
        first = first.when(F.expr(rules[k]), F.lit(k))
    return first.otherwise(F.lit(None).cast("string"))


def verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: dict[str, str] = RULES) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, failed_rule (of the cascade, null if kept).

    A null text is empty: no words, so it fails.  Repeated rows get equal verdicts.  Other
    columns are ignored, whatever their names.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    order = plan_cascade(rows, rules)
    told = features(rows).withColumn("failed_rule", _cascade(order, rules))
    base = F.expr(" or ".join(f"({RULES[k]})" for k in BASE_RULES))
    return told.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base.alias("base_failed"), (F.col("failed_rule").isNull() & ~base).alias("kept"), "failed_rule",
    )


def keep_good(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: dict[str, str] = RULES) -> DataFrame:
    """The rows of ``docs`` that no rule rejects, with all their columns."""
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    order = plan_cascade(rows, rules)
    return features(rows).where(_cascade(order, rules).isNull()).select("row.*")
