"""Quality rules: a table of thresholds compiled into one projection.

Everything is a built-in column expression, evaluated in the scan's stage without a
shuffle. Each select below names values that the next one uses more than once, so
that the optimizer keeps them apart and computes them once.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bucketlens.llm.common import WORD

WINDOW = 8
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

# Very common function words of English, German, French and Spanish.
STOP_WORDS = (
    "a an and are as at be by for from in is it not of on or that the this to was with "
    "als auf auch aus das dem den der des die ein eine für ich im in ist mit nicht sich sie und von zu "
    "au avec ce dans de des du elle en est et il la le les ne ou par pas pour que qui se sur un une "
    "al con de del el en es esta la las lo los no para por que se su un una y"
).split()


@dataclass(frozen=True)
class Rule:
    """``metric`` (SQL over the measures) must lie in [low, high]; None is open."""

    name: str
    metric: str
    low: float | None = None
    high: float | None = None


RULES = (
    Rule("mean_word_length", "word_chars / n_words", 2.0, 12.0),
    Rule("symbols_per_word", "n_symbols / n_words", None, 0.1),
    Rule("stop_word_share", "n_stop_words / n_words", 0.02, None),
    Rule("duplicate_line_share", "n_dup_lines / n_lines", None, 0.3),
    Rule("words_per_line", "n_words / n_lines", 2.0, None),
)


def compile_rules(rules: tuple[Rule, ...]) -> dict[str, Column]:
    """One boolean column per rule: does the row pass? A metric without value passes.

    A text without words has no value of any metric. CASE says so, as Spark computes
    what both bounds share ahead of an OR, and would divide by zero words.
    """

    def passes(rule: Rule) -> Column:
        metric = f"CASE WHEN n_words > 0 THEN {rule.metric} END"
        bounds = [f"({metric}) >= {rule.low}D"] * (rule.low is not None)
        bounds += [f"({metric}) <= {rule.high}D"] * (rule.high is not None)
        return F.expr(f"coalesce({' AND '.join(bounds) or 'true'}, true)")

    return {rule.name: passes(rule) for rule in rules}


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and the measures of every whole text.

    n_words, word_chars, n_symbols, n_lines (lines with a word), n_dup_lines (such
    lines equal to an earlier one), n_stop_words and n_repeat_words (words in a window
    of eight that the text holds twice or more). A NULL or empty text has zeros.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    split = docs.select(
        "doc_id",
        F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("words"),
        F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD)).alias("lines"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).alias("n_symbols"),
    )
    counted = split.select(
        "doc_id",
        F.size("words").cast("bigint").alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        F.col("n_symbols").cast("bigint").alias("n_symbols"),
        F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.size(F.filter("words", lambda w: F.lower(w).isin(*STOP_WORDS))).cast("bigint").alias("n_stop_words"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
    )
    measures = [c for c in counted.columns if c != "hashes"]
    starts = F.when(F.size("hashes") >= WINDOW, F.sequence(F.lit(1), F.size("hashes") - (WINDOW - 1))).otherwise(
        F.array().cast("array<int>")
    )
    windowed = counted.select(*measures, F.transform(starts, lambda i: F.xxhash64(F.slice("hashes", i, WINDOW))).alias("windows"))
    # Most texts repeat no window; only the others sort theirs.
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    pairs = F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    ordered = windowed.select(*measures, F.when(repeats, pairs).alias("ordered"))

    def twice(pair: Column, at: Column) -> Column:
        before = F.get("ordered", at - 1)["h"].eqNullSafe(pair["h"])
        return before | F.get("ordered", at + 1)["h"].eqNullSafe(pair["h"])

    places = ordered.select(
        *measures, F.array_sort(F.transform(F.filter("ordered", twice), lambda pair: pair["i"])).alias("places")
    )
    covered = F.aggregate(
        F.sequence(F.lit(1), F.size("places") - 1),
        F.lit(WINDOW).cast("bigint"),
        lambda total, at: total + F.least(F.lit(WINDOW), F.get("places", at) - F.get("places", at - 1)),
    )
    repeated = F.coalesce(F.when(F.size("places") > 1, covered), F.lit(0)).cast("bigint").alias("n_repeat_words")
    # Out of a generator, so that a filter on a measure isn't moved below and computes it again.
    return places.select(F.inline(F.array(F.struct(*measures, repeated))))


def apply_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Measures, ``base_failed``, one column per rule, and ``kept``.

    A text of fewer than ``MIN_WORDS`` words (also a NULL or empty one) fails the base
    rules and is not kept.
    """
    base_failed = F.expr(f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words")
    judged = measured(docs).withColumns({"base_failed": base_failed, **compile_rules(rules)})
    kept = ~F.col("base_failed")
    for rule in rules:
        kept = kept & F.col(rule.name)
    return judged.withColumn("kept", kept)


def quality_rules_query(docs: DataFrame) -> DataFrame:
    return apply_rules(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def oracle() -> str:
    """The same rows in DuckDB."""
    words = "regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')"
    checks = []
    for rule in RULES:
        metric = rule.metric.replace(" / ", "::DOUBLE / ")
        checks += [f"coalesce({metric} >= {rule.low}, true)"] * (rule.low is not None)
        checks += [f"coalesce({metric} <= {rule.high}, true)"] * (rule.high is not None)
    stops = ", ".join(f"'{w}'" for w in STOP_WORDS)
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, unnest({words}) AS word, generate_subscripts({words}, 1) AS i FROM d),
l AS (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d),
lw AS (SELECT r, line FROM l WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
lc AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM lw GROUP BY r),
wc AS (SELECT r, count(*) AS n_words, sum(length(word)) AS word_chars,
    count(*) FILTER (WHERE lower(word) IN ({stops})) AS n_stop_words FROM w GROUP BY r),
g AS (SELECT r, i, list(word) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND {WINDOW - 1} FOLLOWING) AS g FROM w),
t AS (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM g WHERE len(g) = {WINDOW}),
p AS (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nx FROM t WHERE n > 1),
rep AS (SELECT r, sum(least({WINDOW}, coalesce(nx - i, {WINDOW}))) AS n_repeat_words FROM p GROUP BY r),
m AS (SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
    coalesce(n_lines, 0) AS n_lines, coalesce(n_stop_words, 0) AS n_stop_words
    FROM d LEFT JOIN wc USING (r) LEFT JOIN lc USING (r) LEFT JOIN rep USING (r)),
b AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM m)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
    CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
    CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
    NOT base_failed AND (n_words = 0 OR ({' AND '.join(checks)})) AS kept
FROM b"""
