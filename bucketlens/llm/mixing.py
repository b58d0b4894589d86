"""Mixing sources to target weights.

Tokens are added up per source, each source gets a target by weight with a ceiling,
and its repetition rate is target / size. A document is taken floor(rate) times, and
once more with the rate's fraction as probability; the draw is a hash of seed and id,
so a rerun or a recomputed task takes the same documents.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bucketlens.llm.common import packed, spread_join, word_count
from bucketlens.session import staged

WEIGHTS = (5, 2, 1)
DRAW_BITS = 52


def name_of(doc_id: Column, text: Column) -> Column:
    """What a row is drawn by: its id, or the MD5 of its text where it has none."""
    return F.coalesce(doc_id.cast("string"), F.concat(F.lit(":"), F.md5(F.coalesce(text, F.lit("")).cast("binary"))))


def draw(name: Column, seed: int) -> Column:
    """Uniform in [0, 1) from a name: the first 13 hex digits of an MD5."""
    text = F.concat(F.lit(f"{seed}:"), name)
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, DRAW_BITS // 4), 16, 10).cast("bigint") / F.lit(float(2**DRAW_BITS))


def copies_of(name: Column, rate: Column, seed: int) -> Column:
    whole = F.floor(rate)
    return (whole + (draw(name, seed) < rate - whole).cast("bigint")).cast("bigint")


def source_targets(sizes: DataFrame, weights: tuple[int, ...], share: float, ceiling: float) -> DataFrame:
    """source, source_size, target, rate from (source, size) rows.

    Sources in code point order, NULL last, take the weights in turn. Targets are
    ``share`` of all sizes split by weight; none exceeds ``ceiling`` times its source,
    and what is cut off goes to the others by weight. That is min(cap, level * weight)
    with the level at which the targets add up. Sources that reach their cap come
    first by cap / weight, so the level follows from running sums. A source without
    words has the target and the rate 0.
    """
    # From here on one row per source, in one sorted run.
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.lit(list(weights)), (F.pmod(place, F.lit(len(weights))) + 1).cast("int"))
    weighted = totals.withColumn("_w", weight.cast("double")).withColumn("_cap", F.col("source_size") * F.lit(float(ceiling)))
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    summed = weighted.select(
        "*",
        F.sum("_cap").over(whole).alias("_caps"),
        F.sum("_w").over(whole).alias("_ws"),
        F.coalesce(F.sum("_cap").over(before), F.lit(0.0)).alias("_cap_before"),
        F.coalesce(F.sum("_w").over(before), F.lit(0.0)).alias("_w_before"),
    )
    budget = F.least(F.col("_caps"), F.col("_caps") * F.lit(share / ceiling))
    # The level if exactly the sources before this one were at their caps.
    levelled = summed.withColumn("_level", (budget - F.col("_cap_before")) / (F.col("_ws") - F.col("_w_before")))
    below = F.when(F.col("_level") * F.col("_w") < F.col("_cap"), F.col("_level"))
    level = F.max(below).over(whole)
    # All at their caps: no level, and least() passes over it.
    target = F.least(F.col("_cap"), level * F.col("_w"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    return levelled.select("source", "source_size", target.alias("target")).withColumn("rate", rate)


def mixing_plan(
    docs: DataFrame, seed: int = 0, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, ceiling: float = 2.0
) -> DataFrame:
    """doc_id, source, size, source_size, target, copies for every row of ``docs``.

    Size is the number of words; a NULL or empty text has 0. Rows with the same id
    are drawn alike, and of rows without an id those with the same text.
    """
    name = name_of(F.col("doc_id"), F.col("text")).alias("_name")
    sizes = staged(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), name), "mix-sizes")
    targets = source_targets(sizes, weights, share, ceiling)
    planned = spread_join(sizes, targets, ["source"], ["_name"])
    copies = copies_of(F.col("_name"), F.col("rate"), seed).alias("copies")
    return planned.select("doc_id", "source", "size", "source_size", "target", copies)


def mix_documents(
    docs: DataFrame, seed: int = 0, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, ceiling: float = 2.0
) -> DataFrame:
    """The mixed corpus: every document as often as it is taken, columns as given.

    Drawn as in ``mixing_plan``. A NULL or empty text is taken like any other of its
    source; repeated rows come out alike, an empty table empty.
    """
    sizes = docs.groupBy("source").agg(F.sum(word_count(F.col("text"))).alias("size"))
    targets = source_targets(sizes, weights, share, ceiling).select("source", F.col("rate").alias("_rate"))
    name = name_of(F.col("_row.doc_id"), F.col("_row.text")).alias("_name")
    rows = packed(docs).select("_row", F.col("_row.source").alias("source"), name)
    rated = spread_join(rows, staged(targets, "mix-rates"), ["source"], ["_name"])
    times = F.array_repeat(F.lit(0), copies_of(F.col("_name"), F.col("_rate"), seed).cast("int"))
    return rated.select("_row", F.explode(times)).select("_row.*")


def mix_query(docs: DataFrame) -> DataFrame:
    """What the mix takes of every document: doc_id, size, source_size, target, taken."""
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return mixing_plan(docs).select("doc_id", "size", "source_size", "target", taken)


def oracle() -> str:
    """The same rows in DuckDB."""
    weights = ", ".join(f"{w}.0" for w in WEIGHTS)
    return f"""
WITH d AS (SELECT doc_id, coalesce(doc_id::VARCHAR, ':' || md5(coalesce(text, ''))) AS name, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [{weights}][(row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % {len(WEIGHTS)} + 1]::DOUBLE AS w,
    source_size * 2.0::DOUBLE AS cap FROM s),
c AS (SELECT *, (SELECT sum(cap) FROM w) AS caps, (SELECT sum(w) FROM w) AS ws,
    coalesce(sum(cap) OVER before, 0)::DOUBLE AS cap_before, coalesce(sum(w) OVER before, 0)::DOUBLE AS w_before FROM w
    WINDOW before AS (ORDER BY cap / w, encode(source) NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT *, (caps * 0.75::DOUBLE - cap_before) / (ws - w_before) AS level FROM c),
m AS (SELECT max(level) FILTER (WHERE level * w < cap) AS level FROM l),
t AS (SELECT source, source_size, least(cap, (SELECT level FROM m) * w)::DOUBLE AS target FROM l),
r AS (SELECT d.doc_id, size, source_size, target,
    CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS rate,
    CAST('0x' || substr(md5('0:' || name), 1, 13) AS BIGINT) / 4503599627370496.0::DOUBLE AS u
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
    size * (floor(rate)::BIGINT + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END)::BIGINT AS taken
FROM r"""
