"""Uniform shuffle into shards of exact sizes.

The number of rows that go from every block of input rows to every shard is drawn
up front: the rows of a block are a sample without replacement of the free places in
the shards, so each row of the matrix is a multivariate hypergeometric draw. Blocks
are then permuted on their own and cut by their row of the matrix, the pieces are
exchanged, and every shard is permuted again. The result is distributed like one
uniform permutation of all rows dealt into shards of equal size.

A block is a hash class of rows, so a lost task recomputes the same blocks. Block
counts and the matrix are the only things on the driver: one row of ``n_shards``
numbers per ``rows_per_block`` rows, drawn in about a millisecond.
"""

import math
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bucketlens.llm.common import packed
from bucketlens.session import staged

SHARD, SLOT = "shard", "slot"
# So many blocks (and parts of a shard) at least, which keeps small inputs spread too.
MIN_BLOCKS = 2048


def shard_sizes(rows: int, n_shards: int) -> np.ndarray:
    """Equal sizes; the first shards hold one row more where it doesn't come out even."""
    return np.full(n_shards, rows // n_shards, dtype=np.int64) + (np.arange(n_shards) < rows % n_shards)


def hypergeometric(draw: np.random.Generator, good: int, bad: int, taken: int) -> int:
    """How many of ``taken`` out of ``good`` + ``bad`` are good, for any counts below 2 ** 53.

    By inversion: probabilities relative to the mode's are products of ratios of
    neighbours, so that no large factorial is needed. Beyond 40 standard deviations (and
    100 values) from the mode they are less than double precision can tell from 0.
    """
    low, high = max(0, taken - bad), min(good, taken)
    if low == high:
        return low
    total = good + bad
    mode = min(max((taken + 1) * (good + 1) // (total + 2), low), high)
    deviation = math.sqrt(taken * (good / total) * (bad / total) * (total - taken) / max(1, total - 1))
    reach = int(40 * deviation) + 100
    up = np.arange(mode, min(high, mode + reach), dtype=np.float64)
    down = np.arange(mode, max(low, mode - reach), -1, dtype=np.float64)
    above = np.cumprod((good - up) * (taken - up) / ((up + 1) * (bad - taken + up + 1)))
    below = np.cumprod(down * (bad - taken + down) / ((good - down + 1) * (taken - down + 1)))
    weights = np.concatenate([below[::-1], [1.0], above])
    sums = np.cumsum(weights)
    place = int(np.searchsorted(sums, draw.random() * sums[-1], side="right"))
    return mode - len(below) + min(place, len(weights) - 1)


def communication_matrix(block_rows: np.ndarray, n_shards: int, seed: int) -> np.ndarray:
    """Rows from each block (line) to each shard (column); exact sums both ways.

    A block's line is a multivariate hypergeometric draw, shard by shard.
    """
    draw = np.random.Generator(np.random.PCG64(seed))
    free = shard_sizes(int(block_rows.sum()), n_shards).tolist()
    matrix = np.zeros((len(block_rows), n_shards), dtype=np.int64)
    for i, rows in enumerate(block_rows.tolist()):
        others = sum(free)
        for shard, places in enumerate(free):
            others -= places
            matrix[i, shard] = n = hypergeometric(draw, places, others, rows)
            free[shard] -= n
            rows -= n
    return matrix


def shuffle_into_shards(
    rows: DataFrame, by: list[str], n_shards: int, seed: int = 0, rows_per_block: int = 50_000
) -> DataFrame:
    """Rows with ``shard`` (0 to ``n_shards`` - 1) and ``slot`` (gapless from 0 in a shard).

    ``by`` identifies a row. Rows equal in all of it take neighbouring ranks in either
    order; where they are more than a block should have, they are dealt over several
    blocks by their place in the input. NULLs are values like any other. Shard sizes differ by one row at most, and
    an empty table gives an empty result. Input columns named like a result column
    are replaced. Pass narrow rows: texts need not move, they can be joined by ``by``.
    """
    spark = rows.sparkSession
    given = staged(packed(rows.drop(SHARD, SLOT)), "shard-rows")
    total = given.count()
    n_blocks = max(MIN_BLOCKS, math.ceil(total / rows_per_block))
    by = [f"_row.`{c}`" for c in by]

    # At most one row per block's worth of input rows.
    names = [f"_by{n}" for n in range(len(by))]
    many = given.groupBy(*(F.col(c).alias(n) for c, n in zip(by, names))).agg(F.count(F.lit(1)).alias("_n"))
    many = many.where(F.col("_n") > rows_per_block).withColumn("_deals", F.ceil(F.col("_n") / rows_per_block)).drop("_n")
    given = given.withColumn("_place", F.monotonically_increasing_id())
    found = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(n)) for c, n in zip(by, names)))
    deal = F.pmod(F.xxhash64("_place"), F.coalesce("_deals", F.lit(1))).alias("_deal")
    given = given.join(F.broadcast(many), found, "left").select("_row", deal)
    by.append("_deal")

    block = F.pmod(F.xxhash64(F.lit(seed), F.lit("block"), *by), F.lit(n_blocks)).alias("_block")
    dealt = given.select("*", block, F.xxhash64(F.lit(seed), F.lit("local"), *by).alias("_order"))
    counted = sorted((r[0], r[1]) for r in dealt.groupBy("_block").count().collect())
    matrix = communication_matrix(np.array([n for _, n in counted], dtype=np.int64), n_shards, seed)
    cuts = [(b, c) for (b, _), c in zip(counted, np.cumsum(matrix, axis=1).tolist())]
    ends = spark.createDataFrame(cuts, "_block BIGINT, _ends ARRAY<BIGINT>")

    local = Window.partitionBy("_block").orderBy("_order", *by)
    ranked = dealt.withColumn("_rank", F.row_number().over(local)).join(ends, "_block")
    shard = F.size(F.filter("_ends", lambda end: end < F.col("_rank"))).alias(SHARD)

    n_parts = max(MIN_BLOCKS // n_shards, math.ceil(total / n_shards / rows_per_block), 1)
    part = F.pmod(F.xxhash64(F.lit(seed), F.lit("part"), *by), F.lit(n_parts)).alias("_part")
    order = F.xxhash64(F.lit(seed), F.lit("again"), *by).alias("_order")
    placed = staged(ranked.select("_row", "_deal", shard, part, order), "shard-placed")

    # One row per part of a shard: where the part's slots begin.
    before = Window.partitionBy(SHARD).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy(SHARD, "_part").agg(F.count(F.lit(1)).alias("_rows"))
    begins = sizes.select(SHARD, "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_begin"))
    again = Window.partitionBy(SHARD, "_part").orderBy("_order", *by)
    slotted = placed.withColumn("_rank", F.row_number().over(again)).join(begins, [SHARD, "_part"])
    slot = (F.col("_begin") + F.col("_rank") - 1).cast("bigint").alias(SLOT)
    return slotted.select("_row.*", SHARD, slot)


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard, files of even size, rows sorted by slot within a file."""
    ordered = sharded.hint("rebalance", SHARD).sortWithinPartitions(SHARD, SLOT)
    ordered.write.mode("errorifexists").partitionBy(SHARD).parquet(path)


def shard_documents(docs: DataFrame, n_shards: int = 24, seed: int = 0) -> DataFrame:
    """The law ``rows`` on documents, as digests.

    Columns: doc_id, size (bytes of the text plus 8), text_crc32, law, shard, slot,
    grown_shard (NULL under this law). A NULL text has no bytes and the checksum 0.
    """
    digests = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("bigint").alias("size"),
        F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("bigint").alias("text_crc32"),
        F.xxhash64("text").alias("_text"),
    )
    sharded = shuffle_into_shards(digests, ["doc_id", "_text"], n_shards, seed)
    return sharded.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), SHARD, SLOT, F.lit(None).cast("int").alias("grown_shard")
    )
