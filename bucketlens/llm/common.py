"""What the corpus operators share: word pattern, row digests, skew-safe joins."""

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A word is a run of characters other than blank and the control characters 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"


def word_count(text: Column) -> Column:
    """Number of words as BIGINT; NULL text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def id_remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; a NULL id counts as empty text."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(divisor))


def packed(df: DataFrame) -> DataFrame:
    """All columns as the struct ``_row``, so that no added column clashes with a given one."""
    return df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("_row"))


def same(left: DataFrame, right: DataFrame, names: list[str], right_names: list[str] | None = None) -> Column:
    """Null-safe equality on all ``names``."""
    pairs = zip(names, right_names or names)
    return reduce(lambda a, b: a & b, (left[x].eqNullSafe(right[y]) for x, y in pairs))


def spread_join(rows: DataFrame, lookup: DataFrame, keys: list[str], spread_by: list[str], copies: int = 16) -> DataFrame:
    """Left join of ``rows`` to a ``lookup`` with unique ``keys`` (NULL equals NULL).

    A key may hold any share of the rows: its rows are dealt over ``copies`` tasks by
    a hash of ``spread_by``, and every lookup row is copied to all of them.
    """
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*spread_by), F.lit(copies)).cast("int"))
    right_keys = [f"_r_{k}" for k in keys]
    copied = lookup.withColumnsRenamed(dict(zip(keys, right_keys)))
    copied = copied.withColumn("_r_salt", F.explode(F.lit(list(range(copies)))))
    matched = salted.join(copied, same(salted, copied, ["_salt", *keys], ["_r_salt", *right_keys]), "left")
    return matched.drop("_salt", "_r_salt", *right_keys)


def summed(df: DataFrame, of_batch: Callable[[pa.RecordBatch], np.ndarray], width: int) -> np.ndarray:
    """Sum over all batches of the vector ``of_batch`` makes of each; its width is fixed.

    Every task adds up its batches and reports the places that aren't 0; Spark adds the
    reports up per place, and ``width`` numbers come to the driver.
    """

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for batch in batches:
            total += of_batch(batch)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], names=["place", "value"])

    result = np.zeros(width)
    for place, value in df.mapInArrow(report, "place INT, value DOUBLE").groupBy("place").agg(F.sum("value")).collect():
        result[place] = value
    return result
