"""Numbers as report text."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Decimal size suffixes, each 1000 times the one before.
SIZE_SUFFIXES = ["kB", "MB", "GB", "TB", "PB", "EB"]


def size_text(size: Column) -> Column:
    """``1.2 kB``, ``3.4 GB``: powers of 1000, one decimal, as C's ``%.1f`` rounds."""
    unit, suffix = F.lit(1000).cast("bigint"), F.lit(SIZE_SUFFIXES[0])
    for power, name in enumerate(SIZE_SUFFIXES[1:], start=2):
        unit = F.when(size >= 1000**power, F.lit(1000**power)).otherwise(unit)
        suffix = F.when(size >= 1000**power, name).otherwise(suffix)
    small = F.when(size == 1, "1 Byte").otherwise(F.format_string("%d Bytes", size))
    return F.when(size < 1000, small).otherwise(F.concat(_one_decimal(size, unit), F.lit(" "), suffix))


def _one_decimal(size: Column, unit: Column) -> Column:
    """Size in units, rounded to tenths.

    C rounds the exact value of the double, so a decimal half such as 1.45 goes
    up or down with the double's own error. Scaling a double by a power of two
    is exact; the scaled value is compared with the half in integer arithmetic.
    """
    tenth = F.call_function("div", unit, F.lit(10))
    below = F.call_function("div", size, tenth)
    rest = size % tenth * 2
    # Sign of (double - half way), both scaled by 20 * 2**52.
    scaled = (size.cast("double") / unit.cast("double") * F.lit(float(2**52))).cast("bigint")
    half_way = (below * 2 + 1).cast("decimal(6,0)") * F.lit(2**52).cast("decimal(16,0)")
    error = scaled.cast("decimal(19,0)") * F.lit(20).cast("decimal(2,0)") - half_way
    up = F.when(rest != tenth, rest > tenth).when(error != 0, error > 0).otherwise(below % 2 == 1)
    tenths = below + up.cast("bigint")
    return F.concat(F.call_function("div", tenths, F.lit(10)).cast("string"), F.lit("."), (tenths % 10).cast("string"))


def grouped_digits(number: Column) -> Column:
    """Thousands separators: 1234567 -> 1,234,567."""
    return F.format_number(number, 0)
