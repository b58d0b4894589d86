"""IP addresses as hexadecimal text.

An address becomes a family digit and its hexadecimal digits: ``4`` + 8 digits or
``6`` + 32 digits. A network is then a prefix of that text, and looking an
address up is an equality on prefixes, for both families alike.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_IPV4 = rf"^{_OCTET}(?:\.{_OCTET}){{3}}\z"
_GROUPS = r"[0-9a-f]{1,4}(?::[0-9a-f]{1,4})*"
_IPV6 = rf"^(?:(?:{_GROUPS})?::(?:{_GROUPS})?|[0-9a-f]{{1,4}}(?::[0-9a-f]{{1,4}}){{7}})\z"
_MAPPED = "0" * 20 + "ffff"

IPV4_DIGITS = 8
IPV6_DIGITS = 32


def with_ipv4_hex(df: DataFrame, ip: Column, name: str) -> DataFrame:
    """Add the eight hexadecimal digits of a valid dotted address, NULL for other text."""
    octet = [F.get(F.col("_octets"), F.lit(i)).cast("bigint") for i in range(4)]
    number = ((octet[0] * 256 + octet[1]) * 256 + octet[2]) * 256 + octet[3]
    steps = df.withColumn("_octets", F.when(ip.rlike(_IPV4), F.split(ip, r"\.")))
    return steps.withColumn(name, F.lower(F.lpad(F.hex(number), IPV4_DIGITS, "0"))).drop("_octets")


def with_ipv6_hex(df: DataFrame, ip: Column, name: str) -> DataFrame:
    """Add the 32 hexadecimal digits of a valid IPv6 address, NULL for other text.

    Built up in steps, so that each intermediate value is worked out once.
    """
    dotted_end = r"^(.*:)([0-9.]+\.[0-9.]+)$"
    text, last, padded = F.col("_text"), F.col("_last"), F.col("_padded")
    as_groups = F.concat(
        F.regexp_extract(text, dotted_end, 1), F.substring(last, 1, 4), F.lit(":"), F.substring(last, 5, 4)
    )
    # Every group to four digits: three zeros in front, then its last four.
    four_digits = F.regexp_replace(F.regexp_replace(text, "([0-9a-f]+)", "000$1"), "[0-9a-f]*([0-9a-f]{4})", "$1")
    dotted = F.contains(text, F.lit("."))
    steps = df.withColumn("_text", F.lower(F.when(F.instr(ip, ":") > 0, ip)))
    steps = with_ipv4_hex(steps, F.when(dotted, F.regexp_extract(text, dotted_end, 2)), "_last")
    steps = steps.withColumn("_text", F.when(dotted, as_groups).otherwise(text)).withColumn(
        "_padded", F.when(text.rlike(_IPV6), four_digits)
    )
    gap = F.instr(padded, "::")
    head = F.translate(F.substring_index(padded, "::", 1), ":", "")
    tail = F.when(gap > 0, F.translate(F.substring_index(padded, "::", -1), ":", "")).otherwise("")
    missing = F.lit(IPV6_DIGITS) - F.length(head) - F.length(tail)
    complete = F.when(gap > 0, missing >= 4).otherwise(missing == 0)
    digits = F.when(complete, F.concat(head, F.repeat(F.lit("0"), missing), tail))
    return steps.withColumn(name, digits).drop("_text", "_last", "_padded")


def with_address_text(df: DataFrame, ip: Column, name: str) -> DataFrame:
    """Add family digit and hexadecimal digits; NULL for text that is no address.

    IPv4 addresses written inside IPv6 (``::ffff:a.b.c.d``) count as IPv4.
    """
    v4, v6 = F.col("_v4"), F.col("_v6")
    text = F.when(v6.startswith(_MAPPED), F.concat(F.lit("4"), F.substring(v6, 25, 8))).otherwise(
        F.concat(F.lit("6"), v6)
    )
    both = with_ipv6_hex(with_ipv4_hex(df, ip, "_v4"), ip, "_v6")
    return both.withColumn(name, F.coalesce(F.concat(F.lit("4"), v4), text)).drop("_v4", "_v6")
