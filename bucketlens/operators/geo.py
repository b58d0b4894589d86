"""IP address to country: the most specific range that holds the address."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bucketlens import schema as S
from bucketlens.functions import addresses as A
from bucketlens.session import staged

# Lookup tables up to this size are sent to every executor, larger ones are joined by a shuffle.
BROADCAST_BYTES = 64 << 20
# What a row of a lookup table takes besides its text.
ROW_BYTES = 64
# In a table with so many codes at most they are numbered, in the low bits of a match:
# minima of numbers are taken in hash tables, those of texts need sorted rows.
MOST_CODES, CODE_BITS = 1_000, 16

# Prefixes of at most so many digits number 139,810 at most, whatever the table: they
# are always sent. Each of them may hold any share of the addresses.
WIDE_DIGITS = 4
# Requests meet a table in place by a join per length of prefix, up to so many.
MOST_JOINS = 8
# A longer prefix's addresses are dealt over so many tasks.
COPIES = 8

# An address with more rows than a task should have, or than a millionth of all, is hot.
HOT_ROWS = 1_000_000
MOST_HOT = 1_000_000
# Rows that match nothing in a shuffle are spread over so many keys.
SPREAD = 1_000


@dataclass(frozen=True)
class GeoTable:
    """Country by address prefix.

    ``prefixes`` has one row per distinct prefix: ``prefix`` and ``match``, the width of
    its narrowest range and that range's code (empty for none); of equal widths the
    first code in order. Few codes are listed in ``codes``, in order, and ``match`` is a
    number that ends in the place of the code; otherwise it is a struct. ``lengths``
    lists the lengths of the prefixes of each address family.
    """

    prefixes: DataFrame
    lengths: dict[str, list[int]]
    codes: list[str]
    broadcastable: bool

    def country(self, match: Column) -> Column:
        """Code of a match; none, or no match, is ``N/A``."""
        code = match["code"]
        if self.codes:
            code = F.get(_texts(self.codes), match.bitwiseAND(F.lit(2**CODE_BITS - 1)).cast("int"))
        return F.coalesce(F.nullif(code, F.lit("")), F.lit(S.NO_COUNTRY)).alias("country")


def _texts(values: list[str]) -> Column:
    return F.array(*(F.lit(v) for v in values)).cast("array<string>")


def geo_table(
    ranges: DataFrame | None = None, networks: DataFrame | None = None, address_ranges: DataFrame | None = None
) -> GeoTable:
    """Lookup table from ranges and / or networks in CIDR notation.

    ``ranges``: range_start BIGINT, range_end BIGINT (IPv4), iso_code.
    ``networks``: network (``a.b.c.d/n`` or ``a:b::/n``), iso_code.
    ``address_ranges``: first_address, last_address (text, IPv4 or IPv6, both included),
    iso_code. Ranges of two families, or that end before they start, hold nothing.
    """
    parts = []
    if ranges is not None:
        parts.append(_range_prefixes(ranges))
    if networks is not None:
        parts.append(_range_prefixes(_ipv4_networks(networks)))
        parts.append(_ipv6_prefixes(networks))
    if address_ranges is not None:
        ends = _hex_ends(address_ranges)
        parts.append(_range_prefixes(_ipv4_ranges(ends)))
        # Widths of any number of addresses as 32 digits, which sort as the numbers do.
        parts = [p.withColumn("width", _wide(p)) for p in parts]
        parts.append(_ipv6_range_prefixes(ends))
    pieces = parts[0]
    for part in parts[1:]:
        pieces = pieces.unionByName(part)
    pieces = pieces.select("prefix", "width", F.coalesce("iso_code", F.lit("")).alias("code"))
    # Family and length: 40 pairs at most.
    kind = F.struct(F.substring("prefix", 1, 1), F.length("prefix"))
    size = F.sum(F.octet_length("prefix") + F.octet_length("code") + ROW_BYTES)
    found = pieces.agg(F.collect_set(kind), F.coalesce(size, F.lit(0)), F.approx_count_distinct("code")).first()
    lengths = {family: sorted(length for f, length in found[0] if f == family) for family in ("4", "6")}
    numbered = address_ranges is None and found[2] <= MOST_CODES
    codes = sorted(r[0] for r in pieces.select("code").distinct().collect()) if numbered else []
    match = F.struct("width", "code")
    if codes:
        match = F.shiftleft("width", CODE_BITS) + F.array_position(_texts(codes), F.col("code")) - 1
    prefixes = pieces.select("prefix", match.alias("match")).groupBy("prefix").agg(F.min("match").alias("match"))
    return GeoTable(prefixes, lengths, codes, found[1] <= BROADCAST_BYTES)


def _range_prefixes(ranges: DataFrame) -> DataFrame:
    """Cut IPv4 ranges into hexadecimal prefixes, at most 240 per range.

    In blocks of 16**k addresses, a range covers the blocks from ceil(start) to
    floor(end). Those inside a larger covered block are left to it, which leaves up
    to 15 blocks at either side on each level.
    """
    start, stop, level = F.col("range_start"), F.col("range_end") + 1, F.col("level")

    def shift(direction: str, value: Column, digits: Column) -> Column:
        return F.call_function(f"shift{direction}", value, digits * 4)

    def first(k: Column) -> Column:
        return shift("right", start + shift("left", F.lit(1).cast("bigint"), k) - 1, k)

    def blocks(low: Column, high: Column) -> Column:
        return F.when(low < high, F.sequence(low, high - 1)).otherwise(F.array().cast("array<bigint>"))

    levels = ranges.where("range_start <= range_end").select(
        start, stop.alias("stop"), "iso_code", F.explode(F.sequence(F.lit(0), F.lit(A.IPV4_DIGITS))).alias("level")
    )
    stop = F.col("stop")
    covered = levels.select(
        "iso_code",
        (stop - start).alias("width"),
        (F.lit(A.IPV4_DIGITS) - level).alias("digits"),
        first(level).alias("low"),
        shift("right", stop, level).alias("high"),
        (first(level + 1) * 16).alias("inner_low"),
        (shift("right", stop, level + 1) * 16).alias("inner_high"),
    )
    low, high, inner_low, inner_high = (F.col(c) for c in ("low", "high", "inner_low", "inner_high"))
    nested = inner_low < inner_high
    outside = F.when(nested, F.concat(blocks(low, inner_low), blocks(inner_high, high))).otherwise(blocks(low, high))
    numbers = covered.select("iso_code", "width", "digits", F.explode(outside).alias("block"))
    text = F.lower(F.lpad(F.hex("block"), A.IPV4_DIGITS, "0"))
    digits = F.col("digits")
    prefix = F.concat(F.lit("4"), F.substring(text, F.lit(A.IPV4_DIGITS + 1) - digits, digits))
    return numbers.select(prefix.alias("prefix"), "width", "iso_code")


def _worked_out(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns out of a generator, so that what uses them does not work them out again and again."""
    return df.select("*", F.inline(F.array(F.struct(*(c.alias(n) for n, c in columns.items())))))


def _hex_ends(address_ranges: DataFrame) -> DataFrame:
    """Both ends as family digit and hexadecimal digits, where they are of one family and in order."""
    first = A.with_address_text(address_ranges.select("first_address", "last_address", "iso_code"), F.col("first_address"), "_hex")
    first = _worked_out(first, _first=F.col("_hex")).drop("_hex")
    last = A.with_address_text(first, F.col("last_address"), "_hex")
    both = _worked_out(last, _last=F.col("_hex")).drop("_hex")
    same_family = F.substring("_first", 1, 1) == F.substring("_last", 1, 1)
    return both.where(same_family & (F.col("_first") <= F.col("_last"))).select("_first", "_last", "iso_code")


def _ipv4_ranges(ends: DataFrame) -> DataFrame:
    numbers = (F.conv(F.substring(c, 2, A.IPV4_DIGITS), 16, 10).cast("bigint") for c in ("_first", "_last"))
    start, end = numbers
    return ends.where(F.col("_first").startswith("4")).select(start.alias("range_start"), end.alias("range_end"), "iso_code")


def _ipv6_range_prefixes(ends: DataFrame) -> DataFrame:
    """Cut IPv6 ranges into hexadecimal prefixes, at most 944 per range.

    Below the digits that both ends share, a range is what lies between the two digits
    that differ, what follows the first end within its digit, and what comes before the
    last end within its own. Ends of zeros, or of the highest digits, need no cutting.
    """
    s, e = F.col("_s"), F.col("_e")
    shared, low, high = F.col("_shared"), F.col("_low"), F.col("_high")

    def digit(text: Column, k: Column) -> Column:
        return F.conv(F.substring(text, k, F.lit(1)), 16, 10).cast("int")

    def numbers(first: Column, last: Column) -> Column:
        return F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))

    def children(text: Column, k: Column, first: Column, last: Column) -> Column:
        """The first ``k - 1`` digits of ``text``, each time with one digit from ``first`` to ``last``."""
        stem = F.substring(text, F.lit(1), k - 1)
        return F.transform(numbers(first, last), lambda d: F.concat(stem, F.lower(F.hex(d))))

    def stem(text: Column, end: Column) -> Column:
        return F.array(F.substring(text, F.lit(1), F.greatest(end, shared + 1)))

    place = F.sequence(F.lit(1), F.lit(A.IPV6_DIGITS))
    cut = _worked_out(
        ends.where(F.col("_first").startswith("6")), _s=F.substring("_first", 2, A.IPV6_DIGITS), _e=F.substring("_last", 2, A.IPV6_DIGITS)
    )
    cut = _worked_out(
        cut,
        _shared=F.size(F.filter(place, lambda k: F.substring(s, F.lit(1), k) == F.substring(e, F.lit(1), k))),
        _low=F.length(F.rtrim(s, F.lit("0"))),
        _high=F.length(F.rtrim(e, F.lit("f"))),
        width=_difference(e, s),
    )
    differ = shared + 1
    pieces = F.concat(
        children(s, differ, digit(s, differ) + 1, digit(e, differ) - 1),
        stem(s, low),
        F.flatten(F.transform(numbers(shared + 2, low), lambda k: children(s, k, digit(s, k) + 1, F.lit(15)))),
        stem(e, high),
        F.flatten(F.transform(numbers(shared + 2, high), lambda k: children(e, k, F.lit(0), digit(e, k) - 1))),
    )
    block = (low <= shared) & (high <= shared)
    prefixes = F.when(block, F.array(F.substring(s, F.lit(1), shared))).otherwise(pieces)
    return cut.select(F.explode(prefixes).alias("_piece"), "width", "iso_code").select(
        F.concat(F.lit("6"), "_piece").alias("prefix"), "width", "iso_code"
    )


def _difference(larger: Column, smaller: Column) -> Column:
    """Difference of two 128-bit numbers of 32 hexadecimal digits, in four parts with a borrow."""
    parts, borrow = [], F.lit(0)
    for begin in range(A.IPV6_DIGITS - 7, 0, -8):
        a, b = (F.conv(F.substring(x, begin, 8), 16, 10).cast("bigint") for x in (larger, smaller))
        part = a - b - borrow
        borrow = F.when(part < 0, 1).otherwise(0)
        parts.insert(0, F.lower(F.lpad(F.hex(part + borrow * F.lit(1 << 32)), 8, "0")))
    return F.concat(*parts)


def _wide(pieces: DataFrame) -> Column:
    """Number of addresses less one, as 32 hexadecimal digits.

    ``width`` is the number of addresses for IPv4, that of open bits for IPv6.
    """
    count, bits = F.hex(F.col("width") - 1), F.col("width").cast("int")
    ones = F.concat(F.element_at(_texts(["", "1", "3", "7"]), bits % 4 + 1), F.repeat(F.lit("f"), F.call_function("div", bits, F.lit(4)).cast("int")))
    digits = F.when(F.col("prefix").startswith("4"), F.lower(count)).otherwise(ones)
    return F.lpad(digits, A.IPV6_DIGITS, "0")


def _ipv4_networks(networks: DataFrame) -> DataFrame:
    size = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.lit(32) - F.col("_bits"))
    base = F.conv(F.col("_hex"), 16, 10).cast("bigint")
    text = F.split_part("network", F.lit("/"), F.lit(1))
    return (
        A.with_ipv4_hex(networks, text, "_hex")
        .select("_hex", F.split_part("network", F.lit("/"), F.lit(2)).try_cast("int").alias("_bits"), "iso_code")
        .where(F.col("_hex").isNotNull() & F.col("_bits").between(0, 32))
        .select((base - base % size).alias("range_start"), (base - base % size + size - 1).alias("range_end"), "iso_code")
    )


def _ipv6_prefixes(networks: DataFrame) -> DataFrame:
    """IPv6 networks as prefixes; a length between two digits takes up to 8 of them."""
    bits = F.col("_bits")
    whole = F.call_function("div", bits, F.lit(4)).cast("int")
    open_bits = F.when(bits % 4 > 0, F.lit(4) - bits % 4).otherwise(0)
    count = F.element_at(F.array(*(F.lit(n) for n in (1, 2, 4, 8))), open_bits + 1)
    digit = F.conv(F.substring("_hex", whole + 1, F.lit(1)), 16, 10).try_cast("int")
    lowest = digit - digit % count
    digits = F.transform(F.sequence(lowest, lowest + count - 1), lambda d: F.lower(F.hex(d)))
    endings = F.when(bits % 4 > 0, digits).otherwise(F.array(F.lit("")))
    text = F.split_part("network", F.lit("/"), F.lit(1))
    return (
        A.with_ipv6_hex(networks, text, "_hex")
        .select("_hex", F.split_part("network", F.lit("/"), F.lit(2)).try_cast("int").alias("_bits"), "iso_code")
        .where(F.col("_hex").isNotNull() & bits.between(0, 128))
        .select(
            F.concat(F.lit("6"), F.substring("_hex", F.lit(1), whole)).alias("_prefix"),
            F.explode(endings).alias("_ending"),
            # IPv6 networks meet only their like: the number of open bits orders them.
            (F.lit(128) - bits).cast("bigint").alias("width"),
            "iso_code",
        )
        .select(F.concat("_prefix", "_ending").alias("prefix"), "width", "iso_code")
    )


def _cuts(geo: GeoTable, low: int = 0, high: int = A.IPV6_DIGITS) -> Column:
    """The prefixes of ``_address`` with ``low`` to ``high`` digits that the table may hold."""

    def of_family(family: str) -> Column:
        cuts = [F.substring(F.col("_address"), 1, n) for n in geo.lengths[family] if low <= n - 1 <= high]
        return F.when(F.col("_address").startswith(family), F.array(*cuts)) if cuts else F.lit(None)

    return F.coalesce(of_family("4"), of_family("6"), F.lit(None).cast("array<string>"))


def resolve_addresses(keyed: DataFrame, geo: GeoTable, keys: list[str], address: Column) -> DataFrame:
    """Add ``country`` to a frame whose rows are told apart by ``keys``.

    Each address meets its own prefixes, one per length in the table, by an
    equality join against unique prefixes; the narrowest range met wins. When
    ``keyed`` is already grouped by ``keys``, putting its rows together again
    needs no shuffle.
    """
    if not geo.broadcastable:
        return _resolve_by_shuffle(keyed, geo, address)
    rest = [c for c in keyed.columns if c not in keys]
    cuts = F.explode_outer(_cuts(geo)).alias("prefix")
    tried = A.with_address_text(keyed, address, "_address").select(*keyed.columns, cuts)
    met = tried.join(F.broadcast(geo.prefixes), "prefix", "left").groupBy(*keys)
    narrowest = met.agg(*(F.any_value(c).alias(c) for c in rest), F.min("match").alias("match"))
    return narrowest.select(*keyed.columns, geo.country(F.col("match")))


def _resolve_by_shuffle(keyed: DataFrame, geo: GeoTable, address: Column) -> DataFrame:
    """``resolve_addresses`` for a table too large to be sent.

    Every distinct address is looked up once: in the few wide prefixes, which are sent,
    and in the others by a shuffle that deals the addresses of a prefix over several
    tasks. Rows without an address stay out of it and are spread.
    """
    named = A.with_address_text(keyed, address, "_hex")
    # Out of a generator: filters that the optimizer infers for the joins below would
    # otherwise be moved below the steps that build the text, and repeat them many times over.
    named = named.select(*keyed.columns, F.explode(F.array("_hex")).alias("_address"))
    # A missing address has no prefix and falls out below.
    distinct = named.select("_address").distinct()

    def tried(low: int, high: int) -> DataFrame:
        return distinct.select("_address", F.explode(_cuts(geo, low, high)).alias("prefix"))

    digits = F.length("prefix") - 1
    wide = tried(0, WIDE_DIGITS).join(F.broadcast(geo.prefixes.where(digits <= WIDE_DIGITS)), "prefix")
    copy = F.pmod(F.xxhash64("_address"), F.lit(COPIES)).cast("int")
    copied = geo.prefixes.where(digits > WIDE_DIGITS).withColumn("_copy", F.explode(F.lit(list(range(COPIES)))))
    narrow = tried(WIDE_DIGITS + 1, A.IPV6_DIGITS).withColumn("_copy", copy).join(copied.hint("shuffle_merge"), ["prefix", "_copy"])
    met = wide.select("_address", "match").unionByName(narrow.select("_address", "match"))
    found = met.groupBy("_address").agg(F.min("match").alias("_match")).withColumnRenamed("_address", "_found")
    spread = F.concat(F.lit("none "), F.pmod(F.monotonically_increasing_id(), F.lit(SPREAD)).cast("string"))
    placed = named.withColumn("_place", F.coalesce("_address", spread))
    joined = placed.join(found.hint("shuffle_merge"), F.col("_place") == F.col("_found"), "left")
    return joined.select(*keyed.columns, geo.country(F.col("_match")))


def _locate_in_place(requests: DataFrame, geo: GeoTable, ip: str, lengths: list[int]) -> DataFrame:
    """Country of every row without a shuffle: one broadcast join per length of prefix.

    The table goes out once in all, each part holding the prefixes of one length.
    """
    located = A.with_address_text(requests, F.col(ip), "_hex")
    # Out of a generator, so that no join works the text out anew.
    located = located.select(*requests.columns, F.explode(F.array("_hex")).alias("_address"))
    found = []
    for length in lengths:
        of_length = geo.prefixes.where(F.length("prefix") == length)
        part = of_length.select(F.col("prefix").alias(f"_prefix{length}"), F.col("match").alias(f"_match{length}"))
        located = located.join(F.broadcast(part), F.substring("_address", 1, length) == F.col(f"_prefix{length}"), "left")
        found.append(F.col(f"_match{length}"))
    if not found:
        return requests.withColumn("country", F.lit(S.NO_COUNTRY))
    match = F.least(*found) if len(found) > 1 else found[0]
    return located.select(*requests.columns, match.alias("_match")).select(*requests.columns, geo.country(F.col("_match")))


def with_country(
    requests: DataFrame, geo: GeoTable, ip: str = "remoteip", broadcast_bytes: int = BROADCAST_BYTES, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Add ``country`` to every request, which is read once.

    A table that can be sent and has few lengths of prefix (IPv4 has eight) is met by
    the requests where they are. For any other they are written to the shared folder first; addresses are counted and each
    distinct one is looked up once. If the addresses found are few they are sent.
    Otherwise they are joined by a shuffle, except for hot addresses: their rows meet a
    broadcast copy of at most ``MOST_HOT`` rows and are spread by their place in the
    input, like rows without an address, so that one busy address does not fill one task.
    """
    lengths = sorted({n for found in geo.lengths.values() for n in found})
    if geo.broadcastable and len(lengths) <= MOST_JOINS:
        return _locate_in_place(requests, geo, ip, lengths)
    requests = staged(requests, "requests")
    counted = requests.where(F.col(ip).isNotNull()).groupBy(F.col(ip).alias("_ip")).agg(F.count(F.lit(1)).alias("_n"))
    found = staged(resolve_addresses(counted, geo, ["_ip"], F.col("_ip")).withColumnRenamed("country", "_country"), "addresses")
    text = F.octet_length("_ip") + F.octet_length("_country") + ROW_BYTES
    size = found.agg(F.coalesce(F.sum(text), F.lit(0)).alias("bytes"), F.coalesce(F.sum("_n"), F.lit(0)).alias("requests")).first()
    if size.bytes <= broadcast_bytes:
        joined = requests.join(F.broadcast(found), F.col(ip) == F.col("_ip"), "left")
        return joined.select(*requests.columns, F.coalesce("_country", F.lit(S.NO_COUNTRY)).alias("country"))
    hot = found.where(F.col("_n") > max(hot_rows, size.requests // MOST_HOT)).select(
        F.col("_ip").alias("_hot_ip"), F.col("_country").alias("_hot_country")
    )
    spread = F.concat(F.lit("hot "), F.pmod(F.monotonically_increasing_id(), F.lit(SPREAD)).cast("string"))
    own_place = F.col("_hot_ip").isNotNull() | F.col(ip).isNull()
    marked = requests.withColumn("_spread", spread).join(F.broadcast(hot), F.col(ip) == F.col("_hot_ip"), "left").withColumn(
        "_join_ip", F.when(own_place, F.col("_spread")).otherwise(F.col(ip))
    )
    joined = marked.join(found.hint("shuffle_merge"), F.col("_join_ip") == F.col("_ip"), "left")
    country = F.coalesce("_hot_country", "_country", F.lit(S.NO_COUNTRY)).alias("country")
    return joined.select(*requests.columns, country)
