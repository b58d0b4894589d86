import ipaddress
import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from bucketlens.functions import addresses as A
from bucketlens.operators import geo as G
from bucketlens.operators.locations import location_histogram
from helpers import physical_plan, rows, values

ODD = [
    "256.1.1.1", "01.2.3.4", "1.2.3", "bad", "", "-", None, "::", "::1", "1::", "2001:DB8:0:0:0:0:0:1",
    "::ffff:1.2.3.4", "64:ff9b::1.2.3.4", "1:2:3:4:5:6:7:8:9", "1::2::3", "1:2:3:4:5:6:7::", "::2:3:4:5:6:7:8",
    "1:2:3:4:5:6:7:8::", "12345::", ":1:2", "1:2:3", "::1.2.3.400", "1.2.3.4\n", " 1.2.3.4",
]


def address_key(text):
    """Family digit and hexadecimal digits by Python's own address parser."""
    if text is None:
        return None
    try:
        address = ipaddress.ip_address(text)
    except ValueError:
        return None
    if address.version == 6 and address.ipv4_mapped:
        address = address.ipv4_mapped
    return f"4{int(address):08x}" if address.version == 4 else f"6{int(address):032x}"


def near_addresses(generator, count):
    """Addresses close together, so that they share networks."""
    v4 = [ipaddress.IPv4Address(generator.getrandbits(4) << 28 | generator.getrandbits(8)) for _ in range(count)]
    v6 = [ipaddress.IPv6Address(0x2001 << 112 | generator.getrandbits(6) << 90 | generator.getrandbits(3)) for _ in range(count)]
    return [str(a) for a in v4 + v6]


def test_address_text(spark):
    generator = random.Random(1)
    texts = ODD + [str(ipaddress.IPv6Address(generator.getrandbits(128))) for _ in range(100)]
    texts += [str(ipaddress.IPv4Address(generator.getrandbits(32))) for _ in range(100)]
    df = spark.createDataFrame([(t,) for t in texts], "ip string")
    found = {r.ip: r.key for r in A.with_address_text(df, F.col("ip"), "key").collect()}
    assert found == {t: address_key(t) for t in texts}


@pytest.fixture(scope="module")
def networks():
    generator = random.Random(2)
    found = set()
    for _ in range(300):
        if generator.random() < 0.5:
            base = generator.getrandbits(4) << 28 | generator.getrandbits(8)
            found.add(ipaddress.ip_network((base, generator.randint(0, 32)), strict=False))
        else:
            base = 0x2001 << 112 | generator.getrandbits(6) << 90 | generator.getrandbits(3)
            bits = generator.choice([3, 12, 16, 19, 20, 29, 32, 33, 34, 35, 36, 48, 64, 128])
            found.add(ipaddress.ip_network((base, bits), strict=False))
    return [(str(n), None if i % 7 == 0 else f"C{i}") for i, n in enumerate(sorted(found, key=str))]


@pytest.fixture(scope="module")
def ranges():
    generator = random.Random(3)
    found = []
    for i in range(60):
        start = generator.getrandbits(32)
        found.append((start, min(2**32 - 1, start + generator.getrandbits(generator.randint(0, 30))), f"R{i}"))
    return found


@pytest.fixture(scope="module")
def table(spark, networks, ranges):
    return G.geo_table(
        spark.createDataFrame(ranges, "range_start bigint, range_end bigint, iso_code string"),
        spark.createDataFrame(networks, "network string, iso_code string"),
    )


def country_of(text, networks, ranges):
    key = address_key(text)
    if key is None:
        return "N/A"
    number, version = int(key[1:], 16), 4 if key[0] == "4" else 6
    holding = []
    for network, iso in networks:
        parsed = ipaddress.ip_network(network)
        if parsed.version == version and int(parsed.network_address) <= number <= int(parsed.broadcast_address):
            holding.append((parsed.num_addresses, iso or "", iso))
    if version == 4:
        holding += [(end - start + 1, iso, iso) for start, end, iso in ranges if start <= number <= end]
    return (min(holding, key=lambda h: h[:2])[2] or "N/A") if holding else "N/A"


def probes():
    generator = random.Random(4)
    spread = [str(ipaddress.IPv4Address(generator.getrandbits(32))) for _ in range(200)]
    return ODD + near_addresses(generator, 200) + spread


@pytest.mark.parametrize("broadcastable", [True, False])
def test_narrowest_range_wins(spark, table, networks, ranges, broadcastable):
    addresses = probes()
    requests = spark.createDataFrame([(i, a) for i, a in enumerate(addresses)], "i int, remoteip string")
    looked_up = G.with_country(requests, replace(table, broadcastable=broadcastable))
    assert rows(looked_up) == sorted(
        ((i, a, country_of(a, networks, ranges)) for i, a in enumerate(addresses)), key=repr
    )


def test_prefixes_cover_the_range_exactly(spark):
    ranges = [(5, 5, "A"), (0, 2**32 - 1, "B"), (15, 16, "C"), (1, 2**32 - 2, "D"), (256, 511, "E"), (9, 8, "F")]
    for start, end, iso in ranges:
        one = spark.createDataFrame([(start, end, iso)], "range_start bigint, range_end bigint, iso_code string")
        prefixes = values(G.geo_table(one).prefixes, "prefix")
        covered = sorted((int(p[1:].ljust(8, "0"), 16), 16 ** (9 - len(p))) for p in prefixes)
        assert sum(size for _, size in covered) == max(end - start + 1, 0)
        assert all(covered[i][0] + covered[i][1] == covered[i + 1][0] for i in range(len(covered) - 1))
        assert not covered or covered[0][0] == start
        assert len(prefixes) <= 240


@pytest.mark.parametrize("broadcast_bytes", [10**8, 0])
def test_hot_address_and_missing_addresses(spark, table, networks, ranges, broadcast_bytes):
    """One address with most of the rows, and many rows without any."""
    addresses = ["10.0.0.1"] * 3000 + [None] * 1500 + near_addresses(random.Random(5), 300)
    requests = spark.createDataFrame([(i, a) for i, a in enumerate(addresses)], "i int, remoteip string")
    large = replace(table, broadcastable=False)
    looked_up = {r.i: r.country for r in G.with_country(requests, large, broadcast_bytes=broadcast_bytes, hot_rows=50).collect()}
    assert looked_up == {i: country_of(a, networks, ranges) for i, a in enumerate(addresses)}


def test_lookup_of_counted_addresses_adds_no_shuffle(prepared, geo):
    plan = physical_plan(location_histogram(prepared, geo, ["day"]), run=True)
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    # Counting per address, summing per country, and the small table itself.
    assert plan.count("Exchange hashpartitioning(day") == 2
    assert plan.count("Exchange hashpartitioning") == 3
    assert "SortAggregate" not in plan


def test_lookup_per_request_agrees_with_lookup_per_count(prepared, geo):
    by_request = G.with_country(prepared, geo).groupBy("day", "country").count()
    assert rows(by_request) == rows(location_histogram(prepared, geo, ["day"]))


@pytest.fixture
def many_tasks(spark):
    """Plans as on a cluster: a dozen tasks, nothing decided at run time, nothing sent unasked."""
    settings = {"spark.sql.shuffle.partitions": "12", "spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def partition_sizes(df):
    # The country is used, or the plan would leave the lookup out.
    sizes = df.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"), F.max("country"))
    return [r.n for r in sizes.collect()]


def test_many_codes(spark):
    ranges = spark.range(1_500).selectExpr("id * 10 AS range_start", "id * 10 + 4 AS range_end", "concat('C', id) AS iso_code")
    table = G.geo_table(ranges)
    assert table.codes == []
    asked = spark.createDataFrame([("0.0.0.3",), ("0.0.0.7",), ("0.0.58.126",), (None,)], "remoteip string")
    for broadcastable in (True, False):
        located = G.resolve_addresses(asked, replace(table, broadcastable=broadcastable), ["remoteip"], asked["remoteip"])
        assert rows(located) == sorted([("0.0.0.3", "C0"), ("0.0.0.7", "N/A"), ("0.0.58.126", "C1497"), (None, "N/A")], key=repr)


def test_shuffled_lookup_of_counts_without_hot_tasks(spark, table, many_tasks):
    counted = spark.range(6_000).selectExpr(
        "CAST(id AS STRING) AS k", "IF(id % 3 = 0, concat_ws('.', 10, id % 250, id % 7, id % 200), NULL) AS remoteip"
    )
    located = G.resolve_addresses(counted, replace(table, broadcastable=False), ["k"], counted["remoteip"])
    sizes = partition_sizes(located)
    assert sum(sizes) == 6_000 and max(sizes) < 2.5 * 6_000 / 12
    expected = G.resolve_addresses(counted, table, ["k"], counted["remoteip"])
    assert rows(located) == rows(expected)


def test_shuffled_country_of_a_single_column_without_hot_tasks(spark, table, many_tasks):
    requests = spark.range(9_000).selectExpr(
        "CASE id % 3 WHEN 0 THEN '10.1.0.7' WHEN 1 THEN NULL ELSE concat_ws('.', 10, id % 250, id % 7, id % 200) END AS remoteip"
    )
    located = G.with_country(requests, replace(table, broadcastable=False), broadcast_bytes=0, hot_rows=500)
    sizes = partition_sizes(located)
    assert sum(sizes) == 9_000 and max(sizes) < 2.5 * 9_000 / 12
    assert rows(located) == rows(G.with_country(requests, table))


def test_requests_are_read_once(spark, tables, geo):
    """A table that is sent meets the requests where they are: one scan, no shuffle."""
    from registry.tables import prepared as derive

    plan = physical_plan(G.with_country(spark.read.parquet(f"{tables}/events.parquet").selectExpr("event_id", "'10.0.0.1' AS remoteip"), geo))
    assert plan.count("FileScan parquet [event_id") == 1 and "Exchange hashpartitioning" not in plan.split("BroadcastExchange")[0]
    assert physical_plan(G.with_country(derive(spark, tables), geo)).count("regexp_extract(props") == 1


def number(address):
    return int(ipaddress.ip_address(address))


@pytest.fixture(scope="module")
def address_ranges():
    """Ranges that nest, touch, cross the halves, and odd ones."""
    draw = random.Random(9)
    base = 0x2001 << 112
    found = [
        ("2001::", "2001::ffff:ffff:ffff:ffff", "HA"), ("2001::ffff:ffff:ffff:fff0", "2001:0:0:1::f", "XX"), ("::", "ffff:" * 7 + "ffff", "ALL"),
        ("2001::7", "2001::7", "ONE"), ("2001::8", "2001::7", "NO"), ("10.0.0.0", "2001::", "NO"), ("bad", "2001::1", "NO"), (None, "::1", "NO"),
        ("0.0.0.0", "255.255.255.255", "V4"), ("10.0.0.3", "10.0.1.200", None), ("::ffff:10.0.0.9", "::ffff:10.0.0.12", "MAP"),
    ]
    for k in range(60):
        first = base + (draw.getrandbits(3) << 63) + draw.choice([0, 1, draw.getrandbits(9), 2**64 - draw.randint(1, 40)])
        last = first + draw.choice([0, 1, 15, 16, draw.getrandbits(9), draw.getrandbits(66)])
        found.append((str(ipaddress.IPv6Address(first)), str(ipaddress.IPv6Address(last)), f"C{k}"))
    return found


def plain_lookup(address, address_ranges):
    """Country of the narrowest range; of equal ones the first code in order."""
    key, best = address_key(address), None
    for first, last, iso in address_ranges:
        ends = address_key(first), address_key(last)
        if key and all(ends) and ends[0][0] == ends[1][0] == key[0] and ends[0] <= key <= ends[1]:
            candidate = (int(ends[1][1:], 16) - int(ends[0][1:], 16), iso or "")
            best = min(best, candidate) if best else candidate
    return (best[1] if best else "") or "N/A"


@pytest.mark.parametrize("broadcastable", [True, False])
def test_ranges_of_any_family(spark, address_ranges, networks, broadcastable):
    ranges = spark.createDataFrame(address_ranges, "first_address string, last_address string, iso_code string")
    table = G.geo_table(address_ranges=ranges)
    draw = random.Random(4)
    asked = [*ODD, "10.0.0.2", "10.0.0.3", "10.0.0.10", "10.0.1.200", "10.0.1.201"]
    for first, last, _ in address_ranges:
        if address_key(first) and address_key(last) and ":" in first and ":" in last and number(first) <= number(last):
            inside = number(first) + draw.randrange(number(last) - number(first) + 1)
            for n in (number(first) - 1, number(first), inside, number(last), number(last) + 1):
                if 0 <= n < 2**128:
                    asked.append(str(ipaddress.IPv6Address(n)))
    requests = spark.createDataFrame(list(enumerate(asked)), "i int, remoteip string")
    found = {r.i: r.country for r in G.with_country(requests, replace(table, broadcastable=broadcastable)).collect()}
    assert found == {i: plain_lookup(a, address_ranges) for i, a in enumerate(asked)}


def test_pieces_of_an_ipv6_range(spark, address_ranges):
    """The pieces of each range are next to each other and cover just the range."""
    numbered = [(first, last, str(k)) for k, (first, last, _) in enumerate(address_ranges)]
    ranges = spark.createDataFrame(numbered, "first_address string, last_address string, iso_code string")
    found = {}
    for r in G._ipv6_range_prefixes(G._hex_ends(ranges)).collect():
        found.setdefault(int(r.iso_code), []).append((int(r.prefix[1:].ljust(32, "0"), 16), 16 ** (33 - len(r.prefix)), int(r.width, 16)))
    for k, (first, last, _) in enumerate(address_ranges):
        keys = address_key(first), address_key(last)
        if not all(keys) or keys[0][0] != "6" or keys[1][0] != "6" or keys[0] > keys[1]:
            assert k not in found
            continue
        pieces = sorted(found[k])
        assert pieces[0][0] == number(first) and pieces[-1][0] + pieces[-1][1] - 1 == number(last) and len(pieces) <= 944
        assert all(a + n == b for (a, n, _), (b, _, _) in zip(pieces, pieces[1:]))
        assert {w for *_, w in pieces} == {number(last) - number(first)}


def test_ranges_and_networks_together(spark):
    """Widths of both families and of all three kinds of input are compared as numbers of addresses."""
    networks = spark.createDataFrame([("2001::/20", "A"), ("2001::/64", "B"), ("10.0.0.0/8", "C"), ("10.0.0.0/30", "D")], "network string, iso_code string")
    ranges = spark.createDataFrame([(10 << 24, (10 << 24) + 255, "E")], "range_start bigint, range_end bigint, iso_code string")
    given = [("2001::", "2001:0:1::", "F"), ("2001::", "2001::ffff", "G"), ("10.0.0.0", "10.0.0.9", "H"), ("2001::", "2001::ffff:ffff:ffff:ffff", "Z")]
    table = G.geo_table(ranges, networks, spark.createDataFrame(given, "first_address string, last_address string, iso_code string"))
    asked = {"2001::1": "G", "2001::1:0": "B", "2001:0:0:1::": "F", "2001:0:1::1": "A", "10.0.0.1": "D", "10.0.0.5": "H", "10.0.0.99": "E", "10.9.0.0": "C"}
    requests = spark.createDataFrame([(a,) for a in asked], "remoteip string")
    assert {r.remoteip: r.country for r in G.with_country(requests, table).collect()} == asked
