import math
import random

import numpy as np
import pytest
from cases import awkward_rows, brute_fingerprint, brute_lines, brute_spans, groups, sha

from bucketlens.llm import embedding_dedup, line_dedup, repeats, simhash, suffix_dedup
from bucketlens.llm.components import components, local_labels

ROWS = [r[:2] for r in awkward_rows()]


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# Suffix dedup


@pytest.mark.parametrize("crowded_bytes", [suffix_dedup.CROWDED_BYTES, 3_000, 0])
def test_suffix_dedup_equals_brute_force(awkward, crowded_bytes):
    query = suffix_dedup.suffix_query(awkward, 100, crowded_bytes)
    assert query.where("n_kept <> n_bytes - n_removed").isEmpty()
    got = found(query.drop("n_kept"))
    assert got == sorted(brute_spans(ROWS, 100), key=repr)


@pytest.mark.parametrize("crowded_bytes", [suffix_dedup.CROWDED_BYTES, 3_000, 0])
def test_suffix_dedup_keeps_the_first(spark, awkward, crowded_bytes):
    rows = sorted({r for r in ROWS if r[0] is not None})
    given = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    kept = suffix_dedup.remove_repeats(given, 100, crowded_bytes=crowded_bytes).collect()
    expected = [(i, removed, runs, digest) for i, _, removed, runs, digest in brute_spans(rows, 100, first_only=True)]
    assert sorted((r.doc_id, r.n_removed, r.n_spans, sha(bytes(r.kept))) for r in kept) == expected


@pytest.mark.parametrize("crowded_bytes", [suffix_dedup.CROWDED_BYTES, 2_000, 0])
def test_suffix_dedup_on_periodic_and_shifted_texts(spark, crowded_bytes):
    draw = random.Random(5)
    base = "".join(draw.choice("ab") for _ in range(900))
    texts = ["a" * 500, "a" * 99, "a" * 100, base, base[37:800], "c" + base[200:420] + "d" + base[100:330], "abc" * 200]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    got = found(suffix_dedup.suffix_query(docs, 100, crowded_bytes).drop("n_kept"))
    assert got == sorted(brute_spans(rows, 100), key=repr)
    kept = suffix_dedup.remove_repeats(docs, 100, crowded_bytes=crowded_bytes).collect()
    expected = [(i, removed, runs, digest) for i, _, removed, runs, digest in brute_spans(rows, 100, first_only=True)]
    assert sorted((r.doc_id, r.n_removed, r.n_spans, sha(bytes(r.kept))) for r in kept) == expected


def test_suffix_dedup_of_a_passage_in_very_many_texts(spark):
    """A crowded key is divided: the rows of each round follow the number of texts."""
    draw = random.Random(6)
    word = lambda n: "".join(draw.choice("abcdefgh ") for _ in range(n))
    passage = word(180)
    rows = [(k, word(draw.randint(60, 160)) + passage[: draw.randint(150, 180)] + word(draw.randint(0, 90))) for k in range(120)]
    rows += [(1_000 + k, rows[k][1][:200] + "!" + rows[k][1][201:]) for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    got = found(suffix_dedup.suffix_query(docs, 100, 5_000).drop("n_kept"))
    assert got == sorted(brute_spans(rows, 100), key=repr)


def test_suffix_dedup_of_passages_at_the_limit(spark):
    """Passages of over 50 words, in two texts each: 400 bytes are removed, 399 stay, as does all other text."""
    draw = random.Random(7)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(draw.randint(3, 7)))
    prose = lambda n: " ".join(word() for _ in range(n))
    long, short = (prose(100)[:n] for n in (400, 399))
    assert min(len(long.split()), len(short.split())) > 50
    texts = [f"{prose(60)} {k}{passage}{k} {prose(60)}" for k, passage in enumerate([long, long, short, short, "", ""])]
    rows = list(enumerate(texts))
    query = suffix_dedup.suffix_query(spark.createDataFrame(rows, "doc_id BIGINT, text STRING"))
    got = found(query.drop("n_kept"))
    assert got == sorted(brute_spans(rows, 400), key=repr)
    assert [r[2] for r in got] == [400, 400, 0, 0, 0, 0]


def test_suffix_dedup_of_an_empty_table(nothing):
    assert found(suffix_dedup.suffix_query(nothing)) == []


def test_prefix_ranks_follow_the_order_of_suffixes():
    data = np.frombuffer(b"banana bandana banana", dtype=np.uint8)
    ranks = suffix_dedup.prefix_classes(data, 5)
    words = [data.tobytes()[i : i + 5].ljust(5, b"\0") for i in range(len(data))]
    assert [sorted(set(words)).index(w) for w in words] == ranks.tolist()


# Line dedup


@pytest.mark.parametrize("min_docs, min_chars", [(2, 1), (2, 7), (10, 1)])
def test_line_dedup_equals_brute_force(awkward, min_docs, min_chars):
    expected = [(i, n, gone, sha(rest)) for i, n, gone, rest in brute_lines(ROWS, min_docs, min_chars)]
    assert found(line_dedup.line_dedup_query(awkward, min_docs, min_chars)) == sorted(expected, key=repr)


def test_line_dedup_keeps_columns_and_untouched_texts(awkward):
    kept = line_dedup.dedup_lines(awkward, 2)
    assert kept.columns == awkward.columns
    expected = [(i, t if gone == 0 else rest) for (i, t), (_, _, gone, rest) in zip(ROWS, brute_lines(ROWS, 2))]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(expected, key=repr)


def test_line_dedup_keeps_the_first_line(spark):
    given = spark.createDataFrame([(1, "A\nb\nA"), (2, "a\nc"), (3, "c ")], "doc_id BIGINT, text STRING")
    kept = line_dedup.dedup_lines(given, 2, keep_first=True).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == [(1, "A\nb"), (2, "c"), (3, "")]


def test_line_dedup_with_a_full_filter(awkward, monkeypatch):
    """A filter in which every bit is set costs comparisons, not results."""
    monkeypatch.setattr(line_dedup, "repeat_filter", lambda *_: np.full(1 << 23, 255, dtype=np.uint8))
    expected = [(i, n, gone, sha(rest)) for i, n, gone, rest in brute_lines(ROWS, 2)]
    assert found(line_dedup.line_dedup_query(awkward, 2)) == sorted(expected, key=repr)


@pytest.mark.parametrize("bits", [16, 20])
def test_filter_equals_brute_force(spark, bits):
    """Dense and sparse slices, tasks that share hashes or hold them twice."""
    draw = np.random.default_rng(3)
    given = draw.integers(0, 2**63, 30_000, dtype=np.uint64) * np.uint64(2)
    given = np.concatenate([given, given[:500], given[:20]])
    rows = [(int(h) - 2**63,) for h in given]
    made = repeats.repeat_filter(
        spark.createDataFrame(rows, "h BIGINT").repartition(5), lambda b: (b["h"].to_numpy().astype(np.int64) ^ np.int64(-(2**63))).view(np.uint64), bits
    )
    places, times = np.unique(repeats.positions(given, bits), return_counts=True)
    assert set(np.flatnonzero(np.unpackbits(made, bitorder="little"))) == set(places[times > 1].tolist())
    assert repeats.maybe_repeated(made, given[:500]).all()


@pytest.mark.parametrize("distinct", [1, 70_000, 16_000_000])
def test_few_single_hashes_are_suspected(distinct):
    """16 million: the distinct lines of some 5 GB, ten times what the check tool reads."""
    hashes = np.random.default_rng(4).integers(0, 2**64, distinct, dtype=np.uint64)
    once, twice = (np.zeros(1 << (repeats.filter_bits(distinct) - 3), dtype=np.uint8) for _ in range(2))
    for part in np.array_split(hashes, 1 + distinct // 1_000_000):
        repeats.add_hashes(once, twice, part)
    suspects = repeats.maybe_repeated(twice, hashes).sum()
    assert suspects <= 0.05 * distinct
    assert repeats.filter_bits(distinct) <= 27 and repeats.filter_bits(10**12) == repeats.MOST_BITS


def test_line_dedup_of_an_empty_table(nothing):
    assert found(line_dedup.line_dedup_query(nothing)) == []


# SimHash


@pytest.mark.parametrize("tile", [simhash.TILE, 2])
def test_simhash_equals_brute_force(spark, corpus, tile):
    rows = [tuple(r) for r in corpus.where("doc_id < 250").select("doc_id", "text").collect()] + [
        (-i if i else None, t) for i, t in ROWS
    ]
    prints = [brute_fingerprint(t) for _, t in rows]
    label = groups(len(rows), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 4)
    members = {}
    for (i, _), g in zip(rows, label):
        members.setdefault(g, []).append(i)
    name = {g: min((i for i in ids if i is not None), default=None) for g, ids in members.items()}
    expected = [(i, p if p < 2**63 else p - 2**64, name[g]) for (i, _), p, g in zip(rows, prints, label)]
    given = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    got = simhash.near_duplicates(given, tile=tile).select("doc_id", "fp", "component_id")
    assert found(got) == sorted(expected, key=repr)
    assert len(set(label)) < len(rows) - 5


def test_near_fingerprints_meet_at_a_home():
    draw = np.random.default_rng(1)
    left = draw.integers(-(2**63), 2**63, 4_000)
    flips = [sum(1 << int(b) for b in draw.choice(64, 4, replace=False)) for _ in left]
    right = (left.view(np.uint64) ^ np.array(flips, dtype=np.uint64)).view(np.int64)
    radius = simhash.COVERING_RADIUS + 4 // len(simhash.PARTS)
    at, number, home = simhash.anchors(left, radius)
    at_right, number_right, _ = simhash.anchors(right, radius)
    homes = set(zip(at[home].tolist(), number[home].tolist()))
    assert {i for i, n in zip(at_right.tolist(), number_right.tolist()) if (i, n) in homes} == set(range(len(left)))


def test_keep_one_of_each_component(awkward):
    kept = simhash.keep_one(awkward)
    assert kept.columns == awkward.columns
    all_found = simhash.near_duplicates(awkward).collect()
    ids = [r.doc_id for r in kept.collect() if r.doc_id is not None]
    assert sorted(ids) == sorted({r.component_id for r in all_found if r.component_id is not None})


def test_simhash_of_an_empty_table(nothing):
    assert found(simhash.simhash_query(nothing)) == []
    assert found(simhash.keep_one(nothing)) == []


# Components


def test_components_of_chains_and_hubs(spark):
    draw = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 180)] + [(300, 300)]
    edges += [(draw.randint(400, 600), draw.randint(400, 600)) for _ in range(150)]
    draw.shuffle(edges)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a BIGINT, b BIGINT")).collect()}
    nodes = sorted({n for a, b in edges if a != b for n in (a, b)})
    linked = set(edges) | {(b, a) for a, b in edges}
    label = groups(len(nodes), lambda x, y: (nodes[x], nodes[y]) in linked)
    assert got == {n: nodes[g] for n, g in zip(nodes, label)}
    a, b = np.array(edges).T
    assert {n: int(local_labels(a, b, 601)[n]) for n in nodes} == got


# Embeddings


def vectors():
    draw = np.random.default_rng(4)
    rows, number = [], 0
    for label in (1, 2, 3):
        for _ in range(12):
            base = draw.normal(size=16)
            for _ in range(draw.integers(1, 9)):
                rows.append((number, (base + draw.normal(size=16) * draw.choice([0.0, 0.05, 0.15])).astype(float).tolist(), label))
                number += 1
    odd = [
        (900, None, 1), (901, [0.0] * 16, 1), (902, [], 1), (903, [1.0, None] * 8, 1), (904, [float("nan")] + [1.0] * 15, 1),
        (905, [float("inf")] * 16, 1), (906, rows[0][1], None), (907, rows[0][1], 2), (908, rows[0][1], 1),
        (908, rows[0][1], 1), (None, rows[0][1], 1), (None, None, 1), (910, [1.0, 2.0], 1), (911, [2.0, 4.0], 1),
    ]
    return rows + odd


@pytest.mark.parametrize("tile", [embedding_dedup.TILE, 5])
def test_embedding_dedup_equals_brute_force(spark, tile):
    rows = vectors()

    def valid(row):
        _, v, label = row
        return label is not None and bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)

    def linked(a, b):
        (_, x, l), (_, y, m) = rows[a], rows[b]
        if not (valid(rows[a]) and valid(rows[b]) and l == m and len(x) == len(y)):
            return False
        return np.dot(x, y) / np.sqrt(np.dot(x, x) * np.dot(y, y)) >= 0.98

    label = groups(len(rows), linked)
    expected = []
    for n, row in enumerate(rows):
        links = sum(linked(n, m) for m in range(len(rows)) if m != n)
        ids = [rows[m][0] for m in range(len(rows)) if label[m] == label[n] and rows[m][0] is not None]
        component = min(ids, default=None) if valid(row) else row[0]
        expected.append((row[0], links, component, row[0] == component))
    given = spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT").selectExpr("*", "'x' AS size", "1 AS kept")
    exact = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], k) for i, v, k in rows]
    rows[:] = exact
    assert found(embedding_dedup.near_duplicates(given, tile=tile)) == sorted(expected, key=repr)


def test_embedding_error_bound_holds():
    draw = np.random.default_rng(6)
    x = draw.normal(size=(300, 24))
    x /= np.linalg.norm(x, axis=1)[:, None]
    q, scale, error = embedding_dedup.quantised(x)
    approximate = (q.astype(float) @ q.T.astype(float)) * scale[:, None] * scale
    length = np.linalg.norm(q.astype(float), axis=1) * scale
    bound = length[:, None] * error + error[:, None] * (length + error)
    assert (np.abs(approximate - x @ x.T) <= bound + 1e-12).all()


def test_embedding_dedup_of_an_empty_table(spark):
    given = spark.createDataFrame([], "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT")
    assert found(embedding_dedup.near_duplicates(given)) == []


def test_embedding_dedup_in_thousands_of_partitions(spark):
    """Numbers of classes stay small, however many tiles there are: one vector per tile here."""
    draw = np.random.default_rng(8)
    given = [(k, draw.normal(size=4).tolist(), 1) for k in range(2_060)]
    given += [(10_000 + k, [x * 1.001 + 1e-5 for x in v], 1) for k, v, _ in given[:20]]
    vectors_ = np.array([v for _, v, _ in given], dtype=np.float32).astype(float)
    unit = vectors_ / np.linalg.norm(vectors_, axis=1)[:, None]
    part = slice(0, 300)
    n_links = (unit[part] @ unit.T >= 0.9999999).sum(axis=1) - 1
    frame = spark.createDataFrame(given, "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT")
    got = {r.vec_id: r.n_links for r in embedding_dedup.near_duplicates(frame, threshold=0.9999999, tile=1).collect()}
    assert len(got) == 2_080 and [got[k] for k in range(300)] == n_links.tolist()


def test_numbers_of_classes_fit(spark):
    largest = ((2**31 << embedding_dedup.TILE_BITS) + 1000) * embedding_dedup.TILE + embedding_dedup.TILE
    assert largest < 2**63


def test_embedding_classes_with_equal_hashes(spark, monkeypatch):
    """Hashes that don't tell all classes apart are given up for others."""
    from pyspark.sql import functions as F

    real, tried = embedding_dedup._hashes, []

    def weak(seed):
        tried.append(seed)
        return F.struct(F.lit(0).cast("bigint").alias("h1"), F.lit(0).cast("bigint").alias("h2")) if seed < 2 else real(seed)

    monkeypatch.setattr(embedding_dedup, "_hashes", weak)
    given = spark.createDataFrame([(1, [1.0, 0.0], 1), (2, [0.0, 1.0], 1), (3, [-0.0, 1.0], 1)], "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT")
    assert found(embedding_dedup.near_duplicates(given)) == [(1, 0, 1, True), (2, 1, 2, True), (3, 1, 2, False)]
    assert tried == [0, 1, 2, 2]


def test_the_same_row_is_kept_however_rows_are_dealt(spark):
    text = "one text of some words that all of these rows share in full"
    rows = [(1, text, f"s{k}") for k in range(5)] + [(None, text + " and more", f"t{k}") for k in range(5)]
    kept = set()
    for n in (1, 2, 3, 7):
        docs = spark.createDataFrame(rows if n % 2 else rows[::-1], "doc_id BIGINT, text STRING, source STRING").repartition(n)
        kept.add(tuple(found(simhash.keep_one(docs))))
    assert len(kept) == 1


def test_kept_rows_move_once(spark, capsys):
    """Copies of a row meet in their tasks; whole texts pass one exchange."""
    rows = [(n % 50, f"text number {n % 50} of some words", "s") for n in range(2_000)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, source STRING")
    kept = simhash.keep_one(docs)
    assert kept.count() == len({r.doc_id for r in kept.collect()}) == kept.select("text").distinct().count()
    kept.explain()
    plan = capsys.readouterr().out.split("== Initial Plan ==")[0]
    carried = [line for line in plan.splitlines() if "Exchange" in line and "_none" in line and "_best" not in line]
    assert plan.count("partial_min_by") == 1 and len(carried) <= 2


def test_fingerprints_count_in_blocks(monkeypatch):
    text = " ".join(str(n * n % 97) for n in range(1_000)).encode()
    whole = simhash.fingerprint(text, 4)
    monkeypatch.setattr(simhash, "COUNTED", 7)
    assert simhash.fingerprint(text, 4) == whole
