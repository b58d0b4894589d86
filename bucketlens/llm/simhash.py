"""Near duplicates by SimHash, compared around the anchors of a covering code.

The 64 bits are cut into three parts. Two fingerprints that differ in at most five
bits differ in at most one bit of some part. On each part the words of the binary Golay
code are the anchors: it is perfect, every value lies within distance 3 of exactly
one. A fingerprint's home is that one; it is copied to all anchors within distance
3 + 1. So of two near ones, each finds the other at its home. Around an anchor the
fingerprints at home are compared with all copies.

Equal fingerprints are one throughout. An anchor with very many copies is cut into
tiles that meet pairwise in separate tasks. A tile reports a forest of its links,
never all pairs.
"""

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bucketlens.llm.common import packed, spread_join
from bucketlens.llm.components import components, local_labels
from bucketlens.session import staged

# Fixed value: generator polynomial of the binary Golay code of length 23.
GENERATOR = 0b110001110101
LENGTH, CHECKS, COVERING_RADIUS = 23, 11, 3
# Lowest bit and width of each part of a fingerprint.
PARTS = ((0, 21), (21, 21), (42, 22))
TILE = 8_192
# Shingles whose bits are counted at a time: 64 bytes each.
COUNTED = 1 << 16


def fingerprint(text: bytes | None, shingle: int) -> int:
    """Majority bits of the XXH64 (seed 42) of all word shingles, as a signed number."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    last = min(shingle, len(words)) - 1
    spans = zip(starts[: len(words) - last].tolist(), ends[last:].tolist())
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[s:e], 42) for s, e in spans), dtype="<u8", count=len(words) - last)
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, len(hashes), COUNTED):
        block = hashes[start : start + COUNTED].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    majority = 2 * ones > len(hashes)
    return int(np.packbits(majority, bitorder="little").view("<i8")[0])


def _syndromes(values: np.ndarray) -> np.ndarray:
    """Remainders modulo the generator."""
    left = values.astype(np.int64)
    for bit in range(LENGTH - 1, CHECKS - 1, -1):
        left = np.where(left >> bit & 1, left ^ (GENERATOR << (bit - CHECKS)), left)
    return left


def error_patterns(radius: int) -> tuple[np.ndarray, np.ndarray]:
    """All patterns of weight up to ``radius``, sorted by syndrome, and where each syndrome begins.

    The first pattern of a syndrome is the lightest, which leads to the home.
    """
    patterns = [sum(1 << b for b in bits) for weight in range(radius + 1) for bits in combinations(range(LENGTH), weight)]
    found = np.array(patterns, dtype=np.int64)
    syndromes = _syndromes(found)
    order = np.argsort(syndromes, kind="stable")
    return found[order], np.searchsorted(syndromes[order], np.arange((1 << CHECKS) + 1))


def anchors(fingerprints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index of the fingerprint, anchor number, and whether it is home, for all copies."""
    patterns, begins = error_patterns(radius)
    rows, numbers, homes = [], [], []
    for number, (low, width) in enumerate(PARTS):
        part = (fingerprints.view(np.uint64) >> np.uint64(low) & np.uint64((1 << width) - 1)).astype(np.int64)
        syndromes = _syndromes(part)
        first, many = begins[syndromes], np.diff(begins)[syndromes]
        at = np.repeat(np.arange(len(part)), many)
        nth = np.arange(len(at)) - np.repeat(np.cumsum(many) - many, many)
        rows.append(at)
        numbers.append((number << LENGTH) + (part[at] ^ patterns[first[at] + nth]))
        homes.append(nth == 0)
    return np.concatenate(rows), np.concatenate(numbers), np.concatenate(homes)


def tile_forest(homes: np.ndarray, members: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between homes and members as a forest: (fingerprint, a smaller linked one)."""
    nodes = np.unique(np.concatenate([homes, members]))
    at_home, at_member = np.searchsorted(nodes, homes), np.searchsorted(nodes, members)
    label = np.arange(len(nodes))
    step = max(1, (1 << 22) // max(1, len(members)))
    for start in range(0, len(homes), step):
        block = homes[start : start + step]
        near = np.bitwise_count((block[:, None] ^ members[None, :]).view(np.uint64)) <= max_bits
        i, j = np.nonzero(near)
        if len(i):
            a = np.concatenate([at_home[start + i], np.arange(len(nodes))])
            b = np.concatenate([at_member[j], label])
            label = local_labels(a, b, len(nodes))
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[moved], nodes[label[moved]]


def links(distinct: DataFrame, max_bits: int, tile: int = TILE) -> DataFrame:
    """a, b: a forest of the links between distinct fingerprints (column ``fp``)."""
    if max_bits >= 2 * len(PARTS):
        raise ValueError("two fingerprints must agree in all but one bit of a part")
    radius = COVERING_RADIUS + max_bits // len(PARTS)

    def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch["fp"].to_numpy()
            at, numbers, homes = anchors(fps, radius)
            yield pa.RecordBatch.from_arrays([pa.array(fps[at]), pa.array(numbers.astype(np.int32)), pa.array(homes)], names=["fp", "anchor", "home"])

    copies = staged(distinct.select("fp").mapInArrow(copy, "fp BIGINT, anchor INT, home BOOLEAN"), "simhash-copies")
    # At most three times 4,096 anchors, however many rows.
    crowded = copies.groupBy("anchor").agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("cuts")).where("cuts > 1")
    sized = copies.join(F.broadcast(crowded), "anchor", "left").withColumn("cuts", F.coalesce("cuts", F.lit(1)))
    own = F.pmod(F.xxhash64("fp"), F.col("cuts")).cast("int")
    others = F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)).alias("other")
    cut = sized.select("fp", "anchor", "home", own.alias("own"), others)
    dealt = cut.select("fp", "anchor", F.col("other").alias("i"), F.col("own").alias("j"), F.lit(False).alias("home")).unionByName(
        cut.where("home").select("fp", "anchor", F.col("own").alias("i"), F.col("other").alias("j"), "home")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, ["anchor", "i", "j"]):
            fps, home = group["fp"].to_numpy(), group["home"].to_numpy(zero_copy_only=False)
            if home.any():
                a, b = tile_forest(fps[home], fps[~home], max_bits)
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    tiles = dealt.repartition("anchor", "i", "j").sortWithinPartitions("anchor", "i", "j")
    return tiles.mapInArrow(compare, "a BIGINT, b BIGINT")


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Consecutive rows with equal ``keys``, whole, from sorted batches."""
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch[k].to_numpy(zero_copy_only=False) for k in keys]
        changes = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
        if waiting and any(waiting[-1][k][-1].as_py() != batch[k][0].as_py() for k in keys):
            yield pa.Table.from_batches(waiting).combine_chunks()
            waiting = []
        for start, end in zip([0, *changes], [*changes, batch.num_rows]):
            waiting.append(batch.slice(start, end - start))
            if end < batch.num_rows:
                yield pa.Table.from_batches(waiting).combine_chunks()
                waiting = []
    if waiting:
        yield pa.Table.from_batches(waiting).combine_chunks()


def near_duplicates(docs: DataFrame, shingle: int = 4, max_bits: int = 4, tile: int = TILE) -> DataFrame:
    """doc_id, _text (hash of the text), fp, component_id for every row of ``docs``.

    A NULL or empty text has no words and the fingerprint 0, which links like any
    other. Rows with a NULL id belong to components, but name one only where all
    ids in it are NULL; the component's id is then NULL.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t, shingle) for t in batch["text"].cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["_text"], pa.array(fps, pa.int64())], names=["doc_id", "_text", "fp"])

    given = docs.select("doc_id", F.xxhash64("text").alias("_text"), "text")
    printed = staged(given.mapInArrow(prints, f"doc_id {id_type}, _text BIGINT, fp BIGINT"), "simhash-prints")
    distinct = staged(printed.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-distinct")
    rooted = components(links(distinct, max_bits, tile))
    # One row per distinct fingerprint from here on; a component may hold very many.
    root = F.coalesce("root", "fp").alias("root")
    of_root = staged(distinct.join(rooted, F.col("fp") == F.col("node"), "left").select("fp", root, "first_id"), "simhash-roots")
    named = of_root.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_print = spread_join(of_root.select("fp", "root"), named, ["root"], ["fp"], copies=4).select("fp", "component_id")
    return spread_join(printed, of_print, ["fp"], ["doc_id", "_text"])


def _key(doc_id: Column) -> list[Column]:
    """An id without NULL, so that grouping and joining by it share one exchange."""
    return [doc_id.isNull().alias("_none"), F.coalesce(doc_id.cast("string"), F.lit("")).alias("_id")]


def keep_one(docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """Documents, columns as given: of each component the row with the smallest id.

    Rows without an id come last. Of rows with the same id and text the one whose other
    columns have the least hash stays, so the same one in every run; of equal rows one.
    """
    found = near_duplicates(docs, shingle, max_bits).withColumn("_none", F.col("doc_id").isNull())
    best = F.min(F.struct("_none", "doc_id", "_text"))
    # Components without any id are told apart by their fingerprint's root only, so
    # each distinct fingerprint without an id keeps a row of its own.
    key = [F.col("component_id"), F.when(F.col("component_id").isNull(), F.col("fp"))]
    kept = found.groupBy(*(k.alias(f"_k{i}") for i, k in enumerate(key))).agg(best.alias("_best"))
    kept = kept.select("_best.*").distinct().select(*_key(F.col("doc_id")), "_text")
    # One row of each id and text in every task, before whole texts move; they move once.
    rows = packed(docs).select("_row", *_key(F.col("_row.doc_id")), F.xxhash64("_row.text").alias("_text"))
    others = [F.col(f"_row.`{c}`") for c, kind in docs.dtypes if c not in ("doc_id", "text") and "map<" not in kind]
    first = F.min_by("_row", F.xxhash64(F.lit("others"), *others)).alias("_row")
    one = rows.groupBy("_none", "_id", "_text").agg(first)
    return one.join(kept, ["_none", "_id", "_text"], "left_semi").select("_row.*")


def simhash_query(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id, one row per given row.

    A text without words (NULL too) has the fingerprint 0. Equal rows share a component.
    A component is named by its smallest id, by NULL if it has none. An empty table gives no rows.
    """
    found = near_duplicates(docs)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
