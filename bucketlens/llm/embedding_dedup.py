"""Near duplicates among embeddings, by int8 tile products with error bounds.

Equal vectors of a label are one class. Classes are sorted along the direction of
most variance and cut into tiles. Two unit vectors with cosine c lie sqrt(2 - 2c)
apart, and their shadows on any direction no further, so only tiles that come that
close are compared. A tile holds its vectors also as int8 with a scale and the exact
length of what rounding took away; the product of two int8 vectors differs from the
true cosine by at most ``|X| e_y + e_x |Y| + e_x e_y``. Pairs that might reach the
threshold are computed again in double precision; no other pair can reach it.

A pair of tiles reports counts per class and a forest of its links, never all pairs.
"""

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from bucketlens.llm.common import spread_join, summed
from bucketlens.llm.components import components, local_labels
from bucketlens.session import staged

TILE = 2_048
# A partition of sorted classes makes fewer than 2 ** TILE_BITS tiles.
TILE_BITS = 20
BLOCK = 256
# Far above the rounding errors of sums in double precision.
SLACK = 1e-9


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.array(column.to_pylist(), dtype=np.float64).reshape(-1, dim)


def quantised(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 vectors, their scales, and the length of the rounding error of each."""
    scale = np.abs(unit).max(axis=1) / 127
    q = np.rint(unit / scale[:, None]).astype(np.int8)
    return q, scale, np.linalg.norm(unit - q * scale[:, None], axis=1)


def near_pairs(left: np.ndarray, right: np.ndarray, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs with cosine >= ``threshold``, in blocks of rows of ``left``."""
    norms = [np.sqrt((v * v).sum(axis=1)) for v in (left, right)]
    (qa, sa, ea), (qb, sb, eb) = (quantised(v / n[:, None]) for v, n in zip((left, right), norms))
    # Sums of int8 products are whole numbers below 2 ** 24 up to some 1,000 dimensions.
    kind = np.float32 if left.shape[1] * 127**2 < 2**24 else np.float64
    qa, qb = qa.astype(kind), qb.astype(kind)
    # In double precision: the bound has to hold to within SLACK.
    la, lb = (np.linalg.norm(q.astype(np.float64), axis=1) * s for q, s in ((qa, sa), (qb, sb)))
    for start in range(0, len(left), BLOCK):
        part = slice(start, start + BLOCK)
        most = (qa[part] @ qb.T) * (sa[part, None] * sb)
        most += la[part, None] * eb + ea[part, None] * (lb + eb)
        i, j = np.nonzero(most >= threshold - SLACK)
        for at in range(0, len(i), 65_536):
            a, b = i[at : at + 65_536] + start, j[at : at + 65_536]
            cosine = (left[a] * right[b]).sum(axis=1) / (norms[0][a] * norms[1][b])
            yield a[cosine >= threshold], b[cosine >= threshold]


def compare_tiles(left: np.ndarray, right: np.ndarray, sizes: np.ndarray, same: bool, threshold: float):
    """Links of each row of both tiles, and for each the smallest row it reaches.

    Rows of ``right`` are numbered after those of ``left``; ``same``: both are one tile,
    and only its own rows are numbered.
    """
    n = len(left) if same else len(left) + len(right)
    offset = 0 if same else len(left)
    counts, label = np.zeros(n, dtype=np.int64), np.arange(n)
    for a, b in near_pairs(left, right, threshold):
        b = b + offset
        if same:
            a, b = a[a < b], b[a < b]
        if len(a):
            counts += np.bincount(a, weights=sizes[b], minlength=n).astype(np.int64)
            counts += np.bincount(b, weights=sizes[a], minlength=n).astype(np.int64)
            label = local_labels(np.concatenate([a, np.arange(n)]), np.concatenate([b, label]), n)
    return counts, label


def _hashes(seed: int) -> Column:
    """Two hashes of a vector; 0 and -0 are the same component."""
    plain = F.transform("embedding", lambda x: x.cast("double") + F.lit(0.0))
    return F.struct(F.xxhash64(F.lit(2 * seed), plain).alias("h1"), F.xxhash64(plain, F.lit(2 * seed + 1)).alias("h2"))


def _valid() -> Column:
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists("embedding", lambda x: x != 0)
    return F.coalesce(F.col("label").isNotNull() & finite & some, F.lit(False))


def _tiles(classes: DataFrame, tile: int, partitions: int) -> DataFrame:
    """label, dim, tile, low, high, and the tile's vectors, class sizes and ids."""
    dims = [r[0] for r in classes.groupBy("dim").count().orderBy(F.desc("count"), "dim").limit(1).collect()]
    dim = dims[0] if dims else 1

    def products(batch: pa.RecordBatch) -> np.ndarray:
        x = _matrix(batch["embedding"], dim)
        x /= np.linalg.norm(x, axis=1)[:, None]
        return np.concatenate([x.sum(axis=0), (x.T @ x).ravel(), [len(x)]])

    sums = summed(classes.where(F.col("dim") == dim).select("embedding"), products, dim + dim * dim + 1)
    mean = sums[:dim] / max(1, sums[-1])
    spread = sums[dim:-1].reshape(dim, dim) / max(1, sums[-1]) - np.outer(mean, mean)
    direction = np.linalg.eigh(spread)[1][:, -1]

    @F.arrow_udf("double")
    def shadow(vectors: pa.Array) -> pa.Array:
        given = [np.array(v, dtype=float) for v in vectors.to_pylist()]
        # Vectors of another length have no shadow here; 0 keeps all of them together.
        return pa.array([float(v @ direction / np.linalg.norm(v)) if len(v) == dim else 0.0 for v in given])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, waiting = 0, []

        def packed(rows: list) -> pa.RecordBatch:
            nonlocal number
            number += 1
            first = rows[0]
            vectors = np.array([r["embedding"] for r in rows], dtype="<f8")
            return pa.RecordBatch.from_pylist(
                [{
                    "label": first["label"], "dim": first["dim"], "tile": (first["part"] << TILE_BITS) + number,
                    "low": first["shadow"], "high": rows[-1]["shadow"], "vectors": vectors.tobytes(),
                    "sizes": [r["size"] for r in rows], "first_ids": [r["first_id"] for r in rows],
                    "hashes": [r["hashes"] for r in rows],
                }],
                schema=schema,
            )

        for batch in batches:
            for row in batch.to_pylist():
                if waiting and (len(waiting) == tile or any(waiting[0][k] != row[k] for k in ("label", "dim"))):
                    yield packed(waiting)
                    waiting = []
                waiting.append(row)
        if waiting:
            yield packed(waiting)

    label, first_id = (classes.schema[c].dataType for c in ("label", "first_id"))
    schema = pa.schema([
        ("label", to_arrow_type(label)), ("dim", pa.int32()), ("tile", pa.int64()), ("low", pa.float64()), ("high", pa.float64()),
        ("vectors", pa.binary()), ("sizes", pa.list_(pa.int64())), ("first_ids", pa.list_(to_arrow_type(first_id))),
        ("hashes", pa.list_(pa.struct([("h1", pa.int64()), ("h2", pa.int64())]))),
    ])
    ranged = (
        classes.withColumn("shadow", shadow("embedding"))
        .repartitionByRange(partitions, "label", "dim", "shadow")
        .sortWithinPartitions("label", "dim", "shadow", "first_id")
        .withColumn("part", F.spark_partition_id().cast("bigint"))
    )
    columns = f"label {label.simpleString()}, dim INT, tile BIGINT, low DOUBLE, high DOUBLE, vectors BINARY, "
    columns += f"sizes ARRAY<BIGINT>, first_ids ARRAY<{first_id.simpleString()}>, hashes ARRAY<STRUCT<h1: BIGINT, h2: BIGINT>>"
    return staged(ranged.mapInArrow(pack, columns), "embedding-tiles")


def near_duplicates(vectors: DataFrame, threshold: float = 0.98, tile: int = TILE) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of (vec_id, embedding, label).

    A vector that is NULL, empty or zero, holds a NULL or non-finite component, or has
    no label links with nothing and is kept; vectors of different lengths don't link.
    Rows that are repeated are vectors of their own. Rows without an id count as
    links, but give a component its id only if all of it has none: it is then NULL.
    ``kept`` compares ids with NULL equal to NULL.
    """
    given = vectors.select("vec_id", "embedding", "label")
    classes = given.where(_valid()).groupBy("label", "embedding").agg(F.count(F.lit(1)).alias("size"), F.min("vec_id").alias("first_id"))
    grouped = staged(classes.withColumn("dim", F.size("embedding")), "embedding-classes")
    # Two hashes name a class of a label, so that vectors themselves need not be joined.
    # Should two classes share both, other hashes are taken.
    for seed in count():
        classes = grouped.withColumn("hashes", _hashes(seed))
        if classes.groupBy("label", "hashes").count().where("count > 1").isEmpty():
            break
    partitions = max(1, -(-classes.count() // tile))
    tiles = _tiles(classes, tile, partitions)

    # A class is known by the number of its tile and its place there.
    metas = tiles.select("label", "dim", "tile", "low", "high")
    other = metas.toDF("label", "dim", "tile_b", "low_b", "high_b")
    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + SLACK
    close = metas.join(other, ["label", "dim"]).where(
        (F.col("tile") <= F.col("tile_b"))
        & (F.greatest("low", "low_b") - F.least("high", "high_b") <= reach)
    )
    payload = tiles.select("tile", "vectors", "sizes")
    pairs = (
        close.select("dim", "tile", "tile_b")
        .join(payload, "tile")
        .join(payload.toDF("tile_b", "vectors_b", "sizes_b"), "tile_b")
        .repartition("tile", "tile_b")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                left, right = (np.frombuffer(row[k], dtype="<f8").reshape(-1, row["dim"]) for k in ("vectors", "vectors_b"))
                same = row["tile"] == row["tile_b"]
                sizes = np.array(row["sizes"] if same else row["sizes"] + row["sizes_b"])
                counts, label = compare_tiles(left, right, sizes, same, threshold)
                places = row["tile"] * tile + np.arange(len(left))
                nodes = places if same else np.concatenate([places, row["tile_b"] * tile + np.arange(len(right))])
                found = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes[found]), pa.array(counts[found]), pa.array(nodes[label[found]])], names=["node", "links", "linked"]
                )

    reported = staged(pairs.mapInArrow(compare, "node BIGINT, links BIGINT, linked BIGINT"), "embedding-links")
    counted = reported.groupBy("node").agg(F.sum("links").alias("links"))
    rooted = components(reported.select(F.col("node").alias("a"), F.col("linked").alias("b")))

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                n = len(row["sizes"])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["label"]] * n, label_type), pa.array(row["hashes"], hash_type),
                        pa.array(row["tile"] * tile + np.arange(n)), pa.array(row["sizes"], pa.int64()), pa.array(row["first_ids"], id_type),
                    ],
                    names=["label", "hashes", "node", "size", "first_id"],
                )

    kinds = dict(grouped.dtypes)
    label_type, id_type = (to_arrow_type(grouped.schema[c].dataType) for c in ("label", "first_id"))
    hash_type = pa.struct([("h1", pa.int64()), ("h2", pa.int64())])
    placed = tiles.select("label", "hashes", "tile", "sizes", "first_ids").mapInArrow(
        unpack, f"label {kinds['label']}, hashes STRUCT<h1: BIGINT, h2: BIGINT>, node BIGINT, size BIGINT, first_id {kinds['first_id']}"
    )
    known = staged(
        placed.join(counted, "node", "left").join(rooted, "node", "left").select(
            "label", "hashes", "first_id", F.coalesce("root", "node").alias("root"),
            (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"),
        ),
        "embedding-roots",
    )
    named = known.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_class = spread_join(known.drop("first_id"), named, ["root"], ["hashes"], copies=4).drop("root")
    asked = given.select("vec_id", _valid().alias("_valid"), "label", F.when(_valid(), _hashes(seed)).alias("hashes"))
    told = spread_join(asked, of_class, ["label", "hashes"], ["vec_id"])
    result = told.select(
        "vec_id",
        F.when(F.col("_valid"), F.col("n_links")).otherwise(0).cast("bigint").alias("n_links"),
        F.when(F.col("_valid"), F.col("component_id")).otherwise(F.col("vec_id")).alias("component_id"),
    )
    return result.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
