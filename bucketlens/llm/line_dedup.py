"""Removing lines that many documents share.

Distinct lines are estimated first, by a sketch. Pass 1 puts the hashes of every
document's distinct line keys into a pair of Bloom filters (``repeats``) of a size that
fits these. Pass 2 emits only keys that the second filter suspects of a
repeat, with their document; these are counted exactly, by their text. The last
pass rewrites the documents, joined to the keys they lose.

A key is the line without blanks and control characters 9 to 13 at its ends, A-Z in
lower case. A NULL or empty text is one empty line. Rows that are repeated count as
documents of their own; a NULL id is an id like any other.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bucketlens.llm.common import BLANKS, packed, same, spread_join
from bucketlens.llm.repeats import filter_bits, maybe_repeated, repeat_filter
from bucketlens.session import staged

_ENDS = BLANKS.encode()


def line_key(line: bytes) -> bytes:
    return line.strip(_ENDS).lower()


def document_keys(text: bytes | None, min_chars: int) -> list[bytes]:
    """The distinct keys of a text, in order, that are long enough to be looked at."""
    keys = dict.fromkeys(map(line_key, (text or b"").split(b"\n")))
    if min_chars <= 1:
        keys.pop(b"", None)
        return list(keys) if min_chars == 1 else [b"", *keys]
    return [k for k in keys if len(k) >= min_chars and len(k.decode()) >= min_chars]


def _hashes(keys: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), dtype=np.uint64, count=len(keys))


def _texts(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()


def repeated_lines(docs: DataFrame, min_docs: int, min_chars: int) -> DataFrame:
    """doc_id, _text, keys, first: what each document holds of keys in ``min_docs`` documents.

    ``first`` lists the keys whose first document (by id, then text hash) it is.
    """
    spark = docs.sparkSession

    def hashes_of(batch: pa.RecordBatch) -> np.ndarray:
        return _hashes([k for text in _texts(batch["text"]) for k in document_keys(text, min_chars)])

    lines = F.explode(F.split(F.coalesce("text", F.lit("")), "\n"))
    distinct = docs.select(lines.alias("line")).agg(F.approx_count_distinct("line")).first()[0]
    suspicion = spark.sparkContext.broadcast(repeat_filter(docs.select("text"), hashes_of, filter_bits(distinct)))

    def suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [document_keys(text, min_chars) for text in _texts(batch["text"])]
            flat = [k for of_text in keys for k in of_text]
            found = np.flatnonzero(maybe_repeated(suspicion.value, _hashes(flat)))
            rows = np.repeat(np.arange(len(keys)), [len(k) for k in keys])[found]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"].take(pa.array(rows)), batch["_text"].take(pa.array(rows)), pa.array([flat[i] for i in found], pa.binary())],
                names=["doc_id", "_text", "key"],
            )

    schema = docs.select("doc_id", "_text").schema.add("key", "binary")
    suspected = staged(docs.select("doc_id", "_text", "text").mapInArrow(suspects, schema), "line-suspects")
    confirmed = (
        suspected.groupBy("key")
        .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "_text")).alias("owner"))
        .where(F.col("n") >= min_docs)
    )
    owned = spread_join(suspected, confirmed, ["key"], ["doc_id", "_text"]).where("n IS NOT NULL")
    is_owner = F.col("owner").eqNullSafe(F.struct("doc_id", "_text"))
    return owned.groupBy("doc_id", "_text").agg(
        F.collect_set("key").alias("keys"), F.collect_set(F.when(is_owner, F.col("key"))).alias("first")
    )


def kept_lines(text: bytes | None, drop: list[bytes] | None, first: list[bytes] | None) -> tuple[int, bytes]:
    """Number of lines dropped and the remaining text; one line of each ``first`` key stays."""
    if not drop:
        return 0, text or b""
    dropped, spared = set(drop), set(first or ())
    lines, kept = (text or b"").split(b"\n"), []
    for line in lines:
        key = line_key(line)
        if key in spared:
            spared.discard(key)
        elif key in dropped:
            continue
        kept.append(line)
    return len(lines) - len(kept), b"\n".join(kept)


@F.arrow_udf(T.StructType().add("n_dropped", T.LongType()).add("kept_sha256", T.StringType()))
def _digest(text: pa.Array, drop: pa.Array, first: pa.Array) -> pa.Array:
    done = [kept_lines(*row) for row in zip(_texts(text), drop.to_pylist(), first.to_pylist())]
    return pa.StructArray.from_arrays(
        [pa.array([n for n, _ in done], pa.int64()), pa.array([hashlib.sha256(t).hexdigest() for _, t in done], pa.string())],
        names=["n_dropped", "kept_sha256"],
    )


@F.arrow_udf(T.StringType())
def _kept_text(text: pa.Array, drop: pa.Array, first: pa.Array) -> pa.Array:
    done = [kept_lines(*row) for row in zip(_texts(text), drop.to_pylist(), first.to_pylist())]
    return pa.array([t for _, t in done], pa.binary()).cast(pa.string())


def _with_repeats(docs: DataFrame, min_docs: int, min_chars: int) -> DataFrame:
    """``_row`` (the document) with ``keys`` and ``first`` of the lines it shares."""
    text = F.col("_row.text")
    identified = packed(docs).select("_row", F.col("_row.doc_id").alias("doc_id"), F.xxhash64(text).alias("_text"), text.alias("text"))
    repeated = repeated_lines(identified, min_docs, min_chars).toDF("_r_id", "_r_text", "keys", "first")
    rows = identified.drop("text")
    return rows.join(repeated, same(rows, repeated, ["doc_id", "_text"], ["_r_id", "_r_text"]), "left")


def _spared(keep_first: bool) -> Column:
    return F.col("first") if keep_first else F.lit(None).cast("array<binary>")


def dedup_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, keep_first: bool = False) -> DataFrame:
    """Documents, columns as given, without the lines whose key ``min_docs`` documents hold.

    With ``keep_first`` the first such line of the first document stays. A text that is
    NULL or loses nothing stays as it is.
    """
    joined = _with_repeats(docs, min_docs, min_chars)
    text = F.col("_row.text")
    rest = F.when(F.col("keys").isNull(), text).otherwise(_kept_text(text, "keys", _spared(keep_first)))
    return joined.select(*((rest if c == "text" else F.col(f"_row.`{c}`")).alias(c) for c in docs.columns))


def line_dedup_query(docs: DataFrame, min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256, one row per given row.

    A NULL or empty text is one empty line, which has no key and stays. Equal rows count
    as documents of their own; ids may be NULL or repeat. An empty table gives no rows.
    """
    joined = _with_repeats(docs.select("doc_id", "text"), min_docs, min_chars)
    text = F.col("_row.text")
    digest = joined.select(
        "doc_id",
        F.size(F.split(F.coalesce(text, F.lit("")), "\n")).cast("bigint").alias("n_lines"),
        _digest(text, "keys", _spared(False)).alias("_d"),
    )
    return digest.select("doc_id", "n_lines", "_d.n_dropped", "_d.kept_sha256")


def oracle(min_docs: int = 10) -> str:
    """The same rows in DuckDB."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    blanks = " || ".join(f"chr({n})" for n in (32, 9, 10, 11, 12, 13))
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT r, doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM d),
k AS (SELECT *, translate(trim(line, {blanks}), '{upper}', '{lower}') AS key FROM l),
h AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT r) >= {min_docs})
SELECT any_value(doc_id) AS doc_id, count(*)::BIGINT AS n_lines, count(h.key)::BIGINT AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE h.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN h ON k.key = h.key GROUP BY r"""
