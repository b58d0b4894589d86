"""Removing long byte strings that occur again, by suffix order.

A string of ``min_bytes`` bytes is a window. Its key is the least hash of the short
grams in it, so equal windows have equal keys wherever they stand, and neighbouring
windows mostly share theirs: a text is a sequence of runs of windows with one key.
Only runs whose key occurs again are looked at further.

Of runs with the same bytes one is compared with others. Runs of a key are brought
together, and their suffixes are put in order by prefix doubling up to ``min_bytes``.
The longest previous factor of a suffix reaches ``min_bytes`` exactly if its block of
equal prefixes holds an earlier position; in a block sorted by position, the previous
smaller position is the entry before it, and the next entry is a later match.

A key may have more different runs than one task should hold, as where a passage
stands in very many texts. Such a key is divided until its parts fit: all windows that
hold the key's gram at about the same offset share a core, the bytes common to all
those offsets, so only stretches of windows with equal cores need to meet. Cores grow
with every round until they are the window itself. Of equal stretches one goes on, and
stretches whose core stands alone are settled, so rows follow the input in every round.
Equal stretches are told by 128-bit digests, next to their key and length.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bucketlens.llm.common import spread_join
from bucketlens.session import staged

GRAM = 32
# A key whose runs have more bytes than this is divided, in rounds: offsets that share a core.
CROWDED_BYTES = 1 << 20
CORE_OFFSETS = (64, 16, 4, 1)
# Bytes whose suffixes are put in order at a time.
ORDERED_BYTES = 1 << 21
_ODD = [np.uint64(n) for n in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD)]


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the ``GRAM`` bytes from each position on, by doubling."""
    h = (data.astype(np.uint64) + _ODD[4]) * _ODD[0]
    h ^= h >> np.uint64(29)
    width = 1
    for odd in _ODD:
        h = h[:-width] * odd + h[width:]
        h ^= h >> np.uint64(32)
        width *= 2
    h *= _ODD[4]
    return h ^ (h >> np.uint64(31))


def sliding(values: np.ndarray, width: int, best: np.ufunc, worst: np.uint64) -> np.ndarray:
    """Least or greatest of each ``width`` neighbours, from running ones of blocks."""
    n = len(values)
    padded = np.full(-(-n // width) * width, worst)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    forward = best.accumulate(blocks, axis=1).ravel()
    backward = best.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return best(backward[: n - width + 1], forward[width - 1 : n])


def window_runs(text: bytes, min_bytes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Key, start, number of windows of each run, and whether its key has two places in the text."""
    hashes = gram_hashes(np.frombuffer(text, dtype=np.uint8))
    width = min_bytes - GRAM + 1
    keys = sliding(hashes, width, np.minimum, np.uint64(2**64 - 1))
    starts = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1])
    counts = np.diff(np.concatenate([starts, [len(keys)]]))
    # A gram is a window's least exactly if it is the greatest least around it.
    around = np.concatenate([np.zeros(width - 1, np.uint64), keys, np.zeros(width - 1, np.uint64)])
    least = hashes[hashes == sliding(around, width, np.maximum, np.uint64(0))]
    places, many = np.unique(least, return_counts=True)
    return keys[starts], starts, counts, np.isin(keys[starts], places[many > 1])


def prefix_classes(data: np.ndarray, length: int) -> np.ndarray:
    """Rank of the ``length`` bytes from each position on, by prefix doubling.

    Equal ranks mean equal bytes; positions too close to the end are padded with zeros.
    """

    def paired(high: np.ndarray, low: np.ndarray) -> np.ndarray:
        return np.unique(high * np.int64(low.max() + 1) + low, return_inverse=True)[1]

    def later(ranks: np.ndarray, step: int) -> np.ndarray:
        moved = np.zeros_like(ranks)
        if step < len(ranks):
            moved[:-step] = ranks[step:]
        return moved

    ranks, reached = data.astype(np.int64) + 1, 1
    while reached < 4 and 2 * reached <= length:
        # Up to four bytes fit into a number as they are.
        ranks = (ranks << (9 * reached)) | later(ranks, reached)
        reached *= 2
    while reached < length:
        step = min(reached, length - reached)
        if reached == 4:
            ranks = np.unique(ranks, return_inverse=True)[1]
        ranks = paired(ranks, later(ranks, step))
        reached += step
    return ranks


def matches(contexts: list[bytes], min_bytes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For every window of the given strings: string, offset, an earlier match, a later one.

    The strings' order is the order of positions.
    """
    lengths = np.array([len(c) for c in contexts])
    begins = np.cumsum(lengths) - lengths
    ranks = prefix_classes(np.frombuffer(b"".join(contexts), dtype=np.uint8), min_bytes)
    windows = lengths - min_bytes + 1
    of = np.repeat(np.arange(len(contexts)), windows)
    offset = np.arange(len(of)) - np.repeat(np.cumsum(windows) - windows, windows)
    blocks = ranks[begins[of] + offset]
    order = np.argsort(blocks, kind="stable")
    tied = blocks[order][1:] == blocks[order][:-1]
    earlier, later = np.zeros(len(of), dtype=bool), np.zeros(len(of), dtype=bool)
    earlier[order[1:]], later[order[:-1]] = tied, tied
    return of, offset, earlier, later


def _spans(of: np.ndarray, offset: np.ndarray, chosen: np.ndarray, begins: np.ndarray, min_bytes: int) -> tuple:
    """Chosen windows as spans of bytes: string, start, end of each stretch of neighbours."""
    at = np.flatnonzero(chosen)
    if not len(at):
        return at, at, at
    new = np.concatenate([[True], (of[at][1:] != of[at][:-1]) | (offset[at][1:] != offset[at][:-1] + 1)])
    last = np.concatenate([np.flatnonzero(new)[1:] - 1, [len(at) - 1]])
    first, last = at[new], at[last]
    return of[first], begins[of[first]] + offset[first], begins[of[last]] + offset[last] + min_bytes


def core_stretches(context: bytes, key: int, offset: int | None, windows: int, min_bytes: int, width: int) -> Iterator[tuple[int, int, int, bytes, bytes]]:
    """Stretches of a context's windows whose offsets share a core: first window, windows, its offset, core, bytes.

    The offset of a window is where the key's gram first stands in it; ``offset`` is
    that of the first window, if there is one gram for all.
    """
    at = np.arange(windows)
    if offset is None:
        places = np.flatnonzero(gram_hashes(np.frombuffer(context, dtype=np.uint8)) == np.uint64(key & (2**64 - 1)))
        anchors = places[np.searchsorted(places, at)]
    else:
        anchors = np.full(windows, offset)
    block = (anchors - at) // width
    new = np.flatnonzero(np.concatenate([[True], (anchors[1:] != anchors[:-1]) | (block[1:] != block[:-1])]))
    for first, last in zip(new.tolist(), [*new[1:].tolist(), windows]):
        begin = int(anchors[first] - block[first] * width)
        core = xxhash.xxh3_128_digest(context[begin : begin + min_bytes - width + 1], seed=int(block[first]))
        yield first, last - first, int(anchors[first]) - first, core, context[first : last - 1 + min_bytes]


def _divided(contexts: DataFrame, min_bytes: int, keep_first: bool, crowded_bytes: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """Contexts of crowded keys in parts that fit a task, and the spans (_id, _text, start, end) already settled."""
    names = ["_id", "_text", "start", "windows", "offset", "core", "bytes", "context"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    schema = "_id BIGINT, _text BIGINT, start INT, windows INT, offset INT, core BINARY, bytes BINARY, context BINARY"

    def split(width: int, with_offset: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    found = []
                    pieces = [(0, row["windows"], row["context"])]
                    if row["windows"] > min_bytes - GRAM + 1:
                        # More windows than one gram has offsets: the text repeats itself. Of equal
                        # windows in it one goes on, the others are spans (no core) at once.
                        of, offset, earlier, later = matches([row["context"]], min_bytes)
                        marked = earlier if keep_first else earlier | later
                        begins = np.array([row["start"]])
                        for _, start, end in zip(*_spans(of, offset, marked, begins, min_bytes)):
                            found.append((row["_id"], row["_text"], start, end - start - min_bytes + 1, None, None, None, None))
                        _, starts, ends = _spans(of, offset, ~earlier, np.array([0]), min_bytes)
                        pieces = [(a, b - a - min_bytes + 1, row["context"][a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
                    for first, windows, context in pieces:
                        own = row["offset"] - first if with_offset else None
                        for a, n, o, core, content in core_stretches(context, row["key"], own, windows, min_bytes, width):
                            digest = xxhash.xxh3_128_digest(content)
                            found.append((row["_id"], row["_text"], row["start"] + first + a, n, o, core, digest, content))
                    if found:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), kinds)], names=names)

        return run

    fitting, settled = [], []
    place, end = F.struct("_id", "_text", "start"), (F.col("start") + F.col("windows") + (min_bytes - 1)).cast("int").alias("end")
    same_bytes = ["core", "bytes", "windows", "offset"]
    waiting = staged(contexts.withColumn("offset", F.lit(None).cast("int")), "suffix-crowded")
    for number, width in enumerate(CORE_OFFSETS):
        if waiting.isEmpty():
            break
        blocks = staged(waiting.mapInArrow(split(width, number > 0), schema), "suffix-blocks")
        settled.append(blocks.where("core IS NULL").select("_id", "_text", "start", end))
        contents = blocks.where("core IS NOT NULL").groupBy(*same_bytes).agg(
            F.count(F.lit(1)).alias("copies"), F.min(place).alias("first"), F.first("context").alias("context")
        )
        contents = staged(contents, "suffix-contents")
        repeated = contents.where("copies > 1").select(*same_bytes, "first")
        copied = spread_join(blocks.select("_id", "_text", "start", *same_bytes), repeated, same_bytes, ["_id", "_text", "start"], copies=4)
        copied = copied.where("first IS NOT NULL")
        if keep_first:
            copied = copied.where(~F.col("first").eqNullSafe(place))
        settled.append(copied.select("_id", "_text", "start", end))
        size = F.sum(F.octet_length("context").cast("bigint")).alias("size")
        groups = contents.groupBy("core").agg(F.count(F.lit(1)).alias("different"), size).where("different > 1")
        told = spread_join(contents, groups, ["core"], ["bytes", "offset"], copies=4).where("different IS NOT NULL")
        # Parts are brought together by the core; a clash of its first half only puts two into one task.
        half = F.conv(F.hex(F.substring("core", 1, 8)), 16, -10).cast("bigint").alias("key")
        told = told.select("first.*", half, "windows", "offset", "context", (F.col("size") > crowded_bytes).alias("crowded"))
        told = staged(told, "suffix-told")
        fitting.append(told.where("NOT crowded"))
        waiting = told.where("crowded").drop("crowded")
    return fitting, settled


def repeated_spans(docs: DataFrame, min_bytes: int, keep_first: bool, crowded_bytes: int = CROWDED_BYTES) -> DataFrame:
    """_id, _text, spans (start, end in bytes) of documents that lose something.

    ``docs`` is what ``_identified`` gives.
    """
    if min_bytes < 2 * GRAM:
        raise ValueError(f"at least {2 * GRAM} bytes")
    owner = "_id BIGINT, _text BIGINT"
    owner_fields = [("_id", pa.int64()), ("_text", pa.int64())]

    def batch_of(columns: list, fields: list) -> pa.RecordBatch:
        schema = pa.schema(owner_fields + fields)
        return pa.RecordBatch.from_arrays([c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    run_fields = [("key", pa.int64()), ("start", pa.int32()), ("windows", pa.int32()), ("bytes", pa.binary()), ("again", pa.bool_())]

    def find_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, found, digests = [], [], []
            for row, text in enumerate(batch["text"].cast(pa.binary()).to_pylist()):
                if text is not None and len(text) >= min_bytes:
                    keys, starts, counts, again = window_runs(text, min_bytes)
                    ends = (starts + counts + (min_bytes - 1)).tolist()
                    digests += [xxhash.xxh3_128_digest(text[s:e]) for s, e in zip(starts.tolist(), ends)]
                    rows.append(np.full(len(keys), row))
                    found.append((keys, starts, counts, again))
            if not rows:
                continue
            at = pa.array(np.concatenate(rows))
            keys, starts, counts, again = (np.concatenate(c) for c in zip(*found))
            columns = [keys.view(np.int64), starts, counts, digests, again]
            yield batch_of([batch["_id"].take(at), batch["_text"].take(at), *columns], run_fields)

    run_schema = "key BIGINT, start INT, windows INT, bytes BINARY, again BOOLEAN"
    all_runs = staged(docs.mapInArrow(find_runs, f"{owner}, {run_schema}"), "suffix-runs")
    again = all_runs.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("again").alias("self")).where("n > 1 OR self")
    suspects = staged(spread_join(all_runs, again, ["key"], ["_id", "_text", "start"], copies=4).where("n IS NOT NULL").drop("n", "again"), "suffix-suspects")

    # One row per key and content of a run, with the first place it stands at.
    place = F.struct("_id", "_text", "start")
    contents = suspects.groupBy("key", "bytes", "windows").agg(
        F.count(F.lit(1)).alias("copies"), F.min(place).alias("first"), F.max("self").alias("self")
    )
    contents = staged(contents, "suffix-contents")
    copied = spread_join(
        suspects.select("_id", "_text", "start", "key", "bytes", "windows"), contents.where("copies > 1").drop("self"),
        ["key", "bytes", "windows"], ["_id", "_text", "start"], copies=4,
    ).where("copies IS NOT NULL")
    if keep_first:
        copied = copied.where(~F.col("first").eqNullSafe(place))
    end = (F.col("start") + F.col("windows") + (min_bytes - 1)).alias("end")
    whole = copied.select("_id", "_text", "start", end)

    size = F.sum((F.col("windows") + (min_bytes - 1)).cast("bigint")).alias("size")
    per_key = contents.groupBy("key").agg(F.count(F.lit(1)).alias("different"), F.max("self").alias("any_self"), size)
    per_key = per_key.where("different > 1 OR any_self")
    # With the first kept, or of a single copy, a content's windows may still match others.
    told = spread_join(contents, per_key, ["key"], ["bytes", "windows"], copies=4).where("different IS NOT NULL")
    wanted = told.select("first.*", "key", "windows", (F.col("size") > crowded_bytes).alias("crowded"))
    by_doc = wanted.groupBy("_id", "_text").agg(F.collect_list(F.struct("key", "start", "windows", "crowded")).alias("_runs"))
    # One row of each that are repeated. Texts move by (_id, _text), here and once more
    # when the spans come back to them, so the plan shuffles them once and reads that twice.
    given = docs.join(staged(by_doc, "suffix-wanted"), ["_id", "_text"]).dropDuplicates(["_id", "_text"])

    def cut(crowded: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows, found, context = [], [], []
                for row, (text, runs) in enumerate(zip(batch["text"].cast(pa.binary()).to_pylist(), batch["_runs"].to_pylist())):
                    for r in runs:
                        if r["crowded"] == crowded:
                            rows.append(row)
                            found.append((r["key"], r["start"], r["windows"]))
                            context.append(text[r["start"] : r["start"] + r["windows"] + min_bytes - 1])
                if rows:
                    at = pa.array(rows)
                    yield batch_of(
                        [batch["_id"].take(at), batch["_text"].take(at), *map(list, zip(*found)), context],
                        [("key", pa.int64()), ("start", pa.int32()), ("windows", pa.int32()), ("context", pa.binary())],
                    )

        return given.mapInArrow(run, f"{owner}, key BIGINT, start INT, windows INT, context BINARY")

    span_fields = [("start", pa.int32()), ("end", pa.int32())]

    def order_suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def judged(table: pa.Table) -> pa.RecordBatch:
            columns = {c: table[c].combine_chunks() for c in table.column_names}
            of, offset, earlier, later = matches(columns["context"].to_pylist(), min_bytes)
            chosen = earlier if keep_first else earlier | later
            of, start, end = _spans(of, offset, chosen, columns["start"].to_numpy(), min_bytes)
            at = pa.array(of)
            return batch_of([columns["_id"].take(at), columns["_text"].take(at), start, end], span_fields)

        waiting = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            waiting = pa.concat_tables([waiting, table]) if waiting is not None else table
            keys = waiting["key"].to_numpy()
            sizes = np.cumsum(waiting["windows"].to_numpy().astype(np.int64) + min_bytes - 1)
            borders = np.flatnonzero(keys[1:] != keys[:-1]) + 1
            done = 0
            for border, after in zip(borders, [*borders[1:], None]):
                size = sizes[border - 1] - (sizes[done - 1] if done else 0)
                if after is None or sizes[after - 1] - (sizes[done - 1] if done else 0) > ORDERED_BYTES:
                    if size:
                        yield judged(waiting.slice(done, border - done))
                    done = border
            waiting = waiting.slice(done)
        if waiting is not None and waiting.num_rows:
            yield judged(waiting)

    context_columns = ["_id", "_text", "key", "start", "windows", "context"]
    whole = whole.select("_id", "_text", "start", F.col("end").cast("int").alias("end"))
    fitting, settled = _divided(cut(True), min_bytes, keep_first, crowded_bytes)
    together = cut(False)
    for part in fitting:
        together = together.unionByName(part.select(*context_columns))
    ordered = together.repartition("key").sortWithinPartitions("key", "_id", "_text", "start")
    spans = whole.unionByName(ordered.mapInArrow(order_suffixes, f"{owner}, start INT, end INT"))
    for part in settled:
        spans = spans.unionByName(part)
    return spans.groupBy("_id", "_text").agg(F.collect_list(F.struct("start", "end")).alias("spans"))


def kept_bytes(text: bytes | None, spans: list[dict] | None) -> tuple[int, int, bytes]:
    """Bytes removed, maximal runs of them, and the rest."""
    text, runs, kept, at = text or b"", 0, [], 0
    removed = 0
    for span in sorted(spans or (), key=lambda s: s["start"]):
        if runs and span["start"] <= at:
            removed += max(0, span["end"] - at)
            at = max(at, span["end"])
            continue
        kept.append(text[at : span["start"]])
        runs += 1
        removed += span["end"] - span["start"]
        at = span["end"]
    kept.append(text[at:])
    return removed, runs, b"".join(kept)


_COUNTS = T.StructType().add("n_removed", T.LongType()).add("n_spans", T.LongType())


@F.arrow_udf(T.StructType([*_COUNTS, T.StructField("kept", T.BinaryType())]))
def _cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
    done = [kept_bytes(*row) for row in zip(texts.cast(pa.binary()).to_pylist(), spans.to_pylist())]
    return pa.StructArray.from_arrays(
        [
            pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done], pa.int64()),
            pa.array([d[2] for d in done], pa.binary()),
        ],
        names=["n_removed", "n_spans", "kept"],
    )


@F.arrow_udf(T.StructType([*_COUNTS, T.StructField("kept_sha256", T.StringType())]))
def _digest(texts: pa.Array, spans: pa.Array) -> pa.Array:
    done = [kept_bytes(*row) for row in zip(texts.cast(pa.binary()).to_pylist(), spans.to_pylist())]
    return pa.StructArray.from_arrays(
        [
            pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done], pa.int64()),
            pa.array([hashlib.sha256(d[2]).hexdigest() for d in done], pa.string()),
        ],
        names=["n_removed", "n_spans", "kept_sha256"],
    )


def _identified(docs: DataFrame) -> DataFrame:
    """With ``_id`` (the id, NULL as the least number) and ``_text`` (hash of the text)."""
    number = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(2**63)))
    return docs.select("doc_id", number.alias("_id"), F.xxhash64("text").alias("_text"), "text")


def _with_spans(docs: DataFrame, min_bytes: int, keep_first: bool, crowded_bytes: int) -> DataFrame:
    given = _identified(docs)
    return given.join(repeated_spans(given, min_bytes, keep_first, crowded_bytes), ["_id", "_text"], "left")


def remove_repeats(docs: DataFrame, min_bytes: int = 400, keep_first: bool = True, crowded_bytes: int = CROWDED_BYTES) -> DataFrame:
    """doc_id, kept (BINARY: the remaining bytes), n_removed, n_spans.

    Removes every byte covered by a string of ``min_bytes`` bytes that starts anywhere
    else too; with ``keep_first``, only copies after the first by (id, text hash,
    position). Matches don't cross documents and may overlap. A NULL text is empty;
    rows that are repeated are copies of each other, but share a place in that order,
    so the first place keeps its text in each of them.
    """
    cut = _with_spans(docs, min_bytes, keep_first, crowded_bytes).select("doc_id", _cut("text", "spans").alias("_c"))
    return cut.select("doc_id", "_c.kept", "_c.n_removed", "_c.n_spans")


def suffix_query(docs: DataFrame, min_bytes: int = 400, crowded_bytes: int = CROWDED_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, n_kept (bytes left), all copies removed.

    A NULL or empty text has 0 bytes and loses none. Repeated rows are copies of each
    other. No rows give no rows.
    """
    cut = _with_spans(docs, min_bytes, False, crowded_bytes).select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"), _digest("text", "spans").alias("_c")
    )
    kept = (F.col("n_bytes") - F.col("_c.n_removed")).alias("n_kept")
    return cut.select("doc_id", "n_bytes", "_c.n_removed", "_c.n_spans", "_c.kept_sha256", kept)
