"""Periodic runs of words: stretches that repeat themselves, found and collapsed.

A run is a longest stretch of consecutive words with a smallest period q, at least
``max(min_words, 2 * q)`` words long. With s its first word, the suffixes from s and
from s + q share the rest of the run, and no suffix between them starts with those
words. So runs follow from the suffix order of a text: its neighbours are united by
decreasing length of their common prefix (Kruskal's order), each class of suffixes
keeps its positions in order, and whenever two positions become neighbours in a class
at a distance within the common prefix, they are the first two periods of a run (of
one that may start earlier, in which case the pair further left gives it).

A group of texts is ordered at once by prefix doubling, of which only suffixes that
are not yet told apart take part; few texts have any left after four words. One pass
without a shuffle; a group has ``GROUP_WORDS`` words at most, or is one longer text,
and takes some 150 bytes a word.
"""

import hashlib
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from bucketlens.llm.common import WORD

GROUP_WORDS = 1 << 19
MIN_WORDS = 12
# Below this, pairs of suffixes are compared word by word all at once.
SINGLE_PAIRS = 64


def _new_groups(ranks: np.ndarray) -> np.ndarray:
    return np.concatenate([[True], ranks[1:] != ranks[:-1]])


def suffix_order(words: np.ndarray, shared: int) -> tuple[np.ndarray, np.ndarray]:
    """Neighbours in suffix order that share at least ``shared`` words, as two arrays of positions.

    Texts stand one after another, each closed by a number that occurs once; numbers of
    different texts differ.
    """
    # Rank of a suffix: how many suffixes are smaller by the words compared so far.
    order = np.argsort(words, kind="stable")
    new = _new_groups(words[order])
    firsts = np.flatnonzero(new)
    rank = np.empty(len(words), dtype=np.int64)
    rank[order] = firsts[np.cumsum(new) - 1]
    sizes = np.diff(np.concatenate([firsts, [len(words)]]))
    left = order[np.repeat(sizes, sizes) > 1]
    reached, kept = 1, np.empty(0, dtype=np.int64)
    while len(left):
        # Suffixes that are alike this far have as many words, so there is one more entry.
        key = rank[left] * np.int64(len(words)) + rank[left + reached]
        inner = np.argsort(key, kind="stable")
        left, key = left[inner], key[inner]
        new = _new_groups(key)
        firsts = np.flatnonzero(new)
        sizes = np.diff(np.concatenate([firsts, [len(left)]]))
        # Within a group of old rank r the places are r, r + 1, ...
        old = rank[left]
        group_starts = np.flatnonzero(_new_groups(old))
        at = np.arange(len(left)) - np.repeat(group_starts, np.diff(np.concatenate([group_starts, [len(left)]])))
        rank[left] = np.repeat((old + at)[firsts], sizes)
        reached *= 2
        if reached * 2 > shared and not len(kept):
            # All pairs that share enough are among those alike this far, or the next doubling's.
            kept = left if reached > shared else left[np.repeat(sizes, sizes) > 1]
        left = left[np.repeat(sizes, sizes) > 1]
    if not len(kept):
        return kept, kept
    kept = kept[np.argsort(rank[kept], kind="stable")]
    near = np.flatnonzero(rank[kept[1:]] == rank[kept[:-1]] + 1)
    return kept[near], kept[near + 1]


def common_lengths(words: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many words the suffixes of each pair share.

    ``left`` holds no position twice. Where the pair one word earlier is listed too and
    its words are alike, a pair shares one word less than that; only the others are
    compared.
    """
    by_place = np.argsort(left, kind="stable")
    left, right = left[by_place], right[by_place]
    follows = np.zeros(len(left), dtype=bool)
    follows[1:] = (left[1:] == left[:-1] + 1) & (right[1:] == right[:-1] + 1) & (words[left[:-1]] == words[right[:-1]])
    heads = np.flatnonzero(~follows)
    a, b = left[heads], right[heads]
    length = np.zeros(len(heads), dtype=np.int64)
    open_pairs = np.arange(len(heads))
    step = 0
    while len(open_pairs) > SINGLE_PAIRS:
        open_pairs = open_pairs[words[a[open_pairs] + step] == words[b[open_pairs] + step]]
        step += 1
        length[open_pairs] = step
    for k in open_pairs.tolist():
        x, y, width = int(a[k]) + step, int(b[k]) + step, 64
        shared = step
        while True:
            n = min(width, len(words) - max(x, y))
            differ = words[x : x + n] != words[y : y + n]
            first = int(differ.argmax())
            if differ[first]:
                break
            shared, x, y, width = shared + n, x + n, y + n, 2 * width
        length[k] = shared + first
    of = np.cumsum(~follows) - 1
    result = np.empty(len(left), dtype=np.int64)
    result[by_place] = length[of] - (np.arange(len(left)) - heads[of])
    return result


def seeds(left: np.ndarray, right: np.ndarray, shared: np.ndarray) -> list[tuple[int, int, int]]:
    """(p, q, n): neighbours p < q of a class with q - p <= n, the words they share.

    Pairs are united by decreasing ``shared``. A class is a sorted list of positions;
    the smaller of two goes into the larger, entry by entry or, if they are of like
    size, by one merge.
    """
    found = []
    owner: dict[int, int] = {}
    members: dict[int, list[int]] = {}

    def class_of(p: int) -> int:
        root = p
        while (up := owner.setdefault(root, root)) != root:
            root = up
        while p != root:
            owner[p], p = root, owner[p]
        return root

    order = np.argsort(-shared, kind="stable")
    for p, q, n in zip(left[order].tolist(), right[order].tolist(), shared[order].tolist()):
        p, q = class_of(p), class_of(q)
        if p == q:
            continue
        large, small = members.pop(p, None) or [p], members.pop(q, None) or [q]
        if len(large) < len(small):
            p, q, large, small = q, p, small, large
        owner[q] = p
        before = None
        for x in small:
            at = bisect_left(large, x)
            # Between two entries of the smaller list that no entry parts, they are neighbours already.
            if at and (before is None or large[at - 1] > before) and x - large[at - 1] <= n:
                found.append((large[at - 1], x, n))
            before = x
        after = None
        for x in reversed(small):
            at = bisect_left(large, x)
            if at < len(large) and (after is None or large[at] < after) and large[at] - x <= n:
                found.append((x, large[at], n))
            after = x
        if 8 * len(small) > len(large):
            large = sorted(large + small)
        else:
            for x in small:
                insort(large, x)
        members[p] = large
    return found


def runs_of(texts: list[np.ndarray], min_words: int = MIN_WORDS) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of every run of each text, in order; texts are word numbers from 0."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if not texts:
        return out
    parts, begins, first, at = [], [], 0, 0
    for text in texts:
        begins.append(at)
        # The closing number is one that no other place has.
        close = first + (int(text.max()) + 1 if len(text) else 0)
        parts += [text + first, [close]]
        first, at = close + 1, at + len(text) + 1
    words = np.concatenate(parts).astype(np.int64)
    # A run of n words and period q has two suffixes that share n - q >= n / 2 words.
    left, right = suffix_order(words, -(-min_words // 2))
    if not len(left):
        return out
    shared = common_lengths(words, left, right)
    enough = shared >= -(-min_words // 2)
    starts = np.array(begins)
    for p, q, n in seeds(left[enough], right[enough], shared[enough]):
        if q - p + n < min_words:
            continue
        k = int(np.searchsorted(starts, p, side="right")) - 1
        begin = begins[k]
        # If the words before are alike too, the pair one word earlier gives the run.
        if p == begin or words[p - 1] != words[q - 1]:
            out[k].append((p - begin, q - p + n, q - p))
    return [sorted(runs, key=lambda r: (r[0], r[2])) for runs in out]


def collapsed(words: list[str], runs: list[tuple[int, int, int]]) -> list[str]:
    """The words that no run holds after its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    kept = np.cumsum(change[:-1]) == 0
    return [w for w, k in zip(words, kept.tolist()) if k]


def planted(doc_id: int | None, words: list) -> list:
    """The words with a periodic end put in for one id in ten; a NULL id counts as empty text.

    With h the CRC-32 of the id as text and g = h // 10, ids with h % 10 == 0 get one:
    every word i >= a becomes word a + (i - a) % p.
    """
    h = zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    period = words[a : a + p]
    return words[:a] + (period * (-(-(n - a) // p)))[: n - a]


def _numbered(words: list[str]) -> np.ndarray:
    """Words as numbers; equal words have equal numbers."""
    seen: dict[str, int] = {}
    return np.array([seen.setdefault(w, len(seen)) for w in words], dtype=np.int64)


def periodic_runs(docs: DataFrame, min_words: int = MIN_WORDS, plant: bool = False) -> DataFrame:
    """doc_id, n_runs, the longest run, runs (as lines), text (collapsed) of every row of ``docs``.

    ``start``, ``length``, ``period`` and ``exponent_milli`` are those of the longest run
    (ties: the smallest start, then the smallest period), NULL without a run.
    ``runs`` lists all of them by start and period, one line each; ``text`` is the words
    that are kept, joined by blanks. With ``plant`` the text is first changed as in
    ``planted``. A NULL or empty text has no words, no run and an empty result.
    Every row is judged by itself, so repeated rows come out alike; other columns
    are not looked at, and no rows give no rows.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs", "text"]
    word = re.compile(WORD)

    def batch_of(ids: list, texts: list[list[str]], id_type: pa.DataType) -> pa.RecordBatch:
        found = runs_of([_numbered(words) for words in texts], min_words)
        longest = [min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None) for runs in found]
        exponents = [length and 1000 * length // period for _, length, period in longest]
        lines = ["".join(f"{s},{n},{q}\n" for s, n, q in runs) for runs in found]
        rest = [" ".join(collapsed(words, runs)) for words, runs in zip(texts, found)]
        numbers = [[len(runs) for runs in found], *map(list, zip(*longest)), exponents]
        columns = [pa.array(ids, id_type), *(pa.array(x, pa.int64()) for x in numbers), pa.array(lines, pa.string()), pa.array(rest, pa.string())]
        return pa.RecordBatch.from_arrays(columns, names=names)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, size = [], [], 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = word.findall(text.as_py() or "")
                words = planted(doc_id, words) if plant else words
                if ids and size + len(words) > GROUP_WORDS:
                    yield batch_of(ids, texts, batch.column(0).type)
                    ids, texts, size = [], [], 0
                ids.append(doc_id)
                texts.append(words)
                size += len(words)
            if ids:
                yield batch_of(ids, texts, batch.column(0).type)

    numbers = "n_runs BIGINT, start BIGINT, length BIGINT, period BIGINT, exponent_milli BIGINT"
    return docs.select("doc_id", "text").mapInArrow(find, f"doc_id {kind}, {numbers}, runs STRING, text STRING")


def runs_query(docs: DataFrame) -> DataFrame:
    """What ``periodic_runs`` finds in the changed texts, the list and the rest as digests."""
    found = periodic_runs(docs, plant=True)
    return found.selectExpr(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli",
        "sha2(CAST(runs AS BINARY), 256) AS runs_sha256", "sha2(CAST(text AS BINARY), 256) AS collapsed_sha256",
    )
