"""Byte-pair encoding by speculation, and decoding.

A text is cut into words by the vocabulary's fixed pattern. For every new word the
greedy longest match proposes tokens. A proposal is right exactly if each token is
what merging makes of its own bytes and no merge ever crosses a border between two of
them. The first holds for all tokens offered to the match; the second is tested for
all adjacent pairs of a batch at once, in numpy. Only words with a failing pair are
merged rule by rule.

A border is tested by undoing merges backwards in time from the two finished tokens:
at each moment one token ends at the border and one begins there, and a rule for
those two that comes before the merges that took them up would have crossed it.
Rules are ordered, and a rule comes after those that made its parts, so time runs by
rank; of equal ranks the left one is applied first.

The vocabulary is read on the driver and sent to the executors: its size is fixed.
"""

import hashlib
import json
import re
import unicodedata
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

# Fixed value: the word pattern that byte-level vocabularies of this kind are made for.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
NO_RULE = np.iinfo(np.int32).max
LONG_WORD = 100
# Words remembered by an executor process, some 100 MB at most; then it starts afresh.
REMEMBERED_WORDS = 400_000
# Longer words are not remembered.
REMEMBERED_LENGTH = 64


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary file.

    Visible Latin-1 characters stand for themselves, the other bytes, in order, for
    the characters from 256 on.
    """
    visible = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {**{chr(b): b for b in visible}, **{chr(256 + i): b for i, b in enumerate(hidden)}}


def word_patterns() -> dict[str, str]:
    """``newer``: characters that have become letters or digits since the library's Unicode version.

    The standard library has that version (15.1), the regular expressions a later one.
    ``strict_pattern`` is the word pattern for texts with such characters.
    """
    unassigned = "".join(c if unicodedata.category(c) == "Cn" else " " for c in map(chr, range(0x110000)))
    runs = [(m.start(), m.end() - 1) for m in regex.finditer(r"[\p{L}\p{N}]+", unassigned)]
    if not runs:
        return {"newer": r"(?!)", "strict_pattern": WORD_PATTERN}
    newer = "".join(f"\\U{low:08x}-\\U{high:08x}" for low, high in runs)
    letter, digit = (rf"[\p{{{x}}}--[{newer}]]" for x in "LN")
    strict = WORD_PATTERN.replace(r"[^\s\p{L}\p{N}]", f"[^\\s{letter}{digit}]")
    strict = strict.replace(r" ?\p{L}", f" ?{letter}").replace(r" ?\p{N}", f" ?{digit}")
    return {"newer": f"[{newer}]", "strict_pattern": "(?V1)" + strict}


@lru_cache(maxsize=2)
def load_vocabulary(path: str) -> dict:
    """Tables of a byte-level BPE file, as plain values that can be sent to executors."""
    with open(path, encoding="utf-8") as file:
        given = json.load(file)
    model, pre = given["model"], given["pre_tokenizer"]
    if model["type"] != "BPE" or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or given["normalizer"]:
        raise ValueError("only byte-level BPE without prefix space and normalizer")
    alphabet = byte_alphabet()
    size = max([*model["vocab"].values(), *(t["id"] for t in given["added_tokens"])]) + 1
    token_bytes: list[bytes] = [b""] * size
    for token, number in model["vocab"].items():
        token_bytes[number] = bytes(alphabet[c] for c in token)
    for token in given["added_tokens"]:
        if token["lstrip"] or token["rstrip"] or token["single_word"]:
            raise ValueError("added tokens with strip or word rules")
        token_bytes[token["id"]] = token["content"].encode()
    special = {t["content"]: t["id"] for t in given["added_tokens"]}

    ids = {token_bytes[n]: n for n in model["vocab"].values()}
    rank = np.full(size, -1, dtype=np.int32)
    first, last = np.arange(size, dtype=np.int32), np.arange(size, dtype=np.int32)
    rules: dict[int, int] = {}
    made_by = []
    for order, (left, right) in enumerate(model["merges"]):
        a, b = model["vocab"][left], model["vocab"][right]
        made = model["vocab"][left + right]
        if rank[made] != -1 or max(rank[a], rank[b]) >= order:
            raise ValueError("a token must be made by one rule, after its parts")
        rules[a * size + b] = order
        made_by.append(made)
        rank[made], first[made], last[made] = order, a, b
    codes = np.fromiter(rules, dtype=np.int64, count=len(rules))
    by_code = np.argsort(codes)
    tables = {
        "token_bytes": token_bytes, "special": special, "rules": rules, "made": made_by, "rank": rank, "first": first, "last": last,
        "codes": codes[by_code], "code_ranks": np.arange(len(rules), dtype=np.int32)[by_code],
        "byte_ids": [ids[bytes([b])] for b in range(256)], "longest": {},
        "remembered": {}, **word_patterns(),
    }
    # The match may only propose tokens that merging makes of their own bytes.
    tables["offered"] = {t: n for t, n in ids.items() if merge_exactly(tables, t) == [n]}
    for token in tables["offered"]:
        start = token[:2]
        tables["longest"][start] = max(len(token), tables["longest"].get(start, 0))
    return tables


def merge_exactly(tables: dict, word: bytes) -> list[int]:
    """Apply the rules one by one: lowest rank first, leftmost first."""
    if len(word) > LONG_WORD:
        return merge_long(tables, word)
    rules, made, size = tables["rules"].get, tables["made"], len(tables["rank"])
    parts = [tables["byte_ids"][b] for b in word]
    ranks = [rules(a * size + b, NO_RULE) for a, b in zip(parts, parts[1:])]
    while ranks:
        rank = min(ranks)
        if rank == NO_RULE:
            break
        at = ranks.index(rank)
        parts[at] = made[rank]
        del parts[at + 1], ranks[at]
        if at:
            ranks[at - 1] = rules(parts[at - 1] * size + parts[at], NO_RULE)
        if at < len(ranks):
            ranks[at] = rules(parts[at] * size + parts[at + 1], NO_RULE)
    return parts


def merge_long(tables: dict, word: bytes) -> list[int]:
    """The same in n log n steps, for words of any length."""
    rules, made, size = tables["rules"].get, tables["made"], len(tables["rank"])
    parts = [tables["byte_ids"][b] for b in word]
    after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
    queue = [(rules(a * size + b, NO_RULE), at, a, b) for at, (a, b) in enumerate(zip(parts, parts[1:]))]
    queue = [entry for entry in queue if entry[0] != NO_RULE]
    heapify(queue)
    while queue:
        rank, at, a, b = heappop(queue)
        right = after[at]
        if parts[at] != a or right >= len(parts) or parts[right] != b:
            continue
        parts[at], parts[right] = made[rank], -1
        after[at] = after[right]
        if after[at] < len(parts):
            before[after[at]] = at
        for left in (before[at], at):
            if left >= 0 and after[left] < len(parts):
                x, y = parts[left], parts[after[left]]
                rank = rules(x * size + y, NO_RULE)
                if rank != NO_RULE:
                    heappush(queue, (rank, left, x, y))
    return [p for p in parts if p >= 0]


def propose(tables: dict, word: bytes) -> list[int]:
    """Greedy longest match."""
    offered, longest, tokens, at = tables["offered"].get, tables["longest"].get, [], 0
    while at < len(word):
        # At least the single byte is offered.
        end = min(len(word), at + longest(word[at : at + 2], 1))
        while (token := offered(word[at:end])) is None:
            end -= 1
        tokens.append(token)
        at = end
    return tokens


def compatible(tables: dict, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For each pair of tokens: does no merge cross the border between them?"""
    rank, codes, code_ranks = tables["rank"], tables["codes"], tables["code_ranks"]
    fine = np.ones(len(left), dtype=bool)
    open_, a, b = np.arange(len(left)), left.astype(np.int64), right.astype(np.int64)
    taken_a, taken_b = np.full(len(left), NO_RULE), np.full(len(left), NO_RULE)
    while len(open_):
        wanted = a * len(rank) + b
        at = np.minimum(np.searchsorted(codes, wanted), len(codes) - 1)
        rule = np.where(codes[at] == wanted, code_ranks[at], NO_RULE)
        crossed = (rule < taken_a) & (rule <= taken_b) & (rule != NO_RULE)
        fine[open_[crossed]] = False
        go = ~crossed & ((rank[a] >= 0) | (rank[b] >= 0))
        open_, a, b, taken_a, taken_b = open_[go], a[go], b[go], taken_a[go], taken_b[go]
        undo_a = rank[a] > rank[b]
        taken_a, taken_b = np.where(undo_a, rank[a], taken_a), np.where(undo_a, taken_b, rank[b])
        a, b = np.where(undo_a, tables["last"][a], a), np.where(undo_a, b, tables["first"][b])
    return fine


def encode_words(tables: dict, words: list[str]) -> dict[str, list[int]]:
    """Tokens of distinct words: proposals, verified together, merged where they fail."""
    proposed = [propose(tables, w.encode()) for w in words]
    borders = np.array([max(0, len(p) - 1) for p in proposed])
    left = np.fromiter(chain.from_iterable(p[:-1] for p in proposed), dtype=np.int64, count=borders.sum())
    right = np.fromiter(chain.from_iterable(p[1:] for p in proposed), dtype=np.int64, count=borders.sum())
    pairs, which = np.unique(left * len(tables["rank"]) + right, return_inverse=True)
    fine = compatible(tables, pairs // len(tables["rank"]), pairs % len(tables["rank"]))[which]
    failing = np.bincount(np.repeat(np.arange(len(words)), borders), weights=~fine, minlength=len(words)) > 0
    return {
        w: merge_exactly(tables, w.encode()) if failed else p for w, p, failed in zip(words, proposed, failing)
    }


def is_latin(text: str) -> bool:
    try:
        return text.isascii() or bool(text.encode("latin-1"))
    except UnicodeEncodeError:
        return False


def split_words(tables: dict, text: str) -> list[str]:
    """Words of a text; a special token's string stands for itself."""
    newer = not is_latin(text) and re.search(tables["newer"], text)
    pattern = regex.compile(tables["strict_pattern"] if newer else WORD_PATTERN)
    if not any(s in text for s in tables["special"]):
        return pattern.findall(text)
    longest_first = sorted(tables["special"], key=len, reverse=True)
    parts = regex.split(f"({'|'.join(map(regex.escape, longest_first))})", text)
    return [w for p in parts for w in ([p] if p in tables["special"] else pattern.findall(p))]


def encode_texts(tables: dict, texts: list[str | None]) -> Iterator[bytes]:
    """Token ids per text, as decimals joined by commas."""
    remembered = tables["remembered"]
    for start in range(0, len(texts), 256):
        words = [split_words(tables, t or "") for t in texts[start : start + 256]]
        if len(remembered) > REMEMBERED_WORDS:
            remembered.clear()
        new = set(chain.from_iterable(words)).difference(remembered)
        special = {w: [tables["special"][w]] for w in new.intersection(tables["special"])}
        made = {**encode_words(tables, list(new.difference(special))), **special} if new else {}
        for w, ids in made.items():
            remembered[w] = ",".join(map(str, ids)).encode()
        for of_text in words:
            yield b",".join([remembered[w] for w in of_text])
        for w in new:
            if len(w) > REMEMBERED_LENGTH:
                del remembered[w]


def parse_ids(joined: bytes) -> list[int]:
    return list(map(int, joined.split(b","))) if joined else []


def decode_ids(tables: dict, ids: Iterable[int]) -> bytes:
    """The text of token ids, in UTF-8; bytes that are no UTF-8 become U+FFFD."""
    raw = b"".join(map(tables["token_bytes"].__getitem__, ids))
    try:
        raw.decode()
    except UnicodeDecodeError:
        return raw.decode(errors="replace").encode()
    return raw


def _mapped(
    docs: DataFrame, path: str, schema: str, columns: Callable[[dict, pa.RecordBatch], list[pa.Array]]
) -> DataFrame:
    """doc_id and what ``columns`` makes of each batch of (doc_id, value)."""
    sent = docs.sparkSession.sparkContext.broadcast(load_vocabulary(path))
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns(sent.value, batch)], names=["doc_id", *names])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {id_type}, {schema}")


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids. A NULL or empty text has no ids."""

    def columns(tables: dict, batch: pa.RecordBatch) -> list[pa.Array]:
        encoded = encode_texts(tables, batch.column(1).to_pylist())
        return [pa.array(map(parse_ids, encoded), pa.list_(pa.int32()))]

    return _mapped(docs.select("doc_id", "text"), path, "ids array<int>", columns)


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, text from (doc_id, ids). NULL ids give an empty text."""

    def columns(tables: dict, batch: pa.RecordBatch) -> list[pa.Array]:
        return [pa.array([decode_ids(tables, ids or ()) for ids in batch.column(1).to_pylist()], pa.binary()).cast(pa.string())]

    return _mapped(encoded.select("doc_id", "ids"), path, "text string", columns)


def bpe_query(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every whole text."""

    def columns(tables: dict, batch: pa.RecordBatch) -> list[pa.Array]:
        counts, of_ids, of_text = [], [], []
        for joined in encode_texts(tables, batch.column(1).to_pylist()):
            ids = parse_ids(joined)
            counts.append(len(ids))
            of_ids.append(hashlib.sha256(joined).hexdigest())
            of_text.append(hashlib.sha256(decode_ids(tables, ids)).hexdigest())
        return [pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())]

    schema = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return _mapped(docs.select("doc_id", "text"), path, schema, columns)
