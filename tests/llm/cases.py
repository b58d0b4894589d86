"""Awkward documents and plain versions of the operators to compare with."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, _row STRING, _text STRING, keys STRING, score STRING, shard STRING, fp STRING"


def awkward_rows():
    draw = random.Random(3)
    word = lambda: "".join(draw.choice("abcdeéß") for _ in range(draw.randint(1, 8)))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared = prose(120)
    very_long = prose(12_000)
    texts = [
        (1, shared + " end one"),
        (2, shared + " end one"),
        (2, shared + " end one"),
        (3, None),
        (4, ""),
        (None, shared[:400] + prose(30)),
        (None, None),
        (5, "short"),
        (6, " \t\x0b\n \x0c\r\n"),
        (7, "ab" * 600),
        (8, prose(40) + shared[100:700] + prose(40)),
        (9, very_long),
        (10, very_long[:50_000] + " changed"),
        (11, "Line A\n  line a \nLINE B\nLine A\nLine A\n\n\n"),
        (12, "x\nline A\t\nline b\nother"),
        (13, "1234 5678 !!! ### <| |> $$$ %%%"),
        (14, "日本語のテキスト 😀 <|endoftext|> 　 \x1c don't I'll   end  "),
        (15, "<|endoftext|>"),
    ]
    langs, sources = ["en", "de", None, ""], ["s1", "é", None, "s2", "Z"]
    return [
        (i, t, langs[n % 4], sources[n % 5], len(t) if t else None, "r", "t", "k", "0.5", "7", "f")
        for n, (i, t) in enumerate(texts)
    ]


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def brute_spans(rows, width, first_only=False):
    """(id, bytes, removed, runs, digest) per row: bytes in a window that starts elsewhere too."""
    seen = defaultdict(list)
    texts = [(t or "").encode() for _, t in rows]
    for r, b in enumerate(texts):
        for k in range(len(b) - width + 1):
            seen[b[k : k + width]].append((r, k))
    out = []
    for r, ((i, _), b) in enumerate(zip(rows, texts)):
        gone = bytearray(len(b))
        for k in range(len(b) - width + 1):
            places = seen[b[k : k + width]]
            if len(places) > 1 and not (first_only and places[0] == (r, k)):
                gone[k : k + width] = b"\x01" * width
        rest = bytes(x for x, g in zip(b, gone) if not g)
        runs = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(b), sum(gone), runs, sha(rest)))
    return out


def line_key(line):
    return re.sub("[A-Z]", lambda m: m[0].lower(), re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", line))


def brute_lines(rows, min_docs, min_chars=1):
    """(id, lines, dropped, rest) per row."""
    holders = Counter(k for _, t in rows for k in {line_key(x) for x in (t or "").split("\n")})
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if holders[line_key(x)] < min_docs or len(line_key(x)) < min_chars]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def brute_fingerprint(text, shingle=4):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[k : k + shingle]) for k in range(max(1, len(words) - shingle + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(n, linked):
    """The smallest index reachable from each of n, by depth-first search."""
    label = [None] * n
    for start in range(n):
        todo = [start]
        while todo:
            at = todo.pop()
            if label[at] is None:
                label[at] = start
                todo += [other for other in range(n) if label[other] is None and linked(at, other)]
    return label


def brute_measures(text):
    """words, letters in words, symbols, repeated lines, words in repeated windows."""
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
    many, covered = Counter(windows), set()
    for k, w in enumerate(windows):
        if many[w] > 1:
            covered.update(range(k, k + 8))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)
