"""Fill-in-the-middle: documents cut in three and put in another order.

A token is a run of the letters A to Z, of either case, or any other single
character. Where a document is cut is drawn as a number of tokens, so that no word is
cut. The bytes of a group of texts get a wavelet matrix over four character classes.
Its rank queries count the tokens and the characters before any byte, and bisection on
those ranks finds both cuts of every text of the group at once.

One pass without a shuffle. A group of texts has ``GROUP_BYTES`` bytes at most, or is
one longer text; working memory is some ten times the group.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The marks before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"

GROUP_BYTES = 8 << 20
# Classes of bytes: a letter after a letter, a letter that starts a run, a byte that
# goes on with a character of several bytes, any other byte.
INSIDE, START, REST, OTHER = range(4)


class Bits:
    """A bit sequence with the number of ones before any place."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros(-(-(len(bits) + 1) // 64) * 64, dtype=bool)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])

    def ones(self, at: np.ndarray) -> np.ndarray:
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        below = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
        return self.before[word] + np.bitwise_count(below)


class WaveletMatrix:
    """Rank of each of four classes: the high bits, then the low bits with those of high bit 0 first."""

    def __init__(self, classes: np.ndarray):
        is_high = classes >= 2
        low = (classes & 1).astype(bool)
        self.high = Bits(is_high)
        self.low = Bits(np.concatenate([low[~is_high], low[is_high]]))
        self.zeros = len(classes) - int(np.count_nonzero(is_high))

    def rank(self, symbol: int, at: np.ndarray) -> np.ndarray:
        """How many of the first ``at`` places hold ``symbol``."""
        ones = self.high.ones(at)
        first = np.int64(self.zeros if symbol >= 2 else 0)
        n = ones if symbol >= 2 else at - ones
        ones = self.low.ones(first + n) - self.low.ones(first)
        return ones if symbol & 1 else n - ones


def byte_classes(data: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """The class of each byte of texts that stand one after another, from ``begins`` on."""
    lowered = data | 0x20
    letter = (lowered >= 0x61) & (lowered <= 0x7A)
    goes_on = np.zeros(len(data), dtype=bool)
    goes_on[1:] = letter[:-1]
    goes_on[begins[begins < len(data)]] = False
    other = np.where(data >> 6 == 2, REST, OTHER)
    return np.where(letter, np.where(goes_on, INSIDE, START), other).astype(np.uint8)


class Texts:
    """Token and character counts of a group of texts, and where to cut them."""

    def __init__(self, texts: list[bytes]):
        lengths = np.array([len(t) for t in texts], dtype=np.int64)
        self.ends = np.cumsum(lengths)
        self.begins = self.ends - lengths
        data = np.frombuffer(b"".join(texts), dtype=np.uint8)
        self.matrix = WaveletMatrix(byte_classes(data, self.begins))

    def tokens_before(self, at: np.ndarray) -> np.ndarray:
        return self.matrix.rank(START, at) + self.matrix.rank(OTHER, at)

    def characters(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return end - begin - (self.matrix.rank(REST, end) - self.matrix.rank(REST, begin))

    def tokens(self) -> np.ndarray:
        return self.tokens_before(self.ends) - self.tokens_before(self.begins)

    def after(self, n: np.ndarray) -> np.ndarray:
        """The last place of every text with at most ``n`` tokens started before it."""
        low, high = self.begins.copy(), self.ends.copy()
        wanted = self.tokens_before(self.begins) + n
        while (low < high).any():
            middle = (low + high + 1) >> 1
            few = self.tokens_before(middle) <= wanted
            low, high = np.where(few, middle, low), np.where(few, high, middle - 1)
        return low


def draws(doc_id: int | None, seed: int) -> list[int]:
    """Four unsigned 32-bit numbers that follow from the id; a NULL id counts as empty text."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[k : k + 8], 16) for k in range(0, 32, 8)]


def _marked(text: bytes) -> bool:
    return any(mark.encode() in text for mark in (PREFIX, SUFFIX, MIDDLE))


def cut_texts(ids: list[int | None], texts: list[bytes], seed: int, percent: int, spm_percent: int) -> tuple[list, ...]:
    """n, form, prefix_chars, middle_chars, output of every text."""
    group = Texts(texts)
    n = group.tokens()
    drawn = np.array([draws(i, seed) for i in ids], dtype=np.int64).reshape(-1, 4)
    cuts = drawn[:, :2] % (n[:, None] + 1)
    first, last = group.after(cuts.min(axis=1)), group.after(cuts.max(axis=1))
    prefix_chars, middle_chars = group.characters(group.begins, first), group.characters(first, last)
    stay_plain, suffix_first = drawn[:, 2] % 100 >= percent, drawn[:, 3] % 100 < spm_percent
    forms, outputs, chars = [], [], []
    p, s, m = (mark.encode() for mark in (PREFIX, SUFFIX, MIDDLE))
    places = zip(texts, (first - group.begins).tolist(), (last - group.begins).tolist(), stay_plain.tolist(), suffix_first.tolist(), prefix_chars.tolist(), middle_chars.tolist())
    for text, a, b, plain, swapped, in_prefix, in_middle in places:
        if plain or not text or _marked(text):
            forms.append(PLAIN)
            outputs.append(text)
            chars.append((None, None))
            continue
        parts = (s, text[b:], p, text[:a]) if swapped else (p, text[:a], s, text[b:])
        forms.append(SPM if swapped else PSM)
        outputs.append(b"".join((*parts, m, text[a:b])))
        chars.append((in_prefix, in_middle))
    return n.tolist(), forms, *map(list, zip(*chars)), outputs


def _groups(texts: list[bytes], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of texts with ``most`` bytes at most, or one text."""
    begin = size = 0
    for k, text in enumerate(texts):
        if k > begin and size + len(text) > most:
            yield begin, k
            begin, size = k, 0
        size += len(text)
    if begin < len(texts):
        yield begin, len(texts)


def fim_documents(docs: DataFrame, seed: int = 1, percent: int = 90, spm_percent: int = 20) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output of every row of ``docs``.

    ``n`` counts the tokens. ``percent`` of the documents are cut, ``spm_percent`` of
    these put the suffix first; which ones and where follows from ``seed`` and the id
    alone, so rows that share an id are drawn alike and repeated rows come out equal.
    Empty texts and texts that hold a mark stay plain, with NULL for the two counts of
    characters. A NULL text is an empty one, a NULL id is drawn as empty text. Other
    columns are not looked at; no rows give no rows.
    """
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            texts = [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
            for begin, end in _groups(texts, GROUP_BYTES):
                own = ids.slice(begin, end - begin)
                n, forms, in_prefix, in_middle, outputs = cut_texts(own.to_pylist(), texts[begin:end], seed, percent, spm_percent)
                numbers = [pa.array(x, pa.int64()) for x in (n, in_prefix, in_middle)]
                columns = [own, numbers[0], pa.array(forms, pa.string()), *numbers[1:], pa.array(outputs, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n BIGINT, form STRING, prefix_chars BIGINT, middle_chars BIGINT, output STRING"
    return docs.select("doc_id", "text").mapInArrow(cut, schema)


def restored(form: Column, output: Column) -> Column:
    """The text that ``output`` was made of: marks stand in no text that was cut."""

    def between(begin: str, end: str | None) -> Column:
        start = F.instr(output, begin) + len(begin)
        length = F.instr(output, end) - start if end else F.length(output)
        return F.substr(output, start, length)

    psm = F.concat(between(PREFIX, SUFFIX), between(MIDDLE, None), between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), between(MIDDLE, None), between(SUFFIX, PREFIX))
    return F.when(form == PSM, psm).when(form == SPM, spm).otherwise(output)


def fim_query(docs: DataFrame) -> DataFrame:
    """What ``fim_documents`` makes, with digests of the output and of the text rebuilt from it."""
    cut = fim_documents(docs)
    rebuilt = restored(F.col("form"), F.col("output"))
    return cut.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(rebuilt.cast("binary"), 256).alias("restored_sha256"),
    )


def oracle() -> str:
    """The same in DuckDB: tokens as a list, cut by slices."""
    return f"""
WITH tokens AS (
    SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS t,
           sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
    FROM documents
), drawn AS (
    SELECT doc_id, text, t, len(t) AS n,
           CAST('0x' || h[1:8] AS BIGINT) % (len(t) + 1) AS c1, CAST('0x' || h[9:16] AS BIGINT) % (len(t) + 1) AS c2,
           CAST('0x' || h[17:24] AS BIGINT) % 100 AS h3, CAST('0x' || h[25:32] AS BIGINT) % 100 AS h4
    FROM tokens
), cut AS (
    SELECT doc_id, text, n,
           CASE WHEN text = '' OR contains(text, '{PREFIX}') OR contains(text, '{SUFFIX}') OR contains(text, '{MIDDLE}') OR h3 >= 90
                THEN '{PLAIN}' WHEN h4 < 20 THEN '{SPM}' ELSE '{PSM}' END AS form,
           coalesce(array_to_string(t[1:least(c1, c2)], ''), '') AS prefix,
           coalesce(array_to_string(t[least(c1, c2) + 1:greatest(c1, c2)], ''), '') AS middle,
           coalesce(array_to_string(t[greatest(c1, c2) + 1:], ''), '') AS suffix
    FROM drawn
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> '{PLAIN}' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> '{PLAIN}' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN '{PSM}' THEN '{PREFIX}' || prefix || '{SUFFIX}' || suffix || '{MIDDLE}' || middle
                        WHEN '{SPM}' THEN '{SUFFIX}' || suffix || '{PREFIX}' || prefix || '{MIDDLE}' || middle
                        ELSE text END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM cut
"""
