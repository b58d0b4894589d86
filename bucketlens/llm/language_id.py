"""Language identification by sparse multinomial logistic regression.

Features are character n-grams of one to three, hashed, weighted by TF-IDF and
scaled to length 1. Document frequencies come from all documents that may be learnt
from. The weights come from a bounded sample of them, per-coordinate
follow-the-regularised-leader with elastic net (the L1 part leaves most weights 0),
and a temperature fitted on a part of the sample that was not trained on turns
logits into calibrated probabilities.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bucketlens.llm.common import id_remainder, packed, summed

BITS = 14
UNKNOWN = "und"
# Rows sampled per language for the weights (expected number; hash-selected).
SAMPLE_PER_LANGUAGE = 1_000
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.001
# Every fifth sampled row fits the temperature.
HELD_FOR_TEMPERATURE = 5
_SEEDS = (0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35)


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def ngram_counts(text: str) -> np.ndarray:
    """Counts of hashed n-grams of the whole text, lower case, other signs as blanks."""
    chars = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), dtype="<u4").copy()
    chars[(chars < 97) | ((chars > 122) & (chars < 192))] = 32
    total = np.zeros(1 << BITS, dtype=np.int64)
    one, two, three = (chars * np.uint32(s) for s in _SEEDS)
    for gram in (one, one[:-1] * np.uint32(31) ^ two[1:], (one[:-2] * np.uint32(31) ^ two[1:-1]) * np.uint32(31) ^ three[2:]):
        gram = gram ^ (gram >> np.uint32(15))
        total += np.bincount((gram * np.uint32(_SEEDS[0])) >> np.uint32(32 - BITS), minlength=1 << BITS)
    return total


def sparse_features(counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.flatnonzero(counts)
    value = (1 + np.log(counts[at])) * idf[at]
    return at, value / np.linalg.norm(value)


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def ftrl(rows: list[tuple[np.ndarray, np.ndarray]], classes: np.ndarray, n_classes: int) -> np.ndarray:
    """Weights by FTRL-proximal steps, one row at a time, in the order given."""
    z, n = np.zeros((1 << BITS, n_classes)), np.zeros((1 << BITS, n_classes))

    def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        return -np.sign(z) * np.maximum(np.abs(z) - L1, 0) / ((BETA + np.sqrt(n)) / ALPHA + L2)

    for _ in range(EPOCHS):
        for (at, value), k in zip(rows, classes):
            w = weights(z[at], n[at])
            error = _softmax(value @ w)
            error[k] -= 1
            gradient = value[:, None] * error
            more = n[at] + gradient**2
            z[at] += gradient - (np.sqrt(more) - np.sqrt(n[at])) / ALPHA * w
            n[at] = more
    return weights(z, n)


def temperature(logits: np.ndarray, classes: np.ndarray) -> float:
    """The scale that gives the least log loss, from a fine grid of powers of two."""
    grid = 2.0 ** np.arange(-6, 4.01, 0.125)
    places = np.arange(len(classes))
    loss = [-np.log(_softmax(logits / t)[places, classes] + 1e-12).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


def train(learnable: DataFrame, sample_per_language: int = SAMPLE_PER_LANGUAGE) -> dict | None:
    """Model from (doc_id, text, lang); None where no row has both a letter and a language."""
    rows = learnable.where("text IS NOT NULL AND lang IS NOT NULL").select("doc_id", "text", "lang")
    # One row per language: the model has a column for each.
    counted = {r[0]: r[1] for r in rows.groupBy("lang").count().collect()}

    def frequencies(batch: pa.RecordBatch) -> np.ndarray:
        total = np.zeros((1 << BITS) + 1)
        for text in batch["text"].to_pylist():
            total[:-1] += ngram_counts(text) > 0
        total[-1] = batch.num_rows
        return total

    seen = summed(rows.select("text"), frequencies, (1 << BITS) + 1)
    idf = np.log((1 + seen[-1]) / (1 + seen[:-1])) + 1

    uniform = (F.xxhash64(F.lit("sample"), "doc_id", "text") / F.lit(2.0**64)) + 0.5
    share = F.lit(0.0)
    for lang, n in counted.items():
        share = F.when(F.col("lang") == lang, min(1.0, sample_per_language / n)).otherwise(share)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sparse_features(ngram_counts(t), idf) if has_letter(t) else ((), ()) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["u"], batch["lang"], pa.array([a for a, _ in found], pa.list_(pa.int32())), pa.array([v for _, v in found], pa.list_(pa.float32()))],
                names=["u", "lang", "at", "value"],
            )

    # Copies of a text count once, and twice the expected rows of a language are the most.
    sampled = rows.withColumn("u", uniform).where(F.col("u") < share).groupBy("text", "lang").agg(F.min("u").alias("u"))
    first = F.row_number().over(Window.partitionBy("lang").orderBy("u", "text"))
    sampled = sampled.withColumn("_nth", first).where(F.col("_nth") <= 2 * sample_per_language).select("u", "text", "lang")
    # The sample's size is bounded; as arrays it takes a few kilobytes a row.
    given = sampled.mapInArrow(features, "u DOUBLE, lang STRING, at ARRAY<INT>, value ARRAY<FLOAT>").toArrow()
    given = given.sort_by([("u", "ascending"), ("lang", "ascending")]).combine_chunks()
    given = given.filter(pc.greater(pc.list_value_length(given["at"]), 0)).combine_chunks()
    if not given.num_rows:
        return None
    named = given["lang"].to_pylist()
    languages = sorted(set(named))
    classes = np.array([languages.index(lang) for lang in named])
    ends = np.cumsum(pc.list_value_length(given["at"]).to_numpy())
    flat = [pc.list_flatten(given[c]).to_numpy() for c in ("at", "value")]
    vectors = [(flat[0][e - n : e], flat[1][e - n : e].astype(float)) for e, n in zip(ends, np.diff(ends, prepend=0))]
    # The sample's order is random; within it u says nothing about the language.
    order = np.argsort([hash_of(i) for i in range(len(vectors))])
    fit = [i for i in order if i % HELD_FOR_TEMPERATURE or len(vectors) < HELD_FOR_TEMPERATURE]
    weights = ftrl([vectors[i] for i in fit], classes[fit], len(languages))
    held = [i for i in order if not i % HELD_FOR_TEMPERATURE]
    logits = np.array([v @ weights[at] for at, v in (vectors[i] for i in held)])
    return {"languages": languages, "idf": idf, "weights": weights, "temperature": temperature(logits, classes[held])}


def hash_of(number: int) -> int:
    return (number * 0x9E3779B97F4A7C15 + 0x85EBCA6B) % 2**64


def predictor(docs: DataFrame, model: dict | None):
    """A column function: text to struct(lang_pred, score)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang_pred: string, score: double>")
    def predict(texts: pa.Array) -> pa.Array:
        model, found, scores = sent.value, [], []
        for text in texts.to_pylist():
            if model is None or not has_letter(text):
                found.append(UNKNOWN)
                scores.append(0.0)
                continue
            at, value = sparse_features(ngram_counts(text), model["idf"])
            p = _softmax(value @ model["weights"][at] / model["temperature"])
            best = int(p.argmax())
            found.append(model["languages"][best])
            scores.append(round(float(p[best]), 6))
        return pa.StructArray.from_arrays([pa.array(found, pa.string()), pa.array(scores, pa.float64())], names=["lang_pred", "score"])

    return predict


def held_out(doc_id: Column) -> Column:
    return id_remainder(doc_id, 3) == 1


def trained(docs: DataFrame) -> dict | None:
    """The model of all documents that aren't held out; needs doc_id, text, lang."""
    return train(docs.where(~held_out(F.col("doc_id"))))


def keep_identified(docs: DataFrame, min_score: float = 0.4) -> DataFrame:
    """Documents, columns as given, whose language is known with at least ``min_score``."""
    language = predictor(docs, trained(docs))("_row.text")
    found = packed(docs).withColumn("_language", language)
    known = (F.col("_language.lang_pred") != UNKNOWN) & (F.col("_language.score") >= min_score)
    return found.where(known).select("_row.*")


def language_query(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score.

    Learns from the text and language of documents that aren't held out. A text that is
    NULL or has no letter is ``und`` with score 0, and so is any text if there is
    nothing to learn from. A NULL id is not held out.
    """
    language = predictor(docs, trained(docs))("text").alias("_language")
    found = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), language)
    return found.select("doc_id", "held_out", "_language.lang_pred", "_language.score")
