"""Document quality by regularised quadratic discriminant analysis.

Each class is a normal density over transformed document statistics; its covariance
is shrunk towards the pooled one and towards a multiple of the identity. The score
is the logistic of the log-density difference, from Mahalanobis distances by the
inverse Cholesky factors, plus the log prior odds.

The text is read once, for the statistics, which are written to the shared folder.
Learning needs only sums of them and of their products, over all labelled rows.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bucketlens.llm.common import id_remainder, summed
from bucketlens.session import staged

STATISTICS = (
    "words", "word_length", "distinct_words", "upper", "digits", "symbols", "pipes", "exclamations",
    "sentence_marks", "commas", "words_per_line", "repeated_lines", "short_words", "common_word",
)
WIDTH = len(STATISTICS)
TO_POOLED, TO_IDENTITY = 0.2, 0.05
# Of a standardised statistic, where all rows are alike.
LEAST_VARIANCE = 1e-3
THRESHOLD = 0.3
EXTRA_WORDS, EXTRA_LINES, USUAL_LENGTH = 12, 3, 6


def _members(chars: bytes) -> np.ndarray:
    return np.bincount(np.frombuffer(chars, dtype=np.uint8), minlength=256) > 0


_UPPER = _members(bytes(range(65, 91)))
_DIGIT = _members(bytes(range(48, 58)))
_SYMBOL = _members(b"#*$%&<>@~^_=+\\{}[]")


def statistics(text: bytes | None) -> list[float]:
    """Statistics of a whole text, on scales on which they are about normal."""
    text = text or b""
    seen = np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256)
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip()]
    distinct: dict[bytes, int] = {}
    for w in words:
        distinct[w] = distinct.get(w, 0) + 1
    # Shares of a short text are drawn towards those of a usual one.
    n, n_lines = len(words) + EXTRA_WORDS, len(lines) + EXTRA_LINES
    upper, digits, symbols = (seen[mask].sum() / n for mask in (_UPPER, _DIGIT, _SYMBOL))
    signs = len(text) - seen[32] - seen[10] + USUAL_LENGTH * EXTRA_WORDS
    return [
        np.log1p(len(words)),
        np.log1p(signs / n),
        (len(distinct) + EXTRA_WORDS) / n,
        np.log1p(4 * upper),
        np.log1p(20 * digits),
        np.log1p(20 * symbols),
        np.log1p(20 * seen[124] / n),
        np.log1p(20 * seen[33] / n),
        np.sqrt((seen[46] + seen[63]) / n),
        np.sqrt(seen[44] / n),
        np.log1p(n / n_lines),
        np.sqrt(1 - (len(set(lines)) + EXTRA_LINES) / n_lines),
        sum(len(w) <= 2 for w in words) / n,
        np.sqrt(max(distinct.values(), default=0) / n),
    ]


@F.arrow_udf(T.ArrayType(T.DoubleType()))
def _statistics(texts: pa.Array) -> pa.Array:
    return pa.array([statistics(t) for t in texts.cast(pa.binary()).to_pylist()], pa.list_(pa.float64()))


def _parts(batch: pa.RecordBatch) -> list[np.ndarray]:
    """The statistics of either class."""
    x = np.array(batch["x"].to_pylist(), dtype=float).reshape(-1, WIDTH)
    y = np.array(batch["quality"].to_pylist())
    return [x[y == k] for k in (0, 1)]


def _sums(batch: pa.RecordBatch) -> np.ndarray:
    """Per class: number of rows, sums."""
    return np.concatenate([np.concatenate([[len(p)], p.sum(axis=0)]) for p in _parts(batch)])


def train(labelled: DataFrame) -> dict:
    """Model from (x, quality 0 or 1). With rows of one class, or none, only a prior.

    Scatters are summed around the means, in a second pass, so that no rounding makes a
    variance negative; rows that are all alike have none and get a least one.
    """
    given = labelled.select("x", "quality")
    sums = summed(given, _sums, 2 * (1 + WIDTH)).reshape(2, 1 + WIDTH)
    n = sums[:, 0]
    if n.min() < 2:
        return {"prior": float(n[1] / n.sum()) if n.sum() else 0.5}
    mean = sums[:, 1:] / n[:, None]

    def scatters(batch: pa.RecordBatch) -> np.ndarray:
        around = [p - m for p, m in zip(_parts(batch), mean)]
        return np.concatenate([(p.T @ p).ravel() for p in around])

    scatter = summed(given, scatters, 2 * WIDTH**2).reshape(2, WIDTH, WIDTH)
    pooled = scatter.sum(axis=0) / (n.sum() - 2)
    scale = np.sqrt(np.maximum(np.diag(pooled), 1e-9))
    factors, logs = [], []
    for k in (0, 1):
        # On standardised statistics, so that the identity is a fair target.
        own, shared = (s / scale[:, None] / scale[None, :] for s in (scatter[k] / (n[k] - 1), pooled))
        mixed = (1 - TO_POOLED) * own + TO_POOLED * shared
        shrunk = (1 - TO_IDENTITY) * mixed + TO_IDENTITY * max(np.trace(mixed) / WIDTH, LEAST_VARIANCE) * np.eye(WIDTH)
        cholesky = np.linalg.cholesky(shrunk)
        factors.append(np.linalg.inv(cholesky) / scale[None, :])
        logs.append(-np.log(np.diag(cholesky)).sum())
    return {"mean": mean, "factors": factors, "logs": logs, "odds": float(np.log(n[1] / n[0]))}


def scores(model: dict, x: np.ndarray) -> np.ndarray:
    """Probability of label 1, rounded so that the order of summing doesn't show."""
    if "prior" in model:
        return np.full(len(x), model["prior"])
    density = [
        log - 0.5 * (((x - mean) @ factor.T) ** 2).sum(axis=1)
        for log, mean, factor in zip(model["logs"], model["mean"], model["factors"])
    ]
    return np.round(1 / (1 + np.exp(-np.clip(density[1] - density[0] + model["odds"], -50, 50))), 6)


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``.

    Labels other than 0 and 1 and labels of held-out documents teach nothing; a NULL id
    has no label and counts as held out. A label given twice counts twice.
    """
    measured = docs.select("doc_id", (id_remainder(F.col("doc_id"), 5) == 0).alias("held_out"), _statistics("text").alias("x"))
    measured = staged(measured, "quality-statistics")
    given = labels.where("quality IN (0, 1)").select("doc_id", F.col("quality").cast("int").alias("quality"))
    model = train(measured.where("NOT held_out").join(given, "doc_id"))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(x: pa.Array) -> pa.Array:
        return pa.array(scores(sent.value, np.array(x.to_pylist(), dtype=float).reshape(-1, WIDTH)))

    scored = measured.select("doc_id", "held_out", score("x").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def quality_query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``score_documents``: every row once, repeated rows alike; a NULL text counts as an empty one."""
    return score_documents(docs, labels)
