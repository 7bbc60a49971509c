"""Document quality by regularised quadratic discriminant analysis.

A text becomes a few statistics, transformed to be closer to normal. Each class has a mean and a covariance that is
shrunk towards the pooled one and towards a sphere, so it can be factored however few rows a class has. The score is
the logistic of the difference of log-densities, from Mahalanobis distances through cached Cholesky factors, plus prior log-odds.

Sums for means and covariances are made in the tasks over all labelled rows and added up by Spark; a few hundred numbers
reach the driver.

Defined cases: null or empty text has the statistics of no words and is scored like any other; rows without a label teach nothing; a
class without rows takes the pooled moments, and without any labelled row every score is the prior 0.5; repeated rows count as often
as they stand; ids may be null. No rows give no rows. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palaver.llm.text import Roller, normalised

#: Shares of the pooled covariance and of the sphere in a class's covariance.
TO_POOLED, TO_SPHERE = 0.2, 0.05
NAMES = ("words", "word_length", "symbols", "shouts", "capitals", "digits", "distinct", "repeats", "lines", "ends")
WIDTH = len(NAMES)
UPPER, LOWER, DIGIT, SYMBOL = (np.isin(np.arange(256), list(x)) for x in (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b"#*$%&|<>_~^{}[]\\="))


def statistics(text: str | None, roller: Roller) -> np.ndarray:
    raw = normalised(text)
    n = raw.count(b" ") + 1 if raw else 0
    if not n:
        return np.zeros(WIDTH)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    letters = counts[UPPER].sum() + counts[LOWER].sum()
    runs = roller.windows(raw, 3)
    lines = [x for x in text.split("\n") if x.strip()]
    distinct = len(np.unique(roller.windows(raw, 1)))
    ends = sum(x.rstrip()[-1:] in ".!?:\"'" for x in lines)
    return np.array([
        np.log1p(n),
        np.log(max(1, len(raw) - n + 1) / n),
        np.log1p(20 * counts[SYMBOL].sum() / n),
        np.log1p(20 * counts[ord("!")] / n),
        np.log((counts[UPPER].sum() + 1) / (letters + 20)),
        np.log1p(20 * counts[DIGIT].sum() / n),
        np.log((distinct + 1) / (n + 2)),
        np.log1p(20 * (1 - len(np.unique(runs)) / len(runs))) if len(runs) else 0.0,
        np.log1p(20 * (1 - len(set(lines)) / max(1, len(lines)))),
        np.log1p(20 * (1 - ends / max(1, len(lines)))),
    ])


def _sums(batches):
    roller, total = Roller(7), np.zeros((2, WIDTH + 1, WIDTH + 1))
    for batch in batches:
        for text, label in zip(batch.column(0), batch.column(1), strict=True):
            x = np.append(1.0, statistics(text.as_py(), roller))
            total[label.as_py()] += np.outer(x, x)
    at = np.arange(total.size)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total.ravel())], names=["cell", "value"])


def learn(training: DataFrame, text_col: str = "text", label_col: str = "quality") -> dict:
    """Means, Cholesky factors and prior log-odds from rows with a label of 0 or 1."""
    rows = training.select(F.col(text_col).cast("string").alias("text"), F.col(label_col).cast("int").alias("label")).filter("label in (0, 1)")
    cells = rows.mapInArrow(_sums, "cell int, value double").groupBy("cell").agg(F.sum("value").alias("value")).collect()
    total = np.zeros(2 * (WIDTH + 1) ** 2)
    for r in cells:
        total[r["cell"]] = r["value"]
    total = total.reshape(2, WIDTH + 1, WIDTH + 1)
    n = total[:, 0, 0]
    all_n = max(1.0, n.sum())
    centre = total[:, 0, 1:].sum(axis=0) / all_n
    means = [total[c, 0, 1:] / n[c] if n[c] else centre for c in (0, 1)]
    scatter = [total[c, 1:, 1:] - n[c] * np.outer(means[c], means[c]) for c in (0, 1)]
    pooled = (scatter[0] + scatter[1]) / all_n + 1e-4 * np.eye(WIDTH)
    factors = []
    for c in (0, 1):
        own = scatter[c] / n[c] if n[c] else pooled
        cov = (1 - TO_POOLED) * own + TO_POOLED * pooled
        cov = (1 - TO_SPHERE) * cov + TO_SPHERE * np.trace(cov) / WIDTH * np.eye(WIDTH)
        factors.append(np.linalg.cholesky(cov))
    return {"means": means, "factors": factors, "prior": float(np.log((n[1] + 1) / (n[0] + 1)))}


def log_odds(x: np.ndarray, model: dict) -> np.ndarray:
    """Of label 1, for rows of statistics."""
    density = []
    for mean, factor in zip(model["means"], model["factors"], strict=True):
        z = np.linalg.solve(factor, (x - mean).T)
        density.append(-0.5 * (z * z).sum(axis=0) - np.log(np.diag(factor)).sum())
    return density[1] - density[0] + model["prior"]


def score(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, score (0 to 1, high for label 1)."""

    def run(batches):
        roller = Roller(7)
        for batch in batches:
            x = np.array([statistics(t.as_py(), roller) for t in batch.column(1)]).reshape(-1, WIDTH)
            odds = np.clip(log_odds(x, model), -50, 50) if len(x) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(1 / (1 + np.exp(-odds)))], names=["id", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "id long, score double").withColumnRenamed("id", id_col)
