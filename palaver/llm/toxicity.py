"""Severity of toxicity by cumulative-link ordinal regression over sparse text features.

Features are the distinct lower-case words of a text, hashed. Labels say toxic or not; the grades of the toxic ones come from
how many marked words they have, words that are significantly more frequent in toxic texts: grade 0 is not toxic, 1 to
``GRADES - 1`` divide the toxic texts by that number. P(grade <= k) is the logistic of a threshold minus one weighted sum, with the same weights at all
thresholds, which are kept in order. The expected severity is the sum of P(grade >= k).

The model is fitted on the driver on at most ``SAMPLE`` labelled texts, those with the smallest hash of their id; that is the only
bound. Every text is scored.

Defined cases: null or empty text has no features and scores by the thresholds alone; rows without a label teach nothing; without toxic
training rows nothing is toxic; an id teaches once for each label it has, by the smallest of its texts; ids of scored rows may be null. No rows give no rows. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palaver.llm.tables import maybe_broadcast
from palaver.llm.text import Roller, normalised, word_table

SAMPLE, GRADES, BITS = 20_000, 4, 20
#: Least texts with a word and least z-score of its log-odds ratio for it to be a feature; weight decay; steps of the fit.
LEAST_TEXTS, LEAST_Z, DECAY, STEPS = 4, 4.0, 1e-5, 600
TABLE = word_table(lambda b: 0x61 <= b <= 0x7A or b >= 0x80)


def features(text: str | None, roller: Roller) -> np.ndarray:
    """Sorted distinct hashed words."""
    return np.unique(roller.windows(normalised(text, TABLE), 1) >> np.uint64(64 - BITS)).astype(np.int32)


def _featured(batches):
    roller = Roller(9)
    for batch in batches:
        rows = [features(t.as_py(), roller) for t in batch.column("text")]
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.array(rows, pa.list_(pa.int32()))], names=["id", "label", "words"])


class Marks:
    """Which texts have which marked words: a sparse matrix of ones."""

    def __init__(self, rows: np.ndarray, columns: np.ndarray, shape: tuple[int, int]):
        self.rows, self.columns, self.shape = rows, columns, shape

    @classmethod
    def of(cls, texts: list[np.ndarray], marks: np.ndarray) -> Marks:
        found = [np.searchsorted(marks, words[np.isin(words, marks)]) for words in texts]
        rows = np.repeat(np.arange(len(texts)), [len(own) for own in found])
        return cls(rows, np.concatenate([np.zeros(0, np.int64), *found]), (len(texts), len(marks)))

    def __len__(self) -> int:
        return self.shape[0]

    def sums(self, weights: np.ndarray) -> np.ndarray:
        """For each text, the weights of its words."""
        return np.bincount(self.rows, weights[self.columns], minlength=self.shape[0])

    def totals(self, values: np.ndarray) -> np.ndarray:
        """For each word, the values of its texts."""
        return np.bincount(self.columns, values[self.rows], minlength=self.shape[1])


def marked_words(rows: list[np.ndarray], toxic: np.ndarray) -> np.ndarray:
    """Features that are significantly more, or less, frequent in toxic texts."""
    have = np.zeros((2, 1 << BITS))
    for words, y in zip(rows, toxic, strict=True):
        have[y, words] += 1
    n = np.array([(toxic == 0).sum(), (toxic == 1).sum()])
    odds = np.log((have[1] + 0.5) / (n[1] - have[1] + 0.5)) - np.log((have[0] + 0.5) / (n[0] - have[0] + 0.5))
    error = np.sqrt(1 / (have[1] + 0.5) + 1 / (have[0] + 0.5) + 1 / (n[1] - have[1] + 0.5) + 1 / (n[0] - have[0] + 0.5))
    return np.flatnonzero((have.sum(axis=0) >= LEAST_TEXTS) & (np.abs(odds / error) >= LEAST_Z) & (odds > 0))


def fit(x: Marks, grade: np.ndarray, grades: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and rising thresholds, by Adam on the mean log-likelihood with weight decay."""
    share = np.clip([(grade <= k).mean() for k in range(grades - 1)], 1e-4, 1 - 1e-4)
    cuts = np.log(share / (1 - share))
    theta = np.concatenate(([cuts[0]], np.log(np.maximum(0.05, np.diff(cuts))), np.zeros(x.shape[1])))
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    logistic = lambda z: 1 / (1 + np.exp(-np.clip(z, -50, 50)))
    for step in range(1, STEPS + 1):
        gaps = np.exp(theta[1 : grades - 1])
        cut = theta[0] + np.concatenate(([0], np.cumsum(gaps)))
        z = cut[None, :] - x.sums(theta[grades - 1 :])[:, None]
        c = np.concatenate((np.zeros((len(x), 1)), logistic(z), np.ones((len(x), 1))), axis=1)
        rows = np.arange(len(x))
        p = np.maximum(1e-9, c[rows, grade + 1] - c[rows, grade])
        slope = c * (1 - c)
        upper, lower = slope[rows, grade + 1] / p, slope[rows, grade] / p
        by_cut = np.zeros((len(x), grades + 1))
        by_cut[rows, grade + 1] += upper
        by_cut[rows, grade] -= lower
        by_cut = by_cut[:, 1:grades]
        g_cut = by_cut.mean(axis=0)
        tail = np.cumsum(g_cut[::-1])[::-1]
        g = np.concatenate(([g_cut.sum()], tail[1:] * gaps, -x.totals(by_cut.sum(axis=1)) / len(x) - DECAY * theta[grades - 1 :]))
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta = theta + 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return theta[grades - 1 :], theta[0] + np.concatenate(([0], np.cumsum(np.exp(theta[1 : grades - 1]))))


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE) -> dict:
    """The model from the texts of ``docs`` with a label of 0 or 1 in ``labels``."""
    chosen = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).filter("label in (0, 1) and id is not null")
    chosen = chosen.distinct().orderBy(F.xxhash64("id"), "id", "label").limit(sample)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(maybe_broadcast(chosen, sample), "id")
    # One text of each id, so the sample bounds the texts too and is the same in any partitions.
    rows = rows.groupBy("id", "label").agg(F.min("text").alias("text"))
    found = rows.mapInArrow(_featured, f"id {dict(docs.dtypes)[id_col]}, label int, words array<int>").toArrow().sort_by([("id", "ascending"), ("label", "ascending")])
    toxic = np.array(found["label"].to_pylist(), np.int64)
    words = [np.asarray(x.values) for c in found["words"].chunks for x in c]
    marks = marked_words(words, toxic) if toxic.any() and not toxic.all() else np.zeros(0, np.int64)
    x = Marks.of(words, marks)
    hits = x.sums(np.ones(len(marks)))
    cuts = np.quantile(hits[toxic == 1], np.arange(1, GRADES - 1) / (GRADES - 1)) if toxic.any() else np.zeros(GRADES - 2)
    grade = np.where(toxic == 1, 1 + (hits[:, None] > cuts).sum(axis=1), 0)
    weights, thresholds = fit(x, grade, GRADES) if len(marks) else (np.zeros(0), np.full(GRADES - 1, 50.0))
    return {"marks": marks, "weights": weights, "thresholds": thresholds}


def severity(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """Per row: id, score (probability of any toxicity), grade (the likeliest), expected_severity, toxic (score at the threshold)."""
    marks, weights, thresholds = model["marks"], model["weights"], model["thresholds"]

    def run(batches):
        roller = Roller(9)
        for batch in batches:
            sums = np.array([weights[np.isin(marks, features(t.as_py(), roller))].sum() if len(marks) else 0.0 for t in batch.column(1)]).reshape(-1)
            above = 1 - 1 / (1 + np.exp(-np.clip(thresholds[None, :] - sums[:, None], -50, 50)))
            each = np.diff(np.concatenate((np.zeros((len(sums), 1)), 1 - above, np.ones((len(sums), 1))), axis=1), axis=1)
            columns = [batch.column(0), pa.array(above[:, 0]), pa.array(each.argmax(axis=1), pa.int32()), pa.array(above.sum(axis=1)), pa.array(above[:, 0] >= threshold)]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "score", "grade", "expected_severity", "toxic"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "id long, score double, grade int, expected_severity double, toxic boolean").withColumnRenamed("id", id_col)
