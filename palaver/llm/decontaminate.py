"""Benchmark decontamination by winnowing.

From the hashes of all runs of ``GRAM`` words the smallest one in every ``window - GRAM + 1`` consecutive runs is
kept, so any shared span of ``window`` words has a kept hash in common. Fingerprints of documents and of benchmark
items are joined; each hit is extended on the words themselves. An item of fewer words than a window is
one window of its own length; for such lengths all runs of that length are fingerprints.

While the benchmark has at most ``MAX_FINGERPRINTS`` fingerprints (counted), tasks get them sorted and pass on matching hashes
only; a larger benchmark takes the same join with all fingerprints. Benchmark texts travel by item to the
documents that share a fingerprint with them.

Defined cases: null or empty text has no words, no hits and isn't contaminated; an item without words never occurs;
repeated items each count; rows that share a doc_id share their candidate items, each row is judged on its own words; rows
with a null doc_id are judged as one id; items with a null id are ignored. Empty tables give no rows, or clean ones.
Other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palaver.llm.tables import written
from palaver.llm.text import Roller, covered, mix, normalised, word_table

WINDOW, GRAM = 13, 5
MAX_FINGERPRINTS = 4_000_000
#: Word bytes: 0-9, a-z (A-Z are lowered) and all bytes of characters beyond ASCII.
TABLE = word_table(lambda b: 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80)


def winnow(hashes: np.ndarray, width: int) -> np.ndarray:
    """The distinct smallest hashes of all ``width`` consecutive ones."""
    if len(hashes) < width:
        return hashes[:0]
    least = hashes[: len(hashes) - width + 1]
    for k in range(1, width):
        least = np.minimum(least, hashes[k : len(hashes) - width + 1 + k])
    return np.unique(least)


def fingerprints(raw: bytes, roller: Roller, window: int, lengths) -> np.ndarray:
    """Winnowed hashes, and those of all runs of the given lengths; a hash of another length is another hash."""
    parts = [winnow(roller.windows(raw, GRAM), window - GRAM + 1)]
    parts += [np.unique(mix(roller.windows(raw, k) + np.uint64(k))) for k in lengths]
    return np.concatenate(parts)


def _item_marks(window: int):
    def run(batches):
        roller = Roller(5)
        for batch in batches:
            ids, marks, short = [], [], []
            for i, text in zip(*(batch.column(k) for k in range(2)), strict=True):
                raw = normalised(text.as_py(), TABLE)
                n = raw.count(b" ") + 1 if raw else 0
                own = fingerprints(raw, roller, window, [n] if 0 < n < window else [])
                ids += [i.as_py()] * len(own)
                marks += own.view(np.int64).tolist()
                short += [n if n < window else 0] * len(own)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(marks, pa.int64()), pa.array(short, pa.int32())], names=["item_id", "mark", "words"])

    return run


def _doc_marks(window: int, lengths: list[int], wanted: np.ndarray | None):
    def run(batches):
        roller = Roller(5)
        for batch in batches:
            ids, marks = [], []
            for i, text in zip(*(batch.column(k) for k in range(2)), strict=True):
                own = fingerprints(normalised(text.as_py(), TABLE), roller, window, lengths)
                if wanted is not None and len(own):
                    own = own[wanted[np.minimum(np.searchsorted(wanted, own), len(wanted) - 1)] == own]
                if len(own):
                    ids.append(np.full(len(own), i.as_py() or 0, np.int64))
                    marks.append(own)
            if ids:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(ids)), pa.array(np.concatenate(marks).view(np.int64))], names=["id", "mark"]
                )

    return run


def _judge(window: int):
    def run(batches):
        roller, items = Roller(5), {}
        for batch in batches:
            rows = []
            for i, text, found in zip(*(batch.column(k) for k in range(3)), strict=True):
                raw = normalised(text.as_py(), TABLE)
                n = raw.count(b" ") + 1 if raw else 0
                hit, names = np.zeros(n, bool), []
                runs = {}
                for item in found.as_py() or []:
                    words = normalised(item["text"], TABLE)
                    k = min(window, words.count(b" ") + 1)
                    if words not in items:
                        if len(items) > 10_000:
                            items.clear()
                        items[words] = np.unique(roller.windows(words, k))
                    if k not in runs:
                        runs[k] = roller.windows(raw, k)
                    starts = np.isin(runs[k], items[words])
                    if starts.any():
                        names.append(item["item_id"])
                        hit |= covered(starts, k, n)
                digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
                n_hit = int(hit.sum())
                rows.append((i.as_py(), n, n_hit, len(names), digest, n_hit > 0 and 20 * n_hit >= n))
            kinds = {"id": pa.int64(), "n_words": pa.int64(), "n_hit": pa.int64(), "n_items": pa.int64(), "items_sha256": pa.string(), "contaminated": pa.bool_()}
            columns = list(zip(*rows, strict=True)) or [[] for _ in kinds]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds.values(), strict=True)], names=list(kinds))

    return run


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Per row of ``docs``: id, n_words, n_hit, n_items, items_sha256, contaminated (at least a twentieth of the words hit)."""
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text")).filter("item_id is not null")
    marks = written(items.mapInArrow(_item_marks(window), "item_id string, mark long, words int"), "item-marks")
    distinct = marks.select("mark").distinct()
    lengths = sorted(r[0] for r in marks.filter("words > 0").select("words").distinct().collect())
    wanted = None
    if 0 < distinct.limit(MAX_FINGERPRINTS + 1).count() <= MAX_FINGERPRINTS:
        wanted = np.sort(np.asarray(distinct.toArrow().column(0)).view(np.uint64))
    found = docs.mapInArrow(_doc_marks(window, lengths, wanted), "id long, mark long")
    pairs = found.join(marks.select("item_id", "mark"), "mark").select("id", "item_id").distinct()
    named = pairs.join(items, "item_id").groupBy("id").agg(F.collect_list(F.struct("item_id", "text")).alias("items"))
    joined = docs.withColumn("key", F.coalesce("id", F.lit(0).cast("long"))).join(named.withColumnRenamed("id", "key"), "key", "left")
    kinds = "id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"
    return joined.select("id", "text", "items").mapInArrow(_judge(window), kinds).withColumnRenamed("id", id_col)
