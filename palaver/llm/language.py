"""Language identification of mixed text.

The model holds, for each learned language, log-probabilities of letter trigrams hashed into a fixed number of bins,
and the scripts the language is written in. A word is a run of letters. Its script narrows the candidate languages; its score for each
is the sum over its trigrams. Viterbi over the words, with a penalty for every change of language, labels spans; a text's language
is the one with most letters, ties going to the first name, and its score is that share.

Counts come from all training rows by partial sums in the tasks; only (language, bin, count) reaches the driver, bounded by the languages
times the bins.

Defined cases: text that is null or has no letter is ``und`` with score 0 and no spans; a script that no learned language uses is no
evidence; rows without a language teach nothing; without any training row every text with a letter is ``und``. Repeated
rows count as often as they stand; ids may be null. No rows give no rows. Other columns are ignored.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palaver.llm.text import mix

BINS, PENALTY = 1 << 15, 12.0
#: Log-score of a word in a script that a language isn't written in, and the least share of a language's letters that makes a script its own.
FOREIGN, LEAST_SHARE = -30.0, 0.002
#: Letters scored at once, and cells of the block of texts that are labelled together.
LETTERS, CELLS = 1 << 18, 1 << 20
#: Code point ranges of scripts; 0 is every other one.
SCRIPTS = (
    (1, 0x41, 0x24F), (1, 0x1E00, 0x1EFF), (2, 0x370, 0x3FF), (2, 0x1F00, 0x1FFF), (3, 0x400, 0x52F), (4, 0x530, 0x58F),
    (5, 0x590, 0x5FF), (6, 0x600, 0x6FF), (6, 0x750, 0x77F), (7, 0x900, 0x97F), (8, 0x980, 0x9FF), (9, 0xE00, 0xE7F),
    (10, 0x10A0, 0x10FF), (11, 0x1100, 0x11FF), (11, 0xAC00, 0xD7AF), (12, 0x3040, 0x30FF), (13, 0x3400, 0x4DBF), (13, 0x4E00, 0x9FFF),
)
N_SCRIPTS, PLANE = 14, 0x20000


class Letters:
    """Words and hashed trigrams of texts."""

    def __init__(self):
        low = [chr(c).lower() for c in range(PLANE)]
        self.lower = np.array([ord(x) if len(x) == 1 else c for c, x in enumerate(low)], np.uint32)
        # By category (L) over all planes: tags, variation selectors and private use are no letters.
        self.alpha = np.array([chr(c).isalpha() for c in range(sys.maxunicode + 1)])
        self.script = np.zeros(PLANE, np.uint8)
        for number, first, last in SCRIPTS:
            self.script[first : last + 1] = number

    def read(self, text: str):
        """Trigram bins of all letters, the first letter of each word among them, the script of each word, and the words' bounds in the text."""
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
        inside = np.minimum(points, PLANE - 1)
        at = np.flatnonzero(self.alpha[points])
        if not len(at):
            return np.zeros(0, np.uint16), at, np.zeros(0, np.uint8), at, at
        new = np.ones(len(at), bool)
        new[1:] = np.diff(at) > 1
        last = np.ones(len(at), bool)
        last[:-1] = new[1:]
        c = self.lower[inside[at]].astype(np.uint64)
        before, after = np.concatenate(([0], c[:-1])).astype(np.uint64), np.concatenate((c[1:], [0])).astype(np.uint64)
        before[new], after[last] = 0, 0
        bins = (mix((before << np.uint64(42)) | (c << np.uint64(21)) | after) % np.uint64(BINS)).astype(np.uint16)
        first = np.flatnonzero(new)
        return bins, first, self.script[inside[at[first]]], at[first], at[last] + 1


def _counts(batches):
    letters, totals = Letters(), {}
    for batch in batches:
        for text, lang in zip(batch.column(0), batch.column(1), strict=True):
            own = totals.setdefault(lang.as_py(), np.zeros(BINS + N_SCRIPTS, np.int64))
            bins, first, script, _, _ = letters.read(text.as_py())
            own[:BINS] += np.bincount(bins, minlength=BINS)
            sizes = np.diff(np.append(first, len(bins)))
            own[BINS:] += np.bincount(script, weights=sizes, minlength=N_SCRIPTS).astype(np.int64)
    for lang, own in totals.items():
        at = np.flatnonzero(own)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(own[at])], names=["lang", "bin", "n"])


def learn(training: DataFrame, text_col: str = "text", lang_col: str = "lang") -> dict:
    """The model of rows with a text and a language."""
    rows = training.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")).dropna()
    found = rows.mapInArrow(_counts, "lang string, bin int, n long").groupBy("lang", "bin").agg(F.sum("n").alias("n")).toArrow()
    names = sorted(set(found["lang"].to_pylist()))
    counts = np.zeros((BINS + N_SCRIPTS, len(names)))
    if names:
        where = {n: k for k, n in enumerate(names)}
        counts[found["bin"].to_numpy(), [where[x] for x in found["lang"].to_pylist()]] = found["n"].to_numpy()
    smooth = counts[:BINS] + 0.1
    share = counts[BINS:] / np.maximum(1, counts[BINS:].sum(axis=0))
    allowed = share >= LEAST_SHARE
    return {"names": names, "scores": np.log(smooth / smooth.sum(axis=0)).astype(np.float32), "allowed": allowed}


def word_scores(model: dict, bins, first, script) -> np.ndarray:
    """Log-scores (words x languages)."""
    ends = np.append(first[1:], len(bins))
    parts, at = [], 0
    while at < len(first):
        to = max(at + 1, int(np.searchsorted(ends, first[at] + LETTERS)))
        rows = model["scores"][bins[first[at] : ends[to - 1]]]
        parts.append(np.add.reduceat(rows, first[at:to] - first[at], axis=0))
        at = to
    out = np.concatenate(parts)
    allowed = model["allowed"][script]
    known = allowed.any(axis=1)
    return np.where(known[:, None], np.where(allowed, out, out + FOREIGN), np.float32(0))


def viterbi(texts: list[np.ndarray], penalty: float) -> list[np.ndarray]:
    """The best label of each word of each text, where every change of label costs the penalty; texts go side by side."""
    n, width, longest = len(texts), texts[0].shape[1], max(map(len, texts))
    padded = np.zeros((longest, n, width), np.float32)
    for k, t in enumerate(texts):
        padded[: len(t), k] = t
    stay, best = np.ones((longest, n, width), bool), np.zeros((longest, n), np.int16)
    v, rows = padded[0].copy(), np.arange(n)
    for t in range(1, longest):
        best[t] = v.argmax(axis=1)
        change = (v[rows, best[t]] - np.float32(penalty))[:, None]
        np.greater_equal(v, change, out=stay[t])
        v = np.maximum(v, change) + padded[t]
    now, labels = v.argmax(axis=1), np.zeros((longest, n), np.int16)
    for t in range(longest - 1, -1, -1):
        labels[t] = now
        now = np.where(stay[t, rows, now], now, best[t])
    return [labels[: len(t), k] for k, t in enumerate(texts)]


def _labelled(model: dict, penalty: float):
    names = model["names"]
    span = pa.struct([("lang", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    schema = pa.schema([("id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("spans", pa.list_(span))])

    def run(batches):
        letters = Letters()
        for batch in batches:
            ids = batch.column(0).to_pylist()
            results = [("und", 0.0, [])] * len(ids)
            # Longest first, so that texts of like length are labelled together and a block stays small.
            lengths = np.array([len(t.as_py() or "") for t in batch.column(1)])
            block, longest = [], 0

            def settle(block):
                for (k, bins, first, start, end, _), labels in zip(block, viterbi([b[5] for b in block], penalty), strict=True):
                    sizes = np.diff(np.append(first, len(bins)))
                    share = np.bincount(labels, weights=sizes, minlength=len(names)) / len(bins)
                    cuts = np.flatnonzero(np.diff(labels, prepend=-1))
                    spans = [
                        {"lang": names[labels[c]], "start": int(start[c]), "end": int(end[d - 1])}
                        for c, d in zip(cuts, np.append(cuts[1:], len(labels)), strict=True)
                    ]
                    top = int(share.argmax())
                    results[k] = (names[top], float(share[top]), spans)

            for k in np.argsort(-lengths, kind="stable"):
                text = batch.column(1)[int(k)].as_py()
                if not text or not names:
                    continue
                bins, first, script, start, end = letters.read(text)
                if not len(bins):
                    continue
                longest = max(longest, len(first))
                block.append((int(k), bins, first, start, end, word_scores(model, bins, first, script)))
                if longest * len(block) * len(names) >= CELLS:
                    settle(block)
                    block, longest = [], 0
            if block:
                settle(block)
            columns = [ids, *map(list, zip(*results, strict=True))] if ids else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return run


def identify(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text", penalty: float = PENALTY) -> DataFrame:
    """Per row: id, lang_pred, score, spans (language, first character, end)."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    out = rows.mapInArrow(_labelled(model, penalty), "id long, lang_pred string, score double, spans array<struct<lang:string,start:long,end:long>>")
    return out.withColumnRenamed("id", id_col)
