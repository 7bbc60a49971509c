"""Substring de-duplication: removal of word windows that an earlier document has.

Every window of ``window`` words gets a Rabin-Karp hash. Tasks keep one entry for each hash of a slice
of documents (what repeats inside a slice is settled there, and dealt out by document), pack the entries by bucket, and
Spark's shuffle brings each bucket together; there the smallest document of each hash is found, and all others lose
the window. The bucket comes from a second hash and the number of buckets grows with the corpus, so a match has 64
bits and those of the bucket. Windows are judged on the input; overlapping ones merge into maximal intervals.

Exact copies of a text are found first by digest: all windows of a copy start in the copy with the smallest id
too, so only that one goes through the windows.

Defined cases: null or empty text has no words (digest of the empty text); rows with a null id neither lose words
nor make others lose them; rows that share an id count as one document, each keeping its own words;
fewer words than a window: nothing removed. No rows give no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palaver.llm.tables import maybe_broadcast, written
from palaver.llm.text import Roller, covered, normalised

WINDOW = 13
#: Bytes of text for each bucket of hashes, the least number of buckets, and windows in one slice.
BUCKET_BYTES, LEAST_BUCKETS, SLICE_WINDOWS = 2 << 20, 256, 400_000
#: Odd, so that ids with a common stride are dealt to all buckets.
SPREAD = np.uint64(0x9E3779B97F4A7C15)
ENTRIES = "bucket int, settled boolean, ids binary, hashes binary"


def _pack(ids: np.ndarray) -> bytes:
    return zlib.compress(np.diff(ids, prepend=0).astype("<i8").tobytes(), 1)


def _unpack(raw: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zlib.decompress(raw), "<i8"))


def _later(hashes: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For entries in the order of ids: which is the first of its hash, and the (id, hash) of the later documents, once each."""
    order = np.argsort(hashes, kind="stable")
    h, d = hashes[order], ids[order]
    first = np.ones(len(h), bool)
    first[1:] = h[1:] != h[:-1]
    lead = d[np.maximum.accumulate(np.where(first, np.arange(len(h)), 0))]
    new = first.copy()
    new[1:] |= d[1:] != d[:-1]
    hit = new & (d > lead)
    return order[first], d[hit], h[hit]


def _entries(window: int, buckets: int):
    def run(batches):
        main, other = Roller(1), Roller(2)
        held, count = [], 0

        def flush():
            held.sort(key=lambda x: x[0])
            ids = np.concatenate([np.full(len(h), i, np.int64) for i, h, _ in held])
            hashes = np.concatenate([h for _, h, _ in held])
            where = np.concatenate([b for _, _, b in held])
            keep, late_ids, late = _later(hashes, ids)
            keep.sort()
            ids, hashes, where = ids[keep], hashes[keep], where[keep]
            order = np.argsort(where, kind="stable")
            used, cuts = np.unique(where[order], return_index=True)
            rows = [(int(b), False, _pack(ids[x]), hashes[x].tobytes()) for b, x in zip(used, np.split(order, cuts[1:]), strict=True)]
            if len(late):  # these need not meet: each document's own go to a bucket dealt by its id
                dealt = ((late_ids.view(np.uint64) * SPREAD >> np.uint64(32)) % np.uint64(buckets)).astype(np.int32)
                order = np.lexsort((late_ids, dealt))
                used, cuts = np.unique(dealt[order], return_index=True)
                rows += [(int(b), True, _pack(late_ids[x]), late[x].tobytes()) for b, x in zip(used, np.split(order, cuts[1:]), strict=True)]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.bool_(), pa.binary(), pa.binary()), strict=True)],
                names=["bucket", "settled", "ids", "hashes"],
            )

        for batch in batches:
            for i, text in zip(batch.column(0), batch.column(1), strict=True):
                raw = normalised(text.as_py())
                h = main.windows(raw, window)
                if len(h):
                    where = (other.windows(raw, window) % np.uint64(buckets)).astype(np.int32)
                    held.append((i.as_py(), h, where))
                    count += len(h)
                if count >= SLICE_WINDOWS:
                    yield flush()
                    held, count = [], 0
        if count:
            yield flush()

    return run


def _meet(group: pa.Table) -> pa.Table:
    """The (document, hash) of a bucket that an earlier document has."""
    ids = {True: [np.zeros(0, np.int64)], False: [np.zeros(0, np.int64)]}
    hashes = {True: [np.zeros(0, np.uint64)], False: [np.zeros(0, np.uint64)]}
    for settled, i, h in zip(group["settled"].to_pylist(), group["ids"].to_pylist(), group["hashes"].to_pylist(), strict=True):
        ids[settled].append(_unpack(i))
        hashes[settled].append(np.frombuffer(h, np.uint64))
    d, h = np.concatenate(ids[False]), np.concatenate(hashes[False])
    order = np.argsort(d, kind="stable")
    _, late_ids, late = _later(h[order], d[order])
    out = np.concatenate([late_ids, *ids[True]]), np.concatenate([late, *hashes[True]])
    return pa.table({"id": pa.array(out[0], pa.int64()), "hash": pa.array(out[1].view(np.int64), pa.int64())})


def _cut(window: int):
    def run(batches):
        roller = Roller(1)
        for batch in batches:
            rows = []
            for i, text, copy, hits in zip(*(batch.column(k) for k in range(4)), strict=True):
                raw = normalised(text.as_py())
                words = raw.split(b" ") if raw else []
                gone = np.zeros(len(words), bool)
                if copy.as_py() and len(words) >= window:
                    gone[:] = True
                elif hits.is_valid:
                    bad = np.asarray(hits.values).view(np.uint64)
                    gone = covered(np.isin(roller.windows(raw, window), bad), window, len(words))
                kept = b" ".join(w for w, g in zip(words, gone, strict=True) if not g) if gone.any() else raw
                rows.append((i.as_py(), len(words), int(gone.sum()), hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "replace")))
            yield pa.RecordBatch.from_pydict(
                dict(zip(("id", "n_words", "n_removed", "kept_sha256", "kept_text"), map(list, zip(*rows, strict=True)), strict=True)) if rows else {k: [] for k in ("id", "n_words", "n_removed", "kept_sha256", "kept_text")},
                schema=pa.schema([("id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("kept_text", pa.string())]),
            )

    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Per row: id, n_words, n_removed, kept_sha256, kept_text (the words left, joined by one space)."""
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    digest = F.sha2("text", 256)
    copies = written(
        docs.filter("text is not null and id is not null").groupBy(digest.alias("digest"))
        .agg(F.min("id").alias("first_id"), F.max("id").alias("last_id"), F.sum(F.octet_length("text")).alias("bytes")),
        "text-classes",
    )
    total = copies.agg(F.sum("bytes")).first()[0] or 0
    repeated = maybe_broadcast(copies.filter("last_id > first_id").select("digest", "first_id"))
    flagged = docs.withColumn("digest", digest).join(repeated, "digest", "left")
    flagged = flagged.select("id", "text", F.coalesce(F.col("id") > F.col("first_id"), F.lit(False)).alias("copy"))
    buckets = max(LEAST_BUCKETS, -(-total // BUCKET_BYTES))
    entries = flagged.filter("id is not null and not copy").select("id", "text").mapInArrow(_entries(window, buckets), ENTRIES)
    late = entries.groupBy("bucket").applyInArrow(_meet, "id long, hash long")
    hits = late.groupBy("id").agg(F.collect_list("hash").alias("hits"))
    joined = flagged.join(hits, "id", "left").select("id", "text", "copy", "hits")
    out = joined.mapInArrow(_cut(window), "id long, n_words long, n_removed long, kept_sha256 string, kept_text string")
    return out.withColumnRenamed("id", id_col)
