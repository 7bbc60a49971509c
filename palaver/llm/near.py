"""Near-duplicate groups by fast similarity sketching, banding and exact verification.

The sketch of a shingle set has ``T`` coordinates, filled in rounds. In each of the first T rounds every element is
placed into a hashed bin with a hashed value; in round T + i all elements go to bin i. A bin keeps the smallest
(round, value), so bins filled in an earlier round stay, and after 2T rounds every coordinate is filled whatever the
size of the set. Coordinates of two sets agree with the probability of their Jaccard similarity, and their share is concentrated
around it. ``BANDS`` bands of ``ROWS`` coordinates are joined: a pair of similarity 0.8 shares none of them with a
probability below 3e-7.

Documents with equal sets form a class, represented by its smallest id; only representatives are compared.
Candidates are compared in two passes, so that a family of many near copies does not give all its pairs:
first each member of a bucket with the smallest one; then, only in buckets whose members those links have not yet brought
together, the other pairs that are still apart, unless their sizes or their distances from the smallest member rule it out (Jaccard
distance is a metric), or their sketches agree in fewer coordinates than five standard deviations below the threshold. Large buckets are compared in blocks. Every candidate is confirmed on full sets.

Defined cases: null or empty text has an empty set, which is linked with nothing; fewer words than a
shingle make one shingle; rows with a null id are never linked and have a null component; rows that share an id are
one node, linked with what any of their texts is linked with. No rows give no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palaver.llm.components import components, contracted, linked, nearest
from palaver.llm.tables import maybe_broadcast, written
from palaver.llm.text import Roller, mix, normalised

BANDS, ROWS = 50, 6
T = BANDS * ROWS
#: Coordinates, two bits each, of the finer sketch that candidates of the second pass are tested by.
FINE = 1200
#: Members of a bucket compared at once.
BLOCK = 512
EMPTY = np.zeros(0, np.uint64)


def shingles(raw: bytes, words: int, roller: Roller) -> np.ndarray:
    """Sorted distinct hashes of the shingles of normalised bytes."""
    return np.unique(roller.sequence(raw.lower(), words))


def sketch(elements: np.ndarray, t: int = T) -> np.ndarray:
    """The t coordinates of a set that isn't empty, a byte each."""
    low = np.uint64(0xFFFFFFFF)
    bins = np.full(t, np.iinfo(np.uint64).max, np.uint64)
    step = max(1, -(-2 * t // len(elements)))
    for at in range(0, 2 * t, step):
        rounds = np.arange(at, min(2 * t, at + step), dtype=np.uint64)[:, None]
        h = mix(elements[None, :] + mix(rounds + np.uint64(1)))
        where = ((h >> np.uint64(32)) * np.uint64(t)) >> np.uint64(32)
        where = np.where(rounds < t, where, rounds - np.minimum(rounds, np.uint64(t)))
        np.minimum.at(bins, where.ravel().astype(np.intp), ((rounds << np.uint64(32)) | (h & low)).ravel())
        if bins.max() < np.uint64(min(t, at + step)) << np.uint64(32) or at + step >= 2 * t:
            break
    return (mix(bins) & np.uint64(255)).astype(np.uint8)


def _sketches(words: int):
    def run(batches):
        roller = Roller(3)
        for batch in batches:
            rows = []
            for i, text, text_key in zip(*(batch.column(k) for k in range(3)), strict=True):
                s = shingles(normalised(text.as_py()), words, roller)
                key = hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None
                rows.append((i.as_py(), text_key.as_py(), len(s), key, sketch(s).tobytes() if len(s) else None))
            columns = list(zip(*rows, strict=True)) or [[], [], [], [], []]
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["id", "text_key", "n_shingles", "set_key", "sketch"])

    return run


def _similar(words: int):
    def run(batches):
        roller = Roller(3)
        last, kept = None, EMPTY
        for batch in batches:
            rows = []
            for a, b, x, y in zip(*(batch.column(k) for k in range(4)), strict=True):
                if a.as_py() != last:
                    last, kept = a.as_py(), shingles(normalised(x.as_py()), words, roller)
                other = shingles(normalised(y.as_py()), words, roller)
                both = len(np.intersect1d(kept, other, assume_unique=True))
                rows.append((last, b.as_py(), both, len(kept) + len(other) - both))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(4)], names=["a", "b", "both", "either"])

    return run


def _compared(pairs: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """The pairs (a, b) with the sizes of the intersection and the union of their full sets."""
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("y"))
    left = texts.select(F.col("id").alias("a"), F.col("text").alias("x"))
    joined = pairs.join(right, "b").join(left, "a").select("a", "b", "x", "y")
    return joined.mapInArrow(_similar(words), "a long, b long, both long, either long")


def _links(compared: DataFrame, percent: int) -> DataFrame:
    return compared.filter(100 * F.col("both") >= percent * F.col("either")).select("a", "b")


def _fine(words: int):
    def run(batches):
        roller = Roller(3)
        for batch in batches:
            out = []
            for text in batch.column(1):
                s = sketch(shingles(normalised(text.as_py()), words, roller), FINE) & 3
                out.append(np.bitwise_or.reduce([part << 2 * k for k, part in enumerate(np.split(s, 4))]).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["id", "fine"])

    return run


def _across(percent: int):
    return lambda batches: _pairs_across(batches, percent)


def _pairs_across(batches, percent: int):
    """Pairs of members of a cell that may be similar, across components; the rows of a cell follow each other.

    A pair that shares several bands comes from the first of them only.
    """
    held: list[pa.RecordBatch] = []
    share = percent / 100
    sure = share - 5 * (share * (1 - share) / T) ** 0.5
    by_chance = share + (1 - share) / 4
    fine_sure = by_chance - 5 * (by_chance * (1 - by_chance) / FINE) ** 0.5

    def pairs(cell: pa.Table):
        ids, comp = cell["id"].to_numpy(), cell["component"].to_numpy()
        side = cell["side"].to_numpy()
        s = np.frombuffer(b"".join(cell["sketch"].to_pylist()), np.uint8).reshape(len(ids), -1)
        sizes, band, away = cell["n_shingles"].to_numpy(), cell["band"][0].as_py(), cell["away"].to_numpy()
        packed = np.frombuffer(b"".join(cell["fine"].to_pylist()), np.uint8).reshape(len(ids), -1)
        fine = np.concatenate([packed >> k & 3 for k in (0, 2, 4, 6)], axis=1)
        same = cell["ci"][0].as_py() == cell["cj"][0].as_py()
        left = np.arange(len(ids)) if same else np.flatnonzero(side == cell["ci"][0].as_py())
        right = left if same else np.flatnonzero(side == cell["cj"][0].as_py())
        a, b = [], []
        for i in left:
            rest = right[(right > i)] if same else right
            rest = rest[comp[rest] != comp[i]]
            rest = rest[100 * np.minimum(sizes[rest], sizes[i]) >= percent * np.maximum(sizes[rest], sizes[i])]
            agree = s[rest] == s[i]
            once = agree.reshape(len(rest), BANDS, ROWS).all(axis=2).argmax(axis=1) == band
            rest = rest[once & (agree.sum(axis=1) >= T * sure) & (np.abs(away[rest] - away[i]) <= 1 - share + 1e-9)]
            fine_agree = (fine[rest] == fine[i]).sum(axis=1)
            near = rest[fine_agree >= FINE * fine_sure]
            a.append(np.minimum(ids[near], ids[i]))
            b.append(np.maximum(ids[near], ids[i]))
        return np.concatenate(a or [ids[:0]]), np.concatenate(b or [ids[:0]])

    def out(cells):
        found = [pairs(c) for c in cells]
        a = np.concatenate([x[0] for x in found] or [np.zeros(0, np.int64)])
        b = np.concatenate([x[1] for x in found] or [np.zeros(0, np.int64)])
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    def cut(t: pa.Table):
        cell = t["cell"].to_numpy()
        ends = np.flatnonzero(cell[1:] != cell[:-1]) + 1
        edges = [0, *ends.tolist(), len(cell)]
        return [t.slice(x, y - x) for x, y in zip(edges[:-1], edges[1:], strict=True)]

    for batch in batches:
        if not batch.num_rows:
            continue
        cells = cut(pa.Table.from_batches([*held, batch]))
        held = cells[-1].to_batches()
        yield out(cells[:-1])
    if held:
        yield out([pa.Table.from_batches(held)])


def _bands(sketches: DataFrame) -> DataFrame:
    keys = [F.xxhash64(F.lit(k), F.substring("sketch", k * ROWS + 1, ROWS)) for k in range(BANDS)]
    return sketches.select("id", F.posexplode(F.array(*keys)).alias("band", "bucket"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """Per row: id, n_shingles, component_id (smallest id that links lead to) and kept (whether that is the id itself)."""
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    keyed = docs.select("id", "text", F.xxhash64("text").alias("text_key"))
    sketched = written(keyed.mapInArrow(_sketches(words), "id long, text_key long, n_shingles long, set_key binary, sketch binary"), "sketches")
    several = sketched.filter("id is not null").groupBy("id").agg(F.min("text_key").alias("lo"), F.max("text_key").alias("hi")).filter("lo < hi").select("id")
    several = written(several, "repeated-ids")
    if several.isEmpty():
        out = _grouped(docs, sketched, None, words, percent)
    else:
        out = _by_text(keyed, sketched, several, words, percent)
    return out.select(F.col("id").alias(id_col), "n_shingles", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))


def _by_text(docs: DataFrame, sketched: DataFrame, several: DataFrame, words: int, percent: int) -> DataFrame:
    """The same where ids have several texts: each text of such an id is a node, and the nodes of an id are linked."""
    marked = maybe_broadcast(several.withColumn("many", F.lit(True)))
    seed = 0
    while True:  # until no new node has the number of an id
        node = F.when(F.col("many"), F.xxhash64(F.lit(seed), "id", "text_key")).otherwise(F.col("id")).alias("node")
        nodes = written(sketched.join(marked, "id", "left").select("*", node), "nodes")
        made = nodes.filter("many").select("id", "node", "text_key").distinct()
        double = made.groupBy("node").count().filter("count > 1").select("node")
        if double.isEmpty() and made.join(sketched.select(F.col("id").alias("node")), "node", "left_semi").isEmpty():
            break
        seed += 1
    texts = docs.join(marked, "id", "left").select(node.alias("id"), "text")
    first = made.groupBy("id").agg(F.min("node").alias("a"))
    same = written(made.join(first, "id").select("a", F.col("node").alias("b")).filter("a <> b"), "same-ids")
    out = _grouped(texts, nodes.select(F.col("node").alias("id"), "n_shingles", "set_key", "sketch"), same, words, percent)
    # Nodes back to ids; the smallest id of a component need not be that of its smallest node.
    real = made.select(F.col("node").alias("id"), F.col("id").alias("real"))
    out = written(out.join(maybe_broadcast(real), "id", "left").withColumn("real", F.coalesce("real", "id")), "node-groups")
    least = out.groupBy("component_id").agg(F.min("real").alias("least"))
    return out.join(least, "component_id", "left").select(F.col("real").alias("id"), "n_shingles", F.col("least").alias("component_id"))


def _grouped(docs: DataFrame, sketched: DataFrame, given: DataFrame | None, words: int, percent: int) -> DataFrame:
    """``id, n_shingles, component_id``; ``given`` links (a, b) hold besides those found."""
    full = sketched.filter("id is not null and set_key is not null")
    classes = full.groupBy("set_key").agg(F.min("id").alias("rep"), F.max("id").alias("last_id"))
    classes = written(classes.filter("last_id > rep").select("set_key", "rep"), "classes")
    shared = maybe_broadcast(classes, classes.count())
    members = sketched.join(shared, "set_key", "left").select("id", "n_shingles", F.coalesce("rep", "id").alias("rep"), F.col("set_key").isNotNull().alias("full"), "sketch")
    reps = members.filter("id = rep and full").select("id", "n_shingles", "sketch")

    banded = _bands(reps)
    buckets = banded.groupBy("bucket").agg(F.min("id").alias("first_id"), F.max("id").alias("last_id"), F.count("*").alias("size"))
    # Counted, so that few enough buckets meet their members without a shuffle, in which a large bucket is one task.
    buckets = written(buckets.filter("last_id > first_id"), "crowded")
    crowded = banded.join(maybe_broadcast(buckets, buckets.count()), "bucket").select("bucket", "band", "first_id", "size", "id")
    crowded = written(crowded, "buckets")
    ids = written(crowded.select("id").distinct(), "bucket-ids")
    texts = written(docs.join(maybe_broadcast(ids, ids.count()), "id", "left_semi"), "bucket-texts")

    first = written(crowded.filter("id > first_id").select(F.col("first_id").alias("a"), F.col("id").alias("b")).distinct(), "star-pairs")
    stars = written(_compared(first, texts, words), "star-sizes")
    joined = contracted(linked(_links(stars, percent)))
    rest = _unsettled(crowded, nearest(joined), stars, reps, texts, words, percent)
    rest = written(rest.join(first, ["a", "b"], "left_anti"), "cross-pairs")
    across = _links(_compared(rest, texts, words), percent)
    if given is not None:
        of = members.select("id", "rep").distinct()
        ends = given.join(of.select(F.col("id").alias("a"), F.col("rep").alias("x")), "a").join(of.select(F.col("id").alias("b"), F.col("rep").alias("y")), "b")
        across = across.unionByName(ends.select(F.col("x").alias("a"), F.col("y").alias("b")))
    found = components(joined.select(F.col("u").alias("a"), F.col("v").alias("b")).unionByName(across))
    labelled = members.join(found.withColumnRenamed("id", "rep"), "rep", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "rep"))
    return labelled.select("id", "n_shingles", component.alias("component_id"))


def _unsettled(crowded: DataFrame, found: DataFrame, stars: DataFrame, reps: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Pairs (a, b) across the components of a bucket, neither of them its smallest id, that may be similar."""
    spark: SparkSession = crowded.sparkSession
    members = crowded.filter("size > 2").join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
    mixed = members.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo < hi")
    away = stars.groupBy(F.col("a").alias("first_id"), F.col("b").alias("id")).agg((1 - F.max("both") / F.max("either")).alias("away"))
    members = members.join(mixed.select("bucket"), "bucket").join(away, ["first_id", "id"])
    members = members.withColumn("blocks", F.ceil(F.col("size") / BLOCK))
    side = F.pmod(F.xxhash64("id"), F.col("blocks"))
    members = members.withColumn("side", side).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    members = members.withColumn("ci", F.least("side", "other")).withColumn("cj", F.greatest("side", "other"))
    members = written(members.withColumn("cell", F.xxhash64("bucket", "ci", "cj")), "mixed-buckets")
    wanted = texts.join(members.select("id").distinct(), "id", "left_semi").dropDuplicates(["id"])
    fine = wanted.select("id", "text").mapInArrow(_fine(words), "id long, fine binary")
    members = members.join(reps.join(fine, "id"), "id")
    columns = ["cell", "ci", "cj", "side", "band", "id", "component", "away", "n_shingles", "sketch", "fine"]
    dealt = members.select(*columns).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "cell").sortWithinPartitions("cell", "ci", "cj")
    return dealt.mapInArrow(_across(percent), "a long, b long").distinct()
