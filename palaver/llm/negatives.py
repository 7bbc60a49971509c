"""Hard-negative mining over an R-tree packed by Sort-Tile-Recursive.

Vectors are dealt to tiles by cuts along the coordinates of greatest spread, taken from a bounded sample (``SAMPLE_VALUES``); every
vector is in the tree, and a tile that holds too many is split by id. A task packs a tile into leaves by the same
recursion. A record of the index is one tile: its leaves, their minimum bounding boxes and the vectors.

A search goes over all tiles, with the anchors in waves of bounded size. The product of an anchor with a box lies in the sum of an
interval for each coordinate. A queue takes the box with the largest upper end first; boxes outside the score windows or
strictly below the k-th best found are passed over. Products are whole numbers and exact, so the result does
not depend on the tiles.

Defined cases: rows with a null id, label or vector, or a component that is null or not finite, take no part; rows that share an
id count as one, that with the smallest label, then the smallest vector; a shorter vector counts as filled
up with zeros; equal scores are settled by the smaller id; a vector whose squares add up to ``LARGEST_SQUARE`` or more takes no part, as
its scores may not fit a long. No anchors give no rows. Columns other than those named are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palaver.llm.tables import maybe_broadcast, shuffle_partitions, written

#: Rows of a tile and of a leaf, and tiles that a task of a search holds at most.
TILE_ROWS, LEAF_ROWS, TASK_TILES = 4096, 256, 64
#: Numbers in the sample that places the cuts, sampled rows for each tile, and numbers in a wave of anchors.
SAMPLE_VALUES, SAMPLE_ROWS_PER_TILE, WAVE_VALUES = 1 << 20, 32, 1 << 20
INDEX = "dim int, ids binary, labels binary, vectors binary, kind string, ends binary, lo binary, hi binary"
LARGEST_SQUARE = 2**62


def str_cuts(values: np.ndarray, tiles: int, axes: list[int]) -> dict | None:
    """Nested cuts of a sample into about ``tiles`` tiles: slabs along the first axis, each cut along the next one."""
    if tiles <= 1 or not axes or len(values) < 2:
        return None
    slabs = math.ceil(tiles ** (1 / len(axes)) - 1e-9)
    ordered = values[np.argsort(values[:, axes[0]], kind="stable")]
    at = [len(ordered) * k // slabs for k in range(slabs + 1)]
    edges = np.unique(ordered[at[1:-1], axes[0]])
    parts = np.searchsorted(edges, values[:, axes[0]], side="right")
    each = math.ceil(tiles / slabs)
    return {"axis": axes[0], "edges": edges, "parts": [str_cuts(values[parts == k], each, axes[1:]) for k in range(len(edges) + 1)]}


def tile_of(values: np.ndarray, cuts: dict | None) -> np.ndarray:
    """The tile of each row: the path through the cuts as one number."""
    path = np.zeros(len(values), np.int64)
    if cuts is None:
        return path
    column = values[:, cuts["axis"]] if cuts["axis"] < values.shape[1] else np.zeros(len(values))
    part = np.searchsorted(cuts["edges"], column, side="right")
    for k, below in enumerate(cuts["parts"]):
        rows = np.flatnonzero(part == k)
        path[rows] = tile_of(values[rows], below) * len(cuts["parts"]) + k
    return path


def _widest(values: np.ndarray) -> list[int]:
    return np.argsort(-np.ptp(values, axis=0), kind="stable").tolist() if len(values) else []


def str_leaves(values: np.ndarray, rows: int = LEAF_ROWS) -> list[np.ndarray]:
    """Positions of the rows of each leaf."""

    def packed(at: np.ndarray, axes: list[int]) -> list[np.ndarray]:
        leaves = math.ceil(len(at) / rows)
        if leaves <= 1:
            return [at] if len(at) else []
        if not axes:
            return [at[k : k + rows] for k in range(0, len(at), rows)]
        slabs = math.ceil(leaves ** (1 / len(axes)) - 1e-9)
        at = at[np.argsort(values[at, axes[0]], kind="stable")]
        step = rows * math.ceil(leaves / slabs)
        return [leaf for k in range(0, len(at), step) for leaf in packed(at[k : k + step], axes[1:])]

    return packed(np.arange(len(values)), _widest(values))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), dim)


def _dealt(batches: Iterator[pa.RecordBatch], cuts: dict | None) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        dims = batch.column(3).to_numpy()
        for dim in np.unique(dims).tolist():
            rows = batch.take(pa.array(np.flatnonzero(dims == dim)))
            tiles = tile_of(_matrix(rows.column(2), dim), cuts)
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(tiles)], [*batch.schema.names, "tile"])


def _packed(group: pa.Table) -> pa.Table:
    group = group.combine_chunks()
    dim = group["dim"][0].as_py()
    values = _matrix(group["vector"].combine_chunks(), dim)
    leaves = str_leaves(values)
    order = np.concatenate(leaves)
    lo, hi = (np.array([f(values[leaf], axis=0) for leaf in leaves]).reshape(len(leaves), dim) for f in (np.min, np.max))
    kind = "<i2" if not values.size or np.abs(values).max() < 1 << 15 else "<f8"
    row = {
        "dim": dim, "ids": group["vec_id"].to_numpy()[order].astype("<i8").tobytes(), "labels": group["label"].to_numpy()[order].astype("<i8").tobytes(),
        "vectors": values[order].astype(kind).tobytes(), "kind": kind, "ends": np.cumsum([len(leaf) for leaf in leaves]).astype("<i4").tobytes(),
        "lo": lo.astype("<f8").tobytes(), "hi": hi.astype("<f8").tobytes(),
    }
    types = {"dim": pa.int32(), "kind": pa.string()}
    return pa.table({name: pa.array([value], types.get(name, pa.binary())) for name, value in row.items()})


def build_index(vectors: DataFrame, rows: int) -> DataFrame:
    """Tiles of ``vec_id, label, vector`` as records, written; a tile has about ``TILE_ROWS`` rows at most."""
    sized = vectors.withColumn("dim", F.size("vector")).select("vec_id", "label", "vector", "dim")
    dim = sized.agg(F.max("dim")).first()[0] or 0
    wanted = max(SAMPLE_ROWS_PER_TILE, SAMPLE_VALUES // max(1, dim))
    share = min(1.0, wanted / max(1, rows))
    picked = sized.filter(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20)) < math.ceil(share * (1 << 20))).limit(wanted).select("vector").collect()
    sample = np.zeros((len(picked), dim))
    for at, (vector,) in enumerate(picked):
        sample[at, : len(vector)] = vector
    tiles = max(1, min(math.ceil(rows / TILE_ROWS), len(sample) // SAMPLE_ROWS_PER_TILE))
    cuts = str_cuts(sample, tiles, _widest(sample))
    dealt = written(sized.mapInArrow(lambda batches: _dealt(batches, cuts), f"{_ddl(sized)}, tile long"), "negatives-dealt")
    sizes = dealt.groupBy("dim", "tile").agg(F.ceil(F.count(F.lit(1)) / TILE_ROWS).alias("shares"))
    shared = dealt.join(maybe_broadcast(sizes), ["dim", "tile"]).withColumn("share", F.pmod(F.xxhash64("vec_id"), "shares"))
    return written(shared.groupBy("dim", "tile", "share").applyInArrow(_packed, INDEX), "negatives-index")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in df.dtypes)


def _exact(x: np.ndarray, y: np.ndarray) -> type:
    """A type in which products of rows are exact."""
    largest = float(np.abs(x).max(initial=0)) * float(np.abs(y).max(initial=0)) * max(1, x.shape[-1])
    return np.float64 if largest < 2**53 else np.int64 if largest < 2**62 else object


def _typed(values: np.ndarray, kind: type) -> np.ndarray:
    return np.vectorize(int, otypes=[object])(values) if kind is object and values.size else values.astype(kind)


@dataclass
class Tile:
    ids: np.ndarray
    labels: np.ndarray
    values: np.ndarray
    ends: list[int]
    lo: np.ndarray
    hi: np.ndarray

    @classmethod
    def read(cls, row: dict) -> Tile:
        dim, ids = row["dim"], np.frombuffer(row["ids"], "<i8")
        lo, hi = (np.frombuffer(row[name], "<f8").reshape(-1, dim) if dim else np.zeros((len(row["ends"]) // 4, 0)) for name in ("lo", "hi"))
        values = np.frombuffer(row["vectors"], row["kind"]).reshape(len(ids), dim).astype(np.float64)
        return cls(ids, np.frombuffer(row["labels"], "<i8"), values, np.frombuffer(row["ends"], "<i4").tolist(), lo, hi)

    def leaf(self, k: int) -> slice:
        return slice(self.ends[k - 1] if k else 0, self.ends[k])


def intervals(anchor: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ends of the products of an anchor with any vector of each box, summed over the coordinates."""
    up, down = np.maximum(anchor, 0), np.minimum(anchor, 0)
    return lo @ up + hi @ down, hi @ up + lo @ down


@dataclass
class Sought:
    """What an anchor looks for: the best ``k`` rows of the same or of other labels in each score window."""

    anchor_id: int
    label: int
    vector: np.ndarray
    same: bool
    windows: list[tuple[int, int]]
    k: int
    best: list[list[tuple[int, int]]] = field(default_factory=list)

    def __post_init__(self):
        self.best = [[] for _ in self.windows]
        self.top = max((high for _, high in self.windows), default=0)

    def least(self, w: int) -> int:
        """Scores strictly below this are of no use in a window."""
        low, found = self.windows[w][0], self.best[w]
        return max(low, -found[-1][0]) if len(found) == self.k else low

    def wanted(self, lower, upper):
        """Whether rows between these scores may matter; numbers or arrays."""
        use = False
        for w, (_, high) in enumerate(self.windows):
            use = use | ((lower <= high) & (upper >= self.least(w)))
        return use

    def scan(self, scores: np.ndarray, labels: np.ndarray, ids: np.ndarray) -> None:
        fits = (labels == self.label) & (ids != self.anchor_id) if self.same else labels != self.label
        for w, (_, high) in enumerate(self.windows):
            at = np.flatnonzero(fits & (scores >= self.least(w)) & (scores <= high))
            if len(at):
                found = zip((-scores[at]).tolist(), ids[at].tolist(), strict=True)
                self.best[w] = heapq.nsmallest(self.k, [*self.best[w], *found])


def best_first(sought: Sought, tiles: list[Tile]) -> None:
    """Take rows of the tiles into the best of ``sought``, box by box from the largest possible score down."""

    def boxes(lo: np.ndarray, hi: np.ndarray, names: list[tuple[int, int]]) -> None:
        anchor = sought.vector[: lo.shape[1]]
        shared = slice(0, len(anchor))
        kind = _exact(np.concatenate((lo[:, shared], hi[:, shared])), anchor)
        lower, upper = intervals(_typed(anchor, kind), _typed(lo[:, shared], kind), _typed(hi[:, shared], kind))
        for at in np.flatnonzero(sought.wanted(lower, upper)).tolist():
            heapq.heappush(queue, (-min(upper[at], sought.top), *names[at], lower[at], upper[at]))

    queue: list[tuple] = []
    for t, tile in enumerate(tiles):
        boxes(tile.lo.min(axis=0)[None], tile.hi.max(axis=0)[None], [(t, -1)])
    while queue:
        _, t, k, lower, upper = heapq.heappop(queue)
        if not sought.wanted(lower, upper):
            continue
        tile = tiles[t]
        if k < 0:
            boxes(tile.lo, tile.hi, [(t, leaf) for leaf in range(len(tile.ends))])
            continue
        rows = tile.leaf(k)
        anchor = sought.vector[: tile.values.shape[1]]
        values = tile.values[rows, : len(anchor)]
        kind = _exact(values, anchor)
        sought.scan(_typed(values, kind) @ _typed(anchor, kind), tile.labels[rows], tile.ids[rows])


def _search(batches: Iterator[pa.RecordBatch], wave, k: int, same: bool) -> Iterator[pa.RecordBatch]:
    """Each anchor's best rows of the tiles of this task, by window."""
    sought = [Sought(anchor_id, label, np.array(vector, np.float64), same, windows, k) for anchor_id, label, vector, windows in wave.value]
    for batch in batches:
        for at in range(0, batch.num_rows, TASK_TILES):
            tiles = [Tile.read(row) for row in batch.slice(at, TASK_TILES).to_pylist()]
            for one in sought:
                best_first(one, tiles)
    rows = [(s.anchor_id, w, int(-score), vec_id) for s in sought for w, best in enumerate(s.best) for score, vec_id in best]
    columns = zip(*rows, strict=True) if rows else ([], [], [], [])
    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], ["anchor_id", "window", "score", "vec_id"])


def _searched(index: DataFrame, anchors: DataFrame, n_anchors: int, dim: int, k: int, same: bool) -> DataFrame:
    """``anchor_id, window, score, vec_id``: the best ``k`` rows in each window of the anchors (``windows``: low, high)."""
    spark = index.sparkSession
    waves = max(1, math.ceil(n_anchors * max(1, dim) / WAVE_VALUES))
    tasks = max(shuffle_partitions(spark), math.ceil(index.count() / TASK_TILES))
    found = None
    for wave in range(waves):
        picked = anchors.filter(F.pmod(F.xxhash64("anchor_id"), F.lit(waves)) == wave).select("anchor_id", "label", "vector", "windows").collect()
        seen = spark.sparkContext.broadcast([(a, label, list(vector), [(low, high) for low, high in windows]) for a, label, vector, windows in picked])
        rows = index.repartition(tasks).mapInArrow(lambda batches, seen=seen: _search(batches, seen, k, same), "anchor_id long, window long, score long, vec_id long")
        best = Window.partitionBy("anchor_id", "window").orderBy(F.col("score").desc(), "vec_id")
        part = written(rows.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k), "negatives-found")
        found = part if found is None else found.unionByName(part)
        seen.unpersist()
    return found


def whole(column: Column, factor: int = 256) -> Column:
    """Components times ``factor``, rounded down, as doubles; null if any of them is null or not finite."""
    scaled = F.transform(column, lambda x: x.cast("double") * factor)
    odd = F.exists(scaled, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    # floor() gives a long, which large components don't fit; x - x % 1 is the whole part, exactly.
    return F.when(~odd, F.transform(scaled, lambda x: x - x % 1 - F.when(x < x - x % 1, 1).otherwise(0)))


def hard_negatives(vectors: DataFrame, anchor: Column, positives: int = 5, negatives: int = 5, window: tuple[int, int] = (80, 100)) -> DataFrame:
    """Rows of other labels that score almost as high as a positive.

    ``vectors`` has ``vec_id``, ``label`` and ``vector`` of whole numbers; ``anchor`` marks the anchors. An anchor's positives are its
    best other rows of the same label. For each, ``window`` bounds the scores of its negatives, in hundredths of the positive's.
    Returns ``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.
    """
    usable = vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), F.col("vector").cast("array<double>"))
    usable = usable.filter("vec_id is not null and label is not null and vector is not null")
    usable = usable.filter(F.aggregate("vector", F.lit(0.0), lambda sum, x: sum + x * x) < float(LARGEST_SQUARE))
    one = usable.groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("row")).select("vec_id", "row.label", "row.vector")
    rows = written(one, "negatives-vectors")
    index = build_index(rows, rows.count())
    anchors = rows.filter(anchor).select(F.col("vec_id").alias("anchor_id"), "label", "vector")
    n, dim = anchors.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    anywhere = F.array(F.struct(F.lit(-LARGEST_SQUARE).alias("low"), F.lit(LARGEST_SQUARE).alias("high")))
    found = _searched(index, anchors.withColumn("windows", anywhere), n, dim or 0, positives, same=True)
    found = found.select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))

    least, most = window
    score = F.col("positive_score").cast("decimal(38,0)")
    inside = F.struct(F.ceil(score * least / 100).cast("long").alias("low"), F.floor(score * most / 100).cast("long").alias("high"))
    wanted = found.select("anchor_id", "positive_score", inside.alias("inside")).distinct()
    # An anchor has no more windows than positives.
    wanted = wanted.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("positive_score", "inside"))).alias("each"))
    wanted = written(wanted, "negatives-windows")
    seeking = anchors.join(wanted, "anchor_id").withColumn("windows", F.col("each.inside"))
    near = _searched(index, seeking, n, dim or 0, negatives, same=False)
    places = wanted.select("anchor_id", F.posexplode("each.positive_score").alias("window", "positive_score"))
    near = near.join(places, ["anchor_id", "window"]).select("anchor_id", "positive_score", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return found.join(near, ["anchor_id", "positive_score"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
