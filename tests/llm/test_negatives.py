"""Hard negatives against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from palaver.llm import negatives
from palaver.llm.negatives import Sought, Tile, _packed, best_first, hard_negatives, intervals, str_leaves, whole

SCHEMA = "vec_id long, label long, vector array<double>, rank string, tile string, dim string, windows string"


def brute(rows, every, k=5):
    """Rows (vec_id, label, vector) -> expected results; repeated ids count as one."""
    one = {}
    for vec_id, label, vector in rows:
        if vec_id is not None and label is not None and vector is not None:
            one[vec_id] = min(one.get(vec_id, (label, vector)), (label, vector))

    def score(a, b):
        return sum(int(x) * int(y) for x, y in zip(a, b, strict=False))

    out = set()
    for a, (label, vector) in one.items():
        if a % every:
            continue
        scored = sorted((-score(vector, v), b, other) for b, (other, v) in one.items() if b != a)
        for p, positive, _ in [x for x in scored if x[2] == label][:k]:
            inside = [(n, b) for n, b, other in scored if other != label and 80 * -p <= 100 * -n <= 100 * -p][:k]
            out |= {(a, positive, rank, b, -p, -n) for rank, (n, b) in enumerate(inside, 1)}
    return out


def mined(spark, rows, every):
    frame = spark.createDataFrame([(*row, "a", "b", "c", "d") for row in rows], SCHEMA)
    found = [tuple(r) for r in hard_negatives(frame, F.col("vec_id") % every == 0).collect()]
    assert len(found) == len(set(found))
    return set(found)


@pytest.mark.parametrize("scale", [2, 300, 1 << 29])
def test_against_brute_force(spark, monkeypatch, scale):
    """Ties, copies, nulls, repeated ids, several tiles, leaves and waves; products beyond what doubles hold exactly."""
    monkeypatch.setattr(negatives, "TILE_ROWS", 40)
    monkeypatch.setattr(negatives, "WAVE_VALUES", 64)
    r = random.Random(scale)
    rows = [(i, r.randrange(3), [float(r.randint(-scale, scale)) for _ in range(4)]) for i in range(300)]
    rows += [(i, r.randrange(3), rows[0][2]) for i in range(300, 420)]
    rows += [rows[5], (5, 0, [1.0, 0.0, 0.0, 0.0]), (None, 1, [1.0] * 4), (1000, None, [1.0] * 4), (1001, 1, None), (-10, 2, [1.0, 1.0, 0.0, 0.0])]
    rows_and_huge = [*rows, (1100, 1, [1e25] * 4)]
    assert mined(spark, rows_and_huge, 10) == brute(rows, 10)


def test_lengths(spark):
    rows = [(0, 1, [1.0, 2.0]), (1, 1, [3.0]), (2, 0, [3.0, 0.0, 9.0]), (3, 0, []), (4, 1, [])]
    assert mined(spark, rows, 1) == brute(rows, 1)


def test_empty(spark):
    frame = spark.createDataFrame([], SCHEMA)
    found = hard_negatives(frame, F.lit(True))
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"] and found.isEmpty()
    one = spark.createDataFrame([(0, 1, [1.0], *"abcd")], SCHEMA)
    assert hard_negatives(one, F.lit(True)).isEmpty()


def test_whole(spark):
    values = [[0.1, -0.1, -1e-20, 1e30, 0.0], [1.0, None], [float("nan")], [float("inf")], [], None]
    frame = spark.createDataFrame([(v,) for v in values], "v array<double>").select(whole(F.col("v")))
    assert [x[0] for x in frame.collect()] == [[25.0, -26.0, -1.0, 256e30, 0.0], None, None, None, [], None]


def test_boxes():
    rng = np.random.default_rng(1)
    values = np.floor(rng.normal(size=(1000, 5)) * 50)
    leaves = str_leaves(values, 64)
    assert sorted(np.concatenate(leaves).tolist()) == list(range(1000)) and max(map(len, leaves)) <= 64
    anchor = values[3]
    for leaf in leaves:
        lower, upper = intervals(anchor, values[leaf].min(0)[None], values[leaf].max(0)[None])
        assert lower[0] <= (values[leaf] @ anchor).min() and (values[leaf] @ anchor).max() <= upper[0]


def test_boxes_are_passed_over():
    """Clustered vectors: leaves that can't hold a result are not read."""
    import pyarrow as pa

    rng = np.random.default_rng(2)
    values = np.concatenate([np.floor(rng.normal(size=(1024, 2)) + 100 * np.array(c)) for c in ((1, 1), (-1, 1), (-1, -1), (1, -1))])
    group = pa.table({"vec_id": np.arange(len(values)), "label": np.zeros(len(values), np.int64), "vector": list(values), "dim": np.full(len(values), 2, np.int32)})
    tile = Tile.read(_packed(group).to_pylist()[0])
    read = []
    sought = Sought(-1, 0, values[0], True, [(-(2**62), 2**62)], 5)
    scan = sought.scan
    sought.scan = lambda scores, labels, ids: (read.append(len(ids)), scan(scores, labels, ids))
    best_first(sought, [tile])
    assert sum(read) <= 1024
    assert [-s for s, _ in sought.best[0]] == sorted((values @ values[0]).tolist(), reverse=True)[:5]
