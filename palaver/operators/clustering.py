"""An order of rows that keeps values of two columns together."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 5


def interleaved(rows: DataFrame, first: str, second: str, bits: int = BITS) -> Column:
    """The place of a row on a Z curve over two columns: their ranks among ``2^bits`` quantiles, bit by bit in turn.

    Quantiles come from one pass over the two columns; a sketch of bounded size reaches the driver. In rows sorted by
    it, a run of one part in n spans about one part in sqrt(n) of the values of each column.
    """
    steps = [k / 2**bits for k in range(1, 2**bits)]
    cuts = rows.stat.approxQuantile([first, second], steps, 0.25 / 2**bits)

    def rank(name: str, edges: list[float]) -> Column:
        each = [F.when(F.col(name) >= F.lit(edge), 1).otherwise(0) for edge in sorted(set(edges))]
        return reduce(lambda a, b: a + b, each, F.lit(0))

    a, b = (rank(name, edges) for name, edges in zip((first, second), cuts, strict=True))
    turns = [F.shiftleft(F.shiftright(x, k).bitwiseAND(F.lit(1)), 2 * k + place) for k in range(bits) for place, x in ((1, a), (0, b))]
    return reduce(lambda x, y: x.bitwiseOR(y), turns)
