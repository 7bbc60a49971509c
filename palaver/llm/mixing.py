"""Mixing sources to target weights by temperature.

The token shares p of the sources are raised to an exponent a and normalised. The exponent falls from 1 (as the corpus is) towards 0
(all sources alike) until the mixture has the wanted entropy, and never so far that a source is repeated more often than the limit;
it is found by bisection, where one Spark job evaluates the six next levels of halving at once on the table of sources.

The weights become budgets of tokens. Documents of a source are dealt by a keyed hash into blocks of about ``block_docs``
documents; a block has its share of the source's budget. It is realised as whole passes, each in a
keyed order of its own, and a last pass that takes documents in that order while they fit at least half. Only blocks are sorted, so a hot
source is many tasks, and every block follows the weights.

Defined cases: a null source is a source of its own; text without words has no tokens and is passed over; no
rows, or no tokens at all, give no rows; one source gets everything; repeated rows are documents of their own (equal ones
are interchangeable). The columns of ``docs`` stay, unless one is named like an added one (pass, slot, n_tokens), which is replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from palaver.llm.tables import maybe_broadcast, written

LEVELS, JOBS = 6, 5


def token_count(text):
    """Words of a text: runs of characters other than spaces."""
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _shares(sources: DataFrame, exponents: list[float]) -> list:
    """Entropy of the mixture and the largest ratio of a weight to its source's share, for each exponent."""
    p = F.col("tokens") / F.col("total")
    columns = []
    for k, a in enumerate(exponents):
        power = F.pow(p, F.lit(a))
        columns += [F.sum(power).alias(f"z{k}"), F.sum(power * F.log(power)).alias(f"s{k}"), F.max(F.pow(p, F.lit(a - 1.0))).alias(f"m{k}")]
    row = sources.agg(*columns).select(
        *[F.expr(f"ln(z{k}) - s{k} / z{k}").alias(f"h{k}") for k in range(len(exponents))],
        *[F.expr(f"m{k} / z{k}").alias(f"r{k}") for k in range(len(exponents))],
    ).first()
    n = len(exponents)
    return [(row[k], row[n + k]) for k in range(n)]


def exponent(sources: DataFrame, entropy: float, repeats: float) -> float:
    """The largest exponent in 0..1 whose mixture has ``entropy`` (times that of equal weights), raised if it would
    repeat a source more than ``repeats`` times. Both measures move one way with the exponent, so it is bisected."""
    most = sources.agg(F.log(F.count("*"))).first()[0] or 0.0

    def bisect(wanted) -> float:
        """The least exponent, up to 2**-30, where ``wanted`` no longer holds."""
        low, high = 0.0, 1.0
        for _ in range(JOBS):
            grid = [low + (high - low) * k / 2**LEVELS for k in range(2**LEVELS + 1)]
            measures = _shares(sources, grid[1:-1])
            left, right = 0, 2**LEVELS
            while right - left > 1:  # the halvings that this job has answered
                middle = (left + right) // 2
                left, right = (middle, right) if wanted(*measures[middle - 1]) else (left, middle)
            low, high = grid[left], grid[right]
        return (low + high) / 2

    as_is = _shares(sources, [0.0, 1.0])
    flat = 1.0 if as_is[1][0] >= entropy * most else 0.0 if as_is[0][0] <= entropy * most + 1e-12 else bisect(lambda h, r: h >= entropy * most)
    held = 0.0 if as_is[0][1] <= repeats else bisect(lambda h, r: r > repeats)
    return max(flat, held)


def mix_sources(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    entropy: float = 0.98, repeats: float = 2.0, budget: float = 1.0, block_docs: int = 1000, key: str = "mix", keep: tuple[str, ...] | None = None,
) -> DataFrame:
    """Rows of ``docs`` as often as the mixture takes them, with pass (0, 1, ...), slot (the place in the keyed order of the
    pass, equal on ties) and n_tokens; of the columns of ``docs`` those in ``keep``, or all. ``budget`` is the tokens of the mixture as a multiple of those of the corpus."""
    own = [c for c in docs.columns if c not in ("pass", "slot", "n_tokens") and (keep is None or c in keep)]
    name = F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit("-")).alias("_name")
    text_hash = F.xxhash64(F.lit(key), F.col(id_col).cast("string"), F.col(text_col).cast("string")).alias("_hash")
    # The caller's columns travel as one, so their names meet none of ours.
    carried = F.struct(F.lit(0).alias("-"), *own).alias("_row")
    rows = written(docs.select(carried, token_count(F.col(text_col)).alias("n_tokens"), name, text_hash), "counted").filter("n_tokens > 0")
    back = [F.col("_row").getField(c).alias(c) for c in own]
    sources = rows.groupBy("_name").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("docs"))
    sources = written(sources, "sources")
    total = sources.agg(F.sum("tokens")).first()[0] or 0
    if not total:
        return rows.select(*back, "n_tokens", F.lit(0).cast("long").alias("pass"), F.lit(0).cast("long").alias("slot")).limit(0)
    sources = written(sources.withColumn("total", F.lit(total).cast("double")), "source-shares")
    a = exponent(sources, entropy, repeats)
    power = F.pow(F.col("tokens") / F.col("total"), F.lit(a))
    z = sources.agg(F.sum(power)).first()[0]
    plan = sources.select("_name", (power / F.lit(z) * F.lit(budget * total) / F.col("tokens")).alias("_rate"), F.ceil(F.col("docs") / block_docs).alias("_blocks"))
    dealt = rows.join(maybe_broadcast(plan), "_name")
    dealt = dealt.withColumn("_block", F.pmod(F.xxhash64(F.lit("block"), "_hash"), F.col("_blocks")))
    block = Window.partitionBy("_name", "_block")
    whole = F.floor("_rate").cast("long")
    dealt = dealt.withColumn("_last", F.xxhash64(whole, "_hash"))
    before = F.coalesce(F.sum("n_tokens").over(block.orderBy("_last").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # The whole block, with the same order, so that one sort serves both.
    everything = F.sum("n_tokens").over(block.orderBy("_last").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    dealt = dealt.withColumns({"_before": before, "_all": everything})
    fits = F.col("_before") + F.col("n_tokens") / 2 <= (F.col("_rate") - whole) * F.col("_all")
    times = whole + F.when(fits, 1).otherwise(0)
    taken = dealt.filter(times > 0).withColumn("pass", F.explode(F.sequence(F.lit(0).cast("long"), times - 1)))
    return taken.select(*back, "n_tokens", "pass", F.xxhash64("pass", "_hash").alias("slot"))
