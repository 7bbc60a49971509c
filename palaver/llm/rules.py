"""Quality by weak supervision: rules vote or abstain, and their accuracies are learned without labels.

Each rule looks at one statistic of a whole text and votes good (1), bad (-1) or abstains (0). Expectation-maximisation over
the counts of vote patterns, at most 3 to the number of rules whatever the corpus, estimates how each rule votes on good
and on bad documents (a rule that says nothing is evidence as well) and how many are good. The posterior probability of being good decides. Statistics and
posteriors are DataFrame expressions; only the pattern counts come to the driver.

Defined cases: null or empty text has no words and fails the base check; lines are compared as they are, lines without a word never
count; repeated rows and rows with a null id are judged like others. No rows give no rows. Other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palaver.llm.tables import written

SPACE = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
#: name, condition of a bad vote, condition of a good vote (bad goes first); a condition that isn't true abstains.
RULES = (
    ("symbols", "n_symbols > 0.1 * n_words", "false"),
    ("repeats", "n_repeat_words > 0.3 * n_words", "false"),
    ("lines", "n_dup_lines > 0.3 * n_lines", "false"),
    ("capitals", "n_capitals > 0.4 * word_chars", "false"),
    ("shouts", "n_shouts > 0.1 * n_words", "false"),
    ("word_length", "word_chars not between 3 * n_words and 12 * n_words", "false"),
    ("letters", "false", "n_capitals <= 0.15 * word_chars and n_symbols <= 0.02 * n_words and n_shouts <= 0.02 * n_words"),
)
#: What is assumed at first, and as if it had been seen in so many votes, of rules that find faults and of those that
#: find virtues: shares of bad votes, none, good votes.
FAULT = {"good": (0.02, 0.97, 0.01), "bad": (0.25, 0.74, 0.01)}
VIRTUE = {"good": (0.01, 0.29, 0.7), "bad": (0.01, 0.69, 0.3)}
FIRST = [VIRTUE if bad == "false" else FAULT for _, bad, _ in RULES]
SEEN = 2.0
ROUNDS = 60


def _words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))


def _count_of(text: Column, characters: str) -> Column:
    """How many characters of a class are in the text."""
    return F.length(text) - F.length(F.regexp_replace(text, f"[{characters}]+", ""))


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """Per row: id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and what the other rules look at."""
    kept = [F.col(c) for c in carry]
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), *([F.struct(*kept).alias("carried")] if kept else []), text.alias("whole"), _words(text).alias("ws"))
    runs = F.transform(F.sequence(F.lit(0), F.size("ws") - 3), lambda i: F.xxhash64(F.get("ws", i), F.get("ws", i + 1), F.get("ws", i + 2)))
    rows = rows.withColumn("runs", F.when(F.size("ws") >= 3, runs).otherwise(F.array().cast("array<bigint>")))
    # Sorted by hash, equal runs of words are neighbours; texts without any are done before.
    grams = F.sort_array(F.transform("runs", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    some = F.when(F.size(F.array_distinct("runs")) < F.size("runs"), grams).otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))
    lines = F.filter(F.split(F.col("whole"), "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != "")
    rows = rows.withColumns({"grams": some, "lines": lines})
    same = lambda x, i: F.coalesce(x["h"] == F.get("grams", i)["h"], F.lit(False))
    again = F.filter("grams", lambda x, i: same(x, i - 1) | same(x, i + 1))
    places = F.flatten(F.transform(again, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))
    return rows.select(
        "id", *(["carried"] if kept else []),
        F.size("ws").cast("long").alias("n_words"),
        F.length(F.array_join("ws", "")).cast("long").alias("word_chars"),
        _count_of(F.col("whole"), SYMBOLS).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.array_distinct(places)).cast("long").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        _count_of(F.col("whole"), r"\p{Lu}").cast("long").alias("n_capitals"),
        (F.length("whole") - F.length(F.replace(F.col("whole"), F.lit("!"), F.lit("")))).cast("long").alias("n_shouts"),
    )


def votes() -> list[Column]:
    return [F.when(F.expr(bad), -1).when(F.expr(good), 1).otherwise(0) for _, bad, good in RULES]


def estimate(patterns: list[tuple[tuple[int, ...], int]]) -> tuple[float, list[dict[str, tuple[float, ...]]]]:
    """Share of good documents, and per rule the shares of its votes (bad, none, good) on good and on bad documents.

    Expectation-maximisation from ``FIRST``. Rules are taken to be better than chance: bad votes are never likelier
    on good documents nor good votes on bad ones, so good can't change places with bad.
    """
    share, shares = 0.8, FIRST
    total = float(sum(count for _, count in patterns))
    for _ in range(ROUNDS if total else 0):
        start, steps = weights(share, shares)
        seen = {y: [[SEEN * x for x in first[y]] for first in FIRST] for y in ("good", "bad")}
        good = 0.0
        for vote, count in patterns:
            odds = start + sum(step[v + 1] for v, step in zip(vote, steps, strict=True))
            p = 1 / (1 + math.exp(-max(-700.0, min(700.0, odds))))
            good += count * p
            for j, v in enumerate(vote):
                seen["good"][j][v + 1] += count * p
                seen["bad"][j][v + 1] += count * (1 - p)
        share = min(0.99, max(0.01, good / total))
        shares = [{y: tuple(x / sum(seen[y][j]) for x in seen[y][j]) for y in seen} for j in range(len(RULES))]
    return share, shares


def weights(share: float, shares: list[dict[str, tuple[float, ...]]]) -> tuple[float, list[tuple[float, float, float]]]:
    """Log-odds of good before any vote, and what a bad vote, none and a good vote of each rule add."""
    steps = []
    for rule in shares:
        bad, none, good = (math.log(g / b) for g, b in zip(rule["good"], rule["bad"], strict=True))
        steps.append((min(0.0, bad), none, max(0.0, good)))
    return math.log(share / (1 - share)), steps


def judged(stats: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``stats`` (read more than once) with base_failed, quality (posterior) and kept."""
    names = [name for name, *_ in RULES]
    counted = stats.select(*[v.alias(name) for v, name in zip(votes(), names, strict=True)]).groupBy(*names).count().collect()
    start, steps = weights(*estimate(sorted((tuple(r[n] for n in names), r["count"]) for r in counted)))
    odds = F.lit(start)
    for v, (bad, none, good) in zip(votes(), steps, strict=True):
        odds = odds + F.when(v < 0, F.lit(bad)).when(v > 0, F.lit(good)).otherwise(F.lit(none))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    quality = F.lit(1.0) / (F.lit(1.0) + F.exp(-odds))
    return stats.withColumn("base_failed", failed).withColumn("quality", quality).withColumn("kept", ~failed & (F.col("quality") >= threshold))


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """Per row: id, the statistics, base_failed, quality and kept. The statistics are written once."""
    return judged(written(statistics(docs, id_col, text_col), "statistics"), threshold).withColumnRenamed("id", id_col)


def keep_good(docs: DataFrame, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns."""
    whole = docs.select(F.struct(*docs.columns).alias("carried"), F.lit(None).alias("id"), F.col(text_col).alias("text"))
    stats = statistics(whole, "id", "text", ("carried",))
    return judged(written(stats, "statistics"), threshold).filter("kept").select("carried.carried.*")
