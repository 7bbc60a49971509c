"""Grouping of spelling variants: words one edit apart, found by products of letter-count blocks.

Tasks count the words of whole texts and Spark sums them up. Words of equal length whose letters fall equally into a few
groups of letters make a block; a block meets only those whose counts differ as one edit can make them differ, which lie
in its own or an adjacent length. Blocks are cut into chunks of bounded size, and the chunks of a large block are
dealt to tasks one by one. A NumPy product of two chunks of letter counts gives all squared distances; pairs at most two
apart are verified letter by letter. The letter groups are balanced by the counts of letters in the vocabulary,
and their number follows its size, so that blocks stay small as it grows.

Defined cases: null or empty text and text without a letter have no words; a null doc_id counts as any other but its
words lose no letter; repeated rows count each time; a word of any length is taken whole. No rows give no rows. Columns other than
``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palaver.llm.tables import maybe_broadcast, written

#: Letters a-z and U+00C0 to U+00FF stay, A-Z become lower case, all else parts words.
LOWER_OR_SPACE = bytes(c if 97 <= c <= 122 or c >= 0xC0 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))
LEAST_LETTERS, LEAST_COUNT = 5, 3
#: One in so many (document, run) pairs is noised, where noise is asked for.
NOISE = 97
#: Characters of text that a task counts at once, and words and letters of a chunk.
HELD_CHARS, CHUNK_WORDS, CHUNK_LETTERS = 16 << 20, 2048, 1 << 20


def _noise(doc_ids: list[int | None], words_of: np.ndarray, found: np.ndarray, runs: list[str], noise: int) -> tuple[np.ndarray, list[str]]:
    """Which runs lose a letter, and what is left of them.

    ``found`` numbers the runs of all documents in order, ``words_of`` says how many each document has. The checksum of joined
    bytes is that of the first part, moved by the length of the second, xor that of the second.
    """
    raw = [run.encode("utf-8") for run in runs]
    sums = np.array([zlib.crc32(x) for x in raw], np.uint32)
    sizes, size_of = np.unique(np.array([len(x) for x in raw], np.int64), return_inverse=True)
    zeros = [bytes(size) for size in sizes.tolist()]
    blank = [zlib.crc32(z) for z in zeros]
    first = [zlib.crc32(f"{doc_id}:".encode()) for doc_id in doc_ids]
    moved = np.array([[zlib.crc32(z, start) ^ own for z, own in zip(zeros, blank, strict=True)] for start in first], np.uint32)
    doc = np.repeat(np.arange(len(doc_ids)), words_of)
    checksums = sums[found] ^ moved[doc, size_of[found]]
    known = np.array([doc_id is not None for doc_id in doc_ids])
    struck = (checksums % noise == 0) & known[doc]
    short = []
    for at, checksum in zip(found[struck].tolist(), checksums[struck].tolist(), strict=True):
        cut = checksum % len(runs[at])
        short.append(runs[at][:cut] + runs[at][cut + 1 :])
    return struck, short


def count_words(doc_ids: list[int | None], texts: list[str], noise: int | None) -> tuple[list[str], np.ndarray]:
    """Distinct words of some texts and how often they occur."""
    # All letters are Latin-1 characters; what is none becomes a question mark and, as any other byte, a space.
    split = [text.encode("latin-1", "replace").translate(LOWER_OR_SPACE).split() for text in texts]
    words_of = np.array([len(words) for words in split], np.int64)
    joined = b"".join(b" ".join(words) + b" " for words in split if words)
    ends = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32) + 1
    offsets = np.concatenate(([0], ends)).astype(np.int64)
    column = pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(joined)]).dictionary_encode()
    runs = [run[:-1].decode("latin-1") for run in column.dictionary.to_pylist()]
    found = column.indices.to_numpy().astype(np.int64)
    short: list[str] = []
    if noise is not None and len(runs):
        struck, short = _noise(doc_ids, words_of, found, runs, noise)
        found = found[~struck]
    counts = np.bincount(found, minlength=len(runs))
    return runs + short, np.concatenate((counts, np.ones(len(short), np.int64)))


def _counted(batches: Iterator[pa.RecordBatch], noise: int | None, least: int) -> Iterator[pa.RecordBatch]:
    def rows() -> pa.RecordBatch:
        words, counts = count_words(ids, texts, noise)
        kept = [at for at, n in enumerate(counts.tolist()) if n and len(words[at]) >= least]
        return pa.RecordBatch.from_arrays([pa.array([words[at] for at in kept], pa.string()), pa.array(counts[kept])], ["word", "n"])

    ids, texts, held = [], [], 0
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            if text.is_valid:
                ids.append(doc_id)
                texts.append(text.as_py())
                held += len(texts[-1])
            if held >= HELD_CHARS:
                yield rows()
                ids, texts, held = [], [], 0
    yield rows()


def vocabulary(docs: DataFrame, noise: int | None = None) -> DataFrame:
    """``word, n``: distinct words of at least five letters that occur three times or more.

    With ``noise``, a run of a document loses a letter where that number divides the crc32 of ``<doc_id>:<run>``.
    """
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    counted = texts.mapInArrow(lambda batches: _counted(batches, noise, LEAST_LETTERS), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_COUNT)


def _letter_groups(ranked: DataFrame, words: int) -> list[str]:
    """Letters in groups of about equal counts, the more groups the more words there are."""
    letters = ranked.select(F.explode(F.split("word", "")).alias("letter")).groupBy("letter").count()
    groups = [[0, ""] for _ in range(max(3, len(str(words)) - 2))]
    # There are at most 90 letters.
    for letter, n in sorted(letters.collect(), key=lambda row: (-row[1], row[0])):
        least = min(groups)
        least[0] += n
        least[1] += letter
    return sorted(letters for _, letters in groups if letters)


def _blocks(ranked: DataFrame, words: int) -> DataFrame:
    """Chunks ``counts, chunk, chunks, ranks, words`` of blocks; the counts of letter groups add up to the length."""
    groups = _letter_groups(ranked, words)
    everything = "".join(groups)
    counts: list[Column] = [F.length(F.translate("word", "".join(c for c in everything if c not in group), "")) for group in groups]
    dealt = ranked.select("rank", "word", F.array(*counts).alias("counts"))
    each = F.greatest(F.lit(1), F.least(F.lit(CHUNK_WORDS), F.expr(f"{CHUNK_LETTERS} div greatest(1, aggregate(counts, 0, (a, x) -> a + x))").cast("int")))
    sizes = dealt.groupBy("counts").agg(F.count(F.lit(1)).alias("n")).select("counts", F.ceil(F.col("n") / each).cast("int").alias("chunks"))
    dealt = dealt.join(maybe_broadcast(sizes), "counts")
    dealt = dealt.withColumn("chunk", F.pmod(F.xxhash64("rank"), F.col("chunks")).cast("int"))
    return dealt.groupBy("counts", "chunk", "chunks").agg(F.collect_list(F.struct("rank", "word")).alias("members"))


def _met(counts: str, groups: int) -> Column:
    """The blocks that one edit leads to, each unordered pair of blocks from one side: itself, one letter more in a group, or
    one less in a group and one more in a later one."""
    moved = [{}] + [{j: 1} for j in range(groups)] + [{i: -1, j: 1} for i, j in combinations(range(groups), 2)]
    cells = [F.array(*[F.element_at(counts, k + 1) + F.lit(by.get(k, 0)) for k in range(groups)]) for by in moved]
    return F.filter(F.array(*cells), lambda cell: F.forall(cell, lambda n: n >= 0))


def _letters(words: list[str]) -> np.ndarray:
    """The code points, all below 256, of words of one length."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)


def _letter_counts(codes: np.ndarray, used: np.ndarray) -> np.ndarray:
    n, size = codes.shape
    place = np.zeros(256, np.int64)
    place[used] = np.arange(len(used))
    flat = (np.arange(n)[:, None] * len(used) + place[codes]).ravel()
    # Squared distances of counts are whole numbers: float32 holds them up to 2^24.
    return np.bincount(flat, minlength=n * len(used)).reshape(n, -1).astype(np.float32 if size < 2000 else np.float64)


def near_pairs(one: list[str], other: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Positions in ``one`` and ``other``, words of one length each, that are a single edit apart."""
    a, b = _letters(one), _letters(other)
    used = np.union1d(np.unique(a), np.unique(b))
    x, y = _letter_counts(a, used), _letter_counts(b, used)
    # |x - y|^2 = -2xy + |x|^2 + |y|^2, as one product with two more columns.
    left = np.column_stack((-2 * x, (x * x).sum(1), np.ones(len(x), x.dtype)))
    right = np.column_stack((y, np.ones(len(y), y.dtype), (y * y).sum(1)))
    i, j = np.divmod(np.flatnonzero(left @ right.T <= 2), len(b))
    return _verified(a, b, i, j)


def _verified(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if a.shape[1] > b.shape[1]:
        j, i = _verified(b, a, j, i)
        return i, j
    size, found = a.shape[1], []
    step = max(1, (1 << 24) // max(1, size))
    for at in range(0, len(i), step):
        s, t = a[i[at : at + step]], b[j[at : at + step]]
        if size == b.shape[1]:
            found.append((s != t).sum(1) == 1)
        else:
            head = np.logical_and.accumulate(s == t[:, :size], axis=1).sum(1)
            tail = np.logical_and.accumulate((s == t[:, 1:])[:, ::-1], axis=1).sum(1)
            found.append(head + tail >= size)
    good = np.concatenate(found) if found else np.zeros(0, bool)
    return i[good], j[good]


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            own, other, same = (batch.column(k)[row] for k in range(3))
            (r, one), (s, two) = (_members(x) for x in (own, other))
            i, j = near_pairs(one, two)
            if same.as_py():
                i, j = i[r[i] < s[j]], j[r[i] < s[j]]
            if len(i):
                both = np.concatenate((r[i], s[j])), np.concatenate((s[j], r[i]))
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in both], ["rank", "near"])


def _members(scalar: pa.ListScalar) -> tuple[np.ndarray, list[str]]:
    members = scalar.values
    return members.field(0).to_numpy(), members.field(1).to_pylist()


def links(ranked: DataFrame, words: int) -> DataFrame:
    """``rank, near``: both directions of every pair of words one edit apart."""
    blocks = written(_blocks(ranked, words), "spelling-blocks")
    first = blocks.select(F.size("counts")).first()
    groups = first[0] if first else 1
    spread = blocks.select(F.col("counts").alias("from"), F.col("chunk").alias("other_chunk"), F.col("members").alias("other"), F.explode(_met("counts", groups)).alias("counts"))
    # A chunk is dealt to each chunk of the blocks it meets, so a large block is no task of its own.
    spread = spread.join(maybe_broadcast(blocks.select("counts", "chunks").distinct()), "counts")
    spread = spread.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).drop("chunks")
    own = blocks.select("counts", "chunk", F.col("members").alias("own"))
    met = own.join(spread, ["counts", "chunk"])
    inside = F.col("from") == F.col("counts")
    met = met.filter(~inside | (F.col("other_chunk") <= F.col("chunk")))
    same = inside & (F.col("other_chunk") == F.col("chunk"))
    return met.select("own", "other", same.alias("same")).mapInArrow(_pairs, "rank long, near long")


def spelling_groups(docs: DataFrame, noise: int | None = None) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of the vocabulary.

    ``form`` is the near word with the largest count (then the smallest), if that is at least twice the word's; ``root`` the
    end of the chain of forms, the word itself where it has none. Counts double along a chain, so it ends after at
    most 63 steps, and each round doubles the steps followed.
    """
    # Ranks grow from the largest count down, then by code point: the best of several words is that with the least rank.
    counted = written(vocabulary(docs, noise), "spelling-words")
    ordered = counted.orderBy(F.col("n").desc(), "word").select(F.monotonically_increasing_id().alias("rank"), "word", "n")
    ranked = written(ordered, "spelling-ranks")
    words = ranked.count()
    best = links(ranked, words).groupBy("rank").agg(F.count(F.lit(1)).alias("n_near"), F.min("near").alias("near"))
    best = written(best, "spelling-links")
    near = ranked.select(F.col("rank").alias("near"), F.col("word").alias("near_word"), F.col("n").alias("near_n"))
    joined = ranked.join(best, "rank", "left").join(near, "near", "left")
    has = F.col("near_n") >= 2 * F.col("n")
    table = joined.select(
        "rank", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(has, F.col("near")).alias("form_rank"),
        F.when(has, F.col("near_word")).alias("form"), F.when(has, F.col("near_n")).alias("form_n"),
    )
    table = written(table, "spelling-forms")
    steps = written(table.filter("form_rank is not null").select("rank", F.col("form_rank").alias("root")), "spelling-steps")
    while True:
        onward = steps.select(F.col("rank").alias("root"), F.col("root").alias("further"))
        longer = steps.join(onward, "root", "left").select("rank", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        longer = written(longer, "spelling-steps")
        steps = longer.drop("moved")
        if longer.filter("moved").isEmpty():
            break
    roots = steps.join(ranked.select(F.col("rank").alias("root"), F.col("word").alias("root_word")), "root").select("rank", "root_word")
    return table.join(roots, "rank", "left").select("word", "form", F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n")
