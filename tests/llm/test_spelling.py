"""Spelling variants against brute force."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from palaver.llm import spelling
from palaver.llm.spelling import near_pairs, spelling_groups

SCHEMA = "doc_id long, text string, word string, n string, rank string, counts string"


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:k] + long[k + 1 :] == short for k in range(len(long)))


def brute(docs, noise):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            checksum = zlib.crc32(f"{doc_id}:{run}".encode())
            if noise and doc_id is not None and checksum % noise == 0:
                at = checksum % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 5 and c >= 3}
    others = {w: sorted((x for x in n if near(w, x)), key=lambda x: (-n[x], x)) for w in n}
    form = {w: o[0] if o and n[o[0]] >= 2 * n[w] else None for w, o in others.items()}

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted((w, form[w] or "", root(w), n[w], len(others[w]), n.get(form[w], 0)) for w in n)


def found(spark, docs, noise, parts=3):
    frame = spark.createDataFrame([(*d, "a", "b", "c", "d") for d in docs], SCHEMA).repartition(parts)
    rows = spelling_groups(frame, noise).collect()
    assert all((r["form"] is None) == (r["form_n"] is None) for r in rows)
    return sorted((r["word"], r["form"] or "", r["root"], r["n"], r["n_near"], r["form_n"] or 0) for r in rows)


@pytest.mark.parametrize(("noise", "chunk"), [(97, 2048), (None, 7), (5, 30)])
def test_against_brute_force(spark, monkeypatch, noise, chunk):
    monkeypatch.setattr(spelling, "CHUNK_WORDS", chunk)
    monkeypatch.setattr(spelling, "HELD_CHARS", 2000)
    r = random.Random(chunk)
    stems = ["".join(r.choice("abcé÷") for _ in range(r.randint(5, 9))) for _ in range(40)]
    docs = []
    for i in range(60):
        words = [r.choice(stems) for _ in range(r.randint(0, 60))]
        words = [w[: (k := r.randrange(len(w)))] + r.choice(["", "a", "É", "B", w[k : k + 1]]) + w[k + 1 :] if r.random() < 0.3 else w for w in words]
        docs.append((i, r.choice([" ", "-", "́", "ŝ", "1"]).join(words)))
    docs += [(None, docs[3][1]), (3, docs[3][1]), (70, None), (71, ""), (72, "12 345"), (73, "İstanbul ſtrasse " * 4), (-4, "MIXED Mixed mixed mixes MIXES mixes mixe")]
    assert found(spark, docs, noise) == brute(docs, noise)


def test_long_words_and_texts(spark):
    long = "ab" * 40_000
    docs = [(1, f"{long} {long} {long} {long}x {long}x {long}x {long[1:]} "), (2, f"{long} {long[1:]} {long[1:]} " + "word " * 70_000), (3, "words worda wordi " * 3)]
    rows = spelling_groups(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    got = {r["word"][:6] + str(len(r["word"])): (r["n"], r["n_near"], r["form"] and len(r["form"])) for r in rows}
    assert got == {"ababab80000": (4, 2, None), "ababab80001": (3, 1, None), "bababa79999": (3, 1, None), "words5": (3, 2, None), "worda5": (3, 2, None), "wordi5": (3, 2, None)}


def test_chain_of_forms(spark):
    counts = {"aaaaaa": 64, "aaaaab": 32, "aaaabb": 16, "aaabbb": 8, "aabbbb": 4}
    docs = [(1, " ".join(f"{w} " * n for w, n in counts.items()))]
    assert {r["word"]: r["root"] for r in spelling_groups(spark.createDataFrame(docs, "doc_id long, text string")).collect()} == dict.fromkeys(counts, "aaaaaa")


def test_empty(spark):
    rows = spelling_groups(spark.createDataFrame([], "doc_id long, text string"))
    assert rows.columns == ["word", "form", "root", "n", "n_near", "form_n"] and rows.isEmpty()


def test_near_pairs():
    one, other = ["abcde", "abced", "xxxxx"], ["abcdef", "aabcde", "abcedd"]
    i, j = near_pairs(one, other)
    assert {(one[a], other[b]) for a, b in zip(i.tolist(), j.tolist(), strict=True)} == {(a, b) for a in one for b in other if near(a, b)}
