"""Operators against brute force, and on nulls, empty and long texts, repeated rows, empty tables, clashing columns."""

from __future__ import annotations

import gzip
import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from palaver.llm import language, quality_model, repeats, rules, toxicity, warc
from palaver.llm.components import components
from palaver.llm.decontaminate import contamination
from palaver.llm.mixing import mix_sources
from palaver.llm.near import near_duplicates, sketch
from palaver.llm.repeats import remove_repeats
from palaver.llm.surrogates import pseudonymise, surrogates
from palaver.llm.text import Roller, normalised
from palaver.llm.warc import quarantined, read_archives, record, write_archives

SCHEMA = "doc_id long, text string, lang string, source string, id string, hash string, kept string, digest string"
WORD = r"[^\x20\x09-\x0D]+"


def vocabulary(seed, n=60):
    r = random.Random(seed)
    return ["".join(r.choice("abcdefgh") for _ in range(r.randint(1, 6))) for _ in range(n)]


@pytest.fixture(scope="module")
def texts():
    r, v = random.Random(4), vocabulary(1, 400)
    base = [" ".join(r.choice(v) for _ in range(r.randint(60, 140))) for _ in range(12)]
    rows = {}
    for i in range(120):
        words = r.choice(base).split()
        kind = i % 6
        if kind == 0:
            words = [r.choice(v) for _ in range(r.randint(0, 90))]
        elif kind in (1, 2, 3):
            for _ in range(r.randint(0, 4 * kind)):
                words[r.randrange(len(words))] = r.choice(v)
        elif kind == 4:
            words = [r.choice(v) for _ in range(30)] + words[10:40] + ["end"]
        rows[i] = r.choice([" ", "\n", " \t "]).join(words)
    rows |= {200: None, 201: "", 202: " \n ", 203: "one", 204: "One two", 205: "one two", 206: " ".join(v) * 12, 207: "é " * 40 + "ß x"}
    return rows


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, None, "s", "x", "y", "z", "w") for i, t in texts.items()]
    return spark.createDataFrame([*rows, rows[7], rows[7], (None, texts[7], None, None, None, None, None, None)], SCHEMA)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def test_windows_are_hashes_of_their_words():
    words = vocabulary(2, 30) * 40
    roller, seen = Roller(1), {}
    for raw in (" ".join(words), "  ".join(words[7:]) + "\n"):
        h = roller.windows(normalised(raw), 3)
        ws = raw.split()
        assert len(h) == len(ws) - 2
        for i, x in enumerate(h):
            assert seen.setdefault(tuple(ws[i : i + 3]), x) == x
    assert len(set(seen.values())) == len(seen)


def test_repeats(docs, texts, nothing):
    first, words = {}, {i: re.findall(WORD, t or "") for i, t in texts.items()}
    for i, ws in words.items():
        for k in range(len(ws) - 12):
            first[tuple(ws[k : k + 13])] = min(i, first.get(tuple(ws[k : k + 13]), i))
    want = {}
    for i, ws in words.items():
        gone = {p for k in range(len(ws) - 12) if first[tuple(ws[k : k + 13])] < i for p in range(k, k + 13)}
        kept = " ".join(w for p, w in enumerate(ws) if p not in gone)
        want[i] = (i, len(ws), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    want[None] = (None, len(words[7]), 0, hashlib.sha256(" ".join(words[7]).encode()).hexdigest())
    got = rows_of(remove_repeats(docs), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert got == sorted([*want.values(), want[7], want[7]], key=repr)
    assert sum(r[2] for r in got) > 100
    assert remove_repeats(nothing).count() == 0


def shingle_sets(texts, k):
    out = {}
    for i, t in texts.items():
        ws = re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        out[i] = {tuple(ws[p : p + k]) for p in range(len(ws) - k + 1)} or ({tuple(ws)} if ws else set())
    return out


def test_settled_windows_are_dealt_to_all_buckets(monkeypatch):
    monkeypatch.setattr(repeats, "SLICE_WINDOWS", 2000)
    v, buckets = vocabulary(3, 200), 16
    family = [v[k % 200] for k in range(120)]
    batches = [pa.RecordBatch.from_pydict({"id": [64 * (50 * b + k) for k in range(50)], "text": [" ".join([*family, f"end{b}"])] * 50}) for b in range(8)]
    per_bucket, settled = Counter(), set()
    for out in repeats._entries(13, buckets)(batches):
        for b, done, ids, hashes in zip(*(out.column(k).to_pylist() for k in range(4)), strict=True):
            if done:
                per_bucket[b] += len(hashes)
                settled |= {(b, int(i)) for i in repeats._unpack(ids)}
    assert len(per_bucket) == buckets and max(per_bucket.values()) < 3 * sum(per_bucket.values()) / buckets
    assert len(settled) == len({i for _, i in settled})


@pytest.mark.parametrize("words", [4, 5])
def test_near_duplicates(docs, texts, nothing, words):
    sets = shingle_sets(texts, words)
    least = {i: i for i in sets}
    changed = True
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            low = min(least[a], least[b])
            changed |= least[a] != low or least[b] != low
            least[a] = least[b] = low
    want = {i: (i, len(s), least[i], least[i] == i) for i, s in sets.items()}
    want[None] = (None, len(sets[7]), None, True)
    got = rows_of(near_duplicates(docs, words=words), "doc_id", "n_shingles", "component_id", "kept")
    assert got == sorted([*want.values(), want[7], want[7]], key=repr)
    assert len(links) > 20
    assert near_duplicates(nothing).count() == 0


@pytest.mark.parametrize("size", [1, 2, 7, 300, 5000])
def test_sketch_fills_every_coordinate_and_estimates_similarity(size):
    r = np.random.default_rng(size)
    a = np.unique(r.integers(0, 2**63, size).astype(np.uint64))
    b = a.copy()
    b[: size // 5] = r.integers(0, 2**63, size // 5).astype(np.uint64)
    x, y = sketch(a), sketch(np.unique(b))
    assert len(x) == len(y) == 300
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs((x == y).mean() - true) < (0.15 if size > 50 else 0.45)


def test_decontamination(spark, docs, texts, nothing):
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    lower = lambda t: re.findall(pattern, re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    items = {"b": " ".join(texts[1].split()[5:30]).upper(), "a": "one", "c": " ".join(texts[4].split()[20:33]), "d": None, "e": "", "f": " ".join(texts[9].split()[3:9])}
    items["g"] = items["f"]
    bench = spark.createDataFrame([(k, v, 1) for k, v in items.items()] + [(None, "one", 1)], "item_id string, text string, mark int")
    want = {}
    for i, t in [*texts.items(), (None, texts[7])]:
        ws, hit, names = lower(t), set(), set()
        for name, text in items.items():
            iw = lower(text)
            k = min(13, len(iw))
            wins = {tuple(iw[p : p + k]) for p in range(len(iw) - k + 1)} if iw else set()
            for p in range(len(ws) - k + 1) if wins else ():
                if tuple(ws[p : p + k]) in wins:
                    hit |= set(range(p, p + k))
                    names.add(name)
        want[i] = (i, len(ws), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(ws))
    columns = "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"
    expected = sorted([*want.values(), want[7], want[7]], key=repr)
    assert rows_of(contamination(docs, bench), *columns) == expected
    assert any(x[5] for x in expected)
    assert contamination(docs, bench.limit(0)).filter("n_hit > 0").count() == 0
    assert contamination(nothing, bench).count() == 0


def test_decontamination_without_the_broadcast(spark, docs, texts, monkeypatch):
    from palaver.llm import decontaminate

    bench = spark.createDataFrame([("b", " ".join(texts[1].split()[5:30])), ("s", "one")], "item_id string, text string")
    want = rows_of(contamination(docs, bench), "doc_id", "n_hit")
    monkeypatch.setattr(decontaminate, "MAX_FINGERPRINTS", 0)
    assert rows_of(contamination(docs, bench), "doc_id", "n_hit") == want


def test_quality_statistics(docs, texts, nothing, spark):
    extra = {300: "a b c a b c x", 301: "x y\nx y\n \n\nx y", 302: "## $$ é|é <tag> 100%", 303: "w " * 70, 304: None}
    more = spark.createDataFrame([(i, t, None, None, None, None, None, None) for i, t in extra.items()], SCHEMA)
    want = {}
    for i, t in (texts | extra).items():
        t = t or ""
        ws = re.findall(WORD, t)
        places = {}
        for k in range(len(ws) - 2):
            places.setdefault(tuple(ws[k : k + 3]), []).append(k)
        again = {p for v in places.values() if len(v) > 1 for k in v for p in (k, k + 1, k + 2)}
        lines = [x for x in t.split("\n") if re.search(WORD, x)]
        want[i] = (i, len(ws), sum(map(len, ws)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(again), len(ws) < 50 or 100 * len(again) > 50 * len(ws))
    judged = rules.quality_rules(docs.filter("doc_id is not null").dropDuplicates(["doc_id"]).unionByName(more))
    columns = "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"
    assert rows_of(judged, *columns) == sorted(want.values(), key=repr)
    assert judged.filter("kept and base_failed").count() == 0
    assert rules.quality_rules(nothing).count() == 0
    assert rules.keep_good(docs).columns == docs.columns


def test_votes_are_learned_without_labels():
    r, patterns = random.Random(1), Counter()
    for _ in range(4000):
        good = r.random() < 0.85
        vote = [-(r.random() < (0.01 if good else 0.5)) for _ in range(len(rules.RULES) - 1)] + [int(r.random() < (0.9 if good else 0.1))]
        patterns[tuple(int(v) for v in vote)] += 1
    share, shares = rules.estimate(sorted(patterns.items()))
    assert abs(share - 0.85) < 0.04
    assert all(abs(x["bad"][0] - 0.5) < 0.1 and x["good"][0] < 0.05 for x in shares[:-1])


def test_mixture_follows_the_weights(spark, nothing):
    v = vocabulary(5)
    r = random.Random(2)
    rows = [(i, " ".join(r.choice(v) for _ in range(r.randint(1, 40))), "big" if i % 3 else (None if i % 2 else f"s{i % 5}")) for i in range(6000)]
    docs = spark.createDataFrame([*rows, rows[0], (9999, None, "big"), (9998, "", "only empty")], "doc_id long, text string, source string")
    had = Counter()
    for _, t, s in [*rows, rows[0]]:
        had[s] += len(t.split())
    got = Counter()
    for x in mix_sources(docs, block_docs=200, entropy=0.97, repeats=9.0).groupBy("source").agg(F.sum("n_tokens").alias("n")).collect():
        got[x["source"]] = x["n"]
    p, q = (np.array([c[s] for s in sorted(had, key=str)], float) for c in (had, got))
    entropy = lambda x: -(x / x.sum() * np.log(x / x.sum())).sum()
    assert abs(q.sum() / p.sum() - 1) < 0.02
    assert abs(entropy(q) / np.log(len(p)) - 0.97) < 0.01
    slope = np.polyfit(np.log(p), np.log(q), 1)[0]
    assert np.allclose(np.log(q / q.sum()), np.log(p**slope / (p**slope).sum()), atol=0.08)
    limited = mix_sources(docs, block_docs=200, entropy=1.0, repeats=1.2).groupBy("source").agg(F.sum("n_tokens").alias("n"), F.max("pass").alias("p")).collect()
    assert max(x["n"] / had[x["source"]] for x in limited) < 1.25
    assert mix_sources(nothing).count() == 0


def test_surrogates(spark, nothing):
    text = "Mail müller.55@Mail4.example.com or +1 (017) 555-7713. Mrs Anna Smith, Mr Smith, Господин Иванов; 4111-1111-1111-1111, 83.229.25.121, 123-45-6789, token = \"ae93e105146691ae697923a219be4df655c4f1c7\"."
    rows = [(1, text), (1, text), (2, "again müller.55@Mail4.example.com"), (3, None), (4, ""), (None, "to a@b.org"), (5, "no entity at all, 12 of 15.")]
    docs = spark.createDataFrame([(i, t, None, None, None, None, None, None) for i, t in rows], SCHEMA)
    got = {(r["doc_id"], r["text"]): r["n_replaced"] for r in pseudonymise(docs, "k").collect()}
    new = next(t for i, t in got if i == 1)
    for old in ("müller", "7713", "Anna", "Smith", "Иванов", "4111", "83.229", "123-45", "ae93e1"):
        assert old not in new
    assert re.search(r"\+1 \(\d{3}\) \d{3}-\d{4}\. Mrs [A-Z][a-z]+(a|ia|elle) [A-Z][a-z]+, Mr [A-Z][a-z]+, Господин [А-Я][а-я]+; \d{4}-\d{4}-\d{4}-\d{4}, ", new)
    assert re.search(r"Mrs \w+ (\w+), Mr \1,", new)
    digits = [int(c) for c in re.search(r"\d{4}-\d{4}-\d{4}-\d{4}", new)[0] if c.isdigit()]
    assert sum(d if k % 2 else (2 * d - 9 if d > 4 else 2 * d) for k, d in enumerate(digits)) % 10 == 0
    mail = re.search(r"\S+@\S+", new)[0]
    assert ("again " + mail) in {t for i, t in got if i == 2}
    assert got[(3, None)] == got[(4, "")] == got[(5, rows[-1][1])] == 0
    assert pseudonymise(docs, "k").count() == len(rows)
    assert pseudonymise(docs, "other").filter(F.col("text") == new).count() == 0
    assert pseudonymise(nothing, "k").count() == 0


def test_long_entities_are_replaced_whole(spark):
    lead, key = "." * 70, "0123456789abcdef" * 64
    texts = [
        f"John Smith{lead}jsmith@uni.edu", f"{'_' * 5000}jsmith@uni.edu", f"{'联系我们' * 30}jsmith@uni.edu", f"jsmith@{'a' * 80}.{'b.' * 20}edu",
        "one@uni.edu_jsmith@uni.edu", f"n = {key};", f"n = {key.upper()}0;", f"no {'1234567890' * 3}.", f"Mr Jsmith{'a' * 50}smith left",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in pseudonymise(docs, "k").collect()}
    for i, old in enumerate(texts):
        assert not re.search(r"(?i)jsmith|uni\.edu|asmith|0123456789|1234567890", got[i]), got[i]
        assert i in (3, 8) or "@" in old or len(got[i]) == len(old)
    assert re.fullmatch(r"[A-Z][a-z]+ [A-Z][a-z]+\.{70}[a-z]{6}@[a-z]{3}\.example", got[0])
    assert re.fullmatch(r"n = [0-9a-f]{1024};", got[5]) and re.fullmatch(r"n = [0-9A-F]{1025};", got[6])
    assert len({got[5][4 + k : 68 + k] for k in range(0, 1024, 64)}) == 16


def test_names_share_their_parts_and_stay_distinct(spark):
    letters = lambda k: "".join("abcdefghij"[int(c)] for c in f"{k:04d}")
    names = [f"F{letters(k)}" for k in range(7000)]
    values = [*(f"Mr {n}" for n in names), *(f"Mr John {n}" for n in names), "Mrs Anna Faaaa", "Mr FAAAA", "Mr McDonald", "Mr Mcdonald", "Mr O'BRIEN", "Ms Eva O'Brien", "Mr. John Faaaa"]
    got = {r["value"]: r["surrogate"] for r in surrogates(spark.createDataFrame([(v,) for v in values], "value string"), "k").filter("kind = 'name'").collect()}
    assert set(got) == set(values)
    assert len(set(got.values())) == len(got) and not set(got.values()) & set(values)
    family = {n: got[f"Mr {n}"].split()[-1] for n in names}
    assert len(set(family.values())) == len(names)
    assert all(re.fullmatch("Mr [A-Z][a-z]+", got[f"Mr {n}"]) and got[f"Mr John {n}"].split()[2] == family[n] for n in names)
    assert len({got[f"Mr John {n}"].split()[1] for n in names}) == 1 and got["Mr. John Faaaa"] == got["Mr John Faaaa"].replace("Mr", "Mr.")
    assert got["Mrs Anna Faaaa"].split()[2] == family["Faaaa"] and got["Mr FAAAA"] == f"Mr {family['Faaaa'].upper()}"
    assert got["Ms Eva O'Brien"].split()[2].upper() == got["Mr O'BRIEN"].split()[1]


def test_surrogates_stay_distinct(spark):
    values = [f"{a:03d}-{b:02d}-0000" for a in range(40) for b in range(50)] + [f"{c}@x.org" for c in "abcdefghijklmnopqrstuvwxyz"]
    got = surrogates(spark.createDataFrame([(v,) for v in values], "value string"), "k").collect()
    made = [r["surrogate"] for r in got]
    assert len(set(made)) == len(values) == len(got)
    assert not set(made) & set(values)


def test_archives_come_back(spark, tmp_path):
    big = "x" * 2000
    rows = [(1, "u1", big, 5), (2, "u2", big, 5), (3, "u3", "small", 5), (4, "u4", "small", 5), (5, None, None, 5), (6, "u6", "", 5), (None, "n", big, 5), (7, "u\r\n7", "é" * 600, 5), (8, "u8", "é" * 600, 5)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, kind int")
    for compress in (True, False):
        got = read_archives(spark, write_archives(pages, compress=compress), split_bytes=300)
        want = []
        for i, _, html, _ in rows:
            raw = (html or "").encode()
            last = max((j for j, _, h, _ in rows if j is not None and h == html), default=None)
            again = len(raw) >= 1000 and i is not None and i < last
            want.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response", last if again else None))
        assert rows_of(got, "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to") == sorted(want, key=repr)
    assert read_archives(spark, write_archives(pages.limit(0))).count() == 0


@pytest.mark.parametrize("compress", [True, False])
def test_long_ids_and_urls_come_back(spark, compress):
    big, url = "x" * 2000, "https://h/" + "q" * (100 << 10)
    rows = [(2**63 - 1, url, big), (10**18, "u2", big), (-(2**63), f"{url}2", "small"), (3, f"{url}WARC/1.1", "last")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = read_archives(spark, write_archives(pages, compress=compress))
    want = [(i, u, "revisit" if i == 10**18 else "response", 2**63 - 1 if i == 10**18 else None) for i, u, _ in rows]
    assert rows_of(got, "page_id", "target_uri", "record_type", "refers_to") == sorted(want, key=repr)
    assert warc.parse(record("response", 2**63, "u", b"", hashlib.sha1(b"").hexdigest(), 0, None))["page_id"] is None


@pytest.mark.parametrize("compress", [True, False])
def test_damaged_archives_are_salvaged(spark, tmp_path, compress):
    raws = []
    for i in range(40):
        body = random.Random(i).randbytes(400)
        raws.append(record("response", i, f"u{i}", body, hashlib.sha1(body).hexdigest(), len(body), None))
    parts = [gzip.compress(r) for r in raws] if compress else raws
    junk = b"\x1f\x8b\x08 WARC/1.1\r\n broken"
    broken = bytearray(parts[7])
    broken[len(broken) // 2] ^= 255
    data = b"".join([*parts[:7], bytes(broken), *parts[8:20], junk, *parts[20:39], parts[39][:-9]])
    path = tmp_path / f"x.warc{'.gz' * compress}"
    path.write_bytes(data)
    files = spark.createDataFrame([(str(path), len(data))], "path string, bytes long")
    records = read_archives(spark, files, split_bytes=700).persist()
    assert sorted(r["page_id"] for r in records.collect()) == [i for i in range(39) if i != 7]
    at = [sum(map(len, parts[:7])), sum(map(len, parts[:20])), len(data) - len(parts[39]) + 9]
    want = [(at[0], at[0] + len(parts[7])), (at[1], at[1] + len(junk)), (at[2], len(data))]
    assert rows_of(quarantined(files, records), "gap_start", "gap_end") == sorted(want, key=repr)


def test_language_of_mixed_text(spark, nothing):
    r = random.Random(3)
    langs = {"aa": ["the", "thing", "with", "other"], "bb": ["der", "schatz", "und", "nicht"], "ру": ["это", "слово", "мир"]}
    make = lambda k, n: " ".join(r.choice(langs[k]) for _ in range(n))
    rows = [(i, make(k, 20), k) for i in range(20) for k in langs] + [(90, "the", None), (91, None, "aa")]
    model = language.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    mixed = make("aa", 12) + ". " + make("bb", 25) + " ru: " + make("ру", 6)
    tests = [(1, mixed), (2, None), (3, "12 !"), (4, ""), (5, make("aa", 3000)), (None, make("ру", 2)), (1, make("aa", 9))]
    got = [(x["doc_id"], x["lang_pred"], x["score"], x["spans"]) for x in language.identify(spark.createDataFrame(tests, "doc_id long, text string"), model).collect()]
    assert sorted((str(i), p) for i, p, _, _ in got) == sorted([("1", "bb"), ("2", "und"), ("3", "und"), ("4", "und"), ("5", "aa"), ("None", "ру"), ("1", "aa")])
    spans = next(s for i, p, _, s in got if i == 1 and p == "bb")
    assert [s["lang"] for s in spans][0] == "aa" and [s["lang"] for s in spans][-1] == "ру" and {s["lang"] for s in spans} == set(langs)
    assert mixed[spans[0]["start"] : spans[0]["end"]] == mixed.split(".")[0]
    assert all(0 <= s <= 1 for _, _, s, _ in got)
    assert language.identify(nothing, model).count() == 0
    empty = language.learn(nothing)
    assert {x["lang_pred"] for x in language.identify(spark.createDataFrame(tests, "doc_id long, text string"), empty).collect()} == {"und"}


def test_viterbi_is_the_best_path():
    r = np.random.default_rng(1)
    from itertools import product

    texts = [r.normal(size=(n, 3)).astype(np.float32) for n in (1, 5, 3, 6)]
    for t, labels in zip(texts, language.viterbi(texts, 0.7), strict=True):
        value = lambda path: sum(t[k, x] for k, x in enumerate(path)) - 0.7 * sum(a != b for a, b in zip(path, path[1:], strict=False))
        assert value(labels) == pytest.approx(max(value(p) for p in product(range(3), repeat=len(t))), abs=1e-4)


def test_quality_model(spark, nothing):
    r, v = random.Random(6), vocabulary(7, 500)
    good = [" ".join(r.choice(v) for _ in range(r.randint(20, 200))).capitalize() + "." for _ in range(150)]
    bad = [" ".join(r.choice(v) + r.choice(["***", "%%%"]) for _ in range(r.randint(20, 200))) for _ in range(30)]
    rows = [(i, t, int(i < 150)) for i, t in enumerate(good + bad)] + [(900, None, None), (901, "", 1), (None, "x", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    model = quality_model.learn(docs.filter("doc_id % 2 = 0"))
    got = {x["doc_id"]: x["score"] for x in quality_model.score(docs, model).collect()}
    assert all(0 <= s <= 1 for s in got.values())
    assert np.mean([(got[i] >= 0.3) == (y == 1) for i, _, y in rows[:180] if i % 2]) > 0.95
    assert quality_model.score(nothing, model).count() == 0
    untaught = quality_model.learn(docs.limit(0))
    assert {x["score"] for x in quality_model.score(docs, untaught).collect()} == {0.5}


def test_toxicity(spark, nothing):
    r, v = random.Random(8), vocabulary(9, 500)
    texts, labels = [], []
    for i in range(400):
        words = [r.choice(v) for _ in range(60)]
        n = r.choice([1, 2, 5]) if i % 5 == 0 else 0
        for _ in range(n):
            words.insert(r.randrange(60), r.choice(["nastyone", "nastytwo", "Nastythree,"]))
        texts.append(" ".join(words))
        labels.append(int(n > 0))
    docs = spark.createDataFrame([*enumerate(texts), (900, None), (901, ""), (None, "nastyone")], "doc_id long, text string")
    known = spark.createDataFrame([(i, y) for i, y in enumerate(labels) if i % 4], "doc_id long, toxic int")
    model = toxicity.learn(docs, known)
    assert list(model["thresholds"]) == sorted(model["thresholds"])
    got = {x["doc_id"]: x for x in toxicity.severity(docs, model).collect()}
    assert all(got[i]["toxic"] == bool(y) for i, y in enumerate(labels))
    assert not got[900]["toxic"] and not got[901]["toxic"] and got[None]["toxic"]
    assert all(0 <= x["expected_severity"] <= toxicity.GRADES - 1 for x in got.values())
    assert toxicity.severity(nothing, model).count() == 0
    assert not any(x["toxic"] for x in toxicity.severity(docs, toxicity.learn(docs, known.limit(0))).collect())


def test_ordinal_fit_recovers_order():
    r = np.random.default_rng(2)
    x = r.integers(0, 2, (3000, 3)).astype(float)
    z = x @ np.array([2.0, -1.0, 0.0]) + r.logistic(size=3000)
    weights, cuts = toxicity.fit(toxicity.Marks(*np.nonzero(x), x.shape), np.digitize(z, [0.0, 1.5, 3.0]), 4)
    assert np.allclose(weights, [2.0, -1.0, 0.0], atol=0.3) and np.allclose(cuts, [0.0, 1.5, 3.0], atol=0.3)


@pytest.mark.parametrize("kind", ["none", "chain", "random", "loops"])
def test_components_are_those_of_the_graph(spark, kind):
    r = random.Random(kind)
    links = {
        "none": [],
        "chain": [(i, i + 1) for i in range(60)],
        "random": [(r.randrange(150), r.randrange(150)) for _ in range(110)],
        "loops": [(5, 5), (7, 2), (2, 7), (2, 7), (9, 7)],
    }[kind]
    least = {x: x for pair in links for x in pair if pair[0] != pair[1]}
    for _ in least:
        for a, b in links:
            if a != b:
                least[a] = least[b] = min(least[a], least[b])
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert len(got) == len(least) and {x["id"]: x["component"] for x in got} == least
