"""Cases that once came out wrong: names and numbers left in texts, words with equal polynomials, letters that are none, clashing columns."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from palaver.llm import language, toxicity
from palaver.llm.decontaminate import contamination
from palaver.llm.mixing import mix_sources
from palaver.llm.near import near_duplicates
from palaver.llm.repeats import remove_repeats
from palaver.llm.rules import keep_good
from palaver.llm.surrogates import pseudonymise, surrogates
from palaver.llm.text import CHUNK_WORDS, Roller, normalised


def replaced(spark, *texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r["text"] for r in sorted(pseudonymise(docs, "k").collect(), key=lambda r: r["doc_id"])]


def test_names_of_any_length_and_later_mentions(spark):
    cases = {
        "Mr John Paul Smith went": "John Paul Smith",
        "Mrs Anna Maria García López spoke": "Anna Maria García López",
        "Mr Ludwig van Beethoven wrote": "Ludwig Beethoven",
        "Mr J. R. Smith and Mr. John  Smith met": "Smith John",
        "Prof. Dr. Eva Müller-Lüdenscheid lectured": "Eva Müller Lüdenscheid",
        "Dr\nJane O’Hara came. O’Hara's car": "Jane Hara",
        "Mr John Smith came. Smith left. John Smith wrote. SMITH! Mc Smithson stayed.": "John Smith SMITH",
        "Before, Smith sat. Mr Smith stood": "Smith",
        "Mr Γιώργος Παπαδόπουλος ήρθε": "Γιώργος Παπαδόπουλος",
        "Господин Иван Петров и Петров": "Иван Петров",
    }
    got = replaced(spark, *cases)
    for (old, names), new in zip(cases.items(), got, strict=True):
        assert not set(re.findall(r"\w+", names)) & set(re.findall(r"\w+", new)), (old, new)
    assert re.fullmatch(r"Mr \w+ van \w+ wrote", got[2]) and re.fullmatch(r"Mr [A-Z]\. [A-Z]\. (\w+) and Mr\. \w+  \1 met", got[3])
    assert re.fullmatch(r"Prof\. Dr\. \w+ \w+ lectured", got[4]) and re.fullmatch(r"Dr\n\w+ (\w+) came\. \1's car", got[5])
    first, family = re.match(r"Mr (\w+) (\w+) came", got[6]).groups()
    assert got[6] == f"Mr {first} {family} came. {family} left. {first} {family} wrote. {family.upper()}! Mc Smithson stayed."
    assert re.fullmatch(r"Before, (\w+) sat\. Mr \1 stood", got[7])
    assert re.fullmatch(r"Mr [Α-ω]+ [Α-ω]+ ήρθε", got[8]) and re.fullmatch(r"Господин [А-я]+ ([А-я]+) и \1", got[9])


def test_no_part_of_a_name_is_left(spark):
    r = random.Random(1)
    made = lambda: "".join(r.choice("bdgklmnrst") + r.choice("aeiou") for _ in range(r.randint(2, 4))).capitalize()
    texts, parts = [], []
    for _ in range(60):
        names = [made() for _ in range(r.randint(1, 4))]
        joined = names[0] + "".join(r.choice([" ", "  ", " van ", " Q. ", "\xa0"]) + n for n in names[1:])
        texts.append(f"So {r.choice(['Mr', 'Mrs.', 'Dr', 'Frau', 'Prof. Dr.'])} {joined} said: {names[-1]}, {names[0].upper()} and {' '.join(names)}.")
        parts.append({n.lower() for n in names})
    for new, names in zip(replaced(spark, *texts), parts, strict=True):
        assert not names & {w.lower() for w in re.findall(r"\w+", new)}, new


def mod97(iban):
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def test_numbers_and_addresses_of_every_form(spark):
    texts = [
        "NL91ABNA0417164300", "GB82 WEST 1234 5698 7654 32", "FR1420041010050500013M02606", "NO9386011117947", "DE89370400440532013000",
        "3782 822463 10005", "2001:0db8:85a3:0000:0000:8a2e:0370:7334", "2001:DB8::8a2e:370", "a@example.xn--p1ai", "山田@example.org", "Bob@X.org", "Bob@x.org",
    ]
    got = replaced(spark, *(f"it is {t}, yes" for t in texts), "std::vector at 12:30:45, a::be")
    new = [g[6:-5] for g in got[:-1]]
    for old, now in zip(texts[:5], new[:5], strict=True):
        plain = now.replace(" ", "")
        assert now != old and now[:2] == old[:2] and mod97(plain) == 1 and [c.isdigit() for c in now[4:]] == [c.isdigit() for c in old[4:]] and now[4:] != old[4:]
    assert re.fullmatch(r"\d{4} \d{6} \d{5}", new[5]) and not set(new[5].split()) & set(texts[5].split())
    assert re.fullmatch(r"(?:[0-9a-f]{4}:){7}[0-9a-f]{4}", new[6]) and new[6] != texts[6] and re.fullmatch(r"[0-9]{4}|[0-9a-f]{4}", new[7][:4].lower())
    assert re.fullmatch(r"[a-z]@[a-z]+\.example", new[8]) and re.fullmatch(r"[一-鿿]{2}@[a-z]+\.example", new[9]) and "山田" not in new[9]
    assert new[10] == new[11]
    assert got[-1] == "std::vector at 12:30:45, a::be"


def test_accounts_stay_distinct(spark):
    values = [f"NL91ABNA{k:010d}" for k in range(500)] + [f"GB82WEST{k:014d}" for k in range(500)]
    got = surrogates(spark.createDataFrame([(v,) for v in values], "value string"), "k").collect()
    assert len({r["surrogate"] for r in got}) == 1000 and {r["kind"] for r in got} == {"iban"}


def thue_morse(flip):
    return "".join("ab"[(k.bit_count() + flip) % 2] for k in range(1024))


def test_words_of_equal_polynomials_differ(spark):
    """Two words whose byte polynomials agree modulo 2^64 for every base."""
    one, two = thue_morse(0), thue_morse(1)
    for seed in (1, 2, 3, 5):
        roller = Roller(seed)
        assert roller.windows(one.encode(), 1) != roller.windows(two.encode(), 1)
    rest = " ".join(f"w{k}" for k in range(12))
    docs = spark.createDataFrame([(1, f"{one} {rest}"), (2, f"{two} {rest}")], "doc_id long, text string")
    assert {r["doc_id"]: r["n_removed"] for r in remove_repeats(docs).collect()} == {1: 0, 2: 0}
    alone = spark.createDataFrame([(1, one), (2, two)], "doc_id long, text string")
    assert {r["doc_id"]: r["component_id"] for r in near_duplicates(alone, words=4).collect()} == {1: 1, 2: 2}
    items = spark.createDataFrame([("i", one)], "item_id string, text string")
    assert {r["doc_id"]: r["n_hit"] for r in contamination(alone, items).collect()} == {1: 1, 2: 0}


def test_rolling_over_long_texts():
    raw = normalised(" ".join(f"w{k % 977}" for k in range(CHUNK_WORDS * 2 + 100)))
    words = raw.split(b" ")
    hashes = Roller(1).windows(raw, 13)
    assert len(hashes) == len(words) - 12
    for at in (0, CHUNK_WORDS - 13, CHUNK_WORDS - 12, CHUNK_WORDS - 1, CHUNK_WORDS, 2 * CHUNK_WORDS, len(hashes) - 1):
        assert hashes[at] == Roller(1).windows(b" ".join(words[at : at + 13]), 13)[0]


def test_tags_are_no_letters(spark):
    docs = spark.createDataFrame([(1, "the cat sat on the mat", "en"), (2, "der Hund lag auf der Matte", "de")], "doc_id long, text string, lang string")
    model = language.learn(docs)
    flag = "\U0001f3f4" + "".join(chr(0xE0000 + ord(c)) for c in "gbeng") + "\U000e007f"
    texts = [flag, "\U000e0101", "\U000f0000", "", "\U00020000"]
    got = language.identify(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).collect()
    found = {r["doc_id"]: r["lang_pred"] for r in got}
    assert [found[k] for k in range(4)] == ["und"] * 4 and found[4] != "und"


@pytest.mark.parametrize("operator", ["pseudonymise", "mix", "keep"])
def test_clashing_columns_come_back(spark, operator):
    names = "_found _map _key _name _hash _rate _last _block _before _all _row key found made text_ parts known pieces row words id carried".split()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").withColumns({n: F.lit(n) for n in names})
    out = {"pseudonymise": lambda: pseudonymise(docs, "k"), "mix": lambda: mix_sources(docs), "keep": lambda: keep_good(docs)}[operator]()
    assert [c for c in out.columns if c in docs.columns] == docs.columns
    rows = out.collect()
    assert rows and all(r[n] == n for r in rows for n in names)


@pytest.mark.parametrize("shared", [1, 5])
def test_texts_of_one_id_link_what_either_is_like(spark, shared):
    """An id with two texts, and an empty one, brings the copies of both together."""
    one, two = (" ".join(f"{c}{k}" for k in range(60)) for c in "xy")
    near = lambda t: t.replace("0 ", "zero ", 1)
    rows = [(shared, one), (shared, two), (shared, ""), (shared, one), (2, near(one)), (3, near(two)), (7, None), (8, "alone here"), (None, one)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r["doc_id"], r["component_id"]) for r in near_duplicates(docs, words=4).collect()]
    least = min(shared, 2)
    want = [(shared, least)] * 4 + [(2, least), (3, least), (7, 7), (8, 8), (None, None)]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_toxicity_learns_the_same_from_any_partitions(spark):
    """Repeated ids and labels, a sample smaller than the labels."""
    r = random.Random(3)
    rows = [(i % 150, " ".join(r.choice("abcdefghij") * 3 for _ in range(20)) + " nastyone" * (i % 150 % 4 == 0)) for i in range(300)]
    known = [(i, int(i % 4 == 0)) for i in range(150)] * 2
    models = []
    for parts in (1, 3, 7):
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        labels = spark.createDataFrame(known, "doc_id long, toxic int").repartition(parts)
        models.append(toxicity.learn(docs, labels, sample=120))
    assert all(len(m["marks"]) for m in models)
    for model in models[1:]:
        assert all((model[k] == models[0][k]).all() for k in ("marks", "weights", "thresholds"))
