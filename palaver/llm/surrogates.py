"""Personal data replaced by keyed surrogates of the same type.

Entities are found by patterns: mail addresses, phone numbers, IPv4 and IPv6 addresses, payment cards and other long numbers,
social security numbers, account numbers (IBAN), hexadecimal secrets, and names after a title. An entity's surrogate
follows from the key and the entity alone, so all its mentions in the corpus get the same one. It keeps the format:
separators, lengths (of whatever size), letter case, script (those of ``ALPHABETS``; letters of others become Latin), the country code of a
phone number or account, the check digits of a card or account, octets up to 255, and for names the gender that the title tells, none for
``NEUTRAL`` ones. Numbers go through a keyed Feistel permutation of the numbers of their length, so different numbers never meet.

A name has any number of words, with initials and particles between them: particles stay, initials are exchanged by a keyed rotation. In
a document that has a name, its parts are replaced wherever they stand alone later or earlier, also without a title and
in capitals. A name that no title introduces anywhere in its document is not found.

The distinct entities of the corpus are a table. Two of one type with the same surrogate, or a surrogate that is itself an
entity of the corpus, are tried again with the next attempt, all but the smallest, until none is left; distinct entities stay
distinct, where addresses that differ in the case of the domain alone are one. For names this holds for the given names of a gender and the
family names on their own, and full names are built from them, so a family name has the same made-up one wherever it stands; further attempts add
syllables. Everything is DataFrame expressions. Only rows with entities are joined with their surrogates.

Defined cases: null text stays null, text without entities stays as it is, repeated rows and rows that share an id get the same
surrogates; rows with a null id are treated like others. No rows give no rows. An entity other than a name that still meets others after ``ATTEMPTS``
attempts (too few forms) gets its digest appended. Other columns stay, whatever their names, unless they are named like the added one.
"""

from __future__ import annotations

import hashlib
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palaver.llm.tables import maybe_broadcast, shuffle_partitions, written

ATTEMPTS, FEISTEL_ROUNDS = 8, 6
# Titles by gender, and words that join the parts of a name.
MALE = "Mr|Mister|Sir|Herr|Señor|Sr|Monsieur|Signor|Signore|Господин|Κύριος|Κος"
FEMALE = "Mrs|Ms|Miss|Mme|Mlle|Madam|Frau|Señora|Sra|Señorita|Madame|Mademoiselle|Signora|Signorina|Госпожа|Κυρία|Κα"
NEUTRAL = "Dr|Doctor|Doktor|Prof|Professor|Professeur|Profesor|Profesora|Доктор|Профессор|Δρ"
PARTICLES = "van|von|der|den|de|del|della|di|da|das|dos|du|la|las|los|le|zu|zum|zur|ten|ter|bin|ibn|al|el|y|e|af|av"
TITLE = f"(?:{MALE}|{FEMALE}|{NEUTRAL})"
GAP, BREAK = r"[ \t\x{A0}]++", r"(?=[\s\x{A0}])[ \t\x{A0}]*+\r?\n?[ \t\x{A0}]*+"
#: A part of a name; an apostrophe or hyphen belongs to it if two letters follow.
PART = r"(?<!\p{L})\p{Lu}(?:[\p{L}\p{M}]|['’-](?=\p{L}{2}))*+"
INITIALS = r"(?:\p{Lu}\.)++(?!\p{L})"
TITLES = rf"(?:{TITLE}\.?{BREAK})++"
OCTET = r"(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"
HEX = "[0-9a-fA-F]{1,4}"
#: kind -> pattern; the first kind that matches a whole entity is its kind. Each begins where its characters begin, so matching is linear
#: without a cap on the length: an address takes all of the run before its @, with leaders or unspaced text, and may follow the last match.
PATTERNS = {
    "email": r"(?:(?<![\p{L}\p{N}._%+-])|\G)[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++){0,126}\.(?:[xX][nN]--[\p{L}\p{N}-]{1,59}|\p{L}{2,24})",
    "iban": r"(?<![\p{L}\p{N}])[A-Z]{2}[0-9]{2}(?=(?:[ A-Z]*+[0-9]){6})(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?![\p{L}\p{N}])",
    "ip": rf"(?<![\p{{L}}\p{{N}}.]){OCTET}(?:\.{OCTET}){{3}}(?![\p{{L}}\p{{N}}]|\.[0-9])",
    "ip6": rf"(?<![\p{{L}}\p{{N}}:.])(?:(?:{HEX}:){{7}}{HEX}|(?=[a-fA-F:]*+[0-9])(?:{HEX}:){{1,6}}(?::{HEX}){{1,6}})(?![\p{{L}}\p{{N}}:])",
    "secret": r"(?<![\p{L}\p{N}])(?:[0-9a-f]{32,}+|[0-9A-F]{32,}+)(?![\p{L}\p{N}])",
    "ssn": r"(?<![\p{L}\p{N}+.-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\p{L}\p{N}-])",
    "card": r"(?<![\p{L}\p{N}+.-])(?:[0-9]{4}(?:[ -]?[0-9]{4}){2}[ -]?[0-9]{1,7}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![\p{L}\p{N}])|(?<![\p{L}\p{N}+.-])[0-9]{20,31}(?![\p{L}\p{N}])",
    "phone": r"(?<![\p{L}\p{N}+.-])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)[ .-]?|[0-9]{2,4}[ .-])[0-9]{3,4}[ .-]?[0-9]{3,5}(?![\p{L}\p{N}])|(?<![\p{L}\p{N}+])\+[0-9]{8,15}(?![\p{L}\p{N}])",
    "name": rf"(?<!\p{{L}})(?=\p{{Lu}}){TITLES}(?:(?:{PARTICLES}){GAP}){{0,3}}(?:{INITIALS}|{PART})(?:{GAP}(?:(?:{PARTICLES}){GAP}){{0,3}}(?:{INITIALS}|{PART}))*+",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: What every entity has one of; texts without are passed by.
HINT = rf"@|[0-9]{{3}}|[0-9]\.[0-9]|[0-9a-fA-F]{{32}}|[A-Z]{{2}}[0-9]{{2}}|[0-9a-fA-F]::[0-9a-fA-F]|(?:{HEX}:){{7}}|(?<!\p{{L}})(?=\p{{Lu}}){TITLE}"
#: Alphabets in which a letter stays: the letters that belong to one, and those it takes its surrogates from.
ALPHABETS = (
    ("[0-9]", "0123456789"), ("[a-z]", "abcdefghijklmnopqrstuvwxyz"), ("[A-Z]", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    (r"[\p{IsCyrillic}&&\p{Lu}]", "АБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЭЮЯ"), (r"\p{IsCyrillic}", "абвгдежзийклмнопрстуфхцчшщэюя"),
    (r"[\p{IsGreek}&&\p{Lu}]", "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ"), (r"\p{IsGreek}", "αβγδεζηθικλμνξοπρστυφχψω"),
    (r"\p{IsHebrew}", "אבגדהוזחטיכלמנסעפצקרשת"), (r"\p{IsArabic}", "ابتثجحخدذرزسشصضطظعغفقكلمنهوي"), (r"\p{IsDevanagari}", "कखगघचछजझटठडढतथदधनपफबभमयरलवशसह"),
    (r"\p{IsThai}", "กขคงจชซดตถทนบปผพมยรลวสหอ"), (r"\p{IsHangul}", "가나다라마바사아자차카타파하고노도로모보소오조호"), (r"\p{IsHiragana}", "あいうえおかきくけこさしすせそたちつてとなにのはまみやらり"),
    (r"\p{IsKatakana}", "アイウエオカキクケコサシスセソタチツテトナニノハマミヤラリ"), (r"\p{IsHan}", "山川田中村木林森石井上下大小高松本野原島水金土火月日天文"),
)
ROTATED = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "АБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЭЮЯ", "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ")
SYLLABLES = {
    "latin": ("ba be da do fa ga ka la le ma me na ne ra ro sa se ta va ve".split(), "nd rs lt nn".split(), ("an or in el".split(), "a ina ia elle".split(), "er man sen ley".split(), "is en ou y".split())),
    "greek": ("βα γα δα ζω κα λα μα να πα ρα σα τα φα χα θε λε με νε ρο τσι".split(), "νδ ρς λτ ντ".split(), ("ος ης ας ων".split(), "α ινα ια η".split(), "ιδης ακης οπουλος ου".split(), "ι εν ο ω".split())),
    "cyrillic": ("ба бе да до фа га ка ла ле ма ме на не ра ро са се та ва ве".split(), "нд рс лт нн".split(), ("ан ор ин ел".split(), "а ина ия елла".split(), "ер ман ко ук".split(), "ис ен о ы".split())),
}


def _hash(key: str, *parts) -> Column:
    """A keyed 63-bit number: the first 60 bits of a SHA-256 over the key and the parts."""
    text = F.concat_ws("\x1f", F.lit(key), *[p if isinstance(p, Column) else F.lit(str(p)) for p in parts])
    return F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("long")


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _pick(items, number: Column) -> Column:
    return F.get(F.array(*[F.lit(x) for x in items]), F.pmod(number, F.lit(len(items))).cast("int"))


def _power(width: Column) -> Column:
    return F.pow(F.lit(10.0), width).cast("long")


def _permuted(digits: Column, key: str, tag: Column) -> Column:
    """A keyed permutation of the digit strings of one length: an unbalanced Feistel network, each round adds to one half."""

    def network(d: Column) -> Column:
        half = F.floor(F.length(d) / 2).cast("int")
        left, right = F.substr(d, F.lit(1), half), F.substr(d, half + 1)
        state = F.struct(left.alias("l"), right.alias("r"))

        def add(x: Column, other: Column, k: Column) -> Column:
            size = _power(F.length(x))
            moved = F.pmod(F.coalesce(x.cast("long"), F.lit(0)) + F.pmod(_hash(key, tag, k.cast("string"), F.length(x).cast("string"), other), size), size)
            return F.when(F.length(x) > 0, F.lpad(moved.cast("string"), F.length(x), "0")).otherwise(x)

        def turn(s: Column, k: Column) -> Column:
            return F.struct(
                F.when(k % 2 == 0, add(s["l"], s["r"], k)).otherwise(s["l"]).alias("l"),
                F.when(k % 2 == 1, add(s["r"], s["l"], k)).otherwise(s["r"]).alias("r"),
            )

        return F.aggregate(F.sequence(F.lit(0), F.lit(FEISTEL_ROUNDS - 1)), state, turn, lambda s: F.concat(s["l"], s["r"]))

    return _let(digits, network)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _refilled(value: Column, fresh: Column, skip: Column | int = 0) -> Column:
    """``value`` with its digits, after the first ``skip`` ones, replaced by those of ``fresh``."""

    def one(c: Column, i: Column) -> Column:
        before = F.length(_digits(F.substr(value, F.lit(1), i)))
        return F.when(c.rlike("^[0-9]$") & (before >= skip), F.substr(fresh, before - skip + 1, F.lit(1))).otherwise(c)

    return F.array_join(F.transform(F.split(value, ""), one), "")


def _luhn(payload: Column) -> Column:
    """The check digit of a card number's other digits."""
    doubled = F.transform(
        F.split(F.reverse(payload), ""),
        lambda c, i: _let(F.coalesce(c.cast("int"), F.lit(0)) * F.when(i % 2 == 0, 2).otherwise(1), lambda d: F.when(d > 9, d - 9).otherwise(d)),
    )
    return F.pmod(F.lit(10) - F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10, F.lit(10))


def _card(value: Column, key: str, tag: Column) -> Column:
    def fresh(d: Column) -> Column:
        payload = F.substr(d, F.lit(1), F.length(d) - 1)
        offset = F.pmod(F.substr(d, F.length(d)).cast("int") - _luhn(payload), F.lit(10))
        return _let(_permuted(payload, key, tag), lambda p: F.concat(p, F.pmod(_luhn(p) + offset, F.lit(10)).cast("string")))

    return _refilled(value, _let(_digits(value), fresh))


def _phone(value: Column, key: str, tag: Column) -> Column:
    code = F.length(F.regexp_extract(value, r"^\+([0-9]{1,3})(?![0-9])", 1))
    return _refilled(value, _permuted(F.substr(_digits(value), code + 1), key, tag), code)


def _ip(value: Column, key: str, tag: Column) -> Column:
    octets = F.transform(F.split(value, r"\."), lambda x: x.cast("long"))
    halves = F.struct((F.get(octets, F.lit(0)) * 256 + F.get(octets, F.lit(1))).alias("l"), (F.get(octets, F.lit(2)) * 256 + F.get(octets, F.lit(3))).alias("r"))
    turn = lambda s, k: F.struct(s["r"].alias("l"), ((s["l"] + _hash(key, tag, k.cast("string"), s["r"].cast("string"))) % 65536).alias("r"))
    text = lambda s: F.concat_ws(".", (s["l"] / 256).cast("long"), s["l"] % 256, (s["r"] / 256).cast("long"), s["r"] % 256)
    return F.aggregate(F.sequence(F.lit(0), F.lit(FEISTEL_ROUNDS - 1)), halves, turn, text)


def _scrambled(value: Column, key: str, tag: Column) -> Column:
    """Each letter and digit replaced by one of its alphabet; what is in none of them and is a letter becomes a Latin one."""

    def one(c: Column, i: Column, digest: Column) -> Column:
        number = _hash(key, tag, digest, i.cast("string"))
        out = F.when(c.rlike(r"^\p{Lu}$"), _pick(ALPHABETS[2][1], number)).when(c.rlike(r"^\p{L}$"), _pick(ALPHABETS[1][1], number)).otherwise(c)
        for pattern, letters in reversed(ALPHABETS[3:]):
            out = F.when(c.rlike(f"^{pattern}$") & c.rlike(r"^\p{L}$"), _pick(letters, number)).otherwise(out)
        for pattern, letters in reversed(ALPHABETS[:3]):
            out = F.when(c.rlike(f"^{pattern}$"), _pick(letters, number)).otherwise(out)
        return out

    return _let(F.sha2(value, 256), lambda digest: F.array_join(F.transform(F.split(value, ""), lambda c, i: one(c, i, digest)), ""))


def _email_domain_lower(value: Column) -> Column:
    """Addresses that differ in the case of the domain alone are one."""
    return F.concat(F.substring_index(value, "@", 1), F.lit("@"), F.lower(F.substring_index(value, "@", -1)))


def _ip6(value: Column, key: str, tag: Column) -> Column:
    """Hexadecimal digits exchanged one by one; groups and their lengths stay."""
    digits = lambda c, i: _pick("0123456789abcdef", _hash(key, tag, "ip6", F.sha2(F.lower(value), 256), i.cast("string")))
    shown = lambda c, i: F.when(c.rlike("^[A-F]$") | (value == F.upper(value)), F.upper(digits(c, i))).otherwise(digits(c, i))
    return F.array_join(F.transform(F.split(value, ""), lambda c, i: F.when(c == ":", c).otherwise(shown(c, i))), "")


def _iban(value: Column, key: str, tag: Column) -> Column:
    """The country stays; digits and letters of the account are exchanged, and the check digits follow from them."""
    country, account = F.substr(value, F.lit(1), F.lit(2)), F.substr(value, F.lit(5))
    letters = _scrambled(F.regexp_replace(account, "[0-9]", "0"), key, F.concat(tag, F.lit("iban"), F.sha2(value, 256)))
    # Digits come from the permutation, so that accounts of digits never meet.
    mixed = F.array_join(F.zip_with(F.split(account, ""), F.split(letters, ""), lambda a, x: F.when(a.rlike("^[A-Z]$"), x).otherwise(a)), "")
    fresh = _refilled(mixed, _permuted(_digits(account), key, tag))

    def check(text: Column) -> Column:
        plain = F.split(F.concat(F.regexp_replace(text, " ", ""), country, F.lit("00")), "")
        number = lambda c: F.conv(c, 36, 10).cast("int")
        rest = F.aggregate(plain, F.lit(0), lambda a, c: F.pmod(a * F.when(number(c) > 9, 100).otherwise(10) + number(c), F.lit(97)))
        return F.lpad((98 - rest).cast("string"), 2, "0")

    return _let(fresh, lambda text: F.concat(country, check(text), text))


def _email(value: Column, key: str, tag: Column) -> Column:
    """The domain depends on the domain alone and ends in a reserved name; a further attempt shows in the local part."""
    local, domain = F.substring_index(value, "@", 1), F.substring_index(value, "@", -1)
    lower = F.lower(F.regexp_replace(domain, r"\.[^.]*$", ""))
    fresh = F.concat(_scrambled(lower, key, F.lit("domain")), F.lit(".example"))
    more = F.when(tag == "0", "").otherwise(tag)
    return F.concat(_scrambled(local, key, F.concat(tag, F.lit("@"), F.lower(domain))), more, F.lit("@"), fresh)


def _secret(value: Column, key: str, tag: Column) -> Column:
    """As many digits as the value has, from digests of its own digest."""
    part = lambda digest, k: F.sha2(F.concat_ws("\x1f", F.lit(key), tag, k.cast("string"), digest), 256)
    blocks = F.sequence(F.lit(0), F.floor((F.length(value) - 1) / 64).cast("int"))
    fresh = _let(F.sha2(value, 256), lambda digest: F.substr(F.array_join(F.transform(blocks, lambda k: part(digest, k)), ""), F.lit(1), F.length(value)))
    return F.when(value == F.upper(value), F.upper(fresh)).otherwise(fresh)


def _name_part(part: Column, key: str, attempt: Column, kind: Column) -> Column:
    """A made-up name of the part's script; ``kind`` is 0 male, 1 female, 2 family name, 3 given name of either. Each attempt has one more
    syllable. Scripts without syllables have letters exchanged, and each attempt adds the first one again."""

    def of(script: str) -> Column:
        starts, middles, ends = SYLLABLES[script]
        number = lambda k: _hash(key, "name", kind.cast("string"), attempt.cast("string"), part, k)
        more = F.transform(F.sequence(F.lit(1), attempt), lambda k: _pick(starts, number(k.cast("string"))))
        n = number("last")
        last = F.when(kind == 0, _pick(ends[0], n)).when(kind == 1, _pick(ends[1], n)).when(kind == 3, _pick(ends[3], n)).otherwise(_pick(ends[2], n))
        return F.initcap(F.concat(_pick(starts, number("first")), _pick(starts, number("second")), F.when(attempt > 0, F.array_join(more, "")).otherwise(""), _pick(middles, number("middle")), last))

    other = _scrambled(part, key, F.concat(F.lit("name"), kind.cast("string")))
    other = F.concat(other, F.repeat(F.substr(other, F.lit(1), F.lit(1)), attempt))
    out = F.when(part.rlike(r"\p{IsCyrillic}"), of("cyrillic")).when(part.rlike(r"\p{IsGreek}"), of("greek"))
    return out.when(part.rlike(r"\p{IsLatin}"), of("latin")).otherwise(other)


def kind_of(value: Column) -> Column:
    return reduce(lambda out, k: F.when(value.rlike(f"^(?:{PATTERNS[k]})$"), k).otherwise(out), reversed(list(PATTERNS)), F.lit("card"))


def surrogate(kind: Column, value: Column, attempt: Column, key: str) -> Column:
    tag = attempt.cast("string")
    out = F.when(kind == "email", _email(value, key, tag)).when(kind == "ip", _ip(value, key, tag)).when(kind == "secret", _secret(value, key, tag))
    out = out.when(kind == "card", _card(value, key, tag)).when(kind == "phone", _phone(value, key, tag))
    out = out.when(kind == "iban", _iban(value, key, tag)).when(kind == "ip6", _ip6(value, key, tag))
    out = out.otherwise(_refilled(value, _permuted(_digits(value), key, tag)))
    return F.when(attempt < ATTEMPTS, out).otherwise(F.concat(out, F.lit("-"), F.substr(F.sha2(F.concat(F.lit(key), value), 256), F.lit(1), F.lit(16))))


def _settled(found: DataFrame, taken: DataFrame, form) -> DataFrame:
    """``found`` (value and others) with ``form`` of it and the attempt as surrogate, all different and none of them in ``taken``."""
    made = lambda df: df.withColumn("surrogate", form(F.col("attempt")))
    table = written(made(found.withColumn("attempt", F.lit(0))), "surrogates")
    while True:  # each round raises the attempt of some, and that ends in forms of their own
        least = table.groupBy("surrogate").agg(F.min("value").alias("first"), F.count("*").alias("n"))
        again = table.join(least.filter("n > 1"), "surrogate").filter("value != first").select("value")
        real = table.join(taken, "surrogate", "left_semi").select("value")
        clashes = written(again.unionByName(real).distinct(), "clashes")
        n = clashes.count()
        if not n:
            return table
        marked = table.join(maybe_broadcast(clashes.withColumn("clash", F.lit(1)), n), "value", "left")
        table = written(made(marked.withColumn("attempt", F.col("attempt") + F.coalesce("clash", F.lit(0))).select(*found.columns, "attempt")), "surrogates")


def _initials(value: Column, key: str) -> Column:
    """Capital letters exchanged by a keyed rotation of their alphabet: different ones stay different."""
    for letters in ROTATED:
        turn = 1 + int(hashlib.sha256(f"{key}\x1finitials".encode()).hexdigest(), 16) % (len(letters) - 1)
        value = F.translate(value, letters, letters[turn:] + letters[:turn])
    return value


def _names(names: DataFrame, key: str) -> DataFrame:
    """(value, kind, surrogate, parts) of distinct names: titles, particles and white space are kept, and each given name of a gender and
    each family name has one made-up name, in capitals where the part is. No two of a role share one and none is a part of a name in the corpus,
    so full names don't meet either. Parts that differ in case otherwise are different names, and one of them shares its made-up name with the
    capitals. ``parts`` lists (part, shown)."""
    titles = F.regexp_extract(F.col("value"), f"^{TITLES}", 0)
    gender = F.when(titles.rlike(rf"(?<!\p{{L}})(?:{FEMALE})(?!\p{{L}})"), 1).when(titles.rlike(rf"(?<!\p{{L}})(?:{MALE})(?!\p{{L}})"), 0).otherwise(3)
    rest = F.substr(F.col("value"), F.length(titles) + 1)
    cut = names.select("value", titles.alias("titles"), gender.alias("gender"), F.regexp_extract_all(rest, F.lit(r"[^\s\x{A0}]+"), F.lit(0)).alias("words"), F.regexp_extract_all(rest, F.lit(r"[\s\x{A0}]+"), F.lit(0)).alias("gaps"))
    is_part = lambda w: w.rlike(f"^{PART}$")
    cut = written(cut.withColumn("last", F.array_max(F.filter(F.transform("words", lambda w, i: F.when(is_part(w), i)), lambda i: i.isNotNull()))), "names-cut")
    split = cut.select("value", "gender", "last", F.posexplode("words").alias("place", "part")).filter(is_part(F.col("part")))
    role = F.when(F.col("place") == F.col("last"), 2).otherwise(F.col("gender"))
    split = written(split.select("value", "place", "part", role.alias("role")), "name-mentions")
    lower = F.lower("part")
    capital = (F.col("part") == F.upper(lower)) & (F.length("part") > 1) & (F.col("part") != lower)
    distinct = written(split.select("role", "part").distinct().select("role", "part", lower.alias("lower"), capital.alias("capital")), "name-parts")
    main = distinct.groupBy("role", "lower").agg(F.max(F.when(~F.col("capital"), F.col("part"))).alias("main"))
    own = F.when(F.col("capital") | (F.col("part") == F.col("main")), F.col("lower")).otherwise(F.col("part"))
    keyed = written(distinct.join(main, ["role", "lower"]).select("role", "part", "capital", F.concat_ws(" ", F.col("role").cast("string"), own).alias("own")), "name-keys")
    tagged = lambda role, x: F.concat_ws(" ", role.cast("string"), F.lower(x))
    found = keyed.select(F.col("own").alias("value"), "role").distinct()
    form = lambda attempt: tagged(F.col("role"), _name_part(F.substring_index("value", " ", -1), key, attempt, F.col("role")))
    # No made-up name is a real one of any role.
    real = distinct.select(F.explode(F.array(*[tagged(F.lit(r), F.col("part")) for r in range(4)])).alias("surrogate")).distinct()
    settled = _settled(found, real, form)
    shown = F.initcap(F.substring_index("surrogate", " ", -1))
    shown = F.when(F.col("capital"), F.upper(shown)).otherwise(shown)
    fresh = written(keyed.join(settled.select(F.col("value").alias("own"), "surrogate"), "own").select("role", "part", shown.alias("shown")), "name-surrogates")
    exchanged = split.join(maybe_broadcast(fresh), ["role", "part"]).groupBy("value").agg(F.collect_list(F.struct("place", "role", "part", "shown")).alias("parts"))
    built = cut.join(exchanged, "value", "left").withColumn("made", F.map_from_entries(F.transform(F.coalesce("parts", F.array().cast("array<struct<place:int,role:int,part:string,shown:string>>")), lambda x: F.struct(x["place"], x["shown"]))))
    initials = lambda w: F.when(w.rlike(f"^{INITIALS}$"), _initials(w, key)).otherwise(w)
    words = F.transform("words", lambda w, i: F.concat(F.coalesce(F.element_at("made", i), initials(w)), F.coalesce(F.get("gaps", i), F.lit(""))))
    return built.select("value", F.lit("name").alias("kind"), F.concat("titles", F.array_join(words, "")).alias("surrogate"), "parts")


PARTS = "array<struct<place:int,role:int,part:string,shown:string>>"


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """(value, kind, surrogate, parts) of the distinct values, all surrogates different and none of them a value."""
    found = written(entities.select("value").distinct().select("value", kind_of(F.col("value")).alias("kind")), "entities")
    one = F.when(F.col("kind") == "email", _email_domain_lower(F.col("value"))).otherwise(F.col("value"))
    canonical = written(found.filter("kind != 'name'").select("value", "kind", one.alias("one")), "canonical")
    taken = found.select(F.col("value").alias("surrogate")).unionByName(canonical.select(F.col("one").alias("surrogate"))).distinct()
    # Dealt by value: the entities of a small file are not made in one task.
    distinct = canonical.select(F.col("one").alias("value"), "kind").distinct().repartition(shuffle_partitions(entities.sparkSession), "value")
    table = _settled(distinct, taken, lambda attempt: surrogate(F.col("kind"), F.col("value"), attempt, key))
    table = canonical.join(table.select(F.col("value").alias("one"), "surrogate"), "one").select("value", "kind", "surrogate", F.lit(None).cast(PARTS).alias("parts"))
    names = found.filter("kind = 'name'")
    return table if names.isEmpty() else table.unionByName(written(_names(names, key), "names"))


def _later_mentions(piece: Column, known: Column) -> Column:
    """Parts of names that stand in text without a title: what stands between them, and what they become."""
    words = F.regexp_extract_all(piece, F.lit(PART), F.lit(0))
    shown = lambda w: F.coalesce(F.element_at(known, w), F.when(w == F.upper(w), F.upper(F.element_at(known, F.initcap(F.lower(w))))), w)
    return _let(words, lambda ws: F.array_join(F.transform(F.split(piece, PART), lambda gap, i: F.concat(gap, F.coalesce(shown(F.get(ws, i)), F.lit("")))), ""))


def _mentioned(piece: Column, known: Column) -> Column:
    """How many such parts there are."""
    has = lambda w: F.element_at(known, w).isNotNull() | ((w == F.upper(w)) & F.element_at(known, F.initcap(F.lower(w))).isNotNull())
    return F.size(F.filter(F.regexp_extract_all(piece, F.lit(PART), F.lit(0)), has))


def pseudonymise(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` with entities replaced in the text, and n_replaced."""
    own = [c for c in docs.columns if c != "n_replaced"]
    text = F.col(text_col).cast("string")
    none = F.array().cast("array<string>")
    found = F.when(text.rlike(HINT), F.regexp_extract_all(text, F.lit(ANY), F.lit(0))).otherwise(none)
    # The caller's columns travel as one, so their names meet none of ours.
    rows = docs.select(F.struct(*own).alias("row"), text.alias("text"), F.xxhash64(id_col, text_col).alias("key"), found.alias("found"))
    back = lambda fresh: [(fresh if c == text_col else F.col("row").getField(c)).alias(c) for c in own]
    plain = rows.filter(F.coalesce(F.size("found"), F.lit(0)) == 0).select(*back(F.col("row").getField(text_col)), F.lit(0).cast("long").alias("n_replaced"))
    touched = written(rows.filter(F.size("found") > 0), "entity-rows")
    mentions = touched.select("key", F.explode(F.array_distinct("found")).alias("value")).distinct()
    table = surrogates(mentions, key)
    named = mentions.join(maybe_broadcast(table), "value").groupBy("key").agg(
        F.map_from_entries(F.collect_list(F.struct("value", "surrogate"))).alias("made"), F.flatten(F.collect_list("parts")).alias("parts")
    )
    # One made-up name for each part; that of a family name goes before that of a given one.
    ranked = F.sort_array(F.transform("parts", lambda x: F.struct(x["part"], F.when(x["role"] == 2, 0).otherwise(1 + x["role"]).alias("rank"), x["shown"])))
    first = F.filter(F.transform(ranked, lambda x, i: F.struct(x["part"], x["shown"], F.coalesce(F.get(ranked, i - 1)["part"] == x["part"], F.lit(False)).alias("again"))), lambda x: ~x["again"])
    known = F.map_from_entries(F.transform(first, lambda x: F.struct(x["part"], x["shown"])))
    joined = touched.join(named.withColumn("known", known), "key").withColumn("pieces", F.split("text", ANY))
    some = F.size("known") > 0
    pieces = F.transform("pieces", lambda p, i: F.concat(F.when(some, _later_mentions(p, F.col("known"))).otherwise(p), F.coalesce(F.element_at("made", F.get("found", i)), F.lit(""))))
    more = F.when(some, F.aggregate("pieces", F.lit(0), lambda n, p: n + _mentioned(p, F.col("known")))).otherwise(0)
    fresh = joined.select("row", F.array_join(pieces, "").alias("fresh"), (F.size("found") + more).cast("long").alias("n"))
    return fresh.select(*back(F.col("fresh")), F.col("n").alias("n_replaced")).unionByName(plain)
