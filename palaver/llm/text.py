"""Words and rolling hashes of whole texts, as numpy arrays."""

from __future__ import annotations

import hashlib

import numpy as np

WORD = np.uint64
STEP = 0x9E3779B97F4A7C15
#: Words hashed at once, so that a very long text needs no more memory than its bytes and this.
CHUNK_WORDS = 1 << 16
#: Words whose numbers a task keeps at hand.
KNOWN_WORDS = 1 << 18
#: Words of a text whose numbers are kept; longer texts are numbered by chunk each time.
HELD_WORDS = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over all bits (a bijection)."""
    x = np.asarray(x, WORD)
    x = (x ^ (x >> WORD(30))) * WORD(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> WORD(27))) * WORD(0x94D049BB133111EB)
    return x ^ (x >> WORD(31))


def normalised(text: str | None, table: bytes | None = None) -> bytes:
    """The words of a text joined by single spaces; ``table`` maps bytes first. Words are split at
    the bytes 20 and 09-0D. Null gives no words."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    if table is not None:
        raw = raw.translate(table)
    return b" ".join(raw.split())


def word_table(is_word_byte) -> bytes:
    """Maps A-Z to a-z and every byte that is in no word to a space."""
    lower = bytes(range(256)).lower()
    return bytes(b if is_word_byte(b) else 32 for b in lower)


def bounds(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of each word of normalised bytes."""
    if not raw:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    gaps = np.flatnonzero(np.frombuffer(raw, np.uint8) == 32)
    return np.concatenate(([0], gaps + 1)), np.concatenate((gaps, [len(raw)]))


class Tokens(dict):
    """The number of a word: 64 bits of its BLAKE2 digest, so that no two words are made to meet."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        self[word] = number = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return number


class Numbered:
    """The numbers of the words of texts; those of the last text stay, as it is often hashed several times."""

    def __init__(self):
        self.tokens, self.raw, self.numbers = Tokens(), b"", np.zeros(0, WORD)

    def __reduce__(self):
        return Numbered, ()  # functions that travel to the tasks take none of it along

    def of(self, raw: bytes, first: int, end: int, size: int) -> np.ndarray:
        words = raw[first:end].split(b" ")
        return np.fromiter(map(self.tokens.__getitem__, words), WORD, size)

    def whole(self, raw: bytes, size: int) -> np.ndarray:
        if raw is not self.raw:
            self.numbers, self.raw = self.of(raw, 0, len(raw), size), raw
        return self.numbers


#: Of the process: the hashes of all seeds share them.
NUMBERED = Numbered()


class Roller:
    """Rabin-Karp hashes modulo 2^64 of every window of k words.

    A word is a number (``Tokens``), mixed with the seed, and a position a power of an odd base; prefix sums give the hash of any
    window, and the inverse power moves it to position 0. Equal word sequences have equal hashes wherever they stand; the result
    is spread over all bits.
    """

    def __init__(self, seed: int):
        self.offset = (seed * STEP) % 2**64
        self.base = int(mix(np.array([self.offset], WORD))[0]) // 8 * 8 + 5
        self._start()

    def _start(self) -> None:
        powers = np.full(CHUNK_WORDS + 1, self.base, WORD)
        inverses = np.full(CHUNK_WORDS + 1, pow(self.base, -1, 2**64), WORD)
        powers[0] = inverses[0] = 1
        self.powers, self.inverses = np.cumprod(powers, dtype=WORD), np.cumprod(inverses, dtype=WORD)

    def __getstate__(self):
        return {"offset": self.offset, "base": self.base}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._start()

    def windows(self, raw: bytes, k: int) -> np.ndarray:
        """A hash for each start of k consecutive words; none if there are fewer words."""
        starts, ends = bounds(raw)
        n = len(starts) - k + 1
        if n <= 0:
            return np.zeros(0, WORD)
        parts, step = [], max(1, CHUNK_WORDS - k + 1)
        held = NUMBERED.whole(raw, len(starts)) if len(starts) <= HELD_WORDS else None
        for at in range(0, n, step):
            size = min(n - at, step) + k - 1
            numbers = NUMBERED.of(raw, starts[at], ends[at + size - 1], size) if held is None else held[at : at + size]
            prefix = np.zeros(size + 1, WORD)
            np.cumsum(mix(numbers + WORD(self.offset)) * self.powers[:size], out=prefix[1:])
            parts.append(mix((prefix[k:] - prefix[:-k]) * self.inverses[: size - k + 1]))
        return np.concatenate(parts)

    def sequence(self, raw: bytes, k: int) -> np.ndarray:
        """As ``windows``, but fewer words than k, if there are any, are one window."""
        n = raw.count(b" ") + 1 if raw else 0
        return self.windows(raw, min(k, n)) if n else np.zeros(0, WORD)


def covered(starts_hit: np.ndarray, k: int, n_words: int) -> np.ndarray:
    """Which words lie in a window of k words whose start is marked."""
    edge = np.zeros(n_words + 1, np.int64)
    at = np.flatnonzero(starts_hit)
    np.add.at(edge, at, 1)
    np.add.at(edge, np.minimum(at + k, n_words), -1)
    return np.cumsum(edge[:-1]) > 0
