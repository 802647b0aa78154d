"""Word shingles of whole texts as sets of 64-bit hashes."""

from __future__ import annotations

import numpy as np

WIDTH = 5
GOLDEN = 0x9E3779B97F4A7C15
#: The ASCII white space that parts words.
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes hashed at once, if no word is longer.
CHUNK = 1 << 20


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(29))


#: Odd multipliers of the places in a shingle. They are scrambled: with multiples of one number, shingles such as
#: "a b b a x" and "b a a b x" would have the same hash.
PLACES = mixed(np.arange(1, WIDTH + 1, dtype=np.uint64) * np.uint64(GOLDEN)) | np.uint64(1)


def distinct(values: np.ndarray) -> np.ndarray:
    """The distinct values, ascending."""
    values = np.sort(values)
    keep = np.ones(len(values), bool)
    np.not_equal(values[1:], values[:-1], out=keep[1:])
    return values[keep]


_BYTES = mixed(mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(GOLDEN)))
_BASE = 0xD1342543DE82EF95
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2^64, at least ``n`` of each."""
    if len(_POWERS[0]) < n:
        size = max(n, CHUNK + 1)
        for i, base in enumerate((_BASE, pow(_BASE, -1, 2**64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[i] = np.multiply.accumulate(steps)
    return _POWERS[0], _POWERS[1]


def hashed_words(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of each word between ASCII white space, with A-Z lower-cased (as bytes.lower does)."""
    raw = np.frombuffer(text.lower(), np.uint8)
    if len(raw) <= CHUNK:
        return _hashed(raw)
    parts, begin = [], 0
    while begin < len(raw):
        end = min(begin + CHUNK, len(raw))
        if end < len(raw):
            # Cut after white space; a longer word makes a longer chunk.
            spaces = np.nonzero(IS_SPACE[raw[begin:end]])[0]
            if len(spaces):
                end = begin + int(spaces[-1]) + 1
            else:
                after = np.nonzero(IS_SPACE[raw[end:]])[0]
                end = end + int(after[0]) + 1 if len(after) else len(raw)
        hashes, starts = _hashed(raw[begin:end])
        parts.append((hashes, starts + begin))
        begin = end
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def _hashed(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = len(raw)
    inside = np.zeros(n + 2, bool)
    np.logical_not((raw == 0x20) | (raw - np.uint8(0x09) < 5), out=inside[1:-1])
    turns = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = turns[0::2], turns[1::2]
    up, down = powers(n + 1)
    # A word's hash is a polynomial of its bytes, from sums over the text: it does not depend on the word's place.
    sums = np.zeros(n + 1, np.uint64)
    part = sums[1:]
    np.take(_BYTES, raw, out=part, mode="clip")
    np.multiply(part, up[:n], out=part)
    np.cumsum(part, out=part)
    hashes = (sums[ends] - sums[starts]) * down[starts]
    return mixed(hashes + (ends - starts).astype(np.uint64)), starts


def rolled(words: np.ndarray) -> np.ndarray:
    """One hash for each run of WIDTH words."""
    n = len(words) - WIDTH + 1
    total = words[:n] * PLACES[0]
    for i in range(1, WIDTH):
        total += words[i : i + n] * PLACES[i]
    return mixed(total)


def sequence_hashes(words: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Hash of each sequence of words; the sequences lie one behind the other, none is empty."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    place = np.arange(len(words), dtype=np.uint64) - np.repeat(starts, lengths).astype(np.uint64)
    factors = mixed((place + np.uint64(1)) * np.uint64(GOLDEN)) | np.uint64(1)
    return mixed(np.add.reduceat(words * factors, starts) + lengths.astype(np.uint64) * np.uint64(GOLDEN))


def of_few(names: np.ndarray) -> np.ndarray:
    """The one token of each sequence shorter than a shingle, from its sequence hash."""
    return mixed(names + np.uint64(GOLDEN))


def shingles(text: bytes) -> np.ndarray:
    """The distinct shingles of a text, ascending; with fewer words than WIDTH, the whole sequence as one; without words, none."""
    words, _ = hashed_words(text)
    if not len(words):
        return words
    if len(words) < WIDTH:
        return of_few(sequence_hashes(words, np.zeros(1, np.int64), np.array([len(words)])))
    return distinct(rolled(words))
