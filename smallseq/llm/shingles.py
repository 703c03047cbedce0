"""Word shingles and their fingerprints. Words lie between ASCII white space, A-Z lowered."""

from __future__ import annotations

from functools import partial

import numpy as np
import xxhash

_U = np.uint64
_SLICE = 1 << 16
hash64 = partial(xxhash.xxh64_intdigest, seed=42)


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (the splitmix64 finaliser)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def shingle_set(text: str | None, words: int = 5) -> np.ndarray:
    """Distinct hashes (uint64, ascending) of the word shingles, made from the words' hashes; a shorter text is one shingle."""
    parts = words_of(text)
    if len(parts) < words:
        return np.array([hash64(b" ".join(parts))], _U)
    one = np.fromiter(map(hash64, parts), _U, len(parts))
    n = len(parts) - words + 1
    out = one[:n]
    for i in range(1, words):
        out = mix(out * _U(0x9E3779B97F4A7C15) + one[i : n + i])
    return np.unique(out)


def simhash(hashes: np.ndarray) -> int:
    """The unsigned fingerprint of 64-bit hashes: a bit is 1 if it is set in over half of them."""
    ones = np.zeros(64, "i8")
    for at in range(0, len(hashes), _SLICE):
        bits = np.unpackbits(hashes[at : at + _SLICE].astype("<u8").view("u1").reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype="i4")
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])
