"""Substring deduplication by recompression.

Rounds name runs of one token and pairs of neighbours, each name a hash of what it stands for, so names agree across the
whole corpus without a table of them. Whether two neighbours are joined depends on their names and a bit of each alone
(left and right halves of the alphabet, drawn anew each round), so equal substrings get equal interior symbols whatever
surrounds them. Rounds are restricted: a run or pair beyond a length limit waits, which bounds how far a symbol's context
reaches (``context``) and how long a symbol is (``longest``). Every window then holds whole interior symbols; the least
name among them is its anchor, and anchors that recur lead to the repeats (see ``repeats``).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from . import repeats
from .repeats import Scheme, mix

_U = np.uint64
#: Rounds in order of preference: (what is named, longest run or longest half of a pair, in words).
ROUNDS = [[("run", 2), ("pair", 2), ("pair", 2)], [("pair", 1), ("pair", 2)], [("pair", 1)], []]


def reach(rounds: list[tuple[str, int]]) -> tuple[int, int]:
    """(context, longest): words beside a boundary that decide it, and a symbol's greatest length."""
    context, longest = 0, 1
    for kind, limit in rounds:
        if kind == "run":  # up to the run's limit and one symbol beyond it
            context, longest = context + limit + longest, max(longest, limit)
        else:  # both neighbours in full
            context, longest = context + longest, max(longest, 2 * limit)
    return context, longest


def name_runs(sym: np.ndarray, pos: np.ndarray, span: np.ndarray, limit: int) -> tuple[np.ndarray, ...]:
    """Maximal runs of one symbol, of ``limit`` words at most, become one symbol named by symbol and count."""
    first = np.concatenate([[True], sym[1:] != sym[:-1]])
    at = np.flatnonzero(first)
    total = np.add.reduceat(span, at)
    count = np.diff(np.concatenate([at, [len(sym)]]))
    joined = (count > 1) & (total <= limit)
    in_run = np.repeat(joined, count)
    stay = ~in_run | first
    new_sym, new_span = sym.copy(), span.copy()
    new_sym[at[joined]] = mix(sym[at[joined]] + count[joined].astype(_U) * _U(0xA24BAED4963EE407))
    new_span[at[joined]] = total[joined]
    return new_sym[stay], pos[stay], new_span[stay]


def name_pairs(sym: np.ndarray, pos: np.ndarray, span: np.ndarray, limit: int, turn: int) -> tuple[np.ndarray, ...]:
    """Neighbours (left half, right half of the alphabet), each of ``limit`` words at most, become one symbol."""
    right = (sym >> _U(7 * turn + 5) & _U(1)).astype(bool)
    short = span <= limit
    joined = np.concatenate([(~right & short)[:-1] & (right & short)[1:], [False]])
    at = np.flatnonzero(joined)
    new_sym, new_span = sym.copy(), span.copy()
    new_sym[at] = mix(sym[at] * _U(0x9FB21C651E98DF25) + mix(sym[at + 1]))
    new_span[at] = span[at] + span[at + 1]
    stay = np.ones(len(sym), bool)
    stay[at + 1] = False
    return new_sym[stay], pos[stay], new_span[stay]


class Words(Scheme):
    """Words between ASCII white space; anchors are symbols of the last round, the least name first."""

    def __init__(self, window: int):
        self.window = window
        for rounds in ROUNDS:
            context, longest = reach(rounds)
            choice = window - 2 * context - longest + 1
            if choice >= longest:
                break
        self.rounds, self.before, self.choice, self.key = rounds, context, choice, longest + context

    def units(self, raw: bytes) -> np.ndarray:
        words = raw.split()
        return np.fromiter(map(xxhash.xxh64_intdigest, words), _U, len(words))

    def parse(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(names, first words, lengths) of the symbols after all rounds."""
        sym, pos, span = units, np.arange(len(units)), np.ones(len(units), "i4")
        for turn, (kind, limit) in enumerate(self.rounds):
            if len(sym):
                sym, pos, span = name_runs(sym, pos, span, limit) if kind == "run" else name_pairs(sym, pos, span, limit, turn)
        return sym, pos, span

    def ranked(self, units: np.ndarray) -> np.ndarray:
        sym, pos, _ = self.parse(units)
        out = np.full(len(units), np.iinfo(_U).max, _U)
        out[pos] = mix(sym) >> _U(1)
        return out


def _words_kept(raw: bytes, lo: np.ndarray, hi: np.ndarray) -> tuple[list[bytes], int]:
    words = raw.split()
    if not len(lo):
        return words, len(words)
    gone = repeats.covered(len(words), lo, hi)
    return [words[i] for i in np.flatnonzero(~gone).tolist()], len(words)


def _digest(raw: bytes, lo: np.ndarray, hi: np.ndarray) -> tuple:
    kept, n = _words_kept(raw, lo, hi)
    return n, n - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()


def _text(raw: bytes, lo: np.ndarray, hi: np.ndarray) -> tuple:
    return (b" ".join(_words_kept(raw, lo, hi)[0]).decode("utf-8", "replace"),)


def digests(docs: DataFrame, window: int = 35) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept_sha256, without every word that a recurring window covers.

    A window recurs if its word sequence starts anywhere else, same document included, judged on the input. Null and empty
    texts have no words; texts shorter than the window lose nothing; rows that repeat an id and a text count as copies.
    """
    rows, ranges = repeats.repeated_ranges(docs, Words(window))
    return repeats.finished(rows, ranges, _digest, [("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())], "n_words long, n_removed long, kept_sha256 string")


def deduplicate(docs: DataFrame, window: int = 35) -> DataFrame:
    """(doc_id, text): the words that are left, joined by one space."""
    rows, ranges = repeats.repeated_ranges(docs, Words(window))
    return repeats.finished(rows, ranges, _text, [("text", pa.string())], "text string")
