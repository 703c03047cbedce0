"""Splitting texts for the word-level BPE tokenizer file, shared by the encoders.

The file's pipeline is: NFC, white space to one space, lower case; pieces by a pattern; bytes spelt as printable
characters; BPE over a piece whose last character carries the word-end mark. White space never lies within a piece, so a
text may be cut at white space first: each cut ("chunk") has its own tokens, and natural text repeats chunks. Chunks of
printable ASCII and letters of Latin-1 are split here; all others go through the library's own normaliser and splitter,
whose Unicode tables are not Python's. For a column of texts, Arrow cuts and splits, and Python sees distinct pieces alone.
The caches below are bounded and only save time.
"""

from __future__ import annotations

import gc
import json
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

#: Fixed values of the tokenizer file: piece pattern (as it reads on lower-case ASCII and letters of Latin-1) and the mark of
#: a word's end.
PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|[^\sa-z0-9\xdf-\xf6\xf8-\xff]+")
#: Chunks of these characters are in the file's normal form but for their case.
_LATIN = regex.compile(r"[!-~\xc0-\xd6\xd8-\xf6\xf8-\xff]+")
WORD_END = "</w>"
#: What str.split() takes for white space although the file's pattern does not.
_CONTROL_SPACE = regex.compile("[\x1c-\x1f]")
_SPACE = regex.compile(r"\s+")
_MARKS = frozenset(".,;:!?")
#: Entries kept by each cache before it starts afresh; characters of the longest chunk or piece that is kept.
CACHE_ENTRIES, KEPT_LENGTH = 200_000, 256


def byte_spelling() -> list[str]:
    """Byte -> printable character: printable Latin-1 bytes stand for themselves, the rest follow from U+0100."""
    keep = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, spare = [""] * 256, 0x100
    for b in range(256):
        if b in set(keep):
            out[b] = chr(b)
        else:
            out[b], spare = chr(spare), spare + 1
    return out


_SPELT = dict(enumerate(byte_spelling()))


@contextmanager
def no_cycles() -> Iterator[None]:
    """Stop the cycle collector for a while: the caches hold many objects but no cycles, and it would walk them all."""
    gc.disable()
    try:
        yield
    finally:
        gc.enable()


def load_file(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def load_library(path: str, model: bool = True):
    """The library's tokenizer of a file, or only its normaliser and splitter. Its parallelism stays off: tasks share the cores."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    if model:
        return Tokenizer.from_file(path)
    spec = load_file(path)
    return Tokenizer.from_str(json.dumps(spec | {"added_tokens": [], "model": spec["model"] | {"vocab": {}, "merges": []}}))


def ascii_pieces(low: str) -> list[str]:
    """The pieces of a lower-case chunk of printable ASCII and letters of Latin-1; words before one mark, a usual case, need no pattern."""
    if low.isalpha():
        return [low]
    if low[-1] in _MARKS and low[:-1].isalpha():
        return [low[:-1], low[-1]]
    return PIECE.findall(low)


def spelt(piece: str) -> str:
    """A piece as the file asks for it: letters beyond ASCII are two bytes each."""
    return piece if piece.isascii() else piece.encode().decode("latin-1").translate(_SPELT)


def latin_pieces(low: str) -> list[str]:
    """The pieces of ``ascii_pieces``, spelt."""
    return [spelt(piece) for piece in ascii_pieces(low)]


def _starts(values: pa.Array) -> np.ndarray:
    """Where each value of a large binary array without an offset begins, and where the last one ends."""
    return np.frombuffer(values.buffers()[1], "<i8", len(values) + 1)


class ChunkEncoder:
    """Encodes whole texts by chunk, with a bounded chunk cache over a bounded piece cache.

    ``encode_pieces`` maps new pieces, their bytes spelt as the file asks, to their token ids (little-endian, 32 bits).
    Special tokens in a text become their own ids, as the library does by default.
    """

    def __init__(self, library, specials: dict[str, int], encode_pieces: Callable[[list[str]], Iterable[bytes]], entries: int | None = None):
        self.entries = entries or CACHE_ENTRIES
        self.specials = specials
        self.encode_pieces = encode_pieces
        self.special_split = regex.compile("(" + "|".join(map(regex.escape, specials)) + ")") if specials else None
        self.normalize, self.split = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        self.chunks: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def pieces_of(self, chunk: str) -> list[str]:
        if chunk.isascii() and chunk.isprintable():
            return ascii_pieces(chunk.lower())
        if _LATIN.fullmatch(chunk):
            return latin_pieces(chunk.lower())
        return [piece for piece, _ in self.split(self.normalize(chunk))]

    def _learn(self, needed: set[str]) -> None:
        """Make all of these chunks known. A full cache starts afresh before, never between, what one call needs."""
        new = needed.difference(self.chunks)
        if len(self.chunks) + len(new) > self.entries:
            self.chunks.clear()
            new = needed
        if not new:
            return
        get, slow = self.pieces.get, []
        for chunk in new:
            if chunk.isascii() and chunk.isprintable():
                low = chunk.lower()
                ids = get(low)  # what is known as a piece is that piece
                if ids is None and low[-1] in _MARKS and low[:-1].isalpha():
                    stem, mark = get(low[:-1]), get(low[-1])
                    ids = stem + mark if stem and mark else None
                if ids is not None:
                    self.chunks[chunk] = ids
                    continue
                slow.append((chunk, ascii_pieces(low)))
            else:
                slow.append((chunk, self.pieces_of(chunk)))
        pieces = {p for _, parts in slow for p in parts}
        fresh = pieces.difference(self.pieces)
        if len(self.pieces) + len(fresh) > self.entries:
            self.pieces.clear()
            fresh = pieces
        order = list(fresh)
        self.pieces.update(zip(order, self.encode_pieces(order), strict=True))
        known = self.pieces.__getitem__
        for chunk, parts in slow:
            self.chunks[chunk] = known(parts[0]) if len(parts) == 1 else b"".join(map(known, parts))
        for piece in order:
            if len(piece) > KEPT_LENGTH:
                del self.pieces[piece]

    def _chunks_of(self, text: str) -> list[str]:
        return _SPACE.split(text) if _CONTROL_SPACE.search(text) else text.split()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each whole text; null counts as empty. Callers pass a few MB at once."""
        cut: list[list[tuple[bytes, list[str]]]] = []
        new: set[str] = set()
        for text in texts:
            parts: list[tuple[bytes, list[str]]] = []
            if text:
                marked = self.special_split is not None and any(s in text for s in self.specials)
                for part in self.special_split.split(text) if marked else (text,):
                    if marked and part in self.specials:
                        parts.append((np.array([self.specials[part]], "<u4").tobytes(), []))
                    else:
                        words = self._chunks_of(part)
                        new.update(words)
                        parts.append((b"", words))
            cut.append(parts)
        new.discard("")
        with no_cycles():
            self._learn(new)
        out = [self._join(parts) for parts in cut]
        for chunk in new:
            if len(chunk) > KEPT_LENGTH:
                del self.chunks[chunk]
        return out

    def encode_column(self, texts: pa.Array) -> list[bytes]:
        """The same for a column: Arrow cuts texts at ASCII's white space, finds the distinct chunks and puts ids in the texts' order."""
        texts = pc.fill_null(texts, "")
        marked = np.zeros(len(texts), bool)
        for special in self.specials:
            marked |= pc.match_substring(texts, special).to_numpy(zero_copy_only=False)
        if marked.any():  # special tokens may stand within chunks
            plain = iter(self.encode_column(texts.filter(pa.array(~marked))))
            other = iter(self.encode(texts.filter(pa.array(marked)).to_pylist()))
            return [next(other if m else plain) for m in marked.tolist()]
        cut = pc.ascii_split_whitespace(texts)
        coded = cut.flatten().dictionary_encode()
        chunks = coded.dictionary
        own = pc.match_substring_regex(chunks, rf"\A(?:{_LATIN.pattern})?\z")
        place = np.empty(len(chunks), "i8")  # those that are split here first, then all others
        here = own.to_numpy(zero_copy_only=False)
        place[here], place[~here] = np.arange(own.true_count), np.arange(own.true_count, len(chunks))
        known = pa.concat_arrays([self._latin_ids(chunks.filter(own)), self._other_ids(chunks.filter(pc.invert(own)))])
        ids = known.take(pa.array(place[coded.indices.to_numpy()]))
        ends = _starts(ids)[np.cumsum(cut.value_lengths().to_numpy())].tolist()
        image = memoryview(ids.buffers()[2] or b"")
        return [bytes(image[a:b]) for a, b in zip([0, *ends], ends, strict=False)]

    def _latin_ids(self, chunks: pa.Array) -> pa.Array:
        """Ids of chunks of printable ASCII and letters of Latin-1 (or empty ones): Arrow splits them as ``ascii_pieces`` does.

        Their pieces are kept unspelt beside the spelt ones of other chunks: what is spelt otherwise than it reads has a
        character for a byte from 0x80 to 0xBF, and none of these is a letter of Latin-1.
        """
        low = pc.utf8_lower(chunks.cast(pa.large_string()))
        split = pc.ascii_split_whitespace(pc.ascii_rtrim_whitespace(pc.replace_substring_regex(low, PIECE.pattern, r"\0 ")))
        coded = split.flatten().dictionary_encode()
        pieces = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = [ids if p else b"" for p, ids in zip(pieces, map(self.pieces.get, pieces), strict=True)]
        new = [i for i, ids in enumerate(found) if ids is None]
        if len(self.pieces) + len(new) > self.entries:
            self.pieces.clear()
        with no_cycles():
            for i, ids in zip(new, self.encode_pieces([spelt(pieces[i]) for i in new]), strict=True):
                found[i] = ids
                if len(pieces[i]) <= KEPT_LENGTH:
                    self.pieces[pieces[i]] = ids
        ids = pa.array(found, pa.large_binary()).take(coded.indices)
        starts = _starts(ids)[np.concatenate([[0], np.cumsum(split.value_lengths().to_numpy())])]
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(chunks), [None, pa.py_buffer(starts), ids.buffers()[2] or pa.py_buffer(b"")])

    def _other_ids(self, chunks: pa.Array) -> pa.Array:
        """Ids of all other chunks; those that are new are cut again, at white space beyond ASCII's."""
        words = chunks.to_numpy(zero_copy_only=False).tolist()
        found = list(map(self.chunks.get, words))
        new = [i for i, ids in enumerate(found) if ids is None]
        for i, ids in zip(new, self.encode([words[i] for i in new]), strict=True):
            found[i] = ids
        return pa.array(found, pa.large_binary())

    def _join(self, parts: list[tuple[bytes, list[str]]]) -> bytes:
        get = self.chunks.__getitem__
        return b"".join(special or b"".join(map(get, filter(None, words))) for special, words in parts)
