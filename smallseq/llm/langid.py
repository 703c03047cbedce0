"""Language identification of whole and mixed texts: script ranges, word scores, a Viterbi path with a switching penalty.

The script of each run of letters leaves the languages that are written in it; each of these scores the run by its character
n-grams, and a word by its runs; what a word can say grows with its letters, so that text without spaces counts too. The
best path over a text's words, where changing the language costs ``SWITCH``, labels spans. A text's language is the one of
most letters on its path, its score the share of those letters.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import groupby

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .batches import by_volume, hold, lean, only
from .common import materialise, remove, row_key, ship

#: First code point of each script range (Unicode blocks; what lies between takes the range before).
SCRIPT_STARTS = [
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"), (0x0600, "arabic"), (0x0780, "other"),
    (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "other"), (0x0B80, "tamil"), (0x0C00, "other"), (0x0E00, "thai"), (0x0E80, "other"),
    (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "other"), (0x1C80, "cyrillic"), (0x1C90, "georgian"), (0x1CC0, "other"), (0x1D00, "latin"), (0x1F00, "greek"),
    (0x2000, "other"), (0x2C60, "latin"), (0x2C80, "other"), (0x2DE0, "cyrillic"), (0x2E00, "other"), (0x3040, "kana"), (0x3100, "other"), (0x3130, "hangul"),
    (0x3190, "other"), (0x3400, "han"), (0xA000, "other"), (0xA640, "cyrillic"), (0xA6A0, "other"), (0xA720, "latin"), (0xA800, "other"), (0xAC00, "hangul"),
    (0xD800, "other"), (0xF900, "han"), (0xFB00, "latin"), (0xFB1D, "hebrew"), (0xFB50, "arabic"), (0xFE00, "other"), (0xFF21, "latin"), (0xFF66, "kana"), (0xFFA0, "hangul"), (0xFFE0, "other"), (0x20000, "han"), (0x32000, "other"),
]
_STARTS, _NAMES = [s for s, _ in SCRIPT_STARTS], [n for _, n in SCRIPT_STARTS]
SCRIPTS = sorted(set(_NAMES))
_SCRIPT = {name: i for i, name in enumerate(SCRIPTS)}
LETTERS = regex.compile(r"\p{L}+")
#: The bounded sample that is learned from: documents of each language, by smallest hash. Size of the model: n-grams of each
#: language (the most frequent). The n-grams' lengths (see grams_of); a script is a language's if so large a share of its
#: letters is in it.
SAMPLE_DOCS, LANGUAGE_GRAMS, GRAMS, SCRIPT_SHARE = 1000, 20_000, (1, 3), 0.01
#: Log scores: the cost of changing the language, the most that so many letters can say, the letters, the smoothing.
SWITCH, CLIP, CLIP_LETTERS, SMOOTH = 10.0, 8.0, 8, 0.5
#: Words cached by a worker before it starts afresh, and the longest that is kept.
CACHE_WORDS, KEPT_LENGTH = 200_000, 256
#: Texts are judged in slices of about so many bytes, which take some 30 times as much.
TASK_BYTES = 1 << 20
UNDETERMINED = "und"


def script_of(letter: str) -> int:
    return _SCRIPT[_NAMES[bisect_right(_STARTS, ord(letter)) - 1]]


def grams_of(word: str) -> list[str]:
    w = f" {word} "
    return [*word, *map("".join, zip(w, w[1:], w[2:]))]


def letters_of(word: str) -> list[str]:
    """The runs of letters; words, and words before one mark, need no pattern."""
    if word.isalpha():
        return [word]
    if word[:-1].isalpha() and not word[-1].isalpha():
        return [word[:-1]]
    return LETTERS.findall(word)


def script_runs(word: str) -> list[tuple[str, int]]:
    """The runs of letters of one script each, with that script."""
    if word.isascii():
        return [(run, _SCRIPT["latin"]) for run in letters_of(word)]
    return [("".join(run), script) for letters in letters_of(word) for script, run in groupby(letters, script_of)]


def in_training(doc_id: Column) -> Column:
    """Documents that may be learned from: crc32 of the id as text, modulo 3, is not 1 (without an id: none)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 != 1, F.lit(False))


def _most(letters: np.ndarray) -> np.ndarray:
    """The most that words or runs of so many letters can say against a language."""
    return (CLIP * np.maximum(1, letters / CLIP_LETTERS))[:, None]


@dataclass
class Model:
    languages: list[str]
    grams: dict[str, int]
    logp: np.ndarray  # of each gram (the last row: of unknown grams) in each language
    scripts: np.ndarray  # script x language: written in it
    words: dict[str, int] = field(default_factory=dict)
    scores: np.ndarray | None = None
    letters: np.ndarray | None = None

    def __getstate__(self):
        return {"languages": self.languages, "grams": self.grams, "logp": self.logp, "scripts": self.scripts}

    def __setstate__(self, state):
        self.__dict__.update(state, words={}, scores=None, letters=None)

    def _score(self, new: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Scores (best language 0, others below) and letter counts of words."""
        unknown = len(self.grams)
        get = self.grams.get
        rows, sizes, letters, scripts, owner = [], [], [], [], []
        for k, word in enumerate(new):
            for run, script in script_runs(word.lower()):
                at = [get(g, unknown) for g in grams_of(run)]
                rows += at
                sizes.append(len(at))
                letters.append(len(run))
                scripts.append(script)
                owner.append(k)
        total = np.bincount(owner, letters, len(new)) if owner else np.zeros(len(new))
        out = np.zeros((len(new), len(self.languages)), "f4")
        if owner:
            size = np.array(sizes)
            run = np.add.reduceat(self.logp[np.array(rows)], np.cumsum(size) - size, axis=0) / len(GRAMS)
            fits = self.scripts[np.array(scripts)]
            fits |= ~fits.any(axis=1, keepdims=True)
            run = np.where(fits, run, -np.inf)
            run -= run.max(axis=1, keepdims=True)
            np.add.at(out, np.array(owner), np.maximum(run, -_most(np.array(letters))))
            out -= out.max(axis=1, keepdims=True)
        return np.maximum(out, -_most(total)).astype("f4"), total.astype("i4")

    def look_up(self, words: list[list[str]]) -> np.ndarray:
        """Row of each word in the cache, all texts in a row."""
        hold("langid", self.forget)
        new = set().union(*words).difference(self.words)
        if self.scores is None or len(self.words) + len(new) > CACHE_WORDS:
            self.words.clear()
            self.scores, self.letters = np.zeros((0, len(self.languages)), "f4"), np.zeros(0, "i4")
            new = set().union(*words)
        if new:
            order = sorted(new)
            scores, letters = self._score(order)
            self.words.update(zip(order, range(len(self.scores), len(self.scores) + len(order)), strict=True))
            self.scores, self.letters = np.concatenate([self.scores, scores]), np.concatenate([self.letters, letters])
        get = self.words.__getitem__
        row = np.fromiter((i for w in words for i in map(get, w)), "i8", sum(map(len, words)))
        for word in new:
            if len(word) > KEPT_LENGTH:
                del self.words[word]
        return row

    def forget(self) -> None:
        self.words, self.scores, self.letters = {}, None, None

    def label(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(language index of every word, its letters, words of each text) of whole texts."""
        words = [t.split() if t else [] for t in texts]
        count = np.array([len(w) for w in words], "i8")
        row = self.look_up(words)
        return viterbi(self.scores[row], count, SWITCH), self.letters[row], count

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        if not self.languages:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts))
        path, letters, count = self.label(texts)
        k = len(self.languages)
        owner = np.repeat(np.arange(len(texts)), count)
        share = np.bincount(owner * k + path, letters, len(texts) * k).reshape(-1, k)
        total = share.sum(axis=1)
        best = share.argmax(axis=1)
        name = [self.languages[b] if n else UNDETERMINED for b, n in zip(best, total, strict=True)]
        return name, np.divide(share.max(axis=1), total, out=np.zeros(len(texts)), where=total > 0)


def viterbi(scores: np.ndarray, count: np.ndarray, switch: float) -> np.ndarray:
    """The best path of each text over its words' scores: a change of language costs ``switch``.

    All texts advance together, longest first, one word at a time; ties stay with the language, then go to the first.
    """
    n, k = scores.shape
    if not n:
        return np.zeros(0, "i8")
    by_length = np.argsort(-count, kind="stable")
    length = count[by_length]
    begin = (np.cumsum(count) - count)[by_length]
    steps = int(length[0])
    active = np.searchsorted(-length, -np.arange(steps), "left")  # texts longer than t
    at = np.concatenate([[0], np.cumsum(active)])
    place = np.empty(n, "i8")  # step-major order
    lane = np.arange(n) - np.repeat(at[:-1], active)
    place[:] = begin[lane] + np.repeat(np.arange(steps), active)
    s = scores[place]
    moved, source = np.empty((n, k), bool), np.empty(n, "i2")
    v = s[: at[1]].copy()
    final = np.empty(len(count), "i8")
    for t in range(1, steps + 1):
        a = int(active[t]) if t < steps else 0
        if a < len(v):
            final[a : len(v)] = v[a:].argmax(axis=1)
            v = v[:a]
        if not a:
            break
        lo, hi = at[t], at[t + 1]
        top = v.argmax(axis=1)
        source[lo:hi] = top
        jump = (v[np.arange(a), top] - switch)[:, None]
        np.greater(jump, v, out=moved[lo:hi])
        v = np.maximum(v, jump) + s[lo:hi]
        if not t % 512:
            v -= v.max(axis=1, keepdims=True)
    path = np.empty(n, "i8")
    now = np.empty(0, "i8")
    for t in range(steps - 1, -1, -1):
        lo, hi = at[t], at[t + 1]
        a = hi - lo
        if len(now) < a:
            now = np.concatenate([now, final[len(now) : a]])
        path[lo:hi] = now
        if t:
            now = np.where(moved[lo:hi][np.arange(a), now], source[lo:hi], now)
    out = np.empty(n, "i8")
    out[place] = path
    return out


def train(docs: DataFrame) -> Model:
    """Learn from a bounded sample of the training documents (doc_id, text, lang): SAMPLE_DOCS of each language.

    Only rows that ``in_training`` admits and whose lang and text are not null are used; rows that repeat an id and a text
    count once. All languages are learned. The driver receives the n-gram table, which the sample and LANGUAGE_GRAMS bound
    for each language.
    """
    ship(docs.sparkSession)
    rows = docs.where(in_training(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", *row_key(), "text")
    sizes = sorted((r[0], r[1]) for r in rows.groupBy("lang").agg(F.approx_count_distinct(F.struct("d", "t"))).collect())
    languages = [lang for lang, _ in sizes]
    if not languages:
        return Model([], {}, np.zeros((1, 0), "f4"), np.zeros((len(SCRIPTS), 0), bool))
    # the least hashes of a language: first a cut that leaves about four times as many, whatever the table's size
    spark = docs.sparkSession
    cuts = spark.createDataFrame([(lang, min(1 << 31, (4 * SAMPLE_DOCS << 31) // max(1, n))) for lang, n in sizes], "lang string, cut long")
    place = F.pmod(F.xxhash64("d"), F.lit(1 << 31))
    w = Window.partitionBy("lang").orderBy("place", "d", "t")
    chosen = rows.select("lang", "d", "t", place.alias("place")).join(F.broadcast(cuts), "lang").where(F.col("place") < F.col("cut")).drop("cut").distinct()
    chosen = chosen.withColumn("n", F.row_number().over(w)).where(F.col("n") <= SAMPLE_DOCS).select("lang", "d", "t")
    sample = rows.join(F.broadcast(chosen), ["lang", "d", "t"], "left_semi").dropDuplicates(["lang", "d", "t"]).select("lang", "text")

    @lean
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_volume(batches, limit=TASK_BYTES):
            found: dict[str, Counter] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                grams = found.setdefault(lang, Counter())
                for word, n in Counter(LETTERS.findall(text.lower())).items():
                    for g in grams_of(word):
                        grams[g] += n
            rows = [(lang, g, n) for lang, grams in found.items() for g, n in grams.items()]
            if rows:
                a, b, c = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(c, pa.int64())], ["lang", "gram", "n"])

    table = materialise(sample.mapInArrow(count, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")), "grams")
    often = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    kept = table.withColumn("place", F.row_number().over(often)).where(F.col("place") <= LANGUAGE_GRAMS).select("gram").distinct()
    found = table.join(kept, "gram", "left_semi").collect()
    remove(table)
    grams = {g: i for i, g in enumerate(sorted({r["gram"] for r in found}))}
    at = {lang: k for k, lang in enumerate(languages)}
    counts = np.zeros((len(grams), len(languages)))
    for r in found:
        counts[grams[r["gram"]], at[r["lang"]]] = r["n"]
    logp = np.zeros((len(grams) + 1, len(languages)), "f4")
    for n in GRAMS:
        of = np.array([i for g, i in grams.items() if len(g) == n], "i8")
        if len(of):
            mass = counts[of].sum(axis=0) + SMOOTH * (len(of) + 1)
            logp[of] = np.log((counts[of] + SMOOTH) / mass)
    logp[-1] = logp[:-1].min(initial=0.0)
    scripts = np.zeros((len(SCRIPTS), len(languages)))
    for g, i in grams.items():
        if len(g) == 1:
            scripts[script_of(g)] += counts[i]
    return Model(languages, grams, logp, scripts >= SCRIPT_SHARE * np.maximum(1, scripts.sum(axis=0)))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score) of every row. One pass; the model (bounded) is broadcast.

    ``und`` with score 0 where the text is null or has no letter; otherwise a learned language, and the share of letters
    that the path gives to it (ties go to the first language by name). Rows that repeat an id stay rows; other columns are
    not read; no rows give none.
    """
    out_id = docs.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @only("langid")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_volume(batches, limit=TASK_BYTES):
            names, score = shared.value.predict(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(score, pa.float64())], ["doc_id", "lang_pred", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {out_id}, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: Model, least_score: float) -> DataFrame:
    """The rows of docs, all columns as they are, whose language is determined with a score of ``least_score`` or more."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    @only("langid")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_volume(batches, at, limit=TASK_BYTES):
            names, score = shared.value.predict(batch.column(at).to_pylist())
            yield batch.filter(pa.array([n != UNDETERMINED and s >= least_score for n, s in zip(names, score, strict=True)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def spans(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, spans array<struct<first, last, lang>>): runs of words (counted from 0) that the path gives one language."""
    out_id = docs.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("lang", pa.string())]))

    @only("langid")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_volume(batches, limit=TASK_BYTES):
            m = shared.value
            texts = batch.column(1).to_pylist()
            path, _, count = m.label(texts) if m.languages else (np.zeros(0, "i8"), None, np.zeros(len(texts), "i8"))
            out, at = [], 0
            for n in count.tolist():
                own = path[at : at + n]
                cut = np.concatenate([[0], np.flatnonzero(np.diff(own)) + 1, [n]]).tolist() if n else [0]
                out.append([{"first": a, "last": b - 1, "lang": m.languages[own[a]]} for a, b in zip(cut[:-1], cut[1:], strict=True)])
                at += n
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, kind)], ["doc_id", "spans"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {out_id}, spans array<struct<first:int,last:int,lang:string>>")
