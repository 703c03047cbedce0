"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns, for every operator and stage."""

import collections
import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from smallseq.llm import bpe, common, decontaminate, idstore, langid, linetree, recompress, repeats, simhash, suffixes, topk, urltree
from smallseq.llm import queries as Q

DOCS = "doc_id long, text string, lang string, source string, n_chars long, d string, t string, n int, text_key string, __d int"
BENCH = "item_id long, text string"
LONG = " ".join(f"w{i * 7919 % 30011}" for i in range(30_000))
TEXTS = [(1, "alpha beta gamma delta\nsecond line 42"), (1, "alpha beta gamma delta\nsecond line 42"), (2, None), (3, ""), (None, "alpha beta gamma delta"), (None, None), (4, LONG), (5, LONG + " end"), (6, " \n\t\n"), (7, "a"), (8, "ΑΣ Straße ＡＢ  ’s don't <|endoftext|> 12 \x1cx\u0085y é"), (1, "another text of the same id")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "en", "s", 1, "x", "y", 2, "z", 3) for i, t in TEXTS], DOCS).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def ids(rows):
    return sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in rows)


WANT = sorted((i is None, i or 0) for i, _ in TEXTS)


def test_bpe_like_the_library(docs, none):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(Q.vocabulary())
    got = bpe.round_trip_digests(docs, Q.vocabulary()).collect()
    want = []
    for i, t in TEXTS:
        e = lib.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(e), hashlib.sha256(np.array(e, "<u4").tobytes()).hexdigest(), hashlib.sha256(lib.decode(e, skip_special_tokens=False).encode()).hexdigest()))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert bpe.round_trip_digests(none, Q.vocabulary()).collect() == []
    back = bpe.decode(bpe.encode(docs.where("doc_id = 7"), Q.vocabulary()), Q.vocabulary()).first()
    assert back["text"] == "a</w>"


def test_all_of_unicode_like_the_library():
    """Both encoders agree with the library on every code point, assigned or not: alone, between letters, between marks."""
    library = Tokenizer.from_file(Q.vocabulary())
    encoders = bpe.RankArrayBpe(Q.vocabulary()), idstore.LibraryEncoder(Q.vocabulary())
    points = [*range(0xD800), *range(0xE000, 0x32000), *range(0x32000, 0xE0000, 61), *range(0xE0000, 0xE0200), *range(0xE0200, 0x110000, 61)]
    texts = [f"{c} a{c}b !{c}?" for c in map(chr, points)] + ["İI ŞS", "ΟΔΟΣ ΣΑΣ", "e\u0301 \u0301x", "'S 'Ll I'M'RE", "<|endoftext|>x <|startoftext|>"]
    for at in range(0, len(texts), 20_000):
        part = texts[at : at + 20_000]
        want = [np.array(e.ids, "<u4").tobytes() for e in library.encode_batch(part, add_special_tokens=False)]
        for encoder in encoders:
            assert [ascii(t) for t, a, b in zip(part, encoder.encode(part), want, strict=True) if a != b] == []


def test_words_of_latin_letters_are_split_here():
    """Words of the test languages need no call of the library's normaliser, and have its ids."""
    library, encoder = Tokenizer.from_file(Q.vocabulary()), idstore.LibraryEncoder(Q.vocabulary())
    letters = [chr(c) for c in [*range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x100)]]
    words = [f"{a}{mark}" for a in letters for mark in ("", ".", "'s", "7x", "!?", "zß,")] + [a + b for a in letters for b in letters] + ["'Été'Lleñe''s"]
    want = [np.array(e.ids, "<u4").tobytes() for e in library.encode_batch(words, add_special_tokens=False)]
    calls = []
    encoder.chunks.normalize = lambda chunk: calls.append(chunk) or chunk
    assert encoder.encode(words) == want and not calls


def test_a_column_of_texts_is_cut_outside_python():
    """op2 encodes Arrow columns: however a word is written and marked, it is one entry and one call of the library's model."""
    library, encoder = Tokenizer.from_file(Q.vocabulary()), idstore.LibraryEncoder(Q.vocabulary())
    asked, tokenize = [], encoder.tokenize
    encoder.tokenize = lambda piece: asked.append(piece) or tokenize(piece)
    words = ["Été été, ÉTÉ!", None, "", " \t\n", "Word, word wOrd.", "don't DON'T.", "été " * 3000, "1a" * 400]
    odd = ["été.\x1cété\xa0ÉTÉ?", "世界\u3000世界 a×b 世界", None, "don't <|endoftext|>Don't", "x"]
    for texts in words, odd, odd + words, odd[:2], []:
        want = [np.array(library.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
        assert encoder.encode(pa.array(["x", *texts], pa.string()).slice(1)) == want
        if texts is words:
            assert sorted(asked) == sorted(["Ã©tÃ©", *",!.1a", "word", "don", "'t"]) and not encoder.chunks.chunks


def test_a_long_word_takes_seconds():
    import time

    library, own = Tokenizer.from_file(Q.vocabulary()), bpe.RankArrayBpe(Q.vocabulary())
    for n in (100, 129, 5000, 1_000_000):
        word = "".join(chr(97 + (i * i * 7919 + i * 31) % 26) for i in range(n))
        start = time.time()
        got = own.encode([word])[0]
        assert time.time() - start < 60 and np.frombuffer(got, "<u4").tolist() == library.encode(word, add_special_tokens=False).ids
        assert not any(len(c) > 256 for c in own.encoder.chunks)


def test_a_full_cache_loses_nothing(monkeypatch):
    from smallseq.llm import tokens

    monkeypatch.setattr(tokens, "CACHE_ENTRIES", 20)
    small, large = bpe.RankArrayBpe(Q.vocabulary()), bpe.encoder(Q.vocabulary())
    texts = [" ".join(f"word{random.Random(i * 100 + k).randrange(60)}" for k in range(15)) for i in range(40)]
    assert [small.encode([t])[0] for t in texts] == large.encode(texts)


def test_store(spark, docs, none):
    folder = idstore.new_folder(spark)
    idstore.write(docs, Q.vocabulary(), folder, parts=3)
    found = idstore.digests(spark, folder).collect()
    assert ids(found) == WANT
    order = sorted(found, key=lambda r: r["start"])
    assert [r["doc_id"] is None for r in order][:2] == [True, True]
    assert [r["start"] for r in order] == np.concatenate([[0], np.cumsum([r["n_tokens"] for r in order])[:-1]]).tolist()
    read = {(r["doc_id"], r["start"]): r["ids"] for r in idstore.read(spark, folder).collect()}
    plain = {r["doc_id"]: r["ids"] for r in bpe.encode(docs.where("doc_id in (4, 7)"), Q.vocabulary()).collect()}
    assert [v for (d, _), v in read.items() if d == 7] == [plain[7] + [1]]
    assert idstore.lookup(spark, folder, 4) == [plain[4] + [1]] and len(idstore.lookup(spark, folder, 1)) == 3 and idstore.lookup(spark, folder, 99) == []
    empty = idstore.new_folder(spark)
    idstore.write(none, Q.vocabulary(), empty)
    assert idstore.digests(spark, empty).collect() == []


def test_store_with_a_dictionary(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(["stone", "river", "cloud", "ember", "grain"]) for _ in range(rng.randint(5, 900)))) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    raw = idstore.train_dictionary(df, Q.vocabulary(), 2)
    assert raw
    folder = idstore.new_folder(spark)
    idstore.write(df, Q.vocabulary(), folder)
    want = {r["doc_id"]: [*r["ids"], 1] for r in bpe.encode(df, Q.vocabulary()).collect()}
    assert {r["doc_id"]: r["ids"] for r in idstore.read(spark, folder).collect()} == want
    image = bytes(spark.read.parquet(f"{folder}/blocks").first()["image"])
    with pytest.raises(ValueError):
        idstore.Block(image, b"another dictionary")


VECTORS = "vec_id long, embedding array<float>, query_id string, rank string, score string"


def test_top_k_edges(spark):
    """Every row is a candidate but the query's own: rows that repeat an id, and rows without one (last of ties)."""
    rows = [(0, [1.0, 2.0]), (20, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, None), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]), (None, [1.0, 2.0]), (7, [1.0]), (8, []), (2, [1.0, 2.0]), (2, [3.0, 2.0]), (40, [-0.001, 0.5]), (20, [1.0, 0.0])]
    df = spark.createDataFrame([(i, e, "q", "r", "s") for i, e in rows], VECTORS)
    full = [(i, np.floor(64 * np.array(e, "f4").astype("f8"))) for i, e in rows if e and len(e) == 2 and all(x is not None and np.isfinite(x) for x in e)]
    for k in (3, 7, 100):
        want = []
        for a, (q, x) in enumerate(full):
            if q is not None and q % 20 == 0:
                best = sorted((-int(x @ y), c is None, c or 0) for b, (c, y) in enumerate(full) if a != b)[:k]
                want += [(q, n, None if none else c, -s) for n, (s, none, c) in enumerate(best, 1)]
        assert sorted(map(tuple, topk.top_k(df, topk.F.col("vec_id") % 20 == 0, k=k).collect()), key=repr) == sorted(want, key=repr)
    assert topk.top_k(df.limit(0), topk.F.col("vec_id") % 20 == 0).collect() == []


def test_top_k_tiles_and_tree(spark, monkeypatch):
    for name, value in (("TILE_QUERIES", 3), ("TILE_VECTORS", 7), ("STRIP", 2), ("FAN_IN", 2)):
        monkeypatch.setattr(topk, name, value)
    rng = np.random.default_rng(0)
    m = rng.integers(-2, 3, (120, 4)) / 64
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(m)], "vec_id long, embedding array<float>")
    e = np.floor(64 * m).astype(int)
    want = {(q, n, c, int(e[q] @ e[c])) for q in range(0, 120, 20) for n, c in enumerate(sorted((c for c in range(120) if c != q), key=lambda c: (-(e[q] @ e[c]), c))[:5], 1)}
    assert {tuple(r) for r in topk.top_k(df, topk.F.col("vec_id") % 20 == 0, k=5).collect()} == want


def test_huge_components_stay_exact():
    q = np.array([[2.0**60, -3.0]])
    assert topk._strip_scores(q, np.array([[2.0, 1.0]]))[0, 0] == 2**61 - 3
    assert topk._strip_scores(q, np.array([[2.0**60, 1.0]]))[0, 0] == 2**63 - 1


def test_simhash_edges(docs, none):
    got = simhash.components(docs).collect()
    assert ids(got) == WANT
    zero = {r["doc_id"] for r in got if r["fp"] == 0}
    assert {2, 3, 6} <= zero and {r["component_id"] for r in got if r["fp"] == 0} == {2}
    assert simhash.components(none).collect() == []
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    by_id = collections.Counter(r["doc_id"] for r in kept.collect())
    assert by_id[1] == 1 and by_id[None] == 2 and by_id[2] == 1 and by_id[3] == 0
    assert simhash.keep_first(none).collect() == []


@pytest.mark.parametrize("limit", [4096, 8])
def test_bk_links_are_all_links(spark, monkeypatch, limit):
    monkeypatch.setattr(simhash, "SHARD_ROWS", limit)
    rng = random.Random(2)
    base = [rng.getrandbits(64) for _ in range(12)] + [0]
    fps = list({b ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for b in base for _ in range(30)} | set(base))
    edges = simhash.links(spark.createDataFrame([(simhash._signed(f),) for f in fps], "fp long"))
    if limit == 4096:
        roots = simhash.connected_components(edges)
        got = {r["node"] & (2**64 - 1): r["root"] & (2**64 - 1) for r in roots.collect()}
    else:  # shards of 8 are dealt on by more bands: every link must still be found
        got = None
        pairs = {(r["a"] & (2**64 - 1), r["b"] & (2**64 - 1)) for r in edges.collect()}
    label = {f: f for f in fps}

    def find(label, f):
        while label[f] != f:
            f = label[f]
        return f

    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= 2:
                x, y = find(label, a), find(label, b)
                label[x] = y
    want = collections.defaultdict(set)
    for f in fps:
        want[find(label, f)].add(f)
    if got is None:
        own = {f: f for f in fps}
        for a, b in pairs:
            own[find(own, a)] = find(own, b)
        have = collections.defaultdict(set)
        for f in fps:
            have[find(own, f)].add(f)
    else:
        have = collections.defaultdict(set)
        for f in fps:
            have[got.get(f, f)].add(f)
    assert sorted(map(sorted, want.values())) == sorted(map(sorted, have.values()))


def test_components_of_a_long_chain(spark):
    from smallseq.llm.graph import connected_components

    n = 300
    order = list(range(n))
    random.Random(0).shuffle(order)
    edges = [(order[i], order[i + 1]) for i in range(n - 1)] + [(1000, 1001), (1000, 1000)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(n)} | {1000: 1000, 1001: 1000}


def test_substring_edges(docs, none):
    for digests in (recompress.digests, suffixes.digests):
        got = digests(docs).collect()
        assert ids(got) == WANT and digests(none).collect() == []
        empty = [r for r in got if r["doc_id"] in (2, 3)]
        assert all(tuple(r)[1:3] == (0, 0) for r in empty)
        both = {r["doc_id"]: r for r in got if r["doc_id"] in (4, 5)}
        assert all(r[2] >= 30_000 - 1 for r in both.values())
    assert ids(recompress.deduplicate(docs).collect()) == WANT
    first = {r["doc_id"]: bytes(r["kept"]) for r in suffixes.deduplicate(docs.where("doc_id in (4, 5)")).collect()}
    assert first[4] == LONG.encode() and len(first[5]) < 200


@pytest.mark.parametrize("cut", [10_000, 1])
def test_suffix_shards_and_counted_groups_agree(spark, monkeypatch, cut):
    monkeypatch.setattr(suffixes, "SHARD_CONTEXTS", cut)
    rng = random.Random(4)
    core = "".join(rng.choice("abc") for _ in range(150))
    texts = ["".join(rng.choice("abc") for _ in range(rng.randint(0, 60))) + core[rng.randint(0, 60) : rng.randint(90, 150)] + "".join(rng.choice("ab") for _ in range(40)) for _ in range(40)] + ["a" * 300]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    seen = collections.Counter(t[i : i + 30] for t in texts for i in range(len(t) - 29))
    got = {r["doc_id"]: r for r in suffixes.digests(df, 30).collect()}
    earlier = set()
    kept = {r["doc_id"]: bytes(r["kept"]).decode() for r in suffixes.deduplicate(df, 30).collect()}
    for d, t in enumerate(texts):
        gone, later = set(), set()
        for i in range(len(t) - 29):
            if seen[t[i : i + 30]] > 1:
                gone.update(range(i, i + 30))
            if t[i : i + 30] in earlier:
                later.update(range(i, i + 30))
            earlier.add(t[i : i + 30])
        assert got[d]["n_removed"] == len(gone), d
        assert kept[d] == "".join(c for i, c in enumerate(t) if i not in later), d


@pytest.mark.parametrize("window", [1, 2, 5, 12, 35])
def test_word_windows_of_any_size(spark, window):
    rng = random.Random(window)
    texts = [" ".join(rng.choice("ab") if k % 3 else rng.choice("abcdefgh") for _ in range(rng.randint(0, 90))) for k in range(25)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    words = [t.split() for t in texts]
    seen = collections.Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    got = {r["doc_id"]: r["n_removed"] for r in recompress.digests(df, window).collect()}
    assert got == {d: len({j for i in range(len(w) - window + 1) if seen[tuple(w[i : i + window])] > 1 for j in range(i, i + window)}) for d, w in enumerate(words)}


def test_anchors_depend_on_the_window_alone():
    rng = random.Random(9)
    for window, scheme in ((35, recompress.Words(35)), (200, suffixes.Bytes(200))):
        alphabet = [b"x", b"y", b"zz", b"x"] if window == 35 else [b"a", b"b"]
        glue = b" " if window == 35 else b""
        core = [rng.choice(alphabet) for _ in range(window * 2)]
        texts = [glue.join([*[rng.choice(alphabet) for _ in range(rng.randint(0, 50))], *core, *[rng.choice(alphabet) for _ in range(rng.randint(0, 50))]]) for _ in range(10)]
        units = [scheme.units(t) for t in texts]
        text, lo, n, kh, _ = scheme.anchors(units)
        assert n.sum() == sum(max(0, len(u) - window + 1) for u in units)
        key = {}
        for i in range(len(lo)):
            for s in range(lo[i], lo[i] + n[i]):
                assert key.setdefault(units[text[i]][s : s + window].tobytes(), kh[i]) == kh[i]


def test_decontamination_edges(spark, docs, none):
    bench = spark.createDataFrame([(1, "Alpha, BETA gamma"), (1, "beta gamma delta"), (2, None), (3, ""), (4, "... !"), (5, " ".join(f"w{i * 7919 % 30011}" for i in range(20)))], BENCH)
    got = decontaminate.contamination(docs, bench).collect()
    assert ids(got) == WANT
    one = next(r for r in got if r["doc_id"] == 1 and r["n_words"] == 7)
    assert (one["n_hit"], one["n_items"], one["contaminated"], [tuple(s) for s in one["spans"]]) == (4, 1, True, [(0, 3)])
    assert one["items_sha256"] == hashlib.sha256(b"1").hexdigest()
    long = next(r for r in got if r["doc_id"] == 4)
    assert long["n_items"] == 1 and long["n_hit"] > 0 and not long["contaminated"]
    assert decontaminate.contamination(none, bench).collect() == []
    nothing = decontaminate.contamination(docs, bench.limit(0)).collect()
    assert ids(nothing) == WANT and not any(r["contaminated"] or r["n_hit"] for r in nothing)
    kept = decontaminate.clean(docs, bench)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == [1, 2, 3, 4, 5, 6, 7, 8]


def test_decontamination_shuffled_like_broadcast(spark, docs, monkeypatch):
    bench = spark.createDataFrame([(5, " ".join(f"w{i * 7919 % 30011}" for i in range(20)))], BENCH)
    one = sorted(map(repr, decontaminate.contamination(docs, bench).collect()))
    monkeypatch.setattr(common, "BROADCAST_BYTES", -1)
    assert sorted(map(repr, decontaminate.contamination(docs, bench).collect())) == one


def test_language_edges(spark, docs, none):
    train = spark.createDataFrame([(i, ("der die und das nicht " if i % 2 else "the and of that with ") * 5, "de" if i % 2 else "en") for i in range(40)] + [(100, None, "en"), (101, "x", None), (None, "the", "fr")], "doc_id long, text string, lang string")
    model = langid.train(train)
    assert model.languages == ["de", "en"]
    got = langid.identify(docs, model).collect()
    assert ids(got) == WANT
    assert all((r["lang_pred"], r["score"]) == ("und", 0.0) for r in got if r["doc_id"] in (2, 3, 6))
    assert all(r["lang_pred"] in ("de", "en") and 0 < r["score"] <= 1 for r in got if r["doc_id"] in (1, 7, 8))
    assert langid.identify(none, model).collect() == []
    blank = langid.train(train.limit(0))
    assert {r["lang_pred"] for r in langid.identify(docs, blank).collect()} == {"und"}
    mixed = spark.createDataFrame([(1, "the and of that with the and " + "der die und das nicht der die")], "doc_id long, text string")
    assert [(s["first"], s["last"], s["lang"]) for s in langid.spans(mixed, model).first()["spans"]] == [(0, 6, "en"), (7, 13, "de")]
    assert langid.keep_identified(docs, model, 0.4).columns == docs.columns


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(3)
    count = np.array([0, 1, 7, 3, 7, 0, 5])
    scores = -rng.integers(0, 6, (count.sum(), 3)).astype("f4")
    path = langid.viterbi(scores, count, 2.5)
    at = 0
    for n in count.tolist():
        s = scores[at : at + n]
        value = lambda p: sum(s[i, k] for i, k in enumerate(p)) - 2.5 * sum(a != b for a, b in zip(p, p[1:], strict=False))  # noqa: E731, B023
        best = max((value(p) for p in np.ndindex(*[3] * n)), default=0)
        assert value(path[at : at + n].tolist()) == pytest.approx(best)
        at += n


def test_line_edges(spark, docs, none):
    got = linetree.digests(docs).collect()
    assert ids(got) == WANT and linetree.digests(none).collect() == []
    assert next(tuple(r)[1:3] for r in got if r["doc_id"] == 2) == (0, 0)
    rows = [(i, f"Posted by user{chr(97 + i)} on day {i} at noon\nunique{chr(97 + i)} text{chr(98 + i)} line{chr(99 + i)}\n\nsame footer here") for i in range(6)]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, line string")
    out = {r["doc_id"]: r["text"] for r in linetree.deduplicate(df).collect()}
    assert out == {i: f"unique{chr(97 + i)} text{chr(98 + i)} line{chr(99 + i)}\n" for i in range(6)}
    first = {r["doc_id"]: r["text"] for r in linetree.deduplicate(df, keep_first=True).collect()}
    assert first[0] == rows[0][1] and first[1] == out[1]
    assert {r["text"] for r in linetree.deduplicate(df.limit(4)).collect()} == {t for _, t in rows[:4]}


def test_url_edges(spark):
    urls = [(1, None), (2, "no scheme"), (3, "HTTP://WWW.Example.COM/en/7?x#y"), (4, "http://a.com/en/x"), (5, "http://com/en/"), (6, "http://xcom/en/"), (7, "http://b.net/de/"), (8, "http://example.net/de/81"), (9, "http://q.example.org/es/"), (10, "a://b://c/d"), (11, "http://h"), (12, ""), (None, "http://a.com/en/x"), (4, "http://a.com/en/x"), (13, "://"), (14, "http://a.com?en/x")]
    pages = spark.createDataFrame([(i, u, "h", "p", "t") for i, u in urls], "page_id long, url string, host string, path string, template string")
    labels = spark.createDataFrame([(4, True), (4, False), (5, None), (None, True), (99, True)], "page_id long, bad boolean")
    got = [(r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in urltree.judge(pages, labels).collect()]
    assert len(got) == len(urls)
    by = {g[0]: g[1:] for g in got}
    assert by[1][:3] == ("", "", None) and by[2][:3] == ("", "", None) and by[13][:2] == ("", "")
    assert by[3] == ("www.example.com", "/en/7", "example.com/en/7", "allow")
    assert by[4][2:] == ("com/en/", "block") and by[5][2:] == ("com/en/", "block") and by[6][2] is None
    assert by[7][2:] == ("net/de/", "allow") and by[8][2:] == ("example.net/de/8", "block") and by[9][2:] == ("org/es/", "block")
    assert by[10][:2] == ("b:", "//c/d") and by[11][:2] == ("h", "") and by[14][:3] == ("a.com", "", None)
    assert urltree.judge(pages.limit(0), labels).collect() == []


def test_bad_templates_are_rejected(spark):
    pages = spark.createDataFrame([(i, f"http://h.io/{'spam' if i % 2 else 'news'}/{'abcdefghijklmnopqrstuvwxyz'[i % 26]}x{i}") for i in range(200)], "page_id long, url string")
    labels = spark.createDataFrame([(i, bool(i % 2)) for i in range(100)], "page_id long, bad boolean")
    got = {r["page_id"]: r for r in urltree.judge(pages, labels).collect()}
    assert all(got[i]["verdict"] == ("block" if i % 2 else "allow") for i in range(200))
    assert {r["template"] for r in got.values()} == {"/spam/#", "/news/#"}


def test_materialise_and_remove(spark):
    import os

    df = common.materialise(spark.range(3).toDF("x"), "t")
    path = df.inputFiles()[0].removeprefix("file://")
    assert df.count() == 3 and os.path.exists(path)
    common.remove(df)
    assert not os.path.exists(path)


def test_range_hashes():
    u = repeats.mix(np.arange(50, dtype=np.uint64))
    h = repeats.RangeHash(np.concatenate([u, u]), 0)
    a = np.array([3, 10, 0])
    assert (h(a, a + 20) == h(a + 50, a + 70)).all() and h(a, a + 20)[0] != h(a, a + 20)[1]


def test_one_cache_at_a_time():
    from smallseq.llm import batches

    class Held:
        def __init__(self):
            self.dropped = 0

        def drop(self):
            self.dropped += 1

    a, b, c = Held(), Held(), Held()
    batches.hold("x", a.drop)
    batches.hold("x", a.drop)
    assert a.dropped == 0
    batches.hold("x", b.drop)
    assert (a.dropped, b.dropped) == (1, 0)
    batches.hold("y", c.drop)
    assert (a.dropped, b.dropped, c.dropped) == (1, 1, 0)


@pytest.mark.parametrize("large", [False, True])
def test_near_copies_of_five_words_are_all_found(spark, monkeypatch, large):
    """``large``: nothing is broadcast, and a shingle's texts are compared in many blocks."""
    from smallseq.llm import similar

    if large:
        monkeypatch.setattr(common, "BROADCAST_BYTES", -1)
        monkeypatch.setattr(similar, "BLOCK", 3)

    rng = random.Random(4)
    rows = []
    for g in range(12):  # originals, and copies with some words replaced: similarities on both sides of 0.8
        words = [f"w{rng.randrange(5000)}" for _ in range(120)]
        rows.append(" ".join(words))
        for k in range(6):
            at = set(rng.sample(range(120), k + 1))
            rows.append(" ".join(f"x{rng.randrange(5000)}" if i in at else w for i, w in enumerate(words)))
    passage = " ".join(f"c{i}" for i in range(40))
    rows += [f"{passage} {' '.join(f'u{rng.randrange(9999)}' for _ in range(60))}" for _ in range(30)]
    sets = [set(similar.shingle_set(t).tolist()) for t in rows]
    root = list(range(len(rows)))
    pairs = [(a, b) for a in root for b in root if a < b and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    for _ in rows:
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    assert len(pairs) > 10 and {r["doc_id"]: r["component_id"] for r in similar.components(docs).collect()} == dict(enumerate(root))
    assert {r["doc_id"] for r in simhash.keep_first(docs).collect()} == set(root)


def test_variable_fields_of_a_large_template(spark):
    """Every value of the fields recurs in more documents than MIN_DOCS; the template is still one."""
    word = lambda k, c: c + "".join(chr(97 + k // 26**j % 26) for j in range(3))
    rows = [(i, f"This page was written by {word(i % 50, 'n')} of the town {word(i * 7 % 61, 'c')} and printed for all readers") for i in range(1000)]
    df = spark.createDataFrame(rows + [(2000, "This page is of its own kind")], "doc_id long, text string")
    got = {r["doc_id"]: r["n_dropped"] for r in linetree.digests(df).collect()}
    assert got.pop(2000) == 0 and set(got.values()) == {1}
    assert linetree.deduplicate(df, keep_first=True).where("text <> ''").count() == 2


def test_variable_fields_of_long_lines(spark):
    word = lambda k: "n" + "".join(chr(97 + k // 26**j % 26) for j in range(3))
    tail = " ".join(f"notice{chr(97 + k)}" for k in range(24))
    rows = [(i, f"to all {word(i)} {tail}") for i in range(8)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["n_dropped"] for r in linetree.digests(df).collect()} == {1}


def test_a_bad_section_among_many_is_not_merged(spark):
    name = lambda k: "s" + chr(97 + k // 26) + chr(97 + k % 26)
    pages = spark.createDataFrame([(i, f"http://h.io/{name(i % 40)}/p{i}") for i in range(4000)], "page_id long, url string")
    labels = spark.createDataFrame([(i, i % 40 == 7) for i in range(4000)], "page_id long, bad boolean")
    got = {r["page_id"]: r["verdict"] for r in urltree.judge(pages, labels).collect()}
    assert got == {i: "block" if i % 40 == 7 else "allow" for i in range(4000)}


def test_paths_that_differ_deep_down(spark):
    pages = spark.createDataFrame([(i, f"http://h.io/a/b/c/d/e/f/{'spam' if i % 2 else 'news'}/x{i}/{'y/' * (i % 3)}") for i in range(200)], "page_id long, url string")
    labels = spark.createDataFrame([(i, i % 2 == 1) for i in range(0, 200, 1)], "page_id long, bad boolean")
    assert {r["page_id"]: r["verdict"] for r in urltree.judge(pages, labels).collect()} == {i: "block" if i % 2 else "allow" for i in range(200)}


def test_small_branches_merge_only_with_their_like(spark):
    """One large branch and 29 small ones, 14 of them all good and 15 all bad; digits beside the merged branch."""
    name = lambda k: f"s{chr(97 + k)}{chr(98 + k)}"
    urls = [("http://h.io/main/x", i % 10 == 0) for i in range(300)] + [(f"http://h.io/{name(k % 29)}/y", k % 29 >= 14) for k in range(29 * 6)] + [("http://h.io/7/y", True)] * 40
    pages = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(urls)], "page_id long, url string")
    labels = spark.createDataFrame([(i, b) for i, (_, b) in enumerate(urls)], "page_id long, bad boolean")
    got = {r["page_id"]: r["verdict"] for r in urltree.judge(pages, labels).collect()}
    assert got == {i: "block" if i >= 300 and b else "allow" for i, (_, b) in enumerate(urls)}


def test_a_document_supports_a_token_once(spark):
    """One document that has a field's value in seven lines does not make it a constant; the others' lines still go."""
    word = lambda k: "n" + "".join(chr(97 + k // 26**j % 26) for j in range(3))
    rows = [(i, f"letter from {word(i)} about the weather") for i in range(6)]
    rows.append((6, "\n".join(f"letter from {word(0)} about the {word(100 + k)}" for k in range(7))))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"]: r["n_dropped"] for r in linetree.digests(df).collect()} == {**{i: 1 for i in range(6)}, 6: 0}


def test_long_lines_recur_from_two_documents(spark):
    long = " ".join(f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(50))
    df = spark.createDataFrame([(1, long + "\nshort"), (2, "short\n" + long), (3, long[:-4])], "doc_id long, text string")
    assert {r["doc_id"]: r["n_dropped"] for r in linetree.digests(df).collect()} == {1: 1, 2: 1, 3: 0}
    assert sorted(r["text"] for r in linetree.deduplicate(df, keep_first=True).where("doc_id < 3").collect()) == ["short", long + "\nshort"]


def test_names_of_the_caller_do_not_clash(spark):
    names = ["row", "d", "t", "gone", "lines", "kept", "i", "m", "w", "starts", "cases"]
    df = spark.createDataFrame([(i, "same line\nhere") + tuple(range(len(names))) for i in (1, 2, 3, 4, 5)], "doc_id long, text string, " + ", ".join(f"{n} int" for n in names))
    bench = spark.createDataFrame([(1, "nothing of this")], BENCH)
    for out in (linetree.deduplicate(df, keep_first=True), decontaminate.clean(df, bench)):
        assert out.columns == df.columns and {tuple(r)[2:] for r in out.collect()} == {tuple(range(len(names)))}


def _plain_scores(model, word):
    """Scores of a word by the definition, letter by letter."""
    import math

    total = [0.0] * len(model.languages)
    letters = 0
    runs, last = [], None
    for c in word.lower():
        if not c.isalpha():
            last = None
            continue
        script = next(n for s, n in reversed(langid.SCRIPT_STARTS) if s <= ord(c))
        if script == last:
            runs[-1][1].append(c)
        else:
            runs.append((script, [c]))
        last = script
    for script, run in runs:
        letters += len(run)
        padded = [" ", *run, " "]
        grams = run + ["".join(padded[i : i + 3]) for i in range(len(run))]
        fits = [bool(x) for x in model.scripts[langid.SCRIPTS.index(script)]]
        score = [sum(float(model.logp[model.grams.get(g, len(model.grams))][k]) for g in grams) / 2 if f or not any(fits) else -math.inf for k, f in enumerate(fits)]
        most = langid.CLIP * max(1, len(run) / langid.CLIP_LETTERS)
        total = [t + max(x - max(score), -most) for t, x in zip(total, score, strict=True)]
    return [max(t - max(total), -langid.CLIP * max(1, letters / langid.CLIP_LETTERS)) for t in total], letters


def test_word_scores_by_the_definition(spark):
    han = "".join(chr(0x4E00 + i * 37 % 900) for i in range(300))
    rows = [(i, ["der die und das nicht", "the and of that with", "и не на что как", han][i % 4], ["de", "en", "ru", "zh"][i % 4]) for i in range(60)]
    model = langid.train(spark.createDataFrame(rows + rows, "doc_id long, text string, lang string"))
    words = ["the", "nicht", "что", "don't", "x1y", "42", "theund", "Как-the", han[:50], "the" + han[:7] + "и", "überстрасse", "a" * 300]
    scores, letters = model._score(words)
    for word, got, n in zip(words, scores, letters, strict=True):
        want, count = _plain_scores(model, word)
        assert n == count and got == pytest.approx(want, abs=2e-3), word
    # a run without spaces wins its span, however many words stand around it
    mixed = "the and of that with " * 4
    text = spark.createDataFrame([(1, mixed + han + han + han + han + " " + mixed)], "doc_id long, text string")
    assert [s["lang"] for s in langid.spans(text, model).first()["spans"]] == ["en", "zh", "en"]
    assert langid.identify(text, model).first()["lang_pred"] == "zh"
    many = [(i, "the and of", f"l{i % 90:02d}") for i in range(2000)]
    assert len(langid.train(spark.createDataFrame(many, "doc_id long, text string, lang string")).languages) == 90


def test_near_copies_edges(spark, docs, none):
    """Texts without words are alike; texts shorter than a shingle are one; copies of one id, and rows without an id."""
    from smallseq.llm import similar

    found = similar.components(docs).collect()
    assert ids(found) == WANT
    by = {r["doc_id"]: r["component_id"] for r in found if r["doc_id"] is not None}
    assert by[2] == by[3] == by[6] == 2 and by[4] == by[5] == 4 and by[7] == 7
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == [1, 2, 4, 7, 8]
    assert simhash.keep_first(none).collect() == []


def test_sketches_never_rule_out_what_two_sets_share():
    from smallseq.llm import similar

    rng = np.random.default_rng(5)
    for n, m, common_ in [(1, 1, 1), (3, 4, 3), (50, 60, 45), (1000, 1200, 990), (5000, 4100, 4000)]:
        pool = rng.integers(0, 1 << 63, n + m - common_, dtype="u8")
        a, b = np.unique(pool[:n]), np.unique(np.concatenate([pool[:common_], pool[n:]]))
        assert similar.most_common(similar.sketch(a), similar.sketch(b)) >= len(np.intersect1d(a, b))


def test_lines_without_broadcasts(spark, monkeypatch):
    word = lambda k, c: c + "".join(chr(97 + k // 26**j % 26) for j in range(3))
    rows = [(i, f"This page was written by {word(i % 50, 'n')} of the town {word(i * 7 % 61, 'c')} and printed for all readers\nown {word(i, 'x')}") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    one = sorted(map(tuple, linetree.digests(df).collect()))
    monkeypatch.setattr(common, "BROADCAST_BYTES", -1)
    assert sorted(map(tuple, linetree.digests(df).collect())) == one and {r[2] for r in one} == {1}


def test_texts_without_edges_are_not_moved(spark, monkeypatch):
    """Where edges are too many for a broadcast, other texts stay out of the join's shuffle, and results are the same."""
    from pyspark.sql import functions as F

    likely = common.likely
    words = [f"w{random.Random(7).randrange(10**6)}x{i}" for i in range(3000)]
    texts = [" ".join(words[40 * i : 40 * i + 60] if i < 6 else [f"own{i}n{k}" for k in range(50)]) for i in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    want = [sorted(map(tuple, digests(docs).collect())) for digests in (recompress.digests, suffixes.digests)]
    assert sum(r[2] for r in want[1]) > 0
    moved = []
    monkeypatch.setattr(repeats, "BROADCAST_BYTES", -1)
    monkeypatch.setattr(repeats, "likely", lambda *args: moved.append(likely(*args).count()) or likely(*args))
    assert [sorted(map(tuple, digests(docs).collect())) for digests in (recompress.digests, suffixes.digests)] == want
    assert moved and max(moved) < 20
    keys = docs.select(F.col("doc_id").alias("d")).where("d % 3 = 0")
    left = common.likely(docs.withColumnRenamed("doc_id", "d"), keys, ["d"])
    assert left.join(keys, "d", "left_semi").count() == 100 and left.columns == ["d", "text"]
    assert common.likely(docs, keys.limit(0).withColumnRenamed("d", "doc_id"), ["doc_id"]).count() == 0


def test_suffix_ranks_take_bounded_memory():
    """A large group of contexts is one text of some MB: 100 bytes for each of its bytes were too many beside the other workers."""
    import tracemalloc

    text = np.frombuffer(np.random.default_rng(3).bytes(1 << 20), "u1") % 4
    tracemalloc.start()
    try:
        lpf, _ = suffixes.previous_factors(text, np.flatnonzero(np.arange(len(text)) % 300 < 60), 200)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(lpf) and most < 64 * len(text)


def test_a_task_with_a_cache_drops_those_of_others(monkeypatch):
    """The language model's tasks begin without the encoder's caches, and leave no more than their own."""
    from smallseq.llm import batches

    dropped, given = [], []
    monkeypatch.setattr(batches, "_held", {})
    monkeypatch.setattr(batches, "give_back", lambda: given.append(1))
    batches.hold("bpe", lambda: dropped.append("bpe"))

    @batches.only("langid")
    def work(rows):
        assert dropped == ["bpe"] and given == [1]
        batches.hold("langid", lambda: dropped.append("langid"))
        yield from rows

    assert list(work([1, 2])) == [1, 2] and dropped == ["bpe"] and len(given) == 2 and list(batches._held) == ["langid"]
    dropped.clear()
    batches.hold("bpe", lambda: dropped.append("bpe"))
    assert dropped == ["langid"]
