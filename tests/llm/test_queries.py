"""The llm queries: against SQL where it says them, else against brute force, over whole small tables."""

import collections
import hashlib
import os
import re
import zlib

import duckdb
import numpy as np
import pytest
import xxhash

from smallseq.llm import queries as Q

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    return con


@pytest.fixture(scope="module")
def texts(duck):
    return dict(duck.execute("SELECT doc_id, text FROM documents").fetchall())


def rows(spark, name):
    return {r[0]: tuple(r)[1:] for r in Q.QUERIES[name](spark, SF).collect()}


@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_sql(spark, duck, name):
    df = Q.QUERIES[name](spark, SF)
    got = sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=repr)
    cur = duck.execute(Q.ORACLES[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    assert got == sorted((tuple(r[names.index(c)] for c in sorted(names)) for r in cur.fetchall()), key=repr)


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(Q.vocabulary())


def test_op2(spark, texts, library):
    got, at = rows(spark, "op2_token_ids"), 0
    for doc in sorted(texts):
        ids = np.array([*library.encode(texts[doc], add_special_tokens=False).ids, 1], "<u4")
        assert got[doc] == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_op6(spark, texts):
    got = rows(spark, "op6_simhash")

    def fingerprint(text):
        words = re.findall("[^\x20\x09-\x0d]+", text.translate({i: i + 32 for i in range(65, 91)}))
        grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    fps = {d: fingerprint(t) for d, t in texts.items()}
    root = {d: d for d in fps}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for a in sorted(fps):
        for b in sorted(fps):
            if b < a and (fps[a] ^ fps[b]).bit_count() <= 2 and find(a) != find(b):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    assert got == {d: (f"{f:016x}", find(d)) for d, f in fps.items()}


def test_op7(spark, texts):
    words = {d: re.findall("[^\x20\x09-\x0d]+", t) for d, t in texts.items()}
    seen = collections.Counter(tuple(w[i : i + 35]) for w in words.values() for i in range(len(w) - 34))
    want = {}
    for d, w in words.items():
        gone = {j for i in range(len(w) - 34) if seen[tuple(w[i : i + 35])] > 1 for j in range(i, i + 35)}
        want[d] = (len(w), len(gone), hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest())
    assert rows(spark, "op7_recompression") == want


def test_op8(spark, texts):
    raw = {d: t.encode() for d, t in texts.items()}
    seen = collections.Counter(b[i : i + 200] for b in raw.values() for i in range(len(b) - 199))
    want = {}
    for d, b in raw.items():
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - 199):
            if seen[b[i : i + 200]] > 1:
                gone[i : i + 200] = True
        runs = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        want[d] = (len(b), int(gone.sum()), runs, hashlib.sha256(bytes(x for x, g in zip(b, gone, strict=True) if not g)).hexdigest())
    assert rows(spark, "op8_suffix_array") == want


def test_op9(spark, texts, library):
    want = {}
    for d, t in texts.items():
        ids = library.encode(t, add_special_tokens=False).ids
        want[d] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest())
    assert rows(spark, "op9_bpe") == want


def test_op10_held_out_accuracy(spark, duck):
    df = Q.QUERIES["op10_language_id"](spark, "/root/testdata/sf0.01")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    found = df.join(docs, "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in found)
    assert all(0 <= r["score"] <= 1 for r in found)
    held = [r["lang"] == r["lang_pred"] for r in found if r["held_out"]]
    assert len(held) > 200 and sum(held) / len(held) > 0.97


def without_repeated_lines(docs):
    """Lines whose template recurs go, but for the first of the most general one: by the definition, on Python's tables."""
    from smallseq.llm.linetree import CONSTANT, LONG, LONG_DOCS, MIN_DOCS

    lines = []
    for d, text in docs.items():
        for i, raw in enumerate(text.split("\n")):
            flat = re.sub("[ \t\r\x0b\f]+", " ", raw).strip(" ")
            if flat:
                tokens = tuple("<*>" if re.search("[0-9]", x) else x for x in flat.split(" "))
                lines.append((d, i, (len(tokens), *tokens[:2]), tokens))
    support, leaf_docs, kinds = collections.defaultdict(set), collections.defaultdict(set), collections.defaultdict(set)
    for d, _, leaf, tokens in lines:
        leaf_docs[leaf].add(d)
        kinds[leaf].add(tokens)
        for p, x in enumerate(tokens):
            support[leaf, p, x].add(d)

    def templates(leaf, tokens):
        found = {}
        if len(kinds[leaf]) > 1 and len(leaf_docs[leaf]) >= MIN_DOCS:
            for level in range(12):
                constant = tuple((p, x) for p, x in enumerate(tokens) if len(support[leaf, p, x]) >= MIN_DOCS * 4**level)
                if len(constant) >= CONSTANT * len(tokens):
                    found[leaf, constant] = level
        return found or {(leaf, tokens): 0}

    docs_of, first = collections.defaultdict(set), {}
    for d, i, leaf, tokens in lines:
        for x in templates(leaf, tokens):
            docs_of[x].add(d)
            first[x] = min(first.get(x, (d, i)), (d, i))
    gone = set()
    for d, i, leaf, tokens in lines:
        needed = LONG_DOCS if len(tokens) >= LONG else MIN_DOCS
        often = [(level, x) for x, level in templates(leaf, tokens).items() if len(docs_of[x]) >= needed]
        if often and first[max(often)[1]] != (d, i):
            gone.add((d, i))
    return {d: "\n".join(x for i, x in enumerate(t.split("\n")) if (d, i) not in gone) for d, t in docs.items()}


def without_near_copies(docs):
    """The first of each group of texts whose sets of 5-word shingles have a similarity of 0.8 or more."""
    sets = {}
    for d, text in docs.items():
        w = text.translate({i: i + 32 for i in range(65, 91)})
        w = re.findall("[^\x20\x09-\x0d]+", w)
        sets[d] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}
    root = {d: d for d in docs}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for a in sorted(docs):
        for b in sorted(docs):
            if b < a and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: t for d, t in docs.items() if find(d) == d}


def test_pipeline_against_its_operators_by_hand(spark, duck, library):
    import corpus_pipeline as P
    from smallseq.llm import langid

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.train(docs.select("doc_id", "text", "lang"))
    kept = {}
    for d, t in duck.execute("SELECT doc_id, text FROM documents").fetchall():
        names, score = model.predict([t])
        if names[0] != "und" and score[0] >= P.LEAST_LANGUAGE_SHARE:
            kept[d] = t
    kept = without_repeated_lines(kept)
    kept = without_near_copies(kept)
    con = duckdb.connect()
    # contamination: the SQL's rule
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", list(kept.items()))
    con.execute(f"CREATE VIEW benchmark AS SELECT * FROM '{SF}/benchmark.parquet'")
    bad = {r[0] for r in con.execute(f"SELECT doc_id FROM ({Q.ORACLES['op5_decontaminate']}) WHERE contaminated").fetchall()}
    want = {d: library.encode(t, add_special_tokens=False).ids for d, t in kept.items() if d not in bad}
    got = {r["doc_id"]: r for r in P.run(spark, SF).collect()}
    assert {d: r["ids"] for d, r in got.items()} == want
    assert all(r["n_tokens"] == len(r["ids"]) and r["decoded_sha256"] == hashlib.sha256(library.decode(r["ids"], skip_special_tokens=False).encode()).hexdigest() for r in got.values())


def test_stages_return_the_columns_of_documents(spark):
    import corpus_pipeline as P

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in P.STAGES[:-1]:
        assert stage(spark, docs, SF).schema.simpleString() == docs.schema.simpleString(), name


def test_names():
    assert [n for n in Q.QUERIES if not re.fullmatch(r"op(10|[1-9])_\w+", n)] == []
    assert {int(re.match(r"op(\d+)", n)[1]) for n in Q.QUERIES} == set(range(1, 11))
