"""Collocations against brute force."""

import random
import re
from collections import Counter

import pyarrow as pa
import pytest

from rollcall.llm import phrases
from rollcall.llm.support import Scratch

SMALL = "/root/testdata/sf0.001"


def brute(rows, least=10, hides=50, top=2000):
    f, n = Counter(), Counter()
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\\x0A-\\x0D]", (text or "").translate(fold)):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for k in (1, 2, 3):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i : i + k])] += 1
    cands = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    out = {}
    for (lang, p), a in cands.items():
        inside = [b for (x, q), b in cands.items() if x == lang and len(q) == 3 > len(p) and p in (q[:2], q[1:])]
        if any(100 * b >= hides * a for b in inside):
            continue
        cuts = [(1_000_000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        phrase = " ".join(p)
        out.setdefault(lang, []).append((-score, -a, phrase.encode(), (lang, phrase, a, f[lang, p[:k]], f[lang, p[k:]], n[lang], score)))
    rows = set()
    for lang in out:
        for rank, (_, _, _, row) in enumerate(sorted(out[lang])[:top], 1):
            rows.add((row[0], rank, *row[1:]))
    return rows


def tuples(df):
    rows = [(r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def made(seed, docs=60):
    rng = random.Random(seed)
    words = ["a", "B", "the", "é", "x\x1cy", "zz q", "ÀA", "\x00", "of", "Of"]
    text = lambda: "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\x0b"]) for _ in range(rng.choice([0, 3, 40, 200])))
    return [(rng.choice(["en", "de", None, "und", ""]), text() if rng.random() > 0.1 else None) for _ in range(docs)]


@pytest.mark.parametrize(
    "least,top,tries,bits", [(10, 2000, 1_500_000, 27), (3, 5, 40, 27), (2, 2000, 1_500_000, 8)]
)
def test_collocations_equal_brute_force(spark, least, top, tries, bits):
    rows = made(least)
    frame = spark.createDataFrame([(i, t, x) for i, (x, t) in enumerate(rows)], "doc_id long, text string, lang string")
    frame = frame.selectExpr("*", "1 AS id", "2 AS n", "3 AS phrase", "4 AS `a.b`")
    got = tuples(phrases.collocations(frame, least=least, top=top, trie_phrases=tries, most_bits=bits))
    assert got == brute(rows, least=least, top=top) and got


def test_several_sketch_passes_lose_nothing(spark, monkeypatch):
    rows = made(9, 200)
    monkeypatch.setattr(phrases, "LEAST_BITS", 6)
    frame = spark.createDataFrame([(t, x) for x, t in rows], "text string, lang string")
    assert tuples(phrases.collocations(frame, most_bits=6)) == brute(rows)


def test_blocks_and_long_texts(spark, monkeypatch):
    monkeypatch.setattr(phrases, "BLOCK", 50)
    rows = [("en", "in a row, in a row; in a row " * 40), ("en", "one long piece without any end " * 30), ("en", None), (None, "")]
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([x or "und" for x, _ in rows]), pa.array([t or "" for _, t in rows])], names=["lang", "text"])
    pieces = [[known[i] if i >= 0 else b"." for i in ids] for _, known, ids in phrases.blocks(iter([batch]))]
    assert len(pieces) > 5
    flat = b" ".join(w for p in pieces for w in p)
    want = b" . ".join(p.strip() for p in re.split(b"[.,;:!?\n]", ".".join(t or "" for _, t in rows).encode()))
    assert [w for w in flat.split() if w != b"."] == [w for w in want.split() if w != b"."]


def test_candidates_keep_every_frequent_phrase(spark):
    rows = made(4)
    frame = spark.createDataFrame([("und" if x is None else x, t or "") for x, t in rows], "lang string, text string")
    found = {(r.lang, r.phrase) for r in phrases.candidates(frame, 1, 10, Scratch(spark, "test"), most_bits=16).collect()}
    assert {(r[0], r[2]) for r in brute(rows, hides=10**9)} <= found


def test_scores_are_exact_beyond_64_bits(spark):
    a, left, right = 10**13 + 7, 10**15 + 1, 10**13 + 9
    row = spark.createDataFrame([(a, left, right)], "a long, l long, r long")
    from pyspark.sql import functions as F

    assert row.select(phrases.score_of(F.col("a"), F.col("l"), F.col("r"))).first()[0] == 1_000_000 * a * a // (left * right)


def test_no_texts_and_the_small_table(spark):
    assert phrases.collocations(spark.createDataFrame([], "text string, lang string")).count() == 0
    rows = [(r.lang, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    assert tuples(phrases.op13_collocations(spark, SMALL)) == brute(rows)


def test_texts_of_many_batches_share_blocks(monkeypatch):
    texts = [("en", "The\tcat  sat. "), ("de", "Der Hund"), ("en", ""), ("en", "a cat,the end"), ("de", " \t "), ("en", "sat\nThe cat")]
    batches = [pa.RecordBatch.from_arrays([pa.array([x], pa.string()) for x in row], names=["lang", "text"]) for row in texts]

    def read():
        return [(lang, [b"." if i < 0 else known[i] for i in ids]) for lang, known, ids in phrases.blocks(iter(batches))]

    found = read()
    assert [lang for lang, _ in found] == ["de", "en"]
    assert found[0][1] == b"der hund . .".split()
    assert found[1][1] == b"the cat sat . . . a cat . the end . sat . the cat .".split()
    # Small blocks, and few texts that wait, hold the same words.
    for block, waiting in ((4, 100), (1000, 10)):
        monkeypatch.setattr(phrases, "BLOCK", block)
        monkeypatch.setattr(phrases, "WAITING", waiting)
        small = read()
        assert len(small) > 2
        assert sorted(w for _, words in small for w in words if w != b".") == sorted(w for _, words in found for w in words if w != b".")


def test_words_keep_their_numbers_without_the_spaces_around_them():
    whole = b"  a\tb  ab .a. \t c  b"
    ((lang, known, ids),) = phrases.numbered("x", whole)
    words = ["a", "b", "ab", ".", "a", ".", "c", "b", "."]
    assert lang == "x" and [known[i].decode() if i >= 0 else "." for i in ids] == words
    assert not any(w.startswith(b" ") or w.endswith(b" ") for w in known.tolist())


def test_a_sketch_adds_up_cells_that_phrases_share(monkeypatch):
    monkeypatch.setattr(phrases, "cells", lambda hashes, bits: (hashes % phrases.np.uint64(3)).astype(phrases.np.int64))
    batch = pa.RecordBatch.from_arrays([pa.array(["x"] * 2), pa.array(["a b " * 400, "c d e f g h"])], names=["lang", "text"])
    (_, known, ids), *_ = phrases.blocks(iter([batch]))
    for level, (_, counts, hashes) in enumerate(phrases.block_phrases("x", known, ids)):
        expected = phrases.np.minimum(phrases.np.bincount((hashes % phrases.np.uint64(3)).astype(int), counts, 3), 255)
        pieces = [b.to_pylist()[0] for b in phrases.sketched(iter([batch]), 16, 0, 1)]
        data = next(p["counts"] for p in pieces if p["piece"] == level * (1 << phrases.MOST_BITS) // phrases.PIECE)
        n = len(data) // 3
        at, got = phrases.np.frombuffer(data, "<u2", n), phrases.np.frombuffer(data, phrases.np.uint8, n, 2 * n)
        assert dict(zip(at.tolist(), got.tolist())) == {i: int(e) for i, e in enumerate(expected) if e}


def test_texts_are_read_as_often_for_many_tries(spark, monkeypatch):
    rows = made(10)
    frame = spark.createDataFrame([(t, x) for x, t in rows], "text string, lang string")
    calls = spark.sparkContext.accumulator(0)
    passed = phrases.blocks

    def counting(batches):
        calls.add(1)
        yield from passed(batches)

    monkeypatch.setattr(phrases, "blocks", counting)
    reads = []
    for trie_phrases in (1_000_000, 20):
        before = calls.value
        assert tuples(phrases.collocations(frame.coalesce(1), trie_phrases=trie_phrases)) == brute(rows)
        reads.append(calls.value - before)
    assert reads == [2, 2]


def test_a_trie_adds_up_what_blocks_send():
    sent = [(0, "en", b"a\na b\na b c\nb\n", [5, 2, 1, 300]), (0, "de", b"a\na b\n", [9, 1]), (0, "en", b"a b\nb c\xc3\xa9 a\na\n", [4, 7, 1])]
    columns = [pa.array([r[i] for r in sent]) for i in range(3)] + [pa.array([phrases.np.array(r[3], "<u4").tobytes() for r in sent])]
    out = phrases.counted(pa.table(dict(zip(("trie", "lang", "phrases", "counts"), columns, strict=True))), 6).to_pylist()
    assert {(r["lang"], r["phrase"], r["f"]) for r in out} == {
        ("en", "a", 6), ("en", "a b", 6), ("en", "b", 300), ("en", "b cé a", 7), ("de", "a", 9), ("en", None, 306), ("de", None, 9),
    }


def test_a_sketch_holds_the_cells_it_met_only(monkeypatch):
    """Pieces that are sent early add up, and a large sketch takes no more memory than its phrases."""
    batch = pa.RecordBatch.from_arrays([pa.array(["x"] * 3), pa.array(["a b c " * 300, "d e f", "a b c d"])], names=["lang", "text"])
    monkeypatch.setattr(phrases, "BLOCK", 5)
    wanted = {}
    for _, known, ids in phrases.blocks(iter([batch])):
        for level, (_, counts, hashes) in enumerate(phrases.block_phrases("x", known, ids)):
            for c, n in zip(phrases.cells(hashes, 40).tolist(), counts.tolist()):
                wanted[level, c] = wanted.get((level, c), 0) + n
    monkeypatch.setattr(phrases, "MOST_BITS", 40)
    monkeypatch.setattr(phrases, "WAITING_CELLS", 4)
    got = {}
    for rows in phrases.sketched(iter([batch]), 40, 0, 1):
        for r in rows.to_pylist():
            level, piece = divmod(r["piece"], (1 << 40) // phrases.PIECE)
            n = len(r["counts"]) // 3
            for at, k in zip(phrases.np.frombuffer(r["counts"], "<u2", n).tolist(), r["counts"][2 * n :]):
                got[level, piece * phrases.PIECE + at] = got.get((level, piece * phrases.PIECE + at), 0) + k
    assert got == {k: n if n < 256 else got[k] for k, n in wanted.items()} and all(got[k] >= 255 for k, n in wanted.items() if n > 255)
