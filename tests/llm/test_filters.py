"""Exact dedup, n-gram join and language ID on small hand-made tables."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from rollcall.llm import exact_dedup, langid, ngram_join

LONG = "word " * 30_000


def test_exact_groups_of_edge_cases(documents):
    rows = [(5, "a  b"), (3, "a\tb"), (9, "a b"), (7, None), (6, ""), (8, LONG), (2, LONG), (2, LONG), (None, "alone"), (1, "x")]
    got = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_groups(documents(rows)).collect()}
    assert got == {
        (5, 3, 3, False), (3, 3, 3, True), (9, 3, 3, False), (7, 6, 2, False), (6, 6, 2, True),
        (8, 2, 3, False), (2, 2, 3, True), (None, None, 1, True), (1, 1, 1, True),
    }
    assert exact_dedup.exact_groups(documents([])).count() == 0
    sha = {r.doc_id: r.text_sha256 for r in exact_dedup.exact_groups(documents(rows)).collect()}
    assert sha[5] == hashlib.sha256(b"a b").hexdigest() and sha[7] == hashlib.sha256(b"").hexdigest()


def test_deduplicated_keeps_columns_and_folds_repeated_rows(documents):
    docs = documents([(2, LONG), (2, LONG), (8, LONG), (1, "x"), (None, None)])
    out = exact_dedup.deduplicated(docs)
    assert out.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text) for r in out.collect()) == sorted([(0, None), (1, "x"), (2, LONG)], key=lambda r: r[0])


@pytest.mark.parametrize("bits", [0, 3, 9])
def test_filters_merge_without_loss(bits):
    rng = np.random.Generator(np.random.PCG64(bits))
    prints = rng.integers(0, 2**64, 4000, dtype=np.uint64)
    prints = np.concatenate([prints, prints[:900], prints[:40]])
    whole = exact_dedup.summed(prints, np.ones(len(prints), np.uint64))
    got_p, got_c = [], []
    for block in range(1 << bits):
        mine = prints[(prints >> np.uint64(64 - bits)) == block] if bits else prints
        halves = [exact_dedup.summed(h, np.ones(len(h), np.uint64)) for h in (mine[::2], mine[1::2]) if len(h)]
        decoded = [exact_dedup.decode_block(exact_dedup.encode_block(p, c, bits), block, bits) for p, c in halves]
        if decoded:
            p, c = exact_dedup.summed(np.concatenate([d[0] for d in decoded]), np.concatenate([d[1] for d in decoded]))
            got_p.append(p)
            got_c.append(c)
    assert (np.concatenate(got_p) == whole[0]).all() and (np.concatenate(got_c) == whole[1]).all()


def brute_classes(rows):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets, parent = {}, {}
    for i, text, *_ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(low))
        own = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
        sets.setdefault(i, []).append(own)
        parent[i] = i

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            for x in sets[a]:
                for y in sets[b]:
                    if a < b and x and y and 100 * len(x & y) >= 80 * len(x | y):
                        r, s = root(a), root(b)
                        parent[max(r, s)] = min(r, s)
    return {i: root(i) for i in sets}


def near_copies(seed, common):
    """Random texts, short and long, with edited copies and, if asked for, one passage in most of them."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = [f"p{i}" for i in range(40)]
    texts = [[rng.choice(vocabulary) for _ in range(rng.choice([1, 3, 5, 8, 9, 14, 20, 40, 120]))] for _ in range(60)]
    for t in list(texts):
        for _ in range(rng.randint(0, 4)):
            copy = list(t)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append(copy[: len(copy) - rng.randint(0, 2)] or copy)
    if common:
        texts = [t + passage if rng.random() < 0.7 else t for t in texts]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    return [(i, (" " if rng.random() < 0.5 else "\n").join(t).upper()) for i, t in zip(ids, texts, strict=True)]


@pytest.mark.parametrize(("seed", "common"), [(1, False), (2, True)])
def test_join_equals_brute_force(spark, documents, seed, common):
    rows = near_copies(seed, common)
    out = ngram_join.classes(documents(rows).repartition(3)).collect()
    assert {r.doc_id: r.component_id for r in out} == brute_classes(rows)


def test_join_edge_cases(documents):
    rows = [(4, None), (5, ""), (6, " \n"), (7, "one"), (8, "ONE"), (9, LONG), (3, LONG), (3, LONG), (1, "a b c d e f"), (None, "one"), (1, "one")]
    out = ngram_join.classes(documents(rows)).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in out if r.doc_id is not None) == [
        (1, 1, 1), (1, 2, 1), (3, 1, 3), (3, 1, 3), (4, 0, 4), (5, 0, 5), (6, 0, 6), (7, 1, 1), (8, 1, 1), (9, 1, 3),
    ]
    assert [r.component_id for r in out if r.doc_id is None] == [None]
    assert ngram_join.classes(documents([])).count() == 0


@pytest.mark.parametrize("block", [2, 1024])
def test_hub_lists_scanned_in_blocks(monkeypatch, documents, block):
    """A chain of similar texts whose ends don't link, through lists longer than a block."""
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    monkeypatch.setattr(ngram_join, "MEMBERS", block)
    words = [f"c{i}" for i in range(200)]
    rows = [(i, " ".join(words[4 * i : 4 * i + 100])) for i in range(20)]
    out = ngram_join.classes(documents(rows)).collect()
    assert {r.doc_id: r.component_id for r in out} == brute_classes(rows)


def test_a_passage_of_many_texts_proposes_no_pairs(monkeypatch, documents):
    """Long texts that share a passage only are not held against each other, however many they are."""
    tried = []
    verified = ngram_join.verified
    monkeypatch.setattr(ngram_join, "verified", lambda pairs, *rest: tried.append(pairs.count()) or verified(pairs, *rest))
    # In a large table a passage of so many texts is not common yet.
    monkeypatch.setattr(ngram_join, "COMMON_LEAST", 1000)
    passage = [f"p{i}" for i in range(200)]
    rows = [(i, " ".join([f"w{i}x{j}" for j in range(2400)] + passage)) for i in range(30)]
    rows.append((99, rows[7][1] + " and an end"))
    out = ngram_join.classes(documents(rows)).collect()
    assert {r.doc_id: r.component_id for r in out} == {i: i for i in range(30)} | {99: 7}
    assert tried == [1, 0]


def test_texts_that_follow_themselves_are_split_once(monkeypatch):
    texts = ["a b c d e f", "a b c d e f", None, None, "", "a b c d e f", "g h"]
    n = len(texts)
    columns = [pa.array(range(n)), pa.array([0] * n), pa.array([True] * n), pa.array(range(n)), pa.array(texts)]
    batch = pa.RecordBatch.from_arrays(columns, names=["head", "part", "member", "id", "text"])
    seen = []
    of = ngram_join.Shingler.of
    monkeypatch.setattr(ngram_join.Shingler, "of", lambda self, b, c: seen.extend(b.column(c).to_pylist()) or of(self, b, c))
    (out,) = ngram_join.keyed(iter([batch]), False)
    sizes = [len(x) // 8 for x in out.column(4).to_pylist()]
    assert sizes == [2, 2, 0, 0, 0, 2, 1] and out.column(3).to_pylist() == list(range(n))
    assert len(seen) < n


def test_subsets_meet_for_every_similar_pair():
    """Two light sets that link share a subset of a size both enumerate."""
    for a in range(1, 24):
        for b in range(1, a + 1):
            for i in range(1, b + 1):
                if 5 * i >= 4 * (a + b - i):
                    sizes = set(ngram_join.subset_sizes(a)) & set(ngram_join.subset_sizes(b))
                    assert any(c <= i for c in sizes)


def test_language(documents):
    rng = random.Random(3)
    alphabet = {"aa": "abcdefgh", "bb": "nopqrstu"}
    rows = []
    for i in range(200):
        lang = "aa" if i % 3 else "bb"
        rows.append((i, " ".join("".join(rng.choices(alphabet[lang], k=5)) for _ in range(20)), lang))
    extra = [(1000, None), (1001, ""), (1002, "12 34 !"), (1003, "ABCDE FGHAB " * 9000), (None, "nopqr stu"), (7, "abc", None)]
    out = langid.identify(documents([*rows, *extra])).collect()
    got = {r.doc_id: (r.lang_pred, r.score) for r in out if r.doc_id != 7}
    assert all(got[i][0] == lang for i, _, lang in rows if i != 7)
    assert got[1000] == got[1001] == got[1002] == ("und", 0.0)
    assert got[1003][0] == "aa" and got[None][0] == "bb" and all(0 <= s <= 1 for _, s in got.values())
    kept = langid.identified(documents([*rows, *extra]))
    assert kept.columns == documents([]).columns and kept.count() == len(rows) + 3
    assert langid.identify(documents([])).count() == 0
    assert {r.lang_pred for r in langid.identify(documents([(0, "abc"), (1, "x")])).collect()} == {"und"}


def test_random_letters_are_rejected_and_nothing_else(documents):
    rng = random.Random(5)
    made = lambda syllables: ["".join(rng.choices(syllables, k=rng.randint(1, 3))) for _ in range(60)]
    words = {"aa": made(["al", "pha", "be", "ta", "gam", "ma"]), "bb": made(["u", "no", "dos", "tres", "sei", "ocho"])}
    text = lambda lang, n: " ".join(rng.choice(words[lang]) for _ in range(n))
    clean = [(i, text("ab"[i % 2] * 2, rng.choice([3, 20, 90])), "ab"[i % 2] * 2) for i in range(120)]
    noise = [(1000 + i, " ".join("".join(rng.choices("bcdfghjklmnpqrstvwxyz", k=6)) for _ in range(30))) for i in range(20)]
    short = [(2000, "Qwrt."), (2001, "zzz")]
    empty = [(3000, None), (3001, "12 !"), (None, text("aa", 50))]
    kept = [r.doc_id for r in langid.identified(documents([*clean, *noise, *short, *empty])).collect()]
    assert sorted(k for k in kept if k is not None) == [*range(120), 2000, 2001] and None in kept
    without = [(i, t) for i, t, _ in clean] + empty
    assert langid.identified(documents(without)).count() == len(clean) + 1
    assert langid.identified(documents([])).count() == 0


def test_ties_go_to_the_first_language(documents):
    rows = [(i, "same words here", lang) for i, lang in enumerate(["zz", "yy"] * 20)]
    assert {r.lang_pred for r in langid.identify(documents(rows)).collect()} == {"yy"}


def test_language_vectors_bundle_what_a_loop_bundles():
    letters = langid.Letters(64)
    texts = ["Ab ba, b", "", None, "ÀÉ x"]
    got = langid.bundle(texts, [0, 1, 2, 3], np.arange(4), 4, letters)
    for k, text in enumerate(texts):
        folded = re.sub(r"\s+", " ", " " + "".join(c.lower() if c.isalpha() else " " for c in text or "") + " ")
        want = np.zeros(64)
        for i in range(len(folded) - 2):
            a, b, c = (letters.vector(ord(x)) for x in folded[i : i + 3])
            want += np.roll(a, 2) * np.roll(b, 1) * c
        assert (got[k] == want).all()
