"""Spans, tokens, quality and packing on small hand-made tables."""

import itertools
import os
import random
import re
import subprocess
import sys
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rollcall.llm import bpe, packing, pii, quality, secret_scan, spans

LONG = "ab 12 " * 20_000


def reference_spans(text, kinds):
    found = []
    for k, (name, pattern, good) in enumerate(kinds):
        found += [(m.start(), k, m.end(), name) for m in re.finditer(pattern, text) if good(m)]
    return ",".join(f"{n}:{a}:{b}" for a, _, b, n in sorted(found))


def digits(m):
    return sum("0" <= c <= "9" for c in m.group())


def luhn(m):
    d = [int(c) for c in m.group() if c.isdigit()][::-1]
    return sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(d)) % 10 == 0


PII = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.group().split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= digits(m) <= 19 and luhn(m)),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= digits(m) <= 15),
)
SECRETS = (
    ("assign", r"""(?ai:(?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m.group(1)) >= 6),
    ("access", r"AKIA[A-Z0-9]+", lambda m: len(m.group()) >= 20),
    ("hex", r"[0-9a-f]+", lambda m: len(m.group()) >= 24),
)


@pytest.mark.parametrize("seed", range(3))
def test_patterns_equal_plain_search(seed):
    rng = random.Random(seed)
    bits = ["a@b", ".c", "@", "x@y.de", "1.2.3.4", "300.1.1.1", ".5", "4111 1111 1111 1111", "4111-1111", "+1 (555) 123-4567", "+", " ", "9", "é", "\n", "-"]
    for _ in range(3000):
        text = "".join(rng.choices(bits, k=rng.randint(0, 9)))
        assert pii.joined(pii.patterns(text)) == reference_spans(text, PII)
    bits = ["password", "PassWD", "api_key", "ſecret", "token", "=", ":", " ", '"', "'", "AKIA", "ABCDEFGH12345678", "deadbeef", "0123456789abcdef", "é", "x.y", "\n"]
    for _ in range(3000):
        text = "".join(rng.choices(bits, k=rng.randint(0, 9)))
        assert secret_scan.joined(secret_scan.patterns(text)[0]) == reference_spans(text, SECRETS)


def test_patterns_stay_linear():
    assert pii.patterns("1" * 300_000) == [] and pii.patterns("." * 300_000) == []
    assert pii.patterns("a" * 300_000 + "@") == []


def test_field_finds_other_mentions(documents):
    rows = [(i, f"Reach +4930{1000000 + i} now. Again 4930{1000000 + i} later, order {i} of 77 items.") for i in range(200)]
    out = {r.doc_id: r for r in pii.find(documents([*rows, (900, None), (901, ""), (902, LONG), (None, "x")])).collect()}
    assert all(out[i].n_phone == 1 and out[i].n_added == 1 and out[i].spans.count("phone") == 2 for i, _ in rows)
    assert out[900].spans == out[901].spans == out[902].spans == "" and out[None].n_added == 0
    assert pii.find(documents([])).count() == 0


def test_field_labels_without_a_match(documents):
    """A shape that is mostly phone elsewhere is found where no pattern matches, alone or repeated."""
    rows = [(i, f"Call +4930{1000000 + i} or 4930{1000000 + i} of {i} items.") for i in range(200)]
    rows += [(i, f"Call +4930{1000000 + i}x now.") for i in range(200, 400)]
    counts = pii.learn(documents(rows))
    token = pii.shape("(030)55-66")
    counts.node[token] = np.log([0.001, 0.001, 0.001, 0.98, 0.017])
    for text, n in (("Ring (030)55-66 today", 1), ("Ring (030)55-66 or (030)55-66", 2), ("Room 7 of 9", 0)):
        assert [k for k, _, _ in pii.added(text, [], counts)] == ["phone"] * n
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array(["Ring (030)55-66 today"])], names=["row", "text"])
    assert "<PHONE>" in next(pii.masked_texts(iter([batch]), counts)).column(1)[0].as_py()


def test_masked_texts(documents):
    docs = documents([(1, "mail bob@x.org or 10.0.0.1"), (2, None), (3, "plain")])
    out = {r.doc_id: r for r in pii.masked(docs).collect()}
    assert pii.masked(docs).columns == docs.columns
    assert out[1].text == "mail <EMAIL> or <IP>" and out[1].n_chars == 20 and out[2].text is None and out[3].text == "plain"


def test_markov_models_tell_random_strings(documents):
    rng = random.Random(5)
    some = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    word = lambda: "".join(rng.choice(["ka", "to", "mi", "re", "su", "no"]) for _ in range(rng.randint(2, 7)))
    rows = []
    for i in range(150):
        secret, bare = ("".join(rng.choices(some, k=32)) for _ in range(2))
        rows.append((i, f"{' '.join(word() for _ in range(80))} token={secret} and {bare} {word()}{word()}{word()}{word()}{word()}"))
    out = {r.doc_id: r for r in secret_scan.find(documents([*rows, (900, None), (901, ""), (902, LONG)])).collect()}
    hits = sum(out[i].n_added == 1 for i, _ in rows)
    assert hits >= 140 and all(out[i].n_assign == 1 for i, _ in rows) and all(out[i].n_added <= 1 for i, _ in rows)
    assert out[900].spans == out[901].spans == out[902].spans == ""
    assert secret_scan.find(documents([])).count() == 0


def test_secret_models_tell_random_from_ordinary(documents):
    rng = random.Random(2)
    stems = ["configuration", "manager", "service", "provider", "report", "value", "house", "river", "customer", "yellow", "number", "window", "winter"]
    rows = [(i, " ".join(rng.choice(stems) for _ in range(120)) + f" in {1990 + i % 30}.") for i in range(300)]
    ratio, limit = secret_scan.learn(documents(rows))
    states, sure = secret_scan.state_table(), lambda t: secret_scan.total(t, ratio, secret_scan.state_table()) >= limit
    for plain in ("configuration_manager_service_provider", "ReportValueWindowHouse", "customer-number-winter", "-" * 60, "=" * 30, "river/window/house", "YELLOW_NUMBER_VALUE_7"):
        assert not sure(plain), plain
    assert sure("xK9fQ2LmZ7pRt4WvB1")
    fresh = secret_scan.random_strings(600, seed=5)
    mixed = [t for t in fresh if len(t) >= 14 and len(set(t)) > 6 and not set(t) <= set("0123456789abcdef")]
    assert len(mixed) > 400 and sum(map(sure, mixed)) >= 0.97 * len(mixed)
    # What a match leaves of a token is judged by itself.
    text = "AKIA" + "Q" * 16 + "_" + "xK9fQ2LmZ7pRt4WvB1kk"
    base, _ = secret_scan.patterns(text)
    assert secret_scan.added(text, base, (ratio, limit), states) == [("random", 20, len(text))]


def test_covered_ranges():
    assert spans.covered([("a", 0, 4), ("b", 2, 3), ("c", 4, 9), ("a", 12, 13)]) == [(0, 9), (12, 13)]
    taken = [(0, 9), (12, 13)]
    for a, b in itertools.combinations(range(16), 2):
        assert spans.free(a, b, taken) == all(b <= x or y <= a for x, y in taken)
    assert secret_scan.limit_of({0: 10**6, 30: 5, 40: 3}) == 6.0 and secret_scan.limit_of({0: 10**6, 30: 50}) == 31.0


def test_ratios_equal_a_plain_count():
    """The ordinary model's pairs by a dictionary over the same strings."""
    texts = ["the old house", "new_value and an_other one"]
    states, seen = secret_scan.state_table(), {}
    for text in texts:
        data = f" {secret_scan.ordinary(text)} "
        for a, b in itertools.pairwise(data):
            seen[states[ord(a)], states[ord(b)]] = seen.get((states[ord(a)], states[ord(b)]), 0) + 1
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    got = {divmod(c, secret_scan.STATES): n for b in secret_scan.count(iter([batch])) for r, c, n in zip(*[x.to_pylist() for x in b.columns], strict=True) if not r}
    assert got == seen


@pytest.fixture(scope="module")
def vocabulary():
    return pytest.importorskip("public_tokenizers").path(bpe.VOCABULARY)


@pytest.fixture(scope="module")
def model(vocabulary):
    return bpe.Model(bpe.load(vocabulary))


@pytest.fixture(scope="module")
def library(vocabulary):
    return pytest.importorskip("tokenizers").Tokenizer.from_file(vocabulary)


def test_codes_equal_the_library(model, library):
    rng = random.Random(2)
    bits = ["'s", "'re", "'", " ", "\n", "\x1c", "　", "the", "é", "1", "²", "中文", "😀", "_", "<|endoftext|>", "<|endof", "\x00", "ⅷ"]
    encoder = bpe.Encoder(model)
    for _ in range(2000):
        text = "".join(rng.choices(bits, k=rng.randint(0, 14)))
        ids = np.array(library.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        n = rng.randint(1, 5)
        assert b"".join(encoder.encode(text[i : i + n] for i in range(0, len(text), n))) == ids
        assert "".join(bpe.decode([ids[:8], ids[8:]], model)) == text
    for _ in range(200):
        ids = [rng.randrange(50257) for _ in range(20)]
        assert "".join(bpe.decode([np.array(ids, dtype="<u4").tobytes()], model)) == library.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("text", ["a" * 150_000, "é😀" * 40_000, " " * 140_000 + "x", "thereinon" * 9000 + "<|endoftext|>" + "q" * 70_000])
def test_endless_words_stream(model, library, text):
    held = []
    unit = bpe.Transducer(model)
    data = text.encode()[:20_000]
    for i in range(0, len(data), 50):
        unit.feed(data[i : i + 50])
        held.append(len(unit.held))
    assert max(held) <= 2 * model.lookahead + 300
    ids = np.array(library.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
    assert b"".join(bpe.Encoder(model).encode(text[i : i + 65_536] for i in range(0, len(text), 65_536))) == ids


def test_lookahead_settles_boundaries():
    """Every boundary in all strings of a small alphabet is settled by that many bytes."""
    rng = random.Random(8)
    for _ in range(15):
        tokens, merges = [b"a", b"b"], []
        while len(merges) < 5:
            u, v = rng.choice(tokens), rng.choice(tokens)
            if u + v not in tokens:
                merges.append((u, v))
                tokens.append(u + v)
        need = bpe.lookahead(merges)
        ranks = {m: i for i, m in enumerate(merges)}

        def ends(s, ranks=ranks):
            parts = [s[i : i + 1] for i in range(len(s))]
            while any(p in ranks for p in itertools.pairwise(parts)):
                r, i = min((ranks[p], i) for i, p in enumerate(itertools.pairwise(parts)) if p in ranks)
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
            return set(itertools.accumulate(map(len, parts)))

        for _ in range(60):
            head = bytes(rng.choices(b"ab", k=rng.randint(1, 9) + need))
            settled = [{e for e in ends(head + bytes(rng.choices(b"ab", k=12))) if e <= len(head) - need} for _ in range(5)]
            assert all(s == settled[0] for s in settled)


def test_round_trip_of_edge_cases(documents, vocabulary):
    model = bpe.load(vocabulary)
    rows = [(1, None), (2, ""), (3, LONG), (3, LONG), (None, "x")]
    out = bpe.round_trip(documents(rows), model).collect()
    assert [r.n_tokens for r in out if r.doc_id in (1, 2)] == [0, 0]
    assert len({(r.n_tokens, r.ids_sha256) for r in out if r.doc_id == 3}) == 1 and len(out) == 5
    assert bpe.round_trip(documents([]), model).count() == 0


def test_every_word_is_read_by_the_transducer(model, library):
    encoder = bpe.Encoder(model)
    text = "one two one two " + "three" * 100 + " two" + " x" * 70_000
    ids = b"".join(encoder.encode(text[i : i + 65_536] for i in range(0, len(text), 65_536)))
    assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    # Short words once each; the long one is not remembered.
    assert set(encoder.words) == {"one", " two", " one", " x", " "} - ({" "} if " " not in encoder.words else set())
    assert encoder.words.read == len(encoder.words) + 1


def test_tasks_need_no_package(tmp_path):
    """From another folder, with the package on the driver's path only."""
    root = Path(__file__).resolve().parents[2]
    script = f"""
import sys
sys.path.insert(0, {str(root)!r})
from rollcall.session import build_session
from rollcall.llm.queries import QUERIES
spark = build_session("local[2]", 2, "2g", settings={{"spark.checkpoint.dir": {str(tmp_path)!r}}})
for name in ("op10_bpe", "op11_token_store", "op12_prefix_trie", "op13_collocations"):
    print(name, QUERIES[name](spark, "/root/testdata/sf0.001").count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-3000:]
    assert [line.split()[0] for line in done.stdout.splitlines()] == ["op10_bpe", "op11_token_store", "op12_prefix_trie", "op13_collocations"]


def test_quality_learns_and_takes_edge_cases(spark, documents):
    rng = random.Random(9)
    good = lambda: " ".join(rng.choice(["river", "stone", "walks", "green", "over", "the"]) for _ in range(60)) + "."
    bad = lambda: " ".join(rng.choice(["BUY", "now", "$$$", "!!!", "click"]) for _ in range(60))
    rows = [(i, good() if i % 2 else bad()) for i in range(300)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(300)] + [(5000, None, None)], "doc_id long, quality int, toxic int")
    extra = [(900, None), (901, ""), (902, LONG), (None, "x")]
    out = quality.scored(documents([*rows, *extra]), labels).collect()
    assert len(out) == 304 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out)
    held = [r for r in out if r.held_out and r.doc_id is not None and r.doc_id < 300]
    assert len(held) > 60 and np.mean([r.predicted == r.doc_id % 2 for r in held]) > 0.95
    assert quality.scored(documents([]), labels).count() == 0
    assert {r.score for r in quality.scored(documents(rows[:3]), labels.limit(0)).collect()} == {0.5}


def test_best_ends_equal_brute_force():
    rng = random.Random(4)
    for _ in range(40):
        lengths = sorted(rng.sample(range(1, 60), rng.randint(1, 8)))
        counts = [rng.randint(1, 9) for _ in lengths]
        pad = lambda ends, a=lengths, n=counts: sum(c * (min(e for e in ends if e >= x) - x) for x, c in zip(a, n, strict=True))
        for k in (1, 2, 3):
            want = min(pad((*e, lengths[-1])) for m in range(k) for e in itertools.combinations(lengths[:-1], m))
            ends = packing.best_ends(lengths, counts, k)
            assert len(ends) <= k and pad(ends) == want
    assert packing.best_ends([], [], 4) == []


def test_best_ends_of_long_lengths():
    """Against the plain dynamic programme, with lengths far above any rounding."""
    rng = random.Random(6)
    lengths = sorted({int(rng.paretovariate(0.6) * 300) for _ in range(250)})
    counts = [rng.randint(1, 50) for _ in lengths]
    n, k, best = len(lengths), 9, [0] + [10**30] * len(lengths)
    for _ in range(k):
        new = [0] + [10**30] * n
        for j in range(1, n + 1):
            new[j] = min(best[i] + lengths[j - 1] * sum(counts[i:j]) for i in range(j))
        best = new
    ends = packing.best_ends(lengths, counts, k)
    assert set(ends) <= set(lengths) and lengths[-1] in ends and len(ends) <= k
    assert sum(c * min(e for e in ends if e >= x) for x, c in zip(lengths, counts, strict=True)) == best[n]


def test_batches_fit_the_budget(spark, documents):
    rows = [(i, "w " * (i % 50)) for i in range(300)] + [(900, None), (901, LONG), (901, LONG), (None, "x")]
    out = packing.packed(documents(rows), packing.words(F.col("text")), buckets=4, budget=200).collect()
    assert len(out) == 304 and sorted(r.n_tokens for r in out)[-2:] == [40_000, 40_000]
    slots = {(r.bucket, r.batch, r.slot) for r in out}
    assert len(slots) == 304 and all(r.padding == r.bucket_length - r.n_tokens >= 0 for r in out)
    for _, group in itertools.groupby(sorted(out, key=lambda r: (r.bucket, r.batch)), key=lambda r: (r.bucket, r.batch)):
        group = list(group)
        assert len(group) == 1 or len(group) * group[0].bucket_length <= 200
    assert packing.packed(documents([]), packing.words(F.col("text"))).count() == 0
    assert {r.n_tokens for r in documents([(1, " \n"), (2, "")]).select(packing.words(F.col("text")).alias("n_tokens")).collect()} == {0}


def test_shapes_see_whole_tokens():
    long = "a1-" * 200
    assert pii.shape(long + "x") != pii.shape(long + "@") and pii.shape("12-34") == pii.shape("98-76")


def test_labels_of_crowded_tokens():
    """A token that many spans touch takes the first that overlaps it."""
    text = ",".join(["10.0.0.1"] * 30) + " 5 +4930123456789"
    chain = pii.Chain(text, pii.patterns(text))
    assert [pii.LABELS[k] for k in chain.observed] == ["ip", "other", "phone"]


def exact_marginals(chain, factors):
    """Label probabilities by adding up all labellings."""
    n, k = len(chain.spans), len(pii.LABELS)
    out = np.zeros((n, k))
    for labels in itertools.product(range(k), repeat=n):
        if any(o != pii.OTHER and o != x for o, x in zip(chain.observed, labels, strict=True)):
            continue
        weight = sum(0.0 if chain.observed[i] != pii.OTHER else factors.node[chain.shapes[i], x] for i, x in enumerate(labels))
        weight += sum(factors.near[labels[i], labels[j]] for i, j in chain.near) + sum(factors.skip[labels[i], labels[j]] for i, j in chain.skip)
        out[np.arange(n), labels] += np.exp(weight)
    return out / out.sum(axis=1, keepdims=True)


@pytest.mark.parametrize("text", ["tel 4930123456 x", "call +4930123456 or 4930123456 now", "a1 b2 c3 4930123456 then 4930123456"])
def test_beliefs_equal_exact_marginals(documents, text):
    """On trees message passing is exact; with loops it comes near."""
    rows = [(i, f"Call +4930{1000000 + i} or 4930{1000000 + i} of {i} items.") for i in range(100)]
    factors = pii.learn(documents(rows))
    chain = pii.Chain(text, pii.patterns(text))
    got, want = pii.beliefs(chain, factors), exact_marginals(chain, factors)
    loops = len(chain.near) + len(chain.skip) >= len(chain.spans)
    assert np.abs(got - want).max() < (0.1 if loops else 1e-3)
