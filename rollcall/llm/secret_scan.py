"""Secrets: fixed patterns, extended by character Markov models.

Two first-order models over the same characters are compared by their
log-likelihood ratio: one of random strings, learned from labelled samples of them
and from the values the patterns find, one of ordinary words and identifiers,
learned from the texts' words and from identifiers made of them. How much better the random model must
explain a run to be reported is set on documents the models have not seen.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.llm.spans import Span, covered, digest, joined, ordered
from rollcall.llm.support import by_value, table

by_value(__name__)

KINDS = ("assign", "access", "hex")
ALL_KINDS = (*KINDS, "random")
# Fixed: names before a secret value, in either case.
NAMES = ("password", "passwd", "secret", "token", "api_key", "apikey")
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
STATES = len(LETTERS) + 1
# Shortest run that the models judge, and random strings they learn from (a fixed number, made from a seed).
SHORTEST, SAMPLES, SEED = 12, 20_000, 71
# Alphabets and lengths of labelled random strings.
DIGITS, LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
ALPHABETS = (
    DIGITS + LOWER + LOWER.upper(),
    DIGITS + LOWER + LOWER.upper() + "+/",
    DIGITS + LOWER + LOWER.upper() + "_-",
    DIGITS + LOWER,
    DIGITS + LOWER.upper(),
    DIGITS + "abcdef",
)
LENGTHS = (14, 40)
# One in FOLD documents is kept from the models; their ordinary strings set the limit that one in RARE of them may pass.
FOLD, RARE = 10, 100_000
# The limit lies between these, in nats.
LEAST_LIMIT, MOST_LIMIT = 6, 60
# Words of an identifier, and forms that identifiers take.
WORDS = 3
FORMS = ("_", "-", "", "/")
# Share of pairs of one character twice that ordinary strings have at least, as in drawn lines.
TWICE = 0.05


def either_case(pattern: str) -> str:
    """Pattern with each lower-case letter as a class of both cases (ASCII only)."""
    return "".join(f"[{c.upper()}{c}]" if "a" <= c <= "z" else c for c in pattern)


ASSIGN = re.compile(
    "(" + either_case("password|passwd|secret|token|api_?key") + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
# Runs are taken whole, so a least length can be part of the pattern.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{12,}")
# Words of one case but for their first letter, standing alone.
WORD = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z][a-z]+(?![A-Za-z0-9+/_=-])")


def state_table() -> np.ndarray:
    """State of each byte; 0 stands for everything outside the alphabet."""
    out = np.zeros(256, dtype=np.int64)
    for i, c in enumerate(LETTERS):
        out[ord(c)] = i + 1
    return out


def patterns(text: str) -> tuple[list[Span], list[str]]:
    """Matches, leftmost and not overlapping within a kind, and the secret values in them."""
    found, values = [], []
    low = text.lower()
    if any(n in low for n in NAMES):
        for m in ASSIGN.finditer(text):
            if len(m.group(2)) >= 6:
                found.append(("assign", *m.span()))
                values.append(m.group(2))
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            found.append(("access", *m.span()))
            values.append(m.group())
    for m in HEX.finditer(text):
        found.append(("hex", *m.span()))
        values.append(m.group())
    return ordered(found, KINDS), values


def pairs(data: bytes, states: np.ndarray) -> np.ndarray:
    """Counts of neighbouring states."""
    x = states[np.frombuffer(b" " + data + b" ", dtype=np.uint8)]
    return np.bincount(x[:-1] * STATES + x[1:], minlength=STATES * STATES)


def random_strings(n: int = SAMPLES, seed: int = SEED) -> list[str]:
    """Labelled samples of random strings, of several alphabets and lengths."""
    rng = np.random.Generator(np.random.PCG64(seed))
    out = []
    for i in range(n):
        letters = ALPHABETS[i % len(ALPHABETS)]
        out.append("".join(letters[k] for k in rng.integers(0, len(letters), int(rng.integers(LENGTHS[0], LENGTHS[1] + 1)))))
    return out


def identifiers(text: str) -> list[str]:
    """Labelled samples of ordinary strings: identifiers made from a text's words as they follow each other.

    Every run of WORDS words is written in one of the usual forms: with lines or
    dashes between, or with capitals, and now and then a number behind.
    """
    words, out = WORD.findall(text), []
    for k in range(0, len(words), WORDS):
        group = words[k : k + WORDS]
        form = FORMS[k // WORDS % len(FORMS)]
        name = form.join(w.lower() for w in group) if form else "".join(w.capitalize() for w in group)
        kind = k // WORDS % 7
        out.append(name.upper() if kind == 3 else f"{name}{form}{len(name) % 10 + 1}" if kind == 5 else name)
    return out


def ordinary(text: str) -> str:
    """What a text teaches about ordinary strings: its words, identifiers made from them, and what is too short to be judged."""
    return "\n".join([TOKEN.sub(" ", text), *WORD.findall(text), *identifiers(text)])


def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """State pairs of one partition: (random, cell, n)."""
    states = state_table()
    sums = np.zeros((2, STATES * STATES), dtype=np.int64)
    for batch in batches:
        for value in batch.column(0):
            text = value.as_py()
            if not text:
                continue
            _, values = patterns(text)
            if values:
                sums[1] += pairs("\n".join(values).encode(), states)
            sums[0] += pairs(ordinary(text).encode("utf-8", "replace"), states)
    for flag in (0, 1):
        at = np.flatnonzero(sums[flag])
        if len(at):
            yield pa.RecordBatch.from_arrays(
                [pa.array([bool(flag)] * len(at)), pa.array(at), pa.array(sums[flag][at])], names=["random", "cell", "n"]
            )


def ratios(rows: list[tuple[bool, int, int]]) -> np.ndarray:
    """Log-likelihood ratio of each state pair: random over ordinary.

    The random model has the labelled samples besides the counted values. Both are
    smoothed, and pairs with a state outside the alphabet say nothing.
    """
    counts = np.zeros((2, STATES * STATES))
    for flag, cell, n in rows:
        counts[int(flag), cell] = n
    counts[1] += pairs("\n".join(random_strings()).encode(), state_table())
    square = counts[0].reshape(STATES, STATES)
    square[np.diag_indices(STATES)] += TWICE * (square.sum(axis=1) + 10)
    # Of random strings every character is as likely after any other, as far as counts don't tell.
    counts = counts.reshape(2, STATES, STATES) + np.array([0.5, 1.0])[:, None, None]
    p = counts[:, :, 1:] / counts[:, :, 1:].sum(axis=2, keepdims=True)
    out = np.zeros((STATES, STATES))
    out[1:, 1:] = (np.log(p[1]) - np.log(p[0]))[1:]
    return out


def total(token: str, ratio: np.ndarray, states: np.ndarray) -> float:
    """How many nats likelier the random model makes a token."""
    x = states[np.frombuffer(token.encode(), dtype=np.uint8)]
    return float(ratio[x[:-1], x[1:]].sum())


def tally(batches: Iterator[pa.RecordBatch], ratio: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(nats, n): how often held-out ordinary strings come to so many nats, in a partition."""
    states, sums = state_table(), np.zeros(MOST_LIMIT + 1, dtype=np.int64)
    for batch in batches:
        for value in batch.column(0):
            text = value.as_py() or ""
            for token in [*identifiers(text), *WORD.findall(text)]:
                if len(token) >= SHORTEST:
                    sums[int(min(MOST_LIMIT, max(0.0, np.ceil(total(token, ratio, states)))))] += 1
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(sums))), pa.array(sums)], names=["nats", "n"])


def limit_of(counts: dict[int, int]) -> float:
    """The least number of nats that at most one in RARE ordinary strings reach."""
    allowed, above = sum(counts.values()) // RARE, 0
    for nats in range(MOST_LIMIT, LEAST_LIMIT - 1, -1):
        above += counts.get(nats, 0)
        if above > allowed:
            return float(min(nats + 1, MOST_LIMIT))
    return float(LEAST_LIMIT)


def added(text: str, base: list[Span], model: tuple[np.ndarray, float], states: np.ndarray) -> list[Span]:
    """Runs outside the matches that the random model explains better by the limit."""
    (ratio, limit), taken = model, covered(base)
    out, k = [], 0
    for m in TOKEN.finditer(text):
        at, end = m.span()
        while k < len(taken) and taken[k][1] <= at:
            k += 1
        parts, i = [], k
        while i < len(taken) and taken[i][0] < end:
            parts.append((at, taken[i][0]))
            at, i = taken[i][1], i + 1
        for a, b in (*parts, (at, end)):
            if b - a >= SHORTEST and total(text[a:b], ratio, states) >= limit:
                out.append(("random", a, b))
    return out


def scan(batches: Iterator[pa.RecordBatch], model: tuple[np.ndarray, float]) -> Iterator[pa.RecordBatch]:
    states = state_table()
    for batch in batches:
        counts: dict[str, list[int]] = {k: [] for k in KINDS}
        shas, spans, extra = [], [], []
        for value in batch.column(1):
            text = value.as_py() or ""
            base, _ = patterns(text)
            more = added(text, base, model, states)
            kinds = Counter(s[0] for s in base)
            for k in KINDS:
                counts[k].append(kinds[k])
            shas.append(digest(base))
            spans.append(joined(ordered([*base, *more], ALL_KINDS)))
            extra.append(len(more))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                *[pa.array(counts[k], pa.int64()) for k in KINDS],
                pa.array(shas, pa.string()),
                pa.array(spans, pa.string()),
                pa.array(extra, pa.int64()),
            ],
            names=["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "n_added"],
        )


def learn(docs: DataFrame) -> tuple[np.ndarray, float]:
    """Ratios and the limit; at most 2 x 69 x 69 counts and MOST_LIMIT + 1 more reach the driver."""
    held = F.pmod(F.crc32(F.coalesce(F.col("text").cast("string"), F.lit(""))), F.lit(FOLD)) == 0
    rows = docs.where(~held).select("text").mapInArrow(count, "random boolean, cell bigint, n bigint")
    ratio = ratios([tuple(r) for r in rows.groupBy("random", "cell").agg(F.sum("n")).collect()])
    sums = docs.where(held).select("text").mapInArrow(lambda it: tally(it, ratio), "nats bigint, n bigint")
    return ratio, limit_of({r[0]: r[1] for r in sums.groupBy("nats").agg(F.sum("n")).collect()})


def find(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_added.

    The counts and base_sha256 are of pattern matches; ``spans`` has those and the
    ones the models add (kind ``random``), n_added of them: runs of SHORTEST characters or more,
    or what matches leave of them. NULL and empty texts have none. Repeated rows teach and are
    answered each time, rows without doc_id too; no rows give none. Columns besides
    doc_id and text are not looked at.
    """
    model = learn(docs)
    schema = ", ".join(f"n_{k} bigint" for k in KINDS)
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        lambda it: scan(it, model), f"doc_id bigint, {schema}, base_sha256 string, spans string, n_added bigint"
    )


def op5_secrets(spark: SparkSession, directory: str) -> DataFrame:
    return find(table(spark, directory, "documents"))
