"""Personal data: fixed patterns, extended by a skip-chain conditional random field.

The field labels the tokens that hold a digit or an at sign. Tokens inside a
pattern match are observed. A node factor scores a token's shape, a chain factor
neighbouring tokens, and a skip factor ties distant tokens with the same
digits, or the same mailbox name, to each other. Loopy message passing over a
document lets an observed entity label its other mentions. The factors are
learned piecewise: each is the conditional frequency of labels in its own
cliques, counted over all documents.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.llm.spans import Span, covered, digest, free, joined, ordered, replaced
from rollcall.llm.support import by_value, table

by_value(__name__)

KINDS = ("email", "ip", "card", "phone")
LABELS = (*KINDS, "other")
OTHER = len(KINDS)
SHAPES = 4096
# Pseudo-counts: equal labels on both ends of an edge, and different ones.
SAME, DIFFERENT, UNSEEN = 60.0, 1.0, 0.5
ROUNDS, DAMPING, SURE = 12, 0.3, 0.9

DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
MAILBOX = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# Every ip and card match lies within one such region.
REGION = re.compile(r"[0-9][0-9. -]*")
# A start inside a run of digits fails as its beginning does, so only beginnings are tried.
ADDRESS = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
HINT = re.compile(r"[0-9@]")
GAP = re.compile(r"\s")
TRIM = ".,;:!?()[]{}<>\"'"


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) << (i & 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def patterns(text: str) -> list[Span]:
    """Pattern matches: leftmost, not overlapping within a kind; failing ones are dropped."""
    found, end = [], 0
    if "@" in text:
        for m in DOMAIN.finditer(text):
            start = m.start()
            while start > end and text[start - 1] in MAILBOX:
                start -= 1
            if start < m.start():
                found.append(("email", start, m.end()))
                end = m.end()
    for region in REGION.finditer(text):
        a, b = region.span()
        if b - a < 7:
            continue
        for m in ADDRESS.finditer(text, a, b):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
                found.append(("ip", *m.span()))
        for m in CARD.finditer(text, a, b):
            digits = only_digits(m.group())
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= len(only_digits(m.group())) <= 15:
                found.append(("phone", *m.span()))
    return ordered(found, KINDS)


def shape(token: str) -> int:
    """Letters and digits by run and rough length, other characters as they are; hashed."""
    out = []
    for run in re.findall(r"[0-9]+|[^\W\d_]+|.", token, re.S):
        if run[0].isdigit() and run.isascii():
            n = len(run)
            out.append("0123456789abc"[min(12, n if n < 4 else 4 + (n - 4) // 3)] + "d")
        else:
            out.append("a" if run[0].isalpha() else run)
    return zlib.crc32("".join(out).encode("utf-8", "replace")) % SHAPES


def key_of(token: str) -> str:
    """What repeated or similar tokens have in common; '' without enough of it."""
    if "@" in token:
        name = token.split("@", 1)[0].strip(TRIM).lower()
        return "@" + name if len(name) >= 3 else ""
    digits = only_digits(token).lstrip("0")
    return digits[-9:] if len(digits) >= 7 else ""


def tokens(text: str) -> list[tuple[int, int]]:
    """Spans of the tokens between white space that hold a digit or an at sign."""
    out, at = [], 0
    while m := HINT.search(text, at):
        start = m.start()
        while start > at and not text[start - 1].isspace():
            start -= 1
        stop = GAP.search(text, m.end())
        at = stop.start() if stop else len(text)
        out.append((start, at))
    return out


class Chain:
    """A document's tokens, observed labels and edges."""

    def __init__(self, text: str, base: list[Span]):
        self.spans = tokens(text)
        n = len(self.spans)
        self.shapes = np.array([shape(text[a:b]) for a, b in self.spans], dtype=np.int64)
        self.observed = np.full(n, OTHER)
        j = 0
        by_start = sorted(base, key=lambda s: s[1])
        for i, (a, b) in enumerate(self.spans):
            while j < len(by_start) and by_start[j][2] <= a:
                j += 1
            m = j
            while m < len(by_start) and by_start[m][1] < b:
                if by_start[m][2] > a:
                    self.observed[i] = KINDS.index(by_start[m][0])
                    break
                m += 1
        # Neighbours stand side by side; skip edges lead to the last token with the same key.
        self.near = [(i, i + 1) for i in range(n - 1) if self.spans[i + 1][0] - self.spans[i][1] == 1]
        last: dict[str, int] = {}
        self.skip = []
        for i, (a, b) in enumerate(self.spans):
            if k := key_of(text[a:b]):
                if k in last:
                    self.skip.append((last[k], i))
                last[k] = i


    def known(self) -> np.ndarray:
        """Tokens with a label to learn from: not those without a match that another mention has."""
        out, mark = np.ones(len(self.spans), dtype=bool), self.observed.tolist()
        # Forth and back along the skip edges, so a mention anywhere is seen.
        for pairs in (self.skip, [(j, i) for i, j in reversed(self.skip)]):
            for i, j in pairs:
                if mark[i] != OTHER and mark[j] == OTHER:
                    mark[j], out[j] = mark[i], False
        return out


def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Labels in the cliques of one partition: (factor, cell, n)."""
    node = np.zeros((SHAPES, len(LABELS)), dtype=np.int64)
    edges = np.zeros((2, len(LABELS), len(LABELS)), dtype=np.int64)
    for batch in batches:
        for value in batch.column(0):
            text = value.as_py()
            if not text or not HINT.search(text):
                continue
            chain = Chain(text, patterns(text))
            known = chain.known()
            np.add.at(node, (chain.shapes[known], chain.observed[known]), 1)
            for f, pairs in enumerate((chain.near, chain.skip)):
                for i, j in pairs:
                    if known[i] and known[j]:
                        edges[f, chain.observed[i], chain.observed[j]] += 1
    rows = [("node", c) for c in (node,)] + [("near", edges[0]), ("skip", edges[1])]
    names, cells, counts = [], [], []
    for name, block in rows:
        flat = block.ravel()
        at = np.flatnonzero(flat)
        names += [name] * len(at)
        cells += at.tolist()
        counts += flat[at].tolist()
    if names:
        yield pa.RecordBatch.from_arrays(
            [pa.array(names), pa.array(cells, pa.int64()), pa.array(counts, pa.int64())], names=["factor", "cell", "n"]
        )


class Factors:
    """Log factors from counts."""

    def __init__(self, counts: list[tuple[str, int, int]]):
        k = len(LABELS)
        node, edges = np.zeros((SHAPES, k)), {"near": np.zeros((k, k)), "skip": np.zeros((k, k))}
        for name, cell, n in counts:
            (node if name == "node" else edges[name]).reshape(-1)[cell] = n
        # A shape not met yet says nothing.
        node += UNSEEN / k
        self.node = np.log(node / node.sum(axis=1, keepdims=True))
        self.near = self.edge(edges["near"], SAME / 4)
        self.skip = self.edge(edges["skip"], SAME)

    @staticmethod
    def edge(counts: np.ndarray, same: float) -> np.ndarray:
        """How much more often two labels meet than by chance; pseudo-counts favour equal ones."""
        k = len(counts)
        both = counts + counts.T
        both = both + np.where(np.eye(k, dtype=bool), same, DIFFERENT)
        share = both / both.sum()
        one = share.sum(axis=1)
        return np.log(share / np.outer(one, one))


def beliefs(chain: Chain, factors: Factors) -> np.ndarray:
    """Label probabilities of every token after loopy message passing."""
    n, k = len(chain.spans), len(LABELS)
    local = factors.node[chain.shapes].copy()
    seen = chain.observed != OTHER
    local[seen] = -30.0
    local[seen, chain.observed[seen]] = 0.0
    pairs = np.array([*chain.near, *chain.skip], dtype=np.int64).reshape(-1, 2)
    if not len(pairs):
        return np.exp(local - np.logaddexp.reduce(local, axis=1)[:, None])
    kind = np.array([0] * len(chain.near) + [1] * len(chain.skip))
    table_ = np.stack([factors.near, factors.skip])[kind]
    # Messages run both ways; the factors are symmetric.
    source, target = np.concatenate([pairs[:, 0], pairs[:, 1]]), np.concatenate([pairs[:, 1], pairs[:, 0]])
    back = np.concatenate([np.arange(len(pairs)) + len(pairs), np.arange(len(pairs))])
    table_ = np.concatenate([table_, table_])
    messages = np.zeros((len(source), k))
    for _ in range(ROUNDS):
        total = local.copy()
        np.add.at(total, target, messages)
        out = total[source] - messages[back]
        new = np.logaddexp.reduce(out[:, :, None] + table_, axis=1)
        new -= np.logaddexp.reduce(new, axis=1)[:, None]
        messages = DAMPING * messages + (1 - DAMPING) * new
    total = local.copy()
    np.add.at(total, target, messages)
    total -= np.logaddexp.reduce(total, axis=1)[:, None]
    return np.exp(total).reshape(n, k)


def added(text: str, base: list[Span], factors: Factors) -> list[Span]:
    """Further mentions: tokens outside the matches that the field is sure of."""
    chain = Chain(text, base)
    if not chain.spans:
        return []
    p, taken = beliefs(chain, factors), covered(base)
    out = []
    for i, (a, b) in enumerate(chain.spans):
        label = int(p[i].argmax())
        if label == OTHER or chain.observed[i] != OTHER or p[i, label] < SURE:
            continue
        while a < b and text[a] in TRIM:
            a += 1
        while b > a and text[b - 1] in TRIM:
            b -= 1
        if a < b and free(a, b, taken):
            out.append((KINDS[label], a, b))
    return out


def scan(batches: Iterator[pa.RecordBatch], factors: Factors) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: dict[str, list[int]] = {k: [] for k in KINDS}
        shas, spans, extra = [], [], []
        for value in batch.column(1):
            text = value.as_py() or ""
            base = patterns(text)
            more = added(text, base, factors)
            kinds = Counter(s[0] for s in base)
            for k in KINDS:
                counts[k].append(kinds[k])
            shas.append(digest(base))
            spans.append(joined(ordered([*base, *more], KINDS)))
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


def learn(docs: DataFrame) -> Factors:
    """Factors from all texts; the table of counts has at most 4,096 shapes by five labels, and two of five by five."""
    counts = docs.select("text").mapInArrow(count, "factor string, cell bigint, n bigint")
    rows = counts.groupBy("factor", "cell").agg(F.sum("n").alias("n")).collect()
    return Factors([(r["factor"], r["cell"], r["n"]) for r in rows])


def find(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added.

    The counts and base_sha256 are of pattern matches; ``spans`` has those and the
    ones the field adds, n_added of them; an added span may share no character with a match.
    NULL and empty texts have none. Repeated rows teach and are answered each time,
    rows without doc_id too; no rows give none. Columns besides doc_id and text are not looked at.
    """
    factors = learn(docs)
    schema = ", ".join(f"n_{k} bigint" for k in KINDS)
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        lambda it: scan(it, factors),
        f"doc_id bigint, {schema}, base_sha256 string, spans string, n_added bigint",
    )


def masked_texts(batches: Iterator[pa.RecordBatch], factors: Factors) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for value in batch.column(1):
            text = value.as_py()
            if text and HINT.search(text):
                base = patterns(text)
                text = replaced(text, ordered([*base, *added(text, base, factors)], KINDS))
            out.append(text)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=["row", "clean"])


def masked(docs: DataFrame) -> DataFrame:
    """The documents with every span as a mark, ``<EMAIL>`` and so on, and n_chars to match where there is one.

    All rows and columns stay; NULL texts stay NULL.
    """
    factors = learn(docs)
    names = docs.columns
    boxed = docs.select(F.struct(*[F.col(f"`{c}`") for c in names if c != "text"]).alias("row"), "text")
    schema = T.StructType([boxed.schema["row"], T.StructField("clean", T.StringType())])
    out = boxed.mapInArrow(lambda it: masked_texts(it, factors), schema)
    length = F.length("clean").cast("bigint")
    made = {"text": F.col("clean"), "n_chars": F.coalesce(length, F.col("row.n_chars")) if "n_chars" in names else None}
    return out.select(*[(made[c] if c in made else F.col(f"row.`{c}`")).alias(c) for c in names])


def op3_pii(spark: SparkSession, directory: str) -> DataFrame:
    return find(table(spark, directory, "documents"))
