"""Byte-pair encoding as a streaming transducer with bounded lookahead.

Whether two neighbouring tokens are ever merged is settled once enough bytes to
the right of their boundary are known. ``lookahead`` computes how many are enough
for a merge list; the transducer emits every token that ends that far before the
end of what it has read and keeps only the rest. Decoding feeds token bytes
through a small machine that holds back an unfinished UTF-8 character.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.llm.support import by_value, table

by_value(__name__)

VOCABULARY = "byte_bpe_50k.json"
# Characters read at once, and the longest word encoded in one piece (in bytes).
PIECE = 65_536
WORD_BYTES = 256
# Encoded words remembered in a task; the memory is emptied when full.
REMEMBERED = 400_000

# Fixed: the pattern by which this tokenizer family cuts texts into words.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# The same for texts without the characters that the standard library classes otherwise.
PLAIN = r"'(?:[stmd]|re|ve|ll)| ?[^\W\d_]+| ?\d+| ?(?:[^\w\s]|_)+|\s+(?!\S)|\s+"
# Letters, digits and punctuation on which both patterns agree.
ODD = "[^\\t-\\r -~\\u00a0-\\u00b1\\u00b4-\\u00b8\\u00ba\\u00bb\\u00bf-\\u024f\\u2010-\\u2027\\u2030-\\u205e\\u20ac]"
# A word that never ends, by the class of its first character after an optional space.
RUNS = (r" ?\p{L}+", r" ?\p{N}+", r" ?[^\s\p{L}\p{N}]+", r"\s+")


def byte_letters() -> dict[str, int]:
    """The printable stand-in of every byte in vocabulary files of this family."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


def lookahead(merges: list[tuple[bytes, bytes]]) -> int:
    """Bytes to the right of a boundary that settle it, for any text.

    A merge (u, v) fails only if the right end of v is taken by an earlier merge
    (s, x), where s is v or a right part of it that is still alone at that time. That
    merge is settled by bytes to the right of v, in turn. Ranks fall along such a
    chain, so its longest extent follows in one pass by rank.
    """
    made: dict[bytes, tuple[int, bytes]] = {}
    # By left part: ranks in ascending order with the largest extent so far.
    ranks: dict[bytes, list[int]] = {}
    extents: dict[bytes, list[int]] = {}
    longest = 1
    for rank, (u, v) in enumerate(merges):
        extent, piece, taken = 0, v, rank
        while True:
            known = ranks.get(piece, ())
            lo, hi = 0, len(known)
            while lo < hi:
                mid = (lo + hi) // 2
                lo, hi = (mid + 1, hi) if known[mid] < taken else (lo, mid)
            if lo:
                extent = max(extent, extents[piece][lo - 1])
            if piece not in made:
                break
            taken, piece = made[piece]
        reach = len(v) + extent
        ranks.setdefault(u, []).append(rank)
        held = extents.setdefault(u, [])
        held.append(max(reach, held[-1]) if held else reach)
        made.setdefault(u + v, (rank, v))
        longest = max(longest, reach)
    return longest


class Model:
    """Merge ranks, token bytes and special tokens of a vocabulary file."""

    def __init__(self, text: str, reach: int | None = None):
        """``reach`` is the lookahead, where it is known already."""
        data = json.loads(text)
        letters = byte_letters()
        raw = lambda s: bytes(letters[c] for c in s)
        self.special = {t["content"]: t["id"] for t in data.get("added_tokens", [])}
        vocab = {raw(t): i for t, i in data["model"]["vocab"].items() if t not in self.special}
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in data["model"]["merges"]]
        merges = [(raw(a), raw(b)) for a, b in pairs]
        self.lookahead = lookahead(merges) if reach is None else reach
        self.ids = vocab
        self.rank: dict[tuple[int, int], tuple[int, int]] = {}
        for r, (a, b) in enumerate(merges):
            self.rank.setdefault((vocab[a], vocab[b]), (r, vocab[a + b]))
        self.single = [vocab[bytes([b])] for b in range(256)]
        self.bytes = [b""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for token, i in [*vocab.items(), *((k.encode(), i) for k, i in self.special.items())]:
            self.bytes[i] = token

    def merge(self, word: bytes) -> list[int]:
        """Ids of a byte string: the lowest rank merges first, the leftmost of equal ones."""
        got = self.ids.get(word) if len(word) == 1 else None
        if got is not None:
            return [got]
        ids = [self.single[b] for b in word]
        if len(ids) > 64:
            return self.merge_long(ids)
        none, rank = (1 << 60, 0), self.rank.get
        pairs = [rank(p, none) for p in zip(ids, ids[1:], strict=False)]
        while pairs:
            best = min(pairs)
            if best is none:
                break
            i = pairs.index(best)
            ids[i : i + 2] = [best[1]]
            del pairs[i]
            if i:
                pairs[i - 1] = rank((ids[i - 1], best[1]), none)
            if i < len(pairs):
                pairs[i] = rank((best[1], ids[i + 1]), none)
        return ids

    def merge_long(self, ids: list[int]) -> list[int]:
        """The same with a heap and linked neighbours."""
        n, rank = len(ids), self.rank
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        alive = [True] * n
        heap = [(*f, i, ids[i], ids[i + 1]) for i in range(n - 1) if (f := rank.get((ids[i], ids[i + 1])))]
        heapq.heapify(heap)
        # Order by rank, then place.
        heap = [(r, i, new, a, b) for r, new, i, a, b in heap]
        heapq.heapify(heap)
        while heap:
            _, i, new, a, b = heapq.heappop(heap)
            j = after[i] if alive[i] else n
            if not alive[i] or j >= n or ids[i] != a or ids[j] != b:
                continue
            ids[i], alive[j] = new, False
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                if f := rank.get((new, ids[after[i]])):
                    heapq.heappush(heap, (f[0], i, f[1], new, ids[after[i]]))
            if (p := before[i]) >= 0 and (f := rank.get((ids[p], new))):
                heapq.heappush(heap, (f[0], p, f[1], ids[p], new))
        return [x for x, ok in zip(ids, alive, strict=True) if ok]


class Transducer:
    """Tokens of one word read in pieces; keeps what the lookahead does not settle yet."""

    def __init__(self, model: Model):
        self.model = model
        self.held = b""

    def feed(self, data: bytes) -> list[int]:
        self.held += data
        settled = len(self.held) - self.model.lookahead
        if settled <= 0:
            return []
        out, end = [], 0
        for token in self.model.merge(self.held):
            size = len(self.model.bytes[token])
            if end + size > settled:
                break
            out.append(token)
            end += size
        self.held = self.held[end:]
        return out

    def finish(self) -> list[int]:
        out = self.model.merge(self.held) if self.held else []
        self.held = b""
        return out


class Words(dict):
    """Little-endian 32-bit ids by word; the transducer reads words not met yet.

    Words of up to WORD_BYTES bytes are remembered, so the memory is bounded.
    """

    def __init__(self, model: Model):
        super().__init__()
        self.model = model
        self.read = 0

    def __missing__(self, word: str) -> bytes:
        data = word.encode("utf-8", "surrogatepass")
        unit, out, step = Transducer(self.model), [], self.model.lookahead
        self.read += 1
        for i in range(0, len(data), step):
            out += unit.feed(data[i : i + step])
        packed = np.array(out + unit.finish(), dtype="<u4").tobytes()
        if len(data) <= WORD_BYTES:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = packed
        return packed


class Encoder:
    """Packed ids of a text read in pieces; what it keeps doesn't grow with the text.

    A word is settled once three characters after its end are known, which covers
    every lookahead of the pattern. A word without end goes through the transducer.
    """

    def __init__(self, model: Model, words: Words | None = None):
        self.model = model
        self.words = Words(model) if words is None else words
        self.full = regex.compile(PATTERN)
        self.plain = re.compile(PLAIN)
        self.odd = re.compile(ODD)
        self.runs = [regex.compile(r) for r in RUNS]
        self.special = max((len(s) for s in model.special), default=1)
        self.split = re.compile("|".join(map(re.escape, model.special))) if model.special else None

    def cut(self, text: str) -> list[str]:
        return (self.full if self.odd.search(text) else self.plain).findall(text)

    def whole(self, text: str) -> bytes:
        """Packed ids of a text without special tokens in it."""
        return b"".join(map(self.words.__getitem__, self.cut(text)))

    def encode(self, pieces: Iterable[str]) -> Iterator[bytes]:
        held = ""
        for piece in pieces:
            held += piece
            if self.split:
                # A special token ends the text before it.
                while m := self.split.search(held):
                    yield from self.run(held[: m.start()])
                    yield np.array([self.model.special[m.group()]], dtype="<u4").tobytes()
                    held = held[m.end() :]
            if len(held) > 2 * self.special + 64:
                out, held = self.settled(held)
                yield out
                if len(held) > PIECE:
                    held = yield from self.endless(held)
        yield from self.run(held)

    def run(self, text: str) -> Iterator[bytes]:
        """A stretch that ends here, for instance before a special token."""
        held = ""
        for i in range(0, len(text), PIECE):
            held += text[i : i + PIECE]
            out, held = self.settled(held)
            yield out
            if len(held) > PIECE:
                held = yield from self.endless(held)
        yield self.whole(held)

    def settled(self, held: str) -> tuple[bytes, str]:
        """Packed ids of the words that later characters can't change, and the rest."""
        words = self.cut(held)
        safe = len(held) - max(3, self.special)
        rest, end = len(words), len(held)
        while rest and end > safe:
            rest -= 1
            end -= len(words[rest])
        return b"".join(map(self.words.__getitem__, words[:rest])), held[end:]

    def endless(self, held: str) -> Iterator[bytes]:
        """Start on a word longer than a piece: its settled tokens go out, its text stays short."""
        for run in self.runs:
            m = run.match(held)
            if m and m.end() > PIECE // 2:
                unit = Transducer(self.model)
                # The last characters stay, as what follows may change where the word ends.
                keep = max(self.special, 3) + 1
                body = held[: m.end() - keep]
                out = []
                data = body.encode("utf-8", "surrogatepass")
                step = max(WORD_BYTES, self.model.lookahead)
                for i in range(0, len(data), step):
                    out += unit.feed(data[i : i + step])
                ends = len(data) - len(unit.held)
                # What is kept must begin with a whole character: go back to such a token.
                while out and ends < len(data) and (data[ends] & 0xC0) == 0x80:
                    ends -= len(self.model.bytes[out.pop()])
                yield np.array(out, dtype="<u4").tobytes()
                return data[ends:].decode("utf-8", "surrogatepass") + held[m.end() - keep :]
        return held


class TextDecoder:
    """Text of a byte stream read in pieces: the state is an unfinished character of up to three bytes."""

    def __init__(self):
        self.held = b""

    def feed(self, data: bytes) -> str:
        data = self.held + data
        cut = len(data)
        # Look back for a lead byte whose character is not complete yet.
        for back in range(1, min(3, len(data)) + 1):
            b = data[-back]
            if b >= 0xC0:
                cut -= back if back < (2 if b < 0xE0 else 3 if b < 0xF0 else 4) else 0
                break
            if b < 0x80:
                break
        self.held = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def finish(self) -> str:
        out, self.held = self.held.decode("utf-8", "replace"), b""
        return out


def decode(parts: Iterable[bytes], model: Model) -> Iterator[str]:
    """Text of packed ids that come in parts."""
    unit = TextDecoder()
    for packed in parts:
        ids = np.frombuffer(packed, dtype="<u4")
        for i in range(0, len(ids), PIECE):
            yield unit.feed(b"".join(map(model.bytes.__getitem__, ids[i : i + PIECE].tolist())))
    yield unit.finish()


def hashed(parts: Iterable[bytes], digest) -> Iterator[bytes]:
    """The same parts, each added to ``digest`` as it passes."""
    for packed in parts:
        digest.update(packed)
        yield packed


def coded(batches: Iterator[pa.RecordBatch], vocabulary: str, reach: int) -> Iterator[pa.RecordBatch]:
    """Encode and decode texts part by part: neither all ids nor the decoded text of one are ever held."""
    encoder = Encoder(Model(vocabulary, reach))
    for batch in batches:
        counts, ids_sha, text_sha = [], [], []
        for value in batch.column(1):
            text = value.as_py() or ""
            ids, back = hashlib.sha256(), hashlib.sha256()
            parts = encoder.encode(text[i : i + PIECE] for i in range(0, len(text), PIECE))
            n_bytes = [0]
            for part in decode(hashed(counted(parts, n_bytes), ids), encoder.model):
                back.update(part.encode("utf-8", "surrogatepass"))
            counts.append(n_bytes[0] // 4)
            ids_sha.append(ids.hexdigest())
            text_sha.append(back.hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())],
            names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )


def counted(parts: Iterable[bytes], total: list[int]) -> Iterator[bytes]:
    """The same parts; ``total[0]`` grows by their bytes."""
    for packed in parts:
        total[0] += len(packed)
        yield packed


def load(path: str) -> str:
    """The text of a vocabulary file that the driver can read."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def round_trip(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 per row of ``docs``.

    NULL texts are empty and have no tokens; repeated rows are answered each
    time; no rows give none; a text of any length is read in pieces. Columns
    besides doc_id and text are not looked at. The vocabulary has a fixed size, so its text is
    broadcast; tasks build the model from it.
    """
    reach = Model(vocabulary).lookahead
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        lambda it: coded(it, shared.value, reach), "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )


def op10_bpe(spark: SparkSession, directory: str, path: str | None = None) -> DataFrame:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)
    return round_trip(table(spark, directory, "documents"), load(path))
