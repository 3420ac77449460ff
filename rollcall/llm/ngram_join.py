"""Near duplicates by Jaccard similarity of word 5-grams: a size-aware join.

Sets below a boundary are light: they enumerate all subsets of the fixed sizes
that two similar sets must share. Larger ones are heavy: their prefixes under a
global order of shingles are inverted, and the lists are scanned. The boundary is
where the cost of both, taken from the sizes and list lengths of the table, is
least.

Only components are asked for, so a list does not emit its pairs. Every list
first proposes its smallest member to the others, and verified proposals are
contracted. Lists whose members then still lie in different components are
scanned in blocks; parity sketches, which bound the distance of two sets from
below, discard pairs without losing any that links. What remains is verified on
the sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.llm.support import Scratch, by_value, components, joined_small, small, table
from rollcall.llm.wordhash import Hasher, lowered, mix, pieces, random_words, text_bytes

by_value(__name__)

WORDS = 5
# Sets are similar from this Jaccard similarity on, as a fraction.
PART, WHOLE = 4, 5
# Largest set that may be light; the boundary is chosen up to here.
LIGHT = 24
SKETCH_BITS = 1024
SKETCH_LONGS = SKETCH_BITS // 64
# Pairs with more shingles than this are told apart by sketches of 2 ** WIDE_BITS bits.
LONG, WIDE_BITS = 1500, 14
# Shingles are counted in 2 ** CELL_BITS cells, which travel in pieces of 2 ** PIECE_BITS. That only orders prefixes; results don't depend on it.
CELL_BITS, PIECE_BITS = 26, 16
# Cells of a task that wait to be sent.
WAITING_CELLS = 1 << 23
# A shingle is common when its cell has this share of documents, and often met when it has so many and twice the mean of its piece.
COMMON_SHARE, COMMON_LEAST, OFTEN_LEAST = 0.001, 16, 16
# Entries of the inverted lists packed into one bucket.
BUCKET_ENTRIES = 500_000
# Members of a list compared in one task.
BLOCK = 1024
# Members held against one copy of their head: copies are below 2 % of the sets that move, and a large group spreads over many tasks.
MEMBERS = 64
SPACE_BYTES = (32, 9, 10, 11, 12, 13)


def least_common(a: int, b: int) -> int:
    """Shingles that sets of these sizes share at least when they link: 9i >= 4(a + b)."""
    return -(-(a + b) * PART // (PART + WHOLE))


def prefix_length(n: int) -> int:
    """Shingles of a set of size n of which a partner must have one; n >= 1."""
    return n - -(-n * PART // WHOLE) + 1


def subset_sizes(n: int) -> list[int]:
    """Sizes of the subsets that a light set of size n enumerates: one for each possible partner."""
    sizes = range(-(-n * PART // WHOLE), n * WHOLE // PART + 1)
    return sorted({c for b in sizes if b >= 1 and (c := least_common(n, b)) <= min(n, b)})


def subset_count(n: int) -> int:
    return sum(comb(n, c) for c in subset_sizes(n))


class Shingler:
    """Sorted distinct shingle hashes of texts."""

    def __init__(self):
        self.hasher, self.low = Hasher(), lowered()
        self.space = np.zeros(256, dtype=bool)
        self.space[list(SPACE_BYTES)] = True
        self.place = random_words(11, WORDS) | np.uint64(1)
        self.length = random_words(13, WORDS)

    def shingles(self, data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All shingles of some texts, and where each text's begin; repeated ones stay."""
        space = self.space[data]
        start = ~space
        start[1:] &= space[:-1]
        inside = begins[:-1][begins[:-1] < len(data)]
        start[inside] = ~space[inside]
        starts = np.flatnonzero(start)
        stop = np.ones(len(data), dtype=bool)
        stop[:-1] = space[1:]
        last = begins[1:] - 1
        stop[last[last >= 0]] = True
        ends = np.flatnonzero(stop & ~space) + 1
        words = self.hasher.ranges(self.low[data], starts, ends)
        first = np.searchsorted(starts, begins)
        counts = np.diff(first)
        # Five-word windows at every word; those that leave their text are cut out below.
        n = len(words)
        windows = np.zeros(n, dtype=np.uint64)
        for j in range(WORDS):
            windows[: n - j] += words[j:] * self.place[j]
        windows = mix(windows)
        keep = np.zeros(n, dtype=bool)
        owner = np.repeat(np.arange(len(counts)), counts)
        ahead = np.minimum(np.arange(n) + WORDS - 1, n - 1)
        keep[: max(0, n - WORDS + 1)] = True
        keep &= owner[ahead] == owner if n else keep
        for i in np.flatnonzero((counts > 0) & (counts < WORDS)):
            a, b = first[i], first[i + 1]
            keep[a:b] = False
            keep[a] = True
            windows[a] = mix((words[a:b] * self.place[: b - a]).sum(dtype=np.uint64, keepdims=True) + self.length[b - a])[0]
        ends_kept = np.concatenate([[0], np.cumsum(keep)])
        return windows[keep], ends_kept[first]

    def of(self, batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, np.ndarray]]:
        """Row number and set of each text of a batch."""
        data, begins = text_bytes(batch.column(column))
        for a, b in pieces(begins):
            found, first = self.shingles(data[begins[a] : begins[b]], begins[a : b + 1] - begins[a])
            for i in range(b - a):
                yield a + i, np.unique(found[first[i] : first[i + 1]])


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The same rows in small batches: sets take more memory than their texts."""
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)


def cells_of(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - CELL_BITS)).astype(np.uint32)


def tallied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(piece, cells): the cells of the shingles of all sets, once for each set.

    Places of cells in their piece are sorted, first all high bytes, then all low ones, which packs well.
    """
    shingler, waiting, n = Shingler(), [], 0
    for batch in sliced(batches):
        waiting += [cells_of(s) for _, s in shingler.of(batch, 0)]
        n += sum(map(len, waiting[-batch.num_rows :]))
        if n >= WAITING_CELLS:
            yield cell_batch(waiting)
            waiting, n = [], 0
    if n:
        yield cell_batch(waiting)


def cell_batch(waiting: list[np.ndarray]) -> pa.RecordBatch:
    found = np.sort(np.concatenate(waiting))
    pieces_, first = np.unique(found >> np.uint32(PIECE_BITS), return_index=True)
    parts = np.split(found.astype(np.uint16), first[1:])
    data = [(x >> 8).astype(np.uint8).tobytes() + x.astype(np.uint8).tobytes() for x in parts]
    return pa.RecordBatch.from_arrays([pa.array(pieces_, pa.int64()), pa.array(data, pa.binary())], names=["piece", "cells"])


def summed_cells(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """(piece, often, common) from rows sorted by piece: a bit for each cell met often, and the cells of common shingles."""
    now, total = None, np.zeros(0, np.int64)
    for batch in batches:
        for piece, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            if piece != now:
                if now is not None:
                    yield from frequent_cells(now, total, least)
                now, total = piece, np.zeros(1 << PIECE_BITS, np.int64)
            high, low = np.frombuffer(data.as_buffer(), np.uint8).reshape(2, -1)
            total += np.bincount(high.astype(np.int64) << 8 | low, minlength=len(total))
    if now is not None:
        yield from frequent_cells(now, total, least)


def frequent_cells(piece: int, total: np.ndarray, least: float) -> Iterator[pa.RecordBatch]:
    often = total >= OFTEN_LEAST + 2 * total.mean()
    common = total >= least
    if (often | common).any():
        places = (np.flatnonzero(common) + (piece << PIECE_BITS)).astype(np.uint32).tobytes()
        columns = [pa.array([piece], pa.int64()), pa.array([np.packbits(often).tobytes()], pa.binary()), pa.array([places], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["piece", "often", "common"])


# A bit for each cell met often, and the sorted cells of common shingles.
Frequent = tuple[np.ndarray, np.ndarray]


def frequent_shingles(docs: DataFrame, rows: int) -> Frequent:
    """What orders shingles by how many documents have them: 2 ** CELL_BITS bits, and at most the mean number of shingles in a document divided by COMMON_SHARE cells."""
    least = max(COMMON_LEAST, COMMON_SHARE * rows)
    found = docs.select("text").mapInArrow(tallied, "piece bigint, cells binary")
    found = found.repartition("piece").sortWithinPartitions("piece")
    found = found.mapInArrow(lambda it: summed_cells(it, least), "piece bigint, often binary, common binary")
    often, common = np.zeros((1 << CELL_BITS) // 8, np.uint8), [np.zeros(0, np.uint32)]
    for r in found.collect():
        at = (r["piece"] << PIECE_BITS) // 8
        often[at : at + (1 << PIECE_BITS) // 8] = np.frombuffer(r["often"], np.uint8)
        common.append(np.frombuffer(r["common"], np.uint32))
    return often, np.sort(np.concatenate(common))


def is_common(shingles: np.ndarray, frequent: Frequent) -> np.ndarray:
    common = frequent[1]
    if not len(common):
        return np.zeros(len(shingles), dtype=bool)
    cells = cells_of(shingles)
    return common[np.minimum(np.searchsorted(common, cells), len(common) - 1)] == cells


def is_often(shingles: np.ndarray, frequent: Frequent) -> np.ndarray:
    cells = cells_of(shingles)
    return (frequent[0][cells >> np.uint32(3)] >> (7 - (cells & np.uint32(7))).astype(np.uint8)) & 1 == 1


def prefixes(shingles: np.ndarray, frequent: Frequent) -> tuple[np.ndarray, np.ndarray]:
    """The rare and the common part of a prefix.

    The global order has shingles met seldom by hash, then those met often by hash, then common ones by hash:
    what many documents share gets into a prefix last, so lists stay short as tables grow.
    """
    size = prefix_length(len(shingles))
    hot, often = is_common(shingles, frequent), is_often(shingles, frequent)
    rare = np.concatenate([shingles[~hot & ~often], shingles[~hot & often]])[:size]
    return rare, shingles[hot][: size - len(rare)]


def sketch(shingles: np.ndarray) -> list[int]:
    """Parity of the number of shingles in each of SKETCH_BITS cells, as 64-bit integers.

    The bits in which two sketches differ are no more than the shingles in which the sets differ.
    """
    odd = np.bincount((shingles >> np.uint64(64 - 10)).astype(np.int64), minlength=SKETCH_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64).tolist()


def describe(batches: Iterator[pa.RecordBatch], frequent: Frequent) -> Iterator[pa.RecordBatch]:
    """Size, fingerprint of the set, sketch and prefix of each text; small sets are kept whole."""
    shingler, none = Shingler(), np.zeros(0, np.int64)
    for batch in sliced(batches):
        size, one, two, parity, rare, hot, whole = [], [], [], [], [], [], []
        for _, s in shingler.of(batch, 1):
            n = len(s)
            size.append(n)
            one.append(int(mix(s).sum(dtype=np.uint64).view(np.int64)) if n else 0)
            two.append(int(np.bitwise_xor.reduce(mix(s + np.uint64(1))).view(np.int64)) if n else 0)
            parity.append(sketch(s) if n else [0] * SKETCH_LONGS)
            a, b = prefixes(s, frequent) if n else (none, none)
            rare.append(a.view(np.int64))
            hot.append(b.view(np.int64))
            whole.append(s.view(np.int64) if 0 < n < LIGHT else None)
        many = pa.list_(pa.int64())
        kinds = (pa.int64(), pa.int64(), pa.int64(), many, many, many, many)
        found = (size, one, two, parity, rare, hot, whole)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *[pa.array(x, k) for x, k in zip(found, kinds, strict=True)]],
            names=["doc_id", "n", "one", "two", "sketch", "rare", "common", "whole"],
        )


def subset_keys(shingles: np.ndarray, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the subsets of a light set, and whether all shingles of a subset are common.

    There are as many as comb(n, c) for each size c: a few thousand for the largest light set.
    """
    n, values = len(shingles), mix(shingles + np.uint64(99))
    keys, common_ = [], []
    for c in subset_sizes(n):
        at = np.array(list(combinations(range(n), c)))
        keys.append(mix(values[at].sum(axis=1, dtype=np.uint64) + np.uint64(c)))
        common_.append(hot[at].all(axis=1))
    return np.concatenate(keys), np.concatenate(common_)


def entries(batch: pa.RecordBatch, edge: int, frequent: Frequent, hot: bool) -> tuple[np.ndarray, np.ndarray]:
    """Keys and ids of the sets (id, n, rare, common, whole) of a batch.

    Heavy sets, and light ones that a heavy set may link to, enter their prefix;
    light sets enter their subsets. ``hot`` picks the keys made of common
    shingles only; lists of the other keys are no longer than a rare shingle is frequent.
    """
    keys, ids = [], []
    column = batch.column(3 if hot else 2)
    sizes = batch.column(1).to_numpy()
    rows = batch.column(0).to_numpy()
    offsets, flat = column.offsets.to_numpy(), column.values.to_numpy().view(np.uint64)
    for k, n in enumerate(sizes.tolist()):
        if n * WHOLE >= edge * PART:
            keys.append(flat[offsets[k] : offsets[k + 1]])
            ids.append(np.full(len(keys[-1]), rows[k]))
        if n < edge:
            s = np.array(batch.column(4)[k].as_py(), dtype=np.int64).view(np.uint64)
            found, all_hot = subset_keys(s, is_common(s, frequent))
            keys.append(found[all_hot == hot])
            ids.append(np.full(len(keys[-1]), rows[k]))
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(keys), np.concatenate(ids)


def hot_entries(batches: Iterator[pa.RecordBatch], edge: int, frequent: Frequent) -> Iterator[pa.RecordBatch]:
    """(key, id) rows of the keys made of common shingles."""
    for batch in batches:
        keys, ids = entries(batch, edge, frequent, True)
        yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(ids)], names=["key", "id"])


def packed_entries(batches: Iterator[pa.RecordBatch], edge: int, frequent: Frequent, buckets: int) -> Iterator[pa.RecordBatch]:
    """Entries of the other keys, packed by bucket: (bucket, keys, ids)."""
    for batch in batches:
        keys, ids = entries(batch, edge, frequent, False)
        bucket = (mix(keys) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        keys, ids = keys[order], ids[order]
        at, first = np.unique(bucket[order], return_index=True)
        ends = np.append(first[1:], len(keys))
        spans = list(zip(first, ends, strict=True))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(at, pa.int64()),
                pa.array([keys[a:b].tobytes() for a, b in spans], pa.binary()),
                # Only steps between ids: they pack well.
                pa.array([np.diff(ids[a:b], prepend=0).astype("<i8").tobytes() for a, b in spans], pa.binary()),
            ],
            names=["bucket", "keys", "ids"],
        )


def bucket_lists(parts: pd.DataFrame) -> pd.DataFrame:
    """Lists of at least two members in one bucket: (key, id, head), the head being the smallest member."""
    keys = np.concatenate([np.frombuffer(k, np.uint64) for k in parts["keys"]])
    ids = np.concatenate([np.cumsum(np.frombuffer(i, "<i8")) for i in parts["ids"]])
    order = np.lexsort((ids, keys))
    keys, ids = keys[order], ids[order]
    new = np.ones(len(keys), dtype=bool)
    new[1:] = keys[1:] != keys[:-1]
    first = np.flatnonzero(new)
    number = np.cumsum(new) - 1
    last = np.append(first[1:], len(keys)) - 1
    several = (ids[last] != ids[first])[number]
    fresh = new | np.concatenate([[True], ids[1:] != ids[:-1]])
    keep = several & fresh
    return pd.DataFrame({"key": keys[keep].view(np.int64), "id": ids[keep], "head": ids[first][number[keep]]})


def boundary(sets: DataFrame) -> int:
    """The size from which sets are heavy: the one with the least cost in all.

    A light set costs its subsets. A heavy one costs its prefix, and the lists
    of its prefix that are scanned. At most LIGHT rows reach the driver.
    """
    little = sets.where(F.col("n").between(1, LIGHT - 1))
    lists = little.select("n", F.explode(F.concat("rare", "common")).alias("key"))
    lengths = lists.groupBy("key", "n").agg(F.count("*").alias("m"))
    lengths = lengths.join(lengths.groupBy("key").agg(F.sum("m").alias("whole")), "key")
    scans = lengths.groupBy("n").agg(F.sum(F.col("m") * F.col("whole")).cast("double").alias("scan"))
    found = {r["n"]: (r["rows"], r["scan"] or 0.0) for r in little.groupBy("n").agg(F.count("*").alias("rows")).join(scans, "n", "left").collect()}
    cost = {}
    for x in range(1, LIGHT + 1):
        cost[x] = sum(
            rows * subset_count(n) if n < x else rows * prefix_length(n) + scan for n, (rows, scan) in found.items()
        )
    return min(cost, key=lambda x: (cost[x], x))


def parity_close(a: Column, b: Column, sizes: Column) -> Column:
    """Whether the sketches allow a link: |A xor B| <= (|A| + |B|) / 9."""
    bits = sum((F.bit_count(a[i].bitwiseXOR(b[i])) for i in range(1, SKETCH_LONGS)), F.bit_count(a[0].bitwiseXOR(b[0])))
    return bits * (PART + WHOLE) <= sizes


def sizes_close(a: Column, b: Column) -> Column:
    return (F.least(a, b) * WHOLE >= F.greatest(a, b) * PART).cast("boolean")


def wide_sketch(shingles: np.ndarray) -> bytes:
    """The size of a set and a parity sketch that still tells long sets apart."""
    odd = np.bincount((shingles >> np.uint64(64 - WIDE_BITS)).astype(np.int64), minlength=1 << WIDE_BITS) & 1
    return np.uint64(len(shingles)).tobytes() + np.packbits(odd.astype(np.uint8)).tobytes()


def keyed(batches: Iterator[pa.RecordBatch], wide: bool) -> Iterator[pa.RecordBatch]:
    """The set, or its wide sketch, of each text; texts that follow themselves are split once."""
    shingler = Shingler()
    for batch in sliced(batches, 500):
        texts = batch.column(4)
        new = np.ones(len(texts), dtype=bool)
        new[1:] = pc.fill_null(pc.not_equal(texts[1:], texts[:-1]), True).to_numpy(zero_copy_only=False)
        once = pa.RecordBatch.from_arrays([texts.filter(pa.array(new))], names=["text"])
        made = [wide_sketch(s) if wide else s.tobytes() for _, s in shingler.of(once, 0)]
        found = [made[i] for i in (np.cumsum(new) - 1).tolist()]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:4], pa.array(found, pa.binary())], names=["head", "part", "member", "id", "data"]
        )


def similar(x: np.ndarray, y: np.ndarray, wide: bool) -> bool:
    """Whether two sets link; of wide sketches, whether they may."""
    if wide:
        return int(np.bitwise_count(x[1:] ^ y[1:]).sum()) * (PART + WHOLE) <= int(x[0] + y[0])
    both = len(np.intersect1d(x, y, assume_unique=True))
    return WHOLE * both >= PART * (len(x) + len(y) - both)


def links(batches: Iterator[pa.RecordBatch], wide: bool) -> Iterator[pa.RecordBatch]:
    """Similar pairs (head, id), from rows sorted by head, part and member, heads first."""
    place, heads = None, []
    for batch in batches:
        a, b = [], []
        columns = [c.to_pylist() for c in batch.columns[:4]]
        for head, part, member, i, data in zip(*columns, batch.column(4), strict=True):
            x = np.frombuffer(data.as_buffer(), dtype=np.uint64)
            if not member:
                if (head, part) != place:
                    place, heads = (head, part), []
                heads.append(x.copy())
            elif (head, part) == place and any(similar(x, y, wide) for y in heads):
                a.append(head)
                b.append(i)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def matched(pairs: DataFrame, docs: DataFrame, scratch: Scratch, wide: bool) -> DataFrame:
    """The similar ones of the pairs (a, b).

    Sets or sketches are made from the texts of these documents only, and move once: a
    member to its head, a head to as many parts as its members need.
    """
    heads = pairs.groupBy("a").agg(F.ceil(F.count("*") / MEMBERS).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part")
    member = pairs.join(heads, "a").select(F.col("a").alias("head"), part, F.lit(True).alias("member"), F.col("b").alias("id"))
    parts = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    head = heads.select(F.col("a").alias("head"), parts.alias("part"), F.lit(False).alias("member"), F.col("a").alias("id"))
    wanted = scratch.save(member.union(head), "wanted")
    rows = joined_small(docs.withColumnRenamed("doc_id", "id"), wanted, "id", "inner").select("head", "part", "member", "id", "text")
    made = rows.mapInArrow(lambda it: keyed(it, wide), "head bigint, part int, member boolean, id bigint, data binary")
    made = made.repartition("head", "part").sortWithinPartitions("head", "part", "member")
    return scratch.save(made.mapInArrow(lambda it: links(it, wide), "a bigint, b bigint"), "matched")


def verified(pairs: DataFrame, docs: DataFrame, scratch: Scratch) -> DataFrame:
    """The pairs (a, b, long) that link. The small sketches can't tell long sets apart, so wide ones come before the sets."""
    left = pairs.where("NOT long").select("a", "b")
    long = pairs.where("long").select("a", "b")
    if long.limit(1).count():
        left = left.union(matched(long, docs, scratch, True))
    return matched(left, docs, scratch, False)


def by_list(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """Groups of rows with equal leading columns (key, i, j) from batches sorted by them."""
    held: list[np.ndarray] | None = None
    for batch in batches:
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns[:-1]]
        columns.append(batch.column(batch.num_columns - 1).flatten().to_numpy().reshape(-1, SKETCH_LONGS).view(np.uint64))
        if held is not None:
            columns = [np.concatenate([h, c]) for h, c in zip(held, columns, strict=True)]
        n = len(columns[0])
        if not n:
            continue
        new = np.ones(n, dtype=bool)
        new[1:] = np.any([c[1:] != c[:-1] for c in columns[:3]], axis=0)
        at = [*np.flatnonzero(new).tolist(), n]
        for a, b in zip(at[:-2], at[1:-1], strict=True):
            yield [c[a:b] for c in columns]
        held = [c[at[-2] :] for c in columns]
    if held is not None:
        yield held


def cross(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of one block of a list from different components that the sketches don't rule out."""
    left, right, total = [], [], []
    for _, i, j, part, ids, sizes, comps, sketches in by_list(batches):
        one = np.flatnonzero(part == i[0])
        two = np.flatnonzero(part == j[0])
        for k in one.tolist():
            other = two[two > k] if i[0] == j[0] else two
            other = other[comps[other] != comps[k]]
            a, b = np.minimum(sizes[other], sizes[k]), np.maximum(sizes[other], sizes[k])
            other = other[a * WHOLE >= b * PART]
            if len(other):
                bits = np.bitwise_count(sketches[other] ^ sketches[k]).sum(axis=1, dtype=np.int64)
                other = other[bits * (PART + WHOLE) <= sizes[other] + sizes[k]]
                left += [ids[k]] * len(other)
                right += ids[other].tolist()
                total += (sizes[other] + sizes[k]).tolist()
        if len(left) > 20_000:
            yield pair_batch(left, right, total)
            left, right, total = [], [], []
    if left:
        yield pair_batch(left, right, total)


def pair_batch(left: list[int], right: list[int], total: list[int]) -> pa.RecordBatch:
    a, b = np.array(left, dtype=np.int64), np.array(right, dtype=np.int64)
    columns = [np.minimum(a, b), np.maximum(a, b), np.array(total) > LONG]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["a", "b", "long"])


def classes(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, set_id.

    set_id is the smallest doc_id with an equal set of shingles. NULL and empty
    texts and those of white space have no shingles and link with nothing. Rows
    that repeat a doc_id are one document, whose texts count as linked. Rows
    without doc_id have no component_id. No rows give no rows.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "ngram")
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    shared = spark.sparkContext.broadcast(frequent_shingles(docs, docs.count()))
    long, many = "bigint", "array<bigint>"
    described = docs.mapInArrow(
        lambda it: describe(it, shared.value),
        f"doc_id {long}, n {long}, one {long}, two {long}, sketch {many}, rare {many}, common {many}, whole {many}",
    )
    described = scratch.save(described, "described")
    prints = scratch.save(described.select("doc_id", "n", "one", "two"), "prints")
    # Equal sets are one from here on: that of the smallest doc_id.
    filled = described.where("n > 0 AND doc_id IS NOT NULL")
    equal = prints.where("n > 0 AND doc_id IS NOT NULL").groupBy("one", "two").agg(F.min("doc_id").alias("id"), F.count("*").alias("m"))
    equal = scratch.save(equal.where("m > 1").select("one", "two", "id"), "equal")
    spare = joined_small(prints.where("n > 0"), equal, ["one", "two"], "inner").where("doc_id != id").select("doc_id", "one")
    spare = scratch.save(spare.distinct(), "spare")
    sets = joined_small(filled, spare, ["doc_id", "one"], "left_anti").withColumnRenamed("doc_id", "id")
    edge = boundary(sets)

    # Lists of at least two members, each member with the smallest one as its head.
    short = sets.select("id", "n", "rare", "common", "whole")
    total = short.agg(F.sum(F.size("rare"))).first()[0] or 0
    buckets = max(1, -(-total // BUCKET_ENTRIES))
    packed = short.mapInArrow(lambda it: packed_entries(it, edge, shared.value, buckets), "bucket bigint, keys binary, ids binary")
    rare = packed.groupBy("bucket").applyInPandas(bucket_lists, "key bigint, id bigint, head bigint")
    hot = short.where(F.col("n") < edge).union(short.where((F.col("n") >= edge) & (F.size("common") > 0)))
    hot = hot.mapInArrow(lambda it: hot_entries(it, edge, shared.value), "key bigint, id bigint").distinct()
    hot = scratch.save(hot, "hot")
    heads = hot.groupBy("key").agg(F.min("id").alias("head"), F.max("id").alias("tail")).where("head != tail").select("key", "head")
    listed = scratch.save(rare.union(hot.join(heads, "key").select("key", "id", "head")), "listed")
    members = scratch.save(listed.select("id").distinct(), "members")
    about = scratch.save(joined_small(sets.select("id", "n", "sketch"), members, "id", "left_semi"), "about")
    scratch.drop("described", "hot", "members")

    # Contract: every member tries the smallest list head that its sketch allows.
    pairs = listed.where(F.col("id") != F.col("head")).select("id", "head").distinct()
    others = about.select(F.col("id").alias("head"), F.col("n").alias("m"), F.col("sketch").alias("other"))
    near = pairs.join(about, "id").join(others, "head")
    near = near.where(sizes_close(F.col("n"), F.col("m")) & parity_close(F.col("sketch"), F.col("other"), F.col("n") + F.col("m")))
    first = F.min(F.struct("head", (F.col("n") + F.col("m") > LONG).alias("long"))).alias("first")
    near = near.groupBy("id").agg(first).select(F.col("first.head").alias("a"), F.col("id").alias("b"), "first.long")
    linked = verified(scratch.save(near, "proposed"), docs, scratch)
    joined = scratch.save(components(linked, scratch), "joined")
    part = F.coalesce("component", "id")
    placed = joined_small(about, joined.withColumnRenamed("node", "id"), "id", "left").select("id", "n", part.alias("comp"), "sketch")
    placed = scratch.save(placed, "placed")

    # Scan: lists that still touch several components, block against block; equal lists once.
    open_lists = joined_small(listed.select("key", "id"), placed.select("id", "comp"), "id", "inner").groupBy("key")
    open_lists = open_lists.agg(
        F.min("comp").alias("x"), F.max("comp").alias("y"), F.count("*").alias("m"), F.sum(F.xxhash64("id").cast("decimal(20,0)")).alias("who")
    ).where("x != y")
    open_lists = open_lists.groupBy("who", "m").agg(F.min("key").alias("key"))
    open_lists = scratch.save(open_lists.select("key", F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks")), "open")
    rows = joined_small(listed.select("key", "id"), open_lists, "key", "inner")
    rows = rows.withColumn("part", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    against = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda b: F.struct(F.least(b, "part").alias("i"), F.greatest(b, "part").alias("j")))
    rows = rows.select("key", "id", "part", F.explode(against).alias("pair")).select("key", "pair.i", "pair.j", "part", "id")
    rows = rows.join(placed, "id").select("key", "i", "j", "part", "id", "n", "comp", "sketch")
    rows = rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "id")
    left_over = scratch.save(rows.mapInArrow(cross, "a bigint, b bigint, long boolean").distinct(), "candidates")
    more = verified(left_over, docs, scratch)
    scratch.drop("listed", "about", "placed", "open", "wanted")

    # Rows that share a doc_id, or a set, are in one component.
    shares = joined_small(prints.where("n > 0 AND doc_id IS NOT NULL"), equal, ["one", "two"], "inner")
    shares = shares.where("doc_id != id").select(F.col("id").alias("a"), F.col("doc_id").alias("b"))
    final = scratch.save(components(linked.union(more).union(shares), scratch), "final")
    found = joined_small(prints, equal, ["one", "two"], "left")
    found = joined_small(found, final.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    scratch.drop("edges", "candidates", "joined", "spare")
    return found.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("component", "doc_id").alias("component_id"),
        F.when(F.col("n") > 0, F.coalesce("id", "doc_id")).otherwise(F.col("doc_id")).alias("set_id"),
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents with the smallest doc_id of each component, with all their columns.

    Rows without doc_id stay. Documents without shingles stay.
    """
    found = classes(docs).where(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias("_id"))
    gone = Scratch(docs.sparkSession, "gone").save(found.distinct(), "gone")
    gone = (F.broadcast(gone) if small(gone) else gone).alias("g")
    return docs.alias("d").join(gone, F.col("d.doc_id").cast("bigint") == F.col("g._id"), "left_anti")


def op1_ngram_join(spark: SparkSession, directory: str) -> DataFrame:
    return classes(table(spark, directory, "documents"))
