"""Collocations: phrases of two or three words that occur together more often than their parts.

Two passes over the texts. The first counts hashed phrases in a sketch of
fixed size; a phrase whose cell stays below the least count cannot reach it,
so only phrases whose cells and whose parts' cells reach it are candidates, and
none that counts is lost. The second pass sends the candidates of every block of
text, with their counts, to tries by hash. A double-array trie holds its share of
the candidates, advances every one it is sent by one word at a time, and adds
its count to the state it arrives in. However many tries there are, texts are
not read again for them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rollcall.llm.double_array import DoubleArray
from rollcall.llm.support import Scratch, by_value, table

by_value(__name__)

# The fixed values of the score: least count, parts per unit, share of a count that hides a shorter phrase.
LEAST, UNIT, HIDES, TOP = 10, 1_000_000, 50, 2000
# Cells of a sketch are 2^bits, at most 2^MOST_BITS of one byte; more words than PER_CELL of these take further passes.
LEAST_BITS, MOST_BITS, PER_CELL = 16, 28, 10
# Cells of a piece of a sketch.
PIECE = 1 << 16
# Cells of a task's sketch that wait to be sent.
WAITING_CELLS = 1 << 22
# A trie for so many phrases that blocks send, of which there is less than one in PHRASE_BYTES of text; further ones go to further tries.
TRIE_PHRASES, PHRASE_BYTES = 1_000_000, 16
# Bytes of text handled at once, twice as many at most, to the end of the piece they end in.
BLOCK = 3 << 20
# Bytes of text of all langs that wait for a block to be full.
WAITING = 1 << 23
# A-Z become a-z, and characters that end a piece become a stop.
STOP = b"."
SPACE, LINE = ord(" "), ord("\n")
FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ,;:!?\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz" + STOP * 9)


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
    """(lang, distinct words as bytes, word numbers of the positions); stops are number -1.

    Texts of a lang wait for others until they fill a block, so that what is done once per
    distinct word or phrase of a block is done less often; all langs together hold a few blocks.
    """
    waiting: dict[str, list[bytes]] = {}
    sizes: dict[str, int] = {}
    for batch in batches:
        langs = np.array(batch.column(0).to_pylist(), dtype=object)
        texts = batch.column(1).cast(pa.binary()).to_pylist()
        for lang in sorted(set(langs)):
            more = [texts[i].translate(FOLD) for i in np.flatnonzero(langs == lang)]
            waiting.setdefault(lang, []).extend(more)
            sizes[lang] = sizes.get(lang, 0) + sum(map(len, more))
        del texts
        for lang in sorted(waiting, key=sizes.get, reverse=True):
            if sizes[lang] >= BLOCK or sum(sizes.values()) >= WAITING:
                sizes.pop(lang)
                yield from numbered(lang, STOP.join(waiting.pop(lang)))
    for lang in sorted(waiting):
        yield from numbered(lang, STOP.join(waiting.pop(lang)))


def numbered(lang: str, whole: bytes) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
    """The blocks of texts of one lang."""
    at = 0
    while at < len(whole):
        cut = len(whole) if len(whole) - at <= 2 * BLOCK else whole.find(STOP, at + BLOCK)
        cut = len(whole) if cut < 0 else cut
        words = (whole[at:cut] + STOP).replace(STOP, b" . ").replace(b"\t", b" ").strip() + b" "
        # Other white space has become a stop, so words are what ends at a space, which they keep until they are told apart.
        ends = np.flatnonzero(np.frombuffer(words, np.uint8) == SPACE) + 1
        offsets = pa.py_buffer(np.append(0, ends).astype(np.int64))
        found = pa.Array.from_buffers(pa.large_binary(), len(ends), [None, offsets, pa.py_buffer(words)]).dictionary_encode()
        known, ids = np.empty(len(found.dictionary), dtype=object), found.indices.to_numpy()
        known[:] = [w[:-1] for w in found.dictionary.to_numpy(zero_copy_only=False).tolist()]
        number = np.where(known == STOP, -1, np.arange(len(known)))
        empty = known == b""
        ids = ids[~empty[ids]] if empty.any() else ids
        yield lang, known, number[ids]
        at = cut + 1


def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """64 bits from two times 64."""
    h = (a * np.uint64(0x9E3779B97F4A7C15)) ^ ((b + np.uint64(0x632BE59BD9B4E019)) * np.uint64(0xC2B2AE3D27D4EB4F))
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def word_hashes(lang: str, known: np.ndarray) -> tuple[np.ndarray, np.uint64]:
    seed = pd.util.hash_array(np.array([lang], dtype=object), categorize=False)[0]
    return pd.util.hash_array(known, categorize=False), seed


def block_phrases(lang: str, known: np.ndarray, ids: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For two and for three words: distinct word numbers (rows x words), counts and hashes of a block's phrases."""
    if len(known) >= 1 << 21:
        raise ValueError("too many different words in one block")
    hashes, seed = word_hashes(lang, known)
    out = []
    for n in (2, 3):
        columns = [ids[i : len(ids) - n + 1 + i].astype(np.int64) for i in range(n)]
        keep = np.logical_and.reduce([c >= 0 for c in columns]) if len(ids) >= n else np.zeros(0, bool)
        key = np.zeros(int(keep.sum()), np.int64)
        for c in columns:
            key = key * len(known) + c[keep] if len(key) else key
        key, counts = np.unique(key, return_counts=True)
        words = np.empty((len(key), n), np.int64)
        for i in reversed(range(n)):
            key, words[:, i] = np.divmod(key, max(len(known), 1))
        h = np.full(len(words), seed)
        for i in range(n):
            h = mixed(h, hashes[words[:, i]])
        out.append((words, counts, h))
    return out


def cells(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


def of_pass(hashes: np.ndarray, number: int, passes: int) -> np.ndarray:
    return hashes % np.uint64(passes) == np.uint64(number)


def sketched(batches: Iterator[pa.RecordBatch], bits: int, number: int, passes: int) -> Iterator[pa.RecordBatch]:
    """The task's sketch of two- and three-word phrases: pieces with places and counts (at most 255) of full cells.

    Only cells that the task has met are held, however large the sketch is; a piece may come more than once.
    """
    waiting: list[list[np.ndarray]] = [[], []]
    held = 0
    for lang, known, ids in blocks(batches):
        for row, (_, counts, hashes) in zip(waiting, block_phrases(lang, known, ids), strict=True):
            mine = of_pass(hashes, number, passes)
            row.append(cells(hashes[mine], bits) << 8 | np.minimum(counts[mine], 255))
            held += len(row[-1])
        if held >= WAITING_CELLS:
            yield from sketch_rows(waiting)
            waiting, held = [[], []], 0
    yield from sketch_rows(waiting)


def sketch_rows(waiting: list[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
    for level, parts in enumerate(waiting):
        # One sort of cells and counts together, which 255 of are as good as more.
        both = np.sort(np.concatenate([np.zeros(0, np.int64), *parts]))
        if not len(both):
            continue
        cell = both >> 8
        first = np.flatnonzero(np.diff(cell, prepend=-1))
        counts = np.minimum(np.add.reduceat(both & 255, first), 255).astype(np.uint8)
        cell = cell[first]
        pieces, at = np.unique(cell // PIECE, return_index=True)
        spans = list(zip(at.tolist(), [*at[1:].tolist(), len(cell)], strict=True))
        places = (cell % PIECE).astype("<u2")
        data = [places[a:b].tobytes() + counts[a:b].tobytes() for a, b in spans]
        yield pa.RecordBatch.from_arrays(
            [pa.array(pieces + level * (1 << MOST_BITS) // PIECE, pa.int64()), pa.array(data, pa.binary())], names=["piece", "counts"]
        )


def summed_pieces(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """For each piece, a bit for every cell that reaches ``least`` over all tasks."""
    totals: dict[int, np.ndarray] = {}
    for batch in batches:
        for piece, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            n = len(data) // 3
            total = totals.setdefault(piece, np.zeros(PIECE, np.uint8))
            at = np.frombuffer(data, "<u2", n)
            total[at] = np.minimum(total[at].astype(np.int32) + np.frombuffer(data, np.uint8, n, 2 * n), 255)
    yield pa.RecordBatch.from_arrays(
        [pa.array(totals.keys(), pa.int64()), pa.array([np.packbits(t >= least).tobytes() for t in totals.values()], pa.binary())],
        names=["piece", "bits"],
    )


def survivors(
    batches: Iterator[pa.RecordBatch], full: list[np.ndarray], bits: int, number: int, passes: int, tries: int
) -> Iterator[pa.RecordBatch]:
    """(trie, lang, phrases, counts): a block's distinct phrases whose cells are full, with their counts, by trie.

    Of one pass, their parts' cells are full as well. The first pass also sends all single words.
    Every phrase ends with a line end, which no word has.
    """
    for lang, known, ids in blocks(batches):
        word = pa.array(known, pa.binary())
        last = pa.array([w + b"\n" for w in known.tolist()], pa.binary())
        found, many, shard = [], [], []
        if number == 0:
            counts = np.bincount(ids[ids >= 0], minlength=len(known))
            some = np.flatnonzero(counts)
            hashes, seed = word_hashes(lang, known)
            found.append(last.take(pa.array(some)))
            many.append(counts[some])
            shard.append(of_trie(mixed(np.full(len(some), seed), hashes[some]), tries))
        pairs = None
        for level, (words, counts, hashes) in enumerate(block_phrases(lang, known, ids)):
            cell = cells(hashes, bits)
            keep = (full[level][cell >> 3] >> (7 - (cell & 7)).astype(np.uint8)) & 1 == 1
            keep &= of_pass(hashes, number, passes)
            on = np.flatnonzero(keep)
            if level == 0:
                pairs = words[on] @ np.array([len(known), 1])
            elif passes == 1:
                for at in (0, 1):
                    on = on[np.isin(words[on, at : at + 2] @ np.array([len(known), 1]), pairs)]
            columns = [word.take(pa.array(words[on, i])) for i in range(level + 1)] + [last.take(pa.array(words[on, level + 1]))]
            found.append(pc.binary_join_element_wise(*columns, pa.scalar(b" ", pa.binary())))
            many.append(counts[on])
            shard.append(of_trie(hashes[on], tries))
        shard = np.concatenate(shard)
        if not len(shard):
            continue
        order = np.argsort(shard, kind="stable")
        phrases = pa.concat_arrays(found).take(pa.array(order))
        counts = np.concatenate(many)[order].astype("<u4")
        at, first = np.unique(shard[order], return_index=True)
        spans = list(zip(first.tolist(), [*first[1:].tolist(), len(order)], strict=True))
        offsets = np.frombuffer(phrases.buffers()[1], np.int32, len(phrases) + 1, 4 * phrases.offset).tolist()
        data = phrases.buffers()[2] or b""
        columns = [
            pa.array(at, pa.int64()),
            pa.array([lang] * len(at), pa.string()),
            pa.array([data[offsets[a] : offsets[b]].to_pybytes() for a, b in spans], pa.binary()),
            pa.array([counts[a:b].tobytes() for a, b in spans], pa.binary()),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["trie", "lang", "phrases", "counts"])


def of_trie(hashes: np.ndarray, tries: int) -> np.ndarray:
    return (hashes >> np.uint64(8)) % np.uint64(tries)


SENT = "trie bigint, lang string, phrases binary, counts binary"
COUNTS = "lang string, phrase string, f bigint"


def counted(part: pa.Table, least: int) -> pa.Table:
    """(lang, phrase, f) of a trie's phrases that reach ``least``, and (lang, NULL, words) of its single words."""
    counts = [np.frombuffer(c, "<u4") for c in part["counts"].to_pylist()]
    langs = part["lang"].combine_chunks().dictionary_encode()
    lang = np.repeat(langs.indices.to_numpy(), [len(c) for c in counts])
    counts = np.concatenate(counts).astype(np.int64)
    data = b"".join(part["phrases"].to_pylist())
    raw = np.frombuffer(data, np.uint8)
    ends = np.flatnonzero((raw == SPACE) | (raw == LINE))
    done = np.flatnonzero(raw[ends] == LINE)
    # Words are what ends at a space, phrases what ends at a line end.
    first = np.append(0, done[:-1] + 1)
    sizes = done - first + 1
    split = lambda at, text: pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(np.append(0, at + 1).astype(np.int64)), pa.py_buffer(text)])
    words = split(ends, data.replace(b"\n", b" ")).dictionary_encode()
    symbols, n_words = words.indices.to_numpy().astype(np.int64), len(words.dictionary)
    # Word numbers follow no order; those of langs come behind them.
    trie = DoubleArray(n_words + len(langs.dictionary))
    states = trie.extend(np.zeros(len(lang), np.int64), lang.astype(np.int64) + n_words)
    for level in range(3):
        on = np.flatnonzero(sizes > level)
        states[on] = trie.extend(states[on], symbols[first[on] + level])
    # Sums stay below 2^53, so they are whole.
    seen = np.bincount(states, weights=counts).astype(np.int64)
    arrived, where = np.unique(states, return_index=True)
    where = where[seen[arrived] >= least]
    phrases = pc.utf8_rtrim(split(ends[done], data).take(pa.array(where)).cast(pa.large_string()), "\n").cast(pa.string())
    single = np.bincount(lang, weights=np.where(sizes == 1, counts, 0), minlength=len(langs.dictionary)).astype(np.int64)
    names = langs.dictionary
    return pa.table(
        {
            "lang": pa.concat_arrays([names.take(pa.array(lang[where])), names]),
            "phrase": pa.concat_arrays([phrases, pa.nulls(len(names), pa.string())]),
            "f": np.concatenate([seen[states[where]], single]),
        }
    )


def candidates(
    texts: DataFrame, n_bytes: int, least: int, scratch: Scratch, most_bits: int = MOST_BITS, trie_phrases: int = TRIE_PHRASES
) -> DataFrame:
    """(lang, phrase, f): counts of all phrases of one to three words that occur ``least`` times, and parts of a lang's words without phrase."""
    words = max(1, n_bytes // 4)
    bits = min(most_bits, max(LEAST_BITS, math.ceil(math.log2(words / 2))))
    passes = -(-words // (PER_CELL << bits))
    tries = max(1, -(-n_bytes // (trie_phrases * PHRASE_BYTES)))
    found = []
    for number in range(passes):
        pieces = texts.mapInArrow(lambda it, i=number: sketched(it, bits, i, passes), "piece bigint, counts binary")
        full = pieces.repartition("piece").mapInArrow(lambda it: summed_pieces(it, least), "piece bigint, bits binary")
        maps = [np.zeros(max(1 << bits, PIECE) // 8, np.uint8) for _ in range(2)]
        # At most 2^MOST_BITS bits for each of two levels, whatever the size of the texts.
        for r in full.collect():
            level, piece = divmod(r["piece"], (1 << MOST_BITS) // PIECE)
            data = np.frombuffer(r["bits"], np.uint8)
            maps[level][piece * PIECE // 8 : piece * PIECE // 8 + len(data)] = data
        shared = texts.sparkSession.sparkContext.broadcast(maps)
        rows = texts.mapInArrow(lambda it, i=number, m=shared: survivors(it, m.value, bits, i, passes, tries), SENT)
        found.append(scratch.save(rows.groupBy("trie").applyInArrow(lambda part: counted(part, least), COUNTS), "counts"))
        shared.unpersist()
    whole = found[0]
    for more in found[1:]:
        whole = whole.union(more)
    return whole


def frequencies(docs: DataFrame, least: int, scratch: Scratch, trie_phrases: int = TRIE_PHRASES, most_bits: int = MOST_BITS) -> tuple[DataFrame, DataFrame]:
    """Exact (lang, phrase, f) of all phrases and words that occur ``least`` times, and (lang, n) of all words."""
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und"))
    texts = docs.select(lang.alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    n_bytes = texts.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    counts = candidates(texts, n_bytes, least, scratch, most_bits, trie_phrases)
    return counts.where("phrase IS NOT NULL"), counts.where("phrase IS NULL").groupBy("lang").agg(F.sum("f").alias("n"))


def score_of(a: Column, left: Column, right: Column) -> Column:
    """floor(UNIT a² / (l r)) in DECIMAL, which holds 38 digits."""
    wide = [c.cast("decimal(18,0)") for c in (a, a, left, right)]
    top, bottom = wide[0] * wide[1] * F.lit(UNIT).cast("decimal(7,0)"), wide[2] * wide[3]
    return F.call_function("div", top, bottom)


def ranked(f: DataFrame, n: DataFrame, least: int = LEAST, hides: int = HIDES, top: int = TOP) -> DataFrame:
    """Scores from exact counts, without phrases that a longer one accounts for; the first ``top`` of each lang."""
    word = F.split("phrase", " ")
    long = f.where(F.col("f") >= least).withColumn("w", word).where(F.size("w") > 1)
    cuts = long.select("lang", "phrase", F.col("f").alias("a"), F.size("w").alias("words"), F.explode(F.sequence(F.lit(1), F.size("w") - 1)).alias("k"), "w")
    part = lambda a, b: F.array_join(F.slice("w", a, b), " ")
    cuts = cuts.select("lang", "phrase", "a", "words", "k", part(F.lit(1), F.col("k")).alias("left"), part(F.col("k") + 1, F.col("words")).alias("right"))
    for side, name in (("left", "l"), ("right", "r")):
        cuts = cuts.join(f.select("lang", F.col("phrase").alias(side), F.col("f").alias(name)), ["lang", side])
    cuts = cuts.withColumn("score", score_of(F.col("a"), F.col("l"), F.col("r")))
    best = F.min(F.struct("score", "k", "l", "r")).alias("cut")
    scored = cuts.groupBy("lang", "phrase", "a", "words").agg(best).select("lang", "phrase", "a", "words", "cut.*")
    three = long.where(F.size("w") == 3)
    inner = three.select("lang", F.explode(F.array(part(F.lit(1), F.lit(2)), part(F.lit(2), F.lit(2)))).alias("phrase"), "f")
    inner = inner.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    free = scored.join(inner, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < hides * F.col("a")))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    listed = free.withColumn("rank", F.row_number().over(order).cast("bigint")).where(F.col("rank") <= top)
    return listed.join(n, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def collocations(docs: DataFrame, least: int = LEAST, hides: int = HIDES, top: int = TOP, trie_phrases: int = TRIE_PHRASES, most_bits: int = MOST_BITS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` collocations of every lang.

    Pieces end at ``.,;:!?`` and line ends, words at spaces and tabs; A-Z are
    lower-cased. NULL lang is ``und``, NULL text empty. Repeated rows count
    each time. Columns besides lang and text are not looked at; no texts give no rows.
    A trie stands for ``trie_phrases`` phrases; texts are read twice, however many tries there are.
    """
    scratch = Scratch(docs.sparkSession, "phrases")
    return ranked(*frequencies(docs, least, scratch, trie_phrases, most_bits), least, hides, top)


def op13_collocations(spark: SparkSession, directory: str) -> DataFrame:
    return collocations(table(spark, directory, "documents"))


SQL = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), w AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p
), s AS (
  SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w
), f AS (
  SELECT lang, words, array_to_string(list_slice(ws, i, i + words - 1), ' ') AS phrase, count(*) AS f
  FROM (SELECT *, unnest([1, 2, 3]) AS words FROM s) x WHERE i + words - 1 <= len(ws) GROUP BY ALL
), c AS (
  SELECT *, string_split(phrase, ' ') AS w FROM f WHERE words > 1 AND f >= 10
), k AS (
  SELECT *, unnest(range(1, words)) AS k FROM c
), q AS (
  SELECT k.lang, k.phrase, k.words, k.k, k.f AS a, x.f AS l, y.f AS r,
    (1000000::HUGEINT * k.f * k.f) // (x.f::HUGEINT * y.f) AS score
  FROM k JOIN f x ON x.lang = k.lang AND x.phrase = array_to_string(list_slice(k.w, 1, k.k), ' ')
         JOIN f y ON y.lang = k.lang AND y.phrase = array_to_string(list_slice(k.w, k.k + 1, k.words), ' ')
), b AS (
  SELECT * FROM q QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), h AS (
  SELECT lang, phrase, max(f) AS longer FROM (
    SELECT lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase, f FROM c WHERE words = 3) z GROUP BY ALL
), r AS (
  SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank
  FROM b LEFT JOIN h ON h.lang = b.lang AND h.phrase = b.phrase WHERE h.longer IS NULL OR 100 * h.longer < 50 * a
)
SELECT r.lang, rank, phrase, a, l, r, t.n, CAST(score AS BIGINT) AS score
FROM r JOIN (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM w GROUP BY lang) t ON t.lang = r.lang WHERE rank <= 2000
"""
