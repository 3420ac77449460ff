"""Exact duplicates by counting quotient filters.

Every partition builds a counting quotient filter over the 64-bit fingerprints
of its texts. A fingerprint is split into block, quotient and remainder; a
filter block stores the quotients' run lengths, the sorted remainders and the
counts above one. Blocks of all partitions with one number are merged by
their sorted remainders, which loses nothing: the merged filter is the one a
single pass would have built. Only fingerprints counted more than once are
looked at again, byte by byte.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.llm.support import SPACES, Scratch, by_value, joined_small, table

by_value(__name__)

# Fingerprints expected in a block of the merged filter.
BLOCK_ROWS = 50_000
# Bits of the quotient within a block.
QUOTIENT_BITS = 16


def encode_block(prints: np.ndarray, counts: np.ndarray, block_bits: int) -> bytes:
    """A filter block: sorted distinct fingerprints of one block number, with counts."""
    rest_bits = 64 - block_bits - QUOTIENT_BITS
    inner = prints << np.uint64(block_bits) if block_bits else prints
    quotients = (inner >> np.uint64(64 - QUOTIENT_BITS)).astype(np.uint32)
    remainders = prints & np.uint64((1 << rest_bits) - 1)
    occupied, runs = np.unique(quotients, return_counts=True)
    many = np.flatnonzero(counts > 1)
    head = np.array([len(occupied), len(prints), len(many)], dtype="<u4")
    return b"".join(
        x.tobytes()
        for x in (
            head,
            occupied.astype("<u2"),
            runs.astype("<u4"),
            remainders.astype("<u8"),
            many.astype("<u4"),
            counts[many].astype("<u8"),
        )
    )


def decode_block(data: bytes, block: int, block_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints, in ascending order, and counts of a filter block."""
    rest_bits = 64 - block_bits - QUOTIENT_BITS
    n_occupied, n, n_many = (int(x) for x in np.frombuffer(data, "<u4", 3))
    at = 12
    parts = []
    for kind, size in (("<u2", n_occupied), ("<u4", n_occupied), ("<u8", n), ("<u4", n_many), ("<u8", n_many)):
        parts.append(np.frombuffer(data, kind, size, at))
        at += size * int(kind[2])
    occupied, runs, remainders, many, more = parts
    quotients = np.repeat(occupied.astype(np.uint64), runs)
    prints = (quotients << np.uint64(rest_bits)) | remainders.astype(np.uint64)
    if block_bits:
        prints |= np.uint64(block) << np.uint64(64 - block_bits)
    counts = np.ones(n, dtype=np.uint64)
    counts[many] = more
    return prints, counts


def summed(prints: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge sorted runs: equal fingerprints become one with the sum of counts."""
    order = np.argsort(prints, kind="stable")
    prints, counts = prints[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], prints[1:] != prints[:-1]]))
    return prints[first], np.add.reduceat(counts, first)


def build_filters(batches: Iterator[pa.RecordBatch], block_bits: int) -> Iterator[pa.RecordBatch]:
    """The filter of one partition, block by block; memory is 16 bytes a row of the partition."""
    seen = [b.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) for b in batches if b.num_rows]
    if not seen:
        return
    prints = np.concatenate(seen)
    prints, counts = summed(prints, np.ones(len(prints), dtype=np.uint64))
    numbers = (prints >> np.uint64(64 - block_bits)).astype(np.int64) if block_bits else np.zeros(len(prints), np.int64)
    blocks, first = np.unique(numbers, return_index=True)
    ends = np.append(first[1:], len(prints))
    data = [encode_block(prints[i:j], counts[i:j], block_bits) for i, j in zip(first, ends, strict=True)]
    for i in range(0, len(data), 1000):
        yield pa.RecordBatch.from_arrays(
            [pa.array(blocks[i : i + 1000], pa.int64()), pa.array(data[i : i + 1000], pa.binary())],
            names=["block", "filter"],
        )


def merge_filters(parts: pd.DataFrame, block_bits: int) -> pd.DataFrame:
    """Merge the blocks of all partitions with one number; fingerprints counted twice or more."""
    decoded = [decode_block(d, int(b), block_bits) for b, d in zip(parts["block"], parts["filter"], strict=True)]
    prints, counts = summed(np.concatenate([p for p, _ in decoded]), np.concatenate([c for _, c in decoded]))
    many = counts > 1
    return pd.DataFrame({"fp": prints[many].view(np.int64), "copies": counts[many].astype(np.int64)})


def normalised(docs: DataFrame) -> DataFrame:
    """doc_id and the text with each run of white space as one space; NULL counts as empty."""
    text = F.regexp_replace(F.coalesce(F.col("text"), F.lit("")), SPACES, " ")
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"))


def repeated(prints: DataFrame, rows: int) -> DataFrame:
    """(fp, copies) of the fingerprints that occur more than once in column ``fp``."""
    block_bits = max(0, math.ceil(math.log2(max(rows, 1) / BLOCK_ROWS)))
    filters = prints.select("fp").mapInArrow(lambda it: build_filters(it, block_bits), "block bigint, filter binary")
    return filters.groupBy("block").applyInPandas(lambda p: merge_filters(p, block_bits), "fp bigint, copies bigint")


def exact_groups(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    NULL texts equal empty ones. Rows that repeat a doc_id count in group_size,
    and all rows with the smallest doc_id of a group are marked kept; a group
    without any doc_id has a NULL keep_id and is kept. No rows give no rows.
    Columns besides doc_id and text are not looked at.
    """
    scratch = Scratch(docs.sparkSession, "exact")
    texts = normalised(docs)
    fp = F.xxhash64("text").alias("fp")
    sha = F.unhex(F.sha2("text", 256)).alias("sha")
    rows = scratch.save(texts.select("doc_id", fp, sha), "prints")
    twice = scratch.save(repeated(rows, rows.count()), "twice")
    # Byte verification: equal texts of these fingerprints meet; copies are folded map-side, before the shuffle.
    again = joined_small(texts.select("doc_id", "text", fp), twice.select("fp"), "fp", "left_semi")
    groups = again.groupBy("text").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    groups = groups.where("group_size > 1").select(sha, "keep_id", "group_size")
    groups = scratch.save(groups, "groups")
    out = joined_small(rows.select("doc_id", "sha"), groups.withColumn("found", F.lit(True)), "sha", "left")
    keep = F.when(F.col("found"), F.col("keep_id")).otherwise(F.col("doc_id"))
    return out.select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("bigint")).alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def deduplicated(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns; rows that repeat a doc_id and text leave one."""
    kept = exact_groups(docs).where("kept").groupBy("doc_id", "text_sha256").agg(F.count("*").alias("n"))
    kept = Scratch(docs.sparkSession, "kept").save(kept, "kept")
    sha = F.sha2(F.regexp_replace(F.coalesce(F.col("d.text"), F.lit("")), SPACES, " "), 256)
    on = F.col("k.doc_id").eqNullSafe(F.col("d.doc_id").cast("bigint")) & (F.col("k.text_sha256") == sha)
    out = docs.alias("d").join(kept.where("n = 1").alias("k"), on, "left_semi")
    again = kept.where("n > 1")
    if not again.limit(1).count():
        return out
    row = F.struct(*[F.col(f"d.`{c}`") for c in docs.columns])
    more = docs.alias("d").join(again.alias("k"), on).groupBy("k.doc_id", "k.text_sha256").agg(F.first(row).alias("row"))
    return out.union(more.select("row.*"))


def op8_exact_dedup(spark: SparkSession, directory: str) -> DataFrame:
    return exact_groups(table(spark, directory, "documents"))


SQL = r"""
WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents
), g AS (
  SELECT doc_id, body, min(doc_id) OVER (PARTITION BY body) AS keep_id, count(*) OVER (PARTITION BY body) AS group_size FROM t
)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(body) AS text_sha256 FROM g
"""
