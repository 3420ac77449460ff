"""Length buckets with the least padding, and token-budget batches inside them.

Every document is padded to the upper end of its bucket. The bucket ends are
chosen by dynamic programming over the histogram of lengths of all documents, so
no other choice with as many buckets pads less.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.llm.support import SPACES, Scratch, table
from rollcall.operators.ranking import grouped_row_number

BUCKETS = 16
BUDGET = 65_536


def words(text: Column) -> Column:
    """Number of words between white space; NULL has none."""
    bare = F.regexp_replace(F.coalesce(text, F.lit("")), f"^{SPACES}|{SPACES}$", "")
    return F.when(bare == "", 0).otherwise(F.size(F.split(bare, SPACES))).cast("bigint")


def best_ends(lengths: Sequence[int], counts: Sequence[int], buckets: int) -> list[int]:
    """Bucket ends, at most ``buckets``, with the least padding for a histogram in ascending order.

    A bucket over places i to j - 1 holds length[j - 1] * (rows[j] - rows[i]) with its
    padding; what the rows hold themselves is fixed. With one more bucket, the
    best total up to j is the least over i of a line in length[j - 1] with slope
    -rows[i], so a hull of lines gives it: each of them enters and leaves once, in whole numbers.
    """
    n = len(lengths)
    rows = [0]
    for c in counts:
        rows.append(rows[-1] + int(c))
    best: list[int | None] = [0] + [None] * n
    cuts: list[list[int]] = []
    for _ in range(min(buckets, n)):
        new: list[int | None] = [0] + [None] * n
        cut = [0] * (n + 1)
        hull: list[int] = []
        at = 0
        for j in range(1, n + 1):
            i = j - 1
            if best[i] is not None:
                # Slopes fall from line to line: drop the last line while it is nowhere below its neighbours.
                while len(hull) - at > 1 and (best[i] - best[hull[-2]]) * (rows[hull[-1]] - rows[hull[-2]]) <= (
                    best[hull[-1]] - best[hull[-2]]
                ) * (rows[i] - rows[hull[-2]]):
                    hull.pop()
                hull.append(i)
            x = int(lengths[j - 1])
            while at + 1 < len(hull) and best[hull[at + 1]] - rows[hull[at + 1]] * x < best[hull[at]] - rows[hull[at]] * x:
                at += 1
            cut[j] = hull[at]
            new[j] = best[hull[at]] + x * (rows[j] - rows[hull[at]])
        cuts.append(cut)
        best = new
    ends, j = [], n
    for cut in reversed(cuts):
        if j:
            ends.append(int(lengths[j - 1]))
            j = cut[j]
    return sorted(set(ends))


def packed(docs: DataFrame, length: Column, buckets: int = BUCKETS, budget: int = BUDGET) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, bucket, bucket_length, batch, slot, padding.

    ``length`` is the number of tokens; NULL counts as 0. A batch holds as many
    documents of one bucket, in the order of doc_id (NULL first, equal ones by
    length), as fit the budget at the bucket's length, and at least one, so a
    longer document stands alone. Of choices that pad alike the first found
    counts. No rows give no rows; repeated rows take a slot each. Columns besides
    doc_id and those of ``length`` are not looked at.
    """
    scratch = Scratch(docs.sparkSession, "packing")
    sized = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(length, F.lit(0)).cast("bigint").alias("n_tokens"))
    sized = scratch.save(sized, "lengths")
    # One bin per length: k different lengths need k²/2 tokens, so even 10^13 tokens have at most 4.5 million.
    histogram = sized.groupBy(F.col("n_tokens").alias("end")).agg(F.count("*").alias("n")).orderBy("end").collect()
    ends = best_ends([r["end"] for r in histogram], [r["n"] for r in histogram], buckets)
    number = F.lit(len(ends) - 1 if ends else 0)
    for i in reversed(range(len(ends) - 1)):
        number = F.when(F.col("n_tokens") <= ends[i], i).otherwise(number)
    size = F.element_at(F.array(*[F.lit(e).cast("bigint") for e in ends or [0]]), F.col("bucket") + 1)
    bucketed = sized.withColumn("bucket", number.cast("int")).withColumn("bucket_length", size)
    numbered = grouped_row_number(bucketed, "bucket", "doc_id", "n_tokens", name="_n")
    room = F.greatest(F.floor(F.lit(budget) / F.greatest("bucket_length", F.lit(1))), F.lit(1)).cast("bigint")
    return numbered.select(
        "doc_id",
        "n_tokens",
        "bucket",
        "bucket_length",
        F.floor((F.col("_n") - 1) / room).cast("bigint").alias("batch"),
        ((F.col("_n") - 1) % room).cast("bigint").alias("slot"),
        (F.col("bucket_length") - F.col("n_tokens")).alias("padding"),
    )


def op4_packing(spark: SparkSession, directory: str) -> DataFrame:
    docs = table(spark, directory, "documents")
    return packed(docs, words(F.col("text")))
