"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. An n-gram vector binds the
vectors of its letters, each rotated by its place, by multiplication; a text
bundles the vectors of all its n-grams by addition. A language prototype is the
bundle of all training texts of the language, and a text is given the language
whose prototype has the largest cosine with it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.llm.support import Scratch, by_value, crc_part, table

by_value(__name__)

WIDTH = 1024
SEED = 20_240_611
# Characters bundled at once, and the largest alphabet numbered without hashing.
CHUNK = 400_000
ALPHABET = 160
# A text with fewer different n-grams is never rejected: its cosine says too little. The cosine under which one in
# RARE of a language's longer training texts lies, times SLACK, is the least a text of that language must have.
ENOUGH, RARE, SLACK = 32, 200, 0.5
BINS = 1000
# Cells of the dense count matrix (documents by n-grams) of one multiplication.
CELLS = 4_000_000


class Letters:
    """Letter numbers and vectors, made as letters are met; the same in every task."""

    def __init__(self, width: int = WIDTH):
        self.width = width
        self.code = np.full(0x110000, -1, dtype=np.int32)
        self.vectors: dict[int, np.ndarray] = {}

    def fold(self, points: np.ndarray) -> np.ndarray:
        """Lower-case letters; everything else becomes a space."""
        got = self.code[points]
        if (got < 0).any():
            for p in np.unique(points[got < 0]).tolist():
                low = chr(p).lower()
                self.code[p] = (ord(low) if len(low) == 1 else p) if chr(p).isalpha() else 32
            got = self.code[points]
        return got

    def vector(self, point: int) -> np.ndarray:
        if point not in self.vectors:
            bits = np.random.Generator(np.random.PCG64([SEED, point])).integers(0, 2, self.width)
            self.vectors[point] = (2 * bits - 1).astype(np.float32)
        return self.vectors[point]

    def grams(self, first: np.ndarray, second: np.ndarray, third: np.ndarray) -> np.ndarray:
        """Bound vectors of three-letter sequences, one row each."""
        points, at = np.unique(np.concatenate([first, second, third]), return_inverse=True)
        base = np.stack([self.vector(int(p)) for p in points])
        a, b, c = at.reshape(3, -1)
        out = np.roll(base, 2, axis=1)[a]
        out *= np.roll(base, 1, axis=1)[b]
        out *= base[c]
        return out


def numbered(letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of a letter sequence as three columns, and the number of each place's n-gram."""
    points = np.flatnonzero(np.bincount(letters)) if len(letters) else np.zeros(0, np.int64)
    size = len(points)
    lut = np.zeros(int(points[-1]) + 1 if size else 1, dtype=np.int64)
    lut[points] = np.arange(size)
    x = lut[letters]
    key = (x[:-2] * size + x[1:-1]) * size + x[2:]
    if size <= ALPHABET:
        present = np.zeros(size**3, dtype=bool)
        present[key] = True
        found = np.flatnonzero(present)
        number = np.zeros(size**3, dtype=np.int32)
        number[found] = np.arange(len(found))
        at = number[key]
    else:
        found, at = np.unique(key, return_inverse=True)
    return np.stack([points[found // (size * size)], points[found // size % size], points[found % size]]), at


def chunks(texts: list[str | None], size: int = CHUNK) -> Iterator[list[int]]:
    """Row numbers grouped to about ``size`` characters; a longer text stands alone."""
    group, held = [], 0
    for i, t in enumerate(texts):
        n = len(t or "")
        if group and held + n > size:
            yield group
            group, held = [], 0
        group.append(i)
        held += n
    if group:
        yield group


def sequence(texts: list[str | None], rows: list[int], letters: Letters) -> tuple[np.ndarray, np.ndarray]:
    """Folded letters of some texts, each with a space before and after, and where each begins.

    Runs of non-letters become one space, also across the pieces between texts.
    """
    joined = "".join(f" {texts[i] or ''} " for i in rows)
    points = letters.fold(np.frombuffer(joined.encode("utf-32-le", "replace"), dtype=np.uint32))
    begins = np.zeros(len(rows) + 1, dtype=np.int64)
    np.cumsum([len(texts[i] or "") + 2 for i in rows], out=begins[1:])
    owner_start = np.zeros(len(points), dtype=bool)
    owner_start[begins[:-1]] = True
    keep = np.ones(len(points), dtype=bool)
    keep[1:] = (points[1:] != 32) | (points[:-1] != 32) | owner_start[1:]
    kept = np.concatenate([[0], np.cumsum(keep)])
    return points[keep], kept[begins]


def places(begins: np.ndarray, n: int) -> np.ndarray:
    """For each n-gram place, the text it lies in, or -1 if it spans two texts."""
    owner = np.repeat(np.arange(len(begins) - 1), np.diff(begins))
    return np.where(owner[: n - 2] == owner[2:n], owner[: n - 2], -1) if n > 2 else np.zeros(0, np.int64)


def bundle(
    texts: list[str | None], rows: list[int], groups: np.ndarray, n_groups: int, letters: Letters, sizes: list[int] | None = None
) -> np.ndarray:
    """Sums of n-gram vectors of the texts of each group; ``groups`` numbers the rows' groups.

    ``sizes`` takes the number of different n-grams of each group.
    """
    out = np.zeros((n_groups, letters.width))
    seq, begins = sequence(texts, rows, letters)
    if len(seq) < 3:
        if sizes is not None:
            sizes += [0] * n_groups
        return out
    grams, at = numbered(seq)
    owner = places(begins, len(seq))
    inside = owner >= 0
    total = len(grams[0])
    owner, at = groups[owner[inside]], at[inside]
    step = max(1, CELLS // max(total, 1))
    vectors = letters.grams(*grams)
    for lo in range(0, n_groups, step):
        hi = min(n_groups, lo + step)
        here = (owner >= lo) & (owner < hi) if (lo, hi) != (0, n_groups) else slice(None)
        counts = np.bincount((owner[here] - lo) * total + at[here], minlength=(hi - lo) * total)
        counts = counts.reshape(hi - lo, total)
        out[lo:hi] = counts.astype(np.float32) @ vectors
        if sizes is not None:
            sizes += np.count_nonzero(counts, axis=1).tolist()
    return out


def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bundle of each language in one partition: one row per language."""
    letters, sums = Letters(), {}
    for batch in batches:
        texts, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for rows in chunks(texts):
            names = sorted({langs[i] for i in rows})
            groups = np.array([names.index(langs[i]) for i in rows])
            for name, total in zip(names, bundle(texts, rows, groups, len(names), letters), strict=True):
                sums[name] = sums.get(name, 0) + total
    if sums:
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.string()), pa.array([v.astype(np.int64).tolist() for v in sums.values()])],
            names=["lang", "bundle"],
        )


def predict(batches: Iterator[pa.RecordBatch], names: list[str], prototypes: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Cosine with every prototype for each text; the first of equal ones by name wins."""
    letters = Letters()
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
        langs, scores, grams = ["und"] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), np.int64)
        for rows in chunks(texts) if names else ():
            sizes: list[int] = []
            sums = bundle(texts, rows, np.arange(len(rows)), len(rows), letters, sizes)
            grams[rows] = sizes
            norms = np.linalg.norm(sums, axis=1)
            cosines = (sums @ prototypes.T) / np.maximum(norms, 1e-12)[:, None]
            best = cosines.argmax(axis=1)
            for k, i in enumerate(rows):
                if norms[k] > 0 and any(c.isalpha() for c in texts[i] or ""):
                    langs[i] = names[best[k]]
                    scores[i] = min(1.0, max(0.0, float(cosines[k, best[k]])))
        rest = [batch.column(i) for i in range(batch.num_columns) if batch.schema.names[i] != "text"]
        fields = [n for n in batch.schema.names if n != "text"]
        yield pa.RecordBatch.from_arrays(
            [*rest, pa.array(langs, pa.string()), pa.array(scores), pa.array(grams)], names=[*fields, "lang_pred", "score", "n_grams"]
        )


def prototypes(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Unit prototypes of all languages of ``docs`` (text, lang); NULL languages teach nothing.

    One row of ``WIDTH`` numbers per language reaches the driver; sums are whole
    numbers, so their order doesn't matter.
    """
    sums = (
        docs.where("lang IS NOT NULL AND text IS NOT NULL")
        .select("text", "lang")
        .mapInArrow(learn, "lang string, bundle array<bigint>")
        .select("lang", F.posexplode("bundle").alias("place", "value"))
        .groupBy("lang", "place")
        .agg(F.sum("value").alias("value"))
        .groupBy("lang")
        .agg(F.sort_array(F.collect_list(F.struct("place", "value"))).alias("cells"))
        .orderBy("lang")
        .collect()
    )
    names = [r["lang"] for r in sums]
    vectors = np.array([[c["value"] for c in r["cells"]] for r in sums], dtype=float).reshape(len(names), WIDTH)
    norms = np.linalg.norm(vectors, axis=1)
    known = norms > 0
    return [n for n, k in zip(names, known, strict=True) if k], vectors[known] / norms[known][:, None]


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, n_grams per row of ``docs``.

    Prototypes are learned from rows whose crc32(doc_id) mod 4 is not 2. Texts
    that are NULL or have no letter get ``und`` and score 0, and so does
    every text if nothing could be learned. Of languages with equal cosines the
    first by name counts. Repeated rows teach and are answered each time; no rows
    give none. Other columns are not looked at.
    """
    folds = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "text", "lang", (crc_part("doc_id", 4) == 2).alias("held_out")
    )
    names, vectors = prototypes(folds.where("NOT held_out"))
    return folds.select("doc_id", "held_out", "text").mapInArrow(
        lambda it: predict(it, names, vectors), "doc_id bigint, held_out boolean, lang_pred string, score double, n_grams bigint"
    )


def predict_rows(batches: Iterator[pa.RecordBatch], names: list[str], vectors: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The same for whole rows, boxed in one column."""
    boxed = (
        pa.RecordBatch.from_arrays([b.column(0), pc.struct_field(b.column(0), "text")], names=["row", "text"])
        for b in batches
    )
    return predict(boxed, names, vectors)


def least_scores(scored: DataFrame) -> dict[str, float]:
    """For each language, the least cosine of a text that is kept.

    Learned from rightly identified training rows (lang, lang_pred, score, n_grams) with
    enough n-grams, by a histogram of at most BINS + 1 places a language.
    """
    sure = scored.where((F.col("n_grams") >= ENOUGH) & (F.col("lang") == F.col("lang_pred")))
    counts = sure.groupBy("lang", F.floor(F.col("score") * BINS).alias("bin")).agg(F.count("*").alias("n")).collect()
    out = {}
    for lang in sorted({r["lang"] for r in counts}):
        places = sorted((r["bin"], r["n"]) for r in counts if r["lang"] == lang)
        allowed = sum(n for _, n in places) // RARE
        for place, n in places:
            allowed -= n
            if allowed < 0:
                out[lang] = place / BINS * SLACK
                break
    return out


def identified(docs: DataFrame) -> DataFrame:
    """Documents in a language that could be learned: all their columns, without the rejected ones.

    Rejected are texts that are NULL or have no letter, and longer texts whose
    best cosine is far below that of their language's training texts, such as
    random letters. Without any training text nothing is known of languages, and all
    texts with a letter stay. Repeated rows fare alike; no rows give none.
    """
    folds = docs.select("text", "lang", (crc_part("doc_id", 4) == 2).alias("held_out"))
    names, vectors = prototypes(folds.where("NOT held_out"))
    if not names:
        return docs.where(F.col("text").rlike("\\p{L}"))
    boxed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    more = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("n_grams", T.LongType())]
    out = boxed.mapInArrow(lambda it: predict_rows(it, names, vectors), T.StructType([boxed.schema["row"], *more]))
    # Scored once: the limits are learned from the same table that they are applied to.
    out = Scratch(docs.sparkSession, "language").save(out, "scored")
    training = out.where(crc_part("row.doc_id", 4) != 2)
    least = least_scores(training.select(F.col("row.lang").alias("lang"), "lang_pred", "score", "n_grams"))
    limit = F.lit(0.0)
    for lang, score in least.items():
        limit = F.when(F.col("lang_pred") == lang, score).otherwise(limit)
    return out.where((F.col("lang_pred") != "und") & ((F.col("n_grams") < ENOUGH) | (F.col("score") >= limit))).select("row.*")


def op9_language_id(spark: SparkSession, directory: str) -> DataFrame:
    return identify(table(spark, directory, "documents"))
