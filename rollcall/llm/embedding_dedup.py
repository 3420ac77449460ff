"""Near duplicates of embeddings by NN-descent.

A neighbour graph starts from the leaves of random-projection trees and is
refined through neighbours of neighbours: around every vector, its neighbours
and those it is a neighbour of are compared with each other. Links found on the way are
kept: the best of each vector, and as many more as tell which of the vectors
compared are connected. A vector whose list is full of links is saturated: its list
is then enlarged to its whole component, in blocks, so its links are counted
exactly, and further trees look for its links outside the component, until no list
is full. The
recall is audited against brute force on a sample, and more trees follow until it
is high enough. Vectors count as known when all their links are, and those with
few links count apart from those with many, so a hot group hides no missing pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rollcall.llm.support import Scratch, by_value, components, joined_small, table

by_value(__name__)

THRESHOLD = 0.9
# Trees per attempt, vectors expected in a leaf and compared at most in one task, neighbours kept.
TREES, LEAF, BLOCK = 8, 64, 512
NEIGHBOURS, STARTERS, ROUNDS = 10, 3, 3
# A round that finds fewer new links than this share of those known is the last one.
SETTLED = 0.001
# Vectors the recall is audited on, and the recall asked for.
AUDITED, RECALL, MOST_ATTEMPTS = 1000, 0.97, 12
# Cosines this near to the threshold may fall on either side of it by rounding: no link is missed there.
ROUNDING = 1e-12
EDGE = "u bigint, v bigint, sim double"


def units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Unit vectors in double precision; NULL for those that link with nothing."""
    for batch in batches:
        out = []
        for value in batch.column(1).to_pylist():
            unit = None
            if value and None not in value:
                x = np.array(value, dtype=float)
                if np.isfinite(x).all() and x.any():
                    x = x / np.abs(x).max()
                    unit = (x / np.sqrt(x @ x)).astype("<f8").tobytes()
            out.append(unit)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["vec_id", "unit"])


def matrix(units_: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(units_), dtype="<f8").reshape(len(units_), -1)


def leaf_codes(batches: Iterator[pa.RecordBatch], seed: int, depth: int) -> Iterator[pa.RecordBatch]:
    """(tree, code, id) for every tree: the sides of ``depth`` random hyperplanes; vectors of other widths never meet."""
    planes: dict[int, np.ndarray] = {}
    for batch in batches:
        trees, codes, ids = [], [], []
        for i, unit in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            x = np.frombuffer(unit, "<f8")
            width = len(x)
            if width not in planes:
                planes[width] = np.random.Generator(np.random.PCG64([seed, width])).normal(size=(TREES * max(depth, 1), width))
            sides = (planes[width] @ x > 0)[: TREES * depth].reshape(TREES, depth)
            codes += (sides @ (1 << np.arange(depth, dtype=np.int64)) * 65536 + width % 65536).tolist()
            trees += range(TREES)
            ids += [i] * TREES
        yield pa.RecordBatch.from_arrays(
            [pa.array(trees, pa.int32()), pa.array(codes, pa.int64()), pa.array(ids, pa.int64())], names=["tree", "code", "id"]
        )


def groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[list]]:
    """Columns of the rows with equal first ``keys`` columns, from batches sorted by them."""
    held: list[list] | None = None
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        if held:
            columns = [h + c for h, c in zip(held, columns, strict=True)]
        n = len(columns[0])
        if not n:
            continue
        marks = list(zip(*columns[:keys], strict=True))
        at = [0, *[i for i in range(1, n) if marks[i] != marks[i - 1]], n]
        for a, b in zip(at[:-2], at[1:-1], strict=True):
            yield [c[a:b] for c in columns]
        held = [c[at[-2] :] for c in columns]
    if held:
        yield held


def edge_batch(u: list[np.ndarray], v: list[np.ndarray], sim: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (u, v, sim)], names=["u", "v", "sim"])


def forest(near: np.ndarray) -> tuple[list[int], list[int]]:
    """Links that connect all that ``near`` connects: one less than members for each component."""
    row, column, fresh = [], [], np.ones(len(near), dtype=bool)
    for root in range(len(near)):
        stack = [root] if fresh[root] else []
        fresh[root] = False
        while stack:
            k = stack.pop()
            new = np.flatnonzero(near[k] & fresh).tolist()
            fresh[new] = False
            row += [k] * len(new)
            column += new
            stack += new
    return row, column


def nearest(batches: Iterator[pa.RecordBatch], keys: int, starters: int) -> Iterator[pa.RecordBatch]:
    """Compare all vectors of a group: (u, v, sim) of the best partners of each u.

    Rows are keys, id, unit, comp, worst: vectors of one ``comp`` are not compared, as
    that is scanned anyway, and partners that are no better than the
    worst one in a vector's list are left out, unless they link. Of those that don't link,
    a vector gets ``starters`` at most; of links as many as its list holds, and those
    that connect the vectors of the group.
    """
    us, vs, sims, held = [], [], [], 0
    for columns in groups(batches, keys):
        ids, unit, comp, worst = columns[keys : keys + 4]
        if len(ids) < 2:
            continue
        order = np.array(sorted({i: k for k, i in enumerate(ids)}.values()))
        x, ids, comp, worst = matrix(unit)[order], np.array(ids)[order], np.array(comp)[order], np.array(worst)[order]
        s = x @ x.T
        s[comp[:, None] == comp[None, :]] = -2
        take = min(NEIGHBOURS, len(ids) - 1)
        if take < 1:
            continue
        best = np.argpartition(-s, take - 1, axis=1)[:, :take]
        value = np.take_along_axis(s, best, axis=1)
        rank = np.argsort(np.argsort(-value, axis=1), axis=1)
        keep = (value >= THRESHOLD) | ((rank < starters) & (value > worst[:, None]))
        row, column = np.nonzero(keep)
        if len(row):
            us.append(ids[row])
            vs.append(ids[best[row, column]])
            sims.append(value[row, column])
            held += len(row)
        near = s >= THRESHOLD
        if near.sum(axis=1).max() > take:
            row, column = forest(near)
            us.append(ids[row])
            vs.append(ids[column])
            sims.append(s[row, column])
            held += len(row)
        if held > 50_000:
            yield edge_batch(us, vs, sims)
            us, vs, sims, held = [], [], [], 0
    if held:
        yield edge_batch(us, vs, sims)


def lists(edges: DataFrame, size: int = NEIGHBOURS) -> DataFrame:
    """The ``size`` best neighbours of every vector."""
    best = Window.partitionBy("u").orderBy(F.desc("sim"), "v")
    one = edges.groupBy("u", "v").agg(F.max("sim").alias("sim"))
    return one.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= size)


def seeds(vectors: DataFrame, rows: int, seed: int, scratch: Scratch) -> DataFrame:
    """First neighbours: those in the same leaf of a random-projection tree."""
    depth = max(0, math.ceil(math.log2(max(rows, 1) / LEAF)))
    codes = vectors.select("id", "unit").mapInArrow(lambda it: leaf_codes(it, seed, depth), "tree int, code bigint, id bigint")
    codes = scratch.save(codes, "codes")
    # A crowded leaf is dealt out at random; each tree deals differently.
    full = codes.groupBy("tree", "code").agg(F.count("*").alias("m")).where(F.col("m") > BLOCK)
    full = scratch.save(full.select("tree", "code", F.ceil(F.col("m") / (BLOCK // 2)).alias("parts")), "full")
    dealt = joined_small(codes, full, ["tree", "code"], "left")
    part = F.pmod(F.xxhash64("id", "tree", F.lit(seed)), F.coalesce("parts", F.lit(1)))
    rows_ = dealt.select("tree", "code", part.alias("part"), "id").join(vectors.select("id", "unit", "comp"), "id")
    rows_ = rows_.select("tree", "code", "part", "id", "unit", "comp", F.lit(-2.0).alias("worst"))
    rows_ = rows_.repartition("tree", "code", "part").sortWithinPartitions("tree", "code", "part")
    return rows_.mapInArrow(lambda it: nearest(it, 3, STARTERS), EDGE)


def refined(known: DataFrame, vectors: DataFrame) -> DataFrame:
    """Better neighbours among the neighbours of each vector's neighbours."""
    worst = known.groupBy("u").agg(F.when(F.count("*") >= NEIGHBOURS, F.min("sim")).otherwise(F.lit(-2.0)).alias("worst"))
    about = vectors.join(worst.withColumnRenamed("u", "id"), "id", "left").select("id", "unit", "comp", F.coalesce("worst", F.lit(-2.0)).alias("worst"))
    # As many of those that have the vector in their list as a list holds.
    reverse = lists(known.select(F.col("v").alias("u"), F.col("u").alias("v"), "sim"))
    around = known.select("u", "v").union(reverse.select("u", "v")).union(known.select("u", F.col("u").alias("v"))).distinct()
    rows = around.select(F.col("u").alias("center"), F.col("v").alias("id")).join(about, "id").select("center", "id", "unit", "comp", "worst")
    rows = rows.repartition("center").sortWithinPartitions("center")
    return rows.mapInArrow(lambda it: nearest(it, 1, STARTERS), EDGE)


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of each vector with one block of its component: (id, links), weighted by copies."""
    for columns in groups(batches, 3):
        _, i, j, part, ids, copies, unit = columns
        part, ids, copies = np.array(part), np.array(ids), np.array(copies)
        x = matrix(unit)
        one, two = np.flatnonzero(part == i[0]), np.flatnonzero(part == j[0])
        for a in range(0, len(one), BLOCK):
            mine = one[a : a + BLOCK]
            near = (x[mine] @ x[two].T >= THRESHOLD) & (ids[mine][:, None] != ids[two][None, :])
            counts = near @ copies[two]
            yield pa.RecordBatch.from_arrays([pa.array(ids[mine]), pa.array(counts.astype(np.int64))], names=["id", "links"])
            if i[0] != j[0]:
                counts = copies[mine] @ near
                yield pa.RecordBatch.from_arrays([pa.array(ids[two]), pa.array(counts.astype(np.int64))], names=["id", "links"])


def saturated(links: DataFrame, parts: DataFrame, vectors: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(id, component, n, links) of linked vectors, and (component, id, parts) of those in components with a saturated one."""
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct()
    copies = vectors.select(F.col("id").alias("v"), "copies")
    listed = both.join(copies, "v").groupBy("u").agg(F.count("*").alias("n"), F.sum("copies").alias("links"))
    listed = scratch.save(listed.withColumnRenamed("u", "id").join(parts, "id"), "degrees")
    dense = listed.groupBy("component").agg(F.max("n").alias("most"), F.count("*").alias("m"))
    dense = dense.where(F.col("most") >= NEIGHBOURS).select("component", F.ceil(F.col("m") / BLOCK).cast("int").alias("parts"))
    dense = scratch.save(dense, "dense")
    return listed, scratch.save(joined_small(parts, dense, "component", "inner").select("component", "id", "parts"), "scanned")


def marked(vectors: DataFrame, scanned: DataFrame) -> DataFrame:
    """The vectors with ``comp``: the component that is scanned, or the vector alone."""
    comps = scanned.select("id", F.col("component").alias("comp"))
    return joined_small(vectors, comps, "id", "left").withColumn("comp", F.coalesce("comp", "id"))


def outside(known: DataFrame, scanned: DataFrame) -> DataFrame:
    """The neighbours that are not of one scanned component."""
    for end in ("u", "v"):
        known = joined_small(known, scanned.select(F.col("id").alias(end), F.col("component").alias(f"of_{end}")), end, "left")
    return known.where("of_u IS NULL OR of_v IS NULL OR of_u != of_v").select("u", "v", "sim")


def degrees(listed: DataFrame, scanned: DataFrame, vectors: DataFrame) -> DataFrame:
    """(id, links) of linked vectors, weighted by copies; components with a saturated vector are scanned in blocks."""
    rows = scanned.withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    pair = lambda b: F.struct(F.least(b, "part").alias("i"), F.greatest(b, "part").alias("j"))
    rows = rows.select("component", "id", "part", F.explode(F.transform(F.sequence(F.lit(0), F.col("parts") - 1), pair)).alias("p"))
    rows = rows.join(vectors, "id").select("component", "p.i", "p.j", "part", "id", "copies", "unit")
    rows = rows.repartition("component", "i", "j").sortWithinPartitions("component", "i", "j")
    exact = rows.mapInArrow(blocks, "id bigint, links bigint").groupBy("id").agg(F.sum("links").alias("links"))
    return joined_small(listed, scanned.select("id"), "id", "left_anti").select("id", "links").union(exact)


def brute(batches: Iterator[pa.RecordBatch], asked: list[tuple[int, bytes, int]]) -> Iterator[pa.RecordBatch]:
    """Links of the audited vectors with the vectors of one partition, and those within scanned components."""
    ids, comps = np.array([r[0] for r in asked]), np.array([r[2] for r in asked])
    sizes = np.array([len(r[1]) for r in asked])
    groups = [(rows, matrix([asked[i][1] for i in rows])) for rows in (np.flatnonzero(sizes == w) for w in np.unique(sizes))]
    total, inside = np.zeros(len(ids), dtype=np.int64), np.zeros(len(ids), dtype=np.int64)
    for batch in batches:
        units_ = batch.column(2).to_pylist()
        for rows, x in groups:
            fit = [k for k, u in enumerate(units_) if len(u) == 8 * x.shape[1]]
            if fit:
                y = matrix([units_[k] for k in fit])
                other, copies = batch.column(0).to_numpy()[fit], batch.column(1).to_numpy()[fit]
                near = (x @ y.T >= THRESHOLD + ROUNDING) & (ids[rows][:, None] != other[None, :])
                total[rows] += near @ copies
                inside[rows] += (near & (comps[rows][:, None] == batch.column(3).to_numpy()[fit][None, :])) @ copies
    yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total), pa.array(inside)], names=["id", "truth", "inside"])


def recall_of(truth: np.ndarray, links: np.ndarray) -> float | None:
    """The lowest of: the share of links known, and the shares of vectors with few and with many links that have all known.

    None where no audited vector has a link: nothing is measured then.
    """
    if not truth.any():
        return None
    shares = [np.minimum(truth, links).sum() / truth.sum()]
    for group in ((truth > 0) & (truth < NEIGHBOURS), truth >= NEIGHBOURS):
        if group.any():
            shares.append((links[group] >= truth[group]).mean())
    return float(min(shares))


def audit(listed: DataFrame, scanned: DataFrame, vectors: DataFrame, scratch: Scratch) -> float | None:
    """Recall on all vectors whose id is divisible by 50, by links and by vectors.

    They are compared with all vectors in blocks of AUDITED, each of which is
    shipped to the tasks. Known are the links within scanned components, and the
    listed ones of other vectors.
    """
    vectors = marked(vectors, scanned).select("id", "copies", "unit", "comp")
    sample = vectors.where(F.col("id") % 50 == 0)
    blocks = -(-sample.count() // AUDITED)
    dealt = scratch.save(sample.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(max(blocks, 1)))), "asked")
    truths, links = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    rest = joined_small(listed, scanned.select("id"), "id", "left_anti").select("id", "links")
    for i in range(blocks):
        asked = [(r["id"], bytes(r["unit"]), r["comp"]) for r in dealt.where(F.col("block") == i).collect()]
        if not asked:
            continue
        found = vectors.mapInArrow(lambda it, a=asked: brute(it, a), "id bigint, truth bigint, inside bigint")
        found = found.groupBy("id").agg(F.sum("truth").alias("truth"), F.sum("inside").alias("inside"))
        both = found.join(rest, "id", "left").select("truth", (F.col("inside") + F.coalesce("links", F.lit(0))).alias("links")).collect()
        truths.append(np.array([r["truth"] for r in both], np.int64))
        links.append(np.array([r["links"] for r in both], np.int64))
    return recall_of(np.concatenate(truths), np.concatenate(links))


def near_duplicates(embeddings: DataFrame) -> DataFrame:
    """One row per row of ``embeddings``: vec_id, n_links, component_id, kept, audit_recall, attempts.

    ``attempts`` is how often new trees were planted. ``audit_recall`` is NULL where no audited vector has a
    link. It is at least RECALL unless MOST_ATTEMPTS did not get there, which it then shows.

    Vectors that are NULL, empty, zero or hold NULL or non-finite components link with
    nothing, and neither do vectors of different widths. Equal vectors are one
    class whose copies all count. Of rows that repeat a vec_id with another
    vector the smallest vector counts; the others link with nothing. Rows without vec_id have no
    component, are not counted and not kept. No rows give no rows.
    """
    scratch = Scratch(embeddings.sparkSession, "nn")
    source = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = scratch.save(source.mapInArrow(units, "vec_id bigint, unit binary"), "units")
    valid = rows.where("unit IS NOT NULL AND vec_id IS NOT NULL").groupBy("vec_id").agg(F.min("unit").alias("unit"))
    vectors = valid.groupBy("unit").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies"))
    vectors = scratch.save(vectors.select("id", "copies", "unit"), "vectors")
    n = vectors.count()

    links, recall = None, 0.0
    known, scanned = None, None
    # Any two vectors that link may share a leaf of the next trees, so the recall gets there.
    for attempt in range(MOST_ATTEMPTS):
        apart = vectors.withColumn("comp", F.col("id")) if scanned is None else marked(vectors, scanned)
        edges = scratch.save(seeds(apart, n, attempt, scratch), "edges")
        known = scratch.save(lists(edges if known is None else outside(known, scanned).union(edges)).select("u", "v", "sim"), "lists")
        fresh = edges.where(F.col("sim") >= THRESHOLD).select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
        links = fresh.distinct() if links is None else links.union(fresh).distinct()
        links = scratch.save(links, "links")
        size = links.count()
        for _ in range(ROUNDS):
            better = scratch.save(refined(known, apart), "edges")
            known = scratch.save(lists(known.union(better)).select("u", "v", "sim"), "lists")
            fresh = better.where(F.col("sim") >= THRESHOLD).select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
            links = scratch.save(links.union(fresh).distinct(), "links")
            before, size = size, links.count()
            if size - before <= SETTLED * max(before, 1):
                break
        joined = components(links, scratch, "u", "v").withColumnRenamed("node", "id")
        parts = scratch.save(joined, "parts")
        listed, scanned = saturated(links, parts, vectors, scratch)
        # A list full of links may hide more of them outside the component, so lists without the component follow.
        full = known.where(F.col("sim") >= THRESHOLD).groupBy("u").agg(F.count("*").alias("n")).where(F.col("n") >= NEIGHBOURS)
        last = attempt + 1 == MOST_ATTEMPTS
        if last or full.limit(1).count() == 0:
            recall = audit(listed, scanned, vectors, scratch)
            if last or recall is None or recall >= RECALL:
                break
        scratch.drop("codes", "full", "edges", "asked")

    found = scratch.save(degrees(listed, scanned, vectors), "found")
    scratch.drop("codes", "full", "edges", "asked", "lists", "dense", "degrees", "scanned")
    of_unit = vectors.select(F.col("unit").alias("_unit"), "id", "copies")
    used = valid.select(F.col("vec_id").alias("_id"), F.col("unit").alias("_used"))
    out = rows.join(used, (F.col("vec_id") == F.col("_id")) & (F.col("unit") == F.col("_used")), "left")
    out = out.join(of_unit, F.col("_used") == F.col("_unit"), "left").drop("_unit", "_id", "_used", "unit")
    out = out.join(found, "id", "left").join(parts, "id", "left")
    links_ = F.when(F.col("id").isNull(), 0).otherwise(F.coalesce("links", F.lit(0)) + F.col("copies") - 1)
    component = F.coalesce("component", "id", "vec_id")
    return out.select(
        "vec_id",
        links_.cast("bigint").alias("n_links"),
        component.alias("component_id"),
        (F.col("vec_id") == component).alias("kept"),
        F.lit(recall).cast("double").alias("audit_recall"),
        F.lit(attempt + 1).cast("bigint").alias("attempts"),
    ).fillna({"kept": False})


def op7_embedding_dedup(spark: SparkSession, directory: str) -> DataFrame:
    return near_duplicates(table(spark, directory, "embeddings"))
