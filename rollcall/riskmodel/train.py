"""Boosted trees on the feature matrix, grown from second-order histograms.

Values are turned into bins once. Every task adds up gradients and Hessians of
its rows by node, feature and bin, Spark sums these histograms over all tasks,
and the driver, which sees nothing but the sums, chooses the splits. Trees that
follow each other are alike, so a job also sums the nodes below those it is for,
as earlier trees have split them: where the sums lead to the same split, they are
there already, and elsewhere another job sums the right nodes. Gradients are
whole numbers of a fixed unit, so sums do not depend on the order of tasks and a
model can be trained again bit by bit.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark import RDD, StorageLevel, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.functions import boosting as tasks
from rollcall.functions.boosting import Layout, Tree
from rollcall.sources.scratch import discard, written

ROUNDS, RATE, DEPTH, LEAF, L2, PATIENCE = 500, 0.03, 4, 50, 1.0, 30
HOLDOUT = 15
# Bins of a feature, and places a quantile may be off in a million rows.
BINS, ACCURACY = 64, 20_000
# Most values of a feature that are counted one by one.
FEW_VALUES = 1_000
# Margins are written down after so many rounds, which bounds the trees a task applies again after a loss.
SNAPSHOT = 50
# Margins in the executors' memory are renewed after so many rounds: every job applies the trees since then.
REFRESH = 5
# Most rows of a task, and rows too few to share with another one; a task works on so many at a time.
TASK_ROWS, FEW_ROWS, CHUNK = 500_000, 20_000, 50_000
# Earlier splits of a node that are tried in advance, and, for others than the last one, rows a task may
# add up and nodes of a job: a job more costs far more than the sums of some nodes more.
GUESSES, SPARE_ROWS, SPARE_NODES = 10, 200_000, 32
# Sums of so many tasks are added on the driver.
FEW_TASKS = 64


# The way from the root to a node, as (feature, bin, whether right), and a split as (feature, bin, rows left, rows right).
Road = tuple[tuple[int, int, bool], ...]
Split = tuple[int, int, int, int]


@dataclass(frozen=True)
class Ensemble:
    """Fitted trees: the score is 1 / (1 + exp(-(base + sum of leaf values)))."""

    features: tuple[str, ...]
    base: float
    trees: tuple[Tree, ...]
    # Mean logarithmic loss on the held-out rows after 0, 1, 2, ... trees; empty without them.
    losses: tuple[float, ...] = ()


def held_out(percent: int = HOLDOUT) -> Column:
    """Whether a row belongs to the slice training leaves out, by a hash of its key."""
    return F.pmod(F.xxhash64("employee_id"), F.lit(100)) < percent


def cut_points(data: DataFrame, features: Sequence[str], bins: int = BINS) -> list[np.ndarray]:
    """Ascending values of each feature that may part rows: a row goes left when its value is at most the cut.

    Most features are flags or small numbers. Their values are counted, which is exact; sketches,
    which cost far more, are made of the others only.
    """
    counts = _counted(data, features)
    many = [i for i in range(len(features)) if i not in counts]
    shares = [i / bins for i in range(1, bins)]
    asked = F.array(*[F.lit(s) for s in shares])
    found = [F.percentile_approx(F.col(f"`{features[i]}`").cast("double"), asked, ACCURACY).alias(f"q{i}") for i in many]
    row = data.agg(*found).first() if many else ()
    quantiles = {i: row[at] or [] for at, i in enumerate(many)}
    for i, (values, n) in counts.items():
        ends = np.cumsum(n)
        quantiles[i] = values[np.searchsorted(ends, np.ceil(np.array(shares) * ends[-1]))]
    return [np.unique(np.array([v for v in quantiles[i] if v == v], dtype=float)) for i in range(len(features))]


def _counted(data: DataFrame, features: Sequence[str], few: int = FEW_VALUES) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Ascending values, NaN last, and their rows of each feature that has at most ``few`` of them, and one at least."""
    values = F.array(*[F.col(f"`{f}`").cast("double") for f in features])
    parts = data.select(values.alias("x")).mapInArrow(lambda it: tasks.value_counts(it, len(features), few), tasks.COUNTS)
    sums = parts.groupBy("feature", "value").agg(F.sum("n").alias("n"))
    # A task sends at most this many values of a feature, too.
    whole = sums.groupBy("feature").agg(F.collect_list(F.struct("value", "n")).alias("found"), F.min("n").alias("least"))
    out = {}
    for feature, found, _ in whole.where((F.col("least") > 0) & (F.size("found") <= few)).collect():
        seen, n = np.array([r["value"] for r in found], float), np.array([r["n"] for r in found], np.int64)
        order = np.argsort(seen)
        out[feature] = seen[order], n[order]
    return out


def best_splits(sums: np.ndarray, leaf: int, l2: float) -> list[tuple[int, int, np.ndarray, np.ndarray] | None]:
    """For each node, (feature, bin, sums left, sums right) of the greatest gain, or None.

    ``sums`` is (node, feature, bin, [gradient, Hessian, rows]). Equal gains go
    to the first feature and its lowest bin.
    """
    left = sums.cumsum(axis=2)
    whole = left[:, :, -1:, :]
    right = whole - left
    worth = lambda s: s[..., 0] ** 2 / (s[..., 1] + l2)
    gain = worth(left) + worth(right) - worth(whole)
    gain = np.where((left[..., 2] >= leaf) & (right[..., 2] >= leaf), gain, -np.inf)
    flat = gain.reshape(len(gain), -1)
    out: list = []
    for node, at in enumerate(flat.argmax(axis=1)):
        f, b = divmod(int(at), gain.shape[2])
        good = flat[node, at] > 1e-12
        out.append((f, b, left[node, f, b], right[node, f, b]) if good else None)
    return out


def _summed(parts: RDD) -> tuple:
    """The sums of all tasks; those of many tasks meet in executors first."""
    return parts.treeReduce(tasks.added) if parts.getNumPartitions() > FEW_TASKS else reduce(tasks.added, parts.collect())


def _layout(blocks: DataFrame, sizes: np.ndarray) -> Layout:
    """Features that no row has outside their usual bins together share a column: fewer sums to add up."""
    (counts,) = _summed(blocks.rdd.mapPartitions(lambda it: tasks.bin_counts(it, sizes)))
    usual = counts.argmax(axis=1)
    (both,) = _summed(blocks.rdd.mapPartitions(lambda it: tasks.overlaps(it, usual)))
    return Layout.of(counts, both, sizes)


def _arrays(blocks: DataFrame, layout: Layout) -> RDD:
    """The blocks as arrays in the executors' memory or disk; what is lost is read again from the table."""
    most = CHUNK
    return blocks.rdd.mapPartitions(lambda it: tasks.arrays(it, layout, most)).persist(StorageLevel.MEMORY_AND_DISK)


def _pickled(layout: Layout) -> bytes:
    """The kernel of all histogram jobs; pickling its module by value anew for each takes as long as the work."""
    return cloudpickle.dumps((tasks.histograms, layout))


def _histograms(arrays: RDD, layout: Layout, kernel: bytes, job: dict) -> tuple[np.ndarray, float, int]:
    """Whole sums over all tasks by (node, feature, bin), and loss and number of held-out rows.

    One of hundreds of small jobs that wait for each other: planning a query for
    each would take longer than the work, hence the partition functions. A task's
    sums are 3 x nodes x features x bins numbers.
    """

    def sums(blocks):
        run, where = pickle.loads(kernel)
        return run(blocks, where, job)

    totals, loss, lost = _summed(arrays.mapPartitions(sums))
    return np.moveaxis(layout.spread(totals), 0, 3), loss / tasks.UNIT, lost


def _lesser(rows_left: int, rows_right: int) -> bool:
    """Whether the right one of two children is the one to sum; the other is what it lacks of the parent."""
    return rows_right < rows_left


def _nodes(lacking: Sequence[Road], below: Sequence[Road], seen: dict[Road, list[Split]], depth: int, spare: int) -> dict[Road, list]:
    """Nodes of a job: those that are lacking, and the lesser children that earlier splits give below others.

    By road, as [parent, feature, bin, right, wanted]. The last split of a node is
    always tried, earlier ones while their children have at most ``spare`` rows in all
    and are at most ``SPARE_NODES``, which bounds the sums of a task.
    """
    nodes: dict[Road, list] = {(): [-1, 0, 0, False, False]}

    def want(road: Road) -> None:
        for n in range(1, len(road) + 1):
            if road[:n] not in nodes:
                nodes[road[:n]] = [list(nodes).index(road[: n - 1]), *road[n - 1], False]
        nodes[road][4] = True

    queue: list[tuple[int, Road, Split]] = []
    others = 0

    def guess(road: Road, rank: int) -> None:
        if len(road) < depth - 1:
            for i, split in enumerate(seen.get(road, ())):
                heapq.heappush(queue, (rank + i, road, split))

    for road in lacking:
        want(road)
    for road in below:
        guess(road, 0)
    while queue:
        rank, road, (feature, at, left, right) = heapq.heappop(queue)
        if rank:
            if others == SPARE_NODES or min(left, right) > spare:
                continue
            others += 1
            spare -= min(left, right)
        want((*road, (feature, at, _lesser(left, right))))
        for side in (False, True):
            guess((*road, (feature, at, side)), rank)
    return nodes


def _tasks(rows: int, slots: int) -> int:
    """One task per core while each has enough to do, and more where one would have too much."""
    return max(1, -(-rows // TASK_ROWS), min(-(-rows // FEW_ROWS), slots))


def train(
    matrix: DataFrame,
    features: Sequence[str],
    rounds: int = ROUNDS,
    rate: float = RATE,
    depth: int = DEPTH,
    leaf: int = LEAF,
    l2: float = L2,
    holdout: int = HOLDOUT,
    patience: int = PATIENCE,
    weight: str | None = None,
    bins: int = BINS,
) -> Ensemble:
    """Fit gradient-boosted trees, stopping early on a held-out slice.

    ``holdout`` percent of the rows, chosen by a hash of the key, decide when to
    stop: after ``patience`` rounds without a lower loss, and the trees up to the
    lowest one are kept. 0 turns that off. A leaf has at least ``leaf`` rows and
    the value -G / (H + l2). NULL and NaN values go right at every cut. Without rows,
    or rows of both classes, there are no trees.
    """
    features = tuple(features)
    held = held_out(holdout) if holdout else F.lit(False)
    values = F.array(*[F.col(f"`{f}`").cast("double") for f in features])
    data = matrix.select(
        values.alias("x"),
        F.col("attrition").cast("double").alias("y"),
        held.alias("held"),
        (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("w"),
    )
    cuts = cut_points(matrix.where(~held), features, bins)
    fit = F.expr("CASE WHEN held THEN 0 ELSE w END")
    rows, positive, total = data.agg(F.count("*"), F.sum(fit * F.col("y")), F.sum(fit)).first()
    if not rows or not positive or positive == total:
        share = min(max((positive or 0.0) / (total or 1.0), 1e-6), 1 - 1e-6)
        return Ensemble(features, float(np.log(share / (1 - share))), ())
    base = float(np.log(positive / (total - positive)))
    binned = data.mapInArrow(lambda it: tasks.binned(it, cuts, base), tasks.BLOCK)
    # Blocks are small beside the rows they are made from, so they are what is dealt to tasks.
    blocks = written(binned.repartition(_tasks(rows, matrix.sparkSession.sparkContext.defaultParallelism)), "blocks")
    layout = _layout(blocks, np.array([len(c) + 1 for c in cuts]))
    arrays = _arrays(blocks, layout)
    stale: list[RDD] = []

    kernel = _pickled(layout)
    units = [tasks.UNIT, tasks.UNIT, 1]
    trees: list[Tree] = []
    # Trees that the margins in memory, and those in the table, lack.
    recent: list[Tree] = []
    unwritten: list[Tree] = []
    losses: list[float] = []
    best = 0
    seen: dict[Road, list[Split]] = {}
    spare = SPARE_ROWS * arrays.getNumPartitions()
    while True:
        tree = Tree.empty(depth)
        roads: dict[int, Road] = {0: ()}
        known: dict[Road, np.ndarray] = {}
        last = depth == 0 or len(trees) == rounds
        live = [0]
        while live:
            start = not known
            # Of two children the smaller one is summed; what it lacks of the parent is the other.
            lacking = [roads[b if _lesser(tree.rows[a], tree.rows[b]) else a] for a, b in zip(live[::2], live[1::2])] if live[0] else [()]
            nodes = _nodes(lacking, [] if last else [roads[n] for n in live], seen, depth, spare)
            job = {"recent": [t.plain() for t in recent], "nodes": list(nodes.values()), "loss": start}
            found_sums, loss, n_held = _histograms(arrays, layout, kernel, job)
            known.update(zip((road for road, node in nodes.items() if node[4]), found_sums, strict=True))
            while stale:
                stale.pop().unpersist()
            if start:
                if n_held:
                    losses.append(loss / n_held)
                    best = int(np.argmin(losses))
                # The whole is the same in every feature.
                tree.fill(0, known[()][0].sum(axis=0) / units, rate, l2)
                if last or (n_held and len(trees) - best >= patience):
                    break
            queue, live = live, []
            for node in queue:
                road = roads[node]
                if road not in known:
                    *way, (f, b, side) = road
                    other = known.get((*way, (f, b, not side)))
                    if other is None:
                        live.append(node)
                        continue
                    known[road] = known[tuple(way)] - other
                (found,) = best_splits(known[road][None] / units, leaf, l2)
                if found and found[1] < len(cuts[found[0]]):
                    f, b, left, right = found
                    tree.split(node, f, b, float(cuts[f][b]))
                    tree.fill(2 * node + 1, left, rate, l2)
                    tree.fill(2 * node + 2, right, rate, l2)
                    split = (f, b, int(left[2]), int(right[2]))
                    seen[road] = [split, *(s for s in seen.get(road, ()) if s != split)][:GUESSES]
                    if len(road) < depth - 1:
                        roads[2 * node + 1], roads[2 * node + 2] = (*road, (f, b, False)), (*road, (f, b, True))
                        queue += [2 * node + 1, 2 * node + 2]
        if tree.feature[0] < 0:
            break
        trees.append(tree)
        recent.append(tree)
        unwritten.append(tree)
        if len(unwritten) == SNAPSHOT:
            moved = written(blocks.mapInArrow(lambda it, r=tuple(unwritten): tasks.advanced(it, r, layout), tasks.BLOCK), "blocks")
            arrays.unpersist()
            discard(blocks)
            blocks, arrays, recent, unwritten = moved, _arrays(moved, layout), [], []
        elif len(recent) == REFRESH:
            # Made by the next job, which also reads it; the old arrays are of no use after that.
            stale.append(arrays)
            arrays = arrays.mapPartitions(lambda it, r=tuple(recent): tasks.moved(it, r, layout)).persist(StorageLevel.MEMORY_AND_DISK)
            recent = []
    arrays.unpersist()
    discard(blocks)
    kept = trees[:best] if losses else trees
    return Ensemble(features, base, tuple(kept), tuple(losses))


def score(model: Ensemble, matrix: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Add ``prob`` (attrition probability) and ``predicted_attrition`` at ``threshold``."""
    trees, base = model.trees, model.base
    margin = F.pandas_udf(lambda x: tasks.margins(x, trees, base), T.DoubleType())
    values = F.struct(*[F.col(f"`{f}`").cast("double").alias(f"x{i}") for i, f in enumerate(model.features)])
    return matrix.withColumn("prob", 1 / (1 + F.exp(-margin(values)))).withColumn(
        "predicted_attrition", (F.col("prob") >= threshold).cast("int")
    )


def rounds_used(model: Ensemble) -> int:
    return len(model.trees)
