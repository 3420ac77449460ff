"""What tasks do while trees are grown: bins, margins and histograms.

Pickled by value, so executors need no copy of this package.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Gradients and Hessians are counted in units of 2^-30: sums of 8 billion rows fit 64 bits.
UNIT = float(1 << 30)
# Rows of a task as arrays: bins (feature by feature), label, held-out flag, weight, margin so far.
BLOCK = "n int, bins binary, label binary, held binary, weight binary, margin binary"
# Rows of a value of a feature.
COUNTS = "feature int, value double, n bigint"

# Combinations of bins that one count of rows tells apart; columns' sums are sums of these.
JOINT = 4096


@dataclass
class Tree:
    """A binary tree in heap order: the children of node i are 2i + 1 and 2i + 2."""

    feature: np.ndarray
    bin: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    rows: np.ndarray

    @staticmethod
    def empty(depth: int) -> Tree:
        n = 2 ** (depth + 1) - 1
        return Tree(np.full(n, -1), np.zeros(n, np.int64), np.full(n, np.nan), np.zeros(n), np.zeros(n, np.int64))

    def fill(self, node: int, sums: np.ndarray, rate: float, l2: float) -> None:
        """Set a node's value and rows from its sums of gradient, Hessian and rows."""
        self.value[node] = -rate * sums[0] / (sums[1] + l2) if sums[1] + l2 > 0 else 0.0
        self.rows[node] = int(sums[2])

    def split(self, node: int, feature: int, at: int, cut: float) -> None:
        self.feature[node], self.bin[node], self.cut[node] = feature, at, cut

    def depth(self) -> int:
        return (len(self.feature) + 1).bit_length() - 2

    def plain(self) -> tuple[np.ndarray, ...]:
        """The fields, which are quick to pickle."""
        return self.feature, self.bin, self.cut, self.value, self.rows


@dataclass
class Layout:
    """Where the bins of features lie in the columns of a block.

    A column holds one feature, or several of which no row has more than one outside
    its usual bin, as the flags of a category are: 0 where all are usual, and for each
    feature a run of values from ``start``, one per other bin.
    """

    column: np.ndarray
    start: np.ndarray
    usual: np.ndarray
    sizes: np.ndarray
    widths: np.ndarray

    @staticmethod
    def of(counts: np.ndarray, both: np.ndarray, sizes: np.ndarray) -> Layout:
        """From rows by feature and bin, and rows in which two features are both outside their usual bins."""
        usual = counts.argmax(axis=1)
        column, start = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
        widths: list[int] = []
        members: list[list[int]] = []
        for f, size in enumerate(sizes):
            for c, inside in enumerate(members):
                if widths[c] + size - 1 <= 256 and not both[f, inside].any():
                    break
            else:
                c = len(members)
                members.append([])
                widths.append(1)
            column[f], start[f] = c, widths[c]
            members[c].append(f)
            widths[c] += int(size) - 1
        return Layout(column, start, usual, np.asarray(sizes), np.array(widths))

    def pack(self, codes: np.ndarray) -> np.ndarray:
        """Columns (columns x rows) of bins (features x rows)."""
        out = np.zeros((len(self.widths), codes.shape[1]), np.uint8)
        for f, bins in enumerate(codes):
            other = bins != self.usual[f]
            place = self.start[f] + bins[other].astype(np.int64) - (bins[other] > self.usual[f])
            out[self.column[f], other] = place.astype(np.uint8)
        return out

    def groups(self, most: int = JOINT) -> list[list[int]]:
        """Columns whose bins are counted together, with at most ``most`` combinations unless one has more."""
        out: list[list[int]] = []
        for c in np.argsort(-self.widths, kind="stable").tolist():
            for group in out:
                if self.widths[group].prod() * self.widths[c] <= most:
                    group.append(c)
                    break
            else:
                out.append([c])
        return out

    def right(self, columns: np.ndarray, feature: int, at: int) -> np.ndarray:
        """Whether rows lie in a bin of ``feature`` above ``at``."""
        usual, start, values = self.usual[feature], int(self.start[feature]), columns[self.column[feature]]
        if usual > at:
            return ~_between(values, start, at + 1)
        return _between(values, start + at, int(self.sizes[feature]) - 1 - at)

    def spread(self, cells: np.ndarray) -> np.ndarray:
        """Sums by (..., feature, bin) from sums by (..., cell), the cells of all columns side by side."""
        whole = cells[..., : self.widths[0]].sum(axis=-1)
        first = np.concatenate([[0], np.cumsum(self.widths)])
        out = np.zeros((*cells.shape[:-1], len(self.sizes), int(self.sizes.max())), cells.dtype)
        for f, size in enumerate(self.sizes):
            run = first[self.column[f]] + self.start[f]
            others = cells[..., run : run + size - 1]
            usual = self.usual[f]
            out[..., f, :usual] = others[..., :usual]
            out[..., f, usual] = whole - others.sum(axis=-1)
            out[..., f, usual + 1 : size] = others[..., usual:]
        return out


def _between(values: np.ndarray, low: int, n: int) -> np.ndarray:
    """Whether bytes are among the ``n`` from ``low`` on."""
    if n <= 0:
        return np.zeros(len(values), bool)
    # Bytes below wrap around to large ones.
    return (values - np.uint8(low)) < n


def places(tree: Tree, columns: np.ndarray, layout: Layout) -> np.ndarray:
    """The node each row has reached, given the columns of its block."""
    at = np.zeros(columns.shape[1], np.int16)
    # Parents come before their children.
    for node in np.flatnonzero(tree.feature >= 0):
        here = at == node
        right = layout.right(columns, int(tree.feature[node]), int(tree.bin[node]))
        at += here * np.int16(node + 1) + (here & right)
    return at


def value_counts(batches: Iterator[pa.RecordBatch], features: int, few: int) -> Iterator[pa.RecordBatch]:
    """A task's rows by feature and value from arrays of values; 0 rows of NULL for a feature with more than ``few`` values."""
    found: dict[int, tuple[np.ndarray, np.ndarray]] = {i: (np.zeros(0), np.zeros(0, np.int64)) for i in range(features)}
    many: list[int] = []
    for batch in batches:
        flat, n = batch.column(0).flatten(), batch.num_rows
        known = flat.is_valid().to_numpy(zero_copy_only=False).reshape(n, features)
        rows = flat.to_numpy(zero_copy_only=False).astype(float).reshape(n, features)
        for i, (values, counts) in list(found.items()):
            more, times = np.unique(rows[known[:, i], i], return_counts=True)
            values, at = np.unique(np.concatenate([values, more]), return_inverse=True)
            # Whole numbers below 2^53.
            found[i] = values, np.bincount(at, np.concatenate([counts, times]), len(values)).astype(np.int64)
            if len(values) > few:
                many.append(i)
                del found[i]
    columns = [
        pa.array([*np.repeat(list(found), [len(v) for v, _ in found.values()]).tolist(), *many], pa.int32()),
        pa.array([*[x for v, _ in found.values() for x in v.tolist()], *[None] * len(many)], pa.float64()),
        pa.array([*[x for _, c in found.values() for x in c.tolist()], *[0] * len(many)], pa.int64()),
    ]
    yield pa.RecordBatch.from_arrays(columns, names=["feature", "value", "n"])


def binned(batches: Iterator[pa.RecordBatch], cuts: Sequence[np.ndarray], base: float) -> Iterator[pa.RecordBatch]:
    """One block per batch of (x, y, held, w)."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        flat = batch.column(0).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(n, len(cuts))
        codes = np.stack([np.searchsorted(c, flat[:, f], side="left").astype(np.uint8) for f, c in enumerate(cuts)])
        label, weight = (batch.column(i).to_numpy(zero_copy_only=False).astype(float) for i in (1, 3))
        held = batch.column(2).to_numpy(zero_copy_only=False).astype(np.uint8)
        margin = np.full(n, base)
        yield packed(n, codes, label, held, weight, margin)


def packed(n: int, *arrays: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array([n], pa.int32()), *[pa.array([a.tobytes()], pa.binary()) for a in arrays]]
    return pa.RecordBatch.from_arrays(columns, names=["n", "bins", "label", "held", "weight", "margin"])


def unpacked(rows: Iterator) -> Iterator[tuple]:
    """(bins, label, held, weight, margin) of blocks."""
    for n, bins, label, held, weight, margin in rows:
        codes = np.frombuffer(bins, np.uint8).reshape(-1, n)
        yield codes, np.frombuffer(label), np.frombuffer(held, np.uint8) > 0, np.frombuffer(weight), np.frombuffer(margin)


def arrays(rows: Iterator, layout: Layout, most: int) -> Iterator[tuple]:
    """(columns, label, held, weight, margin) of blocks, small ones joined to about ``most`` rows."""
    parts: list[tuple] = []
    for codes, *others in unpacked(rows):
        parts.append((layout.pack(codes), *others))
        if sum(len(p[1]) for p in parts) >= most:
            yield _joined(parts)
            parts = []
    if parts:
        yield _joined(parts)


def _joined(parts: list[tuple]) -> tuple:
    return tuple(np.concatenate(p, axis=-1) for p in zip(*parts, strict=True))


def bin_counts(rows: Iterator, sizes: Sequence[int]) -> Iterator[tuple]:
    """A task's rows by feature and bin."""
    counts = np.zeros((len(sizes), max(sizes)), np.int64)
    for codes, *_ in unpacked(rows):
        for f, bins in enumerate(codes):
            counts[f] += np.bincount(bins, minlength=max(sizes))
    yield (counts,)


def overlaps(rows: Iterator, usual: np.ndarray) -> Iterator[tuple]:
    """A task's rows in which two features are both outside their usual bins, by pair."""
    both = np.zeros((len(usual), len(usual)), np.int64)
    for codes, *_ in unpacked(rows):
        other = (codes != usual[:, None]).astype(float)
        both += (other @ other.T).astype(np.int64)
    yield (both,)


def with_trees(margin: np.ndarray, columns: np.ndarray, trees: Sequence[Tree], layout: Layout) -> np.ndarray:
    for tree in trees:
        margin = margin + tree.value[places(tree, columns, layout)]
    return margin


def moved(blocks: Iterator[tuple], trees: Sequence[Tree], layout: Layout) -> Iterator[tuple]:
    """Arrays with the trees added to their margins."""
    for columns, label, held, weight, margin in blocks:
        yield columns, label, held, weight, with_trees(margin, columns, trees, layout)


def advanced(batches: Iterator[pa.RecordBatch], trees: Sequence[Tree], layout: Layout) -> Iterator[pa.RecordBatch]:
    """Blocks with the trees added to their margins."""
    for batch in batches:
        for codes, label, held, weight, margin in unpacked(zip(*[c.to_pylist() for c in batch.columns], strict=True)):
            margin = with_trees(margin, layout.pack(codes), trees, layout)
            yield packed(len(label), codes, label, held.astype(np.uint8), weight, margin)


def members(columns: np.ndarray, rows: np.ndarray, nodes: Sequence[tuple], layout: Layout) -> list[np.ndarray]:
    """Places of the rows of each node that is wanted; ``rows`` are those of the root.

    Nodes are (parent, feature, bin, right, wanted), parents before their children.
    """
    masks: list[np.ndarray] = []
    for parent, feature, at, right, _ in nodes:
        if parent < 0:
            masks.append(rows)
            continue
        above = layout.right(columns, feature, at)
        masks.append(masks[parent] & (above if right else ~above))
    return [np.flatnonzero(m) for m, node in zip(masks, nodes, strict=True) if node[4]]


def combined(columns: Sequence[np.ndarray], widths: np.ndarray) -> np.ndarray:
    """One number for each combination of the columns' values, the last column's running fastest."""
    kind = np.uint16 if widths.prod() <= 1 << 16 else np.int64
    codes = columns[0].astype(kind)
    for values, width in zip(columns[1:], widths[1:]):
        codes *= kind(width)
        codes += values
    return codes


def histograms(blocks: Iterator[tuple], layout: Layout, job: dict) -> Iterator[tuple[np.ndarray, int, int]]:
    """A task's sums of [gradient, Hessian, rows] by wanted node and cell, and its held-out loss and rows."""
    nodes, recent = job["nodes"], [Tree(*t) for t in job["recent"]]
    first, groups = np.concatenate([[0], np.cumsum(layout.widths)]), layout.groups()
    totals = np.zeros((3, sum(node[4] for node in nodes), first[-1]), np.int64)
    loss = lost = 0
    for columns, label, held, weight, margin in blocks:
        margin = with_trees(margin, columns, recent, layout)
        if job["loss"] and held.any():
            m, y = margin[held], label[held]
            loss += int(np.rint((np.logaddexp(0, m) - y * m) * UNIT).sum())
            lost += int(held.sum())
        p = 1 / (1 + np.exp(-margin))
        g, h = np.rint((p - label) * weight * UNIT), np.rint(p * (1 - p) * weight * UNIT)
        parts = [(use, g.take(use), h.take(use)) for use in members(columns, ~held, nodes, layout)]
        for group in groups:
            widths = layout.widths[group]
            codes, cells = combined([columns[c] for c in group], widths), np.empty((*totals.shape[:2], widths.prod()))
            for node, (use, *weights) in enumerate(parts):
                slots = codes.take(use).astype(np.intp)
                for i, what in enumerate((*weights, None)):
                    # Whole numbers below 2^53 add up exactly in floating point.
                    cells[i, node] = np.bincount(slots, what, widths.prod())
            cells = cells.reshape(*totals.shape[:2], *widths)
            for axis, c in enumerate(group):
                others = tuple(k + 2 for k in range(len(group)) if k != axis)
                totals[..., first[c] : first[c + 1]] += cells.sum(axis=others).astype(np.int64)
    yield totals, loss, lost


def added(a: tuple, b: tuple) -> tuple:
    """The sums of two tasks."""
    return tuple(x + y for x, y in zip(a, b, strict=True))


def margins(values: pd.DataFrame, trees: Sequence[Tree], base: float) -> pd.Series:
    """Log-odds of rows of feature values."""
    x = values.to_numpy(dtype=float)
    rows, out = np.arange(len(x)), np.full(len(x), base)
    for tree in trees:
        at = np.zeros(len(x), np.int64)
        for _ in range(tree.depth()):
            feature = tree.feature[at]
            right = ~(x[rows, feature] <= tree.cut[at])
            at = np.where(feature >= 0, 2 * at + 1 + right, at)
        out = out + tree.value[at]
    return pd.Series(out)
