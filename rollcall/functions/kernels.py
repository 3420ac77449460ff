"""Small numeric helpers that run inside tasks.

They are pickled by value, so executors need no copy of this package.
"""

from __future__ import annotations

import sys
from math import factorial

import numpy as np
import pandas as pd
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Value of a leaf, and (feature, low, high, share) for each feature on its path.
Leaf = tuple[float, list[tuple[int, float, float, float]]]


def add_leaf(x: np.ndarray, leaf: Leaf, out: np.ndarray) -> None:
    """Add the Shapley values of one leaf for all rows of ``x``.

    They depend on which conditions a row meets, and on nothing else of it, so
    they are worked out once for each such set while those are fewer than the rows.
    """
    value, conditions = leaf
    k = len(conditions)
    met = [(x[:, f] > low) & (x[:, f] <= high) for f, low, high, _ in conditions]
    if 2**k < len(x):
        state = np.zeros(len(x), np.intp)
        for i, m in enumerate(met):
            state += m * np.intp(1 << i)
        met = list(((np.arange(2**k)[:, None] >> np.arange(k)) & 1).T)
    else:
        state = np.arange(len(x))
    met = [m.astype(float) for m in met]
    weights = np.array([factorial(s) * factorial(k - s - 1) / factorial(k) for s in range(k)])
    for j, (feature, _, _, share) in enumerate(conditions):
        # Column s: total over the sets of s other features that are known.
        sizes = np.zeros((len(met[j]), k))
        sizes[:, 0] = 1.0
        for i, other in enumerate(conditions):
            if i != j:
                known = sizes[:, :-1] * met[i][:, None]
                sizes *= other[3]
                sizes[:, 1:] += known
        out[:, feature] += (value * (met[j] - share) * (sizes @ weights))[state]


def leaf_contributions(vectors: pd.Series, leaves: list[Leaf], width: int) -> pd.Series:
    """Contributions of all leaves to each feature vector of a batch."""
    # Leaves look at a few columns each.
    x = np.asfortranarray(np.array(vectors.tolist(), dtype=float).reshape(-1, width))
    out = np.zeros_like(x)
    for leaf in leaves:
        add_leaf(x, leaf, out)
    return pd.Series(list(np.ascontiguousarray(out)))
