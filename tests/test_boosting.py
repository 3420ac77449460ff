"""Boosted trees against a plain numpy version, and the table form of an ensemble."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rollcall.functions import boosting, kernels
from rollcall.functions.boosting import UNIT, Tree
from rollcall.plans import flows
from rollcall.riskmodel import ensemble, explain, train
from rollcall.sources import sinks

COLUMNS = ["a", "b", "c", "d e"]


@pytest.fixture(scope="module")
def matrix(spark):
    rng, rows = random.Random(3), []
    for i in range(900):
        a, b, c = rng.random(), rng.gauss(0, 1), rng.randint(0, 3)
        chance = 1 / (1 + math.exp(-(3 * (a > 0.6) + c - 2 + 0.5 * b * (a < 0.2))))
        rows.append((i, a, b if i % 50 else None, float(c), 1.0, int(rng.random() < chance)))
    return spark.createDataFrame(rows, "employee_id bigint, a double, b double, c double, `d e` double, attrition int").cache()


def plain(matrix, rounds, rate, depth, leaf, l2, patience, bins):
    """Greedy boosting row by row over the same cuts, without histograms."""
    held_col = train.held_out()
    rows = matrix.select(*[F.col(f"`{c}`") for c in COLUMNS], "attrition", held_col.alias("held")).collect()
    x = np.array([[np.nan if v is None else v for v in r[:4]] for r in rows], float)
    y, held = np.array([r[4] for r in rows], float), np.array([r[5] for r in rows])
    cuts = train.cut_points(matrix.where(~held_col), COLUMNS, bins)
    margin = np.full(len(y), math.log(y[~held].sum() / (1 - y[~held]).sum()))
    trees, losses, best = [], [], 0

    def loss():
        m, t = margin[held], y[held]
        return np.rint((np.logaddexp(0, m) - t * m) * UNIT).sum() / UNIT / held.sum()

    while True:
        losses.append(loss())
        best = int(np.argmin(losses))
        if len(trees) == rounds or len(trees) - best >= patience:
            return trees[:best], losses
        p = 1 / (1 + np.exp(-margin))
        g, h = np.rint((p - y) * UNIT) / UNIT, np.rint(p * (1 - p) * UNIT) / UNIT
        nodes, tree = {0: np.arange(len(y))}, {}
        for node in range(2**depth - 1):
            if node not in nodes:
                continue
            members = nodes[node]
            use = members[~held[members]]
            worth = lambda r: g[r].sum() ** 2 / (h[r].sum() + l2)
            found = (1e-12, None)
            for f in range(4):
                for cut in cuts[f]:
                    left = use[x[use, f] <= cut]
                    right = use[~(x[use, f] <= cut)]
                    if min(len(left), len(right)) >= leaf:
                        gain = worth(left) + worth(right) - worth(use)
                        if gain > found[0] + 1e-9:
                            found = (gain, (f, float(cut)))
            if found[1]:
                f, cut = tree[node] = found[1]
                go = x[members, f] <= cut
                nodes[2 * node + 1], nodes[2 * node + 2] = members[go], members[~go]
        if not tree:
            return trees[:best], losses
        for node, members in nodes.items():
            if node not in tree:
                use = members[~held[members]]
                margin[members] += -rate * g[use].sum() / (h[use].sum() + l2)
        trees.append(tree)


def splits(tree):
    return {i: (int(f), float(c)) for i, (f, c) in enumerate(zip(tree.feature, tree.cut)) if f >= 0}


def same(a, b):
    return len(a.trees) == len(b.trees) and a.losses == b.losses and all(
        np.array_equal(getattr(s, k), getattr(t, k), equal_nan=True) for s, t in zip(a.trees, b.trees) for k in ("feature", "bin", "cut", "value", "rows")
    )


def test_trees_equal_a_plain_version(matrix):
    got = train.train(matrix, COLUMNS, rounds=12, rate=0.3, depth=3, leaf=20, patience=30, bins=16)
    trees, losses = plain(matrix, 12, 0.3, 3, 20, 1.0, 30, 16)
    assert [splits(t) for t in got.trees] == trees and len(trees) > 3
    assert got.losses == pytest.approx(losses, abs=1e-9)
    assert all(min(t.rows[t.rows > 0]) >= 20 for t in got.trees)


def test_training_repeats_whatever_the_tasks(matrix, monkeypatch):
    settings = dict(rounds=7, rate=0.2, depth=3, leaf=5)
    first = train.train(matrix, COLUMNS, **settings)
    monkeypatch.setattr(train, "TASK_ROWS", 100)
    monkeypatch.setattr(train, "SNAPSHOT", 2)
    assert same(first, train.train(matrix.repartition(7), COLUMNS, **settings))


def test_patience_and_l2(matrix):
    model = train.train(matrix, COLUMNS, rounds=200, rate=0.8, depth=4, leaf=2, patience=4)
    best = int(np.argmin(model.losses))
    assert len(model.trees) == best and len(model.losses) == best + 5
    strict = train.train(matrix, COLUMNS, rounds=1, depth=1, holdout=0, l2=1e9)
    assert strict.losses == () and abs(strict.trees[0].value).max() < 1e-6
    weighted = train.train(matrix.withColumn("w", F.lit(2.0)), COLUMNS, rounds=2, leaf=5, l2=2.0, weight="w")
    assert [splits(t) for t in weighted.trees] == [splits(t) for t in train.train(matrix, COLUMNS, rounds=2, leaf=5).trees]


def test_without_rows_or_with_one_class(matrix):
    assert train.train(matrix.limit(0), COLUMNS).trees == ()
    sure = train.train(matrix.withColumn("attrition", F.lit(1)), COLUMNS)
    assert sure.trees == () and train.score(sure, matrix).agg(F.min("prob")).first()[0] > 0.99


def test_missing_values_go_right(spark, matrix):
    model = train.train(matrix, COLUMNS, rounds=3, rate=0.5, depth=3, leaf=5)
    odd = spark.createDataFrame([(1, None, None, None, None), (2, *[float("nan")] * 4), (3, *[1e9] * 4)], "employee_id bigint, a double, b double, c double, `d e` double")
    assert len({r["prob"] for r in train.score(model, odd).collect()}) == 1


def test_the_table_scores_and_explains_like_the_trees(spark, matrix, tmp_path):
    model = train.train(matrix, COLUMNS, rounds=3, rate=0.5, depth=4, leaf=10)
    model = train.Ensemble(model.features, model.base, (*model.trees, lone()))
    whole = matrix.where("b IS NOT NULL")
    path = sinks.save_model(ensemble.as_table(spark, model), model.features, model.base, str(tmp_path / "model"))
    table, columns, base = sinks.load_model(spark, path)
    assert columns == COLUMNS and base == model.base
    want = {r["employee_id"]: r["prob"] for r in train.score(model, whole).collect()}
    got = {r["employee_id"]: r["prob"] for r in ensemble.score(whole, table, base).collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-12) for k in want)
    parts = {(r["employee_id"], r["feature"]): r["contribution"] for r in explain.contributions(model, whole, COLUMNS).collect()}
    table_parts = {(r["employee_id"], r["feature"]): r["contribution"] for r in ensemble.contributions(whole, table).collect()}
    assert {k for k, v in parts.items() if v} <= table_parts.keys() and len(table_parts) % len(want) == 0
    assert all(v == pytest.approx(parts[k], abs=1e-12) for k, v in table_parts.items())
    assert ensemble.base_value(table, base) == pytest.approx(explain.base_value(model), abs=1e-12)


def lone():
    """A tree that is a single leaf."""
    tree = Tree.empty(1)
    tree.value[0], tree.rows[0] = 0.25, 10
    return tree


def test_discarded_tables_are_gone(spark):
    from rollcall.sources import scratch

    table = scratch.written(spark.range(5), "gone")
    path = table.inputFiles()[0]
    scratch.discard(table)
    with pytest.raises(Exception):
        spark.read.parquet(path).count()


def test_explanations_of_a_table(spark, matrix):
    model = train.train(matrix, COLUMNS, rounds=2, rate=0.5, depth=2, leaf=10)
    parts = flows.explain.importance(ensemble.contributions(matrix, ensemble.as_table(spark, model)))
    assert parts.count() == len({f for t in model.trees for f in t.feature if f >= 0})


def test_flags_of_a_category_share_a_column():
    rng = np.random.default_rng(5)
    kind, wide, gone = rng.integers(0, 4, 300), rng.integers(0, 7, 300), np.zeros(300, int)
    flags = [(kind == k).astype(int) for k in range(4)]
    codes = np.array([*flags, wide, gone, rng.integers(0, 2, 300)], np.uint8)
    sizes = np.array([2, 2, 2, 2, 7, 1, 2])
    counts = np.array([np.bincount(c, minlength=7) for c in codes])
    usual = counts.argmax(axis=1)
    other = codes != usual[:, None]
    layout = boosting.Layout.of(counts, other.astype(int) @ other.T.astype(int), sizes)
    assert len(layout.widths) < len(codes) and len({*layout.column[:4]}) == 1
    columns = layout.pack(codes)
    for f, size in enumerate(sizes):
        for at in range(size):
            assert np.array_equal(layout.right(columns, f, at), codes[f] > at)
    cells = np.concatenate([np.bincount(c, minlength=w) for c, w in zip(columns, layout.widths)])
    assert np.array_equal(layout.spread(cells), counts)


def test_rows_are_dealt_to_all_cores():
    assert [train._tasks(n, 12) for n in (1, 11_695, 100_000, 701_700, 10**8)] == [1, 1, 5, 12, 200]


def test_renewed_margins_and_joined_blocks_change_nothing(matrix, monkeypatch):
    settings = dict(rounds=7, rate=0.2, depth=3, leaf=5)
    first = train.train(matrix, COLUMNS, **settings)
    for name, value in (("REFRESH", 2), ("SNAPSHOT", 5), ("CHUNK", 50), ("FEW_ROWS", 100)):
        monkeypatch.setattr(train, name, value)
    assert same(first, train.train(matrix.repartition(5), COLUMNS, **settings))


def test_a_leaf_is_worked_out_by_sets_of_conditions():
    x = np.random.default_rng(2).normal(size=(200, 3))
    leaf = (0.7, [(0, -np.inf, 0.1, 0.4), (2, -0.5, 0.9, 0.3), (1, 0.0, np.inf, 0.5)])
    whole, alone = np.zeros_like(x), np.zeros_like(x)
    kernels.add_leaf(x, leaf, whole)
    for i in range(len(x)):
        kernels.add_leaf(x[i : i + 1], leaf, alone[i : i + 1])
    assert np.allclose(whole, alone, atol=1e-15)


def test_nodes_summed_in_advance_change_nothing_but_the_number_of_jobs(matrix, monkeypatch):
    settings = dict(rounds=12, rate=0.05, depth=4, leaf=5)
    jobs = []
    real = train._histograms
    monkeypatch.setattr(train, "_histograms", lambda *a: jobs.append(1) or real(*a))
    model = train.train(matrix, COLUMNS, **settings)
    few = len(jobs)
    assert few < 3 * len(model.trees)
    for guesses, spare in ((0, 0), (1, 0), (3, 40)):
        monkeypatch.setattr(train, "GUESSES", guesses)
        monkeypatch.setattr(train, "SPARE_ROWS", spare)
        jobs.clear()
        assert same(model, train.train(matrix, COLUMNS, **settings)) and len(jobs) >= few


def test_columns_counted_together_have_the_sums_of_each(monkeypatch):
    rng = np.random.default_rng(7)
    sizes = np.array([5, 60, 64, 3])
    codes = np.array([rng.integers(0, n, 400) for n in sizes], np.uint8)
    counts = np.array([np.bincount(c, minlength=64) for c in codes])
    layout = boosting.Layout.of(counts, np.ones((4, 4), int), sizes)
    assert sorted(c for g in layout.groups() for c in g) == [0, 1, 2, 3] and len(layout.groups()) == 2
    assert len(layout.groups(1)) == 4
    label, held, margin = rng.integers(0, 2, 400).astype(float), rng.random(400) < 0.2, rng.normal(size=400)
    nodes = [[-1, 0, 0, False, True], [0, 1, 20, True, False], [1, 2, 9, False, True]]
    job = {"recent": [], "nodes": nodes, "loss": True}
    ((totals, _, lost),) = boosting.histograms(iter([(layout.pack(codes), label, held, np.ones(400), margin)]), layout, job)
    got, p = layout.spread(totals), 1 / (1 + np.exp(-margin))
    g, h = np.rint((p - label) * UNIT), np.rint(p * (1 - p) * UNIT)
    assert lost == held.sum()
    for node, rows in enumerate((~held, ~held & (codes[1] > 20) & (codes[2] <= 9))):
        for f in range(4):
            for i, what in enumerate((g, h, np.ones(400))):
                assert np.array_equal(got[i, node, f], np.bincount(codes[f][rows], what[rows], 64).astype(np.int64))


def test_nodes_that_trees_return_to_need_no_job_of_their_own(spark, monkeypatch):
    rng, rows = random.Random(11), []
    for i in range(1500):
        x = [rng.random() for _ in range(6)]
        rows.append((i, *x, int(rng.random() < sum(x) / 6)))
    names = [f"x{i}" for i in range(6)]
    near = spark.createDataFrame(rows, "employee_id bigint, " + ", ".join(f"{n} double" for n in names) + ", attrition int")
    jobs = []
    real = train._histograms
    monkeypatch.setattr(train, "_histograms", lambda *a: jobs.append(1) or real(*a))
    model = train.train(near, names, rounds=60, rate=0.05, depth=2, leaf=20, holdout=0, bins=8)
    # The first splits of many trees are nearly equal; a job for each of their levels would be 120.
    assert len(model.trees) == 60 and len(jobs) < 80


def test_sums_in_advance_are_bounded():
    road, splits = (), [(f, b, 60, 50) for f in range(4) for b in range(10)]
    seen = {(): splits} | {((f, b, side),): splits for f, b, _, _ in splits for side in (False, True)}
    nodes = train._nodes([road], [road], seen, 4, 10**6)
    assert sum(n[4] for n in nodes.values()) <= 40


def test_cut_points_of_few_values_are_exact(spark):
    rng = np.random.default_rng(5)
    few = np.minimum(rng.zipf(1.3, 40_000), 900) / 7.0
    flag, wide = (rng.random(40_000) < 0.03).astype(float), rng.random(40_000)
    rows = [(float(a) if i % 9 else None, float(b) if i % 11 else math.nan, float(c)) for i, (a, b, c) in enumerate(zip(few, flag, wide))]
    data = spark.createDataFrame(rows, "few double, flag double, wide double").repartition(7)
    assert sorted(train._counted(data, ["few", "flag", "wide"])) == [0, 1]
    cuts = train.cut_points(data, ["few", "flag", "wide"])
    ranks = np.array([i / 64 for i in range(1, 64)])
    for place in (0, 1):
        # NULLs don't count, and NaN is the greatest value.
        known = np.sort([r[place] for r in rows if r[place] is not None])
        exact = known[np.ceil(ranks * len(known)).astype(int) - 1]
        assert cuts[place].tolist() == np.unique(exact[exact == exact]).tolist()
    assert len(cuts[2]) == 63 and np.abs(cuts[2] - ranks).max() < 0.02


def test_values_are_counted_up_to_a_bound_whatever_the_tasks(spark):
    rows = [(float(i % 5), float(i), None) for i in range(100)]
    data = spark.createDataFrame(rows, "a double, b double, c double").repartition(3)
    found = train._counted(data, ["a", "b", "c"], few=50)
    assert list(found) == [0] and found[0][0].tolist() == [0, 1, 2, 3, 4] and found[0][1].tolist() == [20] * 5
    assert sorted(train._counted(data, ["a", "b", "c"], few=100)) == [0, 1]
