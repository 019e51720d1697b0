"""Trees against a single-machine grower, pruning against the definition."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortloom.operators import classify, pruned_tree
from cohortloom.session import freeze

LEAST_SPLIT, LEAST_LEAF = 20, 7


@pytest.fixture(scope="module")
def flowers():
    rng = np.random.default_rng(21)
    n = 400
    y = rng.choice(["a", "b", "c"], n, p=[0.5, 0.3, 0.2])
    k = np.array([{"a": 0, "b": 1, "c": 2}[v] for v in y])
    x = np.stack([rng.normal(k, 1.0), rng.integers(0, 2, n), np.round(rng.normal(size=n), 1), np.full(n, 3.0), rng.exponential(1 + k), rng.normal(k == 1, 0.7)], axis=1)
    return x, y


def frame(spark, x, y):
    return spark.createDataFrame([(i, str(c), [float(v) for v in r]) for i, (r, c) in enumerate(zip(x, y))], "id int, y string, features array<double>")


def brute_bins(x):
    """Bins of about equal counts whose ends are steps of 1/1024 of the range."""
    out = np.zeros(x.shape, int)
    for i in range(x.shape[1]):
        low, step = x[:, i].min(), (x[:, i].max() - x[:, i].min()) / 1024
        if step > 0:
            fine = np.minimum(np.floor((x[:, i] - low) / step), 1023)
            ends = {min(f for f in np.unique(fine) if (fine <= f).sum() * 32 >= q * len(x)) for q in range(1, 32)}
            out[:, i] = [sum(f > e for e in ends if (fine <= e).sum() < len(x)) for f in fine]
    return out


def brute_tree(bins, code, classes, depth, rows):
    counts = np.bincount(code[rows], minlength=classes)
    best, choice = 1e-9, None
    if depth > 0 and len(rows) >= LEAST_SPLIT:
        for f in range(bins.shape[1]):
            for cut in range(32):
                below = bins[rows, f] <= cut
                if min(below.sum(), (~below).sum()) < LEAST_LEAF:
                    continue
                parts = [np.bincount(code[rows[side]], minlength=classes) for side in (below, ~below)]
                gain = (parts[0] ** 2).sum() / parts[0].sum() + (parts[1] ** 2).sum() / parts[1].sum() - (counts**2).sum() / len(rows)
                if gain > best:
                    best, choice = gain, (f, cut, below)
    if choice is None:
        return {"counts": counts}
    f, cut, below = choice
    return {"counts": counts, "f": f, "cut": cut, "left": brute_tree(bins, code, classes, depth - 1, rows[below]), "right": brute_tree(bins, code, classes, depth - 1, rows[~below])}


def same(tree, node, brute):
    assert tree.counts[node].tolist() == brute["counts"].tolist()
    if "f" not in brute:
        assert tree.feature[node] == -1
        return
    assert (tree.feature[node], tree.cut[node]) == (brute["f"], brute["cut"])
    same(tree, tree.left[node], brute["left"])
    same(tree, tree.right[node], brute["right"])


@pytest.fixture(scope="module")
def grown(spark, flowers):
    x, y = flowers
    df = frame(spark, x, y)
    folded = freeze(classify.repeated_folds(df.select("id", "y"), "y", "id", 3, 2))
    data = pruned_tree.binned(df, "features", "y", "id", folded)
    return data, pruned_tree.grow(data, max_depth=4), {(r.repeat, r.id): r.fold for r in folded.collect()}


def test_all_trees_equal_a_single_machine_grower(flowers, grown):
    x, y = flowers
    data, forest, fold = grown
    bins, code = brute_bins(x), np.array(["abc".index(v) for v in y])
    placed = {r.key: list(r.bins) for r in data.rows.collect()}
    assert [placed[i] for i in range(len(y))] == bins.tolist()
    assert len(forest) == 7
    for (repeat, held), tree in forest.items():
        rows = np.array([i for i in range(len(y)) if repeat < 0 or fold[repeat + 1, i] != held])
        same(tree, 0, brute_tree(bins, code, 3, 4, rows))


def test_one_scan_per_level(flowers, grown, monkeypatch):
    data, forest, _ = grown
    levels = []
    count = pruned_tree._level_counts
    monkeypatch.setattr(pruned_tree, "_level_counts", lambda *a: levels.append(1) or count(*a))
    again = pruned_tree.grow(data, max_depth=4)
    assert len(levels) == 4
    assert {m: (t.feature, t.cut) for m, t in again.items()} == {m: (t.feature, t.cut) for m, t in forest.items()}


def test_counts_are_passed_on_when_they_grow_large(grown, monkeypatch):
    data, forest, _ = grown
    monkeypatch.setattr(pruned_tree, "HELD_BYTES", 1)
    again = pruned_tree.grow(data, max_depth=4)
    assert {m: (t.feature, t.cut) for m, t in again.items()} == {m: (t.feature, t.cut) for m, t in forest.items()}


def subtrees(tree, node=0):
    """All prunings as sets of leaves."""
    out = [frozenset([node])]
    if tree.feature[node] >= 0:
        out += [a | b for a, b in itertools.product(subtrees(tree, tree.left[node]), subtrees(tree, tree.right[node]))]
    return out


def test_pruning_is_the_smallest_of_the_cheapest_subtrees(grown):
    _, forest, _ = grown
    tree = forest[pruned_tree.WHOLE, 0]
    every = subtrees(tree)
    links = tree.weakest_links()
    assert links[0] == 0 and links == sorted(set(links)) and len(links) > 3
    for alpha in [*map(float, links), *[float(a + b) / 2 for a, b in zip(links, links[1:])], float(links[-1]) + 1]:
        leaves = frozenset(int(e) for k, e in enumerate(tree.ends(alpha)) if tree.feature[k] < 0)
        cost = {s: sum(tree.errors(k) for k in s) + alpha * len(s) for s in every}
        assert cost[leaves] == pytest.approx(min(cost.values()))
        assert len(leaves) == min(len(s) for s, c in cost.items() if c <= min(cost.values()) + 1e-9)
    sizes = [len({int(e) for k, e in enumerate(tree.ends(float(a))) if tree.feature[k] < 0}) for a in links]
    assert sizes == sorted(sizes, reverse=True) and len(set(sizes)) == len(sizes) and sizes[-1] == 1


def test_choice_by_held_out_rows(spark, flowers, grown):
    x, y = flowers
    data, forest, fold = grown
    bins, candidates = brute_bins(x), pruned_tree.complexities(forest[pruned_tree.WHOLE, 0])
    tuned = {r.complexity: r for r in pruned_tree.tune(data, forest).collect()}
    assert len(tuned) == len(candidates)
    kind = data.rows.schema["label"].dataType
    for c in candidates:
        scores = []
        for (repeat, held), tree in forest.items():
            if repeat >= 0:
                rows = [i for i in range(len(y)) if fold[repeat + 1, i] == held]
                ends = tree.ends(c * tree.errors(0))
                scores.append(np.mean(["abc"[tree.label(ends[e])] == y[i] for i, e in zip(rows, tree.route(bins[rows]))]))
        assert tuned[c].fits == 6 and tuned[c].accuracy == pytest.approx(np.mean(scores)) and tuned[c].accuracy_sd == pytest.approx(np.std(scores, ddof=1))
    best = pruned_tree.best_complexity(pruned_tree.tune(data, forest))
    assert tuned[best].accuracy == max(r.accuracy for r in tuned.values())
    rows = pruned_tree.cv_predictions(data, forest, best, kind).collect()
    assert len(rows) == 2 * len(y) and all(fold[r.repeat, r.key] == r.fold for r in rows)
    hits = {}
    for r in rows:
        hits.setdefault((r.repeat, r.fold), []).append(r.predicted == r.label)
    assert np.mean([np.mean(h) for h in hits.values()]) == pytest.approx(tuned[best].accuracy)


def test_prediction_and_rows_of_the_tree(spark, flowers, grown):
    x, y = flowers
    data, forest, _ = grown
    tree, kind = forest[pruned_tree.WHOLE, 0], data.rows.schema["label"].dataType
    odd = spark.createDataFrame([(900, "a", None), (901, "a", [1.0]), (902, "a", [math.nan] * 6), (903, "a", [math.inf] * 6), (904, "a", [None] * 6), (905, "a", [-1e300] * 6)], "id int, y string, features array<double>")
    out = pruned_tree.predict(frame(spark, x, y).unionByName(odd), "features", data, tree, 0.01, kind)
    got = {r.id: r.predicted for r in out.collect()}
    assert {got[i] for i in range(900, 905)} == {None} and got[905] is not None
    table = {r.node: r for r in pruned_tree.nodes(spark, data, tree, 0.01).collect()}
    assert pruned_tree.leaf_count(tree, 0.01) == sum(r.feature is None for r in table.values())
    for i in range(len(y)):
        at = table[0]
        while at.feature is not None:
            at = table[at.left if x[i, at.feature] < at.below else at.right]
        assert at.label == got[i]
    assert sum(r.n for r in table.values() if r.feature is None) == len(y)


def test_trees_without_splits(spark):
    same_features = spark.createDataFrame([(i, "ab"[i % 2], [1.0]) for i in range(50)], "id int, y string, features array<double>")
    one_class = spark.createDataFrame([(i, "a", [float(i)]) for i in range(50)], "id int, y string, features array<double>")
    for df in (same_features, one_class):
        data = pruned_tree.binned(df, "features", "y", "id")
        forest = pruned_tree.grow(data)
        assert list(forest) == [(pruned_tree.WHOLE, 0)] and forest[pruned_tree.WHOLE, 0].feature == [-1]
        out = pruned_tree.predict(df, "features", data, forest[pruned_tree.WHOLE, 0], 0.0, df.schema["y"].dataType)
        assert {r.predicted for r in out.collect()} == {"a"}
    missing = spark.createDataFrame([(1, None, [1.0]), (2, "a", None), (3, "b", [2.0]), (4, "b", [math.nan])], "id int, y string, features array<double>")
    assert [r.key for r in pruned_tree.binned(missing, "features", "y", "id").rows.collect()] == [3]


def test_labels_may_be_numbers(spark, flowers):
    x, y = flowers
    df = frame(spark, x, y).withColumn("y", F.ascii("y"))
    data = pruned_tree.binned(df, "features", "y", "id")
    tree = pruned_tree.grow(data, 2)[pruned_tree.WHOLE, 0]
    out = pruned_tree.predict(df, "features", data, tree, 0.0, df.schema["y"].dataType)
    assert {r.predicted for r in out.select("predicted").distinct().collect()} <= {97, 98, 99}
