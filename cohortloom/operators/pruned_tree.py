"""Classification trees with cost-complexity pruning, grown for all folds at once.

Features are binned once.  Each level of all trees (the tree of every fold of
every repeat, and the tree of all rows) is grown by one scan: tasks route their
rows through the trees so far and count (node, feature, bin, class); the counts
are summed, and the best cut of each node is found, in one Spark aggregate.
The driver only receives one row per node.  Weakest-link pruning gives the
sequence of subtrees of the whole tree, and held-out accuracy of the folds'
trees, pruned alike, chooses among them.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator
from dataclasses import dataclass, field
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from cohortloom.session import saved

# Ship this module's functions with the tasks, so executors need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FINE = 1024  # equal steps between the smallest and the largest value of a feature
BINS = 32  # bins of about equal counts made of them
HELD_BYTES = 128 * 2**20  # of counts a task holds before it passes them on
MAX_CLASSES = 256
WHOLE = -1  # the repeat of the tree of all rows


@dataclass
class Bins:
    """Per feature the smallest value, the fine step, and the fine steps after which a cut may lie."""

    low: np.ndarray
    step: np.ndarray
    cuts: list[np.ndarray]

    def place(self, x: np.ndarray) -> np.ndarray:
        """The bin of every value; rows are to be finite."""
        out = np.zeros(x.shape, np.uint8)
        for i, cuts in enumerate(self.cuts):
            if self.step[i] > 0:
                fine = np.minimum(np.floor((x[:, i] - self.low[i]) / self.step[i]), FINE - 1)
                out[:, i] = np.searchsorted(cuts, fine, side="left")
        return out

    def value(self, feature: int, cut: int) -> float:
        """Values below this go left."""
        return float(self.low[feature] + (self.cuts[feature][cut] + 1) * self.step[feature])


@dataclass
class Tree:
    """Nodes in order of growth: split feature (-1 for none), last bin that goes left, children, class counts."""

    counts: list[np.ndarray]
    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    depth: list[int] = field(default_factory=lambda: [0])

    def split(self, node: int, feature: int, cut: int, below: np.ndarray) -> None:
        self.feature[node], self.cut[node] = feature, cut
        for side, counts in ((self.left, below), (self.right, self.counts[node] - below)):
            side[node] = len(self.feature)
            for column, value in ((self.feature, -1), (self.cut, 0), (self.left, 0), (self.right, 0), (self.depth, self.depth[node] + 1)):
                column.append(value)
            self.counts.append(counts)

    def errors(self, node: int) -> int:
        return int(self.counts[node].sum() - self.counts[node].max())

    def label(self, node: int) -> int:
        """The class of most rows; ties go to the first."""
        return int(self.counts[node].argmax())

    def route(self, bins: np.ndarray) -> np.ndarray:
        """The deepest node of every row."""
        feature, cut, left, right = (np.array(c) for c in (self.feature, self.cut, self.left, self.right))
        at = np.zeros(len(bins), np.int64)
        for _ in range(max(self.depth)):
            f = feature[at]
            below = bins[np.arange(len(bins)), np.maximum(f, 0)] <= cut[at]
            at = np.where(f < 0, at, np.where(below, left[at], right[at]))
        return at

    def ends(self, alpha: float) -> np.ndarray:
        """For every node the node its rows end in once the tree is pruned at a cost of alpha per leaf.

        The smallest of the cheapest subtrees: a split stays only if it is
        cheaper than the leaf it replaces.
        """
        cost = [self.errors(k) + alpha for k in range(len(self.feature))]
        stays = [False] * len(cost)
        for k in reversed(range(len(cost))):  # children come after their parent
            if self.feature[k] >= 0:
                below = cost[self.left[k]] + cost[self.right[k]]
                if below < cost[k]:
                    cost[k], stays[k] = below, True
        end = np.arange(len(cost))
        for k in range(len(cost)):
            if self.feature[k] >= 0:
                for child in (self.left[k], self.right[k]):
                    end[child] = child if stays[k] and end[k] == k else end[k]
        return end

    def weakest_links(self) -> list[Fraction]:
        """The costs per leaf at which the pruned tree changes, from 0 on, each larger than the one before."""
        errors, leaves = [self.errors(k) for k in range(len(self.feature))], [1] * len(self.feature)
        open_ = [f >= 0 for f in self.feature]
        found = [Fraction(0)]
        while True:
            below = list(errors)
            for k in reversed(range(len(open_))):
                leaves[k] = 1
                if open_[k]:
                    below[k] = below[self.left[k]] + below[self.right[k]]
                    leaves[k] = leaves[self.left[k]] + leaves[self.right[k]]
            reach = [k == 0 for k in range(len(open_))]
            for k in range(len(open_)):
                if reach[k] and open_[k]:
                    reach[self.left[k]] = reach[self.right[k]] = True
            links = {k: Fraction(errors[k] - below[k], leaves[k] - 1) for k in range(len(open_)) if reach[k] and open_[k]}
            if not links:
                return found
            least = min(links.values())
            for k, link in links.items():
                if link == least:
                    open_[k] = False
            if least > found[-1]:
                found.append(least)


@dataclass
class Binned:
    """The saved rows (key, label, code, folds, bins), their bins and classes, and how many folds there are."""

    rows: DataFrame
    bins: Bins
    classes: list
    repeats: int
    folds: int


def _whole(features: str) -> F.Column:
    return F.col(features).isNotNull() & F.forall(
        features, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf")))
    )


def feature_bins(df: DataFrame, features: str) -> Bins:
    """Bins of an array column of whole rows, by two passes: the ends, then the counts of the fine steps."""
    width = df.agg(F.max(F.size(features))).first()[0] or 0
    ends = df.agg(*[f(F.get(features, i)) for i in range(width) for f in (F.min, F.max)]).first() if width else []
    low = np.array([ends[2 * i] for i in range(width)], float)
    step = (np.array([ends[2 * i + 1] for i in range(width)], float) - low) / FINE
    lows, steps = F.array(*[F.lit(float(v)) for v in low]), F.array(*[F.lit(float(v)) for v in step])
    fine = F.transform(
        features, lambda x, i: F.when(F.get(steps, i) > 0, F.least(F.floor((x - F.get(lows, i)) / F.get(steps, i)), F.lit(FINE - 1))).otherwise(0)
    )
    counts = df.select(F.posexplode(fine).alias("feature", "fine")).groupBy("feature", "fine").agg(F.count("*").alias("n")) if width else None
    cuts = [np.zeros(0, np.int64)] * width
    for feature, own in counts.toPandas().groupby("feature") if width else ():
        own = own.sort_values("fine")
        below, fine_steps = own["n"].cumsum().to_numpy(), own["fine"].to_numpy()
        at = np.searchsorted(below * BINS, np.arange(1, BINS) * below[-1], side="left")
        cuts[int(feature)] = np.unique(fine_steps[at[below[at] < below[-1]]]).astype(np.int64)
    return Bins(low, step, cuts)


def binned(df: DataFrame, features: str, label: str, key: str, folded: DataFrame | None = None) -> Binned:
    """Prepare the rows of (key, label, features); ``folded`` has (key, repeat, fold), as ``repeated_folds`` gives it.

    Rows with a missing label or feature are left out.
    """
    rows = df.select(F.col(key).alias("key"), F.col(label).alias("label"), F.col(features).cast("array<double>").alias("x"))
    rows = rows.filter(F.col("label").isNotNull() & _whole("x"))
    repeats = folds = 0
    if folded is None:
        rows = rows.withColumn("folds", F.array().cast("array<int>"))
    else:
        ends = folded.agg(F.max("repeat").alias("r"), F.max("fold").alias("f")).first()
        repeats, folds = ends["r"], ends["f"] + 1
        own = folded.groupBy(F.col(key).alias("key")).agg(F.sort_array(F.collect_list(F.struct("repeat", "fold"))).alias("_all"))
        rows = rows.join(own, "key").withColumn("folds", F.col("_all.fold")).drop("_all")
    classes = sorted(r["label"] for r in rows.select("label").distinct().limit(MAX_CLASSES + 1).collect())
    if len(classes) > MAX_CLASSES:
        raise ValueError(f"there are more than {MAX_CLASSES} classes")
    bins = feature_bins(rows, "x")

    @F.pandas_udf(T.BinaryType())
    def place(x: pd.Series) -> pd.Series:
        return pd.Series([r.tobytes() for r in bins.place(np.stack(x.to_numpy()))])

    code = F.array_position(F.array(*[F.lit(c) for c in classes]), F.col("label")) - 1 if classes else F.lit(0)
    return Binned(saved(rows.select("key", "label", code.cast("int").alias("code"), "folds", place("x").alias("bins"))), bins, classes, repeats, folds)


def _matrices(batch: pa.RecordBatch, width: int, repeats: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    bins = np.frombuffer(b"".join(batch["bins"].to_pylist()), np.uint8).reshape(len(batch), width)
    folds = batch["folds"].flatten().to_numpy(zero_copy_only=False).reshape(len(batch), repeats)
    return bins, folds, batch["code"].to_numpy(zero_copy_only=False)


def _mine(folds: np.ndarray, model: tuple[int, int], held_out: bool) -> np.ndarray:
    """The rows a model is grown on, or those held out from it."""
    if model[0] == WHOLE:
        return np.zeros(0, np.int64) if held_out else np.arange(len(folds))
    return np.flatnonzero((folds[:, model[0]] == model[1]) == held_out)


def _level_counts(data: Binned, models: list, forest: list[Tree], slots: list[dict[int, int]]) -> DataFrame:
    """(model, node, feature, bin, code, n) of the nodes with a slot, from one scan."""
    width, classes, repeats = len(data.bins.low), len(data.classes), data.repeats

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}

        def rows(m: int, table: np.ndarray) -> pa.RecordBatch:
            at = np.flatnonzero(table)
            slot, feature, bin_, code = np.unravel_index(at, (len(slots[m]), width, BINS, classes))
            node = np.array(list(slots[m]))[slot]
            columns = [np.full(len(at), m), node, feature, bin_, code]
            return pa.RecordBatch.from_arrays([*[pa.array(c.astype(np.int32)) for c in columns], pa.array(table[at])], ["model", "node", "feature", "bin", "code", "n"])

        for batch in batches:
            if not len(batch):
                continue
            bins, folds, code = _matrices(batch, width, repeats)
            for m, model in enumerate(models):
                if not slots[m]:
                    continue
                own = _mine(folds, model, held_out=False)
                slot_of = np.full(len(forest[m].feature), -1)
                slot_of[list(slots[m])] = list(slots[m].values())
                slot = slot_of[forest[m].route(bins[own])]
                own, slot = own[slot >= 0], slot[slot >= 0]
                at = ((slot[:, None] * width + np.arange(width)) * BINS + bins[own]) * classes + code[own, None]
                size = len(slots[m]) * width * BINS * classes
                table = np.bincount(at.ravel(), minlength=size)
                held[m] = held[m] + table if m in held else table
                if sum(t.nbytes for t in held.values()) > HELD_BYTES:
                    for k in list(held):
                        yield rows(k, held.pop(k))
        for k, table in held.items():
            yield rows(k, table)

    return data.rows.select("bins", "folds", "code").mapInArrow(count, "model int, node int, feature int, bin int, code int, n bigint")


def best_cuts(counts: DataFrame, classes: int, least_leaf: int) -> DataFrame:
    """(model, node, feature, bin, below): of every node the cut of largest Gini gain; ties go to the first feature, then bin."""
    names = [f"_c{k}" for k in range(classes)]
    summed = counts.groupBy("model", "node", "feature", "bin").agg(*[F.sum(F.when(F.col("code") == k, F.col("n")).otherwise(0)).alias(c) for k, c in enumerate(names)])
    of = Window.partitionBy("model", "node", "feature")
    so_far = of.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    cut = summed.select(
        "model", "node", "feature", "bin", F.array(*[F.sum(c).over(so_far) for c in names]).alias("below"), F.array(*[F.sum(c).over(of) for c in names]).alias("all")
    )
    zero = F.lit(0).cast("bigint")

    def total(values):
        return F.aggregate(values, zero, lambda a, v: a + v)

    def squares(values):
        return F.aggregate(values, zero, lambda a, v: a + v * v)

    above = F.zip_with("all", "below", lambda a, b: a - b)
    cut = cut.withColumn("above", above).withColumns({"nb": total("below"), "na": total("above")}).filter(F.least("nb", "na") >= least_leaf)
    gain = squares("below") / F.col("nb") + squares("above") / F.col("na") - squares("all") / (F.col("nb") + F.col("na"))
    ranked = cut.withColumn("gain", gain).filter(F.col("gain") > 1e-9)
    order = F.struct(F.col("gain"), -F.col("feature"), -F.col("bin"))
    return ranked.groupBy("model", "node").agg(F.max_by(F.struct("feature", "bin", "below"), order).alias("best")).select("model", "node", "best.*")


def grow(data: Binned, max_depth: int = 10, least_split: int = 20, least_leaf: int = 7) -> dict[tuple[int, int], Tree]:
    """The tree of all rows, and that of every (repeat, fold), repeats from 0, grown on the other folds.

    One scan per level, whatever the number of trees.  A node is split if it
    has ``least_split`` rows and a cut that leaves ``least_leaf`` on each side
    and lowers the Gini impurity.
    """
    models = [(WHOLE, 0), *[(r, f) for r in range(data.repeats) for f in range(data.folds)]]
    k = len(data.classes)
    whole = np.zeros(k, np.int64)
    for r in data.rows.groupBy("code").agg(F.count("*").alias("n")).collect():
        whole[r["code"]] = r["n"]
    held = np.zeros((data.repeats, data.folds, k), np.int64)
    if data.repeats:
        by_fold = data.rows.select("code", F.posexplode("folds").alias("repeat", "fold")).groupBy("repeat", "fold", "code").agg(F.count("*").alias("n"))
        for r in by_fold.collect():
            held[r["repeat"], r["fold"], r["code"]] = r["n"]
    forest = [Tree([whole if r == WHOLE else whole - held[r, f]]) for r, f in models]
    for depth in range(max_depth):
        slots = []
        for tree in forest:
            wide = [n for n in range(len(tree.feature)) if tree.depth[n] == depth and tree.counts[n].sum() >= least_split and tree.errors(n) > 0]
            slots.append({n: i for i, n in enumerate(wide)})
        if not any(slots) or not len(data.bins.low):
            break
        cuts = best_cuts(_level_counts(data, models, forest, slots), k, least_leaf).collect()
        for r in sorted(cuts, key=lambda r: (r["model"], r["node"])):
            forest[r["model"]].split(r["node"], r["feature"], r["bin"], np.array(r["below"], np.int64))
    return dict(zip(models, forest, strict=True))


def complexities(tree: Tree) -> list[float]:
    """Candidate costs per leaf as shares of the root's errors: between each two changes of the pruned tree, and above the last."""
    links = tree.weakest_links()
    root = max(1, tree.errors(0))
    shares = [float(a / root) for a in links]
    return [math.sqrt(a * b) for a, b in zip(shares[:-1], shares[1:], strict=True)] + [shares[-1] * 2 if shares[-1] > 0 else 0.0]


def tune(data: Binned, forest: dict[tuple[int, int], Tree], candidates: list[float] | None = None) -> DataFrame:
    """(complexity, leaves, fits, accuracy, accuracy_sd) of every candidate by the held-out rows of all folds, in one scan.

    ``leaves`` are those of the tree of all rows.
    """
    candidates = complexities(forest[WHOLE, 0]) if candidates is None else candidates
    models = [m for m in forest if m[0] != WHOLE]
    labels = [np.array([[t.label(e) for e in t.ends(c * t.errors(0))] for c in candidates]) for t in (forest[m] for m in models)]
    width, repeats = len(data.bins.low), data.repeats

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, hit = np.zeros(len(models), np.int64), np.zeros((len(models), len(candidates)), np.int64)
        for batch in batches:
            if len(batch):
                bins, folds, code = _matrices(batch, width, repeats)
                for m, model in enumerate(models):
                    own = _mine(folds, model, held_out=True)
                    n[m] += len(own)
                    hit[m] += (labels[m][:, forest[model].route(bins[own])] == code[own]).sum(axis=1)
        m, c = (x.ravel() for x in np.indices(hit.shape))
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (m, c, n[m], hit.ravel())], ["model", "candidate", "n", "hit"])

    each = data.rows.select("bins", "folds", "code").mapInArrow(score, "model bigint, candidate bigint, n bigint, hit bigint")
    each = each.groupBy("model", "candidate").agg((F.sum("hit") / F.sum("n")).alias("accuracy"))
    found = each.groupBy("candidate").agg(F.count("accuracy").alias("fits"), F.avg("accuracy").alias("accuracy"), F.stddev_samp("accuracy").alias("accuracy_sd"))
    whole = forest[WHOLE, 0]
    rows = [(i, float(c), leaf_count(whole, c)) for i, c in enumerate(candidates)]
    named = data.rows.sparkSession.createDataFrame(rows, "candidate bigint, complexity double, leaves int")
    return named.join(found, "candidate").drop("candidate")


def leaf_count(tree: Tree, complexity: float) -> int:
    end = tree.ends(complexity * tree.errors(0))
    used = {int(end[k]) for k in range(len(end)) if tree.feature[k] < 0}
    return len(used)


def best_complexity(tuned: DataFrame) -> float:
    """The candidate of the highest accuracy; ties go to the larger, which has fewer leaves."""
    return tuned.orderBy(F.desc("accuracy"), F.desc("complexity")).first()["complexity"]


def predict(test: DataFrame, features: str, data: Binned, tree: Tree, complexity: float, label_type, name: str = "predicted") -> DataFrame:
    """Add the class of the tree pruned at a complexity; a row with a missing feature has none."""
    bins, classes, width = data.bins, np.array(data.classes, dtype=object), len(data.bins.low)
    of_node = np.array([tree.label(e) for e in tree.ends(complexity * tree.errors(0))])

    @F.pandas_udf(label_type)
    def leaf(x: pd.Series) -> pd.Series:
        out = np.full(len(x), None, dtype=object)
        whole = np.array([v is not None and len(v) == width and np.isfinite(np.array(v, float)).all() for v in x], bool)
        if whole.any():
            rows = bins.place(np.stack([np.array(v, float) for v in x[whole]]))
            out[whole] = classes[of_node[tree.route(rows)]]
        return pd.Series(out)

    return test.withColumn(name, leaf(F.col(features).cast("array<double>")))


def cv_predictions(data: Binned, forest: dict[tuple[int, int], Tree], complexity: float, label_type) -> DataFrame:
    """(key, label, repeat, fold, predicted): every row by the tree that did not see it, once per repeat, repeats from 1."""
    classes, width, repeats = np.array(data.classes, dtype=object), len(data.bins.low), data.repeats
    of_node = {m: np.array([t.label(e) for e in t.ends(complexity * t.errors(0))]) for m, t in forest.items()}

    @F.pandas_udf("array<int>")
    def codes(bins: pd.Series, folds: pd.Series) -> pd.Series:
        rows = np.frombuffer(b"".join(bins), np.uint8).reshape(len(bins), width)
        of = np.stack(folds.to_numpy()).reshape(len(bins), repeats)
        out = np.zeros((len(bins), repeats), np.int32)
        for m, labels in of_node.items():
            if m[0] != WHOLE:
                own = _mine(of, m, held_out=True)
                out[own, m[0]] = labels[forest[m].route(rows[own])]
        return pd.Series(list(out))

    each = data.rows.select("key", "label", "folds", codes("bins", "folds").alias("_codes"))
    long = each.select("key", "label", F.posexplode(F.arrays_zip("folds", "_codes")).alias("_r", "_z"))
    names = F.array(*[F.lit(c) for c in classes.tolist()]).cast(T.ArrayType(label_type))
    return long.select(
        "key", "label", (F.col("_r") + 1).alias("repeat"), F.col("_z.folds").alias("fold"), F.get(names, F.col("_z._codes")).alias("predicted")
    )


def nodes(spark: SparkSession, data: Binned, tree: Tree, complexity: float = 0.0) -> DataFrame:
    """The pruned tree as rows: node, depth, feature, the value below which rows go left, children, rows, errors, class."""
    end = tree.ends(complexity * tree.errors(0))
    rows = []
    for k in sorted({int(e) for e in end}):
        for_split = tree.feature[k] >= 0 and end[tree.left[k]] == tree.left[k]
        inner = (tree.feature[k], data.bins.value(tree.feature[k], tree.cut[k]), tree.left[k], tree.right[k]) if for_split else (None,) * 4
        rows.append((k, tree.depth[k], *inner, int(tree.counts[k].sum()), tree.errors(k), str(data.classes[tree.label(k)])))
    return spark.createDataFrame(
        rows, "node int, depth int, feature int, below double, left int, right int, n bigint, errors bigint, label string"
    )
