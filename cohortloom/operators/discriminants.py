"""Linear and quadratic discriminants on numbers and factors together, fitted on class moments.

The design has the numbers, then a 0/1 column for every level of every factor
but its last.  Its moments are never taken over the wide rows: one aggregate
with grouping sets gives the sums and products of the numbers per class, the
sums of the numbers per class and level, and the counts of level pairs.  Only
cells that occur are returned; the driver puts them into matrices of the
design's size.  A Cholesky factor with limited pivoting then keeps, in design
order, the columns that are not constant or dependent on those kept before.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Ship this module's functions with the tasks, so executors need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAX_COLUMNS = 2_000  # of the design; the driver holds squares of this size
TOLERANCE = 1e-10  # share of a column's variance that has to be its own


@dataclass
class Design:
    """The columns of the design, and how rows become vectors."""

    numeric: list[str]
    factors: list[str]
    levels: dict[str, list[str]]
    centre: np.ndarray
    full: bool = False
    columns: list[str] = field(init=False)

    def __post_init__(self):
        self.columns = [*self.numeric, *[f"{f}={v}" for f in self.factors for v in self.used(f)]]
        if len(self.columns) > MAX_COLUMNS:
            raise ValueError(f"{len(self.columns)} design columns are more than {MAX_COLUMNS}")

    def used(self, factor: str) -> list[str]:
        return self.levels[factor] if self.full else self.levels[factor][:-1]

    def places(self) -> dict[tuple[str, str], int]:
        pairs = [(f, v) for f in self.factors for v in self.used(f)]
        return {pair: len(self.numeric) + i for i, pair in enumerate(pairs)}

    def matrix(self, numbers: np.ndarray, factors: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the design, and which rows are whole: no missing value and no unknown level."""
        whole = np.isfinite(numbers).all(axis=1) if len(self.numeric) else np.ones(len(numbers), bool)
        parts = [numbers - self.centre]
        for f, values in zip(self.factors, factors, strict=True):
            codes = pd.Categorical(values, categories=self.levels[f]).codes
            whole &= codes >= 0
            parts.append((codes[:, None] == np.arange(len(self.used(f)))).astype(float))
        return np.hstack(parts), whole


@dataclass
class Model:
    """Class names with their score functions on the kept columns, and what became of every column and class."""

    design: Design
    kept: list[int]
    dropped: dict[str, str]
    left_out: dict
    names: list
    means: np.ndarray
    roots: list[np.ndarray]  # Cholesky factors: one for all classes, or one each
    constants: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        x = x[:, self.kept]
        out = np.empty((len(x), len(self.names)))
        for c, mean in enumerate(self.means):
            root = self.roots[c if len(self.roots) > 1 else 0]
            z = np.linalg.solve(root, (x - mean).T) if len(self.kept) else np.zeros((0, len(x)))
            out[:, c] = self.constants[c] - 0.5 * (z**2).sum(axis=0)
        return out

    def predict(self, x: np.ndarray) -> np.ndarray:
        """The class of the highest score; ties go to the larger label."""
        score = self.scores(x)
        return np.array(self.names, dtype=object)[len(self.names) - 1 - score[:, ::-1].argmax(axis=1)]

    def report(self, spark: SparkSession) -> DataFrame:
        """(kind, name, used, reason) of every design column and class."""
        rows = [("column", c, c not in self.dropped, self.dropped.get(c)) for c in self.design.columns]
        rows += [("class", str(c), True, None) for c in self.names]
        rows += [("class", str(c), False, why) for c, why in self.left_out.items()]
        return spark.createDataFrame(rows, "kind string, name string, used boolean, reason string")


def _complete(df: DataFrame, numeric: list[str], factors: list[str], label: str) -> DataFrame:
    return df.dropna(subset=[*numeric, *factors, label]).withColumns(
        {**{c: F.col(c).cast("double") for c in numeric}, **{f: F.col(f).cast("string") for f in factors}}
    )


def class_moments(
    df: DataFrame, numeric: list[str], factors: list[str], label: str, by: Iterable[str] = (), full: bool = False
) -> tuple[Design, dict]:
    """The design, and per (by, class) the count, sums and products of its columns.

    One pass finds the means of the numbers, around which the sums are taken,
    and one aggregate all moments of all cells of ``by``.  Rows with a missing
    value teach nothing.  ``full`` keeps the last level of every factor too.
    """
    by, p = list(by), len(numeric)
    rows = _complete(df, numeric, factors, label)
    centre = np.zeros(p)
    if p:
        means = rows.agg(*[F.avg(c) for c in numeric]).first()
        centre = np.array([m if m is not None else 0.0 for m in means])
    x = [F.col(c) - F.lit(float(m)) for c, m in zip(numeric, centre, strict=True)]
    base = [*by, label]
    sets = [base, *[[*base, f] for f in factors], *[[*base, f, g] for f, g in combinations(factors, 2)]]
    sums = [F.sum(v).alias(f"_s{i}") for i, v in enumerate(x)]
    products = [F.sum(x[i] * x[j]).alias(f"_q{i}_{j}") for i in range(p) for j in range(i, p)]
    cells = rows.groupingSets(sets, *base, *factors).agg(F.count("*").alias("_n"), *sums, *products).collect()

    levels = {f: sorted({r[f] for r in cells if r[f] is not None}) for f in factors}
    design = Design(list(numeric), list(factors), levels, centre, full)
    place, width = design.places(), len(design.columns)
    found: dict = {}
    for r in cells:
        cell = (tuple(r[b] for b in by), r[label])
        n, s, q = found.setdefault(cell, [0, np.zeros(width), np.zeros((width, width))])
        at = [(f, r[f]) for f in factors if r[f] is not None]
        if not at:
            found[cell][0] = r["_n"]
            s[:p] = [r[f"_s{i}"] for i in range(p)]
            for i in range(p):
                for j in range(i, p):
                    q[i, j] = q[j, i] = r[f"_q{i}_{j}"]
        elif len(at) == 1 and at[0] in place:
            k = place[at[0]]
            s[k] = q[k, k] = r["_n"]
            q[k, :p] = q[:p, k] = [r[f"_s{i}"] for i in range(p)]
        elif len(at) == 2 and at[0] in place and at[1] in place:
            a, b = place[at[0]], place[at[1]]
            q[a, b] = q[b, a] = r["_n"]
    return design, {cell: tuple(v) for cell, v in found.items()}


def independent_columns(
    scatters: list[np.ndarray], spread: np.ndarray, tolerance: float = TOLERANCE
) -> tuple[list[int], list[np.ndarray], dict[int, str]]:
    """The columns kept in order, the Cholesky factor of every matrix on them, and why the others go.

    A column goes if, in any of the matrices, it has no variance beyond a
    rounding of its overall ``spread``, or none of its own beside those kept.
    """
    kept: list[int] = []
    roots = [np.zeros((0, 0)) for _ in scatters]
    dropped: dict[int, str] = {}
    for j in range(len(spread)):
        rows = []
        for a, root in zip(scatters, roots, strict=True):
            if not a[j, j] > tolerance * spread[j]:
                dropped[j] = "constant within classes"
                break
            y = np.linalg.solve(root, a[kept, j]) if kept else np.zeros(0)
            own = a[j, j] - y @ y
            if not own > tolerance * a[j, j]:
                dropped[j] = "depends on the columns before it"
                break
            rows.append(np.append(y, np.sqrt(own)))
        else:
            for k, row in enumerate(rows):
                grown = np.zeros((len(kept) + 1, len(kept) + 1))
                grown[:-1, :-1], grown[-1] = roots[k], row
                roots[k] = grown
            kept.append(j)
    return kept, roots, dropped


def fit(design: Design, moments: dict, quadratic: bool = False) -> Model:
    """A model from the (count, sums, products) of every class.

    Priors are class shares.  A quadratic model leaves out classes that do not
    have more rows than the design has columns, as they have no covariance of
    full rank; it keeps the columns that are independent in every other class,
    so that all classes are compared on the same columns.
    """
    usable = {c: m for c, m in moments.items() if m[0] > 0}
    left_out = {c: "no rows" for c in moments if c not in usable}
    if quadratic:
        few = {c: f"{m[0]} rows for {len(design.columns)} columns" for c, m in usable.items() if m[0] <= len(design.columns)}
        left_out |= few
        usable = {c: m for c, m in usable.items() if c not in few}
    names = sorted(usable)
    if not names:
        raise ValueError("no class has enough rows")
    counts = np.array([usable[c][0] for c in names], float)
    means = np.array([usable[c][1] / usable[c][0] for c in names])
    scatters = [usable[c][2] - np.outer(usable[c][1], usable[c][1]) / usable[c][0] for c in names]
    total = counts.sum()
    shift = counts @ means / total
    spread = np.diag(sum(scatters)) + counts @ (means - shift) ** 2
    if quadratic:
        matrices, spreads = [s / (n - 1) for s, n in zip(scatters, counts, strict=True)], spread / total
    else:
        if total <= len(names):
            raise ValueError("there are no more rows than classes")
        matrices, spreads = [sum(scatters) / (total - len(names))], spread / (total - len(names))
    kept, roots, dropped = independent_columns(matrices, np.maximum(spreads, np.finfo(float).tiny))
    logs = [np.log(np.diag(r)).sum() if len(r) else 0.0 for r in roots]
    constants = np.log(counts / total) - (np.array(logs) if quadratic else 0.0)
    return Model(design, kept, {design.columns[j]: why for j, why in dropped.items()}, left_out, names, means[:, kept], roots, constants)


def _predicted(df: DataFrame, models: dict, by: list[str], numeric: list[str], factors: list[str], kind, name: str) -> DataFrame:
    """Add the prediction of each row's model; a row that is not whole, or has no model, has none."""

    @F.pandas_udf(kind)
    def predict(cell: pd.DataFrame, numbers: pd.Series, values: pd.Series) -> pd.Series:
        out = np.full(len(numbers), None, dtype=object)
        x = np.stack([np.array(v, float) for v in numbers]).reshape(len(numbers), len(numeric))
        levels = np.array([list(v) for v in values], dtype=object).reshape(len(values), len(factors))
        groups = cell.groupby(list(cell.columns)).indices if by else {(): np.arange(len(x))}
        for of, rows in groups.items():
            model = models.get(of if isinstance(of, tuple) else (of,))
            if model is not None:
                design, whole = model.design.matrix(x[rows], [levels[rows, i] for i in range(len(factors))])
                if whole.any():
                    out[rows[whole]] = model.predict(design[whole])
        return pd.Series(out)

    keys = F.struct(*[F.col(b) for b in by]) if by else F.struct(F.lit(0).alias("none"))
    missing = F.lit(float("nan"))
    numbers = F.array(*[F.coalesce(F.col(c).cast("double"), missing) for c in numeric]).cast("array<double>")
    texts = F.array(*[F.col(f).cast("string") for f in factors]).cast("array<string>")
    return df.withColumn(name, predict(keys, numbers, texts))


def discriminant_fit(
    df: DataFrame, numeric: list[str], factors: list[str], label: str, quadratic: bool = False, full: bool = False
) -> Model:
    """A discriminant of ``label`` by numbers and factors; two passes over the rows."""
    design, moments = class_moments(df, numeric, factors, label, full=full)
    return fit(design, {c: m for (_, c), m in moments.items()}, quadratic)


def discriminant_score(test: DataFrame, model: Model, label_type, name: str = "predicted") -> DataFrame:
    """Add the predicted class.  A row with a missing value or a level the fit has not seen has none."""
    return _predicted(test, {(): model}, [], model.design.numeric, model.design.factors, label_type, name)


def mixed_discriminant(
    train: DataFrame, test: DataFrame, numeric: list[str], factors: list[str], label: str, quadratic: bool = False,
    name: str = "predicted",
) -> DataFrame:
    """Test rows with the class predicted by a discriminant of the training rows."""
    model = discriminant_fit(train, numeric, factors, label, quadratic)
    return discriminant_score(test, model, train.schema[label].dataType, name)


def fold_models(
    df: DataFrame, numeric: list[str], factors: list[str], label: str, quadratic: bool = False
) -> dict[tuple, Model]:
    """The model of every (repeat, fold), from the other folds of its repeat.

    All of them come from one aggregate: the moments of the repeat less those
    of the fold.  A level that occurs in a single fold is a constant column
    there and is dropped by that fold's model.
    """
    design, moments = class_moments(df, numeric, factors, label, ["repeat", "fold"])
    width = len(design.columns)
    nothing = (0, np.zeros(width), np.zeros((width, width)))
    classes = sorted({c for _, c in moments})
    models = {}
    for repeat in sorted({by[0] for by, _ in moments}):
        folds = sorted({by for by, _ in moments if by[0] == repeat})
        whole = {c: [sum(x) for x in zip(*[moments.get((by, c), nothing) for by in folds], strict=True)] for c in classes}
        for by in folds:
            rest = {c: tuple(w - o for w, o in zip(whole[c], moments.get((by, c), nothing), strict=True)) for c in classes}
            models[by] = fit(design, rest, quadratic)
    return models


def mixed_discriminant_cv(
    df: DataFrame, numeric: list[str], factors: list[str], label: str, quadratic: bool = False, name: str = "predicted"
) -> DataFrame:
    """Predict every whole row of (repeat, fold) from the other folds of its repeat."""
    models = fold_models(df, numeric, factors, label, quadratic)
    whole = df.dropna(subset=[*numeric, *factors, label])
    return _predicted(whole, models, ["repeat", "fold"], numeric, factors, df.schema[label].dataType, name)
