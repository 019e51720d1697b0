"""Factors, splits and folds, and four classifiers.

Splits and folds follow a digest order, so they repeat exactly.  The discriminant
fits need only per-class moments; cross-validation gets every fold's training
moments by subtracting the fold from the total, in one pass over the data.
"""

from __future__ import annotations

import sys
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml import Pipeline
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import IndexToString, OneHotEncoder, StringIndexer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.operators.spread import hash_order, hash_rank

# Ship this module's functions with the tasks, so executors need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def factor_encode(df: DataFrame, columns: list[str], dummies: bool = True) -> DataFrame:
    """Level index (levels in text order, from 0) per column, and 0/1 columns but for the last level.

    ``<column>_index`` and, with ``dummies``, the array ``<column>_dummies``.
    """
    stages = [
        StringIndexer(
            inputCols=columns, outputCols=[f"{c}_index" for c in columns], stringOrderType="alphabetAsc",
            handleInvalid="error",
        )
    ]
    if dummies:
        stages.append(
            OneHotEncoder(
                inputCols=[f"{c}_index" for c in columns], outputCols=[f"{c}_dummies" for c in columns], dropLast=True
            )
        )
    encoded = Pipeline(stages=stages).fit(df).transform(df)
    out = {f"{c}_index": F.col(f"{c}_index").cast("int") for c in columns}
    if dummies:
        out |= {f"{c}_dummies": vector_to_array(F.col(f"{c}_dummies")) for c in columns}
    return encoded.withColumns(out)


def stratified_split(df: DataFrame, label: str, key: str, share: float = 0.8, seed: int = 1) -> DataFrame:
    """``part`` is 'train' for ceiling(share * n) rows of every class, 'test' for the others."""
    ranked = hash_rank(df.withColumn("_digest", hash_order(seed, key)), [label], "_digest", [key], "_rank", total="_n")
    train = F.col("_rank") <= F.ceil(F.round(F.col("_n") * F.lit(share), 9))
    return ranked.withColumn("part", F.when(train, "train").otherwise("test")).drop("_digest", "_rank", "_n")


def repeated_folds(df: DataFrame, label: str, key: str, folds: int = 10, repeats: int = 30, seed: int = 1) -> DataFrame:
    """One row per row and repeat, with a fold id balanced within every class."""
    each = df.withColumn("repeat", F.explode(F.sequence(F.lit(1), F.lit(repeats))))
    each = each.withColumn("_digest", hash_order(seed, "repeat", key))
    ranked = hash_rank(each, ["repeat", label], "_digest", [key], "_rank")
    return ranked.withColumn("fold", F.pmod(F.col("_rank") - 1, F.lit(folds)).cast("int")).drop("_digest", "_rank")


# ---- discriminants ---------------------------------------------------------


def _moment_columns(features: list[str], centre: list[float]) -> list[Column]:
    x = [F.col(f) - F.lit(c) for f, c in zip(features, centre, strict=True)]
    sums = [F.sum(v).alias(f"s{i}") for i, v in enumerate(x)]
    products = [F.sum(x[i] * x[j]).alias(f"q{i}_{j}") for i in range(len(x)) for j in range(i, len(x))]
    return [F.count("*").alias("n"), *sums, *products]


def _class_moments(df: DataFrame, features: list[str], label: str, by: list[str]):
    """Per (by, class): n, sum and cross products around the overall mean, as numpy arrays."""
    p = len(features)
    complete = df.dropna(subset=[*features, label])
    means = complete.agg(*[F.avg(f).alias(f"m{i}") for i, f in enumerate(features)]).first()
    centre = [means[f"m{i}"] for i in range(p)]
    found = {}
    for row in complete.groupBy(*by, label).agg(*_moment_columns(features, centre)).collect():
        products = np.zeros((p, p))
        for i in range(p):
            for j in range(i, p):
                products[i, j] = products[j, i] = row[f"q{i}_{j}"]
        found[tuple(row[b] for b in by), row[label]] = (row["n"], np.array([row[f"s{i}"] for i in range(p)]), products)
    return np.array(centre), found


def _discriminants(moments: dict, quadratic: bool) -> dict:
    """Per class the score (constant, linear, quadratic part) around the centre."""
    usable = {c: m for c, m in moments.items() if m[0] > 0}
    total = sum(n for n, _, _ in usable.values())
    scatter = {c: q - np.outer(s, s) / n for c, (n, s, q) in usable.items()}
    pooled = sum(scatter.values()) / (total - len(usable))
    scores = {}
    for c, (n, s, _) in usable.items():
        mean = s / n
        covariance = scatter[c] / (n - 1) if quadratic else pooled
        inverse = np.linalg.inv(covariance)
        constant = np.log(n / total) - 0.5 * mean @ inverse @ mean
        if quadratic:
            constant -= 0.5 * np.linalg.slogdet(covariance)[1]
        scores[c] = (float(constant), inverse @ mean, -0.5 * inverse if quadratic else np.zeros_like(inverse))
    return scores


def discriminant_predict(
    train: DataFrame, test: DataFrame, features: list[str], label: str, quadratic: bool = False, name: str = "predicted"
) -> DataFrame:
    """Linear or quadratic discriminant: fit on class moments, score as Column expressions.

    Priors are class shares.  Equal scores go to the larger label.  A row with a
    missing feature (NULL or NaN) has no prediction.
    """
    centre, moments = _class_moments(train, features, label, [])
    scores = _discriminants({c: m for (_, c), m in moments.items()}, quadratic)
    x = [F.col(f) - F.lit(float(m)) for f, m in zip(features, centre, strict=True)]
    options = []
    for level in sorted(scores):
        constant, linear, square = scores[level]
        terms = [F.lit(constant), *[x[i] * F.lit(float(w)) for i, w in enumerate(linear)]]
        if quadratic:
            terms += [
                x[i] * x[j] * F.lit(float(square[i, j] * (1 if i == j else 2)))
                for i in range(len(x))
                for j in range(i, len(x))
            ]
        options.append(F.struct(reduce(lambda a, b: a + b, terms).alias("score"), F.lit(level).alias("label")))
    whole = reduce(lambda a, b: a & b, [F.col(f).isNotNull() & ~F.isnan(F.col(f).cast("double")) for f in features])
    return test.withColumn(name, F.when(whole, F.array_max(F.array(*options))["label"]))


def discriminant_cv(df: DataFrame, features: list[str], label: str, quadratic: bool = False, name: str = "predicted") -> DataFrame:
    """Predict every row of (repeat, fold) from the other folds of its repeat.

    Training moments are the repeat's total less the fold's own, so all folds
    of all repeats are fitted by one aggregate.
    """
    centre, moments = _class_moments(df, features, label, ["repeat", "fold"])
    cells = sorted({by for by, _ in moments})
    levels = sorted({c for _, c in moments})
    p = len(features)
    nothing = (0, np.zeros(p), np.zeros((p, p)))
    models = {}
    for repeat in sorted({r for r, _ in cells}):
        whole = {
            c: [sum(x) for x in zip(*[moments.get((by, c), nothing) for by in cells if by[0] == repeat], strict=True)]
            for c in levels
        }
        for by in cells:
            if by[0] == repeat:
                rest = {
                    c: tuple(w - o for w, o in zip(whole[c], moments.get((by, c), nothing), strict=True)) for c in levels
                }
                scores = _discriminants(rest, quadratic)
                models[by] = (
                    sorted(scores),
                    np.array([scores[c][0] for c in sorted(scores)]),
                    np.array([scores[c][1] for c in sorted(scores)]),
                    np.array([scores[c][2] for c in sorted(scores)]),
                )
    label_type = df.schema[label].dataType

    @F.pandas_udf(label_type)
    def predict(repeat: pd.Series, fold: pd.Series, values: pd.Series) -> pd.Series:
        out = pd.Series([None] * len(values), dtype=object)
        for by, rows in pd.DataFrame({"r": repeat, "f": fold}).groupby(["r", "f"]).groups.items():
            names, constant, linear, square = models[(int(by[0]), int(by[1]))]
            x = np.stack(values.loc[rows].to_numpy()) - centre
            score = constant + x @ linear.T + np.einsum("ni,kij,nj->nk", x, square, x)
            out.loc[rows] = np.array(names, dtype=object)[len(names) - 1 - score[:, ::-1].argmax(axis=1)]
        return out

    whole = df.dropna(subset=[*features, label])
    return whole.withColumn(name, predict("repeat", "fold", F.array(*[F.col(f).cast("double") for f in features])))


# ---- tree ------------------------------------------------------------------


def _label_indexer(df: DataFrame, label: str):
    return StringIndexer(inputCol=label, outputCol="_index", stringOrderType="alphabetAsc").fit(df)


def tree_predict(
    train: DataFrame, test: DataFrame, features: str, label: str, name: str = "predicted", max_depth: int = 5,
    min_info_gain: float = 0.01, seed: int = 1, indexer=None,
) -> DataFrame:
    """Classification tree on an array column of features, depth and gain as tuning values."""
    as_vector = array_to_vector(F.col(features).cast("array<double>"))
    indexer = indexer or _label_indexer(train, label)
    tree = DecisionTreeClassifier(
        featuresCol="_vector", labelCol="_index", predictionCol="_predicted", rawPredictionCol="_raw",
        probabilityCol="_probability", maxDepth=max_depth, minInfoGain=min_info_gain, seed=seed,
    ).fit(indexer.transform(train).withColumn("_vector", as_vector))
    back = IndexToString(inputCol="_predicted", outputCol=name, labels=indexer.labels)
    scored = back.transform(tree.transform(test.withColumn("_vector", as_vector)))
    return scored.drop("_vector", "_raw", "_probability", "_predicted").withColumn(
        name, F.col(name).cast(train.schema[label].dataType)
    )


def tree_cv(df: DataFrame, features: str, label: str, folds: int, repeats: int, name: str = "predicted", **tuning) -> DataFrame:
    """Predict every row of (repeat, fold) by a tree grown on the other folds; one fit per fold."""
    parts, indexer = [], _label_indexer(df, label)
    for repeat in range(1, repeats + 1):
        rows = df.filter(F.col("repeat") == repeat)
        for fold in range(folds):
            train, test = rows.filter(F.col("fold") != fold), rows.filter(F.col("fold") == fold)
            parts.append(tree_predict(train, test, features, label, name, indexer=indexer, **tuning))
    return reduce(DataFrame.unionByName, parts)


# ---- nearest neighbours ----------------------------------------------------


def nearest_neighbours(
    queries: DataFrame, training: DataFrame, features: str, key: str, label: str, k: int,
    fold: str | None = None, pivots: int = 64, block: int = 20_000,
) -> DataFrame:
    """The k nearest training rows of every query, exactly, by Euclidean distance.

    Training rows belong to the cell of their nearest pivot.  Ring counts per
    cell bound the k-th distance of a query; cells that lie beyond the bound
    cannot hold a neighbour and are not visited.  Cells larger than ``block``
    rows are cut into blocks, queries likewise, so a task compares at most
    block x block rows and returns no more than k rows per query.  Distance
    ties go to the smaller key.  With ``fold``, a query skips the training rows
    of its own fold.
    """
    spark = queries.sparkSession
    as_double = F.col(features).cast("array<double>")
    fold_col = F.col(fold).cast("int") if fold else F.lit(-1)
    key_type, label_type = training.schema[key].dataType, training.schema[label].dataType
    base = training.select(
        F.col(key).alias("t_key"), F.col(label).alias("t_label"), fold_col.alias("t_fold"), as_double.alias("t_x")
    )
    asked = queries.select(
        F.col(key).alias("q_key"), (fold_col if fold else F.lit(-2)).alias("q_fold"), as_double.alias("q_x")
    )
    # A row without vector, or with a missing component, has no neighbours and is none.
    base = base.filter(F.col("t_x").isNotNull() & F.forall("t_x", lambda v: v.isNotNull() & ~F.isnan(v)))
    asked = asked.filter(F.col("q_x").isNotNull() & F.forall("q_x", lambda v: v.isNotNull() & ~F.isnan(v)))
    # A fixed number of pivots, whatever the data size.
    chosen = base.orderBy(F.md5(F.col("t_key").cast("string")), "t_key").limit(pivots).select("t_x").collect()
    centre = np.array([r.t_x for r in chosen], dtype=float)
    if not len(centre):
        return spark.createDataFrame([], _neighbour_schema(key, key_type, label_type))
    scale = float(np.linalg.norm(centre - centre[0], axis=1).max()) or 1.0

    def to_pivots(x: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(0.0, ((x[:, None, :] - centre[None, :, :]) ** 2).sum(axis=2)))

    @F.pandas_udf("cell int, reach double")
    def assign(x: pd.Series) -> pd.DataFrame:
        distance = np.concatenate([to_pivots(part) for part in np.array_split(np.stack(x.to_numpy()), len(x) // 1024 + 1)])
        cell = distance.argmin(axis=1)
        return pd.DataFrame({"cell": cell.astype("int32"), "reach": distance[np.arange(len(cell)), cell]})

    celled = base.withColumn("_at", assign("t_x")).select("*", "_at.cell", "_at.reach").drop("_at")
    ring = F.least(F.floor(F.col("reach") / F.lit(scale) * 256), F.lit(1024))
    rings = (
        celled.groupBy("cell", "t_fold", ring.alias("ring"))
        .agg(F.count("*").alias("n"), F.max("reach").alias("edge"))
        .toPandas()  # at most pivots x folds x 1025 rows
    )
    size = rings.groupby("cell")["n"].sum()
    radius = rings.groupby("cell")["edge"].max()
    cells = np.array(sorted(size.index))
    own_folds = sorted(rings["t_fold"].unique()) if fold else [-2]
    bound = {}
    for f in own_folds:
        others = rings[rings["t_fold"] != f].sort_values(["cell", "edge"])
        enough = others[others.groupby("cell")["n"].cumsum() >= k].groupby("cell")["edge"].min()
        bound[int(f)] = enough.reindex(cells).fillna(np.inf).to_numpy()
    no_fold = np.full(len(cells), np.inf)
    cell_radius = radius.reindex(cells).to_numpy()

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def route(x: pd.Series, own: pd.Series) -> pd.Series:
        out = []
        values, folds_of = np.stack(x.to_numpy()), own.to_numpy()
        for part, of in zip(
            np.array_split(values, len(values) // 1024 + 1), np.array_split(folds_of, len(values) // 1024 + 1), strict=True
        ):
            distance = to_pivots(part)[:, cells]
            limit = np.array([(d + bound.get(int(f), no_fold)).min() for d, f in zip(distance, of, strict=True)])
            visit = distance - cell_radius[None, :] <= (limit * (1 + 1e-9) + 1e-12)[:, None]
            out += [cells[v].tolist() for v in visit]
        return pd.Series(out)

    query_blocks = max(1, -(-asked.count() // block))
    blocks_of = [1] * len(centre)
    for cell, n in size.items():
        blocks_of[int(cell)] = max(1, -(-int(n) // block))
    blocks = F.element_at(F.array(*[F.lit(b) for b in blocks_of]), F.col("cell") + 1)
    left = (
        asked.withColumn("cell", F.explode(route("q_x", "q_fold")))
        .withColumn("qb", F.pmod(F.xxhash64("q_key"), F.lit(query_blocks)).cast("int"))
        .withColumn("tb", F.explode(F.sequence(F.lit(0), blocks - 1)))
    )
    right = (
        celled.drop("reach")
        .withColumn("tb", F.pmod(F.xxhash64("t_key"), blocks).cast("int"))
        .withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    )

    def compare(q: pd.DataFrame, t: pd.DataFrame) -> pd.DataFrame:
        kept = []
        if len(q) and len(t):
            tx, t_key, t_fold = np.stack(t["t_x"].to_numpy()), t["t_key"].to_numpy(), t["t_fold"].to_numpy()
            shift = tx.mean(axis=0)
            tx = tx - shift
            t_norm = (tx**2).sum(axis=1)
            for start in range(0, len(q), 512):
                part = q.iloc[start : start + 512]
                qx = np.stack(part["q_x"].to_numpy()) - shift
                rough = (qx**2).sum(axis=1)[:, None] + t_norm[None, :] - 2.0 * qx @ tx.T
                rough[part["q_fold"].to_numpy()[:, None] == t_fold[None, :]] = np.inf
                at = min(k, len(t)) - 1
                cut = np.partition(rough, at, axis=1)[:, at]
                slack = 1e-9 * ((qx**2).sum(axis=1) + t_norm.max())
                rows, columns = np.nonzero((rough <= (cut + slack)[:, None]) & np.isfinite(rough))
                exact = np.sqrt(((qx[rows] - tx[columns]) ** 2).sum(axis=1))
                order = np.lexsort((t_key[columns], exact, rows))
                rows, columns, exact = rows[order], columns[order], exact[order]
                first = np.r_[0, np.flatnonzero(np.diff(rows)) + 1] if len(rows) else np.array([], dtype=int)
                place = np.arange(len(rows)) - np.repeat(first, np.diff(np.r_[first, len(rows)]))
                best = place < k
                kept.append(
                    pd.DataFrame(
                        {
                            "q_key": part["q_key"].to_numpy()[rows[best]],
                            "t_key": t_key[columns[best]],
                            "t_label": t["t_label"].to_numpy()[columns[best]],
                            "distance": exact[best],
                        }
                    )
                )
        if not kept:
            return pd.DataFrame({"q_key": [], "t_key": [], "t_label": [], "distance": []})
        return pd.concat(kept)

    by = ["cell", "tb", "qb"]
    block_schema = T.StructType(
        [
            T.StructField("q_key", key_type), T.StructField("t_key", key_type), T.StructField("t_label", label_type),
            T.StructField("distance", T.DoubleType()),
        ]
    )
    found = left.groupBy(*by).cogroup(right.groupBy(*by)).applyInPandas(compare, block_schema)
    place = F.row_number().over(Window.partitionBy("q_key").orderBy("distance", "t_key"))
    return found.withColumn("rank", place).filter(F.col("rank") <= k).select(
        F.col("q_key").alias(key), F.col("t_key").alias("neighbour"), F.col("t_label").alias("neighbour_label"),
        "distance", "rank",
    )


def _neighbour_schema(key: str, key_type, label_type) -> T.StructType:
    return T.StructType(
        [
            T.StructField(key, key_type), T.StructField("neighbour", key_type),
            T.StructField("neighbour_label", label_type), T.StructField("distance", T.DoubleType()),
            T.StructField("rank", T.IntegerType()),
        ]
    )


def knn_vote(neighbours: DataFrame, key: str, ks: list[int], name: str = "predicted") -> DataFrame:
    """Majority label among the first k neighbours for every k; ties go to the smaller label."""
    each = neighbours.withColumn("k", F.explode(F.array(*[F.lit(k) for k in ks]))).filter(F.col("rank") <= F.col("k"))
    votes = each.groupBy(key, "k", "neighbour_label").agg(F.count("*").alias("_votes"))
    return votes.groupBy(key, "k").agg(F.min(F.struct(-F.col("_votes"), "neighbour_label"))["neighbour_label"].alias(name))


def knn_classify(train: DataFrame, test: DataFrame, features: str, key: str, label: str, k: int = 5, **options) -> DataFrame:
    """Test rows with the majority label of their k nearest training rows."""
    found = nearest_neighbours(test, train, features, key, label, k, **options)
    return test.join(knn_vote(found, key, [k]).drop("k"), key, "left")
