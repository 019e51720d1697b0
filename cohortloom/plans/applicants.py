"""Applicant study: components of the numeric table, then classifiers of time to degree."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.operators import classify, discriminants, metrics, pruned_tree
from cohortloom.operators.components import PrincipalComponents, pca_scores
from cohortloom.session import saved

# The numeric and the categorical columns of the study.
NUMERIC = ["hs_gpa", "hs_gpa_uwh", "satm", "satv", "sat_total", "actc", "hspct", "trf_credits"]
CATEGORICAL = ["college", "gender", "first_gen", "tier_designation", "underrepresented_minority"]
OUTCOME = "grad_years"

# The ten neighbour counts tried, and the share of every class used for training.
NEIGHBOUR_COUNTS = [5, 7, 9, 11, 13, 15, 17, 19, 21, 23]
TRAINING_SHARE = 0.8


def study_table(numeric: DataFrame, categorical: DataFrame, key: str, columns: list[str], factors: list[str], outcome: str) -> DataFrame:
    """Categoricals, as they are and as dummies, three component scores, and the array of all features."""
    fit = PrincipalComponents(numeric, columns)
    joined = pca_scores(fit, numeric, categorical.fillna("0", subset=[c for c in factors if c == "tier_designation"]), key)
    encoded = classify.factor_encode(joined, factors)
    features = F.concat(*[F.col(f"{c}_dummies") for c in factors], F.array("pc1", "pc2", "pc3"))
    return encoded.select(key, outcome, *factors, "pc1", "pc2", "pc3", features.alias("features"))


def compare_models(
    table: DataFrame, key: str, outcome: str, numeric: list[str], features: str = "features", folds: int = 10,
    repeats: int = 30, k: int = 5, tree_depth: int = 5, factors: list[str] | None = None,
) -> DataFrame:
    """Accuracy and kappa of every model and fold, as long rows.

    The discriminants use the numeric columns and the factors and fit all folds in one pass;
    neighbours run once per repeat; the trees of all folds are grown together,
    by one scan per level, and pruned at the complexity of the best held-out accuracy.
    """
    folded = saved(classify.repeated_folds(table, outcome, key, folds, repeats))
    parts = [
        metrics.cv_metrics(discriminants.mixed_discriminant_cv(folded, numeric, factors or [], outcome, quadratic), name, "predicted", outcome)
        for name, quadratic in (("lda", False), ("qda", True))
    ]
    for repeat in range(1, repeats + 1):
        rows = folded.filter(F.col("repeat") == repeat)
        found = classify.nearest_neighbours(rows, rows, features, key, outcome, k, fold="fold")
        voted = rows.join(classify.knn_vote(found, key, [k]), key)
        parts.append(metrics.cv_metrics(voted, "knn", "predicted", outcome))
    data = pruned_tree.binned(table, features, outcome, key, folded)
    forest = pruned_tree.grow(data, tree_depth)
    best = pruned_tree.best_complexity(pruned_tree.tune(data, forest))
    grown = pruned_tree.cv_predictions(data, forest, best, table.schema[outcome].dataType)
    parts.append(metrics.cv_metrics(grown, "tree", "predicted", "label"))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def tune_neighbours(
    folded: DataFrame, key: str, outcome: str, features: str = "features", ks: list[int] | None = None, repeats: int = 30
) -> DataFrame:
    """Cross-validated accuracy and kappa per neighbour count; one neighbour search per repeat serves all counts."""
    ks = ks or NEIGHBOUR_COUNTS
    scored = []
    for repeat in range(1, repeats + 1):
        rows = folded.filter(F.col("repeat") == repeat)
        found = classify.nearest_neighbours(rows, rows, features, key, outcome, max(ks), fold="fold")
        voted = rows.join(classify.knn_vote(found, key, ks), key)
        scored.append(metrics.accuracy_kappa(voted, "predicted", outcome, ["k", "repeat", "fold"]))
    return _per_value(scored, "k")


def tune_pruning(table: DataFrame, folded: DataFrame, key: str, outcome: str, features: str = "features", depth: int = 10) -> DataFrame:
    """Cross-validated accuracy per complexity of the pruned tree; one scan per level grows the trees of all folds."""
    data = pruned_tree.binned(table, features, outcome, key, folded)
    return pruned_tree.tune(data, pruned_tree.grow(data, depth))


def tune_tree(
    folded: DataFrame, outcome: str, depths: list[int], features: str = "features", folds: int = 10, repeats: int = 30
) -> DataFrame:
    """Cross-validated accuracy and kappa per tree depth."""
    scored = []
    for depth in depths:
        grown = classify.tree_cv(folded, features, outcome, folds, repeats, max_depth=depth)
        scores = metrics.accuracy_kappa(grown, "predicted", outcome, ["repeat", "fold"])
        scored.append(scores.withColumn("depth", F.lit(depth)))
    return _per_value(scored, "depth")


def _per_value(scored: list[DataFrame], value: str) -> DataFrame:
    whole = scored[0]
    for part in scored[1:]:
        whole = whole.unionByName(part)
    return whole.groupBy(value).agg(
        F.count("*").alias("fits"), F.avg("accuracy").alias("accuracy"), F.stddev_samp("accuracy").alias("accuracy_sd"),
        F.avg("kappa").alias("kappa"),
    )


def best_value(tuning: DataFrame, value: str, simpler_is_larger: bool) -> int:
    """The tuning value of the highest accuracy; ties go to the simpler model."""
    tie = F.col(value).desc() if simpler_is_larger else F.col(value).asc()
    return tuning.orderBy(F.col("accuracy").desc(), tie).first()[value]


def held_out_predictions(
    table: DataFrame, key: str, outcome: str, numeric: list[str], features: str = "features", k: int = 5,
    tree_depth: int = 5, seed: int = 1, factors: list[str] | None = None,
) -> dict[str, DataFrame]:
    """Predictions of every model for the held-out fifth of each class."""
    parts = saved(classify.stratified_split(table, outcome, key, TRAINING_SHARE, seed))
    train, test = parts.filter(F.col("part") == "train"), parts.filter(F.col("part") == "test")
    return {
        "lda": discriminants.mixed_discriminant(train, test, numeric, factors or [], outcome),
        "qda": discriminants.mixed_discriminant(train, test, numeric, factors or [], outcome, quadratic=True),
        "knn": classify.knn_classify(train, test, features, key, outcome, k),
        "tree": _pruned_predictions(train, test, features, key, outcome, tree_depth, seed),
    }


def _pruned_predictions(
    train: DataFrame, test: DataFrame, features: str, key: str, outcome: str, depth: int, seed: int, folds: int = 10
) -> DataFrame:
    """The test rows by the tree of all training rows, pruned as ten folds of them do best."""
    folded = saved(classify.repeated_folds(train.select(key, outcome), outcome, key, folds, 1, seed))
    data = pruned_tree.binned(train, features, outcome, key, folded)
    forest = pruned_tree.grow(data, depth)
    best = pruned_tree.best_complexity(pruned_tree.tune(data, forest))
    return pruned_tree.predict(test, features, data, forest[pruned_tree.WHOLE, 0], best, train.schema[outcome].dataType)


def held_out_scores(predictions: dict[str, DataFrame], outcome: str) -> DataFrame:
    """Accuracy, kappa and no-information rate of every model on the held-out rows."""
    parts = [
        metrics.accuracy_kappa(df, "predicted", outcome).withColumn("model", F.lit(model)) for model, df in predictions.items()
    ]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole
