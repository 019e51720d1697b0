"""Discriminants on numbers and factors against a dense brute-force fit."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortloom.operators import discriminants

COLLEGES, TIERS = ["arts", "law", "science"], ["1", "2", "3", "4"]
DDL = "id int, y string, score double, credits double, college string, tier string"


@pytest.fixture(scope="module")
def students():
    rng = np.random.default_rng(11)
    n = 420
    y = rng.choice(["four", "five", "six"], n, p=[0.5, 0.3, 0.2])
    late = np.array([{"four": 0, "five": 1, "six": 2}[v] for v in y])
    score = rng.normal(size=n) * (1 + 0.4 * late) - 0.8 * late + 1e6
    credits = rng.normal(size=n) + 0.3 * score
    college = [COLLEGES[(k + rng.choice(3, p=[0.5, 0.35, 0.15])) % 3] for k in late]
    tier = [TIERS[rng.integers(0, 4)] for _ in range(n)]
    return [(i, str(a), float(b), float(c), d, e) for i, (a, b, c, d, e) in enumerate(zip(y, score, credits, college, tier))]


def dense(rows):
    one_hot = [[float(r[4] == c) for c in COLLEGES[:-1]] + [float(r[5] == t) for t in TIERS[:-1]] for r in rows]
    return np.hstack([np.array([r[2:4] for r in rows]), np.array(one_hot)]), np.array([r[1] for r in rows])


def brute(x, y, at, quadratic):
    classes, scale = sorted(set(y)), np.r_[x[:, :2].mean(0), np.zeros(x.shape[1] - 2)]
    x, at, scores = x - scale, at - scale, []
    pooled = sum((x[y == c] - x[y == c].mean(0)).T @ (x[y == c] - x[y == c].mean(0)) for c in classes) / (len(y) - len(classes))
    for c in classes:
        s = np.cov(x[y == c].T) if quadratic else pooled
        d = at - x[y == c].mean(0)
        scores.append(np.log((y == c).mean()) - 0.5 * np.einsum("ni,ij,nj->n", d, np.linalg.inv(s), d) - (0.5 * np.linalg.slogdet(s)[1] if quadratic else 0))
    return np.array(classes)[np.argmax(scores, axis=0)].tolist()


NUMBERS, FACTORS = ["score", "credits"], ["college", "tier"]


@pytest.mark.parametrize("quadratic", [False, True])
def test_equal_to_a_dense_fit(spark, students, quadratic):
    train, test = spark.createDataFrame(students[100:], DDL), spark.createDataFrame(students[:100], DDL)
    out = discriminants.mixed_discriminant(train, test, NUMBERS, FACTORS, "y", quadratic)
    x, y = dense(students)
    assert [r.predicted for r in out.orderBy("id").collect()] == brute(x[100:], y[100:], x[:100], quadratic)


@pytest.mark.parametrize("quadratic", [False, True])
def test_all_folds_equal_a_dense_fit(spark, students, quadratic):
    df = spark.createDataFrame(students, DDL).crossJoin(spark.createDataFrame([(1,), (2,)], "repeat int"))
    df = df.withColumn("fold", F.pmod(F.col("id") + F.col("id") / 7 * F.col("repeat"), F.lit(4)).cast("int"))
    got = {(r.repeat, r.id): (r.fold, r.predicted) for r in discriminants.mixed_discriminant_cv(df, NUMBERS, FACTORS, "y", quadratic).collect()}
    x, y = dense(students)
    for repeat in (1, 2):
        fold = np.array([got[repeat, i][0] for i in range(len(students))])
        for f in range(4):
            at = np.flatnonzero(fold == f)
            assert [got[repeat, i][1] for i in at] == brute(x[fold != f], y[fold != f], x[fold == f], quadratic)


def test_redundant_and_constant_columns_are_dropped_and_reported(spark, students):
    df = spark.createDataFrame(students, DDL).withColumns(
        {"twice": F.col("score") * 2 - F.col("credits"), "same": F.lit(7.0), "only": F.lit("x"), "outcome": F.when(F.col("y") == "six", 1.0).otherwise(0.0)}
    )
    model = discriminants.discriminant_fit(df, ["score", "same", "credits", "twice", "outcome"], [*FACTORS, "only"], "y", full=True)
    report = {r.name: (r.used, r.reason) for r in model.report(spark).filter("kind = 'column'").collect()}
    assert report["score"] == (True, None) and report["credits"] == (True, None)
    for constant in ("same", "only=x", "outcome"):
        assert report[constant] == (False, "constant within classes")
    for dependent in ("twice", "college=science", "tier=4"):
        assert report[dependent] == (False, "depends on the columns before it")
    assert len(model.kept) == 7
    plain = discriminants.mixed_discriminant(df, df, NUMBERS, FACTORS, "y")
    wide = discriminants.discriminant_score(df, model, df.schema["y"].dataType)
    assert [r.predicted for r in wide.orderBy("id").collect()] == [r.predicted for r in plain.orderBy("id").collect()]


def test_quadratic_with_a_level_absent_from_a_class(spark, students):
    rows = [r for r in students if not (r[1] == "five" and r[4] == "arts")] + [(9000 + i, "rare", float(i), 0.0, "arts", "1") for i in range(3)]
    df = spark.createDataFrame(rows, DDL)
    model = discriminants.discriminant_fit(df, NUMBERS, FACTORS, "y", quadratic=True)
    assert model.dropped == {"college=arts": "constant within classes"} and list(model.left_out) == ["rare"]
    x, y = dense([r for r in rows if r[1] != "rare"])
    kept = [0, 1, 3, 4, 5, 6]
    out = discriminants.discriminant_score(df.filter("y <> 'rare'"), model, df.schema["y"].dataType)
    assert [r.predicted for r in out.orderBy("id").collect()] == brute(x[:, kept], y, x[:, kept], True)
    assert {r.name: r.used for r in model.report(spark).filter("kind = 'class'").collect()} == {"five": True, "four": True, "six": True, "rare": False}


@pytest.mark.parametrize("quadratic", [False, True])
def test_missing_values_and_unknown_levels(spark, students, quadratic):
    odd = [(1, None, 1.0, 1.0, "law", "1"), (2, "four", None, 1.0, "law", "1"), (3, "four", float("nan"), 1.0, "law", "1"), (4, "four", 1.0, 1.0, None, "1")]
    df = spark.createDataFrame(students + odd, DDL)
    asked = spark.createDataFrame([*odd, (5, None, 1e6, 3e5, "medicine", "1"), (6, None, 1e6, 3e5, "arts", "1")], DDL)
    got = {r.id: r.predicted for r in discriminants.mixed_discriminant(df, asked, NUMBERS, FACTORS, "y", quadratic).collect()}
    assert got[6] is not None and got[1] is not None and {got[i] for i in (2, 3, 4, 5)} == {None}


def test_numbers_alone_factors_alone_and_ties(spark, students):
    df = spark.createDataFrame(students, DDL)
    assert discriminants.mixed_discriminant(df, df, NUMBERS, [], "y").filter("predicted IS NULL").count() == 0
    assert discriminants.mixed_discriminant(df, df, [], FACTORS, "y").filter("predicted IS NULL").count() == 0
    even = spark.createDataFrame([(1, "a", 1.0), (2, "a", 2.0), (3, "b", 1.0), (4, "b", 2.0)], "id int, y string, x double")
    assert {r.predicted for r in discriminants.mixed_discriminant(even, even, ["x"], [], "y").collect()} == {"b"}
    with pytest.raises(ValueError):
        discriminants.mixed_discriminant(even.filter("id < 0"), even, ["x"], [], "y")


def test_moments_of_all_folds_are_one_aggregate(spark, students):
    df = spark.createDataFrame(students, DDL).withColumn("repeat", F.lit(1)).withColumn("fold", F.col("id") % 3)
    jobs = []
    collect = type(df).collect
    try:
        type(df).collect = lambda self: jobs.append(1) or collect(self)
        discriminants.fold_models(df, NUMBERS, FACTORS, "y")
    finally:
        type(df).collect = collect
    assert len(jobs) == 2  # the means of the numbers, and all moments


def test_columns_of_a_factor_are_bounded():
    with pytest.raises(ValueError):
        discriminants.Design([], ["f"], {"f": [str(i) for i in range(discriminants.MAX_COLUMNS + 2)]}, np.zeros(0))
