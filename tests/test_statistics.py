"""Statistics against numpy and published results, classifiers against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortloom.operators import classify, components, metrics, moments, order_stats
from cohortloom.operators.components import PrincipalComponents, factor_analysis, pca_scores


def frame(spark, columns, ddl):
    return spark.createDataFrame(list(zip(*[[v.item() if hasattr(v, "item") else v for v in c] for c in columns])), ddl)


@pytest.fixture(scope="module")
def sample():
    rng = np.random.default_rng(7)
    g = np.array(["a", "b", "c"])[rng.integers(0, 3, 900)]
    x = np.where(g == "a", rng.normal(10, 2, 900), np.where(g == "b", rng.integers(0, 4, 900), rng.exponential(1e6, 900)))
    return g, x


@pytest.mark.parametrize("grid,piece_rows", [(4, 1_000_000), (1024, 1_000_000), (16, 60)])
def test_quantiles_match_numpy(spark, sample, grid, piece_rows, monkeypatch):
    """Counted at once, after a second sketch, and after as many as it takes to reach pieces of a row."""
    g, x = sample
    ranks = {"first": F.lit(1), "middle": F.floor((F.col("n") + 1) / 2), "last": F.col("n")}
    found = order_stats.order_statistics(frame(spark, [g, x], "g string, x double"), ["g"], "x", ranks, grid, piece_rows)
    for r in found.collect():
        values = np.sort(x[g == r.g])
        assert (r.first, r.middle, r.last, r.n) == (values[0], values[(len(values) + 1) // 2 - 1], values[-1], len(values))


def test_quartiles_and_missing(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, None), (3.0, 5.0), (4.0, 5.0)], "a double, b double")
    got = {r.column: r for r in order_stats.column_summary(df.withColumn("c", F.lit(None).cast("double")), ["a", "b", "c"]).collect()}
    assert (got["a"].q1, got["a"].median, got["a"].q3, got["a"]["mean"], got["a"].missing) == (1.75, 2.5, 3.25, 2.5, 0)
    assert (got["b"].min, got["b"].max, got["b"].missing) == (5.0, 5.0, 1)
    assert got["c"].median is None and got["c"].missing == 4


def test_box_summary(spark):
    rows = [("four", float(v)) for v in (1, 2, 3, 4)] + [("one", 9.0)] + [("out", float(v)) for v in (1, 2, 3, 4, 5, 100)]
    got = {r.g: r for r in order_stats.box_summary(spark.createDataFrame(rows, "g string, x double"), "g", "x").collect()}
    four = got["four"]
    assert (four.lower_hinge, four.median, four.upper_hinge, four.outliers) == (1.5, 2.5, 3.5, 0)
    assert four.notch_high == pytest.approx(2.5 + 1.58 * 2 / 2)
    assert (got["one"].lower_hinge, got["one"].upper_whisker) == (9.0, 9.0)
    assert (got["out"].upper_whisker, got["out"].outliers) == (5.0, 1)


def test_histogram_integrates_to_one(spark, sample):
    _, x = sample
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    bins = moments.density_histogram(df, "x").collect()
    assert sum(b["count"] for b in bins) == len(x)
    assert sum(b.density * (b.bin_right - b.bin_left) for b in bins) == pytest.approx(1.0)
    closed = moments.density_histogram(spark.createDataFrame([(0.0,), (1.0,), (1.5,), (2.0,)], "x double"), "x", 0.0, 1.0)
    assert sorted((b.bin, b["count"]) for b in closed.collect()) == [(0, 2), (1, 2)]


def test_normal_curve(spark):
    curve = moments.normal_curve(spark)
    assert curve.count() == 601
    peak = curve.filter(F.col("x") == 0).first()
    assert peak.density == pytest.approx(1 / math.sqrt(2 * math.pi))


def test_group_zstat_is_standard(spark):
    """Sample means of many samples: z has mean near 0 and variance near 1."""
    rng = np.random.default_rng(1978)
    x = rng.normal(50, 10, (200, 100))
    df = spark.createDataFrame([(i, float(v)) for i in range(200) for v in x[i]], "sample int, x double")
    z = moments.group_zstat(df, "sample", "x", 50.0, 10.0).agg(F.avg("z"), F.var_samp("z")).first()
    assert abs(z[0]) < 0.25 and 0.7 < z[1] < 1.3


def test_standardise_constant_is_missing(spark):
    df = spark.createDataFrame([(1.0, 3.0), (2.0, 3.0), (3.0, 3.0)], "a double, b double")
    rows = moments.standardise(df, ["a", "b"]).orderBy("a").collect()
    assert [r.a_z for r in rows] == [-1.0, 0.0, 1.0] and {r.b_z for r in rows} == {None}


def test_t_tests(spark):
    # Published example: extra sleep of ten patients under two drugs.
    drug1 = [0.7, -1.6, -0.2, -1.2, -0.1, 3.4, 3.7, 0.8, 0.0, 2.0]
    drug2 = [1.9, 0.8, 1.1, 0.1, -0.1, 4.4, 5.5, 1.6, 4.6, 3.4]
    df = spark.createDataFrame([("1", v) for v in drug1] + [("2", v) for v in drug2] + [("1", None)], "g string, x double")
    t = moments.t_test_two_sample(df, "g", "x", ("1", "2")).first()
    assert (round(t.t, 4), t.df, round(t.p_value, 5)) == (-1.8608, 18, 0.07919)
    assert (round(t.ci_low, 4), round(t.ci_high, 4)) == (-3.3639, 0.2039)
    one = moments.t_test_one_sample(df.filter("g = '1'"), "x").first()
    assert (one.n, one.df, round(one.t, 4), round(one.p_value, 4)) == (10, 9, 1.3257, 0.2176)


def test_anova_and_tukey(spark):
    # Published example: plant weights of a control and two treatments.
    data = {
        "ctrl": [4.17, 5.58, 5.18, 6.11, 4.50, 4.61, 5.17, 4.53, 5.33, 5.14],
        "trt1": [4.81, 4.17, 4.41, 3.59, 5.87, 3.83, 6.03, 4.89, 4.32, 4.69],
        "trt2": [6.31, 5.12, 5.54, 5.50, 5.37, 5.29, 4.92, 6.15, 5.80, 5.26],
    }
    rows = [(g, v) for g, values in data.items() for v in values] + [("ctrl", None), (None, 5.0)]
    df = spark.createDataFrame(rows, "g string, x double")
    a = moments.anova_one_way(df, "g", "x").first()
    assert (a.df_between, a.df_within, round(a.f_value, 3), round(a.p_value, 4)) == (2, 27, 4.846, 0.0159)
    pairs = {(r.level_high, r.level_low): r for r in moments.tukey_pairs(df, "g", "x").collect()}
    assert round(pairs["trt1", "ctrl"].difference, 3) == -0.371
    assert [round(pairs[p].p_adjusted, 3) for p in (("trt1", "ctrl"), ("trt2", "ctrl"), ("trt2", "trt1"))] == [0.391, 0.198, 0.012]
    assert round(pairs["trt2", "trt1"].ci_low, 4) == pytest.approx(0.1738, abs=2e-4)


@pytest.fixture(scope="module")
def numeric():
    rng = np.random.default_rng(5)
    f = rng.normal(size=(1500, 2))
    loadings = np.array([[0.9, 0.0], [0.8, 0.1], [0.7, 0.0], [0.0, 0.85], [0.1, 0.75], [0.0, 0.65]])
    return f @ loadings.T + rng.normal(size=(1500, 6)) * np.sqrt(1 - (loadings**2).sum(axis=1))


def test_components_match_numpy(spark, numeric):
    names = [f"x{i}" for i in range(6)]
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(numeric)], "id int, " + ", ".join(f"{n} double" for n in names))
    fit = PrincipalComponents(df, names)
    values = np.sort(np.linalg.eigvalsh(np.corrcoef(numeric.T)))[::-1]
    assert np.allclose(fit.values, values)
    summary = fit.summary(spark).orderBy("component").collect()
    assert summary[-1].cumulative == pytest.approx(1.0)
    scored = pca_scores(fit, df, df.select("id"), "id").orderBy("id").collect()
    z = (numeric - numeric.mean(axis=0)) / numeric.std(axis=0, ddof=1)
    assert np.allclose([[r.pc1, r.pc2, r.pc3] for r in scored], z @ fit.loadings[:, :3])
    assert [r.log_eigenvalue for r in fit.scree(spark).orderBy("component").collect()] == pytest.approx(list(np.log(values)))


def test_factor_analysis_recovers_the_factors(spark, numeric):
    names = [f"x{i}" for i in range(6)]
    df = spark.createDataFrame([tuple(map(float, r)) for r in numeric], ", ".join(f"{n} double" for n in names))
    rows = {r.variable: r for r in factor_analysis(df, names, 2).collect()}
    assert all(0 < r.uniqueness <= 1 for r in rows.values())
    strong = "factor1" if rows["x0"].factor1 > rows["x0"].factor2 else "factor2"
    other = "factor2" if strong == "factor1" else "factor1"
    for name, size in (("x0", 0.9), ("x1", 0.8), ("x2", 0.7)):
        assert rows[name][strong] == pytest.approx(size, abs=0.1) and abs(rows[name][other]) < 0.2
    assert rows["x3"][other] == pytest.approx(0.85, abs=0.1)
    assert rows["x0"].df == 4 and rows["x0"].p_value > 0.001
    with pytest.raises(ValueError):
        factor_analysis(df.select("x0", "x1", "x2"), ["x0", "x1", "x2"], 2)


@pytest.mark.parametrize("seed", range(20))
def test_factor_fit_reaches_a_zero_gradient(seed):
    rng = np.random.default_rng(seed)
    rows = rng.normal(size=(300, 2)) @ rng.normal(size=(2, 5)) + rng.normal(size=(300, 5))
    matrix = np.corrcoef((rows if seed % 3 else rng.normal(size=(300, 5))).T)
    uniqueness, loadings = components._maximum_likelihood(matrix, 2)
    residual = ((loadings**2).sum(axis=1) + uniqueness - 1) / uniqueness
    for u, g in zip(uniqueness, residual):  # on a bound the gradient may push outwards
        assert abs(g) < 1e-6 or (u < 0.005 + 1e-9 and g > 0) or (u > 1 - 1e-9 and g < 0)


def test_factor_fit_says_when_it_did_not_converge():
    matrix = np.array([[1.0, 0.5, 0.4], [0.5, 1.0, 0.3], [0.4, 0.3, 1.0]])
    with pytest.raises(ValueError, match="did not converge"):
        components._maximum_likelihood(matrix, 1, rounds=1)
    uniqueness, _ = components._maximum_likelihood(matrix, 1)
    assert uniqueness == pytest.approx([1 - 0.5 * 0.4 / 0.3, 1 - 0.5 * 0.3 / 0.4, 1 - 0.4 * 0.3 / 0.5], abs=1e-7)


# ---- classifiers -----------------------------------------------------------


@pytest.fixture(scope="module")
def points():
    rng = np.random.default_rng(2)
    y = rng.choice([0, 1, 2], 300, p=[0.6, 0.3, 0.1])
    x = rng.normal(size=(300, 3)) * (1 + y[:, None] * 0.5) + y[:, None] * 1.5
    return x, y


def points_frame(spark, points):
    x, y = points
    return spark.createDataFrame(
        [(i, int(c), [float(v) for v in r], *map(float, r)) for i, (r, c) in enumerate(zip(x, y))],
        "id int, y int, features array<double>, x0 double, x1 double, x2 double",
    )


def test_stratified_split_sizes(spark, points):
    split = classify.stratified_split(points_frame(spark, points), "y", "id", 0.8, 1)
    counts = {(r.y, r.part): r["count"] for r in split.groupBy("y", "part").count().collect()}
    for c in (0, 1, 2):
        n = int((points[1] == c).sum())
        assert counts[c, "train"] == math.ceil(0.8 * n) and counts.get((c, "test"), 0) == n - math.ceil(0.8 * n)


def test_split_of_a_single_member(spark):
    split = classify.stratified_split(spark.createDataFrame([(1, "x")], "id int, y string"), "y", "id")
    assert split.first().part == "train"


def test_folds_are_balanced(spark, points):
    folds = classify.repeated_folds(points_frame(spark, points), "y", "id", folds=5, repeats=3)
    sizes = folds.groupBy("repeat", "y", "fold").count().groupBy("repeat", "y").agg(F.max("count") - F.min("count"))
    assert all(r[2] <= 1 for r in sizes.collect())
    assert folds.count() == 900


@pytest.mark.parametrize("block,pivots", [(20_000, 8), (17, 5), (40, 64)])
def test_neighbours_match_brute_force(spark, points, block, pivots):
    x, y = points
    df = points_frame(spark, points)
    train, test = df.filter("id >= 60"), df.filter("id < 60")
    found = classify.nearest_neighbours(test, train, "features", "id", "y", 5, pivots=pivots, block=block)
    got = {}
    for r in found.orderBy("id", "rank").collect():
        got.setdefault(r.id, []).append(r.neighbour)
    for i in range(60):
        distance = np.sqrt(((x[60:] - x[i]) ** 2).sum(axis=1))
        assert got[i] == [int(j) + 60 for j in np.lexsort((np.arange(240), distance))[:5]]


def test_neighbours_skip_their_own_fold(spark, points):
    x, _ = points
    df = points_frame(spark, points).withColumn("fold", F.col("id") % 3)
    found = classify.nearest_neighbours(df, df, "features", "id", "y", 4, fold="fold", pivots=6, block=50)
    got = {}
    for r in found.orderBy("id", "rank").collect():
        got.setdefault(r.id, []).append(r.neighbour)
    for i in range(300):
        others = np.array([j for j in range(300) if j % 3 != i % 3])
        distance = np.sqrt(((x[others] - x[i]) ** 2).sum(axis=1))
        assert got[i] == others[np.lexsort((others, distance))[:4]].tolist()


def test_fewer_training_rows_than_k(spark, points):
    df = points_frame(spark, points)
    found = classify.nearest_neighbours(df.filter("id = 0"), df.filter("id in (1, 2)"), "features", "id", "y", 5)
    assert found.count() == 2


def brute_discriminant(x, y, at, quadratic):
    classes = np.unique(y)
    pooled = sum((x[y == c] - x[y == c].mean(0)).T @ (x[y == c] - x[y == c].mean(0)) for c in classes) / (len(y) - len(classes))
    scores = []
    for c in classes:
        s = np.cov(x[y == c].T) if quadratic else pooled
        d = at - x[y == c].mean(0)
        score = -0.5 * np.einsum("ni,ij,nj->n", d, np.linalg.inv(s), d) + np.log((y == c).mean())
        scores.append(score - (0.5 * np.linalg.slogdet(s)[1] if quadratic else 0))
    return classes[np.argmax(scores, axis=0)]


@pytest.mark.parametrize("quadratic", [False, True])
def test_discriminants_match_numpy(spark, points, quadratic):
    x, y = points
    df, names = points_frame(spark, points), ["x0", "x1", "x2"]
    out = classify.discriminant_predict(df.filter("id >= 60"), df.filter("id < 60"), names, "y", quadratic)
    got = [r.predicted for r in out.orderBy("id").collect()]
    assert got == brute_discriminant(x[60:], y[60:], x[:60], quadratic).tolist()

    folded = df.withColumn("repeat", F.lit(1)).withColumn("fold", F.col("id") % 4)
    cv = {r.id: r.predicted for r in classify.discriminant_cv(folded, names, "y", quadratic).collect()}
    fold = np.arange(300) % 4
    for f in range(4):
        expected = brute_discriminant(x[fold != f], y[fold != f], x[fold == f], quadratic)
        assert [cv[i] for i in np.flatnonzero(fold == f)] == expected.tolist()


def test_tree_learns(spark, points):
    df = points_frame(spark, points).withColumn("y", F.when(F.col("x0") > 1, "hi").otherwise("lo"))
    out = classify.tree_predict(df, df, "features", "y", max_depth=2)
    assert out.filter("y = predicted").count() == 300


def test_knn_vote_ties_go_to_the_smaller_label(spark):
    rows = [(1, 10, "b", 0.1, 1), (1, 11, "a", 0.2, 2), (1, 12, "b", 0.3, 3)]
    found = spark.createDataFrame(rows, "id int, neighbour int, neighbour_label string, distance double, rank int")
    votes = {r.k: r.predicted for r in classify.knn_vote(found, "id", [1, 2, 3]).collect()}
    assert votes == {1: "b", 2: "a", 3: "b"}


def test_confusion(spark):
    rows = [("a", "a")] * 5 + [("a", "b")] * 2 + [("b", "b")] * 3 + [("b", "c")] + [(None, "a")]
    df = spark.createDataFrame(rows, "p string, o string")
    row = metrics.accuracy_kappa(df, "p", "o").first()
    chance = (7 * 5 + 4 * 5) / 121
    assert row.accuracy == pytest.approx(8 / 11) and row.kappa == pytest.approx((8 / 11 - chance) / (1 - chance))
    stats = {r["class"]: r for r in metrics.confusion_stats(df, "p", "o").collect()}
    assert stats["c"].positive_predictive is None and stats["c"].sensitivity == 0.0
    assert stats["a"].sensitivity == 1.0 and stats["a"].specificity == pytest.approx(4 / 6)


def test_confusion_overall(spark):
    # Worked by hand: two surveys of the same people, 794 and 150 against 86 and 570.
    cells = {("yes", "yes"): 794, ("yes", "no"): 150, ("no", "yes"): 86, ("no", "no"): 570}
    rows = [pair for pair, n in cells.items() for _ in range(n)]
    row = metrics.confusion_overall(spark.createDataFrame(rows, "p string, o string"), "p", "o").first()
    assert (row.n, row.accuracy, row.mcnemar_df) == (1600, 1364 / 1600, 1)
    assert round(row.mcnemar, 3) == round((150 - 86 - 1) ** 2 / (150 + 86), 3) and row.mcnemar_p == pytest.approx(math.erfc(math.sqrt(row.mcnemar / 2)), rel=1e-9)
    # The exact limits of 7 of 20.
    rows = [("a", "a")] * 7 + [("b", "a")] * 13
    row = metrics.confusion_overall(spark.createDataFrame(rows, "p string, o string"), "p", "o").first()
    assert (round(row.ci_low, 4), round(row.ci_high, 4), row.p_above_rate) == (0.1539, 0.5922, pytest.approx(1.0))
    perfect = metrics.confusion_overall(spark.createDataFrame([("a", "a"), ("b", "b")], "p string, o string"), "p", "o").first()
    assert perfect.ci_high == 1.0 and perfect.mcnemar is None and perfect.p_above_rate == pytest.approx(0.25)
    assert metrics.confusion_overall(spark.createDataFrame([], "p string, o string"), "p", "o").count() == 0


def test_cv_summary_and_compare(spark):
    rows = [(m, 1, f, "accuracy", v) for m, vs in {"x": [0.5, 0.6, 0.7], "y": [0.4, 0.6, 0.5]}.items() for f, v in enumerate(vs)]
    df = spark.createDataFrame(rows, "model string, repeat int, fold int, metric string, value double")
    diff = metrics.cv_compare(df).first()
    assert (diff.model_a, diff.model_b) == ("x", "y") and diff.mean_difference == pytest.approx(0.1)
    assert diff.t == pytest.approx(0.1 / (0.1 / math.sqrt(3)))
    assert {r.model: r.median for r in metrics.cv_summary(df).collect()} == {"x": 0.6, "y": 0.5}


def test_cv_intervals_against_published_quantiles(spark):
    values = {"x": [0.5, 0.6, 0.7, 0.9, 0.8], "y": [0.4, 0.6, 0.5, 0.7, 0.9], "z": [0.1, 0.3, 0.2, 0.4, 0.6]}
    rows = [(m, 1, f, "accuracy", v) for m, vs in values.items() for f, v in enumerate(vs)]
    rows += [(m, 1, f, "kappa", v) for m, v in (("x", 0.5), ("y", 0.5)) for f in range(3)] + [("x", 1, 3, "kappa", None), ("y", 1, 3, "kappa", 0.1)]
    df = spark.createDataFrame(rows, "model string, repeat int, fold int, metric string, value double")
    got = {(r.metric, r.model_a, r.model_b): r for r in metrics.cv_compare(df).collect()}
    pairs = [("x", "y"), ("x", "z"), ("y", "z")]
    p = {}
    for a, b in pairs:
        r, d = got["accuracy", a, b], np.array(values[a]) - np.array(values[b])
        error = d.std(ddof=1) / math.sqrt(5)
        # Tables of t with 4 degrees: 2.776445 leaves 5 % on both sides, 3.961 a third of that.
        assert (r.ci_low, r.ci_high) == (pytest.approx(d.mean() - 2.776445 * error, abs=1e-6), pytest.approx(d.mean() + 2.776445 * error, abs=1e-6))
        assert r.joint_high - r.mean_difference == pytest.approx(3.9608 * error, rel=1e-3)
        assert r.p_bonferroni == pytest.approx(min(1.0, 3 * r.p_value))
        assert (r.p_value < 0.05) == (r.ci_low > 0 or r.ci_high < 0)
        p[a, b] = r.p_value
    top = 0.0
    for k, pair in enumerate(sorted(p, key=p.get)):
        top = max(top, min(1.0, (3 - k) * p[pair]))
        assert got["accuracy", *pair].p_holm == pytest.approx(top)
    same = got["kappa", "x", "y"]
    assert (same.folds, same.t, same.p_value, same.p_holm, same.p_bonferroni) == (3, None, None, None, None)
    assert (same.ci_low, same.ci_high) == (0.0, 0.0)
    assert metrics.cv_compare(df.limit(0)).count() == 0
    one = metrics.cv_compare(df.filter("fold = 0 AND metric = 'accuracy'")).first()
    assert (one.folds, one.ci_low, one.p_value, one.p_holm) == (1, None, None, None)


def test_step_down_of_published_p_values(spark):
    df = spark.createDataFrame([(1, 0.01), (2, 0.04), (3, 0.03), (4, 0.005), (5, None)], "id int, p double")
    got = {r.id: r.p_holm for r in metrics.adjusted_pvalues(df, "p", ["id"]).collect()}
    assert got == {1: pytest.approx(0.03), 2: pytest.approx(0.06), 3: pytest.approx(0.06), 4: pytest.approx(0.02), 5: None}


def test_factor_encode(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, "c")], "id int, g string")
    got = {r.id: (r.g_index, list(r.g_dummies)) for r in classify.factor_encode(df, ["g"]).collect()}
    assert got == {1: (1, [0.0, 1.0]), 2: (0, [1.0, 0.0]), 3: (2, [0.0, 0.0])}


EXTREMES = [
    [1.0, 2.0, 3.0, math.inf], [1.0, 2.0, 3.0, math.nan], [-1.7e308, 1.0, 2.0, 1.7e308], [-math.inf, -5e-324, 0.0, 5e-324, math.inf],
    [s * 10.0**e for e in range(-300, 301, 7) for s in (1, -1)], [math.nan, None], [math.inf, math.inf, -math.inf], [1.0 + i * 2**-52 for i in range(9)],
]


def test_order_statistics_end_on_every_double(spark, monkeypatch):
    passes = []
    narrow = order_stats._narrow
    monkeypatch.setattr(order_stats, "_narrow", lambda *a, exact: passes.append(1) or narrow(*a, exact=exact))
    rows = [(i, x) for i, values in enumerate(EXTREMES) for x in values]
    ranks = {"first": F.lit(1), "second": F.least(F.lit(2), F.col("n")), "middle": F.floor((F.col("n") + 1) / 2), "last": F.col("n")}
    found = order_stats.order_statistics(spark.createDataFrame(rows, "g int, x double"), ["g"], "x", ranks)
    got = {r.g: (r.first, r.second, r.middle, r.last) for r in found.collect()}
    for i, values in enumerate(EXTREMES):
        v = sorted(x for x in values if x is not None and not math.isnan(x))
        if v:
            assert got.pop(i) == (v[0], v[min(1, len(v) - 1)], v[(len(v) + 1) // 2 - 1], v[-1])
    assert not got and len(passes) == 1  # after the sketch


def test_a_sketch_out_of_bounds_changes_nothing(spark, sample, monkeypatch):
    """Brackets that miss their ranks cost more scans, not the result."""
    g, x = sample
    bracket = order_stats._bracket

    def wrong(rank, n, sketch, lowest, highest, grid):
        return bracket(f"least({rank} + {n} / 3, {n})", n, sketch, lowest, highest, grid)

    monkeypatch.setattr(order_stats, "_bracket", wrong)
    ranks = {"first": F.lit(1), "middle": F.floor((F.col("n") + 1) / 2), "last": F.col("n")}
    for r in order_stats.order_statistics(frame(spark, [g, x], "g string, x double"), ["g"], "x", ranks).collect():
        values = np.sort(x[g == r.g])
        assert (r.first, r.middle, r.last) == (values[0], values[(len(values) + 1) // 2 - 1], values[-1])


def test_three_scans_at_most(spark, monkeypatch):
    """Many rows of one group: a sketch, a sketch inside the brackets, the counts."""
    kinds = []
    narrow = order_stats._narrow
    monkeypatch.setattr(order_stats, "_narrow", lambda *a, exact: kinds.append(exact) or narrow(*a, exact=exact))
    df = spark.range(300_000).select(F.lit(1).alias("g"), F.xxhash64("id").cast("double").alias("x"))
    ranks = {"q1": F.lit(75_000), "q2": F.lit(150_000), "q2b": F.lit(150_001), "last": F.col("n")}
    for piece_rows, wanted in ((1_000_000, [True]), (1_000, [False, True])):
        got = order_stats.order_statistics(df, ["g"], "x", ranks, piece_rows=piece_rows).first()
        assert kinds == wanted
        kinds.clear()
    values = np.sort([r.x for r in df.collect()])
    assert (got.q1, got.q2, got.q2b, got.last) == (values[74_999], values[149_999], values[150_000], values[-1])


def test_summary_with_nan_and_infinity(spark):
    df = spark.createDataFrame([(1.0, math.nan), (2.0, math.inf), (math.inf, None), (4.0, 3.0)], "a double, b double")
    got = {r["column"]: r for r in order_stats.column_summary(df, ["a", "b"]).collect()}
    assert (got["a"]["min"], got["a"]["max"], got["a"].missing, got["b"].missing) == (1.0, math.inf, 0, 2)


def test_missing_features_have_no_prediction(spark):
    rng = np.random.default_rng(1)
    rows = [(i, float(rng.normal(i % 2 * 4)), float(rng.normal()), "ab"[i % 2]) for i in range(60)]
    train = spark.createDataFrame(rows, "id long, x1 double, x2 double, y string")
    asked = spark.createDataFrame([(100, None, 1.0), (101, math.nan, 1.0), (102, 0.0, 0.0)], "id long, x1 double, x2 double")
    for quadratic in (False, True):
        got = {r.id: r.predicted for r in classify.discriminant_predict(train, asked, ["x1", "x2"], "y", quadratic).collect()}
        assert got == {100: None, 101: None, 102: "a"}
    vector = F.when(F.col("id") != 100, F.array("x1", "x2"))
    found = classify.knn_classify(train.withColumn("v", F.when(F.col("id") > 3, F.array("x1", "x2"))), asked.withColumn("v", vector).withColumn("y", F.lit(None).cast("string")), "v", "id", "y", k=3)
    assert {r.id: r.predicted for r in found.collect()} == {100: None, 101: None, 102: "a"}
