"""Statistics and classification over lines, orders, labels and embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings import query, table
from cohortloom.operators import classify, discriminants, metrics, moments, order_stats, pruned_tree
from cohortloom.operators.components import PrincipalComponents, factor_analysis, pca_scores
from cohortloom.plans.applicants import compare_models
from cohortloom.session import freeze, saved

_FOUR = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _rounded(df, columns, places=6):
    return df.withColumns({c: F.round(c, places) for c in columns})


@query(
    "group_zstat",
    """SELECT l_suppkey, count(*) AS n, round(avg(l_extendedprice), 6) AS mean,
              round((avg(l_extendedprice) - 38000) / (23000 / sqrt(count(*))), 6) AS z FROM lineitem GROUP BY 1""",
)
def group_zstat(spark, sf):
    z = moments.group_zstat(table(spark, sf, "lineitem"), "l_suppkey", "l_extendedprice", 38000.0, 23000.0)
    return _rounded(z, ["mean", "z"])


@query(
    "density_histogram",
    """WITH r AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi, count(*) AS n FROM orders),
       c AS (SELECT *, (hi - lo) / ceil(log2(n) + 1) AS cell FROM r),
       u AS (SELECT *, power(10.0, floor(log10(cell))) AS p FROM c),
       w AS (SELECT *, CASE WHEN 2 * p - cell >= 1.5 * (cell - p) THEN p WHEN 5 * p - cell >= 2.75 * (cell - 2 * p) THEN 2 * p
                            WHEN 10 * p - cell >= 1.5 * (cell - 5 * p) THEN 5 * p ELSE 10 * p END AS step FROM u),
       b AS (SELECT *, floor(lo / step + 1e-10) * step AS start FROM w)
       SELECT bin, start + bin * step AS bin_left, start + (bin + 1) * step AS bin_right, count(*) AS count,
              round(count(*) / (any_value(n) * any_value(step)), 12) AS density
       FROM (SELECT CAST(greatest(ceil((o_totalprice - start) / step) - 1, 0) AS BIGINT) AS bin, start, step, n FROM orders, b)
       GROUP BY bin, start, step""",
)
def density_histogram(spark, sf):
    return _rounded(moments.density_histogram(table(spark, sf, "orders"), "o_totalprice"), ["density"], 12)


def _column_summary_sql(columns):
    parts = []
    for c in columns:
        v = "nullif(l_discount, 0)" if c == "l_discount" else c
        parts.append(
            f"""SELECT '{c}' AS "column", min({v}) AS min, round(quantile_cont({v}, 0.25), 6) AS q1, round(quantile_cont({v}, 0.5), 6) AS median,
                round(avg({v}), 6) AS mean, round(quantile_cont({v}, 0.75), 6) AS q3, max({v}) AS max, count(*) - count({v}) AS missing FROM lineitem"""
        )
    return " UNION ALL ".join(parts)


@query("column_summary", _column_summary_sql(_FOUR))
def column_summary(spark, sf):
    lines = table(spark, sf, "lineitem").withColumn("l_discount", F.nullif("l_discount", F.lit(0.0)))
    return _rounded(order_stats.column_summary(lines, _FOUR), ["q1", "median", "mean", "q3"])


@query(
    "box_summary",
    """WITH r AS (SELECT o_orderpriority AS g, o_totalprice AS x, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice) AS i,
                         count(*) OVER (PARTITION BY o_orderpriority) AS n FROM orders),
       d AS (SELECT *, floor((n + 3) / 2) / 2 AS depth FROM r),
       h AS (SELECT g, n, avg(x) FILTER (i = floor(depth) OR i = ceil(depth)) AS lh, avg(x) FILTER (i = floor((n + 1) / 2) OR i = ceil((n + 1) / 2)) AS med,
                    avg(x) FILTER (i = floor(n + 1 - depth) OR i = ceil(n + 1 - depth)) AS uh FROM d GROUP BY g, n)
       SELECT h.g AS o_orderpriority, h.n, min(x) FILTER (x >= lh - 1.5 * (uh - lh)) AS lower_whisker, round(any_value(lh), 4) AS lower_hinge,
              round(any_value(med), 4) AS median, round(any_value(uh), 4) AS upper_hinge, max(x) FILTER (x <= uh + 1.5 * (uh - lh)) AS upper_whisker,
              round(any_value(med - 1.58 * (uh - lh) / sqrt(h.n)), 4) AS notch_low, round(any_value(med + 1.58 * (uh - lh) / sqrt(h.n)), 4) AS notch_high,
              count(*) FILTER (x < lh - 1.5 * (uh - lh) OR x > uh + 1.5 * (uh - lh)) AS outliers
       FROM r JOIN h ON r.g = h.g GROUP BY h.g, h.n""",
)
def box_summary(spark, sf):
    box = order_stats.box_summary(table(spark, sf, "orders"), "o_orderpriority", "o_totalprice")
    return _rounded(box, ["lower_hinge", "median", "upper_hinge", "notch_low", "notch_high"], 4)


@query(
    "correlation_matrix",
    " UNION ALL ".join(f"SELECT '{a}' AS var1, '{b}' AS var2, round(corr({a}, {b}), 6) AS r FROM lineitem" for a in _FOUR for b in _FOUR),
)
def correlation_matrix(spark, sf):
    return _rounded(moments.correlation_matrix(table(spark, sf, "lineitem"), _FOUR), ["r"])


@query(
    "standardise",
    """SELECT o_orderkey, round((o_totalprice - (SELECT avg(o_totalprice) FROM orders)) / (SELECT stddev_samp(o_totalprice) FROM orders), 6) AS price_z,
              CAST(NULL AS DOUBLE) AS constant_z FROM orders""",
)
def standardise(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_totalprice").alias("price"), F.lit(1.0).alias("constant"))
    return _rounded(moments.standardise(orders, ["price", "constant"]), ["price_z", "constant_z"]).drop("price", "constant")


# ---- components ------------------------------------------------------------

_PAIR = ["l_quantity", "l_extendedprice"]
_EIGEN = """WITH c AS (SELECT corr(l_quantity, l_extendedprice) AS r FROM lineitem),
       e AS (SELECT 1 AS component, 1 + abs(r) AS eigenvalue, sign(r) AS s FROM c UNION ALL SELECT 2, 1 - abs(r), -sign(r) FROM c)"""


@query(
    "pca_fit",
    f"""{_EIGEN} SELECT component, round(sqrt(eigenvalue), 6) AS sdev, round(eigenvalue, 6) AS eigenvalue, round(eigenvalue / 2, 6) AS proportion,
               round(CASE component WHEN 1 THEN eigenvalue / 2 ELSE 1 END, 6) AS cumulative, round(1 / sqrt(2.0), 6) AS loading_l_quantity,
               round(s / sqrt(2.0), 6) AS loading_l_extendedprice FROM e""",
)
def pca_fit(spark, sf):
    summary = PrincipalComponents(table(spark, sf, "lineitem"), _PAIR).summary(spark)
    return _rounded(summary, [c for c in summary.columns if c != "component"])


@query(
    "pca_scree",
    f"{_EIGEN} SELECT component, round(eigenvalue, 6) AS eigenvalue, round(ln(eigenvalue), 6) AS log_eigenvalue FROM e",
)
def pca_scree(spark, sf):
    return _rounded(PrincipalComponents(table(spark, sf, "lineitem"), _PAIR).scree(spark), ["eigenvalue", "log_eigenvalue"])


@query(
    "pca_scores",
    """WITH x AS (SELECT o_orderkey AS id, o_totalprice AS a, CAST(o_custkey AS DOUBLE) AS b FROM orders),
       m AS (SELECT avg(a) AS ma, avg(b) AS mb, stddev_samp(a) AS sa, stddev_samp(b) AS sb, sign(corr(a, b)) AS s FROM x),
       z AS (SELECT id, (a - ma) / sa AS za, (b - mb) / sb AS zb, s FROM x, m)
       SELECT id, o_orderstatus, round((za + s * zb) / sqrt(2.0), 5) AS pc1, round((za - s * zb) / sqrt(2.0), 5) AS pc2
       FROM z JOIN orders ON o_orderkey = id""",
)
def pca_scores_query(spark, sf):
    orders = table(spark, sf, "orders")
    numeric = orders.select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("a"), F.col("o_custkey").cast("double").alias("b"))
    other = orders.select(F.col("o_orderkey").alias("id"), "o_orderstatus")
    return _rounded(pca_scores(PrincipalComponents(numeric, ["a", "b"]), numeric, other, "id"), ["pc1", "pc2"], 5)


@query("factor_analysis")
def factor_analysis_query(spark, sf):
    lines = table(spark, sf, "lineitem").select(*_FOUR, F.col("l_linenumber").cast("double").alias("l_linenumber"))
    return factor_analysis(lines, lines.columns, 2)


@query(
    "factor_analysis_one",
    """
    WITH m AS (SELECT l_quantity + 300 * l_discount AS a, l_quantity + 5 * l_linenumber AS b, l_quantity + 400 * l_tax AS c FROM lineitem),
    r AS (SELECT corr(a, b) AS ab, corr(a, c) AS ac, corr(b, c) AS bc FROM m),
    shared AS (
        SELECT 'a' AS variable, ab * ac / bc AS h FROM r
        UNION ALL SELECT 'b', ab * bc / ac FROM r
        UNION ALL SELECT 'c', ac * bc / ab FROM r)
    SELECT variable, round(1 - h, 5) AS uniqueness, round(sqrt(h), 5) AS factor1, 0 AS df FROM shared
    """,
)
def factor_analysis_one(spark, sf):
    """One factor of three measures that share the quantity; three variables have a closed form."""
    line = {k: F.col(k).cast("double") for k in ("l_quantity", "l_discount", "l_linenumber", "l_tax")}
    measures = table(spark, sf, "lineitem").select(
        (line["l_quantity"] + 300 * line["l_discount"]).alias("a"),
        (line["l_quantity"] + 5 * line["l_linenumber"]).alias("b"),
        (line["l_quantity"] + 400 * line["l_tax"]).alias("c"),
    )
    return _rounded(factor_analysis(measures, ["a", "b", "c"], 1), ["uniqueness", "factor1"], 5).select("variable", "uniqueness", "factor1", "df")


# ---- tests of means --------------------------------------------------------


def _simpson(density, upper, steps=2000):
    """The integral of a density of u from 0 to ``upper``, in SQL."""
    weight = f"CASE WHEN i = 0 OR i = {steps} THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END"
    return f"list_sum(list_transform(range(0, {steps + 1}), lambda i: {weight} * ({density.replace('u', f'(i * {upper} / {steps})')}))) * {upper} / {3 * steps}"


def _t_pvalue_sql(t, df):
    """Two-sided; the density beyond 40 is nothing at the degrees of freedom of these tables."""
    scale = f"exp(lgamma(({df} + 1) / 2) - lgamma({df} / 2)) / sqrt({df} * pi())"
    return f"round(1 - 2 * {scale} * {_simpson(f'pow(1 + u * u / {df}, -({df} + 1) / 2)', f'least(abs({t}), 40.0)')}, 6)"


def _t_quantile_sql(df, z=1.959963984540054):
    """The 97.5 % point by its series in 1 / df around the normal one, good to 1e-8 from about 100 degrees of freedom on."""
    terms = [z, (z**3 + z) / 4, (5 * z**5 + 16 * z**3 + 3 * z) / 96, (3 * z**7 + 19 * z**5 + 17 * z**3 - 15 * z) / 384,
             (79 * z**9 + 776 * z**7 + 1482 * z**5 - 1920 * z**3 - 945 * z) / 92160]
    return "(" + " + ".join(f"{c!r} / pow({df}, {k})" for k, c in enumerate(terms)) + ")"


@query(
    "t_test_two_sample",
    f"""WITH m AS (SELECT o_orderstatus AS g, count(*) AS n, avg(o_totalprice) AS a, var_samp(o_totalprice) AS v FROM orders
                  WHERE o_orderstatus IN ('F', 'O') GROUP BY 1),
       p AS (SELECT x.a AS m1, y.a AS m2, x.n + y.n - 2 AS df,
                    sqrt(((x.n - 1) * x.v + (y.n - 1) * y.v) / (x.n + y.n - 2) * (1 / x.n + 1 / y.n)) AS se
             FROM m x JOIN m y ON x.g = 'F' AND y.g = 'O')
       SELECT round(m1, 4) AS mean1, round(m2, 4) AS mean2, round(m1 - m2, 4) AS difference, df, round(se, 4) AS std_error,
              round((m1 - m2) / se, 6) AS t, {_t_pvalue_sql('((m1 - m2) / se)', 'df')} AS p_value,
              round(m1 - m2 - {_t_quantile_sql('df')} * se, 3) AS ci_low, round(m1 - m2 + {_t_quantile_sql('df')} * se, 3) AS ci_high FROM p""",
)
def t_test_two_sample(spark, sf):
    test = moments.t_test_two_sample(table(spark, sf, "orders"), "o_orderstatus", "o_totalprice", ("F", "O"))
    return _rounded(_rounded(_rounded(test, ["mean1", "mean2", "difference", "std_error"], 4), ["t", "p_value"]), ["ci_low", "ci_high"], 3)


@query(
    "t_test_one_sample",
    f"""WITH m AS (SELECT count(*) AS n, avg(c_acctbal) AS a, count(*) - 1 AS df, stddev_samp(c_acctbal) / sqrt(count(*)) AS se FROM customer)
       SELECT n, round(a, 4) AS mean, round(a, 4) AS difference, df, round(se, 6) AS std_error, round(a / se, 6) AS t, {_t_pvalue_sql('(a / se)', 'df')} AS p_value,
              round(a - {_t_quantile_sql('df')} * se, 4) AS ci_low, round(a + {_t_quantile_sql('df')} * se, 4) AS ci_high FROM m""",
)
def t_test_one_sample(spark, sf):
    test = _rounded(moments.t_test_one_sample(table(spark, sf, "customer"), "c_acctbal"), ["mean", "difference", "ci_low", "ci_high"], 4)
    return _rounded(test, ["std_error", "t", "p_value"])


_GROUPS = """WITH m AS (SELECT o_orderpriority AS g, count(*) AS n, avg(o_totalprice) AS a, var_samp(o_totalprice) AS v FROM orders GROUP BY 1),
       s AS (SELECT sum(n * pow(a - (SELECT avg(o_totalprice) FROM orders), 2)) AS ssb, sum((n - 1) * v) AS ssw,
                    count(*) - 1 AS dfb, CAST(sum(n) - count(*) AS BIGINT) AS dfw FROM m)"""


@query(
    "anova_one_way",
    f"""{_GROUPS} SELECT round(ssb / 1e9, 4) AS ss_between, round(ssw / 1e9, 4) AS ss_within, dfb AS df_between, dfw AS df_within,
               round(ssb / dfb / 1e9, 4) AS ms_between, round(ssw / dfw / 1e9, 4) AS ms_within, round((ssb / dfb) / (ssw / dfw), 6) AS f_value,
               round(pow(ssw / (ssw + ssb), dfw / 2) * (1 + dfw / 2 * ssb / (ssw + ssb)), 6) AS p_value FROM s""",
)
def anova_one_way(spark, sf):
    """Squares in billions.  With five groups the upper tail has a closed form."""
    row = moments.anova_one_way(table(spark, sf, "orders"), "o_orderpriority", "o_totalprice")
    squares = {c: F.round(F.col(c) / 1e9, 4) for c in ("ss_between", "ss_within", "ms_between", "ms_within")}
    return _rounded(row.withColumns(squares), ["f_value", "p_value"])


@query(
    "tukey_pairs",
    f"""{_GROUPS} SELECT x.g AS level_high, y.g AS level_low, round(x.a - y.a, 4) AS difference,
               round(sqrt(ssw / dfw / 2 * (1 / x.n + 1 / y.n)), 4) AS std_error,
               round(abs(x.a - y.a) / sqrt(ssw / dfw / 2 * (1 / x.n + 1 / y.n)), 6) AS q FROM m x JOIN m y ON x.g > y.g, s""",
)
def tukey_pairs(spark, sf):
    pairs = moments.tukey_pairs(table(spark, sf, "orders"), "o_orderpriority", "o_totalprice")
    return _rounded(_rounded(pairs, ["difference", "std_error"], 4), ["q"]).drop("p_adjusted", "ci_low", "ci_high")


# ---- factors, splits, folds ------------------------------------------------


@query(
    "factor_encode",
    """SELECT o_orderkey, CAST(CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS INTEGER) AS status_index,
              CAST(left(o_orderpriority, 1) AS INTEGER) - 1 AS priority_index,
              CASE o_orderstatus WHEN 'F' THEN '1.0/0.0' WHEN 'O' THEN '0.0/1.0' ELSE '0.0/0.0' END AS status_dummies FROM orders""",
)
def factor_encode(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority")
    )
    encoded = classify.factor_encode(orders, ["status", "priority"])
    return encoded.select(
        "o_orderkey", "status_index", "priority_index",
        F.array_join(F.transform("status_dummies", lambda d: d.cast("string")), "/").alias("status_dummies"),
    )


@query(
    "stratified_split",
    """SELECT o_orderkey, o_orderstatus, CASE WHEN row_number() OVER (PARTITION BY o_orderstatus ORDER BY md5('1|' || o_orderkey), o_orderkey)
              <= ceil(0.8 * count(*) OVER (PARTITION BY o_orderstatus)) THEN 'train' ELSE 'test' END AS part FROM orders""",
)
def stratified_split(spark, sf):
    return classify.stratified_split(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), "o_orderstatus", "o_orderkey")


@query(
    "repeated_cv",
    """SELECT doc_id, quality, repeat, CAST((row_number() OVER (PARTITION BY repeat, quality ORDER BY md5('1|' || repeat || '|' || doc_id), doc_id) - 1)
              % 10 AS INTEGER) AS fold FROM labels, (SELECT CAST(unnest(range(1, 31)) AS INTEGER) AS repeat)""",
)
def repeated_cv(spark, sf):
    return classify.repeated_folds(table(spark, sf, "labels").select("doc_id", "quality"), "quality", "doc_id", folds=10, repeats=30)


# ---- classifiers -----------------------------------------------------------

_PARTS = """v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e, embedding[1]::DOUBLE AS x1, embedding[2]::DOUBLE AS x2,
         row_number() OVER (PARTITION BY label ORDER BY md5('1|' || vec_id), vec_id) <= ceil(0.8 * count(*) OVER (PARTITION BY label)) AS is_train FROM embeddings),
       tr AS (SELECT * FROM v WHERE is_train), te AS (SELECT * FROM v WHERE NOT is_train)"""


def _split_vectors(spark, sf):
    vectors = table(spark, sf, "embeddings").select(
        "vec_id", "label", "embedding", F.get("embedding", 0).cast("double").alias("x1"), F.get("embedding", 1).cast("double").alias("x2")
    )
    parts = saved(classify.stratified_split(vectors, "label", "vec_id"))
    return parts.filter(F.col("part") == "train"), parts.filter(F.col("part") == "test")


@query(
    "knn_classify",
    f"""WITH {_PARTS}, d AS (SELECT te.vec_id, te.label, tr.label AS near, row_number() OVER (PARTITION BY te.vec_id
                    ORDER BY list_distance(te.e, tr.e), tr.vec_id) AS r FROM te, tr),
       c AS (SELECT vec_id, label, near, count(*) AS votes FROM d WHERE r <= 5 GROUP BY ALL)
       SELECT vec_id, label, near AS predicted FROM c QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY votes DESC, near) = 1""",
)
def knn_classify(spark, sf):
    train, test = _split_vectors(spark, sf)
    return classify.knn_classify(train, test, "embedding", "vec_id", "label", k=5, pivots=16).select("vec_id", "label", "predicted")


_CLASS = """m AS (SELECT label, count(*) AS n, avg(x1) AS m1, avg(x2) AS m2, var_samp(x1) AS v11, covar_samp(x1, x2) AS v12, var_samp(x2) AS v22 FROM tr GROUP BY 1)"""


@query(
    "lda_classify",
    f"""WITH {_PARTS}, {_CLASS},
       w AS (SELECT sum((n - 1) * v11) / (sum(n) - count(*)) AS a, sum((n - 1) * v12) / (sum(n) - count(*)) AS b,
                    sum((n - 1) * v22) / (sum(n) - count(*)) AS c, sum(n) AS total FROM m)
       SELECT vec_id, te.label, m.label AS predicted FROM te, m, w
       QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY ln(n / total)
         - 0.5 * (c * (x1 - m1) ** 2 - 2 * b * (x1 - m1) * (x2 - m2) + a * (x2 - m2) ** 2) / (a * c - b * b) DESC) = 1""",
)
def lda_classify(spark, sf):
    train, test = _split_vectors(spark, sf)
    return classify.discriminant_predict(train, test, ["x1", "x2"], "label").select("vec_id", "label", "predicted")


@query(
    "qda_classify",
    f"""WITH {_PARTS}, {_CLASS}
       SELECT vec_id, te.label, m.label AS predicted FROM te, m
       QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY ln(n / (SELECT sum(n) FROM m)) - 0.5 * ln(v11 * v22 - v12 * v12)
         - 0.5 * (v22 * (x1 - m1) ** 2 - 2 * v12 * (x1 - m1) * (x2 - m2) + v11 * (x2 - m2) ** 2) / (v11 * v22 - v12 * v12) DESC) = 1""",
)
def qda_classify(spark, sf):
    train, test = _split_vectors(spark, sf)
    return classify.discriminant_predict(train, test, ["x1", "x2"], "label", quadratic=True).select("vec_id", "label", "predicted")


# All predictors at once: numbers and factors as a design of nine columns, inverted in SQL by sweeps.

_DESIGN = ["price", "days", *[f"(priority = {k})::INT" for k in range(1, 5)], *[f"(quarter = {k})::INT" for k in range(1, 4)]]
_COVARIANCES = "[" + ", ".join("[" + ", ".join(f"covar_samp(x{min(i, j)}, x{max(i, j)})" for j in range(1, 10)) + "]" for i in range(1, 10)) + "]"
_MEANS = "[" + ", ".join(f"avg(x{i})" for i in range(1, 10)) + "]"
_MIXED = f"""WITH RECURSIVE o AS (SELECT o_orderkey, o_orderstatus AS g, o_totalprice AS price, date_diff('day', DATE '1995-01-01', o_orderdate::DATE) AS days,
             left(o_orderpriority, 1)::INT AS priority, quarter(o_orderdate) AS quarter, row_number() OVER (PARTITION BY o_orderstatus
             ORDER BY md5('1|' || o_orderkey), o_orderkey) <= ceil(0.8 * count(*) OVER (PARTITION BY o_orderstatus)) AS is_train FROM orders),
       x AS (SELECT o_orderkey, g, is_train, {", ".join(f"({c})::DOUBLE AS x{i}" for i, c in enumerate(_DESIGN, 1))} FROM o),
       m AS (SELECT g, count(*) AS n, {_MEANS} AS mu, {_COVARIANCES} AS c FROM x WHERE is_train GROUP BY g)"""
_SWEEP = """s AS (SELECT g, 0 AS k, a, 0.0::DOUBLE AS logdet FROM w UNION ALL
             SELECT g, k + 1, list_transform(range(1, 10), lambda i: list_transform(range(1, 10), lambda j:
                    CASE WHEN i = k + 1 AND j = k + 1 THEN 1 / a[k + 1][k + 1] WHEN i = k + 1 THEN a[k + 1][j] / a[k + 1][k + 1]
                         WHEN j = k + 1 THEN -a[i][k + 1] / a[k + 1][k + 1] ELSE a[i][j] - a[i][k + 1] * a[k + 1][j] / a[k + 1][k + 1] END)),
                    logdet + ln(a[k + 1][k + 1]) FROM s WHERE k < 9),
       d AS (SELECT o_orderkey, x.g AS o_orderstatus, m.g AS predicted, m.n, s.a, s.logdet,
                    list_transform(range(1, 10), lambda i: [x1, x2, x3, x4, x5, x6, x7, x8, x9][i] - mu[i]) AS v
             FROM x, m JOIN s ON s.g = m.g AND s.k = 9 WHERE NOT is_train)
       SELECT o_orderkey, o_orderstatus, predicted FROM d QUALIFY row_number() OVER (PARTITION BY o_orderkey
         ORDER BY ln(n / (SELECT sum(n) FROM m)) - {half} * logdet
           - 0.5 * list_sum(list_transform(range(1, 10), lambda i: v[i] * list_dot_product(a[i], v))) DESC, predicted DESC) = 1"""


def _orders_by_all(spark, sf, quadratic):
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_orderstatus", F.col("o_totalprice").alias("price"),
        F.datediff("o_orderdate", F.lit("1995-01-01").cast("date")).alias("days"),
        F.substring("o_orderpriority", 1, 1).alias("priority"), F.quarter("o_orderdate").alias("quarter"),
    )
    parts = saved(classify.stratified_split(orders, "o_orderstatus", "o_orderkey"))
    train, test = parts.filter(F.col("part") == "train"), parts.filter(F.col("part") == "test")
    out = discriminants.mixed_discriminant(train, test, ["price", "days"], ["priority", "quarter"], "o_orderstatus", quadratic)
    return out.select("o_orderkey", "o_orderstatus", "predicted")


@query(
    "lda_all_predictors",
    f"""{_MIXED}, w AS (SELECT y.g, list_transform(range(1, 10), lambda i: list_transform(range(1, 10), lambda j:
               list_sum(list_transform(p.ns, lambda n, q: (n - 1) * p.cs[q][i][j])) / (list_sum(p.ns) - len(p.ns)))) AS a
               FROM m y, (SELECT list(n ORDER BY g) AS ns, list(c ORDER BY g) AS cs FROM m) p),
       {_SWEEP.format(half=0)}""",
)
def lda_all_predictors(spark, sf):
    return _orders_by_all(spark, sf, quadratic=False)


@query("qda_all_predictors", f"{_MIXED}, w AS (SELECT g, c AS a FROM m), {_SWEEP.format(half=0.5)}")
def qda_all_predictors(spark, sf):
    return _orders_by_all(spark, sf, quadratic=True)


# A tree of three levels, pruned at one hundredth of the root's errors per leaf.  Node k has the children 2k and 2k + 1.

_TREE_DEPTH, _TREE_COST = 3, 0.01


def _tree_sql():
    """Bins by counts of 1/1024 of the range; a step of counts, best cuts and routing per level; pruning from below."""
    parts = [
        f"WITH {_PARTS}",
        "x AS (SELECT vec_id, label, is_train, unnest(range(1, len(e) + 1)) AS f, unnest(e) AS x FROM v)",
        "r AS (SELECT f, min(x) AS low, (max(x) - min(x)) / 1024 AS step FROM x WHERE is_train GROUP BY f)",
        "fine AS (SELECT vec_id, label, is_train, f, CASE WHEN step > 0 THEN least(floor((x - low) / step), 1023) ELSE 0 END AS fine FROM x JOIN r USING (f))",
        "c AS (SELECT f, fine, count(*) AS n FROM fine WHERE is_train GROUP BY ALL)",
        "s AS (SELECT f, fine, sum(n) OVER (PARTITION BY f ORDER BY fine) AS upto, sum(n) OVER (PARTITION BY f) AS total FROM c)",
        "e AS (SELECT DISTINCT f, min(fine) AS fine FROM s, range(1, 32) t(q) WHERE upto * 32 >= q * total GROUP BY f, q, total HAVING min(upto) < any_value(total))",
        "b AS (SELECT fine.vec_id, any_value(fine.label) AS label, any_value(is_train) AS is_train, fine.f, count(e.f) AS bin FROM fine LEFT JOIN e ON e.f = fine.f AND e.fine < fine.fine GROUP BY fine.vec_id, fine.f)",
        "a0 AS (SELECT vec_id, label, is_train, 1 AS node FROM v)",
    ]
    for d in range(_TREE_DEPTH):
        parts += [
            f"t{d} AS (SELECT node, label, count(*) AS n FROM a{d} WHERE is_train GROUP BY ALL)",
            f"k{d} AS (SELECT node, sum(n)::BIGINT AS n, sum(n * n)::BIGINT AS sq FROM t{d} GROUP BY node HAVING sum(n) >= 20)",
            f"l{d} AS (SELECT a.node, b.f, j.cut, a.label, count(*) AS n FROM a{d} a JOIN b USING (vec_id) JOIN range(0, 32) j(cut) ON b.bin <= j.cut WHERE a.is_train GROUP BY ALL)",
            f"g{d} AS (SELECT l.node, l.f, l.cut, sum(l.n)::BIGINT AS nb, sum(l.n * l.n)::BIGINT AS sb, sum(l.n * l.n - 2 * l.n * t.n)::BIGINT AS cross_ FROM l{d} l JOIN t{d} t USING (node, label) GROUP BY ALL)",
            f"""w{d} AS (SELECT node, f, cut FROM g{d} JOIN k{d} k USING (node) WHERE least(nb, k.n - nb) >= 7 AND sb / nb + (k.sq + cross_) / (k.n - nb) - k.sq / k.n > 1e-9
                QUALIFY row_number() OVER (PARTITION BY node ORDER BY sb / nb + (k.sq + cross_) / (k.n - nb) - k.sq / k.n DESC, f, cut) = 1)""",
            f"a{d + 1} AS (SELECT a.vec_id, a.label, a.is_train, CASE WHEN w.node IS NULL THEN a.node WHEN b.bin <= w.cut THEN 2 * a.node ELSE 2 * a.node + 1 END AS node FROM a{d} a LEFT JOIN w{d} w USING (node) LEFT JOIN b ON b.vec_id = a.vec_id AND b.f = w.f)",
        ]
    last = _TREE_DEPTH
    splits = " UNION ALL ".join(f"SELECT node FROM w{d}" for d in range(last))
    counts = " UNION ".join(f"SELECT node, label, count(*) AS n FROM a{d} WHERE is_train GROUP BY ALL" for d in range(last + 1))
    parts += [
        f"split AS ({splits})",
        f"cl AS ({counts})",
        "m AS (SELECT node, sum(n) - max(n) AS errors, arg_max(label, n * 1000000 - label) AS label FROM cl GROUP BY node)",
        f"al AS (SELECT {_TREE_COST} * errors AS alpha FROM m WHERE node = 1)",
        f"p{last} AS (SELECT node, errors + alpha AS cost, false AS stays FROM m, al)",
    ]
    for d in reversed(range(last)):  # costs of level d from those of the level below
        parts.append(
            f"""p{d} AS (SELECT m.node, CASE WHEN x.cost + y.cost < errors + alpha THEN x.cost + y.cost ELSE errors + alpha END AS cost,
                coalesce(x.cost + y.cost < errors + alpha, false) AS stays FROM m CROSS JOIN al LEFT JOIN split s USING (node)
                LEFT JOIN p{d + 1} x ON x.node = 2 * s.node LEFT JOIN p{d + 1} y ON y.node = 2 * s.node + 1)"""
        )
    path = " UNION ALL ".join(f"SELECT vec_id, {d} AS depth, node FROM a{d}" for d in range(last + 1))
    return ", ".join(parts) + f""", path AS ({path}),
        stop AS (SELECT vec_id, arg_min(path.node, depth) AS node FROM path JOIN p0 USING (node) WHERE NOT stays GROUP BY vec_id)
        SELECT te.vec_id, te.label, m.label AS predicted FROM te JOIN stop USING (vec_id) JOIN m USING (node)"""


@query("tree_classify", _tree_sql())
def tree_classify(spark, sf):
    train, test = _split_vectors(spark, sf)
    data = pruned_tree.binned(train, "embedding", "label", "vec_id")
    tree = pruned_tree.grow(data, _TREE_DEPTH)[pruned_tree.WHOLE, 0]
    return pruned_tree.predict(test, "embedding", data, tree, _TREE_COST, train.schema["label"].dataType).select("vec_id", "label", "predicted")


@query("tree_tuning")
def tree_tuning(spark, sf):
    """Two repeats of three folds: held-out accuracy of every pruning of the whole tree."""
    vectors = saved(table(spark, sf, "embeddings").select("vec_id", "label", "embedding"))
    folded = saved(classify.repeated_folds(vectors.select("vec_id", "label"), "label", "vec_id", 3, 2))
    data = pruned_tree.binned(vectors, "embedding", "label", "vec_id", folded)
    return pruned_tree.tune(data, pruned_tree.grow(data, 5))


@query("cv_compare")
def cv_compare(spark, sf):
    """Two repeats of three folds; all four models."""
    vectors = table(spark, sf, "embeddings").select(
        "vec_id", "label", "embedding", *[F.get("embedding", i).cast("double").alias(f"x{i}") for i in range(3)]
    )
    scores = freeze(
        compare_models(vectors, "vec_id", "label", ["x0", "x1", "x2"], features="embedding", folds=3, repeats=2, tree_depth=4)
    )
    return metrics.cv_compare(scores)


_LABELS = """WITH c AS (SELECT toxic AS p, quality AS o, count(*) AS n FROM labels GROUP BY 1, 2), t AS (SELECT sum(n) AS n, sum(n) FILTER (p = o) AS hit FROM c),
       k AS (SELECT class, coalesce((SELECT sum(n) FROM c WHERE p = class), 0) AS np, coalesce((SELECT sum(n) FROM c WHERE o = class), 0) AS no,
                    coalesce((SELECT sum(n) FROM c WHERE p = class AND o = class), 0) AS nh
             FROM (SELECT p AS class FROM c UNION SELECT o FROM c))"""


@query(
    "accuracy_kappa",
    f"""{_LABELS} SELECT CAST(any_value(t.n) AS BIGINT) AS n, round(any_value(hit / t.n), 6) AS accuracy,
               round((any_value(hit / t.n) - sum(np * no) / any_value(t.n * t.n)) / (1 - sum(np * no) / any_value(t.n * t.n)), 6) AS kappa,
               round(max(no) / any_value(t.n), 6) AS no_information_rate FROM k, t""",
)
def accuracy_kappa(spark, sf):
    scored = metrics.accuracy_kappa(table(spark, sf, "labels"), "toxic", "quality")
    return _rounded(scored, ["accuracy", "kappa", "no_information_rate"])


_BINOMIAL = "list_sum(list_transform(range({k}, n + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({p}) + (n - i) * ln(1 - {p}))))"


@query(
    "confusion_overall",
    f"""WITH RECURSIVE c AS (SELECT toxic AS p, quality AS o, count(*) AS n FROM labels GROUP BY 1, 2),
       t AS (SELECT sum(n)::INT AS n, sum(n) FILTER (p = o)::INT AS k, (sum(n) FILTER (p = 0 AND o = 1)) AS x, coalesce(sum(n) FILTER (p = 1 AND o = 0), 0) AS y,
                    greatest(sum(n) FILTER (o = 0), sum(n) FILTER (o = 1)) / sum(n) AS nir FROM c),
       b AS (SELECT 0 AS step, 0.0::DOUBLE AS l1, 1.0::DOUBLE AS h1, 0.0::DOUBLE AS l2, 1.0::DOUBLE AS h2 UNION ALL
             SELECT step + 1, CASE WHEN low THEN m1 ELSE l1 END, CASE WHEN low THEN h1 ELSE m1 END, CASE WHEN high THEN m2 ELSE l2 END, CASE WHEN high THEN h2 ELSE m2 END
             FROM (SELECT b.*, (l1 + h1) / 2 AS m1, (l2 + h2) / 2 AS m2, {_BINOMIAL.format(k="k", p="((l1 + h1) / 2)")} < 0.025 AS low,
                          1 - {_BINOMIAL.format(k="k + 1", p="((l2 + h2) / 2)")} > 0.025 AS high FROM b, t WHERE step < 45))
       SELECT n::BIGINT AS n, round(k / n, 6) AS accuracy, round(l1, 6) AS ci_low, round(h2, 6) AS ci_high, round(nir, 6) AS no_information_rate,
              round(least(1, {_BINOMIAL.format(k="k", p="nir")}), 6) AS p_above_rate, round(pow(abs(x - y) - 1, 2) / (x + y), 6) AS mcnemar, 1 AS mcnemar_df,
              round(1 - 2 * {_simpson("exp(-u * u / 2) / sqrt(2 * pi())".replace("sqrt", "SQRT"), "least((abs(x - y) - 1) / sqrt(x + y), 40.0)")}, 6) AS mcnemar_p
       FROM t, b WHERE step = 45""",
)
def confusion_overall(spark, sf):
    found = metrics.confusion_overall(table(spark, sf, "labels"), "toxic", "quality")
    return _rounded(found, ["accuracy", "ci_low", "ci_high", "no_information_rate", "p_above_rate", "mcnemar", "mcnemar_p"])


_RATES = ["sensitivity", "specificity", "positive_predictive", "negative_predictive", "prevalence", "detection_rate", "detection_prevalence", "balanced_accuracy"]


@query(
    "confusion_stats",
    f"""{_LABELS} SELECT class, CAST(t.n AS BIGINT) AS n, CAST(np AS BIGINT) AS n_predicted, CAST(no AS BIGINT) AS n_observed, CAST(nh AS BIGINT) AS n_hit,
               round(nh / nullif(no, 0), 6) AS sensitivity, round((t.n - np - no + nh) / nullif(t.n - no, 0), 6) AS specificity,
               round(nh / nullif(np, 0), 6) AS positive_predictive, round((t.n - np - no + nh) / nullif(t.n - np, 0), 6) AS negative_predictive,
               round(no / t.n, 6) AS prevalence, round(nh / t.n, 6) AS detection_rate, round(np / t.n, 6) AS detection_prevalence,
               round((nh / nullif(no, 0) + (t.n - np - no + nh) / nullif(t.n - no, 0)) / 2, 6) AS balanced_accuracy FROM k, t""",
)
def confusion_stats(spark, sf):
    return _rounded(metrics.confusion_stats(table(spark, sf, "labels"), "toxic", "quality"), _RATES)
