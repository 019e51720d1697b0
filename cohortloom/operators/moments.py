"""Moments, standardising, histograms, correlation and the tests of group means.

One aggregate pass each; p-values are computed on the few aggregated rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.functions.tails import f_pvalue, t_pvalue, t_quantile95, tukey_pvalue, tukey_quantile95
from cohortloom.session import freeze


def standardise(df: DataFrame, columns: list[str], suffix: str = "_z") -> DataFrame:
    """(x - mean) / sample standard deviation; missing for a constant column.

    All means and deviations are one struct from one pass, read as a scalar subquery.
    """
    both = [x for i, c in enumerate(columns) for x in (F.avg(c).alias(f"m{i}"), F.stddev_samp(c).alias(f"d{i}"))]
    found = df.agg(F.struct(*both).alias("s")).scalar()
    return df.withColumns({c + suffix: F.try_divide(F.col(c) - found[f"m{i}"], found[f"d{i}"]) for i, c in enumerate(columns)})


def group_zstat(df: DataFrame, sample: str, value: str, mu: float | Column, sigma: float | Column) -> DataFrame:
    """(mean - mu) / (sigma / sqrt(n)) of every sample."""
    mu = mu if isinstance(mu, Column) else F.lit(mu)
    sigma = sigma if isinstance(sigma, Column) else F.lit(sigma)
    grouped = df.groupBy(sample).agg(F.count(value).alias("n"), F.avg(value).alias("mean"))
    return grouped.withColumn("z", (F.col("mean") - mu) / (sigma / F.sqrt("n")))


def pretty_step(low: Column, high: Column, cells: Column) -> Column:
    """A step of 1, 2, 5 or 10 times a power of ten that gives about ``cells`` cells."""
    cell = (high - low) / cells
    power = F.pow(F.lit(10.0), F.floor(F.log10(cell)))
    # The factors and bias of the usual rule for round breakpoints.
    bias, bias5 = 1.5, 2.75
    step = power
    step = F.when(2 * power - cell < bias * (cell - step), 2 * power).otherwise(step)
    step = F.when((step == 2 * power) & (5 * power - cell < bias5 * (cell - step)), 5 * power).otherwise(step)
    return F.when((step == 5 * power) & (10 * power - cell < bias * (cell - step)), 10 * power).otherwise(step)


def histogram_breaks(df: DataFrame, value: str) -> DataFrame:
    """Lowest break, step and count for round breaks with about log2(n) + 1 cells: one row."""
    low, high, cells = F.col("lo"), F.col("hi"), F.ceil(F.log2(F.col("n")) + 1)
    return (
        df.agg(F.min(value).alias("lo"), F.max(value).alias("hi"), F.count(value).alias("n"))
        .withColumn("step", F.coalesce(pretty_step(low, high, cells), F.lit(1.0)))
        .select((F.floor(F.col("lo") / F.col("step") + 1e-10) * F.col("step")).alias("start"), "step", "n")
    )


def density_histogram(df: DataFrame, value: str, start: float | None = None, step: float | None = None) -> DataFrame:
    """Bins (left, right], the first also holding its left edge: count and density.

    Without ``start`` and ``step`` round breaks are chosen from the data.
    """
    if start is None or step is None:
        breaks = histogram_breaks(df, value)
    else:
        breaks = df.agg(F.count(value).alias("n")).select(
            F.lit(float(start)).alias("start"), F.lit(float(step)).alias("step"), "n"
        )
    rows = df.filter(F.col(value).isNotNull()).select(
        F.col(value).alias("_x"), breaks.select(F.struct("start", "step", "n")).scalar().alias("_b")
    )
    first, width = F.col("_b.start"), F.col("_b.step")
    cell = F.greatest(F.ceil((F.col("_x") - first) / width) - 1, F.lit(0)).cast("bigint")
    return rows.groupBy("_b", cell.alias("bin")).agg(F.count("*").alias("count")).select(
        "bin",
        (first + F.col("bin") * width).alias("bin_left"),
        (first + (F.col("bin") + 1) * width).alias("bin_right"),
        "count",
        (F.col("count") / (F.col("_b.n") * width)).alias("density"),
    )


def normal_curve(spark, low: float = -3.0, high: float = 3.0, step: float = 0.01) -> DataFrame:
    """The standard normal density on a grid."""
    cells = round((high - low) / step)
    x = F.round(F.lit(low) + F.col("id") * F.lit(step), 10)
    return spark.range(cells + 1).select(x.alias("x")).withColumn(
        "density", F.exp(-F.col("x") * F.col("x") / 2) / F.sqrt(F.lit(2.0) * F.pi())
    )


def correlation_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of every pair of columns, in one aggregate, as (var1, var2, r)."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    row = df.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    both = [(a, b, f"{a}|{b}") for a, b in pairs] + [(b, a, f"{a}|{b}") for a, b in pairs if a != b]
    cells = F.array(
        *[F.struct(F.lit(a).alias("var1"), F.lit(b).alias("var2"), F.col(f"`{c}`").alias("r")) for a, b, c in both]
    )
    return row.select(F.explode(cells).alias("c")).select("c.var1", "c.var2", "c.r")


def group_moments(df: DataFrame, group: str, value: str) -> DataFrame:
    """Count, mean and sample variance per group; rows missing either are left out."""
    return (
        df.dropna(subset=[group, value])
        .groupBy(group)
        .agg(F.count("*").alias("n"), F.avg(value).alias("mean"), F.var_samp(value).alias("variance"))
    )


def t_test_two_sample(df: DataFrame, group: str, value: str, levels: tuple) -> DataFrame:
    """Pooled-variance t test of the first level against the second."""
    m = group_moments(df.filter(F.col(group).isin(*levels)), group, value)
    pick = []
    for i, level in enumerate(levels, 1):
        for c in ("n", "mean", "variance"):
            pick.append(F.max(F.when(F.col(group) == level, F.col(c))).alias(f"{c}{i}"))
    row = m.agg(*pick)
    dof = F.col("n1") + F.col("n2") - 2
    pooled = ((F.col("n1") - 1) * F.col("variance1") + (F.col("n2") - 1) * F.col("variance2")) / dof
    row = row.withColumn("df", dof).withColumn(
        "std_error", F.sqrt(pooled * (1 / F.col("n1") + 1 / F.col("n2")))
    )
    row = row.withColumn("difference", F.col("mean1") - F.col("mean2"))
    return _finish_t(row, ["mean1", "mean2", "difference"])


def t_test_one_sample(df: DataFrame, value: str, mu: float = 0.0) -> DataFrame:
    """t test of the mean against ``mu``."""
    row = df.agg(F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("_sd"))
    row = row.select(
        "n", "mean", (F.col("n") - 1).alias("df"), (F.col("_sd") / F.sqrt("n")).alias("std_error"),
        (F.col("mean") - F.lit(mu)).alias("difference"),
    )
    return _finish_t(row, ["n", "mean", "difference"], shift=mu)


def _finish_t(row: DataFrame, keep: list[str], shift: float = 0.0) -> DataFrame:
    half = t_quantile95(F.col("df").cast("double")) * F.col("std_error")
    return (
        row.withColumn("t", F.try_divide(F.col("difference"), F.col("std_error")))
        .withColumn("p_value", t_pvalue(F.col("t"), F.col("df").cast("double")))
        .withColumn("ci_low", F.col("difference") + F.lit(shift) - half)
        .withColumn("ci_high", F.col("difference") + F.lit(shift) + half)
        .select(*keep, "df", "std_error", "t", "p_value", "ci_low", "ci_high")
    )


def _anova_parts(moments: DataFrame) -> DataFrame:
    """Sums of squares and degrees of freedom from the frozen group table: one row."""
    grand = moments.agg(F.sum(F.col("n") * F.col("mean")) / F.sum("n")).scalar()
    between = F.sum(F.col("n") * F.pow(F.col("mean") - grand, 2))
    within = F.sum(F.when(F.col("n") > 1, (F.col("n") - 1) * F.col("variance")).otherwise(0.0))
    return moments.agg(
        between.alias("ss_between"), within.alias("ss_within"), (F.count("*") - 1).alias("df_between"),
        (F.sum("n") - F.count("*")).alias("df_within"),
    )


def anova_one_way(df: DataFrame, group: str, value: str) -> DataFrame:
    """One-way analysis of variance; the group is always treated as categorical."""
    row = _anova_parts(freeze(group_moments(df, group, value)))
    row = row.withColumn("ms_between", F.try_divide("ss_between", F.col("df_between").cast("double"))).withColumn(
        "ms_within", F.try_divide("ss_within", F.col("df_within").cast("double"))
    )
    row = row.withColumn("f_value", F.try_divide("ms_between", "ms_within"))
    return row.withColumn(
        "p_value", f_pvalue("f_value", F.col("df_between").cast("double"), F.col("df_within").cast("double"))
    )


def tukey_pairs(df: DataFrame, group: str, value: str) -> DataFrame:
    """All differences of level means (later minus earlier) with adjusted interval and p-value.

    Pairs are formed over the levels of the group, the statistic's own result
    rows, never over data rows.
    """
    m = freeze(group_moments(df, group, value))
    parts = _anova_parts(m)
    mse = parts.select(F.col("ss_within") / F.col("df_within")).scalar()
    dof = parts.select(F.col("df_within").cast("double")).scalar()
    k = parts.select((F.col("df_between") + 1).cast("double")).scalar()
    high = m.select(F.col(group).alias("level_high"), F.col("n").alias("_n1"), F.col("mean").alias("_m1"))
    low = m.select(F.col(group).alias("level_low"), F.col("n").alias("_n2"), F.col("mean").alias("_m2"))
    pairs = high.join(low, F.col("level_high") > F.col("level_low"))
    error = F.sqrt(mse / 2 * (1 / F.col("_n1") + 1 / F.col("_n2")))
    return (
        pairs.select("level_high", "level_low", (F.col("_m1") - F.col("_m2")).alias("difference"), error.alias("std_error"),
                     k.alias("_k"), dof.alias("_df"))
        .withColumn("q", F.try_divide(F.abs("difference"), F.col("std_error")))
        .withColumn("p_adjusted", tukey_pvalue("q", "_k", "_df"))
        .withColumn("_half", tukey_quantile95("_k", "_df") * F.col("std_error"))
        .withColumn("ci_low", F.col("difference") - F.col("_half"))
        .withColumn("ci_high", F.col("difference") + F.col("_half"))
        .drop("_half", "_k", "_df")
    )
