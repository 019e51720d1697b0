"""Agreement of predicted and observed classes, from confusion counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from cohortloom.functions.tails import binomial_interval95, binomial_pvalue, chi2_pvalue, t_pvalue, t_quantile
from cohortloom.operators.spread import null_safe_on
from cohortloom.session import freeze


def confusion_counts(df: DataFrame, predicted: str, observed: str, by: list[str] | None = None) -> DataFrame:
    """Rows per (by, predicted, observed); rows missing either are left out."""
    return (
        df.dropna(subset=[predicted, observed])
        .groupBy(*(by or []), F.col(predicted).alias("predicted"), F.col(observed).alias("observed"))
        .agg(F.count("*").alias("n"))
    )


def _class_margins(counts: DataFrame, by: list[str]) -> DataFrame:
    """Per class: how often predicted, observed, and both."""
    sides = F.array(
        F.struct(F.col("predicted").alias("class"), F.col("n").alias("p"), F.lit(0).cast("bigint").alias("o")),
        F.struct(F.col("observed").alias("class"), F.lit(0).cast("bigint").alias("p"), F.col("n").alias("o")),
    )
    hit = F.when(F.col("predicted") == F.col("observed"), F.col("n")).otherwise(0)
    long = counts.select(*by, hit.alias("hit"), F.posexplode(sides).alias("side", "m"))
    return long.groupBy(*by, F.col("m.class").alias("class")).agg(
        F.sum("m.p").alias("n_predicted"), F.sum("m.o").alias("n_observed"),
        F.sum(F.when(F.col("side") == 0, F.col("hit")).otherwise(0)).alias("n_hit"),
    )


def accuracy_kappa(df: DataFrame, predicted: str, observed: str, by: list[str] | None = None) -> DataFrame:
    """Accuracy, kappa and no-information rate, overall or per ``by``."""
    by = by or []
    margins = _class_margins(confusion_counts(df, predicted, observed, by), by)
    row = margins.groupBy(*by).agg(
        F.sum("n_observed").alias("n"),
        F.sum("n_hit").alias("_hit"),
        F.sum(F.col("n_predicted").cast("double") * F.col("n_observed")).alias("_chance"),
        F.max("n_observed").alias("_largest"),
    )
    accuracy = F.try_divide(F.col("_hit").cast("double"), F.col("n"))
    chance = F.try_divide(F.col("_chance"), F.col("n").cast("double") * F.col("n"))
    return row.select(
        *by, "n", accuracy.alias("accuracy"),
        F.try_divide(accuracy - chance, F.lit(1.0) - chance).alias("kappa"),
        F.try_divide(F.col("_largest").cast("double"), F.col("n")).alias("no_information_rate"),
    )


def confusion_stats(df: DataFrame, predicted: str, observed: str) -> DataFrame:
    """Per class: sensitivity, specificity, predictive values, prevalence, rates, balanced accuracy.

    A value whose denominator is zero (a class never predicted) is missing.
    """
    counts = confusion_counts(df, predicted, observed)
    margins = _class_margins(counts, [])
    n = counts.agg(F.sum("n")).scalar()
    hit, p, o = F.col("n_hit"), F.col("n_predicted"), F.col("n_observed")
    true_negative = F.col("n") - p - o + hit

    def ratio(a, b):
        return F.try_divide(a.cast("double"), b.cast("double"))

    sensitivity, specificity = ratio(hit, o), ratio(true_negative, F.col("n") - o)
    return margins.withColumn("n", n).select(
        "class", "n", "n_predicted", "n_observed", "n_hit",
        sensitivity.alias("sensitivity"), specificity.alias("specificity"),
        ratio(hit, p).alias("positive_predictive"), ratio(true_negative, F.col("n") - p).alias("negative_predictive"),
        ratio(o, F.col("n")).alias("prevalence"), ratio(hit, F.col("n")).alias("detection_rate"),
        ratio(p, F.col("n")).alias("detection_prevalence"),
        ((sensitivity + specificity) / 2).alias("balanced_accuracy"),
    )


def confusion_overall(df: DataFrame, predicted: str, observed: str) -> DataFrame:
    """One row: accuracy with its exact 95 % interval, its test against the no-information rate, and McNemar's test.

    ``p_above_rate`` is the chance of so many hits or more at the rate of the
    largest observed class.  McNemar's statistic compares the two ways every
    two classes are taken for each other, with continuity correction for two
    classes; it is missing if two classes are never taken for each other.
    Without any row there is no result.
    """
    counts = freeze(confusion_counts(df, predicted, observed))
    total = accuracy_kappa(df, predicted, observed).select("n", "accuracy", "no_information_rate").filter("n > 0")
    low, high = F.least("predicted", "observed"), F.greatest("predicted", "observed")
    way = F.when(F.col("predicted") < F.col("observed"), F.col("n")).otherwise(-F.col("n"))
    pairs = counts.filter("predicted <> observed").groupBy(low.alias("a"), high.alias("b")).agg(F.sum("n").alias("both"), F.abs(F.sum(way)).alias("apart"))
    classes = counts.select(F.col("predicted").alias("c")).union(counts.select("observed")).agg(F.count_distinct("c")).scalar()
    found = pairs.agg(
        F.count("*").alias("_pairs"), F.sum(F.pow("apart", F.lit(2)) / F.col("both")).alias("_plain"),
        F.sum(F.pow(F.col("apart") - F.least(F.lit(1), "apart"), F.lit(2)) / F.col("both")).alias("_corrected"),
    )
    row = total.join(F.broadcast(found)).withColumns({"_classes": classes, "_hits": F.round(F.col("accuracy") * F.col("n"))})
    row = row.withColumn("mcnemar_df", (F.col("_classes") * (F.col("_classes") - 1) / 2).cast("int"))
    statistic = F.when(F.col("_classes") == 2, F.col("_corrected")).otherwise(F.col("_plain"))
    row = row.withColumn("mcnemar", F.when(F.col("_pairs") == F.col("mcnemar_df"), statistic))
    return row.withColumn("_ci", binomial_interval95("_hits", "n")).select(
        "n", "accuracy", F.col("_ci.low").alias("ci_low"), F.col("_ci.high").alias("ci_high"), "no_information_rate",
        binomial_pvalue("_hits", "n", "no_information_rate").alias("p_above_rate"), "mcnemar", "mcnemar_df",
        chi2_pvalue("mcnemar", F.col("mcnemar_df").cast("double")).alias("mcnemar_p"),
    )


def cv_metrics(predictions: DataFrame, model: str, predicted: str, observed: str) -> DataFrame:
    """Accuracy and kappa of every fold as long rows (model, repeat, fold, metric, value)."""
    scored = accuracy_kappa(predictions, predicted, observed, ["repeat", "fold"])
    long = F.array(
        F.struct(F.lit("accuracy").alias("metric"), F.col("accuracy").alias("value")),
        F.struct(F.lit("kappa").alias("metric"), F.col("kappa").alias("value")),
    )
    return scored.select(
        F.lit(model).alias("model"), F.col("repeat").cast(T.IntegerType()), F.col("fold").cast(T.IntegerType()),
        F.explode(long).alias("m"),
    ).select("model", "repeat", "fold", "m.metric", "m.value")


def cv_summary(metrics: DataFrame) -> DataFrame:
    """Spread of each model's metric over the folds (folds are few, so percentiles are exact)."""
    return metrics.groupBy("model", "metric").agg(
        F.count("value").alias("folds"), F.min("value").alias("min"),
        F.percentile("value", F.lit(0.25)).alias("q1"), F.percentile("value", F.lit(0.5)).alias("median"),
        F.avg("value").alias("mean"), F.percentile("value", F.lit(0.75)).alias("q3"), F.max("value").alias("max"),
    )


def adjusted_pvalues(tests: DataFrame, p: str, order: list[str]) -> DataFrame:
    """Add p_holm: the step-down adjustment over all rows; a missing p stays missing and is no test.

    ``order`` settles ties, which does not change a value.  All rows meet in
    one window, so this is for tables of tests, not of observations.
    """
    ranked = Window.orderBy(F.col(p).asc_nulls_last(), *order)
    left = F.count(p).over(Window.partitionBy()) - F.row_number().over(ranked) + 1
    step = tests.withColumn("_step", F.when(F.col(p).isNotNull(), F.least(F.lit(1.0), left * F.col(p))))
    so_far = F.max("_step").over(ranked.rowsBetween(Window.unboundedPreceding, 0))
    return step.withColumn("p_holm", F.when(F.col(p).isNotNull(), so_far)).drop("_step")


def cv_compare(metrics: DataFrame, level: float = 0.95) -> DataFrame:
    """Paired fold differences of every two models: t test against 0, intervals and adjusted p-values.

    ``ci_low`` and ``ci_high`` hold one difference at the level, ``joint_low``
    and ``joint_high`` all pairs of models of a metric together (each at
    1 - (1 - level) / pairs).  ``p_bonferroni`` is for the pairs of the metric,
    ``p_holm`` steps down over all pairs and metrics.  Folds that lack either
    value are left out.  With one fold, or differences that do not vary, there
    is no test; with one fold there is no interval either.
    """
    other = metrics.select(*[F.col(c).alias(f"_o_{c}") for c in metrics.columns])
    paired = metrics.join(
        other, null_safe_on(metrics, other, ["repeat", "fold", "metric"], "_o_") & (F.col("model") < F.col("_o_model"))
    )
    difference = F.col("value") - F.col("_o_value")
    row = paired.groupBy(F.col("model").alias("model_a"), F.col("_o_model").alias("model_b"), "metric").agg(
        F.count(difference).alias("folds"), F.avg(difference).alias("mean_difference"), F.stddev_samp(difference).alias("_sd")
    )
    error = F.col("_sd") / F.sqrt("folds")
    df = (F.col("folds") - 1).cast("double")
    row = row.withColumn("_pairs", F.count("*").over(Window.partitionBy("metric")))  # rows are pairs of models
    row = row.withColumn("t", F.try_divide(F.col("mean_difference"), error)).withColumn("p_value", t_pvalue("t", df))
    for name, share in (("ci", F.lit(1.0 - level)), ("joint", F.lit(1.0 - level) / F.col("_pairs"))):
        half = t_quantile(F.lit(1.0) - share, df) * error
        row = row.withColumns({f"{name}_low": F.col("mean_difference") - half, f"{name}_high": F.col("mean_difference") + half})
    row = row.withColumn("p_bonferroni", F.least(F.lit(1.0), F.col("_pairs") * F.col("p_value")))
    row = row.withColumn("p_bonferroni", F.when(F.col("p_value").isNotNull(), F.col("p_bonferroni")))
    return adjusted_pvalues(row, "p_value", ["metric", "model_a", "model_b"]).drop("_sd", "_pairs")
