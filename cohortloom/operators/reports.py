"""Totals, ratios, cross tabulations and counters: single-pass grouped aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from cohortloom import fixed_values as fv
from cohortloom.session import freeze


def ratio_of_sums(part: Column, whole: Column) -> Column:
    """100 * part / whole; missing when the whole is zero."""
    return F.try_divide(part * F.lit(100.0), whole)


def _margins(df: DataFrame, class_vars: list[str], aggregates: list[Column]) -> DataFrame:
    """Grand total and one-way totals as (dim, level, ...), in one pass.

    A row with any missing class variable is left out of every total.
    """
    complete = df.dropna(subset=class_vars)
    sets = [[]] + [[v] for v in class_vars]
    grouped = complete.groupingSets(sets, *class_vars).agg(F.grouping_id().alias("_gid"), *aggregates)
    # grouping_id sets one bit per variable that is summed over, first variable highest.
    everything = (1 << len(class_vars)) - 1
    dim, level = F.lit("all"), F.lit("Total")
    for i, v in enumerate(class_vars):
        alone = F.col("_gid") == everything - (1 << (len(class_vars) - 1 - i))
        dim = F.when(alone, F.lit(v)).otherwise(dim)
        level = F.when(alone, F.col(v).cast("string")).otherwise(level)
    return grouped.withColumn("dim", dim).withColumn("level", level).drop("_gid", *class_vars)


def totals_report(
    df: DataFrame, class_vars: list[str], measures: list[str], ratios: dict[str, tuple[str, str]] | None = None
) -> DataFrame:
    """Sums of the measures in total and per class variable, with ratios of those sums."""
    sums = _margins(df, class_vars, [F.sum(m).cast("bigint").alias(m) for m in measures])
    extra = [ratio_of_sums(F.col(a), F.col(b)).alias(name) for name, (a, b) in (ratios or {}).items()]
    return sums.select("dim", "level", *measures, *extra)


def snapshot_compare(df: DataFrame, class_vars: list[str], measures: list[str], tag: str, tags: dict) -> DataFrame:
    """The totals with every measure split by snapshot; ``tags`` maps value to column suffix."""
    split = [
        F.coalesce(F.sum(F.when(F.col(tag) == value, F.col(m))), F.lit(0)).cast("bigint").alias(f"{m}_{suffix}")
        for m in measures
        for value, suffix in tags.items()
    ]
    whole = df.filter(F.col(tag).isin(list(tags)))
    return _margins(whole, class_vars, split).select(
        "dim", "level", *[f"{m}_{suffix}" for m in measures for suffix in tags.values()]
    )


def report_cells(df: DataFrame, keys: list[str], class_vars: list[str], measures: list[str]) -> DataFrame:
    """Sums of the measures per combination of keys and class values, missing values being values of their own.

    ``totals_report`` and ``snapshot_compare`` of the cells equal those of the
    rows for every choice among the class variables and every filter on keys
    and class variables, so many reports need one pass over the rows.  The
    cells grow with the combinations that occur, not with the rows.
    """
    return df.groupBy(*keys, *class_vars).agg(*[F.sum(m).alias(m) for m in measures])


def crosstab_counts(df: DataFrame, row: str, column: str) -> DataFrame:
    """Two-way counts; rows with a missing value in either variable are left out."""
    return df.dropna(subset=[row, column]).groupBy(row, column).agg(F.count("*").alias("n"))


def crosstab_full(df: DataFrame, row: str, column: str) -> DataFrame:
    """Two-way counts with percent of the total, the row and the column.

    The cells are counted once and frozen; margins are sums of cells.
    """
    cells = freeze(crosstab_counts(df, row, column))
    n, total = F.col("n"), cells.agg(F.sum("n")).scalar()
    return cells.select(
        row,
        column,
        "n",
        ratio_of_sums(n, total).alias("pct_total"),
        ratio_of_sums(n, F.sum("n").over(Window.partitionBy(row))).alias("pct_row"),
        ratio_of_sums(n, F.sum("n").over(Window.partitionBy(column))).alias("pct_col"),
    )


def status_totals(df: DataFrame, status: str, totals: list[tuple[str, str]] | None = None) -> DataFrame:
    """One counter per status and the record count with header and trailer."""
    totals = totals or fv.STATUS_TOTALS
    return df.agg(
        *[F.count_if(F.col(status) == letter).alias(name) for letter, name in totals],
        (F.count("*") + 2).alias("total_records"),
    )


def report_filter(df: DataFrame, base: Column, extra: Column | None = None) -> DataFrame:
    """The report's own condition and the caller's, both required."""
    return df.filter(base if extra is None else base & extra)


def nearest_history_date(
    dates: DataFrame, day: str, run_date: Column, condition: Column | None = None, override: Column | None = None
) -> DataFrame:
    """The day closest to, and not before, the run date one year earlier.

    A manual override replaces the found day.
    """
    last_year = F.add_months(run_date, -12)
    rows = dates.filter(F.col(day) >= last_year)
    rows = rows if condition is None else rows.filter(condition)
    found = rows.agg(F.min(day).alias("_found"))
    chosen = F.col("_found") if override is None else F.coalesce(override, F.col("_found"))
    return found.select(chosen.alias("history_date"), F.datediff(chosen, last_year).alias("distance"))
