"""Data-quality checks: each returns the offending rows; :func:`violations` counts them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom import fixed_values as fv
from cohortloom.functions.missing import not_equal
from cohortloom.functions.scalars import needs_review


def check_review_rows(rows: DataFrame, standing: str, audit_units: str) -> DataFrame:
    """Rows without a derivable standing and without audit units."""
    return rows.filter(needs_review(standing, audit_units))


def check_run_date(headers: DataFrame, terms: Column, run_date: str, today: Column) -> DataFrame:
    """Latest header date of the wanted terms and whether it is today's."""
    return headers.filter(terms).agg(F.max(run_date).alias("latest"), F.count("*").alias("n")).withColumn(
        "fresh", F.coalesce(F.col("latest") == today, F.lit(False))
    )


def check_status_conflict(
    records: DataFrame, registration: DataFrame, keys: list[str], withdrawn: Column, active: Column
) -> DataFrame:
    """Records withdrawn overall whose key is actively registered."""
    return records.filter(withdrawn).join(registration.filter(active), keys)


def overwritten(before: str, after: str) -> Column:
    """Withdrawn before, and neither withdrawn nor graduated after (missing counts as changed)."""
    return F.col(before).eqNullSafe(fv.WITHDRAWN) & not_equal(after, fv.WITHDRAWN) & not_equal(after, fv.GRADUATED)


def check_overwritten_status(
    withdrawn_rows: DataFrame, combined: DataFrame, keys: list[str], pairs: list[tuple[str, str]]
) -> DataFrame:
    """Withdrawn rows joined to the combined record where any of the status pairs was overwritten."""
    condition = reduce(lambda a, b: a | b, [overwritten(x, y) for x, y in pairs])
    return withdrawn_rows.join(combined, keys).filter(condition)


def check_missing_credits(rows: DataFrame, total: str) -> DataFrame:
    """Rows with no total of credits counted toward the degree."""
    return rows.filter(F.col(total).isNull())


def check_unmatched_courses(courses: DataFrame, accepted: Column, subject: str) -> DataFrame:
    """Accepted courses that no subject was found for."""
    return courses.filter(accepted & F.col(subject).isNull())


def violations(checks: dict[str, DataFrame]) -> DataFrame:
    """One row (check, violations) per check."""
    parts = [df.agg(F.count("*").alias("violations")).select(F.lit(name).alias("check"), "violations") for name, df in checks.items()]
    return reduce(DataFrame.unionByName, parts)
