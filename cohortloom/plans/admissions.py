"""Daily admission report: today's snapshot against the nearest snapshot of last year.

Plain functions; whether they are run daily, and what is done with the tables,
is the caller's business.  The reports of a day roll up from cells that one pass
over the snapshots leaves.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom import fixed_values as fv
from cohortloom.functions.scalars import label_concat
from cohortloom.functions.terms import term_calendar
from cohortloom.operators.joins import left_lookup_chain
from cohortloom.operators.reports import nearest_history_date, report_cells, report_filter, snapshot_compare, totals_report
from cohortloom.operators.setops import override_union, snapshot_concat
from cohortloom.session import saved

RATES = {"acceptance_pct": ("admit", "apply"), "yield_pct": ("will_enter", "admit")}


def combined_snapshots(
    today: DataFrame, history: DataFrame, today_day: str, history_day: str, terms: list[str], history_terms: list[str]
) -> DataFrame:
    """Both snapshots, tagged by day, limited to the report's terms and types."""
    both = snapshot_concat([(history, history_day), (today, today_day)])
    return both.filter(
        F.col("admit_term").isin([*history_terms, *terms]) & F.col("applicant_type").isin(fv.ADMISSION_TYPES)
    )


def with_tiers(rows: DataFrame, res_codes: DataFrame, tiers: DataFrame) -> DataFrame:
    """County of the residence code, then the county's tier label."""
    joined = left_lookup_chain(
        rows, (res_codes, "nc_tui_res_code", "nc_tui_res_code"), (tiers, "nc_tui_res_cd_dcr", "county")
    )
    return joined.withColumn("tier_designation", label_concat("Tier", "tier_designation"))


def unit_condition() -> Column:
    """Applicants of the college, of its shared plans, or of its sub-plan."""
    return (
        F.col("college").eqNullSafe(fv.UNIT_COLLEGE)
        | F.coalesce(F.col("acad_plan").isin(fv.UNIT_PLANS), F.lit(False))
        | F.col("acad_sub_plan").eqNullSafe(fv.UNIT_SUB_PLAN)
    )


def admission_report(
    rows: DataFrame, applicant_type: str, today_day: str, history_day: str, class_vars: list[str] | None = None,
    extra: Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Today's totals with acceptance and yield rates, and the two-day comparison."""
    class_vars = class_vars or fv.ADMISSION_CLASSES
    chosen = report_filter(rows, F.col("applicant_type") == applicant_type, extra)
    totals = totals_report(chosen.filter(F.col("day") == today_day), class_vars, fv.ADMISSION_MEASURES, RATES)
    compared = snapshot_compare(
        chosen, class_vars, fv.ADMISSION_MEASURES, "day", {today_day: "today", history_day: "history"}
    )
    return totals, compared


def spring_connect(rows: DataFrame, today: DataFrame, spring_term: str) -> DataFrame:
    """Deferred applicants: once with the outcome in today's spring file, once as deferrals."""
    label = F.lit(fv.SPRING_CONNECT)
    spring = today.filter(F.col("admit_term") == spring_term).select(
        "emplid", F.col("admit").alias("_admit"), F.col("will_enter").alias("_will_enter")
    )
    deferred = rows.filter(F.col("spring_defer") == 1)
    outcome = deferred.filter((F.col("apply") == 1) & (F.col("admit") == 0)).join(spring, "emplid")
    return override_union(
        [
            (
                outcome.withColumns({"admit": F.col("_admit"), "will_enter": F.col("_will_enter")})
                .drop("_admit", "_will_enter")
                .select(*rows.columns),
                {"applicant_type": label},
            ),
            (deferred, {"applicant_type": label, "admit": F.lit(1), "will_enter": F.col("spring_def_we")}),
        ]
    )


def day_cells(rows: DataFrame, with_unit: bool) -> DataFrame:
    """What every report of a day sums: measures per day, applicant type and class values, and per unit membership if asked for."""
    class_vars = [*fv.ADMISSION_CLASSES, "country"]
    if with_unit:
        class_vars += [v for v in fv.UNIT_CLASSES if v not in class_vars] + ["in_unit"]
        rows = rows.withColumn("in_unit", unit_condition())
    return report_cells(rows, ["day", "applicant_type"], class_vars, fv.ADMISSION_MEASURES)


def _narrow(snapshot: DataFrame, spring_term: str, terms: list[str]) -> DataFrame:
    """The rows and columns of a snapshot that the reports of a spring day use, stored, as two plans read them."""
    columns = [
        "emplid", "admit_term", "applicant_type", "nc_tui_res_code", "spring_defer", "spring_def_we",
        *fv.ADMISSION_MEASURES, *[c for c in fv.ADMISSION_CLASSES if c != "tier_designation"], "country", "acad_plan", "acad_sub_plan",
    ]
    return saved(snapshot.filter(F.col("admit_term").isin([*terms, spring_term])).select(*columns))


def daily_reports(
    run_date: date,
    read_snapshot: Callable[[str, date], DataFrame],
    dates: DataFrame,
    res_codes: DataFrame,
    tiers: DataFrame,
    history_override: date | None = None,
) -> dict[tuple[str, str, str], tuple[DataFrame, DataFrame]]:
    """All reports due on a day: (season, report, applicant type) to (totals, comparison).

    ``read_snapshot`` gives the snapshot of a semester and day, ``dates`` the
    days that have one (day, semester).  The one or two cycles and their
    history dates are looked up here, and each snapshot is read once into cells;
    every report is a lazy plan over the cells.  The unit report is due on
    Mondays, the spring report in July and August.
    """
    spark = dates.sparkSession
    today_lit = F.lit(run_date.isoformat()).cast("date")
    override = F.lit(history_override.isoformat()).cast("date") if history_override else None
    cycles = spark.range(1).select(F.explode(term_calendar(today_lit)).alias("c")).select("c.*").collect()
    due: dict[tuple[str, str, str], tuple[DataFrame, DataFrame]] = {}
    for cycle in cycles:
        found = nearest_history_date(
            dates, "day", today_lit, F.col("semester") == cycle.history_semester, override
        ).first()
        if found.history_date is None:
            raise ValueError(f"no snapshot of semester {cycle.history_semester} to compare with")
        today_day, history_day = run_date.isoformat(), found.history_date.isoformat()
        today = read_snapshot(cycle.semester, run_date)
        history = read_snapshot(cycle.history_semester, found.history_date)
        terms, history_terms, unit_due = list(cycle.terms), list(cycle.history_terms), run_date.weekday() == 0
        spring_term = f"2{(run_date.year + 1) % 100:02d}1" if run_date.month in (7, 8) else None
        if spring_term:
            today, history = (_narrow(s, spring_term, [*terms, *history_terms]) for s in (today, history))
        rows = with_tiers(combined_snapshots(today, history, today_day, history_day, terms, history_terms), res_codes, tiers)
        cells = saved(day_cells(rows, unit_due))
        for applicant_type in fv.ADMISSION_TYPES:
            kinds: list[tuple[str, list[str], Column | None]] = [
                ("students", fv.ADMISSION_CLASSES, None), ("countries", ["country"], None)
            ]
            if unit_due:
                kinds.append(("unit", fv.UNIT_CLASSES, F.col("in_unit")))
            for kind, class_vars, extra in kinds:
                due[cycle.season, kind, applicant_type] = admission_report(
                    cells, applicant_type, today_day, history_day, class_vars, extra
                )
        if spring_term:
            spring_cells = saved(day_cells(spring_connect(rows, today, spring_term), False))
            due[cycle.season, "spring", fv.SPRING_CONNECT] = admission_report(
                spring_cells, fv.SPRING_CONNECT, today_day, history_day
            )
    return due
