"""Session merge: two session snapshots into one status per student and six program slots.

Merge, enrich, derive, resolve and settle are one DataFrame pipeline; slots
travel as an array of structs.  Checks and the file are separate functions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom import fixed_values as fv
from cohortloom.functions.missing import first_nonblank, null_sum, present
from cohortloom.functions.scalars import band_ladder, char_from_end, code_normalise, decode, resolve_standing
from cohortloom.operators import checks
from cohortloom.operators.joins import effective_dated_join, match_merge, theta_flag
from cohortloom.operators.reports import crosstab_counts, crosstab_full
from cohortloom.operators.rows import duplicate_counts
from cohortloom.operators.slots import SLOT_FIELDS, slots_explode, slots_keep_newest, slots_pack, slots_resolve
from cohortloom.session import saved
from cohortloom.sources.sinks import enrollment_lines, fixed_width_write, table_persist


@dataclass
class SessionRun:
    """Parameters of one run: the two terms, dates as YYYYMMDD text, and the term's label."""

    first_term: str
    second_term: str
    term_start: str
    first_term_end: str
    run_date: str
    label: str


def merged(first: DataFrame, second: DataFrame) -> DataFrame:
    """Both snapshots by student, the second overlaying the first, original loads kept beside."""
    packed = [slots_pack(df) for df in (first, second)]
    orders = [[c for c in df.columns if c != "emplid"] for df in packed]
    whole = match_merge(packed[0], packed[1], ["emplid"], *orders, suffixes=("_sum1", "_sum2"))
    both = ["academic_load_nslc", "status_dt_nslc"]
    unused = [c for c in whole.columns if c.endswith(("_sum1", "_sum2")) and c[:-5] not in both]
    return whole.drop("row_in_key", "in_a", "in_b", *unused)


def enriched(students: DataFrame, loads: DataFrame, plans: DataFrame, checkouts: DataFrame, plan_table: DataFrame, run: SessionRun) -> DataFrame:
    """One row per student and plan with hours, audit units, program status and plan code."""
    career = first_nonblank("career_sum1", "career_sum2")

    def session(term, suffix):
        enrolled = (F.col("unt_taken_prgrss") >= 1) | (F.col("unt_audit") >= 1)
        return loads.filter((F.col("strm") == term) & enrolled).select(
            "emplid",
            *[
                F.col(c).alias(f"{alias}_{suffix}")
                for c, alias in [
                    ("acad_career", "career"), ("unt_taken_prgrss", "hours"), ("unt_audit", "unt_audit"),
                    ("academic_load", "academic_load"), ("fa_load", "fa_load"),
                ]
            ],
        )

    df = students.join(session(run.first_term, "sum1"), "emplid", "left").join(
        session(run.second_term, "sum2"), "emplid", "left"
    )
    df = df.withColumns(
        {
            "acad_career": career,
            "summer_hours": null_sum("hours_sum1", "hours_sum2"),
            "total_audit": null_sum("unt_audit_sum1", "unt_audit_sum2"),
        }
    ).drop("career_sum1", "career_sum2", "hours_sum1", "hours_sum2")
    status = plans.select("emplid", "acad_career", "acad_plan", "prog_status", F.col("completion_term").alias("status_strm"))
    df = df.join(status, ["emplid", "acad_career"], "left")
    approved = checkouts.filter(
        F.col("strm").isin(run.first_term, run.second_term)
        & (F.col("acad_plan_type") == fv.SESSION_PLAN_TYPE)
        & (F.col("nc_degr_ckout_stat") == fv.CHECKOUT_APPROVED)
    ).select("emplid", "acad_plan", "acad_career", "nc_degr_ckout_stat", F.col("strm").alias("grad_strm"))
    df = df.join(approved, ["emplid", "acad_plan", "acad_career"], "left")
    codes = plan_table.select("institution", "acad_plan", "effdt", "cip_code")
    df = effective_dated_join(
        df, codes, ["acad_plan"], "effdt", F.to_date(F.lit(run.run_date), "yyyyMMdd"), keys=["institution", "acad_plan"]
    )
    level = decode(char_from_end("acad_plan"), fv.CREDENTIAL_LEVEL, fv.CREDENTIAL_LEVEL_DEFAULT)
    return df.withColumns({"cip_code_sis": code_normalise("cip_code"), "crd_lvl_sis": level}).drop("effdt", "cip_code")


def derived(rows: DataFrame, run: SessionRun) -> DataFrame:
    """Standing per row (``raw_standing`` is missing where a review may be due), dates filled."""
    raw = band_ladder("summer_hours", "acad_career", "academic_load_nslc")
    return rows.withColumn("raw_standing", raw).withColumns(
        {
            "summer_hours": F.coalesce("summer_hours", F.lit(0.0)),
            "acad_summer_standing": resolve_standing("raw_standing"),
            "academic_load_nslc": resolve_standing("raw_standing"),
            "begin_dt": F.lit(run.term_start),
            "status_dt_nslc": F.coalesce("status_dt_nslc", F.lit(run.run_date)),
        }
    )


def resolved(rows: DataFrame, run: SessionRun) -> DataFrame:
    """One row per student; order inside a student is plan, then status term, then institution."""
    rows = rows.withColumn("_grad", F.coalesce("grad_strm", F.lit("")))
    students = slots_resolve(
        rows, ["emplid"], ["acad_plan", "status_strm", "_grad", "institution"], "academic_load_nslc", [run.first_term],
        run.term_start, run.first_term_end,
    ).drop("_grad", "cip_code_sis", "crd_lvl_sis", "institution", "raw_standing")
    first_code = F.get(F.col("slots"), 0)["cipcode"]
    return students.filter(~F.col("program_indicator").eqNullSafe("Y") | present(first_code))


def settled(students: DataFrame, first: DataFrame) -> DataFrame:
    """Students whose withdrawn slot was overwritten get equal programs merged into one slot."""
    before = slots_explode(
        slots_pack(first).select("emplid", "slots"), lambda s: s["prg_stat"] == fv.WITHDRAWN
    ).select("emplid", "slot")
    marks = [F.col("slot") == k for k in range(1, fv.SLOT_COUNT + 1)]

    def changed(k) -> Column:
        status = F.get(F.col("slots"), k)["prg_stat"]
        return ~status.eqNullSafe(fv.WITHDRAWN) & ~status.eqNullSafe(fv.GRADUATED)

    flagged = theta_flag(students, before, ["emplid"], marks, [changed(k) for k in range(fv.SLOT_COUNT)], "w_comp")
    merged_slots = slots_keep_newest("slots", ["cipcode", "crd_lvl", "prog_len"], "prg_start", SLOT_FIELDS)
    return flagged.withColumn("slots", F.when(F.col("w_comp") == "Y", merged_slots).otherwise(F.col("slots")))


def combine_sessions(
    first: DataFrame, second: DataFrame, loads: DataFrame, plans: DataFrame, checkouts: DataFrame,
    plan_table: DataFrame, run: SessionRun,
) -> tuple[DataFrame, DataFrame]:
    """(combined records, rows for review)."""
    rows = saved(derived(enriched(merged(first, second), loads, plans, checkouts, plan_table, run), run))
    review = checks.check_review_rows(rows, "raw_standing", "total_audit").drop("slots")
    return settled(resolved(rows, run), first), review


def session_checks(combined: DataFrame, review: DataFrame, first: DataFrame, registration: DataFrame, run: SessionRun) -> DataFrame:
    """(check, violations) for the reviews that must come out empty."""
    from_first = slots_explode(
        slots_pack(first).select("emplid", "slots"), lambda s: s["prg_stat"] == fv.WITHDRAWN
    ).select("emplid", "slot", F.col("prg_stat").alias("before"))
    after = slots_explode(combined.select("emplid", "slots")).select("emplid", "slot", F.col("prg_stat").alias("after"))
    conflict = checks.check_status_conflict(
        combined.select("emplid", "academic_load_nslc"),
        registration.filter(F.col("strm").isin(run.first_term, run.second_term)).select("emplid", "strm", "nc_reg_status"),
        ["emplid"],
        F.col("academic_load_nslc") == fv.WITHDRAWN,
        F.col("nc_reg_status") == "1",
    )
    return checks.violations(
        {
            "review_not_withdrawn": review.filter(~F.col("academic_load_nslc_sum1").eqNullSafe(fv.WITHDRAWN)),
            "status_conflict": conflict,
            "overwritten_status": checks.check_overwritten_status(from_first, after, ["emplid", "slot"], [("before", "after")]),
            "duplicate_students": duplicate_counts(combined, ["emplid"]),
        }
    )


def session_job(
    first: DataFrame, second: DataFrame, loads: DataFrame, plans: DataFrame, checkouts: DataFrame,
    plan_table: DataFrame, registration: DataFrame, run: SessionRun, folder: str,
) -> tuple[DataFrame, DataFrame, dict[str, DataFrame]]:
    """The whole job: saves the combined records, writes the file; returns records, checks and cross tabulations."""
    combined, review = combine_sessions(first, second, loads, plans, checkouts, plan_table, run)
    kept = table_persist(combined, f"{folder}/combined")
    fixed_width_write(enrollment_lines(kept, run.label, run.run_date), f"{folder}/enrollment")
    tables = {
        "standing_by_career": crosstab_full(kept, "acad_summer_standing", "acad_career"),
        "date_by_standing": crosstab_counts(kept, "status_dt_nslc", "acad_summer_standing"),
        "indicator_by_date": crosstab_counts(kept, "program_indicator", "status_dt_nslc"),
    }
    return kept, session_checks(kept, review, first, registration, run), tables
