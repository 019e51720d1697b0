"""Graduate tables: a wide fact table per graduate and plan, and course-level detail.

Lookups that only answer yes or no are reduced to distinct keys before they are
joined, so they cannot multiply rows; the final distinct makes both forms equal.
"""

from __future__ import annotations

from dataclasses import dataclass, fields, replace

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom import fixed_values as fv
from cohortloom.functions.missing import not_equal, null_sum, placeholder_key, presence_flag, present, three_way_flag
from cohortloom.functions.scalars import decode, prefix_flag, starts_with, year_from_term
from cohortloom.operators import checks
from cohortloom.operators.joins import (
    asof_term_join,
    crosswalk_join,
    latest_active,
    latest_then_status,
    null_matching_join,
    other_row_exists,
)
from cohortloom.operators.rows import keep_or_last, random_surrogate_id, running_flag
from cohortloom.operators.setops import typed_union
from cohortloom.operators.spread import hot_keys, join_back, split_hot
from cohortloom.session import saved
from cohortloom.sources.sinks import csv_write, sheet_write, table_persist


STUDENT_ROWS = 100_000  # that one student's row may gather


@dataclass
class GraduateTables:
    """The source tables, columns as the functions below use them."""

    graduation_plans: DataFrame
    demographics: DataFrame
    plan_codes: DataFrame
    term_enrollment: DataFrame
    term_totals: DataFrame
    degree_totals: DataFrame
    transfer_schools: DataFrame
    colleges: DataFrame
    external_degrees: DataFrame
    agreements: DataFrame
    aid: DataFrame
    transfer_courses: DataFrame
    audit_courses: DataFrame
    term_programs: DataFrame
    requirements: DataFrame
    admissions: DataFrame


FACT_COLUMNS = [
    "emplid", "acad_career", "acad_prog", "acad_plan", "primary_plan", "nc_gender", "birthdate", "ethnicity",
    "tuition_res", "cip_code", "cum_gpa", "min_units_reqd", "tot_attempted", "tot_completed", "completion_term",
    "ncccs", "transfer", "new_freshmen", "trnsfr_school", "ext_org_id", "ls_school_type", "nccc_transfer_accept",
    "tot_transfer_accept", "credits_towards_degree", "trf_towards_degree", "excess_attempted", "excess_earned",
    "caa_met", "degree", "degree_descr", "degree_field", "pell_eligibility", "nccc_dev_ed", "multiple_plan",
]

COURSE_SCHEMA = T.StructType(
    [
        T.StructField(name, T.DoubleType() if name in ("unt_taken", "unt_trnsfr") else T.StringType())
        for name in (
            "emplid", "acad_plan", "school", "home_subject", "home_nbr", "comp_subject_area", "nccc_dev_ed",
            "transfer_credit", "articulation_term", "unt_taken", "unt_trnsfr", "reject_reason_code", "reject_reason",
            "counts_toward_degree",
        )
    ]
)


def _graduates(t: GraduateTables) -> DataFrame:
    return t.graduation_plans.filter(
        F.col("completion_term").between(*fv.GRADUATE_TERMS)
        & F.col("nc_degr_ckout_stat").isin(fv.GRADUATE_CHECKOUTS)
        & (F.col("acad_plan_type") == fv.GRADUATE_PLAN_TYPE)
        & (F.col("acad_career") == fv.GRADUATE_CAREER)
        & not_equal("acad_plan", fv.GRADUATE_EXCLUDED_PLAN)
    ).select("emplid", "acad_career", "acad_prog", "acad_plan", "completion_term")


def _finished(df: DataFrame) -> DataFrame:
    """The fact columns from the joined ones."""
    at_college = F.col("college_id").isNotNull()
    return df.select(
        "*",
        F.when(F.col("acad_plan").eqNullSafe(F.col("enrolled_plan")), "Y").otherwise("N").alias("primary_plan"),
        decode("nc_ipeds_summary", fv.ETHNICITY, fv.ETHNICITY_DEFAULT).alias("ethnicity"),
        null_sum("tot_taken_gpa", "tot_taken_nogpa").alias("tot_attempted"),
        F.col("tot_cumulative").alias("tot_completed"),
        presence_flag("college_id").alias("ncccs"),
        F.when(present("ext_org_id"), "Y").otherwise("N").alias("transfer"),
        presence_flag("freshman").alias("new_freshmen"),
        F.when(at_college, null_sum("trf_taken_nogpa", "trf_taken_gpa")).alias("nccc_transfer_accept"),
        null_sum("nc_unt_nondgr_trns", "nc_unt_dgr_trns").alias("tot_transfer_accept"),
        F.col("nc_unt_dgr_tot").alias("credits_towards_degree"),
        F.col("nc_unt_dgr_trns").alias("trf_towards_degree"),
        (F.col("tot_taken_prgrss") - F.col("nc_unt_dgr_tot")).alias("excess_attempted"),
        (F.col("tot_cumulative") - F.col("nc_unt_dgr_tot")).alias("excess_earned"),
        three_way_flag(F.coalesce("remedial", F.lit(False)), at_college).alias("nccc_dev_ed"),
    ).select(*FACT_COLUMNS).distinct()


def _fact_by_joins(t: GraduateTables) -> DataFrame:
    """The fact table by one join after the other, all of which can be split where a student has very many rows."""
    grads = _graduates(t)
    df = grads.join(t.demographics.select("emplid", "nc_gender", "birthdate", "nc_ipeds_summary", "tuition_res"), "emplid", "left")
    codes = t.plan_codes.select("acad_plan", "effdt", "eff_status", "cip_code")
    df = latest_then_status(df, codes, ["acad_plan"], "effdt", F.col("eff_status") == "A").drop("effdt", "eff_status")

    enrolled = t.term_enrollment.select("emplid", "acad_career", "strm", F.col("acad_plan").alias("enrolled_plan"))
    df = asof_term_join(df, enrolled, ["emplid", "acad_career"], "completion_term", "strm").withColumnRenamed(
        "matched_term", "strm"
    )
    totals = t.term_totals.select(
        "emplid", "acad_career", "strm", "cum_gpa", "tot_taken_gpa", "tot_taken_nogpa", "tot_cumulative", "tot_taken_prgrss"
    )
    df = df.join(totals, ["emplid", "acad_career", "strm"], "left")
    credits = t.degree_totals.select("emplid", "acad_plan", "nc_unt_nondgr_trns", "nc_unt_dgr_trns", "nc_unt_dgr_tot")
    df = df.join(credits, ["emplid", "acad_plan"], "left")

    schools = t.transfer_schools.filter(
        not_equal("src_institution", fv.HOME_INSTITUTION) & not_equal("ls_school_type", fv.NO_SCHOOL_TYPE)
    ).select("emplid", "ext_org_id", "ls_school_type", "trf_taken_gpa", "trf_taken_nogpa")
    df = df.join(schools, "emplid", "left")
    colleges = t.colleges.select(F.col("ext_org_id").alias("college_id"), F.col("descr").alias("trnsfr_school"))
    df = df.join(colleges, F.col("ext_org_id") == F.col("college_id"), "left")

    degrees = t.external_degrees.select(
        "emplid", F.col("ext_org_id").alias("college_id"), "degree", F.col("descr").alias("degree_descr"),
        F.col("field_of_study_1").alias("degree_field"),
    ).distinct()
    df = null_matching_join(df, degrees, ["emplid", "college_id"])
    met = t.agreements.filter(F.col("nc_ext_agreement") == fv.AGREEMENT_MET).select(
        "emplid", F.col("ext_org_id").alias("college_id"), F.col("nc_ext_agreement").alias("caa_met")
    ).distinct()
    df = null_matching_join(df, met, ["emplid", "college_id"])
    aid = t.aid.select("emplid", "aid_year", "pell_eligibility").distinct()
    df = join_back(df.withColumn("aid_year", year_from_term("completion_term")), aid, ["emplid", "aid_year"])
    remedial = t.transfer_courses.filter(F.col("course_level") == fv.REMEDIAL_LEVEL).select(
        "emplid", F.col("trnsfr_src_id").alias("college_id"), F.lit(True).alias("remedial")
    ).distinct()
    df = null_matching_join(df, remedial, ["emplid", "college_id"])

    programs = t.term_programs.filter(not_equal("acad_plan_type", fv.MINOR_PLAN_TYPE)).select(
        "emplid", "strm", "acad_plan", "acad_sub_plan"
    )
    df = other_row_exists(df, programs, ["emplid", "strm"], "acad_plan", F.lit(True), "multiple_plan")
    freshmen = t.admissions.filter(
        (F.col("nc_hist_type") == fv.HISTORY_TYPE)
        & F.col("admit_type").isin(fv.FRESHMAN_ADMITS)
        & (F.col("nc_enrolled") == "Y")
    ).select("emplid", F.lit(True).alias("freshman")).distinct()
    df = join_back(df, freshmen, ["emplid"])

    sub_plans = programs.withColumn("sub_plan", placeholder_key("acad_sub_plan", fv.NO_SUB_PLAN)).select(
        "emplid", "strm", "acad_plan", "sub_plan"
    ).distinct()
    df = join_back(df, sub_plans, ["emplid", "strm", "acad_plan"])
    required = t.requirements.filter(F.col("rqrmnt_list_seq") == fv.REQUIREMENT_SEQUENCE).select(
        "acad_plan", F.col("acad_sub_plan").alias("sub_plan"), "eff_status", "effdt", "min_units_reqd"
    )
    df = latest_active(df, required, ["acad_plan", "sub_plan"], "effdt", F.col("eff_status") == "A")

    return _finished(df)


def _student_tables(t: GraduateTables) -> dict[str, DataFrame]:
    """The rows every student brings to the fact, by name; (emplid, other columns).

    Where a missing emplid matches nothing, such rows are left out.
    """
    colleges = t.colleges.select(F.col("ext_org_id").alias("college_id"), F.col("descr").alias("trnsfr_school"))
    schools = t.transfer_schools.filter(
        present("emplid") & not_equal("src_institution", fv.HOME_INSTITUTION) & not_equal("ls_school_type", fv.NO_SCHOOL_TYPE)
    ).select("emplid", "ext_org_id", "ls_school_type", "trf_taken_gpa", "trf_taken_nogpa")
    return {
        "plans": _graduates(t),
        "people": t.demographics.filter("emplid IS NOT NULL").select("emplid", "nc_gender", "birthdate", "nc_ipeds_summary", "tuition_res"),
        "enrolled": t.term_enrollment.select("emplid", "acad_career", "strm", F.col("acad_plan").alias("enrolled_plan")),
        "totals": t.term_totals.filter("emplid IS NOT NULL").select(
            "emplid", "acad_career", "strm", "cum_gpa", "tot_taken_gpa", "tot_taken_nogpa", "tot_cumulative", "tot_taken_prgrss"
        ),
        "credits": t.degree_totals.filter("emplid IS NOT NULL").select("emplid", "acad_plan", "nc_unt_nondgr_trns", "nc_unt_dgr_trns", "nc_unt_dgr_tot"),
        "schools": schools.join(colleges, F.col("ext_org_id") == F.col("college_id"), "left"),
        "degrees": t.external_degrees.select(
            "emplid", F.col("ext_org_id").alias("of_college"), "degree", F.col("descr").alias("degree_descr"),
            F.col("field_of_study_1").alias("degree_field"),
        ),
        "met": t.agreements.filter(F.col("nc_ext_agreement") == fv.AGREEMENT_MET).select("emplid", F.col("ext_org_id").alias("of_college")),
        "aid": t.aid.select("emplid", "aid_year", "pell_eligibility"),
        "remedials": t.transfer_courses.filter(F.col("course_level") == fv.REMEDIAL_LEVEL).select("emplid", F.col("trnsfr_src_id").alias("of_college")),
        "programs": t.term_programs.filter(not_equal("acad_plan_type", fv.MINOR_PLAN_TYPE)).select(
            "emplid", "strm", F.col("acad_plan").alias("of_plan"), placeholder_key("acad_sub_plan", fv.NO_SUB_PLAN).alias("sub_plan")
        ),
        "freshmen": t.admissions.filter(
            (F.col("nc_hist_type") == fv.HISTORY_TYPE) & F.col("admit_type").isin(fv.FRESHMAN_ADMITS) & (F.col("nc_enrolled") == "Y")
        ).select("emplid", F.lit(True).alias("freshman")),
    }


def _latest_codes(dated: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of the greatest effdt of every key, ties kept; one shuffle, limited before it."""
    newest = F.rank().over(Window.partitionBy(*keys).orderBy(F.col("effdt").desc_nulls_last()))
    return dated.withColumn("_newest", newest).filter("_newest = 1").drop("_newest", "effdt")


def _fact_by_student(tables: dict[str, DataFrame], t: GraduateTables) -> DataFrame:
    """The fact table from one row per student, gathered by one union and aggregate.

    All lookups within a student are functions of its arrays, the lists that
    multiply rows are opened last, and code tables are joined by Spark's own
    choice; the partitioning by student holds to the last distinct.
    """
    stacked = None
    for name, df in tables.items():
        tagged = df.select("emplid", F.struct(*[c for c in df.columns if c != "emplid"]).alias(name))
        stacked = tagged if stacked is None else stacked.unionByName(tagged, allowMissingColumns=True)
    students = stacked.groupBy("emplid").agg(*[F.collect_set(name).alias(name) for name in tables])
    df = students.filter(F.size("plans") > 0).withColumn("plan", F.explode("plans")).select("emplid", "plan.*", *[n for n in tables if n != "plans"])

    def same(name: str, *pairs: tuple[str, str]) -> F.Column:
        """The entries of a list whose fields equal columns, missing equal to missing."""

        def matches(e):
            found = F.lit(True)
            for inner, outer in pairs:
                found = found & e[inner].eqNullSafe(F.col(outer))
            return found

        return F.filter(name, matches)

    def before(e):
        return e["acad_career"].eqNullSafe(F.col("acad_career")) & (e["strm"] <= F.col("completion_term"))

    df = df.withColumn("strm", F.array_max(F.transform(F.filter("enrolled", before), lambda e: e["strm"])))
    differs = F.exists(
        same("programs", ("strm", "strm")),
        lambda e: F.coalesce(e["of_plan"].cast("string"), F.lit("")) != F.coalesce(F.col("acad_plan").cast("string"), F.lit("")),
    )
    now = F.col("strm").isNotNull()
    df = df.withColumns(
        {
            "aid_year": year_from_term("completion_term"),
            "enrolled": F.array_distinct(F.transform(F.filter("enrolled", lambda e: now & e["acad_career"].eqNullSafe(F.col("acad_career")) & (e["strm"] == F.col("strm"))), lambda e: e["enrolled_plan"])),
            "totals": F.filter("totals", lambda e: (e["acad_career"] == F.col("acad_career")) & (e["strm"] == F.col("strm"))),
            "credits": F.filter("credits", lambda e: e["acad_plan"] == F.col("acad_plan")),
            "multiple_plan": F.when(differs, "Y").otherwise("N"),
            "freshman": F.when(F.size("freshmen") > 0, F.lit(True)),
            "sub_plans": F.array_distinct(F.transform(same("programs", ("strm", "strm"), ("of_plan", "acad_plan")), lambda e: e["sub_plan"])),
        }
    ).withColumn("aid", F.array_distinct(F.transform(same("aid", ("aid_year", "aid_year")), lambda e: e["pell_eligibility"])))
    lists = ["degrees", "met", "remedials"]
    row = ["emplid", "acad_career", "acad_prog", "acad_plan", "completion_term", "strm", "multiple_plan", "freshman"]
    for name, fields in (
        ("people", ["nc_gender", "birthdate", "nc_ipeds_summary", "tuition_res"]),
        ("totals", ["cum_gpa", "tot_taken_gpa", "tot_taken_nogpa", "tot_cumulative", "tot_taken_prgrss"]),
        ("credits", ["nc_unt_nondgr_trns", "nc_unt_dgr_trns", "nc_unt_dgr_tot"]),
        ("enrolled", ["enrolled_plan"]), ("aid", ["pell_eligibility"]), ("sub_plans", ["sub_plan"]),
        ("schools", ["ext_org_id", "ls_school_type", "trf_taken_gpa", "trf_taken_nogpa", "college_id", "trnsfr_school"]),
    ):
        df = df.withColumn("_one", F.explode_outer(name))
        opened = {f: F.col(f"_one.{f}") if len(fields) > 1 else F.col("_one") for f in fields}
        df = df.withColumns(opened).drop("_one", name)
        row += fields
    df = df.withColumns({"caa_met": F.when(F.size(same("met", ("of_college", "college_id"))) > 0, fv.AGREEMENT_MET), "remedial": F.size(same("remedials", ("of_college", "college_id"))) > 0})
    df = df.withColumn("_degree", F.explode_outer(same("degrees", ("of_college", "college_id")))).select(
        *row, "caa_met", "remedial", "_degree.degree", "_degree.degree_descr", "_degree.degree_field"
    )
    codes = _latest_codes(t.plan_codes.select("acad_plan", "effdt", "eff_status", "cip_code"), ["acad_plan"]).filter("eff_status = 'A'").drop("eff_status")
    required = t.requirements.filter((F.col("rqrmnt_list_seq") == fv.REQUIREMENT_SEQUENCE) & (F.col("eff_status") == "A")).select(
        "acad_plan", F.col("acad_sub_plan").alias("sub_plan"), "effdt", "min_units_reqd"
    )
    return _finished(df.join(codes, "acad_plan", "left").join(_latest_codes(required, ["acad_plan", "sub_plan"]), ["acad_plan", "sub_plan"], "left"))


def graduate_fact(t: GraduateTables, student_rows: int = STUDENT_ROWS) -> DataFrame:
    """One distinct row per graduate, plan, transfer school, degree, aid and requirement.

    Students with more than ``student_rows`` rows in the tables, if any, are
    joined table by table; all others are worked out from one row each.
    """
    tables = _student_tables(t)
    keys = None
    for df in tables.values():
        keys = df.select("emplid") if keys is None else keys.unionByName(df.select("emplid"))
    hot = hot_keys(["emplid"], student_rows, keys)
    if hot is None:
        return _fact_by_student(tables, t)
    cold = {name: split_hot(df, hot, ["emplid"])[1] for name, df in tables.items()}
    by_student = {f.name: getattr(t, f.name) for f in fields(t) if "emplid" in getattr(t, f.name).columns}
    large = replace(t, **{name: split_hot(df, hot, ["emplid"])[0] for name, df in by_student.items()})
    return _fact_by_student(cold, t).unionByName(_fact_by_joins(large))


def overview(fact: DataFrame) -> DataFrame:
    """Running community-college flag per student; rows with a school, or the plan's last row.

    Reads ``fact`` several times: pass the saved table, not the join itself.
    """
    rows = fact.withColumn("_last_first", F.when(F.col("ncccs") == "Y", 0).otherwise(1))
    ties = [c for c in FACT_COLUMNS if c not in ("emplid", "acad_plan", "ncccs")]
    order = ["acad_plan", "_last_first", *ties]
    flagged = running_flag(rows, ["emplid"], order, F.col("ncccs") == "Y", "ncccs_transfer")
    kept = keep_or_last(flagged, ["emplid", "acad_plan"], ["_last_first", *ties], present("trnsfr_school"))
    return kept.drop("_last_first")


def course_detail(students: DataFrame, t: GraduateTables) -> DataFrame:
    """Transfer courses with their credit, and the courses taken here, as one distinct table."""
    keys = ["emplid", "acad_career", "acad_plan"]
    toward = F.when(F.col("rqrmnt_group").eqNullSafe(fv.NOT_COUNTED_GROUP), "N").otherwise("Y")
    audit = t.audit_courses.select(
        *keys, "crse_id", F.col("strm").alias("articulation_term"), F.col("subject").alias("home_subject"),
        F.col("catalog_nbr").alias("home_nbr"), "grade", "rqrmnt_group", "unt_other", "nc_xscriptdata_src",
    )
    credited = starts_with("grade", "T")

    transferred = students.filter(present("ext_org_id")).select(*keys, "ext_org_id", F.col("trnsfr_school").alias("school")).distinct()
    taken = t.transfer_courses.select(
        "emplid", F.col("trnsfr_src_id").alias("ext_org_id"), "crse_id", "articulation_term", "course_level",
        "comp_subject_area", "unt_taken", "unt_trnsfr", F.col("reject_reason").alias("reject_reason_code"),
    )
    elsewhere = (
        transferred.join(taken, ["emplid", "ext_org_id"])
        .join(audit.filter(credited).drop("unt_other", "nc_xscriptdata_src"), [*keys, "crse_id", "articulation_term"], "left")
        .withColumns(
            {
                "nccc_dev_ed": F.when(F.col("course_level").eqNullSafe(fv.REMEDIAL_LEVEL), "Y").otherwise("N"),
                "transfer_credit": prefix_flag("grade", "T"),
                "reject_reason": decode("reject_reason_code", fv.REJECT_REASON),
                "counts_toward_degree": toward,
            }
        )
    )
    own = audit.filter(
        ~credited & present("nc_xscriptdata_src") & not_equal("nc_xscriptdata_src", fv.REQUIREMENT_SOURCE)
    ).drop("articulation_term")
    here = (
        students.select(*keys).distinct().join(own, keys, "left")
        .withColumns(
            {"school": F.lit(fv.HOME_SCHOOL_LABEL), "unt_taken": F.col("unt_other"), "counts_toward_degree": toward}
        )
    )
    return typed_union([elsewhere, here], COURSE_SCHEMA)


def pseudonymised(rows: DataFrame, crosswalk: DataFrame, key: str = "emplid") -> DataFrame:
    """Rows with the saved surrogate id beside the key; exports drop the key."""
    return crosswalk_join(rows, crosswalk, key)


def graduate_checks(students: DataFrame, courses: DataFrame) -> DataFrame:
    """(check, violations): students without a credit total, accepted courses without a subject."""
    accepted = F.coalesce(F.col("unt_trnsfr") != 0, F.lit(False)) | F.col("school").eqNullSafe(fv.HOME_SCHOOL_LABEL)
    return checks.violations(
        {
            "missing_credit_total": checks.check_missing_credits(students, "credits_towards_degree"),
            "unmatched_courses": checks.check_unmatched_courses(courses, accepted, "home_subject"),
        }
    )


def graduate_job(t: GraduateTables, folder: str, seed: int | str, crosswalk: DataFrame | None = None) -> DataFrame:
    """The whole job: tables, crosswalk, internal exports with the id, public ones without; returns the checks.

    A saved ``crosswalk`` (emplid, obs) is used as it is; without one a new
    random numbering is drawn and saved below ``folder``.
    """
    view = saved(overview(saved(graduate_fact(t))))
    courses = saved(course_detail(view, t))
    if crosswalk is None:
        crosswalk = table_persist(random_surrogate_id(view, "emplid", seed), f"{folder}/crosswalk")
    tables = {"overview": pseudonymised(view, crosswalk), "courses": pseudonymised(courses, crosswalk)}
    sheet_write(tables, f"{folder}/internal")
    for name, df in tables.items():
        csv_write(df, f"{folder}/public/{name}", drop=["emplid"])
    return graduate_checks(view, courses)
