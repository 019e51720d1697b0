"""The jobs end to end on small fixtures with one case per rule."""

import datetime

import pytest
from pyspark.sql import functions as F

from cohortloom import fixed_values as fv
from cohortloom.functions.terms import term_calendar
from cohortloom.operators import classify
from cohortloom.operators.rows import random_surrogate_id
from cohortloom.operators.slots import SLOT_FIELDS
from cohortloom.plans import admissions, applicants, graduates, sessions
from cohortloom.session import freeze, saved
from cohortloom.sources import sinks


def table(spark, ddl, *rows):
    return spark.createDataFrame(list(rows), ddl)


def as_set(df, *columns):
    return {tuple(r[c] for c in columns) for r in df.collect()}


# ---- admission report ------------------------------------------------------

SNAPSHOT = (
    "emplid string, admit_term string, applicant_type string, apply int, admit int, will_enter int, spring_defer int, "
    "spring_def_we int, gender string, race string, res_st string, college string, acad_plan string, acad_sub_plan string, nc_tui_res_code string"
)


@pytest.fixture(scope="module")
def snapshots(spark):
    today = table(
        spark, SNAPSHOT,
        ("1", "2188", "Freshmen", 1, 1, 1, 0, 0, "F", "A", "NC", "CNR", "11X", None, "r1"),
        ("2", "2188", "Freshmen", 1, 0, 0, 1, 1, "M", "A", "NC", "ENG", "11X", None, "r2"),
        ("3", "2187", "Freshmen", 1, 1, 0, 0, 0, "M", None, "NC", "ENG", "11ENVSCBS", None, "r1"),
        ("4", "2188", "Other", 1, 1, 0, 0, 0, "M", "B", "NC", "ENG", "11X", None, "r1"),
        ("2", "2191", "Freshmen", 1, 1, 1, 0, 0, "M", "A", "NC", "ENG", "11X", None, "r2"),
    )
    history = table(
        spark, SNAPSHOT,
        ("9", "2178", "Freshmen", 1, 1, 0, 0, 0, "F", "B", "VA", "ENG", "11X", "14PSEI", "r9"),
        ("8", "2178", "Ext_Trans", 0, 0, 0, 0, 0, "F", "B", "VA", "ENG", "11X", None, "r9"),
    )
    res = table(spark, "nc_tui_res_code string, nc_tui_res_cd_dcr string", ("r1", "Wake"), ("r2", "Ash"))
    tiers = table(spark, "county string, tier_designation int", ("Wake", 3))
    both = admissions.combined_snapshots(
        today, history, "2018-07-01", "2017-07-02", ["2186", "2187", "2188"], ["2176", "2177", "2178"]
    )
    return today, admissions.with_tiers(both, res, tiers)


def test_admission_report(snapshots):
    _, rows = snapshots
    assert as_set(rows, "emplid", "day", "tier_designation") == {
        ("1", "2018-07-01", "Tier 3"), ("2", "2018-07-01", "Missing"), ("3", "2018-07-01", "Tier 3"),
        ("9", "2017-07-02", "Missing"), ("8", "2017-07-02", "Missing"),
    }
    totals, compared = admissions.admission_report(rows, "Freshmen", "2018-07-01", "2017-07-02")
    got = {(r.dim, r.level): r for r in totals.collect()}
    # Student 3 has no race and is left out of every total.
    assert (got["all", "Total"].apply, got["all", "Total"].acceptance_pct, got["all", "Total"].yield_pct) == (2, 50.0, 100.0)
    assert got["gender", "M"].yield_pct is None
    assert set(got) == {
        ("all", "Total"), ("gender", "F"), ("gender", "M"), ("race", "A"), ("res_st", "NC"), ("college", "CNR"), ("college", "ENG"),
        ("tier_designation", "Tier 3"), ("tier_designation", "Missing"),
    }
    both = {(r.dim, r.level): r for r in compared.collect()}
    assert (both["all", "Total"].apply_today, both["all", "Total"].apply_history) == (2, 1)
    assert (both["race", "B"].apply_today, both["race", "B"].apply_history) == (0, 1)


def test_unit_report_and_zero_applications(snapshots):
    _, rows = snapshots
    assert as_set(rows.filter(admissions.unit_condition()), "emplid") == {("1",), ("3",), ("9",)}
    totals, _ = admissions.admission_report(rows, "Ext_Trans", "2017-07-02", "2018-07-01")
    assert {r.acceptance_pct for r in totals.collect()} == {None}


def test_spring_connect_takes_both_branches(snapshots):
    today, rows = snapshots
    spring = admissions.spring_connect(rows, today, "2191")
    assert as_set(spring, "emplid", "applicant_type", "admit", "will_enter") == {("2", "Spring Connect", 1, 1)}
    later = today.withColumn("will_enter", F.when(F.col("admit_term") == "2191", 0).otherwise(F.col("will_enter")))
    assert as_set(admissions.spring_connect(rows, later, "2191"), "emplid", "will_enter") == {("2", 0), ("2", 1)}


def test_daily_reports(spark, snapshots):
    today, rows = snapshots
    today = today.withColumn("country", F.lit("USA"))
    read = {("2188", datetime.date(2018, 7, 2)): today, ("2178", datetime.date(2017, 7, 3)): today.withColumn("admit_term", F.lit("2178"))}
    dates = table(
        spark, "day date, semester string", (datetime.date(2017, 7, 1), "2178"), (datetime.date(2017, 7, 3), "2178"),
        (datetime.date(2017, 7, 2), "2171"), (datetime.date(2017, 9, 1), "2178"),
    )
    res = table(spark, "nc_tui_res_code string, nc_tui_res_cd_dcr string", ("r1", "Wake"))
    tiers = table(spark, "county string, tier_designation int", ("Wake", 3))
    due = admissions.daily_reports(datetime.date(2018, 7, 2), lambda semester, day: read[semester, day], dates, res, tiers)
    kinds = {(kind, of) for _, kind, of in due}
    assert {season for season, _, _ in due} == {"Fall"}
    assert kinds == {(k, t) for k in ("students", "countries", "unit") for t in fv.ADMISSION_TYPES} | {("spring", "Spring Connect")}
    totals, compared = due["Fall", "countries", "Freshmen"]
    assert {(r.dim, r.level, r.apply) for r in totals.collect()} == {("all", "Total", 3), ("country", "USA", 3)}
    assert {r.apply_history for r in compared.collect()} == {4}
    january = admissions.daily_reports(
        datetime.date(2018, 1, 2), lambda semester, day: today, table(spark, "day date, semester string", (datetime.date(2017, 1, 5), "2178"), (datetime.date(2017, 1, 9), "2171")), res, tiers
    )
    assert {season for season, _, _ in january} == {"Fall", "Spring"}
    with pytest.raises(ValueError):
        admissions.daily_reports(datetime.date(2018, 7, 2), lambda s, d: today, dates.limit(0), res, tiers)


def test_daily_reports_read_each_snapshot_once(spark, snapshots, tmp_path):
    today, _ = snapshots
    today = today.withColumn("country", F.when(F.col("emplid") != "1", F.lit("USA")))
    files = {("2188", datetime.date(2018, 7, 2)): today, ("2178", datetime.date(2017, 7, 3)): today.withColumn("admit_term", F.lit("2178"))}
    calls = []

    def read(semester, day):
        calls.append((semester, day))
        path = str(tmp_path / f"{semester}-{day}")
        files[semester, day].write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)

    dates = table(spark, "day date, semester string", (datetime.date(2017, 7, 3), "2178"))
    res = table(spark, "nc_tui_res_code string, nc_tui_res_cd_dcr string", ("r1", "Wake"))
    tiers = table(spark, "county string, tier_designation int", ("Wake", 3))
    due = admissions.daily_reports(datetime.date(2018, 7, 2), read, dates, res, tiers)
    assert sorted(calls) == sorted(files)
    cycle = spark.range(1).select(F.explode(term_calendar(F.lit("2018-07-02").cast("date"))).alias("c")).select("c.*").first()
    rows = admissions.with_tiers(
        admissions.combined_snapshots(files["2188", datetime.date(2018, 7, 2)], files["2178", datetime.date(2017, 7, 3)], "2018-07-02", "2017-07-03", list(cycle.terms), list(cycle.history_terms)),
        res, tiers,
    )
    plain = {"students": (fv.ADMISSION_CLASSES, None), "countries": (["country"], None), "unit": (fv.UNIT_CLASSES, admissions.unit_condition())}
    for (_, kind, applicant_type), (totals, compared) in due.items():
        assert not any(str(tmp_path) in f for df in (totals, compared) for f in df.inputFiles())  # cells only
        if kind == "spring":
            want = admissions.admission_report(admissions.spring_connect(rows, files["2188", datetime.date(2018, 7, 2)], "2191"), applicant_type, "2018-07-02", "2017-07-03")
        else:
            want = admissions.admission_report(rows, applicant_type, "2018-07-02", "2017-07-03", *plain[kind])
        for got, expected in zip((totals, compared), want):
            assert got.columns == expected.columns and sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))
    assert admissions.day_cells(rows.limit(0), True).count() == 0


# ---- session merge ---------------------------------------------------------

RUN = sessions.SessionRun("2186", "2187", "20180516", "20180731", "20180801", "Summer 2018")


def session_row(emplid, load, status_dt=None, indicator="Y", slots=()):
    row = {"emplid": emplid, "academic_load_nslc": load, "status_dt_nslc": status_dt, "program_indicator": indicator,
           "last_name": f"Name{emplid}", "end_dt": "20180630"}
    for i in range(1, 7):
        given = slots[i - 1] if i <= len(slots) else {}
        row |= {f"{f}{i}": given.get(f) for f in SLOT_FIELDS}
    return row


def session_frame(spark, *rows):
    ddl = ", ".join(f"{c} string" for c in rows[0])
    return spark.createDataFrame([tuple(r.values()) for r in rows], ddl)


def slot(code, level, status, start="20170816", length="4"):
    return {"cipcode": code, "crd_lvl": level, "prg_stat": status, "prg_start": start, "prog_len": length}


@pytest.fixture(scope="module")
def session_inputs(spark):
    first = session_frame(
        spark,
        session_row("1", "W", slots=[slot("140901", "03", "W")]),
        session_row("2", "H", slots=[slot("260101", "03", "W", "20160801"), slot("260101", "03", "F", "20180601")]),
        session_row("3", "F", slots=[slot("140901", "03", "F")]),
        session_row("4", "F", indicator="Y"),
    )
    second = session_frame(
        spark,
        session_row("3", "L", "20180701", slots=[slot("140901", "03", "H")]),
        session_row("5", "L", slots=[slot("140901", "05", "L")]),
        session_row("6", "F", indicator="N"),
    )
    loads = table(
        spark, "emplid string, strm string, acad_career string, unt_taken_prgrss double, unt_audit double, academic_load string, fa_load string",
        ("2", "2186", "UGRD", 6.0, None, "H", "H"), ("3", "2186", "UGRD", 6.0, None, "H", "H"), ("3", "2187", "UGRD", 6.0, None, "H", "H"),
        ("5", "2187", "GRAD", 6.75, None, "H", "H"), ("6", "2187", "GRAD", 0.0, 3.0, "L", "L"), ("5", "2186", "GRAD", 0.5, None, "L", "L"),
    )
    plans = table(
        spark, "emplid string, acad_career string, acad_plan string, prog_status string, completion_term string",
        ("2", "UGRD", "17BIOBS", "AC", None), ("3", "UGRD", "14CHEBS", "AC", None), ("5", "GRAD", "14CHEMS", "AC", None),
    )
    checkouts = table(
        spark, "emplid string, acad_plan string, acad_career string, strm string, acad_plan_type string, nc_degr_ckout_stat string",
        ("3", "14CHEBS", "UGRD", "2186", "MAJ", "AP"),
    )
    plan_table = table(
        spark, "institution string, acad_plan string, effdt date, cip_code string",
        ("NC", "17BIOBS", datetime.date(2000, 1, 1), "26.0101"), ("NC", "14CHEBS", datetime.date(2000, 1, 1), "14.0901"),
        ("NC", "14CHEBS", datetime.date(2030, 1, 1), "99.9999"), ("NC", "14CHEMS", datetime.date(2001, 1, 1), "14.0901"),
    )
    return first, second, loads, plans, checkouts, plan_table


@pytest.fixture(scope="module")
def combined(session_inputs):
    done, review = sessions.combine_sessions(*session_inputs, RUN)
    return session_inputs[0], freeze(done), review


def test_combined_records(combined):
    _, done, review = combined
    got = {r.emplid: r for r in done.collect()}
    # 4 has no code in slot 1 and the indicator Y.
    assert set(got) == {"1", "2", "3", "5", "6"}
    assert {k: r.academic_load_nslc for k, r in got.items()} == {"1": "W", "2": "H", "3": "F", "5": "L", "6": "L"}
    assert (got["3"].summer_hours, got["3"].academic_load_nslc_sum1, got["3"].academic_load_nslc_sum2) == (12.0, "F", "L")
    assert (got["3"].status_dt_nslc, got["1"].status_dt_nslc, got["1"].begin_dt) == ("20180701", "20180801", "20180516")
    # The active plan of 2 handed its withdrawn slot the load; the newer equal program moved to slot 1.
    assert (got["2"].w_comp, got["2"].slots[0].prg_start, got["2"].slots[0].prg_stat, got["2"].slots[1].cipcode) == ("Y", "20180601", "H", None)
    assert (got["2"].slots[0].p_stat_dt, got["3"].slots[0].p_stat_dt) == ("20180601", "20180516")
    # 4 and 5 fall in no band and have no audit units; 6 has audit units only.
    assert as_set(review, "emplid") == {("4",), ("5",)}


def test_session_checks(spark, combined):
    first, done, review = combined
    registration = table(
        spark, "emplid string, strm string, nc_reg_status string", ("1", "2187", "1"), ("1", "2181", "1"), ("2", "2187", "1")
    )
    found = {r["check"]: r.violations for r in sessions.session_checks(done, review, first, registration, RUN).collect()}
    assert found == {"review_not_withdrawn": 2, "status_conflict": 1, "overwritten_status": 1, "duplicate_students": 0}


def test_session_job(spark, session_inputs, tmp_path):
    registration = table(spark, "emplid string, strm string, nc_reg_status string", ("9", "2187", "1"))
    kept, found, tables = sessions.session_job(*session_inputs, registration, RUN, str(tmp_path))
    assert kept.count() == 5
    assert {r["check"]: r.violations for r in found.collect()}["status_conflict"] == 0
    # Two students have no career and are left out of the two-way table.
    assert sum(r.n for r in tables["standing_by_career"].collect()) == kept.dropna(subset=["acad_career"]).count()
    assert spark.read.text(str(tmp_path / "enrollment")).count() == 7


def test_session_file(spark, combined, tmp_path):
    _, done, _ = combined
    path = str(tmp_path / "file")
    sinks.fixed_width_write(sinks.enrollment_lines(done, RUN.label, RUN.run_date), path)
    lines = [line for part in sorted((tmp_path / "file").glob("part-*")) for line in part.read_text().splitlines()]
    assert lines[0] == "A300297200Summer 2018    N20180801F"
    assert [line[:2] for line in lines] == ["A3"] + ["D1"] * 5 + ["T1"]
    assert {len(line) for line in lines[1:-1]} == {fv.DETAIL_LENGTH}
    assert [line[419:420] for line in lines[1:-1]] == ["1", "2", "3", "5", "6"]
    second = lines[2]
    assert (second[32:52].rstrip(), second[86], second[87:95], second[217:225]) == ("Name2", "H", "20180801", "20180516")
    assert (second[674:680], second[684:686], second[699:707], second[708], second[709:717]) == ("260101", "03", "20180601", "H", "20180601")
    assert lines[-1] == "T1" + "000001" + "000000" + "000001" + "000002" + "000001" + "000000" * 4 + "00000007"


def test_empty_file_has_header_and_trailer(spark, combined):
    _, done, _ = combined
    lines = [r.line for r in sinks.enrollment_lines(done.limit(0), "X", "20180801").collect()]
    assert len(lines) == 2 and lines[1] == "T1" + "0" * 54 + "00000002"


# ---- graduates -------------------------------------------------------------


@pytest.fixture(scope="module")
def grad_tables(spark):
    def t(ddl, *rows):
        return table(spark, ", ".join(f"{c} string" if " " not in c else c for c in ddl.split(", ")), *rows)

    return graduates.GraduateTables(
        graduation_plans=t(
            "emplid, acad_career, acad_prog, acad_plan, acad_plan_type, completion_term, nc_degr_ckout_stat",
            ("1", "UGRD", "ENG", "14CHEBS", "MAJ", "2111", "AP"), ("2", "UGRD", "ENG", "14CHEBS", "MAJ", "2187", "CC"),
            ("3", "UGRD", "ENG", "14CHEBS", "MAJ", "2108", "AP"), ("4", "UGRD", "ENG", "14BMJBS", "MAJ", "2151", "AP"),
            ("5", "GRAD", "ENG", "14CHEMS", "MAJ", "2151", "AP"), ("6", "UGRD", "ENG", "17BIOBS", "MAJ", "2151", "XX"),
        ),
        demographics=t("emplid, nc_gender, birthdate, nc_ipeds_summary, tuition_res", ("1", "F", "x", "8", "R"), ("2", "M", "y", "9", "N")),
        plan_codes=t(
            "acad_plan, effdt int, eff_status, cip_code", ("14CHEBS", 1, "A", "14.0701"), ("14CHEBS", 2, "I", "14.0702")
        ),
        term_enrollment=t(
            "emplid, acad_career, strm, acad_plan",
            ("1", "UGRD", "2108", "14CHEBS"), ("1", "UGRD", "2118", "17BIOBS"), ("2", "UGRD", "2181", "14CHEBS"), ("2", "UGRD", "2181", "17BIOBS"),
        ),
        term_totals=t(
            "emplid, acad_career, strm, cum_gpa double, tot_taken_gpa double, tot_taken_nogpa double, tot_cumulative double, tot_taken_prgrss double",
            ("1", "UGRD", "2108", 3.5, 100.0, None, 120.0, 125.0),
        ),
        degree_totals=t("emplid, acad_plan, nc_unt_nondgr_trns double, nc_unt_dgr_trns double, nc_unt_dgr_tot double", ("1", "14CHEBS", None, 30.0, 118.0)),
        transfer_schools=t(
            "emplid, ext_org_id, src_institution, ls_school_type, trf_taken_gpa double, trf_taken_nogpa double",
            ("1", "CC1", None, None, 10.0, None), ("1", "U9", "X", "CC", 3.0, None), ("1", "HOME", "NCSU1", "CC", 1.0, 1.0), ("1", "NAT", "X", "NA", 1.0, 1.0),
        ),
        colleges=t("ext_org_id, descr", ("CC1", "First College")),
        external_degrees=t("emplid, ext_org_id, degree, descr, field_of_study_1", ("2", None, "AA", "Associate", "ART")),
        agreements=t("emplid, ext_org_id, nc_ext_agreement", ("1", "CC1", "CAAM"), ("1", "CC1", "OTHER")),
        aid=t("emplid, aid_year, pell_eligibility", ("1", "2011", "Y"), ("1", "2010", "N")),
        transfer_courses=t(
            "emplid, trnsfr_src_id, crse_id, articulation_term, course_level, comp_subject_area, unt_taken double, unt_trnsfr double, reject_reason",
            ("1", "CC1", "c1", "2081", "RM", "Math", 3.0, 3.0, "16"), ("1", "U9", "c2", "2081", "CR", "Art", 3.0, 3.0, "99"), ("2", "CC1", "c3", "2081", "RM", "Art", 1.0, 1.0, None),
        ),
        audit_courses=t(
            "emplid, acad_career, acad_plan, crse_id, strm, subject, catalog_nbr, grade, rqrmnt_group, unt_other double, nc_xscriptdata_src",
            ("1", "UGRD", "14CHEBS", "c1", "2081", "MA", "107", "TR", "999999", 3.0, "T"), ("1", "UGRD", "14CHEBS", "c9", "2091", "CH", "101", "A", "000001", 4.0, "ENRL"),
            ("1", "UGRD", "14CHEBS", "c8", "2091", "CH", "102", None, "000001", 4.0, "ENRL"), ("1", "UGRD", "14CHEBS", "c7", "2091", "CH", "103", "B", "000001", 4.0, "REQR"),
            ("1", "UGRD", "14CHEBS", "c6", "2091", "CH", "104", "B", "000001", 4.0, None),
        ),
        term_programs=t(
            "emplid, strm, acad_plan, acad_sub_plan, acad_plan_type",
            ("1", "2108", "14CHEBS", None, "MAJ"), ("1", "2108", "MINOR", None, "MIN"), ("2", "2181", "14CHEBS", "S1", None), ("2", "2181", "17BIOBS", None, None),
        ),
        requirements=t(
            "acad_plan, acad_sub_plan, rqrmnt_list_seq int, eff_status, effdt int, min_units_reqd double",
            ("14CHEBS", "NOSUBPLAN", 30, "A", 1, 120.0), ("14CHEBS", "NOSUBPLAN", 30, "I", 2, 999.0), ("14CHEBS", "NOSUBPLAN", 10, "A", 3, 5.0), ("14CHEBS", "S1", 30, "A", 1, 124.0),
        ),
        admissions=t("emplid, nc_hist_type, admit_type, nc_enrolled", ("1", "CEN", "FRD", "Y"), ("2", "CEN", "TRN", "Y")),
    )


@pytest.fixture(scope="module")
def fact(grad_tables):
    return freeze(graduates.graduate_fact(grad_tables))


def test_graduate_fact(fact):
    rows = fact.collect()
    assert {r.emplid for r in rows} == {"1", "2"}
    first = {r.ext_org_id: r for r in rows if r.emplid == "1"}
    assert set(first) == {"CC1", "U9"}
    cc, other = first["CC1"], first["U9"]
    assert (cc.primary_plan, cc.ethnicity, cc.cip_code, cc.cum_gpa, cc.min_units_reqd) == ("Y", "White", None, 3.5, 120.0)
    assert (cc.tot_attempted, cc.excess_attempted, cc.excess_earned, cc.tot_transfer_accept) == (100.0, 7.0, 2.0, 30.0)
    assert (cc.ncccs, cc.transfer, cc.trnsfr_school, cc.nccc_transfer_accept, cc.caa_met, cc.nccc_dev_ed) == ("Y", "Y", "First College", 10.0, "CAAM", "Y")
    assert (other.ncccs, other.transfer, other.trnsfr_school, other.nccc_transfer_accept, other.caa_met, other.nccc_dev_ed) == ("N", "Y", None, None, None, None)
    assert (cc.new_freshmen, cc.pell_eligibility, cc.multiple_plan) == ("Y", "Y", "N")
    second = [r for r in rows if r.emplid == "2"]
    # Two enrolled plans in the last term, a degree of no known college, no totals.
    assert {r.primary_plan for r in second} == {"Y", "N"} and len(second) == 2
    assert {(r.ethnicity, r.transfer, r.degree, r.multiple_plan, r.min_units_reqd, r.excess_earned, r.new_freshmen) for r in second} == {
        ("Two or More", "N", "AA", "Y", 124.0, None, "N")
    }


def test_students_with_many_rows_are_joined_instead(spark, grad_tables, fact):
    """All students, one of two, and none over the limit give the same rows."""
    wanted = as_set(fact, *fact.columns)
    for limit in (0, 20):
        assert as_set(graduates.graduate_fact(grad_tables, limit), *fact.columns) == wanted


def test_one_partitioning_by_student(spark, grad_tables):
    """Over stored tables: the students, and the latest rows of two code tables."""
    stored = graduates.GraduateTables(**{name: saved(df) for name, df in vars(grad_tables).items()})
    plan = graduates.graduate_fact(stored)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(") == 3 and plan.count("hashpartitioning(emplid") == 1


def test_overview_and_courses(spark, fact, grad_tables):
    view = freeze(graduates.overview(fact))
    # The row of a school that is no college is kept as the plan's last row.
    assert as_set(view, "emplid", "ext_org_id", "ncccs_transfer") == {("1", "CC1", "Y"), ("1", "U9", "Y"), ("2", None, "N")}
    courses = freeze(graduates.course_detail(view, grad_tables))
    assert as_set(courses, "emplid", "school", "home_subject", "home_nbr", "nccc_dev_ed", "transfer_credit", "reject_reason", "counts_toward_degree", "unt_taken") == {
        ("1", "First College", "MA", "107", "Y", "Y", "Blank Grade", "N", 3.0),
        ("1", None, None, None, "N", "N", None, "Y", 3.0),
        ("1", "NCSU", "CH", "101", None, None, None, "Y", 4.0),
        ("1", "NCSU", "CH", "102", None, None, None, "Y", 4.0),
        ("2", "NCSU", None, None, None, None, None, "Y", None),
    }
    found = {r["check"]: r.violations for r in graduates.graduate_checks(view, courses).collect()}
    assert found == {"missing_credit_total": 1, "unmatched_courses": 2}


def test_graduate_job(spark, grad_tables, tmp_path):
    found = graduates.graduate_job(grad_tables, str(tmp_path), 7)
    assert {r["check"] for r in found.collect()} == {"missing_credit_total", "unmatched_courses"}
    crosswalk = spark.read.parquet(str(tmp_path / "crosswalk"))
    assert as_set(crosswalk, "obs") == {(1,), (2,)}
    public = spark.read.csv(str(tmp_path / "public" / "courses"), header=True)
    assert public.count() == 5 and "emplid" not in public.columns and "obs" in public.columns
    assert spark.read.csv(str(tmp_path / "internal" / "overview"), header=True).count() == 3


def test_pseudonymised_export(spark, fact, tmp_path):
    crosswalk = random_surrogate_id(fact, "emplid", 1)
    assert as_set(crosswalk, "obs") == {(1,), (2,)}
    rows = graduates.pseudonymised(fact, crosswalk)
    paths = sinks.sheet_write({"overview": rows}, str(tmp_path))
    sinks.csv_write(rows, str(tmp_path / "public"), drop=["emplid"])
    assert "emplid" in spark.read.csv(paths["overview"], header=True).columns
    assert "emplid" not in spark.read.csv(str(tmp_path / "public"), header=True).columns


# ---- applicants ------------------------------------------------------------


def test_applicant_study(spark):
    rows = spark.range(240).select(
        F.col("id"), (F.col("id") % 3).cast("string").alias("grad_years"),
        *[((F.hash("id", F.lit(j)) % 1000) / 500.0 + F.when(F.col("id") % 3 == 1, j * 1.0).otherwise(0.0)).alias(f"n{j}") for j in range(4)],
        F.when(F.col("id") % 2 == 0, "F").otherwise("M").alias("gender"),
        F.when(F.col("id") % 5 > 0, (F.col("id") % 5).cast("string")).alias("tier_designation"),
    )
    numeric, categorical = rows.select("id", "n0", "n1", "n2", "n3"), rows.select("id", "grad_years", "gender", "tier_designation")
    study = freeze(applicants.study_table(numeric, categorical, "id", ["n0", "n1", "n2", "n3"], ["gender", "tier_designation"], "grad_years"))
    assert study.count() == 240 and len(study.first().features) == 1 + 4 + 3
    scores = applicants.compare_models(study, "id", "grad_years", ["pc1", "pc2", "pc3"], folds=2, repeats=1, factors=["gender", "tier_designation"])
    got = {(r.model, r.metric): r.value for r in scores.groupBy("model", "metric").agg(F.avg("value").alias("value")).collect()}
    assert {m for m, _ in got} == {"lda", "qda", "knn", "tree"}
    assert got["lda", "accuracy"] > 0.5

    folded = freeze(classify.repeated_folds(study, "grad_years", "id", 2, 1))
    tuning = freeze(applicants.tune_neighbours(folded, "id", "grad_years", ks=[1, 5, 9], repeats=1))
    assert {r.k for r in tuning.collect()} == {1, 5, 9} and {r.fits for r in tuning.collect()} == {2}
    assert applicants.best_value(tuning, "k", True) in (1, 5, 9)
    depths = applicants.tune_tree(folded, "grad_years", [1, 3], folds=2, repeats=1)
    assert {r.depth for r in depths.collect()} == {1, 3}
    pruning = applicants.tune_pruning(study, folded, "id", "grad_years", depth=3).collect()
    assert {r.fits for r in pruning} == {2} and max(r.leaves for r in pruning) > 1
    predicted = applicants.held_out_predictions(study, "id", "grad_years", ["pc1", "pc2", "pc3"], factors=["gender", "tier_designation"])
    scored = {r.model: r for r in applicants.held_out_scores(predicted, "grad_years").collect()}
    assert {r.n for r in scored.values()} == {48} and scored["lda"].accuracy > scored["lda"].no_information_rate


def test_best_value_prefers_the_simpler_model(spark):
    tuning = table(spark, "k int, accuracy double", (5, 0.7), (9, 0.7), (11, 0.6))
    assert applicants.best_value(tuning, "k", True) == 9
    assert applicants.best_value(tuning, "k", False) == 5
