"""The graduate fact table over tables derived from orders, customers, parts and events.

Every order is a graduation plan, an enrolled term and a term program of its
customer; parts are dated plan codes and requirements; events are the transfer
schools, degrees, agreements and courses of the user with the customer's number.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings import query, table
from cohortloom import fixed_values as fv
from cohortloom.plans.graduates import GraduateTables, graduate_fact

_ORDERS = """o AS (SELECT CAST(o_custkey AS VARCHAR) AS emplid, CASE o_orderstatus WHEN 'P' THEN 'GRAD' ELSE 'UGRD' END AS career,
         '2' || (year(o_orderdate) - 1985) || CASE WHEN month(o_orderdate) <= 5 THEN '1' WHEN month(o_orderdate) <= 7 THEN '6' ELSE '8' END AS term,
         'PL' || left(o_orderpriority, 1) AS plan, o_orderstatus AS status, o_totalprice AS price, o_orderpriority AS priority FROM orders)"""

_SQL = f"""WITH {_ORDERS},
  grads AS (SELECT DISTINCT emplid, career, 'PR' || status AS prog, plan, term FROM o
            WHERE term BETWEEN '2111' AND '2187' AND career = 'UGRD' AND price <= 400000 AND priority <> '4-NOT SPECIFIED'),
  bio AS (SELECT CAST(c_custkey AS VARCHAR) AS emplid, CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'F' ELSE 'M' END AS gender,
          DATE '1980-01-01' + CAST(c_custkey AS INTEGER) AS birthdate, CASE WHEN c_acctbal > 5000 THEN 'R' ELSE 'N' END AS res,
          CASE c_nationkey {' '.join(f"WHEN {k} THEN '{v}'" for k, v in fv.ETHNICITY.items())} ELSE '{fv.ETHNICITY_DEFAULT}' END AS ethnicity,
          c_acctbal > 0 AND c_mktsegment IN ('BUILDING', 'FURNITURE') AND c_nationkey < 15 AS freshman FROM customer),
  code AS (SELECT 'PL' || (p_size % 5 + 1) AS plan, CASE WHEN max_by(p_type, p_partkey) <> 'ECONOMY' THEN max_by(p_brand, p_partkey) END AS cip
           FROM part GROUP BY 1),
  need AS (SELECT 'PL' || (p_size % 5 + 1) AS plan, CASE WHEN p_type = 'STANDARD' THEN 'NOSUBPLAN' ELSE 'S1' END AS sub,
                  max_by(CAST(p_size AS DOUBLE), p_partkey) AS units FROM part WHERE p_size > 10 AND p_type <> 'PROMO' GROUP BY ALL),
  held AS (SELECT DISTINCT g.emplid, g.term, (SELECT max(e.term) FROM o e WHERE e.emplid = g.emplid AND e.career = 'UGRD' AND e.term <= g.term) AS strm FROM grads g),
  totals AS (SELECT emplid, term, max(price) / 100000 AS gpa, CAST(count(*) AS DOUBLE) AS n,
                    nullif(count(*) FILTER (priority = '5-LOW'), 0) AS n_low FROM o WHERE career = 'UGRD' GROUP BY ALL),
  credits AS (SELECT emplid, plan, nullif(count(*) FILTER (status = 'F'), 0) AS nondgr, nullif(count(*) FILTER (status = 'O'), 0) AS dgr,
                     CASE WHEN count(*) > 1 THEN count(*) * 2 END AS tot FROM o GROUP BY ALL),
  school AS (SELECT CAST(user_id AS VARCHAR) AS emplid, event_type AS org, CASE WHEN event_type <> 'click' THEN 'CC' END AS kind,
                    nullif(count(*) FILTER (value > 50), 0) AS gpa, nullif(count(*) FILTER (value > 97), 0) AS nogpa,
                    CASE WHEN event_type IN ('signup', 'purchase') THEN event_type END AS college
             FROM events WHERE event_type <> 'view' GROUP BY ALL),
  deg AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS emplid, nullif(event_type, 'error') AS org, 'Associate ' || event_type AS descr,
                 left(event_type, 3) AS field FROM events WHERE value > 97),
  met AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS emplid, nullif(event_type, 'error') AS org FROM events WHERE value < 3),
  rem AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS emplid, nullif(event_type, 'error') AS org FROM events WHERE value > 90 AND value < 92),
  pell AS (SELECT emplid, '20' || substr(term, 2, 2) AS aid_year, CASE WHEN max(price) > 300000 THEN 'Y' ELSE 'N' END AS pell FROM o GROUP BY 1, 2),
  prog AS (SELECT DISTINCT emplid, term, plan, CASE WHEN price > 250000 THEN 'S1' ELSE 'NOSUBPLAN' END AS sub FROM o WHERE price >= 50000)
SELECT DISTINCT g.emplid, g.career AS acad_career, g.prog AS acad_prog, g.plan AS acad_plan, CASE WHEN en.plan = g.plan THEN 'Y' ELSE 'N' END AS primary_plan,
  bio.gender AS nc_gender, bio.birthdate, coalesce(bio.ethnicity, '{fv.ETHNICITY_DEFAULT}') AS ethnicity, bio.res AS tuition_res, code.cip AS cip_code,
  t.gpa AS cum_gpa, need.units AS min_units_reqd, t.n + coalesce(t.n_low, 0) AS tot_attempted, t.n * 3 AS tot_completed, g.term AS completion_term,
  CASE WHEN s.college IS NOT NULL THEN 'Y' ELSE 'N' END AS ncccs, CASE WHEN s.org IS NOT NULL THEN 'Y' ELSE 'N' END AS transfer,
  CASE WHEN bio.freshman THEN 'Y' ELSE 'N' END AS new_freshmen, 'College of ' || s.college AS trnsfr_school, s.org AS ext_org_id, s.kind AS ls_school_type,
  CAST(CASE WHEN s.college IS NULL OR (s.gpa IS NULL AND s.nogpa IS NULL) THEN NULL ELSE coalesce(s.gpa, 0) + coalesce(s.nogpa, 0) END AS DOUBLE) AS nccc_transfer_accept,
  CAST(CASE WHEN c.nondgr IS NULL AND c.dgr IS NULL THEN NULL ELSE coalesce(c.nondgr, 0) + coalesce(c.dgr, 0) END AS DOUBLE) AS tot_transfer_accept,
  CAST(c.tot AS DOUBLE) AS credits_towards_degree, CAST(c.dgr AS DOUBLE) AS trf_towards_degree, t.n * 4 - c.tot AS excess_attempted, t.n * 3 - c.tot AS excess_earned,
  CASE WHEN met.emplid IS NOT NULL THEN 'CAAM' END AS caa_met, CASE WHEN deg.emplid IS NOT NULL THEN 'AA' END AS degree, deg.descr AS degree_descr, deg.field AS degree_field,
  pell.pell AS pell_eligibility, CASE WHEN rem.emplid IS NOT NULL THEN 'Y' WHEN s.college IS NOT NULL THEN 'N' END AS nccc_dev_ed,
  CASE WHEN EXISTS (SELECT 1 FROM prog m WHERE m.emplid = g.emplid AND m.term = a.strm AND m.plan <> g.plan) THEN 'Y' ELSE 'N' END AS multiple_plan
FROM grads g
LEFT JOIN bio ON bio.emplid = g.emplid
LEFT JOIN code ON code.plan = g.plan
LEFT JOIN held a ON a.emplid = g.emplid AND a.term = g.term
LEFT JOIN o en ON en.emplid = g.emplid AND en.career = 'UGRD' AND en.term = a.strm
LEFT JOIN totals t ON t.emplid = g.emplid AND t.term = a.strm
LEFT JOIN credits c ON c.emplid = g.emplid AND c.plan = g.plan
LEFT JOIN school s ON s.emplid = g.emplid
LEFT JOIN deg ON deg.emplid = g.emplid AND deg.org IS NOT DISTINCT FROM s.college
LEFT JOIN met ON met.emplid = g.emplid AND met.org IS NOT DISTINCT FROM s.college
LEFT JOIN rem ON rem.emplid = g.emplid AND rem.org IS NOT DISTINCT FROM s.college
LEFT JOIN pell ON pell.emplid = g.emplid AND pell.aid_year = '20' || substr(g.term, 2, 2)
LEFT JOIN prog p ON p.emplid = g.emplid AND p.term = a.strm AND p.plan = g.plan
LEFT JOIN need ON need.plan = p.plan AND need.sub = p.sub"""


def graduate_tables(spark, sf) -> GraduateTables:
    month = F.month("o_orderdate")
    price, priority, status = F.col("o_totalprice"), F.col("o_orderpriority"), F.col("o_orderstatus")
    orders = table(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias("emplid"),
        F.when(status == "P", "GRAD").otherwise("UGRD").alias("acad_career"),
        F.concat(
            F.lit("2"), (F.year("o_orderdate") - 1985).cast("string"), F.when(month <= 5, "1").when(month <= 7, "6").otherwise("8")
        ).alias("strm"),
        F.concat(F.lit("PL"), F.substring(priority, 1, 1)).alias("acad_plan"),
        status.alias("status"), price.alias("price"), priority.alias("priority"),
    )
    price, priority, status = F.col("price"), F.col("priority"), F.col("status")
    checkout = (
        F.when(priority == "1-URGENT", "AG").when(priority == "2-HIGH", "AP").when(priority == "3-MEDIUM", "CC")
        .when(priority == "5-LOW", "DR").otherwise("XX")
    )
    customers = table(spark, sf, "customer").withColumn("emplid", F.col("c_custkey").cast("string"))
    segment = F.col("c_mktsegment")
    parts = table(spark, sf, "part").select(
        F.concat(F.lit("PL"), (F.col("p_size") % 5 + 1).cast("string")).alias("acad_plan"),
        F.date_add(F.lit("1990-01-01").cast("date"), F.col("p_partkey").cast("int")).alias("effdt"),
        "p_type", "p_brand", "p_size",
    )
    kind, value, org = F.col("event_type"), F.col("value"), F.nullif(F.col("event_type"), F.lit("error"))
    events = table(spark, sf, "events").withColumn("emplid", F.col("user_id").cast("string"))

    def count(condition):
        return F.nullif(F.count_if(condition), F.lit(0)).cast("double")

    return GraduateTables(
        graduation_plans=orders.select(
            "emplid", "acad_career", F.concat(F.lit("PR"), status).alias("acad_prog"), "acad_plan",
            F.when(price > 400000, "MIN").otherwise("MAJ").alias("acad_plan_type"), F.col("strm").alias("completion_term"),
            checkout.alias("nc_degr_ckout_stat"),
        ),
        demographics=customers.select(
            "emplid", F.when(segment.isin("BUILDING", "MACHINERY"), "F").otherwise("M").alias("nc_gender"),
            F.date_add(F.lit("1980-01-01").cast("date"), F.col("c_custkey").cast("int")).alias("birthdate"),
            F.col("c_nationkey").cast("string").alias("nc_ipeds_summary"),
            F.when(F.col("c_acctbal") > 5000, "R").otherwise("N").alias("tuition_res"),
        ),
        plan_codes=parts.select(
            "acad_plan", "effdt", F.when(F.col("p_type") == "ECONOMY", "I").otherwise("A").alias("eff_status"), F.col("p_brand").alias("cip_code")
        ),
        term_enrollment=orders.select("emplid", "acad_career", "strm", "acad_plan"),
        term_totals=orders.groupBy("emplid", "acad_career", "strm").agg(
            (F.max(price) / 100000).alias("cum_gpa"), F.count("*").cast("double").alias("tot_taken_gpa"),
            count(priority == "5-LOW").alias("tot_taken_nogpa"), (F.count("*") * 3).cast("double").alias("tot_cumulative"),
            (F.count("*") * 4).cast("double").alias("tot_taken_prgrss"),
        ),
        degree_totals=orders.groupBy("emplid", "acad_plan").agg(
            count(status == "F").alias("nc_unt_nondgr_trns"), count(status == "O").alias("nc_unt_dgr_trns"),
            F.when(F.count("*") > 1, F.count("*") * 2).cast("double").alias("nc_unt_dgr_tot"),
        ),
        transfer_schools=events.groupBy("emplid", "event_type").agg(
            count(value > 50).alias("trf_taken_gpa"), count(value > 97).alias("trf_taken_nogpa")
        ).select(
            "emplid", kind.alias("ext_org_id"), F.when(kind == "view", fv.HOME_INSTITUTION).when(kind != "error", "OTHER").alias("src_institution"),
            F.when(kind != "click", "CC").alias("ls_school_type"), "trf_taken_gpa", "trf_taken_nogpa",
        ),
        colleges=events.filter(kind.isin("signup", "purchase")).select(
            kind.alias("ext_org_id"), F.concat(F.lit("College of "), kind).alias("descr")
        ).distinct(),
        external_degrees=events.filter(value > 97).select(
            "emplid", org.alias("ext_org_id"), F.lit("AA").alias("degree"), F.concat(F.lit("Associate "), kind).alias("descr"),
            F.substring(kind, 1, 3).alias("field_of_study_1"),
        ),
        agreements=events.filter(value < 5).select(
            "emplid", org.alias("ext_org_id"), F.when(value < 3, fv.AGREEMENT_MET).otherwise("OTHR").alias("nc_ext_agreement")
        ),
        aid=orders.groupBy("emplid", F.concat(F.lit("20"), F.substring("strm", 2, 2)).alias("aid_year")).agg(
            F.when(F.max(price) > 300000, "Y").otherwise("N").alias("pell_eligibility")
        ),
        transfer_courses=events.select(
            "emplid", org.alias("trnsfr_src_id"), F.col("props").alias("crse_id"), F.date_format("ts", "yyyyMM").alias("articulation_term"),
            F.when((value > 90) & (value < 92), fv.REMEDIAL_LEVEL).otherwise("CR").alias("course_level"), kind.alias("comp_subject_area"),
            value.alias("unt_taken"), value.alias("unt_trnsfr"), F.lit(None).cast("string").alias("reject_reason"),
        ),
        audit_courses=orders.select(
            "emplid", "acad_career", "acad_plan", F.col("priority").alias("crse_id"), "strm", F.col("status").alias("subject"),
            priority.alias("catalog_nbr"), status.alias("grade"), F.lit(None).cast("string").alias("rqrmnt_group"),
            F.lit(3.0).alias("unt_other"), status.alias("nc_xscriptdata_src"),
        ),
        term_programs=orders.select(
            "emplid", "strm", "acad_plan", F.when(price > 250000, "S1").otherwise(" ").alias("acad_sub_plan"),
            F.when(price < 50000, "MIN").when(price >= 100000, "MAJ").alias("acad_plan_type"),
        ),
        requirements=parts.select(
            "acad_plan", F.when(F.col("p_type") == "STANDARD", fv.NO_SUB_PLAN).otherwise("S1").alias("acad_sub_plan"),
            F.when(F.col("p_size") > 10, 30).otherwise(10).alias("rqrmnt_list_seq"),
            F.when(F.col("p_type") == "PROMO", "I").otherwise("A").alias("eff_status"), "effdt", F.col("p_size").cast("double").alias("min_units_reqd"),
        ),
        admissions=customers.select(
            "emplid", F.when(F.col("c_acctbal") > 0, "CEN").otherwise("NEW").alias("nc_hist_type"),
            F.when(segment == "BUILDING", "FRD").when(segment == "FURNITURE", "FRI").otherwise("TRN").alias("admit_type"),
            F.when(F.col("c_nationkey") < 15, "Y").otherwise("N").alias("nc_enrolled"),
        ),
    )


@query("wide_fact_join", _SQL)
def wide_fact_join(spark, sf):
    return graduate_fact(graduate_tables(spark, sf))
