"""Scalar functions over the whole tables; missing values are made by condition."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings import query, table
from cohortloom import fixed_values as fv
from cohortloom.functions import missing, scalars, terms
from cohortloom.operators.checks import check_review_rows
from cohortloom.operators.reports import nearest_history_date
from cohortloom.operators.rows import top_one
from cohortloom.operators.setops import select_rename_drop


def _pairs(codes: dict[str, str]) -> str:
    return ", ".join(f"('{k}', '{v}')" for k, v in codes.items())


def _null_if(column, value):
    return F.when(F.col(column) != value, F.col(column))


@query(
    "first_nonblank",
    """SELECT o_orderkey, CASE WHEN o_orderpriority IN ('5-LOW', '1-URGENT') THEN o_orderstatus ELSE o_orderpriority END AS chosen
       FROM orders""",
)
def first_nonblank(spark, sf):
    first = F.when(F.col("o_orderpriority") == "5-LOW", "  ").when(
        F.col("o_orderpriority") != "1-URGENT", F.col("o_orderpriority")
    )
    return table(spark, sf, "orders").select("o_orderkey", missing.first_nonblank(first, "o_orderstatus").alias("chosen"))


_LINE_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


@query(
    "null_skipping_sum",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
              CASE WHEN l_discount = 0 AND l_tax = 0 THEN NULL ELSE round(l_discount + l_tax, 4) END AS total
       FROM lineitem""",
)
def null_skipping_sum(spark, sf):
    total = missing.null_sum(_null_if("l_discount", 0), _null_if("l_tax", 0))
    return table(spark, sf, "lineitem").select(*_LINE_KEYS, F.round(total, 4).alias("total"))


@query(
    "strict_difference",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(nullif(l_discount, 0) - nullif(l_tax, 0), 4) AS diff
       FROM lineitem""",
)
def strict_difference(spark, sf):
    difference = _null_if("l_discount", 0) - _null_if("l_tax", 0)
    return table(spark, sf, "lineitem").select(*_LINE_KEYS, F.round(difference, 4).alias("diff"))


@query(
    "code_decode",
    f"""SELECT c_custkey, coalesce(e.label, '{fv.ETHNICITY_DEFAULT}') AS with_default, r.label AS without_default
        FROM customer
        LEFT JOIN (VALUES {_pairs(fv.ETHNICITY)}) e(code, label) ON e.code = CAST(c_nationkey AS VARCHAR)
        LEFT JOIN (VALUES {_pairs(fv.REJECT_REASON)}) r(code, label) ON r.code = lpad(CAST(c_nationkey AS VARCHAR), 2, '0')""",
)
def code_decode(spark, sf):
    code = F.col("c_nationkey").cast("string")
    return table(spark, sf, "customer").select(
        "c_custkey",
        scalars.decode(code, fv.ETHNICITY, fv.ETHNICITY_DEFAULT).alias("with_default"),
        scalars.decode(F.lpad(code, 2, "0"), fv.REJECT_REASON).alias("without_default"),
    )


@query(
    "presence_flag",
    """SELECT c_custkey, CASE WHEN EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey
                AND o_orderdate >= DATE '2001-06-01') THEN 'Y' ELSE 'N' END AS recent FROM customer""",
)
def presence_flag(spark, sf):
    recent = (
        table(spark, sf, "orders").filter(F.col("o_orderdate") >= F.lit("2001-06-01").cast("timestamp_ntz"))
        .select(F.col("o_custkey").alias("recent_key")).distinct()
    )
    joined = table(spark, sf, "customer").join(recent, F.col("c_custkey") == F.col("recent_key"), "left")
    return joined.select("c_custkey", missing.presence_flag("recent_key").alias("recent"))


@query(
    "three_way_flag",
    "SELECT c_custkey, CASE WHEN c_acctbal > 7000 THEN 'Y' WHEN c_acctbal < 3000 THEN 'N' END AS flag FROM customer",
)
def three_way_flag(spark, sf):
    flag = missing.three_way_flag(F.col("c_acctbal") > 7000, F.col("c_acctbal") < 3000)
    return table(spark, sf, "customer").select("c_custkey", flag.alias("flag"))


@query(
    "char_from_end",
    """SELECT p_partkey, substr(p_brand, length(p_brand) - 1, 1) AS brand_char,
              CASE WHEN p_size >= 10 THEN left(right(CAST(p_size AS VARCHAR), 2), 1) END AS size_char FROM part""",
)
def char_from_end(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey",
        scalars.char_from_end(F.concat("p_brand", F.lit("  "))).alias("brand_char"),
        scalars.char_from_end(F.col("p_size").cast("string")).alias("size_char"),
    )


@query(
    "code_normalise",
    """SELECT p_partkey, left(CAST(p_retailprice AS VARCHAR), 2) || substr(CAST(p_retailprice AS VARCHAR), 4) AS price_code,
              'Br' || substr(p_brand, 4) AS brand_code FROM part""",
)
def code_normalise(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey",
        scalars.code_normalise(F.col("p_retailprice").cast("string")).alias("price_code"),
        scalars.code_normalise("p_brand").alias("brand_code"),
    )


@query(
    "prefix_flag",
    """SELECT p_partkey, CASE WHEN p_type LIKE 'S%' THEN 'Y' ELSE 'N' END AS starts_s,
              CASE WHEN p_size = 11 OR p_type NOT LIKE 'S%' THEN 'Y' ELSE 'N' END AS other FROM part""",
)
def prefix_flag(spark, sf):
    kind = F.when(F.col("p_size") != 11, F.col("p_type"))
    other = F.when(scalars.starts_with(kind, "S"), "N").otherwise("Y")
    return table(spark, sf, "part").select(
        "p_partkey", scalars.prefix_flag("p_type", "S").alias("starts_s"), other.alias("other")
    )


@query(
    "label_concat",
    "SELECT p_partkey, CASE WHEN p_size > 40 THEN 'Missing' ELSE 'Tier ' || p_size END AS label FROM part",
)
def label_concat(spark, sf):
    size = F.when(F.col("p_size") <= 40, F.col("p_size"))
    return table(spark, sf, "part").select("p_partkey", scalars.label_concat("Tier", size).alias("label"))


# Lines as load rows: hours from the quantity, career from the return flag, load from the line status.
_LOADS = """SELECT (l_quantity - 1) / 4 AS hours, l_discount AS audit,
                   CASE l_returnflag WHEN 'A' THEN 'VETM' WHEN 'N' THEN 'NDS' ELSE 'OTHER' END AS career,
                   CASE l_linestatus WHEN 'F' THEN 'W' ELSE 'F' END AS load FROM lineitem"""
_STANDING = """CASE WHEN career = 'VETM' AND hours >= 9 THEN 'F' WHEN career = 'VETM' AND hours BETWEEN 7 AND 8.5 THEN 'Q'
                    WHEN career = 'VETM' AND hours BETWEEN 4.5 AND 6.5 THEN 'H' WHEN career = 'VETM' AND hours BETWEEN 1 AND 4 THEN 'L'
                    WHEN career = 'NDS' AND hours >= 12 THEN 'F' WHEN career = 'NDS' AND hours BETWEEN 9 AND 11 THEN 'Q'
                    WHEN career = 'NDS' AND hours BETWEEN 6 AND 8 THEN 'H' WHEN career = 'NDS' AND hours BETWEEN 1 AND 5 THEN 'L'
                    WHEN hours = 0 AND load = 'W' THEN 'W' END"""


def _loads(spark, sf):
    career = F.when(F.col("l_returnflag") == "A", "VETM").when(F.col("l_returnflag") == "N", "NDS").otherwise("OTHER")
    rows = table(spark, sf, "lineitem").select(
        ((F.col("l_quantity") - 1) / 4).alias("hours"),
        F.col("l_discount").alias("audit"),
        career.alias("career"),
        F.when(F.col("l_linestatus") == "F", "W").otherwise("F").alias("load"),
    )
    return rows.withColumn("raw_standing", scalars.band_ladder("hours", "career", "load"))


@query(
    "band_ladder",
    f"""SELECT hours, career, load, {_STANDING} AS raw_standing, coalesce({_STANDING}, 'L') AS standing, count(*) AS n
        FROM ({_LOADS}) GROUP BY ALL""",
)
def band_ladder(spark, sf):
    rows = _loads(spark, sf).withColumn("standing", scalars.resolve_standing("raw_standing"))
    return rows.groupBy("hours", "career", "load", "raw_standing", "standing").agg(F.count("*").alias("n"))


@query(
    "check_review_rows",
    f"""SELECT career, load, hours, count(*) AS n FROM (SELECT *, {_STANDING} AS raw_standing FROM ({_LOADS}))
        WHERE raw_standing IS NULL AND NOT audit > 0 GROUP BY ALL""",
)
def check_review_rows_query(spark, sf):
    review = check_review_rows(_loads(spark, sf), "raw_standing", "audit")
    return review.groupBy("career", "load", "hours").agg(F.count("*").alias("n"))


@query(
    "fill_default",
    """SELECT o_orderkey, CASE WHEN o_totalprice > 400000 THEN 0.0 ELSE o_totalprice END AS price,
              CASE WHEN o_orderstatus = 'P' THEN '19980731' ELSE o_orderstatus END AS status, '19980516' AS begin_dt FROM orders""",
)
def fill_default(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey",
        missing.fill_default(F.when(F.col("o_totalprice") <= 400000, F.col("o_totalprice")), 0.0).alias("price"),
        missing.fill_default(F.when(F.col("o_orderstatus") == "P", " ").otherwise(F.col("o_orderstatus")), "19980731").alias("status"),
        F.lit("19980516").alias("begin_dt"),
    )


@query(
    "null_skipping_max",
    """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'F' THEN strftime(o_orderdate, '%Y%m%d')
                WHEN o_orderpriority = '5-LOW' THEN NULL
                WHEN o_orderpriority = '1-URGENT' THEN '19980516'
                ELSE greatest('19980516', strftime(o_orderdate, '%Y%m%d')) END AS p_stat_dt FROM orders""",
)
def null_skipping_max(spark, sf):
    day = F.date_format("o_orderdate", "yyyyMMdd")
    current = F.when(F.col("o_orderstatus") != "F", day)
    status = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority"))
    start = F.when(F.col("o_orderpriority") != "1-URGENT", day)
    latest = F.when(current.isNull() & status.isNotNull(), missing.null_max(F.lit("19980516"), start)).otherwise(current)
    return table(spark, sf, "orders").select("o_orderkey", latest.alias("p_stat_dt"))


@query(
    "binary_recode",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
              CAST(CASE WHEN l_tax = 0.08 THEN NULL WHEN l_discount = 0 THEN 0 ELSE 1 END AS INTEGER) AS recoded FROM lineitem""",
)
def binary_recode(spark, sf):
    value = F.when(F.col("l_tax") != 0.08, F.col("l_discount"))
    return table(spark, sf, "lineitem").select(*_LINE_KEYS, scalars.binary_recode(value).alias("recoded"))


@query(
    "placeholder_key",
    f"""SELECT o_orderkey, CASE WHEN o_orderpriority LIKE '%NOT SPECIFIED' THEN '{fv.NO_SUB_PLAN}' ELSE o_orderpriority END AS sub_plan
        FROM orders""",
)
def placeholder_key(spark, sf):
    plan = F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", " ").otherwise(F.col("o_orderpriority"))
    return table(spark, sf, "orders").select("o_orderkey", missing.placeholder_key(plan, fv.NO_SUB_PLAN).alias("sub_plan"))


@query(
    "year_from_term",
    """SELECT o_orderkey, '2' || strftime(o_orderdate, '%y') || '6' AS term, '20' || strftime(o_orderdate, '%y') AS aid_year
       FROM orders""",
)
def year_from_term(spark, sf):
    rows = table(spark, sf, "orders").select(
        "o_orderkey", F.concat(F.lit("2"), F.date_format("o_orderdate", "yy"), F.lit("6")).alias("term")
    )
    return rows.withColumn("aid_year", scalars.year_from_term("term"))


@query(
    "term_calendar",
    """WITH d AS (SELECT DISTINCT o_orderdate::DATE AS run_date, month(o_orderdate) AS m, year(o_orderdate) AS y FROM orders),
       c AS (
         SELECT run_date, 'Fall' AS season, CASE WHEN m IN (11, 12) THEN y + 1 ELSE y END AS y FROM d WHERE m <= 8 OR m >= 11
         UNION ALL
         SELECT run_date, 'Spring', CASE WHEN m = 1 THEN y ELSE y + 1 END FROM d WHERE m = 1 OR m >= 9),
       t AS (SELECT *, '2' || right(CAST(y AS VARCHAR), 2) AS cur, '2' || right(CAST(y - 1 AS VARCHAR), 2) AS old FROM c)
       SELECT run_date, season,
              CASE season WHEN 'Fall' THEN cur || '6,' || cur || '7,' || cur || '8' ELSE cur || '1' END AS terms,
              CASE season WHEN 'Fall' THEN old || '6,' || old || '7,' || old || '8' ELSE old || '1' END AS history_terms,
              cur || CASE season WHEN 'Fall' THEN '8' ELSE '1' END AS semester,
              old || CASE season WHEN 'Fall' THEN '8' ELSE '1' END AS history_semester
       FROM t""",
)
def term_calendar(spark, sf):
    days = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("run_date")).distinct()
    cycles = days.select("run_date", F.explode(terms.term_calendar("run_date")).alias("c")).select("run_date", "c.*")
    return cycles.withColumn("terms", F.array_join("terms", ",")).withColumn(
        "history_terms", F.array_join("history_terms", ",")
    )


@query(
    "date_shift_distance",
    """SELECT ts::DATE AS day, (ts::DATE - INTERVAL 1 YEAR)::DATE AS last_year,
              CAST(ts::DATE - DATE '2024-01-15' AS INTEGER) AS distance, count(*) AS n FROM events GROUP BY ALL""",
)
def date_shift_distance(spark, sf):
    days = table(spark, sf, "events").groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))
    return days.select(
        "day",
        scalars.same_day_last_year("day").alias("last_year"),
        scalars.day_distance(F.lit("2024-01-15").cast("date"), "day").alias("distance"),
        "n",
    )


@query(
    "nearest_history_date",
    """SELECT min(ts::DATE) AS history_date, CAST(min(ts::DATE) - DATE '2024-01-15' AS INTEGER) AS distance
       FROM events WHERE ts::DATE >= DATE '2024-01-15' AND event_type IN ('signup', 'purchase') AND value > 99""",
)
def nearest_history_date_query(spark, sf):
    days = table(spark, sf, "events").select(F.to_date("ts").alias("day"), "event_type", "value")
    return nearest_history_date(
        days, "day", F.lit("2025-01-15").cast("date"),
        F.col("event_type").isin("signup", "purchase") & (F.col("value") > 99),
    )


@query(
    "top_one",
    """SELECT event_id, user_id, event_type, value FROM events
       ORDER BY abs(ts::DATE - DATE '2024-01-20'), value DESC, event_id LIMIT 1""",
)
def top_one_query(spark, sf):
    distance = F.abs(F.datediff(F.to_date("ts"), F.lit("2024-01-20").cast("date")))
    first = top_one(table(spark, sf, "events"), distance, F.col("value").desc(), F.col("event_id"))
    return first.select("event_id", "user_id", "event_type", "value")


@query(
    "picture_percent",
    """SELECT o_orderpriority, printf('%.2f%%', 100.0 * count(*) FILTER (o_orderstatus = 'F') / count(*)) AS finished
       FROM orders GROUP BY 1""",
)
def picture_percent(spark, sf):
    share = F.count_if(F.col("o_orderstatus") == "F") * 100.0 / F.count("*")
    grouped = table(spark, sf, "orders").groupBy("o_orderpriority").agg(share.alias("share"))
    return grouped.select("o_orderpriority", scalars.picture_percent("share").alias("finished"))


@query(
    "json_path_default",
    """SELECT event_id, json_extract_string(props, '$.k') AS k, 'none' AS absent FROM events""",
)
def json_path_default(spark, sf):
    return table(spark, sf, "events").select(
        "event_id",
        scalars.json_path_default("props", "$.k", "none").alias("k"),
        scalars.json_path_default("props", "$.z.y", "none").alias("absent"),
    )


@query(
    "size_step_up",
    f"""SELECT p_partkey, p_size * 100 AS width,
               CAST(coalesce((SELECT min(s) FROM (SELECT unnest({fv.IMAGE_WIDTHS}) AS s) WHERE s >= p_size * 100),
                    {max(fv.IMAGE_WIDTHS)}) AS INTEGER) AS offered FROM part""",
)
def size_step_up(spark, sf):
    rows = table(spark, sf, "part").select("p_partkey", (F.col("p_size") * 100).alias("width"))
    return rows.withColumn("offered", scalars.size_step_up("width"))


@query("select_rename_drop", "SELECT s_suppkey AS id, s_name AS name, s_acctbal AS balance FROM supplier")
def select_rename_drop_query(spark, sf):
    return select_rename_drop(
        table(spark, sf, "supplier"), {"s_suppkey": "id", "s_name": "name", "s_acctbal": "balance"}
    )
