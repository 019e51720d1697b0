"""Filters, predicates and stacking."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from bindings import query, table
from cohortloom.functions import missing, scalars
from cohortloom.operators import checks, joins, reports, setops

_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]


@query(
    "in_list_filter",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders
       WHERE o_orderstatus IN ('F', 'P') AND o_orderpriority IN ('1-URGENT', '2-HIGH')""",
)
def in_list_filter(spark, sf):
    chosen = F.col("o_orderstatus").isin("F", "P") & F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    return table(spark, sf, "orders").filter(chosen).select(*_COLUMNS)


@query(
    "chained_range",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y%m') AS month FROM orders
       WHERE '199711' <= strftime(o_orderdate, '%Y%m') AND strftime(o_orderdate, '%Y%m') <= '199902'""",
)
def chained_range(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyyMM").alias("month"))
    return rows.filter(F.col("month").between("199711", "199902"))


@query(
    "null_safe_not_equal",
    """SELECT n_nationkey, nullif(n_regionkey, 3) AS region_code FROM nation WHERE n_regionkey <> 1 OR n_regionkey = 3""",
)
def null_safe_not_equal(spark, sf):
    code = F.when(F.col("n_regionkey") != 3, F.col("n_regionkey"))
    rows = table(spark, sf, "nation").select("n_nationkey", code.alias("region_code"))
    return rows.filter(missing.not_equal("region_code", 1))


@query(
    "report_filter",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders
       WHERE o_orderstatus = 'F' AND year(o_orderdate) = 1998
         AND (o_orderpriority = '1-URGENT' OR o_custkey IN (7, 77, 777) OR o_totalprice > 450000)""",
)
def report_filter(spark, sf):
    base = (F.col("o_orderstatus") == "F") & (F.year("o_orderdate") == 1998)
    extra = (
        (F.col("o_orderpriority") == "1-URGENT") | F.col("o_custkey").isin(7, 77, 777) | (F.col("o_totalprice") > 450000)
    )
    return reports.report_filter(table(spark, sf, "orders"), base, extra).select(*_COLUMNS)


@query(
    "exclude_incomplete",
    """SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders
       WHERE NOT (o_orderstatus = 'F' AND o_orderpriority = '5-LOW')""",
)
def exclude_incomplete(spark, sf):
    indicator = F.when(F.col("o_orderstatus") == "F", "Y").when(F.col("o_orderstatus") == "O", "N")
    code = F.when(F.col("o_orderpriority") == "5-LOW", " ").otherwise(F.col("o_orderpriority"))
    rows = table(spark, sf, "orders").withColumn("indicator", indicator).withColumn("code", code)
    kept = rows.filter(missing.not_equal("indicator", "Y") | missing.present("code"))
    return kept.select("o_orderkey", "o_orderstatus", "o_orderpriority")


@query(
    "post_join_filter",
    """SELECT c_custkey, o_orderkey, o_totalprice FROM customer LEFT JOIN orders ON c_custkey = o_custkey
       WHERE c_mktsegment = 'BUILDING' AND o_orderstatus = 'F'""",
)
def post_join_filter(spark, sf):
    building = table(spark, sf, "customer").filter(F.col("c_mktsegment") == "BUILDING")
    orders = table(spark, sf, "orders").withColumnRenamed("o_custkey", "c_custkey")
    joined = joins.post_join_filter(building, orders, ["c_custkey"], F.col("o_orderstatus") == "F")
    return joined.select("c_custkey", "o_orderkey", "o_totalprice")


@query(
    "media_allow_list",
    """WITH posts AS (SELECT *, user_id || '/' || strftime(ts, '%Y%m%d') AS account FROM events),
       kept AS (
         SELECT * FROM posts WHERE event_type IN ('purchase', 'signup')
         UNION ALL
         SELECT * FROM posts WHERE event_type = 'view'
           AND account NOT IN (SELECT account FROM posts WHERE event_type IN ('purchase', 'signup'))),
       labelled AS (SELECT *, left(event_type || ' shared on ' || strftime(ts, '%a %b %d %Y') || ' | ' || props, 41) AS cut FROM kept)
       SELECT event_id, account, event_type,
              CASE WHEN length(cut) = 41 AND regexp_matches(cut, '[A-Za-z0-9]$') THEN cut || '...' ELSE cut END AS label
       FROM labelled""",
)
def media_allow_list(spark, sf):
    posts = table(spark, sf, "events").withColumn(
        "account", F.concat_ws("/", F.col("user_id").cast("string"), F.date_format("ts", "yyyyMMdd"))
    )
    fallback = posts.filter(F.col("event_type") == "view")
    kept = joins.media_allow_list(posts, fallback, "account", "event_type", ["purchase", "signup"])
    label = scalars.media_label(F.col("event_type"), F.col("ts"), F.col("props"), limit=41)
    return kept.select("event_id", "account", "event_type", label.alias("label"))


# ---- stacking --------------------------------------------------------------


@query(
    "snapshot_concat",
    """SELECT o_orderkey, o_orderstatus, o_totalprice, CASE year(o_orderdate) WHEN 1997 THEN '1997-07-31' ELSE '1998-07-31' END AS day,
              CASE year(o_orderdate) WHEN 1998 THEN o_orderpriority END AS o_orderpriority
       FROM orders WHERE year(o_orderdate) IN (1997, 1998) AND o_orderstatus IN ('F', 'O')""",
)
def snapshot_concat(spark, sf):
    dated = table(spark, sf, "orders").withColumn("year", F.year("o_orderdate"))
    columns = ["o_orderkey", "o_orderstatus", "o_totalprice"]
    history = dated.filter(F.col("year") == 1997).select(*columns)
    today = dated.filter(F.col("year") == 1998).select(*columns, "o_orderpriority")
    both = setops.snapshot_concat([(history, "1997-07-31"), (today, "1998-07-31")])
    return both.filter(F.col("o_orderstatus").isin("F", "O"))


@query(
    "override_union",
    """SELECT o_custkey, o_orderpriority, 'Deferred' AS kind, 1 AS admit FROM orders WHERE o_orderstatus = 'F'
       UNION
       SELECT o_custkey, o_orderpriority, 'Deferred', 0 FROM orders WHERE o_orderstatus = 'P'""",
)
def override_union(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderpriority", "o_orderstatus").withColumn("kind", F.lit("Regular"))
    branches = [
        (orders.filter(F.col("o_orderstatus") == s).drop("o_orderstatus"), {"kind": F.lit("Deferred"), "admit": F.lit(n)})
        for s, n in (("F", 1), ("P", 0))
    ]
    return setops.override_union(branches)


@query(
    "typed_union",
    """SELECT c_nationkey AS nation, c_mktsegment AS segment, CAST(NULL AS DOUBLE) AS balance, 'customer' AS kind FROM customer
       UNION
       SELECT s_nationkey, NULL, s_acctbal, 'supplier' FROM supplier""",
)
def typed_union(spark, sf):
    schema = T.StructType.fromDDL("nation int, segment string, balance double, kind string")
    customers = table(spark, sf, "customer").select(
        F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment"), F.lit("customer").alias("kind")
    )
    suppliers = table(spark, sf, "supplier").select(
        F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("balance"), F.lit("supplier").alias("kind")
    )
    return setops.typed_union([customers, suppliers], schema)


@query(
    "split_output",
    """SELECT CASE WHEN o_totalprice > 250000 THEN 'large' ELSE 'small' END AS part, o_orderstatus, count(*) AS n,
              min(o_orderkey) AS first_key FROM orders GROUP BY ALL""",
)
def split_output(spark, sf):
    large, small = setops.split_output(table(spark, sf, "orders"), F.col("o_totalprice") > 250000)
    both = large.withColumn("part", F.lit("large")).unionByName(small.withColumn("part", F.lit("small")))
    return both.groupBy("part", "o_orderstatus").agg(F.count("*").alias("n"), F.min("o_orderkey").alias("first_key"))


# ---- checks ----------------------------------------------------------------


@query(
    "check_run_date",
    """SELECT max(o_orderdate::DATE) AS latest, count(*) AS n, max(o_orderdate::DATE) = DATE '2001-08-01' AS fresh
       FROM orders WHERE o_orderstatus IN ('F', 'O')""",
)
def check_run_date(spark, sf):
    headers = table(spark, sf, "orders").withColumn("run_date", F.to_date("o_orderdate"))
    return checks.check_run_date(
        headers, F.col("o_orderstatus").isin("F", "O"), "run_date", F.lit("2001-08-01").cast("date")
    )


@query(
    "check_status_conflict",
    """SELECT c_custkey, event_id FROM customer JOIN events ON user_id = c_custkey
       WHERE c_mktsegment = 'BUILDING' AND event_type = 'signup' AND value > 50""",
)
def check_status_conflict(spark, sf):
    registration = table(spark, sf, "events").withColumnRenamed("user_id", "c_custkey")
    conflicts = checks.check_status_conflict(
        table(spark, sf, "customer"), registration, ["c_custkey"], F.col("c_mktsegment") == "BUILDING",
        (F.col("event_type") == "signup") & (F.col("value") > 50),
    )
    return conflicts.select("c_custkey", "event_id")


@query(
    "check_missing_credits",
    """SELECT 'missing_total' AS "check", count(*) FILTER (l_discount = 0 OR l_tax = 0) AS violations FROM lineitem
       UNION ALL
       SELECT 'unmatched', count(*) FILTER (l_tax <> 0 AND l_returnflag = 'A') FROM lineitem""",
)
def check_missing_credits(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        (F.nullif("l_discount", F.lit(0.0)) - F.nullif("l_tax", F.lit(0.0))).alias("total"), "l_tax",
        F.nullif("l_returnflag", F.lit("A")).alias("subject"),
    )
    return checks.violations(
        {
            "missing_total": checks.check_missing_credits(lines, "total"),
            "unmatched": checks.check_unmatched_courses(lines, F.col("l_tax") != 0, "subject"),
        }
    )
