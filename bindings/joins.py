"""Joins over the whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings import query, table
from cohortloom.operators import joins
from cohortloom.operators.rows import random_surrogate_id


@query(
    "match_merge",
    """WITH a AS (SELECT o_custkey, o_orderkey, o_totalprice, o_orderpriority,
                         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS i,
                         count(*) OVER (PARTITION BY o_custkey) AS n FROM orders WHERE o_orderstatus = 'F'),
            b AS (SELECT o_custkey, o_orderkey AS b_orderkey, CASE WHEN o_totalprice <= 400000 THEN o_totalprice END AS o_totalprice,
                         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS i,
                         count(*) OVER (PARTITION BY o_custkey) AS n FROM orders WHERE o_orderstatus = 'O'),
            k AS (SELECT coalesce(x.o_custkey, y.o_custkey) AS o_custkey, coalesce(x.n, 0) AS na, coalesce(y.n, 0) AS nb
                  FROM (SELECT DISTINCT o_custkey, n FROM a) x FULL JOIN (SELECT DISTINCT o_custkey, n FROM b) y
                    ON x.o_custkey = y.o_custkey),
            r AS (SELECT *, unnest(range(1, greatest(na, nb) + 1)) AS i FROM k)
       SELECT r.o_custkey, r.i AS row_in_key, na > 0 AS in_a, nb > 0 AS in_b, a.o_orderkey AS a_orderkey, b.b_orderkey,
              a.o_orderpriority, CASE WHEN r.i <= nb THEN b.o_totalprice ELSE a.o_totalprice END AS o_totalprice,
              a.o_totalprice AS o_totalprice_a, b.o_totalprice AS o_totalprice_b
       FROM r LEFT JOIN a ON a.o_custkey = r.o_custkey AND a.i = least(r.i, na)
              LEFT JOIN b ON b.o_custkey = r.o_custkey AND b.i = least(r.i, nb)""",
)
def match_merge(spark, sf):
    orders = table(spark, sf, "orders")
    a = orders.filter(F.col("o_orderstatus") == "F").select(
        "o_custkey", F.col("o_orderkey").alias("a_orderkey"), "o_totalprice", "o_orderpriority"
    )
    price = F.when(F.col("o_totalprice") <= 400000, F.col("o_totalprice"))
    b = orders.filter(F.col("o_orderstatus") == "O").select(
        "o_custkey", F.col("o_orderkey").alias("b_orderkey"), price.alias("o_totalprice")
    )
    return joins.match_merge(a, b, ["o_custkey"], ["a_orderkey"], ["b_orderkey"])


@query(
    "left_lookup_chain",
    """SELECT c_custkey, n_name, CASE WHEN n_regionkey <> 2 THEN r_name END AS r_name FROM customer
       LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""",
)
def left_lookup_chain(spark, sf):
    regions = table(spark, sf, "region").filter(F.col("r_regionkey") != 2)
    chained = joins.left_lookup_chain(
        table(spark, sf, "customer"), (table(spark, sf, "nation"), "c_nationkey", "n_nationkey"),
        (regions, "n_regionkey", "r_regionkey"),
    )
    return chained.select("c_custkey", "n_name", "r_name")


@query(
    "left_join_on_filter",
    """WITH loads AS (SELECT o_custkey, year(o_orderdate) AS y, count(*) AS n, round(sum(o_totalprice), 2) AS total
                      FROM orders GROUP BY ALL)
       SELECT c_custkey, x.n AS n_first, x.total AS total_first, z.n AS n_second, z.total AS total_second FROM customer
       LEFT JOIN loads x ON c_custkey = x.o_custkey AND x.y = 1997 AND x.total >= 100000
       LEFT JOIN loads z ON c_custkey = z.o_custkey AND z.y = 1998 AND z.total >= 100000""",
)
def left_join_on_filter(spark, sf):
    loads = (
        table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey"), F.year("o_orderdate").alias("y"))
        .agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    )
    out = table(spark, sf, "customer").select("c_custkey")
    for year, name in ((1997, "first"), (1998, "second")):
        right = loads.select("c_custkey", "y", F.col("n").alias(f"n_{name}"), F.col("total").alias(f"total_{name}"))
        condition = (F.col("y") == year) & (F.col(f"total_{name}") >= 100000)
        out = joins.left_join_filtered(out, right, ["c_custkey"], condition).drop("y")
    return out


@query(
    "computed_key_join",
    """SELECT c_custkey, r_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
       LEFT JOIN region ON r_regionkey = CASE WHEN c_mktsegment = 'BUILDING' THEN n_regionkey ELSE c_nationkey END""",
)
def computed_key_join(spark, sf):
    with_nation = joins.left_lookup_chain(
        table(spark, sf, "customer"), (table(spark, sf, "nation"), "c_nationkey", "n_nationkey")
    )
    key = F.when(F.col("c_mktsegment") == "BUILDING", F.col("n_regionkey")).otherwise(F.col("c_nationkey"))
    return joins.computed_key_join(with_nation, table(spark, sf, "region"), key, "r_regionkey").select("c_custkey", "r_name")


@query(
    "inner_computed_term",
    """SELECT c_custkey, o_orderkey, strftime(o_orderdate, '2%y') || CASE WHEN month(o_orderdate) <= 5 THEN '1'
                WHEN month(o_orderdate) <= 7 THEN '6' ELSE '8' END AS term
       FROM customer JOIN orders ON c_custkey = o_custkey AND year(o_orderdate) = 1998 AND month(o_orderdate) <= 5""",
)
def inner_computed_term(spark, sf):
    month = F.month("o_orderdate")
    session = F.when(month <= 5, "1").when(month <= 7, "6").otherwise("8")
    orders = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("c_custkey"), "o_orderkey",
        F.concat(F.lit("2"), F.date_format("o_orderdate", "yy"), session).alias("term"),
    )
    wanted = F.concat(F.lit("2"), F.lit("98"), F.lit("1"))
    return table(spark, sf, "customer").select("c_custkey").join(orders.filter(F.col("term") == wanted), "c_custkey")


# Orders as dated rows of a customer: status F is active.
def _dated(spark, sf):
    return table(spark, sf, "orders").select(
        F.col("o_custkey").alias("c_custkey"), "o_orderkey", F.to_date("o_orderdate").alias("effdt"), "o_orderstatus"
    )


_DATED = "SELECT o_custkey AS c_custkey, o_orderkey, o_orderdate::DATE AS effdt, o_orderstatus FROM orders"


@query(
    "effective_dated_join",
    f"""WITH d AS ({_DATED}), t AS (SELECT * FROM d x WHERE effdt <= DATE '1998-07-01' AND effdt =
              (SELECT max(effdt) FROM d y WHERE y.c_custkey = x.c_custkey AND y.effdt <= DATE '1998-07-01'))
        SELECT c.c_custkey, t.o_orderkey, t.effdt, t.o_orderstatus FROM customer c LEFT JOIN t ON t.c_custkey = c.c_custkey""",
)
def effective_dated_join(spark, sf):
    customers = table(spark, sf, "customer").select("c_custkey")
    return joins.effective_dated_join(customers, _dated(spark, sf), ["c_custkey"], "effdt", F.lit("1998-07-01").cast("date"))


@query(
    "latest_then_status",
    f"""WITH d AS ({_DATED}), t AS (SELECT * FROM d x WHERE o_orderstatus = 'F' AND effdt =
              (SELECT max(effdt) FROM d y WHERE y.c_custkey = x.c_custkey))
        SELECT c.c_custkey, t.o_orderkey, t.effdt, t.o_orderstatus FROM customer c LEFT JOIN t ON t.c_custkey = c.c_custkey""",
)
def latest_then_status(spark, sf):
    customers = table(spark, sf, "customer").select("c_custkey")
    return joins.latest_then_status(customers, _dated(spark, sf), ["c_custkey"], "effdt", F.col("o_orderstatus") == "F")


@query(
    "latest_active",
    f"""WITH d AS ({_DATED}), t AS (SELECT * FROM d x WHERE o_orderstatus = 'F' AND effdt =
              (SELECT max(effdt) FROM d y WHERE y.c_custkey = x.c_custkey AND y.o_orderstatus = 'F'))
        SELECT c.c_custkey, t.o_orderkey, t.effdt, t.o_orderstatus FROM customer c LEFT JOIN t ON t.c_custkey = c.c_custkey""",
)
def latest_active(spark, sf):
    customers = table(spark, sf, "customer").select("c_custkey")
    return joins.latest_active(customers, _dated(spark, sf), ["c_custkey"], "effdt", F.col("o_orderstatus") == "F")


@query(
    "correlated_max",
    """SELECT o_custkey, o_orderpriority, max(o_orderdate::DATE) AS max_effdt FROM orders
       WHERE o_orderdate <= DATE '2000-01-01' GROUP BY ALL""",
)
def correlated_max(spark, sf):
    dated = table(spark, sf, "orders").select("o_custkey", "o_orderpriority", F.to_date("o_orderdate").alias("effdt"))
    return joins.correlated_max(dated, ["o_custkey", "o_orderpriority"], "effdt", F.col("effdt") <= F.lit("2000-01-01").cast("date"))


@query(
    "asof_term_join",
    """WITH m AS (SELECT *, max(CASE WHEN event_type = 'signup' THEN ts END) OVER (PARTITION BY user_id ORDER BY ts
                     RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS matched_term FROM events)
       SELECT m.event_id, m.user_id, m.event_type, m.matched_term, s.event_id AS signup_id, s.value AS signup_value
       FROM m LEFT JOIN events s ON s.user_id = m.user_id AND s.ts = m.matched_term AND s.event_type = 'signup'""",
)
def asof_term_join(spark, sf):
    events = table(spark, sf, "events")
    signups = events.filter(F.col("event_type") == "signup").select(
        "user_id", F.col("ts").alias("signup_ts"), F.col("event_id").alias("signup_id"), F.col("value").alias("signup_value")
    )
    joined = joins.asof_term_join(
        events.select("event_id", "user_id", "ts", "event_type"), signups, ["user_id"], "ts", "signup_ts",
        bucket=lambda t: F.date_trunc("HOUR", t),
    )
    return joined.drop("ts")


@query(
    "null_matching_join",
    """WITH n AS (SELECT n_nationkey, CASE WHEN n_regionkey NOT IN (0, 3) THEN n_regionkey END AS k FROM nation),
            r AS (SELECT r_name, CASE WHEN r_regionkey NOT IN (0, 3) THEN r_regionkey END AS k FROM region)
       SELECT n_nationkey, n.k AS region_code, r_name FROM n LEFT JOIN r ON n.k IS NOT DISTINCT FROM r.k""",
)
def null_matching_join(spark, sf):
    nations = table(spark, sf, "nation").select(
        "n_nationkey", F.when(~F.col("n_regionkey").isin(0, 3), F.col("n_regionkey")).alias("region_code")
    )
    regions = table(spark, sf, "region").select(
        "r_name", F.when(~F.col("r_regionkey").isin(0, 3), F.col("r_regionkey")).alias("region_code")
    )
    return joins.null_matching_join(nations, regions, ["region_code"])


@query(
    "nonblank_key_join",
    """SELECT s_suppkey, n_nationkey, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey
       WHERE s_nationkey NOT IN (3, 4)""",
)
def nonblank_key_join(spark, sf):
    code = F.when(F.col("s_nationkey") == 3, " ").when(F.col("s_nationkey") != 4, F.col("s_nationkey").cast("string"))
    suppliers = table(spark, sf, "supplier").select("s_suppkey", code.alias("code"))
    nations = table(spark, sf, "nation").select("n_nationkey", "n_name").withColumn("code", F.col("n_nationkey").cast("string"))
    return joins.nonblank_key_join(suppliers, nations, "code").drop("code")


@query(
    "other_row_exists",
    """SELECT o.o_orderkey, strftime(o.o_orderdate, '%Y%m') AS month,
              CASE WHEN EXISTS (SELECT 1 FROM orders x WHERE x.o_custkey = o.o_custkey
                AND strftime(x.o_orderdate, '%Y%m') = strftime(o.o_orderdate, '%Y%m')
                AND x.o_orderpriority <> o.o_orderpriority AND x.o_orderstatus <> 'P') THEN 'Y' ELSE 'N' END AS multiple
       FROM orders o""",
)
def other_row_exists(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", F.date_format("o_orderdate", "yyyyMM").alias("month"), "o_orderpriority", "o_orderstatus"
    )
    flagged = joins.other_row_exists(
        orders.drop("o_orderstatus"), orders, ["o_custkey", "month"], "o_orderpriority", F.col("o_orderstatus") != "P", "multiple"
    )
    return flagged.select("o_orderkey", "month", "multiple")


@query(
    "crosswalk_join",
    """WITH x AS (SELECT c_custkey, row_number() OVER (ORDER BY md5('7|' || c_custkey), c_custkey) AS obs FROM customer
                  WHERE c_mktsegment <> 'BUILDING')
       SELECT o_orderkey, o_orderstatus, obs FROM orders LEFT JOIN x ON o_custkey = c_custkey""",
)
def crosswalk_join(spark, sf):
    known = table(spark, sf, "customer").filter(F.col("c_mktsegment") != "BUILDING")
    crosswalk = random_surrogate_id(known.select(F.col("c_custkey").alias("o_custkey")), "o_custkey", 7)
    crosswalk = crosswalk.withColumn("obs", F.col("obs").cast("bigint"))
    rows = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return joins.crosswalk_join(rows, crosswalk, "o_custkey").drop("o_custkey")
