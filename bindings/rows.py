"""Ordered-row operators over events, orders and lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings import query, table
from cohortloom.operators import rows

_ORDER = ["ts", "event_id"]


@query(
    "running_flag",
    """SELECT event_id, user_id, max(CASE WHEN event_type = 'purchase' THEN 'Y' ELSE 'N' END)
              OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS flag FROM events""",
)
def running_flag(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id", "ts", "event_type")
    flagged = rows.running_flag(events, ["user_id"], _ORDER, F.col("event_type") == "purchase", "flag")
    return flagged.select("event_id", "user_id", "flag")


@query(
    "keep_or_last",
    """SELECT event_id, user_id, event_type, CASE WHEN value > 50 THEN value END AS value FROM (
         SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS back FROM events)
       WHERE value > 50 OR back = 1""",
)
def keep_or_last(spark, sf):
    value = F.when(F.col("value") > 50, F.col("value")).alias("value")
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", "ts", value)
    return rows.keep_or_last(events, ["user_id", "event_type"], _ORDER, F.col("value").isNotNull()).drop("ts")


@query(
    "last_row_per_key",
    """SELECT user_id, event_id, event_type, value FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
)
def last_row_per_key(spark, sf):
    events = table(spark, sf, "events").select("user_id", "event_id", "event_type", "ts", "value")
    return rows.last_row_per_key(events, ["user_id"], _ORDER).drop("ts")


@query(
    "carry_last_assignment",
    """SELECT user_id, max_by(event_type, (ts, event_id)) FILTER (event_type IN ('signup', 'purchase')) AS status,
              max_by(value, (ts, event_id)) FILTER (value > 99) AS peak FROM events GROUP BY user_id""",
)
def carry_last_assignment(spark, sf):
    kind, value = F.col("event_type"), F.col("value")
    return rows.carry_last_assignment(
        table(spark, sf, "events"), ["user_id"], _ORDER,
        {"status": F.when(kind.isin("signup", "purchase"), kind), "peak": F.when(value > 99, value)},
    )


@query(
    "random_surrogate_id",
    "SELECT c_custkey, row_number() OVER (ORDER BY md5('20190122|' || c_custkey), c_custkey) AS obs FROM customer",
)
def random_surrogate_id(spark, sf):
    return rows.random_surrogate_id(table(spark, sf, "customer"), "c_custkey", 20190122)


_LINE = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


@query(
    "duplicate_keys",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {', '.join(_LINE)}) > 1""",
)
def duplicate_keys(spark, sf):
    lines = table(spark, sf, "lineitem")
    repeated = rows.duplicate_keys(lines, ["l_orderkey", "l_linenumber"], _LINE)
    return repeated.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")


@query(
    "duplicate_counts",
    "SELECT l_orderkey, l_linenumber, count(*) - 1 AS extra_rows FROM lineitem GROUP BY ALL HAVING count(*) > 1",
)
def duplicate_counts(spark, sf):
    return rows.duplicate_counts(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "dedupe_keys",
    """SELECT o_custkey, o_orderkey, o_totalprice FROM orders
       QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice, o_orderkey) = 1""",
)
def dedupe_keys(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return rows.dedupe_keys(orders, ["o_custkey"], ["o_totalprice", "o_orderkey"])


@query("multi_key_sort", "SELECT o_custkey, o_orderpriority, o_orderstatus, o_orderkey FROM orders ORDER BY 1, 2, 3 DESC, 4")
def multi_key_sort(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderpriority", "o_orderstatus", "o_orderkey")
    return rows.multi_key_sort(orders, "o_custkey", "o_orderpriority", F.col("o_orderstatus").desc(), "o_orderkey")
