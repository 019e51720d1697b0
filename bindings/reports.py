"""Reports, cross tabulations and counters."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings import query, table
from cohortloom.operators import reports
from cohortloom.session import freeze

_CLASSES = ["c_mktsegment", "o_orderpriority"]
_MEASURES = ["applied", "admitted", "will_enter"]


def _applications(spark, sf):
    """Orders of customers: every order applied, F and P are admitted, F will enter."""
    orders = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("c_custkey"),
        "o_orderpriority",
        F.year("o_orderdate").alias("day"),
        F.lit(1).alias("applied"),
        F.col("o_orderstatus").isin("F", "P").cast("int").alias("admitted"),
        (F.col("o_orderstatus") == "F").cast("int").alias("will_enter"),
    )
    return orders.join(table(spark, sf, "customer").select("c_custkey", "c_mktsegment"), "c_custkey")


_SOURCE = """SELECT c_mktsegment, o_orderpriority, year(o_orderdate) AS day,
       CASE WHEN o_orderstatus IN ('F', 'P') THEN 1 ELSE 0 END AS admitted, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS will_enter
       FROM orders JOIN customer ON o_custkey = c_custkey"""
_LABELS = """CASE WHEN grouping(c_mktsegment) = 0 THEN 'c_mktsegment' WHEN grouping(o_orderpriority) = 0 THEN 'o_orderpriority' ELSE 'all' END AS dim,
       coalesce(c_mktsegment, o_orderpriority, 'Total') AS level"""
_SETS = "GROUP BY GROUPING SETS ((), (c_mktsegment), (o_orderpriority))"


@query(
    "totals_report",
    f"""SELECT {_LABELS}, count(*) AS applied, CAST(sum(admitted) AS BIGINT) AS admitted, CAST(sum(will_enter) AS BIGINT) AS will_enter,
               round(100.0 * sum(admitted) / count(*), 6) AS acceptance_pct, round(100.0 * sum(will_enter) / nullif(sum(admitted), 0), 6) AS yield_pct
        FROM ({_SOURCE}) {_SETS}""",
)
def totals_report(spark, sf):
    rates = {"acceptance_pct": ("admitted", "applied"), "yield_pct": ("will_enter", "admitted")}
    report = reports.totals_report(_applications(spark, sf), _CLASSES, _MEASURES, rates)
    return report.withColumns({name: F.round(name, 6) for name in rates})


@query(
    "ratio_of_sums",
    """SELECT c_nationkey, round(100.0 * count(*) FILTER (o_orderstatus = 'F')
              / nullif(count(*) FILTER (o_orderpriority = '1-URGENT' AND o_totalprice > 480000), 0), 6) AS ratio
       FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1""",
)
def ratio_of_sums(spark, sf):
    orders = table(spark, sf, "orders").join(
        table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey"
    )
    part = F.count_if(F.col("o_orderstatus") == "F")
    whole = F.count_if((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_totalprice") > 480000))
    return orders.groupBy("c_nationkey").agg(F.round(reports.ratio_of_sums(part, whole), 6).alias("ratio"))


@query(
    "snapshot_compare",
    f"""SELECT {_LABELS}, count(*) FILTER (day = 1998) AS applied_today, count(*) FILTER (day = 1997) AS applied_history,
               CAST(coalesce(sum(admitted) FILTER (day = 1998), 0) AS BIGINT) AS admitted_today,
               CAST(coalesce(sum(admitted) FILTER (day = 1997), 0) AS BIGINT) AS admitted_history,
               CAST(coalesce(sum(will_enter) FILTER (day = 1998), 0) AS BIGINT) AS will_enter_today,
               CAST(coalesce(sum(will_enter) FILTER (day = 1997), 0) AS BIGINT) AS will_enter_history
        FROM ({_SOURCE}) WHERE day IN (1997, 1998) {_SETS}""",
)
def snapshot_compare(spark, sf):
    return reports.snapshot_compare(_applications(spark, sf), _CLASSES, _MEASURES, "day", {1998: "today", 1997: "history"})


_CELLS = """SELECT {label} AS report, {dim}, count(*) FILTER (day = 1998) AS applied_today, count(*) FILTER (day = 1997) AS applied_history,
               CAST(coalesce(sum(admitted) FILTER (day = 1998), 0) AS BIGINT) AS admitted_today,
               CAST(coalesce(sum(admitted) FILTER (day = 1997), 0) AS BIGINT) AS admitted_history,
               CAST(coalesce(sum(will_enter) FILTER (day = 1998), 0) AS BIGINT) AS will_enter_today,
               CAST(coalesce(sum(will_enter) FILTER (day = 1997), 0) AS BIGINT) AS will_enter_history
        FROM ({source}) WHERE day IN (1997, 1998) {where} {sets}"""


@query(
    "reports_from_cells",
    " UNION ALL ".join(
        [
            _CELLS.format(label="'all'", dim=_LABELS, source=_SOURCE, where="", sets=_SETS),
            _CELLS.format(label="'urgent'", dim=_LABELS, source=_SOURCE, where="AND o_orderpriority = '1-URGENT'", sets=_SETS),
            _CELLS.format(
                label="'segments'", source=_SOURCE, where="", sets="GROUP BY GROUPING SETS ((), (c_mktsegment))",
                dim="CASE WHEN grouping(c_mktsegment) = 0 THEN 'c_mktsegment' ELSE 'all' END AS dim, coalesce(c_mktsegment, 'Total') AS level",
            ),
        ]
    ),
)
def reports_from_cells(spark, sf):
    """Three comparisons of two days from one pass over the applications."""
    cells = freeze(reports.report_cells(_applications(spark, sf), ["day"], _CLASSES, _MEASURES))
    tags = {1998: "today", 1997: "history"}
    due = {"all": (cells, _CLASSES), "urgent": (cells.filter("o_orderpriority = '1-URGENT'"), _CLASSES), "segments": (cells, _CLASSES[:1])}
    compared = [
        reports.snapshot_compare(df, class_vars, _MEASURES, "day", tags).withColumn("report", F.lit(name)) for name, (df, class_vars) in due.items()
    ]
    return compared[0].unionByName(compared[1]).unionByName(compared[2])


@query(
    "crosstab_full",
    """SELECT o_orderpriority, o_orderstatus, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS pct_total,
              round(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY o_orderpriority), 6) AS pct_row,
              round(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY o_orderstatus), 6) AS pct_col
       FROM orders GROUP BY 1, 2""",
)
def crosstab_full(spark, sf):
    full = reports.crosstab_full(table(spark, sf, "orders"), "o_orderpriority", "o_orderstatus")
    return full.withColumns({c: F.round(c, 6) for c in ("pct_total", "pct_row", "pct_col")})


@query(
    "crosstab_counts",
    """SELECT l_returnflag, CASE WHEN l_quantity > 10 THEN l_linestatus END AS status, count(*) AS n FROM lineitem
       WHERE l_quantity > 10 GROUP BY 1, 2""",
)
def crosstab_counts(spark, sf):
    status = F.when(F.col("l_quantity") > 10, F.col("l_linestatus"))
    return reports.crosstab_counts(table(spark, sf, "lineitem").withColumn("status", status), "l_returnflag", "status")


@query("distinct_rows", "SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus FROM lineitem")
def distinct_rows(spark, sf):
    return table(spark, sf, "lineitem").select("l_suppkey", "l_returnflag", "l_linestatus").distinct()
