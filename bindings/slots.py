"""Slot arrays: each record holds up to six consecutive orders of a customer.

All orders are used: a customer's orders, in date order, are cut into records
of six.  Priority is the code, status the level, the order date the start.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings import query, table
from cohortloom import fixed_values as fv
from cohortloom.operators import checks, joins, slots
from cohortloom.operators.spread import rank_within

KEYS = ["o_custkey", "record"]

_NUMBERED = """SELECT *, CAST((rn - 1) // 6 AS BIGINT) AS record, CAST((rn - 1) % 6 + 1 AS INTEGER) AS slot FROM (
    SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders)"""
# A level of H belongs to large orders, which keeps code and level of two orders often equal.
_SLOT = """o_custkey, record, slot, left(o_orderpriority, 1) AS cipcode,
    CASE WHEN o_totalprice > 300000 THEN '06' ELSE '03' END AS crd_lvl, '4' AS prog_len,
    strftime(o_orderdate, '%Y%m%d') AS prg_start, CASE o_orderstatus WHEN 'F' THEN 'W' WHEN 'O' THEN 'F' ELSE 'H' END AS prg_stat,
    CASE WHEN o_orderpriority = '5-LOW' THEN strftime(o_orderdate, '%Y%m%d') END AS p_stat_dt, o_orderkey, o_totalprice, o_orderstatus"""
_FILLED = f"SELECT {_SLOT} FROM ({_NUMBERED})"
# Every record has six slots, the last ones possibly blank.
_GRID = f"""f AS ({_FILLED}), g AS (SELECT o_custkey, record, CAST(unnest(range(1, 7)) AS INTEGER) AS slot FROM
    (SELECT DISTINCT o_custkey, record FROM f)), s AS (SELECT g.o_custkey, g.record, g.slot, f.* EXCLUDE (o_custkey, record, slot)
    FROM g LEFT JOIN f ON f.o_custkey = g.o_custkey AND f.record = g.record AND f.slot = g.slot)"""


def numbered(spark, sf):
    ranked = rank_within(table(spark, sf, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"], "rn")
    return ranked.withColumn("record", F.floor((F.col("rn") - 1) / 6)).withColumn(
        "slot", ((F.col("rn") - 1) % 6 + 1).cast("int")
    )


def records(rows):
    """One row per record with its slot array (a record has at most six orders)."""
    day = F.date_format("o_orderdate", "yyyyMMdd")
    text = {
        "cipcode": F.substring("o_orderpriority", 1, 1),
        "crd_lvl": F.when(F.col("o_totalprice") > 300000, "06").otherwise("03"),
        "prog_len": F.lit("4"),
        "prg_start": day,
        "prg_stat": F.when(F.col("o_orderstatus") == "F", "W").when(F.col("o_orderstatus") == "O", "F").otherwise("H"),
        "p_stat_dt": F.when(F.col("o_orderpriority") == "5-LOW", day),
    }
    blank = F.lit(None).cast("string")
    filled = F.struct(*[text.get(f, blank).alias(f) for f in slots.SLOT_FIELDS])
    empty = F.struct(*[blank.alias(f) for f in slots.SLOT_FIELDS])
    in_order = F.transform(F.array_sort(F.collect_list(F.struct("slot", filled.alias("s")))), lambda x: x["s"])
    packed = rows.groupBy(*KEYS).agg(in_order.alias("filled"))
    six = F.transform(F.sequence(F.lit(0), F.lit(fv.SLOT_COUNT - 1)), lambda i: F.coalesce(F.get("filled", i), empty))
    return packed.select(*KEYS, six.alias("slots"))


def _slot_rows(df):
    return slots.slots_explode(df, keep=KEYS).select(*KEYS, "slot", "cipcode", "crd_lvl", "prg_start", "prg_stat", "p_stat_dt")


_OUT = "o_custkey, record, slot, cipcode, crd_lvl, prg_start, prg_stat, p_stat_dt"


@query(
    "slots_pack",
    f"""WITH {_GRID} SELECT o_custkey, record, string_agg(coalesce(cipcode, '-') || coalesce(crd_lvl, '-'), '/' ORDER BY slot) AS codes,
           max(CASE slot WHEN 6 THEN prg_start END) AS prg_start6, max(CASE slot WHEN 1 THEN prg_stat END) AS prg_stat1
        FROM s GROUP BY ALL""",
)
def slots_pack(spark, sf):
    packed = slots.slots_pack(slots.slots_flatten(records(numbered(spark, sf))))
    codes = F.transform(
        "slots", lambda s: F.concat(F.coalesce(s["cipcode"], F.lit("-")), F.coalesce(s["crd_lvl"], F.lit("-")))
    )
    flat = slots.slots_flatten(packed.withColumn("codes", F.array_join(codes, "/")))
    return flat.select(*KEYS, "codes", "prg_start6", "prg_stat1")


@query("slots_explode", f"SELECT {_OUT} FROM ({_FILLED}) WHERE prg_stat = 'W'")
def slots_explode(spark, sf):
    out = slots.slots_explode(records(numbered(spark, sf)), lambda s: s["prg_stat"] == fv.WITHDRAWN, keep=KEYS)
    return out.select(*KEYS, "slot", "cipcode", "crd_lvl", "prg_start", "prg_stat", "p_stat_dt")


_NEWEST = f"""{_GRID}, k AS (
    SELECT o_custkey, record, cipcode, crd_lvl, prog_len, min(slot) AS slot, max_by(slot, (coalesce(prg_start, ''), -slot)) AS newest
    FROM s GROUP BY ALL)
    SELECT g.o_custkey, g.record, g.slot, n.cipcode, n.crd_lvl, n.prg_start, n.prg_stat, n.p_stat_dt FROM g
    LEFT JOIN k ON k.o_custkey = g.o_custkey AND k.record = g.record AND k.slot = g.slot
    LEFT JOIN s n ON n.o_custkey = k.o_custkey AND n.record = k.record AND n.slot = k.newest"""


@query("slots_keep_newest", f"WITH {_NEWEST}")
def slots_keep_newest(spark, sf):
    df = records(numbered(spark, sf))
    newest = slots.slots_keep_newest("slots", ["cipcode", "crd_lvl", "prog_len"], "prg_start", slots.SLOT_FIELDS)
    return _slot_rows(df.withColumn("slots", newest))


# Plan rows of a record: its own orders in key order, with a program status by price.
_PLANS = """SELECT o_custkey, record, o_orderkey, left(o_orderpriority, 1) AS cip, CASE WHEN o_totalprice > 200000 THEN '06' ELSE '03' END AS lvl,
    CASE WHEN o_totalprice > 440000 THEN 'CM' WHEN o_totalprice > 330000 THEN 'AC' WHEN o_totalprice > 280000 THEN 'LA'
         WHEN o_totalprice > 60000 THEN 'AC' WHEN o_totalprice > 50000 THEN 'DC' ELSE 'XX' END AS prog,
    CASE WHEN o_orderpriority = '1-URGENT' AND o_totalprice > 150000 THEN 'AP' END AS ckout, strftime(o_orderdate, '2%y6') AS term,
    CASE o_orderstatus WHEN 'P' THEN 'W' ELSE o_orderstatus END AS load FROM n"""
_RESOLVE = f"""n AS ({_NUMBERED}), {_GRID}, p AS ({_PLANS}),
    lastp AS (SELECT o_custkey, record, max(o_orderkey) AS last_key, max_by(load, o_orderkey) AS load FROM p GROUP BY ALL),
    hits AS (SELECT s.o_custkey, s.record, s.slot, p.o_orderkey, p.prog, p.ckout IS NOT DISTINCT FROM 'AP' OR p.prog = 'CM' AS grad, p.term
             FROM s JOIN p ON p.o_custkey = s.o_custkey AND p.record = s.record AND p.cip = s.cipcode AND p.lvl = s.crd_lvl AND s.prg_stat = 'W'),
    carry AS (SELECT o_custkey, record, slot, max_by(CASE WHEN grad THEN 'G' ELSE 'W' END, o_orderkey) FILTER (grad OR prog IN ('DC', 'CN', 'LA', 'DM')) AS carried
              FROM hits GROUP BY ALL),
    act AS (SELECT DISTINCT h.o_custkey, h.record, h.slot FROM hits h JOIN lastp l ON l.o_custkey = h.o_custkey AND l.record = h.record
            AND l.last_key = h.o_orderkey WHERE NOT grad AND prog = 'AC'),
    ended AS (SELECT DISTINCT o_custkey, record FROM hits WHERE grad AND term = '2986'),
    st AS (SELECT s.*, CASE WHEN (a.slot IS NOT NULL AND l.load <> 'W') OR (a.slot IS NULL AND s.prg_stat <> 'W') THEN l.load
                            ELSE coalesce(c.carried, s.prg_stat) END AS status, l.load, e.record IS NOT NULL AS is_ended
           FROM s JOIN lastp l ON l.o_custkey = s.o_custkey AND l.record = s.record
           LEFT JOIN carry c ON c.o_custkey = s.o_custkey AND c.record = s.record AND c.slot = s.slot
           LEFT JOIN act a ON a.o_custkey = s.o_custkey AND a.record = s.record AND a.slot = s.slot
           LEFT JOIN ended e ON e.o_custkey = s.o_custkey AND e.record = s.record)"""


def _resolved(orders):
    price, priority = F.col("o_totalprice"), F.col("o_orderpriority")
    program = (
        F.when(price > 440000, "CM").when(price > 330000, "AC").when(price > 280000, "LA").when(price > 60000, "AC")
        .when(price > 50000, "DC").otherwise("XX")
    )
    term = F.concat(F.lit("2"), F.date_format("o_orderdate", "yy"), F.lit("6"))
    plans = orders.select(
        *KEYS, "o_orderkey", F.substring(priority, 1, 1).alias("cip_code_sis"),
        F.when(price > 200000, "06").otherwise("03").alias("crd_lvl_sis"), program.alias("prog_status"),
        F.when((priority == "1-URGENT") & (price > 150000), "AP").alias("nc_degr_ckout_stat"),
        term.alias("grad_strm"), F.lit(None).cast("string").alias("status_strm"),
        F.when(F.col("o_orderstatus") == "P", "W").otherwise(F.col("o_orderstatus")).alias("load"),
    )
    rows = plans.join(records(orders), KEYS)
    return slots.slots_resolve(rows, KEYS, ["o_orderkey"], "load", ["2986"], "19980516", "19980731")


@query(
    "slots_resolve",
    f"""WITH {_RESOLVE} SELECT o_custkey, record, slot, status AS prg_stat,
            CASE WHEN p_stat_dt IS NULL AND status IS NOT NULL THEN greatest('19980516', prg_start) ELSE p_stat_dt END AS p_stat_dt,
            CASE WHEN is_ended THEN '19980731' END AS end_dt, load FROM st""",
)
def slots_resolve(spark, sf):
    resolved = _resolved(numbered(spark, sf)).select(*KEYS, "end_dt", "load", "slots")
    return slots.slots_explode(resolved).select(*KEYS, "slot", "prg_stat", "p_stat_dt", "end_dt", "load")


@query(
    "or_theta_flag",
    f"""WITH {_RESOLVE} SELECT o_custkey, record, CASE WHEN bool_or(prg_stat = 'W' AND status <> 'W' AND status <> 'G') THEN 'Y' ELSE 'N' END AS w_comp
        FROM st GROUP BY ALL""",
)
def or_theta_flag(spark, sf):
    orders = numbered(spark, sf)
    before = slots.slots_explode(records(orders), lambda s: s["prg_stat"] == fv.WITHDRAWN, keep=KEYS).select(*KEYS, "slot")

    def changed(k):
        status = F.get(F.col("slots"), k)["prg_stat"]
        return ~status.eqNullSafe(fv.WITHDRAWN) & ~status.eqNullSafe(fv.GRADUATED)

    places = range(fv.SLOT_COUNT)
    flagged = joins.theta_flag(
        _resolved(orders).select(*KEYS, "slots"), before, KEYS, [F.col("slot") == k + 1 for k in places],
        [changed(k) for k in places], "w_comp",
    )
    return flagged.drop("slots")


@query(
    "comma_join_where",
    f"""WITH {_RESOLVE} SELECT o_custkey, record, slot, cipcode, prg_stat AS prg_stat_before, status AS prg_stat_combine, crd_lvl FROM st
        WHERE prg_stat = 'W' AND status <> 'W' AND status <> 'G'""",
)
def comma_join_where(spark, sf):
    orders = numbered(spark, sf)
    before = slots.slots_explode(records(orders), lambda s: s["prg_stat"] == fv.WITHDRAWN, keep=KEYS).select(
        *KEYS, "slot", "cipcode", "crd_lvl", F.col("prg_stat").alias("prg_stat_before")
    )
    after = slots.slots_explode(_resolved(orders), keep=KEYS).select(*KEYS, "slot", F.col("prg_stat").alias("prg_stat_combine"))
    return joins.conditional_join(
        before, after, [*KEYS, "slot"], checks.overwritten("prg_stat_before", "prg_stat_combine")
    )


@query(
    "check_overwritten_status",
    f"""WITH {_RESOLVE} SELECT 'overwritten_status' AS "check", count(*) AS violations FROM st
        WHERE prg_stat = 'W' AND status <> 'W' AND status <> 'G'""",
)
def check_overwritten_status(spark, sf):
    orders = numbered(spark, sf)
    before = slots.slots_explode(records(orders), lambda s: s["prg_stat"] == fv.WITHDRAWN, keep=KEYS).select(
        *KEYS, "slot", F.col("prg_stat").alias("before")
    )
    after = slots.slots_explode(_resolved(orders), keep=KEYS).select(*KEYS, "slot", F.col("prg_stat").alias("after"))
    found = checks.check_overwritten_status(before, after, [*KEYS, "slot"], [("before", "after")])
    return checks.violations({"overwritten_status": found})
