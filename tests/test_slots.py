"""Slot operators against literal loops."""

import itertools
import random

from pyspark.sql import functions as F

from cohortloom.operators import slots

FIELDS = slots.SLOT_FIELDS


def newest_by_loops(record):
    """The double loop over slot pairs, each slot a (key, start) pair or blanks."""
    r = [list(x) for x in record]
    for i in range(6):
        for j in range(i + 1, 6):
            if r[i][0] == r[j][0]:
                if (r[i][1] or "") < (r[j][1] or ""):
                    r[i] = list(r[j])
                r[j] = [None, None]
    return [tuple(x) for x in r]


def test_keep_newest_matches_the_double_loop(spark):
    random.seed(5)
    choices = [(None, None), ("a", "1"), ("a", "2"), ("b", "1"), ("b", "2")]
    records = random.sample(list(itertools.product(choices, repeat=6)), 3000)
    df = spark.createDataFrame(
        [(n, [dict(zip(("cipcode", "prg_start"), s)) for s in r]) for n, r in enumerate(records)],
        "n int, slots array<struct<cipcode string, prg_start string>>",
    )
    newest = slots.slots_keep_newest("slots", ["cipcode"], "prg_start", ["cipcode", "prg_start"])
    once = df.withColumn("slots", newest)
    got = {r.n: [(s.cipcode, s.prg_start) for s in r.slots] for r in once.collect()}
    assert got == {n: newest_by_loops(r) for n, r in enumerate(records)}
    twice = once.withColumn("slots", newest)
    assert {r.n: r.slots for r in twice.collect()} == {r.n: r.slots for r in once.collect()}


def test_pack_flatten_round_trip(spark):
    wide = {f"{f}{i}": f"{f}-{i}" for f in FIELDS for i in range(1, 7)}
    df = spark.createDataFrame([tuple(["s1", *wide.values()])], ["emplid", *wide])
    packed = slots.slots_pack(df)
    assert len(packed.first().slots) == 6
    flat = slots.slots_flatten(packed).first().asDict()
    assert {k: flat[k] for k in wide} == wide


def resolve_by_steps(student, plans, term_start):
    """The per-row rules of one student, rows in order; slot columns are read afresh on every row."""
    carried, ended = [None] * 6, False
    for n, plan in enumerate(plans):
        current = [dict(s) for s in student]
        for i, s in enumerate(current):
            if s["cipcode"] == plan["cip"] and s["crd_lvl"] == plan["lvl"] and s["prg_stat"] == "W":
                if plan["ckout"] == "AP" or plan["prog"] == "CM":
                    carried[i] = "G"
                    ended = ended or "T1" in (plan["grad"], plan["status_term"])
                elif plan["prog"] == "AC":
                    s["prg_stat"] = plan["load"]
                elif plan["prog"] in ("DC", "CN", "LA", "DM"):
                    carried[i] = "W"
        if n == len(plans) - 1:
            for i, s in enumerate(current):
                if s["prg_stat"] not in (None, "W"):
                    s["prg_stat"] = plan["load"]
                elif carried[i] is not None:
                    s["prg_stat"] = carried[i]
                if s["p_stat_dt"] is None and s["prg_stat"] is not None:
                    s["p_stat_dt"] = max(term_start, s["prg_start"] or "")
            return [(s["prg_stat"], s["p_stat_dt"]) for s in current], ended


def test_resolve_matches_the_row_rules(spark):
    random.seed(11)
    rows, expected = [], {}
    for student in range(400):
        own = [
            dict(
                cipcode=random.choice(["c1", "c2", None]), crd_lvl=random.choice(["03", "05"]),
                prg_stat=random.choice(["W", "W", "F", None]), prg_start=random.choice(["20170101", "20180601", None]),
                p_stat_dt=random.choice([None, "20150101"]),
            )
            for _ in range(6)
        ]
        plans = [
            dict(
                cip=random.choice(["c1", "c2"]), lvl=random.choice(["03", "05"]),
                prog=random.choice(["CM", "AC", "AC", "DC", "LA", "ZZ", None]), ckout=random.choice(["AP", None, None, None]),
                grad=random.choice(["T1", "T2", None]), status_term=random.choice(["T1", None, None]),
                load=random.choice(["F", "H", "W"]),
            )
            for _ in range(random.randrange(1, 5))
        ]
        expected[student] = resolve_by_steps(own, plans, "20180516")
        packed = [tuple(s.get(f) for f in FIELDS) for s in own]
        rows += [
            (student, n, packed, p["cip"], p["lvl"], p["prog"], p["ckout"], p["grad"], p["status_term"], p["load"])
            for n, p in enumerate(plans)
        ]
    slot_type = ", ".join(f"{f} string" for f in FIELDS).replace(" string", ": string")
    df = spark.createDataFrame(
        rows,
        f"emplid int, n int, slots array<struct<{slot_type}>>, cip_code_sis string, crd_lvl_sis string, prog_status string, "
        "nc_degr_ckout_stat string, grad_strm string, status_strm string, load string",
    )
    out = slots.slots_resolve(df, ["emplid"], ["n"], "load", ["T1"], "20180516", "20180731")
    got = {r.emplid: ([(s.prg_stat, s.p_stat_dt) for s in r.slots], r.end_dt == "20180731") for r in out.collect()}
    assert got == expected


def test_explode_keeps_duplicates(spark):
    df = spark.createDataFrame(
        [("s", [("W",), ("F",), ("W",)])], "emplid string, slots array<struct<prg_stat: string>>"
    )
    out = slots.slots_explode(df, lambda s: s["prg_stat"] == F.lit("W"))
    assert sorted(r.slot for r in out.collect()) == [1, 3]
