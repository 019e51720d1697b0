"""Six program slots of a record as an array of structs, handled inside the row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom import fixed_values as fv
from cohortloom.functions.missing import _col
from cohortloom.operators.spread import order_struct

SLOT_FIELDS = list(fv.SLOT_LAYOUT)


def slots_pack(df: DataFrame, fields: list[str] | None = None, count: int = fv.SLOT_COUNT, name: str = "slots") -> DataFrame:
    """Columns field1..fieldN become one array of structs."""
    fields = fields or SLOT_FIELDS
    slots = [F.struct(*[F.col(f"{f}{i}").alias(f) for f in fields]) for i in range(1, count + 1)]
    wide = [f"{f}{i}" for f in fields for i in range(1, count + 1)]
    return df.withColumn(name, F.array(*slots)).drop(*wide)


def slots_flatten(df: DataFrame, fields: list[str] | None = None, count: int = fv.SLOT_COUNT, name: str = "slots") -> DataFrame:
    """The array becomes columns field1..fieldN again."""
    fields = fields or SLOT_FIELDS
    wide = {
        f"{f}{i}": F.get(F.col(name), i - 1)[f] for i in range(1, count + 1) for f in fields
    }
    return df.withColumns(wide).drop(name)


def slots_explode(
    df: DataFrame, condition=None, name: str = "slots", position: str = "slot", keep: list[str] | None = None
) -> DataFrame:
    """One row per slot that meets the condition; a row may come out several times."""
    columns = keep or [c for c in df.columns if c != name]
    # The outer form keeps the optimiser from evaluating the array a second time in an inferred filter.
    out = df.select(*columns, F.posexplode_outer(name).alias("_at", "_slot")).filter(F.col("_at").isNotNull())
    if condition is not None:
        out = out.filter(condition(F.col("_slot")))
    return out.select(*columns, (F.col("_at") + 1).alias(position), F.col("_slot.*"))


def slots_keep_newest(
    slots: Column | str, same: list[str], start: str, fields: list[str], count: int = fv.SLOT_COUNT
) -> Column:
    """Among slots equal on ``same``, the newest start moves to the first of them; the others go blank.

    Equal starts keep the earlier slot.  Slots compare blank-equal, which only
    blanks what is blank already.
    """
    slots = _col(slots)

    def equal(x, y):
        outcome = F.lit(True)
        for f in same:
            outcome = outcome & x[f].eqNullSafe(y[f])
        return outcome

    placed = F.transform(slots, lambda s, i: F.struct(s[start].alias("start"), (-i).alias("at"), s.alias("slot")))
    blank = F.struct(*[F.lit(None).cast("string").alias(f) for f in fields])

    def settle(s, i):
        group = F.filter(placed, lambda p: equal(p["slot"], s))
        lowest = -F.array_max(F.transform(group, lambda p: p["at"]))
        return F.when(lowest == i, F.array_max(group)["slot"]).otherwise(blank)

    return F.transform(slots, settle)


def slots_resolve(
    rows: DataFrame,
    keys: list[str],
    order: list[str],
    load: str,
    session_terms: list[str],
    term_start: str,
    grad_date: str,
    count: int = fv.SLOT_COUNT,
) -> DataFrame:
    """Program statuses of every student from all of the student's plan rows.

    ``rows`` has one row per student and plan, with the slot array, the plan's
    code and level (cip_code_sis, crd_lvl_sis), prog_status, nc_degr_ckout_stat,
    grad_strm and status_strm.  A plan touches the withdrawn slots with its code
    and level: completion carries G, stopping carries W, and an active plan
    that is the last row hands the slot the overall load.  The last carried
    status wins.  A graduation in one of ``session_terms`` sets end_dt.

    One aggregate per student: carried values and the last row, no window.
    """
    position = order_struct(*order)
    graduated = F.col("nc_degr_ckout_stat").eqNullSafe(fv.CHECKOUT_APPROVED) | F.col("prog_status").eqNullSafe(
        fv.PROGRAM_COMPLETED
    )
    in_session = F.coalesce(F.col("grad_strm").isin(session_terms), F.lit(False)) | F.coalesce(
        F.col("status_strm").isin(session_terms), F.lit(False)
    )

    def touched(slot):
        return (
            slot["cipcode"].eqNullSafe(F.col("cip_code_sis"))
            & slot["crd_lvl"].eqNullSafe(F.col("crd_lvl_sis"))
            & slot["prg_stat"].eqNullSafe(fv.WITHDRAWN)
        )

    def assigned(hit):
        stopped = F.col("prog_status").isin(fv.PROGRAM_STOPPED)
        return F.when(hit & F.col("_graduated"), fv.GRADUATED).when(hit & stopped, fv.WITHDRAWN)

    def active(hit):
        return hit & ~F.col("_graduated") & F.col("prog_status").eqNullSafe(fv.PROGRAM_ACTIVE)

    others = [c for c in rows.columns if c not in keys]
    marked = (
        rows.withColumns({"_graduated": graduated, "_hits": F.transform("slots", touched)})
        .withColumns({"_assigned": F.transform("_hits", assigned), "_active": F.transform("_hits", active)})
        .withColumn("_ended", F.exists("_hits", lambda hit: hit) & F.col("_graduated") & in_session)
    )
    letters = [F.get("_assigned", i) for i in range(count)]
    students = marked.groupBy(*keys).agg(
        F.max_by(F.struct(*others, "_active"), position).alias("_last"),
        F.bool_or("_ended").alias("_ended"),
        *[F.max_by(x, F.when(x.isNotNull(), position)).alias(f"_carried{i}") for i, x in enumerate(letters)],
    )
    students = students.select(
        *keys, "_ended", "_last.*", F.array(*[F.col(f"_carried{i}") for i in range(count)]).alias("_carried")
    )

    def settle(slot, i):
        own, load_now = slot["prg_stat"], F.col(load)
        carried, handed = F.get(F.col("_carried"), i), F.get(F.col("_active"), i)
        enrolled = handed | (own.isNotNull() & ~own.eqNullSafe(fv.WITHDRAWN))
        # An active last row hands over the load; a load of W then still yields to a carried status.
        yields = ~enrolled | (handed & load_now.eqNullSafe(fv.WITHDRAWN))
        status = F.when(yields & carried.isNotNull(), carried).when(enrolled, load_now).otherwise(own)
        date = F.when(
            slot["p_stat_dt"].isNull() & status.isNotNull(), F.greatest(F.lit(term_start), slot["prg_start"])
        ).otherwise(slot["p_stat_dt"])
        changed = {"prg_stat": status, "p_stat_dt": date}
        return F.struct(*[changed.get(f, slot[f]).alias(f) for f in SLOT_FIELDS])

    end_date = F.when(F.col("_ended"), F.lit(grad_date))
    if "end_dt" in others:
        end_date = F.coalesce(end_date, F.col("end_dt"))
    kept = [c for c in others if c not in ("slots", "end_dt")]
    return students.select(*keys, *kept, end_date.alias("end_dt"), F.transform("slots", settle).alias("slots"))
