"""Term codes: ``2``, two year digits, and a session digit (1 spring, 6 and 7 summer, 8 fall)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cohortloom.functions.missing import _col


def _term(year: Column, session: str) -> Column:
    return F.concat(F.lit("2"), F.lpad(F.pmod(year, F.lit(100)).cast("string"), 2, "0"), F.lit(session))


def _cycle(season: str, year: Column) -> Column:
    sessions = ["6", "7", "8"] if season == "Fall" else ["1"]
    return F.struct(
        F.lit(season).alias("season"),
        F.array(*[_term(year, s) for s in sessions]).alias("terms"),
        F.array(*[_term(year - 1, s) for s in sessions]).alias("history_terms"),
        _term(year, sessions[-1]).alias("semester"),
        _term(year - 1, sessions[-1]).alias("history_semester"),
    )


def term_calendar(run_date: Column | str) -> Column:
    """The admission cycles a run date reports on, as an array of one or two structs.

    November to January report fall and spring of the coming cycle, February to
    August fall of this year, September and October spring of next year.
    """
    run_date = _col(run_date)
    month, year = F.month(run_date), F.year(run_date)
    coming = F.when(month == 1, year).otherwise(year + 1)
    return (
        F.when(month.isin(11, 12, 1), F.array(_cycle("Fall", coming), _cycle("Spring", coming)))
        .when(month < 9, F.array(_cycle("Fall", year)))
        .otherwise(F.array(_cycle("Spring", year + 1)))
    )
