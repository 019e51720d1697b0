"""Exact order statistics of groups of any size, without sorting them.

One pass sketches every group (a mergeable KLL sketch with a known rank error)
and so sets a narrow bracket around each wanted rank.  A second pass counts: rows outside the brackets by the gap they lie in,
rows inside by value.  Running sums over these few counts name the value at
each rank.  Where a bracket may still hold more values than one task should
sort, it is sketched once more before it is counted: three scans.  The counts
are exact, so the result never depends on the sketch; should a bracket miss its
rank, the gap the rank lies in is the next bracket.

Rows are only scanned and counted; nothing but counts is ever moved.
Infinities are the largest and smallest values; NaN counts as missing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from cohortloom.operators.spread import null_safe_on
from cohortloom.session import BROADCAST_ROWS, PIECE_ROWS, broadcast_if_small, freeze

K = 8192  # of the KLL sketch, whose ranks are off by 0.04 % with 99 % confidence
SLACK = 0.001  # of all rows, that a bracket is wider on either side
GRID = 128  # values that are read from a sketch, evenly spaced by rank
MAX_ROUNDS = 16  # two suffice, unless a sketch breaks its bound


def _sketch(x: Column, grid: int) -> Column:
    """Values at even steps of rank, by a sketch; null without values."""
    steps = F.expr(f"array({', '.join(f'{k / grid!r}D' for k in range(grid + 1))})")
    values = F.kll_sketch_get_quantile_double(F.kll_sketch_agg_double(x, K), steps)
    return F.when(F.count(x) > 0, values)


def _bracket(rank: str, n: str, sketch: str, lowest: str, highest: str, grid: int) -> str:
    """The values around a rank of n, and how many rows they may hold, as SQL."""
    low = f"cast(floor((try_divide({rank}, {n}) - {SLACK}) * {grid}) as int)"
    high = f"cast(ceil((try_divide({rank}, {n}) + {SLACK}) * {grid}) as int)"
    return f"""named_struct('lo', if({low} <= 0, {lowest}, get({sketch}, {low})), 'hi', if({high} >= {grid}, {highest}, get({sketch}, {high})),
        'rows', least({n} * (least({high}, {grid}) - greatest({low}, 0) + 2) / {grid}, double({n})))"""


def order_statistics(
    df: DataFrame, groups: list[str], value: str, ranks: dict[str, Column], grid: int = GRID, piece_rows: int = PIECE_ROWS,
    empty: bool = False,
) -> DataFrame:
    """The values at the wanted ranks, one row per group.

    ``ranks`` maps a name to a 1-based rank as an expression over ``n``, the
    group's number of values.  Missing values and NaN are not counted.  The result has
    the groups, n, missing, lowest, highest, mean and one column per name; a
    group without values has a row only with ``empty``.
    """
    data = df.select(*groups, F.nullif(F.col(value).cast("double"), F.lit(float("nan"))).alias("_x"))
    found = data.groupBy(*groups).agg(
        F.count("_x").alias("n"), F.count_if(F.col("_x").isNull()).alias("missing"), F.min("_x").alias("lowest"),
        F.max("_x").alias("highest"), F.avg("_x").alias("mean"), _sketch(F.col("_x"), grid).alias("_sketch"),
    )
    found = freeze(found)
    found = found.withColumns({f"_rank_{name}": rank.cast("bigint") for name, rank in ranks.items()})
    brackets = {
        f"_at_{name}": F.expr(_bracket(f"_rank_{name}", "n", "_sketch", "lowest", "highest", grid)) for name in ranks
    }
    one_value = F.expr("if(lowest = highest, lowest, null)")
    base = found.withColumns({**brackets, **dict.fromkeys(ranks, one_value)}).drop("_sketch")
    values = data.filter("_x IS NOT NULL")
    for number in range(MAX_ROUNDS + 1):
        rows = ", ".join(f"if({name} IS NULL, if(_at_{name}.lo = _at_{name}.hi, 1, _at_{name}.rows), null)" for name in ranks)
        still, size = base.agg(F.expr(f"max(if(n > 0, greatest(0D, {rows}), null))"), F.count("*")).first()
        if not still:
            return (base if empty else base.filter("n > 0")).drop(*[f"_rank_{n}" for n in ranks], *brackets)
        if number == MAX_ROUNDS:
            raise RuntimeError(f"ranks are still open after {MAX_ROUNDS} rounds")
        base = freeze(_narrow(values, base, groups, list(ranks), grid, size <= BROADCAST_ROWS, exact=still <= piece_rows))


def _narrow(values: DataFrame, base: DataFrame, groups: list[str], names: list[str], grid: int, few: bool, exact: bool) -> DataFrame:
    """One scan: the values of all ranks (``exact``), or narrower brackets around them."""
    ends = [F.expr(f"if({n} IS NULL, _at_{n}.{e}, null) AS _{e}{k}") for k, n in enumerate(names) for e in ("lo", "hi")]
    side = base.filter("n > 0").select(*[F.col(g).alias(f"_b_{g}") for g in groups], *ends)
    side = F.broadcast(side) if few else side
    each = range(len(names))
    inside = " OR ".join(f"coalesce(_x BETWEEN _lo{k} AND _hi{k}, false)" for k in each)
    start = "_x" if exact else f"greatest(double(null), {', '.join(f'if(_lo{k} <= _x, _lo{k}, null)' for k in each)})"
    gap_after = f"greatest(double(null), {', '.join(f'if(_hi{k} < _x, _hi{k}, null)' for k in each)})"
    joined = values.join(side, null_safe_on(values, side, groups, "_b_"))
    keyed = joined.select(*groups, "_x", F.expr(f"({inside}) AS _in"), F.expr(f"if({inside}, {start}, {gap_after}) AS _at"))
    sums = [F.count("*").alias("_n"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi")]
    if not exact:
        sums.append(_sketch(F.expr("if(_in, _x, null)"), grid).alias("_sketch"))
    counted = keyed.groupBy(*groups, "_at", "_in").agg(*sums)
    # a gap lies after the end it is named by, and after the values up to that end
    in_order = Window.partitionBy(*groups).orderBy(F.col("_at").asc_nulls_first(), F.col("_in").desc()).rowsBetween(Window.unboundedPreceding, 0)
    counted = counted.withColumn("_upto", F.sum("_n").over(in_order))
    asked = base.select(*[F.col(g).alias(f"_b_{g}") for g in groups], *[f"_rank_{n}" for n in names])
    met = counted.join(F.broadcast(asked) if few else asked, null_safe_on(counted, asked, groups, "_b_"))
    hits = []
    for n in names:
        rank = f"(_rank_{n} - _upto + _n)"
        hit = f"({rank} > 0 AND {rank} <= _n)"
        then = "named_struct('lo', _lo, 'hi', _hi, 'rows', double(_n))"
        if exact:
            hits.append(F.expr(f"max(if({hit} AND _in, _at, null)) AS _new_{n}"))
        else:
            then = f"if(_in, {_bracket(rank, '_n', '_sketch', '_lo', '_hi', grid)}, {then})"
        hits.append(F.expr(f"max(if({hit}, {then}, null)) AS _then_{n}"))
    found = [c for n in names for c in ([f"_new_{n}"] if exact else []) + [f"_then_{n}"]]
    met = met.groupBy(*groups).agg(*hits).select(*[F.col(g).alias(f"_m_{g}") for g in groups], *found)
    merged = base.join(met, null_safe_on(base, met, groups, "_m_"), "left")
    update = {f"_at_{n}": F.expr(f"if({n} IS NULL, _then_{n}, _at_{n})") for n in names}
    if exact:
        update |= {n: F.expr(f"coalesce({n}, _new_{n})") for n in names}
    return merged.withColumns(update).select(*base.columns)


def _type7(p: float, name: str) -> dict[str, Column]:
    """Ranks on both sides of the interpolated position 1 + (n - 1) p."""
    at = F.lit(1.0) + (F.col("n") - 1) * F.lit(p)
    return {f"{name}_below": F.floor(at), f"{name}_above": F.ceil(at)}


def quantiles(df: DataFrame, groups: list[str], value: str, points: dict[str, float], empty: bool = False) -> DataFrame:
    """Interpolated quantiles (position 1 + (n - 1) p) per group."""
    ranks: dict[str, Column] = {}
    for name, p in points.items():
        ranks.update(_type7(p, name))
    found = order_statistics(df, groups, value, ranks, empty=empty)
    for name, p in points.items():
        at = F.lit(1.0) + (F.col("n") - 1) * F.lit(p)
        low, high = F.col(f"{name}_below"), F.col(f"{name}_above")
        found = found.withColumn(name, F.when(low == high, low).otherwise(low + (at - F.floor(at)) * (high - low)))
    return found.drop(*ranks)


def column_summary(df: DataFrame, columns: list[str]) -> DataFrame:
    """Minimum, quartiles, mean, maximum and missing count (NaN is missing), one row per column."""
    long = df.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in columns])).alias("v")
    ).select("v.column", "v.x")
    summary = quantiles(long, ["column"], "x", {"q1": 0.25, "median": 0.5, "q3": 0.75}, empty=True)
    return summary.select("column", F.col("lowest").alias("min"), "q1", "median", "mean", "q3", F.col("highest").alias("max"), "missing")


def box_summary(df: DataFrame, group: str, value: str) -> DataFrame:
    """Hinges, whiskers, notch and outlier count of every group.

    Hinge depth is floor((n + 3) / 2) / 2, averaged over its two neighbours;
    whiskers reach the last value within 1.5 hinge spreads; the notch is
    median +/- 1.58 spreads / sqrt(n).
    """
    depth = F.floor((F.col("n") + 3) / 2) / 2
    middle = (F.col("n") + 1) / F.lit(2.0)
    found = order_statistics(
        df,
        [group],
        value,
        {
            "_l1": F.floor(depth), "_l2": F.ceil(depth),
            "_m1": F.floor(middle), "_m2": F.ceil(middle),
            "_u1": F.floor(F.col("n") + 1 - depth), "_u2": F.ceil(F.col("n") + 1 - depth),
        },
    )
    hinges = found.select(
        group, "n",
        ((F.col("_l1") + F.col("_l2")) / 2).alias("lower_hinge"),
        ((F.col("_m1") + F.col("_m2")) / 2).alias("median"),
        ((F.col("_u1") + F.col("_u2")) / 2).alias("upper_hinge"),
    )
    spread = F.col("upper_hinge") - F.col("lower_hinge")
    fences = freeze(
        hinges.select(
            F.col(group).alias("_g"), "n", "lower_hinge", "median", "upper_hinge",
            (F.col("lower_hinge") - 1.5 * spread).alias("_low_fence"),
            (F.col("upper_hinge") + 1.5 * spread).alias("_high_fence"),
            (F.col("median") - 1.58 * spread / F.sqrt("n")).alias("notch_low"),
            (F.col("median") + 1.58 * spread / F.sqrt("n")).alias("notch_high"),
        )
    )
    x = F.col(value)
    reach = (
        df.filter(x.isNotNull() & ~F.isnan(x.cast("double")))
        .select(group, value)
        .join(broadcast_if_small(fences), F.col(group).eqNullSafe(F.col("_g")))
        .groupBy(group)
        .agg(
            F.min(F.when(x >= F.col("_low_fence"), x)).alias("lower_whisker"),
            F.max(F.when(x <= F.col("_high_fence"), x)).alias("upper_whisker"),
            F.count_if((x < F.col("_low_fence")) | (x > F.col("_high_fence"))).alias("outliers"),
        )
    )
    return reach.join(fences, F.col(group).eqNullSafe(F.col("_g"))).select(
        group, "n", "lower_whisker", "lower_hinge", "median", "upper_hinge", "upper_whisker",
        "notch_low", "notch_high", "outliers",
    )
