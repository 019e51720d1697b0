"""Joins: match-merge, dated and as-of lookups, null-matching joins, existence flags.

Latest-row lookups are aggregates (max per key) joined back on key *and* date, so
a key with many dated rows is spread by its dates.  Existence questions are
answered by aggregates too; no operator forms the pairs of a group.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from cohortloom.functions.missing import blank_to_null
from cohortloom.operators.spread import hot_keys, join_back, null_safe_on, order_struct, rank_by_position, split_hot
from cohortloom.session import HOT_ROWS


def match_merge(
    a: DataFrame, b: DataFrame, keys: list[str], order_a: list[str], order_b: list[str],
    hot_rows: int = HOT_ROWS, suffixes: tuple[str, str] = ("_a", "_b"),
) -> DataFrame:
    """Merge two tables by key, row by row, ``b`` overlaying ``a``.

    A key with nA and nB rows gives max(nA, nB) rows; row i pairs the rows
    min(i, nA) and min(i, nB).  In shared columns b's value wins while i <= nB,
    a missing value included; later rows keep a's.  A shared column c is also
    returned untouched as c_a and c_b (missing when the key is not on that
    side).  in_a and in_b say on which sides the key occurs.

    Both sides are stacked and shuffled once by key; hot keys, if any, are
    paired apart by position.
    """
    hot = hot_keys(keys, hot_rows, a, b)
    if hot is None:
        paired = _pair_in_key(a, b, keys, order_a, order_b)
    else:
        (hot_a, cold_a), (hot_b, cold_b) = split_hot(a, hot, keys), split_hot(b, hot, keys)
        paired = _pair_in_key(cold_a, cold_b, keys, order_a, order_b).unionByName(
            _pair_by_position(hot_a, hot_b, keys, order_a, order_b)
        )
    shared = [c for c in a.columns if c in b.columns and c not in keys]
    return paired.select(
        *keys,
        F.col("_i").alias("row_in_key"),
        F.col("_a").isNotNull().alias("in_a"),
        F.col("_b").isNotNull().alias("in_b"),
        *[F.col(f"_a.{c}").alias(c) for c in a.columns if c not in [*keys, *shared]],
        *[F.when(F.col("_b_wins"), F.col(f"_b.{c}")).otherwise(F.col(f"_a.{c}")).alias(c) for c in shared],
        *[F.col(f"_b.{c}").alias(c) for c in b.columns if c not in [*keys, *shared]],
        *[F.col(f"_a.{c}").alias(c + suffixes[0]) for c in shared],
        *[F.col(f"_b.{c}").alias(c + suffixes[1]) for c in shared],
    )


def _values(df: DataFrame, keys: list[str]) -> Column:
    return F.struct(*[c for c in df.columns if c not in keys])


def _pair_in_key(a: DataFrame, b: DataFrame, keys: list[str], order_a: list[str], order_b: list[str]) -> DataFrame:
    """Paired rows (keys, _i, _a, _b, _b_wins) by windows over one hash partitioning."""
    stacked = a.select(*keys, order_struct(*order_a).alias("_order_a"), _values(a, keys).alias("_a")).unionByName(
        b.select(*keys, order_struct(*order_b).alias("_order_b"), _values(b, keys).alias("_b")), allowMissingColumns=True
    ).repartition(*keys)
    in_side = Window.partitionBy(*keys, F.col("_a").isNull()).orderBy("_order_a", "_order_b")
    so_far = Window.partitionBy(*keys).orderBy("_i").rowsBetween(Window.unboundedPreceding, 0)
    pairs = (
        stacked.withColumn("_i", F.row_number().over(in_side).cast("bigint"))
        .groupBy(*keys, "_i")
        .agg(F.first("_a", ignorenulls=True).alias("_a"), F.first("_b", ignorenulls=True).alias("_b"))
    )
    return pairs.select(
        *keys,
        "_i",
        F.last("_a", ignorenulls=True).over(so_far).alias("_a"),
        F.last("_b", ignorenulls=True).over(so_far).alias("_b"),
        F.col("_b").isNotNull().alias("_b_wins"),
    )


def _pair_by_position(a: DataFrame, b: DataFrame, keys: list[str], order_a: list[str], order_b: list[str]) -> DataFrame:
    """The same pairs for a few keys of any size: joined on key and row number."""

    def side(df, order, name, prefix):
        ranked = rank_by_position(df, keys, order, "_i")
        return ranked.select(
            *[F.col(k).alias(prefix + k) for k in keys], F.col("_i").alias(f"{prefix}_i"), _values(df, keys).alias(name)
        )

    def last_row(df, order, name, prefix):
        last = F.max_by(_values(df, keys), order_struct(*order)).alias(name)
        return F.broadcast(df.groupBy(*keys).agg(last).select(*[F.col(k).alias(prefix + k) for k in keys], name))

    left, right = side(a, order_a, "_a", ""), side(b, order_b, "_b", "_r_")
    pairs = left.join(right, null_safe_on(left, right, [*keys, "_i"], "_r_"), "full").select(
        *[F.when(F.col("_a").isNotNull(), F.col(k)).otherwise(F.col(f"_r_{k}")).alias(k) for k in keys],
        F.coalesce("_i", "_r__i").alias("_i"),
        F.col("_a").alias("_own_a"),
        F.col("_b").alias("_own_b"),
    )
    for df, order, name, prefix in ((a, order_a, "_last_a", "_la_"), (b, order_b, "_last_b", "_lb_")):
        closing = last_row(df, order, name, prefix)
        pairs = pairs.join(closing, null_safe_on(pairs, closing, keys, prefix), "left")
    return pairs.select(
        *keys,
        "_i",
        F.coalesce("_own_a", "_last_a").alias("_a"),
        F.coalesce("_own_b", "_last_b").alias("_b"),
        F.col("_own_b").isNotNull().alias("_b_wins"),
    )


def left_lookup_chain(df: DataFrame, *steps: tuple[DataFrame, str, str]) -> DataFrame:
    """Left joins through codes; each step is (lookup, column here, key there).

    No hint: Spark broadcasts a lookup when its size allows.
    """
    for lookup, here, there in steps:
        side = lookup.withColumnRenamed(there, "_lookup_key")
        df = df.join(side, F.col(here) == F.col("_lookup_key"), "left").drop("_lookup_key")
    return df


def left_join_filtered(left: DataFrame, right: DataFrame, keys: list[str], condition: Column) -> DataFrame:
    """Left join whose extra conditions concern the right side only: filter, then join."""
    return left.join(right.filter(condition), keys, "left")


def computed_key_join(left: DataFrame, right: DataFrame, key: Column, right_key: str, how: str = "left") -> DataFrame:
    """Join on a key computed from earlier columns, materialised so the join stays an equi-join."""
    side = right.withColumnRenamed(right_key, "_side_key")
    return (
        left.withColumn("_computed", key)
        .join(side, F.col("_computed") == F.col("_side_key"), how)
        .drop("_computed", "_side_key")
    )


def null_matching_join(
    left: DataFrame, right: DataFrame, keys: list[str], how: str = "left", null_keys_match: bool = True
) -> DataFrame:
    """Equi-join in which missing keys match each other (unless switched off)."""
    side = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    if null_keys_match:
        condition = null_safe_on(left, side, keys, "_r_")
    else:
        condition = reduce(lambda x, y: x & y, [left[k] == side[f"_r_{k}"] for k in keys])
    return left.join(side, condition, how).drop(*[f"_r_{k}" for k in keys])


def nonblank_key_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Inner join that leaves out missing and blank keys."""
    return left.filter(blank_to_null(F.col(key).cast("string")).isNotNull()).join(right, key)


def correlated_max(df: DataFrame, keys: list[str], value: str, condition: Column | None = None) -> DataFrame:
    """The largest value per key among the rows that meet the condition."""
    rows = df if condition is None else df.filter(condition)
    return rows.groupBy(*keys).agg(F.max(value).alias(f"max_{value}"))


def latest_rows(df: DataFrame, keys: list[str], date: str, condition: Column | None = None) -> DataFrame:
    """All rows (ties kept) that carry the greatest date of their key.

    ``condition`` limits which rows count and can be returned.
    """
    rows = df if condition is None else df.filter(condition)
    latest = correlated_max(rows, keys, date).select(
        *[F.col(k).alias(f"_m_{k}") for k in keys], F.col(f"max_{date}").alias(f"_m_{date}")
    )
    return rows.join(latest, null_safe_on(rows, latest, [*keys, date], "_m_"), "left_semi")


def effective_dated_join(
    left: DataFrame, dated: DataFrame, on: list[str], date: str, as_of: Column, keys: list[str] | None = None
) -> DataFrame:
    """Left join to the rows with the greatest date not after ``as_of``; ties kept.

    ``keys`` is what the date is the greatest within, by default the join columns.
    """
    current = latest_rows(dated, keys or on, date, F.col(date) <= as_of)
    return left.join(current, on, "left")


def latest_then_status(left: DataFrame, dated: DataFrame, on: list[str], date: str, active: Column) -> DataFrame:
    """Latest row first, whatever its status; joined only if it is active."""
    return left.join(latest_rows(dated, on, date).filter(active), on, "left")


def latest_active(
    left: DataFrame, dated: DataFrame, on: list[str], date: str, active: Column, keys: list[str] | None = None
) -> DataFrame:
    """Active rows first, the latest of those joined."""
    return left.join(latest_rows(dated, keys or on, date, active), on, "left")


def asof_keys(
    left: DataFrame, right: DataFrame, keys: list[str], left_term: str, right_term: str, bucket=None
) -> DataFrame:
    """For every distinct (key, left term), the greatest right term not after it.

    Works on distinct terms.  ``bucket`` is a monotone function of a term column
    (such as the hour of a timestamp) that cuts long histories into pieces: the
    last value is looked up inside the piece, and what earlier pieces carry over
    comes from one row per (key, piece).  Term codes are few, so they need none.
    """
    ticks = (
        left.select(*keys, F.col(left_term).alias("_t"), F.lit(False).alias("_right"))
        .unionByName(right.select(*keys, F.col(right_term).alias("_t"), F.lit(True).alias("_right")))
        .filter(F.col("_t").isNotNull())
        .distinct()
        .withColumn("_known", F.when(F.col("_right"), F.col("_t")))
    )
    so_far = [F.col("_t"), F.col("_right").desc()]
    if bucket is None:
        inside = Window.partitionBy(*keys).orderBy(*so_far).rowsBetween(Window.unboundedPreceding, 0)
        found = ticks.withColumn("_match", F.max("_known").over(inside))
    else:
        ticks = ticks.withColumn("_piece", bucket(F.col("_t")))
        inside = Window.partitionBy(*keys, "_piece").orderBy(*so_far).rowsBetween(Window.unboundedPreceding, 0)
        earlier = Window.partitionBy(*keys).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
        pieces = ticks.groupBy(*keys, "_piece").agg(F.max("_known").alias("_top"))
        carried = pieces.select(
            *[F.col(k).alias(f"_c_{k}") for k in [*keys, "_piece"]], F.max("_top").over(earlier).alias("_carried")
        )
        local = ticks.withColumn("_local", F.max("_known").over(inside))
        found = local.join(carried, null_safe_on(local, carried, [*keys, "_piece"], "_c_")).withColumn(
            "_match", F.coalesce("_local", "_carried")
        )
    return found.filter(~F.col("_right")).select(
        *keys, F.col("_t").alias(left_term), F.col("_match").alias("matched_term")
    )


def asof_term_join(
    left: DataFrame, right: DataFrame, keys: list[str], left_term: str, right_term: str, bucket=None
) -> DataFrame:
    """Left join to the right rows of the greatest term not after the row's own; ties kept.

    ``matched_term`` is that term.  Both joins are on key and term together, so
    a key with a long history is spread over its terms.
    """
    terms = asof_keys(left, right, keys, left_term, right_term, bucket)
    side_terms = terms.select(*[F.col(c).alias(f"_t_{c}") for c in [*keys, left_term]], "matched_term")
    marked = left.join(side_terms, null_safe_on(left, side_terms, [*keys, left_term], "_t_"), "left").drop(
        *[f"_t_{c}" for c in [*keys, left_term]]
    )
    side = right.select(
        *[F.col(k).alias(f"_r_{k}") for k in keys],
        F.col(right_term).alias("_r_term"),
        *[c for c in right.columns if c not in [*keys, right_term]],
    )
    condition = null_safe_on(marked, side, keys, "_r_") & (marked["matched_term"] == side["_r_term"])
    return marked.join(side, condition, "left").drop("_r_term", *[f"_r_{k}" for k in keys])


def other_row_exists(
    df: DataFrame, others: DataFrame, keys: list[str], column: str, counts: Column, name: str
) -> DataFrame:
    """'Y' when ``others`` holds a counted row of the same keys with a different value.

    Two different values exist exactly when the smallest or the largest differs
    from the row's own, so one small aggregate answers it; missing is a value.
    """
    def as_value(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(""))

    spans = others.filter(counts).groupBy(*keys).agg(
        F.min(as_value(column)).alias("_low"), F.max(as_value(column)).alias("_high")
    )
    joined = join_back(df, spans, keys)
    differs = (F.col("_low") != as_value(column)) | (F.col("_high") != as_value(column))
    return joined.withColumn(name, F.when(F.coalesce(differs, F.lit(False)), "Y").otherwise("N")).drop("_low", "_high")


def theta_flag(
    left: DataFrame, right: DataFrame, keys: list[str], marks: list[Column], tests: list[Column], name: str
) -> DataFrame:
    """'Y' when some right row of the key has mark k while the left row meets test k, for any k.

    The right side shrinks to one row of booleans per key before the join.
    """
    seen = right.groupBy(*keys).agg(
        *[F.bool_or(F.coalesce(m, F.lit(False))).alias(f"_seen{k}") for k, m in enumerate(marks)]
    )
    joined = join_back(left, seen, keys)
    hit = reduce(
        lambda x, y: x | y,
        [F.coalesce(F.col(f"_seen{k}"), F.lit(False)) & F.coalesce(t, F.lit(False)) for k, t in enumerate(tests)],
    )
    return joined.withColumn(name, F.when(hit, "Y").otherwise("N")).drop(*[f"_seen{k}" for k in range(len(marks))])


def conditional_join(left: DataFrame, right: DataFrame, keys: list[str], condition: Column) -> DataFrame:
    """Inner join on the keys, limited by a condition over both sides (columns named apart)."""
    return left.join(right, keys).filter(condition)


def post_join_filter(left: DataFrame, right: DataFrame, keys: list[str], condition: Column) -> DataFrame:
    """Left join followed by a filter on the right side; Catalyst makes it an inner join."""
    return left.join(right, keys, "left").filter(condition)


def crosswalk_join(df: DataFrame, crosswalk: DataFrame, key: str) -> DataFrame:
    """Attach the surrogate id saved for each key."""
    return df.join(crosswalk, key, "left")


def media_allow_list(
    posts: DataFrame, fallback: DataFrame, account: str, media_type: str, allowed: list[str]
) -> DataFrame:
    """Posts of an allowed type; an account with none gets its fallback posts instead."""
    kept = posts.filter(F.col(media_type).isin(allowed))
    served = kept.select(account).distinct()
    return kept.unionByName(join_back(fallback, served, [account], "left_anti"), allowMissingColumns=True)
