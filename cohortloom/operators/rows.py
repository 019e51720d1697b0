"""Ordered-row operators: flags, last rows, carried values, positions and numbering.

"Rows so far" questions are answered by per-key aggregates (which combine on the
map side) and a join back whose hot keys can be split, not by a window over the
whole key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.operators.spread import hash_order, hash_rank, join_back, order_struct, ordered_index, rank_within


def running_flag(df: DataFrame, keys: list[str], order: list[str], condition: Column, name: str) -> DataFrame:
    """'Y' from the first row of the key where ``condition`` holds onward, else 'N'."""
    position = order_struct(*order)
    first_hit = df.filter(condition).groupBy(*keys).agg(F.min(position).alias("_first_hit"))
    reached = F.coalesce(position >= F.col("_first_hit"), F.lit(False))
    return join_back(df, first_hit, keys).withColumn(name, F.when(reached, "Y").otherwise("N")).drop("_first_hit")


def last_row_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of every key, by a total order, as one aggregate."""
    others = [c for c in df.columns if c not in keys]
    last = F.max_by(F.struct(*others), order_struct(*order)).alias("_last")
    return df.groupBy(*keys).agg(last).select(*[F.col(c) if c in keys else F.col(f"_last.{c}") for c in df.columns])


def keep_or_last(df: DataFrame, keys: list[str], order: list[str], has_value: Column) -> DataFrame:
    """Every row with a value; of the rest only the last row of its key.

    The first part needs no shuffle; the second is the last-row aggregate, kept
    where that row has no value.
    """
    kept = F.coalesce(has_value, F.lit(False))
    flagged = df.withColumn("_kept", kept)
    valued = flagged.filter(F.col("_kept"))
    closing = last_row_per_key(flagged, keys, order).filter(~F.col("_kept"))
    return valued.unionByName(closing).drop("_kept")


def carry_last_assignment(
    df: DataFrame, keys: list[str], order: list[str], assignments: dict[str, Column]
) -> DataFrame:
    """Per key and name, the last value assigned (a NULL is no assignment)."""
    position = order_struct(*order)
    return df.groupBy(*keys).agg(
        *[F.max_by(value, F.when(value.isNotNull(), position)).alias(name) for name, value in assignments.items()]
    )


def random_surrogate_id(df: DataFrame, key: str, seed: int | str, name: str = "obs", digits: int | None = None) -> DataFrame:
    """Distinct keys numbered 1..n in a repeatable random order."""
    keys = df.select(key).distinct().withColumn("_digest", hash_order(seed, key))
    return hash_rank(keys, [], "_digest", [key], name, digits).drop("_digest")


def running_count(df: DataFrame, order: list[str], name: str = "running_count", start: int = 0) -> DataFrame:
    """Position of each row in a total order, counted on from ``start``."""
    return ordered_index(df, order, name).withColumn(name, F.col(name) + F.lit(start))


def duplicate_keys(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """All rows of a key after its first in a total order; of identical rows all but one."""
    return rank_within(df, keys, order, "_row").filter(F.col("_row") > 1).drop("_row")


def duplicate_counts(df: DataFrame, keys: list[str], name: str = "extra_rows") -> DataFrame:
    """How many rows beyond the first each repeated key has."""
    return df.groupBy(*keys).agg((F.count("*") - 1).alias(name)).filter(F.col(name) > 0)


def dedupe_keys(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the first in a total order."""
    others = [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*others), order_struct(*order)).alias("_first")
    return df.groupBy(*keys).agg(first).select(*[F.col(c) if c in keys else F.col(f"_first.{c}") for c in df.columns])


def multi_key_sort(df: DataFrame, *order: Column | str) -> DataFrame:
    """Total sort; missing values sort first when ascending, last when descending."""
    return df.orderBy(*order)


def top_one(df: DataFrame, *order: Column | str) -> DataFrame:
    """The first row of the sorted table."""
    return df.orderBy(*order).limit(1)
