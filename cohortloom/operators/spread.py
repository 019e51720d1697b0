"""Building blocks that keep one huge key from becoming one huge task.

Aggregates combine on the map side, so a hot key is no problem for them.  Joins
back to a hot key, row numbers inside a hot key and global positions are; the
functions here let such keys be split over many tasks, with exact results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from cohortloom.session import HOT_ROWS, PIECE_ROWS, broadcast_if_small, freeze, saved

_IN_PARTITION = (1 << 33) - 1


def order_struct(*cols: str) -> Column:
    """The order columns as one comparable value; missing sorts first, as in the windows."""
    return F.struct(*[F.col(c) for c in cols])


def null_safe_on(left: DataFrame, right: DataFrame, keys: list[str], prefix: str) -> Column:
    """Equality of ``keys`` with the prefixed columns of ``right``, missing matching missing."""
    condition = F.lit(True)
    for k in keys:
        condition = condition & left[k].eqNullSafe(right[prefix + k])
    return condition


def join_back(big: DataFrame, small: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join ``big`` to a table with few rows per key; missing keys match.

    A small side that fits is broadcast by Spark's own size check.  Beyond that
    both sides are shuffled on the null-safe keys.  An aggregate on the plain
    keys does not satisfy that partitioning, so the small side gets a shuffle
    of its own too, and with it adaptive execution can split the partition of a
    hot key over many tasks (its skew-join rule needs a shuffle on both sides).
    """
    side = small.select(*[F.col(c).alias(f"_key_{c}") if c in keys else F.col(c) for c in small.columns])
    return big.join(side, null_safe_on(big, side, keys, "_key_"), how).drop(*[f"_key_{k}" for k in keys])


def ordered_index(df: DataFrame, order: list[str], name: str = "position") -> DataFrame:
    """Number all rows 1..n in ``order`` without moving them through one task.

    A range sort splits the rows (also the rows of one key, as the order is
    total), the sorted rows are saved so that positions cannot change, and each
    partition is shifted by the rows before it.  The table of offsets has one
    row per partition.
    """
    ranged = (
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    )
    frozen = saved(ranged).withColumn("_part", F.shiftright("_at", 33))
    sizes = frozen.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return (
        frozen.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_before") + F.col("_at").bitwiseAND(F.lit(_IN_PARTITION)) + 1)
        .drop("_part", "_at", "_before")
    )


def hot_keys(keys: list[str], hot_rows: int, *tables: DataFrame) -> DataFrame | None:
    """The keys with more than ``hot_rows`` rows in any of the tables; None if there are none.

    Counts one column set per table, map-side combined.  The result is frozen
    and no longer than total rows / hot_rows, so it may be broadcast.
    """
    found = None
    for df in tables:
        counted = df.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") > hot_rows).select(*keys)
        found = counted if found is None else found.unionByName(counted)
    found = freeze(found.distinct() if len(tables) > 1 else found)
    return None if found.isEmpty() else found


def split_hot(df: DataFrame, hot: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows of the hot keys, all other rows), by a broadcast of the bounded key list."""
    marks = hot.select(*[F.col(k).alias(f"_hot_{k}") for k in keys])
    condition = null_safe_on(df, marks, keys, "_hot_")
    return df.join(F.broadcast(marks), condition, "left_semi"), df.join(F.broadcast(marks), condition, "left_anti")


def rank_by_position(df: DataFrame, keys: list[str], order: list[str], name: str) -> DataFrame:
    """Row number inside each of a few keys of any size, from global positions."""
    placed = ordered_index(df, [*keys, *order], "_pos")
    starts = placed.groupBy(*keys).agg(F.min("_pos").alias("_first")).select(
        *[F.col(k).alias(f"_hot_{k}") for k in keys], "_first"
    )
    return (
        placed.join(F.broadcast(starts), null_safe_on(placed, starts, keys, "_hot_"))
        .withColumn(name, F.col("_pos") - F.col("_first") + 1)
        .select(*df.columns, name)
    )


def rank_within(
    df: DataFrame, keys: list[str], order: list[str], name: str = "row_in_key", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Row number inside each key, in a total order.

    Without hot keys this is a plain window.  Hot keys are taken out and
    numbered by position instead, so that no task receives a whole hot key.
    """
    numbered = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("bigint")
    hot = hot_keys(keys, hot_rows, df)
    if hot is None:
        return df.withColumn(name, numbered)
    large, small = split_hot(df, hot, keys)
    return small.withColumn(name, numbered).unionByName(rank_by_position(large, keys, order, name))


def hash_order(seed: int | str, *keys: str) -> Column:
    """A repeatable random order: the digest of seed and key."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))


def hash_rank(
    df: DataFrame, groups: list[str], digest: str, ties: list[str], name: str, digits: int | None = None,
    total: str | None = None,
) -> DataFrame:
    """Row number inside each group by an evenly spread hex digest.

    The first digits cut every group, however large, into 16**digits even
    pieces of about PIECE_ROWS rows or less.  Rows are numbered inside their
    piece and shifted by the rows of the pieces before it.  The shifts are one
    row per group and piece and are broadcast when they are few, so the data is
    shuffled once.  ``total`` also returns the size of the group.
    """
    if digits is None:
        rows, digits = df.count(), 1
        while rows > PIECE_ROWS * 16**digits:
            digits += 1
    cut = df.withColumn("_piece", F.substring(digest, 1, digits))
    sizes = cut.groupBy(*groups, "_piece").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy(*groups).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    shift = sizes.select(
        *[F.col(g).alias(f"_of_{g}") for g in groups],
        F.col("_piece").alias("_of__piece"),
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
        *([F.sum("_n").over(Window.partitionBy(*groups)).alias(total)] if total else []),
    )
    shift = broadcast_if_small(freeze(shift))
    local = F.row_number().over(Window.partitionBy(*groups, "_piece").orderBy(digest, *ties))
    numbered = cut.withColumn("_local", local)
    return (
        numbered.join(shift, null_safe_on(numbered, shift, [*groups, "_piece"], "_of_"))
        .withColumn(name, F.col("_before") + F.col("_local"))
        .drop("_piece", "_local", "_before", "_of__piece", *[f"_of_{g}" for g in groups])
    )
