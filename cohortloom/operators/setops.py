"""Stacking and splitting tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def snapshot_concat(parts: list[tuple[DataFrame, str]], tag: str = "day") -> DataFrame:
    """Append snapshots, each tagged with its origin; absent columns become NULL."""
    tagged = [df.withColumn(tag, F.lit(value)) for df, value in parts]
    whole = tagged[0]
    for part in tagged[1:]:
        whole = whole.unionByName(part, allowMissingColumns=True)
    return whole


def override_union(branches: list[tuple[DataFrame, dict[str, Column]]]) -> DataFrame:
    """Override columns in every branch, then the distinct union of all."""
    changed = [df.withColumns(overrides) for df, overrides in branches]
    whole = changed[0]
    for part in changed[1:]:
        whole = whole.unionByName(part.select(*whole.columns))
    return whole.distinct()


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema`` in order; absent ones become typed NULLs."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def typed_union(branches: list[DataFrame], schema: T.StructType) -> DataFrame:
    """Distinct union in which a column one branch lacks is a NULL of its type."""
    whole = conform(branches[0], schema)
    for part in branches[1:]:
        whole = whole.unionByName(conform(part, schema))
    return whole.distinct()


def split_output(df: DataFrame, condition: Column) -> tuple[DataFrame, DataFrame]:
    """The rows where the condition holds and all others (a missing condition counts as false)."""
    holds = F.coalesce(condition, F.lit(False))
    return df.filter(holds), df.filter(~holds)


def select_rename_drop(df: DataFrame, keep: dict[str, str]) -> DataFrame:
    """Keep and rename; two columns with one name are refused."""
    if len(set(keep.values())) != len(keep):
        raise ValueError("two output columns share a name")
    return df.select(*[F.col(old).alias(new) for old, new in keep.items()])
