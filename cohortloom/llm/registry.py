"""The queries of this subpackage, and the SQL of those SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query, and its SQL where SQL can express it on whole tables."""

    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLE[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """True for the quarter of the documents no model learns from; a null id is not held out."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def load() -> None:
    """Import all operator modules, which fills the two registries."""
    from cohortloom.llm import (  # noqa: F401
        best_fit,
        embedding_join,
        hard_negatives,
        html_text,
        lang_id,
        ngram_join,
        pieces,
        pii,
        quality_rules,
        rule_ensemble,
        secret_scan,
        spelling,
        web_archive,
    )
