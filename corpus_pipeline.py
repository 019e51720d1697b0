"""From raw documents to packed token sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and is given what the stage before kept.
All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.llm import best_fit, lang_id, ngram_join, pii, rule_ensemble
from cohortloom.llm.registry import held_out, query, table
from cohortloom.session import saved


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without letters, and those whose words speak for no learned language."""
    model = lang_id.fit(docs.filter(F.col("doc_id").isNotNull() & ~held_out()))
    found = lang_id.identify(docs, model, "_language")
    return found.filter(lang_id.accepted(F.col("_language"))).select(*docs.columns)


def keep_good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the rule ensemble, learned from the labels, scores under the threshold."""
    learned = docs.filter(F.col("doc_id").isNotNull() & ~held_out())
    model = rule_ensemble.fit(learned, table(spark, sf_dir, "labels"))
    scored = rule_ensemble.classify(docs, model, "_quality_score")
    return scored.filter(F.col("_quality_score") >= rule_ensemble.ACCEPT).select(*docs.columns)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group linked by five-word shingles at a Jaccard similarity of 0.8."""
    return ngram_join.one_of_each(docs, width=5, percent=80)


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by pseudonyms of the same format; n_chars follows the new text."""
    done = pii.pseudonymise(docs, pii.QUERY_KEY)
    return done.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns) if "n_chars" in docs.columns else done


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents with their ids, packed into sequences."""
    return best_fit.pack(best_fit.token_pieces(docs.select("doc_id", "text"), with_ids=True))


STAGES = [
    ("language ID", keep_known_languages),
    ("quality classifier", keep_good_quality),
    ("n-gram Jaccard join", keep_one_of_each),
    ("PII", hide_personal_data),
    ("best-fit packing", pack_sequences),
]

#: No stage is within reach of SQL; tests hold them against brute force.
ORACLE_SQL = None


@query("pipeline")
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir))
    return docs
