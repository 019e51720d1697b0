"""Language identification: known words first, then ever shorter character n-grams.

A known word is scored by its log frequency in every language.  An unseen word
falls back to its longest character n-grams that any language knows.  The model
is bounded by its parameters, so it may be sent to every task.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.llm.registry import held_out, query, table

LETTERS = re.compile(r"[^\W\d_]+")
MAX_ROWS = 8_000  # labelled documents a model is fitted on, about
MAX_WORDS = 30_000  # known words per language
MAX_GRAMS = 20_000  # known n-grams per language and length
LONGEST = 5  # characters of the longest n-gram
CACHED = 300_000  # scored words a task keeps
UNKNOWN = "und"


@dataclass
class LanguageModel:
    """langs; rows of log frequencies per language, for words and for n-grams by length."""

    langs: list[str]
    words: dict[str, int]
    grams: list[dict[str, int]]
    table: np.ndarray
    gram_table: np.ndarray


def words_of(text: str | None) -> list[str]:
    """The lower-cased runs of letters of the whole text."""
    return LETTERS.findall(text.lower()) if text else []


def _count_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        counts: dict[tuple[str, str], int] = {}
        for lang, text in zip(batch["lang"], batch["text"]):
            for word in words_of(text):
                counts[lang, word] = counts.get((lang, word), 0) + 1
        yield pd.DataFrame([(k[0], k[1], n) for k, n in counts.items()], columns=["lang", "word", "n"])


def _log_frequencies(rows: list, langs: list[str], first: int = 0) -> tuple[dict[str, int], np.ndarray]:
    """The position of every key, and its smoothed log frequency in every language."""
    position = {lang: i for i, lang in enumerate(langs)}
    keys: dict[str, int] = {}
    for r in rows:
        keys.setdefault(r["key"], len(keys))
    counts = np.full((len(keys), len(langs)), 0.1)
    for r in rows:
        counts[keys[r["key"]], position[r["lang"]]] += r["n"]
    logs = np.log(counts / np.maximum(counts.sum(axis=0, keepdims=True), 1e-9))
    return {k: first + i for k, i in keys.items()}, logs


def fit(labelled: DataFrame, max_rows: int = MAX_ROWS, max_words: int = MAX_WORDS, max_grams: int = MAX_GRAMS) -> LanguageModel:
    """Learn from (doc_id, text, lang) rows.

    About ``max_rows`` of the rows with a language are used, the same share of
    each language, chosen by a hash of the id; languages with few rows are used
    whole.  Rows without text teach nothing.
    """
    rows = labelled.select("doc_id", "text", "lang").filter("lang IS NOT NULL AND text IS NOT NULL")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = sorted(sizes)
    if not langs:
        return LanguageModel([], {}, [{} for _ in range(LONGEST)], np.zeros((0, 0)), np.zeros((0, 0)))
    share = max_rows / len(langs)
    keep = F.lit(False)
    place = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("sample")), F.lit(1_000_000))
    for lang in langs:
        keep = keep | ((F.col("lang") == lang) & (place < min(1_000_000, int(1_000_000 * share / sizes[lang]) + 1)))
    counted = (
        rows.filter(keep).select("lang", "text")
        .mapInPandas(_count_words, "lang string, word string, n bigint")
        .groupBy("lang", "word").agg(F.sum("n").alias("n"))
    ).persist()

    def top(counts: DataFrame, most: int) -> list:
        order = Window.partitionBy("lang").orderBy(F.desc("n"), "key")
        return counts.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= most).orderBy("key", "lang").collect()

    words, word_table = _log_frequencies(top(counted.select("lang", F.col("word").alias("key"), "n"), max_words), langs)
    grams, tables, first = [], [], 0
    padded = counted.select("lang", F.concat(F.lit("^"), "word", F.lit("$")).alias("w"), "n")
    for size in range(1, LONGEST + 1):
        cut = padded.filter(F.length("w") >= size).select(
            "lang", "n", F.explode(F.transform(F.sequence(F.lit(1), F.length("w") - size + 1), lambda i: F.substring(F.col("w"), i, F.lit(size)))).alias("key")
        )
        found, logs = _log_frequencies(top(cut.groupBy("lang", "key").agg(F.sum("n").alias("n")), max_grams), langs, first)
        grams.append(found)
        tables.append(logs)
        first += len(found)
    counted.unpersist()
    return LanguageModel(langs, words, grams, word_table, np.vstack(tables))


class Scorer:
    """Scores texts with a model; remembers a bounded number of backed-off words."""

    def __init__(self, model: LanguageModel, cached: int = CACHED):
        self.model, self.cached = model, cached
        self._reset()

    def _reset(self) -> None:
        known = len(self.model.words)
        self.rows = dict(self.model.words)
        self.logs = np.zeros((known + self.cached, len(self.model.langs)))
        self.logs[:known] = self.model.table
        self.shares = np.zeros_like(self.logs)
        self.shares[:known] = _shares(self.model.table)

    def back_off(self, word: str) -> np.ndarray:
        """Mean log frequency of the longest n-grams any language knows; zeros if it knows no character."""
        padded = f"^{word}$"
        for size in range(min(LONGEST, len(padded)), 0, -1):
            known = self.model.grams[size - 1]
            if size == 1:
                padded = word  # the two marks alone tell nothing
            hits = [known[g] for i in range(len(padded) - size + 1) if (g := padded[i : i + size]) in known]
            if hits:
                return self.model.gram_table[hits].mean(axis=0)
        return np.zeros(len(self.model.langs))

    def score(self, text: str | None) -> tuple[str, float]:
        """(language, share of its words' evidence); ('und', 0) without letters or model."""
        words = words_of(text)
        if not words or not self.model.langs:
            return UNKNOWN, 0.0
        if len(words) > self.cached:  # a text with more words than the memory holds, in parts
            parts = [self._sums(words[i : i + self.cached]) for i in range(0, len(words), self.cached)]
            logs, shares = sum(p[0] for p in parts), sum(p[1] for p in parts)
        else:
            logs, shares = self._sums(words)
        best = int(np.argmax(logs))
        return self.model.langs[best], float(min(1.0, shares[best] / len(words)))

    def _sums(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        at = list(map(self.rows.get, words))
        if None in at:
            missing = {w for w, i in zip(words, at) if i is None}
            if len(self.rows) + len(missing) > len(self.logs):
                self._reset()
                missing = {w for w in words if w not in self.rows}
            first = len(self.rows)
            for w in missing:
                row = len(self.rows)
                self.logs[row] = self.back_off(w)
                self.rows[w] = row
            self.shares[first : len(self.rows)] = _shares(self.logs[first : len(self.rows)])
            at = list(map(self.rows.__getitem__, words))
        return self.logs[at].sum(axis=0), self.shares[at].sum(axis=0)


def _shares(logs: np.ndarray) -> np.ndarray:
    if not logs.size:
        return logs
    e = np.exp(logs - logs.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def identify(docs: DataFrame, model: LanguageModel, name: str = "language") -> DataFrame:
    """Add a struct ``name`` (lang_pred, score) to every row.

    lang_pred is a learned language, 'und' with score 0 for a null text, a text
    without letters, or when nothing was learned.  score is the mean posterior
    share of that language over the words.  Ties go to the first language by
    name.  Repeated rows are scored alike; an existing column of this name is
    replaced; an empty table stays empty.
    """
    sent = docs.sparkSession.sparkContext.broadcast(vars(model))  # plain values: tasks need not know the class

    @F.pandas_udf("struct<lang_pred:string,score:double>")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(LanguageModel(**sent.value))
        for texts in batches:
            yield pd.DataFrame([scorer.score(t) for t in texts], columns=["lang_pred", "score"])

    return docs.withColumn(name, scored(F.col("text").cast("string")))


def accepted(language: Column, min_score: float = 0.35) -> Column:
    """Whether a document has a language: letters, and words that mostly speak for one language."""
    return (language["lang_pred"] != UNKNOWN) & (language["score"] >= min_score)


@query("op2_language_id")
def op2_language_id(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    model = fit(docs.filter(F.col("doc_id").isNotNull() & ~held_out()))
    found = identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out().alias("held_out"), "language.lang_pred", "language.score")
