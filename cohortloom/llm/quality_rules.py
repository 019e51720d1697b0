"""Quality rules: one table of thresholds, compiled into one Spark projection.

Lengths, symbol, stop-word and line ratios and repeated passages are counted by
Spark expressions over the whole text; no Python runs on the executors.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.registry import query, table

WORD = r"[^\x20\x09-\x0D]+"
BLANKS = r"[\x20\x09-\x0D]+"
SYMBOLS = "[#*$%&|<>]"
WINDOW = 8  # words of a passage that counts as repeated when found again

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to a in is that it was for on are as with his they at be this from have or by one had not but what all were "
    "der die und das von zu den mit des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei "
    "de la le et les des en un du une que est pour qui dans par plus pas au sur ne se ce il sont avec ou son "
    "el que y los del se las por un con no una su para al lo como más pero sus le ya o este"
).split()


@dataclass(frozen=True)
class Threshold:
    """A measure and the closed range a good document keeps it in."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None


#: Measures are SQL expressions over the counts of ``counts`` (n_words is at least 1 where they are used).
THRESHOLDS = (
    Threshold("word_length", "word_chars / n_words", 2.0, 15.0),
    Threshold("symbols", "n_symbols / n_words", None, 0.3),
    Threshold("stop_words", "n_stop_words / n_words", 0.02, None),
    Threshold("repeated_lines", "n_dup_lines / n_lines", None, 0.5),
    Threshold("capital_letters", "n_capitals / word_chars", None, 0.4),
)


def _let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it as often as ``body`` likes."""
    return F.transform(F.array(value), body)[0]


def _covered(hashes: Column) -> Column:
    """Words in windows whose hash occurs twice or more; ``hashes`` has one entry per window start."""

    def from_sorted(s):
        again = F.filter(s, lambda x, j: (F.get(s, j - 1)["h"] == x["h"]) | (F.get(s, j + 1)["h"] == x["h"]))
        starts = F.sort_array(F.transform(again, lambda x: x["i"]))
        begin = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
        return F.aggregate(
            starts, begin,
            lambda acc, i: F.struct((i + WINDOW).alias("end"), (acc["n"] + i + WINDOW - F.greatest(acc["end"], i)).alias("n")),
            lambda acc: acc["n"],
        )

    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(_let(pairs, from_sorted))


def repeated_words(words: Column) -> Column:
    """How many words lie in an 8-word window that is found twice or more in the text, the first one included."""

    def whole(w):
        starts = F.sequence(F.lit(0), F.size(w) - WINDOW)
        hashes = F.transform(starts, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)]))
        return _let(hashes, _covered)

    return F.when(F.size(words) > WINDOW, _let(words, whole)).otherwise(F.lit(0))


def counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the counts the thresholds are made of, as columns of longs; null text counts as empty."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    split = docs.withColumn("_t", t).withColumn("_words", F.regexp_extract_all("_t", F.lit(WORD), F.lit(0))).withColumn(
        "_lines", F.filter(F.split("_t", "\n", -1), lambda x: x.rlike(WORD))
    )
    w = F.col("_words")
    found = {
        "n_words": F.size(w),
        "word_chars": F.length(F.regexp_replace("_t", BLANKS, "")),
        "n_symbols": F.length("_t") - F.length(F.regexp_replace("_t", SYMBOLS, "")),
        "n_lines": F.size("_lines"),
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        "n_stop_words": F.size(F.filter(w, lambda x: F.lower(x).isin(STOP_WORDS))),
        "n_capitals": F.length("_t") - F.length(F.regexp_replace("_t", r"\p{Lu}+", "")),
        "n_repeat_words": repeated_words(w),
    }
    return split.withColumns({k: v.cast("bigint") for k, v in found.items()}).drop("_t", "_words", "_lines")


def base_failed() -> Column:
    """Fewer than 20 words, or over 30 percent of the words in repeated passages."""
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def broken(thresholds: tuple[Threshold, ...] = THRESHOLDS) -> Column:
    """The names of the thresholds a document breaks, as one expression over its counts."""
    def one(t: Threshold) -> Column:
        value = F.expr(t.measure)
        outside = F.lit(False)
        if t.low is not None:
            outside = outside | (value < t.low)
        if t.high is not None:
            outside = outside | (value > t.high)
        return F.when(outside, F.lit(t.name))

    return F.when(F.col("n_words") > 0, F.filter(F.array(*[one(t) for t in thresholds]), lambda x: x.isNotNull())).otherwise(F.array().cast("array<string>"))


def judge(docs: DataFrame, thresholds: tuple[Threshold, ...] = THRESHOLDS) -> DataFrame:
    """Add the counts, base_failed, broken_rules and kept to every row.

    Null, empty and short texts fail the base; texts of any length are counted
    whole; repeated rows are judged alike; columns of the added names are
    replaced; an empty table stays empty.
    """
    counted = counts(docs).withColumns({"base_failed": base_failed(), "broken_rules": broken(thresholds)})
    return counted.withColumn("kept", ~F.col("base_failed") & (F.size("broken_rules") == 0))


_STOP_SQL = ", ".join(f"'{w}'" for w in sorted(set(STOP_WORDS)))


@query(
    "op7_quality_rules",
    rf"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
    w AS (SELECT row_number() OVER () AS r, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words,
                 list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
    g AS (SELECT r, unnest(range(len(words) - 7)) AS i, words FROM w WHERE len(words) >= 8),
    h AS (SELECT r, i, array_to_string(words[i + 1:i + 8], ' ') AS gram FROM g),
    m AS (SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS n FROM h),
    p AS (SELECT r, count(*) AS n FROM (SELECT DISTINCT r, unnest(range(i, i + 8)) AS at FROM m WHERE n > 1) GROUP BY r),
    c AS (SELECT doc_id, len(words) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
                 length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(lines) AS n_lines,
                 len(lines) - len(list_distinct(lines)) AS n_dup_lines,
                 len(list_filter(words, lambda x: lower(x) IN ({_STOP_SQL}))) AS n_stop_words,
                 length(t) - length(regexp_replace(t, '\p{{Lu}}+', '', 'g')) AS n_capitals,
                 coalesce(p.n, 0) AS n_repeat_words FROM w LEFT JOIN p USING (r)),
    b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM c)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND word_chars / n_words >= 2.0 AND word_chars / n_words <= 15.0 AND n_symbols / n_words <= 0.3
           AND n_stop_words / n_words >= 0.02 AND n_dup_lines / n_lines <= 0.5 AND n_capitals / word_chars <= 0.4 AS kept FROM b""",
)
def op7_quality_rules(spark, sf):
    judged = judge(table(spark, sf, "documents").select("doc_id", "text"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
