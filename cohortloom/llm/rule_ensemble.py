"""Quality classifier: a sparse ensemble of conjunctive rules over text statistics.

Small trees are grown on a bounded sample of labelled rows; every path below a
root is a rule.  A lasso logistic regression keeps a few of the rules, and these
are compiled into one Spark column.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from cohortloom.llm.registry import held_out, query, table

MAX_ROWS = 20_000  # labelled rows the rules are learned from
TREES = 40
DEPTH = 3
BINS = 32
PENALTY = 5e-4
STEPS = 600
ACCEPT = 0.7

STATS = [
    "n_chars", "n_words", "word_length", "longest_word", "upper_share", "lower_share", "digit_share", "space_share",
    "symbol_share", "stop_share", "comma_share", "bang_share", "bar_share", "other_share", "capital_words", "marked_words",
    "distinct_words", "top_word", "bare_words", "n_lines", "line_words", "repeated_lines", "repeated_pairs",
]

_KIND = np.full(256, 9, dtype=np.int64)
for _kind, _members in enumerate(
    [
        range(65, 91), range(97, 123), range(48, 58), b" \t\n\v\f\r", b"#*$%&<>@^~=_\\/+", b".?;:", b",", b"!", b"|",
    ]
):
    _KIND[list(_members)] = _kind
_KIND[128:] = 10
_STRIPPED = ".,;:!?\"'()"


def statistics_of(text: str | None) -> list[float]:
    """The statistics of the whole text, in the order of STATS; all zero for null or blank text."""
    words = text.split() if text else []
    if not words:
        return [0.0] * len(STATS)
    kinds = np.bincount(_KIND[np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)], minlength=11)
    size = float(kinds.sum())
    n = len(words)
    counts = Counter(words)
    lengths = sum(map(len, words))
    marked = sum(w[-1] in "#*$%&!|=~^" or w[0] in "#*$%&|=~^<" for w in words)
    lines = [x for x in text.split("\n") if x and not x.isspace()]
    pairs = len(set(zip(words, words[1:]))) if n > 1 else 1
    return [
        np.log1p(len(text)), np.log1p(n), lengths / n, float(max(map(len, words))), kinds[0] / size, kinds[1] / size, kinds[2] / size,
        kinds[3] / size, kinds[4] / size, kinds[5] / size, kinds[6] / size, kinds[7] / size, kinds[8] / size, kinds[9] / size,
        sum(map(str.isupper, words)) / n, marked / n, len(counts) / n, max(counts.values()) / n,
        sum(w[-1] not in _STRIPPED for w in words) / n, np.log1p(len(lines)), n / len(lines), 1 - len(set(lines)) / len(lines),
        1 - pairs / max(1, n - 1),
    ]


@F.pandas_udf(StructType([StructField(s, DoubleType()) for s in STATS]))
def text_statistics(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([statistics_of(t) for t in texts], columns=STATS, dtype=float)


Rule = tuple[tuple[int, bool, float], ...]  # (statistic, above, threshold), all of which must hold


@dataclass
class RuleModel:
    """score = logistic(bias + sum of the weights of the rules that hold)."""

    bias: float
    rules: list[tuple[Rule, float]]

    def column(self, stats: Column) -> Column:
        """The score as one Spark column over the struct of statistics."""
        total = F.lit(self.bias)
        for rule, weight in self.rules:
            holds = F.lit(True)
            for at, above, threshold in rule:
                value = stats[STATS[at]]
                holds = holds & (value > threshold if above else value <= threshold)
            total = total + F.when(holds, F.lit(weight)).otherwise(F.lit(0.0))
        return 1.0 / (1.0 + F.exp(-total))


def _grow(codes: np.ndarray, edges: list[np.ndarray], target: np.ndarray, rng: np.random.Generator) -> list[Rule]:
    """Paths of one regression tree on binned statistics."""
    paths: list[Rule] = []
    used = rng.choice(codes.shape[1], size=max(4, codes.shape[1] // 2), replace=False)

    def split(rows: np.ndarray, path: Rule) -> None:
        if path:
            paths.append(path)
        if len(path) == DEPTH or len(rows) < 20:
            return
        y, best = target[rows], (1e-9, -1, -1)
        whole = y.sum() ** 2 / len(rows)
        for f in used:
            n = np.bincount(codes[rows, f], minlength=BINS + 1).cumsum()[:-1]
            s = np.bincount(codes[rows, f], weights=y, minlength=BINS + 1).cumsum()[:-1]
            m = len(rows) - n
            ok = (n >= 5) & (m >= 5)
            gain = np.where(ok, s**2 / np.maximum(n, 1) + (y.sum() - s) ** 2 / np.maximum(m, 1) - whole, 0.0)
            at = int(gain.argmax())
            if gain[at] > best[0]:
                best = (gain[at], f, at)
        if best[1] < 0 or best[2] >= len(edges[best[1]]):
            return
        _, f, at = best
        low = codes[rows, f] <= at
        split(rows[low], (*path, (int(f), False, float(edges[f][at]))))
        split(rows[~low], (*path, (int(f), True, float(edges[f][at]))))

    split(np.arange(len(target)), ())
    return paths


def _holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), dtype=bool)
    for at, above, threshold in rule:
        out &= x[:, at] > threshold if above else x[:, at] <= threshold
    return out


def fit_rules(x: np.ndarray, y: np.ndarray, trees: int = TREES, penalty: float = PENALTY, seed: int = 7) -> RuleModel:
    """Rules from boosted trees, weights from lasso logistic regression (accelerated proximal gradient).

    Without rows the score is 0.5 for all; with one class only it is near that class for all.
    """
    if not len(y):
        return RuleModel(0.0, [])
    share = (y.sum() + 0.5) / (len(y) + 1)
    bias = float(np.log(share / (1 - share)))
    if y.min() == y.max():
        return RuleModel(bias, [])
    rng = np.random.default_rng(seed)
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    codes = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    margin, rules = np.full(len(y), bias), {}
    for _ in range(trees):
        chosen = rng.random(len(y)) < 0.6
        residual = y - 1 / (1 + np.exp(-margin))
        paths = _grow(codes[chosen], edges, residual[chosen], rng)
        for path in paths:
            rules[tuple(sorted(path))] = None
        whole = set(paths)
        for path in paths:  # the leaves are the paths no other path goes on from
            if not any(p != path and p[: len(path)] == path for p in whole):
                held = _holds(path, x)
                if held.any():
                    margin[held] += 0.5 * np.clip(residual[held].mean() * 4, -2, 2)
    kept = list(rules)
    a = np.stack([_holds(r, x) for r in kept], axis=1).astype(float) if kept else np.zeros((len(y), 0))
    w, b, z, zb, t = np.zeros(a.shape[1]), bias, np.zeros(a.shape[1]), bias, 1.0
    step = 4 * len(y) / (np.linalg.norm(a, 2) ** 2 + len(y))
    for _ in range(STEPS):
        error = 1 / (1 + np.exp(-(a @ z + zb))) - y
        new = z - step * (a.T @ error) / len(y)
        new = np.sign(new) * np.maximum(np.abs(new) - step * penalty, 0)
        new_b = zb - step * error.mean()
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z, zb = new + (t - 1) / t_next * (new - w), new_b + (t - 1) / t_next * (new_b - b)
        w, b, t = new, new_b, t_next
    return RuleModel(float(b), [(r, float(v)) for r, v in zip(kept, w) if v != 0])


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> RuleModel:
    """Learn from (doc_id, text) rows and (doc_id, quality) labels, at most about ``max_rows`` of them.

    The sample is chosen by a hash of the id, before any text is looked at.
    Null labels teach nothing; of several labels of one document the lowest counts.
    """
    known = labels.filter("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    share = int(1_000_000 * max_rows / max(1, known.count())) + 1
    chosen = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("rules")), F.lit(1_000_000)) < share
    stats = with_statistics(docs.select("doc_id", "text").filter(chosen)).select("doc_id", "stats")
    joined = known.filter(chosen).join(stats, "doc_id").select("doc_id", "stats.*", "quality")
    rows = joined.toPandas().sort_values(["doc_id", *STATS], kind="stable")
    return fit_rules(rows[STATS].to_numpy(dtype=float), rows["quality"].to_numpy(dtype=float))


def with_statistics(docs: DataFrame, name: str = "stats") -> DataFrame:
    return docs.withColumn(name, text_statistics(F.col("text").cast("string")))


def classify(docs: DataFrame, model: RuleModel, name: str = "score") -> DataFrame:
    """Add ``name``, the probability of quality 1, to every row of ``docs``.

    Null, empty and very long texts are scored from their statistics like any
    other; equal texts get equal scores; an empty table stays empty; an existing
    column of this name is replaced.
    """
    scored = with_statistics(docs, "_rule_stats").withColumn(name, model.column(F.col("_rule_stats")))
    return scored.drop("_rule_stats")


@query("op4_quality_rule_ensemble")
def op4_quality_rule_ensemble(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    model = fit(docs.filter(F.col("doc_id").isNotNull() & ~held_out()), table(spark, sf, "labels"))
    scored = classify(docs, model).select("doc_id", held_out().alias("held_out"), "score")
    return scored.withColumn("predicted", (F.col("score") >= ACCEPT).cast("int"))
