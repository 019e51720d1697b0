"""Secret scan: pattern findings, cleaned of false positives by a random forest.

Patterns find candidates in whole texts.  A forest trained on labelled findings
judges each by its length, its character transitions, how much of it dictionary
words cover, the path of its document and the words beside it.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.registry import held_out, query, table
from cohortloom.session import broadcast_if_small, freeze, saved

MAX_FINDINGS = 20_000  # labelled findings a forest is trained on, about
WORD_SHARE = 0.0005  # of the different documents, and two at least, that hold a word of the dictionary
COUNTED = 300_000  # words a task counts before it hands them on
TREES, DEPTH, LEAF = 40, 8, 3
ACCEPT = 0.5

_NAMES = r"token|passwords?|passwd|pwd|secrets?|api[_-]?keys?|access[_-]?keys?|auth[_-]?keys?|credentials?|client[_-]?secret"
#: Rules in the order they are tried at a place; the group of a rule is the candidate.
RULES = {
    "private_key": r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----(?:[A-Za-z0-9+/=\s]*-----END (?:[A-Z]+ )*PRIVATE KEY-----)?",
    "access_key": r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[0-9A-Z]{16}(?![A-Za-z0-9])",
    "service_token": r"(?<![A-Za-z0-9])(?:gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_(?:live|test)_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{35})",
    "web_token": r"(?<![A-Za-z0-9])eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]*",
    "assigned": r"(?:(?<=[=:])|(?<=[=:] )|(?<=[=:][\"'])|(?<=[=:] [\"']))[^\s\"'`,;=]{6,}",
    "generic": r"(?<![A-Za-z0-9_+/-])(?=[A-Za-z_+/-]*[0-9])[A-Za-z0-9_+/-]{12,}={0,2}",
}
_ANY = re.compile("|".join(f"(?P<{n}>{p})" for n, p in RULES.items()))
_NAMED = re.compile(rf"(?i)(?:{_NAMES})[\"']?\s*[=:]\s*[\"']?$")
_WORDS = re.compile(r"[^\W\d_]{3,}")
_LETTERS = re.compile(r"[^\W\d_]+")
_PATH = re.compile(r"(?i)test|example|sample|doc|fixture|mock")
_CONFIG = re.compile(r"(?i)\.(?:env|ya?ml|json|ini|cfg|conf|properties|toml)$")

FEATURES = [
    "length", "distinct", "entropy", "digits", "capitals", "small", "other", "changes", "longest_run", "digit_letter_changes",
    "vowel_changes", "hex", "covered", "named", "assigned", "quoted", "left_word_known", "right_word_known", "left_words", "right_words",
    "path_sample", "path_config", *[f"rule_{r}" for r in RULES],
]


def candidates(text: str | None) -> list[tuple[int, int, str]]:
    """(start, end, rule) of the candidates of a whole text, left to right, not overlapping."""
    if not text or not (re.search("[0-9]", text) or "PRIVATE KEY" in text or _NAMED_HINT.search(text)):
        return []
    out = []
    for m in _ANY.finditer(text):
        rule = m.lastgroup
        if rule == "assigned" and not _NAMED.search(text, max(0, m.start() - 40), m.start()):
            at = _GENERIC.match(text, m.start())  # not after a secret's name; it may still look like one
            if at is None:
                continue
            out.append((at.start(), at.end(), "generic"))
            continue
        out.append((m.start(), m.end(), rule))
    return out


_NAMED_HINT = re.compile(rf"(?i)(?:{_NAMES})[\"']?\s*[=:]")
_GENERIC = re.compile(RULES["generic"][len("(?<![A-Za-z0-9_+/-])") :])


def find(docs: DataFrame, path: str | None = "source") -> DataFrame:
    """(doc_id, start, length, rule, value, before, after, path) for every candidate of (doc_id, text and the path column).

    Null and empty texts have none; whole texts are searched; repeated rows give
    repeated findings.  start counts characters from 0.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    where = F.col(path).cast("string") if path in docs.columns else F.lit(None).cast("string")
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), where.alias("path"))

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for doc_id, text, place in zip(batch["doc_id"], batch["text"], batch["path"]):
                for start, end, rule in candidates(text):
                    found.append((doc_id, start, end - start, rule, text[start:end], text[max(0, start - 60) : start], text[end : end + 40], place))
            out = pd.DataFrame(found, columns=["doc_id", "start", "length", "rule", "value", "before", "after", "path"])
            out["doc_id"] = out["doc_id"].astype("Int64" if id_type in ("bigint", "int") else object)
            yield out

    return rows.mapInPandas(scan, f"doc_id {id_type}, start bigint, length bigint, rule string, value string, before string, after string, path string")


def dictionary(docs: DataFrame, word_share: float = WORD_SHARE) -> list[str]:
    """The words of three letters or more in ``word_share`` of the different texts of ``docs``, and in two at least.

    All documents are counted; copies of a text count as one.  There are at most
    words per text / ``word_share`` such words, however many documents there are.
    """
    texts = docs.select(F.col("text").cast("string").alias("text")).filter("text IS NOT NULL").withColumn("digest", F.xxhash64("text"))
    copies = freeze(texts.groupBy("digest").agg(F.count("*").alias("rows")).filter("rows > 1"))
    sizes = copies.agg(F.coalesce(F.sum(F.col("rows") - 1), F.lit(0)).alias("n")).first()["n"]
    least = max(2.0, word_share * (texts.count() - sizes))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()
        for batch in batches:
            for text, rows in zip(batch["text"], batch["rows"]):
                for word in set(_WORDS.findall(text.lower())):
                    seen[word] += 1 / rows
                if len(seen) > COUNTED:
                    yield pd.DataFrame(seen.items(), columns=["word", "n"])
                    seen.clear()
        yield pd.DataFrame(seen.items(), columns=["word", "n"])

    weighed = texts.join(broadcast_if_small(copies), "digest", "left").select("text", F.coalesce("rows", F.lit(1)).alias("rows"))
    words = weighed.mapInPandas(count, "word string, n double")
    known = words.groupBy("word").agg(F.sum("n").alias("n")).filter(F.round("n", 6) >= least)  # sums of parts differ in their last digits
    return sorted(r["word"] for r in known.select("word").collect())


def _covered(value: str, known: frozenset[str]) -> float:
    """Share of the characters that dictionary words cover, the longest word first at every place."""
    low, at, hit = value.lower(), 0, 0
    while at < len(low):
        for n in range(min(14, len(low) - at), 2, -1):
            if low[at : at + n] in known:
                hit, at = hit + n, at + n
                break
        else:
            at += 1
    return hit / max(1, len(low))


def _classes(value: str) -> str:
    return "".join("d" if c.isdigit() else "u" if c.isupper() else "l" if c.isalpha() else "o" for c in value)


def features_of(rule: str, value: str, before: str, after: str, path: str | None, known: frozenset[str]) -> list[float]:
    """The features of a finding, in the order of FEATURES."""
    n = max(1, len(value))
    kinds = _classes(value)
    share = Counter(kinds)
    chars = Counter(value)
    changes = sum(a != b for a, b in zip(kinds, kinds[1:]))
    mixed = sum({a, b} in ({"d", "l"}, {"d", "u"}) for a, b in zip(kinds, kinds[1:]))
    vowels = ["aeiouAEIOU".find(c) >= 0 for c in value if c.isalpha()]
    left, right = _LETTERS.findall(before), _LETTERS.findall(after)
    run = max((len(m[0]) for m in re.finditer(r"(.)\1*", kinds)), default=0)
    return [
        float(len(value)), len(chars) / n, -sum(c / n * math.log2(c / n) for c in chars.values()), share["d"] / n, share["u"] / n, share["l"] / n,
        share["o"] / n, changes / n, run / n, mixed / n, sum(a != b for a, b in zip(vowels, vowels[1:])) / max(1, len(vowels)),
        float(bool(re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", value))), _covered(value, known), float(bool(_NAMED.search(before))),
        float(bool(re.search(r"[=:]\s*[\"']?$", before))), float(before[-1:] in ("'", '"') and before[-1:] != ""),
        float(bool(left) and left[-1].lower() in known), float(bool(right) and right[0].lower() in known), float(len(left)), float(len(right)),
        float(bool(path and _PATH.search(path))), float(bool(path and _CONFIG.search(path))), *[float(rule == r) for r in RULES],
    ]


@dataclass
class Forest:
    """Trees as arrays (feature, threshold, left, right, share of secrets) and the dictionary of the features."""

    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]
    words: list[str]

    def predict(self, x: np.ndarray) -> np.ndarray:
        if not self.trees:
            return np.full(len(x), 0.5)
        total = np.zeros(len(x))
        for feature, threshold, left, right, share in self.trees:
            at = np.zeros(len(x), dtype=np.int64)
            for _ in range(DEPTH):
                inner = left[at] >= 0
                down = x[np.arange(len(x)), feature[at]] <= threshold[at]
                at = np.where(inner, np.where(down, left[at], right[at]), at)
            total += share[at]
        return total / len(self.trees)


def grow_tree(x: np.ndarray, y: np.ndarray, rng: np.random.Generator):
    """A tree of least Gini impurity, with a random third of the features tried at every node."""
    feature, threshold, left, right, share = [], [], [], [], []
    tried = max(2, x.shape[1] // 3)

    def node(rows: np.ndarray, depth: int) -> int:
        me = len(feature)
        feature.append(0), threshold.append(0.0), left.append(-1), right.append(-1), share.append(float(y[rows].mean()))
        if depth == DEPTH or len(rows) < 2 * LEAF or share[me] in (0.0, 1.0):
            return me
        best = (1e-12, -1, 0.0)
        p = share[me]
        for f in rng.choice(x.shape[1], size=tried, replace=False):
            order = rows[np.argsort(x[rows, f], kind="stable")]
            v, c = x[order, f], np.cumsum(y[order])
            n = np.arange(1, len(order) + 1)
            cut = np.flatnonzero((v[1:] > v[:-1]) & (n[:-1] >= LEAF) & (len(order) - n[:-1] >= LEAF))
            if not len(cut):
                continue
            nl, cl = n[cut], c[cut]
            nr, cr = len(order) - nl, c[-1] - cl
            gain = p * (1 - p) - (cl * (1 - cl / nl) + cr * (1 - cr / nr)) / len(order)
            k = int(gain.argmax())
            if gain[k] > best[0]:
                best = (gain[k], int(f), float((v[cut[k]] + v[cut[k] + 1]) / 2))
        if best[1] < 0:
            return me
        down = x[rows, best[1]] <= best[2]
        feature[me], threshold[me] = best[1], best[2]
        left[me] = node(rows[down], depth + 1)
        right[me] = node(rows[~down], depth + 1)
        return me

    node(np.arange(len(y)), 0)
    return tuple(np.array(a) for a in (feature, threshold, left, right, share))


def grow_forest(x: np.ndarray, y: np.ndarray, words: list[str], trees: int = TREES, seed: int = 11) -> Forest:
    """Trees on bootstrap samples; without findings every score is 0.5."""
    rng = np.random.default_rng(seed)
    grown = []
    for _ in range(trees if len(y) else 0):
        rows = rng.integers(0, len(y), len(y))
        grown.append(grow_tree(x[rows], y[rows], rng))
    return Forest(grown, words)


def train(labelled: DataFrame, words: list[str], max_findings: int = MAX_FINDINGS) -> Forest:
    """Learn from findings with a column ``secret`` (null teaches nothing), about ``max_findings`` of them, chosen by a hash."""
    known = labelled.filter("secret IS NOT NULL")
    share = int(1_000_000 * max_findings / max(1, known.count())) + 1
    place = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), "start", F.lit("findings")), F.lit(1_000_000))
    rows = known.filter(place < share).select("doc_id", "start", "rule", "value", "before", "after", "path", "secret").toPandas()
    rows = rows.sort_values(["doc_id", "start", "rule", "value"], kind="stable")
    dictionary_ = frozenset(words)
    x = [features_of(r.rule, r.value, r.before, r.after, r.path, dictionary_) for r in rows.itertuples()]
    return grow_forest(np.array(x, dtype=float).reshape(len(x), len(FEATURES)), rows["secret"].to_numpy(dtype=float), words)


def judge(findings: DataFrame, forest: Forest, name: str = "score") -> DataFrame:
    """Add the forest's score, the probability that a finding is a secret, to every finding."""
    sent = findings.sparkSession.sparkContext.broadcast((forest.trees, forest.words))  # bounded by the forest's parameters

    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        model = Forest(*sent.value)
        known = frozenset(model.words)
        for columns in batches:
            x = np.array([features_of(*row, known) for row in zip(*columns)], dtype=float).reshape(-1, len(FEATURES))
            yield pd.Series(model.predict(x))

    return findings.withColumn(name, score("rule", "value", "before", "after", "path"))


def known_labels(findings: DataFrame) -> DataFrame:
    """Labelled findings of a corpus that has no reviewed ones: ``secret`` from formats that tell by themselves.

    True for issuers' key formats and for values set to a secret's name that mix
    letters and digits; false for numbers alone, for placeholders and for values
    of one or two different characters; null, so not learned from, for the rest.
    """
    value = F.col("value")
    plain = value.rlike("^[0-9][0-9 .:/+-]*$") | value.rlike("(?i)example|changeme|placeholder|your|xxxx|1234567") | value.rlike(r"^(.)\1*$")
    named = F.col("before").rlike(rf"(?i)(?:{_NAMES})[\"']?\s*[=:]\s*[\"']?$") & value.rlike("[0-9]") & value.rlike("[A-Za-z]")
    issued = F.col("rule").isin("private_key", "access_key", "service_token", "web_token")
    return findings.withColumn("secret", F.when(plain, False).when(issued | named, True))


@query("op10_secret_scan")
def op10_secret_scan(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", "source")
    findings = saved(find(docs))
    learned = F.col("doc_id").isNotNull() & ~held_out()
    forest = train(known_labels(findings.filter(learned)), dictionary(docs.filter(learned)))
    judged = judge(findings, forest)
    return judged.select(
        "doc_id", "start", "length", "rule", F.sha2("value", 256).alias("value_sha256"), "score", (F.col("score") >= ACCEPT).alias("is_secret")
    )
