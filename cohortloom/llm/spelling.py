"""Spelling variants: edits of every word are probed against Bloom filters, and only the hits are joined.

The vocabulary is counted first.  Every length of word has a blocked Bloom
filter of its own: a word sets a few bits of one 64-bit block, and blocks are
combined by a bitwise OR in an aggregate.  Tasks generate all deletions and
replacements of their words as rolling hashes, without building the strings,
and probe them against broadcast filters; an insertion is a deletion seen from
the other word.  Only hits become strings, and an exact join with the
vocabulary removes the false ones.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.registry import query, table
from cohortloom.session import freeze, saved

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LETTERS = "a-zA-ZÀ-ÿ"
BASE = 0x9E3779B97F4A7C15  # of the rolling hash
BITS = 24  # of a filter for each word, at least
PROBES = 1_000_000  # hashed at a time
FILTER_BLOCKS = 2**21  # 64-bit blocks that are broadcast at a time (16 MB); more of them take more rounds
TASK_WORDS = 4_000  # whose edits one task generates


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _masks(h: np.ndarray) -> np.ndarray:
    """Five of the 64 bits of a block."""
    one, mask = np.uint64(1), np.zeros_like(h)
    for k in range(5):
        mask |= one << (h >> np.uint64(34 + 6 * k) & np.uint64(63))
    return mask


def code_points(words: list[str], length: int) -> np.ndarray:
    return np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(len(words), length).astype(np.uint64)


def _powers(length: int) -> np.ndarray:
    """The weights of the positions in the rolling hash."""
    powers = np.full(max(length, 1), BASE, np.uint64)
    powers[0] = 1
    return np.multiply.accumulate(powers)[:length][::-1]


def deletions(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words less one code point, and which differ from the deletion before."""
    n, length = points.shape
    weights = _powers(length)
    ahead = np.zeros((n, length), np.uint64)
    ahead[:, 1:] = np.cumsum(points[:, :-1] * weights[1:], axis=1, dtype=np.uint64)
    whole = points * weights
    behind = np.cumsum(whole[:, ::-1], axis=1, dtype=np.uint64)[:, ::-1] - whole
    own = np.ones((n, length), bool)
    own[:, 1:] = points[:, 1:] != points[:, :-1]
    return ahead + behind, own


def replacements(points: np.ndarray, alphabet: np.ndarray, start: int, stop: int) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words with a letter of positions start to stop replaced by a larger one, and which are such."""
    weights = _powers(points.shape[1])
    part = points[:, start:stop, None]
    whole = (points * weights).sum(axis=1, dtype=np.uint64)
    return whole[:, None, None] + (alphabet - part) * weights[start:stop, None], alphabet > part


class Shard:
    """A range of the blocks of the filter of one length."""

    def __init__(self, blocks: int, low: int, masks: np.ndarray):
        self.blocks, self.low, self.masks = blocks, low, masks

    def hits(self, hashes: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, ...]:
        """The positions of the hashes the filter may hold, among those marked own."""
        h = mixed(hashes[own])
        block = (h & np.uint64(self.blocks - 1)).astype(np.int64) - self.low
        inside = (block >= 0) & (block < len(self.masks))
        masks = _masks(h)
        hit = inside.copy()
        hit[inside] = (self.masks[block[inside]] & masks[inside]) == masks[inside]
        return tuple(axis[hit] for axis in np.nonzero(own))


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, list[str], np.ndarray]]:
    lengths, words = batch["length"].to_numpy(zero_copy_only=False), batch["word"].to_pylist()
    counts = batch["n"].to_numpy(zero_copy_only=False)
    for length in np.unique(lengths):
        at = np.flatnonzero(lengths == length)
        yield int(length), [words[i] for i in at], counts[at]


def _filter_rows(words: DataFrame, blocks: dict[int, int]) -> DataFrame:
    """(length, block, mask) of all filters, blocks that are not zero only."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, own, _ in _by_length(batch):
                h = mixed((code_points(own, length) * _powers(length)).sum(axis=1, dtype=np.uint64))
                block = (h & np.uint64(blocks[length] - 1)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(own), length, np.int32)), pa.array(block), pa.array(_masks(h).view(np.int64))], ["length", "block", "mask"]
                )

    return words.mapInArrow(build, "length int, block bigint, mask bigint").groupBy("length", "block").agg(F.bit_or("mask").alias("mask"))


def _probed(words: DataFrame, shards, alphabet: np.ndarray) -> DataFrame:
    """(word, n, near): the words with those of their edits that the filters may hold."""

    def strings(points: np.ndarray) -> list[str]:
        text, width = points.astype("<u4").tobytes(), 4 * points.shape[1]
        return [text[k : k + width].decode("utf-32-le") for k in range(0, len(text), width)]

    def edits(length: int, points: np.ndarray) -> Iterator[tuple[np.ndarray, list[str]]]:
        """(lines, edits) of words of one length, in bounded pieces."""
        for shard in shards.value.get(length - 1, ()):
            i, at = shard.hits(*deletions(points))
            kept = np.ones((len(i), length), bool)
            kept[np.arange(len(i)), at] = False
            if length > 1 and len(i):
                yield i, strings(points[i][kept].reshape(len(i), length - 1))
        step = max(1, PROBES // max(1, len(points) * len(alphabet)))
        for shard in shards.value.get(length, ()) if len(alphabet) else ():
            for start in range(0, length, step):
                i, at, letter = shard.hits(*replacements(points, alphabet, start, start + step))
                changed = points[i]
                changed[np.arange(len(i)), start + at] = alphabet[letter]
                if len(i):
                    yield i, strings(changed)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, own, counts in _by_length(batch):
                some = max(1, PROBES // max(1, length * max(1, len(alphabet))))
                for start in range(0, len(own), some):
                    part, n = own[start : start + some], counts[start : start + some]
                    for lines, near in edits(length, code_points(part, length)):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([part[i] for i in lines], pa.string()), pa.array(n[lines]), pa.array(near, pa.string())], ["word", "n", "near"]
                        )

    return words.mapInArrow(probe, "word string, n bigint, near string")


def _rounds(blocks: dict[int, int], most: int) -> list[list[tuple[int, int, int]]]:
    """(length, low, high) ranges of blocks, dealt to rounds of at most so many blocks."""
    rounds, room = [], 0
    for length, count in sorted(blocks.items()):
        low = 0
        while low < count:
            if not room:
                rounds.append([])
                room = most
            high = min(count, low + room)
            rounds[-1].append((length, low, high))
            room -= high - low
            low = high
    return rounds


def near_words(words: DataFrame, filter_blocks: int = FILTER_BLOCKS) -> DataFrame:
    """(word, n, near, near_n): each two words of (word, n, length) that are one edit apart, once.

    ``words`` must be saved and distinct.  What the driver collects and
    broadcasts is one round of filters, ``filter_blocks`` blocks at most, and
    the count of words per length; lengths are few, as words of many lengths
    need text as long as the square of their number.
    """
    spark = words.sparkSession
    blocks = {r["length"]: 2 ** max(6, math.ceil(math.log2(r["words"] * BITS / 64))) for r in words.groupBy("length").agg(F.count("*").alias("words")).collect()}
    letters = words.select(F.explode(F.array_distinct(F.split("word", ""))).alias("c")).distinct()
    alphabet = np.sort(np.array([ord(r["c"]) for r in letters.filter("c <> ''").collect()], np.uint64))
    filters = saved(_filter_rows(words, blocks))
    found = None
    for parts in _rounds(blocks, filter_blocks):
        shards: dict[int, list[Shard]] = {}
        some = filters.filter(" OR ".join(f"(length = {n} AND block >= {low} AND block < {high})" for n, low, high in parts)).toArrow()
        length, block, mask = (some[c].to_numpy() for c in ("length", "block", "mask"))
        for n, low, high in parts:
            masks, own = np.zeros(high - low, np.uint64), length == n
            masks[block[own] - low] = mask[own].view(np.uint64)
            shards.setdefault(n, []).append(Shard(blocks[n], low, masks))
        sizes = sorted({n + k for n in shards for k in (0, 1)})
        probing = words.filter(F.col("length").isin(sizes))
        hits = _probed(probing, spark.sparkContext.broadcast(shards), alphabet)
        exact = saved(hits.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near"))
        found = exact if found is None else found.unionByName(exact)
    return found if found is not None else spark.createDataFrame([], "near string, word string, n bigint, near_n bigint")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form) without circles: the last word that the forms lead to, by doubling steps."""
    now = freeze(forms.select("word", F.col("form").alias("root")))
    while True:
        after = now.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        step = freeze(now.join(after, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")))
        now = step.select("word", "root")
        if step.filter("_moved").isEmpty():
            return now


def group_variants(words: DataFrame, ratio: int = 5, filter_blocks: int = FILTER_BLOCKS) -> DataFrame:
    """word, n, n_near, form, form_n and root for every word of (word, n).

    Two words are near if they differ by one inserted, deleted or replaced code
    point.  A word's form is its near word of largest n, ties going to the
    smallest, if that has at least ``ratio`` times its n, else null; its root
    is the last word the forms lead to.  ``ratio`` has to be above 1, as else
    forms could lead in circles.

    The n of repeated rows are added up; rows with a null or empty word or a
    null n are left out.  Words of any length are whole: the work on one is its
    length times the letters in use.  Other columns do not matter, and an empty
    table gives no rows.
    """
    if ratio <= 1:
        raise ValueError("ratio has to be above 1")
    sums = words.filter("word <> '' AND n IS NOT NULL").groupBy("word").agg(F.sum("n").cast("bigint").alias("n"))
    known = saved(sums.withColumn("length", F.char_length("word")))
    tasks = max(1, math.ceil(known.count() / TASK_WORDS))
    known = saved(known.repartition(tasks, "word"))
    pairs = near_words(known, filter_blocks)
    both = pairs.select("word", "n", F.col("near").alias("other"), F.col("near_n").alias("other_n")).unionByName(
        pairs.select(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    )
    best = both.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("other"))).alias("best")
    )
    whole = known.drop("length").join(best, "word", "left").withColumn("_form", -F.col("best.less") >= ratio * F.col("n"))
    formed = saved(
        whole.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(F.col("_form"), F.col("best.other")).alias("form"), F.when(F.col("_form"), -F.col("best.less")).alias("form_n"),
        )
    )
    ends = roots(formed.filter("form IS NOT NULL"))
    return formed.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))


def count_words(
    documents: DataFrame, least_length: int = 6, least_count: int = 5, damage: int | None = None
) -> DataFrame:
    """(word, n): the runs of letters of the whole texts of (doc_id, text), A to Z in lower case, that occur often enough.

    ``damage`` makes test data: where it divides the crc32 of ``doc_id:run``,
    the run loses its code point at that number modulo its length.  A null
    doc_id damages nothing.  A null text has no words.  The counts are combined
    before the shuffle; texts of any length are read whole.
    """
    pattern = f"[{LETTERS}]{{{least_length},}}+"
    run = F.when(F.octet_length("_run") == F.char_length("_run"), F.lower("_run")).otherwise(F.translate("_run", UPPER, LOWER))
    rows = documents.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).alias("_run")).select("doc_id", run.alias("word"))
    if damage is not None:
        h = F.crc32(F.concat(F.col("doc_id").cast("string"), F.lit(":"), F.col("word")).cast("binary"))
        at = (h % F.char_length("word")).cast("int")
        less = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.char_length("word")))
        rows = rows.select(F.when(h % damage == 0, less).otherwise(F.col("word")).alias("word")).filter(F.char_length("word") >= least_length)
    return rows.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least_count)


@query("op11_spelling_variants")
def op11_spelling_variants(spark, sf):
    words = count_words(table(spark, sf, "documents").select("doc_id", "text"), damage=199)
    return group_variants(words).select("word", "form", "root", "n", "n_near", "form_n")
