"""Exact Jaccard join of word n-gram sets with prefix filters under several global token orders.

If two sets are similar enough they share a token among the first tokens of both
under *any* fixed order of all tokens.  Pairs must pass the prefixes of three
rare-first orders with different tie-breaks, and are then verified on the whole
sets.  Which pairs are tried is found by buckets.  Similar sets differ in few
tokens; if all tokens are dealt into more parts than that, the sets agree in some
part, and a bucket holds the sets that agree in all tokens of a part.  Where the
parts would be too small (``LEAST_BY_PARTS``), a bucket is a token of the first
order's prefix.  From the second round on, parities of groups of tokens tell most
pairs of a bucket apart.  Sets that are equal are one class from the start; inside a bucket
of classes only links between different components are looked for.
"""

from __future__ import annotations

import hashlib
import logging
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from cohortloom.llm.batches import FREE_SHUFFLES, settings, small_batches
from cohortloom.llm.components import components
from cohortloom.llm.registry import query, table
from cohortloom.session import BROADCAST_ROWS, broadcast_if_small, discard, freeze, saved, scratch_path

COUNTERS = 1 << 18  # of the sketch of document counts that orders tokens rare first
CHUNK = 1 << 21  # bytes of text hashed at a time (a longer text is one chunk)
TEXTS_AT_ONCE = 500  # texts, or pairs of them, that a task hands to Python at a time
LEAST_BY_PARTS = 80  # percent; below it, the parts two sets agree in hold too few tokens to tell sets apart
PART_STEP = 1.25  # from the largest size dealt into some number of parts to the next
TOKENS_AT_ONCE = 1 << 20  # dealt into parts at a time (a larger set is dealt at once)
PIVOTS = 4  # classes of a bucket that the others are compared with in a later round
SPARSE = 128  # open pairs per bucket row, up to which all of them are compared after the first round, by their parities
PARITIES = 4  # numbers of 64 parities each
SLOW = 0.9  # share of the open pairs a round of pivots must get below; after two rounds in a row that do not, all are compared

log = logging.getLogger(__name__)
_U = np.uint64


def _mix(x: np.ndarray, salt: int) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    with np.errstate(over="ignore"):
        x = x ^ _U(salt)
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


_BYTES = _mix(np.arange(256, dtype=_U), 0x9E3779B97F4A7C15)
_BYTES[65:91] = _BYTES[97:123]  # A-Z count as a-z
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_SALTS = (0x243F6A8885A308D3, 0x13198A2E03707344, 0xA4093822299F31D0)  # one per order


def _powers(n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(np.concatenate([[_U(1)], np.full(max(0, n - 1), 0x9FB21C651E98DF25, dtype=_U)]))


def shingle_sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text.

    Words are runs of bytes other than ASCII white space.  A text with fewer
    than ``width`` words has one shingle, the whole sequence; without words it
    has none.
    """
    out, start = [], 0
    while start < len(texts):
        stop, size = start, 0
        while stop < len(texts) and (stop == start or size + len(texts[stop]) <= CHUNK):
            size += len(texts[stop])
            stop += 1
        out += _chunk_sets(texts[start:stop], width)
        start = stop
    return out


def _chunk_sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    data = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts])
    blank = _BLANK[data]
    word = ~blank
    first = word.copy()
    first[1:] &= blank[:-1]
    starts = np.flatnonzero(first)
    if not len(starts):
        return [np.zeros(0, dtype=_U) for _ in texts]
    stops = np.flatnonzero(blank[1:] & word[:-1]) + 1
    lengths = stops - starts
    at = np.flatnonzero(word)
    place = np.arange(len(at)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    with np.errstate(over="ignore"):
        value = _BYTES[data[at]] * _powers(int(lengths.max()))[place]
        words = _mix(np.add.reduceat(value, np.cumsum(lengths) - lengths) + lengths.astype(_U), 1)
        whole = words.copy()
        if width > 1 and len(words) >= width:
            count = len(words) - width + 1
            whole = np.zeros(count, dtype=_U)
            for k in range(width):
                whole = whole * _U(0xD6E8FEB86659FD93) + words[k : k + count]
            whole = _mix(whole, 2)
        bounds = np.searchsorted(starts, np.concatenate([[0], ends]))
        out = []
        for lo, hi in zip(bounds[:-1], bounds[1:]):
            n = hi - lo
            if n >= width:
                out.append(np.unique(whole[lo : hi - width + 1]))
            elif n:
                total = _U(n)
                for w in words[lo:hi]:
                    total = total * _U(0xD6E8FEB86659FD93) + w
                out.append(_mix(np.array([total], dtype=_U), 3))
            else:
                out.append(np.zeros(0, dtype=_U))
    return out


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    column = batch.column("text")
    return [b"" if v is None else v for v in column.cast(pa.binary() if pa.types.is_string(column.type) else pa.large_binary()).to_pylist()]


def prefix_size(n: int, percent: int) -> int:
    """First tokens of a set of n of which two sets with that Jaccard percentage share one, under any order."""
    return n - -(-percent * n // 100) + 1


def order_keys(tokens: np.ndarray, levels: np.ndarray, order: int) -> np.ndarray:
    """The place of tokens in an order: by document-count level, then by a scramble that differs between the orders."""
    return (levels[(tokens & _U(COUNTERS - 1)).astype(np.int64)].astype(_U) << _U(57)) | (_mix(tokens, _SALTS[order]) >> _U(7))


def prefixes(tokens: np.ndarray, levels: np.ndarray, percent: int, order: int) -> np.ndarray:
    """The order keys of the first tokens of a set, unsorted."""
    keys = order_keys(tokens, levels, order)
    size = prefix_size(len(tokens), percent) if len(tokens) else 0
    return keys if size >= len(keys) else np.partition(keys, size - 1)[:size]


def least_overlap(n_a, n_b, percent: int):
    """Tokens that two sets of these sizes share at least when they are similar enough (columns)."""
    return F.ceil((n_a + n_b) * percent / (100 + percent) - 1e-9)


def _profiles(docs: DataFrame, width: int) -> DataFrame:
    """Rows (doc_id, n, digest) of the documents, and rows (counter, seen) of the sketch of document counts.

    A task tells only the counters that stand out in it; all others are rare.
    """

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(COUNTERS, dtype=np.int64)
        for batch in batches:
            sets = shingle_sets(_texts(batch), width)
            if sets:
                seen += np.bincount((np.concatenate(sets) & _U(COUNTERS - 1)).astype(np.int64), minlength=COUNTERS)
            n = len(sets)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                    pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64()),
                ],
                names=["doc_id", "n", "digest", "counter", "seen"],
            )
        at = np.flatnonzero(seen > 2 * seen.mean() + 1)  # the rest tells nothing rare from frequent
        n = len(at)
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()), pa.array(at.astype(np.int32)), pa.array(seen[at])],
            names=["doc_id", "n", "digest", "counter", "seen"],
        )

    return saved(docs.mapInArrow(profile, "doc_id bigint, n bigint, digest binary, counter int, seen bigint"))


def _levels(profiles: DataFrame) -> np.ndarray:
    """log2 of the document count of every counter; as many numbers as the sketch has counters."""
    out = np.zeros(COUNTERS, dtype=np.uint8)
    sums = profiles.filter("counter IS NOT NULL").groupBy("counter").agg(F.sum("seen").alias("seen")).toPandas()
    out[sums["counter"].to_numpy(dtype=np.int64)] = np.log2(sums["seen"].to_numpy(dtype=float)).astype(np.uint8)
    return out


def part_schemes(percent: int, largest: int) -> list[tuple[int, int, int]]:
    """(largest size, parts, spare parts) of every deal that sets up to a size need, smallest first.

    A similar pair meets in the deal of its larger set.  There are more parts
    than tokens the pair may differ in, and ``spare`` more, so it agrees in more
    than ``spare`` parts.  These are as many as few sets leave empty.  A deal
    whose pairs may not differ at all has no parts, as equal sets are one class.
    """
    out, low, top = [], 1, 1
    while True:
        differ, least, spare = 2 * top * (100 - percent) // (100 + percent), -(-percent * low // 100), 1
        for _ in range(30):
            parts = differ + 1 + spare
            empty = parts * math.exp(-least / parts)
            spare = max(1, math.ceil(empty + 4 * math.sqrt(empty)))
        out.append((top, differ + 1 + spare if differ else 0, spare))
        if top >= largest:
            return out
        low, top = top + 1, max(top + 1, int(top * PART_STEP))


def part_keys(sets: list[np.ndarray], percent: int, levels: np.ndarray) -> list[np.ndarray]:
    """The keys of the parts of each set; two similar sets that differ share one.

    Only tokens that no sketch counter tells frequent are dealt, so a common
    passage makes no bucket.  Of the parts a pair agrees in, one is not empty
    unless both sets leave more than the spare parts empty.  Such sets are dealt
    again with all tokens; if too many parts stay empty, the empty ones count.
    """
    out, start = [], 0
    while start < len(sets):
        stop, size = start, 0
        while stop < len(sets) and (stop == start or size + len(sets[stop]) <= TOKENS_AT_ONCE):
            size += len(sets[stop])
            stop += 1
        out += _slice_keys(sets[start:stop], percent, levels)
        start = stop
    return out


def _slice_keys(sets: list[np.ndarray], percent: int, levels: np.ndarray) -> list[np.ndarray]:
    sizes = np.array([len(x) for x in sets])
    reach = 100 * sizes // percent  # of the larger set of a pair
    tops, parts, spare = (np.array(x) for x in zip(*part_schemes(percent, int(reach.max()))))
    first, last = np.searchsorted(tops, sizes), np.searchsorted(tops, reach)
    deals = np.where(sizes > 0, last - first + 1, 0)
    own = np.repeat(np.arange(len(sets)), deals)
    scheme = np.arange(len(own)) - np.repeat(np.cumsum(deals) - deals - first, deals)
    own, scheme = own[parts[scheme] > 0], scheme[parts[scheme] > 0]
    rare = [x[levels[(x & _U(COUNTERS - 1)).astype(np.int64)] == 0] for x in sets]
    of, keys, held, empty = _dealt(rare, own, scheme, parts, 4)
    few = empty > spare[scheme]
    own, scheme = own[few], scheme[few]
    of_all, keys_all, held_all, empty = _dealt(sets, own, scheme, parts, 6)
    held_all |= np.repeat(empty > spare[scheme], parts[scheme])
    of, keys = np.concatenate([of[held], of_all[held_all]]), np.concatenate([keys[held], keys_all[held_all]])
    order = np.argsort(of, kind="stable")
    return np.split(keys[order], np.searchsorted(of[order], np.arange(1, len(sets))))


def _dealt(sets: list[np.ndarray], own: np.ndarray, scheme: np.ndarray, parts: np.ndarray, salt: int) -> tuple:
    """Of the deals ``scheme`` of the sets ``own``: for each part its set, its key and whether it holds tokens; for each deal its empty parts."""
    counts = parts[scheme]
    begin, total = np.cumsum(counts) - counts, int(counts.sum())
    sizes = np.array([len(x) for x in sets], dtype=np.int64)[own]
    tokens = _mix(np.concatenate([*(sets[i] for i in own), np.zeros(0, dtype=_U)]), 0x452821E638D01377)
    part = ((tokens >> _U(32)) * np.repeat(counts, sizes).astype(_U)) >> _U(32)
    at = np.repeat(begin, sizes) + part.astype(np.int64)
    held, sums = np.bincount(at, minlength=total) > 0, np.zeros(total, dtype=_U)
    np.add.at(sums, at, tokens)
    number = np.repeat(scheme, counts) * (1 << 40) + np.arange(total) - np.repeat(begin, counts)
    deal = np.repeat(np.arange(len(own)), counts)
    empty = np.bincount(deal[~held], minlength=len(own))
    return own[deal], _mix(sums ^ _mix(number.astype(_U), salt), salt + 1), held, empty


def _signatures(docs: DataFrame, width: int, percent: int, levels) -> DataFrame:
    """(doc_id, n, tokens): the names of the buckets of every set."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets(_texts(batch), width)
            keys = part_keys(sets, percent, levels.value) if percent >= LEAST_BY_PARTS else [prefixes(s, levels.value, percent, 0) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()), pa.array([len(s) for s in sets], pa.int32()),
                    pa.array([k.view(np.int64) for k in keys], pa.list_(pa.int64())),
                ],
                names=["doc_id", "n", "tokens"],
            )

    return docs.filter("doc_id IS NOT NULL").mapInArrow(sign, "doc_id bigint, n int, tokens array<bigint>")


def _buckets(docs: DataFrame, own: DataFrame, classes: DataFrame, width: int, percent: int, levels) -> DataFrame:
    """(token, doc_id, n) of the rows that classes are named after, each once."""
    reps = classes.select(F.col("rep").alias("doc_id")).distinct()
    if reps.count() <= BROADCAST_ROWS:
        signed = _signatures(docs.join(F.broadcast(reps), "doc_id", "left_semi"), width, percent, levels)
    else:
        rest = freeze(own.filter("doc_id IS NOT NULL").select("doc_id").distinct().join(reps, "doc_id", "left_anti"))
        if rest.count() <= BROADCAST_ROWS:
            signed = _signatures(docs.join(F.broadcast(rest), "doc_id", "left_anti"), width, percent, levels)
        else:
            signed = _signatures(docs, width, percent, levels).join(reps, "doc_id", "left_semi")
    rows = signed.select(F.explode("tokens").alias("token"), "doc_id", "n")
    repeated = own.filter("doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1")
    return rows if repeated.isEmpty() else rows.distinct()


def parities(tokens: np.ndarray) -> np.ndarray:
    """For 64 * PARITIES groups of all tokens, whether a set holds an odd number of the group.

    Every token that only one of two sets holds turns one parity, so no more of
    them differ than tokens do.
    """
    odd = np.bincount((_mix(tokens, 0xBE5466CF34E90C6C) >> _U(32)).astype(np.int64) % (64 * PARITIES), minlength=64 * PARITIES) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _parities(docs: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """(doc_id, n, p0, p1, ...): the parities of the documents of some ids, checkpointed."""
    names = [f"p{k}" for k in range(PARITIES)]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets(_texts(batch), width)
            found = np.array([parities(s) for s in sets], dtype=np.int64).reshape(len(sets), PARITIES)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array([len(s) for s in sets], pa.int32()), *[pa.array(found[:, k]) for k in range(PARITIES)]],
                names=["doc_id", "n", *names],
            )

    some = docs.join(broadcast_if_small(ids), "doc_id", "left_semi")
    return freeze(some.mapInArrow(count, "doc_id bigint, n int, " + ", ".join(f"{x} bigint" for x in names)).distinct())


def _may_link(percent: int, a: list, b: list):
    """Whether sizes n_a and n_b and the parities of a pair, if there are any, allow for enough shared tokens."""
    close = (F.col("n_a") * 100 >= F.col("n_b") * percent) & (F.col("n_b") * 100 >= F.col("n_a") * percent)
    if not a:
        return close
    differ = sum((F.bit_count(x.bitwiseXOR(y)) for x, y in zip(a, b)), F.lit(0))
    return close & (differ * (100 + percent) <= (F.col("n_a") + F.col("n_b")) * (100 - percent))


def _open(rows: DataFrame, draws: list) -> DataFrame:
    """The rows (token, doc_id, n, component, parities) of buckets with several components, with pivots and sizes of bucket and component."""
    bucket = Window.partitionBy("token")
    several = rows.withColumns({"_lo": F.min("component").over(bucket), "_hi": F.max("component").over(bucket)}).filter("_lo <> _hi").drop("_lo", "_hi")
    known = [x for x in rows.columns if x != "token"]
    pivots = F.array(*[F.min(F.struct(h.alias("h"), *known)).over(bucket) for h in draws])
    return several.withColumns({"_m": F.count("*").over(bucket), "pivots": pivots}).withColumn("_c", F.count("*").over(Window.partitionBy("token", "component")))


def _upper_half(keys: np.ndarray) -> np.ndarray:
    """Order keys in 32 bits.  They sort alike; where two become one, ``_passes`` counts fewer missing tokens, never more."""
    return (keys >> _U(32)).astype(np.int32)


def _with_orders(docs: DataFrame, width: int, percent: int, levels) -> DataFrame:
    """(doc_id, text, first, second, third): the prefixes in the three orders."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets(_texts(batch), width)
            orders = [pa.array([_upper_half(prefixes(s, levels.value, percent, k)) for s in sets], pa.list_(pa.int32())) for k in (0, 1, 2)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), batch.column("text"), *orders], names=["doc_id", "text", "first", "second", "third"])

    return docs.mapInArrow(sign, "doc_id bigint, text string, first array<int>, second array<int>, third array<int>")


def _passes(order: str, percent: int):
    """Whether the prefixes of a pair in one order allow for enough shared tokens.

    A token of one prefix that comes no later than the end of the other prefix is
    in the other set only if it is in that prefix; no more such tokens may be
    missing than the sizes allow.
    """
    a, b = F.col(f"{order}_a"), F.col(f"{order}_b")
    shared = least_overlap(F.col("n_a"), F.col("n_b"), percent)

    def missing(x, y):
        return F.size(F.filter(F.array_except(x, y), lambda k: k <= F.array_max(y)))

    return F.arrays_overlap(a, b) & (missing(a, b) <= F.col("n_a") - shared) & (missing(b, a) <= F.col("n_b") - shared)


def _verified(pairs: DataFrame, width: int, percent: int) -> DataFrame:
    """(a, b) of the rows (a, b, text_a, text_b) whose sets are similar enough."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = []
            for name in ("text_a", "text_b"):
                column = batch.column(name).dictionary_encode()
                texts = [b"" if v is None else v.encode("utf-8") for v in column.dictionary.to_pylist()]
                sides.append((column.indices.to_numpy(zero_copy_only=False), shingle_sets(texts, width)))
            (at_a, sets_a), (at_b, sets_b) = sides
            keep = np.zeros(len(batch), dtype=bool)
            for i, (p, q) in enumerate(zip(at_a, at_b)):
                x, y = sets_a[p], sets_b[q]
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep[i] = 100 * both >= percent * (len(x) + len(y) - both) and both > 0
            yield batch.filter(pa.array(keep)).select(["a", "b"])

    return pairs.mapInArrow(verify, "a bigint, b bigint")


def _linked(pairs: DataFrame, docs: DataFrame, width: int, percent: int, levels) -> DataFrame:
    """(a, b) of the pairs (a, b, n_a, n_b) that pass the other orders and are similar enough, checkpointed.

    Only the texts of documents in pairs are moved, and only those in pairs that
    pass all orders are joined to pairs.
    """
    spark = docs.sparkSession
    ids = freeze(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct())
    path = scratch_path(spark, "texts")
    some = saved(_with_orders(docs.join(broadcast_if_small(ids), "doc_id", "left_semi"), width, percent, levels), path)
    orders = some.select("doc_id", "first", "second", "third")
    both = orders.toDF("a", "first_a", "second_a", "third_a").join(broadcast_if_small(pairs), "a")
    both = both.join(orders.toDF("b", "first_b", "second_b", "third_b"), "b")
    kept = freeze(both.filter(_passes("first", percent) & _passes("second", percent) & _passes("third", percent)).select("a", "b").distinct())
    few, texts = broadcast_if_small(kept), some.select("doc_id", "text")
    with_a = texts.toDF("a", "text_a").join(few, "a")
    of_b = texts.toDF("b", "text_b").join(few.select("b"), "b", "left_semi")
    linked = freeze(_verified(with_a.join(of_b, "b").select("a", "b", "text_a", "text_b"), width, percent))
    discard(spark, path)
    return linked


def similar_sets(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id.

    Sets of distinct ``width``-word shingles (A-Z lower-cased) are linked when
    their Jaccard similarity is at least ``percent``; component_id is the
    smallest doc_id reachable by links.  Texts without words link with nothing.
    Rows that repeat a doc_id count as one node; rows without doc_id link with
    nothing and have no component.  No pair inside a component is needed twice,
    so groups of copies cost about their size; every link between different
    components is found.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    spark = docs.sparkSession
    with small_batches(spark, TEXTS_AT_ONCE), settings(spark, FREE_SHUFFLES):  # all jobs that hand texts to Python run in here
        return _similar_sets(docs, width, percent)


def _similar_sets(docs: DataFrame, width: int, percent: int) -> DataFrame:
    spark = docs.sparkSession
    profiles = _profiles(docs, width)
    levels = spark.sparkContext.broadcast(_levels(profiles))  # a fixed number of bytes
    own = profiles.filter("counter IS NULL").select("doc_id", "n", "digest")
    classes = saved(own.filter("n > 0 AND doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("rep")))

    edges, label, path = None, None, None
    rows = _buckets(docs, own, classes, width, percent, levels).withColumn("component", F.col("doc_id"))
    number, before, slow = 0, None, 0
    parity: list[str] = []  # names, once there are any
    while True:
        number += 1
        # the first pivot is the same in all buckets it is in, which joins copies of one text at once
        draws = [F.xxhash64("doc_id")] if number == 1 else [F.xxhash64("doc_id", "token", F.lit(number), F.lit(k)) for k in range(PIVOTS)]
        done, path = path, scratch_path(spark, "open")
        open_rows = saved(_open(rows, draws), path)  # closed buckets stay closed, so a round goes on from the last one's rows
        if done:
            discard(spark, done)
        work = open_rows.agg(F.sum(F.col("_m") - F.col("_c")).alias("ends"), F.count("*").alias("rows")).first()
        if not work["rows"]:
            discard(spark, path)
            break
        open_pairs = work["ends"] / 2
        log.info("round %d: %d rows in open buckets, %d pairs", number, work["rows"], open_pairs)
        # the first round joins near copies, whose pairs would grow with the square of their number;
        # pivots are drawn at random, so a good round may follow a poor one
        slow = slow + 1 if before is not None and open_pairs > SLOW * before else 0
        last = open_pairs <= work["rows"] * (1 if number == 1 else SPARSE) or slow > 1
        before = open_pairs
        if last:  # all pairs of different components that share a bucket
            one, two = (
                open_rows.select("token", F.col("doc_id").alias(x), F.col("n").alias(f"n_{x}"), F.col("component").alias(f"c_{x}"), *[F.col(k).alias(f"{k}_{x}") for k in parity])
                for x in "ab"
            )
            near = _may_link(percent, [F.col(f"{k}_a") for k in parity], [F.col(f"{k}_b") for k in parity])
            met = one.join(two, "token").filter((F.col("a") < F.col("b")) & (F.col("c_a") != F.col("c_b")) & near)
            pairs = met.select("a", "b", "n_a", "n_b").distinct()
        else:  # the pivots of a bucket against the other components
            pivot = [F.col("pivot.doc_id"), F.col("pivot.n")]
            first = pivot[0] < F.col("doc_id")
            pairs = open_rows.withColumn("pivot", F.explode("pivots")).filter(F.col("pivot.component") != F.col("component")).select(
                F.least(pivot[0], "doc_id").alias("a"), F.greatest(pivot[0], "doc_id").alias("b"),
                F.when(first, pivot[1]).otherwise(F.col("n")).alias("n_a"), F.when(first, F.col("n")).otherwise(pivot[1]).alias("n_b"),
                *[F.col(f"pivot.{k}").alias(f"{k}_p") for k in parity], *parity,
            ).filter((F.col("a") < F.col("b")) & _may_link(percent, [F.col(f"{k}_p") for k in parity], [F.col(k) for k in parity])).select("a", "b", "n_a", "n_b").distinct()
        linked = _linked(freeze(pairs), docs, width, percent, levels)
        if not linked.isEmpty():
            edges = linked if edges is None else freeze(edges.unionByName(linked))
            label = freeze(components(edges))
        if last:
            discard(spark, path)
            break
        rows = open_rows.select("token", "doc_id", "n")
        if number == 1:
            found = _parities(docs, freeze(rows.select("doc_id").distinct()), width)
            parity = [x for x in found.columns if x not in ("doc_id", "n")]
        if label is None:
            named = found.withColumn("component", F.col("doc_id"))
        else:
            named = found.join(broadcast_if_small(label), F.col("doc_id") == F.col("node"), "left").withColumn("component", F.coalesce("component", "doc_id"))
        rows = rows.join(named.select("doc_id", "n", "component", *parity), ["doc_id", "n"])

    named = classes.select(F.col("digest").alias("_digest"), "rep")
    out = own.join(named, own["digest"] == named["_digest"], "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("rep", "doc_id").alias("rep"))
    if label is None:
        return out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("rep")).alias("component_id"))
    return out.join(label, out["rep"] == label["node"], "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "rep")).alias("component_id")
    )


def one_of_each(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` without near copies: of each component the row with the smallest doc_id stays.

    Rows that repeat a doc_id are one document, of which one row stays.  Rows
    without doc_id or without words have no copies and stay.  All columns stay.
    """
    found = similar_sets(docs.select("doc_id", "text"), width, percent)
    gone = found.filter("doc_id <> component_id").select("doc_id").distinct()
    kept = docs.join(broadcast_if_small(freeze(gone)), "doc_id", "left_anti").select(*docs.columns)
    repeated = freeze(found.filter("doc_id = component_id").groupBy("doc_id").count().filter("count > 1").select("doc_id"))
    if repeated.isEmpty():
        return kept
    repeated = broadcast_if_small(repeated)
    return kept.join(repeated, "doc_id", "left_anti").select(*docs.columns).unionByName(
        kept.join(repeated, "doc_id", "left_semi").select(*docs.columns).dropDuplicates(["doc_id"])
    )


@query("op8_ngram_jaccard_join")
def op8_ngram_jaccard_join(spark, sf):
    return similar_sets(table(spark, sf, "documents").select("doc_id", "text"), width=3, percent=90)
