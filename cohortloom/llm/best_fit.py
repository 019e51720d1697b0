"""Best-fit packing of token sequences with certified bin counts.

Documents become token pieces of at most one sequence length.  Pieces are dealt
to partitions of bounded size and packed there by best-fit decreasing.  A lower
bound from dual-feasible functions certifies a partition whose bin count it
reaches; the partitions with a gap exchange the pieces of their bins that are
not full, and these are packed again, as long as that saves sequences.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.batches import small_batches
from cohortloom.llm.registry import query, table
from cohortloom.session import saved

CAPACITY = 1024
END = 2  # the id after every document
PART_ITEMS = 20_000  # pieces that one task packs, about
ROUNDS = 4  # of exchange, at most
CACHED = 64 << 20  # bytes of words and ids that a task keeps, about
LONG_WORD = 64  # characters; longer ones are not kept
LONG_SPACE = 10_000  # white space of more characters goes round the encoder's pattern matcher, which has a limit
DOCS_AT_ONCE = 500  # texts sent to Python at a time

_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
_SPACES = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{%d,}" % LONG_SPACE)
_OTHER = re.compile("[^\t-\r\x20-\x7eÀ-ɏ]")  # characters that Python's classes and the tokenizer's may see differently


class Encoder:
    """Ids of the byte-level BPE as bytes of little-endian unsigned 32-bit numbers; words seen before are looked up."""

    def __init__(self, ranks_path: str, pattern: str, cached: int = CACHED):
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.bpe = tiktoken.Encoding("byte_bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.seen: dict[str, bytes] = {}
        self.held = 0
        self.cached = cached

    def encode(self, text: str) -> bytes:
        if _OTHER.search(text):
            return self._pack(text)
        words = _WORDS.findall(text)
        try:
            return b"".join(map(self.seen.__getitem__, words))
        except KeyError:
            own = dict.fromkeys(words)
            for word in own:
                ids = self.seen.get(word)
                if ids is None:
                    ids = self._pack(word)
                    if len(word) <= LONG_WORD:
                        self._keep(word, ids)
                own[word] = ids
            return b"".join(map(own.__getitem__, words))

    def _keep(self, word: str, ids: bytes) -> None:
        size = 200 + len(word) + len(ids)  # with the objects' own
        if self.held + size > self.cached:
            self.seen, self.held = {}, 0
        if size <= self.cached:
            self.seen[word] = ids
            self.held += size

    def _pack(self, text: str) -> bytes:
        if len(text) < LONG_SPACE:
            return np.asarray(self.bpe.encode_ordinary(text), dtype="<u4").tobytes()
        out, done = [], 0
        for spaces in _SPACES.finditer(text):
            # The last white space before a word belongs to what follows, the others are one word.
            end = spaces.end() if spaces.end() == len(text) else spaces.end() - 1
            out += [self.bpe.encode_ordinary(text[done : spaces.start()]), self._space_ids(text[spaces.start() : end])]
            done = end
        out.append(self.bpe.encode_ordinary(text[done:]))
        return b"".join(np.asarray(ids, dtype="<u4").tobytes() for ids in out)

    def _space_ids(self, spaces: str) -> list[int]:
        return self.bpe._encode_single_piece(spaces)


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document with n >= 1 ids: all full but perhaps the first."""
    first = n % capacity or capacity
    return [(0, first), *[(s, capacity) for s in range(first, n, capacity)]]


def token_pieces(docs: DataFrame, with_ids: bool = False, capacity: int = CAPACITY, ranks_path: str | None = None) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, and the ids as binary if asked for.

    A null text counts as empty, which is one piece with the end id alone.
    Whole texts of any length are encoded.  Rows that repeat a doc_id are cut
    each on its own.
    """
    import public_tokenizers

    path, pattern = ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    id_type = docs.schema["doc_id"].dataType.simpleString()
    end = END.to_bytes(4, "little")

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(path, pattern)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                ids = (encoder.encode(text) if text else b"") + end
                for piece, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                    own = ids[4 * start : 4 * (start + length)]
                    rows.append((doc_id, piece, start, length, zlib.crc32(own), *([own] if with_ids else [])))
            out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])])
            out["doc_id"] = out["doc_id"].astype("Int64" if id_type in ("bigint", "int") else object)
            yield out

    columns = f"doc_id {id_type}, piece int, start bigint, length bigint, ids_crc32 bigint" + (", ids binary" if with_ids else "")
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInPandas(pieces, columns)


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """Sequences that any packing needs, from dual-feasible functions; counts[s] pieces have length s."""
    sizes = np.arange(capacity + 1)
    best = -(-int((counts * sizes).sum()) // capacity)
    below, large = np.cumsum(counts), np.cumsum(counts[::-1])[::-1]
    filled = np.cumsum(counts * sizes)
    for k in range(1, capacity // 2 + 1):  # pieces over capacity - k count whole, those under k not at all
        whole = int(large[capacity - k + 1])
        middle = int(filled[capacity - k] - filled[k - 1])
        best = max(best, whole + -(-middle // capacity))
    for k in range(1, 101):  # lengths rounded down to k-ths of a sequence, those that divide it evenly kept
        scaled = (k + 1) * sizes
        value = np.where(scaled % capacity == 0, sizes * k, (scaled // capacity) * capacity)
        best = max(best, -(-int((counts * value).sum()) // (k * capacity)))
    return int(best) if below[-1] else 0


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """(bin and offset of every piece, fill of every bin)."""
    order = np.argsort(-lengths, kind="stable")
    bins, offsets, fill = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64), []
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]  # by room left
    rooms = 0  # bit r: some bin has room r
    for at, length in zip(order.tolist(), lengths[order].tolist()):
        fits = rooms >> length
        if fits:
            room = length + (fits & -fits).bit_length() - 1
            b = open_bins[room].pop()
            if not open_bins[room]:
                rooms &= ~(1 << room)
        else:
            b, room = len(fill), capacity
            fill.append(0)
        bins[at], offsets[at] = b, fill[b]
        fill[b] += length
        left = room - length
        if left:
            open_bins[left].append(b)
            rooms |= 1 << left
    return bins, offsets, fill


def _pack_round(items: DataFrame, number: int, capacity: int, part_items: int) -> DataFrame:
    """Deal the items, by their row number, to partitions of about ``part_items`` and pack each; saved, as later rounds build on it."""
    parts = max(1, -(-items.count() // part_items))
    names = items.columns
    dealt = items.withColumn("_part", F.pmod(F.xxhash64("_row", F.lit(number)), F.lit(parts)).cast("int"))
    out_schema = items.withColumn("sequence_id", F.lit(0).cast("bigint")).withColumn("offset", F.lit(0).cast("bigint")).withColumn("_room", F.lit(0).cast("bigint")).withColumn("_certified", F.lit(True)).schema

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        part = int(group["_part"].iloc[0])
        group = group.sort_values(["length", "doc_id", "piece", "_row"], ascending=[False, True, True, True], kind="stable")
        lengths = group["length"].to_numpy()
        bins, offsets, fill = best_fit_decreasing(lengths, capacity)
        bound = lower_bound(np.bincount(lengths, minlength=capacity + 1), capacity)
        out = group[names].copy()
        out["sequence_id"] = (number << 56) + (part << 32) + bins
        out["offset"] = offsets
        out["_room"] = capacity - np.asarray(fill)[bins]
        out["_certified"] = len(fill) <= bound
        return out

    return saved(dealt.groupBy("_part").applyInPandas(pack, out_schema))


def pack(pieces: DataFrame, capacity: int = CAPACITY, part_items: int = PART_ITEMS, rounds: int = ROUNDS) -> DataFrame:
    """Add sequence_id and offset to piece rows (doc_id, piece, length and any more columns but those two).

    No sequence holds more than ``capacity`` ids; offsets are gapless from 0.
    Pieces as long as a sequence fill one each.  Repeated rows are packed each
    and spread over the parts; an empty table gives no rows.  Exchange stops when all partitions are
    certified, when a round saves nothing, or after ``rounds``.  Binary columns
    (the ids) stay out of the rounds and are joined to their rows at the end.
    """
    columns = pieces.columns
    with small_batches(pieces.sparkSession, DOCS_AT_ONCE):
        stored = saved(pieces.withColumn("_row", F.monotonically_increasing_id()))  # saved, so it stays the same
    heavy = [f.name for f in stored.schema if f.dataType.typeName() == "binary"]
    pieces = stored.drop(*heavy)
    full = pieces.filter(F.col("length") == capacity).select(
        "*", (-1 - F.col("_row")).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset")
    )
    names = pieces.columns
    placed = _pack_round(pieces.filter(F.col("length") < capacity), 1, capacity, part_items)
    done = []
    for number in range(2, rounds + 2):
        freed = placed.filter(~F.col("_certified") & (F.col("_room") > 0))
        before = freed.filter(F.col("offset") == 0).count()
        if not before:
            break
        again = _pack_round(freed.select(*names), number, capacity, part_items)
        if again.filter(F.col("offset") == 0).count() >= before:
            break
        done.append(placed.filter(F.col("_certified") | (F.col("_room") == 0)))
        placed = again
    out = full
    for part in [*done, placed]:
        out = out.unionByName(part.drop("_room", "_certified"))
    if heavy:
        out = out.join(stored.select("_row", *heavy), "_row")
    return out.select(*columns, "sequence_id", "offset")


def bound_of(pieces: DataFrame, capacity: int = CAPACITY) -> int:
    """The lower bound for all pieces together, from their counts by length."""
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect():  # one row per length
        counts[r["length"]] = r["n"]
    return lower_bound(counts, capacity)


@query("op6_best_fit_packing")
def op6_best_fit_packing(spark, sf):
    return pack(token_pieces(table(spark, sf, "documents").select("doc_id", "text")))
