"""Hard negatives by exact integer scores: a matrix product in a residue number system, then windowed selection.

Components become integers.  Anchors and rows are multiplied modulo several
small primes in single precision, which is exact there, and the signed scores
are put together again by Chinese remaindering.  Anchors are a stated query
set: they meet all rows in blocks of bounded size, and rows are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from cohortloom.llm.registry import query, table
from cohortloom.operators.spread import ordered_index
from cohortloom.session import saved

PRIMES = (509, 503, 499, 491, 487, 479, 467, 463)
DEPTH = 2**24 // (max(PRIMES) // 2) ** 2  # products that single precision adds up without rounding
ANCHORS = 4096  # of a block, at most
COMPONENTS = 2**21  # of a block of anchors, at most (16 MB)
ROWS = 512  # rows scored at a time
TASK_ROWS = 1_000_000  # rows that share one list of best rows per anchor
LARGEST = 2**56  # of a score, so that its percentages fit 64 bits
NONE = -(2**62)  # below every score


def primes_for(bound: int) -> tuple[int, ...]:
    """As many primes as tell all integers from -bound to bound apart."""
    product = 1
    for n, p in enumerate(PRIMES, 1):
        product *= p
        if product > 2 * bound:
            return PRIMES[:n]
    raise ValueError("scores do not fit 64 bits")


def residues(matrix: np.ndarray, primes: tuple[int, ...]) -> list[np.ndarray]:
    """The integer matrix modulo every prime, around zero, in single precision."""
    return [((matrix + p // 2) % p - p // 2).astype(np.float32) for p in primes]


def _product(x: np.ndarray, y: np.ndarray, p: int) -> np.ndarray:
    total = np.zeros((len(x), len(y)), np.int32)
    for k in range(0, x.shape[1], DEPTH):
        total += (x[:, k : k + DEPTH] @ y[:, k : k + DEPTH].T).astype(np.int32) % p
    return total % p


def scores(x: list[np.ndarray], y: list[np.ndarray], primes: tuple[int, ...]) -> np.ndarray:
    """All inner products of the rows of x and y, exact, from their residues: digits of a mixed radix, around zero."""
    digits: list[np.ndarray] = []
    for k, p in enumerate(primes):
        rest = _product(x[k], y[k], p)
        for q, digit in zip(primes, digits, strict=False):
            rest = (rest - digit) * pow(q, -1, p) % p
        digits.append((rest + p // 2) % p - p // 2)
    value = digits[-1].astype(np.int64)
    for p, digit in zip(primes[-2::-1], digits[-2::-1], strict=True):
        value = value * p + digit
    return value


def merge_best(best: np.ndarray, names: np.ndarray, found: np.ndarray, ids: np.ndarray) -> None:
    """Update the best scores of every line and their ids with a matrix of new scores; ties go to the smaller id."""
    k = best.shape[1]
    least = best[:, -1]
    if found.shape[1] > k and np.count_nonzero(found >= np.maximum(least, NONE + 1)[:, None]) > 4 * k * len(best):
        least = np.maximum(least, np.partition(found, found.shape[1] - k, axis=1)[:, -k])
    line, at = np.nonzero((found >= least[:, None]) & (found > NONE))
    if not len(line):
        return
    changed = np.unique(line)
    of = np.concatenate([np.repeat(changed, k), line])
    value = np.concatenate([best[changed].ravel(), found[line, at]])
    name = np.concatenate([names[changed].ravel(), ids[at]])
    order = np.lexsort((name, -value, of))
    starts = np.searchsorted(of[order], changed)
    first = order[starts[:, None] + np.arange(k)]
    best[changed], names[changed] = value[first], name[first]


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    lengths = pc.list_value_length(batch["embedding"])
    for n in pc.unique(lengths).to_pylist():
        yield n, batch.filter(pc.equal(lengths, n))


def _integers(vectors: pa.Array, length: int, scale: int) -> np.ndarray:
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(flat * scale).astype(np.int64).reshape(len(vectors), length)


def _scored(batches: Iterator[pa.RecordBatch], block: dict) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(anchors, ids, codes, scores) of bounded pieces: anchors and rows of one length; code -1 is a label of no anchor."""
    ready = {n: (at, residues(m, block["primes"])) for n, (at, m) in block["matrices"].items()}
    labels = pa.array(block["labels"], pa.string())
    for batch in batches:
        for length, own in _by_length(batch):
            if length not in ready:
                continue
            at, x = ready[length]
            for start in range(0, len(own), ROWS):
                part = own.slice(start, ROWS)
                y = residues(_integers(part["embedding"], length, block["scale"]), block["primes"])
                codes = pc.index_in(part["label"], value_set=labels).fill_null(-1).to_numpy(zero_copy_only=False)
                ids = part["vec_id"].to_numpy(zero_copy_only=False)
                if block["same"]:  # only rows whose label an anchor has, label by label
                    for code in np.unique(codes[codes >= 0]):
                        i, j = np.flatnonzero(block["codes"][at] == code), np.flatnonzero(codes == code)
                        if len(i):
                            yield at[i], ids[j], codes[j], scores([m[i] for m in x], [m[j] for m in y], block["primes"])
                else:
                    yield at, ids, codes, scores(x, y, block["primes"])


def _positives(rows: DataFrame, block, wanted: int) -> DataFrame:
    """(no, id, score): of every anchor the best rows of its label in each task."""

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = block.value
        value, name = np.full((len(b["ids"]), wanted), NONE, np.int64), np.zeros((len(b["ids"]), wanted), np.int64)
        for at, ids, _, found in _scored(batches, {**b, "same": True}):
            found = np.where(b["ids"][at][:, None] == ids, NONE, found)
            own, names = value[at], name[at]
            merge_best(own, names, found, ids)
            value[at], name[at] = own, names
        i, j = np.nonzero(value > NONE)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (i, name[i, j], value[i, j])], ["no", "id", "score"])

    return rows.mapInArrow(best, "no bigint, id bigint, score bigint")


def _negatives(rows: DataFrame, block, wanted: int) -> DataFrame:
    """(pair, id, score): of every anchor and positive the best rows of other labels within the bounds, in each task."""

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = block.value
        value, name = np.full((len(b["of"]), wanted), NONE, np.int64), np.zeros((len(b["of"]), wanted), np.int64)
        for at, ids, codes, found in _scored(batches, {**b, "same": False}):
            found = np.where((b["codes"][at][:, None] == codes) | (b["ids"][at][:, None] == ids), NONE, found)
            place = np.full(len(b["ids"]), -1)
            place[at] = np.arange(len(at))
            for turn in range(int(b["turn"].max(initial=-1)) + 1):  # one positive of every anchor
                own = np.flatnonzero((b["turn"] == turn) & (place[b["of"]] >= 0))
                s = found[place[b["of"][own]]]
                s = np.where((s >= b["low"][own][:, None]) & (s <= b["high"][own][:, None]), s, NONE)
                v, names = value[own], name[own]
                merge_best(v, names, s, ids)
                value[own], name[own] = v, names
        i, j = np.nonzero(value > NONE)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (i, name[i, j], value[i, j])], ["pair", "id", "score"])

    return rows.mapInArrow(best, "pair bigint, id bigint, score bigint")


def _first(found: DataFrame, group: str, wanted: int) -> DataFrame:
    order = Window.partitionBy(group).orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= wanted)


def sound_rows(rows: DataFrame, label: str | Column = "label") -> DataFrame:
    """(vec_id, label, embedding) of the rows that take part; the label as text."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != F.lit(float("inf"))))
    named = F.col(label) if isinstance(label, str) else label
    return rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), named.cast("string").alias("label"), "embedding").filter(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite
    )


def mine(
    rows: DataFrame, anchor: Column, label: str | Column = "label", positives: int = 5, negatives: int = 5,
    low: int = 80, high: int = 100, scale: int = 256, anchors_at_once: int = ANCHORS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score), ranks from 1.

    ``rows`` has vec_id and embedding, other columns do not matter; ``anchor``
    is a condition on vec_id.  A component x becomes floor(scale * x).  An
    anchor's positives are the best rows of its label, a positive's negatives
    the best rows of other labels that score ``low`` to ``high`` per cent of it.

    Rows with a null vec_id, label or vector, or any null or non-finite
    component take no part.  Ties go to the smaller vec_id.  Vectors of
    different length have no score.  An empty vector scores 0.  A repeated row
    is a row of its own as positive or negative; repeated equal anchors are one
    anchor, and no anchor meets a row of its own vec_id.  An empty table gives
    no rows.  Scores of 2**56 and more raise an error, as they cannot be held
    as percentages of 64 bits.
    """
    spark = rows.sparkSession
    taking = sound_rows(rows, label)
    top = F.coalesce(F.array_max(F.transform("embedding", lambda x: F.abs(F.floor(x.cast("double") * scale).cast("double")))), F.lit(0.0))
    size = taking.agg(F.count("*").alias("n"), F.max(top).alias("top"), F.max(F.size("embedding")).alias("length")).first()
    empty = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    if not size["n"]:
        return spark.createDataFrame([], empty)
    bound = int(size["top"]) ** 2 * size["length"]
    if bound >= LARGEST:
        raise ValueError(f"a score may reach {bound}; components have to be smaller")
    primes = primes_for(bound)
    at_once = max(1, min(anchors_at_once, COMPONENTS // max(1, size["length"])))
    anchors = saved(ordered_index(taking.filter(anchor).distinct(), ["vec_id"], "no"))
    number = anchors.count()
    taking = taking.coalesce(max(2 * spark.sparkContext.defaultParallelism, size["n"] // TASK_ROWS))
    done = None
    for start in range(0, number, at_once):
        block = _block(anchors.filter((F.col("no") > start) & (F.col("no") <= start + at_once)), primes, scale)
        sent = spark.sparkContext.broadcast(block)
        best = _first(_positives(taking, sent, positives), "no", positives).orderBy("no", "rank").collect()
        of, ids, score, turn = (np.array([r[c] for r in best], np.int64) for c in ("no", "id", "score", "rank"))
        pairs = {"of": of, "turn": turn - 1, "low": -(-low * score // 100), "high": high * score // 100}
        sent = spark.sparkContext.broadcast({**block, **pairs})
        chosen = _first(_negatives(taking, sent, negatives), "pair", negatives)
        named = spark.createDataFrame(
            pa.table({"pair": np.arange(len(of)), "anchor_id": block["ids"][of], "positive_id": ids, "positive_score": score}).to_pandas(),
            "pair bigint, anchor_id bigint, positive_id bigint, positive_score bigint",
        )
        part = saved(
            chosen.join(named, "pair").select(
                "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
            )
        )
        done = part if done is None else done.unionByName(part)
    return spark.createDataFrame([], empty) if done is None else done


def _block(anchors: DataFrame, primes: tuple[int, ...], scale: int) -> dict:
    """A bounded block of anchors as matrices, one for each length."""
    own = anchors.orderBy("no").select("vec_id", "label", "embedding").toArrow().combine_chunks()
    batch = pa.RecordBatch.from_arrays([own[c].combine_chunks() for c in own.column_names], own.column_names)
    lengths = pc.list_value_length(batch["embedding"]).to_numpy(zero_copy_only=False)
    labels = pc.unique(batch["label"])
    return {
        "ids": batch["vec_id"].to_numpy(zero_copy_only=False), "labels": labels.to_pylist(), "primes": primes, "scale": scale,
        "codes": pc.index_in(batch["label"], value_set=labels).to_numpy(zero_copy_only=False),
        "matrices": {n: (np.flatnonzero(lengths == n), _integers(part["embedding"], n, scale)) for n, part in _by_length(batch)},
    }


@query(
    "op13_hard_negatives",
    """WITH t AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS l,
                  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
                  WHERE label IS NOT NULL AND embedding IS NOT NULL
                  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
       s AS (SELECT a.vec_id AS anchor_id, a.l AS own, b.vec_id AS id, b.l, list_dot_product(a.e, b.e)::BIGINT AS score
             FROM t a JOIN t b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
       p AS (SELECT anchor_id, own, id AS positive_id, score AS positive_score FROM s WHERE l = own
             QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
       SELECT anchor_id, positive_id,
              row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.id)::INT AS rank,
              s.id AS negative_id, positive_score, s.score AS negative_score
       FROM p JOIN s USING (anchor_id) WHERE s.l <> p.own AND 80 * positive_score <= 100 * s.score AND 100 * s.score <= 100 * positive_score
       QUALIFY rank <= 5""",
)
def op13_hard_negatives(spark, sf):
    own = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(table(spark, sf, "embeddings"), F.col("vec_id") % 100 == 0, own)
