"""Cosine near-copies of vectors by an epsilon grid order join.

Unit vectors are projected on their leading principal directions and sorted by
grid cells of side epsilon, the distance that belongs to the cosine.  The
sequence is cut into blocks with bounding boxes.  Intervals of the sequence are
joined recursively: a pair of intervals whose boxes are further apart than
epsilon is skipped with all that is below it.  The block pairs that remain are
gathered in tiles, two intervals of bounded size, so that a block travels once
per tile and not once per partner.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from cohortloom.llm.components import components
from cohortloom.llm.registry import query, table
from cohortloom.session import freeze, saved

SAMPLE = 20_000  # vectors the directions are computed from; they only steer the order, not the result
DIRECTIONS = 16  # of the bounding boxes, at most
GRID = 6  # leading directions that make the cells, at most
BLOCK = 256  # vectors of a block
FANOUT = 8  # intervals that make the next larger interval
TILE_BYTES = 4 << 20  # of vectors on each side of a tile, about; a task holds two sides
TILE_TASKS = 4096  # that the tiles are spread over, at most
SLACK = 1e-5  # rounding of projections and boxes


def principal_directions(vectors: np.ndarray, most: int = DIRECTIONS) -> np.ndarray:
    """Orthonormal columns, the direction of largest variance first."""
    centred = vectors - vectors.mean(axis=0)
    _, directions = np.linalg.eigh(centred.T @ centred)
    return directions[:, ::-1][:, :most]


def _unit(rows: np.ndarray) -> np.ndarray:
    scaled = rows / np.abs(rows).max(axis=1, keepdims=True)  # against overflow
    return scaled / np.sqrt((scaled**2).sum(axis=1, keepdims=True))


def _projected(classes: DataFrame, basis: np.ndarray, epsilon: float) -> DataFrame:
    """Add the projections and the grid cell of every vector."""
    grid = min(GRID, basis.shape[1])

    @F.pandas_udf("struct<cell:array<int>,at:array<double>>")
    def place(vectors: pd.Series) -> pd.DataFrame:
        at = _unit(np.stack(vectors.to_numpy()).astype(np.float64)) @ basis
        return pd.DataFrame({"cell": list(np.floor(at[:, :grid] / epsilon).astype(np.int32)), "at": list(at)})

    return classes.withColumn("place", place("vector")).select("rep", "copies", "vector", "place.*")


def _blocks(placed: DataFrame, size: int, stored: str) -> DataFrame:
    """Consecutive vectors of the epsilon grid order as one row with their box; seq numbers the blocks in order."""
    ordered = placed.repartitionByRange("cell", "at", "rep").sortWithinPartitions("cell", "at", "rep")

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part, rest, number = TaskContext.get().partitionId(), None, 0

        def block(rows: pd.DataFrame) -> dict:
            at = np.stack(rows["at"].to_numpy())
            return {
                "part": part, "number": number, "reps": rows["rep"].to_numpy(), "copies": rows["copies"].to_numpy(),
                "vectors": np.stack(rows["vector"].to_numpy()).astype(stored).tobytes(), "lo": at.min(axis=0), "hi": at.max(axis=0),
            }

        for batch in batches:
            rest = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            out = []
            while len(rest) >= size:
                out.append(block(rest.iloc[:size]))
                rest, number = rest.iloc[size:], number + 1
            if out:
                yield pd.DataFrame(out)
        if rest is not None and len(rest):
            yield pd.DataFrame([block(rest)])

    shape = "part int, number int, reps array<bigint>, copies array<bigint>, vectors binary, lo array<double>, hi array<double>"
    built = saved(ordered.mapInPandas(build, shape))
    order = built.groupBy("part").agg(F.count("*").alias("n"))  # one row per partition
    before = freeze(order.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("_before")))
    return built.join(F.broadcast(before), "part").withColumn("seq", F.col("_before") + F.col("number")).drop("part", "number", "_before")


def _box_distance(a: str, b: str, dims: int):
    total = F.lit(0.0)
    for k in range(dims):
        gap = F.greatest(F.col(f"lo_{a}")[k] - F.col(f"hi_{b}")[k], F.col(f"lo_{b}")[k] - F.col(f"hi_{a}")[k], F.lit(0.0))
        total = total + gap * gap
    return total


def _block_pairs(blocks: DataFrame, dims: int, epsilon: float, fanout: int) -> DataFrame:
    """(a, b) with a <= b of the blocks whose boxes are within epsilon, by descent from the whole sequence."""
    boxes = freeze(blocks.select("seq", "lo", "hi"))
    count = boxes.count()
    height = 0
    while fanout**height < count:
        height += 1
    levels = [boxes]
    for _ in range(height):
        lo = F.array(*[F.min(F.col("lo")[k]) for k in range(dims)])
        hi = F.array(*[F.max(F.col("hi")[k]) for k in range(dims)])
        up = levels[-1].withColumn("seq", F.floor(F.col("seq") / fanout)).groupBy("seq").agg(lo.alias("lo"), hi.alias("hi"))
        levels.append(freeze(up))
    pairs = blocks.sparkSession.range(1).select(F.col("id").alias("a"), F.col("id").alias("b"))
    for level in reversed(levels[:-1]):
        steps = F.sequence(F.lit(0), F.lit(fanout - 1))
        children = pairs.select(F.explode(F.transform(steps, lambda i: F.col("a") * fanout + i)).alias("a"), "b").select(
            "a", F.explode(F.transform(steps, lambda j: F.col("b") * fanout + j)).alias("b")
        ).filter("a <= b")
        left, right = level.toDF("a", "lo_a", "hi_a"), level.toDF("b", "lo_b", "hi_b")
        near = children.join(left, "a").join(right, "b").filter(_box_distance("a", "b", dims) <= (epsilon + SLACK) ** 2)
        pairs = freeze(near.select("a", "b"))
    return pairs


def _near_box(at: np.ndarray, lo: np.ndarray, hi: np.ndarray, epsilon: float) -> np.ndarray:
    gap = np.maximum(np.maximum(lo - at, at - hi), 0.0)
    return np.flatnonzero((gap**2).sum(axis=1) <= (epsilon + SLACK) ** 2)


def link_matrix(x: np.ndarray, y: np.ndarray, cosine: float) -> np.ndarray:
    """Which rows of x and y have at least that cosine, in double precision."""
    x, y = (np.ldexp(v, -np.frexp(np.abs(v).max(axis=1, keepdims=True))[1]) for v in (x, y))  # by powers of two, against overflow
    nx, ny = np.sqrt((x * x).sum(axis=1)), np.sqrt((y * y).sum(axis=1))
    return (x @ y.T) / np.outer(nx, ny) >= cosine


def _smallest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest of 0..n-1 that each reaches by the links (a, b)."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _tiles(pairs: DataFrame, blocks: DataFrame, side: int) -> DataFrame:
    """The blocks every tile needs, each once: tile (ta, tb), seq and the block; side blocks in an interval."""
    tile = [F.floor(F.col("a") / side).alias("ta"), F.floor(F.col("b") / side).alias("tb")]
    need = pairs.select(*tile, F.explode(F.array("a", "b")).alias("seq")).distinct()
    tasks = pairs.select(*tile).distinct().count()
    return need.join(blocks, "seq").repartition(max(1, min(2 * tasks, TILE_TASKS)), "ta", "tb")


def _linked(tiles: DataFrame, side: int, basis: np.ndarray, stored: str, cosine: float, epsilon: float) -> DataFrame:
    """(rep, links, root): the links a vector has in a tile, and the smallest vector it reaches there."""

    def join(tile: pd.DataFrame) -> pd.DataFrame:
        tile = tile.sort_values("seq", ignore_index=True)
        ids = np.concatenate(tile["reps"].to_numpy())
        copies = np.concatenate(tile["copies"].to_numpy())
        sizes = tile["reps"].map(len).to_numpy()
        start = np.cumsum(sizes) - sizes
        interval = tile["seq"].to_numpy() // side
        lo, hi = np.stack(tile["lo"].to_numpy()), np.stack(tile["hi"].to_numpy())
        vectors = [np.frombuffer(v, dtype=stored).reshape(n, -1).astype(np.float64) for v, n in zip(tile["vectors"], sizes)]
        at = [_unit(v) @ basis for v in vectors]
        first, last = int(tile["ta"].iloc[0]), int(tile["tb"].iloc[0])
        links, ends = np.zeros(len(ids), dtype=np.int64), []
        for p in np.flatnonzero(interval == first):
            gap = np.maximum(np.maximum(lo[p] - hi, lo - hi[p]), 0.0)
            close = (interval == last) & ((gap**2).sum(axis=1) <= (epsilon + SLACK) ** 2)
            for q in np.flatnonzero(close):
                if q < p:  # of an interval with itself, each two blocks once
                    continue
                i, j = _near_box(at[p], lo[q], hi[q], epsilon), _near_box(at[q], lo[p], hi[p], epsilon)
                if not len(i) or not len(j):
                    continue
                m = link_matrix(vectors[p][i], vectors[q][j], cosine)
                i, j = i + start[p], j + start[q]
                if p == q:
                    np.fill_diagonal(m, False)  # the same rows on both sides
                if not m.any():
                    continue
                links[i] += m @ copies[j]
                if p != q:
                    links[j] += copies[i] @ m
                x, y = np.nonzero(m)
                inner = _smallest(len(i) + len(j), x, y + len(i))  # a forest, so that a tile keeps few links
                both = np.concatenate([i, j])
                moved = inner != np.arange(len(both))
                ends.append(np.stack([both[moved], both[inner[moved]]]))
        if not ends:
            return pd.DataFrame({"rep": ids[:0], "links": links[:0], "root": ids[:0]})
        order = np.argsort(ids, kind="stable")
        rank = np.empty(len(ids), dtype=np.int64)
        rank[order] = np.arange(len(ids))
        a, b = rank[np.concatenate(ends, axis=1)]
        root = ids[order][_smallest(len(ids), a, b)[rank]]
        has = links > 0
        return pd.DataFrame({"rep": ids[has], "links": links[has], "root": root[has]})

    return tiles.groupBy("ta", "tb").applyInPandas(join, "rep bigint, links bigint, root bigint")


def near_vectors(vectors: DataFrame, cosine: float = 0.9, block: int = BLOCK) -> DataFrame:
    """One row per row of (vec_id, embedding): vec_id, n_links, component_id, kept.

    Vectors that are null, empty, zero or hold a null or non-finite component,
    and rows without vec_id, link with nothing; so do vectors of different
    length.  Equal vectors are one class and compared once; a vec_id with
    repeated equal rows counts once as a partner; a vec_id with several
    vectors is one node with the links of all of them.
    """
    if not 0 < cosine <= 1:
        raise ValueError("cosine must be above 0 and at most 1")
    epsilon = math.sqrt(2 - 2 * cosine)
    kind = vectors.schema["embedding"].dataType
    single = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType)
    stored = "<f4" if single else "<f8"  # as given; cosines are in double precision either way
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<float>" if single else "array<double>").alias("vector"))
    top = F.array_max(F.transform("vector", F.abs))
    sound = (
        F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & (F.size("vector") > 0)
        & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))) & (top > 0)
    )
    rows = rows.withColumn("sound", F.coalesce(sound, F.lit(False)))
    classes = saved(
        rows.filter("sound").distinct().groupBy("vector").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    )
    links = None
    lengths = [r["d"] for r in classes.select(F.size("vector").alias("d")).distinct().orderBy("d").collect()]
    for length in lengths:  # nearly always one
        own = classes.filter(F.size("vector") == length)
        chosen = F.pmod(F.xxhash64("rep"), F.lit(1_000_000)) < int(1_000_000 * SAMPLE / max(1, own.count())) + 1
        sample = own.filter(chosen).select("vector").toPandas()["vector"]
        basis = principal_directions(_unit(np.stack(sample.to_numpy()))) if len(sample) else np.eye(length)[:, :DIRECTIONS]
        blocks = _blocks(_projected(own, basis, epsilon), block, stored)
        pairs = _block_pairs(blocks, basis.shape[1], epsilon, FANOUT)
        side = max(1, TILE_BYTES // (block * length * np.dtype(stored).itemsize))
        found = saved(_linked(_tiles(pairs, blocks, side), side, basis, stored, cosine, epsilon))
        links = found if links is None else links.unionByName(found)

    alone = rows.filter("NOT sound").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    if links is None:
        done = alone
    else:
        sums = links.groupBy("rep").agg(F.sum("links").alias("links"))
        label = components(links.select(F.col("rep").alias("a"), F.col("root").alias("b")))
        named = classes.join(sums, "rep", "left").join(label, F.col("rep") == F.col("node"), "left")
        done = rows.filter("sound").join(named, "vector").select(
            "vec_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id")
        ).unionByName(alone)
    return done.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


@query(
    "op5_embedding_near_dedup",
    """WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
           AND list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]) > 0),
       n AS (SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS s FROM v),
       l AS (SELECT a.vec_id AS x, b.vec_id AS y FROM n a JOIN n b ON a.vec_id <> b.vec_id
             WHERE list_dot_product(a.e, b.e) / (a.s * b.s) >= 0.9),
       r AS (SELECT vec_id AS x, vec_id AS y FROM embeddings UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x),
       c AS (SELECT x AS vec_id, min(y) AS component_id FROM r GROUP BY x),
       k AS (SELECT x AS vec_id, count(*) AS n_links FROM l GROUP BY x)
       SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept FROM c LEFT JOIN k USING (vec_id)""",
)
def op5_embedding_near_dedup(spark, sf):
    return near_vectors(table(spark, sf, "embeddings").select("vec_id", "embedding"))
