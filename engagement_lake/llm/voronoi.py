"""Exact top-k search by inner product, as a Voronoi join.

Inner products become distances: with one more coordinate that brings every candidate to the same
norm, and 0 there for queries, the highest inner product is the least distance. Pivots, a bounded
sample of ``PIVOTS`` candidates, divide both sides into cells. A cell's candidates are divided by
their distance from the pivot into rings. From the summaries (how many candidates a ring has, its
least and greatest distance, how far a cell's queries lie from the pivot) follows a distance within
which each query cell has enough candidates; a ring that lies farther is not sent there. Cells
with few queries travel together. Rings and query groups of many rows are split into blocks, each
pair of blocks is searched by itself, and the best of each pair are merged.

Cases: vectors that are null or hold null or non-finite components take no part, nor do null ids; a
shorter vector counts as if zeros followed; a query's own id is never found, all other rows are,
repeated ones each; equal queries are asked once; fewer candidates than k give fewer rows; scores
beyond 64 bits are cut to the nearest. Empty tables give no rows. Other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from engagement_lake.llm.store import read, written

PIVOTS = 32
# Rings of a cell as wide as this part of the greatest norm; a distance is at most twice the norm.
RING = 1 / 8
BLOCK_ROWS = 1024
SCALE = 256
_SLACK = 1e-6


def _matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """Quantised vectors as rows, zeros following where they are shorter."""
    offsets = vectors.offsets.to_numpy()
    flat = np.floor(SCALE * vectors.values.to_numpy(zero_copy_only=False).astype(np.float64))
    lengths = np.diff(offsets)
    out = np.zeros((len(lengths), width))
    row = np.repeat(np.arange(len(lengths)), lengths)
    column = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[row, column] = flat[offsets[0] : offsets[-1]]
    return out


def _distances(points: np.ndarray, extra: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distance of each (point, extra coordinate) from each pivot row, whose last column is extra."""
    square = (points**2).sum(axis=1) + extra**2
    cross = points @ pivots[:, :-1].T + np.outer(extra, pivots[:, -1])
    return np.sqrt(np.maximum(0.0, square[:, None] - 2 * cross + (pivots**2).sum(axis=1)))


def query_groups(pivots: np.ndarray, counts: dict[int, int]) -> dict[int, int]:
    """Query cells to groups: along a chain of nearest pivots, until a group has a block of queries."""
    group, held, groups = 0, 0, {}
    cells = sorted(counts)
    at = cells[0] if cells else None
    while at is not None:
        groups[at] = group
        held += counts[at]
        if held >= BLOCK_ROWS:
            group, held = group + 1, 0
        cells.remove(at)
        apart = [np.linalg.norm(pivots[at] - pivots[c]) for c in cells]
        at = cells[int(np.argmin(apart))] if cells else None
    return groups


def needed_rings(pivots, rings: list, cells: list, k: int, own: list) -> list[tuple[int, int]]:
    """(query cell, ring index) of every ring that may hold one of the k nearest of one of its queries.

    ``rings`` are (cell, ring, n, least, most), ``cells`` (query cell, n, radius, barred): the most
    rows that share the id of one of the cell's queries. ``own`` are (query cell, cell, ring, barred),
    the same within one ring.
    """
    at_ring = {(r[0], r[1]): i for i, r in enumerate(rings)}
    barred_at = {c[0]: np.zeros(len(rings)) for c in cells}
    for cell, *place, barred in own:
        barred_at[cell][at_ring[tuple(place)]] = barred
    ring_cell = np.array([r[0] for r in rings], int)
    n, least, most = (np.array([r[i] for r in rings], float) for i in (2, 3, 4))
    needed = []
    for cell, _, radius, barred in cells:
        apart = np.linalg.norm(pivots[ring_cell] - pivots[cell], axis=1)
        farthest = radius + apart + most
        order = np.argsort(farthest)
        # Rows of a query's own id are never found: in all not more than barred, nor in any ring than there.
        free = np.maximum(np.cumsum(n[order]) - barred, np.cumsum((n - barred_at[cell])[order]))
        enough = np.searchsorted(free, k)
        within = farthest[order][enough] if enough < len(order) else np.inf
        nearest = np.maximum(apart - radius - most, least - apart - radius)
        slack = _SLACK * (1 + radius + apart + most)
        needed += [(cell, int(i)) for i in np.flatnonzero(nearest <= within + slack)]
    return needed


def _best(query_ids, queries, ids, points, k) -> tuple[np.ndarray, ...]:
    """The k best candidates of each query: its index, their ids and scores."""
    largest = max(np.abs(queries).max(initial=0.0), np.abs(points).max(initial=0.0))
    if largest**2 * max(1, points.shape[1]) < 2**53:
        scores = (queries @ points.T).astype(np.int64)
    else:  # beyond what doubles hold exactly
        whole = [[[int(x) for x in row] for row in side] for side in (queries, points)]
        top = 2**63 - 1
        dots = [[min(top, max(-top - 1, sum(map(int.__mul__, q, p)))) for p in whole[1]] for q in whole[0]]
        scores = np.array(dots, np.int64).reshape(len(queries), len(points))
    who, found, value = [], [], []
    for i, row in enumerate(scores):
        others = np.flatnonzero(ids != query_ids[i])
        row = row[others]
        if len(row) > k:
            others = others[(at := row >= np.partition(row, -k)[-k])]
            row = row[at]
        order = np.lexsort((ids[others], -row.astype(object) if row.min(initial=0) == -(2**63) else -row))[:k]
        who.append(np.full(len(order), i))
        found.append(ids[others[order]])
        value.append(row[order])
    return tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in (who, found, value))


def top_k(rows: DataFrame, is_query: Column, k: int, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k highest inner products, ties to smaller ids."""
    spark = rows.sparkSession
    usable = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col(key).isNotNull() & usable).select(
        F.col(key).alias("id"), F.coalesce(is_query, F.lit(False)).alias("asks"), F.col(vector).alias("vector")
    )
    square = F.aggregate("vector", F.lit(0.0), lambda s, x: s + F.pow(F.floor(x.cast("double") * SCALE), F.lit(2.0)))
    whole = rows.agg(F.max(F.size("vector")).alias("width"), F.max(square).alias("square")).head()
    if whole["width"] is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    width, norm = whole["width"], float(np.sqrt(whole["square"])) or 1.0
    sample = rows.orderBy(F.xxhash64("id", "vector"), "id").limit(PIVOTS).select("vector").toArrow()
    points = _matrix(sample.column("vector").combine_chunks(), width)
    extra = np.sqrt(np.maximum(0.0, norm**2 - (points**2).sum(axis=1)))
    pivots = np.unique(np.column_stack([points, extra]), axis=0)
    held = spark.sparkContext.broadcast(pivots)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centers = held.value
        for batch in batches:
            x = _matrix(batch.column("vector"), width)
            lift = np.sqrt(np.maximum(0.0, norm**2 - (x**2).sum(axis=1)))
            near, ask = _distances(x, lift, centers), _distances(x, np.zeros(len(x)), centers)
            cell, ask_cell = near.argmin(axis=1), ask.argmin(axis=1)
            every = np.arange(len(x))
            apart = near[every, cell]
            columns = [
                batch.column("id"), batch.column("asks"), batch.column("vector"),
                pa.array(cell, pa.int32()), pa.array(apart / (norm * RING), pa.int32(), safe=False), pa.array(apart),
                pa.array(ask_cell, pa.int32()), pa.array(ask[every, ask_cell]),
            ]
            names = ["id", "asks", "vector", "cell", "ring", "apart", "ask_cell", "ask_apart"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = (
        f"id {kinds['id']}, asks boolean, vector {kinds['vector']}, cell int, ring int, apart double,"
        " ask_cell int, ask_apart double"
    )
    assigned = written(rows.mapInArrow(assign, schema), "voronoi")

    # Summaries: at most PIVOTS * (2 / RING + 1) rings, PIVOTS query cells, and pairs of both.
    rings = assigned.groupBy("cell", "ring").agg(F.count(F.lit(1)), F.min("apart"), F.max("apart")).collect()
    asking = assigned.where("asks")
    # How many rows a query bars as of its own id: in each ring, and in all.
    of_id = assigned.groupBy("id", "cell", "ring").agg(F.count(F.lit(1)).alias("barred"))
    asked = asking.select("id", "ask_cell").distinct()
    own = of_id.join(asked, "id").groupBy("ask_cell", "cell", "ring").agg(F.max("barred")).collect()
    most = assigned.groupBy("id").agg(F.count(F.lit(1)).alias("barred")).join(asked, "id")
    most = dict(most.groupBy("ask_cell").agg(F.max("barred")).collect())
    cells = asking.groupBy("ask_cell").agg(F.count(F.lit(1)), F.max("ask_apart")).collect()
    cells = [(*c, most[c[0]]) for c in cells]
    groups = query_groups(pivots, {c[0]: c[1] for c in cells})
    sizes: dict[int, int] = {}
    for cell, n, *_ in cells:
        sizes[groups[cell]] = sizes.get(groups[cell], 0) + n
    routes = sorted({(groups[cell], ring) for cell, ring in needed_rings(pivots, rings, cells, k, own)})
    table = [
        (g, rings[r][0], rings[r][1], -(-sizes[g] // BLOCK_ROWS), -(-rings[r][2] // BLOCK_ROWS)) for g, r in routes
    ]
    route = spark.createDataFrame(table, "group int, cell int, ring int, ask_blocks int, blocks int")
    of_cell = spark.createDataFrame(list(groups.items()), "ask_cell int, group int")

    def block(n: str) -> Column:
        return F.pmod(F.xxhash64("id", "vector"), F.col(n)).cast("int")

    def every(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    place = ["group", "cell", "ring"]
    candidates = assigned.join(route, ["cell", "ring"]).withColumn("block", block("blocks"))
    candidates = candidates.select(*place, "block", every("ask_blocks").alias("ask_block"), "id", "vector")
    asking = asking.select("id", "vector", "ask_cell").distinct().join(of_cell, "ask_cell")
    asking = asking.join(route, "group").withColumn("ask_block", block("ask_blocks"))
    asking = asking.select(*place, every("blocks").alias("block"), "ask_block", "id", "vector")
    sides = candidates.withColumn("asks", F.lit(False)).unionByName(asking.withColumn("asks", F.lit(True)))

    def solve(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        asks = table.column("asks").to_numpy()
        ids = table.column("id").to_numpy()
        vectors = table.column("vector").combine_chunks()
        x = _matrix(vectors, width)
        who, found, value = _best(ids[asks], x[asks], ids[~asks], x[~asks], k)
        which = pa.array(np.flatnonzero(asks)[who])
        columns = [table.column("id").take(which), table.column("vector").take(which), pa.array(found), pa.array(value)]
        return pa.table(columns, names=["query_id", "query", "vec_id", "score"])

    pair = [*place, "block", "ask_block"]
    schema = f"query_id {kinds['id']}, query {kinds['vector']}, vec_id {kinds['id']}, score bigint"
    best = sides.groupBy(*pair).applyInArrow(solve, schema)
    best = best.withColumn("query", F.xxhash64("query"))
    order = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op1_voronoi_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS query_id, b.vec_id,
    CAST(list_inner_product(CAST(a.q AS DOUBLE[]), CAST(b.q AS DOUBLE[])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""
