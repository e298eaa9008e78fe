"""Hard-negative mining with an STR-packed R-tree.

Index: all rows are range-partitioned by label and first coordinate into tiles of
bounded size; within a tile the rows of each label are packed by sort-tile-recursive
(coordinates in order of their variance there) into pages of at most ``PAGE_ROWS``
rows. A page is one row of a Parquet table: its label, minimum bounding box and rows.
Runs of ``FANOUT`` pages, and so on upwards, are the inner boxes of the tile's tree.

Search: the inner product of a query and any row of a box lies between the sums of
the coordinate-wise least and greatest products with the box's sides. A queue takes
boxes by greatest upper end; a box is skipped if its interval misses the score
window, or lies strictly below the k-th score found so far (ties are looked at, as
the smaller id wins). Every (tile, block of anchors) is one group of bounded size;
the best of all tiles are merged per anchor by a ranked window (limited in every
task first). For negatives about the square root of the tiles is searched first: the
k-th score found there is a lower bound for the other tiles, which then return few
rows. Queries meet rows in blocks only, and nothing passes through the driver.

First the positives of each anchor are searched in pages of its label, then, for each
(anchor, positive), negatives in pages of other labels whose score lies between
``low`` and ``high`` percent of the positive's. Scores are exact integers: in doubles
where they fit into 53 bits, else in Python integers (and saturated to long on output).

Defined results: rows with a null label or vector, or a component that is null or not
finite, take no part; components beyond a long are saturated; only vectors of equal
length meet; equal scores go by smaller id, a null id is the largest and no anchor; a
repeated row is listed as often as it occurs, but an equal copy of the anchor is the
anchor itself, and repeated anchors are searched once; other columns are ignored; an
anchor without positives, or a positive without negatives, has no rows; an empty table
gives an empty table. There is no text, and so no long one; a vector may have any length.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstream.llm.common import load, staged

POSITIVES = 5
NEGATIVES = 10
LOW_PERCENT = 30
HIGH_PERCENT = 90
SCALE = 256.0

TILE_ROWS = 65_536
PAGE_ROWS = 128
FANOUT = 16
BLOCK_ANCHORS = 8_192
#: Anchors whose bounds for all boxes of a tile are computed at once.
BOUND_ANCHORS = 128
#: Tasks of a search, at most (several groups may share one).
SEARCH_TASKS = 4_000

LAST_ID = (1 << 63) - 1  # stands for a null id in the order
PAGE_SCHEMA = ("tile bigint, label bigint, dim int, width int, lo binary, hi binary, "
               "ids binary, vectors binary")


def quantized(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
              label: Column | None = None, scale: float = SCALE) -> DataFrame:
    """id, label (bigint), v (array<bigint>: floor(scale * x)) of the rows that take part."""
    own = F.col("label") if label is None else label
    double = F.transform(vector_col, lambda e: e.cast("double"))
    finite = F.forall("x", lambda e: F.coalesce(
        ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))), F.lit(False)))
    return (table.select(F.col(id_col).cast("bigint").alias("id"),
                         own.cast("bigint").alias("label"), double.alias("x"))
            .where(F.col("label").isNotNull() & F.col("x").isNotNull() & finite)
            .select("id", "label", F.transform("x", lambda e: F.floor(F.lit(scale) * e)).alias("v")))


def str_order(vectors: np.ndarray, page: int) -> list[np.ndarray]:
    """Row numbers of the pages of a sort-tile-recursive packing."""
    axes = np.argsort(-vectors.astype(np.float64).var(axis=0), kind="stable") if (
        vectors.shape[1]) else np.empty(0, np.int64)

    def tile(rows: np.ndarray, depth: int, left: int) -> list[np.ndarray]:
        pages = math.ceil(len(rows) / page)
        if pages <= 1 or not left:
            return [rows[i:i + page] for i in range(0, len(rows), page)]
        slabs = math.ceil(pages ** (1 / left))
        rows = rows[np.argsort(vectors[rows, axes[depth]], kind="stable")]
        size = math.ceil(pages / slabs) * page
        return [p for i in range(0, len(rows), size)
                for p in tile(rows[i:i + size], depth + 1, left - 1)]
    n = math.ceil(math.log2(max(2, len(vectors) / page)))
    return tile(np.arange(len(vectors)), 0, min(n, len(axes)))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.int64).reshape(len(column), dim)


def _tile_pages(tile: int, rows: pa.Table):
    """Page rows of one tile, by (label, vector length)."""
    lengths = rows["v"].combine_chunks().value_lengths().to_numpy(zero_copy_only=False)
    labels = rows["label"].to_numpy()
    for label, dim in sorted(set(zip(labels.tolist(), lengths.tolist()))):
        at = np.flatnonzero((labels == label) & (lengths == dim))
        part = rows.take(at)
        ids = part["id"].fill_null(LAST_ID).to_numpy()
        vectors = _matrix(part["v"].combine_chunks(), dim)
        for page in str_order(vectors, PAGE_ROWS):
            v = vectors[page]
            lo, hi = (v.min(axis=0), v.max(axis=0))
            small = dim == 0 or (lo.min() >= -(1 << 15) and hi.max() < 1 << 15)
            kind = np.dtype("<i2" if small else "<i8")
            yield (tile, label, dim, kind.itemsize, *(
                a.astype(kind).tobytes() for a in (lo, hi)), ids[page].tobytes(),
                v.astype(kind).tobytes())


def index(rows: DataFrame) -> DataFrame:
    """The page table of ``quantized`` rows, written to the shared checkpoint folder."""
    spark = rows.sparkSession
    rows = staged(rows, "negatives-rows")
    tiles = max(math.ceil(rows.count() / TILE_ROWS), 2 * spark.sparkContext.defaultParallelism)
    kinds = pa.schema([("tile", pa.int64()), ("label", pa.int64()), ("dim", pa.int32()),
                       ("width", pa.int32()), ("lo", pa.binary()), ("hi", pa.binary()),
                       ("ids", pa.binary()), ("vectors", pa.binary())])

    def build(batches):
        own = [b for b in batches if b.num_rows]
        if own:
            pages = _tile_pages(TaskContext.get().partitionId(), pa.Table.from_batches(own))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*pages), kinds)], schema=kinds)
    first = F.try_element_at("v", F.lit(1))
    return staged(rows.repartitionByRange(tiles, "label", first, "id").mapInArrow(
        build, PAGE_SCHEMA), "negatives-index")


class Tree:
    """The R-tree over a tile's pages of one vector length."""

    def __init__(self, pages: list[dict], dim: int, exact: bool):
        kind = np.float64 if exact else object
        side = {2: "<i2", 8: "<i8"}

        def read(p: dict, name: str) -> np.ndarray:
            return np.frombuffer(p[name], side[p["width"]]).astype(np.int64).astype(kind)
        self.labels = [p["label"] for p in pages]
        self.ids = [np.frombuffer(p["ids"], np.int64) for p in pages]
        self.vectors = [read(p, "vectors").reshape(len(i), dim) for p, i in zip(pages, self.ids)]
        lo = np.array([read(p, "lo") for p in pages], kind).reshape(len(pages), dim)
        hi = np.array([read(p, "hi") for p in pages], kind).reshape(len(pages), dim)
        # boxes of all levels, pages first; children of an inner box are a range of boxes
        self.children: list[range] = [range(0)] * len(pages)
        spans = [(x, x) for x in self.labels]
        los, his, first, count = [lo], [hi], 0, len(pages)
        while count > 1:
            groups = [range(i, min(i + FANOUT, first + count))
                      for i in range(first, first + count, FANOUT)]
            all_lo, all_hi = np.concatenate(los), np.concatenate(his)
            los.append(np.array([all_lo[g.start:g.stop].min(axis=0) for g in groups], kind)
                       .reshape(len(groups), dim))
            his.append(np.array([all_hi[g.start:g.stop].max(axis=0) for g in groups], kind)
                       .reshape(len(groups), dim))
            spans += [(min(spans[k][0] for k in g), max(spans[k][1] for k in g)) for g in groups]
            self.children += groups
            first, count = first + count, len(groups)
        self.lo, self.hi = np.concatenate(los), np.concatenate(his)
        self.least, self.most = (np.array(x) for x in zip(*spans))
        self.root = len(self.children) - 1

    def intervals(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest inner product of each query with each box."""
        plus, minus = np.maximum(queries, 0), np.minimum(queries, 0)
        return (plus @ self.lo.T + minus @ self.hi.T, plus @ self.hi.T + minus @ self.lo.T)

    def search(self, query: np.ndarray, low: np.ndarray, high: np.ndarray,
               windows: list[tuple[int, int]], k: int, same: int | None, other: int | None,
               skip: int | None) -> list[list[tuple[int, int]]]:
        """For each score window the first ``k`` (score, id) by greater score, then smaller
        id, among rows of label ``same`` (or of any label but ``other``), without rows equal
        to the query under id ``skip``. ``low`` and ``high`` are the boxes' intervals."""
        found: list[list[tuple[int, int]]] = [[] for _ in windows]  # heaps of (score, -id)
        floor = [w[0] for w in windows]
        queue = [(-high[self.root], self.root)]
        while queue:
            top, box = heapq.heappop(queue)
            if -top < min(floor):
                break
            wanted = [j for j, w in enumerate(windows) if -top >= floor[j] and low[box] <= w[1]]
            if not wanted:
                continue
            if self.children[box]:
                for c in self.children[box]:
                    if (self.least[c] <= same <= self.most[c] if same is not None
                            else not (self.least[c] == self.most[c] == other)):
                        heapq.heappush(queue, (-high[c], c))
                continue
            if (self.labels[box] != same) if same is not None else self.labels[box] == other:
                continue
            scores, ids = self.vectors[box] @ query, self.ids[box]
            if skip is not None and (at := np.flatnonzero(ids == skip)).size:
                keep = np.ones(len(ids), bool)
                keep[[i for i in at if (self.vectors[box][i] == query).all()]] = False
                scores, ids = scores[keep], ids[keep]
            for j in wanted:
                for i in np.flatnonzero((scores >= floor[j]) & (scores <= windows[j][1])).tolist():
                    entry = (int(scores[i]), -int(ids[i]))
                    if len(found[j]) < k:
                        heapq.heappush(found[j], entry)
                    elif entry > found[j][0]:
                        heapq.heapreplace(found[j], entry)
                if len(found[j]) == k:
                    floor[j] = max(floor[j], found[j][0][0])
        return [[(s, -i) for s, i in sorted(f, reverse=True)] for f in found]


def _long(x: int) -> int:
    return max(-(1 << 63), min((1 << 63) - 1, x))


def _searched(pages: pa.Table, anchors: pa.Table, k: int, low: int, high: int) -> list[tuple]:
    """Rows (a, rank of the window, score, id) of one tile for one block of anchors. Without
    windows, positives are searched."""
    out = []
    page_rows = pages.to_pylist()
    dims = {p["dim"] for p in page_rows}
    queries = [r for r in anchors.to_pylist() if len(r["v"]) in dims]
    most = max([abs(x) for r in queries for x in r["v"]], default=0)
    for dim in sorted({len(r["v"]) for r in queries}):
        own = [p for p in page_rows if p["dim"] == dim]
        side = max([int(np.abs(np.frombuffer(p[s], f"<i{p['width']}").astype(np.float64)).max())
                    for p in own for s in ("lo", "hi")] if dim else [0])
        exact = dim * max(1, most) * max(1, side) < 1 << 52
        tree = Tree(own, dim, exact)
        mine = [r for r in queries if len(r["v"]) == dim]
        for first in range(0, len(mine), BOUND_ANCHORS):
            part = mine[first:first + BOUND_ANCHORS]
            q = np.array([r["v"] for r in part], np.float64 if exact else object).reshape(
                len(part), dim)
            least, greatest = tree.intervals(q)
            for i, r in enumerate(part):
                if "windows" not in r:
                    hits = tree.search(q[i], least[i], greatest[i],
                                       [(-math.inf, math.inf)], k, r["label"], None, r["id"])
                    out += [(r["a"], 0, _long(s), j) for s, j in hits[0]]
                    continue
                bounds = [(-(-low * w["score"] // 100), high * w["score"] // 100)
                          for w in r["windows"]]
                bounds = [(a if w["least"] is None else max(a, w["least"]), b)
                          for (a, b), w in zip(bounds, r["windows"])]
                ask = [(w, b) for w, b in zip(r["windows"], bounds) if b[0] <= b[1]]
                if ask:
                    hits = tree.search(q[i], least[i], greatest[i], [b for _, b in ask], k, None,
                                       r["label"], None)
                    out += [(r["a"], w["rank"], _long(s), j)
                            for (w, _), f in zip(ask, hits) for s, j in f]
    return out


def _hits(pages: DataFrame, anchors: DataFrame, visits: DataFrame, tiles: int, blocks: int,
          k: int, low: int = 0, high: int = 0) -> DataFrame:
    """a, window, score, id: the first ``k`` of each (anchor, window) in each tile.

    ``visits``: the tiles that each anchor has to look at (a, tile).
    """
    n = max(1, min(SEARCH_TASKS, blocks * tiles))
    keys = ["tile", "block"]
    left = pages.select(*[F.col(c).alias(c) for c in pages.columns],
                        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    right = anchors.join(visits, "a")
    kinds = pa.schema([("a", pa.int64()), ("window", pa.int32()), ("score", pa.int64()),
                       ("id", pa.int64())])

    def run(own: pa.Table, queries: pa.Table) -> pa.Table:
        rows = _searched(own, queries, k, low, high) if own.num_rows and queries.num_rows else []
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(
            zip(*rows) if rows else [()] * 4, kinds)], schema=kinds)
    return (left.repartition(n, *keys).groupBy(*keys)
            .cogroup(right.repartition(n, *keys).groupBy(*keys))
            .applyInArrow(run, "a bigint, window int, score bigint, id bigint"))


def _ranked(hits: DataFrame, k: int) -> DataFrame:
    """The first ``k`` of each (anchor, window), with their ``rank``."""
    order = Window.partitionBy("a", "window").orderBy(F.desc("score"), "id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(rows: DataFrame, anchors: DataFrame, positives: int = POSITIVES,
                   negatives: int = NEGATIVES, low: int = LOW_PERCENT,
                   high: int = HIGH_PERCENT) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows`` and ``anchors`` are as ``quantized`` gives them; anchors are some of the rows.
    """
    pages = index(rows)
    queries = staged(anchors.where(F.col("id").isNotNull()).dropDuplicates()
                     .withColumn("a", F.monotonically_increasing_id()), "negatives-anchors")
    blocks = max(1, math.ceil(queries.count() / BLOCK_ANCHORS))
    tiles = int(pages.agg(F.coalesce(F.max("tile") + 1, F.lit(0))).first()[0])
    queries = queries.withColumn("block", F.pmod(F.xxhash64("a"), F.lit(blocks)).cast("int"))
    # positives: the tiles that hold the anchor's label
    held = pages.select("label", "dim", "tile").distinct()
    own = queries.withColumn("dim", F.size("v")).join(held, ["label", "dim"]).select("a", "tile")
    best = staged(_ranked(_hits(pages, queries, own, tiles, blocks, positives), positives),
                  "negatives-positives")
    # negatives: every tile, the first ones without a bound
    numbers = F.sequence(F.lit(0), F.lit(max(tiles, 1) - 1)).cast("array<bigint>")
    visits = best.select("a").distinct().select("a", F.explode(numbers).alias("tile"))
    early = F.col("tile") % (math.isqrt(max(tiles, 1) - 1) + 1) == 0

    def found(bounds: DataFrame, which: Column) -> DataFrame:
        windows = bounds.groupBy("a").agg(F.sort_array(F.collect_list(
            F.struct("rank", "score", "least"))).alias("windows"))
        return _hits(pages.where(which), queries.join(windows, "a"), visits.where(which), tiles,
                     blocks, negatives, low, high)
    first = staged(found(best.withColumn("least", F.lit(None).cast("bigint")), early),
                   "negatives-first")
    least = _ranked(first, negatives).where(F.col("rank") == negatives).select(
        "a", F.col("window").alias("rank"), F.col("score").alias("least"))
    hits = _ranked(first.unionByName(found(best.join(least, ["a", "rank"], "left"), ~early)),
                   negatives)

    def given(c: str) -> Column:
        return F.when(F.col(c) != LAST_ID, F.col(c))
    return hits.withColumnRenamed("id", "negative").join(
        best.select("a", F.col("rank").alias("window"), F.col("id").alias("positive"),
                    F.col("score").alias("positive_score")), ["a", "window"]).join(
        queries.select("a", F.col("id").alias("anchor_id")), "a").select(
        "anchor_id", given("positive").alias("positive_id"), "rank",
        given("negative").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))


def op13_hard_negatives(spark, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = quantized(load(spark, sf_dir, "embeddings"), label=label)
    return hard_negatives(rows, rows.where(F.col("id") % 100 == 0))


OP13_SQL = """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
         CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM r a JOIN r b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5),
n AS (
  SELECT p.anchor_id, positive_id, other AS negative_id, positive_score, score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other) AS rank
  FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT same
       AND 100 * score >= 30 * positive_score AND 100 * score <= 90 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM n WHERE rank <= 10"""
