"""Nearest neighbours by an inverted multi-index.

The two halves of every vector are quantised separately; a pair of centroids
is a cell.  A query visits cells in the order of summed distance, the negative
inner products of its halves with the centroids, from a heap over the two
sorted centroid lists, until the cells hold a share ``visit`` of all entries
(and ``LEAST_ENTRIES`` at least).  Entries of visited cells are reranked by
the exact inner product.

Codebooks are fitted on a bounded sample; every vector is indexed.  Equal
vectors form one entry with the smallest ids that a result can hold, and
equal queries are searched once, so a hot vector costs no more than another.
Entries are dealt into blocks of bounded size along the cells; a query goes
only to blocks it visits, and large sets of queries are dealt into groups.

Defined results: vectors that are null, zero, of another length than most, or
hold a null or non-finite component take no part, nor do rows without vec_id;
a repeated row counts once; ties go to the smaller vec_id; scores are the
correctly rounded sums of the components' products.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyspark.llm.shared import stored

#: Bound of the sample the codebooks are fitted on, and rounds of fitting.
SAMPLE, ROUNDS = 8192, 12
LEAST_ENTRIES = 2000
BLOCK_ENTRIES, GROUP_QUERIES = 8192, 4096
#: Queries scored at once.
STRIPE = 256


# ------------------------------------------------------------------ codebooks
def centroids(points: np.ndarray, k: int, seed: int = 11) -> np.ndarray:
    """k-means in numpy; fewer centroids if there are fewer points."""
    rng = np.random.default_rng(seed)
    centers = points[rng.permutation(len(points))[:k]].copy()
    for _ in range(ROUNDS):
        own = nearest(points, centers)
        sums = np.zeros_like(centers)
        np.add.at(sums, own, points)
        n = np.bincount(own, minlength=len(centers))
        centers[n > 0] = sums[n > 0] / n[n > 0, None]
    return centers


def nearest(points: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return ((centers * centers).sum(axis=1) - 2 * points @ centers.T).argmin(axis=1)


def visited_cells(d1: np.ndarray, d2: np.ndarray, counts: np.ndarray, wanted: int) -> list[int]:
    """Cells in the order of d1[i] + d2[j], until they hold ``wanted`` entries."""
    o1, o2 = np.argsort(d1, kind="stable").tolist(), np.argsort(d2, kind="stable").tolist()
    a, b, width = d1[o1].tolist(), d2[o2].tolist(), len(d2)
    heap, cells, held, reach = [(a[0] + b[0], 0, 0)], [], 0, [0] * len(a)
    while heap and held < wanted:
        _, i, j = heapq.heappop(heap)
        cell = o1[i] * width + o2[j]
        if counts[cell]:
            cells.append(cell)
            held += counts[cell]
        # (i, j + 1) and (i + 1, j) enter once the cells before them are out
        reach[i] = j + 1
        if j + 1 < width and (i == 0 or reach[i - 1] > j + 1):
            heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))
        if i + 1 < len(a) and reach[i + 1] == j:
            heapq.heappush(heap, (a[i + 1] + b[j], i + 1, j))
    return cells


# ------------------------------------------------------------------ index
def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, vec, h1, h2): the vectors that take part, h1 and h2 naming
    equal ones."""
    vec = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), vec.alias("vec")).where(
        F.col("vec_id").isNotNull() & F.col("vec").isNotNull()
        & F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("vec", lambda x: x != 0))
    sizes = rows.groupBy(F.size("vec").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").first()
    # adding 0.0 makes -0.0 equal to 0.0
    plain = F.transform("vec", lambda x: x + F.lit(0.0))
    return rows.where(F.size("vec") == (sizes.d if sizes else 0)).select(
        "vec_id", plain.alias("vec")).select("vec_id", "vec", F.xxhash64(F.lit(1), "vec").alias("h1"),
                                             F.xxhash64(F.lit(2), "vec").alias("h2"))


def _matrix(column: pa.Array, n: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(n, -1)


class Index:
    """Codebooks, entries by cell, and the blocks the cells are dealt into."""

    def __init__(self, spark: SparkSession, rows: DataFrame, keep: int, visit: float):
        first = Window.partitionBy("h1", "h2").orderBy("vec_id")
        distinct = rows.dropDuplicates(["vec_id", "h1", "h2"])
        ranked = distinct.withColumn("r", F.row_number().over(first)).where(F.col("r") <= keep)
        groups = ranked.groupBy("h1", "h2").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"),
                                                F.any_value("vec").alias("vec"))
        entries = stored(spark, groups, "entries")
        n = entries.count()
        self.k = int(np.clip(round(2 * n**0.25), 8, 256))
        rate = min(1.0, SAMPLE / max(n, 1))
        picked = entries.where(F.pmod("h1", F.lit(1 << 20)) < int(rate * (1 << 20)) + 1).select("h1", "h2", "vec").collect()
        points = np.array([r.vec for r in sorted(picked)][:2 * SAMPLE], np.float64)
        self.empty = not len(points)
        if self.empty:
            return
        self.half = points.shape[1] // 2
        self.books = [centroids(points[:, :self.half], self.k), centroids(points[:, self.half:], self.k)]
        self.entries = stored(spark, self._with_cells(entries), "cells")
        counted = self.entries.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()
        self.counts = np.zeros(len(self.books[0]) * len(self.books[1]), np.int64)
        for r in counted:
            self.counts[r.cell] = r.n
        self.wanted = max(LEAST_ENTRIES, math.ceil(visit * n))
        # cells side by side; a cell spans the blocks its rows reach into
        start = np.cumsum(self.counts) - self.counts
        self.first_block = start // BLOCK_ENTRIES
        self.blocks = np.maximum((start + self.counts - 1) // BLOCK_ENTRIES, self.first_block) - self.first_block + 1

    def _with_cells(self, entries: DataFrame) -> DataFrame:
        books, half = self.books, self.half

        def assign(batches):
            for batch in batches:
                x = _matrix(batch.column("vec"), batch.num_rows)
                cell = nearest(x[:, :half], books[0]) * len(books[1]) + nearest(x[:, half:], books[1])
                yield pa.record_batch([pa.array(cell.astype(np.int32)), *batch.columns], names=["cell", *batch.schema.names])

        return entries.mapInArrow(assign, "cell int, h1 long, h2 long, ids array<long>, vec array<double>")


def _dealt_entries(index: Index, groups: int) -> DataFrame:
    """Entries with their block, once for every group of queries."""
    first, blocks = index.first_block, index.blocks

    def place(batches):
        for batch in batches:
            cell = batch.column("cell").to_numpy()
            spread = batch.column("h2").to_numpy() % blocks[cell]
            yield pa.record_batch([pa.array(first[cell] + spread), *batch.columns], names=["block", *batch.schema.names])

    placed = index.entries.select("cell", "h2", "ids", "vec").mapInArrow(
        place, "block long, cell int, h2 long, ids array<long>, vec array<double>")
    return placed.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))


def _dealt_queries(index: Index, queries: DataFrame, groups: int) -> DataFrame:
    """A row per query and block it visits, with its visited cells there."""
    def visit(batches):
        for batch in batches:
            x = _matrix(batch.column("vec"), batch.num_rows)
            d1, d2 = -x[:, :half] @ books[0].T, -x[:, half:] @ books[1].T
            row, block, cells = [], [], []
            for i in range(len(x)):
                by: dict[int, list[int]] = {}
                for cell in visited_cells(d1[i], d2[i], counts, wanted):
                    for b in range(first[cell], first[cell] + blocks[cell]):
                        by.setdefault(b, []).append(cell)
                row += [i] * len(by)
                block += by
                cells += by.values()
            taken = batch.take(pa.array(row, pa.int64()))
            yield pa.record_batch([pa.array(block, pa.int64()), pa.array(cells, pa.list_(pa.int32())), *taken.columns],
                                  names=["block", "cells", *batch.schema.names])

    counts, first, blocks = index.counts.tolist(), index.first_block.tolist(), index.blocks.tolist()
    wanted, half, books = index.wanted, index.half, index.books
    part = F.pmod("h1", F.lit(groups)).cast("int").alias("part")
    return queries.select("h1", "h2", part, "vec").mapInArrow(
        visit, "block long, cells array<int>, h1 long, h2 long, part int, vec array<double>")


def _rerank(keep: int):
    def score(entries: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(entries) and len(queries):
            x, cells = np.stack(entries["vec"].to_numpy()), np.unique(entries["cell"].to_numpy())
            at = np.searchsorted(cells, entries["cell"].to_numpy())
            ids, least = entries["ids"].tolist(), np.array([i[0] for i in entries["ids"]])
            for lo in range(0, len(queries), STRIPE):
                q = queries.iloc[lo:lo + STRIPE]
                y = np.stack(q["vec"].to_numpy())
                seen = np.zeros((len(q), len(cells)), bool)
                for i, c in enumerate(q["cells"]):
                    seen[i, np.searchsorted(cells, c)[np.isin(c, cells)]] = True
                scores = np.where(seen[:, at], y @ x.T, -np.inf)
                slack = 1e-9 * (np.abs(y).sum(axis=1) * np.abs(x).max() + 1)
                for i, (h1, h2) in enumerate(zip(q["h1"], q["h2"], strict=True)):
                    s = scores[i]
                    bound = np.partition(s, len(s) - keep)[len(s) - keep] if len(s) > keep else -np.inf
                    near = np.flatnonzero((s >= bound - slack[i]) & (s > -np.inf))
                    exact = [(-math.fsum(y[i] * x[e]), int(least[e]), e) for e in near]
                    found = sorted((s, int(v)) for s, _, e in sorted(exact)[:keep] for v in ids[e])[:keep]
                    out += [(h1, h2, v, -s) for s, v in found]
        return pd.DataFrame(out, columns=["h1", "h2", "vec_id", "score"])
    return score


def neighbours(spark: SparkSession, vectors: DataFrame, is_query, top: int = 20, visit: float = 0.6) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``top`` nearest found of every row
    of ``vectors`` (vec_id, embedding) for which the column ``is_query`` holds."""
    rows = usable(vectors)
    asked = stored(spark, rows.where(is_query).dropDuplicates(["vec_id", "h1", "h2"]), "queries")
    # a query leaves itself out, so one more is looked for
    keep = top + 1
    index = Index(spark, rows, keep, visit)
    schema = "query_id long, rank int, vec_id long, score double"
    if index.empty:
        return spark.createDataFrame([], schema)
    queries = asked.groupBy("h1", "h2").agg(F.any_value("vec").alias("vec"))
    groups = max(1, math.ceil(asked.count() / GROUP_QUERIES))
    spread = _dealt_entries(index, groups).groupBy("block", "part")
    asking = _dealt_queries(index, queries, groups).groupBy("block", "part")
    found = spread.cogroup(asking).applyInPandas(_rerank(keep), "h1 long, h2 long, vec_id long, score double")
    best = Window.partitionBy("h1", "h2").orderBy(F.desc("score"), "vec_id")
    nearest_ids = (found.withColumn("r", F.row_number().over(best)).where(F.col("r") <= keep).groupBy("h1", "h2")
                   .agg(F.sort_array(F.collect_list(F.struct("r", "vec_id", "score"))).alias("near")))
    joined = asked.select(F.col("vec_id").alias("query_id"), "h1", "h2").join(nearest_ids, ["h1", "h2"])
    others = F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, top)
    return joined.select("query_id", F.posexplode(others).alias("i", "x")).select(
        "query_id", (F.col("i") + 1).cast("int").alias("rank"), "x.vec_id", "x.score")
