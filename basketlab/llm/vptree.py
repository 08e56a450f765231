"""Nearest neighbours by inner product from vantage-point trees.

With M the largest norm, a vector x becomes (x, sqrt(M^2 - |x|^2)) and a query
(q, 0): the smallest distance is then the largest inner product, and distances
obey the triangle inequality. Vectors go to the cell of the nearest of some
pivots (a bounded sample); a cell is one shard, or several of bounded size, and
each shard is one tree, kept as a row of a table. A node has a vantage point
and the ranges of distances of its two sides; a side at least ``bound`` away is
skipped once factor * bound reaches the distance of the k-th best found. Factor
1, the default, gives exact search; a larger one skips more, and loses true
neighbours as soon as the norms differ.

A query first searches the nearest cells that hold more than k vectors. What it
finds there bounds the rest: it goes on to those cells only whose range of
distances from their pivot can still beat its k-th best, by the same rule.
Queries of a shard come in blocks, and each (shard, block) with a query is one
group, so neither side meets whole in one task. Equal vectors of a shard are
one point with their k + 1 smallest ids, which is all a query can ask for. The
search keeps a few points more than k; where the last of them still ties with
the k-th, as with quantised vectors, the shard's points are all compared for
that query.
"""

from __future__ import annotations

import pickle

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

TREES = T.StructType([T.StructField("shard", T.IntegerType()), T.StructField("tree", T.BinaryType())])
FOUND = T.StructType([T.StructField("query_id", T.LongType()), T.StructField("vec_id", T.LongType()),
                      T.StructField("score", T.DoubleType())])


def distances(points, squares, centre):
    """From each point (with its squared length) to the centre."""
    import numpy as np
    return np.sqrt(np.maximum(squares + centre @ centre - 2 * (points @ centre), 0))


class Tree:
    """``points`` (distinct, float64, one more dimension) in tree order; a
    leaf is (start, end), a node (centre, inner, outer) whose sides are
    (least, largest distance, child)."""

    def __init__(self, vectors, ids, keep: int, leaf: int):
        import numpy as np
        vectors, which = np.unique(vectors, axis=0, return_inverse=True)
        order = np.lexsort((ids, which.ravel()))
        starts = np.searchsorted(which.ravel()[order], np.arange(len(vectors)))
        ends = np.append(starts[1:], len(ids))
        self.ids = [ids[order[s:min(e, s + keep)]] for s, e in zip(starts, ends, strict=True)]
        norms = (vectors * vectors).sum(axis=1)
        self.points = np.column_stack([vectors, np.sqrt(np.maximum(norms.max() - norms, 0))])
        self.squares = (self.points ** 2).sum(axis=1)
        self.rng = np.random.default_rng(len(vectors))
        self.order = np.arange(len(vectors))
        self.root = self._build(0, len(vectors), leaf)
        self.points, self.squares = self.points[self.order], self.squares[self.order]
        self.ids = [self.ids[i] for i in self.order]
        del self.rng, self.order

    def _build(self, start: int, end: int, leaf: int):
        """Halves of the range by their distance to one of its points: the
        depth is the logarithm of the size, whatever the vectors are."""
        import numpy as np
        if end - start <= leaf:
            return (start, end)
        at = self.order[start:end]
        centre = self.points[self.rng.choice(at)].copy()
        d = distances(self.points[at], self.squares[at], centre)
        by = np.argsort(d, kind="stable")
        self.order[start:end], d = at[by], d[by]
        half = (end - start) // 2
        return (centre,) + tuple((d[a], d[b - 1], self._build(start + a, start + b, leaf))
                                 for a, b in ((0, half), (half, end - start)))

    def search(self, queries, k: int, factor: float):
        """For each query the places and inner products of its k or more best
        points found, unordered."""
        import numpy as np
        q = np.column_stack([queries, np.zeros(len(queries))])
        q_squares = (q ** 2).sum(axis=1)
        k = min(k, len(self.points))
        best = np.full((len(q), k), -np.inf)
        place = np.zeros((len(q), k), dtype=np.int64)
        # Inner product p stands for the squared distance |q|^2 + M^2 - 2p.
        largest = self.squares[0]

        def visit(node, live):
            if len(node) == 2:
                start, end = node
                scores = q[live] @ self.points[start:end].T
                both = np.concatenate([best[live], scores], axis=1)
                where = np.concatenate([place[live], np.broadcast_to(np.arange(start, end), scores.shape)], axis=1)
                top = np.argpartition(-both, k - 1, axis=1)[:, :k]
                best[live] = np.take_along_axis(both, top, axis=1)
                place[live] = np.take_along_axis(where, top, axis=1)
                return
            centre, *sides = node
            d = np.sqrt(np.maximum(q_squares[live] + centre @ centre - 2 * (q[live] @ centre), 0))
            bounds = [np.maximum(np.maximum(low - d, d - high), 0) for low, high, _ in sides]
            first = bounds[0] <= bounds[1]
            for group, near in ((live[first], 0), (live[~first], 1)):
                mine = first if near == 0 else ~first
                for side in (near, 1 - near):
                    if not len(group):
                        continue
                    worst = best[group].min(axis=1)
                    limit = np.sqrt(np.maximum(q_squares[group] + largest - 2 * worst, 0))
                    go = group[factor * bounds[side][mine] <= limit]  # no bound yet: limit is infinite
                    if len(go):
                        visit(sides[side][2], go)

        visit(self.root, np.arange(len(q)))
        return place, best


    def best_ids(self, query, own: int, where, found, k: int, spare: int):
        """(ids, inner products) of the k best rows but ``own``, ties to the
        smaller id, from the places that ``search`` found and its inner
        products. They are summed anew, the same way for all points."""
        import numpy as np
        scores = (self.points[where, :-1] * query).sum(axis=1)
        who, score = self._rows(where, scores, own)
        top = np.lexsort((who, -score))[:k]
        # Rounding of a sum of products, of either kind.
        margin = 8 * len(query) * np.finfo(float).eps * np.sqrt((query @ query) * self.squares[0])
        if len(where) < min(k + spare, len(self.points)) or len(where) == len(self.points):
            return who[top], score[top]
        if len(top) == k and found.min() < score[top[-1]] - margin:
            return who[top], score[top]
        # Points that weren't kept may tie with the k-th: all that come up to it.
        near = np.flatnonzero(self.points[:, :-1] @ query >= (score[top[-1]] if len(top) == k else -np.inf) - margin)
        scores = np.concatenate([(self.points[some, :-1] * query).sum(axis=1) for some in np.array_split(
            near, -(-len(near) // 4096))])
        who, score = self._rows(near, scores, own)
        top = np.lexsort((who, -score))[:k]
        return who[top], score[top]

    def _rows(self, places, scores, own: int):
        """The points' ids without ``own``, and their scores."""
        import numpy as np
        who = np.concatenate([self.ids[p] for p in places])
        score = np.repeat(scores, [len(self.ids[p]) for p in places])
        other = who != own
        return who[other], score[other]


#: Points kept beyond k, so that rounding in the search decides no tie.
SPARE = 8


def valid(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id, v (doubles): rows with an id and a vector that is not null or
    zero, holds no null or non-finite component, and has the commonest length."""
    v = F.col("v")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = (vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
            .filter(F.col("vec_id").isNotNull() & v.isNotNull())
            .filter(F.coalesce(finite, F.lit(False)) & F.exists(v, lambda x: x != 0)))
    sizes = rows.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), "size").first()
    return rows.filter(F.size("v") == (sizes[0] if sizes else 0))


#: Pivots at most: what every task holds.
MOST_PIVOTS = 1024


class Cells:
    """Pivots (rows of a matrix), the largest squared norm of all vectors and,
    once counted, each cell's range of distances and number of shards."""

    def __init__(self, pivots, largest: float):
        import numpy as np
        self.pivots, self.largest = np.array(pivots, dtype=np.float64), largest
        norms = (self.pivots ** 2).sum(axis=1)
        self.lifts = np.sqrt(np.maximum(largest - norms, 0))
        self.low = self.high = self.rows = self.shards = self.first = None

    def distances(self, vectors):
        """From each vector (lifted to norm M) to each pivot."""
        import numpy as np
        lift = np.sqrt(np.maximum(self.largest - (vectors ** 2).sum(axis=1), 0))
        inner = vectors @ self.pivots.T + lift[:, None] * self.lifts
        return np.sqrt(np.maximum(2 * self.largest - 2 * inner, 0))

    def query_distances(self, queries):
        import numpy as np
        squares = (queries ** 2).sum(axis=1)
        return np.sqrt(np.maximum(squares[:, None] + self.largest - 2 * (queries @ self.pivots.T), 0))

    def count(self, found, shard_rows: int) -> None:
        """``found``: (cell, rows, least, largest distance) of the cells used."""
        import numpy as np
        n = len(self.pivots)
        self.rows, self.low, self.high = np.zeros(n, dtype=np.int64), np.full(n, np.inf), np.full(n, -np.inf)
        for cell, rows, low, high in found:
            self.rows[cell], self.low[cell], self.high[cell] = rows, low, high
        self.shards = -(-self.rows // shard_rows)
        self.first = np.cumsum(self.shards) - self.shards

    def nearest(self, queries, k: int):
        """Per query the nearest cells which hold more than k rows together."""
        import numpy as np
        order = np.argsort(self.query_distances(queries), axis=1, kind="stable")
        held = np.cumsum(self.rows[order], axis=1)
        needed = (held <= k).sum(axis=1) + 1
        return [row[:n][self.rows[row[:n]] > 0] for row, n in zip(order, needed, strict=True)]

    def open(self, queries, worst, factor: float):
        """Per query the cells that may hold a row as good as ``worst``, the
        k-th best inner product so far."""
        import numpy as np
        d = self.query_distances(queries)
        squares = (queries ** 2).sum(axis=1)
        # Distances of nearby points keep half of the digits.
        margin = 1e-6 * np.sqrt(squares + self.largest)
        limit = np.sqrt(np.maximum(squares + self.largest - 2 * worst, 0)) + margin
        bound = np.maximum(np.maximum(self.low - d, d - self.high), 0)
        return [np.flatnonzero(row & (self.rows > 0)) for row in factor * bound <= limit[:, None]]

    def shards_of(self, cells) -> list[int]:
        return [int(self.first[c]) + i for c in cells for i in range(int(self.shards[c]))]


def cells_of(rows: DataFrame, shard_rows: int) -> tuple[DataFrame, Cells] | None:
    """``rows`` with their cell and shard, and the cells."""
    size = rows.agg(F.count("*"), F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))).first()
    if not size[0]:
        return None
    wanted = min(MOST_PIVOTS, -(-size[0] // shard_rows))
    pivots = [r.v for r in rows.orderBy(F.xxhash64("vec_id", "v")).select("v").limit(wanted).collect()]
    cells = Cells(pivots, size[1])

    def run(batches):
        import numpy as np
        import pyarrow as pa
        for batch in batches:
            if not batch.num_rows:
                continue
            d = cells.distances(np.array(batch.column("v").to_pylist(), dtype=np.float64))
            cell = d.argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("v"), pa.array(cell, pa.int32()),
                 pa.array(d[np.arange(len(cell)), cell], pa.float64())], names=["vec_id", "v", "cell", "distance"])

    placed = common.materialise(
        rows.select("vec_id", "v").mapInArrow(run, "vec_id long, v array<double>, cell int, distance double"), "cells")
    cells.count([tuple(r) for r in placed.groupBy("cell").agg(
        F.count("*"), F.min("distance"), F.max("distance")).collect()], shard_rows)  # a row a pivot at most
    first, shards = (F.get(F.array(*[F.lit(int(x)) for x in v]), F.col("cell")) for v in (cells.first, cells.shards))
    # Equal rows share a hash; their place in the table tells them apart.
    deal = F.pmod(F.pmod(F.xxhash64("vec_id", "v"), shards) + F.monotonically_increasing_id() % shards, shards)
    return placed.select("vec_id", "v", (first + deal).cast("int").alias("shard")), cells


def build(rows: DataFrame, keep: int, leaf: int) -> DataFrame:
    """The index: one row (shard, tree) of bounded size per shard."""
    def run(table):
        import numpy as np
        import pyarrow as pa
        v = np.array(table.column("v").to_pylist(), dtype=np.float64)
        tree = Tree(v, table.column("vec_id").to_numpy(), keep, leaf)
        return pa.table({"shard": pa.array([table.column("shard")[0].as_py()], pa.int32()),
                         "tree": pa.array([pickle.dumps(tree, protocol=5)], pa.binary())})

    return rows.select("vec_id", "v", "shard").groupBy("shard").applyInArrow(run, TREES)


def routed(asked: DataFrame, cells: Cells, k: int, factor: float) -> DataFrame:
    """Queries with the cells they have searched (``done``), the shards they
    go to now and, with a column ``worst`` (null: nothing found yet), by the
    bounds instead of by nearness."""
    again = "worst" in asked.columns

    def run(batches):
        import numpy as np
        import pyarrow as pa
        for batch in batches:
            if not batch.num_rows:
                continue
            q = np.array(batch.column("v").to_pylist(), dtype=np.float64)
            if again:
                worst = batch.column("worst").fill_null(-np.inf).to_numpy(zero_copy_only=False)
                done = batch.column("done").to_pylist()
                go = [np.setdiff1d(c, d) for c, d in zip(cells.open(q, worst, factor), done, strict=True)]
            else:
                go = cells.nearest(q, k)
            shards = [cells.shards_of(c) for c in go]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("v"), pa.array([c.tolist() for c in go], pa.list_(pa.int32())),
                 pa.array(shards, pa.list_(pa.int32()))], names=["vec_id", "v", "done", "shards"])

    return asked.mapInArrow(run, "vec_id long, v array<double>, done array<int>, shards array<int>")


def searched(sent: DataFrame, trees: DataFrame, k: int, factor: float, block_rows: int) -> DataFrame:
    """The k best of each (query, shard) of ``sent`` (vec_id, v, shards)."""
    left = sent.select("vec_id", "v", F.explode("shards").alias("shard"))
    many = left.groupBy("shard").agg(F.ceil(F.count("*") / block_rows).alias("blocks"))
    left = left.join(many, "shard").select(
        "vec_id", "v", "shard", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int").alias("block"))
    right = trees.join(many, "shard").select(
        F.col("shard").alias("at"), "tree", F.explode(F.sequence(F.lit(0), F.col("blocks").cast("int") - 1)).alias("part"))

    def run(queries, trees):
        import numpy as np
        import pyarrow as pa
        out = [[], [], []]
        if queries.num_rows and trees.num_rows:
            tree = pickle.loads(trees.column("tree")[0].as_py())
            ids = queries.column("vec_id").to_numpy()
            q = np.array(queries.column("v").to_pylist(), dtype=np.float64)
            places, found = tree.search(q, k + SPARE, factor)
            for own, vector, where, score in zip(ids, q, places, found, strict=True):
                ok = np.isfinite(score)
                who, score = tree.best_ids(vector, own, where[ok], score[ok], k, SPARE)
                out[0].append(np.full(len(who), own))
                out[1].append(who)
                out[2].append(score)
        columns = [np.concatenate(c) if c else [] for c in out]
        return pa.table({f.name: pa.array(c, t) for f, c, t in zip(
            FOUND.fields, columns, (pa.int64(), pa.int64(), pa.float64()), strict=True)})

    return left.groupBy("shard", "block").cogroup(right.groupBy("at", "part")).applyInArrow(run, FOUND)


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, *, id_col="vec_id", vector_col="embedding",
            factor: float = 1.0, shard_rows: int = 32_768, block_rows: int = 8192, leaf: int = 256) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each query row its k
    nearest rows of ``vectors`` by inner product in double precision, itself
    (its id) left out, ties to the smaller id; all rows if there are fewer.

    Null, zero or non-finite vectors, null ids and vectors of an unusual
    length take no part on either side. Repeated rows are candidates each;
    a query that occurs twice is answered once. Empty tables give no rows.
    """
    spark = vectors.sparkSession
    common.python_ready(spark)
    rows = common.materialise(valid(vectors, id_col, vector_col), "vectors")
    asked = common.materialise(valid(queries, id_col, vector_col).dropDuplicates(["vec_id"]), "queries")
    placed = cells_of(rows, shard_rows)
    if placed is None:
        return spark.createDataFrame([], T.StructType([
            FOUND["query_id"], T.StructField("rank", T.IntegerType()), FOUND["vec_id"], FOUND["score"]]))
    placed, cells = placed
    trees = common.materialise(build(placed, k + 1, leaf), "trees")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")  # k rows a shard at most
    ranked = lambda found: found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    first = common.materialise(routed(asked.select("vec_id", "v"), cells, k, factor), "first")
    near = common.materialise(searched(first, trees, k, factor, block_rows), "near")
    worst = ranked(near).filter(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("worst"))
    rest = routed(first.select("vec_id", "v", "done").join(worst, "vec_id", "left"), cells, k, factor)
    far = searched(common.materialise(rest, "second"), trees, k, factor, block_rows)
    return ranked(near.unionByName(far)).select("query_id", "rank", "vec_id", "score")
