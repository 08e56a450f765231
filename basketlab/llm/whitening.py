"""Whitening of embeddings by pivoted Cholesky and one-sided Jacobi.

An entry c becomes the integer floor(scale * c) + shift, so that counts and
sums are exact. The vectors are read in passes of their own: lengths, sums,
scatter (centred before it is multiplied), covariance of the whitened vectors
(the identity, but for rounding), and output. A task hands on sums or one
d x d matrix, and matrices are added row by row in Spark; the driver sees one
of them, whose size depends on the dimension alone.

With V the covariance and P V P' = L L' its Cholesky factor, the largest
remaining diagonal entry taken first, the columns of L are rotated in pairs
until all are orthogonal: L J = U S. Then V = P' U S^2 U' P, so the squared
column norms are the eigenvalues and the normalised columns, their rows put
back in place, the components. V's square is never formed and pivoting has
sorted the columns nearly by size, which keeps small eigenvalues accurate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

OUT = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("component", T.IntegerType()),
    T.StructField("n", T.LongType()), T.StructField("deviation", T.LongType()),
    T.StructField("whitened", T.DoubleType()), T.StructField("explained", T.DoubleType()),
    T.StructField("identity_error", T.DoubleType())])
LONG = (1 << 63) - 1


def pivoted_cholesky(v):
    """(L, order) with v[order][:, order] = L L' and as many columns as the
    rank; what remains of the diagonal is rounding."""
    import numpy as np
    left, d = np.array(v, dtype=np.float64), len(v)
    order, factor = np.arange(d), np.zeros((d, d))
    tiny = d * np.finfo(float).eps * max(left.diagonal().max(initial=0.0), 0.0)
    for k in range(d):
        p = k + int(np.argmax(left.diagonal()[k:]))
        if left[p, p] <= tiny:
            return factor[:, :k], order
        swap = [p, k]
        order[[k, p]] = order[swap]
        factor[[k, p]] = factor[swap]
        left[[k, p]] = left[swap]
        left[:, [k, p]] = left[:, swap]
        factor[k, k] = np.sqrt(left[k, k])
        factor[k + 1:, k] = left[k + 1:, k] / factor[k, k]
        left[k + 1:, k + 1:] -= np.outer(factor[k + 1:, k], factor[k + 1:, k])
    return factor, order


def orthogonal_columns(factor, sweeps: int = 60):
    """Rotates pairs of columns until all are orthogonal. A round takes
    disjoint pairs, as in a round-robin tournament, so they turn together."""
    import numpy as np
    d, r = factor.shape
    g = np.zeros((d, r + r % 2))
    g[:, :r] = factor
    m = g.shape[1]
    if m < 2:
        return g[:, :r]
    ring = list(range(m))
    for _ in range(sweeps):
        worst = 0.0
        for _ in range(m - 1):
            i, j = np.array(ring[:m // 2]), np.array(ring[:m // 2 - 1:-1])
            a, b = g[:, i], g[:, j]
            aa, bb, ab = (a * a).sum(axis=0), (b * b).sum(axis=0), (a * b).sum(axis=0)
            size = np.sqrt(aa * bb)
            turn = np.abs(ab) > 1e-16 * size
            worst = max(worst, float((np.abs(ab[turn]) / size[turn]).max(initial=0.0)))
            zeta = np.where(turn, (bb - aa) / np.where(turn, 2 * ab, 1.0), 0.0)
            t = np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            t = np.where(turn, t, 0.0)
            c = 1 / np.hypot(1.0, t)
            g[:, i], g[:, j] = c * (a - t * b), c * (b + t * a)
            ring = [ring[0], ring[-1], *ring[1:-1]]
        if worst <= 1e-15 * d:
            break
    return g[:, :r]


def components(v):
    """Eigenvalues of a covariance, falling, and its unit eigenvectors as
    columns; the largest entry of each is positive. Only the rank's."""
    import numpy as np
    factor, order = pivoted_cholesky(v)
    turned = np.empty_like(factor)
    turned[order] = orthogonal_columns(factor)
    values = (turned * turned).sum(axis=0)
    by = np.argsort(-values, kind="stable")
    by = by[values[by] > 0]
    vectors = turned[:, by] / np.sqrt(values[by])
    peak = vectors[np.abs(vectors).argmax(axis=0), np.arange(len(by))] if len(by) else np.zeros(0)
    return values[by], vectors * np.where(peak < 0, -1.0, 1.0)


def _usable(column, scale: float, shift: int, size: int | None = None):
    """Of a list column of doubles: which rows are not null, hold neither null
    nor non-finite entries nor such as fit no long, and have ``size`` entries;
    each row's length; and the chosen rows' integers."""
    import numpy as np
    import pyarrow.compute as pc
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    entries = pc.fill_null(column.flatten(), float("nan")).to_numpy(zero_copy_only=False)
    with np.errstate(over="ignore", invalid="ignore"):
        scaled = np.floor(entries * scale)
        bad = np.append(0, np.cumsum(~(np.abs(scaled) < 2.0 ** 62)))
    ends = np.cumsum(lengths)
    ok = (lengths > 0) & (bad[ends] == bad[ends - lengths])
    if size is None:
        return ok, lengths, None
    ok &= lengths == size
    at = (ends - lengths)[ok][:, None] + np.arange(size)
    return ok, lengths, scaled[at].astype(np.int64) + shift


def _lengths(rows: DataFrame, scale: float, shift: int) -> int:
    """The commonest length of usable vectors (of equals the smallest), 0 if
    there are none."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        for batch in batches:
            ok, lengths, _ = _usable(batch.column(0), scale, shift)
            sizes, counts = np.unique(lengths[ok], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())],
                                             names=["size", "rows"])

    found = rows.select("v").mapInArrow(run, "size long, rows long").groupBy("size").agg(F.sum("rows").alias("rows"))
    first = found.orderBy(F.desc("rows"), "size").first()
    return first[0] if first else 0


def _sums(rows: DataFrame, size: int, scale: float, shift: int) -> tuple[int, list[int]]:
    """n and the exact sum of each dimension. Upper and lower parts are added
    apart, so no sum overflows."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        for batch in batches:
            _, _, x = _usable(batch.column(0), scale, shift, size)
            parts = [np.arange(size), np.full(size, len(x)), (x >> 20).sum(axis=0), (x & ((1 << 20) - 1)).sum(axis=0)]
            yield pa.RecordBatch.from_arrays([pa.array(p, pa.int64()) for p in parts], names=["at", "n", "high", "low"])

    total = rows.select("v").mapInArrow(run, "at long, n long, high long, low long").groupBy("at").agg(
        F.sum("n").alias("n"), *(F.sum(F.col(c).cast("decimal(20,0)")).alias(c) for c in ("high", "low")))
    found = {r["at"]: r for r in total.collect()}
    return found[0]["n"], [(int(found[i]["high"]) << 20) + int(found[i]["low"]) for i in range(size)]


class _Centre:
    """x - S/n without loss: the whole part of the mean goes first."""

    def __init__(self, n: int, sums: list[int]):
        import numpy as np
        self.whole = np.array([s // n for s in sums], dtype=np.int64)
        self.rest = np.array([(s % n) / n for s in sums])

    def __call__(self, x):
        return (x - self.whole) - self.rest


def _scatter(rows: DataFrame, size: int, centre: _Centre, scale: float, shift: int, project=None):
    """Sum of the outer products of the centred vectors, or of their
    projections. A task adds up its rows and hands on one matrix."""
    import numpy as np
    width = size if project is None else project.shape[1]

    def partial(batches):
        import numpy as np
        import pyarrow as pa
        total = np.zeros((width, width))
        for batch in batches:
            d = centre(_usable(batch.column(0), scale, shift, size)[2])
            d = d if project is None else d @ project
            total += d.T @ d
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width), pa.int64()),
                                          pa.array(list(total), pa.list_(pa.float64()))], names=["at", "row"])

    def add(table):
        import numpy as np
        import pyarrow as pa
        row = np.array(table.column("row").to_pylist()).sum(axis=0)
        return pa.table({"at": table.column("at")[:1], "row": pa.array([row], pa.list_(pa.float64()))})

    schema = "at long, row array<double>"
    found = rows.select("v").mapInArrow(partial, schema).groupBy("at").applyInArrow(add, schema).collect()
    return np.array([r["row"] for r in sorted(found, key=lambda r: r["at"])]).reshape(-1, width)


def _deviation(x, n: int, sums: list[int]) -> list:
    """Sum over the dimensions of (n x - S)^2, exact; null beyond a long."""
    import numpy as np
    largest = int(np.abs(x).max(initial=0))
    if n * largest + max(map(abs, sums)) < 1 << 62:
        d = n * x - np.array(sums, dtype=np.int64)
        if int(np.abs(d).max(initial=0)) ** 2 * len(sums) <= LONG:
            return (d * d).sum(axis=1).tolist()
    exact = [sum((n * v - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in x.tolist()]
    return [e if e <= LONG else None for e in exact]


def whiten(vectors: DataFrame, *, most: int = 32, id_col="vec_id", vector_col="embedding", scale: float = 64.0,
           shift: int = 1_000_000) -> DataFrame:
    """One row per usable vector and component (at most ``most``, and the
    covariance's rank): vec_id, component (from 1 by falling eigenvalue e), n,
    deviation, whitened, explained (e over the trace) and identity_error.

    Vectors that are null or empty, hold null or non-finite entries (or such
    whose integer fits no long), or haven't the commonest length take no part.
    Null ids stay null; repeated rows count each; a deviation beyond a long is
    null. An empty table, a single vector and equal vectors have no components
    and give no rows. Equal eigenvalues have any orthogonal components of
    their space. Other columns play no part. ``vectors`` is read five times.
    """
    spark = vectors.sparkSession
    common.python_ready(spark)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    size = _lengths(rows, scale, shift)
    if not size:
        return spark.createDataFrame([], OUT)
    n, sums = _sums(rows, size, scale, shift)
    centre = _Centre(n, sums)
    v = _scatter(rows, size, centre, scale, shift) / n
    values, axes = components(v)
    values, axes = values[:most], axes[:, :most]
    k = len(values)
    if not k:
        return spark.createDataFrame([], OUT)
    project, explained = axes / values ** 0.5, values / v.trace()
    error = _scatter(rows, size, centre, scale, shift, project) / n
    error = float(abs(error - [[float(i == j) for j in range(k)] for i in range(k)]).max())

    def run(batches):
        import numpy as np
        import pyarrow as pa
        for batch in batches:
            ok, _, x = _usable(batch.column("v"), scale, shift, size)
            if not len(x):
                continue
            ids = batch.column("id").filter(pa.array(ok))
            each = np.repeat(np.arange(len(x)), k)
            columns = [ids.take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1), len(x)), pa.int32()),
                       pa.array(np.full(len(each), n), pa.int64()),
                       pa.array(_deviation(x, n, sums), pa.int64()).take(pa.array(each)),
                       pa.array((centre(x) @ project).ravel()), pa.array(np.tile(explained, len(x))),
                       pa.array(np.full(len(each), error))]
            yield pa.RecordBatch.from_arrays(columns, names=OUT.names)

    return rows.mapInArrow(run, OUT)
