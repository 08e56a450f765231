"""Customer segmentation: PCA(2) -> min-max -> k-means(8) as one
``pyspark.ml`` pipeline (M1-M6, S10).

All fitting is distributed: PCA needs a 4x4 covariance (tree aggregate), the
scaler a min/max summary, k-means distributed Lloyd iterations; only those
small summaries and the k centres reach the driver.
"""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import MinMaxScaler, PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import MODEL_FEATURES, N_CLUSTERS, SEED

OUT_COL = "Clusters"
# Partitions of an ordered (order_by) training set. Fixed, because seeding
# depends on the layout: the number of rows must not change the model. Set
# ``fit_partitions`` to the cluster's task slots for large training sets, and
# keep it the same between fits that are to agree.
FIT_PARTITIONS = 8
_TMP = ["__features", "__pca", "__scaled"]


def clustering_pipeline(features=MODEL_FEATURES, k: int = N_CLUSTERS, seed: int = SEED,
                        max_iter: int = 300, tol: float = 1e-4) -> Pipeline:
    """M1-M4: assemble (fixed order) -> PCA(2) on unscaled values -> min-max
    to [0, 1] -> k-means. Spark's PCA does not centre; min-max afterwards
    cancels the shift, so clusters equal those of centred PCA (up to a
    mirrored axis, which keeps all distances)."""
    return Pipeline(stages=[
        VectorAssembler(inputCols=list(features), outputCol="__features", handleInvalid="error"),
        PCA(k=2, inputCol="__features", outputCol="__pca"),
        MinMaxScaler(inputCol="__pca", outputCol="__scaled"),
        KMeans(k=k, seed=seed, featuresCol="__scaled", predictionCol=OUT_COL,
               maxIter=max_iter, tol=tol),
    ])


def fit(train: DataFrame, features=MODEL_FEATURES, k: int = N_CLUSTERS, seed: int = SEED,
        n_init: int = 1, target: str | None = None,
        order_by: list[str] | None = None, tol: float = 1e-4,
        parallelism: int = 1, fit_partitions: int = FIT_PARTITIONS) -> PipelineModel:
    """M5: fit the pipeline. ``target`` is accepted and unused, as in the
    reference. With ``n_init > 1`` the k-means stage is refitted from seeds
    seed, seed+1, … and the lowest training cost kept (PCA and scaler are
    fitted once). Requires at least ``k`` rows.

    k-means|| samples rows per partition in partition order, so the fitted
    centres depend on how rows happen to be laid out. ``order_by`` (a unique
    row key, e.g. the entity key) fixes that layout: hash partitioning on the
    key into ``fit_partitions`` (balanced, as the key is unique; no sample, so the partition of a row
    depends on its key alone, not on input order) and a sort within
    partitions, so the same table gives the same model whatever its upstream
    partitioning and row order.

    ``tol`` is relative, as in the reference's k-means: see
    ``lloyd_tolerance``. Only the feature (and key) columns are kept and
    persisted for the PCA, scaler and scaling passes; the scaled vectors are
    persisted for the Lloyd iterations. ``parallelism`` runs up to that many
    of the ``n_init`` fits as concurrent Spark jobs (as Spark ML's model
    search does); the lowest cost wins, ties going to the lowest seed."""
    del target
    stages = clustering_pipeline(features, k, seed).getStages()
    data = train.select(*dict.fromkeys([*features, *(order_by or [])]))
    if order_by:
        data = data.repartition(fit_partitions, *order_by).sortWithinPartitions(*order_by)
    data = data.persist()  # first, so that no later pass runs the input's plan again
    try:
        if data.count() < k:
            raise ValueError(f"k-means needs at least k={k} rows")
        prep = Pipeline(stages=stages[:3]).fit(data)
        scaled = prep.transform(data).select("__scaled").persist()
        try:
            eps = lloyd_tolerance(scaled, tol, k, prep.stages[1].getK())

            def one(i):
                km = stages[3].copy().setSeed(seed + i).setTol(eps).fit(scaled)
                return km.summary.trainingCost, i, km

            seeds = range(max(1, n_init))
            if parallelism > 1 and len(seeds) > 1:
                with ThreadPoolExecutor(max_workers=min(parallelism, len(seeds))) as pool:
                    fits = list(pool.map(one, seeds))
            else:
                fits = [one(i) for i in seeds]
            best = min(fits, key=lambda f: (f[0], f[1]))[2]
        finally:
            scaled.unpersist()
    finally:
        data.unpersist()
    return PipelineModel(stages=[*prep.stages, best])


def lloyd_tolerance(scaled: DataFrame, tol: float, k: int, dims: int,
                    col: str = "__scaled") -> float:
    """Spark's stopping distance for a relative tolerance.

    The reference's k-means stops when the summed squared shift of the k
    centres is at most ``tol`` times the mean per-dimension (population)
    variance of its input. Spark's stops when every centre moved less than
    ``epsilon``. With ``epsilon = sqrt(tol * mean_var / k)`` the summed squared
    shift is then below ``k * epsilon**2``, i.e. the reference's condition
    holds whenever Spark stops. One aggregate over the scaled vectors."""
    arr = vector_to_array(col)
    row = scaled.select(*[F.var_pop(arr[i]) for i in range(dims)]).first()
    mean_var = sum(float(v or 0.0) for v in row) / dims
    return math.sqrt(tol * mean_var / k)


def predict(model: PipelineModel, df: DataFrame, stable_labels: bool = False) -> DataFrame:
    """M6: all input columns plus ``Clusters`` (int); helper vectors dropped.
    Runs on the executors (each task holds the k centres). k-means ids are
    arbitrary; ``stable_labels`` renumbers them by centre order
    (``relabel_by_centre``) with one map lookup, so refits that find the same
    centres give the same ids."""
    out = model.transform(df).drop(*_TMP)
    label = F.col(OUT_COL).cast("int")
    if stable_labels:
        pairs = sorted(relabel_by_centre(model).items())
        label = F.create_map(*[F.lit(x) for kv in pairs for x in kv])[label]
    return out.withColumn(OUT_COL, label.cast("int"))


def save_model(model: PipelineModel, path: str) -> None:
    """Save (overwrite) to any Hadoop-supported path."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def centers(model: PipelineModel) -> list[list[float]]:
    return [list(map(float, c)) for c in model.stages[-1].clusterCenters()]


def pca_projection(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Input plus ``pc1``, ``pc2`` (uncentred PCA scores) and ``s1``, ``s2``
    (after min-max)."""
    t = model.transform(df)
    pa, sa = vector_to_array("__pca"), vector_to_array("__scaled")
    return t.select(*df.columns, pa[0].alias("pc1"), pa[1].alias("pc2"),
                    sa[0].alias("s1"), sa[1].alias("s2"))


# ---- exact building blocks (checked against SQL) ---------------------------
def minmax_columns(df: DataFrame, cols: list[str], suffix: str = "_mm") -> DataFrame:
    """Min-max scale plain columns with ``MinMaxScaler`` (0.5 where constant)."""
    va = VectorAssembler(inputCols=list(cols), outputCol="__v", handleInvalid="error")
    m = MinMaxScaler(inputCol="__v", outputCol="__s").fit(va.transform(df))
    arr = vector_to_array("__s")
    return (m.transform(va.transform(df))
            .select(*df.columns, *[arr[i].alias(c + suffix) for i, c in enumerate(cols)]))


def feature_covariance(df: DataFrame, cols=MODEL_FEATURES) -> DataFrame:
    """Sample covariance matrix (long form: row, col, cov) as one aggregate;
    this is the matrix PCA decomposes."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    agg = df.agg(*[F.covar_samp(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}|{b}")
                   for a, b in pairs])
    stack = ", ".join(f"'{a}', '{b}', `{a}|{b}`" for a, b in pairs)
    return agg.selectExpr(f"stack({len(pairs)}, {stack}) AS (row, col, cov)")


def nearest_center(cols: list[str], centres: list[list[float]]) -> Column:
    """Index of the nearest centre (squared Euclidean; lowest index on ties)
    as one expression: k distance terms and a ``least`` over
    (distance, index) structs. No join; stays in whole-stage codegen."""
    terms = []
    for i, c in enumerate(centres):
        d = None
        for col, v in zip(cols, c):
            term = (F.col(col) - F.lit(float(v))) * (F.col(col) - F.lit(float(v)))
            d = term if d is None else d + term
        terms.append(F.struct(d.alias("d"), F.lit(i).alias("i")))
    return F.least(*terms)["i"] if len(terms) > 1 else terms[0]["i"]


def assign_clusters(df: DataFrame, cols: list[str], centres: list[list[float]],
                    out: str = OUT_COL) -> DataFrame:
    """Label rows by the nearest of fixed centres (batch scoring without the
    pipeline object, e.g. with centres from another system)."""
    return df.withColumn(out, nearest_center(cols, centres).cast("int"))


def relabel_by_centre(model: PipelineModel) -> dict[int, int]:
    """Stable ids: cluster ids ordered by centre coordinates."""
    cs = centers(model)
    order = sorted(range(len(cs)), key=lambda i: tuple(cs[i]))
    return {old: new for new, old in enumerate(order)}
