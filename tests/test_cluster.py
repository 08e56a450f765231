"""Clustering pipeline: PCA vs numpy, scaling range, nearest centre, reload."""

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array

from basketlab.operators import cluster
from basketlab.session import scratch_path

COLS = ["qty_products", "qty_returns", "frequency", "recency_days"]


@pytest.fixture(scope="module")
def train(spark):
    rng = np.random.default_rng(7)
    rows = []
    for i in range(400):
        g = i % 4
        rows.append((i, float(rng.normal(10 + 30 * g, 3)), int(rng.integers(0, 5 + g)),
                     float(rng.uniform(0.01, 1.0)), int(rng.integers(0, 300)), 1.0))
    return spark.createDataFrame(
        rows, "CustomerID long, qty_products double, qty_returns long, frequency double, "
              "recency_days long, gross_revenue double")


@pytest.fixture(scope="module")
def model(train):
    return cluster.fit(train, n_init=2)


def test_pca_matches_centred_svd_after_minmax(train, model):
    proj = cluster.pca_projection(model, train).orderBy("CustomerID").toPandas()
    X = train.orderBy("CustomerID").toPandas()[COLS].to_numpy(float)
    Xc = X - X.mean(axis=0)
    _, _, vt = np.linalg.svd(Xc, full_matrices=False)
    z = Xc @ vt[:2].T
    z = (z - z.min(0)) / (z.max(0) - z.min(0))
    for j, c in enumerate(["s1", "s2"]):
        s = proj[c].to_numpy()
        assert min(np.abs(s - z[:, j]).max(), np.abs(s - (1 - z[:, j])).max()) < 1e-6
    assert proj[["s1", "s2"]].min().min() >= 0 and proj[["s1", "s2"]].max().max() <= 1


def test_rows_sit_at_nearest_centre(train, model):
    t = model.transform(train).select(vector_to_array("__scaled").alias("s"), "Clusters").toPandas()
    cs = np.array(cluster.centers(model))
    S = np.stack(t["s"].to_numpy())
    d = ((S[:, None, :] - cs[None, :, :]) ** 2).sum(-1)
    assert (d.argmin(1) == t["Clusters"].to_numpy()).all()
    assert t["Clusters"].nunique() <= 8


def test_cost_beats_random_assignment(train, model):
    t = model.transform(train).select(vector_to_array("__scaled").alias("s"), "Clusters").toPandas()
    S = np.stack(t["s"].to_numpy())
    cs = np.array(cluster.centers(model))
    cost = ((S - cs[t["Clusters"].to_numpy()]) ** 2).sum()
    rnd = np.random.default_rng(0).integers(0, len(cs), len(S))
    assert cost <= ((S - cs[rnd]) ** 2).sum()


def test_save_load_same_labels(spark, train, model):
    p = scratch_path(spark, "t-model")
    cluster.save_model(model, p)
    a = cluster.predict(model, train).orderBy("CustomerID").select("Clusters").collect()
    b = cluster.predict(cluster.load_model(p), train).orderBy("CustomerID").select("Clusters").collect()
    assert a == b
    cols = cluster.predict(model, train).columns
    assert cols == train.columns + ["Clusters"]


def test_assign_clusters_lowest_index_on_tie(spark):
    df = spark.createDataFrame([(0.5, 0.5), (0.0, 0.0)], "a double, b double")
    out = cluster.assign_clusters(df, ["a", "b"], [[0.0, 0.5], [1.0, 0.5], [0.0, 0.0]])
    assert [r.Clusters for r in out.collect()] == [0, 2]


def test_covariance_matches_numpy(train):
    cov = {(r.row, r.col): r.cov for r in cluster.feature_covariance(train).collect()}
    X = train.toPandas()[COLS].to_numpy(float)
    C = np.cov(X, rowvar=False)
    for i, a in enumerate(COLS):
        for j, b in enumerate(COLS):
            if (a, b) in cov:
                assert abs(cov[(a, b)] - C[i, j]) < 1e-6 * max(1, abs(C[i, j]))


def test_stable_labels_follow_centre_order(train, model):
    raw = cluster.predict(model, train).select("CustomerID", "Clusters").toPandas()
    stable = cluster.predict(model, train, stable_labels=True).select("CustomerID", "Clusters").toPandas()
    m = raw.merge(stable, on="CustomerID", suffixes=("_raw", "_stable"))
    # a renumbering: one stable id per raw id and the other way round
    assert (m.groupby("Clusters_raw")["Clusters_stable"].nunique() == 1).all()
    assert (m.groupby("Clusters_stable")["Clusters_raw"].nunique() == 1).all()
    mapping = cluster.relabel_by_centre(model)
    cs = cluster.centers(model)
    order = [old for old, _ in sorted(mapping.items(), key=lambda kv: kv[1])]
    assert [tuple(cs[i]) for i in order] == sorted(tuple(c) for c in cs)
    assert set(m["Clusters_stable"]) <= set(range(len(cs)))


def test_ordered_fit_ignores_input_layout(train):
    a = cluster.fit(train.repartition(3), order_by=["CustomerID"])
    b = cluster.fit(train.repartition(7, "qty_returns").sortWithinPartitions("frequency"),
                    order_by=["CustomerID"])
    ca, cb = sorted(map(tuple, cluster.centers(a))), sorted(map(tuple, cluster.centers(b)))
    assert np.allclose(ca, cb, atol=1e-9)
    la = cluster.predict(a, train, stable_labels=True).orderBy("CustomerID").select("Clusters")
    lb = cluster.predict(b, train, stable_labels=True).orderBy("CustomerID").select("Clusters")
    assert [r[0] for r in la.collect()] == [r[0] for r in lb.collect()]


def test_lloyd_tolerance_is_relative_to_variance(spark):
    from pyspark.ml.linalg import Vectors
    pts = [(Vectors.dense([x, 2.0 * x + (i % 3)]),) for i, x in enumerate(np.linspace(0, 1, 50))]
    df = spark.createDataFrame(pts, ["__scaled"])
    X = np.array([p[0].toArray() for p in pts])
    eps = cluster.lloyd_tolerance(df, 1e-4, 8, 2)
    # k * eps**2 equals the reference's threshold: tol * mean population variance
    assert np.isclose(8 * eps ** 2, 1e-4 * X.var(axis=0).mean())


def test_parallel_n_init_picks_the_same_model(train):
    a = cluster.fit(train, n_init=3, order_by=["CustomerID"])
    b = cluster.fit(train, n_init=3, order_by=["CustomerID"], parallelism=3)
    assert np.allclose(sorted(map(tuple, cluster.centers(a))), sorted(map(tuple, cluster.centers(b))))


def test_model_does_not_follow_the_input_layout(train):
    """A model doesn't depend on input order or partitioning."""
    a = cluster.fit(train, order_by=["CustomerID"], fit_partitions=3)
    b = cluster.fit(train.repartition(7).orderBy("frequency"), order_by=["CustomerID"], fit_partitions=3)
    assert np.allclose(cluster.centers(a), cluster.centers(b))


def test_partitions_are_fixed_on_both_sides_of_a_large_row_count(spark, monkeypatch):
    """Formerly 250,001 rows meant another layout than 250,000."""
    seen = []
    persist = type(spark.range(1)).persist
    monkeypatch.setattr(type(spark.range(1)), "persist",
                        lambda self, *a: (seen.append(self.rdd.getNumPartitions()), persist(self, *a))[1])
    for n in (250_000, 250_001):
        rows = spark.range(n).selectExpr("id AS CustomerID", "id % 7 AS qty_products", "id % 3 AS qty_returns",
                                         "id % 11 / 10.0 AS frequency", "id % 300 AS recency_days")
        cluster.fit(rows, order_by=["CustomerID"], k=2)
    assert seen == [cluster.FIT_PARTITIONS] * 4
