"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the driver tables through ``fixtures.raw_invoices`` (or a
table Spark derives from them) over their whole extent. Floating sums are
rounded to cents only at this reporting layer, so both engines' different
summation orders compare equal; the library functions return exact sums.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixtures
from ..operators import clean, features, prepare

QUERIES: dict = {}


def register(name):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.raw_invoices(spark, sf_dir)


def curated(spark: SparkSession, sf_dir: str, as_of=None) -> DataFrame:
    return clean.curate(raw(spark, sf_dir), as_of)


def typed(spark: SparkSession, sf_dir: str, as_of=None) -> DataFrame:
    return prepare.cast_trusted(curated(spark, sf_dir, as_of))


def report_features(df: DataFrame) -> DataFrame:
    return df.withColumn("gross_revenue", F.round("gross_revenue", 2))


@register("curated")
def q_curated(spark, sf_dir):
    return curated(spark, sf_dir)


@register("customer_features")
def q_customer_features(spark, sf_dir):
    return report_features(features.customer_features(typed(spark, sf_dir)))


@register("features_join")
def q_features_join(spark, sf_dir):
    f, p, r = prepare.prepare(curated(spark, sf_dir), trusted=True)
    return report_features(features.features_join(f, p, r))


# ---- sources and sinks ----------------------------------------------------
from ..functions import casts  # noqa: E402
from ..schemas import CURATED, MODEL_FEATURES, N_CLUSTERS, PREPARED  # noqa: E402
from ..session import scratch_path, shared_dir  # noqa: E402
from ..sources import tables  # noqa: E402

SCAN_CUTOFF = "1998-08-02"


@register("scan_until")
def q_scan_until(spark, sf_dir):
    return tables.read_until(typed(spark, sf_dir), "InvoiceDate", SCAN_CUTOFF)


RUN_SQL_TEXT = """SELECT Country, COUNT(*) AS n_lines, CAST(SUM(Quantity) AS BIGINT) AS qty
FROM curated WHERE InvoiceDate <= CURRENT_DATE GROUP BY Country"""


@register("run_sql")
def q_run_sql(spark, sf_dir):
    curated(spark, sf_dir).createOrReplaceTempView("curated")
    return tables.run_sql(spark, RUN_SQL_TEXT)


@register("curated_roundtrip")
def q_curated_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "curated")
    tables.write_partitioned(curated(spark, sf_dir), path, "InvoiceDate")
    return tables.read_partitioned(spark, path, CURATED)


@register("write_modes")
def q_write_modes(spark, sf_dir):
    t = typed(spark, sf_dir)
    path = scratch_path(spark, "modes")
    tables.write_table(prepare.purchases(t), path, "fail")
    tables.write_table(prepare.purchases(t), path, "replace")
    tables.write_table(t.where(~(F.col("Quantity") >= 0) | F.col("Quantity").isNull()), path, "append")
    return tables.read_table(spark, path, PREPARED)


# ---- cleaning and preparation ---------------------------------------------
@register("clean_not_null")
def q_clean_not_null(spark, sf_dir):
    return clean.not_null_rows(raw(spark, sf_dir))


@register("clean_business")
def q_clean_business(spark, sf_dir):
    return clean.business_rows(raw(spark, sf_dir))


@register("project_filtered")
def q_project_filtered(spark, sf_dir):
    return prepare.filtered(typed(spark, sf_dir))


@register("split_returns")
def q_split_returns(spark, sf_dir):
    return prepare.returns(typed(spark, sf_dir))


@register("split_purchases")
def q_split_purchases(spark, sf_dir):
    return prepare.purchases(typed(spark, sf_dir))


# ---- single features ------------------------------------------------------
def _fpr(spark, sf_dir):
    return prepare.prepare(curated(spark, sf_dir), trusted=True)


@register("gross_revenue")
def q_gross_revenue(spark, sf_dir):
    f, p, r = _fpr(spark, sf_dir)
    return features.gross_revenue(p).withColumn("gross_revenue", F.round("gross_revenue", 2))


@register("recency")
def q_recency(spark, sf_dir):
    f, p, r = _fpr(spark, sf_dir)
    return features.recency(p, f)


@register("qty_products")
def q_qty_products(spark, sf_dir):
    f, p, r = _fpr(spark, sf_dir)
    return features.qty_products(p)


@register("frequency")
def q_frequency(spark, sf_dir):
    f, p, r = _fpr(spark, sf_dir)
    return features.frequency(p)


@register("qty_returns")
def q_qty_returns(spark, sf_dir):
    f, p, r = _fpr(spark, sf_dir)
    return features.qty_returns(r)


@register("distinct_customers")
def q_distinct_customers(spark, sf_dir):
    f, p, r = _fpr(spark, sf_dir)
    return features.distinct_customers(f)


ACTIVE_DAY = "1998-07-21"


@register("active_customers")
def q_active_customers(spark, sf_dir):
    return features.active_customers(raw(spark, sf_dir), ACTIVE_DAY)


SERIES_FROM, SERIES_TO = "1996-01-01", "1997-01-01"


@register("daily_quantity")
def q_daily_quantity(spark, sf_dir):
    return features.daily_quantity(curated(spark, sf_dir), SERIES_FROM, SERIES_TO)


@register("daily_quantity_by_country")
def q_daily_quantity_by_country(spark, sf_dir):
    return features.daily_quantity(curated(spark, sf_dir), SERIES_FROM, SERIES_TO, keys=("Country",))


# ---- casts ----------------------------------------------------------------
@register("cast_int")
def q_cast_int(spark, sf_dir):
    df = raw(spark, sf_dir).select("InvoiceNo", "StockCode", "Quantity", "UnitPrice", "CustomerID")
    # One pass checks all three: finite doubles truncate; NULLs leave a column as is.
    df, ok = casts.convert_columns(df, [("Quantity", "int"), ("UnitPrice", "int"),
                                        ("CustomerID", "int")])
    return df.select("*", F.lit(ok["Quantity"]).alias("ok_quantity"),
                     F.lit(ok["UnitPrice"]).alias("ok_price"),
                     F.lit(ok["CustomerID"]).alias("ok_customer"))


@register("cast_date")
def q_cast_date(spark, sf_dir):
    df = raw(spark, sf_dir).select(
        "InvoiceNo",
        F.col("InvoiceDate").cast("string").alias("d_iso"),
        F.date_format("InvoiceDate", "dd/MM/yyyy").alias("d_fmt"),
        "Description")
    # One pass checks all three; free text (Description) is left as is.
    df, ok = casts.convert_columns(df, [("d_iso", "date"), ("d_fmt", "date", "dd/MM/yyyy"),
                                        ("Description", "date")])
    return df.select("*", F.lit(ok["d_iso"]).alias("ok_iso"), F.lit(ok["d_fmt"]).alias("ok_fmt"),
                     F.lit(ok["Description"]).alias("ok_text"))


# ---- feature store --------------------------------------------------------
from ..operators import state, store  # noqa: E402
from ..operators.asof import asof_join  # noqa: E402
from ..sources.versioned import VersionedTable  # noqa: E402
from .oracle_sql import BUILD_AS_OF, REFRESH_DAY, T0, T1  # noqa: E402


def _report(df):
    return df.withColumn("gross_revenue", F.round("gross_revenue", 2))


def built_table(spark, sf_dir, as_of=None) -> VersionedTable:
    vt = VersionedTable(spark, scratch_path(spark, "feature-table"))
    store.build_feature_table(vt, typed(spark, sf_dir, as_of), at=T0, key="hash")
    return vt


UUID = "^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$"


@register("stamp")
def q_stamp(spark, sf_dir):
    # Random keys (the reference's behaviour): kept once, then reported as
    # "is a random uuid" and "no other row has it".
    shared_dir(spark)
    t = store.stamp(features.customer_features(typed(spark, sf_dir)), at=T0, key="uuid").checkpoint(eager=True)
    times = t.groupBy("values").agg(F.count("*").alias("n"))
    return _report(t.join(times, "values").select(
        *[c for c in t.columns if c != "values"], F.col("values").rlike(UUID).alias("key_valid"),
        (F.col("n") == 1).alias("key_unique")))


@register("feature_table")
def q_feature_table(spark, sf_dir):
    return _report(built_table(spark, sf_dir).read())


@register("normalise_types")
def q_normalise_types(spark, sf_dir):
    # Untrusted input: CustomerID has missing values, so it stays as it is.
    return casts.normalise_types(raw(spark, sf_dir))


@register("normalise_types_clean")
def q_normalise_types_clean(spark, sf_dir):
    return casts.normalise_types(curated(spark, sf_dir))


@register("write_refused")
def q_write_refused(spark, sf_dir):
    """S7 and S8 on a real table: absent, written, refused, unchanged."""
    path = scratch_path(spark, "refused")
    before = tables.table_exists(spark, path)
    tables.write_table(typed(spark, sf_dir), path, "fail")
    try:
        tables.write_table(typed(spark, sf_dir).limit(1), path, "fail")
        refused = False
    except Exception:  # noqa: BLE001 - Spark's own error type differs by sink
        refused = True
    return tables.read_table(spark, path, PREPARED).groupBy("Country").agg(F.count("*").alias("n_lines")).select(
        "Country", "n_lines", F.lit(before).alias("existed_before"), F.lit(refused).alias("refused"),
        F.lit(tables.table_exists(spark, path)).alias("exists_after"))


@register("active_semi")
def q_active_semi(spark, sf_dir):
    t = prepare.filtered(typed(spark, sf_dir, REFRESH_DAY))
    return store.semi_active(t, store.active_set(raw(spark, sf_dir), REFRESH_DAY))


@register("restamp")
def q_restamp(spark, sf_dir):
    vt = built_table(spark, sf_dir, BUILD_AS_OF)
    return _report(store.restamp(vt.read(), store.active_set(raw(spark, sf_dir), REFRESH_DAY),
                                 at=T1, key="hash"))


def _refreshed(spark, sf_dir, mode):
    vt = built_table(spark, sf_dir, BUILD_AS_OF)
    store.refresh_features(vt, typed(spark, sf_dir, REFRESH_DAY), raw(spark, sf_dir),
                           REFRESH_DAY, at=T1, key="hash", mode=mode)
    return _report(vt.read())


@register("refresh")
def q_refresh(spark, sf_dir):
    return _refreshed(spark, sf_dir, "append")


@register("refresh_upsert")
def q_refresh_upsert(spark, sf_dir):
    return _refreshed(spark, sf_dir, "upsert")


@register("refresh_state")
def q_refresh_state(spark, sf_dir):
    """The refresh from a stored state and the lines of one day."""
    vt = built_table(spark, sf_dir, BUILD_AS_OF)
    st = state.CustomerState(spark, scratch_path(spark, "state"))
    st.build(typed(spark, sf_dir, BUILD_AS_OF))
    one = F.col("InvoiceDate") == F.lit(REFRESH_DAY).cast("date")
    state.refresh_from_state(vt, st, typed(spark, sf_dir, REFRESH_DAY).filter(one), raw(spark, sf_dir).filter(one),
                             REFRESH_DAY, at=T1, key="hash")
    return _report(vt.read())


@register("read_instances")
def q_read_instances(spark, sf_dir):
    return store.read_instances(built_table(spark, sf_dir).read())


def ingested_store(spark, sf_dir):
    vt = built_table(spark, sf_dir)
    fs = store.FeatureStore(spark, scratch_path(spark, "feature-store")).get_or_create()
    fs.register()
    fs.ingest(vt.read(), ingest_date="2024-01-01")
    return vt, fs


STORE_COLS = ["values", "timestamp", "gross_revenue", "recency_days", "qty_products",
              "frequency", "qty_returns"]


@register("ingest")
def q_ingest(spark, sf_dir):
    _, fs = ingested_store(spark, sf_dir)
    return _report(fs.log().select(*STORE_COLS))


@register("train_set")
def q_train_set(spark, sf_dir):
    vt, fs = ingested_store(spark, sf_dir)
    return _report(fs.serve(store.read_instances(vt.read()), "*"))


def two_versions(spark, sf_dir):
    """Built, ingested, refreshed, and the changed rows ingested."""
    vt = built_table(spark, sf_dir, BUILD_AS_OF)
    fs = store.FeatureStore(spark, scratch_path(spark, "feature-store")).get_or_create()
    fs.register()
    fs.ingest_version(vt, ingest_date="2024-01-01")
    store.refresh_features(vt, typed(spark, sf_dir, REFRESH_DAY), raw(spark, sf_dir), REFRESH_DAY, at=T1, key="hash")
    fs.ingest_version(vt, ingest_date="2024-01-02")
    return vt, fs


@register("ingest_two_versions")
def q_ingest_two_versions(spark, sf_dir):
    return _report(two_versions(spark, sf_dir)[1].log().select(*STORE_COLS))


@register("train_set_two_versions")
def q_train_set_two_versions(spark, sf_dir):
    vt, fs = two_versions(spark, sf_dir)
    return _report(fs.serve(store.read_instances(vt.read()), "*"))


@register("asof_serve")
def q_asof_serve(spark, sf_dir):
    # Every event is a read; what a user looked at or clicked on is the feature.
    ev = fixtures.table(spark, sf_dir, "events")
    reads = ev.select("event_id", "event_type", "user_id", "ts")
    feats = ev.where(F.col("event_type").isin("view", "click")).select(
        "user_id", F.col("ts").alias("feat_ts"), F.col("value").alias("feat_value"),
        F.col("event_id").alias("feat_event_id"))
    return asof_join(reads, feats, "user_id", "ts", "feat_ts",
                     ["feat_ts", "feat_value", "feat_event_id"], order_by=["feat_event_id"])


# ---- clustering -----------------------------------------------------------
from ..operators import cluster  # noqa: E402

# Fixed centres for the exact scoring check (a 3x3 grid without its middle).
GRID_CENTRES = [[0.1, 0.1], [0.1, 0.5], [0.1, 0.9], [0.5, 0.1],
                [0.5, 0.9], [0.9, 0.1], [0.9, 0.5], [0.9, 0.9]]


def training_set(spark, sf_dir):
    return features.customer_features(typed(spark, sf_dir))


def fitted(spark, sf_dir):
    train = training_set(spark, sf_dir)
    # Ordered by the unique customer key: the same tables give the same model.
    return train, cluster.fit(train, order_by=["CustomerID"])


@register("feature_cov")
def q_feature_cov(spark, sf_dir):
    return (cluster.feature_covariance(training_set(spark, sf_dir))
            .withColumn("cov", F.round("cov", 4)))


def _scaled(spark, sf_dir):
    mm = cluster.minmax_columns(training_set(spark, sf_dir), ["recency_days", "frequency"])
    return mm.select("CustomerID", F.round("recency_days_mm", 9).alias("recency_days_mm"),
                     F.round("frequency_mm", 9).alias("frequency_mm"))


@register("minmax")
def q_minmax(spark, sf_dir):
    return _scaled(spark, sf_dir)


@register("cluster_assign")
def q_cluster_assign(spark, sf_dir):
    return cluster.assign_clusters(_scaled(spark, sf_dir), ["recency_days_mm", "frequency_mm"],
                                   GRID_CENTRES).select("CustomerID", "Clusters")


@register("pca_project")
def q_pca_project(spark, sf_dir):
    """Per component: the variance of the projected customers (an eigenvalue
    of their covariance) and its share of the whole; scaled bounds 0 and 1."""
    train, model = fitted(spark, sf_dir)
    p = cluster.pca_projection(model, train)
    whole = p.agg(sum(F.var_samp(F.col(c).cast("double")) for c in MODEL_FEATURES)).scalar()
    rows = p.select(F.explode(F.array(*[F.struct(F.lit(i).alias("component"), F.col(f"pc{i}").alias("pc"),
                                                 F.col(f"s{i}").alias("s")) for i in (1, 2)])).alias("r")).select("r.*")
    var = F.var_samp("pc")
    return rows.groupBy("component").agg(var.alias("v"), F.min("s").alias("low"), F.max("s").alias("high")).select(
        "component", F.round(F.col("v"), 2).alias("eigenvalue"), F.round(F.col("v") / whole, 6).alias("share"),
        F.round("low", 6).alias("low"), F.round("high", 6).alias("high"))


@register("kmeans_train")
def q_kmeans_train(spark, sf_dir):
    """Per cluster: has members, and its centre is their mean (up to the
    distance at which the fit stops)."""
    train, model = fitted(spark, sf_dir)
    centres = F.array(*[F.array(*map(F.lit, c)) for c in cluster.centers(model)])
    near = cluster.lloyd_tolerance(model.transform(train).select("__scaled"), 1e-4, N_CLUSTERS, 2) + 1e-9
    rows = (cluster.pca_projection(model, train)
            .join(cluster.predict(model, train).select("CustomerID", "Clusters"), "CustomerID"))
    means = rows.groupBy("Clusters").agg(F.avg("s1").alias("m1"), F.avg("s2").alias("m2"))
    centre = F.get(centres, F.col("Clusters"))
    gap = F.sqrt(F.pow(F.col("m1") - centre[0], 2) + F.pow(F.col("m2") - centre[1], 2))
    return means.select(F.col("Clusters").alias("cluster"), (gap <= near).alias("centre_is_mean"))


def _labelled(model, train, labels):
    """Whether each customer's label is its nearest centre's."""
    near = cluster.nearest_center(["s1", "s2"], cluster.centers(model))
    rows = cluster.pca_projection(model, train).join(labels.select("CustomerID", "Clusters"), "CustomerID")
    return rows.select("CustomerID", *MODEL_FEATURES, (F.col("Clusters") == near).alias("label_is_nearest"))


@register("batch_predict")
def q_batch_predict(spark, sf_dir):
    train, model = fitted(spark, sf_dir)
    return _labelled(model, train, cluster.predict(model, train))


@register("model_reload")
def q_model_reload(spark, sf_dir):
    train, model = fitted(spark, sf_dir)
    path = scratch_path(spark, "model")
    cluster.save_model(model, path)
    again = cluster.predict(cluster.load_model(path), train).select("CustomerID", F.col("Clusters").alias("again"))
    return cluster.predict(model, train).join(again, "CustomerID").select(
        "CustomerID", (F.col("Clusters") == F.col("again")).alias("same_after_reload"))


# ---- forecasting ----------------------------------------------------------
from ..operators import anomalies as anom  # noqa: E402
from ..operators import forecast as fcst  # noqa: E402

SERIES_KEYS = ("Country",)


def daily_series(spark, sf_dir, keys=SERIES_KEYS):
    """Gapless daily series over all dates. Bounded by days x series, and
    read by both the order search and the forecast, so it is checkpointed once
    in the shared folder instead of being derived twice from the input tables."""
    daily = features.daily_quantity(curated(spark, sf_dir), keys=keys)
    shared_dir(spark)
    return fcst.fill_calendar(daily, keys).checkpoint(eager=True)


def _rounded(df, places, cols):
    return df.withColumns({c: F.round(c, places) for c in cols})


def _filled(spark, sf_dir, keys):
    return _rounded(daily_series(spark, sf_dir, keys), 6, ["Quantity"])


@register("fill_calendar")
def q_fill_calendar(spark, sf_dir):
    return _filled(spark, sf_dir, SERIES_KEYS)


@register("fill_calendar_total")
def q_fill_calendar_total(spark, sf_dir):
    return _filled(spark, sf_dir, ())


def _decomposed(spark, sf_dir, keys):
    d = fcst.decompose(daily_series(spark, sf_dir, keys), keys, period=7)
    return _rounded(d.select(*keys, "InvoiceDate", "Quantity", "trend", "seasonal", "residual"), 6,
                    ["Quantity", "trend", "seasonal", "residual"])


@register("decompose")
def q_decompose(spark, sf_dir):
    return _decomposed(spark, sf_dir, SERIES_KEYS)


@register("decompose_total")
def q_decompose_total(spark, sf_dir):
    return _decomposed(spark, sf_dir, ())


@register("seasonal_trend")
def q_seasonal_trend(spark, sf_dir):
    parts = fcst.seasonal_trend(daily_series(spark, sf_dir), SERIES_KEYS, period=7)
    return _rounded(parts, 5, ["Quantity", "trend", "seasonal", "residual"])


@register("series_anomalies")
def q_series_anomalies(spark, sf_dir):
    parts = fcst.seasonal_trend(daily_series(spark, sf_dir), SERIES_KEYS, period=7)
    return _rounded(anom.anomalies(parts, SERIES_KEYS), 5, ["Quantity", "cleaned", "steady"])


def _model_rows(df):
    ar = {f"ar{i + 1}": F.round(F.get("ar_coefficients", F.lit(i)), 6) for i in range(fcst.MAX_ORDER)}
    ma = {f"ma{i + 1}": F.round(F.get("ma_coefficients", F.lit(i)), 6) for i in range(fcst.arma.MAX_Q)}
    df = _rounded(_rounded(df, 4, ["log_likelihood", "AIC", "variance"]), 6, ["intercept_or_drift"])
    return df.withColumns(ar | ma).drop("ar_coefficients", "ma_coefficients", "last_shocks")


def _model(spark, sf_dir, keys=SERIES_KEYS):
    """The series with its weekly season, and the model of the rest."""
    parts = fcst.seasonal_trend(daily_series(spark, sf_dir, keys), keys, period=7).checkpoint(eager=True)
    return parts, fcst.fit_arima(fcst.adjusted(parts, keys), keys)


@register("arima_evaluate")
def q_arima_evaluate(spark, sf_dir):
    s = daily_series(spark, sf_dir)
    parts = fcst.seasonal_trend(s, SERIES_KEYS, period=7)
    flags = anom.flags(anom.anomalies(parts, SERIES_KEYS), SERIES_KEYS)
    return _model_rows(fcst.arima_evaluate(s, SERIES_KEYS, flags=flags))


@register("arima_fit")
def q_arima_fit(spark, sf_dir):
    return _model_rows(fcst.fit_arima(daily_series(spark, sf_dir), SERIES_KEYS))


@register("arima_fit_seasonal")
def q_arima_fit_seasonal(spark, sf_dir):
    return _model_rows(_model(spark, sf_dir)[1])


_BOUNDS = ["standard_error", "prediction_interval_lower_bound", "prediction_interval_upper_bound"]


def _forecast(spark, sf_dir, keys):
    s, m = _model(spark, sf_dir, keys)
    return _rounded(fcst.forecast(s, m, keys, horizon=10, level=0.8), 4, ["forecast_value", *_BOUNDS])


@register("forecast")
def q_forecast(spark, sf_dir):
    return _forecast(spark, sf_dir, SERIES_KEYS)


@register("forecast_total")
def q_forecast_total(spark, sf_dir):
    return _forecast(spark, sf_dir, ())


@register("explain_forecast")
def q_explain_forecast(spark, sf_dir):
    s, m = _model(spark, sf_dir)
    return _rounded(fcst.explain_forecast(s, m, SERIES_KEYS, horizon=30, level=0.8), 4,
                    ["time_series_data", "trend", "seasonal", "residual", *_BOUNDS])


# ---- streaming ------------------------------------------------------------
from ..streaming import start_refresh_stream  # noqa: E402


@register("stream_build")
def q_stream_build(spark, sf_dir):
    """Raw lines land as files; one availableNow run of the refresh stream
    curates them and builds the feature table (no table existed yet)."""
    root = scratch_path(spark, "stream")
    raw(spark, sf_dir).write.parquet(f"{root}/landing")
    q = start_refresh_stream(spark, f"{root}/landing", f"{root}/curated", f"{root}/table",
                             f"{root}/checkpoint", at=T0, key="hash")
    q.awaitTermination()
    return _report(VersionedTable(spark, f"{root}/table").read())
