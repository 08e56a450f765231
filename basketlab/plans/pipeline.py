"""The end-to-end job, as one Spark application (replaces the container DAG).

Steps, in the reference's order:
  get_data             raw -> curated table (date-partitioned)
  data_preparation     curated -> filtered (and, if asked for, purchases / returns) tables
  feature_engineering  full build or, when the table exists, daily refresh
  create_feature_store register features, ingest the feature table
  batch_serve          read instances -> as-of served training set table
  model_train          PCA -> min-max -> k-means pipeline, saved
  batch_prediction     load model, score the training set, write predictions

Every hand-off is a table under ``conf.root`` (a shared path), so any step
can be re-run after a failure without recomputing the ones before it.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..operators import clean, cluster, features, prepare, store
from ..schemas import CURATED, ENTITY_COL, MODEL_FEATURES, MODEL_TARGET, N_CLUSTERS, SEED
from ..sources import tables
from ..sources.versioned import VersionedTable


@dataclass
class Conf:
    root: str                       # shared folder for all tables of the job
    as_of: object = None            # "today" (date); None = current date
    at: object = None               # feature time; None = current timestamp
    key: str = "uuid"               # entity key kind: uuid | hash
    refresh_mode: str = "append"    # append | upsert
    rules: clean.Rules = field(default_factory=clean.Rules)
    n_init: int = 1
    fit_parallelism: int = 1        # concurrent k-means fits when n_init > 1
    stable_labels: bool = False     # number clusters by centre order
    k: int = N_CLUSTERS
    seed: int = SEED
    fit_partitions: int = cluster.FIT_PARTITIONS
    write_splits: bool = False      # also write the purchases and returns tables
    keep_versions: int | None = 7   # feature-table versions that stay

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"


def get_data(spark: SparkSession, raw: DataFrame, conf: Conf) -> None:
    tables.write_partitioned(clean.curate(raw, conf.as_of, conf.rules), conf.path("curated"))


def data_preparation(spark: SparkSession, conf: Conf) -> None:
    cur = tables.read_until(tables.read_table(spark, conf.path("curated"), CURATED),
                            "InvoiceDate", conf.as_of)
    # Curated rows have a finite customer, so the cast needs no checking pass.
    f, p, _ = prepare.prepare(cur, trusted=True)
    tables.write_table(f, conf.path("filtered"), "replace")
    if conf.write_splits:
        # No later step reads these two; the filtered table has all their rows.
        tables.write_table(p, conf.path("purchases"), "replace")
        tables.write_table(prepare.returns(tables.read_table(spark, conf.path("filtered"))),
                           conf.path("returns"), "replace")


def feature_engineering(spark: SparkSession, raw: DataFrame, conf: Conf) -> str:
    """Full build if the feature table is absent, else refresh for the
    customers active on ``as_of``. Returns which branch ran."""
    # The filtered table holds every curated row (purchases, returns, rows
    # without quantity) with all columns the fused aggregation reads.
    typed = tables.read_until(tables.read_table(spark, conf.path("filtered")),
                              "InvoiceDate", conf.as_of)
    prepare.require(typed, features.FEATURE_INPUT, "filtered", non_empty=True)
    prepare.require(prepare.purchases(typed), (), "purchases", non_empty=True)
    vt = VersionedTable(spark, conf.path("feature_table"), keep=conf.keep_versions)
    if not vt.exists():
        store.build_feature_table(vt, typed, conf.at, conf.key)
        return "build"
    day = conf.as_of if conf.as_of is not None else store.today()
    store.refresh_features(vt, typed, raw, day, conf.at, conf.key, conf.refresh_mode)
    return "refresh"


def create_feature_store(spark: SparkSession, conf: Conf, ingest_date=None) -> store.FeatureStore:
    fs = store.FeatureStore(spark, conf.path("feature_store")).get_or_create()
    fs.register()
    vt = VersionedTable(spark, conf.path("feature_table"))
    # One ingest batch per feature-table version, of the rows that changed: a
    # re-run replaces it.
    fs.ingest_version(vt, ingest_date=ingest_date)
    return fs


def batch_serve(spark: SparkSession, conf: Conf) -> None:
    fs = store.FeatureStore(spark, conf.path("feature_store"))
    vt = VersionedTable(spark, conf.path("feature_table"))
    inst = store.read_instances(vt.read())
    tables.write_table(inst, conf.path("read_instances"), "replace")
    train = fs.serve(tables.read_table(spark, conf.path("read_instances")), "*")
    tables.write_table(train, conf.path("train"), "replace")


def model_train(spark: SparkSession, conf: Conf):
    train = tables.read_table(spark, conf.path("train"))
    # Ordered by the entity key: refitting on the same table gives the same model.
    model = cluster.fit(train, MODEL_FEATURES, conf.k, conf.seed, conf.n_init, target=MODEL_TARGET,
                        order_by=[ENTITY_COL], parallelism=conf.fit_parallelism,
                        fit_partitions=conf.fit_partitions)
    cluster.save_model(model, conf.path("model"))
    return model


def batch_prediction(spark: SparkSession, conf: Conf) -> None:
    model = cluster.load_model(conf.path("model"))
    train = tables.read_table(spark, conf.path("train"))
    tables.write_table(cluster.predict(model, train, conf.stable_labels),
                       conf.path("predictions"), "replace")


def run(spark: SparkSession, raw: DataFrame, conf: Conf) -> dict:
    """Run all steps; returns a small report (branch taken, table paths)."""
    get_data(spark, raw, conf)
    data_preparation(spark, conf)
    branch = feature_engineering(spark, raw, conf)
    create_feature_store(spark, conf)
    batch_serve(spark, conf)
    model_train(spark, conf)
    batch_prediction(spark, conf)
    return {"feature_engineering": branch, "predictions": conf.path("predictions")}
