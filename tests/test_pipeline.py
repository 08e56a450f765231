"""The whole job on sf0.001: full build, then a refresh run."""

from basketlab import fixtures
from basketlab.plans import pipeline
from basketlab.session import scratch_path


def test_pipeline_build_then_refresh(spark):
    raw = fixtures.raw_invoices(spark, "/root/testdata/sf0.001")
    conf = pipeline.Conf(root=scratch_path(spark, "t-pipe"), as_of="1998-07-20", key="hash")
    assert pipeline.run(spark, raw, conf)["feature_engineering"] == "build"
    n1 = spark.read.parquet(conf.path("predictions")).count()
    conf.as_of = "1998-07-21"
    assert pipeline.run(spark, raw, conf)["feature_engineering"] == "refresh"
    pred = spark.read.parquet(conf.path("predictions"))
    assert pred.count() >= n1
    assert set(pred.columns) >= {"values", "timestamp", "qty_products", "Clusters"}
    assert pred.where("Clusters is null").count() == 0
    assert pred.select("Clusters").distinct().count() <= 8


def test_returns_table_equals_curated_returns(spark):
    from basketlab.operators import prepare
    from basketlab.sources import tables
    from basketlab.schemas import CURATED
    raw = fixtures.raw_invoices(spark, "/root/testdata/sf0.001")
    conf = pipeline.Conf(root=scratch_path(spark, "t-prep"), as_of="1998-07-20", write_splits=True)
    pipeline.get_data(spark, raw, conf)
    pipeline.data_preparation(spark, conf)
    cur = tables.read_until(tables.read_table(spark, conf.path("curated"), CURATED),
                            "InvoiceDate", conf.as_of)
    want = prepare.prepare(cur)[2]
    got = spark.read.parquet(conf.path("returns"))
    assert got.columns == want.columns and got.count() > 0
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_ingest_step_rerun_does_not_duplicate(spark):
    from basketlab.sources.versioned import VersionedTable
    raw = fixtures.raw_invoices(spark, "/root/testdata/sf0.001")
    conf = pipeline.Conf(root=scratch_path(spark, "t-rerun"), as_of="1998-07-20", key="hash")
    pipeline.get_data(spark, raw, conf)
    pipeline.data_preparation(spark, conf)
    assert pipeline.feature_engineering(spark, raw, conf) == "build"
    n = VersionedTable(spark, conf.path("feature_table")).read().count()
    fs = pipeline.create_feature_store(spark, conf, ingest_date="2024-01-01")
    pipeline.create_feature_store(spark, conf, ingest_date="2024-01-01")   # step re-run
    assert n > 0 and fs.log().count() == n


def test_three_days_log_each_stamp_once(spark):
    from basketlab.sources.versioned import VersionedTable
    raw = fixtures.raw_invoices(spark, "/root/testdata/sf0.001")
    days = [str(r[0]) for r in raw.select("InvoiceDate").distinct().orderBy("InvoiceDate").collect()[-3:]]
    conf = pipeline.Conf(root=scratch_path(spark, "t-days"), key="hash", keep_versions=2)
    stamps = set()
    for i, day in enumerate(days):
        conf.as_of, conf.at = day, f"2024-01-0{i + 1}"
        pipeline.get_data(spark, raw, conf)
        pipeline.data_preparation(spark, conf)
        pipeline.feature_engineering(spark, raw, conf)
        fs = pipeline.create_feature_store(spark, conf, ingest_date=conf.at)
        table = VersionedTable(spark, conf.path("feature_table")).read()
        stamps |= {(r["values"], r["timestamp"]) for r in table.collect()}
        log = fs.log()
        assert log.count() == len(stamps) == log.select("values", "timestamp").distinct().count()
    assert VersionedTable(spark, conf.path("feature_table")).committed() == [3, 2]
    served = fs.serve(table.select("values", "timestamp"))
    assert served.where("qty_products IS NULL").count() == 0 and served.count() == table.count()


def test_empty_input_is_refused(spark):
    import pytest
    raw = fixtures.raw_invoices(spark, "/root/testdata/sf0.001")
    conf = pipeline.Conf(root=scratch_path(spark, "t-empty"), as_of="1901-01-01")
    pipeline.get_data(spark, raw, conf)
    pipeline.data_preparation(spark, conf)
    with pytest.raises(ValueError, match="filtered has no rows"):
        pipeline.feature_engineering(spark, raw, conf)
