"""Scale review as tests: plan shapes of the registered queries."""

import pytest

from basketlab.operators import features
from basketlab.plans import inspect, queries

SF = "/root/testdata/sf0.001"


def test_cleaning_filters_reach_the_scan(spark):
    s = inspect.summary(queries.curated(spark, SF))
    assert any("o_orderdate" in f for f in s["pushed_filters"])


def test_fused_features_two_aggregation_shuffles(spark):
    typed = queries.typed(spark, SF)
    # level1 + level2 of the fused form, before the checkpoint cuts lineage
    level = typed.groupBy("CustomerID", "InvoiceNo", "InvoiceDate").count() \
                 .groupBy("CustomerID").count()
    assert inspect.summary(level)["hash_exchanges"] == 2
    out = features.customer_features(typed)
    assert "Scan ExistingRDD" in inspect.physical(out)     # reads the checkpoint


def test_column_pruning(spark):
    p = inspect.physical(queries.q_qty_returns(spark, SF))
    ls = [l for l in p.splitlines() if "lineitem" in l and "ReadSchema" in l]
    assert ls and "l_extendedprice" not in ls[0] and "l_shipdate" not in ls[0]


def test_asof_reads_its_sliced_keys_once(spark):
    s = inspect.summary(queries.q_asof_serve(spark, SF))
    # range slicing (with its sample) ran once, inside the checkpoint job;
    # the final plan reads the checkpointed keys and each side at most twice
    assert s["range_exchanges"] == 0
    assert s["scans"] <= 2
