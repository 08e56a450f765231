"""Plan inspection: the checks used when reviewing a query for scale."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

# Physical operators that pair every row of one side with every row of the other.
PAIRWISE = ("CartesianProduct", "BroadcastNestedLoopJoin")
PYTHON = ("FlatMapGroupsInPandas", "MapInPandas", "ArrowEvalPython", "BatchEvalPython")


def physical(df: DataFrame) -> str:
    """Physical plan text (the initial plan; AQE may later swap join kinds
    from runtime sizes)."""
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df: DataFrame) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def summary(df: DataFrame) -> dict:
    p = physical(df)
    return {
        "hash_exchanges": len(re.findall(r"Exchange hashpartitioning", p)),
        "range_exchanges": len(re.findall(r"Exchange rangepartitioning", p)),
        "broadcasts": p.count("BroadcastExchange"),
        "pairwise_joins": sum(p.count(x) for x in PAIRWISE),
        "python_nodes": sum(p.count(x) for x in PYTHON),
        "pushed_filters": re.findall(r"PushedFilters: \[([^\]]*)\]", p),
        "scans": len(re.findall(r"FileScan parquet", p)),
    }
