"""Retail customer segmentation as Spark jobs.

Sub-packages:
  sources    reading / writing tables, versioned tables, SQL entry point
  functions  column-level helpers (casts, guarded arithmetic, NaN rules)
  operators  relational and ML operators (cleaning, features, as-of join,
             feature store, clustering, forecasting)
  plans      the end-to-end job and plan-inspection helpers
  streaming  incremental (file-triggered) driver for the daily refresh
"""

__all__ = ["session", "schemas", "fixtures"]
