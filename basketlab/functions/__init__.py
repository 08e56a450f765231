from .casts import column_to_date, column_to_int, normalise_types
from .scalar import guarded_divide, nan_to_null, nan_to_null_all, whole_days

__all__ = ["column_to_int", "column_to_date", "normalise_types",
           "guarded_divide", "nan_to_null", "nan_to_null_all", "whole_days"]
