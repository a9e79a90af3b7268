"""Queries over the driver's tables and the SQL they are checked against."""

from workload import bars_windows, datasets_models, joins_labels, quality_splits, streams
from workload.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES", "bars_windows", "datasets_models", "joins_labels", "quality_splits", "streams"]
