"""Spark-native analytics for abuse detection and root-cause analysis."""

from tracewell.session import prepare, shared_dir

__all__ = ["prepare", "shared_dir"]
