"""Checks of user-given patterns before they reach a plan."""

from __future__ import annotations

from pyspark.sql import SparkSession


def pattern_error(spark: SparkSession, pattern) -> str | None:
    """Why ``pattern`` is not a regular expression for Spark; None when it is one."""
    if not isinstance(pattern, str):
        return f"the pattern is a {type(pattern).__name__}"
    try:
        spark.sparkContext._jvm.java.util.regex.Pattern.compile(pattern)
    except Exception as exc:  # noqa: BLE001 - the JVM's error, reported with its description
        java = getattr(exc, "java_exception", None)
        return java.getDescription() if hasattr(java, "getDescription") else str(exc)
    return None
