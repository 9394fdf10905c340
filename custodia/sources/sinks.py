"""Reports and logs that are written."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_report(df: DataFrame, path: str, columns: list[str]) -> None:
    """The columns in their order, with a header; all or nothing."""
    df.select(*columns).write.mode("overwrite").csv(path, header=True, escape='"')


def append_results(df: DataFrame, path: str) -> None:
    """Results appended to the successes or the failures."""
    df.withColumn("outcome", F.when(F.col("success"), "success").otherwise("failure")).write.mode("append").partitionBy("outcome").parquet(path)
