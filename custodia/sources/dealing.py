"""Files dealt to tasks by their bytes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import running

#: What opening a file counts, in bytes: a task of many small files is as long as one of a large file.
OPEN_COST = 4 << 20
#: Bytes that a task should read, if files allow it.
TASK_BYTES = 1 << 30


def deal_by_bytes(files: DataFrame, tasks: int | None = None, open_cost: int = OPEN_COST) -> DataFrame:
    """The rows of ``files`` (with ``bytes``; null counts as 0) on ``tasks`` partitions, the largest files first. Weights (bytes and the
    cost of opening) are laid end to end in that order and cut in equal pieces; a file belongs to the piece in which it begins. So
    a task has at most the mean and one file more, whatever the sizes. Places are counted by ranges, no task or driver sees all files."""
    spark = files.sparkSession
    weighed = files.withColumn("_weight", F.coalesce(F.col("bytes").cast("long"), F.lit(0)) + F.lit(open_cost).cast("long"))
    total = weighed.agg(F.sum(F.col("_weight").cast("decimal(38,0)"))).first()[0] or 0
    n = tasks or max(spark.sparkContext.defaultParallelism, min(1 << 20, int(total // TASK_BYTES)))
    names = [F.col("`{}`".format(c.replace("`", "``"))) for c in files.columns]
    placed = running(weighed, [], [-F.col("_weight"), *names], "_k", {"_before": "_weight"})
    task = F.least(F.floor(F.col("_before") / (float(total) / n)).cast("int"), F.lit(n - 1)) if total else F.lit(0)
    return placed.repartitionById(n, task).select(*names)
