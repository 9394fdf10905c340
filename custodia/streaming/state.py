"""Streaming forms of the incremental operators. Each batch of a stream goes through the batch operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.state import cache_status, done_bucket, new_done, refresh_cache, write_cache


def attempts(events: DataFrame, late: str = "1 day") -> DataFrame:
    """(site, at, record_id) -> tries and latest record of each site and day, as the day ends: a day that the watermark has
    passed is given out once and forgotten, and attempts that come later are dropped, so state holds the open days only. Batches
    of this go through ``merge_attempts``, which adds the tries up."""
    return events.withWatermark("at", late).groupBy(F.window("at", "1 day"), "site").agg(F.count("*").alias("tries"), F.max_by("record_id", F.struct("at", "record_id")).alias("record_id"))


def attempts_by_window(events: DataFrame, width: str = "1 hour", late: str = "1 day") -> DataFrame:
    """Tries of each site and window; a window is final when the watermark has passed it."""
    return events.withWatermark("at", late).groupBy(F.window("at", width), "site").agg(F.count("*").alias("tries"))


def done_stream(paths: DataFrame) -> DataFrame:
    """(path, at): each path once."""
    return paths.withWatermark("at", "7 days").dropDuplicatesWithinWatermark(["path"])


def append_done(paths: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Appends paths that the done-set at ``target`` lacks; a batch that runs again appends nothing. The set lies in parts by a hash of
    the path, and a batch reads the parts that its own paths belong to."""

    def batch(df: DataFrame, _: int) -> None:
        new = df.select("path", done_bucket("path").alias("bucket")).distinct().persist()
        parts = [r["bucket"] for r in new.select("bucket").distinct().collect()]
        held = done_parts(df.sparkSession, target, parts)
        new_done(held, new).withColumn("bucket", done_bucket("path")).write.mode("append").partitionBy("bucket").parquet(target)
        new.unpersist()

    return paths.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def done_parts(spark: SparkSession, target: str, buckets: list[str]) -> DataFrame:
    """The paths of some parts of a done-set; files of others are not read."""
    return _read(spark, target, "path string, bucket string").where(F.col("bucket").isin(buckets)).select("path")


def refresh_stream(inventory: DataFrame, hash_files, target: str, checkpoint: str) -> StreamingQuery:
    """Each batch of inventory rows (site, name, bytes, mtime) refreshes the cache at ``target``; ``hash_files`` takes the rows
    that are due and returns site, name, sha512, md5. Only the sites of the batch are read and replaced."""

    def batch(df: DataFrame, _: int) -> None:
        cache = _read(df.sparkSession, target, "site string, name string, bytes long, mtime_s long, sha512 string, md5 string")
        own = cache.join(df.select("site").distinct(), "site", "left_semi")
        status = cache_status(df, own).persist()
        new, _odd = refresh_cache(status, hash_files(status.where("status in ('hashed', 'md5_backfill')")))
        write_cache(new, target)
        status.unpersist()

    return inventory.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    from pyspark.errors import AnalysisException

    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)
