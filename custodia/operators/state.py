"""Restartable state: checksum caches, attempts, done-sets, logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.common import col


def last_wins(rows: DataFrame, keys: list[str], order: str, first: bool = False) -> DataFrame:
    """One row for each key: the last by ``order`` (or the first). ``order`` must be a total order. One aggregation, so
    repeated keys are reduced before they are shuffled."""
    rest = [c for c in rows.columns if c not in keys]
    pick = F.min_by if first else F.max_by
    return rows.groupBy(*keys).agg(pick(F.struct(*rest), order).alias("_r")).select(*keys, *(F.col(f"_r.{c}").alias(c) for c in rest)).select(*rows.columns)


def last_lines(lines: DataFrame, n: int = 5) -> DataFrame:
    """(key, line_no, line) -> the last ``n`` of each key."""
    w = Window.partitionBy("key").orderBy(F.desc("line_no"))
    return lines.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= n).drop("_n")


def cache_status(inventory: DataFrame, cache: DataFrame, recheck: bool = False) -> DataFrame:
    """(site, name, bytes, mtime) x (site, name, bytes, mtime_s, sha512, md5) -> what to do with each file: reused,
    md5_backfill or hashed; and missing for cached rows without a file, which are kept."""
    seconds = F.floor(F.unix_micros(F.col("mtime").cast("timestamp")) / 1_000_000).cast("long")
    now = inventory.select("site", "name", "bytes", seconds.alias("mtime_s"), F.lit(True).alias("_here"))
    old = cache.select("site", "name", F.col("bytes").alias("_b"), F.col("mtime_s").alias("_m"), "sha512", "md5")
    same = (F.col("bytes") == F.col("_b")) & (F.col("mtime_s") == F.col("_m")) & F.lit(not recheck)
    status = F.when(F.col("_here").isNull(), "missing").when(F.coalesce(same, F.lit(False)), F.when(F.col("md5").isNull(), "md5_backfill").otherwise("reused")).otherwise("hashed")
    return now.join(old, ["site", "name"], "full_outer").select("site", "name", F.coalesce("bytes", "_b").alias("bytes"), F.coalesce("mtime_s", "_m").alias("mtime_s"), "sha512", "md5", status.alias("status"))


def refresh_cache(status: DataFrame, fresh: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(new cache, disagreements). ``fresh``: site, name, sha512, md5 of the files that were hashed; a file that could not be
    read has no row and loses its place. A backfilled digest that disagrees is reported and the fresh one serves."""
    kept = status.where("status in ('reused', 'missing')").select("site", "name", "bytes", "mtime_s", "sha512", "md5")
    due = status.where("status in ('hashed', 'md5_backfill')").select("site", "name", "bytes", "mtime_s", "status", F.col("sha512").alias("_old"))
    done = due.join(fresh, ["site", "name"])
    odd = done.where((F.col("status") == "md5_backfill") & (F.col("_old") != F.col("sha512"))).select("site", "name", F.col("_old").alias("cached"), F.col("sha512").alias("fresh"))
    return kept.unionByName(done.select("site", "name", "bytes", "mtime_s", "sha512", "md5")), odd


def write_cache(cache: DataFrame, path: str) -> None:
    """One folder for each site; only the sites in ``cache`` are replaced."""
    cache.repartition("site").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("site").parquet(path)


def merge_attempts(state: DataFrame, attempts: DataFrame) -> DataFrame:
    """(site, doc: map) x (site, at, record_id) -> the new documents: unknown keys stay, managed ones are replaced, and
    tries grow by the number of attempts (a column ``tries`` says how many a row stands for) from what was a number above 0."""
    count = F.sum("tries") if "tries" in attempts.columns else F.count("*")
    new = attempts.groupBy("site").agg(count.alias("n"), F.max_by("record_id", F.struct("at", "record_id")).alias("record_id"), F.max("at").alias("at"))
    tries = F.greatest(F.coalesce(F.try_element_at("doc", F.lit("number_of_tries")).try_cast("int"), F.lit(0)), F.lit(0)) + F.coalesce("n", F.lit(0))
    managed = F.create_map(F.lit("record_id"), F.col("record_id"), F.lit("updated"), F.col("at").cast("string"), F.lit("number_of_tries"), tries.cast("string"))
    old = F.map_filter(F.coalesce("doc", F.create_map().cast("map<string,string>")), lambda k, _: ~k.isin("record_id", "updated", "number_of_tries"))
    return state.join(new, "site", "full_outer").select("site", F.when(F.col("n").isNull(), F.col("doc")).otherwise(F.map_concat(old, managed)).alias("doc"))


def recovery_plan(sites: DataFrame, state: DataFrame, recovered: DataFrame) -> DataFrame:
    """(site) x (site, record_id) x (site, record_id) -> states to write, and refusals where another id exists."""
    have = state.select("site", F.col("record_id").alias("_have"))
    rows = sites.select("site").distinct().join(recovered.select("site", "record_id"), "site").join(have, "site", "left")
    action = F.when(F.col("_have").isNull(), "write").when(F.col("_have") != F.col("record_id"), "refuse").otherwise("present")
    return rows.select("site", "record_id", action.alias("action"))


def sentinel_backfill(verdicts: DataFrame) -> DataFrame:
    """(site, verdict, sentinel) -> sites whose completeness is sure and that lack the sentinel."""
    return verdicts.where((F.col("verdict") == "Yes") & ~F.col("sentinel")).select("site")


def done_bucket(path: Column | str) -> Column:
    """One of 256 parts of a done-set, by a hash of the path."""
    return F.substring(F.md5(col(path)), 1, 2)


def new_done(done: DataFrame, finished: DataFrame) -> DataFrame:
    """(path) of both -> what to append; appending it again appends nothing."""
    return finished.select("path").distinct().join(done.select("path"), "path", "left_anti")
