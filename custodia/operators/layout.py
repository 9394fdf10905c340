"""How a site's items are laid out over archives and days, and what limits allow."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import items
from ..functions.common import col
from .ranking import first_names, names_text


def group_by_day(files: DataFrame, sample: int = 10) -> DataFrame:
    """A10: (site, name) -> site, day, n_items; a site with an undatable item gets one refused row that names the first ones."""
    dated = files.withColumn("day", items.day_key("name"))
    wrong = dated.where(F.col("day").isNull())
    named = first_names(wrong, ["site"], sample).select("site", names_text(F.col("names"), F.col("n_names")).alias("named"))
    bad = wrong.groupBy("site").agg(F.count("*").alias("n_items")).join(named, "site")
    good = dated.join(bad.select("site"), "site", "left_anti").groupBy("site", "day").agg(F.count("*").alias("n_items"))
    return good.select("site", "day", "n_items", F.lit(None).cast("string").alias("refused")).unionByName(
        bad.select("site", F.lit(None).cast("string").alias("day"), "n_items", F.concat(F.lit("undatable: "), F.col("named")).alias("refused"))
    )


def layout_mode(archives: DataFrame) -> DataFrame:
    """(site, name or NULL) -> site, mode: mixed, single, per_day or none."""
    daily = F.coalesce(F.col("name").rlike(r"_[0-9]{4}_[0-9]{2}_[0-9]{2}\.(?i:zip)$"), F.lit(False))
    plain = F.coalesce(F.lower("name").endswith(".zip"), F.lit(False)) & ~daily
    seen = archives.groupBy("site").agg(F.bool_or(daily).alias("d"), F.bool_or(plain).alias("p"))
    return seen.select("site", F.when(F.col("d") & F.col("p"), "mixed").when(F.col("p"), "single").when(F.col("d"), "per_day").otherwise("none").alias("mode"))


def file_cap(files: DataFrame, n_companions: int, generated: int = 3, conditional: int = 1, cap: int = 100) -> DataFrame:
    """(site, name) -> files a record would hold with one archive for each day, and whether the cap allows it."""
    days = files.groupBy("site").agg(F.countDistinct(items.day_key("name")).alias("days"))
    total = F.col("days") + n_companions + generated + conditional
    return days.select("site", total.alias("n_files"), (total <= cap).alias("allowed"))


def records_needed(raw: Column | str, companions: Column | str, most: int = 100) -> Column:
    """Records that hold all raw files when each also holds the companions; 0 if there is no room."""
    room = F.lit(most) - col(companions)
    return F.when(room <= 0, 0).otherwise(F.ceil(col(raw) / room)).cast("long")


def split_advice(needed: Column | str) -> Column:
    """A13"""
    n = col(needed)
    return F.when(n == 0, "no room beside the companions").when(n <= 2, "split into two").otherwise(F.concat(F.lit("split into "), n.cast("string"), F.lit(", more than the splitter makes")))


def ambiguous_keys(folders: DataFrame, sample: int = 10) -> DataFrame:
    """(key, folder) -> keys that several folders claim, how many and the first ``sample`` of them."""
    return first_names(folders, ["key"], sample, "folder").where(F.col("n_names") > 1).select("key", F.col("n_names").alias("n"), names_text(F.col("names"), F.col("n_names")).alias("folders"))


def blocking(files: DataFrame, sample: int = 10) -> DataFrame:
    """(site, name, bytes, mtime) -> items that keep an archive from being made: counts and the first names of each kind."""
    kinds = {"zero": F.col("bytes") == 0, "old": items.is_pre_1980("mtime")}
    marked = files.select("site", "name", F.explode(F.array_compact(F.array(*(F.when(c, k) for k, c in kinds.items())))).alias("kind"))
    named = first_names(marked, ["site", "kind"], sample).withColumn("text", names_text(F.col("names"), F.col("n_names")))
    named = named.groupBy("site").agg(*(F.max(F.when(F.col("kind") == k, F.col("text"))).alias(f"names_{k}") for k in kinds))
    counts = files.groupBy("site").agg(*(F.count_if(c).alias(f"n_{k}") for k, c in kinds.items()))
    return counts.join(named, "site", "left").fillna("", [f"names_{k}" for k in kinds])


def write_packed(files: DataFrame, path: str) -> None:
    """Items packed by site and day, one folder each; rows of a hot site spread over its days."""
    files.withColumn("day", items.day_key("name")).repartition("site", "day").write.mode("overwrite").partitionBy("site", "day").parquet(path)


def not_uploaded(files: DataFrame, inputs: list[str]) -> DataFrame:
    """Without metadata inputs, the read-me's source and archives."""
    low = F.lower("name")
    return files.where(~F.col("name").isin(*inputs) & (low != "readme.md") & ~low.endswith(".zip"))


#: Names that an upload leaves behind.
UPLOAD_ARTIFACT = r"(?i)(upload_state|_request_log|_metadata)[^/]*\.json$"


def copy_reason(name: Column | str, is_link: Column, is_dir: Column) -> Column:
    """Why a companion is not copied to the other half; NULL if it is."""
    n = col(name)
    return (
        F.when(is_link, "symlink").when(is_dir, "directory").when(n.startswith("."), "hidden").when(F.lower(n).endswith(".wav"), "item").when(F.lower(n).endswith(".zip"), "archive")
        .when(n.rlike(UPLOAD_ARTIFACT), "upload artifact")
    )


def mode_allows(mode: Column | str, layout: Column | str) -> Column:
    """File-by-file sites stay out unless their archives are per day."""
    return (F.coalesce(col(mode), F.lit("")) != "file_by_file") | (col(layout) == "per_day")


def upload_order(name: Column | str) -> list[Column]:
    """Read-me, companions, archives; by name."""
    low = F.lower(col(name))
    return [F.when(low.rlike(r"^readme\."), 0).when(low.endswith(".zip"), 2).otherwise(1), col(name)]
