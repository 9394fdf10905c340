"""Duplicate records."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import norm_title
from .integrity import diverging
from .layout import UPLOAD_ARTIFACT
from .ranking import first_names, running


def _having(records: DataFrame, key: str, titles: bool) -> DataFrame:
    rule = (F.col("n") >= 2) & (F.col("parents") >= 2)
    if titles:
        rule &= F.col("titles") >= 2
    aggs = [F.count("*").alias("n"), F.countDistinct("parent").alias("parents")] + ([F.countDistinct("title_key").alias("titles")] if titles else [])
    return records.groupBy(key).agg(*aggs).where(rule).select(key)


def duplicate_groups(records: DataFrame) -> DataFrame:
    """(id, parent, key, title) -> members of groups: equal titles (never empty ones), or one key under different
    titles; of different parents, as versions of one record are no duplicates."""
    keyed = records.withColumn("title_key", norm_title("title"))
    titled = keyed.where(F.col("title_key") != "")
    same = titled.join(_having(titled, "title_key", False), "title_key", "left_semi").select("id", F.lit("title").alias("type"), F.col("title_key").alias("group_key"))
    by_key = keyed.where(F.col("key").isNotNull())
    one = by_key.join(_having(by_key, "key", True), "key", "left_semi").select("id", F.lit("key").alias("type"), F.col("key").alias("group_key"))
    return same.unionByName(one)


def number_groups(members: DataFrame) -> DataFrame:
    """(id, type, group_key, created) -> group number, titles first, and the member's number by creation. Groups are
    numbered by ranges of their keys; members find theirs by a join."""
    groups = members.select("type", "group_key").distinct()
    rank = F.when(F.col("type") == "title", 0).otherwise(1)
    numbered = running(groups, [], [rank, F.col("group_key")], "group_no")
    member = F.row_number().over(Window.partitionBy("type", "group_key").orderBy("created", "id"))
    return members.join(numbered, ["type", "group_key"]).select("id", "type", F.col("group_no").cast("int").alias("group_no"), member.alias("member_no"))


def several_drafts(drafts: DataFrame, sample: int = 10) -> DataFrame:
    """(id, key) -> every draft of a key that has several, with their count and the first ``sample`` other ids, in order."""
    held = first_names(drafts, ["key"], sample + 1, "id").where(F.col("n_names") > 1)
    others = F.slice(F.filter("names", lambda x: x != F.col("id")), 1, sample)
    return drafts.join(held, "key").select("id", "key", F.col("n_names").alias("n"), F.array_join(others.cast("array<string>"), ", ").alias("others"))


def find_twin(folders: DataFrame, candidates: DataFrame) -> DataFrame:
    """(key) x (key, place, has_sentinel, priority) -> the twin: with a sentinel first, then by priority."""
    best = F.min_by("place", F.struct((~F.col("has_sentinel")).alias("s"), "priority", "place"))
    return folders.select("key").distinct().join(candidates.groupBy("key").agg(best.alias("twin")), "key", "left")


def leftover_facts(leftovers: DataFrame, candidates: DataFrame, files: DataFrame) -> DataFrame:
    """(key, place) of folders that were left behind, (key, place, has_sentinel, priority, uploaded) of folders that could be their twins and
    (place, name, digest) of the files of both -> the facts by leftover: its twin (J14), archives on both sides and their digests, and
    how many upload artifacts the twin lacks or holds with another content (J17)."""
    about = candidates.select(F.col("place").alias("twin"), F.col("has_sentinel").alias("twin_sentinel"), F.col("uploaded").alias("twin_uploaded")).dropDuplicates(["twin"])
    rows = leftovers.select("key", "place").join(find_twin(leftovers, candidates), "key").join(about, "twin", "left")
    zips = files.where(F.lower("name").endswith(".zip")).groupBy("place").agg(F.count("*").alias("n"), F.max("digest").alias("d"))
    artifacts = files.where(F.col("name").rlike(UPLOAD_ARTIFACT)).select("place", "name", "digest")
    ours = rows.select("place").join(artifacts, "place").select(F.col("place").alias("site"), "name", "digest")
    theirs = rows.select(F.col("place").alias("site"), F.col("twin").alias("place")).join(artifacts, "place").select("site", "name", "digest")
    odd = diverging(ours, theirs).groupBy(F.col("site").alias("place")).agg(F.count("*").alias("n_diverging"))
    own = zips.select("place", F.col("n").alias("n_archives"), F.col("d").alias("digest"))
    twins = zips.select(F.col("place").alias("twin"), F.col("n").alias("n_twin_archives"), F.col("d").alias("twin_digest"))
    return rows.join(own, "place", "left").join(twins, "twin", "left").join(odd, "place", "left").fillna(0, ["n_archives", "n_twin_archives", "n_diverging"])


def title_matches(wanted: DataFrame, records: DataFrame) -> DataFrame:
    """(id, title) x (title, draft) -> how many drafts and published records carry each title."""
    found = records.groupBy(norm_title("title").alias("t")).agg(F.count_if("draft").alias("drafts"), F.count_if(~F.col("draft")).alias("published"))
    return wanted.withColumn("t", norm_title("title")).join(found, "t", "left").select("id", F.coalesce("drafts", F.lit(0)).alias("drafts"), F.coalesce("published", F.lit(0)).alias("published"))
