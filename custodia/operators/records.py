"""Landed record listings: two serialisations, two sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import like_capture, like_pattern
from ..functions.text import draft_flag, first_nonempty, iso_date, record_url


def normalize_records(pages: DataFrame, base: str = "https://records.example.org") -> DataFrame:
    """(source, doc: JSON text) -> typed rows; either serialisation. An empty text falls through like a missing one."""
    v = F.try_parse_json("doc")
    at = lambda path: F.try_variant_get(v, path, "string")
    flag = draft_flag(F.try_variant_get(v, "$.is_published", "boolean"), F.try_variant_get(v, "$.is_published", "variant").isNotNull(), at("$.status"), "source")
    rid = at("$.id")
    return pages.select(
        "source",
        rid.alias("id"),
        first_nonempty(at("$.parent.id"), at("$.conceptrecid")).alias("parent"),
        first_nonempty(at("$.pids.doi.identifier"), at("$.doi")).alias("doi"),
        F.coalesce(first_nonempty(at("$.metadata.title"), at("$.title")), F.lit("")).alias("title"),
        flag["draft"].alias("draft"),
        flag["error"].alias("error"),
        iso_date(at("$.created")).alias("created"),
        record_url(at("$.links.self_html"), flag["draft"], rid, base).alias("url"),
    )


def check_listing(pages: DataFrame) -> DataFrame:
    """(source, page, id, reported) -> by source: distinct rows, reported total, verdict."""
    one = pages.dropDuplicates(["source", "id"]).groupBy("source").agg(F.count("*").alias("n"))
    told = pages.groupBy("source").agg(F.min_by("reported", "page").alias("reported"), F.max("page").alias("pages"), F.count("*").alias("fetched"))
    verdict = F.when(F.col("reported").isNull(), "unknown").when(F.col("n") < F.col("reported"), "incomplete").when(F.col("n") > F.col("reported"), "more than reported").otherwise("complete")
    return told.join(one, "source").select("source", "n", "reported", "pages", (F.col("fetched") - F.col("n")).alias("repeated"), verdict.alias("verdict"))


def in_scope(records: DataFrame, any_of: list[str | tuple[str, int]], all_of: list[str]) -> DataFrame:
    """The key by any pattern, and every filter; what is left out stays as rows with in_scope false, to be counted."""
    passes: Column = F.lit(True)
    for p in all_of:
        passes = passes & F.col("title").rlike(like_pattern(p).replace("([0-9]{3})", ".*?"))
    key = like_capture("title", any_of)
    return records.withColumn("key", key).withColumn("in_scope", F.coalesce(F.col("key").isNotNull() & passes, F.lit(False)))


def merge_sources(community: DataFrame, account: DataFrame, policy: str) -> DataFrame:
    """(id, title, draft) of two listings, one row for each id. Policy "community": its row wins and the source says
    both. Policy "account": its row wins, and listings that disagree on draft give unknown and an error."""
    c = community.select("id", F.struct("title", "draft").alias("c"))
    a = account.select("id", F.struct("title", "draft").alias("a"))
    both = F.col("c").isNotNull() & F.col("a").isNotNull()
    rows = c.join(a, "id", "full_outer")
    source = F.when(both, "both").when(F.col("c").isNotNull(), "community").otherwise("account")
    first, second = ("c", "a") if policy == "community" else ("a", "c")
    won = F.coalesce(first, second)
    conflict = both & (F.col("c.draft") != F.col("a.draft")) if policy == "account" else F.lit(False)
    return rows.select("id", won["title"].alias("title"), F.when(~F.coalesce(conflict, F.lit(False)), won["draft"]).alias("draft"), source.alias("source"), F.when(conflict, "listings disagree").alias("error"))


def canary(candidates: DataFrame, order: list[Column], limit: int) -> DataFrame:
    """Of the actionable rows, in order, those beyond the limit are labelled skipped. Ids are unique, and ``order`` is total."""
    first = candidates.where("actionable").orderBy(*order).limit(limit).select("id", F.lit(True).alias("_first"))
    label = F.when(~F.col("actionable"), "not actionable").when(F.col("_first"), "planned").otherwise("skipped")
    return candidates.join(first, "id", "left").select("id", label.alias("label"))


def footer(records: DataFrame) -> DataFrame:
    """What a report's last lines count."""
    return records.agg(
        F.count_if("draft").alias("drafts"), F.count_if(~F.col("draft")).alias("published"), F.count_if(F.col("draft").isNull()).alias("unknown"), F.count_if(F.col("doi").isNull()).alias("without_doi"), F.count("error").alias("errors"),
    )


def group_footer(members: DataFrame, records: DataFrame) -> DataFrame:
    """Groups by type, records in them, and unpublished ones among those."""
    held = members.join(records.select("id", "draft"), "id")
    return held.groupBy("type").agg(
        F.countDistinct("group_key").alias("groups"), F.countDistinct("id").alias("records"), F.countDistinct(F.when(F.col("draft"), F.col("id"))).alias("unpublished")
    )


def report_order(key: str = "key", record_id: str = "id") -> list[Column]:
    """By key, then by number, then by the raw id."""
    return [F.substring(key, 1, 3).try_cast("int"), F.substring(key, 4, 1 << 20), F.coalesce(F.col(record_id).try_cast("long"), F.lit(0)), F.col(record_id)]


def candidate_order(key: str = "key", record_id: str = "id") -> list[Column]:
    """By key, candidates without one last."""
    return [F.coalesce(F.substring(key, 1, 3).try_cast("int"), F.lit(999)), F.coalesce(F.substring(key, 4, 1 << 20), F.lit("")), F.col(record_id).cast("string")]
