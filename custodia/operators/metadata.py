"""Manifests and metadata documents."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import items, text
from .state import last_wins


def internal_manifest(parts: dict[str, DataFrame], digests: DataFrame) -> DataFrame:
    """Role -> (site, name, bytes), with each file's digest (site, name, sha512)."""
    rows = reduce(DataFrame.unionByName, (d.select("site", "name", "bytes", F.lit(r).alias("role")) for r, d in parts.items()))
    return rows.join(digests.select("site", "name", "sha512"), ["site", "name"], "left").select("site", "name", "role", items.size_kb_text("bytes").alias("size_kb"), "bytes", "sha512")


def external_manifest(manifest: DataFrame, archives: DataFrame) -> DataFrame:
    """Archives (site, name, day, bytes) first, then the files; an item's notes name the archive of its day."""
    day = items.day_key("name")
    own = archives.select("site", "day", F.col("name").alias("archive"))
    files = manifest.withColumn("day", day).join(own, ["site", "day"], "left").select("site", F.lit(1).alias("rank"), "name", "bytes", F.when(F.col("archive").isNotNull(), F.concat(F.lit("in "), F.col("archive"))).otherwise("").alias("notes"))
    return archives.select("site", F.lit(0).alias("rank"), "name", "bytes", F.lit("archive").alias("notes")).unionByName(files)


def upload_set(files: DataFrame, inputs: list[str]) -> DataFrame:
    """(site, name, bytes) without inputs, with size and role."""
    kept = files.where(~F.col("name").isin(*inputs) & (F.lower("name") != "readme.md"))
    return kept.select("site", "name", items.size_kb_text("bytes").alias("size_kb"), text.file_role("name").alias("notes"))


def required_files(manifest: DataFrame, companions: DataFrame) -> DataFrame:
    """(site, name, sha512) x (site, name) -> what per-item delivery needs: raw files with digests, and companions, which
    never include raw names."""
    raw = manifest.where(items.is_raw_upload("name")).select("site", "name", "sha512", F.lit("raw").alias("kind"))
    rest = companions.where(~items.is_raw_upload("name") & ~F.lower("name").endswith(".zip"))
    return raw.unionByName(rest.select("site", "name", F.lit(None).cast("string").alias("sha512"), F.lit("companion").alias("kind")))


def update_manifest(manifest: DataFrame, changed: DataFrame, drop_archives: bool = False) -> DataFrame:
    """(site, name, bytes, sha512): changed rows replace theirs or are added; archive rows go if asked."""
    kept = manifest.join(changed.select("site", "name"), ["site", "name"], "left_anti").unionByName(changed)
    return kept.where(~F.lower("name").endswith(".zip")) if drop_archives else kept


def missing_headers(columns: list[str], required: list[str]) -> list[str]:
    """Required headers that a table lacks; checked on the driver, on names alone."""
    return [r for r in required if text.pick_column(columns, r) is None]


def validate_rows(rows: DataFrame, key: Column, category: str, categories: list[str], needed: dict[str, list[str]]) -> DataFrame:
    """Rows with reject_reason: key not canonical, unknown category, or a field that its category needs is blank."""
    blank = lambda f: F.trim(F.coalesce(F.col(f), F.lit(""))) == ""
    reason = F.when(key.isNull(), "bad key").when(~F.coalesce(F.col(category).isin(*categories), F.lit(False)), "unknown category")
    for name, fields in needed.items():
        for f in fields:
            reason = reason.when((F.col(category) == name) & blank(f), f"{f} is blank")
    return rows.withColumn("key", key).withColumn("reject_reason", reason)


def related_identifiers(rows: DataFrame, types: dict[str, str]) -> DataFrame:
    """(identifier, scheme, relation_type, resource_type) normalised; blank identifiers or relations are skipped."""
    out = rows.select(F.trim("identifier").alias("identifier"), F.lower(F.trim("scheme")).alias("scheme"), text.norm_relation("relation_type").alias("relation_type"), text.map_vocab("resource_type", types).alias("resource_type"))
    return out.where((F.coalesce("identifier", F.lit("")) != "") & (F.coalesce("relation_type", F.lit("")) != ""))


def references(rows: DataFrame) -> DataFrame:
    """(reference) trimmed; blank ones are skipped."""
    return rows.select(F.trim("reference").alias("reference")).where(F.coalesce("reference", F.lit("")) != "")


def route_list(value: Column | str, marker: str, exists: Column) -> Column:
    """Which list of related identifiers a site gets: its own, else by a marker in its keywords."""
    c = F.col(value) if isinstance(value, str) else value
    return F.when(exists, "own").when(F.contains(F.lower(c), F.lit(marker.lower())), "list 2").otherwise("list 1")


def people(column: str, role: str | None = None) -> Column:
    """Array of (family, given, orcid, affiliation) -> array of persons as records need them; blank ids are left out."""
    def one(p):
        name = F.concat_ws(", ", p["family"], p["given"])
        ids = F.when(F.coalesce(p["orcid"], F.lit("")) != "", F.array(F.struct(F.lit("orcid").alias("scheme"), p["orcid"].alias("identifier"))))
        person = F.struct(name.alias("name"), F.lit("personal").alias("type"), ids.alias("identifiers"))
        return F.struct(person.alias("person_or_org"), F.lit(role).alias("role"), F.split(p["affiliation"], ";").alias("affiliations"))

    return F.transform(column, one)


def fundings(column: str) -> Column:
    """Array of (funder_id, award_title, award_number, award_url) -> array of fundings as records need them; without an
    address an award has no identifiers."""
    def one(f):
        ids = F.when(F.coalesce(f["award_url"], F.lit("")) != "", F.array(F.struct(F.lit("url").alias("scheme"), f["award_url"].alias("identifier"))))
        award = F.struct(F.struct(F.coalesce(f["award_title"], F.lit("")).alias("en")).alias("title"), f["award_number"].alias("number"), ids.alias("identifiers"))
        return F.struct(F.struct(f["funder_id"].alias("id")).alias("funder"), award.alias("award"))

    return F.transform(column, one)


def record_documents(sites: DataFrame, fields: dict[str, Column]) -> DataFrame:
    """One JSON document for each site; fields without a value are left out, at every depth."""
    return sites.select("site", F.to_json(F.struct(*(c.alias(k) for k, c in fields.items()))).alias("doc"))


def put_body(docs: DataFrame, allowed: list[str], ensure: tuple[str, str]) -> DataFrame:
    """(id, doc: map, metadata) -> allowed keys, one key made sure of, and the metadata replaced."""
    kept = F.map_filter("doc", lambda k, _: k.isin(*[a for a in allowed if a != "metadata"]))
    has = F.map_contains_key(kept, ensure[0])
    sure = F.when(has, kept).otherwise(F.map_concat(kept, F.create_map(F.lit(ensure[0]), F.lit(ensure[1]))))
    return docs.select("id", F.map_concat(sure, F.create_map(F.lit("metadata"), F.col("metadata"))).alias("body"))


def join_metadata(folders: DataFrame, metadata: DataFrame, staged: DataFrame) -> DataFrame:
    """(key) x (row, key, version, ...) x (key, version): keys in any case, the last row of a key wins, a staged version goes
    first; unmatched folders stay, marked."""
    last = last_wins(metadata.withColumn("_k", F.lower("key")).drop("key"), ["_k"], "row")
    own = staged.groupBy(F.lower("key").alias("_k")).agg(F.max("version").alias("_v"))
    out = folders.withColumn("_k", F.lower("key")).join(last.drop("row"), "_k", "left").join(own, "_k", "left")
    return out.withColumn("matched", F.col("version").isNotNull()).withColumn("version", F.coalesce("_v", "version")).drop("_k", "_v")


def lookup_first(folders: DataFrame, metadata: DataFrame) -> DataFrame:
    """Exact key text, the first row of a key wins."""
    return folders.join(last_wins(metadata, ["key"], "row", first=True).drop("row"), "key", "left")
