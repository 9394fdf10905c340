"""From listings of files to verdicts: the facts of V01 to V04, each stage asking only about the sites that the one before left open.

Listings are cheap, archives' indexes are not, digests are the dearest. Filters on a site cannot be pushed into readers that are Python, so the
survivors of a stage become the rows that the next reader is given: an archive is opened only where listings leave the verdict open, and a
file is hashed only where the structure is sound. ``open_archives`` and ``hash_files`` take (site, path, bytes), as
``sources.files.read_archive_entries`` and ``hash_files`` do.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import items
from ..functions.common import materialise
from . import integrity, layout, verdicts

CONFIG = "CONFIG.TXT"


@dataclass(frozen=True)
class Contract:
    """What a prepared folder holds: names in the folder, those of them that a single archive holds too, names whose absence leaves the
    verdict open, and the mark of a finished folder. ``companions`` is None where their list cannot be read."""

    companions: Sequence[str] | None = ()
    generated: Sequence[str] = ("README.html", "file_list.csv", "manifest.csv")
    packed: Sequence[str] = ("file_list.csv",)
    conditional: Sequence[str] = ("related_identifiers.csv",)
    sentinel: str = ".prep_complete"


def _each(names: Sequence[str]) -> Column:
    """A row for each of the contract's names."""
    return F.explode(F.array(*map(F.lit, names)).cast("array<string>"))


def _days(raw: DataFrame) -> DataFrame:
    """site, name, day of the items that go into archives."""
    return raw.where(items.is_item("name", "prep") & items.is_item("name")).select("site", "name", items.day_key("name").alias("day"))


def _zips(staged: DataFrame) -> DataFrame:
    """site, archive, path, bytes, day (null for the single archive) of a site's own archives."""
    single, day = F.concat("site", F.lit(".zip")) == F.col("name"), F.regexp_extract("name", r"([0-9]{4}_[0-9]{2}_[0-9]{2})\.zip$", 1)
    daily = (day != "") & (_archive(day) == F.col("name"))
    return staged.where(daily | single).select("site", F.col("name").alias("archive"), "path", "bytes", F.when(daily, day).alias("day"))


def _archive(day: Column | str) -> Column:
    """The name of a site's archive of a day."""
    return F.concat("site", F.lit("_"), day, F.lit(".zip"))


def _count(rows: DataFrame, name: str) -> DataFrame:
    return rows.groupBy("site").agg(F.count("*").alias(name))


def listing_facts(raw: DataFrame, staged: DataFrame, contract: Contract) -> DataFrame:
    """Site, folder, sentinel, layout, n_archives, companions_readable, n_undatable, raw_config: what listings (site, name, bytes) of raw
    folders and (site, name, path, bytes) of prepared ones tell."""
    zips = _zips(staged)
    modes = layout.layout_mode(zips.select("site", F.col("archive").alias("name"))).withColumnRenamed("mode", "layout")
    here = staged.groupBy("site").agg(F.bool_or(F.col("name") == contract.sentinel).alias("sentinel"), F.lit(True).alias("folder"))
    source = raw.groupBy("site").agg(F.bool_or(F.upper("name") == CONFIG).alias("raw_config"))
    undatable = _count(_days(raw).where("day is null"), "n_undatable")
    facts = source.join(here, "site", "left").join(modes, "site", "left").join(_count(zips, "n_archives"), "site", "left").join(undatable, "site", "left")
    return facts.fillna(False, ["folder", "sentinel"]).fillna(0, ["n_archives", "n_undatable"]).fillna("none", ["layout"]).withColumn("companions_readable", F.lit(contract.companions is not None))


def open_sites(facts: DataFrame, audit_all: bool = False) -> DataFrame:
    """Sites whose verdict listings leave open: their archives are to be opened."""
    sure = F.col("sentinel") & F.lit(not audit_all)
    return facts.where(~sure & F.col("companions_readable") & ((F.col("layout") == "single") | ((F.col("layout") == "per_day") & (F.col("n_undatable") == 0)))).select("site", "layout", "raw_config")


def prep_verdicts(raw: DataFrame, staged: DataFrame, open_archives: Callable[[DataFrame], DataFrame], contract: Contract, audit_all: bool = False) -> DataFrame:
    """Site, verdict and the counts that it rests on, for every site with a raw folder."""
    facts = materialise(listing_facts(raw, staged, contract), "audit-listing")
    due = materialise(open_sites(facts, audit_all), "audit-open")
    days = _days(raw).join(due.where("layout = 'per_day'").select("site"), "site", "left_semi")
    zips = _zips(staged).join(due, "site")
    wanted_days = days.select("site", "day").distinct().withColumn("archive", _archive("day"))
    stray = zips.where("layout = 'per_day' AND day IS NOT NULL").join(wanted_days.select("site", "archive"), ["site", "archive"], "left_anti")
    opened = zips.join(stray.select("site", "archive"), ["site", "archive"], "left_anti").where("(layout = 'single') = (day IS NULL)")
    entries = materialise(open_archives(opened.select("site", "path", "bytes")).select("site", "archive", "name", "error"), "audit-entries")

    # names in the folder: the contract's, and the archives
    names = [*contract.generated, *(contract.companions or ()), *contract.conditional]
    in_folder = due.select("site", _each(names).alias("name")).distinct()
    in_folder = in_folder.unionByName(due.where("layout = 'single'").select("site", F.concat("site", F.lit(".zip")).alias("name"))).unionByName(wanted_days.select("site", F.col("archive").alias("name")))
    folder_misses = in_folder.join(staged.select("site", "name"), ["site", "name"], "left_anti")

    # names in a single archive: items and what is packed with them; in an archive of a day: its items, and the configuration
    read = entries.where("name IS NOT NULL").select("site", "archive", F.when(F.upper("name") == CONFIG, CONFIG).otherwise(F.col("name")).alias("name")).distinct()
    sound = opened.select("site", "archive", "layout", "raw_config").join(entries.where("name IS NULL").select("site", "archive").distinct(), ["site", "archive"], "left_anti")
    single, daily = sound.where("layout = 'single'"), sound.where("layout = 'per_day'")
    packed = [*contract.packed, *(contract.companions or ()), *contract.conditional]
    in_single = raw.where(items.is_item("name", "prep") & items.is_item("name")).join(single.select("site", "archive"), "site").select("site", "archive", "name")
    in_single = in_single.unionByName(single.select("site", "archive", _each(packed).alias("name"))).unionByName(single.select("site", "archive", F.lit(CONFIG).alias("name")))
    single_misses = in_single.distinct().join(read, ["site", "archive", "name"], "left_anti").join(single.select("site", "raw_config"), "site")
    in_days = days.select("site", _archive("day").alias("archive"), "name").join(daily.select("site", "archive"), ["site", "archive"], "left_semi")
    in_days = in_days.unionByName(daily.where("raw_config").select("site", "archive", F.lit(CONFIG).alias("name"))).withColumn("_w", F.lit(True))
    there = read.join(daily.select("site", "archive"), ["site", "archive"], "left_semi").withColumn("_t", F.lit(True))
    odd_entries = in_days.join(there, ["site", "archive", "name"], "full_outer").where("_w IS NULL OR _t IS NULL")

    may_lack = F.col("name").isin(*contract.conditional) if contract.conditional else F.lit(False)
    open_config = (F.col("name") == CONFIG) & ~F.col("raw_config")
    misses = folder_misses.select("site", may_lack.alias("open")).unionByName(single_misses.select("site", (may_lack | open_config).alias("open")))
    counts = misses.groupBy("site").agg(F.count_if(~F.col("open")).alias("n_required_missing"), F.count_if("open").alias("n_conditional_missing"))
    bad = entries.where("name IS NULL").select("site", F.lit(False).alias("archive_readable")).distinct()
    found = facts.join(counts, "site", "left").join(_count(stray, "n_stray_days"), "site", "left").join(_count(odd_entries, "n_entry_problems"), "site", "left").join(bad, "site", "left")
    columns = ["n_required_missing", "n_conditional_missing", "n_stray_days", "n_entry_problems"]
    found = found.fillna(0, columns).fillna(True, ["archive_readable"]).withColumn("has_config", F.col("raw_config"))
    return verdicts.prep_completeness(found, audit_all).select("site", "verdict", "layout", "n_archives", "n_undatable", *columns, "archive_readable", "has_config")


def source_rows(raw: DataFrame, zips: DataFrame, entries: DataFrame) -> DataFrame:
    """V03 for sites packed by day: (site, name, bytes, discrepancy) of raw files, (site, archive, day) of archives and (site, archive, name,
    bytes, error) of their entries -> a row for each problem and warning of a site. Items are held against the archive of their day, by name
    and bytes, both ways."""
    sound = raw.where(items.is_item("name", "prep") & items.is_item("name")).withColumn("day", items.day_key("name"))
    dated = sound.where("day IS NOT NULL").withColumn("archive", _archive("day"))
    wanted = dated.select("site", "archive").distinct()
    absent, stale = wanted.join(zips, ["site", "archive"], "left_anti"), zips.join(wanted, ["site", "archive"], "left_anti")
    live = zips.join(wanted, ["site", "archive"], "left_semi").select("site", "archive")
    read = entries.join(live, ["site", "archive"], "left_semi")
    bad = read.where("name IS NULL").select("site", "archive")
    held = read.where(items.is_item("name")).select("site", "archive", "name", F.col("bytes").alias("_held"))
    own = dated.join(live, ["site", "archive"], "left_semi").join(bad, ["site", "archive"], "left_anti").select("site", "archive", "name", "bytes")
    mismatch = own.join(held, ["site", "archive", "name"], "full_outer").where(~F.col("bytes").eqNullSafe(F.col("_held"))).select("site").unionByName(bad.select("site"))
    config = raw.where(F.upper("name") == CONFIG).select("site").distinct()
    with_config = read.where(F.upper("name") == CONFIG).select("site", "archive")
    lacking = live.join(config, "site", "left_semi").join(with_config, ["site", "archive"], "left_anti").select("site").distinct().withColumn("has_config", F.lit(False))
    by = sound.groupBy("site").agg(F.count("*").alias("n_items"), F.count_if(F.col("discrepancy").isNotNull() | F.col("day").isNull()).alias("n_cross_check"), F.count_if(F.col("bytes") == 0).alias("n_zero"))
    facts = raw.select("site").distinct().join(by, "site", "left").join(_count(absent, "n_days_absent"), "site", "left").join(_count(stale, "n_days_stale"), "site", "left").join(_count(mismatch, "n_map_mismatch"), "site", "left").join(lacking, "site", "left")
    return verdicts.source_problems(facts.fillna(0).fillna(True, ["has_config"]))


def gate_verdicts(staged: DataFrame, manifest: DataFrame, entries: DataFrame, digests: DataFrame, hash_files: Callable[[DataFrame], DataFrame], contract: Contract) -> DataFrame:
    """Site, problems, verdict, n_hashed. ``manifest``: (site, name, bytes, kb_text) of items, held against the archives' ``entries`` (J02);
    ``digests``: (site, name, digest) of files in the folder, held against what ``hash_files`` computes (J04). Only files of sites that have no other
    problem are hashed."""
    zips = _zips(staged)
    modes = layout.layout_mode(zips.select("site", F.col("archive").alias("name"))).withColumnRenamed("mode", "layout")
    base = staged.groupBy("site").agg(F.bool_or(F.col("name") == contract.sentinel).alias("sentinel")).join(modes, "site", "left").fillna("none", ["layout"])
    names = entries.where(items.is_item("name")).select("site", F.regexp_replace("archive", r"\.zip$", "").alias("archive"), "name", "bytes")
    archives = zips.where("day IS NOT NULL").select("site", F.regexp_replace("archive", r"\.zip$", "").alias("archive"), F.lit(True).alias("recorded"))
    problems = integrity.manifest_problems(manifest, names, archives).groupBy("site").agg(F.sum("n").alias("n_manifest_problems"))
    bad = entries.where("name IS NULL").select("site", F.lit(False).alias("archive_readable")).distinct()
    listed = manifest.select("site", F.lit(True).alias("has_manifest")).distinct()
    facts = base.join(problems, "site", "left").join(bad, "site", "left").join(listed, "site", "left").fillna(0, ["n_manifest_problems"]).fillna(True, ["archive_readable"]).fillna(False, ["has_manifest"])
    facts = materialise(facts, "gate-structure")
    sound = verdicts.integrity_gate(facts.withColumn("n_digest_problems", F.lit(0))).where("verdict = 'pass'").select("site")
    due = staged.join(digests.select("site", "name"), ["site", "name"], "left_semi").join(sound, "site", "left_semi")
    hashed = materialise(hash_files(due.select("site", "path", "bytes")).select("site", F.regexp_extract("path", "([^/]+)$", 1).alias("name"), F.col("sha512").alias("digest")), "gate-digests")
    blocked = facts.select("site").join(sound, "site", "left_anti")
    odd = integrity.digest_problems(digests.join(sound, "site", "left_semi"), hashed, blocked).groupBy("site").agg(F.count("*").alias("n_digest_problems"))
    found = facts.join(odd, "site", "left").join(_count(hashed, "n_hashed"), "site", "left").fillna(0, ["n_digest_problems", "n_hashed"])
    return verdicts.integrity_gate(found).select("site", F.array_join("problems", "; ").alias("problems"), "verdict", "n_hashed")
