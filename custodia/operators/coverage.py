"""What is held, by site and day, and what is missing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def site_inventory(sites: DataFrame, files: DataFrame, min_year: int = 2023) -> DataFrame:
    """Items, total GB as text with 3 decimals and items of ``min_year`` or later, for each site; a
    site without items has zeros. ``files``: site, bytes, year."""
    held = files.groupBy("site").agg(
        F.count("*").alias("n"), F.sum("bytes").alias("b"), F.count_if(F.col("year") >= min_year).alias("y")
    )
    gb = F.bround((F.coalesce("b", F.lit(0)) / F.lit(1 << 30)).cast("decimal(30,10)"), 3)
    return sites.select("site").join(held, "site", "left").select(
        "site",
        F.coalesce("n", F.lit(0)).alias("n_items"),
        gb.cast("string").alias("total_gb"),
        F.coalesce("y", F.lit(0)).alias("n_recent"),
    )


def missing_keys(master: DataFrame, report: DataFrame) -> DataFrame:
    """(key) of two lists -> key, side: master only, report only, or both."""
    a, b = master.select("key").where("key is not null").distinct(), report.select("key").where("key is not null").distinct()
    return (
        a.join(b, "key", "left_anti").withColumn("side", F.lit("master"))
        .unionByName(b.join(a, "key", "left_anti").withColumn("side", F.lit("report")))
        .unionByName(a.join(b, "key", "left_semi").withColumn("side", F.lit("both")))
    )


def locate(raw: DataFrame, staging: DataFrame, uploaded: DataFrame) -> DataFrame:
    """(key) x (key, place) -> where each key's folder is, staging preferred."""
    s = staging.groupBy("key").agg(F.min("place").alias("s"))
    u = uploaded.groupBy("key").agg(F.min("place").alias("u"))
    label = F.when(F.col("s").isNotNull(), "staging").when(F.col("u").isNotNull(), "uploaded").otherwise("none")
    return raw.select("key").distinct().join(s, "key", "left").join(u, "key", "left").select("key", F.coalesce("s", "u").alias("place"), label.alias("location"))


def expected_missing(sites: DataFrame, templates: list[str], extra: DataFrame, actual: DataFrame) -> DataFrame:
    """Names that each site should have (templates with ``{site}``, and ``extra``: site, name) and has not."""
    names = F.array(*(F.concat(*(F.lit(x) if i % 2 == 0 else F.col("site") for i, x in enumerate(_parts(t)))) for t in templates))
    wanted = sites.select("site", F.explode(names).alias("name")).unionByName(extra.select("site", "name")).distinct()
    return wanted.join(actual.select("site", "name"), ["site", "name"], "left_anti")


def _parts(template: str) -> list[str]:
    out = template.split("{site}")
    return [x for pair in zip(out, ["site"] * len(out)) for x in pair][:-1]


def evidence(sites: DataFrame, sources: dict[str, DataFrame | None]) -> DataFrame:
    """One flag for each source (key): found, not found, or NULL if the source is not available."""
    out = sites.select("key").distinct()
    for name, df in sources.items():
        if df is None:
            out = out.withColumn(name, F.lit(None).cast("boolean"))
        else:
            out = out.join(df.select("key").distinct().withColumn(name, F.lit(True)), "key", "left").withColumn(name, F.coalesce(name, F.lit(False)))
    return out


def local_package(keys: DataFrame, staging: DataFrame, raw: DataFrame, state: DataFrame) -> DataFrame:
    """By key: how many staging and raw folders claim it, the first of each, record id and mode from its state."""
    n = lambda d, p: d.groupBy("key").agg(F.count("*").alias(f"n_{p}"), F.min("folder").alias(p))
    out = keys.select("key").distinct().join(n(staging, "staging"), "key", "left").join(n(raw, "raw"), "key", "left")
    return out.join(state.select("key", "record_id", "mode"), "key", "left").fillna(0, ["n_staging", "n_raw"])


def column_accounting(cells: DataFrame) -> DataFrame:
    """(row, key, reason) -> totals of a parsed column; every row is parsed or a problem."""
    twice = cells.where("key is not null").groupBy("key").agg(F.count("*").alias("n")).where("n > 1").agg(F.count("*").alias("n_duplicates"))
    ok = F.col("key").isNotNull()
    counts = cells.agg(F.count("*").alias("total"), F.count_if(ok).alias("parsed"), F.count_if(~ok).alias("problems"), F.countDistinct("key").alias("distinct"))
    return counts.join(twice)  # one row each


def accounting_text(cells: DataFrame, most: int = 20, samples: int = 3) -> DataFrame:
    """Lines of the accounting: first samples, first problems (at most ``most``), and keys that occur twice."""
    first = cells.where("key is not null").orderBy("row").limit(samples).select(F.lit("sample").alias("kind"), F.col("key").alias("text"))
    bad = cells.where("key is null").orderBy("row").limit(most).select(F.lit("problem").alias("kind"), F.concat(F.col("row").cast("string"), F.lit(": "), F.col("reason")).alias("text"))
    twice = cells.where("key is not null").groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    return first.unionByName(bad).unionByName(twice.select(F.lit("duplicate").alias("kind"), F.concat(F.col("key"), F.lit(" x"), F.col("n").cast("string")).alias("text")))


def recording_dates(files: DataFrame, min_year: int = 1980) -> DataFrame:
    """(site, name) -> first and last valid day of distinct names; NULL if there is none."""
    from ..functions.items import item_timestamp

    day = F.to_date(item_timestamp("name"))
    valid = F.when(F.year(day) >= min_year, day)
    return files.groupBy("site").agg(F.min(valid).alias("first_day"), F.max(valid).alias("last_day"), F.countDistinct("name").alias("n_names"))


def verdict_counts(verdicts: DataFrame) -> DataFrame:
    """How often each verdict, most frequent first."""
    return verdicts.groupBy("verdict").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "verdict")


def unique_keys(listing: DataFrame) -> DataFrame:
    """A17"""
    return listing.select("key").where("key is not null").distinct()


def requested(found: DataFrame, requests: DataFrame) -> DataFrame:
    """(key) x (key, position), any case -> request order, and requests that were not found."""
    asked = requests.groupBy(F.upper("key").alias("_k")).agg(F.min("position").alias("position"))
    have = found.select("key", F.upper("key").alias("_k")).distinct()
    return asked.join(have, "_k", "left").select(F.coalesce("key", "_k").alias("key"), "position", F.col("key").isNotNull().alias("found"))


def work_order(work: DataFrame, requests: DataFrame) -> DataFrame:
    """Work (key) with the place of its key in the request list, unknown keys last."""
    return work.join(requests.select("key", "position"), "key", "left").withColumn("position", F.coalesce("position", F.lit(1 << 30)))


def not_done(archives: DataFrame, done: DataFrame) -> DataFrame:
    """(site, path) -> sites that still have an archive outside the done-set (path)."""
    return archives.join(done.select("path").distinct(), "path", "left_anti").select("site").distinct()


def prepared(keys: DataFrame, staging: DataFrame, uploaded: DataFrame) -> DataFrame:
    """(key) x (key, sentinel) x (key) -> whether preparing it is over."""
    s = staging.groupBy("key").agg(F.bool_or("sentinel").alias("s"))
    u = uploaded.select("key").distinct().withColumn("u", F.lit(True))
    return keys.select("key").distinct().join(s, "key", "left").join(u, "key", "left").select("key", (F.coalesce("s", F.lit(False)) | F.coalesce("u", F.lit(False))).alias("prepared"))


def folders(names: DataFrame, prefix: str = "SITE") -> DataFrame:
    """P10: (folder) -> which are strict raw names and which are staging leftovers in the raw area."""
    strict = F.col("folder").rlike(f"^{prefix}#[0-9]{{3}}([A-Za-z_][A-Za-z0-9_]*)?$") & ~F.lower("folder").endswith("_staging")
    left = F.col("folder").rlike(f"(?i)^{prefix}[_#].*_staging$")
    return names.select("folder", strict.alias("raw"), left.alias("leftover"))


def key_pairs(paths: DataFrame, prefix: str = "SITE") -> DataFrame:
    """(path) of archives -> key and path; paths without a key are kept with the warning."""
    from ..functions.keys import parse_key

    base = F.regexp_extract("path", r"([^/]*)$", 1)
    key = parse_key(base, prefix)
    return paths.select("path", key.alias("key"), F.when(key.isNull(), "no key in the name").alias("warning"))
