"""Reconciling two sides file by file, and what each side holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import items, text
from .ranking import first_names, names_text


def _sides(left: DataFrame, right: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    a = left.select(*keys, *(F.col(v).alias(f"l_{v}") for v in values), F.lit(True).alias("_l"))
    b = right.select(*keys, *(F.col(v).alias(f"r_{v}") for v in values), F.lit(True).alias("_r"))
    return a.join(b, keys, "full_outer")


def reconcile(left: DataFrame, right: DataFrame) -> DataFrame:
    """(site, name, bytes) of two sides -> site, name, status: match, missing, extra or size_differs. Each file is
    compared with its own counterpart, so swapped sizes do not cancel out."""
    both = _sides(left, right, ["site", "name"], ["bytes"])
    status = (
        F.when(F.col("_r").isNull(), "missing").when(F.col("_l").isNull(), "extra").when(~F.col("l_bytes").eqNullSafe(F.col("r_bytes")), "size_differs").otherwise("match")
    )
    return both.select("site", "name", status.alias("status"))


def reconcile_summary(status: DataFrame) -> DataFrame:
    """Counts by site, with the first example of each kind."""
    kinds = ("missing", "extra", "size_differs")
    return status.groupBy("site").agg(
        *(F.count_if(F.col("status") == k).alias(f"n_{k}") for k in kinds),
        *(F.min(F.when(F.col("status") == k, F.col("name"))).alias(f"first_{k}") for k in kinds),
        F.every(F.col("status") == "match").alias("matches"),
    )


def side_stats(files: DataFrame, sample: int = 10) -> DataFrame:
    """Site, side, name, bytes, is_zero, is_tiny, discrepancy per file -> counts and bytes by site and side, and the first
    ``sample`` names of each kind of file that counts."""
    kinds = {"zero": F.col("is_zero"), "tiny": F.col("is_tiny"), "odd": F.col("discrepancy").isNotNull()}
    marked = files.select("site", "side", "name", F.explode(F.array_compact(F.array(*(F.when(c, k) for k, c in kinds.items())))).alias("kind"))
    named = first_names(marked, ["site", "side", "kind"], sample).withColumn("text", names_text(F.col("names"), F.col("n_names")))
    named = named.groupBy("site", "side").agg(*(F.max(F.when(F.col("kind") == k, F.col("text"))).alias(f"names_{k}") for k in kinds))
    counts = files.groupBy("site", "side").agg(
        F.count("*").alias("n_items"),
        F.sum("bytes").alias("total_bytes"),
        F.count_if("is_zero").alias("n_zero"),
        F.count_if("is_tiny").alias("n_tiny"),
        F.count("discrepancy").alias("n_discrepancies"),
    )
    return counts.join(named, ["site", "side"], "left").fillna("", [f"names_{k}" for k in kinds])


def self_check(files: DataFrame, stats: DataFrame) -> DataFrame:
    """Rows for what the statistics and the files they were made of do not agree on; none if all is well."""
    again = files.groupBy("site", "side").agg(
        F.sum(F.lit(1)).alias("n"), F.sum(F.col("is_zero").cast("int")).alias("z"), F.sum(F.col("is_tiny").cast("int")).alias("t"), F.max((F.col("is_zero") & F.col("is_tiny")).cast("int")).alias("both"),
    )
    found = stats.join(again, ["site", "side"], "full_outer")
    problem = (
        F.when(~F.col("n").eqNullSafe(F.col("n_items")), "count").when(~F.col("z").eqNullSafe(F.col("n_zero")), "zero").when(~F.col("t").eqNullSafe(F.col("n_tiny")), "tiny").when(F.col("both") == 1, "zero and tiny")
    )
    return found.select("site", "side", problem.alias("problem")).where(F.col("problem").isNotNull())


def audit_report(stats: DataFrame, summary: DataFrame) -> DataFrame:
    """One row for each site: both sides' counts, whether they match, and notes."""
    wide = stats.groupBy("site").pivot("side", ["disk", "archive"]).agg(F.first("n_items").alias("items"), F.first("total_bytes").alias("bytes"), F.first("n_zero").alias("zero"), F.first("n_tiny").alias("tiny"))
    note = F.concat_ws("; ", *(F.when(F.col(f"n_{k}") > 0, F.concat(F.lit(f"{k}: "), F.col(f"n_{k}").cast("string"))) for k in ("missing", "extra", "size_differs")))
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in wide.columns if c != "site"]
    return wide.select("site", *counts).join(summary, "site", "left").select("site", *[c for c in wide.columns if c != "site"], F.coalesce("matches", F.lit(False)).alias("matches"), note.alias("notes"))


def manifest_problems(manifest: DataFrame, entries: DataFrame, archives: DataFrame) -> DataFrame:
    """What a manifest (site, name, bytes, kb_text) and the archives' entries (site, archive, name, bytes) do not
    agree on, by the archive that owns an item: that of its day. ``archives``: site, archive, recorded. One table of
    problems: site, archive, code, n."""
    day = items.day_key("name")
    owned = manifest.withColumn("_day", day).withColumn("archive", F.when(F.col("_day").isNotNull(), F.concat_ws("_", "site", "_day"))).withColumn("_m", F.lit(True))
    there = entries.select("site", "archive", "name", F.col("bytes").alias("held"), F.lit(True).alias("_e"))
    # a task sorts a bounded number of rows, however many there are
    dealt = _dealing(manifest, entries)
    pairs = dealt(owned, "site", "archive", "name").join(dealt(there, "site", "archive", "name"), ["site", "archive", "name"], "full_outer").select("site", "archive", F.col("_m").isNotNull().alias("listed"), F.col("_e").isNotNull().alias("there"), size_agrees().alias("agrees"), F.lit(False).alias("recorded"))
    # one pass over files and archives together: what a file means depends on whether its archive is recorded
    marks = archives.where("recorded").select("site", "archive", F.lit(False).alias("listed"), F.lit(False).alias("there"), F.lit(None).cast("boolean").alias("agrees"), F.lit(True).alias("recorded"))
    listed, there = F.col("listed"), F.col("there")
    counted = dealt(pairs.unionByName(marks), "site", "archive").groupBy("site", "archive").agg(
        F.bool_or("recorded").alias("recorded"), F.count_if(listed).alias("listed"), F.count_if(listed & ~there).alias("missing"), F.count_if(there & ~listed).alias("extra"), F.count_if(listed & there & ~F.col("agrees")).alias("size_differs"),
    )
    sound, dated = F.col("recorded"), F.col("archive").isNotNull()
    codes = {"undatable": (~dated, F.col("listed")), "archive_absent": (dated & ~sound, F.col("listed")), "archive_unlisted": (dated & sound & (F.col("listed") == 0), F.lit(1).cast("long"))}
    codes |= {k: (dated & sound, F.col(k)) for k in ("missing", "extra", "size_differs")}
    found = F.array_compact(F.array(*(F.when(rule & (n > 0), F.struct(F.lit(k).alias("code"), n.alias("n"))) for k, (rule, n) in codes.items())))
    return counted.select("site", "archive", F.explode(found).alias("p")).select("site", "archive", "p.code", "p.n")


#: Rows of a manifest and of entries that a task compares.
TASK_ROWS = 1 << 18


def _dealing(manifest: DataFrame, entries: DataFrame):
    """How rows are dealt to tasks by columns: as Spark does where its partitions are enough for all rows, else on as many as they need."""
    n = -(-manifest.select("site").unionByName(entries.select("site")).count() // TASK_ROWS)
    enough = n <= int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return lambda rows, *columns: rows if enough else rows.repartition(n, *columns)


def size_agrees():
    """Exact bytes where the manifest has them, else its KB text."""
    return F.when(F.col("bytes").isNotNull(), F.col("bytes") == F.col("held")).otherwise(F.coalesce(items.size_kb_text("held") == F.col("kb_text"), F.lit(False)))


def orphaned_days(listed: DataFrame, archives: DataFrame) -> DataFrame:
    """Items by archive that does not exist."""
    return listed.join(archives.where("recorded"), ["site", "archive"], "left_anti").groupBy("site", "archive").agg(F.count("*").alias("n"))


def digest_problems(manifest: DataFrame, digests: DataFrame, blocked: DataFrame) -> DataFrame:
    """Listed digests that the computed ones do not confirm, for sites without problems of structure and without an
    unreadable archive (``blocked``: site)."""
    sound = manifest.join(blocked.select("site").distinct(), "site", "left_anti")
    return sound.join(digests.select("site", "name", F.col("digest").alias("computed")), ["site", "name"], "left").where(~F.col("digest").eqNullSafe(F.col("computed"))).select(
        "site", "name", F.when(F.col("computed").isNull(), "not computed").otherwise("differs").alias("problem")
    )


def upload_plan(local: DataFrame, remote: DataFrame) -> DataFrame:
    """Site, name of local files (with present) and of record entries (with status) -> what to do with each."""
    a = local.select("site", "name", F.col("present").alias("_p"), F.lit(True).alias("_l"))
    b = remote.select("site", "name", F.col("status").alias("_s"), F.lit(True).alias("_r"))
    done = F.col("_s") == "completed"
    action = (
        F.when(F.col("_l").isNull() & done, "on_record_only")
        .when(F.col("_l").isNull(), "to_delete")
        .when(F.coalesce(done, F.lit(False)), "already_committed")
        .when(~F.col("_p"), "missing_locally")
        .otherwise("to_upload")
    )
    return a.join(b, ["site", "name"], "full_outer").select("site", "name", action.alias("action"))


def record_summary(plan: DataFrame) -> DataFrame:
    """By site: files, companions, committed of all, state of the archive."""
    item = items.is_raw_upload("name")
    archive = F.lower("name").endswith(".zip")
    mine = ~F.col("action").isin("on_record_only", "to_delete")
    return plan.groupBy("site").agg(
        F.count_if(mine & item).alias("n_items"),
        F.count_if(mine & ~item & ~archive).alias("n_companions"),
        F.concat_ws("/", F.count_if(F.col("action") == "already_committed").cast("string"), F.count_if(mine).cast("string")).alias("committed"),
        F.coalesce(F.max(F.when(archive, F.col("action"))), F.lit("none")).alias("archive_state"),
    )


def completeness(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """(site, name, bytes) both ways: missing, unexpected, wrong_size; an unknown size is never wrong."""
    both = _sides(expected, actual, ["site", "name"], ["bytes"])
    status = F.when(F.col("_r").isNull(), "missing").when(F.col("_l").isNull(), "unexpected").when(F.col("l_bytes") != F.col("r_bytes"), "wrong_size")
    return both.select("site", "name", status.alias("status")).where(F.col("status").isNotNull())


def listed_missing(manifest: DataFrame, disk: DataFrame, default: list[str]) -> DataFrame:
    """(site, name) of a site's manifest, or of the default list if it has none, that are not on disk."""
    sites = disk.select("site").distinct()
    without = sites.join(manifest.select("site").distinct(), "site", "left_anti")
    wanted = manifest.select("site", "name").unionByName(without.select("site", F.explode(F.array(*map(F.lit, default))).alias("name")))
    return wanted.join(disk.select("site", "name"), ["site", "name"], "left_anti")


def name_sets(left: DataFrame, right: DataFrame) -> DataFrame:
    """(site, name, kind): names of one side only, or of both, as sets."""
    a, b = left.select("site", "name"), right.select("site", "name")
    return a.subtract(b).withColumn("kind", F.lit("left")).unionByName(b.subtract(a).withColumn("kind", F.lit("right"))).unionByName(a.intersect(b).withColumn("kind", F.lit("both")))


def diverging(ours: DataFrame, twin: DataFrame) -> DataFrame:
    """(site, name, digest): artifacts that the twin lacks or holds with another content."""
    other = twin.select("site", "name", F.col("digest").alias("_d"), F.lit(True).alias("_t"))
    how = F.when(F.col("_t").isNull(), "absent").when(~F.col("digest").eqNullSafe(F.col("_d")), "differs")
    return ours.join(other, ["site", "name"], "left").select("site", "name", how.alias("how")).where(F.col("how").isNotNull())


def key_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """(id, doc: map of text) of two versions -> id, key, change (removed, added, same or CHANGED) and detail: the value that
    went or came, both values, or of long texts the lengths and the first difference."""
    rows = lambda d, v: d.select("id", F.explode("doc").alias("key", v))
    change = F.when(F.col("b").isNull(), "removed").when(F.col("a").isNull(), "added").when(F.col("a") == F.col("b"), "same").otherwise("CHANGED")
    count = lambda c: F.format_number(F.length(c), 0)
    far = F.concat(count("a"), F.lit(" -> "), count("b"), F.lit(" chars, first difference at offset "), F.format_number(text.first_diff("a", "b"), 0))
    detail = F.when(F.col("b").isNull(), text.shorten("a")).when(F.col("a").isNull(), text.shorten("b")).when(F.col("a") == F.col("b"), "")
    detail = detail.when(F.length("a") > 200, far).otherwise(F.concat(text.shorten("a"), F.lit("  ->  "), text.shorten("b")))
    return rows(old, "a").join(rows(new, "b"), ["id", "key"], "full_outer").select("id", "key", change.alias("change"), detail.alias("detail"))
