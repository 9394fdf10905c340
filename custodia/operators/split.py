"""Balanced splitting of a site's items into two halves."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.common import casefold, materialise
from ..functions.items import is_item, item_timestamp
from ..functions.keys import parse_part
from .layout import UPLOAD_ARTIFACT, copy_reason
from .ranking import number, ranges, running, starts


def _order():
    return [item_timestamp("name").isNull(), item_timestamp("name"), casefold("name"), F.col("name")]


def positions(files: DataFrame) -> DataFrame:
    """(site, name, bytes) with position i and the bytes before it, in canonical order: by time, then by name. The items of a
    large site are several ranges of that order."""
    return running(files, ["site"], _order(), "i", {"before": "bytes"}).withColumn("i", F.col("i") - 1)


def cuts(placed: DataFrame) -> DataFrame:
    """By site the index at which to cut, so that the halves' bytes differ least; ties go to the largest index, and
    fewer than two items have no cut."""
    totals = placed.groupBy("site").agg(F.sum("bytes").alias("total"), F.count("*").alias("n"))
    inner = placed.where("i > 0").join(totals, "site").withColumn("gap", F.abs(2 * F.col("before") - F.col("total")))
    best = inner.groupBy("site").agg(F.max_by("i", F.struct((-F.col("gap")).alias("g"), "i")).alias("cut"), F.min("gap").alias("imbalance"))
    return totals.join(best, "site", "left")


def range_cuts(dealt: DataFrame, start: DataFrame) -> DataFrame:
    """W01 in two levels: the sums of the ranges tell which of them hold the middle of a site's bytes (the last that begins at or before
    it, and those that begin with the first sum beyond it), and only their rows are looked at. site, cut."""
    whole = start.groupBy("_by_site").agg(F.max(F.col("_before_before") + F.col("_before")).alias("total"), F.max("_total").alias("n"))
    sized = start.join(whole.withColumnRenamed("_by_site", "site"), F.col("_by_site").eqNullSafe(F.col("site")))
    low = 2 * F.col("_before_before") <= F.col("total")
    edge = sized.groupBy("site").agg(F.max(F.when(low, F.col("_start"))).alias("_last"), F.min(F.when(~low, F.col("_before_before"))).alias("_beyond"))
    near = sized.drop("site").join(edge, F.col("_by_site").eqNullSafe(F.col("site"))).where((F.col("_start") == F.col("_last")) | (F.col("_before_before") == F.col("_beyond")))
    rows = number(dealt, near.select(*start.columns, "total"), ["site"], "i", {"before": "bytes"}, "n", ["total"]).withColumn("i", F.col("i") - 1)
    gap = F.abs(2 * F.col("before") - F.col("total"))
    return rows.where("i > 0").groupBy("site").agg(F.max_by("i", F.struct((-gap).alias("g"), "i")).alias("cut"))


def split_plan(files: DataFrame) -> DataFrame:
    """Site, name, part of each item; NULL where there is no cut."""
    sums = {"before": "bytes"}
    dealt = ranges(files.select("site", "name", "bytes"), ["site"], _order())
    start = materialise(starts(dealt, ["site"], sums, total=True), "range-starts")
    placed = number(dealt, start, ["site"], "i", sums).withColumn("i", F.col("i") - 1)
    return placed.join(range_cuts(dealt, start), "site", "left").select("site", "name", "bytes", "i", F.when(F.col("i") < F.col("cut"), 1).when(F.col("cut").isNotNull(), 2).alias("part"))


def cut_boundary(plan: DataFrame) -> DataFrame:
    """Last name of part 1 and first of part 2."""
    return plan.where("part is not null").groupBy("site").agg(F.max_by(F.when(F.col("part") == 1, F.col("name")), F.when(F.col("part") == 1, F.col("i"))).alias("last_of_1"), F.min_by(F.when(F.col("part") == 2, F.col("name")), F.when(F.col("part") == 2, F.col("i"))).alias("first_of_2"))


def verify_plan(plan: DataFrame) -> DataFrame:
    """(site, name, bytes, i, part) -> sites whose plan is not contiguous, has an empty half or is not the best cut."""
    again = cuts(positions(plan.select("site", "name", "bytes")))
    got = plan.groupBy("site").agg(
        F.count_if(F.col("part") == 1).alias("n1"), F.count_if(F.col("part") == 2).alias("n2"), F.max(F.when(F.col("part") == 1, F.col("i"))).alias("end1"),
        F.min(F.when(F.col("part") == 2, F.col("i"))).alias("begin2"), F.abs(F.sum(F.when(F.col("part") == 1, F.col("bytes")).otherwise(-F.col("bytes")))).alias("gap"),
    )
    found = again.join(got, "site")
    problem = (
        F.when(F.col("n") < 2, F.lit(None)).when((F.col("n1") == 0) | (F.col("n2") == 0), "empty half").when(F.col("end1") + 1 != F.col("begin2"), "not contiguous").when(F.col("gap") != F.col("imbalance"), "not the best cut")
    )
    return found.select("site", problem.alias("problem")).where("problem is not null")


def union_parts(part1: DataFrame, part2: DataFrame) -> DataFrame:
    """(site, name, bytes) of two halves as one inventory; part 1 wins, and a conflict is marked."""
    rows = part1.select("site", "name", "bytes", F.lit(1).alias("p")).unionByName(part2.select("site", "name", "bytes", F.lit(2).alias("p")))
    return rows.groupBy("site", "name").agg(F.min_by("bytes", "p").alias("bytes"), (F.countDistinct("bytes") > 1).alias("conflict"))


def part_pairs(folders: DataFrame) -> DataFrame:
    """(key) -> every part 1 with its part 2, if there is one."""
    p = folders.select("key", parse_part("key").alias("p")).where("p is not null").select("key", "p.*")
    one = p.where("i = 1").select("base", "n", F.col("key").alias("part1"))
    two = p.where("i = 2").select("base", "n", F.col("key").alias("part2"))
    return one.join(two, ["base", "n"], "left").select("base", "n", "part1", "part2")


def pair_facts(pairs: DataFrame, files: DataFrame) -> DataFrame:
    """The facts on pairs of halves (J16: base, n, part1, part2) from their files (key, name, bytes, error): what the best split of both
    halves' items would be, what part 2 holds already, and what is missing there. One row for each pair."""
    known = pairs.select(F.col("part1").alias("site"), "base", F.col("n").alias("part_total"), "part2", F.col("part2").isNotNull().alias("part2_exists"))
    one = files.join(known.select(F.col("site").alias("key"), "site"), "key")
    two = files.join(known.where("part2 IS NOT NULL").select(F.col("part2").alias("key"), "site"), "key")
    item = is_item("name", "split")
    held = two.where(item).select("site", "name", "bytes", "error")
    union = materialise(union_parts(one.where(item), held), "pair-union")
    plan = materialise(split_plan(union.select("site", "name", "bytes")), "pair-plan")
    there = plan.join(held.select("site", "name", F.lit(True).alias("_there")).distinct(), ["site", "name"], "left").withColumn("_there", F.coalesce("_there", F.lit(False)))
    first, second = F.col("part") == 1, F.col("part") == 2
    planned = there.groupBy("site").agg(
        (F.max(F.when(first, F.col("i"))) + 1).alias("cut"), F.sum(F.when(first, F.col("bytes"))).alias("items1"), F.sum(F.when(second, F.col("bytes"))).alias("items2"),
        F.count_if(first & F.col("_there")).alias("n_unexpected"), F.count_if("_there").alias("n_in_part2"), F.count_if(second & ~F.col("_there")).alias("n_remaining"),
    )
    beside = one.where(~item & copy_reason("name", F.lit(False), F.lit(False)).isNull())
    copied = beside.groupBy("site").agg(F.sum("bytes").alias("companions"))
    absent = beside.select("site", "name").join(two.select("site", "name"), ["site", "name"], "left_anti").groupBy("site").agg(F.count("*").alias("n_companions_missing"))
    bound = two.where(F.col("name").rlike(UPLOAD_ARTIFACT)).select("site", F.lit(True).alias("part2_bound")).distinct()
    untrusted = one.where(item).select("site", "error").unionByName(held.select("site", "error")).where("error IS NOT NULL").groupBy("site").agg(F.count("*").alias("n_untrusted"))
    differing = union.where("conflict").groupBy("site").agg(F.count("*").alias("n_differing"))
    found = known
    for more in (planned, copied, absent, bound, untrusted, differing, verify_plan(plan).withColumnRenamed("problem", "plan_problem")):
        found = found.join(more, "site", "left")
    found = found.fillna(0, ["companions", "items1", "items2", "n_unexpected", "n_in_part2", "n_remaining", "n_companions_missing", "n_untrusted", "n_differing"]).fillna(False, ["part2_bound"])
    return found.withColumns({"bytes1": F.col("items1") + F.col("companions"), "bytes2": F.col("items2") + F.col("companions")}).drop("items1", "items2", "companions")
