"""Sharding by balanced label propagation: copies of a text move to where most of their group is, and shards keep equal counts.

Documents are linked when their texts are equal. As all members of a group see the same neighbours, a group is one row with its counts by
shard; documents without copies only fill up. Groups larger than half a shard, of which there are fewer than two for each shard, fill shards
one after the other. The others' labels start from a hash of the id, in proportion to the room that is left. In each round a group is
drawn to the shard with most of it among those that have room, and its members elsewhere move there, as far as the quota of that shard
goes: groups with one target queue, and a join with the sums of the ranges before theirs tells each how many it may move. The quota is an
eighth more than the share, less what is in the shard and does not want to leave, so that groups can change places where nearly all
rows have copies. In the end each shard keeps its share exactly; what is beyond it is set down, group after group, in the shards that
have room, and single documents follow. A group is thus cut only where it is larger than a shard, where a share ends, or where rounds end.

Positions are counted by ranges of an order that are written (``running``), members find their place by (group, stretch of STRETCH
members), so no group of copies, however large, is one task's; the driver sees one number for each shard, and the groups larger than half a one.

Only DataFrame functions. Defined results: null texts are empty, and empty texts are copies of each other; rows that repeat an id are
documents of their own; rows without an id are placed like others; an empty table has no rows; with fewer documents than shards the last
shards are empty; other columns are not read, whatever their names.
"""

from __future__ import annotations

from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ranking import running
from .common import materialise, text_or_empty
from .exact_dedup import content_hash

SHARDS = 24
#: Rounds at most; they end when nothing moves. Counts are exact whatever their number.
ROUNDS = 6
#: Members of a group that share a key when they find their places.
STRETCH = 256


def place(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot (from 0 in each shard): counts of shards differ by one at most."""
    text = text_or_empty()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), content_hash(text).alias("group"))
    rows = materialise(rows, "shard-rows")
    rows = materialise(running(rows, ["group"], [F.col("doc_id"), F.col("size")], "i", total="copies").withColumn("i", F.col("i") - 1), "shard-members")
    n = rows.count()
    share = [n // shards + (s < n % shards) for s in range(shards)]
    linked, single = rows.where("copies > 1"), rows.where("copies = 1")
    labels = propagate(linked, share, rounds)

    # what stays, and what is beyond the share
    laid = running(labels, ["shard"], [F.xxhash64("group")], "_k", {"before": "n"})
    fits = _within(_at(share, F.col("shard")) - F.col("before"), F.col("n"))
    laid = materialise(laid.select("group", "shard", "n", "before", fits.alias("fits")), "shard-laid")
    held = _sums(laid, F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: F.when(s == F.col("shard"), F.col("fits")).otherwise(0)), shards)
    over = running(laid.where("fits < n").select("group", "shard", (F.col("n") - F.col("fits")).alias("n")), [], [F.xxhash64("group"), F.col("shard")], "_k", {"before": "n"})
    over = materialise(over.select("group", F.lit(None).cast("int").alias("shard"), "n", F.col("before").alias("base")), "shard-over")
    n_over = over.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]

    # members of a group take its entries one after the other
    entries = laid.where("fits > 0").select("group", "shard", F.col("fits").alias("n"), F.col("before").alias("base")).unionByName(over)
    upto = F.sum("n").over(Window.partitionBy("group").orderBy(F.col("shard").asc_nulls_last(), "base"))
    entries = entries.withColumn("begin", upto - F.col("n"))
    stretches = F.sequence(F.floor(F.col("begin") / STRETCH), F.floor((F.col("begin") + F.col("n") - 1) / STRETCH))
    entries = entries.select(F.col("group").alias("_group"), "shard", "n", "base", "begin", F.explode(stretches).alias("stretch"))
    own = (F.col("group") == F.col("_group")) & (F.floor(F.col("i") / STRETCH) == F.col("stretch")) & (F.col("i") >= F.col("begin")) & (F.col("i") < F.col("begin") + F.col("n"))
    facts = ["doc_id", "size", "text_crc32"]
    found = linked.join(entries, own).select(*facts, "shard", (F.col("base") + F.col("i") - F.col("begin")).alias("at"))
    filled = running(single.select(*facts, "group"), [], [F.xxhash64("group")], "k").select(*facts, F.lit(None).cast("int").alias("shard"), (F.col("k") + (n_over - 1)).alias("at"))

    # places without a shard are counted through the room that shards have left
    ends = list(accumulate(s - h for s, h in zip(share, held)))
    shard = F.coalesce("shard", _place(F.col("at"), ends))
    start = [h - e for h, e in zip(held, [0, *ends])]
    slot = F.when(F.col("shard").isNull(), _at(start, shard) + F.col("at")).otherwise(F.col("at"))
    return found.unionByName(filled).select(*facts, shard.alias("shard"), slot.alias("slot"))


def propagate(linked: DataFrame, share: list[int], rounds: int) -> DataFrame:
    """(doc_id, group, i, copies) of documents with copies -> (group, shard, n) after the rounds."""
    shards, half = len(share), F.lit(max(share) // 2)
    filled, room = _fill(linked.where(F.col("copies") > half).groupBy("group", "copies").count().collect(), share)
    big = linked.sparkSession.createDataFrame(filled, "group binary, n array<long>")
    ends = list(accumulate(room))
    start = _place(F.pmod(F.xxhash64("doc_id", "i"), F.lit(max(1, ends[-1]))), ends)
    few = linked.where(F.col("copies") <= half).select("group", start.alias("shard")).groupBy("group")
    groups = materialise(few.agg(*(F.count_if(F.col("shard") == s).alias(f"n{s}") for s in range(shards))).select("group", F.array(*(f"n{s}" for s in range(shards))).alias("n")), "shard-groups")
    cap = [r + r // 8 for r in room]
    ranked = F.transform("n", lambda x, s: F.struct(x.alias("n"), F.xxhash64("group", s).alias("h"), s.alias("s")))
    for _ in range(rounds):
        load = _sums(groups, F.col("n"), shards)
        leaves = F.transform(ranked, lambda e: F.when(e["s"] == F.array_max(ranked)["s"], 0).otherwise(e["n"]))
        open_to = F.array(*(F.lit(c - x + y > 0) for c, x, y in zip(cap, load, _sums(groups, leaves, shards))))
        target = F.array_max(F.filter(ranked, lambda e: F.get(open_to, e["s"]) & (e["n"] > 0)))
        drawn = F.transform(ranked, lambda e: F.when(e < F.col("target"), e["n"]).otherwise(0))
        asked = groups.withColumn("target", target).withColumn("drawn", drawn).withColumn("m", F.aggregate("drawn", F.lit(0).cast("long"), lambda a, x: a + x)).withColumn("target", F.col("target.s"))
        asked = materialise(asked, "shard-drawn")
        moving = asked.where("m > 0")
        quota = [c - x + y for c, x, y in zip(cap, load, _sums(moving, F.col("drawn"), shards))]
        queue = running(moving, ["target"], [F.xxhash64("group"), F.col("group")], "_k", {"before": "m"})
        queue = queue.withColumn("moved", _within(_at(quota, F.col("target")) - F.col("before"), F.col("m")))
        # members leave the shards in their order
        kept = F.expr(
            "aggregate(drawn, named_struct('left', moved, 'kept', CAST(array() AS array<bigint>)), (a, x) -> named_struct('left', a.left - least(a.left, x), 'kept', concat(a.kept, array(least(a.left, x)))), a -> a.kept)"
        )
        after = F.transform(F.arrays_zip("n", "gone"), lambda e, s: e["n"] - e["gone"] + F.when(s == F.col("target"), F.col("moved")).otherwise(0))
        moves = materialise(queue.withColumn("gone", kept).select("group", after.alias("n"), "moved"), "shard-moves")
        if moves.where("moved > 0").isEmpty():
            break
        groups = asked.where("m = 0 OR m IS NULL").select("group", "n").unionByName(moves.select("group", "n"))
    return groups.unionByName(big).select("group", F.posexplode("n").alias("shard", "n")).where("n > 0")


def _fill(groups: list, share: list[int]) -> tuple[list[tuple], list[int]]:
    """Counts by shard of each large group, and the room that is left."""
    room, counts = list(share), []
    for r in sorted(groups, key=lambda r: (-r["copies"], r["group"])):
        left, n = r["copies"], [0] * len(share)
        while left:
            s = max(range(len(share)), key=lambda s: room[s])
            n[s] += (take := min(left, room[s]))
            room[s] -= take
            left -= take
        counts.append((r["group"], n))
    return counts, room


def _sums(rows: DataFrame, counts: Column, shards: int) -> list[int]:
    """Arrays of counts summed up by shard."""
    at = rows.select(counts.alias("c"))
    return [x or 0 for x in at.agg(*(F.sum(F.get("c", F.lit(s))) for s in range(shards))).first()]


def _place(at: Column, ends: list[int]) -> Column:
    """The interval that a place lies in."""
    return reduce(lambda a, e: a + (at >= e).cast("int"), ends[:-1], F.lit(0))


def _at(numbers: list[int], index: Column) -> Column:
    """The number of a shard."""
    return F.get(F.array(*(F.lit(x).cast("long") for x in numbers)), index)


def _within(room: Column, n: Column) -> Column:
    return F.least(F.greatest(room, F.lit(0).cast("long")), n)
