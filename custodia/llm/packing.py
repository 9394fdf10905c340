"""Packing documents into fixed-length sequences: shortest-pack-first over the length histogram.

1. Documents are tokenised once, in tasks. A document's ids end with an end id; what exceeds a sequence
   is cut off in whole sequences, so only one piece of each document has to find company.
2. The histogram of piece lengths (at most one bin for each length up to the sequence length, so its size
   is bounded) goes to the driver. Lengths are placed longest first, each into the shortest pack that
   has room; a whole count of pieces of one length joins a whole count of packs at once, so the
   placement works on packing patterns and their counts, never on documents.
3. Patterns are joined back by rank: the r-th piece of a length takes that length's r-th slot. Ranks are
   counted in two levels, within a salt and over the counts of salts, so a length that a third of all
   documents share is still ranked by many tasks; the number of salts follows the longest count. Slots are
   ranges of ranks, a table as short as the list of patterns.

Defined results: a null text counts as empty and makes a piece that holds the end id alone; repeated
rows are separate documents; a null doc_id is kept; an empty table gives no rows. Other columns of
the input are not read.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import freed, materialise, parts, text_or_empty
from .tokens import encoder

#: Longest sequence, and the id that ends every document.
LENGTH, END_ID = 2048, 1
#: Salts that share the ranking of one length, at least, and pieces of one length for each salt.
SALTS, PER_SALT = 64, 1 << 16

PIECES = "doc_id long, start long, length long, doc_tokens long, ids_crc32 long, salt long"


def tokenise(docs: DataFrame, path: str, length: int = LENGTH, end_id: int = END_ID, keep_ids: bool = True) -> DataFrame:
    """One row for each piece; ``ids`` are little-endian unsigned 32-bit; ``salt`` numbers the pieces of a task."""

    def run(batches):
        coder = encoder(path)
        seen = 0
        for batch in (part for whole in batches for part in parts(whole, 2 << 20)):
            got, offs = coder.encode(batch.column("text"))
            n = np.diff(offs) + 1
            ends = np.cumsum(n)
            ids = np.full(int(ends[-1]), end_id, "<u4")
            inner = np.ones(len(ids), bool)
            inner[ends - 1] = False
            ids[inner] = got
            per = -(-n // length)  # pieces of each document
            of = np.repeat(np.arange(len(n)), per)
            start = length * (np.arange(len(of)) - np.repeat(np.cumsum(per) - per, per))
            size = np.minimum(length, n[of] - start)
            cuts = np.append(0, np.cumsum(size))
            view = memoryview(ids).cast("B")
            crc = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(cuts.tolist(), cuts[1:].tolist())]
            columns = {"doc_id": batch.column("doc_id").take(pa.array(of)), "start": start, "length": size, "doc_tokens": n[of], "ids_crc32": crc, "salt": seen + np.arange(len(of))}
            if keep_ids:
                columns["ids"] = pa.Array.from_buffers(pa.binary(), len(of), [None, pa.py_buffer((4 * cuts).astype(np.int32)), pa.py_buffer(ids)])
            seen += len(of)
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, pa.int64()) for c in columns.values()], names=list(columns))
        coder.forget()
        freed()

    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return given.mapInArrow(run, PIECES + (", ids binary" if keep_ids else ""))


@dataclass
class Pattern:
    """Lengths that share a sequence, in the order of their places, and how many sequences are so filled."""

    lengths: tuple[int, ...]
    count: int


def shortest_pack_first(histogram: dict[int, int], length: int = LENGTH) -> list[Pattern]:
    """Patterns that hold every length as often as the histogram counts it. Packs of one fill level and
    one make-up are one entry, so the work follows the number of lengths, not of documents."""
    by_room: dict[int, dict[tuple[int, ...], int]] = defaultdict(dict)  # room left -> make-up -> count
    for size in sorted(histogram, reverse=True):
        todo = histogram[size]
        while todo:
            room = next((r for r in range(length, size - 1, -1) if by_room.get(r)), None)
            if room is None:
                per = length // size  # the next of this length fits the pack just opened
                whole, odd = divmod(todo, per)
                for n, count in ((per, whole), (odd, 1)):
                    if n and count:
                        left = by_room[length - n * size]
                        left[(size,) * n] = left.get((size,) * n, 0) + count
                todo = 0
                continue
            made, have = by_room[room].popitem()
            take = min(todo, have)
            if have > take:
                by_room[room][made] = have - take
            left = by_room[room - size]
            left[(*made, size)] = left.get((*made, size), 0) + take
            todo -= take
    return [Pattern(made, n) for left in by_room.values() for made, n in left.items()]


def slots(patterns: list[Pattern]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, last rank, first sequence, offset): the ranks [first, last] of a length lie at
    ``offset`` of the sequences that start at ``first sequence``, one after the other."""
    used: dict[int, int] = defaultdict(int)
    out, sequence = [], 0
    for p in sorted(patterns, key=lambda p: p.lengths, reverse=True):
        offset = 0
        for size in p.lengths:
            out.append((size, used[size], used[size] + p.count - 1, sequence, offset))
            used[size] += p.count
            offset += size
        sequence += p.count
    return out


def place(pieces: DataFrame, length: int = LENGTH) -> DataFrame:
    """``pieces`` (a table that can be read again) with sequence_id and offset. Reads its length and salt twice."""
    spark = pieces.sparkSession
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # ``length`` rows at most
    table = slots(shortest_pack_first(histogram, length))
    slot = spark.createDataFrame(table or [], "length long, first long, last long, sequence long, offset long")

    salts = max(SALTS, max(histogram.values(), default=0) // PER_SALT)
    dealt = pieces.withColumn("salt", F.pmod(F.hash("doc_id", "start", "salt"), F.lit(salts)))
    counts = dealt.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)))
    # the pieces of a salt have consecutive ranks, so few slots concern them; there is a slot for each place of a pattern,
    # and a new length splits one pattern at most: twice as many patterns as lengths, whatever the input
    by_length = slot.groupBy("length").agg(F.array_sort(F.collect_list(F.struct("first", "last", "sequence", "offset"))).alias("slots"))
    near = F.filter("slots", lambda s: (s["first"] < F.col("base") + F.col("n")) & (s["last"] >= F.col("base")))
    base = base.join(F.broadcast(by_length), "length").select(F.col("length").alias("_l"), F.col("salt").alias("_s"), F.col("base").alias("_base"), near.alias("_slots"))
    within = Window.partitionBy("length", "salt").orderBy("doc_id", "start")
    ranked = dealt.withColumn("_r", F.row_number().over(within)).join(base, (F.col("length") == F.col("_l")) & (F.col("salt") == F.col("_s")))
    ranked = ranked.withColumn("rank", F.col("_base") + F.col("_r") - 1)
    hit = F.filter("_slots", lambda s: (s["first"] <= F.col("rank")) & (F.col("rank") <= s["last"]))[0]
    return ranked.withColumn("_hit", hit).select(
        *[c for c in pieces.columns if c != "salt"],
        (F.col("_hit.sequence") + F.col("rank") - F.col("_hit.first")).alias("sequence_id"),
        F.col("_hit.offset").alias("offset"),
    )


def pack(docs: DataFrame, path: str, length: int = LENGTH, end_id: int = END_ID, keep_ids: bool = True) -> DataFrame:
    """doc_id, start, length, doc_tokens, ids_crc32, ids, sequence_id, offset for each piece. Without ``keep_ids`` the
    ids are reduced to their checksum where they are made and only the placement is moved."""
    return place(materialise(tokenise(docs, path, length, end_id, keep_ids), "pieces"), length)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, n_tokens, ids: the pieces of each sequence joined in order; at most ``length`` ids each."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), parts.alias("p")).select(
        "sequence_id", "n_tokens", F.aggregate("p", F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x["ids"])).alias("ids")
    )
