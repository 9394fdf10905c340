"""Numbers and samples of rows in order, without one task over all of them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from ..functions.common import materialise, ship


def ranges(rows: DataFrame, by: list[str], order: list[Column]) -> DataFrame:
    """``rows`` dealt by ranges of the order within ``by`` (columns _o0, _o1, ...) and written, with the number of the range, _range. A hot group
    is several ranges."""
    keyed = rows.select("*", *(c.alias(f"_o{i}") for i, c in enumerate(order)))
    spread = keyed.repartitionByRange(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by, *(f"_o{i}" for i in range(len(order))))
    return materialise(spread.withColumn("_range", F.spark_partition_id()), "ranges")


def starts(dealt: DataFrame, by: list[str], sums: dict[str, str] | None = None, total: bool = False) -> DataFrame:
    """One row for each range and group of ``ranges``: the group (_by_...), _start (the range), rows and sums before it (_n_before, _x_before), sums
    of its own (_x) and, with ``total``, the rows of the group (_total)."""
    sums = sums or {}
    before = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    held = dealt.groupBy(*by, "_range").agg(F.count("*").alias("_n"), *(F.sum(c).alias(f"_{s}") for s, c in sums.items()))
    own = [F.col(b).alias(f"_by_{b}") for b in by]
    start = held.select(*own, F.col("_range").alias("_start"), *(f"_{s}" for s in sums), *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in ("_n", *(f"_{s}" for s in sums))))
    if total:
        start = start.join(held.groupBy(*(F.col(b).alias(f"_of_{b}") for b in by)).agg(F.sum("_n").alias("_total")), _equal(by, "_by_", "_of_"))
    return start


def number(dealt: DataFrame, start: DataFrame, by: list[str], number: str, sums: dict[str, str] | None = None, total: str | None = None, more: Sequence[str] = ()) -> DataFrame:
    """Rows of ``ranges`` that have a row in ``starts``, with ``number`` (from 1) and running sums: those within a range go on from its
    start. ``more`` names further columns of ``starts`` to keep."""
    sums = sums or {}
    keys = sorted((c for c in dealt.columns if c.startswith("_o") and c[2:].isdigit()), key=lambda c: int(c[2:]))
    within = Window.partitionBy(*by, "_range").orderBy(*keys)
    inner = dealt.withColumn("_row", F.row_number().over(within))
    for s, c in sums.items():
        inner = inner.withColumn(s, F.coalesce(F.sum(c).over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    joined = inner.join(start, (F.col("_range") == F.col("_start")) & _equal(by, "", "_by_"))
    totals = [F.col("_total").alias(total)] if total else []
    kept = [c for c in dealt.columns if c not in keys and c != "_range"]
    return joined.select(*kept, (F.col("_row") + F.col("_n_before")).alias(number), *((F.col(s) + F.col(f"_{s}_before")).alias(s) for s in sums), *totals, *more)


def running(rows: DataFrame, by: list[str], order: list[Column], name: str, sums: dict[str, str] | None = None, total: str | None = None) -> DataFrame:
    """``rows`` with the number ``name`` (from 1) in the order within ``by`` (all rows, if empty), and running sums of what comes before:
    ``sums`` maps new columns to summed ones; ``total`` names a column for the number of rows within ``by``.

    Rows are dealt by ranges of the order and written, so a hot group is several ranges; numbers and sums within a range go
    on from those of the ranges before, a table of one row for each range and group."""
    dealt = ranges(rows, by, order)
    return number(dealt, starts(dealt, by, sums, bool(total)), by, name, sums, total)


def _equal(by: list[str], left: str, right: str) -> Column:
    return reduce(lambda a, b: a & F.col(f"{left}{b}").eqNullSafe(F.col(f"{right}{b}")), by, F.lit(True))


def first_names(rows: DataFrame, by: list[str], n: int = 10, name: str = "name") -> DataFrame:
    """By ``by``: names (the ``n`` smallest distinct ones) and n_names (how many there are). Repeats go first, spread by group and
    name; each task counts what it is left with and keeps ``n`` names of a group, and only these are merged by group."""
    ship(rows.sparkSession)
    distinct = rows.where(F.col(name).isNotNull()).select(*by, F.col(name).alias("_name")).distinct()
    out = StructType([*(distinct.schema[b] for b in by), StructField("_names", ArrayType(distinct.schema["_name"].dataType)), StructField("_n", LongType())])
    parts = distinct.mapInArrow(_least(len(by), n), out)
    least = F.slice(F.array_sort(F.flatten(F.collect_list("_names"))), 1, n)
    return parts.groupBy(*by).agg(least.alias("names"), F.sum("_n").alias("n_names"))


def _least(n_keys: int, n: int):
    """Counts of a task's rows by their first columns, and the ``n`` least of the last one."""

    def run(batches):
        import heapq

        names: dict[tuple, list] = {}
        counts: dict[tuple, int] = {}
        kinds = None
        for b in batches:
            kinds = b.schema
            columns = [c.to_pylist() for c in b.columns]
            fresh: dict[tuple, list] = {}
            for *key, name in zip(*columns):
                fresh.setdefault(tuple(key), []).append(name)
            for key, found in fresh.items():
                counts[key] = counts.get(key, 0) + len(found)
                # texts: the order of UTF-8 is that of code points
                names[key] = heapq.nsmallest(n, names.get(key, []) + found)
        if counts:
            keys = [pa.array([k[i] for k in counts], kinds.field(i).type) for i in range(n_keys)]
            rows = [pa.array([names[k] for k in counts], pa.list_(kinds.field(n_keys).type)), pa.array(list(counts.values()), pa.int64())]
            yield pa.RecordBatch.from_arrays([*keys, *rows], names=[*(kinds.field(i).name for i in range(n_keys)), "_names", "_n"])

    return run


def names_text(names: Column, count: Column) -> Column:
    """The names, and how many there are if more."""
    shown = F.array_join(names, ", ")
    return F.when(count > F.size(names), F.concat(shown, F.lit(", ... ("), count.cast("string"), F.lit(")"))).otherwise(shown)
