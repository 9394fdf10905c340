"""Logs scanned for keys in any spelling, in one reading of every line."""

from __future__ import annotations

import heapq
import uuid
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructType

from ..functions.common import col, materialise, ship
from ..functions.keys import key_display
from .state import last_lines

#: Bytes of spellings and keys that one automaton is built from. A table beyond it is cut by key, and each part reads the lines once.
PATTERN_BYTES = 16 << 20
#: Bytes of lines that a task keeps before it hands on what it has found so far.
HELD_BYTES = 32 << 20

_AUTOMATA: dict[str, tuple] = {}


def spellings(key: Column | str, tag: str = "SITE") -> Column:
    """The ways in which logs mention a key: with a blank or an underscore, without leading zeros if it is a number only, as displayed."""
    k, t = col(key), F.lit(tag + " ")
    plain = F.when(k.rlike("^[0-9]+$"), F.concat(t, F.regexp_replace(k, "^0+(?=[0-9])", "")))
    return F.array_distinct(F.array_compact(F.array(F.concat(t, k), F.concat(F.lit(tag + "_"), k), plain, F.concat(t, key_display(k)))))


def scan_logs(lines: DataFrame, keys: DataFrame, words: list[str], n: int = 5) -> tuple[DataFrame, DataFrame]:
    """(line_no, line) x (key, spelling) -> lines that hold any spelling of a key, counted once; and the last ``n`` of them that
    also hold a word, without blanks at their ends. ``line_no`` may be of any type that has an order. Letters count as they are
    written, and a spelling may stand inside a longer word. Empty spellings and null lines are in nothing.

    The spellings become an Aho-Corasick automaton, which a task runs over each line once, so work grows with the bytes of the logs
    alone. A task counts by key and keeps the last ``n`` lines of each; these, not the lines, are shuffled."""
    spark = lines.sparkSession
    ship(spark)
    spelt = keys.where((F.length("spelling") > 0) & F.col("key").isNotNull()).select(F.col("key").cast("string").alias("key"), "spelling").distinct()
    size = spelt.agg(F.sum(F.octet_length("spelling") + F.octet_length("key") + 64)).first()[0] or 0
    parts = max(1, -(-size // PATTERN_BYTES))
    place = lines.schema["line_no"].dataType
    out = StructType().add("key", StringType()).add("n", LongType()).add("last", ArrayType(StructType().add("line_no", place).add("line", StringType())))
    raw = lines.where("line is not null").select("line_no", F.col("line").cast("binary").alias("line"))
    found = None
    for i in range(parts):
        by: dict[str, list[str]] = {}
        for r in spelt.where(F.pmod(F.xxhash64("key"), F.lit(parts)) == i).collect():
            by.setdefault(r["spelling"], []).append(r["key"])
        one = raw.mapInArrow(_scanner(uuid.uuid4().hex, spark.sparkContext.broadcast(by), tuple(words), n), out)
        found = one if found is None else found.unionByName(one)
    found = materialise(found, "log-hits")
    counts = found.groupBy("key").agg(F.sum("n").alias("n_lines"))
    return counts, last_lines(found.select("key", F.inline("last")), n)


def _automaton(name: str, patterns) -> tuple:
    """(automaton, keys) of a broadcast table, built once by each worker."""
    if name not in _AUTOMATA:
        import ahocorasick

        machine, keys = ahocorasick.Automaton(), {}
        for spelling, names in patterns.value.items():
            machine.add_word(spelling, tuple(keys.setdefault(k, len(keys)) for k in names))
        machine.make_automaton()
        _AUTOMATA.clear()
        _AUTOMATA[name] = machine, list(keys)
    return _AUTOMATA[name]


def _scanner(name: str, patterns, words: tuple[str, ...], n: int):
    def run(batches: Iterable[pa.RecordBatch]):
        machine, keys = _automaton(name, patterns)
        counts: dict[int, int] = {}
        last: dict[int, list] = {}
        held = 0
        names, kind = ["key", "n", "last"], None
        for batch in batches:
            kind = batch.schema.field(0).type
            for i, data in enumerate(batch.column(1).to_pylist() if len(machine) else ()):
                line = data.decode("utf-8", "replace")
                hit = {k for _, ks in machine.iter(line) for k in ks}
                if not hit:
                    continue
                told = any(w in line for w in words)
                at = batch.column(0)[i].as_py() if told else None
                order = tuple(at.values()) if isinstance(at, dict) else at
                for k in hit:
                    counts[k] = counts.get(k, 0) + 1
                    if told:
                        kept = last.setdefault(k, [])
                        (heapq.heappush if len(kept) < n else heapq.heappushpop)(kept, (order, at, line.strip()))
                        held += len(data)
                if held > HELD_BYTES:
                    yield _found(counts, last, keys, kind, names)
                    counts, last, held = {}, {}, 0
        if counts:
            yield _found(counts, last, keys, kind, names)

    return run


def _found(counts: dict, last: dict, keys: list[str], kind: pa.DataType, names: list[str]) -> pa.RecordBatch:
    lines = pa.array([[{"line_no": at, "line": line} for _, at, line in last.get(k, ())] for k in counts], pa.list_(pa.struct([("line_no", kind), ("line", pa.string())])))
    return pa.RecordBatch.from_arrays([pa.array([keys[k] for k in counts], pa.string()), pa.array(list(counts.values()), pa.int64()), lines], names=names)
