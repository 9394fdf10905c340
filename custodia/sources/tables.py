"""Tables that people saved as text, of any encoding and separator, read in ranges even where quoted fields span lines.

Whether a line break ends a record depends on all quotes before it. So each range of a file is read once for what it does to the state of
a reader that enters it (at the start of a field, within one, within quotes, after a quote): four states in, four out. These maps are
put together in the order of the ranges, after which every range knows the state in which it begins and can be parsed alone. Records belong
to the range before whose end they begin, the one at its end included.
"""

from __future__ import annotations

import csv
import io
import re
import sys
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.common import materialise, ship
from .opening import open_path

#: Bytes that a task parses at a time.
RANGE_BYTES = 32 << 20
#: Rows of a batch.
ROWS = 1 << 14

FIELD_START, FIELD, QUOTED, QUOTE = range(4)
_MARK = b"\xef\xbb\xbf"


def _cp1252() -> dict[int, str]:
    """The characters in which ISO-8859-1 and cp1252 differ; bytes that cp1252 does not know stay control characters."""
    known = {b: bytes([b]).decode("cp1252", "ignore") for b in range(0x80, 0xA0)}
    return {b: c for b, c in known.items() if c}


_CP1252 = _cp1252()


def decode(data: bytes, utf8: bool) -> str:
    return data.decode("utf-8") if utf8 else data.decode("latin-1").translate(_CP1252)


@lru_cache(64)
def _event(sep: bytes) -> re.Pattern:
    """What matters within an unquoted field: the end of a record, or a separator with a quote behind it."""
    return re.compile(rb"[\r\n]|" + re.escape(sep) + b'"')


@lru_cache(64)
def _opening(sep: bytes) -> re.Pattern:
    return re.compile(rb"[\r\n" + re.escape(sep) + b']"')


def _end_state(data: bytes, at: int, state: int, sep: bytes) -> int:
    """The state after all of ``data`` from ``at`` on."""
    n, breaks = len(data), sep + b"\r\n"
    while at < n:
        if state == QUOTED:
            at = data.find(b'"', at) + 1
            if at == 0:
                return QUOTED
            state = QUOTE
        elif state == QUOTE:
            c = data[at : at + 1]
            state = QUOTED if c == b'"' else FIELD_START if c in breaks else FIELD
            at += 1
        elif state == FIELD_START and data[at : at + 1] == b'"':
            state, at = QUOTED, at + 1
        else:
            found = _opening(sep).search(data, at)
            if not found:
                return FIELD_START if data[-1:] in breaks else FIELD
            state, at = QUOTED, found.end()
    return state


def _record_end(data: bytes, at: int, state: int, sep: bytes) -> tuple[int, int]:
    """(place behind the first record end from ``at`` on, or -1; state at the end of ``data`` if there is none)."""
    n = len(data)
    while at < n:
        if state == QUOTED:
            at = data.find(b'"', at) + 1
            if at == 0:
                return -1, QUOTED
            state = QUOTE
        elif state == QUOTE and data[at : at + 1] == b'"':
            state, at = QUOTED, at + 1
        elif state == FIELD_START and data[at : at + 1] == b'"':
            state, at = QUOTED, at + 1
        else:
            # after a quote, a separator or a line break counts; anything else goes on as a field without quotes
            if state == FIELD_START or state == QUOTE:
                c = data[at : at + 1]
                if c not in b"\r\n":
                    state, at = FIELD_START if c == sep else FIELD, at + 1
                    continue
            found = _event(sep).search(data, at)
            if not found:
                return -1, FIELD_START if data[-1:] == sep else FIELD
            if found.group() in (b"\r", b"\n"):
                at = found.end()
                return at + (found.group() == b"\r" and data[at : at + 1] == b"\n"), FIELD_START
            state, at = QUOTED, found.end()
    return -1, state


def _utf8_facts(data: bytes, more: bytes, first: bool) -> tuple[bool, int, int]:
    """(whether the range is UTF-8 but for a character cut at its start, bytes of that character in this range, bytes that the last
    one lacks): in a file in UTF-8 the numbers of neighbours agree."""
    lead = 0
    while not first and lead < min(4, len(data)) and data[lead] & 0xC0 == 0x80:
        lead += 1
    lack = 0
    for back in range(1, min(4, len(data) - lead + 1)):
        b = data[-back]
        if b >= 0xC0:
            lack = max(0, (2 if b < 0xE0 else 3 if b < 0xF0 else 4) - back)
        if b & 0xC0 != 0x80:
            break
    try:
        (data[lead:] + more[:lack]).decode("utf-8")
    except UnicodeDecodeError:
        return False, lead, lack
    return True, lead, lack


def _heads(files: DataFrame) -> DataFrame:
    """path, length -> and sep, begin (behind a mark), header (fields of the first record that is not blank)."""

    def run(batches):
        csv.field_size_limit(sys.maxsize)
        for b in batches:
            seps, begins, headers = [], [], []
            for path in b.column(0).to_pylist():
                with open_path(path) as f:
                    data, most = b"", 1 << 16
                    while True:
                        more = f.read(most)
                        data, most = data + more, most * 4
                        begin = 3 if data.startswith(_MARK) else 0
                        start = begin + len(data[begin:]) - len(data[begin:].lstrip(b"\r\n"))
                        line = re.split(rb"[\r\n]", data[start : start + len(data)], maxsplit=1)[0]
                        sep = b";" if b";" in line and b"," not in line else b","
                        end = _record_end(data, start, FIELD_START, sep)[0]
                        if not more or (end >= 0 and end < len(data)):
                            break
                record = data[start : end if end >= 0 else len(data)]
                try:
                    text = decode(record, True)
                except UnicodeDecodeError:
                    text = decode(record, False)
                fields = next((r for r in csv.reader(io.StringIO(text, newline=""), delimiter=sep.decode()) if r), [])
                seps.append(sep.decode())
                begins.append(begin)
                headers.append([h.strip() for h in fields])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(seps, pa.string()), pa.array(begins, pa.int64()), pa.array(headers, pa.list_(pa.string()))], names=["path", "length", "sep", "begin", "header"])

    return files.select("path", "length").mapInArrow(run, "path string, length long, sep string, begin long, header array<string>")


def _ranges(heads: DataFrame, size: int) -> DataFrame:
    size = max(size, 8)  # no character is longer than a range
    starts = F.sequence("begin", F.greatest("length", F.col("begin") + 1) - 1, F.lit(size).cast("long"))
    cut = heads.select("path", "length", "sep", "begin", "header", F.explode(starts).alias("start"))
    tasks = cut.sparkSession.sparkContext.defaultParallelism * 4
    return cut.withColumn("end", F.least(F.col("start") + size, "length")).repartition(tasks, "path", "start")


def _states(ranges: DataFrame) -> DataFrame:
    """path, utf8, and for each range start, state (at its start), state_end."""

    def run(batches):
        for b in batches:
            out = []
            for path, begin, start, end, sep in zip(*(b.column(c).to_pylist() for c in ("path", "begin", "start", "end", "sep"))):
                with open_path(path) as f:
                    f.seek(start)
                    data, more = f.read(end - start), f.read(3)
                utf8, lead, lack = _utf8_facts(data, more, start == begin)
                out.append((path, start, [_end_state(data, 0, s, sep.encode()) for s in range(4)], utf8, lead, lack))
            cols = list(zip(*out)) or [()] * 6
            kinds = [pa.string(), pa.int64(), pa.list_(pa.int32()), pa.bool_(), pa.int32(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(cols, kinds)], names=["path", "start", "map", "utf8", "lead", "lack"])

    told = ranges.select("path", "begin", "start", "end", "sep").mapInArrow(run, "path string, start long, map array<int>, utf8 boolean, lead int, lack int")
    by = told.groupBy("path").agg(F.array_sort(F.collect_list(F.struct("start", "map", "utf8", "lead", "lack"))).alias("r"))
    agree = "aggregate(r, named_struct('ok', true, 'lack', 0), (a, x) -> named_struct('ok', a.ok AND x.utf8 AND x.lead = a.lack, 'lack', x.lack), a -> a.ok AND a.lack = 0)"
    steps = f"aggregate(r, named_struct('s', {FIELD_START}, 'all', CAST(array() AS array<struct<start: bigint, state: int, state_end: int>>)), (a, x) -> named_struct('s', x.map[a.s], 'all', concat(a.all, array(named_struct('start', x.start, 'state', a.s, 'state_end', x.map[a.s])))), a -> a.all)"
    return by.select("path", F.expr(agree).alias("utf8"), F.explode(F.expr(steps)).alias("s")).select("path", "utf8", "s.*")


def _owned(f, start: int, end: int, length: int, begin: int, state: int, state_end: int, sep: bytes) -> bytes:
    """The records of a range: those that begin behind its start (its first one too, for a file's first range) up to its end."""
    f.seek(start)
    data = f.read(end - start + 1)  # one more, for a line feed after the last carriage return
    own = end - start
    b = 0 if start == begin else _record_end(data[: own + 1], 0, state, sep)[0]
    if b < 0 or b > own:  # no record begins here; behind the end is a line feed only
        return b""
    if end >= length:
        return data[b:own]
    tail, more, s = data[own:], [data[b:own]], state_end
    step = 1 << 16
    while True:
        e, after = _record_end(tail, 0, s, sep)
        fresh = f.read(1 if e == len(tail) else step)
        if e >= 0 and (e < len(tail) or not fresh):
            more.append(tail[:e])
            return b"".join(more)
        if e >= 0:  # a carriage return at the end of what was read
            more.append(tail[:e] + (fresh if fresh == b"\n" and tail.endswith(b"\r") else b""))
            return b"".join(more)
        if not fresh:
            more.append(tail)
            return b"".join(more)
        more.append(tail)
        tail, s, step = fresh, after, step * 4


def read_dirty_csv(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES, place: bool = False) -> DataFrame:
    """The rows of one table or many: UTF-8 with or without a mark, else cp1252, and ``;`` if the first line has no comma, both found for
    each file. Columns are those of all headers in the order of the files, without blanks around; of equal headers the last counts;
    short rows have nulls, and what a row has beyond its header is left out, as are blank lines. ``table_notes`` tells what was found. With
    ``place``, a column _place orders the rows: by path, then as they stand."""
    ship(spark)
    heads = materialise(_heads(_files(spark, path)), "table-heads")
    first = heads.groupBy("header").agg(F.min("path").alias("path")).orderBy("path")
    names = list(dict.fromkeys(h for r in first.collect() for h in r["header"]))
    if not names:
        return spark.range(0).select(F.struct(F.lit("").alias("path"), F.col("id").alias("start"), F.col("id").alias("n")).alias("_place")) if place else spark.range(0).drop("id")
    ranges = _ranges(heads, range_bytes)
    due = ranges.join(_states(ranges), ["path", "start"])

    def run(batches):
        csv.field_size_limit(sys.maxsize)
        for b in batches:
            columns = ("path", "length", "sep", "begin", "header", "start", "end", "utf8", "state", "state_end")
            for path, length, sep, begin, header, start, end, utf8, state, state_end in zip(*(b.column(c).to_pylist() for c in columns)):
                with open_path(path) as f:
                    data = _owned(f, start, end, length, begin, state, state_end, sep.encode())
                place = {h: i for i, h in enumerate(header)}
                at = [place.get(n, -1) for n in names]
                rows = csv.reader(io.StringIO(decode(data, utf8), newline=""), delimiter=sep)
                filled = (r for r in rows if r)
                if start == begin:
                    next(filled, None)
                n = 0
                for batch in _batches(filled, at):
                    if place:
                        many = len(batch)
                        where = [pa.array([path] * many, pa.string()), pa.array([start] * many, pa.int64()), pa.array(range(n, n + many), pa.int64())]
                        batch, n = batch.append_column("_place", pa.StructArray.from_arrays(where, names=["path", "start", "n"])), n + many
                    yield batch

    schema = ", ".join("`{}` string".format(f"_{i}") for i in range(len(names)))
    found = due.mapInArrow(run, schema + (", _place struct<path: string, start: bigint, n: bigint>" if place else ""))
    return found.toDF(*names, *(["_place"] if place else []))


def _batches(rows, at: list[int]):
    held: list[list[str]] = []
    names = [f"_{i}" for i in range(len(at))]

    def batch():
        return pa.RecordBatch.from_arrays([pa.array([r[i] if 0 <= i < len(r) else None for r in held], pa.string()) for i in at], names=names)

    for r in rows:
        held.append(r)
        if len(held) == ROWS:
            yield batch()
            held.clear()
    if held:
        yield batch()


def _files(spark: SparkSession, path: str) -> DataFrame:
    """path, length of the files; their content is not read."""
    found = spark.read.format("binaryFile").load(path).select("path", "length").where("length > 0")
    return found.repartition(spark.sparkContext.defaultParallelism * 4)


def table_notes(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Path, bytes, sep, utf8, notes: what a reader of the tables should know."""
    ship(spark)
    heads = materialise(_heads(_files(spark, path)), "table-heads")
    utf8 = _states(_ranges(heads, range_bytes)).groupBy("path").agg(F.bool_and("utf8").alias("utf8"))
    notes = F.array_compact(F.array(F.when(~F.col("utf8"), "file was not UTF-8; decoded as cp1252"), F.when(F.col("sep") == ";", "semicolon-delimited CSV detected")))
    return heads.join(utf8, "path").select("path", F.col("length").alias("bytes"), "sep", "utf8", notes.alias("notes"))
