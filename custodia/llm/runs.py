"""Periodic runs: stretches of words that repeat with a period, found by splitting at rare words and scanning lags.

A run of at least MIN_WORDS words that holds its period twice holds each of its words twice or more. So a word that occurs once within a
segment (a text, to begin with) is in no run of it, and the segment falls into the parts beside such words; that is repeated
until nothing changes, and parts shorter than MIN_WORDS go. What survives is scanned by lags: words that equal the word q later, in a
stretch of q of them, include one whose position is a multiple of q, so only these are looked at, and a stretch is followed both ways from
them, exactly. A stretch of a multiple of its period shows up again under the same bounds and counts once, with the smallest.
Each document is worked on by itself where its rows lie: nothing is shuffled, and memory follows the largest text.

Defined results: a null text has no words and no run; rows with a null id are never rearranged; rows that repeat an id are worked on one by one;
an empty table gives no rows; other columns are not read, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import freed, parts, ship, text_or_empty, utf8, word_table

MIN_WORDS = 12
RESULT = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def looped(doc_id: int | None, n: int) -> tuple[int, int] | None:
    """The trial's rearrangement: from word a on, words repeat with period p; one document in ten."""
    if doc_id is None or n == 0:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


def find_runs(docs: DataFrame, rearrange: Callable[[int | None, int], tuple[int, int] | None] | None = None, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, n_words, runs (by start, then period) and collapsed (the words without what repeats the first period of a run, joined
    by one space). ``rearrange`` may give (a, p) for an id and a number of words: each word i >= a is then word a + (i - a) % p."""
    ship(docs.sparkSession)

    def run(batches):
        for batch in batches:
            for part in parts(batch):
                yield freed(_batch(part, rearrange, min_words))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(run, RESULT)


def _batch(batch: pa.RecordBatch, rearrange, min_words: int) -> pa.RecordBatch:
    raw, offs = utf8(batch.column("text"))
    _, _, row, number, known = word_table(raw, offs)
    n = np.bincount(row, minlength=batch.num_rows)
    first = np.cumsum(n) - n
    word = number.astype(np.int64)
    if rearrange:
        for r, i in enumerate(batch.column("doc_id").to_pylist()):
            if loop := rearrange(i, int(n[r])):
                a, p = loop
                at = np.arange(a, n[r])
                word[first[r] + at] = number[first[r] + a + (at - a) % p]
    found = np.array(sorted(_runs(word, row, min_words)), np.int64).reshape(-1, 3)
    start, period, length = found.T
    cover = np.zeros(len(word) + 1, np.int64)
    np.add.at(cover, start + period, 1)
    np.add.at(cover, start + length, -1)
    kept = np.cumsum(cover)[:-1] == 0
    of = row[start]
    fields = [pa.array(start - first[of]), pa.array(length), pa.array(period)]
    runs = pa.ListArray.from_arrays(pa.array(np.searchsorted(of, np.arange(len(n) + 1)), pa.int32()), pa.StructArray.from_arrays(fields, fields=list(_RUN)))
    words = pa.LargeListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(np.bincount(row[kept], minlength=len(n))))), pa.int64()), known.take(pa.array(word[kept])))
    collapsed = pc.binary_join(words, pa.scalar(b" ", pa.large_binary())).cast(pa.large_string()).cast(pa.string())
    return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), runs, collapsed], names=["doc_id", "n_words", "runs", "collapsed"])


def _survivors(word: np.ndarray, row: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions in segments that runs may lie in, and the segment of each."""
    at, segment = np.arange(len(word)), row.astype(np.int64)
    while len(at):
        _, inverse, count = np.unique(segment * (int(word.max()) + 1) + word[at], return_inverse=True, return_counts=True)
        often = count[inverse] > 1
        at, old = at[often], segment[often]
        cut = np.ones(len(at), bool)
        cut[1:] = (at[1:] != at[:-1] + 1) | (old[1:] != old[:-1])
        segment = np.cumsum(cut) - 1
        long = np.bincount(segment)[segment] >= min_words if len(at) else often[:0]
        at, segment = at[long], segment[long]
        if often.all() and long.all():
            break
    return at, segment


def _runs(word: np.ndarray, row: np.ndarray, min_words: int):
    """(start, period, length) of every run, positions as in ``word``."""
    at, segment = _survivors(word, row, min_words)
    if not len(at):
        return
    # between and around segments stand marks of which no two are equal, so no stretch leaves its segment
    shift = np.arange(len(at)) + 4 + 4 * (segment - segment[0])
    w = -np.arange(1, shift[-1] + 9)
    w[shift] = word[at]
    back = np.zeros(len(w), np.int64)
    back[shift] = at
    longest = int(np.bincount(segment - segment[0]).max())
    seen: set[tuple[int, int]] = set()
    # for each position a run that holds it, by number, to pass over its multiples
    holder = np.full(len(w), -1)
    ends, periods, known = [], [], ((), ())
    for q in range(1, longest // 2 + 1):
        hits = np.flatnonzero(w[:-q:q] == w[q::q]) * q
        if len(hits):
            # of the other words of a stretch, half or more are on one side
            reach = min(3, max(q, min_words - q) // 2)
            hits = hits[_beside(w, hits, q, range(1, reach + 1)) | _beside(w, hits, q, range(-reach, 0))]
        if len(hits) and ends:
            if len(known[0]) < len(ends):
                known = np.array(ends), np.array(periods)
            h = holder[hits]
            hits = hits[~((h >= 0) & (q % known[1][h] == 0) & (hits + q < known[0][h]))]
        upto = -1
        for t in hits.tolist():
            if t < upto:
                continue
            a, upto = _stretch(w, t, q)
            if upto + q - a >= max(min_words, 2 * q) and (a, upto + q) not in seen:
                seen.add((a, upto + q))
                free = holder[a : upto + q]
                free[free < 0] = len(ends)
                ends.append(upto + q)
                periods.append(q)
                yield int(back[a]), q, upto + q - a


def _beside(w: np.ndarray, at: np.ndarray, q: int, offsets: range) -> np.ndarray:
    """Whether the words at these offsets from a position equal those q later."""
    same = np.ones(len(at), bool)
    for j in offsets:
        i = at + j
        inside = (i >= 0) & (i + q < len(w))
        same &= inside & (w[np.where(inside, i, 0)] == w[np.where(inside, i + q, 1)])
    return same


def _stretch(w: np.ndarray, t: int, q: int) -> tuple[int, int]:
    """The widest [a, b) around t whose words equal those q later; marks end it before the array does."""
    b, step = t, 32
    while True:
        upto = min(b + step, len(w) - q)
        odd = np.flatnonzero(w[b:upto] != w[b + q : upto + q])
        if len(odd):
            b += int(odd[0])
            break
        b, step = upto, step * 4
    a, step = t, 32
    while True:
        start = max(0, a - step)
        odd = np.flatnonzero(w[start:a] != w[start + q : a + q])
        if len(odd):
            return start + int(odd[-1]) + 1, b
        a, step = start, step * 4


def digest(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, the longest run (start, length, period, exponent_milli) and checksums of the runs and of what is kept."""
    ranked = F.array_sort(F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("p"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))), F.lit("\n")))
    return found.withColumn("best", F.get(ranked, F.lit(0))).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.s").alias("start"),
        (-F.col("best.l")).alias("length"),
        F.col("best.p").alias("period"),
        F.expr("(1000 * -best.l) div best.p").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
