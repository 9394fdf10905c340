"""Substring deduplication: Rabin-Karp hashes of every window of words, counted in Spark.

Blocks of documents (a hash of the id decides) hash every window of ``width`` consecutive words with a
rolling polynomial. Within a block, later documents with a window of an earlier one are marked at once,
so a block sends at most the windows of its smallest document for each hash, however frequent a passage
is. Entries are dealt by hash to shards as packed columns sorted by hash; a shard finds the smallest
document of every hash and answers each block with one bit for each entry. The block is read again, in
the same order, marks its windows and merges them into maximal intervals.

Spark deals and brings together the entries; they are counted inside a shard's task, as packed columns. Windows count as
equal when 80 bits of hashes are: two polynomials, each over word codes of its own, finalised by a bijection. At n
windows about n**2 / 2**81 false matches are expected: less than one up to 10 TB of text, a hundred in 100 TB.

Defined results: a null text has no words; documents shorter than the window keep everything; rows
that repeat a doc_id never remove each other's words (the rule asks for a smaller id); rows without an id
count as the largest id; an empty table gives no rows. Other columns of the input are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BLOCK_BYTES, SHARD_ENTRIES, blocks, deal, freed, ids_of, mix, ordered, pack, prefix_hash, text_bytes, unpack, utf8, words

WIDTH = 50
ENTRIES = "shard int, block int, entries binary"
FLAGS = "block int, shard int, flags binary"
RESULT = "doc_id long, n_words long, spans array<struct<start:long,end:long>>, kept string"


def _windows(group: pa.Table, width: int):
    """Words and windows of a block: (raw, starts, ends, row of each word, rank of each row's id, first word, hash and second
    hash of each window)."""
    raw, offs = utf8(group["text"])
    starts, ends, row, code, other = words(raw, offs)
    ids = ids_of(group)
    sums, inverse = prefix_hash(code)
    first = np.arange(max(0, len(code) - width + 1))
    first = first[row[first] == row[first + width - 1]] if len(first) else first
    hashes = mix((sums[first + width] - sums[first]) * inverse[first])
    sums, _ = prefix_hash(other)
    second = (mix((sums[first + width] - sums[first]) * inverse[first]) >> np.uint64(48)).astype(np.uint16)
    return raw, starts, ends, row, ids, first, hashes, second


def _entries(group: pa.Table, width: int, n_shards: int):
    """What a block sends: windows of the smallest document of each hash, as positions in the list of windows
    by (hash, id, position). Returns (everything from _windows, order, sent mask, known-removed mask)."""
    got = _windows(group, width)
    row, ids, first, hashes, second = got[3:]
    doc = ids[row[first]]
    order = np.lexsort((first, doc, second, hashes))
    h, s, d = hashes[order], second[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (s[1:] != s[:-1])
    least = d[np.maximum.accumulate(np.where(new, np.arange(len(h)), 0))] if len(h) else d
    later = d > least
    # several windows of the smallest document share one entry
    return got, order, new, later


def _shard_of(hashes: np.ndarray, n: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def _deltas(sorted_hashes: np.ndarray) -> np.ndarray:
    return np.diff(sorted_hashes, prepend=np.uint64(0))


def mark_repeats(docs: DataFrame, width: int = WIDTH, block_bytes: int = BLOCK_BYTES, shard_entries: int = SHARD_ENTRIES) -> DataFrame:
    """doc_id, n_words, spans, kept for each row: ``spans`` are maximal runs of removed words [start, end), ``kept`` the
    other words joined by one space."""
    total = text_bytes(docs)
    base = blocks(docs, total, block_bytes=block_bytes)
    n_shards = max(1, total // 6 // shard_entries)  # about six bytes a word

    def _send(key, group):
        group = ordered(group)
        (_, _, _, row, ids, first, hashes, second), order, new, _ = _entries(group, width, n_shards)
        sent = order[new]
        h, doc, second = hashes[sent], ids[row[first[sent]]], second[sent]
        parts = deal(_shard_of(h, n_shards))
        block = key[0].as_py()
        blobs = [pack_entries(h[at], doc[at], second[at]) for _, at in parts]
        return pa.table({"shard": pa.array([s for s, _ in parts], pa.int32()), "block": pa.array([block] * len(parts), pa.int32()), "entries": pa.array(blobs, pa.binary())})

    def _decide(group):
        each = [unpack_entries(blob) for blob in group["entries"].to_pylist()]
        took = [len(e[0]) for e in each]
        h, doc, second = (np.concatenate(x) for x in zip(*each))
        del each
        order = np.lexsort((doc, second, h))
        hs, ss, ds = h[order], second[order], doc[order]
        new = np.ones(len(hs), bool)
        new[1:] = (hs[1:] != hs[:-1]) | (ss[1:] != ss[:-1])
        least = ds[np.maximum.accumulate(np.where(new, np.arange(len(hs)), 0))]
        flag = np.empty(len(hs), bool)
        flag[order] = ds > least
        cuts = np.cumsum([0, *took])
        return pa.table({"block": group["block"], "shard": group["shard"], "flags": pa.array([np.packbits(flag[a:b]).tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary())})

    def _finish(key, group, flags):
        group = ordered(group)
        (raw, starts, ends, row, ids, first, hashes, _), order, new, later = _entries(group, width, n_shards)
        sent = np.flatnonzero(new)
        told = dict(zip(flags["shard"].to_pylist(), flags["flags"].to_pylist()))
        answer = np.zeros(len(sent), bool)
        for s, at in deal(_shard_of(hashes[order[sent]], n_shards)):
            answer[at] = np.unpackbits(np.frombuffer(told[s], np.uint8), count=len(at)).astype(bool)
        gone = later | answer[np.cumsum(new) - 1] if len(order) else later
        hit = first[order[gone]]
        cover = np.zeros(len(row) + 1, np.int32)
        np.add.at(cover, hit, 1)
        np.add.at(cover, hit + width, -1)
        return result(group, raw, starts, ends, row, np.cumsum(cover)[:-1] > 0)

    def send(key, group):
        return freed(_send(key, group))

    def decide(group):
        return freed(_decide(group))

    def finish(key, group, flags):
        return freed(_finish(key, group, flags))

    shards = base.groupBy("block").applyInArrow(send, ENTRIES)
    flags = shards.groupBy("shard").applyInArrow(decide, FLAGS)
    return base.groupBy("block").cogroup(flags.groupBy("block")).applyInArrow(finish, RESULT)


def pack_entries(hashes: np.ndarray, doc: np.ndarray, *more: np.ndarray) -> bytes:
    """Sorted hashes as differences, documents as ranks in the list of their ids, and what else is given."""
    known, rank = np.unique(doc, return_inverse=True)
    head = pack(np.diff(known, prepend=0))
    return len(head).to_bytes(4, "little") + head + pack(_deltas(hashes), rank.astype(np.uint16 if len(known) < 65536 else np.uint32), *more)


def unpack_entries(blob: bytes) -> tuple[np.ndarray, ...]:
    n = int.from_bytes(blob[:4], "little")
    known = np.cumsum(unpack(blob[4 : 4 + n])[0])
    deltas, rank, *more = unpack(blob[4 + n :])
    return np.cumsum(deltas), known[rank], *more


def result(group: pa.Table, raw, starts, ends, row, gone) -> pa.Table:
    """Intervals and kept words of each row of a block."""
    cuts = np.searchsorted(row, np.arange(len(group) + 1))
    data = raw.tobytes()
    spans, kept = [], []
    for r in range(len(group)):
        a, b = cuts[r], cuts[r + 1]
        g = gone[a:b]
        edge = np.flatnonzero(np.diff(np.concatenate(([0], g.astype(np.int8), [0]))))
        spans.append([{"start": int(s), "end": int(e)} for s, e in zip(edge[::2], edge[1::2])])
        keep = np.flatnonzero(~g) + a
        kept.append(b" ".join([data[s:e] for s, e in zip(starts[keep].tolist(), ends[keep].tolist())]))
    return pa.table({
        "doc_id": group["doc_id"],
        "n_words": pa.array(np.diff(cuts), pa.int64()),
        "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
        "kept": pa.array(kept, pa.binary()).cast(pa.string()),
    })


def digest(marked: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256."""
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return marked.select("doc_id", "n_words", removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))
