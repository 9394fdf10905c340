"""Suffix-array deduplication with a logarithmic family of suffix arrays.

A byte goes if a string of ``width`` bytes that covers it also starts earlier: in a document with a smaller
doc_id, or earlier in the same one. Strings are judged on the input and never cross documents.

1. Blocks of documents pick anchors: positions such that equal strings of ``width`` bytes have anchors with equal
   k-mers at equal distances. Suffixes that can match are thereby known by their anchor's k-mer, and the
   suffix space is dealt to shards by it. A block sends each anchor's hashes (of the k-mer, and of the whole
   context of its windows) once for the block's smallest document; contexts of the same bytes after it are repeats.
2. A shard answers for each entry whether other blocks hold its k-mer. Only then do its strings go on.
3. The blocks send these contexts as text. Each shard keeps a family of suffix arrays: a batch of contexts gets its
   suffix array (positions in the text, suffixes compared on ``width`` bytes), is merge-scanned against the existing
   levels, where the earlier of two equal strings stays and the other is a repeat, and what is new becomes
   a level; levels that are not larger than the one that arrives merge with it, so sizes grow
   geometrically. A k-mer with very many contexts is dealt by whole strings instead, so that no frequent line is one
   shard's work.
4. Blocks read their documents again, cover the repeats and cut the covered runs out.

Strings are compared by their bytes, with one exception that bounds a shard's work: of one context, which very many blocks hold,
those after the first ``SAME`` blocks are known as repeats by 128 bits of hash.

Defined results: a null text has no bytes; rows that repeat a doc_id are ordered by text, and all but the first of equal
ones are repeats; rows without an id come last, by block; shorter documents keep everything; an empty table
gives no rows. Kept bytes may end inside a character, so they are binary. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BYTE_CODE, blocks, deal, freed, ids_of, mix, ordered, pack, prefix_hash, text_bytes, unpack, utf8
from .substring_dedup import pack_entries, unpack_entries

#: Bytes of a repeated string, and of the k-mers that anchor it.
WIDTH, KMER = 100, 24


def anchors(raw: np.ndarray, offs: np.ndarray, width: int = WIDTH, kmer: int = KMER):
    """Anchors of a block. Every string of ``width`` bytes has one: its k-mer of the smallest hash, the leftmost of
    equals, so equal strings have equal anchors at equal distances. Windows of one anchor are consecutive.

    Returns (position, first window, last window, hash of the k-mer, hash of all bytes of the windows)."""
    n = len(raw)
    sums, inverse = prefix_hash(BYTE_CODE[raw])
    if n < width:
        z = np.zeros(0, np.int64)
        return z, z, z, z.astype(np.uint64), z.astype(np.uint64)
    code = sums[kmer:] - sums[:-kmer]
    code *= inverse[: n - kmer + 1]
    code = mix(code)
    bits = np.uint64(max(1, int(n).bit_length()))
    at = np.arange(len(code), dtype=np.uint64)
    low = code >> bits
    low <<= bits
    low |= at
    del at
    span, reach = width - kmer + 1, 1
    while reach * 2 <= span:  # minima over spans of 1, 2, 4, ...
        low = np.minimum(low[:-reach], low[reach:])
        reach *= 2
    if reach < span:
        low = np.minimum(low[: len(low) - (span - reach)], low[span - reach :])
    where = (low & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    ok = np.ones(n - width + 1, bool)  # windows inside one row
    for edge in offs[1:-1].tolist():
        ok[max(0, edge - width + 1) : min(edge, len(ok))] = False
    begin = np.arange(len(ok))[ok]
    where = where[ok]
    new = np.ones(len(begin), bool)
    new[1:] = (where[1:] != where[:-1]) | (begin[1:] != begin[:-1] + 1)
    head = np.flatnonzero(new)
    first, last, pos = begin[head], begin[np.append(head[1:], len(begin)) - 1], where[head]
    whole = mix((sums[last + width] - sums[first]) * inverse[first] + mix((last - first).astype(np.uint64) * np.uint64(131) + (pos - first).astype(np.uint64)))
    return pos, first, last, code[pos], whole


#: Input bytes for each shard, contexts in a batch of a shard, contexts of one k-mer from which it is dealt by strings, and blocks
#: of which one context is compared by bytes.
SHARD_BYTES, BATCH, HOT, SAME = 2 << 20, 8192, 4096, 1024
#: Bytes of a block; a task needs about 120 bytes of memory for each of them.
BLOCK_BYTES = 3 << 19
ENTRIES = "shard int, block int, entries binary"
CODES = "block int, shard int, codes binary"
RESULT = "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary"
UNIQUE, REPEAT, COMPARE, BY_STRING = 0, 1, 2, 3


def _flat(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All positions of the ranges [begin, begin + size), one after the other."""
    return np.repeat(begin - np.cumsum(size) + size, size) + np.arange(size.sum())


def same_bytes(raw: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether raw[a:a + size] and raw[b:b + size] agree; sizes are above 0."""
    if not len(a):
        return np.zeros(0, bool)
    return np.logical_and.reduceat(raw[_flat(a, size)] == raw[_flat(b, size)], np.cumsum(size) - size)


def _shard_of(hashes: np.ndarray, n: int) -> np.ndarray:
    """Anchors have small hashes, so callers mix them once more."""
    return ((hashes >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


class Block:
    """The anchors of a block and what it sends of them; the same whenever the block is read."""

    def __init__(self, group: pa.Table, width: int, kmer: int):
        self.raw, self.offs = utf8(group["text"])
        self.ids = ids_of(group)
        self.pos, self.first, self.last, self.kmer, self.whole = anchors(self.raw, self.offs, width, kmer)
        self.doc = self.ids[np.searchsorted(self.offs, self.first, side="right") - 1]
        order = np.lexsort((self.pos, self.doc, self.whole, self.kmer))  # by k-mer, context, document and position
        k, w = self.kmer[order], self.whole[order]
        new = np.ones(len(order), bool)
        new[1:] = (k[1:] != k[:-1]) | (w[1:] != w[:-1])
        # equal hashes are looked at by their bytes; what is not the same after all is sent like any other
        rest = np.flatnonzero(~new)
        a, b = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))[rest]], order[rest]
        size = self.last - self.first + width
        alike = (size[a] == size[b]) & (self.pos[a] - self.first[a] == self.pos[b] - self.first[b])
        alike[alike] = same_bytes(self.raw, self.first[a[alike]], self.first[b[alike]], size[a[alike]])
        new[rest[~alike]] = True
        self.sent, self.again = order[new], order[~new]  # anchors that are sent, and repeats within the block

    def codes(self, told: dict[int, bytes], n_shards: int) -> np.ndarray:
        """The shards' answers, for each anchor that was sent."""
        out = np.zeros(len(self.sent), np.uint8)
        for s, at in deal(_shard_of(mix(self.kmer[self.sent]), n_shards)):
            out[at] = unpack(told[s])[0]
        return out

    def contexts(self, codes: np.ndarray, width: int):
        """(first window, last window, k-mer or string hash, id) of the contexts that are compared by bytes, one for each
        distinct one, by position; and windows known as repeats. Contexts of very frequent k-mers are cut into single strings."""
        some, many = self.sent[codes == COMPARE], self.sent[codes == BY_STRING]
        first, last, key, doc = self.first[some], self.last[some], self.kmer[some], self.doc[some]
        n = self.last[many] - self.first[many] + 1
        single = np.repeat(self.first[many], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        if not len(single):
            order = np.argsort(first, kind="stable")
            return first[order], last[order], key[order], doc[order], single
        sums, inverse = prefix_hash(BYTE_CODE[self.raw])
        h, d = mix((sums[single + width] - sums[single]) * inverse[single]), np.repeat(self.doc[many], n)
        order = np.lexsort((single, d, h))
        new = np.ones(len(order), bool)
        new[1:] = h[order][1:] != h[order][:-1]
        rest = np.flatnonzero(~new)
        a, b = single[order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))[rest]]], single[order[rest]]
        new[rest[~same_bytes(self.raw, a, b, np.full(len(a), width))]] = True
        one = order[new]
        known = single[order[~new]]
        first, last = np.append(first, single[one]), np.append(last, single[one])
        key, doc = np.append(key, h[one]), np.append(doc, d[one])
        order = np.argsort(first, kind="stable")
        return first[order], last[order], key[order], doc[order], known


class Family:
    """Suffix arrays of geometrically growing sizes over the text ``data``. A suffix is known by its number: it starts at
    ``at[number]``, is compared on ``width`` bytes, and ``age[number]`` orders it; the youngest of equals are repeats."""

    def __init__(self, data: np.ndarray, at: np.ndarray, age: np.ndarray, width: int):
        self.windows, self.at, self.age, self.width = np.lib.stride_tricks.sliding_window_view(data, width), at, age, width
        self.levels: list[np.ndarray] = []

    def _strings(self, suffixes: np.ndarray) -> np.ndarray:
        return np.ascontiguousarray(self.windows[self.at[suffixes]]).view(f"S{self.width}").reshape(-1)

    def _merged(self, held: np.ndarray, new: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Both arrays as one, whether each suffix has the string of the one before it, and whether it is of the new ones."""
        both = np.concatenate((held, new))
        strings = self._strings(both)
        order = np.argsort(strings, kind="stable")  # two sorted runs: they are merged
        strings = strings[order]
        same = np.zeros(len(both), bool)
        same[1:] = strings[1:] == strings[:-1]
        return both[order], same, order >= len(held)

    def add(self, batch: np.ndarray) -> np.ndarray:
        """Take in the suffixes ``batch``; returns those that turn out to be repeats, old or new."""
        new, same, _ = self._merged(np.zeros(0, np.int64), batch[np.argsort(self.age[batch], kind="stable")])
        repeats = [new[same]]  # equal suffixes stand by age
        new = new[~same]
        for i, level in enumerate(self.levels):
            both, same, fresh = self._merged(level, new)
            hit = np.flatnonzero(same)  # one of the level stands before one of the batch
            old, young = both[hit - 1], both[hit]
            swap = self.age[young] < self.age[old]
            repeats.append(np.where(swap, old, young))
            both[hit - 1] = np.where(swap, young, old)
            self.levels[i], new = both[~fresh], both[fresh & ~same]
        while self.levels and len(self.levels[-1]) <= len(new):
            new = self._merged(self.levels.pop(), new)[0]
        if len(new):
            self.levels.append(new)
        return np.concatenate(repeats)


def _pack_contexts(raw, first, last, doc, width) -> bytes:
    size = last - first + width
    at = _flat(first, size)
    head = pack((last - first).astype(np.uint16), doc)
    return len(head).to_bytes(4, "little") + head + pack(raw[at])


def _unpack_contexts(blob: bytes):
    n = int.from_bytes(blob[:4], "little")
    more, doc = unpack(blob[4 : 4 + n])
    return more.astype(np.int64), doc, unpack(blob[4 + n :])[0]


def mark_repeats(docs: DataFrame, width: int = WIDTH, kmer: int = KMER, block_bytes: int = BLOCK_BYTES, shard_bytes: int = SHARD_BYTES, batch: int = BATCH, hot: int = HOT, same: int = SAME) -> DataFrame:
    """doc_id, n_bytes, spans, kept for each row: ``spans`` are maximal removed runs of bytes [start, end)."""
    total = text_bytes(docs)
    base = blocks(docs, total, block_bytes=block_bytes)
    n_entries, n_shards = max(1, total // (4 * shard_bytes)), max(1, total // shard_bytes)

    def _send(key, group):
        b = Block(ordered(group), width, kmer)
        parts = deal(_shard_of(mix(b.kmer[b.sent]), n_entries))
        blobs = []
        for _, at in parts:
            k, w, d = b.kmer[b.sent[at]], b.whole[b.sent[at]], b.doc[b.sent[at]]
            head = pack_entries(k, d)
            blobs.append(len(head).to_bytes(4, "little") + head + pack(w))
        return pa.table({"shard": pa.array([s for s, _ in parts], pa.int32()), "block": pa.array([key[0].as_py()] * len(parts), pa.int32()), "entries": pa.array(blobs, pa.binary())})

    def _decide(group):
        group = group.sort_by("block")
        took, parts = [], []
        for blob in group["entries"].to_pylist():
            n = int.from_bytes(blob[:4], "little")
            parts.append((*unpack_entries(blob[4 : 4 + n]), unpack(blob[4 + n :])[0]))
            took.append(len(parts[-1][0]))
        k, d, w = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((d, w, k))  # stable: rows without an id by block
        k, w = k[order], w[order]
        new_k = np.ones(len(k), bool)
        new_k[1:] = k[1:] != k[:-1]
        new_w = new_k.copy()
        new_w[1:] |= w[1:] != w[:-1]
        of = np.cumsum(new_k) - 1
        distinct, total = np.bincount(of, weights=new_w)[of], np.bincount(of)[of]
        nth = np.arange(len(k)) - np.maximum.accumulate(np.where(new_w, np.arange(len(k)), 0))
        code = np.where(total < 2, UNIQUE, np.where(nth >= same, REPEAT, np.where(distinct < hot, COMPARE, BY_STRING))).astype(np.uint8)
        out = np.empty(len(k), np.uint8)
        out[order] = code
        cuts = np.cumsum([0, *took])
        return pa.table({"block": group["block"], "shard": group["shard"], "codes": pa.array([pack(out[a:b]) for a, b in zip(cuts, cuts[1:])], pa.binary())})

    def _send_contexts(key, group, codes):
        b = Block(ordered(group), width, kmer)
        first, last, hashes, doc, _ = b.contexts(b.codes(_told(codes, "codes"), n_entries), width)
        parts = deal(_shard_of(mix(hashes), n_shards))
        blobs = [_pack_contexts(b.raw, first[at], last[at], doc[at], width) for _, at in parts]
        return pa.table({"shard": pa.array([s for s, _ in parts], pa.int32()), "block": pa.array([key[0].as_py()] * len(parts), pa.int32()), "entries": pa.array(blobs, pa.binary())})

    def _compare(group):
        group = group.sort_by("block")
        parts = [_unpack_contexts(x) for x in group["entries"].to_pylist()]
        took = [int((m + 1).sum()) for m, _, _ in parts]
        more, doc, data = (np.concatenate(x) for x in zip(*parts))
        n = more + 1
        begin = np.cumsum(n + width - 1) - (n + width - 1)
        inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        at = np.repeat(begin, n) + inner
        age = np.empty(len(at), np.int64)  # within a document, contexts come in the order of their windows
        age[np.lexsort((np.arange(len(at)), np.repeat(doc, n)))] = np.arange(len(at))
        gone, family = np.zeros(len(at), bool), Family(data, at, age, width)
        cuts = np.append(0, np.cumsum(n))
        for a in range(0, len(n), batch):
            gone[family.add(np.arange(cuts[a], cuts[min(a + batch, len(n))]))] = True
        ends = np.cumsum([0, *took])
        return pa.table({"block": group["block"], "shard": group["shard"], "codes": pa.array([np.packbits(gone[a:b]).tobytes() for a, b in zip(ends, ends[1:])], pa.binary())})

    def _finish(key, group, codes):
        group = ordered(group)
        b = Block(group, width, kmer)
        kind = codes["stage"].to_numpy() if len(codes) else np.zeros(0)
        told = [_told(codes.filter(pa.array(kind == s)), "codes") for s in (1, 2)]
        code = b.codes(told[0], n_entries)
        first, last, hashes, _, known = b.contexts(code, width)
        cover = np.zeros(len(b.raw) + 1, np.int32)

        def remove(lo, hi):
            np.add.at(cover, lo, 1)
            np.add.at(cover, hi + width, -1)

        for at in (b.again, b.sent[code == REPEAT]):
            remove(b.first[at], b.last[at])
        remove(known, known)
        for s, at in deal(_shard_of(mix(hashes), n_shards)):
            n = last[at] - first[at] + 1
            gone = np.unpackbits(np.frombuffer(told[1][s], np.uint8), count=int(n.sum())).astype(bool)
            hit = (np.repeat(first[at], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))[gone]
            remove(hit, hit)
        return _result(group, b, np.cumsum(cover)[:-1] > 0)

    def send(key, group):
        return freed(_send(key, group))

    def decide(group):
        return freed(_decide(group))

    def send_contexts(key, group, codes):
        return freed(_send_contexts(key, group, codes))

    def compare(group):
        return freed(_compare(group))

    def finish(key, group, codes):
        return freed(_finish(key, group, codes))

    entries = base.groupBy("block").applyInArrow(send, ENTRIES)
    codes = entries.groupBy("shard").applyInArrow(decide, CODES)
    contexts = base.groupBy("block").cogroup(codes.groupBy("block")).applyInArrow(send_contexts, ENTRIES)
    flags = contexts.groupBy("shard").applyInArrow(compare, CODES)
    both = codes.withColumn("stage", F.lit(1)).unionByName(flags.withColumn("stage", F.lit(2)))
    return base.groupBy("block").cogroup(both.groupBy("block")).applyInArrow(finish, RESULT)


def _told(codes: pa.Table, name: str) -> dict[int, bytes]:
    return dict(zip(codes["shard"].to_pylist(), codes[name].to_pylist()))


def _result(group: pa.Table, b: Block, gone: np.ndarray) -> pa.Table:
    spans, kept = [], []
    for lo, hi in zip(b.offs[:-1].tolist(), b.offs[1:].tolist()):
        g = gone[lo:hi]
        if not g.any():
            spans.append([])
            kept.append(b.raw[lo:hi].tobytes())
            continue
        edge = np.flatnonzero(np.diff(np.concatenate(([0], g.astype(np.int8), [0])))).tolist()
        spans.append([{"start": s, "end": e} for s, e in zip(edge[::2], edge[1::2])])
        kept.append(b.raw[lo:hi][~g].tobytes())
    return pa.table({
        "doc_id": group["doc_id"],
        "n_bytes": pa.array(np.diff(b.offs), pa.int64()),
        "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
        "kept": pa.array(kept, pa.binary()),
    })


def digest(marked: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return marked.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
