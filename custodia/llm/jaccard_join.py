"""N-gram Jaccard join by T-occurrence search (DivideSkip), and the classes its links make.

A document's set holds the distinct ``size``-word shingles of its lower-cased words; a document with fewer words
has its whole sequence as one. Documents link when their sets' Jaccard similarity reaches ``percent``.

1. One pass over the documents names every set by 128 bits, and counts shingles in a sketch of fixed size. Of the documents
   of one set, the one with the smallest id leads; only leaders are joined, the others link to theirs.
2. The sketch orders shingles, rare ones first: any order gives the same links, this one keeps frequent passages out of the
   lists that are shared. Sets that reach the similarity share l shingles among the first n - ceil(n * percent / 100) + l of
   each, for any l; here l grows with n, so a passage alone does not make a candidate. Blocks of documents send
   these prefixes, packed, to shards by shingle. A shard takes each list apart where sizes leave a gap that no match can
   cross, and answers the members of what is shared with one place of search: the list's most frequent home. A
   home is a min-hash of the set, so the lists of a group of near copies mostly name the same place.
3. A set goes to the places that its answered shingles name, in one order for all sets and without the last l - 1: two sets
   that share l answered shingles share one of those that are left. Lists of very many members are
   cut into parts, with a place for each two parts.
4. At a place the sets are searched in an inverted index: a query must meet T = ceil(n * percent / 100) shingles of a match; the
   short lists are merged, candidates are binary-probed in the long ones and kept while they can still reach T. Members
   that stand next to each other in enough lists are linked before, and a query skips its own class, so a large
   group of near copies is not compared pair by pair. A place returns a spanning forest of its links, never pairs.
5. Components of all links are found by alternating large-star and small-star steps, each written to the shared folder.

Defined results: a null text, or one without words, has an empty set and links with nothing; rows that repeat a
doc_id count as one document for linking; a row without an id takes no part and has no class; an empty
table gives no rows. Other columns of the input are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, deal, freed, ids_of, materialise, mix, named, ordered, pack, parts, ship, text_bytes, text_or_empty, unpack, utf8, words

SIZE, PERCENT = 5, 80
#: A set's prefix grows by one shingle, and the number that must be shared too, for so many shingles.
EXTRA = 5
#: Cells of each row of the sketch, its rows, and the parts in which it is added up.
CELLS, ROWS, PARTS = 1 << 19, 2, 64
#: Input bytes for each shard and place, and members of a list, at most, that meet in one place.
SHARD_BYTES, TOGETHER = 8 << 20, 2048
#: Bytes of a block.
BLOCK_BYTES = 2 << 20
#: Bits of a shingle that name its list. Lists that share a name only make more candidates.
NAME_BITS = 48
_SALT = [np.uint64(x) for x in (0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def shingles(group: pa.Table, size: int):
    """(row, hash) of the distinct shingles of each row of a block, by row and hash."""
    raw, offs = utf8(group["text"])
    _, _, row, code, _ = words(raw, offs, lower=True)
    n_rows = len(offs) - 1
    count = np.bincount(row, minlength=n_rows)
    k = len(code) - size + 1
    h, r = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if k > 0:
        at = np.flatnonzero(row[:k] == row[size - 1 :])
        h = np.zeros(len(at), np.uint64)
        for j in range(size):
            h = mix(h + code[at + j] * _SALT[0])  # order counts
        r = row[at]
    few = np.flatnonzero((count > 0) & (count < size))
    if len(few):
        first = np.searchsorted(row, few)
        whole = np.full(len(few), _SALT[1], np.uint64)
        for j in range(size - 1):
            has = count[few] > j
            whole[has] = mix(whole[has] + code[first[has] + j] * _SALT[2])
        h, r = np.append(h, whole), np.append(r, few)
    order = np.lexsort((h, r))
    h, r = h[order], r[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
    return r[new], h[new], n_rows


def names(row: np.ndarray, h: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(size, one, two): size and 128-bit name of each row's set."""
    n = np.bincount(row, minlength=n_rows)
    one, two = np.zeros(n_rows, np.uint64), np.zeros(n_rows, np.uint64)
    full = np.flatnonzero(n)
    if len(full):
        starts = (np.cumsum(n) - n)[full]
        one[full] = mix(np.add.reduceat(mix(h + _SALT[3]), starts) + n[full].astype(np.uint64))
        two[full] = np.add.reduceat(mix(h ^ _SALT[4]), starts)
    return n, one, two


def _cells(h: np.ndarray) -> list[np.ndarray]:
    """The cell of each shingle in each row of the sketch."""
    return [((h >> np.uint64(20 * r)) & np.uint64(CELLS - 1)).astype(np.int64) for r in range(ROWS)]


NAMED = "doc_id long, n_shingles long, one long, two long, part int, cells binary"


def name_sets(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """One pass over the documents, written: doc_id, n_shingles, one, two for each, and the parts of each task's sketch."""

    def run(batches):
        counts, nothing = np.zeros((ROWS, CELLS), np.uint32), pa.array([0] * PARTS)
        for batch in (part for whole in batches for part in parts(whole, 1 << 20)):
            row, h, n_rows = shingles(pa.Table.from_batches([batch]), size)
            for cells, at in zip(counts, _cells(h)):
                cells += np.bincount(at, minlength=CELLS).astype(np.uint32)
            n, one, two = names(row, h, n_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n), pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), pa.nulls(n_rows, pa.int32()), pa.nulls(n_rows, pa.binary())],
                names=["doc_id", "n_shingles", "one", "two", "part", "cells"],
            )
        batch = row = h = one = two = None
        freed()
        blobs = [pack(p.ravel()) for p in np.split(counts, PARTS, axis=1)]
        yield pa.RecordBatch.from_arrays([nothing, nothing, nothing, nothing, pa.array(range(PARTS), pa.int32()), pa.array(blobs, pa.binary())], names=["doc_id", "n_shingles", "one", "two", "part", "cells"])

    ship(docs.sparkSession)
    return materialise(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(run, NAMED), "named")


def sketch(named: DataFrame) -> np.ndarray:
    """Counts of shingles by bits of their hash: ROWS * CELLS numbers, whatever the input."""

    def add(group):
        total = sum(unpack(b)[0].astype(np.uint64) for b in group["cells"].to_pylist())
        return pa.table({"part": group["part"].slice(0, 1), "cells": pa.array([pack(np.minimum(total, 2**32 - 1).astype(np.uint32))], pa.binary())})

    rows = named.where("part is not null").select("part", "cells").groupBy("part").applyInArrow(add, "part int, cells binary").collect()  # PARTS rows
    out, width = np.zeros((ROWS, CELLS), np.uint32), CELLS // PARTS
    for r in rows:
        out[:, r.part * width : (r.part + 1) * width] = unpack(r.cells)[0].reshape(ROWS, width)
    return out


def place_of(h: np.ndarray, n: int) -> np.ndarray:
    return ((h >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int32)


class Sets:
    """The leading sets of a block and what it sends of them; the same whenever the block is read."""

    def __init__(self, group: pa.Table, leaders: pa.Table, size: int, percent: int, counts: np.ndarray, n_places: int):
        row, h, n_rows = shingles(group, size)
        _, one, _ = names(row, h, n_rows)
        ids = ids_of(group)
        known = set(zip(leaders["doc_id"].to_pylist(), leaders["one"].to_pylist()))
        lead = np.array([x in known for x in zip(group["doc_id"].to_pylist(), one.view(np.int64).tolist())], bool)
        _, first = np.unique(np.stack((ids.view(np.uint64), one)), axis=1, return_index=True)
        again = np.ones(n_rows, bool)
        again[first] = False
        lead &= ~again  # of equal rows of a leader, one
        number = np.cumsum(lead) - 1
        self.hash, self.row = h[lead[row]], number[row[lead[row]]]
        self.ids, self.one = ids[lead], one[lead]
        self.n = np.bincount(self.row, minlength=len(self.ids))
        self.begin = np.cumsum(self.n) - self.n
        seen = np.min([c[at] for c, at in zip(counts, _cells(self.hash))], axis=0) if len(self.hash) else np.zeros(0, np.uint32)
        noise = int(counts[0].sum(dtype=np.uint64)) // CELLS
        rank = np.where(seen > noise + 8 * int(np.sqrt(noise)) + 16, np.log2(seen + 1.0), 0).astype(np.int8)
        ordering = np.lexsort((self.hash, rank, self.row))
        # of the sorted set, the first n - least + l; a match has at least ``least`` shingles, so the smaller l of the two
        # is at least ``needed``
        least = (self.n * percent + 99) // 100
        shared = lambda n: 1 + np.minimum(n // EXTRA, (n * percent + 99) // 100 - 1)
        self.needed = shared(least)
        prefix = ordering[(np.arange(len(ordering)) - self.begin[self.row]) < (self.n - least + shared(self.n))[self.row]]  # rows are in order in both
        name = mix(self.hash[prefix] + _SALT[2]) >> np.uint64(64 - NAME_BITS)
        order = np.argsort(name, kind="stable")
        #: Names and rows of what is sent, by name.
        self.name, self.sent = name[order], self.row[prefix[order]]
        self.home = np.zeros(len(self.ids), np.int32)
        if len(self.ids):
            by = mix(self.hash + _SALT[5])
            self.home = place_of(mix(np.minimum.reduceat(by, self.begin) + _SALT[6]), n_places)

    def entries(self, n_shards: int) -> list[tuple[int, slice]]:
        """(shard, range of what is sent) for each shard that gets any."""
        shard = (self.name * np.uint64(n_shards) >> np.uint64(NAME_BITS)).astype(np.int64)
        cuts = np.append(np.flatnonzero(np.diff(shard, prepend=-1)), len(shard))
        return [(int(shard[a]), slice(a, b)) for a, b in zip(cuts, cuts[1:])]


def _blob(*arrays: np.ndarray) -> bytes:
    return b"".join(len(b).to_bytes(4, "little") + b for b in map(pack, arrays))


def _unblob(blob: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(blob):
        n = int.from_bytes(blob[at : at + 4], "little")
        out.append(unpack(blob[at + 4 : at + 4 + n])[0])
        at += 4 + n
    return out


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Where a new run of equal keys begins."""
    new = np.ones(len(keys[0]), bool)
    new[1:] = False
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return new


def answers(name: np.ndarray, n: np.ndarray, home: np.ndarray, percent: int, together: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(entry, place, parts) for the entries whose list, taken apart by size, has several members. ``parts`` is 1 unless the
    list has more than ``together`` members."""
    order = np.lexsort((n, name))
    k, size = name[order], n[order].astype(np.int64)
    new = _runs(k)
    new[1:] |= 100 * size[:-1] < percent * size[1:]
    of = np.cumsum(new) - 1
    members = np.bincount(of)
    some = members[of] > 1
    order, of = order[some], of[some]
    if not len(order):
        return order, np.zeros(0, np.int32), np.zeros(0, np.int32)
    # the most frequent home of each list, the smallest of equally frequent ones
    o = np.lexsort((home[order], of))
    l, w = of[o], home[order][o]
    first = np.flatnonzero(_runs(l, w))
    count = np.diff(np.append(first, len(l)))
    best = np.lexsort((w[first], -count, l[first]))
    best = best[_runs(l[first][best])]
    hub = np.zeros(len(members), np.int32)
    hub[l[first][best]] = w[first][best]
    return order, hub[of], (-(-members[of] // together)).astype(np.int32)


def destinations(s: Sets, at: np.ndarray, place: np.ndarray, cut: np.ndarray, n_places: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, row), distinct: where a block's sets go. ``at`` are positions in what the block sent."""
    order = np.lexsort((s.name[at], s.sent[at]))
    at, place, cut = at[order], place[order], cut[order]
    row = s.sent[at]
    total = np.bincount(row, minlength=len(s.ids))
    nth = np.arange(len(row)) - (np.cumsum(total) - total)[row]
    keep = nth < (total - s.needed + 1)[row]
    row, place, cut = row[keep], place[keep].astype(np.int64), cut[keep].astype(np.int64)
    whole = cut == 1
    pairs = [np.stack((place[whole], row[whole]))]
    row, place, cut = row[~whole], place[~whole], cut[~whole]
    if len(row):
        _, first = np.unique(np.stack((row, place, cut)), axis=1, return_index=True)
        row, place, cut = row[first], place[first], cut[first]
        mine = (s.one[row] % cut.astype(np.uint64)).astype(np.int64)
        of = np.repeat(np.arange(len(row)), cut)
        other = np.arange(len(of)) - np.repeat(np.cumsum(cut) - cut, cut)
        low, high = np.minimum(mine[of], other), np.maximum(mine[of], other)
        key = mix((place[of] << 20 | low).astype(np.uint64) + mix((cut[of] << 20 | high).astype(np.uint64) + _SALT[1]))
        pairs.append(np.stack((place_of(key, n_places).astype(np.int64), row[of])))
    place, row = np.unique(np.concatenate(pairs, axis=1), axis=1)
    return place, row


class Search:
    """An inverted index of sets and the T-occurrence search over it."""

    def __init__(self, sizes: np.ndarray, tokens: np.ndarray, percent: int):
        self.percent, m = percent, len(sizes)
        member = np.repeat(np.arange(m), sizes)
        label = self._neighbours(sizes, member, tokens)
        # members by class, so that a class is one range of every list
        self.order = np.argsort(label, kind="stable")
        back = np.empty(m, np.int64)
        back[self.order] = np.arange(m)
        self.sizes, self.label = sizes[self.order], label[self.order]
        self.first = np.searchsorted(self.label, self.label)  # of the class
        member = back[member]
        order = np.lexsort((tokens, member))
        member, tokens = member[order], tokens[order]
        self.begin = np.cumsum(self.sizes) - self.sizes
        _, self.of, counts = np.unique(tokens, return_inverse=True, return_counts=True)
        # every posting as one number, by list and member: a binary probe finds a member in any list
        self.keys = np.sort(self.of * m + member)
        self.postings = self.keys % max(1, m)
        self.lists = np.append(0, np.cumsum(counts))

    def _neighbours(self, sizes: np.ndarray, member: np.ndarray, tokens: np.ndarray) -> np.ndarray:
        """Classes of members that stand next to each other in so many lists that these alone make the similarity."""
        order = np.lexsort((member, tokens))
        t, who = tokens[order], member[order]
        same = np.flatnonzero(t[1:] == t[:-1])
        pair, common = np.unique(who[same] * len(sizes) + who[same + 1], return_counts=True)
        a, b = pair // len(sizes), pair % len(sizes)
        near = 100 * common >= self.percent * (sizes[a] + sizes[b] - common)
        label = np.arange(len(sizes))
        for x, y in zip(a[near].tolist(), b[near].tolist()):
            _union(label, x, y)
        while True:  # every member to its root
            up = label[label]
            if np.array_equal(up, label):
                return label
            label = up

    def matches(self, q: int) -> np.ndarray:
        """Members of classes before ``q``'s, not yet linked with it, that reach the similarity."""
        n, m = int(self.sizes[q]), len(self.sizes)
        t = (n * self.percent + 99) // 100  # a match shares at least so many
        lists = self.of[self.begin[q] : self.begin[q] + n]
        lo = self.lists[lists]
        size = np.searchsorted(self.keys, lists * m + self.first[q]) - lo  # of each list, what stands before the class
        some = size > 0
        if some.sum() < t:
            return np.zeros(0, np.int64)
        by = np.argsort(size, kind="stable")
        # of the lists that a match shares, at most len(long) are long ones
        cut = n - t + 1 + min(n // 10, t - 1)
        short, long = by[:cut], by[cut:]
        lo, size = lo[short], size[short]
        at = np.repeat(lo - np.cumsum(size) + size, size) + np.arange(size.sum())
        merged = np.sort(self.postings[at], kind="stable")  # sorted runs: they are merged
        start = np.flatnonzero(_runs(merged)) if len(merged) else np.zeros(0, np.int64)
        found, count = merged[start], np.diff(np.append(start, len(merged)))
        k = self.sizes[found]
        fits = (count >= t - len(long)) & (self.label[found] != self.label[q]) & (100 * np.minimum(k, n) >= self.percent * np.maximum(k, n))
        found, count, left = found[fits], count[fits], len(long)
        for part in np.array_split(lists[long], 4) if left else ():
            if not len(found):
                return found
            probe = (part[:, None] * m + found).ravel()
            hit = self.keys[np.minimum(np.searchsorted(self.keys, probe), len(self.keys) - 1)] == probe
            count = count + hit.reshape(len(part), len(found)).sum(0)
            left -= len(part)
            alive = count + left >= t
            found, count = found[alive], count[alive]
        k = self.sizes[found]
        return found[100 * count >= self.percent * (n + k - count)]

    def classes(self) -> np.ndarray:
        """A label for each set, the same for all sets of a class of the links within this index."""
        held: dict[int, list[int]] = {}
        for i, c in enumerate(self.label.tolist()):
            held.setdefault(c, []).append(i)
        for q in range(len(self.sizes)):
            for other in self.matches(q).tolist():
                a, b = int(self.label[q]), int(self.label[other])
                if a == b:
                    continue
                if len(held[a]) < len(held[b]):
                    a, b = b, a
                self.label[held[b]] = a  # the smaller class takes the other's label
                held[a] += held.pop(b)
        out = np.empty(len(self.label), np.int64)
        out[self.order] = self.label
        return out


def _union(label: np.ndarray, x: int, y: int) -> None:
    while label[x] != x:
        label[x] = x = label[label[x]]
    while label[y] != y:
        label[y] = y = label[label[y]]
    label[max(x, y)] = min(x, y)


def links(docs: DataFrame, size: int = SIZE, percent: int = PERCENT, block_bytes: int = BLOCK_BYTES, shard_bytes: int = SHARD_BYTES, together: int = TOGETHER) -> tuple[DataFrame, DataFrame]:
    """(sets, edges). Sets: doc_id, n_shingles, one, two (128 bits of the set) for each row. Edges: a, b, ids of documents,
    enough to connect what the similarity connects."""
    spark = docs.sparkSession
    total = text_bytes(docs)
    base = blocks(docs, total, block_bytes=block_bytes)
    n_shards = max(1, total // shard_bytes)
    named = name_sets(docs, size)
    sets = named.where("part is null").select("doc_id", "n_shingles", "one", "two")
    cells = spark.sparkContext.broadcast(sketch(named))  # ROWS * CELLS numbers

    some = sets.where("n_shingles > 0 and doc_id is not null")
    first = materialise(some.groupBy("one", "two").agg(F.min("doc_id").alias("doc_id"), F.max("doc_id").alias("last")), "leaders")
    equal = some.join(first.where("doc_id <> last").select("one", "two", F.col("doc_id").alias("b")), ["one", "two"]).where("doc_id <> b").select(F.col("doc_id").alias("a"), "b")
    leaders = blocks(first.select("doc_id", "one", F.lit("").alias("text")), total, ("one",), block_bytes).drop("text")

    def _send(key, group, lead):
        s = Sets(ordered(group), lead, size, percent, cells.value, n_shards)
        sent = s.entries(n_shards)
        n, home = s.n.astype(np.uint32), s.home
        blobs = [_blob(np.diff(s.name[at], prepend=np.uint64(0)), n[s.sent[at]], home[s.sent[at]]) for _, at in sent]
        return pa.table({"shard": pa.array([p for p, _ in sent], pa.int32()), "block": pa.array([key[0].as_py()] * len(sent), pa.int32()), "entries": pa.array(blobs, pa.binary())})

    def _meet(group):
        group = group.sort_by("block")
        got = [_unblob(b) for b in group["entries"].to_pylist()]
        took = np.cumsum([0, *(len(p[0]) for p in got)])
        at, place, cut = answers(np.concatenate([np.cumsum(p[0]) for p in got]), np.concatenate([p[1] for p in got]), np.concatenate([p[2] for p in got]), percent, together)
        o = np.argsort(at, kind="stable")
        at, place, cut = at[o], place[o], cut[o]
        cuts = np.searchsorted(at, took)
        blobs = [_blob((at[a:b] - t).astype(np.uint32), place[a:b], cut[a:b]) for a, b, t in zip(cuts, cuts[1:], took)]
        return pa.table({"block": group["block"], "shard": group["shard"], "places": pa.array(blobs, pa.binary())}).filter(pa.array(np.diff(cuts) > 0))

    def _send_sets(key, left, right):
        told = right.filter(pc.is_valid(right["places"]))
        if not len(told):
            return pa.table({"shard": pa.array([], pa.int32()), "block": pa.array([], pa.int32()), "entries": pa.array([], pa.binary())})
        s = Sets(ordered(left), right.filter(pc.is_null(right["places"])), size, percent, cells.value, n_shards)
        base_of = {shard: at.start for shard, at in s.entries(n_shards)}
        each = [(base_of[shard], *_unblob(blob)) for shard, blob in zip(told["shard"].to_pylist(), told["places"].to_pylist())]
        place, row = destinations(s, np.concatenate([b + i.astype(np.int64) for b, i, _, _ in each]), np.concatenate([e[2] for e in each]), np.concatenate([e[3] for e in each]), n_shards)
        shard, blobs = [], []
        for p, at in deal(place):
            r = row[at]
            n = s.n[r]
            flat = np.repeat(s.begin[r] - np.cumsum(n) + n, n) + np.arange(n.sum())
            shard.append(p)
            blobs.append(_blob(s.ids[r], n, s.hash[flat]))
        return pa.table({"shard": pa.array(shard, pa.int32()), "block": pa.array([key[0].as_py()] * len(shard), pa.int32()), "entries": pa.array(blobs, pa.binary())})

    def _search(group):
        ids, sizes, tokens = (np.concatenate(x) for x in zip(*(_unblob(b) for b in group["entries"].to_pylist())))
        order = np.argsort(ids, kind="stable")
        begin = np.cumsum(sizes) - sizes
        n = sizes[order]
        tokens = tokens[np.repeat(begin[order] - np.cumsum(n) + n, n) + np.arange(n.sum())]
        ids, label = ids[order], Search(n, tokens, percent).classes()
        o = np.argsort(label, kind="stable")
        least = ids[o][np.flatnonzero(_runs(label[o]))]  # ids are in order
        other = np.empty(len(ids), np.int64)
        other[o] = np.repeat(least, np.diff(np.append(np.flatnonzero(_runs(label[o])), len(o))))
        moved = other != ids
        return pa.table({"a": ids[moved], "b": other[moved]})

    def send(key, group, lead):
        return freed(_send(key, group, lead))

    def meet(group):
        return freed(_meet(group))

    def send_sets(key, left, right):
        return freed(_send_sets(key, left, right))

    def search(group):
        return freed(_search(group))

    rows = "shard int, block int, entries binary"
    lead = leaders.select("block", "doc_id", "one", F.lit(None).cast("int").alias("shard"), F.lit(None).cast("binary").alias("places"))
    entries = base.groupBy("block").cogroup(lead.groupBy("block")).applyInArrow(send, rows)
    places = entries.groupBy("shard").applyInArrow(meet, "block int, shard int, places binary")
    told = lead.unionByName(places.select("block", F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("long").alias("one"), "shard", "places"))
    sent = base.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(send_sets, rows)
    edges = sent.groupBy("shard").applyInArrow(search, "a long, b long")
    return sets, edges.unionByName(equal)


def components(edges: DataFrame) -> DataFrame:
    """(doc_id, component_id) of every node of ``edges`` (a, b): the smallest id it reaches. Each step is written to the
    shared folder; what the driver sees of it are a count and a checksum."""
    state = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    state = materialise(state, "edges")
    before = None
    while True:
        mark = state.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == before:
            return state.groupBy(F.col("a").alias("doc_id")).agg(F.min("b").alias("component_id"))
        before = mark
        # large star: every larger neighbour of a node moves to the node's smallest neighbour
        sym = state.unionByName(state.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = sym.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("m", "a").alias("m"))
        large = sym.join(least, F.col("a") == F.col("n")).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # small star: every smaller neighbour, and the node, move to the smallest
        low = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "n")
        small = large.join(low, F.col("a") == F.col("n")).select(F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        state = materialise(small.select("e.a", "e.b").where("a <> b").distinct(), "edges")


def classify(docs: DataFrame, size: int = SIZE, percent: int = PERCENT, block_bytes: int = BLOCK_BYTES, shard_bytes: int = SHARD_BYTES, together: int = TOGETHER) -> DataFrame:
    """doc_id, n_shingles, component_id for each row."""
    sets, edges = links(docs, size, percent, block_bytes, shard_bytes, together)
    found = components(edges).withColumnRenamed("doc_id", "_id")
    return sets.join(found, F.col("doc_id") == F.col("_id"), "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


#: Cells of ids by which most documents that stay are told without a shuffle; at most so many numbers are broadcast.
ID_CELLS = 1 << 20


def drop_near_copies(docs: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """The documents without those whose class has a smaller id; all columns. Rows without an id stay. Only documents whose
    id shares a cell with one that goes are shuffled to find out."""
    gone = classify(docs.select("doc_id", "text"), size, percent).where("doc_id <> component_id")
    gone = materialise(gone.select(F.col("doc_id").alias("gone")).distinct(), "gone")
    cell = lambda c: F.pmod(F.xxhash64(F.col(c).cast("long")), F.lit(ID_CELLS)).cast("int").alias("cell")
    cells = F.broadcast(gone.select(cell("gone")).distinct())
    marked = docs.select(F.struct(*(named(c) for c in docs.columns)).alias("row"), cell("doc_id"))
    sure = marked.join(cells, "cell", "left_anti")
    maybe = marked.join(cells, "cell", "left_semi").join(gone, F.col("row.doc_id").cast("long") == F.col("gone"), "left_anti")
    return sure.unionByName(maybe).select("row.*")
