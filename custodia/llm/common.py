"""Helpers shared by the operators: shared storage, blocks of text, packed columns."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.common import materialise, shared_dir, ship, table  # noqa: F401

#: Bytes of text that one block of documents should hold; a task works on one block at a time.
BLOCK_BYTES = 4 << 20
#: Entries that one shard of an index should hold.
SHARD_ENTRIES = 1 << 20


def named(*path: str) -> Column:
    """A column by its name, whatever characters that has; further names are fields in it."""
    return F.col(".".join("`{}`".format(p.replace("`", "``")) for p in path))


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def text_bytes(docs: DataFrame) -> int:
    """Bytes of all texts; sizes the blocks and shards, so that both follow the input."""
    got = docs.agg(F.sum(F.octet_length("text").cast("long")).alias("n")).first()[0]
    return int(got or 0)


def blocks(docs: DataFrame, total: int, extra: Iterable[str] = (), block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, text, block): a document's block is a hash of its id, so every pass over the
    documents sees the same blocks, whatever partitions it reads. Rows without an id are dealt by text."""
    ship(docs.sparkSession)
    n = max(1, -(-total // block_bytes))
    key = F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.xxhash64("doc_id"))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"), *extra
    ).withColumn("block", F.pmod(key, F.lit(n)).cast("int"))


def utf8(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offsets of its rows, without copying rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    column = column.cast(pa.large_binary())
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offs[0] : offs[-1]], offs - offs[0]


def parts(batch: pa.RecordBatch, most: int = 1 << 19) -> Iterable[pa.RecordBatch]:
    """The batch in ranges of about ``most`` bytes of text, so that what is made of them in memory does not grow with a batch."""
    upto = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False)) // most
    cuts = [0, *(np.flatnonzero(np.diff(upto)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if a < b:
            yield batch.slice(a, b - a)


def ordered(group: pa.Table) -> pa.Table:
    """Rows by doc_id, then text: the same order whenever the block is read again."""
    return group.sort_by([("doc_id", "ascending"), ("text", "ascending")])


def ids_of(group: pa.Table) -> np.ndarray:
    """doc_id as numbers; rows without an id count as the largest."""
    return group["doc_id"].fill_null(np.iinfo(np.int64).max).to_numpy().astype(np.int64)


def freed(result=None):
    """Hands ``result`` on, after the memory that making it took has gone back to the system: Python workers live on between
    tasks and stages, and what their allocators keep is missing elsewhere in the executor."""
    import ctypes

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries have it
    if trim:
        trim(0)
    return result


# --- packed columns ----------------------------------------------------------------------------


def pack(*columns: np.ndarray) -> bytes:
    """Arrays of one length as one value: byte planes of each, compressed."""
    import zstandard

    out = [np.int64(len(columns[0])).tobytes()]
    for c in columns:
        c = np.ascontiguousarray(c)
        planes = c.view(np.uint8).reshape(-1, c.dtype.itemsize).T if len(c) else np.zeros((c.dtype.itemsize, 0), np.uint8)
        out.append(c.dtype.char.encode())
        out.append(np.ascontiguousarray(planes).tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(out))


def unpack(blob: bytes) -> list[np.ndarray]:
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(blob)
    n, at, out = int(np.frombuffer(raw, np.int64, 1)[0]), 8, []
    while at < len(raw):
        kind = np.dtype(raw[at : at + 1].decode())
        planes = np.frombuffer(raw, np.uint8, n * kind.itemsize, at + 1).reshape(kind.itemsize, n)
        out.append(np.ascontiguousarray(planes.T).view(kind).reshape(-1))
        at += 1 + n * kind.itemsize
    return out


def deal(shard: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(shard, positions) for each shard that has entries."""
    order = np.argsort(shard, kind="stable")
    by = shard[order]
    cuts = np.append(np.flatnonzero(np.diff(by, prepend=-1)), len(by))
    return [(int(by[a]), order[a:b]) for a, b in zip(cuts, cuts[1:])]


# --- hashes ------------------------------------------------------------------------------------

_rng = np.random.default_rng(20240229)
BYTE_CODE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit of 64-bit values."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


_POWERS: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n-1), kept by each worker between blocks."""
    if len(_POWERS.get(int(base), ())) < max(n, 1):
        out = np.full(n + (n >> 2) + 1024, base, np.uint64)
        out[0] = 1
        _POWERS[int(base)] = np.cumprod(out)
    return _POWERS[int(base)][:n]


def prefix_hash(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of values[i] * BASE**i and the inverse powers: the polynomial (Rabin-Karp) hash of
    values[a:b] is (sums[b] - sums[a]) * inverse[a], modulo 2**64."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(BASE, len(values)), out=sums[1:])
    return sums, powers(BASE_INV, len(values) + 1)


IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def word_bounds(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a block: start, end and row of each, and whether a byte is in one.

    UTF-8 keeps these separators out of other characters, so bytes are enough."""
    inside = np.zeros(len(raw) + 1, bool)
    inside[:-1] = ~IS_SPACE[raw]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edge = offs[:-1][offs[:-1] < len(raw)]
    begins[edge] = inside[edge]  # a word never crosses rows
    starts = np.flatnonzero(begins)
    stops = ~inside
    stops[0] = False
    ends_at = np.flatnonzero(stops)
    ends = ends_at[np.searchsorted(ends_at, starts, side="left")] if len(starts) else starts
    row = np.searchsorted(offs, starts, side="right") - 1
    return starts, np.minimum(ends, offs[row + 1]) if len(starts) else ends, row, inside[:-1]


def word_table(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """Start, end, row and number of each word of a block, and the distinct words by number."""
    starts, ends, row, inside = word_bounds(raw, offs)
    data, upto = np.ascontiguousarray(raw[inside]), np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=upto[1:])
    coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(upto), pa.py_buffer(data)]).dictionary_encode()
    return starts, ends, row, coded.indices.to_numpy(zero_copy_only=False), coded.dictionary


#: The first bytes of eight.
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def words(raw: np.ndarray, offs: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end, row and two independent 64-bit codes of each word of a block.

    A code goes through a word by eight bytes, each mixed into all bits of the code so far. It is no polynomial: those
    collide, modulo a power of two, on long words of two letters whatever the base is."""
    raw = LOWER[raw] if lower else raw
    starts, ends, row, _ = word_bounds(raw, offs)
    eights = np.ndarray((len(raw) + 1,), "<u8", buffer=np.concatenate((raw, np.zeros(8, np.uint8))), strides=(1,))
    left, at, which = ends - starts, starts, slice(None)
    one, two = mix(left.astype(np.uint64) + BASE), mix(left.astype(np.uint64) * BASE)
    while len(left):
        v = eights[at] & _FIRST[np.minimum(left, 8)]
        one[which], two[which] = mix(one[which] ^ v), mix((two[which] ^ v) * BASE_INV)
        more = np.flatnonzero(left > 8)
        which = more if isinstance(which, slice) else which[more]
        left, at = left[more] - 8, at[more] + 8
    return starts, ends, row, one, two
