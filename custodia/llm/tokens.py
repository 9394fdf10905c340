"""Tokenising documents in tasks with the tokenizers library, one call for many distinct pieces.

A byte-level vocabulary splits a text where a space follows a character that is neither a space nor other
white space and a non-space follows it, where a full stop or its like follows a letter, and on both sides of a line
break between two characters that are not white space: no token spans such a place. A batch of documents therefore
repeats few pieces; Arrow finds the distinct ones by their bytes, each is encoded once, and ids of documents are
gathered from the pieces' ids. A task keeps pieces between batches; when it holds ``CACHE`` of them it starts anew, which
costs time but changes nothing. Tasks are what runs side by side here, so the library's own threads, which cost a third more
CPU, are not used.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa

from .common import utf8

CACHE = 800_000
#: Pieces that are encoded as one text; their ids are told apart by their bytes.
TOGETHER = 512
_WORKER: dict = {}
_WHITE = np.zeros(256, bool)
_WHITE[[*range(0x09, 0x0E), *range(0x1C, 0x21)]] = True
_LETTER, _STOP = np.zeros(256, bool), np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_STOP[list(b".,;:!?")] = True
#: White space of two and three bytes, as the bytes' numbers.
_WHITE_TWO = np.array([0xC285, 0xC2A0])
_WHITE_THREE = np.array([0xE19A80, *range(0xE28080, 0xE2808B), 0xE280A8, 0xE280A9, 0xE280AF, 0xE2819F, 0xE38080])


def white(raw: np.ndarray) -> np.ndarray:
    """Whether a byte belongs to a white-space character."""
    out = _WHITE[raw]
    at = np.flatnonzero(raw[:-1] == 0xC2)
    at = at[np.isin(raw[at].astype(int) << 8 | raw[at + 1], _WHITE_TWO)]
    out[at] = out[at + 1] = True
    at = np.flatnonzero((raw[:-2] >= 0xE1) & (raw[:-2] <= 0xE3))
    at = at[np.isin(raw[at].astype(int) << 16 | raw[at + 1].astype(int) << 8 | raw[at + 2], _WHITE_THREE)]
    out[at] = out[at + 1] = out[at + 2] = True
    return out


def pieces(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the pieces of the rows start, the number of the first piece of each row, with the number of all at the end, and
    what bytes are white space."""
    out = white(raw)
    cut = np.zeros(len(raw) + 1, bool)
    if len(raw) > 2:
        between = ~out[:-2] & ~out[2:]
        cut[1:-2] = (raw[1:-1] == 0x20) & between
        edge = offs[1:-1][(offs[1:-1] < len(raw)) & (offs[1:-1] > 0)]
        cut[edge] = cut[edge - 1] = False  # a space at either end of a row is no place to cut
        lines = np.flatnonzero((raw[1:-1] == 0x0A) & between) + 1
        cut[lines] = cut[lines + 1] = True
        cut[1:-1] |= _LETTER[raw[:-1]] & _STOP[raw[1:]]
    cut[offs[:-1][np.diff(offs) > 0]] = True
    starts = np.flatnonzero(cut[: len(raw)])
    return starts, np.searchsorted(starts, offs), out


def split_ids(ids: np.ndarray, bytes_of: np.ndarray, sizes: list[int]) -> list[bytes]:
    """Ids of texts that were encoded as one: a text ends where its bytes do."""
    ends = np.searchsorted(np.cumsum(bytes_of[ids]), np.cumsum(sizes), side="left") + 1
    raw, cuts = ids.astype("<u4").tobytes(), [0, *(4 * ends).tolist()]
    return [raw[a:b] for a, b in zip(cuts, cuts[1:])]


class Encoder:
    """Ids of texts, as numbers."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # in a byte-level vocabulary a character stands for a byte
        self.bytes_of = np.array([len(self.tokenizer.id_to_token(i) or "") for i in range(self.tokenizer.get_vocab_size())])
        for token in self.tokenizer.get_added_tokens_decoder().values():
            raw = np.frombuffer(token.content.encode(), np.uint8)
            if len(pieces(raw, np.array([0, len(raw)]))[0]) > 1:
                raise ValueError(f"the token {token.content!r} spans pieces")
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        #: Ids of all known pieces, and where each piece's begin; the last number is where the next begin.
        self.ids, self.begin = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def _ids(self, text: bytes) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text.decode()], add_special_tokens=False)[0].ids, np.uint32)

    def _learn(self, new: list[bytes], kind: np.ndarray) -> None:
        """``kind``: 1 for pieces that start with one space and end in none, which can stand beside each other, 2 for those
        without white space at either end, which can after a line break, 0 for the others."""
        ids, count, order = [], [], []
        for k, glue in ((1, b""), (2, b"\n"), (0, None)):
            some = [p for p, is_k in zip(new, (kind == k).tolist()) if is_k]
            order += some
            size = TOGETHER if glue is not None else 1
            for g in (some[i : i + size] for i in range(0, len(some), size)):
                got = self._ids((glue or b"").join(g))
                if size > 1:  # a piece ends where its bytes do
                    bytes_ = np.array([len(p) for p in g])
                    ends = np.searchsorted(np.cumsum(self.bytes_of[got]), np.cumsum(bytes_ + len(glue)) - len(glue), side="left") + 1
                    first = np.append(0, ends[:-1] + len(glue))  # the line break is one token
                    got = got[np.repeat(first - np.cumsum(ends - first) + (ends - first), ends - first) + np.arange((ends - first).sum())]
                    count += (ends - first).tolist()
                else:
                    count.append(len(got))
                ids.append(got)
        at = len(self.known)
        self.known.update(zip(order, range(at, at + len(order))))
        self.ids = np.concatenate([self.ids, *ids])
        self.begin = np.append(self.begin, self.begin[-1] + np.cumsum(count, dtype=np.int64))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows, offsets of the rows in them)."""
        raw, offs = utf8(texts)
        starts, row, out = pieces(raw, offs)
        ends = np.append(starts[1:], len(raw))[: len(starts)]
        if len(self.known) > CACHE:
            self.forget()
        found = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(np.append(starts, len(raw)).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(raw))])
        coded = found.dictionary_encode()
        number, distinct = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary.to_pylist()
        slot = np.fromiter(map(self.known.get, distinct, repeat(-1)), np.int64, len(distinct))
        if len(new := np.flatnonzero(slot < 0)):
            first = np.flatnonzero(np.diff(np.maximum.accumulate(number), prepend=-1) > 0)[new]  # numbers are given in order
            s, e = starts[first], ends[first]
            plain = ~out[e - 1]
            inner = out[np.minimum(s + 1, e - 1)]
            kind = np.where(plain & (raw[s] == 0x20) & ~inner, 1, np.where(plain & ~out[s], 2, 0))
            self._learn([distinct[i] for i in new.tolist()], kind)
            slot[new] = np.fromiter(map(self.known.__getitem__, (distinct[i] for i in new.tolist())), np.int64, len(new))
        slot = slot[number]
        begin = self.begin[slot]
        n = self.begin[slot + 1] - begin
        upto = np.append(0, np.cumsum(n))
        return self.ids[np.repeat(begin - upto[:-1], n) + np.arange(upto[-1])], upto[row]


def encoder(path: str) -> Encoder:
    """One for each worker process and file."""
    if path not in _WORKER:
        _WORKER[path] = Encoder(path)
    return _WORKER[path]
