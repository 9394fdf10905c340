"""SentencePiece encoding and decoding on the tokenizers library, with its parity verified.

The model file is rebuilt as a tokenizers pipeline (``piece_model``). Where no piece reaches over a space
and the normaliser leaves spaces alone, a text's ids are the ids of its chunks, each a run of spaces with
the word after it. A task then encodes each distinct chunk of a batch once, in one multithreaded
call, decodes it again, and compares its ids with those of the SentencePiece library. Other models are
encoded, decoded and compared by whole texts.

Defined results: a null text counts as empty and has no ids; repeated rows give repeated results; a
null doc_id is kept; an empty table gives no rows. Other columns of the input are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import parts, text_or_empty
from .piece_model import BYTE, CHUNK, SPACE, build, parse, spans_words
from .tokens import CACHE, TOGETHER, split_ids

ENCODED = "doc_id long, ids binary, n_tokens long, n_chars long, n_decoded long, round_trip boolean, parity boolean"
_WORKER: dict = {}


class Codec:
    """``verify``: "all" compares every text's ids with the SentencePiece library, "none" none."""

    def __init__(self, path: str, verify: str = "all"):
        raw = open(path, "rb").read()
        self.model = parse(raw)
        self.whole = build(self.model)
        self.inner = build(self.model, prefix=False)
        m = self.model
        self.bytes_of = np.array([1 if k == BYTE else len(p.replace(SPACE, " ").encode()) for p, _, k in m.pieces])
        self.by_chunk = not (m.remove_spaces or m.charsmap or spans_words(m)) and m.dummy_prefix
        self.reference = None
        if verify != "none":
            import sentencepiece

            self.reference = sentencepiece.SentencePieceProcessor(model_proto=raw)
        self.known: dict[str, bytes] = {}
        self.odd: dict[str, tuple[bool, bool, int]] = {}  # chunks that fail a comparison, and decoded lengths that differ
        self.joint: set[str] = set()  # chunks that pass alone and fail together: their texts are encoded and compared whole

    def _check(self, texts: list[str], ids: list[list[int]], decoded: list[str], given: list[str]):
        """(round trip, parity) of each text; ``given``: what the reference encodes to the same ids."""
        same = self.reference.encode(given, num_threads=1) if self.reference else ids
        return [(d == t, a == b) for t, d, a, b in zip(texts, decoded, ids, same)]

    def _learn(self, chunks: set[str]) -> None:
        if len(self.known) > CACHE:
            self.known.clear()
            self.odd.clear()
            self.joint.clear()
        new = [c for c in chunks if c not in self.known]
        whole = [c for c in new if c[-1] != " "]
        groups = [whole[i : i + TOGETHER] for i in range(0, len(whole), TOGETHER)]
        groups += [[c] for c in new if c[-1] == " "]  # spaces at the end of a text; nothing may follow them
        joined = ["".join(g) for g in groups]
        ids = [e.ids for e in self.inner.encode_batch_fast(joined, add_special_tokens=False)]
        decoded = self.inner.decode_batch(ids, skip_special_tokens=False) if new else []
        # the reference puts one space before what it is given
        for g, i, ok in zip(groups, ids, self._check(joined, ids, decoded, [j[1:] for j in joined])):
            blobs = split_ids(np.array(i, np.int64), self.bytes_of, [len(c.encode()) for c in g])
            self.known.update(zip(g, blobs))
            if not all(ok):
                self._look_closer(g, blobs)
                rest = [c for c in g if c not in self.odd]
                if len(rest) > 1 and (len(rest) == len(g) or not self._pass_together(rest)):
                    self.joint.update(rest)

    def _pass_together(self, chunks: list[str]) -> bool:
        joined = "".join(chunks)
        ids = [self.inner.encode_batch_fast([joined], add_special_tokens=False)[0].ids]
        return all(self._check([joined], ids, self.inner.decode_batch(ids, skip_special_tokens=False), [joined[1:]])[0])

    def _look_closer(self, chunks: list[str], blobs: list[bytes]) -> None:
        """Which chunks of a group that failed a comparison fail it alone."""
        ids = [np.frombuffer(b, "<u4").tolist() for b in blobs]
        decoded = self.inner.decode_batch(ids, skip_special_tokens=False)
        for c, i, d, ok in zip(chunks, ids, decoded, self._check(chunks, ids, decoded, [c[1:] for c in chunks])):
            if c == " " and self.reference:  # the reference puts no space before nothing: a lone space is the marker's piece
                ok = (ok[0], i == [self.reference.piece_to_id(SPACE)])
            if not all(ok):
                self.odd[c] = (*ok, len(d) - len(c))

    def encode(self, texts: list[str]) -> list[tuple[bytes, int, bool, bool]]:
        """(ids, decoded length, round trip, parity) of each text."""
        if not self.by_chunk or any(SPACE in t for t in texts):
            if self.by_chunk:  # a marker in a text stands for a space, so those texts have other chunks
                marked = [i for i, t in enumerate(texts) if SPACE in t]
                out = self.encode([t if SPACE not in t else "" for t in texts])
                for i, done in zip(marked, self._whole([texts[i] for i in marked])):
                    out[i] = done
                return out
            return self._whole(texts)
        cut = []
        for t in texts:
            if not t:
                cut.append([])
            elif "  " in t or t[0] == " " or t[-1] == " ":
                cut.append(CHUNK.findall(" " + t))
            else:
                cut.append([" " + w for w in t.split(" ")])
        self._learn(set().union(*cut) if cut else set())
        out, known, odd = [], self.known.__getitem__, self.odd
        for t, c in zip(texts, cut):
            bad = [odd[x] for x in c if x in odd] if odd else []
            out.append((b"".join(map(known, c)), len(t) + sum(x[2] for x in bad), all(x[0] for x in bad), all(x[1] for x in bad)))
        if self.joint:
            again = [i for i, c in enumerate(cut) if not self.joint.isdisjoint(c)]
            for i, done in zip(again, self._whole([texts[i] for i in again])):
                out[i] = done
        return out

    def _whole(self, texts: list[str]) -> list[tuple[bytes, int, bool, bool]]:
        ids = [e.ids for e in self.whole.encode_batch(texts, add_special_tokens=False)]
        decoded = self.whole.decode_batch(ids, skip_special_tokens=False) if texts else []
        return [(np.array(i, "<u4").tobytes(), len(d), *ok) for i, d, ok in zip(ids, decoded, self._check(texts, ids, decoded, texts))]

    def decode(self, ids: list[bytes]) -> list[str]:
        return self.whole.decode_batch([np.frombuffer(i, "<u4").tolist() for i in ids], skip_special_tokens=False) if ids else []


def codec(path: str, verify: str = "all") -> Codec:
    if (path, verify) not in _WORKER:
        _WORKER[path, verify] = Codec(path, verify)
    return _WORKER[path, verify]


def encode(docs: DataFrame, path: str, verify: str = "all") -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit), n_tokens, n_chars, n_decoded, round_trip, parity for each row."""

    def run(batches):
        c = codec(path, verify)
        for batch in (part for whole in batches for part in parts(whole)):
            texts = batch.column("text").to_pylist()
            done = c.encode(texts)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([d[0] for d in done], pa.binary()),
                    pa.array([len(d[0]) // 4 for d in done], pa.int64()),
                    pa.array([len(t) for t in texts], pa.int64()),
                    *(pa.array([d[k] for d in done], kind) for k, kind in ((1, pa.int64()), (2, pa.bool_()), (3, pa.bool_()))),
                ],
                names=["doc_id", "ids", "n_tokens", "n_chars", "n_decoded", "round_trip", "parity"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(run, ENCODED)


def decode(encoded: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """doc_id, text for each row of doc_id and ids; null ids count as none."""

    def run(batches):
        c = codec(path, "none")
        for batch in batches:
            blobs = [b or b"" for b in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(c.decode(blobs), pa.string())], names=["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(ids).alias("ids")).mapInArrow(run, "doc_id long, text string")


def checksum(ids: Column | str) -> Column:
    return F.crc32(ids)
