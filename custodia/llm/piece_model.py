"""SentencePiece models on the tokenizers library.

The model file is a protocol buffer; its wire format is read here directly: pieces with scores and
types, the trainer's model type and byte fallback, and the normaliser's settings. From these a
tokenizers pipeline is built: normaliser (precompiled character map, spaces), the metaspace marker,
a unigram model with its scores or a BPE model with merges in order of scores, byte fallback, and a
decoder that undoes them.
"""

from __future__ import annotations

import re
import struct
from dataclasses import dataclass, field

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


@dataclass
class Model:
    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = 1  # 1 unigram, 2 BPE
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    remove_spaces: bool = True
    escape_spaces: bool = True


def _fields(raw: bytes):
    """(number, value) of each field of a message; lengths and varints decoded."""
    at = 0

    def varint() -> int:
        nonlocal at
        shift = value = 0
        while True:
            b = raw[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(raw):
        key = varint()
        kind = key & 7
        if kind == 0:
            value: int | bytes = varint()
        elif kind == 2:
            n = varint()
            value = raw[at : at + n]
            at += n
        else:
            n = 8 if kind == 1 else 4
            value = raw[at : at + n]
            at += n
        yield key >> 3, value


def parse(raw: bytes) -> Model:
    """Field numbers are those of the public sentencepiece_model.proto."""
    model = Model()
    for number, value in _fields(raw):
        if number == 1:
            piece, score, kind = "", 0.0, NORMAL
            for n, v in _fields(value):
                if n == 1:
                    piece = v.decode()
                elif n == 2:
                    score = struct.unpack("<f", v)[0]
                elif n == 3:
                    kind = v
            model.pieces.append((piece, score, kind))
        elif number == 2:
            for n, v in _fields(value):
                if n == 3:
                    model.kind = v
                elif n == 35:
                    model.byte_fallback = bool(v)
        elif number == 3:
            for n, v in _fields(value):
                if n == 2:
                    model.charsmap = v
                elif n == 3:
                    model.dummy_prefix = bool(v)
                elif n == 4:
                    model.remove_spaces = bool(v)
                elif n == 5:
                    model.escape_spaces = bool(v)
    return model


def merges_of(model: Model) -> list[tuple[str, str]]:
    """Every way to join two pieces into a third, best score first; among the ways of one piece, the
    earlier left part first."""
    score = {p: s for p, s, k in model.pieces if k in (NORMAL, USER, UNUSED)}
    rank = {p: i for i, (p, _, _) in enumerate(model.pieces)}
    ways = [
        (-s, rank[p], rank[p[:i]], rank[p[i:]], p[:i], p[i:])
        for p, s in score.items()
        for i in range(1, len(p))
        if p[:i] in score and p[i:] in score
    ]
    return [(w[4], w[5]) for w in sorted(ways)]


def build(model: Model, prefix: bool = True):
    """The tokenizer; without ``prefix`` it adds no marker of its own, as inside a text."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers

    unk = next((i for i, p in enumerate(model.pieces) if p[2] == UNKNOWN), None)
    if model.kind == 1:
        core = models.Unigram([(p, s) for p, s, _ in model.pieces], unk_id=unk, byte_fallback=model.byte_fallback)
    elif model.kind == 2:
        vocab = {p: i for i, (p, _, _) in enumerate(model.pieces)}
        name = model.pieces[unk][0] if unk is not None else None
        core = models.BPE(vocab, merges_of(model), unk_token=name, fuse_unk=True, byte_fallback=model.byte_fallback)
    else:
        raise ValueError("only unigram and BPE models have pieces that tokenizers can score")
    out = Tokenizer(core)
    steps = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
    if model.remove_spaces:
        steps += [normalizers.Strip(left=True, right=True), normalizers.Replace(Regex(" {2,}"), " ")]
    if prefix and model.dummy_prefix:
        steps.append(normalizers.Prepend(SPACE))
    steps.append(normalizers.Replace(" ", SPACE))
    out.normalizer = normalizers.Sequence(steps)
    undo = [decoders.Replace(SPACE, " "), decoders.ByteFallback(), decoders.Fuse()]
    out.decoder = decoders.Sequence(undo + ([decoders.Strip(content=" ", left=1)] if prefix and model.dummy_prefix else []))
    return out


def spans_words(model: Model) -> bool:
    """Whether a piece can reach from one word over a space into the next."""
    return any(SPACE in p.lstrip(SPACE) for p, _, k in model.pieces if k in (NORMAL, USER))


CHUNK = re.compile(r" +[^ ]*|[^ ]+")
