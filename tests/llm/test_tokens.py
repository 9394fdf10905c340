import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers as P
import pytest
import sentencepiece as reference
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from custodia.llm import packing, piece_model, sentencepiece, tokens

from .util import docs, noisy

BPE, PIECE = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
ODD = ["", " ", "a", " a", "a ", "a  b", "a\n b \n c", "it's  we'll\t x", "<|endoftext|> a <|endoftext|>", "日本 語 x   y", "😀 😀", "a\r\n\r\nb", "1 2  3", "\x1c x \x85 y", "x" * 5000, "▁ ▁a", "<s> <unk> </s> <0x41>"]


def test_encoder_matches_whole_texts():
    plain, ours = Tokenizer.from_file(BPE), tokens.Encoder(BPE)
    texts = ODD + [t or "" for t in noisy(3)]
    for _ in range(2):  # learning the pieces, then knowing them
        for t, got in zip(texts, split(ours, texts)):
            assert got == plain.encode(t, add_special_tokens=False).ids, repr(t[:40])
    ours.forget()
    assert split(ours, texts[::-1])[::-1] == split(ours, texts)


def split(encoder, texts):
    ids, offs = encoder.encode(pa.array(texts, pa.string()))
    return [ids[a:b].tolist() for a, b in zip(offs, offs[1:])]


@settings(max_examples=500, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab '.1\n\t é日\x1c\x85\u200b\u2003\u3000“\xa0"), max_size=40), max_size=3))
def test_encoder_on_any_white_space(texts):
    assert split(tokens.encoder(BPE), texts) == [_plain().encode(t, add_special_tokens=False).ids for t in texts]


def _plain(kept=[]):
    kept or kept.append(Tokenizer.from_file(BPE))
    return kept[0]


@pytest.mark.parametrize("length", [16, 2048])
def test_packing(spark, length):
    texts = noisy(4) + ODD
    d = docs(spark, texts, odd=True)
    rows = packing.pack(d, BPE, length=length).collect()
    ids = {i: _plain().encode(t or "", add_special_tokens=False).ids + [1] for i, t in enumerate(texts)}
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
        part = np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4").tobytes()
        assert r.ids == part and r.ids_crc32 == zlib.crc32(part) and r.doc_tokens == len(ids[r.doc_id])
    for i, whole in ids.items():
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r.start):
            assert r.start == at
            at += r.length
        assert at == len(whole)
    for parts in by_seq.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= length
    assert sorted(by_seq) == list(range(len(by_seq)))
    joined = packing.sequences(spark.createDataFrame(rows)).collect()
    assert sum(len(r.ids) for r in joined) == 4 * sum(map(len, ids.values()))


def test_packing_repeated_null_and_empty(spark):
    assert packing.pack(docs(spark, []), BPE).count() == 0
    got = packing.pack(docs(spark, ["a b", "a b", None, None], ids=[1, 1, None, None]), BPE, length=4).collect()
    assert Counter(r.doc_id for r in got) == {1: 2, None: 2}
    assert len({(r.sequence_id, r.offset) for r in got}) == 4


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 32), st.integers(1, 50), max_size=20))
def test_patterns_hold_the_histogram(histogram):
    patterns = packing.shortest_pack_first(histogram, 32)
    held = Counter()
    for p in patterns:
        assert sum(p.lengths) <= 32
        for n in p.lengths:
            held[n] += p.count
    assert held == histogram
    ranks = defaultdict(list)
    for size, first, last, *_ in packing.slots(patterns):
        ranks[size] += range(first, last + 1)
    assert all(sorted(r) == list(range(histogram[s])) for s, r in ranks.items())


def one_by_one(sizes, length):
    """Shortest-pack-first on single pieces: longest first, each into the fullest^-1 (emptiest) pack that has room."""
    packs = []
    for size in sorted(sizes, reverse=True):
        best = max((p for p in packs if length - sum(p) >= size), key=lambda p: length - sum(p), default=None)
        if best is None:
            packs.append([size])
        else:
            best.append(size)
    return Counter(sum(p) for p in packs)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 32), max_size=120))
def test_patterns_fill_like_packing_piece_by_piece(sizes):
    got = Counter()
    for p in packing.shortest_pack_first(Counter(sizes), 32):
        got[sum(p.lengths)] += p.count
    assert got == one_by_one(sizes, 32)


def test_sentencepiece_parity_and_round_trip(spark):
    texts = ODD + noisy(5)
    sp = reference.SentencePieceProcessor(model_file=PIECE)
    done = sentencepiece.encode(docs(spark, texts, odd=True), PIECE)
    got = {r.doc_id: r for r in done.collect()}
    for i, t in enumerate(texts):
        assert np.frombuffer(got[i].ids, "<u4").tolist() == sp.encode(t or ""), repr(t[:40])
        assert got[i].parity and got[i].n_decoded == len(t or "")
        assert got[i].round_trip == ("▁" not in (t or ""))  # the marker itself decodes to a space, in the reference too
    back = {r.doc_id: r.text for r in sentencepiece.decode(done, PIECE).collect()}
    assert back == {i: (t or "").replace("▁", " ") for i, t in enumerate(texts)}
    assert sentencepiece.encode(docs(spark, []), PIECE).count() == 0


def test_decoding_any_ids_matches_the_reference():
    sp, c = reference.SentencePieceProcessor(model_file=PIECE), sentencepiece.Codec(PIECE)
    r = np.random.default_rng(5)
    for _ in range(50):
        ids = r.integers(259, 32000, 12).tolist()
        assert c.decode([np.array(ids, "<u4").tobytes()])[0] == sp.decode(ids)


def test_unigram_models_keep_their_scores():
    m = piece_model.Model(pieces=[("<unk>", 0, 2), ("▁", -2, 1), ("a", -1.0, 1), ("b", -1.5, 1), ("ab", -1.2, 1), ("▁a", -2.5, 1)], kind=1)
    assert [piece_model.build(m).encode("ab  a").tokens][0] == ["▁", "ab", "▁a"]
    assert not piece_model.spans_words(m)


def test_chunks_that_fail_only_together_are_compared_in_their_texts():
    class Differs:
        """The reference, but with one more id where both words meet."""

        def __init__(self):
            self.real = reference.SentencePieceProcessor(model_file=PIECE)

        def encode(self, given, num_threads=1):
            return [i + [0] * ("alpha" in t and "beta" in t) for t, i in zip(given, self.real.encode(given))]

        def piece_to_id(self, piece):
            return self.real.piece_to_id(piece)

    c, plain = sentencepiece.Codec(PIECE), sentencepiece.Codec(PIECE)
    c.reference = Differs()
    texts = ["alpha beta", "alpha gamma", "beta", "", "delta"]
    assert c.by_chunk
    for _ in range(2):
        done = c.encode(texts)
        assert [d[3] for d in done] == [False, True, True, True, True]
        assert [d[:3] for d in done] == [d[:3] for d in plain.encode(texts)]
