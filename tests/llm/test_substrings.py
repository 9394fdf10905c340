import hashlib
import re

import numpy as np
import pytest

from custodia.llm import substring_dedup, suffix_dedup

from .util import docs, noisy


def brute_words(texts, ids, width):
    ws = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    first = {}
    for i, w in zip(ids, ws):
        for k in range(len(w) - width + 1):
            key = tuple(w[k : k + width])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, w in zip(ids, ws):
        gone = set()
        for k in range(len(w) - width + 1):
            if first[tuple(w[k : k + width])] < i:
                gone.update(range(k, k + width))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize(("width", "block", "shard"), [(50, 4 << 20, 1 << 20), (5, 2000, 500), (3, 600, 100)])
def test_windows_match_brute_force(spark, width, block, shard):
    texts = noisy(11, 80)
    marked = substring_dedup.mark_repeats(docs(spark, texts, odd=True), width, block, shard)
    got = sorted(map(tuple, substring_dedup.digest(marked).collect()))
    assert got == brute_words(texts, range(len(texts)), width)


def test_windows_repeated_ids_and_empty(spark):
    text = " ".join(f"w{i}" for i in range(60))
    d = docs(spark, [text, text, text, "", None], ids=[4, 4, 9, None, None])
    got = sorted((str(r.doc_id), r.n_words, r.n_removed) for r in substring_dedup.digest(substring_dedup.mark_repeats(d)).collect())
    assert got == [("4", 60, 0), ("4", 60, 0), ("9", 60, 60), ("None", 0, 0), ("None", 0, 0)]
    assert substring_dedup.mark_repeats(docs(spark, [])).count() == 0


def test_spans_are_maximal(spark):
    passage = " ".join(f"p{i}" for i in range(70))
    d = docs(spark, [passage, "a b " + passage + " c " + passage])
    spans = {r.doc_id: [tuple(s) for s in r.spans] for r in substring_dedup.mark_repeats(d).collect()}
    assert spans == {0: [], 1: [(2, 72), (73, 143)]}


def brute_bytes(texts, ids, width):
    raw = [(t or "").encode() for t in texts]
    order = sorted(range(len(raw)), key=lambda i: (ids[i], raw[i]))
    seen, out = set(), []
    for i in order:
        t, gone = raw[i], set()
        for k in range(len(t) - width + 1):
            s = t[k : k + width]
            if s in seen:
                gone.update(range(k, k + width))
            seen.add(s)
        kept = bytes(c for k, c in enumerate(t) if k not in gone)
        runs = sum(1 for k in gone if k - 1 not in gone)
        out.append((ids[i], len(t), len(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize(("width", "kmer", "block", "shard", "batch", "hot", "same"), [
    (100, 24, 4 << 20, 4 << 20, 2048, 4096, 1024), (100, 24, 3000, 4000, 7, 3, 2), (20, 6, 2000, 3000, 16, 2, 1024), (8, 4, 1500, 2000, 5, 4096, 1),
])
def test_bytes_match_brute_force(spark, width, kmer, block, shard, batch, hot, same):
    texts = noisy(13, 70) + ["ab" * 300, "\x00" * 150, "\x00" * 130 + "a"]
    marked = suffix_dedup.mark_repeats(docs(spark, texts, odd=True), width, kmer, block, shard, batch, hot, same)
    got = sorted(map(tuple, suffix_dedup.digest(marked).collect()))
    assert got == brute_bytes(texts, list(range(len(texts))), width)


def test_bytes_repeated_ids_and_empty(spark):
    text = "".join(f"w{i} " for i in range(60))
    d = docs(spark, [text, text, "x", None], ids=[4, 4, None, None])
    got = sorted((str(r.doc_id), r.n_removed) for r in suffix_dedup.digest(suffix_dedup.mark_repeats(d)).collect())
    assert got == [("4", 0), ("4", len(text)), ("None", 0), ("None", 0)]
    assert suffix_dedup.mark_repeats(docs(spark, [])).count() == 0


def test_levels_grow_geometrically():
    r = np.random.default_rng(3)
    data = r.integers(97, 99, 2000).astype(np.uint8)
    family = suffix_dedup.Family(data, r.permutation(1980), r.permutation(1980), 12)
    gone = []
    for i in range(0, 1980, 50):
        gone += family.add(np.arange(i, min(i + 50, 1980))).tolist()
    sizes = [len(s) for s in family.levels]
    assert sizes == sorted(sizes, reverse=True) and len(sizes) <= 6
    assert all((np.diff(np.unique(family._strings(s), return_inverse=True)[1]) > 0).all() for s in family.levels)
    first, want = {}, set()
    for n in np.argsort(family.age).tolist():
        string = data[family.at[n] : family.at[n] + 12].tobytes()
        if first.setdefault(string, n) != n:
            want.add(n)
    assert set(gone) == want and len(gone) == len(want) > 50


def test_equal_hashes_are_compared_by_bytes():
    raw = np.frombuffer(b"abcdefabcxef", np.uint8)
    assert suffix_dedup.same_bytes(raw, np.array([0, 0, 2]), np.array([6, 6, 8]), np.array([3, 4, 1])).tolist() == [True, False, True]
    assert len(suffix_dedup.same_bytes(raw, *[np.zeros(0, int)] * 3)) == 0


def test_words_that_collide_in_polynomials(spark):
    """A Thue-Morse word and its complement have one polynomial hash modulo 2**64, whatever the base."""
    bits = [bin(i).count("1") & 1 for i in range(2048)]
    one, other = ("".join("ab"[b ^ flip] for b in bits) for flip in (0, 1))
    tail = " ".join(f"w{i}" for i in range(49))
    d = docs(spark, [f"{one} {tail}", f"{other} {tail}", f"{one} {tail}"])
    assert [r.n_removed for r in substring_dedup.digest(substring_dedup.mark_repeats(d)).sort("doc_id").collect()] == [0, 0, 50]
