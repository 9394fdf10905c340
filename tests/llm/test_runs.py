import hashlib
import random
import re
import time
import zlib

import numpy as np
import pytest

from custodia.llm import runs

from .util import docs, noisy


def brute_runs(w, least):
    """Every run, by trying all periods and starts."""
    found = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(least, 2 * q) and j > i:
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, q, e - s) for (s, e), q in found.items())


def brute(doc_id, text, least=12, loop=True):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(w)
    if loop and doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = brute_runs(w, least)
    gone = {i for s, q, k in found for i in range(s + q, s + k)}
    lines = "".join(f"{s},{k},{q}\n" for s, q, k in found)
    best = min(((-k, s, q) for s, q, k in found), default=None)
    top = (best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4
    kept = " ".join(x for i, x in enumerate(w) if i not in gone)
    return (str(doc_id), len(found), *top, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def test_query_matches_brute_force(spark):
    r = random.Random(3)
    texts = noisy(5, 90)
    for k in range(120):
        unit = [f"u{r.randint(0, 3)}" for _ in range(r.randint(1, 9))]
        loops = " ".join((unit * 40)[: r.randint(2, 90)])
        texts.append(" ".join([*(f"x{r.randint(0, 50)}" for _ in range(r.randint(0, 9))), loops, *(f"u{r.randint(0, 3)}" for _ in range(r.randint(0, 30)))]))
    ids = list(range(len(texts)))
    ids[7] = ids[8] = 6  # repeated ids
    ids[9] = None
    got = sorted((str(x[0]), *x[1:]) for x in runs.digest(runs.find_runs(docs(spark, texts, ids, odd=True), runs.looped)).collect())
    assert got == sorted(brute(i, t) for i, t in zip(ids, texts))
    assert sum(x[1] > 0 for x in got) > 40
    assert runs.find_runs(docs(spark, [])).count() == 0


@pytest.mark.parametrize("least", [2, 4, 12, 20])
def test_all_runs_of_small_alphabets(least):
    r = random.Random(least)
    for _ in range(150):
        rows = [[r.randint(0, r.choice([0, 1, 2, 5])) for _ in range(r.randint(0, 70))] for _ in range(4)]
        word = np.array(sum(rows, []), np.int64)
        row = np.repeat(np.arange(4), [len(x) for x in rows])
        want = []
        for k, x in enumerate(rows):
            at = sum(map(len, rows[:k]))
            want += [(at + s, q, n) for s, q, n in brute_runs(x, least)]
        assert sorted(runs._runs(word, row, least)) == sorted(want)


def test_long_texts_take_seconds():
    r = np.random.default_rng(1)
    for word in (np.zeros(300_000, np.int64), np.arange(300_000) % 7, r.integers(0, 300, 300_000), np.tile(r.integers(0, 300, 70_000), 4)):
        began = time.perf_counter()
        list(runs._runs(word.astype(np.int64), np.zeros(len(word), np.int64), 12))
        assert time.perf_counter() - began < 30
