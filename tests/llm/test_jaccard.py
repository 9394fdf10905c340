import random
import re

import numpy as np
import pytest

from custodia.llm import jaccard_join
from custodia.llm.jaccard_join import Search

from .util import docs, noisy


def brute_sets(texts):
    out = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        out.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    return out


def brute_classes(sets, percent=80):
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(sets))]


def near_copies(seed, groups=12, members=9):
    r = random.Random(seed)
    texts = noisy(seed, 40)
    for g in range(groups):
        base = [f"g{g}w{r.randrange(400)}" for _ in range(r.randint(5, 150))]
        for _ in range(members):
            w = list(base)
            for _ in range(r.randint(0, max(1, len(w) // 40))):
                w[r.randrange(len(w))] = f"e{r.randrange(10**6)}"
            texts.append(" ".join(w).upper() if r.random() < 0.2 else " ".join(w))
    passage = " ".join(f"hot{i}" for i in range(120))
    for i in range(40):  # the passage makes up most of the document
        texts.append(passage + " " + " ".join(f"u{i}x{k}" for k in range(r.randint(5, 40))))
    r.shuffle(texts)
    return texts


@pytest.mark.parametrize(("seed", "block", "shard", "together"), [(1, 4 << 20, 8 << 20, 2048), (2, 3000, 4000, 2048), (3, 5000, 6000, 3)])
def test_classes_match_brute_force(spark, seed, block, shard, together):
    texts = near_copies(seed)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.classify(docs(spark, texts, odd=True), block_bytes=block, shard_bytes=shard, together=together).collect()}
    sets = brute_sets(texts)
    want = brute_classes(sets)
    assert got == {i: (len(s), c) for i, (s, c) in enumerate(zip(sets, want))}


@pytest.mark.parametrize("percent", [50, 80, 90])
def test_search_finds_every_match(percent):
    r = np.random.default_rng(percent)
    sets = [np.unique(r.integers(0, 60, r.integers(1, 40))) for _ in range(150)]
    sets += [np.unique(np.append(sets[0], r.integers(100, 105, 2))) for _ in range(30)]
    s = Search(np.array([len(x) for x in sets]), np.concatenate(sets).astype(np.uint64), percent)
    label = s.label.copy()
    for q in range(len(sets)):
        a = sets[s.order[q]]
        want = [j for j in range(q) if label[j] != label[q] and 100 * len(np.intersect1d(a, sets[s.order[j]])) >= percent * len(np.union1d(a, sets[s.order[j]]))]
        assert s.matches(q).tolist() == want
    classes, want = s.classes(), brute_classes([set(x.tolist()) for x in sets], percent)
    assert len(set(zip(classes.tolist(), want))) == len(set(classes.tolist())) == len(set(want))


def test_lists_part_by_size_and_name_one_place():
    name = np.array([5, 5, 5, 7, 7, 9], np.uint64)
    at, place, cut = jaccard_join.answers(name, np.array([10, 100, 90, 10, 100, 3]), np.array([1, 8, 4, 2, 2, 1], np.int32), 80, 2)
    assert sorted(zip(at.tolist(), place.tolist(), cut.tolist())) == [(1, 4, 1), (2, 4, 1)]
    at, place, cut = jaccard_join.answers(np.zeros(5, np.uint64), np.full(5, 10), np.array([6, 3, 6, 3, 3], np.int32), 80, 2)
    assert set(zip(place.tolist(), cut.tolist())) == {(3, 3)} and len(at) == 5


def test_repeated_null_and_empty(spark):
    d = docs(spark, ["a b c d e f"] * 3 + [None, "x", "x"], ids=[7, 7, 3, 1, None, 9])
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in jaccard_join.classify(d).collect())
    assert got == [("1", 0, "1"), ("3", 2, "3"), ("7", 2, "3"), ("7", 2, "3"), ("9", 1, "9"), ("None", 1, "None")]
    assert jaccard_join.classify(docs(spark, [])).count() == 0
    kept = jaccard_join.drop_near_copies(d)
    assert kept.columns == d.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["1", "3", "9", "None"]
    odd = d.selectExpr("*", "1 as gone", "'x' as cell", "2 as row", "3 as _id", "4 as block")
    assert jaccard_join.drop_near_copies(odd).columns == odd.columns


def test_repeated_ids_link_by_each_of_their_texts(spark):
    one, two = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(60))
    d = docs(spark, [one, two, one + " x", two + " y", two], ids=[7, 7, 8, 9, 11])
    assert {r.doc_id: r.component_id for r in jaccard_join.classify(d).collect()} == {7: 7, 8: 7, 9: 7, 11: 7}


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 90), (95, 100), (95, 91)]
    random.Random(1).shuffle(edges)
    got = {r.doc_id: r.component_id for r in jaccard_join.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 61)} | {i: 90 for i in (91, 95, 100)}


def test_long_words_are_told_apart(spark):
    """A Thue-Morse word and its complement have one polynomial hash modulo 2**64, whatever the base."""
    bits = [bin(i).count("1") & 1 for i in range(2048)]
    one, other = ("".join("ab"[b ^ flip] for b in bits) for flip in (0, 1))
    got = jaccard_join.classify(docs(spark, [one, other, one.upper(), f"{one} {other}"])).select("doc_id", "component_id").sort("doc_id").collect()
    assert [tuple(r) for r in got] == [(0, 0), (1, 1), (2, 0), (3, 3)]
