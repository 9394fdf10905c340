import random
import zlib
from collections import Counter, defaultdict

import pytest

from custodia.llm import sharding

from .util import docs


def check(rows, texts, ids, shards):
    """The law of rows, the slots and the facts; returns the cuts of each group of copies beyond the shards that it needs."""
    assert Counter(r.doc_id for r in rows) == Counter(ids)
    want = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in zip(ids, texts))
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == want
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r.slot)
    counts = [len(by[s]) for s in range(shards)]
    assert set(by) <= set(range(shards)) and max(counts) - min(counts) <= 1
    assert all(sorted(x) == list(range(len(x))) for x in by.values())
    text_of, groups = dict(zip(ids, texts)), defaultdict(Counter)
    for r in rows:
        groups[text_of[r.doc_id] or ""][r.shard] += 1
    most = max(counts) if counts else 0
    return {t: len(c) - -(-sum(c.values()) // most) for t, c in groups.items()}


@pytest.mark.parametrize(("hot", "groups", "single"), [(0.35, 150, 500), (0.0, 400, 0), (0.9, 5, 20)])
def test_law_and_groups(spark, hot, groups, single):
    r = random.Random(groups)
    texts = [f"g{g}" for g in range(groups) for _ in range(r.choice([2, 2, 3, 5, 20]))] + [f"s{i}" for i in range(single)] + [None, "", "", "ä" * 50000]
    texts += ["hot"] * int(hot / (1 - hot) * len(texts))
    r.shuffle(texts)
    ids = list(range(len(texts)))
    cuts = check(sharding.place(docs(spark, texts, odd=True)).collect(), texts, ids, 24)
    # shares end within a group at most once for each shard, twice where much is beyond them
    assert sum(cuts.values()) <= 48
    if single:
        assert sum(c > 0 for c in cuts.values()) <= 24


def test_few_rows_repeats_and_nulls(spark):
    texts, ids = ["a", "a", "a", "b", None], [1, 1, 1, None, None]
    rows = sharding.place(docs(spark, texts, ids)).collect()
    assert sorted((str(r.doc_id), r.size) for r in rows) == [("1", 9)] * 3 + [("None", 8), ("None", 9)]
    assert max(Counter(r.shard for r in rows).values()) == 1 and {r.slot for r in rows} == {0}
    assert sharding.place(docs(spark, [])).count() == 0


def test_three_copies_stay_together_without_quota_pressure(spark):
    texts = [f"t{i % 100}" for i in range(300)] + [f"s{i}" for i in range(3000)]
    cuts = check(sharding.place(docs(spark, texts)).collect(), texts, list(range(len(texts))), 24)
    assert not any(cuts.values())
