import itertools
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from custodia.llm import toxicity

from .util import docs


def corpus(n=1200, seed=3):
    """Junk words mark low quality; bad words mark toxicity, and toxicity is commoner in junk."""
    r = random.Random(seed)
    texts, labels = [], []
    for i in range(n):
        words = [f"w{r.randrange(300)}" for _ in range(r.randint(5, 120))]
        low = r.random() < 0.3
        toxic = r.random() < (0.4 if low else 0.1)
        for marks, on in ((("junk", "spam", "Zzz"), low), (("idiot", "SCUM", "trash"), toxic)):
            for _ in range(2 * on):
                words[r.randrange(len(words))] = r.choice(marks)
        texts.append(" ".join(words))
        labels.append((i, int(not low), int(toxic)))
    return texts, labels


@pytest.fixture(scope="module")
def judged(spark):
    texts, labels = corpus()
    table = spark.createDataFrame(labels[:800] + labels[:5] + [(5000, None, 1), (None, 1, 0)], "doc_id long, quality int, toxic int")
    return texts, labels, table, docs(spark, texts + ["", None], odd=True)


def test_held_out_accuracy(judged):
    texts, labels, table, d = judged
    got = {r.doc_id: r for r in toxicity.judge(d, table).collect()}
    held = labels[800:]
    hit = sum(got[i].toxic == bool(t) for i, _, t in held)
    assert hit / len(held) > 0.95
    assert sum((got[i].p_low_quality >= 0.5) == (q == 0) for i, q, _ in held) / len(held) > 0.95
    assert not got[len(texts)].toxic and not got[len(texts) + 1].toxic


def test_dropping_keeps_columns_and_is_deterministic(judged):
    texts, labels, table, d = judged
    one = toxicity.drop_toxic(d, table, max_train=300)
    assert one.columns == d.columns
    assert sorted(one.collect(), key=str) == sorted(toxicity.drop_toxic(d, table, max_train=300).collect(), key=str)


def test_without_labels(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    d = docs(spark, ["a", None], ids=[1, None])
    assert sorted((str(r.doc_id), round(r.p_toxic, 3)) for r in toxicity.judge(d, none).collect()) == [("1", 0.0), ("None", 0.0)]
    one = spark.createDataFrame([(1, 1, 1)], "doc_id long, quality int, toxic int")
    assert all(r.toxic for r in toxicity.judge(d, one).collect())
    assert toxicity.judge(docs(spark, []), none).count() == 0


def naive(text):
    """Words and their beginnings, once and again, by plain string functions."""
    low = "".join(c.lower() if c.isascii() or c in "ÀÉÑÖ" else c for c in text or "")
    words = re.findall(r"[a-z0-9_éàñöß日本]+", low)
    seen = Counter([(0, w) for w in words] + [(k, w[:k]) for k in toxicity.BEGINNINGS for w in words if len(w) > k])
    return {(x, 1) for x in seen} | {(x, 2) for x, n in seen.items() if n > 1}


def test_features_match_strings():
    from custodia.llm.common import utf8

    texts = ["", "Wörter WÖRTER «Éàñö» “Straße” x", None, "日本日本日本日本 a-b_c, don't ¿Qué?", "abcdefgh abcdefgi\u00a0z", "é"]
    row, feature = toxicity.presence(*toxicity.features(*utf8(pa.array([t or "" for t in texts]))))
    assert [int((row == i).sum()) for i in range(len(texts))] == [len(naive(t)) for t in texts]
    code = {}
    for i, t in enumerate(texts):  # one cell for each feature and the other way round
        alone = toxicity.presence(*toxicity.features(*utf8(pa.array([t or ""]))))[1]
        assert sorted(alone.tolist()) == sorted(feature[row == i].tolist())
        code[i] = set(alone.tolist())
    for i, j in itertools.combinations(range(len(texts)), 2):
        assert len(code[i] & code[j]) == len(naive(texts[i]) & naive(texts[j]))


def dense_fit(x, y, strength, free):
    """The same minimum by 30 000 plain proximal steps; the columns ``free`` are not penalised."""
    w, step = np.zeros(x.shape[1]), 4 * len(y) / np.linalg.norm(x, 2) ** 2
    for _ in range(30_000):
        w = w - step * x.T @ (1 / (1 + np.exp(-x @ w)) - y) / len(y)
        w = np.where(free, w, np.sign(w) * np.maximum(np.abs(w) - step * strength, 0))
    return w


def test_chain_matches_brute_force(spark):
    """Every probability of a small chain, with dense matrices, plain steps and folds taken one by one."""
    texts, labels = corpus(60, seed=8)
    texts = [" ".join(t.split()[:12]) for t in texts]
    table, strength, min_df = spark.createDataFrame(labels[:48], "doc_id long, quality int, toxic int"), 0.02, 2
    d = docs(spark, texts)
    fold = {r.doc_id: r.f for r in d.select("doc_id", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(3)).alias("f")).collect()}
    sets = [naive(t) for t in texts]

    def design(train, extra):
        df = Counter(f for i in train for f in sets[i])
        names = sorted((f for f in df if df[f] >= min_df), key=str)
        x = np.array([[float(f in s) for f in names] for s in sets]).reshape(len(texts), -1)
        return np.hstack((x, extra, np.ones((len(texts), 1))))

    def model(train, y, extra):
        x = design(train, extra)
        w = dense_fit(x[train], y[train], strength, np.arange(x.shape[1]) == x.shape[1] - 1)
        return 1 / (1 + np.exp(-x @ w))

    low = np.array([1 - q for _, q, _ in labels], float)
    toxic = np.array([t for _, _, t in labels], float)
    train, none = np.arange(48), np.zeros((len(texts), 0))
    first, unseen = model(train, low, none), np.zeros(len(texts))
    for f in range(3):
        part = np.array([fold[i] == f for i in range(len(texts))])
        unseen[part] = model(train[~part[:48]], low, none)[part]
    # trained with out-of-fold probabilities, applied to those of the whole model
    x = design(train, unseen[:, None])
    w = dense_fit(x[train], toxic[train], strength, np.arange(x.shape[1]) == x.shape[1] - 1)
    x[:, -2] = first
    second = 1 / (1 + np.exp(-x @ w))
    got = {r.doc_id: r for r in toxicity.judge(d, table, strength=strength, min_df=min_df).collect()}
    assert max(abs(got[i].p_low_quality - first[i]) for i in got) < 0.02
    assert max(abs(got[i].p_toxic - second[i]) for i in got) < 0.02
    assert any(abs(first[i] - unseen[i]) > 0.02 for i in range(48))  # the folds do differ


def test_repeated_rows_choose_the_smallest(spark):
    texts, labels = corpus(200)
    d = docs(spark, texts + ["zz", "aa"], ids=[*range(200), 7, 7])
    one = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    two = spark.createDataFrame(labels[::-1] + [(3, 1, 1), (3, 0, 0)], "doc_id long, quality int, toxic int")
    a, b = (sorted(toxicity.sample(d, t, toxicity.categories_of(t), 1000, 3).collect()) for t in (one, two))
    assert [r for r in a if r["_id"] != 3] == [r for r in b if r["_id"] != 3] and len(a) == 200
    judged = [r for r in toxicity.judge(d, one).collect() if r.doc_id == 7]
    assert len(judged) == 3


def test_clashing_columns_survive(spark):
    texts, labels = corpus(60)
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    d = docs(spark, texts).selectExpr("*", "1 as p", "'x' as row", "2 as _text", "3 as p_toxic", "text as cells", "4 as `a.b`")
    out = toxicity.drop_toxic(d, table)
    assert out.columns == d.columns and {(r.p, r.row, r["_text"], r.p_toxic) for r in out.collect()} == {(1, "x", 2, 3)}


def test_earlier_probabilities_matter():
    c = toxicity.Linear(np.array([4]), np.array([1.0]), np.array([3.0]), -1.0)
    row, feature, before = np.array([0, 1]), np.array([4, 5]), np.array([[0.0], [0.9]])
    assert np.allclose(c.probabilities(2, row, feature, before), 1 / (1 + np.exp(-np.array([0.0, 1.7]))))
