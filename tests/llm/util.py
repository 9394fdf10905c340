"""Small tables and brute force for the operators' tests."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = DOCS + ", block string, hash int, key string, words array<int>, shard double, _h int"


def docs(spark, texts, ids=None, odd=False):
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, "en", "s", None if t is None else len(t)) + (("x", 1, "k", [1], 2.0, 3) if odd else ()) for i, t in zip(ids, texts)]
    return spark.createDataFrame(rows, ODD if odd else DOCS)


def noisy(seed=7, n=60, vocabulary=40, longest=400):
    """Texts with shared passages, near and exact copies, odd spaces and odd characters."""
    r = random.Random(seed)
    vocab = [f"{r.choice(['wör', 'la', 'Ta', 'x', '日本', '😀'])}{i}" for i in range(vocabulary)]
    make = lambda k: " ".join(r.choice(vocab) for _ in range(k))
    passage, texts = make(90), []
    for i in range(n):
        kind = i % 6
        if kind == 0 or not texts:
            texts.append(make(r.randint(0, longest)))
        elif kind == 1:
            texts.append(r.choice(texts))
        elif kind == 2:
            w = (r.choice(texts) or "a").split(" ")
            w[r.randrange(len(w))] = "edited"
            texts.append(" ".join(w))
        elif kind == 3:
            texts.append(make(r.randint(0, 60)) + "\n" + passage + "\t\t" + make(r.randint(0, 60)))
        elif kind == 4:
            texts.append(make(r.randint(0, 8)).replace(" ", r.choice(["  ", "\n", " \x0b"])))
        else:
            texts.append(passage[: r.randint(0, len(passage))])
    return texts + ["", None, " ", "a" * 3000, "ab " * 900]
