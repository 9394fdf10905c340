"""Toxicity by a classifier chain.

Categories are predicted one after the other; each later linear model also sees the probabilities of the earlier
categories. It is trained with out-of-fold ones, predicted by models that did not see the document, so it learns to trust
them as far as they deserve. Scoring uses each category's model of the whole sample.

The models are L1-regularised logistic regressions, fitted to convergence on a bounded sample of the labelled documents:
the ``max_train`` smallest hashes of doc_id. A document's features are the words that it holds and their beginnings of 4
to 7 characters, each once more if it occurs again; they are hashed to ``2**BITS`` cells, and cells of fewer than ``min_df``
sampled documents are left out. The models of one category (one for the whole sample, one for each fold) are fitted
side by side, each in a task of its own. Every document is then scored over its whole text.

Defined results: a null text has no words; rows that repeat a doc_id are scored each; a null doc_id is kept. Labels with a
null in any category do not count; of labels, or documents, that repeat a doc_id the smallest row counts (by category,
by text). Without labels of both kinds a category's probability is the share of its positive labels, or 0; an empty
table gives no rows. Other columns are not read, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BYTE_CODE, LOWER, freed, materialise, mix, named, pack, parts, prefix_hash, ship, text_or_empty, unpack, utf8

MAX_TRAIN, MIN_DF, FOLDS = 20_000, 8, 3
STRENGTH, THRESHOLD = 5e-4, 0.5
#: Entries that a fit looks at at once.
CHUNK = 1 << 20
#: Cells that features are hashed to, and the lengths of the beginnings of words.
BITS, BEGINNINGS = 24, (4, 5, 6, 7)
#: A fit ends when the conditions of the minimum hold up to this share of the penalty, or after so many rounds of so many
#: steps; steps start so many times longer than the bound of curvature is sure to allow.
TOLERANCE, ROUNDS, STEPS, STRETCH = 0.05, 50, 200, 16.0

_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), 95, *range(97, 123), *range(128, 256)]] = True
_SALTS = mix(np.arange(16, dtype=np.uint64) + np.uint64(0xC2B2AE3D27D4EB4F))


def features(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, cell) of every word of the rows and of its beginnings, as often as they occur.

    A-Z and the Latin capitals of two bytes count as small; words are runs of letters, digits and ``_`` outside the
    punctuation of ASCII, Latin-1 and U+2000 to U+207F."""
    low = LOWER[raw]
    inside = np.append(_WORD[raw], False)
    capital = np.flatnonzero(raw[:-1] == 0xC3) + 1
    capital = capital[(raw[capital] >= 0x80) & (raw[capital] <= 0x9E) & (raw[capital] != 0x97)]
    low[capital] += 0x20
    sign = np.flatnonzero(raw == 0xC2)
    inside[sign] = inside[sign + 1] = False
    sign = np.flatnonzero((raw[:-1] == 0xE2) & (raw[1:] >> 1 == 0x40))
    inside[sign] = inside[sign + 1] = inside[np.minimum(sign + 2, len(raw))] = False
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edge = offs[:-1][offs[:-1] < len(raw)]
    begins[edge] = inside[edge]  # a word never crosses rows
    start = np.flatnonzero(begins)
    outside = np.flatnonzero(~inside)
    end = outside[np.searchsorted(outside, start)]
    row = np.searchsorted(offs, start, side="right") - 1
    end = np.minimum(end, offs[row + 1])
    sums, inverse = prefix_hash(BYTE_CODE[low])
    first = (raw & 0xC0) != 0x80  # of a character
    number, at = np.cumsum(first) - 1, np.append(np.flatnonzero(first), [len(raw)] * (max(BEGINNINGS) + 1))
    rows, cells = [], []
    for k in (0, *BEGINNINGS):
        stop, some = end, slice(None)
        if k:
            stop = at[number[start] + k]
            some = stop < end
        s, e = start[some], stop[some]
        code = (sums[e] - sums[s]) * inverse[s] + (e - s).astype(np.uint64) + _SALTS[k]
        rows.append(row[some])
        cells.append((mix(code) >> np.uint64(64 - BITS)).astype(np.int64))
    return np.concatenate(rows), np.concatenate(cells)


def presence(row: np.ndarray, cell: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) without repeats, by row: a cell, and 2**BITS + cell where it occurs again."""
    key, n = np.unique(row << BITS | cell, return_counts=True)
    again = key[n > 1]
    both = np.concatenate((key & (1 << BITS) - 1, (again & (1 << BITS) - 1) + (1 << BITS)))
    of = np.concatenate((key >> BITS, again >> BITS))
    order = np.argsort(of, kind="stable")
    return of[order], both[order]


@dataclass
class Linear:
    """Weights of features, by feature; weights of the earlier categories' probabilities; the bias."""

    feature: np.ndarray
    weight: np.ndarray
    earlier: np.ndarray
    bias: float

    def probabilities(self, n_rows: int, row: np.ndarray, feature: np.ndarray, earlier: np.ndarray) -> np.ndarray:
        z = np.full(n_rows, self.bias) + earlier @ self.earlier
        if len(self.feature):
            at = np.minimum(np.searchsorted(self.feature, feature), len(self.feature) - 1)
            hit = self.feature[at] == feature
            z += np.bincount(row[hit], weights=self.weight[at[hit]], minlength=n_rows)
        return sigmoid(z)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def log_loss(z: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, z) - y * z))


def shrink(x: np.ndarray, by: np.ndarray) -> np.ndarray:
    return np.sign(x) * np.maximum(np.abs(x) - by, 0)


def fit_linear(row: np.ndarray, feature: np.ndarray, earlier: np.ndarray, y: np.ndarray, strength: float = STRENGTH, min_df: int = MIN_DF) -> Linear:
    """The minimum of the mean log loss plus ``strength`` times the sum of absolute weights; the bias is free.

    Accelerated proximal steps on a working set of features, which grows until the conditions of the minimum hold for
    all; a coordinate's step follows from a bound of its curvature, the sum over rows of x_if (sum over g of x_ig) / 4n."""
    n, k = len(y), earlier.shape[1]
    none = np.zeros(0)
    if not n or y.min() == y.max():
        return Linear(none.astype(np.int64), none, np.zeros(k), 60.0 if n and y[0] else -60.0)
    known = np.sort(feature)
    first = np.append(np.flatnonzero(np.diff(known, prepend=known[:1] - 1)), len(known))
    names = known[first[:-1][np.diff(first) >= min_df]]
    m = len(names)
    del known, first
    rows, columns, part, at, keep = [], [], None, None, None
    for a in range(0, len(feature), CHUNK):
        part = feature[a : a + CHUNK]
        at = np.searchsorted(names, part)
        keep = np.append(names, -1)[at] == part
        rows.append(row[a : a + CHUNK][keep])
        columns.append(at[keep].astype(np.int32))
    del feature, part, at, keep
    row = np.concatenate([np.zeros(0, np.int32), *rows])
    del rows
    column = np.concatenate([np.zeros(0, np.int32), *columns])
    del columns
    chunks = [slice(a, a + CHUNK) for a in range(0, len(row), CHUNK)]
    penalty = np.append(np.full(k, strength), 0.0)
    block = np.column_stack((earlier, np.ones(n)))
    w, dense = np.zeros(m), np.append(np.zeros(k), np.log(y.mean() / (1 - y.mean())))
    active, slack, left = np.zeros(m, bool), 1.0, np.inf
    for _ in range(ROUNDS):
        z = block @ dense
        for part in chunks:
            z += np.bincount(row[part], weights=w[column[part]], minlength=n)
        off, gradient = sigmoid(z) - y, np.zeros(m)
        for part in chunks:
            gradient += np.bincount(column[part], weights=off[row[part]], minlength=m)
        gradient = np.abs(gradient / n)
        excess = np.where(active, 0, gradient - strength * (1 + TOLERANCE))
        new = np.flatnonzero(excess > 0)
        if not len(new) and max(slack, left) <= TOLERANCE:
            break
        slack = max(TOLERANCE, min(slack / 2, excess.max(initial=0) / strength))
        active[new[np.argsort(-excess[new], kind="stable")[: max(60, int(active.sum()))]]] = True
        some = active[column]
        r, c, chosen = row[some], (np.cumsum(active) - 1)[column[some]], np.flatnonzero(active)
        reach = np.bincount(r, minlength=n) + np.abs(block).sum(1)
        step_w = 4 * n / np.bincount(c, weights=reach[r], minlength=len(chosen))
        step_d = 4 * n / np.maximum(block.T @ reach, 1e-12)
        slope = lambda v, u: np.bincount(r, weights=v[c], minlength=n) + block @ u
        x, d, z = w[chosen], dense, slope(w[chosen], dense)
        vx, vd, vz, t, scale = x, d, z, 1.0, STRETCH
        for _ in range(STEPS):
            g = (sigmoid(vz) - y) / n
            gx, gd, loss = np.bincount(c, weights=g[r], minlength=len(chosen)), block.T @ g, log_loss(vz, y)
            while True:  # as long as the bound of curvature, relaxed by ``scale``, holds for this step
                sx, sd = scale * step_w, scale * step_d
                x1, d1 = shrink(vx - sx * gx, sx * strength), shrink(vd - sd * gd, sd * penalty)
                z1, ux, ud = slope(x1, d1), x1 - vx, d1 - vd
                if scale <= 1 or log_loss(z1, y) <= loss + gx @ ux + gd @ ud + (ux @ (ux / sx) + ud @ (ud / sd)) / 2 + 1e-12:
                    break
                scale = max(1.0, scale / 2)
            left = max(np.abs(ux / sx).max(initial=0), np.abs(ud / sd).max()) / strength
            if (ux / sx) @ (x1 - x) + (ud / sd) @ (d1 - d) < 0:  # the momentum points uphill: start it anew
                t = 1.0
            t1 = (1 + np.sqrt(1 + 4 * t * t)) / 2
            more = (t - 1) / t1
            vx, vd, vz = x1 + more * (x1 - x), d1 + more * (d1 - d), z1 + more * (z1 - z)
            x, d, z, t, scale = x1, d1, z1, t1, 1.05 * scale
            if left <= slack:
                break
        w, dense = np.zeros(m), d
        w[chosen] = x
        active &= (w != 0) | (gradient > 0.9 * strength)  # what came in and is not needed goes
    on = np.flatnonzero(w)
    return Linear(names[on], w[on], dense[:k], float(dense[k]))


def sample(docs: DataFrame, labels: DataFrame, categories: dict[str, Column], max_train: int, folds: int) -> DataFrame:
    """(_id, y0, y1, ..., fold, cells: packed features) of at most ``max_train`` labelled documents."""
    names = [f"y{i}" for i in range(len(categories))]
    known = labels.select(F.col("doc_id").cast("long").alias("_id"), F.struct(*(c.cast("double").alias(y) for c, y in zip(categories.values(), names))).alias("y"))
    known = known.where(F.col("_id").isNotNull()).where(" and ".join(f"y.{y} is not null" for y in names)).groupBy("_id").agg(F.min("y").alias("y"))
    known = known.orderBy(F.xxhash64("_id"), "_id").limit(max_train).select("_id", "y.*")
    texts = docs.select(F.col("doc_id").cast("long").alias("_id"), text_or_empty().alias("text"))
    rows = texts.join(F.broadcast(known), "_id").groupBy("_id", *names).agg(F.min("text").alias("text"))  # max_train narrow rows

    def code(batches):
        for b in (part for whole in batches for part in parts(whole, 1 << 20)):
            row, feature = presence(*features(*utf8(b.column("text"))))
            cuts = np.searchsorted(row, np.arange(b.num_rows + 1))
            cells = [pack(np.diff(np.sort(feature[i:j]), prepend=0).astype(np.uint32)) for i, j in zip(cuts, cuts[1:])]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("_id", *names)), pa.array(cells, pa.binary())], names=["_id", *names, "cells"])
        row = feature = cells = None
        freed()

    done = rows.mapInArrow(code, f"_id long, {', '.join(f'{y} double' for y in names)}, cells binary")
    return materialise(done.withColumn("fold", F.pmod(F.xxhash64("_id", F.lit(7)), F.lit(folds)).cast("int")), "labelled")


def _stack(table: pa.Table | pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) of packed features."""
    cells = table["cells"]
    # twice unpacked, so that nothing but the result is held
    upto = np.cumsum([0, *(len(unpack(c.as_py())[0]) for c in cells)])
    feature = np.empty(upto[-1], np.int32)
    for i, c in enumerate(cells):
        np.cumsum(unpack(c.as_py())[0], dtype=np.int32, out=feature[upto[i] : upto[i + 1]])
    return np.repeat(np.arange(len(cells), dtype=np.int32), np.diff(upto)), feature


def _out_of_fold(table, before: list[dict[int, Linear]]) -> np.ndarray:
    """Probabilities of the categories fitted so far, each by the model that did not see the row's fold."""
    row, feature = _stack(table)
    fold, n = np.asarray(table["fold"]), table.num_rows
    p = np.zeros((n, len(before)))
    for j, models in enumerate(before):
        for f in np.unique(fold).tolist():
            mine = fold == f
            p[mine, j] = models[f].probabilities(n, row, feature, p[:, :j])[mine]
    return p


def fit(docs: DataFrame, labels: DataFrame, categories: dict[str, Column], max_train: int = MAX_TRAIN, min_df: int = MIN_DF, folds: int = FOLDS, strength: float = STRENGTH) -> list[Linear]:
    """The chain's models. ``categories``: name -> 0/1 condition on the columns of ``labels``, in the order of the chain."""
    rows, chain, before = sample(docs, labels, categories, max_train, folds), [], []
    for j in range(len(categories)):
        held, last = list(before), j + 1 == len(categories)

        def train(key, group):
            import pickle

            group = group.sort_by("_id")
            earlier, y = _out_of_fold(group, held), group[f"y{j}"].to_numpy()
            entries = list(_stack(group))
            # handed over, so that the fit can let them go
            model = freed(fit_linear(entries.pop(0), entries.pop(0), earlier, y, strength, min_df))
            return pa.table({"model": pa.array([key[0].as_py()], pa.int32()), "body": pa.array([pickle.dumps(model)], pa.binary())})

        # model -1 sees every row, model f all but those of fold f
        models = F.array(F.lit(-1)) if last else F.array(F.lit(-1), *(F.when(F.col("fold") != f, F.lit(f)) for f in range(folds)))
        given = rows.select("*", F.explode(F.array_compact(models)).alias("model"))
        fitted = {r["model"]: r["body"] for r in given.groupBy("model").applyInArrow(train, "model int, body binary").collect()}  # folds + 1 rows
        constant = fit_linear(np.zeros(0, int), np.zeros(0, int), np.zeros((0, j)), np.zeros(0))
        got = {m: _load(fitted[m]) if m in fitted else constant for m in range(-1, folds)}
        chain.append(got[-1])
        before.append(got)
    return chain


def _load(body: bytes) -> Linear:
    import pickle

    return pickle.loads(body)


def score(docs: DataFrame, chain: list[Linear], names: list[str]) -> DataFrame:
    """(row, p): each row as a struct of its columns, and a struct of the categories' probabilities."""
    ship(docs.sparkSession)
    cells = np.unique(np.concatenate([m.feature for m in chain])) & (1 << BITS) - 1
    held = docs.sparkSession.sparkContext.broadcast((chain, cells))  # features of the bounded sample that a model uses
    kinds = T.StructType([T.StructField(k, T.DoubleType()) for k in names])

    def run(batches):
        chain, cells = held.value
        used = np.zeros(1 << BITS, bool)
        used[cells] = True
        for b in (part for whole in batches for part in parts(whole, 1 << 20)):
            row, cell = features(*utf8(b.column("text")))
            some = used[cell]
            row, feature = presence(row[some], cell[some])
            p = np.zeros((b.num_rows, len(chain)))
            for j, model in enumerate(chain):
                p[:, j] = model.probabilities(b.num_rows, row, feature, p[:, :j])
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.StructArray.from_arrays([pa.array(c) for c in p.T], names)], names=["row", "p"])
        row = cell = feature = used = None
        freed()

    given = docs.select(F.struct(*(named(c) for c in docs.columns)).alias("row"), text_or_empty().alias("text"))
    return given.mapInArrow(run, T.StructType([given.schema["row"], T.StructField("p", kinds)]))


def categories_of(labels: DataFrame) -> dict[str, Column]:
    """The categories that the labels table annotates: low quality, then toxic."""
    return {"low_quality": 1 - F.col("quality"), "toxic": F.col("toxic")}


def judge(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """doc_id, p_low_quality, p_toxic, toxic for every row."""
    kinds = categories_of(labels)
    scored = score(docs.select("doc_id", "text"), fit(docs, labels, kinds, **options), list(kinds))
    return scored.select(F.col("row.doc_id").cast("long").alias("doc_id"), *(F.col(f"p.{k}").alias(f"p_{k}") for k in kinds), (F.col("p.toxic") >= threshold).alias("toxic"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """The documents that are not toxic, with all their columns."""
    kinds = categories_of(labels)
    return score(docs, fit(docs, labels, kinds, **options), list(kinds)).where(F.col("p.toxic") < threshold).select("row.*")
