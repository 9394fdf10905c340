import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from custodia.llm import merkle, registry


def h(*xs):
    return hashlib.sha256("".join(xs).encode()).hexdigest()


def leaf(row, more=0):
    out = []
    for c in merkle.FIELDS:
        v = row[c]
        v = v + more if c == "n_chars" and v is not None else v
        out.append("-" if v is None else f"{len(str(v).encode())}:{v}")
    return h(*out)


def climb(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


def proof(levels, i):
    out = []
    for level in levels[:-1]:
        j = i ^ 1
        out.append((level[j] if j < len(level) else "", i & 1))
        i >>= 1
    return out


def brute(rows):
    """Rows of the query, from the definition."""
    trees = {}
    for r in rows:
        trees.setdefault((r["lang"] is not None, (r["lang"] or "").encode()), []).append(r)
    order = sorted(trees)
    built = {}
    for k in order:
        trees[k].sort(key=lambda r: ((r["doc_id"] is not None, r["doc_id"] or 0), leaf(r)))
        built[k] = climb([leaf(r) for r in trees[k]])
    top = climb([built[k][-1][0] for k in order])
    out = []
    for n, k in enumerate(order):
        for i, r in enumerate(trees[k]):
            path = proof(built[k], i) + proof(top, n)
            odd = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0
            at = leaf(r, 1 if odd else 0)
            for s, left in path:
                at = h(at) if not s else h(s, at) if left else h(at, s)
            out.append((str(r["doc_id"]), leaf(r), built[k][-1][0], top[-1][0], h(*(s for s, _ in path)), at, at == top[-1][0]))
    return sorted(out)


def rows_of(df, tmp_path):
    df.write.parquet(f"{tmp_path}/documents.parquet")
    return sorted((str(r[0]), *r[1:]) for r in registry.op11_merkle(df.sparkSession, str(tmp_path)).collect())


DOCS = "doc_id long, text string, lang string, source string, n_chars long, node string, place int, path int, tree string, n int"


@pytest.mark.parametrize("steps", [1, 2, 8])
def test_manifest_matches_brute_force(spark, tmp_path, monkeypatch, steps):
    monkeypatch.setattr(merkle, "STEPS", steps)
    langs = ["en"] * 20 + ["é", "", None, "a:b", "zz"]
    rows = [(i, f"tëxt {i}" if i % 9 else None, langs[i % len(langs)], None if i % 4 == 0 else "s", None if i % 5 == 0 else i, "x", 1, 2, "t", 3) for i in range(333)]
    rows += [(5, "tëxt 5", "en", "s", 1, "x", 1, 2, "t", 3), (5, "other", "en", "s", 1, "x", 1, 2, "t", 3), (7, "a" * 200000, "en", "s", 2**63 - 1, "", 0, 0, "", 0)]
    rows += [rows[3], (None, "no id", "en", None, 4, "", 0, 0, "", 0), (None, None, None, None, None, None, None, None, None, None)]
    docs = spark.createDataFrame(rows, DOCS)
    want = brute([r.asDict() for r in docs.collect()])
    assert rows_of(docs, tmp_path) == want
    assert 0 < sum(w[-1] for w in want) < len(want)


def test_one_leaf_and_no_leaves(spark, tmp_path):
    one = spark.createDataFrame([(4, "a", None, "s", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    got = rows_of(one, tmp_path / "a")
    assert got == brute([r.asDict() for r in one.collect()]) and got[0][1] == got[0][2] == got[0][3]
    assert rows_of(one.limit(0), tmp_path / "b") == []


def test_changed_text_breaks_the_root(spark):
    docs = spark.createDataFrame([(i, f"t{i}", "en", "s", i) for i in range(600)], "doc_id long, text string, lang string, source string, n_chars long")
    a = merkle.manifest(docs).select("root").distinct().collect()
    b = merkle.manifest(docs.withColumn("text", F.when(F.col("doc_id") == 311, "other").otherwise(F.col("text")))).select("root").distinct().collect()
    assert len(a) == len(b) == 1 and a != b
