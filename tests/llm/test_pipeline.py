import re

import corpus_pipeline as pipeline
from custodia.llm import packing, secrets, toxicity
from custodia.llm.common import materialise, table

from ..conftest import SF
from .test_exact_and_secrets import brute
from .test_jaccard import brute_classes, brute_sets
from .test_tokens import _plain


def test_stages_match_brute_force(spark):
    docs = table(spark, SF, "documents")
    seen = [docs]
    for name, stage in pipeline.STAGES[:-1]:
        docs = materialise(stage(spark, docs, SF), name)
        assert docs.columns == seen[0].columns
        seen.append(docs)
    rows = [{r.doc_id: r for r in d.collect()} for d in seen]
    toxic = {r.doc_id for r in toxicity.judge(seen[0], table(spark, SF, "labels")).where("toxic").collect()}
    assert set(rows[1]) == set(rows[0]) - toxic

    best = {}
    for i, r in rows[1].items():
        key = re.sub(r"[\x20\x09-\x0D]", "", r.text or "")
        best[key] = min(best.get(key, (0, 1 << 62)), (-len(r.text or ""), i))
    assert set(rows[2]) == {i for _, i in best.values()}

    ids = sorted(rows[2])
    classes = brute_classes(brute_sets([rows[2][i].text for i in ids]))
    assert set(rows[3]) == {ids[c] for c in classes}

    for i, r in rows[3].items():
        masked, at = "", 0
        for s, _, _, e in brute(r.text):
            if s > at or at == 0:
                masked += r.text[at:s] + "[SECRET]"
            at = max(at, e)
        assert rows[4][i].text == (masked + r.text[at:] if at else r.text)
        assert rows[4][i].n_chars == len(rows[4][i].text)
    assert len(rows[4]) == len(rows[3])

    packed = pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in packed} == set(rows[4])
    for i, r in rows[4].items():
        n = len(_plain().encode(r.text, add_special_tokens=False).ids) + 1
        assert sum(p.length for p in packed if p.doc_id == i) == n
    held = {}
    for p in packed:
        held[p.sequence_id] = held.get(p.sequence_id, 0) + p.length
    assert max(held.values()) <= packing.LENGTH
    assert secrets.RULES[0].kind == "assign"


def test_pipeline_on_odd_tables(spark, tmp_path):
    """Nulls in every column, empty and repeated rows, clashing columns, then no rows at all."""
    rows = [(1, "a b c d e f", "en", "s", 11), (1, "a b c d e f", "en", "s", 11), (2, None, None, None, None), (None, "token = abcdefgh", None, "s", 1), (3, "", "en", "s", 0), (4, " ", "en", "s", 1), (5, "a b c d e  f", "en", "s", 12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").selectExpr("*", "1 as row", "'k' as key", "2 as cell", "3 as clean")
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (None, 1, 1), (2, None, 0)], "doc_id long, quality int, toxic int")
    for name, d in (("some", docs), ("none", docs.limit(0))):
        d.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        labels.write.parquet(f"{tmp_path}/{name}/labels.parquet")
    kept = table(spark, f"{tmp_path}/some", "documents")
    for name, stage in pipeline.STAGES[:-1]:
        kept = materialise(stage(spark, kept, f"{tmp_path}/some"), f"odd-{name}")
        assert kept.columns == docs.columns
    # null, empty and blank texts are equal; of them the longest stays, and of equally long ones the smallest id
    assert {(str(r.doc_id), r.text, r.row, r.key, r.cell, r.clean) for r in kept.collect()} == {(i, t, 1, "k", 2, 3) for i, t in [("4", " "), ("5", "a b c d e  f"), ("None", "[SECRET]")]}
    assert pipeline.run(spark, f"{tmp_path}/some").count() == kept.count()
    assert pipeline.run(spark, f"{tmp_path}/none").count() == 0
