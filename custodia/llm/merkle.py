"""Merkle manifest of a data set: one tree of digests for each language, and one over their roots.

Leaves are numbered by language and id (by ranges, so a hot language is several of them). Aligned blocks of 2**STEPS nodes keep each of
their levels as one string of hexadecimal digits: SQL substrings of two digests hash into the parents, and the substring beside a node
is its sibling. A block's last digest is one node of the next tier, which is built alike until a language has one node; the roots
of the languages are leaves of the last tree. Paths go down again tier by tier, joined on (language, block), so no
join has a hot key and nothing is gathered but 2**STEPS digests.

Defined results: nulls are leaves' ``-``; rows without a language are a language of their own, which comes first; rows without an id come
first within a language and are never tampered with; rows that repeat an id are ordered by their leaf, and of equal rows each has a
place of its own; an empty table has no rows. Other columns are not read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import running
from .common import materialise

#: Levels of a block; it holds 2**STEPS nodes.
STEPS = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*inputs: Column) -> Column:
    return F.sha2(F.concat(*inputs), 256)


def leaf(*values: Column) -> Column:
    """H of the values: ``-`` for a null, else UTF-8 bytes, ``:``, value."""
    texts = [v.cast("string") for v in values]
    return digest(*(F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts))


def tampered(doc_id: Column) -> Column:
    """Rows of which one in seven is changed for the trial."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 0, F.lit(False))


def manifest(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, path (the siblings ``s`` from the leaf to the root, '' where there is none, and whether they
    are on the ``left``) and trial (the leaf as it is after tampering)."""
    values = {c: F.col(c) for c in FIELDS}
    more = values | {"n_chars": F.col("n_chars").cast("decimal(38,0)") + 1}
    rows = docs.select(
        F.coalesce(F.concat(F.lit("1"), F.col("lang").cast("string")), F.lit("0")).alias("tree"),
        "doc_id",
        leaf(*values.values()).alias("node"),
        F.when(tampered(F.col("doc_id")), leaf(*more.values())).alias("trial"),
    )
    rows = materialise(rows, "merkle-leaves")
    placed = running(rows, ["tree"], [F.col("doc_id"), F.col("node")], "place", total="n")
    forest = _climb(placed.withColumn("place", F.col("place") - 1), ["doc_id", "trial"])
    roots = forest[-1].select("tree", F.element_at("levels", -1).alias("node"))
    placed = running(roots.withColumnRenamed("tree", "name").withColumn("tree", F.lit("")), ["tree"], [F.col("name")], "place", total="n")
    upper = _climb(placed.withColumn("place", F.col("place") - 1), ["name"])
    top = upper[-1].select("tree", "block", F.array().cast("array<struct<s:string,left:boolean>>").alias("path"), F.element_at("levels", -1).alias("root"))
    trees = _descend(upper, top, ["name"], ["root"])
    top = trees.select(F.col("name").alias("tree"), F.lit(0).cast("long").alias("block"), "path", "root", F.col("node").alias("subroot"))
    return _descend(forest, top, ["doc_id", "trial"], ["root", "subroot"]).select("doc_id", F.col("node").alias("leaf"), "subroot", "root", "path", F.coalesce("trial", "node").alias("trial"))


def fold(start: Column, path: Column) -> Column:
    """The root that ``start`` and its siblings give."""
    step = lambda acc, p: F.when(p["s"] == "", digest(acc)).when(p["left"], digest(p["s"], acc)).otherwise(digest(acc, p["s"]))
    return F.aggregate(path, start, step)


def _climb(nodes: DataFrame, extra: list[str]) -> list[DataFrame]:
    """(tree, place from 0, n, node, what else is given) -> tables of blocks, one for each tier: tree, block, n, members, levels."""
    tiers, extra = [], ["node", *extra]
    while True:
        members = F.array_sort(F.collect_list(F.struct("place", *extra)))
        steps = F.when(F.col("n") > 1 << STEPS, STEPS).when(F.col("n") > 1, F.length(F.bin(F.col("n") - 1))).otherwise(0)
        built = (
            nodes.groupBy("tree", F.shiftright("place", STEPS).alias("block"))
            .agg(F.max("n").alias("n"), members.alias("members"))
            .select("tree", "block", "n", F.transform("members", lambda m: F.struct(*(m[c].alias(c) for c in extra))).alias("members"), steps.alias("steps"))
            .withColumn("level", F.array_join("members.node", ""))
        )
        levels = F.expr(
            f"aggregate(slice(sequence(1, {STEPS}), 1, steps), array(level), (built, _) -> concat(built, array(array_join("
            "transform(sequence(0, (length(element_at(built, -1)) - 1) div 128), j -> sha2(substring(element_at(built, -1), CAST(j AS INT) * 128 + 1, 128), 256)), ''))))"
        )
        tiers.append(materialise(built.select("tree", "block", "n", "members", levels.alias("levels")), "merkle-tier"))
        most = tiers[-1].agg(F.max("n")).first()[0] or 0
        if most <= 1 << STEPS:
            return tiers
        above = F.ceil(F.col("n") / (1 << STEPS)).cast("long")
        nodes, extra = tiers[-1].select("tree", F.col("block").alias("place"), above.alias("n"), F.element_at("levels", -1).alias("node")), ["node"]


def _descend(tiers: list[DataFrame], top: DataFrame, extra: list[str], kept: list[str]) -> DataFrame:
    """(tree, block, path, what is kept) of the last tier -> tree, place, node, path, what is kept and what else members hold, of the first."""
    beside = (
        f"transform(slice(sequence(0, {STEPS - 1}), 1, size(levels) - 1), l -> named_struct("
        "'s', substring(levels[l], CAST((shiftright(j, l) ^ 1) * 64 + 1 AS INT), 64), 'left', (shiftright(j, l) & 1) = 1))"
    )
    for i, tier in reversed(list(enumerate(tiers))):
        more = extra if i == 0 else []
        each = F.expr(f"transform(members, (m, j) -> named_struct('place', block * {1 << STEPS} + j, 'path', concat({beside}, path), 'm', m))")
        rows = tier.join(top, ["tree", "block"]).select("tree", *kept, F.explode(each).alias("at"))
        top = rows.select("tree", F.col("at.place").alias("block" if i else "place"), "at.m.node", "at.path", *(F.col(f"at.m.{c}").alias(c) for c in more), *kept)
    return top
