"""Exact deduplication: group by a 128-bit content hash, compare bytes inside groups, keep one row.

Only DataFrame functions. Texts meet by hash in one aggregation whose key is (hash, text): rows of
one hash come together, and the key's equality compares their bytes, so a collision makes two groups.
Map-side aggregation sends each distinct text of a task once, however many copies it has, and no
group is ever gathered into a row: members find their group again by a join on the digests, of which adaptive execution
splits the members of a huge group (spark.sql.adaptive.skewJoin); without it they are one task's rows.

Defined results: a null text counts as empty and empty texts equal each other; a null doc_id sorts
after every other id; rows that repeat a doc_id with an equal text of equal length are one document,
so ``kept`` is true for each of them while ``group_size`` counts rows. An empty table gives no rows.
Other columns of the input are not read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import named, text_or_empty

#: Deleted before texts are compared.
SPACES = " \t\n\x0b\x0c\r"


def content_hash(text: Column) -> Column:
    """128 bits."""
    return F.unhex(F.md5(text))


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, r"[\x20\x09-\x0D]+", "")


def group_copies(docs: DataFrame, hash_of=content_hash) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row. ``hash_of`` is a parameter so
    that tests can make collisions frequent."""
    norm = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.char_length(text_or_empty()).cast("long").alias("_chars"),
        normalised(text_or_empty()).alias("_norm"),
    )
    # the longest original, then the smallest id, as one comparable value
    rank = F.min(F.struct((-F.col("_chars")).alias("c"), F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("i"), F.col("doc_id")))
    groups = (
        norm.groupBy(hash_of(F.col("_norm")).alias("_h"), "_norm")
        .agg(rank.alias("_first"), F.count("*").alias("group_size"))
        .select("_h", F.sha2("_norm", 256).alias("_sha"), F.col("_first.doc_id").alias("keep_id"), F.col("_first.c").alias("_c"), "group_size")
    )
    members = norm.select("doc_id", "_chars", hash_of(F.col("_norm")).alias("_h"), F.sha2("_norm", 256).alias("text_sha256"))
    return members.join(groups, (members["_h"] == groups["_h"]) & (members["text_sha256"] == groups["_sha"])).select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("_chars") == -F.col("_c"))).alias("kept"),
        "text_sha256",
    )


def drop_copies(docs: DataFrame, hash_of=content_hash) -> DataFrame:
    """The rows that stay, with all their columns; one for each distinct text, even where rows repeat. Of rows that also repeat an id the
    least by text and by the other columns (as JSON) stays."""
    norm = docs.select(F.struct(*(named(c) for c in docs.columns)).alias("_row"), normalised(text_or_empty()).alias("_norm"))
    text = F.coalesce(F.col("_row.text").cast("string"), F.lit(""))
    others = [named("_row", c).alias(f"c{i}") for i, c in enumerate(docs.columns) if c not in ("doc_id", "text")]
    rest = F.to_json(F.struct(*others)) if others else F.lit("")
    # rows that repeat an id are told apart by all that they hold, so that the same one stays whenever this runs
    rank = F.struct((-F.char_length(text)).alias("c"), F.col("_row.doc_id").isNull().alias("n"), F.col("_row.doc_id").alias("i"), text.alias("t"), rest.alias("r"))
    return norm.groupBy(hash_of(F.col("_norm")).alias("_h"), "_norm").agg(F.min_by("_row", rank).alias("_row")).select("_row.*")
