"""Coverage queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.common import table
from ..operators import coverage as op


def a01_site_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    files = docs.select(F.col("source").alias("site"), (F.col("n_chars") * 1000).alias("bytes"), (F.lit(2020) + F.col("doc_id") % 7).alias("year"))
    return op.site_inventory(docs.select(F.col("source").alias("site")).distinct(), files)


QUERIES = {"a01_site_inventory": a01_site_inventory}

ORACLE_SQL = {
    "a01_site_inventory": """
SELECT source AS site, count(*) AS n_items,
       CAST(round_even(CAST(sum(n_chars * 1000) AS DOUBLE) / 1073741824, 3)::DECIMAL(30,3) AS VARCHAR) AS total_gb,
       count(*) FILTER (WHERE 2020 + doc_id % 7 >= 2023) AS n_recent
FROM documents GROUP BY source""",
}
