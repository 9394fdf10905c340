"""Queries of the subpackage, and SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import exact_dedup, jaccard_join, merkle, packing, pii, runs, secrets, sentencepiece, sharding, substring_dedup, suffix_dedup, toxicity, vp_search
from .common import table


def _span_text(spans, where=None):
    """kind:start:end of the spans, comma-joined."""
    chosen = F.filter(spans, where) if where else spans
    return F.concat_ws(",", F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))
    spans = F.col("spans")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *map(count, pii.KINDS),
        F.sha2(_span_text(spans, lambda s: s["kind"].isin(*pii.KINDS)), 256).alias("base_sha256"),
        _span_text(spans).alias("spans"),
    )


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"))
    base = [r.kind for r in secrets.BASE_RULES]

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    spans = F.col("spans")
    return found.select(
        "doc_id",
        *map(count, base),
        F.sha2(_span_text(spans, lambda s: s["kind"].isin(base)), 256).alias("base_sha256"),
        _span_text(spans).alias("spans"),
    )


def op3_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vp_search.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), keep_ids=False)
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = sentencepiece.encode(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))
    return encoded.withColumn("ids_crc32", sentencepiece.checksum("ids")).drop("ids")


def op7_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(suffix_dedup.mark_repeats(table(spark, sf_dir, "documents")))


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.classify(table(spark, sf_dir, "documents"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.group_copies(table(spark, sf_dir, "documents"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digest(substring_dedup.mark_repeats(table(spark, sf_dir, "documents")))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = merkle.manifest(table(spark, sf_dir, "documents")).withColumn("folded_root", merkle.fold(F.col("trial"), F.col("path")))
    proof = F.sha2(F.array_join("path.s", ""), 256).alias("proof_sha256")
    return found.select("doc_id", "leaf", "subroot", "root", proof, "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.digest(runs.find_runs(table(spark, sf_dir, "documents"), runs.looped))


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.place(table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": op1_pii,
    "op2_secrets": op2_secrets,
    "op3_ann": op3_ann,
    "op4_packing": op4_packing,
    "op5_toxicity": op5_toxicity,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_suffix_array": op7_suffix_array,
    "op8_ngram_jaccard": op8_ngram_jaccard,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_merkle": op11_merkle,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_sharding": op13_sharding,
}

_RULES = ", ".join(
    "('{}', {}, '{}', {}, {}, {})".format(r.kind, i, r.pattern.replace("'", "''"), r.group, r.at_least, r in secrets.BASE_RULES) for i, r in enumerate(secrets.RULES)
)

ORACLE_SQL: dict[str, str] = {
    "op2_secrets": r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
r(kind, rank, pattern, grp, least, base) AS (VALUES {RULES}),
m AS (
  SELECT doc_id, kind, rank, least, base,
    unnest(string_split_regex(t, pattern)[1:len(regexp_extract_all(t, pattern))]) AS gap,
    unnest(regexp_extract_all(t, pattern)) AS found,
    unnest(CASE grp WHEN 2 THEN regexp_extract_all(t, pattern, 2) ELSE regexp_extract_all(t, pattern) END) AS counted,
    unnest(range(len(regexp_extract_all(t, pattern)))) AS n
  FROM d, r WHERE regexp_matches(t, pattern)),
p AS (SELECT *, sum(length(gap) + length(found)) OVER (PARTITION BY doc_id, kind ORDER BY n)::BIGINT AS e FROM m),
s AS (SELECT doc_id, kind, rank, base, e - length(found) AS b, e FROM p WHERE length(counted) >= least),
g AS (SELECT doc_id, count(*) FILTER (WHERE kind = 'assign') AS a, count(*) FILTER (WHERE kind = 'access') AS c, count(*) FILTER (WHERE kind = 'hex') AS h,
  string_agg(kind || ':' || b || ':' || e, ',' ORDER BY b, rank) FILTER (WHERE base) AS bs, string_agg(kind || ':' || b || ':' || e, ',' ORDER BY b, rank) AS sp FROM s GROUP BY doc_id)
SELECT d.doc_id, coalesce(a, 0) AS n_assign, coalesce(c, 0) AS n_access, coalesce(h, 0) AS n_hex, sha256(coalesce(bs, '')) AS base_sha256, coalesce(sp, '') AS spans
FROM d LEFT JOIN g USING (doc_id)""".replace("{RULES}", _RULES),
    "op8_ngram_jaccard": r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')] ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN n a ON x = a.doc_id JOIN n b ON y = b.doc_id WHERE 100 * common >= 80 * (a.n + b.n - common)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
c AS (SELECT DISTINCT x AS doc_id, x AS seen FROM e UNION SELECT c.doc_id, e.y FROM c JOIN e ON c.seen = e.x)
SELECT w.doc_id, coalesce(n, 0) AS n_shingles, least(w.doc_id, coalesce(m, w.doc_id)) AS component_id
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT doc_id, min(seen) AS m FROM c GROUP BY doc_id) USING (doc_id)""",
    "op10_substring_dedup": r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
h AS (SELECT doc_id, unnest(range(1, len(ws) - 48)) AS i, unnest(list_transform(range(1, len(ws) - 48), lambda i: md5(array_to_string(ws[i:i + 49], ' ')))) AS h FROM w WHERE len(ws) >= 50),
f AS (SELECT doc_id, i FROM (SELECT *, min(doc_id) OVER (PARTITION BY h) AS first FROM h) WHERE doc_id > first),
g AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS k FROM f),
o AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS k FROM w),
r AS (SELECT doc_id, count(*) AS n_words, count(*) FILTER (WHERE g.k IS NOT NULL) AS n_removed, string_agg(word, ' ' ORDER BY o.k) FILTER (WHERE g.k IS NULL) AS kept FROM o LEFT JOIN g USING (doc_id, k) GROUP BY doc_id)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM w LEFT JOIN r USING (doc_id)""",
    "op11_merkle": r"""
WITH RECURSIVE b AS (SELECT list(c ORDER BY i) AS tab FROM (SELECT i, list_reduce(list_prepend(i, range(8)), lambda a, x: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS c FROM range(256) r(i))),
q AS (SELECT *, coalesce(xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)), lambda a, x: xor(a >> 8, tab[(xor(a, x) & 255) + 1])), 4294967295) % 7 = 0, false) AS odd FROM documents, b),
d AS (SELECT doc_id, coalesce('1' || lang, '0') AS k, sha256(concat(coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'), coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-'), coalesce(strlen(text) || ':' || text, '-'))) AS leaf,
  CASE WHEN odd THEN sha256(concat(coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'), coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen((n_chars::HUGEINT + 1)::VARCHAR) || ':' || (n_chars::HUGEINT + 1), '-'), coalesce(strlen(text) || ':' || text, '-'))) END AS trial FROM q),
r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p, count(*) OVER (PARTITION BY k) AS n FROM d),
t AS (SELECT k, 0 AS l, p, leaf AS h, n FROM r UNION ALL SELECT k, l + 1, p // 2, sha256(string_agg(h, '' ORDER BY p)), (n + 1) // 2 FROM t WHERE n > 1 GROUP BY k, l, p // 2, n),
s AS (SELECT k, h, row_number() OVER (ORDER BY k) - 1 AS p, count(*) OVER () AS n FROM t WHERE n = 1),
u AS (SELECT 0 AS l, p, h, n FROM s UNION ALL SELECT l + 1, p // 2, sha256(string_agg(h, '' ORDER BY p)), (n + 1) // 2 FROM u WHERE n > 1 GROUP BY l, p // 2, n),
g AS (SELECT DISTINCT k, l FROM t WHERE n > 1),
x AS (SELECT r.k, r.p, g.l, (r.p >> g.l) & 1 = 1 AS f, coalesce(t.h, '') AS s FROM r JOIN g ON g.k = r.k LEFT JOIN t ON t.k = r.k AND t.l = g.l AND t.p = xor(r.p >> g.l, 1::BIGINT)
  UNION ALL SELECT r.k, r.p, 1000 + e.l, (s.p >> e.l) & 1 = 1, coalesce(u.h, '') FROM r JOIN s ON s.k = r.k JOIN (SELECT DISTINCT l FROM u WHERE n > 1) e ON true LEFT JOIN u ON u.l = e.l AND u.p = xor(s.p >> e.l, 1::BIGINT)),
y AS (SELECT k, p, list({s: s, f: f} ORDER BY l) AS path, string_agg(s, '' ORDER BY l) AS proof FROM x GROUP BY k, p),
z AS (SELECT r.doc_id, r.leaf, s.h AS subroot, (SELECT h FROM u WHERE n = 1) AS root, sha256(coalesce(proof, '')) AS proof_sha256,
  list_reduce(list_prepend({s: coalesce(trial, leaf), f: false}, coalesce(path, [])), lambda a, x: {s: CASE WHEN x.s = '' THEN sha256(a.s) WHEN x.f THEN sha256(x.s || a.s) ELSE sha256(a.s || x.s) END, f: false}).s AS folded_root
  FROM r JOIN s ON s.k = r.k LEFT JOIN y ON y.k = r.k AND y.p = r.p)
SELECT *, folded_root = root AS verified FROM z""",
    "op3_ann": """
WITH v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
d AS (
  SELECT q.vec_id AS query_id, c.vec_id, sqrt(list_reduce(list_transform(list_zip(q.e, c.e), lambda p: (p[1] - p[2]) * (p[1] - p[2])), lambda a, b: a + b)) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS rank FROM d)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 10""",
    "op9_exact_dedup": r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS norm
  FROM documents),
r AS (
  SELECT doc_id, norm, chars,
         first_value(doc_id) OVER w AS keep_id,
         count(*) OVER (PARTITION BY norm) AS group_size
  FROM n WINDOW w AS (PARTITION BY norm ORDER BY chars DESC, doc_id NULLS LAST))
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256
FROM r""",
}
