"""Queries of the integrity, coverage and layout operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import items, keys
from ..functions.common import table
from ..operators import coverage as cov
from ..operators import dedup, integrity, layout, records, split


def _files(spark, d):
    """Line counts that orders expect, one 'file' for each order."""
    return table(spark, d, "orders").select((F.col("o_custkey") % 50).cast("string").alias("site"), F.col("o_orderkey").cast("string").alias("name"), (F.col("o_orderkey") % 7).alias("bytes"))


def _held(spark, d):
    return table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n")).join(table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).select(
        (F.col("o_custkey") % 50).cast("string").alias("site"), F.col("o_orderkey").cast("string").alias("name"), F.col("n").alias("bytes")
    )


_FILES = "f AS (SELECT CAST(o_custkey % 50 AS VARCHAR) AS site, CAST(o_orderkey AS VARCHAR) AS name, o_orderkey % 7 AS bytes FROM orders), h AS (SELECT CAST(o_custkey % 50 AS VARCHAR) AS site, CAST(o_orderkey AS VARCHAR) AS name, count(*) AS bytes FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_orderkey, o_custkey)"
_STATUS = f"WITH {_FILES}, s AS (SELECT coalesce(f.site, h.site) AS site, coalesce(f.name, h.name) AS name, CASE WHEN h.name IS NULL THEN 'missing' WHEN f.name IS NULL THEN 'extra' WHEN f.bytes <> h.bytes THEN 'size_differs' ELSE 'match' END AS status FROM f FULL JOIN h ON f.site = h.site AND f.name = h.name)"


def _events(spark, d):
    """Items of users by day: (site, name, bytes)."""
    return table(spark, d, "events").select(F.col("user_id").cast("string").alias("site"), F.concat(F.date_format("ts", "yyyyMMdd_HHmmss"), F.lit("_"), F.col("event_id").cast("string"), F.lit(".wav")).alias("name"), (F.col("value") * 100).cast("long").alias("bytes"), "event_id", "ts")


_EVENTS = "e AS (SELECT CAST(user_id AS VARCHAR) AS site, strftime(ts, '%Y%m%d_%H%M%S') || '_' || event_id || '.wav' AS name, CAST(trunc(value * 100) AS BIGINT) AS bytes, event_id, ts FROM events)"


def j01(spark, d):
    return integrity.reconcile(_files(spark, d), _held(spark, d))


def j01_summary(spark, d):
    return integrity.reconcile_summary(j01(spark, d))


def _classified(spark, d):
    docs = table(spark, d, "documents")
    both = docs.select(F.col("source").alias("site"), F.col("doc_id").cast("string").alias("name"), F.col("n_chars").alias("bytes"), F.explode(F.array(F.lit("disk"), F.lit("archive"))).alias("side"))
    return both.where("side = 'disk' or bytes % 5 > 0").select("site", "side", "name", "bytes", (F.col("bytes") == 0).alias("is_zero"), ((F.col("bytes") > 0) & (F.col("bytes") < 1024)).alias("is_tiny"), F.when(F.col("bytes") % 11 == 0, "odd").alias("discrepancy"))


_SIDES = "c AS (SELECT source AS site, 'disk' AS side, CAST(doc_id AS VARCHAR) AS name, n_chars AS bytes FROM documents UNION ALL SELECT source, 'archive', CAST(doc_id AS VARCHAR), n_chars FROM documents WHERE n_chars % 5 > 0)"


def _named(where, column="name", n=10):
    """SQL of the first names that a condition holds for, and how many there are if more."""
    names, count = f"list(DISTINCT {column}) FILTER (WHERE {where})", f"count(DISTINCT {column}) FILTER (WHERE {where})"
    return f"coalesce(array_to_string(list_sort({names})[1:{n}], ', ') || CASE WHEN {count} > {n} THEN ', ... (' || {count} || ')' ELSE '' END, '')"


def a02(spark, d):
    return integrity.side_stats(_classified(spark, d))


def a03(spark, d):
    files = _classified(spark, d)
    wrong = integrity.side_stats(files).withColumn("n_tiny", F.when(F.col("site") == "src1", -1).otherwise(F.col("n_tiny")))
    return integrity.self_check(files, wrong)


def a04(spark, d):
    docs = table(spark, d, "documents").select(F.col("source").alias("site"), F.col("doc_id").cast("string").alias("name"), F.col("n_chars").alias("bytes"))
    status = integrity.reconcile(docs, docs.where("bytes % 5 > 0"))
    return integrity.audit_report(integrity.side_stats(_classified(spark, d)), integrity.reconcile_summary(status)).select("site", "disk_items", "archive_items", "disk_tiny", "matches", "notes")


def j02(spark, d):
    e = _events(spark, d)
    manifest = e.select("site", F.when(F.col("event_id") % 97 == 0, "undated.wav").otherwise(F.col("name")).alias("name"), F.when(F.col("event_id") % 2 == 0, F.col("bytes")).alias("bytes"), items.size_kb_text("bytes").alias("kb_text"))
    day = F.concat_ws("_", "site", items.day_key("name"))
    entries = e.where("event_id % 13 <> 0").select("site", day.alias("archive"), "name", F.when(F.col("event_id") % 17 == 0, F.col("bytes") + 100000).otherwise(F.col("bytes")).alias("bytes"))
    archives = e.select("site", day.alias("archive")).distinct().withColumn("recorded", ~F.col("archive").endswith("5"))
    return integrity.manifest_problems(manifest, entries, archives)


_J02 = f"""WITH {_EVENTS}, m AS (
  SELECT site, CASE WHEN event_id % 97 = 0 THEN NULL ELSE site || '_' || strftime(ts, '%Y_%m_%d') END AS archive, CASE WHEN event_id % 97 = 0 THEN 'undated.wav' ELSE name END AS name FROM e),
n AS (SELECT site, site || '_' || strftime(ts, '%Y_%m_%d') AS archive, name, event_id FROM e WHERE event_id % 13 <> 0),
a AS (SELECT DISTINCT site, site || '_' || strftime(ts, '%Y_%m_%d') AS archive FROM e),
r AS (SELECT * FROM a WHERE right(archive, 1) <> '5'),
p AS (SELECT coalesce(m.site, n.site) AS site, coalesce(m.archive, n.archive) AS archive,
  CASE WHEN n.name IS NULL THEN 'missing' WHEN m.name IS NULL THEN 'extra' WHEN n.event_id % 17 = 0 THEN 'size_differs' END AS code
  FROM (SELECT * FROM m WHERE archive IS NOT NULL) m FULL JOIN n ON m.site = n.site AND m.archive = n.archive AND m.name = n.name)
SELECT site, NULL AS archive, 'undatable' AS code, count(*) AS n FROM m WHERE archive IS NULL GROUP BY site
UNION ALL SELECT p.site, p.archive, code, count(*) FROM p JOIN r ON p.site = r.site AND p.archive = r.archive WHERE code IS NOT NULL GROUP BY ALL
UNION ALL SELECT m.site, m.archive, 'archive_absent', count(*) FROM m WHERE archive IS NOT NULL AND right(archive, 1) = '5' GROUP BY ALL
UNION ALL SELECT site, archive, 'archive_unlisted', 1 FROM r WHERE archive NOT IN (SELECT archive FROM m WHERE archive IS NOT NULL)"""


def j04(spark, d):
    docs = table(spark, d, "documents").select(F.col("source").alias("site"), F.col("doc_id").cast("string").alias("name"), F.md5("text").alias("digest"), "doc_id")
    other = docs.where("doc_id % 7 > 0").withColumn("digest", F.when(F.col("doc_id") % 11 == 0, "x").otherwise(F.col("digest")))
    return integrity.digest_problems(docs, other, docs.where("site = 'src3'"))


def j05(spark, d):
    return cov.missing_keys(table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("key")), table(spark, d, "labels").select((F.col("doc_id") + 3).cast("string").alias("key")))


def j09(spark, d):
    sites = table(spark, d, "nation").select(F.col("n_name").alias("site"))
    have = table(spark, d, "nation").where("n_nationkey % 3 > 0").select(F.col("n_name").alias("site"), F.concat("n_name", F.lit("_list.csv")).alias("name"))
    extra = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("n_name").alias("site"), F.col("s_name").alias("name"))
    return cov.expected_missing(sites, ["{site}_list.csv", "README.html"], extra, have)


def j10(policy):
    def run(spark, d):
        c = table(spark, d, "customer")
        left = c.where("c_custkey % 3 > 0").select(F.col("c_custkey").alias("id"), F.concat(F.lit("c"), "c_name").alias("title"), (F.col("c_custkey") % 7 == 0).alias("draft"))
        right = c.where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("id"), F.concat(F.lit("a"), "c_name").alias("title"), (F.col("c_custkey") % 14 == 0).alias("draft"))
        return records.merge_sources(left, right, policy)

    return run


def _j10(policy):
    first = "CASE WHEN c THEN 'c' ELSE 'a' END" if policy == "community" else "CASE WHEN a THEN 'a' ELSE 'c' END"
    own = "CASE WHEN c THEN c_custkey % 7 = 0 ELSE c_custkey % 14 = 0 END" if policy == "community" else "CASE WHEN a THEN c_custkey % 14 = 0 ELSE c_custkey % 7 = 0 END"
    odd = "c AND a AND (c_custkey % 7 = 0) <> (c_custkey % 14 = 0)" if policy == "account" else "false"
    return f"WITH t AS (SELECT *, c_custkey % 3 > 0 AS c, c_custkey % 2 = 0 AS a FROM customer) SELECT c_custkey AS id, {first} || c_name AS title, CASE WHEN NOT ({odd}) THEN {own} END AS draft, CASE WHEN c AND a THEN 'both' WHEN c THEN 'community' ELSE 'account' END AS source, CASE WHEN {odd} THEN 'listings disagree' END AS error FROM t WHERE c OR a"


def _plan(spark, d):
    docs = table(spark, d, "documents").select(F.col("source").alias("site"), F.concat(F.col("doc_id").cast("string"), F.element_at(F.array(*map(F.lit, (".wav", ".csv", ".zip"))), (F.col("doc_id") % 3 + 1).cast("int"))).alias("name"), "doc_id")
    local = docs.where("doc_id % 5 > 0").withColumn("present", F.col("doc_id") % 7 > 0)
    remote = docs.where("doc_id % 4 > 0").withColumn("status", F.when(F.col("doc_id") % 8 == 1, "pending").otherwise("completed"))
    return integrity.upload_plan(local, remote)


_ACTION = "p AS (SELECT source AS site, doc_id || ['.wav', '.csv', '.zip'][doc_id % 3 + 1] AS name, doc_id, CASE WHEN doc_id % 5 = 0 AND doc_id % 8 <> 1 THEN 'on_record_only' WHEN doc_id % 5 = 0 THEN 'to_delete' WHEN doc_id % 4 > 0 AND doc_id % 8 <> 1 THEN 'already_committed' WHEN doc_id % 7 = 0 THEN 'missing_locally' ELSE 'to_upload' END AS action FROM documents WHERE doc_id % 5 > 0 OR doc_id % 4 > 0)"


def j12(spark, d):
    f = _files(spark, d)
    return integrity.completeness(f, _held(spark, d).withColumn("bytes", F.when(F.col("name").endswith("3"), None).otherwise(F.col("bytes"))))


def j19(spark, d):
    docs = table(spark, d, "documents").select(F.col("source").alias("site"), F.col("doc_id").cast("string").alias("name"), "doc_id")
    return integrity.listed_missing(docs.where("site <> 'src2' and doc_id % 2 = 0"), docs.where("doc_id % 3 > 0"), ["a.csv", "b.csv"])


def u02(spark, d):
    docs = table(spark, d, "documents").select(F.col("source").alias("site"), F.md5("text").alias("name"), "doc_id")
    return integrity.name_sets(docs.where("doc_id % 3 > 0"), docs.where("doc_id % 2 > 0"))


def a05(spark, d):
    docs = table(spark, d, "documents")
    rows = docs.select(F.col("doc_id").alias("id"), (F.col("doc_id") % 50).alias("parent"), F.col("source").alias("key"), F.md5("text").alias("title"))
    return dedup.duplicate_groups(rows)


_A05 = """WITH r AS (SELECT doc_id AS id, doc_id % 50 AS parent, source AS key, md5(text) AS title FROM documents),
t AS (SELECT title FROM r GROUP BY title HAVING count(*) >= 2 AND count(DISTINCT parent) >= 2), k AS (SELECT key FROM r GROUP BY key HAVING count(*) >= 2 AND count(DISTINCT parent) >= 2 AND count(DISTINCT title) >= 2)
SELECT id, 'title' AS type, title AS group_key FROM r WHERE title IN (FROM t) UNION ALL SELECT id, 'key', key FROM r WHERE key IN (FROM k)"""


def w03(spark, d):
    members = a05(spark, d)
    return dedup.number_groups(members.withColumn("created", -F.col("id")))


def a07(spark, d):
    return dedup.several_drafts(table(spark, d, "orders").where("o_orderstatus = 'O'").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("key")))


def w01(spark, d):
    return split.split_plan(_events(spark, d).select("site", "name", "bytes")).select("site", "name", "i", "part")


_ORDERED = f"WITH {_EVENTS}, o AS (SELECT site, name, bytes, row_number() OVER (PARTITION BY site ORDER BY lower(name), name) - 1 AS i, coalesce(sum(bytes) OVER (PARTITION BY site ORDER BY lower(name), name ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, sum(bytes) OVER (PARTITION BY site) AS total FROM e), c AS (SELECT site, i AS cut FROM (SELECT site, i, row_number() OVER (PARTITION BY site ORDER BY abs(2 * before - total), i DESC) AS r FROM o WHERE i > 0) WHERE r = 1)"


def a10(spark, d):
    e = _events(spark, d)
    return layout.group_by_day(e.select("site", F.when(F.col("event_id") % 997 == 0, F.concat(F.lit("x"), "name")).otherwise(F.col("name")).alias("name")))


_A10 = f"WITH {_EVENTS}, b AS (SELECT site, count(*) AS n, {_named("true", "'x' || name")} AS f FROM e WHERE event_id % 997 = 0 GROUP BY site) SELECT site, strftime(ts, '%Y_%m_%d') AS day, count(*) AS n_items, NULL AS refused FROM e WHERE site NOT IN (SELECT site FROM b) GROUP BY ALL UNION ALL SELECT site, NULL, n, 'undatable: ' || f FROM b"


def a11(spark, d):
    names = F.when(F.col("o_custkey") % 4 == 0, F.lit(None)).when((F.col("o_custkey") % 4 == 1) | (F.col("o_orderkey") % 2 == 0), F.concat(F.lit("a_"), F.date_format("o_orderdate", "yyyy_MM_dd"), F.lit(".zip"))).otherwise("a.zip")
    return layout.layout_mode(table(spark, d, "orders").select(F.col("o_custkey").alias("site"), names.alias("name")))


def a12(spark, d):
    return layout.file_cap(_events(spark, d), 10, cap=35)


def a13(spark, d):
    p = table(spark, d, "part").select("p_partkey", layout.records_needed(F.col("p_partkey") % 300, F.col("p_size") * 3).alias("needed"))
    return p.withColumn("advice", layout.split_advice("needed"))


def a15(spark, d):
    return layout.ambiguous_keys(table(spark, d, "supplier").select((F.col("s_suppkey") % 60).alias("key"), F.col("s_name").alias("folder")))


def a18(spark, d):
    e = _events(spark, d)
    return layout.blocking(e.select("site", "name", (F.col("event_id") % 9).alias("bytes"), F.expr("ts - make_interval(cast((event_id % 3) * 25 as int))").alias("mtime")))


def a09(spark, d):
    dates = cov.recording_dates(_events(spark, d).select("site", F.regexp_replace("name", "_[0-9]+\\.wav$", ".wav").alias("name")), 2000)
    return dates.withColumn("first_day", F.col("first_day").cast("string")).withColumn("last_day", F.col("last_day").cast("string"))


def p02(spark, d):
    asked = table(spark, d, "nation").select(F.lower("n_name").alias("key"), F.col("n_nationkey").alias("position"))
    return cov.requested(table(spark, d, "nation").where("n_nationkey % 2 = 0").select(F.col("n_name").alias("key")), asked)


def p03(spark, d):
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("site"), F.col("o_orderkey").alias("path"))
    return cov.not_done(o, o.where("path % 5 > 0 or site % 2 = 0"))


def a08(spark, d):
    return cov.column_accounting(_cells(spark, d))


def _cells(spark, d):
    cell = keys.parse_key_cell(F.when(F.col("p_partkey") % 5 == 0, "").otherwise(F.col("p_size").cast("string")))
    return table(spark, d, "part").select(F.col("p_partkey").alias("row"), cell["key"].alias("key"), cell["reason"].alias("reason"))


def a21(spark, d):
    return cov.accounting_text(_cells(spark, d))


def a16(spark, d):
    return cov.verdict_counts(j01(spark, d).select(F.col("status").alias("verdict")))


def u01(spark, d):
    e = _events(spark, d).select("site", "name", "bytes", "event_id")
    return split.union_parts(e.where("event_id % 3 > 0"), e.where("event_id % 2 > 0").withColumn("bytes", F.col("bytes") + (F.col("event_id") % 5 == 0).cast("int")))


def j15(spark, d):
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("id"), F.md5("text").alias("title"), (F.col("doc_id") % 3 == 0).alias("draft"))
    return dedup.title_matches(docs.select("id", "title"), docs)


def a20(spark, d):
    o = table(spark, d, "orders").select(F.when(F.col("o_orderkey") % 5 > 0, F.col("o_orderkey") % 2 == 0).alias("draft"), F.when(F.col("o_orderkey") % 3 > 0, "10.1/x").alias("doi"), F.when(F.col("o_orderkey") % 5 == 0, "unknown").alias("error"))
    return records.footer(o)


QUERIES = {
    "j01_reconcile": j01, "j01_reconcile_summary": j01_summary, "a02_side_stats": a02, "a03_self_check": a03, "a04_audit_report": a04, "j02_manifest_problems": j02, "j04_digest_problems": j04, "j05_missing_keys": j05, "j09_expected_missing": j09,
    "j10_merge_community": j10("community"), "j10_merge_account": j10("account"), "j11_upload_plan": _plan, "a19_record_summary": lambda s, d: integrity.record_summary(_plan(s, d)), "j12_completeness": j12, "j15_title_matches": j15, "j19_listed_missing": j19, "u01_union_parts": u01, "u02_name_sets": u02,
    "a05_duplicate_groups": a05, "w03_group_numbers": w03, "a07_several_drafts": a07, "w01_balanced_split": w01, "w05_verify_plan": lambda s, d: split.verify_plan(w01_full(s, d)), "w06_cut_boundary": lambda s, d: split.cut_boundary(w01_full(s, d)), "a10_group_by_day": a10, "a11_layout_mode": a11, "a12_file_cap": a12, "a13_records_needed": a13,
    "a15_ambiguous_keys": a15, "a18_blocking": a18, "a09_recording_dates": a09, "p02_requested": p02, "p03_not_done": p03, "a08_column_accounting": a08, "a21_accounting_text": a21, "a16_verdict_counts": a16, "a20_footer": a20,
}


def w01_full(spark, d):
    plan = split.split_plan(_events(spark, d).select("site", "name", "bytes"))
    return plan.withColumn("part", F.when((F.col("site") == "1") & (F.col("i") == 0), 2).otherwise(F.col("part")))  # one plan is spoilt


ORACLE_SQL = {
    "j01_reconcile": f"{_STATUS} SELECT site, name, status FROM s",
    "j01_reconcile_summary": f"{_STATUS} SELECT site, " + ", ".join(f"count(*) FILTER (WHERE status = '{k}') AS n_{k}, min(name) FILTER (WHERE status = '{k}') AS first_{k}" for k in ("missing", "extra", "size_differs")) + ", bool_and(status = 'match') AS matches FROM s GROUP BY site",
    "a02_side_stats": f"WITH {_SIDES} SELECT site, side, count(*) AS n_items, sum(bytes)::BIGINT AS total_bytes, count(*) FILTER (WHERE bytes = 0) AS n_zero, count(*) FILTER (WHERE bytes > 0 AND bytes < 1024) AS n_tiny, count(*) FILTER (WHERE bytes % 11 = 0) AS n_discrepancies, {_named('bytes = 0')} AS names_zero, {_named('bytes > 0 AND bytes < 1024')} AS names_tiny, {_named('bytes % 11 = 0')} AS names_odd FROM c GROUP BY site, side",
    "a03_self_check": f"WITH {_SIDES} SELECT DISTINCT site, side, 'tiny' AS problem FROM c WHERE site = 'src1'",
    "a04_audit_report": "SELECT source AS site, count(*) AS disk_items, count(*) FILTER (WHERE n_chars % 5 > 0) AS archive_items, count(*) FILTER (WHERE n_chars > 0 AND n_chars < 1024) AS disk_tiny, bool_and(n_chars % 5 > 0) AS matches, CASE WHEN bool_and(n_chars % 5 > 0) THEN '' ELSE 'missing: ' || count(*) FILTER (WHERE n_chars % 5 = 0) END AS notes FROM documents GROUP BY source",
    "j02_manifest_problems": _J02,
    "j04_digest_problems": "SELECT source AS site, CAST(doc_id AS VARCHAR) AS name, CASE WHEN doc_id % 7 = 0 THEN 'not computed' ELSE 'differs' END AS problem FROM documents WHERE source <> 'src3' AND (doc_id % 7 = 0 OR doc_id % 11 = 0)",
    "j05_missing_keys": "WITH a AS (SELECT DISTINCT CAST(doc_id AS VARCHAR) AS key FROM documents), b AS (SELECT DISTINCT CAST(doc_id + 3 AS VARCHAR) AS key FROM labels) SELECT coalesce(a.key, b.key) AS key, CASE WHEN b.key IS NULL THEN 'master' WHEN a.key IS NULL THEN 'report' ELSE 'both' END AS side FROM a FULL JOIN b ON a.key = b.key",
    "j09_expected_missing": "SELECT n_name AS site, n_name || '_list.csv' AS name FROM nation WHERE n_nationkey % 3 = 0 UNION ALL SELECT n_name, 'README.html' FROM nation UNION ALL SELECT DISTINCT n_name, s_name FROM supplier JOIN nation ON s_nationkey = n_nationkey",
    "j10_merge_community": _j10("community"), "j10_merge_account": _j10("account"),
    "j11_upload_plan": f"WITH {_ACTION} SELECT site, name, action FROM p",
    "a19_record_summary": f"WITH {_ACTION} SELECT site, count(*) FILTER (WHERE doc_id % 5 > 0 AND doc_id % 3 = 0) AS n_items, count(*) FILTER (WHERE doc_id % 5 > 0 AND doc_id % 3 = 1) AS n_companions, count(*) FILTER (WHERE action = 'already_committed') || '/' || count(*) FILTER (WHERE doc_id % 5 > 0) AS committed, coalesce(max(action) FILTER (WHERE doc_id % 3 = 2), 'none') AS archive_state FROM p GROUP BY site",
    "j12_completeness": f"WITH {_FILES}, s AS (SELECT coalesce(f.site, h.site) AS site, coalesce(f.name, h.name) AS name, CASE WHEN h.name IS NULL THEN 'missing' WHEN f.name IS NULL THEN 'unexpected' WHEN f.bytes <> h.bytes AND right(h.name, 1) <> '3' THEN 'wrong_size' END AS status FROM f FULL JOIN h ON f.site = h.site AND f.name = h.name) SELECT * FROM s WHERE status IS NOT NULL",
    "j15_title_matches": "SELECT doc_id AS id, count(*) FILTER (WHERE doc_id % 3 = 0) OVER (PARTITION BY text) AS drafts, count(*) FILTER (WHERE doc_id % 3 <> 0) OVER (PARTITION BY text) AS published FROM documents",
    "j19_listed_missing": "SELECT source AS site, CAST(doc_id AS VARCHAR) AS name FROM documents WHERE source <> 'src2' AND doc_id % 2 = 0 AND doc_id % 3 = 0 UNION ALL SELECT s.source, n FROM (SELECT source, bool_or(doc_id % 3 > 0) AS here, bool_or(doc_id % 2 = 0 AND source <> 'src2') AS listed FROM documents GROUP BY source) s, (VALUES ('a.csv'), ('b.csv')) v(n) WHERE here AND NOT listed",
    "u01_union_parts": f"WITH {_EVENTS} SELECT site, name, CASE WHEN event_id % 3 > 0 THEN bytes ELSE bytes + CASE WHEN event_id % 5 = 0 THEN 1 ELSE 0 END END AS bytes, event_id % 3 > 0 AND event_id % 2 > 0 AND event_id % 5 = 0 AS conflict FROM e WHERE event_id % 3 > 0 OR event_id % 2 > 0",
    "u02_name_sets": "WITH a AS (SELECT source AS site, md5(text) AS name FROM documents WHERE doc_id % 3 > 0), b AS (SELECT source AS site, md5(text) AS name FROM documents WHERE doc_id % 2 > 0) SELECT *, 'left' AS kind FROM (FROM a EXCEPT FROM b) UNION ALL SELECT *, 'right' FROM (FROM b EXCEPT FROM a) UNION ALL SELECT *, 'both' FROM (FROM a INTERSECT FROM b)",
    "a05_duplicate_groups": _A05,
    "w03_group_numbers": f"WITH m AS ({_A05}) SELECT id, type, dense_rank() OVER (ORDER BY type = 'key', group_key)::INTEGER AS group_no, row_number() OVER (PARTITION BY type, group_key ORDER BY -id, id)::INTEGER AS member_no FROM m",
    "a07_several_drafts": "WITH d AS (SELECT o_orderkey AS id, o_custkey AS key FROM orders WHERE o_orderstatus = 'O'), m AS (SELECT key, count(*) AS n, list_sort(list(id)) AS ids FROM d GROUP BY key) SELECT id, key, n, array_to_string(list_filter(ids, lambda x: x <> id)[1:10], ', ') AS others FROM d JOIN m USING (key) WHERE n > 1",
    "w01_balanced_split": f"{_ORDERED} SELECT site, name, i::INTEGER AS i, CASE WHEN i < cut THEN 1 WHEN cut IS NOT NULL THEN 2 END AS part FROM o LEFT JOIN c USING (site)",
    "w05_verify_plan": f"{_ORDERED} SELECT '1' AS site, CASE WHEN cut = 1 THEN 'empty half' ELSE 'not contiguous' END AS problem FROM c WHERE site = '1'",
    "w06_cut_boundary": f"{_ORDERED} SELECT site, max_by(name, i) FILTER (WHERE i < cut AND NOT (site = '1' AND i = 0)) AS last_of_1, min_by(name, i) FILTER (WHERE i >= cut OR (site = '1' AND i = 0)) AS first_of_2 FROM o JOIN c USING (site) GROUP BY site",
    "a10_group_by_day": _A10,
    "a11_layout_mode": "SELECT o_custkey AS site, CASE o_custkey % 4 WHEN 0 THEN 'none' WHEN 1 THEN 'per_day' ELSE CASE WHEN bool_or(o_orderkey % 2 = 0) AND bool_or(o_orderkey % 2 = 1) THEN 'mixed' WHEN bool_or(o_orderkey % 2 = 0) THEN 'per_day' ELSE 'single' END END AS mode FROM orders GROUP BY o_custkey",
    "a12_file_cap": "SELECT CAST(user_id AS VARCHAR) AS site, count(DISTINCT strftime(ts, '%Y%m%d')) + 14 AS n_files, count(DISTINCT strftime(ts, '%Y%m%d')) + 14 <= 35 AS allowed FROM events GROUP BY user_id",
    "a13_records_needed": "WITH n AS (SELECT p_partkey, CASE WHEN 100 - p_size * 3 <= 0 THEN 0 ELSE ceil((p_partkey % 300) / (100 - p_size * 3)::DOUBLE)::BIGINT END AS needed FROM part) SELECT *, CASE WHEN needed = 0 THEN 'no room beside the companions' WHEN needed <= 2 THEN 'split into two' ELSE 'split into ' || needed || ', more than the splitter makes' END AS advice FROM n",
    "a15_ambiguous_keys": f"SELECT s_suppkey % 60 AS key, count(DISTINCT s_name) AS n, {_named('true', 's_name')} AS folders FROM supplier GROUP BY 1 HAVING count(DISTINCT s_name) > 1",
    "a18_blocking": f"WITH {_EVENTS}, t AS (SELECT *, event_id % 9 = 0 AS z, epoch(ts - to_years(CAST(event_id % 3 * 25 AS INTEGER))) < 315532800 AS o FROM e) SELECT site, count(*) FILTER (WHERE z) AS n_zero, count(*) FILTER (WHERE o) AS n_old, {_named('z')} AS names_zero, {_named('o')} AS names_old FROM t GROUP BY site",
    "a09_recording_dates": "SELECT CAST(user_id AS VARCHAR) AS site, strftime(min(ts), '%Y-%m-%d') AS first_day, strftime(max(ts), '%Y-%m-%d') AS last_day, count(DISTINCT strftime(ts, '%Y%m%d_%H%M%S')) AS n_names FROM events GROUP BY user_id",
    "p02_requested": "SELECT upper(n_name) AS key, n_nationkey AS position, n_nationkey % 2 = 0 AS found FROM nation",
    "p03_not_done": "SELECT DISTINCT o_custkey AS site FROM orders WHERE NOT (o_orderkey % 5 > 0 OR o_custkey % 2 = 0)",
    "a08_column_accounting": "WITH c AS (SELECT CASE WHEN p_partkey % 5 > 0 THEN lpad(CAST(p_size AS VARCHAR), 3, '0') END AS key FROM part) SELECT count(*) AS total, count(key) AS parsed, count(*) - count(key) AS problems, count(DISTINCT key) AS \"distinct\", (SELECT count(*) FROM (SELECT key FROM c WHERE key IS NOT NULL GROUP BY key HAVING count(*) > 1)) AS n_duplicates FROM c",
    "a21_accounting_text": "WITH c AS (SELECT p_partkey AS r, CASE WHEN p_partkey % 5 > 0 THEN lpad(CAST(p_size AS VARCHAR), 3, '0') END AS key FROM part) SELECT * FROM (SELECT 'sample' AS kind, key AS text FROM c WHERE key IS NOT NULL ORDER BY r LIMIT 3) UNION ALL SELECT * FROM (SELECT 'problem', r || ': blank' FROM c WHERE key IS NULL ORDER BY r LIMIT 20) UNION ALL SELECT 'duplicate', key || ' x' || count(*) FROM c WHERE key IS NOT NULL GROUP BY key HAVING count(*) > 1",
    "a16_verdict_counts": f"{_STATUS} SELECT status AS verdict, count(*) AS n FROM s GROUP BY status",
    "a20_footer": "SELECT count(*) FILTER (WHERE o_orderkey % 5 > 0 AND o_orderkey % 2 = 0) AS drafts, count(*) FILTER (WHERE o_orderkey % 5 > 0 AND o_orderkey % 2 = 1) AS published, count(*) FILTER (WHERE o_orderkey % 5 = 0) AS unknown, count(*) FILTER (WHERE o_orderkey % 3 = 0) AS without_doi, count(*) FILTER (WHERE o_orderkey % 5 = 0) AS errors FROM orders",
}
