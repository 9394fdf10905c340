"""Queries of locating, ordering, filtering, manifest, log and report operators, and a gate whose facts other operators find."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import items, keys, text
from ..functions.common import shared_dir, table
from ..operators import coverage as cov
from ..operators import dedup, integrity, layout, logs, metadata, records, split, state, verdicts
from ..sources import files, sinks
from . import judging, reconciling

#: A key with a suffix on two rows of three.
_KEY = "concat(lpad(CAST(p_size AS STRING), 3, '0'), CASE p_partkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'A' ELSE '_x' END)"
_KEY_SQL = "lpad(CAST(p_size AS VARCHAR), 3, '0') || CASE p_partkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'A' ELSE '_x' END"
#: File names of every kind that the upload and copy rules tell apart.
_KINDS = ("README.md", "readme.html", "a.wav", "b.WAV", "c.zip", "d.csv", ".hidden", "x_upload_state.json", "in.xlsx", "e_metadata.json", "f.Wav")
_FILE = "concat(doc_id, '/', element_at(array({}), CAST(doc_id % 11 + 1 AS INT)))".format(", ".join(f"'{k}'" for k in _KINDS))
_NAMES = "[{}][doc_id % 11 + 1]".format(", ".join(f"'{k}'" for k in _KINDS))


def _docs(spark, d, *columns):
    return table(spark, d, "documents").selectExpr("doc_id", "source AS site", f"split_part({_FILE}, '/', 2) AS name", "n_chars AS bytes", *columns)


def _position(rows, by, order, *columns):
    """The place of each row within ``by``."""
    return rows.select(*columns, F.row_number().over(Window.partitionBy(by).orderBy(*order)).alias("place"))


def e04(spark, d):
    k = keys.key_sort("key")
    return table(spark, d, "part").selectExpr("p_partkey", f"{_KEY} AS key").select("p_partkey", k["n"].alias("n"), k["s"].alias("s"))


def e39(spark, d):
    return table(spark, d, "part").select("p_partkey", text.sample_text(F.split("p_type", " "), 2).alias("shown"))


def e42(spark, d):
    new = "to_json(named_struct('parent', named_struct('pids', named_struct('doi', named_struct('identifier', CAST(o_custkey AS STRING)))), 'pids', named_struct('doi', named_struct('identifier', CAST(o_orderkey AS STRING))), 'versions', named_struct('is_latest', o_orderkey % 3 = 0)))"
    old = "to_json(named_struct('conceptdoi', CAST(o_custkey AS STRING), 'doi', ''))"
    ids = text.record_ids("doc")
    return table(spark, d, "orders").selectExpr("o_orderkey", f"CASE WHEN o_orderkey % 2 = 0 THEN {new} ELSE {old} END AS doc").select("o_orderkey", *(ids[c].alias(c) for c in ("concept", "version", "latest")))


def j07(spark, d):
    rows = table(spark, d, "customer").selectExpr("CAST(c_nationkey AS STRING) AS key", "c_custkey AS row", "c_name AS collector")
    return metadata.lookup_first(table(spark, d, "nation").selectExpr("CAST(n_nationkey * 2 AS STRING) AS key"), rows)


def _folders(spark, d, where, letter):
    return table(spark, d, "orders").where(where).selectExpr("o_custkey AS key", f"concat('{letter}', o_orderkey) AS place", f"concat('{letter}', o_orderkey) AS folder", "o_orderkey % 2 = 0 AS sentinel")


def j08(spark, d):
    return cov.locate(table(spark, d, "customer").selectExpr("c_custkey AS key"), _folders(spark, d, "o_orderkey % 7 = 0", "s"), _folders(spark, d, "o_orderkey % 5 = 0", "u"))


def j16(spark, d):
    names = table(spark, d, "part").selectExpr("concat(lpad(CAST(p_size AS STRING), 3, '0'), '_Part_', 1 + p_partkey % 2, '_of_', 2 + p_partkey % 3) AS key").distinct()
    return split.part_pairs(names)


def j17(spark, d):
    ours = table(spark, d, "documents").selectExpr("source AS site", "CAST(doc_id AS STRING) AS name", "md5(text) AS digest", "doc_id")
    return integrity.diverging(ours, ours.where("doc_id % 5 > 0").withColumn("digest", F.when(F.col("doc_id") % 7 == 0, "other").otherwise(F.col("digest"))))


def j18(spark, d):
    docs = table(spark, d, "documents").withColumn("m", F.md5(F.coalesce("text", F.lit("")))).selectExpr("doc_id AS id", "m")
    old = docs.select("id", F.expr("map('gone', m, 'same', m, 'short', m, 'long', repeat(m, 40))").alias("doc"))
    new = docs.select("id", F.expr("map('come', concat(' ', m, ' ', m, ' ', m, ' '), 'same', m, 'short', reverse(m), 'long', concat(repeat(m, 35), 'x'))").alias("doc"))
    return integrity.key_diff(old, new)


def j20(spark, d):
    kept = table(spark, d, "customer").selectExpr("c_custkey AS key", "CAST(c_nationkey AS STRING) AS record_id", "c_mktsegment AS mode").where("key % 4 > 0")
    return cov.local_package(table(spark, d, "customer").selectExpr("c_custkey AS key"), _folders(spark, d, "o_orderkey % 7 = 0", "s"), _folders(spark, d, "o_orderkey % 5 = 0", "r"), kept)


def p04(spark, d):
    rows = table(spark, d, "orders").selectExpr("o_orderkey", "CASE o_orderkey % 3 WHEN 0 THEN 'file_by_file' WHEN 1 THEN 'zip' END AS mode", "CASE WHEN o_orderkey % 2 = 0 THEN 'per_day' ELSE 'single' END AS layout")
    return rows.where(layout.mode_allows("mode", "layout"))


def p05(spark, d):
    return cov.prepared(table(spark, d, "customer").selectExpr("c_custkey AS key"), _folders(spark, d, "o_orderkey % 7 = 0", "s"), _folders(spark, d, "o_orderkey % 5 = 0", "u"))


def p07(spark, d):
    return layout.not_uploaded(_docs(spark, d), ["in.xlsx", "d.csv"])


def p08(spark, d):
    return _docs(spark, d).select("doc_id", layout.copy_reason("name", F.col("doc_id") % 13 == 0, F.col("doc_id") % 17 == 0).alias("reason"))


def p10(spark, d):
    names = table(spark, d, "part").selectExpr("concat('SITE', CASE WHEN p_partkey % 2 = 0 THEN '#' ELSE '_' END, lpad(CAST(p_size AS STRING), 3, '0'), CASE p_partkey % 4 WHEN 0 THEN '' WHEN 1 THEN '_Staging' WHEN 2 THEN 'A_staging' ELSE 'B' END) AS folder")
    return cov.folders(names)


def p11(spark, d):
    paths = table(spark, d, "part").selectExpr("concat('/a/b', p_partkey, '/', CASE WHEN p_partkey % 3 = 0 THEN 'notes' ELSE concat('SITE_', lpad(CAST(p_size AS STRING), 3, '0')) END, '.zip') AS path")
    return cov.key_pairs(paths)


def a17(spark, d):
    return cov.unique_keys(table(spark, d, "orders").selectExpr("CASE WHEN o_custkey % 5 > 0 THEN CAST(o_custkey AS STRING) END AS key"))


def _listing(spark, d):
    return table(spark, d, "part").selectExpr("p_partkey", "p_brand", f"CASE WHEN p_partkey % 11 > 0 THEN {_KEY} END AS key", "CASE WHEN p_partkey % 5 = 0 THEN concat('r', p_partkey) ELSE CAST(p_partkey AS STRING) END AS id")


def l01(spark, d):
    return _position(_listing(spark, d).where("key is not null"), "p_brand", records.report_order(), "p_partkey")


def l06(spark, d):
    return _position(_listing(spark, d), "p_brand", records.candidate_order(), "p_partkey")


def l05(spark, d):
    rows = _docs(spark, d)
    return _position(rows, "site", [*layout.upload_order("name"), F.col("doc_id")], "doc_id")


def l07(spark, d):
    return _position(_docs(spark, d), "site", [*items.item_order("name"), F.col("doc_id")], "doc_id")


def i04(spark, d):
    return state.sentinel_backfill(judging.QUERIES["v02_day_completeness"](spark, d).selectExpr("o_orderkey AS site", "verdict", "o_orderkey % 2 = 0 AS sentinel"))


def m01(spark, d):
    docs = table(spark, d, "documents").selectExpr("source AS site", "CAST(doc_id AS STRING) AS name", "n_chars AS bytes", "md5(text) AS sha512", "doc_id")
    parts = {r: docs.where(f"doc_id % 3 = {i}") for i, r in enumerate(("generated", "companion", "item"))}
    return metadata.internal_manifest(parts, docs.where("doc_id % 4 > 0"))


def _days(spark, d):
    e = reconciling._events(spark, d).withColumn("day", items.day_key("name"))
    return e, e.where("event_id % 3 = 0").groupBy("site", "day").agg(F.sum("bytes").alias("bytes")).withColumn("name", F.concat_ws("_", "site", "day"))


def m02(spark, d):
    e, archives = _days(spark, d)
    return metadata.external_manifest(e.select("site", "name", "bytes"), archives)


def m03(spark, d):
    return metadata.upload_set(_docs(spark, d), ["in.xlsx"])


def m04(spark, d):
    docs = _docs(spark, d, "md5(text) AS sha512")
    return metadata.required_files(docs.where("doc_id % 2 = 0"), docs.where("doc_id % 2 = 1"))


def m07_references(spark, d):
    return metadata.references(table(spark, d, "customer").selectExpr("CASE c_custkey % 4 WHEN 0 THEN '  ' WHEN 1 THEN NULL ELSE concat(' ', c_name, ' ') END AS reference"))


def m09(spark, d):
    rows = table(spark, d, "customer").selectExpr(
        "c_custkey", "array(named_struct('funder_id', CAST(c_nationkey AS STRING), 'award_title', CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END, 'award_number', c_name, 'award_url', CASE WHEN c_custkey % 3 = 0 THEN '' ELSE concat('https://x/', c_custkey) END)) AS f",
        "array(named_struct('family', c_name, 'given', c_mktsegment, 'orcid', CASE WHEN c_custkey % 2 = 0 THEN '' ELSE '0000' END, 'affiliation', concat('a;', c_custkey))) AS p",
    ).withColumn("f", metadata.fundings("f")[0]).withColumn("p", metadata.people("p", "editor")[0])
    return rows.selectExpr("c_custkey", "f.funder.id AS funder", "f.award.title.en AS title", "f.award.number AS number", "f.award.identifiers[0].identifier AS url", "p.person_or_org.name AS person", "size(p.person_or_org.identifiers) AS n_ids", "p.affiliations[1] AS affiliation")


def m11(spark, d):
    docs = table(spark, d, "orders").selectExpr("o_orderkey AS id", "map_from_entries(array_compact(array(struct('files' AS k, o_orderpriority AS v), struct('links' AS k, 'x' AS v), CASE WHEN o_orderkey % 2 = 0 THEN struct('access' AS k, 'open' AS v) END))) AS doc", "o_orderstatus AS metadata")
    out = metadata.put_body(docs, ["files", "access", "metadata"], ("access", "restricted"))
    return out.select("id", F.array_join(F.array_sort(F.map_keys("body")), ",").alias("keys"), *(F.col("body")[k].alias(k) for k in ("files", "access", "metadata")))


def s13(spark, d):
    """Lines that name sites in several spellings, some of them inside longer words."""
    lines = table(spark, d, "part").selectExpr("p_partkey AS line_no", "concat('run ', CASE p_partkey % 4 WHEN 0 THEN 'SITE ' WHEN 1 THEN 'SITE_' WHEN 2 THEN 'site ' ELSE '(SITE ' END, CASE WHEN p_partkey % 3 = 0 THEN CAST(p_size AS STRING) ELSE lpad(CAST(p_size AS STRING), 3, '0') END, CASE WHEN p_partkey % 5 = 0 THEN '_x' ELSE ' ' END, p_type) AS line")
    number = table(spark, d, "nation").selectExpr("n_nationkey + 1 AS n")
    spelt = number.selectExpr("lpad(CAST(n AS STRING), 3, '0') AS key", "explode(array(concat('SITE ', lpad(CAST(n AS STRING), 3, '0')), concat('SITE_', lpad(CAST(n AS STRING), 3, '0')), concat('SITE ', n))) AS spelling")
    counts, last = logs.scan_logs(lines, spelt, ["STEEL", "COPPER"], 3)
    return counts.select("key", F.col("n_lines").alias("n"), F.lit("lines").alias("kind")).unionByName(last.select("key", F.col("line_no").alias("n"), F.lit("last").alias("kind")))


def w04_words(spark, d):
    lines = table(spark, d, "conversations").groupBy(F.col("conv_id").alias("key"), F.col("turn").alias("line_no")).agg(F.min("text").alias("line"))
    return state.last_lines(lines, 2).select("key", "line_no", F.md5("line").alias("line"))


def v08_action(spark, d):
    rows = judging.QUERIES["v08_missing_state_cause"](spark, d)
    return rows.select("o_orderkey", verdicts.suggested_action().alias("action"))


def v08_text(spark, d):
    facts = judging._facts(spark, d, judging.FACTS["v08_missing_state_cause"][1])
    return verdicts.missing_state_cause(facts).select("o_orderkey", verdicts.cause_text().alias("cause"))


def v07_from_listing(spark, d):
    """Listing pages as JSON -> records -> candidates."""
    doc = (
        "to_json(map_filter(map('id', CASE WHEN c_custkey % 13 > 0 THEN CAST(c_custkey AS STRING) END, 'title', CASE c_custkey % 3 WHEN 0 THEN concat('Recordings of site ', lpad(CAST(c_custkey % 1000 AS STRING), 3, '0'), ' by ', c_name)"
        " WHEN 1 THEN concat('SITE ', lpad(CAST(c_nationkey AS STRING), 3, '0')) ELSE c_name END, 'status', CASE c_custkey % 5 WHEN 0 THEN 'published' WHEN 1 THEN NULL ELSE 'draft' END), (k, v) -> v IS NOT NULL))"
    )
    pages = table(spark, d, "customer").selectExpr("c_custkey", "'account' AS source", f"{doc} AS doc")
    found = verdicts.listing_candidates(records.normalize_records(pages.drop("c_custkey")), ["*of site *", "SITE *"])
    return found.groupBy("verdict", "key").agg(F.count("*").alias("n"), F.min("id").alias("first"))


def v09_from_folders(spark, d):
    """Pairs of halves: documents are the items of part 1, and part 2 holds some of them already."""
    docs = table(spark, d, "documents").selectExpr("doc_id % 50 AS b", "doc_id", "n_chars AS bytes", "concat('d', lpad(CAST(doc_id AS STRING), 9, '0'), '.wav') AS name")
    key = "concat(lpad(CAST(b AS STRING), 3, '0'), '_Part_{}_of_', CASE WHEN b % 11 = 0 THEN 3 ELSE 2 END) AS key"
    one, two = key.format(1), key.format(2)
    sites = docs.groupBy("b").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    files = docs.selectExpr(one, "name", "bytes", "CASE WHEN b % 13 = 4 THEN 'odd size' END AS error")
    files = files.unionByName(sites.selectExpr(one, "'aa.txt' AS name", "10 AS bytes", "CAST(NULL AS STRING) AS error"))
    files = files.unionByName(sites.where("b % 17 = 5").selectExpr(two, "'x_upload_state.json' AS name", "1 AS bytes", "CAST(NULL AS STRING) AS error"))
    ends = docs.join(sites, "b").where("b % 5 = 2 AND doc_id = high OR b % 5 = 3 AND doc_id = low")
    files = files.unionByName(ends.selectExpr(two, "name", "bytes + CASE WHEN b % 10 = 2 THEN 1 ELSE 0 END AS bytes", "CAST(NULL AS STRING) AS error"))
    folders = sites.selectExpr(one).unionByName(sites.where("b % 7 > 0").selectExpr(two))
    facts = split.pair_facts(split.part_pairs(folders), files)
    return verdicts.split_verdict(facts, limit=40000).select("base", "verdict", "cut", "bytes1", "bytes2", "n_in_part2")


def v10_from_folders(spark, d):
    """Leftovers and their twins, with archives and upload artifacts that differ here and there."""
    c = table(spark, d, "customer").selectExpr("c_custkey AS c", "c_custkey % 40 AS key", "c_custkey % 3 = 0 AS left")
    left, twin = c.where("left").withColumn("place", F.expr("concat('L', c)")), c.where("NOT left").withColumn("place", F.expr("concat('T', c)"))
    own = left.selectExpr("place", "explode(array_compact(array(struct('a.zip' AS name, CASE WHEN c % 5 > 0 THEN concat('z', key) ELSE 'other' END AS digest), CASE WHEN c % 7 = 0 THEN struct('B.ZIP' AS name, 'b' AS digest) END, struct('x_upload_state.json' AS name, CASE WHEN c % 11 > 0 THEN concat('s', key) ELSE 'd' END AS digest)))) AS f")
    theirs = twin.selectExpr("place", "explode(array_compact(array(CASE WHEN c % 9 > 0 THEN struct('t.zip' AS name, concat('z', key) AS digest) END, CASE WHEN c % 13 > 0 THEN struct('x_upload_state.json' AS name, concat('s', key) AS digest) END))) AS f")
    candidates = twin.where("key % 8 > 0").selectExpr("key", "place", "c % 4 > 0 AS has_sentinel", "c % 5 AS priority", "c % 2 = 0 AS uploaded")
    facts = dedup.leftover_facts(left.select("key", "place"), candidates, own.unionByName(theirs).select("place", "f.*"))
    return verdicts.leftover_verdict(facts).select("place", "twin", "verdict")


def v08_from_evidence(spark, d):
    """Causes of lost states, from results, logs, archives and the done-set, each as found in the tables."""
    c = table(spark, d, "customer").selectExpr("c_custkey AS site", "c_custkey", "c_nationkey")
    o = table(spark, d, "orders").selectExpr("o_custkey AS site", "o_orderkey", "o_orderstatus", "concat('/a/', o_orderkey, '.zip') AS path", "o_orderpriority")
    logs = o.where("o_orderkey % 41 = 0").selectExpr("site", "CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderkey AS STRING) ELSE '' END AS record_id")
    failures = o.where("o_orderkey % 3 = 0").selectExpr("site", "o_orderkey AS at", "o_orderpriority AS error_message")
    facts = verdicts.missing_state_facts(
        c, logs, o.where("o_orderkey % 53 = 0"), o.where("o_orderkey % 47 = 0"), failures, o.where("o_orderkey % 2 = 1").select("site", "path"), o.where("o_orderkey % 11 = 0").select("path"), c.where("c_nationkey % 2 = 0"),
    )
    return verdicts.missing_state_cause(facts).select("site", verdicts.cause_text().alias("cause"), verdicts.suggested_action().alias("action"))


def _draft_side(spark, d):
    """Documents as files of sites: which are raw, which companions, and which the record holds."""
    return table(spark, d, "documents").selectExpr("doc_id % 97 AS k", "concat('S', doc_id % 97) AS site", "doc_id", "CASE WHEN doc_id div 97 % 3 = 0 THEN concat(doc_id, '.txt') ELSE concat(doc_id, '.wav') END AS name", "doc_id div 97 % 3 = 0 AS companion")


def v05_from_entries(spark, d):
    """Verdicts on drafts and why, from the entries of records and the manifests."""
    rows = _draft_side(spark, d)
    sites = rows.select("k", "site").distinct()
    entries = rows.where("k % 6 = 0 OR companion AND (k % 4 > 0 OR doc_id % 5 > 0)").selectExpr("site", "name", "CASE WHEN doc_id % 11 = 0 THEN 'pending' ELSE 'completed' END AS status")
    entries = entries.unionByName(sites.where("k % 7 = 0").selectExpr("site", "concat(site, '.zip') AS name", "CASE WHEN k % 2 = 0 THEN 'completed' ELSE 'pending' END AS status"))
    facts = verdicts.draft_facts(entries, rows.where("NOT companion"), rows.where("companion AND k % 13 > 0"), sites.selectExpr("site", "concat(site, '.zip') AS archive"), sites.where("k % 10 = 3"))
    return verdicts.draft_verdict(facts).select("site", "verdict", verdicts.draft_note().alias("note"))


def v06_notes(spark, d):
    facts = judging._facts(spark, d, judging.FACTS["v06_local_verdict"][1]).selectExpr("*", "transform(sequence(1, n_staging), i -> concat('s', i)) AS staging_folders", "array('r2', 'r1') AS raw_folders", "array(CAST(o_orderkey AS STRING)) AS raw_absent")
    return verdicts.local_verdict(facts).select("o_orderkey", verdicts.local_note().alias("note"))


def v04_from_files(spark, d):
    """The integrity gate on what J02, J04 and A11 find: problems of the manifest, digests that differ, and the archives' layout."""
    e, days = _days(spark, d)
    problems = reconciling.j02(spark, d).groupBy("site").agg(F.sum("n").alias("n_manifest_problems"))
    digests = e.select("site", "name", F.md5("name").alias("digest"), "event_id")
    computed = digests.withColumn("digest", F.when(F.col("event_id") % 41 == 0, "x").otherwise(F.col("digest")))
    odd = integrity.digest_problems(digests.drop("event_id"), computed.drop("event_id"), problems.where("n_manifest_problems > 60")).groupBy("site").agg(F.count("*").alias("n_digest_problems"))
    names = days.select("site", F.concat("name", F.lit(".zip")).alias("name")).unionByName(e.where("event_id % 211 = 0").select("site", F.lit("all.zip").alias("name")))
    sites = e.groupBy("site").agg(F.max("event_id").alias("last"))
    modes = layout.layout_mode(names).withColumnRenamed("mode", "layout")
    facts = sites.join(problems, "site", "left").join(odd, "site", "left").join(modes, "site", "left").fillna(0, ["n_manifest_problems", "n_digest_problems"]).fillna("none", ["layout"])
    facts = facts.select("*", (F.col("last") % 2 == 0).alias("sentinel"), F.lit(True).alias("archive_readable"), F.lit(True).alias("has_manifest"))
    return verdicts.integrity_gate(facts).select("site", F.array_join("problems", "; ").alias("problems"), "verdict")


def s14(spark, d):
    """A report written and read again."""
    path = f"{shared_dir(spark)}/report-{uuid.uuid4().hex}"
    sinks.write_report(table(spark, d, "customer").selectExpr("c_name AS site", "c_custkey AS n", "concat('says \"', c_mktsegment, '\", twice') AS note"), path, ["n", "site", "note"])
    return files.read_report(spark, path, ["n", "site"])


def s15(spark, d):
    """Results appended to both logs, twice, and counted."""
    path = f"{shared_dir(spark)}/results-{uuid.uuid4().hex}"
    rows = table(spark, d, "orders").selectExpr("o_orderkey", "o_orderkey % 3 > 0 AS success")
    for part in (0, 1):
        sinks.append_results(rows.where(f"o_orderkey % 2 = {part}"), path)
    return spark.read.schema("o_orderkey long, success boolean, outcome string").parquet(path).groupBy("outcome").agg(F.count("*").alias("n"), F.countDistinct("o_orderkey").alias("orders"))


def s16(spark, d):
    """Items packed by site and day, and read by their folders."""
    path = f"{shared_dir(spark)}/packed-{uuid.uuid4().hex}"
    layout.write_packed(reconciling._events(spark, d).select((F.col("site").cast("long") % 7).cast("string").alias("site"), "name", "bytes"), path)
    return spark.read.schema("name string, bytes long, site string, day string").parquet(path).groupBy("site", "day").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"))


QUERIES = {
    "e04_key_sort": e04, "e39_sample_text": e39, "e42_record_ids": e42, "j07_lookup_first": j07, "j08_locate": j08, "j16_part_pairs": j16, "j17_diverging": j17, "j18_key_diff": j18, "j20_local_package": j20, "p04_mode_allows": p04, "p05_prepared": p05,
    "p07_not_uploaded": p07, "p08_copy_reason": p08, "p10_folders": p10, "p11_key_pairs": p11, "a17_unique_keys": a17, "l01_report_order": l01, "l05_upload_order": l05, "l06_candidate_order": l06, "l07_item_order": l07, "i04_sentinel_backfill": i04,
    "m01_internal_manifest": m01, "m02_external_manifest": m02, "m03_upload_set": m03, "m04_required_files": m04, "m07_references": m07_references, "m09_people_and_fundings": m09, "m11_put_body": m11, "s13_scan_logs": s13, "w04_last_texts": w04_words,
    "v08_suggested_action": v08_action, "v08_cause_text": v08_text, "v07_from_listing": v07_from_listing, "v08_from_evidence": v08_from_evidence, "v09_from_folders": v09_from_folders, "v10_from_folders": v10_from_folders, "v05_from_entries": v05_from_entries, "v06_local_notes": v06_notes, "v04_gate_from_files": v04_from_files, "s14_s18_report": s14, "s15_results": s15, "s16_packed": s16,
}

_D = f"WITH d AS (SELECT doc_id, source AS site, {_NAMES} AS name, n_chars AS bytes, text FROM documents)"
_O = "WITH s AS (SELECT o_custkey AS key, min('s' || o_orderkey) AS s, count(*) AS n, bool_or(o_orderkey % 2 = 0) AS sentinel FROM orders WHERE o_orderkey % 7 = 0 GROUP BY o_custkey), u AS (SELECT o_custkey AS key, min('u' || o_orderkey) AS u, min('r' || o_orderkey) AS r, count(*) AS n FROM orders WHERE o_orderkey % 5 = 0 GROUP BY o_custkey)"
_DAYS = f"WITH {reconciling._EVENTS}, a AS (SELECT site, strftime(ts, '%Y_%m_%d') AS day, sum(bytes)::BIGINT AS bytes FROM e WHERE event_id % 3 = 0 GROUP BY ALL)"
_ACTIONS = ", ".join("('{}', '{}')".format(*(x.replace("'", "''") for x in kv)) for kv in verdicts.ACTIONS.items())

ORACLE_SQL = {
    "e04_key_sort": "SELECT p_partkey, p_size AS n, CASE p_partkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'A' ELSE '_x' END AS s FROM part",
    "e39_sample_text": "WITH w AS (SELECT p_partkey, list_sort(list_distinct(string_split(p_type, ' '))) AS w FROM part) SELECT p_partkey, array_to_string(w[1:2], ', ') || CASE WHEN len(w) > 2 THEN ', ... (' || len(w) || ')' ELSE '' END AS shown FROM w",
    "e42_record_ids": "SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS concept, CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderkey AS VARCHAR) END AS version, o_orderkey % 6 = 0 AS latest FROM orders",
    "j07_lookup_first": "SELECT CAST(n_nationkey * 2 AS VARCHAR) AS key, c AS collector FROM nation LEFT JOIN (SELECT c_nationkey, min_by(c_name, c_custkey) AS c FROM customer GROUP BY c_nationkey) ON c_nationkey = n_nationkey * 2",
    "j08_locate": f"{_O} SELECT c_custkey AS key, coalesce(s, u) AS place, CASE WHEN s IS NOT NULL THEN 'staging' WHEN u IS NOT NULL THEN 'uploaded' ELSE 'none' END AS location FROM customer LEFT JOIN s ON s.key = c_custkey LEFT JOIN u ON u.key = c_custkey",
    "j16_part_pairs": "WITH f AS (SELECT DISTINCT lpad(CAST(p_size AS VARCHAR), 3, '0') AS base, (1 + p_partkey % 2)::INTEGER AS i, (2 + p_partkey % 3)::INTEGER AS n FROM part) SELECT a.base, a.n, a.base || '_Part_1_of_' || a.n AS part1, b.base || '_Part_2_of_' || b.n AS part2 FROM f a LEFT JOIN f b ON a.base = b.base AND a.n = b.n AND b.i = 2 WHERE a.i = 1",
    "j17_diverging": "SELECT source AS site, CAST(doc_id AS VARCHAR) AS name, CASE WHEN doc_id % 5 = 0 THEN 'absent' ELSE 'differs' END AS how FROM documents WHERE doc_id % 5 = 0 OR doc_id % 7 = 0",
    "j18_key_diff": "WITH m AS (SELECT doc_id AS id, md5(coalesce(text, '')) AS m FROM documents) SELECT id, v.key, v.change, CASE v.key WHEN 'gone' THEN m WHEN 'come' THEN left(m || ' ' || m || ' ' || m, 89) || '…' WHEN 'same' THEN '' WHEN 'short' THEN CASE WHEN m = reverse(m) THEN '' ELSE m || '  ->  ' || reverse(m) END ELSE '1,280 -> 1,121 chars, first difference at offset 1,120' END AS detail FROM m, (VALUES ('gone', 'removed'), ('come', 'added'), ('same', 'same'), ('short', 'CHANGED'), ('long', 'CHANGED')) v(key, change)",
    "j20_local_package": f"{_O} SELECT c_custkey AS key, coalesce(s.n, 0) AS n_staging, s AS staging, coalesce(u.n, 0) AS n_raw, r AS raw, CASE WHEN c_custkey % 4 > 0 THEN CAST(c_nationkey AS VARCHAR) END AS record_id, CASE WHEN c_custkey % 4 > 0 THEN c_mktsegment END AS mode FROM customer LEFT JOIN s ON s.key = c_custkey LEFT JOIN u ON u.key = c_custkey",
    "p04_mode_allows": "SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'file_by_file' WHEN 1 THEN 'zip' END AS mode, CASE WHEN o_orderkey % 2 = 0 THEN 'per_day' ELSE 'single' END AS layout FROM orders WHERE o_orderkey % 3 > 0 OR o_orderkey % 2 = 0",
    "p05_prepared": f"{_O} SELECT c_custkey AS key, coalesce(sentinel, false) OR u IS NOT NULL AS prepared FROM customer LEFT JOIN s ON s.key = c_custkey LEFT JOIN u ON u.key = c_custkey",
    "p07_not_uploaded": f"{_D} SELECT doc_id, site, name, bytes FROM d WHERE name NOT IN ('in.xlsx', 'd.csv', 'README.md', 'c.zip')",
    "p08_copy_reason": f"{_D} SELECT doc_id, CASE WHEN doc_id % 13 = 0 THEN 'symlink' WHEN doc_id % 17 = 0 THEN 'directory' WHEN name = '.hidden' THEN 'hidden' WHEN name IN ('a.wav', 'b.WAV', 'f.Wav') THEN 'item' WHEN name = 'c.zip' THEN 'archive' WHEN name LIKE '%.json' THEN 'upload artifact' END AS reason FROM d",
    "p10_folders": "WITH f AS (SELECT p_partkey % 4 AS k, 'SITE' || CASE WHEN p_partkey % 2 = 0 THEN '#' ELSE '_' END || lpad(CAST(p_size AS VARCHAR), 3, '0') || ['', '_Staging', 'A_staging', 'B'][p_partkey % 4 + 1] AS folder FROM part) SELECT folder, k = 0 AS raw, k IN (1, 2) AS leftover FROM f",
    "p11_key_pairs": "SELECT '/a/b' || p_partkey || '/' || CASE WHEN p_partkey % 3 = 0 THEN 'notes' ELSE 'SITE_' || lpad(CAST(p_size AS VARCHAR), 3, '0') END || '.zip' AS path, CASE WHEN p_partkey % 3 > 0 THEN lpad(CAST(p_size AS VARCHAR), 3, '0') END AS key, CASE WHEN p_partkey % 3 = 0 THEN 'no key in the name' END AS warning FROM part",
    "a17_unique_keys": "SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS key FROM orders WHERE o_custkey % 5 > 0",
    "l01_report_order": "SELECT p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY p_size, CASE p_partkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'A' ELSE '_x' END, CASE WHEN p_partkey % 5 = 0 THEN 0 ELSE p_partkey END, CASE WHEN p_partkey % 5 = 0 THEN 'r' || p_partkey ELSE CAST(p_partkey AS VARCHAR) END)::INTEGER AS place FROM part WHERE p_partkey % 11 > 0",
    "l06_candidate_order": "SELECT p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY CASE WHEN p_partkey % 11 > 0 THEN p_size ELSE 999 END, CASE WHEN p_partkey % 11 = 0 OR p_partkey % 3 = 0 THEN '' WHEN p_partkey % 3 = 1 THEN 'A' ELSE '_x' END, CASE WHEN p_partkey % 5 = 0 THEN 'r' || p_partkey ELSE CAST(p_partkey AS VARCHAR) END)::INTEGER AS place FROM part",
    "l05_upload_order": f"{_D} SELECT doc_id, row_number() OVER (PARTITION BY site ORDER BY CASE WHEN lower(name) LIKE 'readme.%' THEN 0 WHEN name = 'c.zip' THEN 2 ELSE 1 END, name, doc_id)::INTEGER AS place FROM d",
    "l07_item_order": f"{_D} SELECT doc_id, row_number() OVER (PARTITION BY site ORDER BY CASE name WHEN 'b.WAV' THEN 0 WHEN 'a.wav' THEN 1 ELSE 2 END, name, doc_id)::INTEGER AS place FROM d",
    "i04_sentinel_backfill": f"SELECT o_orderkey AS site FROM ({judging.ORACLE_SQL['v02_day_completeness']}) WHERE verdict = 'Yes' AND o_orderkey % 2 = 1",
    "m01_internal_manifest": "SELECT source AS site, CAST(doc_id AS VARCHAR) AS name, ['generated', 'companion', 'item'][doc_id % 3 + 1] AS role, CAST(round_even(n_chars / 1024.0::DOUBLE, 2)::DECIMAL(30,2) AS VARCHAR) AS size_kb, n_chars AS bytes, CASE WHEN doc_id % 4 > 0 THEN md5(text) END AS sha512 FROM documents",
    "m02_external_manifest": f"{_DAYS} SELECT site, 0 AS rank, site || '_' || day AS name, bytes, 'archive' AS notes FROM a UNION ALL SELECT e.site, 1, name, e.bytes, CASE WHEN day IS NULL THEN '' ELSE 'in ' || a.site || '_' || day END FROM e LEFT JOIN a ON e.site = a.site AND strftime(ts, '%Y_%m_%d') = day",
    "m03_upload_set": f"{_D} SELECT site, name, CAST(round_even(bytes / 1024.0::DOUBLE, 2)::DECIMAL(30,2) AS VARCHAR) AS size_kb, CASE WHEN name = 'c.zip' THEN 'archive' WHEN name = 'readme.html' THEN 'readme' WHEN name IN ('a.wav', 'b.WAV', 'f.Wav') THEN 'recording' ELSE 'companion' END AS notes FROM d WHERE name NOT IN ('in.xlsx', 'README.md')",
    "m04_required_files": f"{_D} SELECT site, name, md5(text) AS sha512, 'raw' AS kind FROM d WHERE doc_id % 2 = 0 AND name IN ('a.wav', 'b.WAV', 'f.Wav') UNION ALL SELECT site, name, NULL, 'companion' FROM d WHERE doc_id % 2 = 1 AND name NOT IN ('a.wav', 'b.WAV', 'f.Wav', 'c.zip')",
    "m07_references": "SELECT c_name AS reference FROM customer WHERE c_custkey % 4 > 1",
    "m09_people_and_fundings": "SELECT c_custkey, CAST(c_nationkey AS VARCHAR) AS funder, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment ELSE '' END AS title, c_name AS number, CASE WHEN c_custkey % 3 > 0 THEN 'https://x/' || c_custkey END AS url, c_name || ', ' || c_mktsegment AS person, CASE WHEN c_custkey % 2 > 0 THEN 1 END::INTEGER AS n_ids, CAST(c_custkey AS VARCHAR) AS affiliation FROM customer",
    "m11_put_body": "SELECT o_orderkey AS id, 'access,files,metadata' AS keys, o_orderpriority AS files, CASE WHEN o_orderkey % 2 = 0 THEN 'open' ELSE 'restricted' END AS access, o_orderstatus AS metadata FROM orders",
    "s13_scan_logs": "WITH l AS (SELECT p_partkey AS line_no, 'run ' || ['SITE ', 'SITE_', 'site ', '(SITE '][p_partkey % 4 + 1] || CASE WHEN p_partkey % 3 = 0 THEN CAST(p_size AS VARCHAR) ELSE lpad(CAST(p_size AS VARCHAR), 3, '0') END || CASE WHEN p_partkey % 5 = 0 THEN '_x' ELSE ' ' END || p_type AS line FROM part), k AS (SELECT lpad(CAST(n_nationkey + 1 AS VARCHAR), 3, '0') AS key, n_nationkey + 1 AS n FROM nation), h AS (SELECT key, line_no, line FROM l, k WHERE contains(line, 'SITE ' || key) OR contains(line, 'SITE_' || key) OR contains(line, 'SITE ' || n)), w AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY line_no DESC) AS r FROM h WHERE contains(line, 'STEEL') OR contains(line, 'COPPER')) SELECT key, count(*) AS n, 'lines' AS kind FROM h GROUP BY key UNION ALL SELECT key, line_no, 'last' FROM w WHERE r <= 3",
    "w04_last_texts": "SELECT conv_id AS key, turn AS line_no, md5(line) AS line FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS r FROM (SELECT conv_id, turn, min(text) AS line FROM conversations GROUP BY ALL)) WHERE r <= 2",
    "v08_suggested_action": f"SELECT o_orderkey, action FROM ({judging.ORACLE_SQL['v08_missing_state_cause']}) JOIN (VALUES {_ACTIONS}) a(cause, action) ON verdict = cause",
    "v07_from_listing": """WITH c AS (SELECT c_custkey AS c, CASE c_custkey % 3 WHEN 0 THEN lpad((c_custkey % 1000)::VARCHAR, 3, '0') WHEN 1 THEN lpad(c_nationkey::VARCHAR, 3, '0') END AS key, CASE WHEN c_custkey % 13 > 0 THEN c_custkey::VARCHAR END AS id FROM customer),
v AS (SELECT *, CASE WHEN key IS NULL THEN 'UNPARSABLE_TITLE' WHEN c % 5 = 1 THEN 'UNKNOWN_DRAFT_STATE' WHEN c % 5 = 0 THEN 'PUBLISHED' WHEN id IS NULL THEN 'NO_ID' ELSE 'CANDIDATE' END AS verdict FROM c)
SELECT verdict, key, count(*) AS n, min(id) AS first FROM v GROUP BY verdict, key""",
    "v10_from_folders": """WITH c AS (SELECT c_custkey AS c, c_custkey % 40 AS key FROM customer),
t AS (SELECT key, arg_min(c, (c % 4 = 0, c % 5, 'T' || c)) AS t FROM c WHERE c % 3 > 0 AND key % 8 > 0 GROUP BY key)
SELECT 'L' || c AS place, 'T' || t AS twin, CASE WHEN t IS NULL THEN 'NO_TWIN' WHEN t % 4 = 0 AND t % 2 = 0 THEN 'UPLOADED_TWIN_NO_SENTINEL' WHEN t % 4 = 0 THEN 'TWIN_NO_SENTINEL' WHEN c % 7 = 0 OR t % 9 = 0 THEN 'CANNOT_VERIFY'
  WHEN c % 11 = 0 OR t % 13 = 0 THEN 'CANNOT_VERIFY' WHEN c % 5 > 0 THEN 'VERIFIED_DUPLICATE' ELSE 'CANNOT_VERIFY' END AS verdict FROM c LEFT JOIN t USING (key) WHERE c % 3 = 0""",
    "v09_from_folders": """WITH d AS (SELECT doc_id % 50 AS b, doc_id, n_chars AS bytes FROM documents),
r AS (SELECT *, row_number() OVER w - 1 AS i, coalesce(sum(bytes) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, sum(bytes) OVER (PARTITION BY b) AS total FROM d WINDOW w AS (PARTITION BY b ORDER BY doc_id)),
c AS (SELECT b, i AS cut FROM r WHERE i > 0 QUALIFY row_number() OVER (PARTITION BY b ORDER BY abs(2 * before - total), i DESC) = 1),
f AS (SELECT b, any_value(cut) AS cut, coalesce(sum(bytes) FILTER (WHERE i < cut), 0)::BIGINT + 10 AS b1, coalesce(sum(bytes) FILTER (WHERE i >= cut), 0)::BIGINT + 10 AS b2, b % 7 > 0 AND b % 5 IN (2, 3) AS held FROM r LEFT JOIN c USING (b) GROUP BY b)
SELECT lpad(b::VARCHAR, 3, '0') AS base, CASE WHEN b % 11 = 0 THEN 'NOT_TWO_PARTS' WHEN b % 7 = 0 THEN 'PART2_MISSING' WHEN b % 17 = 5 THEN 'PART2_BOUND' WHEN b % 13 = 4 THEN 'UNTRUSTED_SIZES' WHEN cut IS NULL THEN 'TOO_FEW_ITEMS' WHEN b % 10 = 2 THEN 'NAME_COLLISION'
  WHEN b % 5 = 3 THEN 'PART2_UNEXPECTED' WHEN b % 5 = 2 THEN 'PART2_NEEDS_RESUME' WHEN b1 > 40000 OR b2 > 40000 THEN 'STILL_OVERSIZED' ELSE 'SPLIT_PLANNED' END AS verdict, cut, b1 AS bytes1, b2 AS bytes2, CASE WHEN held THEN 1 ELSE 0 END::BIGINT AS n_in_part2 FROM f""",
    "v08_from_evidence": f"""WITH o AS (SELECT o_custkey AS site, o_orderkey AS k, o_orderpriority AS p FROM orders),
e AS (SELECT site, bool_or(k % 41 = 0) AS log, max(k::VARCHAR) FILTER (WHERE k % 82 = 0) AS log_id, bool_or(k % 53 = 0) AS doc, bool_or(k % 47 = 0) AS success, max_by(p, k) FILTER (WHERE k % 3 = 0) AS failure, bool_or(k % 2 = 1) AS archive, bool_or(k % 2 = 1 AND k % 11 = 0) AS done FROM o GROUP BY site),
f AS (SELECT c_custkey AS site, coalesce(log, false) AS log, log_id, coalesce(doc, false) AS doc, coalesce(success, false) AS success, failure, coalesce(archive, false) AS archive, coalesce(done, false) AS done, c_nationkey % 2 = 0 AS row FROM customer LEFT JOIN e ON site = c_custkey),
v AS (SELECT *, CASE WHEN log_id IS NOT NULL THEN 'state lost, id in the log' WHEN log THEN 'log unreadable' WHEN doc THEN 'creation failed' WHEN success THEN 'prepared again after success' WHEN NOT archive THEN 'no archive' WHEN done THEN 'in the done-set' WHEN NOT row THEN 'no metadata row' WHEN failure > '' THEN 'failed before creation' ELSE 'no evidence' END AS verdict FROM f)
SELECT site, CASE verdict WHEN 'state lost, id in the log' THEN verdict || ': record ' || log_id WHEN 'failed before creation' THEN verdict || ': ' || failure ELSE verdict END AS cause, action FROM v JOIN (VALUES {_ACTIONS}) a(cause, action) ON verdict = a.cause""",
    "v08_cause_text": f"SELECT o_orderkey, CASE verdict WHEN 'state lost, id in the log' THEN verdict || ': record r' WHEN 'failed before creation' THEN verdict || ': timeout' ELSE verdict END AS cause FROM ({judging.ORACLE_SQL['v08_missing_state_cause']})",
    "v05_from_entries": """WITH d AS (SELECT doc_id % 97 AS k, doc_id, doc_id // 97 % 3 = 0 AS companion, doc_id || CASE WHEN doc_id // 97 % 3 = 0 THEN '.txt' ELSE '.wav' END AS name FROM documents),
e AS (SELECT *, (k % 6 = 0 OR (companion AND (k % 4 > 0 OR doc_id % 5 > 0))) AND doc_id % 11 > 0 AS done FROM d),
f AS (SELECT k, count(*) FILTER (WHERE NOT companion) AS raw, count(*) FILTER (WHERE NOT companion AND done) AS held, count(*) FILTER (WHERE companion AND k % 13 > 0) AS beside,
  coalesce(list_sort(list(name) FILTER (WHERE companion AND k % 13 > 0 AND NOT done)), []) AS absent, coalesce(list_sort(list(name) FILTER (WHERE NOT companion AND done)), []) AS stray FROM e GROUP BY k),
v AS (SELECT *, CASE WHEN k % 14 = 0 THEN 'ALREADY_COMMITTED' WHEN raw = 0 OR beside = 0 THEN 'MANIFESTS_MISSING' WHEN k % 10 = 3 THEN 'RESUMABLE' WHEN len(absent) > 0 THEN 'COMPANIONS_MISSING' WHEN len(stray) > 0 THEN 'PARTIALLY_CONVERTED' ELSE 'CONVERTIBLE' END AS verdict FROM f)
SELECT 'S' || k AS site, verdict, CASE verdict WHEN 'ALREADY_COMMITTED' THEN 'the record holds the archive' WHEN 'MANIFESTS_MISSING' THEN raw || ' raw files and ' || beside || ' companions are known; without both nothing can be decided' WHEN 'RESUMABLE' THEN 'file by file; ' || held || '/' || raw || ' raw files committed'
  WHEN 'COMPANIONS_MISSING' THEN len(absent) || ' companions not committed: ' || array_to_string(absent[1:5], ', ') WHEN 'PARTIALLY_CONVERTED' THEN len(stray) || ' raw files on the record of a site that is not file by file: ' || array_to_string(stray[1:5], ', ') ELSE 'all companions are committed, the archive is not' END AS note FROM v""",
    "v06_local_notes": "WITH f AS (SELECT o_orderkey, {FACTS} FROM orders), v AS (SELECT *, {RULE} AS verdict FROM f) SELECT o_orderkey, CASE verdict WHEN 'AMBIGUOUS_FOLDER' THEN '2 prepared folders: s1, s2' WHEN 'NO_STAGING' THEN 'no prepared folder' WHEN 'PREP_INCOMPLETE' THEN 'the mark of a finished folder is absent' WHEN 'UNSUPPORTED_LAYOUT' THEN 'archives are laid out as per_day; one archive is needed' WHEN 'MANIFESTS_MISSING' THEN n_raw || ' raw files and ' || n_companions || ' companions are known; both are needed' WHEN 'TOO_MANY_FILES' THEN (n_raw + n_companions) || ' files (' || n_raw || ' raw, ' || n_companions || ' companions), at most 96: split into two' WHEN 'NO_RAW_FOLDER' THEN 'no raw folder' WHEN 'RAW_FILES_MISSING' THEN '1 listed raw files are not there: ' || o_orderkey WHEN 'UPLOADED_TWIN' THEN 'an uploaded folder of the site exists' WHEN 'STATE_MISMATCH' THEN 'the state names record a, the draft is b' ELSE '' END AS note FROM v".replace("{FACTS}", ", ".join(f"{sql} AS {c}" for c, sql in judging.FACTS["v06_local_verdict"][1].items())).replace("{RULE}", judging.FACTS["v06_local_verdict"][2]),
    "s14_s18_report": "SELECT CAST(c_custkey AS VARCHAR) AS n, c_name AS site, 'says \"' || c_mktsegment || '\", twice' AS note FROM customer",
    "s15_results": "SELECT CASE WHEN o_orderkey % 3 > 0 THEN 'success' ELSE 'failure' END AS outcome, count(*) AS n, count(DISTINCT o_orderkey) AS orders FROM orders GROUP BY 1",
    "s16_packed": f"WITH {reconciling._EVENTS} SELECT CAST(CAST(site AS BIGINT) % 7 AS VARCHAR) AS site, strftime(ts, '%Y_%m_%d') AS day, count(*) AS n, sum(bytes)::BIGINT AS bytes FROM e GROUP BY ALL",
    "v04_gate_from_files": f"""WITH {reconciling._EVENTS}, p AS (SELECT site, sum(n) AS n FROM ({reconciling._J02}) GROUP BY site),
f AS (SELECT site, max(event_id) % 2 = 1 AS bare, bool_or(event_id % 41 = 0) AS odd, bool_or(event_id % 3 = 0) AS daily, bool_or(event_id % 211 = 0) AS plain FROM e GROUP BY site),
g AS (SELECT site, concat_ws('; ', CASE WHEN bare THEN 'no sentinel' END, CASE WHEN daily AND plain THEN 'layout mixed' WHEN NOT daily AND NOT plain THEN 'layout none' WHEN n > 0 THEN 'manifest and archives differ' WHEN odd THEN 'digests differ' END) AS problems FROM f LEFT JOIN p USING (site))
SELECT site, problems, CASE WHEN problems = '' THEN 'pass' ELSE 'fail' END AS verdict FROM g""",
}
