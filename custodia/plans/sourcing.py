"""Queries of readers, and of verdicts whose facts readers find: tasks write files from the given tables, with faults, and they are read back."""

from __future__ import annotations

import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import keys
from ..functions.common import materialise, shared_dir, ship, table
from ..operators import audit, coverage, layout, logs, verdicts
from ..sources import files, sinks

#: Sites that documents are dealt to.
SITES = 60


def _store(root: str):
    """The file system of ``root`` and its path there."""
    from urllib.parse import urlparse

    from pyarrow import fs

    return fs.FileSystem.from_uri(root) if urlparse(root).scheme else (fs.LocalFileSystem(), root)


def _put(rows: DataFrame, root: str) -> None:
    """Tasks write (path below ``root``, data). A task that runs again writes the same; it holds one file's data beside a batch."""
    ship(rows.sparkSession)

    def run(batches):
        store, base = _store(root)
        made: set[str] = set()
        for b in batches:
            for path, data in zip(b.column("path"), b.column("data")):
                full = f"{base}/{path}"
                folder = full.rsplit("/", 1)[0]
                if folder not in made:
                    made = made if len(made) < 1024 else set()
                    store.create_dir(folder, recursive=True)
                    made.add(folder)
                with store.open_output_stream(full) as f:
                    f.write(data.as_py() or b"")
            yield b.slice(0, 0)

    rows = rows.select(F.col("path").cast("string").alias("path"), F.col("data").cast("binary").alias("data"))
    rows.mapInArrow(run, rows.schema).count()


def _put_small(rows: DataFrame, root: str) -> None:
    """Files of which there are many small ones: each costs an opening, so they are dealt evenly."""
    _put(rows.repartition(rows.sparkSession.sparkContext.defaultParallelism * 4, "path"), root)


def _pack(entries: DataFrame, root: str) -> None:
    """Tasks write (path of an archive below ``root``, name, data) as archives, their entries in the order of names; an empty name only says
    that the archive is there. Entries come sorted and each is written as it comes, so a task holds one entry's data beside a
    batch, however large the archive."""
    ship(entries.sparkSession)

    def run(batches):
        store, base = _store(root)
        at = out = z = None
        try:
            for b in batches:
                for path, name, data in zip(b.column("path"), b.column("name"), b.column("data")):
                    path, name = path.as_py(), name.as_py()
                    if path != at:
                        if z is not None:
                            z.close()
                            out.close()
                        at, full = path, f"{base}/{path}"
                        store.create_dir(full.rsplit("/", 1)[0], recursive=True)
                        out = store.open_output_stream(full)
                        z = zipfile.ZipFile(out, "w")
                    if name:
                        z.writestr(name, data.as_py() or b"")
                yield b.slice(0, 0)
            if z is not None:
                z.close()
        finally:
            if out is not None and not out.closed:
                out.close()

    rows = entries.select("path", "name", F.col("data").cast("binary").alias("data"))
    rows.repartition("path").sortWithinPartitions("path", "name").mapInArrow(run, rows.schema).count()


def _new(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _items(spark: SparkSession, d: str) -> DataFrame:
    """Documents as items of sites: k, site, day, name, data."""
    return table(spark, d, "documents").selectExpr(
        "doc_id", f"doc_id % {SITES} AS k", f"concat('S', lpad(CAST(doc_id % {SITES} AS STRING), 3, '0')) AS site", f"concat('2024_01_0', 1 + doc_id div {SITES} % 3) AS day",
        f"concat('2024010', 1 + doc_id div {SITES} % 3, '_', lpad(CAST(doc_id AS STRING), 9, '0'), '.wav') AS name", "coalesce(text, '') AS data",
    )


def _tree(spark: SparkSession, d: str) -> str:
    """Raw and prepared folders of the sites. Which faults a site has follows from its number, which items are packed wrongly from theirs."""
    root, it = _new(spark, "tree"), _items(spark, d)
    sites = it.select("k", "site").distinct()
    plain = it.selectExpr("concat('raw/', site, '/', name) AS path", "data")
    plain = plain.unionByName(sites.where("k % 5 > 0").selectExpr("concat('raw/', site, '/CONFIG.TXT') AS path", "'gain' AS data"))
    plain = plain.unionByName(sites.where("k % 11 = 3").selectExpr("concat('raw/', site, '/notes.wav') AS path", "'?' AS data"))
    plain = plain.unionByName(sites.where("k % 3 = 1").selectExpr("concat('raw/', site, '/._x.wav') AS path", "'' AS data"))

    staged = it.where("k % 7 > 0")
    daily = staged.where("k % 7 > 1 AND NOT (k % 12 = 7 AND day = '2024_01_03')").withColumn("path", F.expr("concat('staged/', site, '/', site, '_', day, '.zip')"))
    single = staged.where("k % 7 = 1 OR k % 13 = 5").withColumn("path", F.expr("concat('staged/', site, '/', site, '.zip')"))
    own = daily.unionByName(single).where("k % 19 <> 4 AND doc_id % 29 <> 7").selectExpr("path", "concat(day, '/', name) AS name", "concat(data, CASE WHEN doc_id % 31 = 11 THEN 'x' ELSE '' END) AS data")
    ones = single.select("k", "path").distinct()
    zips = daily.select("k", "path").distinct().unionByName(ones)
    config = zips.where("k % 19 <> 4").selectExpr("path", "CASE WHEN k % 5 > 0 AND k % 14 <> 6 THEN 'CONFIG.txt' ELSE '' END AS name", "'gain' AS data")
    beside = ones.where("k % 19 <> 4").selectExpr("path", "explode(array('file_list.csv', 'aa.txt', 'related_identifiers.csv')) AS name", "'' AS data")
    bad = zips.where("k % 19 = 4").selectExpr("path", "'not an archive' AS data")
    sites = sites.where("k % 7 > 0")
    odd = sites.where("k % 10 = 9 AND k % 7 > 1").selectExpr("concat('staged/', site, '/', site, '_2030_01_01.zip') AS path", "'z' AS name", "'' AS data")
    names = "array_compact(array('README.html', 'file_list.csv', 'manifest.csv', CASE WHEN k % 17 <> 3 THEN 'aa.txt' END, CASE WHEN k % 9 <> 2 THEN 'related_identifiers.csv' END, CASE WHEN k % 4 = 0 THEN '.prep_complete' END))"
    folder = sites.selectExpr("site", f"explode({names}) AS name").selectExpr("concat('staged/', site, '/', name) AS path", "concat(site, name) AS data")
    _put(plain.unionByName(bad).unionByName(folder), root)
    _pack(own.unionByName(config).unionByName(beside).unionByName(odd), root)
    return root


_CONTRACT = audit.Contract(companions=("aa.txt",))


def _listed(spark: SparkSession, root: str, side: str) -> DataFrame:
    """An inventory with paths, listed once."""
    found = files.read_inventory(spark, f"{root}/{side}").select("*", F.concat(F.lit(f"{root}/{side}/"), "site", F.lit("/"), "name").alias("path"))
    return materialise(found, "listing")


def s01(spark, d):
    return files.read_inventory(spark, f"{_tree(spark, d)}/raw").where("site LIKE 'S0%'").select("site", "name", "bytes", "sidecar", "error", (F.col("mtime") > F.lit("2020-01-01")).alias("dated"))


def s02(spark, d):
    zips = _listed(spark, _tree(spark, d), "staged").where("name LIKE '%.zip'")
    return files.read_archive_index(zips).select("site", F.col("archive").isNotNull().alias("named"), "name", "bytes", "error")


def s03(spark, d):
    raw = _listed(spark, _tree(spark, d), "raw").where("name LIKE '2024%'")
    return files.read_headers(raw).select("site", F.regexp_extract("path", "([^/]+)$", 1).alias("name"), F.hex("header").alias("header"))


def s04(spark, d):
    raw = _listed(spark, _tree(spark, d), "raw").where("name LIKE '2024%'")
    return files.hash_files(raw).select("site", F.regexp_extract("path", "([^/]+)$", 1).alias("name"), "md5", F.length("sha512").alias("n"), "error")


def s05(spark, d):
    """Tables of every encoding and separator, with quoted fields over several lines, read by ranges of a few kilobytes."""
    q = lambda c: f"concat('\"', replace({c}, '\"', '\"\"'), '\"')"
    rows = table(spark, d, "customer").selectExpr("c_nationkey AS k", "c_custkey", f"concat_ws(CASE WHEN c_nationkey % 2 = 0 THEN ',' ELSE ';' END, c_custkey, {q('concat(c_name, chr(10), c_mktsegment, chr(34))')}, concat(c_mktsegment, ' é')) AS line")
    text = rows.groupBy("k").agg(F.array_sort(F.collect_list(F.struct("c_custkey", "line"))).alias("r")).selectExpr("k", "concat_ws(chr(13) || chr(10), CASE WHEN k % 2 = 0 THEN 'Site#,Name, Part ' ELSE 'Site#;Name;Part' END, array_join(r.line, chr(13) || chr(10)))  AS t")
    root = _new(spark, "tables")
    _put(text.selectExpr("concat('t', k, '.csv') AS path", "CASE k % 3 WHEN 0 THEN encode(t, 'UTF-8') WHEN 1 THEN encode(t, 'ISO-8859-1') ELSE concat(X'EFBBBF', encode(t, 'UTF-8')) END AS data"), root)
    found = files.read_dirty_csv(spark, root, 4096)
    key = files.choose_key_column(found.columns)
    return found.select(keys.parse_key_cell(key)["key"].alias("key"), F.col(key).alias("cell"), "Name", "Part")


def s07(spark, d):
    root = _new(spark, "lists")
    lines = table(spark, d, "nation").groupBy("n_regionkey").agg(F.array_sort(F.collect_list(F.expr("concat(CASE WHEN n_nationkey % 3 = 0 THEN '# ' WHEN n_nationkey % 3 = 1 THEN '' ELSE '  ' END, CASE WHEN n_nationkey % 4 = 0 THEN '' ELSE n_name END, ',\"says \"\"', n_nationkey, '\"\"\"')"))).alias("r"))
    _put(lines.selectExpr("concat('l', n_regionkey, '.csv') AS path", "concat('File Name,Note', chr(10), '# of region ', n_regionkey, chr(10), array_join(r, chr(10))) AS data"), root)
    return files.read_companions(spark, root).select(F.trim("File Name").alias("name"), "Note")


def s08(spark, d):
    """State documents and request logs of customers, some broken, and the record ids that both give."""
    root = _new(spark, "states")
    c = table(spark, d, "customer")
    doc = "CASE c_custkey % 4 WHEN 0 THEN concat('{\"record_id\": ', c_nationkey, ', \"number_of_tries\": ', c_custkey % 5, '}') WHEN 1 THEN concat('{\"record_id\": \"', c_nationkey, '\", \"mode\": \"zip\"}') WHEN 2 THEN '{broken' ELSE '{\"record_id\": \"\"}' END"
    log = "CASE c_custkey % 3 WHEN 0 THEN concat('{\"id\": \"', c_custkey, '\"}') WHEN 1 THEN concat('{\"response\": {\"id\": ', c_custkey, '}, \"record_id\": \"\"}') ELSE 'no json' END"
    few = c.where("c_custkey % 10 < 4")
    rows = few.selectExpr("concat(c_custkey, '/upload_state.json') AS path", f"{doc} AS data")
    _put_small(rows.unionByName(c.where("c_custkey % 10 BETWEEN 2 AND 5").selectExpr("concat(c_custkey, '/request.json') AS path", f"{log} AS data")), root)
    docs, ids = materialise(files.read_state_docs(spark, f"{root}/*/upload_state.json"), "states"), files.read_request_logs(spark, f"{root}/*/request.json")
    found = files.recovered_ids(docs, ids).withColumnRenamed("record_id", "recovered")
    return found.join(docs.select("site", "tries", "mode", "note"), "site", "left")


def s12(spark, d):
    """A done-set with blank lines and repeats, and results, logged in ranges of orders, of which each site's last row counts."""
    root = _new(spark, "done")
    o = table(spark, d, "orders")
    o.selectExpr("concat(CASE WHEN o_orderkey % 2 = 0 THEN ' ' ELSE '' END, '/a/', o_custkey, CASE WHEN o_orderkey % 3 = 0 THEN concat(chr(10), chr(10)) ELSE '' END) AS value").write.text(f"{root}/done")
    line = ("CASE WHEN o_custkey % 7 = 0 THEN 'n/a' ELSE concat('SITE ', o_custkey % 1000) END AS site", "CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE concat('failed', chr(10), o_orderkey) END AS error_message")
    o.repartitionByRange("o_orderkey").sortWithinPartitions("o_orderkey").selectExpr(*line).write.csv(f"{root}/results", header=True, quoteAll=True, escape='"')
    paths = files.read_done_set(spark, f"{root}/done").select(F.lit("done").alias("kind"), F.col("path").alias("key"), F.lit(None).cast("string").alias("message"))
    return paths.unionByName(files.read_results(spark, f"{root}/results").select(F.lit("result").alias("kind"), "key", F.replace("error_message", F.lit("\n"), F.lit(" ")).alias("message")))


def s13(spark, d):
    """Logs in several files, in the order of their names and lines."""
    root = _new(spark, "logs")
    text = table(spark, d, "part").selectExpr("p_partkey", "concat(' run ', p_partkey, CASE p_partkey % 4 WHEN 0 THEN ' SITE ' WHEN 1 THEN ' SITE_' WHEN 2 THEN ' site ' ELSE ' (SITE ' END, CASE WHEN p_partkey % 3 = 0 THEN CAST(p_size AS STRING) ELSE lpad(CAST(p_size AS STRING), 3, '0') END, CASE WHEN p_partkey % 5 = 0 THEN '_x' ELSE ' ' END, p_type) AS value")
    text.repartitionByRange(5, "p_partkey").sortWithinPartitions("p_partkey").select("value").write.text(root)
    spelt = table(spark, d, "nation").selectExpr("lpad(CAST(n_nationkey + 1 AS STRING), 3, '0') AS key").select("key", F.explode(logs.spellings("key")).alias("spelling"))
    counts, last = logs.scan_logs(files.read_log_lines(spark, root), spelt, ["STEEL", "COPPER"], 3)
    return counts.select("key", F.col("n_lines").alias("n"), F.lit(None).cast("string").alias("line")).unionByName(last.select("key", F.lit(None).cast("long").alias("n"), "line"))


def s17(spark, d):
    root = _new(spark, "config")
    rows = table(spark, d, "nation").groupBy("n_regionkey").agg(F.array_sort(F.collect_list("n_name")).alias("names"))
    _put(rows.selectExpr("concat(n_regionkey, '.json') AS path", "to_json(named_struct('project', n_regionkey, 'vocabulary', names), map('pretty', 'true')) AS data"), root)
    return files.read_config(spark, root).select("project", F.explode("vocabulary").alias("word"))


def v01(spark, d):
    """Completeness of every site, from listings and the archives that they leave open."""
    root = _tree(spark, d)
    return audit.prep_verdicts(_listed(spark, root, "raw"), _listed(spark, root, "staged"), files.read_archive_entries, _CONTRACT).select("site", "verdict")


def v01_all(spark, d):
    """The verdicts counted when marks of finished folders are not believed."""
    root = _tree(spark, d)
    return coverage.verdict_counts(audit.prep_verdicts(_listed(spark, root, "raw"), _listed(spark, root, "staged"), files.read_archive_entries, _CONTRACT, audit_all=True))


def v13(spark, d):
    """What to prepare again: sites whose verdict from files is No, but those that another listing shows as uploaded."""
    found = v01(spark, d).withColumnRenamed("verdict", "status")
    k = F.substring("site", 2, 3).cast("int")
    uploaded = _items(spark, d).where("k % 6 = 5").select("site").distinct().withColumn("uploaded", F.lit(True))
    raw = _items(spark, d).where("doc_id % 3 > 0").select("site").distinct().withColumn("has_raw", F.lit(True))
    facts = found.join(uploaded, "site", "left").join(raw, "site", "left").fillna(False, ["uploaded", "has_raw"])
    return verdicts.reprep_plan(facts).select("site", k.alias("k"), "verdict")


def v14(spark, d):
    """Stuck sites and whether to change their strategy: state documents on disk, archives by name, and companions on the record."""
    root = _new(spark, "stuck")
    c = table(spark, d, "customer").where("c_custkey % 10 < 8").selectExpr("c_custkey AS c", "CAST(c_custkey AS STRING) AS site")
    doc = "CASE WHEN c % 7 = 0 THEN '{' WHEN c % 5 = 0 THEN '{\"number_of_tries\": 9}' ELSE concat('{\"record_id\": \"', c, '\", \"number_of_tries\": ', c % 6, '}') END"
    _put_small(c.where("c % 10 < 6").selectExpr("concat(site, '/upload_state.json') AS path", f"{doc} AS data"), root)
    states = files.read_state_docs(spark, f"{root}/*/upload_state.json")
    zips = c.where("c % 11 > 0").selectExpr("site", "concat(site, '.zip') AS name").unionByName(c.where("c % 13 = 1").selectExpr("site", "concat(site, '_2024_01_01.zip') AS name"))
    rows = table(spark, d, "orders").selectExpr("CAST(o_custkey AS STRING) AS site", "concat(o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN '.wav' ELSE '.txt' END) AS name", "o_orderkey AS k", "'completed' AS status")
    entries = rows.where("k % 50 > 0 AND k % 3 > 0").unionByName(c.where("c % 17 = 2").selectExpr("site", "concat(site, '.zip') AS name", "c AS k", "'completed' AS status"))
    facts = verdicts.draft_facts(entries, rows.where("k % 3 = 0"), rows.where("k % 3 > 0"), c.selectExpr("site", "concat(site, '.zip') AS archive"), c.limit(0))
    lacking = facts.select("site", (~F.col("archive_committed") & (F.col("n_companions_absent") == 0) & (F.col("n_companions") > 0)).alias("only_archive_missing"))
    found = c.join(states.withColumn("has_state", F.lit(True)), "site", "left").join(layout.layout_mode(zips).withColumnRenamed("mode", "layout"), "site", "left").join(lacking, "site", "left")
    found = found.fillna(False, ["has_state", "only_archive_missing"]).fillna("none", ["layout"]).withColumn("readable", F.col("note").isNull()).withColumn("tries", F.coalesce(F.col("tries").try_cast("int"), F.lit(0)))
    return verdicts.layout_refusal(verdicts.strategy_switch(verdicts.stuck_sites(found))).select("site", "verdict", "switch", "reason")


def _packed(spark, root):
    """Raw files, prepared files, archives and entries of sites that are not packed as one."""
    daily = F.substring("site", 2, 3).cast("int") % 7 > 1
    raw, staged = (_listed(spark, root, x).where(daily) for x in ("raw", "staged"))
    zips = audit._zips(staged).where("day IS NOT NULL")
    return raw, staged, zips, materialise(files.read_archive_entries(zips), "entries")


def v03(spark, d):
    raw, _, zips, entries = _packed(spark, _tree(spark, d))
    return audit.source_rows(raw.withColumn("discrepancy", F.lit(None).cast("string")), zips, entries)


def v04(spark, d):
    """The gate of sites packed by day: a manifest and digests with faults, held against archives and files; only sound sites are hashed."""
    raw, staged, _, entries = _packed(spark, _tree(spark, d))
    k = F.substring("site", 2, 3).cast("int")
    number = F.regexp_extract("name", "_([0-9]+)[.]wav$", 1).cast("long")
    manifest = raw.where(F.col("name").like("2024%") & (number % 37 != 5) & (k % 16 != 2)).select("site", "name", "bytes", F.lit("").alias("kb_text"))
    names = staged.select("site").distinct().select("site", F.explode(F.array(F.lit("aa.txt"), F.lit("README.html"))).alias("name"))
    digests = names.select("site", "name", F.sha2(F.concat("site", F.when((k % 6 == 1) & (F.col("name") == "aa.txt"), "other").otherwise(F.col("name"))), 512).alias("digest"))
    return audit.gate_verdicts(staged, manifest, entries, digests, files.hash_files, _CONTRACT)


QUERIES = {
    "s01_inventory": s01, "s02_archive_index": s02, "s03_headers": s03, "s04_hashes": s04, "s05_s06_dirty_tables": s05, "s07_companions": s07, "s08_s09_states": s08, "s12_done_and_results": s12, "s13_log_files": s13, "s17_config": s17,
    "v01_v02_from_files": v01, "v01_a16_audit_all": v01_all, "v13_from_verdicts": v13, "v14_v15_v17_from_states": v14, "v03_from_files": v03, "v04_staged_gate": v04,
}

_D = f"""d AS (SELECT doc_id, doc_id % {SITES} AS k, 'S' || lpad((doc_id % {SITES})::VARCHAR, 3, '0') AS site, 1 + doc_id // {SITES} % 3 AS day,
  '2024010' || (1 + doc_id // {SITES} % 3) || '_' || lpad(doc_id::VARCHAR, 9, '0') || '.wav' AS name, coalesce(text, '') AS t FROM documents)"""
_V01 = f"""WITH {_D}, s AS (SELECT k, site, bool_or(doc_id % 29 = 7) AS omitted, bool_or(day = 3) AS third FROM d GROUP BY ALL),
f AS (SELECT site, k % 7 = 0 AS absent, k % 4 = 0 AS sure, k % 13 = 5 AND k % 7 > 1 AS mixed, k % 7 = 1 AS single, k % 11 = 3 AS undatable, k % 19 = 4 AS unreadable, k % 5 > 0 AS config,
  k % 17 = 3 AS short, k % 9 = 2 AS conditional, omitted, k % 10 = 9 AS stray, k % 12 = 7 AND third AS lost, k % 14 = 6 AND k % 5 > 0 AS bare FROM s)
SELECT site, CASE WHEN absent THEN 'No' WHEN sure AND TRUSTED THEN 'Yes' WHEN mixed THEN 'No'
  WHEN single AND unreadable THEN 'Ambiguous' WHEN single AND (short OR omitted OR bare) THEN 'No' WHEN single AND (conditional OR NOT config) THEN 'Ambiguous' WHEN single THEN 'Yes'
  WHEN undatable THEN 'Ambiguous' WHEN short OR stray OR lost OR (NOT unreadable AND (omitted OR bare)) THEN 'No' WHEN unreadable OR conditional OR NOT config THEN 'Ambiguous' ELSE 'Yes' END AS verdict FROM f"""

ORACLE_SQL = {
    "s01_inventory": f"""WITH {_D}, s AS (SELECT DISTINCT k, site FROM d), f AS (SELECT site, name, strlen(t) AS bytes FROM d UNION ALL SELECT site, 'CONFIG.TXT', 4 FROM s WHERE k % 5 > 0 UNION ALL SELECT site, 'notes.wav', 1 FROM s WHERE k % 11 = 3 UNION ALL SELECT site, '._x.wav', 0 FROM s WHERE k % 3 = 1)
SELECT site, name, bytes, name LIKE '._%' AND name LIKE '.%' AS sidecar, NULL::VARCHAR AS error, true AS dated FROM f""",
    "s02_archive_index": f"""WITH {_D}, s AS (SELECT DISTINCT k, site FROM d WHERE k % 7 > 0), g AS (SELECT site, name, strlen(t) + CASE WHEN doc_id % 31 = 11 THEN 1 ELSE 0 END AS bytes, doc_id, k, day FROM d WHERE k % 7 > 0 AND k % 19 <> 4 AND doc_id % 29 <> 7),
a AS (SELECT DISTINCT k, site, 'd' || day AS z FROM d WHERE k % 7 > 1 AND NOT (k % 12 = 7 AND day = 3) UNION ALL SELECT DISTINCT k, site, 'one' FROM d WHERE k % 7 = 1 OR (k % 13 = 5 AND k % 7 > 0)),
e AS (SELECT site, name, bytes FROM g WHERE k % 7 > 1 AND NOT (k % 12 = 7 AND day = 3) UNION ALL SELECT site, name, bytes FROM g WHERE k % 7 = 1 OR k % 13 = 5
  UNION ALL SELECT site, n, 0 FROM a, (VALUES ('file_list.csv'), ('aa.txt'), ('related_identifiers.csv')) v(n) WHERE z = 'one' AND k % 19 <> 4 UNION ALL SELECT site, 'CONFIG.txt', 4 FROM a WHERE k % 5 > 0 AND k % 14 <> 6 AND k % 19 <> 4
  UNION ALL SELECT site, 'z', 0 FROM s WHERE k % 10 = 9 AND k % 7 > 1 AND k % 19 <> 4)
SELECT site, true AS named, name, max(bytes) AS bytes, CASE WHEN count(*) > 1 THEN 'repeated name' END AS error FROM e GROUP BY site, name UNION ALL SELECT site, true, NULL, NULL, 'unreadable: BadZipFile' FROM a WHERE k % 19 = 4""",
    "s03_headers": f"WITH {_D} SELECT site, name, left(hex(encode(t)), 24) AS header FROM d",
    "s04_hashes": f"WITH {_D} SELECT site, name, md5(t) AS md5, 128::INTEGER AS n, NULL::VARCHAR AS error FROM d",
    "s05_s06_dirty_tables": "SELECT CASE WHEN c_custkey < 1000 THEN lpad(c_custkey::VARCHAR, 3, '0') END AS key, c_custkey::VARCHAR AS cell, c_name || chr(10) || c_mktsegment || '\"' AS Name, c_mktsegment || ' é' AS Part FROM customer",
    "s07_companions": "SELECT n_name AS name, 'says \"' || n_nationkey || '\"' AS Note FROM nation WHERE n_nationkey % 3 > 0 AND n_nationkey % 4 > 0",
    "s08_s09_states": """WITH c AS (SELECT c_custkey AS c, c_nationkey AS n, c_custkey % 10 < 4 AS s, c_custkey % 10 BETWEEN 2 AND 5 AS l FROM customer)
SELECT c::VARCHAR AS site, coalesce(CASE WHEN s AND c % 4 < 2 THEN n::VARCHAR END, CASE WHEN l AND c % 3 < 2 THEN c::VARCHAR END) AS recovered, CASE WHEN NOT s OR c % 4 = 2 THEN NULL WHEN c % 4 = 0 THEN (c % 5)::VARCHAR ELSE '0 (legacy)' END AS tries,
CASE WHEN s AND c % 4 = 1 THEN 'zip' END AS mode, CASE WHEN s AND c % 4 = 2 THEN 'unreadable' END AS note FROM c WHERE s OR l""",
    "s12_done_and_results": """WITH r AS (SELECT lpad((o_custkey % 1000)::VARCHAR, 3, '0') AS key, o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE 'failed ' || o_orderkey END AS message FROM orders WHERE o_custkey % 7 > 0)
SELECT DISTINCT 'done' AS kind, '/a/' || o_custkey AS key, NULL::VARCHAR AS message FROM orders UNION ALL SELECT 'result', key, max_by(message, o_orderkey) FROM r GROUP BY key""",
    "s13_log_files": """WITH l AS (SELECT p_partkey AS p, 'run ' || p_partkey || [' SITE ', ' SITE_', ' site ', ' (SITE '][p_partkey % 4 + 1] || CASE WHEN p_partkey % 3 = 0 THEN p_size::VARCHAR ELSE lpad(p_size::VARCHAR, 3, '0') END || CASE WHEN p_partkey % 5 = 0 THEN '_x' ELSE ' ' END || p_type AS line FROM part),
k AS (SELECT lpad((n_nationkey + 1)::VARCHAR, 3, '0') AS key, n_nationkey + 1 AS n FROM nation),
h AS (SELECT key, p, line FROM l, k WHERE contains(line, 'SITE ' || key) OR contains(line, 'SITE_' || key) OR contains(line, 'SITE ' || n)),
w AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY p DESC) AS r FROM h WHERE contains(line, 'STEEL') OR contains(line, 'COPPER'))
SELECT key, count(*) AS n, NULL::VARCHAR AS line FROM h GROUP BY key UNION ALL SELECT key, NULL, line FROM w WHERE r <= 3""",
    "s17_config": "SELECT n_regionkey::BIGINT AS project, n_name AS word FROM nation",
    "v01_v02_from_files": _V01.replace("TRUSTED", "true"),
    "v01_a16_audit_all": f"SELECT verdict, count(*) AS n FROM ({_V01.replace('TRUSTED', 'false')}) GROUP BY verdict",
    "v13_from_verdicts": f"""WITH {_D}, v AS ({_V01.replace('TRUSTED', 'true')}), r AS (SELECT DISTINCT site FROM d WHERE doc_id % 3 > 0)
SELECT site, substr(site, 2)::INTEGER AS k, CASE WHEN substr(site, 2)::INTEGER % 6 = 5 THEN 'skip: uploaded' WHEN site NOT IN (SELECT site FROM r) THEN 'skip: no raw folder' ELSE 'prepare' END AS verdict FROM v WHERE verdict = 'No'""",
    "v14_v15_v17_from_states": """WITH c AS (SELECT c_custkey AS c FROM customer WHERE c_custkey % 10 < 8),
o AS (SELECT o_custkey AS c, count(*) AS n, bool_and(o_orderkey % 50 > 0) AS whole FROM orders WHERE o_orderkey % 3 > 0 GROUP BY o_custkey),
f AS (SELECT c, c % 10 < 6 AS state, c % 11 = 0 AND c % 13 <> 1 AS bare, c % 13 = 1 AND c % 11 > 0 AS mixed, c % 13 = 1 AND c % 11 = 0 AS daily, coalesce(whole, false) AND c % 17 <> 2 AS lacking, CASE WHEN c % 10 >= 6 OR c % 7 = 0 THEN 0 WHEN c % 5 = 0 THEN 9 ELSE c % 6 END AS tries FROM c LEFT JOIN o USING (c))
SELECT c::VARCHAR AS site, CASE WHEN NOT state THEN 'without state' WHEN c % 7 = 0 THEN 'skip: unreadable' WHEN c % 5 = 0 THEN 'skip: no record' ELSE 'stuck' END AS verdict, tries >= 3 AND NOT bare AND NOT mixed AND NOT daily AND lacking AS switch,
CASE WHEN daily THEN 'archives are per day' WHEN mixed THEN 'single and daily archives together' WHEN bare THEN 'no archive' END AS reason FROM f""",
    "v03_from_files": f"""WITH {_D}, a AS (SELECT *, k % 12 = 7 AND day = 3 AS lost FROM d WHERE k % 7 > 1),
s AS (SELECT k, site, bool_or(lost) AS lost, bool_or(t = '') AS zero, bool_or(NOT lost AND (k % 19 = 4 OR doc_id % 29 = 7 OR doc_id % 31 = 11)) AS odd, bool_or(NOT lost) AS any_archive FROM a GROUP BY ALL)
SELECT site, code, severity FROM s, (VALUES ('cross-check failed', 'problem'), ('day archive missing', 'problem'), ('stale day archive', 'problem'), ('archive differs from source', 'problem'), ('configuration missing', 'problem'), ('zero-byte items', 'warning')) c(code, severity)
WHERE CASE code WHEN 'cross-check failed' THEN k % 11 = 3 WHEN 'day archive missing' THEN lost WHEN 'stale day archive' THEN k % 10 = 9 WHEN 'archive differs from source' THEN odd WHEN 'configuration missing' THEN any_archive AND k % 5 > 0 AND (k % 14 = 6 OR k % 19 = 4) ELSE zero END""",
    "v04_staged_gate": f"""WITH {_D}, a AS (SELECT *, k % 12 = 7 AND day = 3 AS lost, k % 16 <> 2 AND doc_id % 37 <> 5 AS listed, k % 19 <> 4 AND doc_id % 29 <> 7 AS there FROM d WHERE k % 7 > 1),
s AS (SELECT k, site, bool_or(listed) AS manifest, bool_or(CASE WHEN lost THEN listed ELSE listed <> there OR (listed AND doc_id % 31 = 11) END) OR k % 10 = 9 OR max(n) = 0 AS odd
  FROM (SELECT *, min(CASE WHEN lost THEN 1 ELSE m END) OVER (PARTITION BY site) AS n FROM (SELECT *, count(*) FILTER (WHERE listed) OVER (PARTITION BY site, day) AS m FROM a)) GROUP BY k, site),
p AS (SELECT k, site, concat_ws('; ', CASE WHEN k % 4 > 0 THEN 'no sentinel' END, CASE WHEN k % 13 = 5 THEN 'layout mixed' ELSE concat_ws('; ', CASE WHEN k % 19 = 4 THEN 'unreadable archive' END, CASE WHEN NOT manifest THEN 'no manifest' END, CASE WHEN odd THEN 'manifest and archives differ' END) END) AS structure FROM s),
q AS (SELECT k, site, regexp_replace(structure, '; $', '') AS structure FROM p)
SELECT site, CASE WHEN structure = '' AND (k % 6 = 1 OR k % 17 = 3) THEN 'digests differ' ELSE structure END AS problems, CASE WHEN structure = '' AND NOT (k % 6 = 1 OR k % 17 = 3) THEN 'pass' ELSE 'fail' END AS verdict,
CASE WHEN structure > '' THEN 0 WHEN k % 17 = 3 THEN 1 ELSE 2 END::BIGINT AS n_hashed FROM q""",
}
