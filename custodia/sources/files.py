"""Readers for files: inventories, archive indexes, headers, digests, tolerant tables, JSON documents and logs.

What a task opens itself it opens through ``open_path``: a path that every executor sees. Whole files are read in pieces.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.common import materialise
from ..functions.keys import parse_key_cell
from ..functions.text import pick_column
from ..operators.state import last_wins
from .dealing import deal_by_bytes
from .inventory import read_inventory  # noqa: F401
from .opening import open_path
from .tables import read_dirty_csv  # noqa: F401


def read_archive_entries(paths: DataFrame) -> DataFrame:
    """(site, path) of archives -> site, archive, n (place in the archive), name, bytes, comp_bytes, method, crc, error. Only the index
    at an archive's end is read; one that cannot be read is a row with an error. With a column ``bytes``, archives are dealt by it."""

    def run(batches):
        import zipfile

        for b in batches:
            for site, path in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                short = path.rsplit("/", 1)[-1]
                try:
                    with open_path(path) as f, zipfile.ZipFile(f) as z:
                        found, error = [(n, i) for n, i in enumerate(z.infolist()) if not i.is_dir()], None
                except Exception as e:  # whatever an archive is, it must not end the scan of the others
                    found, error = [], f"unreadable: {type(e).__name__}"
                for at in range(0, len(found), _ROWS) if error is None else (0,):
                    rows = [(site, short, n, i.filename.rsplit("/", 1)[-1], i.file_size, i.compress_size, i.compress_type, i.CRC, None) for n, i in found[at : at + _ROWS]]
                    rows = rows or [(site, short, None, None, None, None, None, None, error)]
                    yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), _ENTRY)], names=["site", "archive", "n", "name", "bytes", "comp_bytes", "method", "crc", "error"])

    return _dealt(paths).mapInArrow(run, "site string, archive string, n int, name string, bytes long, comp_bytes long, method int, crc long, error string")


_ENTRY = [pa.string(), pa.string(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.string()]
#: Rows of a batch of entries.
_ROWS = 1 << 14


def read_archive_index(paths: DataFrame) -> DataFrame:
    """The entries of all archives of a site as one: site, archive, name, bytes, comp_bytes, method, crc, error. A base name seen twice,
    in one archive or in two, is reported, and the last one's size counts (by archive, then place). One unreadable archive
    voids the site, which then has error rows only. Each archive is read once."""
    found = materialise(read_archive_entries(paths), "archive-entries")
    bad = found.where("name is null")
    facts = F.struct("archive", "bytes", "comp_bytes", "method", "crc")
    merged = found.where("name is not null").join(bad.select("site").distinct(), "site", "left_anti").groupBy("site", "name").agg(F.max_by(facts, F.struct("archive", "n")).alias("_f"), F.count("*").alias("_n"))
    good = merged.select("site", "_f.archive", "name", "_f.bytes", "_f.comp_bytes", "_f.method", "_f.crc", F.when(F.col("_n") > 1, "repeated name").alias("error"))
    return good.unionByName(bad.drop("n"))


def _dealt(paths: DataFrame) -> DataFrame:
    """(site, path), by bytes where these are known."""
    return (deal_by_bytes(paths.select("site", "path", "bytes")) if "bytes" in paths.columns else paths).select("site", "path")


def read_headers(paths: DataFrame, n: int = 12) -> DataFrame:
    """(site, path) -> site, path, header: the first ``n`` bytes, null for files that cannot be read. Each costs an opening: with a
    column ``bytes`` (of any value) they are dealt evenly."""

    def run(batches):
        for b in batches:
            heads = []
            for p in b.column(1).to_pylist():
                try:
                    with open_path(p) as f:
                        heads.append(f.read(n))
                except OSError:
                    heads.append(None)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(heads, pa.binary())], names=["site", "path", "header"])

    even = paths.withColumn("bytes", F.lit(0)) if "bytes" in paths.columns else paths
    return _dealt(even).mapInArrow(run, "site string, path string, header binary")


def hash_files(paths: DataFrame, piece: int = 1 << 16) -> DataFrame:
    """(site, path) -> site, path, sha512, md5 in one reading; files that cannot be read have an error instead.
    With a column ``bytes``, files are dealt by it."""

    def run(batches):
        import hashlib

        for b in batches:
            rows = []
            for p in b.column(1).to_pylist():
                digests = hashlib.sha512(), hashlib.md5(usedforsecurity=False)
                try:
                    with open_path(p) as f:
                        while data := f.read(piece):
                            for d in digests:
                                d.update(data)
                    rows.append((digests[0].hexdigest(), digests[1].hexdigest(), None))
                except OSError as e:
                    rows.append((None, None, type(e).__name__))
            cols = list(zip(*rows)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array(x, pa.string()) for x in cols)], names=["site", "path", "sha512", "md5", "error"])

    return _dealt(paths).mapInArrow(run, "site string, path string, sha512 string, md5 string, error string")


def choose_key_column(columns: list[str], override: str | None = None, names: tuple[str, ...] = ("site#", "site")) -> str:
    """The column with keys: an override, an exact name, or the only one that contains it."""
    if override is not None:
        found = pick_column(columns, override)
        if found is None:
            raise ValueError(f"no column {override}")
        return found
    for n in names:
        if found := pick_column(columns, n):
            return found
    fuzzy = [c for c in columns if names[-1] in c.lower()]
    if len(fuzzy) != 1:
        raise ValueError(f"{len(fuzzy)} columns could hold keys")
    return fuzzy[0]


def read_companions(spark: SparkSession, path: str, required: tuple[str, ...] = ("File Name",)) -> DataFrame:
    """A list with ``#`` comments; blank names are skipped."""
    df = spark.read.csv(path, header=True, comment="#", escape='"')
    return require(df, required).where(F.trim(F.coalesce(F.col(required[0]), F.lit(""))) != "")


def require(df: DataFrame, columns: tuple[str, ...] | list[str]) -> DataFrame:
    lacking = [c for c in columns if pick_column(df.columns, c) is None]
    if lacking:
        raise ValueError(f"columns missing: {', '.join(lacking)}")
    return df


def _docs(spark: SparkSession, glob: str) -> DataFrame:
    """site, v: the JSON documents ``root/folders/name``, where folders and name may hold wildcards (``*``, ``?``, ``[]``). Tasks list the
    folders and read the documents that they find; the driver sees none of them. v is null for what is no JSON or cannot be read."""
    import fnmatch

    root, folder, name = glob.rsplit("/", 2)
    if any(c in root for c in "*?[{") or "{" in folder + name:
        raise ValueError(f"wildcards belong in the last two parts of {glob}")
    is_folder, is_name = (fnmatch.translate(p) for p in (folder, name))

    def run(batches):
        import re

        folders, names = re.compile(is_folder), re.compile(is_name)
        for b in batches:
            sites, docs = [], []
            for s, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if not folders.match(s) or not names.match(n):
                    continue
                try:
                    with open_path(f"{root}/{s}/{n}") as f:
                        data = f.read()
                except OSError:
                    data = None
                sites.append(s)
                docs.append(data)
                if len(docs) == _DOCS:
                    yield pa.RecordBatch.from_arrays([pa.array(sites, pa.string()), pa.array(docs, pa.binary())], names=["site", "doc"])
                    sites, docs = [], []
            yield pa.RecordBatch.from_arrays([pa.array(sites, pa.string()), pa.array(docs, pa.binary())], names=["site", "doc"])

    found = read_inventory(spark, root, names_only=True).select("site", "name").mapInArrow(run, "site string, doc binary")
    return found.select("site", F.try_parse_json(F.col("doc").cast("string")).alias("v"))


#: Documents of a batch.
_DOCS = 1 << 10


def read_state_docs(spark: SparkSession, glob: str) -> DataFrame:
    """One row for each document: site (its folder), record_id, tries, mode, note. One that is no JSON is a note."""
    at = lambda p: F.try_variant_get("v", p, "string")
    tries = F.coalesce(at("$.number_of_tries"), F.lit("0 (legacy)"))
    return _docs(spark, glob).select("site", at("$.record_id").alias("record_id"), F.when(F.col("v").isNotNull(), tries).alias("tries"), at("$.mode").alias("mode"), F.when(F.col("v").isNull(), "unreadable").alias("note"))


def read_request_logs(spark: SparkSession, glob: str) -> DataFrame:
    """Site, record_id from request logs."""
    return _docs(spark, glob).select("site", F.coalesce(*(F.nullif(F.try_variant_get("v", p, "string"), F.lit("")) for p in ("$.record_id", "$.response.id", "$.id"))).alias("record_id"))


def recovered_ids(state: DataFrame, logs: DataFrame) -> DataFrame:
    """The state's record id, else the log's."""
    return state.select("site", F.nullif("record_id", F.lit("")).alias("_s")).join(logs.select("site", F.col("record_id").alias("_l")), "site", "full_outer").select("site", F.coalesce("_s", "_l").alias("record_id"))


def read_done_set(spark: SparkSession, path: str) -> DataFrame:
    """A path on each line; blank lines and repeats go."""
    return spark.read.text(path).select(F.trim("value").alias("path")).where("path <> ''").distinct()


def read_results(spark: SparkSession, path: str, column: str = "site", range_bytes: int = 8 << 20) -> DataFrame:
    """Key, error_message: the last row of each key of a results log, or of several in the order of their paths; cells without a key are
    left out, and a log that is not there has no rows. A log is read in ranges, however long it is."""
    from pyspark.errors import AnalysisException

    try:
        rows = read_dirty_csv(spark, path, range_bytes, place=True)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], "key string, error_message string")
    if len(rows.columns) == 1:  # logs without a line
        return spark.createDataFrame([], "key string, error_message string")
    require(rows, [column, "error_message"])
    # finding keys is dear: it is done for the last row of each spelling only
    spelt = last_wins(rows.select(F.col(column).alias("_cell"), F.coalesce("error_message", F.lit("")).alias("error_message"), "_place"), ["_cell"], "_place")
    keyed = spelt.select(parse_key_cell("_cell")["key"].alias("key"), "error_message", "_place").where("key is not null")
    return last_wins(keyed, ["key"], "_place").drop("_place")


def read_log_lines(spark: SparkSession, path: str) -> DataFrame:
    """line_no, line, in the order of the logs: by file, by place of the range that a task reads, and by line within it."""
    at = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("n"))
    return spark.read.text(path).select(at.alias("line_no"), F.col("value").alias("line"))


def read_config(spark: SparkSession, path: str) -> DataFrame:
    """S17"""
    return spark.read.json(path, multiLine=True)


def read_report(spark: SparkSession, path: str, required: list[str]) -> DataFrame:
    """An earlier report; a report that is not there is an empty one."""
    from pyspark.errors import AnalysisException

    try:
        return require(spark.read.csv(path, header=True, escape='"', multiLine=True), required)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], ", ".join(f"`{c}` string" for c in required))
