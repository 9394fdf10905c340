"""Verdicts: ordered rules of which the first that holds decides. Each takes a DataFrame of facts and adds ``verdict``.

Facts are columns named in the docstrings: flags, counts and texts that the other operators compute.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.items import is_raw_upload
from ..functions.keys import like_capture
from .layout import records_needed, split_advice

c = F.col


def cascade(rules: list[tuple[Column, str]], otherwise: str | None) -> Column:
    """The label of the first rule that is true; a NULL condition does not hold."""
    chain = None
    for condition, label in rules:
        chain = F.when(condition, label) if chain is None else chain.when(condition, label)
    return chain.otherwise(F.lit(otherwise))


def _of(facts: DataFrame, rules: list[tuple[Column, str]], otherwise: str | None) -> DataFrame:
    return facts.withColumn("verdict", cascade(rules, otherwise))


def prep_completeness(f: DataFrame, audit_all: bool = False) -> DataFrame:
    """Folder, sentinel, n_archives, layout, companions_readable, archive_readable, n_required_missing,
    n_conditional_missing; and for per-day sites V02's facts."""
    sure = F.lit(not audit_all) & c("sentinel")
    return _of(f, [
        (~c("folder"), "No"), (sure, "Yes"), (c("n_archives") == 0, "No"), (c("layout") == "mixed", "No"), (~c("companions_readable"), "Ambiguous"),
        *[((c("layout") == "per_day") & cond, v) for cond, v in _per_day()], (c("layout") == "per_day", "Yes"),
        (~c("archive_readable"), "Ambiguous"), (c("n_required_missing") > 0, "No"), (c("n_conditional_missing") > 0, "Ambiguous"),
    ], "Yes")


def _per_day() -> list[tuple[Column, str]]:
    return [
        (c("n_undatable") > 0, "Ambiguous"), ((c("n_required_missing") > 0) | (c("n_stray_days") > 0) | (c("n_entry_problems") > 0), "No"),
        (~c("archive_readable") | (c("n_conditional_missing") > 0) | ~c("has_config"), "Ambiguous"),
    ]


def day_completeness(f: DataFrame) -> DataFrame:
    """n_undatable, n_required_missing, n_stray_days, n_entry_problems, archive_readable, n_conditional_missing, has_config."""
    return _of(f, _per_day(), "Yes")


def source_problems(f: DataFrame) -> DataFrame:
    """n_items, n_cross_check, n_days_absent, n_days_stale, n_map_mismatch, has_config, n_zero -> a row for each problem and
    warning of a site: site, code, severity."""
    codes = [
        (c("n_items") == 0, "no items"), (c("n_cross_check") > 0, "cross-check failed"), (c("n_days_absent") > 0, "day archive missing"), (c("n_days_stale") > 0, "stale day archive"),
        (c("n_map_mismatch") > 0, "archive differs from source"), (~c("has_config"), "configuration missing"),
    ]
    rows = F.array(*(F.when(cond, F.struct(F.lit(k).alias("code"), F.lit("problem").alias("severity"))) for cond, k in codes), F.when(c("n_zero") > 0, F.struct(F.lit("zero-byte items").alias("code"), F.lit("warning").alias("severity"))))
    return f.select("site", F.explode(F.array_compact(rows)).alias("p")).select("site", "p.*")


def integrity_gate(f: DataFrame) -> DataFrame:
    """Sentinel, layout, archive_readable, has_manifest, n_manifest_problems, n_digest_problems -> the list of problems; a
    layout that is not supported ends the list, and digests count only if the structure is sound."""
    first = F.array_compact(F.array(F.when(~c("sentinel"), F.lit("no sentinel"))))
    stop = c("layout").isin("mixed", "none")
    more = F.array_compact(F.array(
        F.when(~c("archive_readable"), F.lit("unreadable archive")), F.when(~c("has_manifest"), F.lit("no manifest")), F.when(c("n_manifest_problems") > 0, F.lit("manifest and archives differ")),
    ))
    digest = F.when((F.size(more) == 0) & (c("n_digest_problems") > 0), F.array(F.lit("digests differ"))).otherwise(F.array().cast("array<string>"))
    problems = F.when(stop, F.concat(first, F.array(F.concat(F.lit("layout "), c("layout"))))).otherwise(F.concat(first, more, digest))
    return f.withColumn("problems", problems).withColumn("verdict", F.when(F.size("problems") == 0, "pass").otherwise("fail"))


def draft_verdict(f: DataFrame) -> DataFrame:
    """archive_committed, n_raw, n_companions, file_by_file, n_companions_absent, n_stray_raw."""
    return _of(f, [
        (c("archive_committed"), "ALREADY_COMMITTED"), ((c("n_raw") == 0) | (c("n_companions") == 0), "MANIFESTS_MISSING"), (c("file_by_file"), "RESUMABLE"),
        (c("n_companions_absent") > 0, "COMPANIONS_MISSING"), (c("n_stray_raw") > 0, "PARTIALLY_CONVERTED"),
    ], "CONVERTIBLE")


def _some(names: Column, n: int = 5) -> Column:
    """The first names of a sorted list."""
    return F.array_join(F.slice(F.array_sort(names), 1, n), ", ")


def _text(*parts: Column | str) -> Column:
    """Texts, and columns as text, joined; a null is nothing."""
    return F.concat(*(F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("")) for p in parts))


def draft_note(verdict: Column | str = "verdict") -> Column:
    """Why, in words. Beside the verdict's facts: n_raw_committed, companions_absent and stray_raw (lists of names)."""
    v = F.col(verdict) if isinstance(verdict, str) else verdict
    return (
        F.when(v == "ALREADY_COMMITTED", "the record holds the archive")
        .when(v == "MANIFESTS_MISSING", _text(c("n_raw"), " raw files and ", c("n_companions"), " companions are known; without both nothing can be decided"))
        .when(v == "RESUMABLE", _text("file by file; ", c("n_raw_committed"), "/", c("n_raw"), " raw files committed"))
        .when(v == "COMPANIONS_MISSING", _text(F.size("companions_absent"), " companions not committed: ", _some(c("companions_absent"))))
        .when(v == "PARTIALLY_CONVERTED", _text(F.size("stray_raw"), " raw files on the record of a site that is not file by file: ", _some(c("stray_raw"))))
        .when(v == "CONVERTIBLE", "all companions are committed, the archive is not")
    )


def draft_facts(entries: DataFrame, raw: DataFrame, companions: DataFrame, archives: DataFrame, file_by_file: DataFrame) -> DataFrame:
    """The facts, from a record's (site, name, status), the raw files and companions that the manifests name (site, name), each site's
    archive (site, archive), and the sites that are marked file by file. Every site with an archive has a row."""
    done = entries.where("status = 'completed'").select("site", "name").distinct()
    held = done.withColumn("_done", F.lit(True))
    wanted = raw.select("site", "name").distinct().join(held, ["site", "name"], "left").groupBy("site").agg(F.count("*").alias("n_raw"), F.count("_done").alias("n_raw_committed"))
    beside = companions.select("site", "name").distinct().join(held, ["site", "name"], "left").groupBy("site").agg(F.count("*").alias("n_companions"), F.array_sort(F.collect_list(F.when(F.col("_done").isNull(), F.col("name")))).alias("companions_absent"))
    stray = done.where(is_raw_upload("name")).groupBy("site").agg(F.array_sort(F.collect_list("name")).alias("stray_raw"))
    packed = archives.join(done.withColumnRenamed("name", "archive"), ["site", "archive"], "left_semi").select("site", F.lit(True).alias("archive_committed")).distinct()
    marked = file_by_file.select("site", F.lit(True).alias("file_by_file")).distinct()
    facts = archives.select("site").distinct()
    for more in (wanted, beside, stray, packed, marked):
        facts = facts.join(more, "site", "left")
    none = F.array().cast("array<string>")
    facts = facts.fillna(0, ["n_raw", "n_raw_committed", "n_companions"]).fillna(False, ["archive_committed", "file_by_file"]).withColumns({k: F.coalesce(k, none) for k in ("companions_absent", "stray_raw")})
    return facts.withColumns({"n_companions_absent": F.size("companions_absent"), "n_stray_raw": F.size("stray_raw")})


def local_note(max_files: int = 96, verdict: Column | str = "verdict") -> Column:
    """Why, in words. Beside the verdict's facts: staging_folders, raw_folders and raw_absent (lists of names)."""
    v = F.col(verdict) if isinstance(verdict, str) else verdict
    which = F.when(c("n_staging") > 1, _text(c("n_staging"), " prepared folders: ", _some(c("staging_folders")))).otherwise(_text(c("n_raw_folders"), " raw folders: ", _some(c("raw_folders"))))
    advice = split_advice(records_needed("n_raw", "n_companions", max_files))
    return (
        F.when(v == "AMBIGUOUS_FOLDER", which)
        .when(v == "NO_STAGING", "no prepared folder")
        .when(v == "PREP_INCOMPLETE", "the mark of a finished folder is absent")
        .when(v == "UNSUPPORTED_LAYOUT", _text("archives are laid out as ", c("layout"), "; one archive is needed"))
        .when(v == "MANIFESTS_MISSING", _text(c("n_raw"), " raw files and ", c("n_companions"), " companions are known; both are needed"))
        .when(v == "TOO_MANY_FILES", _text(c("n_raw") + c("n_companions"), " files (", c("n_raw"), " raw, ", c("n_companions"), f" companions), at most {max_files}: ", advice))
        .when(v == "NO_RAW_FOLDER", "no raw folder")
        .when(v == "RAW_FILES_MISSING", _text(c("n_raw_absent"), " listed raw files are not there: ", _some(c("raw_absent"))))
        .when(v == "UPLOADED_TWIN", "an uploaded folder of the site exists")
        .when(v == "STATE_MISMATCH", _text("the state names record ", c("state_record_id"), ", the draft is ", c("record_id")))
        .otherwise("")
    )


def local_verdict(f: DataFrame, max_files: int = 96) -> DataFrame:
    """n_staging, n_raw_folders, staging, sentinel, layout, n_raw, n_companions, n_raw_absent, twin_uploaded, state_record_id,
    record_id; NULL if every gate passes."""
    return _of(f, [
        ((c("n_staging") > 1) | (c("n_raw_folders") > 1), "AMBIGUOUS_FOLDER"), (~c("staging"), "NO_STAGING"), (~c("sentinel"), "PREP_INCOMPLETE"), (c("layout").isNotNull() & (c("layout") != "single"), "UNSUPPORTED_LAYOUT"),
        ((c("n_raw") == 0) | (c("n_companions") == 0), "MANIFESTS_MISSING"), (c("n_raw") + c("n_companions") > max_files, "TOO_MANY_FILES"), (c("n_raw_folders") == 0, "NO_RAW_FOLDER"),
        (c("n_raw_absent") > 0, "RAW_FILES_MISSING"), (c("twin_uploaded"), "UPLOADED_TWIN"), ((c("state_record_id") != "") & (c("state_record_id") != c("record_id")), "STATE_MISMATCH"),
    ], None)


def candidate_verdict(f: DataFrame) -> DataFrame:
    """Key, draft (NULL if unknown), id."""
    return _of(f, [(c("key").isNull(), "UNPARSABLE_TITLE"), (c("draft").isNull(), "UNKNOWN_DRAFT_STATE"), (~c("draft"), "PUBLISHED"), (F.coalesce(c("id"), F.lit("")) == "", "NO_ID")], "CANDIDATE")


def listing_candidates(records: DataFrame, patterns: list[str]) -> DataFrame:
    """Typed records (S10) -> each with the key that its title gives by one of the wildcard patterns, and its verdict."""
    return candidate_verdict(records.withColumn("key", like_capture("title", patterns)))


def missing_state_facts(sites: DataFrame, logs: DataFrame, documents: DataFrame, successes: DataFrame, failures: DataFrame, archives: DataFrame, done: DataFrame, rows: DataFrame | None) -> DataFrame:
    """The evidence on each of ``sites``: request logs (site, record_id), sites with a metadata document, and with an earlier success, failures
    (site, at, error_message), of which the last counts, archives (site, path), the done-set (path), and sites with a metadata row; None
    where these are not available, and then unknown. Each source is reduced to a row for each site before it is joined."""
    known = sites.select("site").distinct()
    log = logs.groupBy("site").agg(F.max(F.nullif("record_id", F.lit(""))).alias("log_id"), F.lit(True).alias("has_log"))
    last = failures.groupBy("site").agg(F.max_by("error_message", "at").alias("latest_failure"))
    packed = archives.join(done.select("path", F.lit(True).alias("_done")).distinct(), "path", "left").groupBy("site").agg(F.lit(True).alias("has_archive"), F.coalesce(F.bool_or("_done"), F.lit(False)).alias("in_done_set"))
    flag = lambda df, name: df.select("site").distinct().withColumn(name, F.lit(True))
    for more in (log, flag(documents, "has_metadata"), flag(successes, "prior_success"), last, packed, *([flag(rows, "metadata_row")] if rows is not None else [])):
        known = known.join(more, "site", "left")
    if rows is None:
        known = known.withColumn("metadata_row", F.lit(None).cast("boolean"))
    return known.fillna(False, ["has_log", "has_metadata", "prior_success", "has_archive", "in_done_set", *(["metadata_row"] if rows is not None else [])])


def missing_state_cause(f: DataFrame) -> DataFrame:
    """log_id, has_log, has_metadata, prior_success, has_archive, in_done_set, metadata_row (NULL if unknown), latest_failure."""
    return _of(f, [
        (F.coalesce(c("log_id"), F.lit("")) != "", "state lost, id in the log"), (c("has_log"), "log unreadable"), (c("has_metadata"), "creation failed"), (c("prior_success"), "prepared again after success"),
        (~c("has_archive"), "no archive"), (c("in_done_set"), "in the done-set"), (c("metadata_row") == F.lit(False), "no metadata row"), (F.coalesce(c("latest_failure"), F.lit("")) != "", "failed before creation"),
    ], "no evidence")


def cause_text(cause: Column | str = "verdict") -> Column:
    """The cause with the record's id or the last error, where it rests on one."""
    v = F.col(cause) if isinstance(cause, str) else cause
    return F.when(v == "state lost, id in the log", _text(v, ": record ", c("log_id"))).when(v == "failed before creation", _text(v, ": ", c("latest_failure"))).otherwise(v)


#: What to do about each cause, in the words of this package.
ACTIONS = {
    "state lost, id in the log": "restore the state from the log, then finish the upload",
    "log unreadable": "look for the record among duplicates, then write the state by hand",
    "creation failed": "look into the failure log, then run again",
    "prepared again after success": "compare with the record before running; a new run would make a duplicate",
    "no archive": "prepare the site again",
    "in the done-set": "verify the record; take a stale path out of the done-set",
    "no metadata row": "add the site's metadata row, then run again",
    "failed before creation": "mend the last error, then run again",
    "no evidence": "run the upload",
}


def suggested_action(cause: Column | str = "verdict") -> Column:
    """What to do about a cause; NULL for other texts."""
    value = F.col(cause) if isinstance(cause, str) else cause
    return F.element_at(F.create_map(*(F.lit(x) for kv in ACTIONS.items() for x in kv)), value)


def split_verdict(f: DataFrame, resume: bool = False, allow_oversized: bool = False, limit: int = 50_000_000_000) -> DataFrame:
    """part_total, part2_exists, part2_bound, n_untrusted, plan_problem, cut, n_differing, n_unexpected, n_in_part2, bytes1,
    bytes2, n_remaining, n_companions_missing."""
    over = (c("bytes1") > limit) | (c("bytes2") > limit)
    return _of(f, [
        (c("part_total") != 2, "NOT_TWO_PARTS"), (~c("part2_exists"), "PART2_MISSING"), (c("part2_bound"), "PART2_BOUND"), (c("n_untrusted") > 0, "UNTRUSTED_SIZES"), (c("plan_problem").isNotNull(), "PLAN_CHECK_FAILED"),
        (c("cut").isNull(), "TOO_FEW_ITEMS"), (c("n_differing") > 0, "NAME_COLLISION"), (c("n_unexpected") > 0, "PART2_UNEXPECTED"), ((c("n_in_part2") > 0) & F.lit(not resume), "PART2_NEEDS_RESUME"),
        (over & F.lit(not allow_oversized), "STILL_OVERSIZED"), ((c("n_remaining") == 0) & (c("n_companions_missing") == 0), "ALREADY_SPLIT"), (c("n_in_part2") > 0, "RESUMABLE"),
    ], "SPLIT_PLANNED")


def leftover_verdict(f: DataFrame) -> DataFrame:
    """Twin, twin_sentinel, twin_uploaded, n_archives, n_twin_archives, n_diverging, digest, twin_digest."""
    return _of(f, [
        (c("twin").isNull(), "NO_TWIN"), (~c("twin_sentinel") & c("twin_uploaded"), "UPLOADED_TWIN_NO_SENTINEL"), (~c("twin_sentinel"), "TWIN_NO_SENTINEL"), ((c("n_archives") != 1) | (c("n_twin_archives") != 1), "CANNOT_VERIFY"),
        (c("n_diverging") > 0, "CANNOT_VERIFY"), (c("digest") == c("twin_digest"), "VERIFIED_DUPLICATE"),
    ], "CANNOT_VERIFY")


def version_preflight(f: DataFrame) -> DataFrame:
    """Sentinel, mode, n_packages, layout, integrity, has_metadata_row, is_latest, title_equal, n_drafts, bump_error."""
    return _of(f, [
        (~c("sentinel"), "no sentinel"), (c("mode") == "file_by_file", "file-by-file site"), (c("n_packages") != 1, "not one package"), (c("layout").isin("mixed", "none"), "unsupported layout"), (c("integrity") != "pass", "integrity failed"),
        (~c("has_metadata_row"), "no metadata row"), (~c("is_latest"), "not the latest version"), (~c("title_equal"), "title differs"), (c("n_drafts") > 0, "stray drafts"), (c("bump_error").isNotNull(), "no next version"),
    ], "ready")


def stale_document(f: DataFrame) -> DataFrame:
    """has_document, current, layout, n_archives."""
    return _of(f, [(~c("has_document"), "no document"), (c("current"), "current"), (c("layout").isin("mixed", "per_day"), "unsupported layout"), (c("n_archives") == 0, "no archive")], "stale")


def reprep_plan(f: DataFrame) -> DataFrame:
    """Status, uploaded, has_raw; rows whose status is not No are not part of the plan."""
    return _of(f.where(c("status") == "No"), [(c("uploaded"), "skip: uploaded"), (~c("has_raw"), "skip: no raw folder")], "prepare")


def stuck_sites(f: DataFrame) -> DataFrame:
    """has_state, readable, record_id."""
    return _of(f, [(~c("has_state"), "without state"), (~c("readable"), "skip: unreadable"), (F.coalesce(c("record_id"), F.lit("")) == "", "skip: no record")], "stuck")


def strategy_switch(f: DataFrame, threshold: int = 3) -> DataFrame:
    """Tries, layout, only_archive_missing."""
    return f.withColumn("switch", (c("tries") >= threshold) & (c("layout") == "single") & c("only_archive_missing"))


def rewritten_archive(f: DataFrame) -> DataFrame:
    """has_readme_entry, entry_has_marker, has_manifest_entry."""
    return _of(f, [(~c("has_readme_entry"), "no readme entry"), (~c("entry_has_marker"), "readme not current"), (~c("has_manifest_entry"), "no manifest entry")], "ok")


def layout_refusal(f: DataFrame) -> DataFrame:
    """Layout -> reason, NULL if the layout is supported."""
    return f.withColumn("reason", F.when(c("layout") == "per_day", "archives are per day").when(c("layout") == "mixed", "single and daily archives together").when(c("layout") == "none", "no archive"))


#: Verdicts that leave nothing to do, by report.
QUIET = {"audit": ("Yes",), "draft": ("ALREADY_COMMITTED",), "split": ("ALREADY_SPLIT", "SPLIT_PLANNED"), "version": ("ready",), "leftover": ("VERIFIED_DUPLICATE",)}


def needs_attention(report: str) -> Column:
    """Whether a row of a report keeps a run from ending well."""
    return F.coalesce(~c("verdict").isin(*QUIET[report]), F.lit(True))


def any_attention(rows: DataFrame, report: str) -> bool:
    """The run's exit status: one such row is enough."""
    return bool(rows.where(needs_attention(report)).limit(1).count())
