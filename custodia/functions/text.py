"""Titles, labels, versions, templates and other text."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .common import casefold, col, nonempty


def norm_title(title: Column | str) -> Column:
    """White space collapsed, ends trimmed, case folded (upper, then lower, so that ß equals ss)."""
    return casefold(F.trim(F.regexp_replace(col(title), r"(?U)\s+", " ")))


def bump_version(version: Column | str, marker: str = "A") -> Column:
    """struct(next, error): the next letter of a version, or why there is none. ``marker`` is a layout's mark, not
    a letter of the ladder."""
    v = F.trim(F.coalesce(col(version), F.lit("")))
    base, letters = F.regexp_extract(v, "^(.*?)([A-Za-z]*)$", 1), F.regexp_extract(v, "^(.*?)([A-Za-z]*)$", 2)
    n, last = F.length(letters), F.substring(v, -1, 1)
    marked = (n == 2) & (F.substring(letters, 1, 1) == marker) & last.rlike("^[a-z]$")
    ladder = ((n == 1) & last.rlike("^[a-z]$")) | marked
    error = (
        F.when(v == "", "no version")
        .when(base == "", "all letters")
        .when((n == 0) | (letters == marker), F.lit(None))
        .when(ladder & (last == "z"), "z has no successor")
        .when(ladder, F.lit(None))
        .when(n > 1, "more than one letter")
        .otherwise("an uppercase letter")
    )
    step = F.concat(F.substring(v, F.lit(1), F.length(v) - 1), F.chr(F.ascii(last) + 1))
    following = F.when(error.isNull(), F.when((n == 0) | (letters == marker), F.concat(v, F.lit("a"))).otherwise(step))
    return F.struct(following.alias("next"), error.alias("error"))


def mark_version(version: Column | str, marker: str = "A") -> Column:
    """The marker once; blanks stay."""
    v = col(version)
    return F.when((F.trim(v) == "") | v.endswith(marker), v).otherwise(F.concat(v, F.lit(marker)))


def split_trim(text: Column | str, sep: str = ":") -> Column:
    """E24"""
    return F.transform(F.split(col(text), re.escape(sep)), F.trim)


def map_vocab(value: Column | str, vocabulary: dict[str, str], other: str = "other") -> Column:
    """Lower-cased and trimmed lookup. The vocabulary is configuration, a few entries."""
    table = F.create_map(*(F.lit(x) for kv in vocabulary.items() for x in kv))
    return F.coalesce(F.try_element_at(table, F.lower(F.trim(col(value)))), F.lit(other))


def norm_relation(value: Column | str) -> Column:
    """E26"""
    return F.replace(F.lower(F.trim(col(value))), F.lit(" "), F.lit(""))


def category_label(value: Column | str, labels: dict[str, str], fallback: str = "{value}") -> Column:
    """The label of a category; of an unknown one ``fallback``, with its name for ``{value}``."""
    chain = reduce(lambda c, kv: c.when(col(value) == kv[0], kv[1]), labels.items(), F.when(F.lit(False), F.lit(None)))
    return chain.otherwise(render_template(fallback, {"value": value}))


def render_template(template: str, values: dict[str, Column | str]) -> Column:
    """``{name}`` replaced by its value; unknown names stay as they are."""
    parts = re.split(r"\{(\w+)\}", template)
    out = [F.lit(p) if i % 2 == 0 else F.coalesce(col(values[p]).cast("string"), F.lit("")) if p in values else F.lit("{" + p + "}") for i, p in enumerate(parts)]
    return F.concat(*out)


def date_interval(first: Column | str, last: Column | str) -> Column:
    """struct(date, description): ``a/b``, one day if both agree or the last is missing, NULL without a first."""
    a, b = nonempty(first), nonempty(last)
    one = b.isNull() | (a == b)
    return F.when(a.isNotNull(), F.struct(F.when(one, a).otherwise(F.concat_ws("/", a, b)).alias("date"), F.when(one, "single day").otherwise("range").alias("description")))


def first_nonempty(*columns: Column | str) -> Column:
    """The first that is neither NULL nor empty."""
    return F.coalesce(*(nonempty(c) for c in columns))


def draft_flag(is_published: Column | str, present: Column, status: Column | str, source: Column | str) -> Column:
    """struct(draft, error). ``present``: whether the flag was given at all; given as NULL it means not published.
    A draft in a listing of published records is a contradiction."""
    status = nonempty(status)
    draft = F.when(present, ~F.coalesce(col(is_published), F.lit(False))).when(status.isNotNull(), status != "published")
    odd = (col(source) == "community") & draft
    error = F.when(draft.isNull(), "neither flag nor status").when(odd, "draft among published records")
    return F.struct(F.when(error.isNull(), draft).alias("draft"), error.alias("error"))


def record_url(html: Column | str, draft: Column | str, record_id: Column | str, base: str) -> Column:
    """The given link, else one for a draft or a published record."""
    made = F.when(col(draft), F.concat(F.lit(f"{base}/uploads/"), col(record_id))).otherwise(F.concat(F.lit(f"{base}/records/"), col(record_id)))
    return F.coalesce(nonempty(html), made)


def iso_date(value: Column | str) -> Column:
    """E33"""
    return F.split_part(col(value), F.lit("T"), F.lit(1))


def shorten(value: Column | str, most: int = 90) -> Column:
    """E34"""
    flat = F.trim(F.regexp_replace(col(value), r"\s+", " "))
    return F.when(F.length(flat) > most, F.concat(F.substring(flat, 1, most - 1), F.lit("…"))).otherwise(flat)


def file_role(name: Column | str) -> Column:
    """What a file is for; the first rule that applies."""
    low = F.lower(col(name))
    return (
        F.when(low.endswith(".zip"), "archive")
        .when(low.rlike(r"^readme\.(md|html)$"), "readme")
        .when(low == "file_list.csv", "manifest")
        .when(low.endswith("_data_dict.csv"), "data dictionary")
        .when(low == "license.txt", "license")
        .when(low.endswith(".wav"), "recording")
        .when(low == "config.txt", "configuration")
        .otherwise("companion")
    )


def has_marker(text: Column | str, marker: str) -> Column:
    """E36"""
    return F.coalesce(F.contains(col(text), F.lit(marker)), F.lit(False))


def strip_tags(html: Column | str) -> Column:
    """E37"""
    return F.regexp_replace(col(html), "<[^<]+?>", "")


def first_diff(old: Column | str, new: Column | str) -> Column:
    """0-based offset of the first difference of two texts, else the shorter length, else NULL for equal texts. The
    common prefix grows by halved steps, so 31 comparisons cover any length."""
    a, b = col(old), col(new)
    n = F.least(F.length(a), F.length(b))
    cut = lambda c, at, k: F.substring(c, at + 1, k)
    halves = F.array(*(F.lit(1 << k) for k in range(30, -1, -1)))
    common = F.aggregate(halves, F.lit(0), lambda at, k: F.when(k > n - at, at).when(cut(a, at, k) == cut(b, at, k), at + k).otherwise(at))
    return F.when(a != b, common)


def sample_text(names: Column | str, n: int = 5) -> Column:
    """The first names of a sorted array, and how many there are if more."""
    a = F.array_sort(F.array_distinct(col(names)))
    shown = F.array_join(F.slice(a, 1, n), ", ")
    return F.when(F.size(a) > n, F.concat(shown, F.lit(", ... ("), F.size(a).cast("string"), F.lit(")"))).otherwise(shown)


def pick_column(columns: list[str], name: str) -> str | None:
    """A header found whatever its case, ends or final colon."""
    plain = lambda c: c.strip().rstrip(":").strip().lower()
    return next((c for c in columns if plain(c) == plain(name)), None)


def escape_phrase(title: Column | str) -> Column:
    """A title as a quoted phrase."""
    inner = F.replace(F.replace(col(title), F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    return F.concat(F.lit('"'), inner, F.lit('"'))


def record_ids(doc: Column | str) -> Column:
    """struct(concept, version, latest) from a record's JSON text, either serialisation."""
    at = lambda p: F.nullif(F.get_json_object(col(doc), p), F.lit(""))
    return F.struct(
        F.coalesce(at("$.parent.pids.doi.identifier"), at("$.conceptdoi")).alias("concept"),
        F.coalesce(at("$.pids.doi.identifier"), at("$.doi")).alias("version"),
        (F.coalesce(at("$.versions.is_latest"), F.lit("false")) == "true").alias("latest"),
    )
