"""Site keys: one to three digits, padded to three, and an optional suffix that needs all three digits.

``prefix`` is the word before a key in names (``SITE_073``, ``SITE#120A``). Digits are ASCII only. Columns in, columns
out; a value that does not fit gives NULL, and the companion functions say why.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .common import col

SUFFIX = "[A-Za-z_][A-Za-z0-9_]*"
#: Tails of folder and file names that do not belong to a key.
RESERVED_TAILS = ("_staging", "_uploaded", "_to_upload", "_metadata", "_request_log")


def _canonical(digits: Column, suffix: Column) -> Column:
    fits = (F.length(suffix) == 0) | (F.length(digits) == 3)
    return F.when((F.length(digits) > 0) & fits, F.concat(F.lpad(digits, 3, "0"), suffix))


def parse_key(name: Column | str, prefix: str = "SITE") -> Column:
    """The key in a folder or file name."""
    stem = F.regexp_replace(F.trim(col(name)), r"\.[A-Za-z0-9]+$", "")
    # the greedy first group leaves the shortest tail, and only one is dropped
    stem = F.regexp_replace(stem, f"(?i)(?:{'|'.join(RESERVED_TAILS)})$", "")
    stem = F.regexp_replace(stem, r"_[0-9]{4}_[0-9]{2}_[0-9]{2}$", "")
    pattern = f"(?i)^{re.escape(prefix)}[_#]([0-9]{{1,3}})({SUFFIX})?$"
    return _canonical(F.regexp_extract(stem, pattern, 1), F.regexp_extract(stem, pattern, 2))


def _token(value: Column | str) -> Column:
    return F.regexp_replace(F.trim(F.coalesce(col(value).cast("string"), F.lit(""))), r"\s+", "_")


_TOKEN = f"^([0-9]{{1,3}})({SUFFIX})?$"


def normalize_key(value: Column | str) -> Column:
    """A bare token in canonical form."""
    t = _token(value)
    return _canonical(F.regexp_extract(t, _TOKEN, 1), F.regexp_extract(t, _TOKEN, 2))


def key_error(value: Column | str) -> Column:
    """Why a token is no key; NULL for a valid one."""
    t = _token(value)
    return F.when(~t.rlike(_TOKEN), F.lit("not a key")).when(normalize_key(value).isNull(), F.lit("a suffix needs three digits"))


def parse_key_cell(value: Column | str, prefix: str = "SITE") -> Column:
    """struct(key, reason) of a hand-typed cell; the first rule that applies decides."""
    text = F.trim(F.coalesce(col(value).cast("string"), F.lit("")))
    number = F.regexp_replace(text, r"^([0-9]+)\.0+$", "$1")  # a spreadsheet's 73.0
    joined = F.regexp_replace(number, r"\s+", "_")
    groups = F.regexp_extract_all(number, F.lit("([0-9]+)"), F.lit(1))
    named = f"(?i){re.escape(prefix)}[_#]*([0-9]{{1,3}})(?![0-9])({SUFFIX})?"
    hits = F.regexp_extract_all(joined, F.lit(named), F.lit(0))
    suffix = F.regexp_replace(F.regexp_extract(joined, named, 2), "_+$", "")
    digits = F.regexp_extract(joined, named, 1)
    only = F.element_at(groups, 1)
    small = F.length(F.regexp_replace(only, "^0+", "")) <= 3
    bad = F.lit("a suffix needs three digits")
    key = (
        F.when(normalize_key(number).isNotNull(), normalize_key(number))
        .when(joined.rlike(f"^[0-9]+{SUFFIX}$"), F.lit(None))
        .when(F.size(hits) == 1, _canonical(digits, suffix))
        .when((F.size(groups) == 1) & small, F.lpad(F.regexp_replace(only, "^0+(?=[0-9])", ""), 3, "0"))
    )
    reason = (
        F.when(text == "", F.lit("blank"))
        .when(normalize_key(number).isNotNull(), F.lit("ok"))
        .when(joined.rlike(f"^[0-9]+{SUFFIX}$"), bad)
        .when(F.size(groups) == 0, F.lit("no digits"))
        .when(F.size(hits) == 1, F.when(_canonical(digits, suffix).isNull(), bad).otherwise("ok"))
        .when((F.size(groups) == 1) & small, F.lit("ok"))
        .when(F.size(groups) == 1, F.lit("out of range"))
        .otherwise(F.concat(F.lit("ambiguous: "), F.size(groups).cast("string"), F.lit(" numbers")))
    )
    return F.struct(key.alias("key"), reason.alias("reason"))


def key_sort(key: Column | str) -> Column:
    """Number, then suffix."""
    return F.struct(F.substring(col(key), 1, 3).cast("int").alias("n"), F.substring(col(key), 4, 1 << 20).alias("s"))


def key_display(key: Column | str) -> Column:
    """For people to read."""
    return F.replace(col(key), F.lit("_"), F.lit(" "))


def key_in_text(text: Column | str, prefix: str = "SITE") -> Column:
    """The first key in free text; the bare number if its suffix does not fit."""
    pattern = f"(?i){re.escape(prefix)}[ _#]*([0-9]{{1,3}})(?![0-9])((?:[ _]?[A-Za-z_][A-Za-z0-9_]*)?)"
    tight = f"(?i){re.escape(prefix)}[ _#]*([0-9]{{1,3}})(?![0-9])({SUFFIX})?"
    digits, suffix = F.regexp_extract(col(text), tight, 1), F.regexp_extract(col(text), tight, 2)
    return F.when(col(text).rlike(pattern), F.coalesce(_canonical(digits, suffix), F.lpad(digits, 3, "0")))


def like_pattern(pattern: str, digits: int = 3) -> str:
    """A wildcard pattern as a Java expression; the last ``*`` takes the digits, three if no other number is given."""
    parts = pattern.split("*")
    quoted = [re.sub(r"([\\.\[\]{}()+?^$|])", r"\\\1", p) for p in parts]
    if len(parts) == 1:
        raise ValueError("the pattern needs a *")
    return "(?is)^" + ".*?".join(quoted[:-1]) + f"([0-9]{{{digits}}})" + quoted[-1]


def like_capture(text: Column | str, patterns: list[str | tuple[str, int]]) -> Column:
    """The digits by the first pattern that matches, NULL if none does. Keys of another length than three are asked for by
    (pattern, digits)."""
    found = [F.nullif(F.regexp_extract(col(text), like_pattern(*((p,) if isinstance(p, str) else p)), 1), F.lit("")) for p in patterns]
    return F.coalesce(*found)


def parse_part(key: Column | str) -> Column:
    """struct(base, i, n) of a key such as 122_Part_1_of_2; NULL for others."""
    pattern = r"(?i)^([0-9]{3})_part_([0-9]+)_of_([0-9]+)$"
    at = lambda n: F.regexp_extract(col(key), pattern, n)
    return F.when(col(key).rlike(pattern), F.struct(at(1).alias("base"), at(2).cast("int").alias("i"), at(3).cast("int").alias("n")))


def part2_name(name: Column | str) -> Column:
    """The sibling's name, in the same spelling."""
    return F.regexp_replace(col(name), "(?i)(?<=_part_)1(?=_of_)", "2")
