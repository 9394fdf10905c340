"""Items and their names, sizes and times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .common import col


def day_key(name: Column | str) -> Column:
    """The first eight digits as YYYY_MM_DD, whether or not such a day exists."""
    p = "^([0-9]{4})([0-9]{2})([0-9]{2})"
    return F.when(col(name).rlike(p), F.concat_ws("_", *(F.regexp_extract(col(name), p, i) for i in (1, 2, 3))))


def stem(name: Column | str) -> Column:
    return F.regexp_replace(col(name), r"(?<=.)\.[^.]*$", "")


def item_timestamp(name: Column | str) -> Column:
    """YYYYMMDD_HHMMSS as a time; NULL unless it is one."""
    p = "^([0-9]{8})_([0-9]{6})$"
    token = F.concat(F.regexp_extract(stem(name), p, 1), F.regexp_extract(stem(name), p, 2))
    real = (F.substring(token, 1, 4) > "0000") & stem(name).rlike(p)
    return F.when(real, F.try_to_timestamp(token, F.lit("yyyyMMddHHmmss")))


def item_year(name: Column | str) -> Column:
    """The year of the first token, if its eight digits are a date; six or seven digits are not one."""
    token = F.split_part(stem(name), F.lit("_"), F.lit(1))
    day = F.to_date(F.try_to_timestamp(F.when(token.rlike("^[0-9]{8}$") & (F.substring(token, 1, 4) > "0000"), token), F.lit("yyyyMMdd")))
    return F.year(day)


def is_item(name: Column | str, rule: str = "audit", ext: str = ".wav") -> Column:
    """Four rules, never unified: audit (any case, no ``._``), prep (no leading dot), split (both) and gate
    (extension only)."""
    n = col(name)
    sound = F.lower(n).endswith(ext)
    return {"audit": sound & ~n.startswith("._"), "prep": sound & ~n.startswith("."), "split": sound & ~n.startswith("._") & ~n.startswith("."), "gate": sound}[rule]


def is_raw_upload(name: Column | str, ext: str = ".wav") -> Column:
    """An item or the configuration file."""
    return F.lower(col(name)).endswith(ext) | (F.upper(col(name)) == "CONFIG.TXT")


def is_hashable(name: Column | str, ext: str = ".wav") -> Column:
    """The same without hidden names."""
    return is_raw_upload(name, ext) & ~col(name).startswith(".")


def archive_name(key: Column | str, day: Column | str, prefix: str = "SITE") -> Column:
    """The name of a site's archive of one day."""
    return F.concat(F.lit(f"{prefix}_"), col(key), F.lit("_"), col(day), F.lit(".zip"))


def parse_archive_name(name: Column | str, prefix: str = "SITE") -> Column:
    """struct(key, day); NULL if the name is not of that form."""
    from .keys import parse_key

    tail = r"_([0-9]{4}_[0-9]{2}_[0-9]{2})\.(?i:zip)$"
    key = parse_key(F.regexp_replace(col(name), tail, ""), prefix)
    return F.when(col(name).rlike(tail) & key.isNotNull(), F.struct(key.alias("key"), F.regexp_extract(col(name), tail, 1).alias("day")))


def fixed(n: Column, unit: int, digits: int) -> Column:
    """A number of bytes in ``unit`` s as text with fixed decimals, ties to even on the exact value: what is left of whole steps decides, as
    a quotient would itself be rounded."""
    scaled = n * F.lit(10**digits).cast(f"decimal({digits + 1},0)")
    rest = scaled % F.lit(unit).cast("decimal(20,0)")
    steps = ((scaled - rest) / F.lit(unit).cast("decimal(20,0)")).cast("decimal(32,0)")
    up = (rest * 2 > unit) | ((rest * 2 == unit) & (steps % 2 == 1))
    return ((steps + up.cast("int")).cast("decimal(31,0)") / F.lit(10**digits).cast(f"decimal({digits + 1},0)")).cast(f"decimal(30,{digits})").cast("string")


def human_size(n: Column | str) -> Column:
    """Bytes for people to read; from 1 GiB on always GB."""
    b = col(n).cast("decimal(30,0)")
    unit = lambda power, name: F.concat(fixed(b, 1024**power, 2), F.lit(f" {name}"))
    return F.when(b < 1024, F.concat(b.cast("string"), F.lit(" B"))).when(b < 1024**2, unit(1, "KB")).when(b < 1024**3, unit(2, "MB")).otherwise(unit(3, "GB"))


def size_kb_text(n: Column | str) -> Column:
    """E16"""
    return fixed(col(n).cast("decimal(30,0)"), 1024, 2)


def size_gb_text(n: Column | str) -> Column:
    """E16"""
    return fixed(col(n).cast("decimal(30,0)"), 1024**3, 3)


def checksum_parts(c: Column | str) -> Column:
    """struct(algo, hex) of ``algo:hex``; without a colon the whole is hex."""
    has = F.contains(col(c), F.lit(":"))
    return F.struct(F.when(has, F.lower(F.split_part(col(c), F.lit(":"), F.lit(1)))).alias("algo"), F.lower(F.when(has, F.split_part(col(c), F.lit(":"), F.lit(2))).otherwise(col(c))).alias("hex"))


def declared_size(header: Column | str) -> Column:
    """Bytes that a RIFF/WAVE header declares for the file; NULL without such a header."""
    h = col(header)
    size = F.conv(F.concat(*(F.substring(F.hex(h), 1 + 2 * i, 2) for i in (7, 6, 5, 4))), 16, 10).cast("long")
    riff = (F.substring(F.hex(h), 1, 8) == "52494646") & (F.substring(F.hex(h), 17, 8) == "57415645")
    return F.when(riff, size + 8)


def classify_size(n: Column | str, header: Column | str, tiny: int = 1024) -> Column:
    """struct(is_zero, is_tiny, discrepancy) of an item on disk, from its size and its first bytes."""
    size, declared, readable = col(n), declared_size(header), F.coalesce(F.octet_length(col(header)), F.lit(0))
    problem = (
        F.when((size == 0) & (readable > 0), F.lit("empty by its size, but readable"))
        .when((size == 0) | (size > 2**32 - 1), F.lit(None))
        .when(declared.isNull(), F.lit("no header"))
        .when(size < declared, F.lit("truncated"))
        .when(size > declared, F.lit("trailing data"))
    )
    return F.struct(((size == 0) & (readable == 0)).alias("is_zero"), ((size > 0) & (size < tiny)).alias("is_tiny"), problem.alias("discrepancy"))


STORED, DEFLATED = 0, 8


def classify_entry(n: Column | str, packed: Column | str, method: Column | str, crc: Column | str, tiny: int = 1024) -> Column:
    """The same for an archive's entry, from the archive's index."""
    size, comp = col(n), col(packed)
    most = F.when(col(method) == DEFLATED, 2).otherwise(0)
    problem = (
        F.when((size == 0) & (col(crc) != 0), F.lit("empty by its size, but has a checksum"))
        .when((size == 0) & (comp > most), F.lit("empty by its size, but holds data"))
        .when((size > 0) & (col(method) == STORED) & (comp != size), F.lit("stored size differs"))
    )
    return F.struct(((size == 0) & problem.isNull()).alias("is_zero"), ((size > 0) & (size < tiny)).alias("is_tiny"), problem.alias("discrepancy"))


def remote_mismatch(n: Column | str, md5: Column | str, remote_size: Column | str, remote_checksum: Column | str) -> Column:
    """How a remote copy differs; NULL if nothing known differs."""
    given = F.nullif(F.trim(col(remote_size).cast("string")), F.lit(""))
    size = given.try_cast("long")
    theirs = checksum_parts(remote_checksum)
    return (
        F.when(given.isNotNull() & size.isNull(), F.lit("unreadable size"))
        .when(size.isNotNull() & (size != col(n)), F.lit("size differs"))
        .when((theirs["algo"] == "md5") & (theirs["hex"] != "") & (theirs["hex"] != F.lower(col(md5))), F.lit("md5 differs"))
    )


def is_pre_1980(mtime: Column | str) -> Column:
    """Times that archives cannot hold."""
    return F.unix_timestamp(col(mtime).cast("timestamp")) < 315532800


def item_order(name: Column | str) -> list[Column]:
    """Upper-case extensions first, then by name."""
    return [F.when(col(name).endswith(".WAV"), 0).when(col(name).endswith(".wav"), 1).otherwise(2), col(name)]
