"""The file inventory as a data source: folders are listed by tasks, and filters on the site decide which are listed at all."""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from urllib.parse import unquote, urlparse

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition, IsNotNull, StringStartsWith

from ..functions.common import ship

SCHEMA = "site string, name string, bytes long, mtime timestamp, sidecar boolean, error string"
#: Rows of a batch.
BATCH = 8192


class SiteFiles(DataSource):
    """Format ``site_files``. Options: ``path``; ``slices``, into how many tasks the sites are dealt by a hash of their name; ``names``, to
    leave sizes and times unasked (they are null then); and ``ranges``, into how many tasks the files of every site are dealt by a hash of theirs, for folders whose files take long
    to stat. A folder's names are read by each of its tasks, sizes and times by one."""

    @classmethod
    def name(cls) -> str:
        return "site_files"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return SiteReader(self.options["path"], int(self.options.get("slices", 32)), int(self.options.get("ranges", 1)), self.options.get("names", "false") == "true")


class Slice(InputPartition):
    """A slice of the sites (or sites by name) and a range of their files."""

    def __init__(self, sites: list[str] | None, number: int, part: int) -> None:
        self.sites, self.number, self.part = sites, number, part


class SiteReader(DataSourceReader):
    def __init__(self, path: str, slices: int, ranges: int, names: bool = False) -> None:
        self.path, self.slices, self.ranges, self.names = path.rstrip("/"), max(1, slices), max(1, ranges), names
        self.sites: set[str] | None = None
        self.prefix = ""
        self.none = False

    def pushFilters(self, filters: list[Filter]):
        """Equality, lists and prefixes of the site are taken over; Spark evaluates the rest."""
        for f in filters:
            if getattr(f, "attribute", None) != ("site",):
                yield f
            elif isinstance(f, (EqualTo, In)):
                named = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.sites = named if self.sites is None else self.sites & named
            elif isinstance(f, StringStartsWith):
                self.none |= not (f.value.startswith(self.prefix) or self.prefix.startswith(f.value))
                self.prefix = max(self.prefix, f.value, key=len)
            elif not isinstance(f, IsNotNull):
                yield f

    def partitions(self) -> list[InputPartition]:
        if self.none:
            return []
        if self.sites is None:
            return [Slice(None, i, j) for i in range(self.slices) for j in range(self.ranges)]
        wanted = sorted(s for s in self.sites if isinstance(s, str) and s not in ("", ".", "..") and "/" not in s and s.startswith(self.prefix))
        dealt = [wanted[i :: self.slices] for i in range(min(self.slices, len(wanted)))]
        return [Slice(own, i, j) for i, own in enumerate(dealt) for j in range(self.ranges)]

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        rows = []
        for site, folder in self._folders(partition):
            for name, size, seconds, error in _entries(folder, lambda n: _dealt(n, self.ranges) == partition.part, self.names):
                rows.append((site, name, size, None if seconds is None else int(seconds // 1) * 1_000_000, name.startswith("._"), error))
                if len(rows) == BATCH:
                    yield _batch(rows)
                    rows = []
        if rows:
            yield _batch(rows)

    def _folders(self, partition: Slice) -> Iterator[tuple[str, str]]:
        if partition.sites is not None:
            yield from ((s, f"{self.path}/{s}") for s in partition.sites)
            return
        for name in _subfolders(self.path):
            if name.startswith(self.prefix) and _dealt(name, self.slices) == partition.number:
                yield name, f"{self.path}/{name}"


def _dealt(name: str, n: int) -> int:
    return zlib.crc32(name.encode("utf-8", "surrogateescape")) % n


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.string(), pa.int64(), pa.timestamp("us", tz="UTC"), pa.bool_(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], names=["site", "name", "bytes", "mtime", "sidecar", "error"])


def _local(path: str) -> str | None:
    u = urlparse(path)
    return (unquote(u.path) if u.scheme else path) if u.scheme in ("", "file") else None


def _subfolders(root: str) -> Iterator[str]:
    """Names of the folders in ``root``; sizes and times are not asked for."""
    if (local := _local(root)) is not None:
        with os.scandir(local) as found:
            yield from (e.name for e in found if e.is_dir())
        return
    from pyarrow import fs

    store, inner = fs.FileSystem.from_uri(root)
    yield from (i.base_name for i in store.get_file_info(fs.FileSelector(inner)) if i.type == fs.FileType.Directory)


def _entries(folder: str, own, names: bool = False) -> Iterator[tuple[str, int | None, float | None, str | None]]:
    """(name, bytes, seconds, error) of the regular files whose names are ``own``; a folder that is not there has none."""
    if (local := _local(folder)) is not None:
        try:
            found = os.scandir(local)
        except (FileNotFoundError, NotADirectoryError):
            return
        with found:
            for e in found:
                if not own(e.name):
                    continue
                try:
                    if e.is_file() and names:
                        yield e.name, None, None, None
                    elif e.is_file():
                        at = e.stat()
                        yield e.name, at.st_size, at.st_mtime, None
                except OSError as x:
                    yield e.name, None, None, f"stat failed: {type(x).__name__}"
        return
    from pyarrow import fs

    store, inner = fs.FileSystem.from_uri(folder)
    for i in store.get_file_info(fs.FileSelector(inner, allow_not_found=True)):
        if i.type == fs.FileType.File and own(i.base_name):
            yield i.base_name, i.size, i.mtime.timestamp() if i.mtime else None, None


def read_inventory(spark: SparkSession, root: str, slices: int | None = None, ranges: int = 1, names_only: bool = False) -> DataFrame:
    """Site, name, bytes, mtime (whole seconds), sidecar, error of the files one level under each site's folder. Hidden files are
    listed too; contents are not read. ``where`` on the site (=, IN, LIKE 'x%') reaches the source, and folders of
    other sites are not looked at. A file whose size cannot be told has an error. With ``names_only`` sizes and times may be left null."""
    ship(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(SiteFiles)
    n = slices or max(1, min(1024, spark.sparkContext.defaultParallelism * 4))
    return spark.read.format("site_files").option("slices", n).option("ranges", ranges).option("names", str(names_only).lower()).load(root)
