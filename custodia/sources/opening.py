"""Files opened by tasks."""

from __future__ import annotations

from urllib.parse import unquote, urlparse


def open_path(path: str):
    """Local paths and file: URIs directly; others through the file systems that Arrow knows."""
    u = urlparse(path)
    if u.scheme in ("", "file"):
        return open(unquote(u.path) if u.scheme else path, "rb")
    from pyarrow import fs

    store, inner = fs.FileSystem.from_uri(path)
    return store.open_input_file(inner)
