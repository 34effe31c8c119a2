"""File systems that Python tasks reach through Arrow: local, S3, GCS and HDFS."""

from __future__ import annotations

import functools
import re

import pyarrow as pa


@functools.lru_cache(8)
def _store(root: str):
    """(Arrow's file system, what of a path to leave out) for URIs that begin with ``root``, which ends before the path; None if Arrow has no such file system."""
    from pyarrow import fs

    if root in ("", "file:", "file://"):
        return fs.LocalFileSystem(), root
    try:
        found, _ = fs.FileSystem.from_uri(root + "/")
    except (pa.ArrowException, OSError, ValueError):
        return None
    return found, root.partition("//")[0] + ("//" if root.startswith(("s3", "gs")) else root[len(root.partition("//")[0]) :])


def _root(path: str) -> str:
    found = re.match(r"[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", path)
    return found.group(0) if found else ""


def store_of(path: str):
    """(Arrow's file system for ``path``, the prefix of the path that it does not take); None for a store that only Spark reaches."""
    return _store(_root(path))
