"""Files as Python tasks see them: local, mounted and object stores alike."""

from __future__ import annotations

import re


def filesystem(path: str):
    """``(pyarrow filesystem, path inside it)`` of a path or URI (``file:``,
    ``s3://``, ``gs://``, ``hdfs://``; a plain path is local)."""
    from pyarrow import fs

    local = re.fullmatch(r"(?:file:/*)?(/.*|[^:]*)", path)
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + re.sub(r"^file:/*", "", path)
    if local:
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path)
