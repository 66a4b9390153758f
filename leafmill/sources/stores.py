"""File systems as tasks see them."""

from __future__ import annotations

from pyarrow import fs


def store_of(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI that Arrow knows, and the path in it."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path) if ":" in path.split("/")[0] else (fs.LocalFileSystem(), path)
