"""Opening files of shared storage inside tasks."""

from __future__ import annotations

from typing import BinaryIO


def _store(uri: str):
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[len("file:"):].lstrip("/")
    if "://" in uri:
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), uri


def open_input(uri: str) -> BinaryIO:
    """A seekable binary file for a path or uri as Spark lists it (``file:``,
    ``hdfs://``, ``s3://``, ... by Arrow's file systems)."""
    store, path = _store(uri)
    return store.open_input_file(path)


def open_output(uri: str) -> BinaryIO:
    """A binary file to write (a repeated task writes it anew); its folder is made."""
    store, path = _store(uri)
    store.create_dir(path.rpartition("/")[0], recursive=True)
    return store.open_output_stream(path)
