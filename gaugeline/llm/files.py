"""Binary files in the shared folder, read and written by tasks."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

import pyarrow.fs as pafs


def opened(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI; a bare path is a local one."""
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    return pafs.FileSystem.from_uri(uri) if "://" in uri else (pafs.LocalFileSystem(), uri)


@contextmanager
def new_file(folder: str, suffix: str):
    """`(uri, stream)` of a file no other attempt writes; only committed rows name it, so retries do no harm."""
    uri = f"{folder}/{uuid.uuid4().hex}{suffix}"
    system, path = opened(uri)
    system.create_dir(path.rsplit("/", 1)[0], recursive=True)
    with system.open_output_stream(path) as stream:
        yield uri, stream
