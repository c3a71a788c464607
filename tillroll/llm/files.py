"""Files of the shared folder that tasks write and read themselves."""

from __future__ import annotations

import os
import shutil
import tempfile
from functools import lru_cache

import numpy as np
from pyarrow import fs


def open_uri(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a location, and the path on it. A bare path is a mounted folder."""
    scheme = uri.split("/")[0]
    if ":" not in scheme:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri("s3" + uri[3:] if scheme == "s3a:" else uri)


def write_bytes(uri: str, *parts: bytes | memoryview) -> None:
    system, path = open_uri(uri)
    system.create_dir(os.path.dirname(path), recursive=True)
    with system.open_output_stream(path) as out:
        for p in parts:
            out.write(p)


@lru_cache(maxsize=4096)
def mapped(uri: str) -> np.memmap:
    """The bytes of a file, memory-mapped. A folder that is mounted on the workers is mapped in
    place; from any other store a worker maps a nameless copy, gone when the worker ends."""
    system, path = open_uri(uri)
    if isinstance(system, fs.LocalFileSystem):
        return np.memmap(path, np.uint8, "r")
    copy = tempfile.TemporaryFile()
    with system.open_input_stream(path) as source:
        shutil.copyfileobj(source, copy)
    copy.flush()
    return np.memmap(copy, np.uint8, "r")
