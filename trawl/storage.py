"""Files of the shared file system, opened from inside tasks by their URI.

``file:`` URIs and plain paths are opened locally (the folder must then be shared by all machines);
any other scheme goes through the matching ``pyarrow.fs`` file system (``hdfs`` needs libhdfs on the
workers).
"""

from __future__ import annotations

import functools
import os
from urllib.parse import unquote, urlsplit

from pyarrow import fs


@functools.cache
def _remote(base: str) -> fs.FileSystem:
    return fs.FileSystem.from_uri(base)[0]


def locate(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path in it."""
    parts = urlsplit(uri)
    if parts.scheme in ("", "file"):
        return fs.LocalFileSystem(), unquote(parts.path) if parts.scheme else uri
    found = _remote(f"{parts.scheme}://{parts.netloc}/")
    return found, parts.netloc + parts.path if parts.scheme in ("s3", "s3a", "gs", "gcs") else parts.path


def open_read(uri: str):
    """Random-access file."""
    system, path = locate(uri)
    return system.open_input_file(path)


def open_write(uri: str):
    """Output stream; its folder is created where missing."""
    system, path = locate(uri)
    system.create_dir(os.path.dirname(path), recursive=True)
    return system.open_output_stream(path, compression=None)


def move(source: str, target: str) -> None:
    """Renames a file; its folder is created where missing."""
    system, path = locate(source)
    to = locate(target)[1]
    system.create_dir(os.path.dirname(to), recursive=True)
    system.move(path, to)


def remove(uri: str) -> None:
    """Deletes a file or a folder with all in it; nothing happens where there is none."""
    system, path = locate(uri)
    kind = system.get_file_info(path).type
    if kind == fs.FileType.Directory:
        system.delete_dir(path)
    elif kind == fs.FileType.File:
        system.delete_file(path)


def exists(uri: str) -> bool:
    system, path = locate(uri)
    return system.get_file_info(path).type != fs.FileType.NotFound


def files(uri: str, suffix: tuple[str, ...] = ()) -> list[tuple[str, int]]:
    """(URI, bytes) of the files below a folder (or of the one file), by name; names and folders that
    begin with ``_`` or ``.`` are left out."""
    system, path = locate(uri)
    info = system.get_file_info(path)
    if info.type == fs.FileType.File:
        return [(uri, info.size)]
    out = []
    for f in system.get_file_info(fs.FileSelector(path, recursive=True, allow_not_found=True)):
        below = f.path[len(path):].strip("/")
        if f.type == fs.FileType.File and below.endswith(suffix or "") and not any(
                p[:1] in ("_", ".") for p in below.split("/")):
            out.append((f"{uri.rstrip('/')}/{below}", f.size))
    return sorted(out)
