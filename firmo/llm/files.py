"""Files that tasks write under the shared folder and other tasks read by byte
range.  A file appears under its name only when it is whole, so a task that is
tried again, or runs twice, leaves one good file."""

from __future__ import annotations

import uuid

from pyarrow import fs


def _at(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def put(uri: str, parts) -> int:
    """Write the byte strings of ``parts`` to a new file; returns its size."""
    where, path = _at(uri)
    if where.type_name == "local":
        where.create_dir(path.rsplit("/", 1)[0], recursive=True)
    temp, n = f"{path}.{uuid.uuid4().hex}.part", 0
    with where.open_output_stream(temp) as out:
        for p in parts:
            out.write(p)
            n += len(p)
    where.move(temp, path)
    return n


def size(uri: str) -> int:
    where, path = _at(uri)
    return where.get_file_info(path).size


def reader(uri: str):
    """A seekable binary file."""
    where, path = _at(uri)
    return where.open_input_file(path)


def read(uri: str) -> bytes:
    with reader(uri) as f:
        return f.read()


def exists(uri: str) -> bool:
    where, path = _at(uri)
    return where.get_file_info(path).is_file
