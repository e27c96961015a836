"""Reading and writing of the operators' own file formats from tasks.

Paths are URIs that Arrow's file systems open (file, hdfs, s3, gs ...), in a
folder that all executors share.  A task writes under a name of its own
attempt; a file counts only once a row that names it is in a written table,
so files of lost or repeated attempts are never read.
"""

from __future__ import annotations

import uuid

from pyarrow import fs


def own_name(folder: str, stem: str, suffix: str) -> str:
    return f"{folder}/{stem}-{uuid.uuid4().hex}{suffix}"


def open_write(uri: str):
    system, path = fs.FileSystem.from_uri(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    return system.open_output_stream(path, compression=None)


def open_read(uri: str):
    system, path = fs.FileSystem.from_uri(uri)
    return system.open_input_file(path)


def read_range(source, offset: int, length: int) -> bytes:
    source.seek(offset)
    data = source.read(length)
    if len(data) != length:
        raise OSError(f"short read: {len(data)} of {length} bytes at {offset}")
    return data
