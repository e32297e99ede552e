"""Files that tasks write to and read from the folder the cluster shares.

A task never overwrites or renames: each attempt writes under a name of its own and hands that name on in
its rows. Rows of lost or repeated attempts are dropped by Spark, and with them the names.
"""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyarrow import fs


def located(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def own_name(folder: str, label: str, suffix: str) -> str:
    return f"{folder}/{label}-{uuid.uuid4().hex}{suffix}"


def make_folder(uri: str) -> None:
    system, path = located(uri)
    system.create_dir(path, recursive=True)


def writer(uri: str) -> pa.NativeFile:
    system, path = located(uri)
    return system.open_output_stream(path, compression=None)  # else a .gz name is packed twice


def reader(uri: str) -> pa.NativeFile:
    """Random access: memory-mapped where the folder is mounted, ranged reads elsewhere."""
    system, path = located(uri)
    if isinstance(system, fs.LocalFileSystem):
        return pa.memory_map(path)
    return system.open_input_file(path)
