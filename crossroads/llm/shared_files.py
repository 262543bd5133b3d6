"""Files in the shared folder from inside tasks: written under a name of the attempt, then renamed, so that repeated tasks agree."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable
from functools import lru_cache

import numpy as np
from pyarrow import fs


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    system, path = fs.FileSystem.from_uri(uri)
    return system, path.rstrip("/")


def write_file(uri: str, name: str, fill: Callable) -> None:
    """``fill`` gets an open output stream; the file appears under its name when it is whole."""
    system, path = open_folder(uri)
    system.create_dir(path, recursive=True)
    attempt = f"{path}/.{name}-{uuid.uuid4().hex}"
    with system.open_output_stream(attempt) as out:
        fill(out)
    system.move(attempt, f"{path}/{name}")


def read_file(uri: str, name: str) -> bytes:
    system, path = open_folder(uri)
    with system.open_input_file(f"{path}/{name}") as f:
        return f.read()


def open_file(uri: str, name: str):
    """A file for reads at any place."""
    system, path = open_folder(uri)
    return system.open_input_file(f"{path}/{name}")


@lru_cache(maxsize=64)
def _local_copy(uri: str, name: str) -> str:
    handle, path = tempfile.mkstemp(prefix="mapped-")
    with os.fdopen(handle, "wb") as out:
        out.write(read_file(uri, name))
    return path


def mapped_file(uri: str, name: str) -> np.ndarray:
    """A file as a read-only map of bytes. A store that cannot be mapped is copied to this machine first, once a worker."""
    system, path = open_folder(uri)
    local = f"{path}/{name}" if isinstance(system, fs.LocalFileSystem) else _local_copy(uri, name)
    return np.memmap(local, np.uint8, "r") if os.path.getsize(local) else np.zeros(0, np.uint8)
