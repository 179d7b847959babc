"""Flat array files in the shared folder, written by tasks and memory-mapped by workers.

A file is written under a name of its own and renamed, so a task that runs twice leaves one whole file. In a
folder every machine has mounted, workers map the file itself; from any other store each machine fetches it
once into its temporary folder.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
import uuid

import numpy as np
from pyarrow import fs


def _at(folder: str) -> tuple[fs.FileSystem, str]:
    if "://" not in folder and folder.startswith("file:"):
        folder = folder.removeprefix("file:")
    return fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)


def make_folder(folder: str) -> None:
    system, path = _at(folder)
    system.create_dir(path, recursive=True)


def write_array(folder: str, name: str, values: np.ndarray) -> None:
    system, path = _at(folder)
    written = f"{path}/.{name}-{uuid.uuid4().hex}"
    with system.open_output_stream(written) as out:
        out.write(np.ascontiguousarray(values).tobytes())
    system.move(written, f"{path}/{name}")


def map_array(folder: str, name: str, dtype) -> np.ndarray:
    system, path = _at(folder)
    path = f"{path}/{name}"
    if not isinstance(system, fs.LocalFileSystem):
        local = os.path.join(tempfile.gettempdir(), hashlib.sha1(f"{folder}/{name}".encode()).hexdigest())
        if not os.path.exists(local):
            part = f"{local}-{uuid.uuid4().hex}"
            with system.open_input_stream(path) as source, open(part, "wb") as out:
                while block := source.read(1 << 22):
                    out.write(block)
            os.replace(part, local)
        path = local
    return np.memmap(path, dtype=dtype, mode="r") if os.path.getsize(path) else np.zeros(0, dtype)
