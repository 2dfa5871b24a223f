"""Arrays as plain files in the shared checkpoint folder, memory-mapped by workers.

A file is written under a name of its own and then renamed, so a retried or
speculative task leaves one whole file.  Where the folder is on a mounted file
system (``file:``), readers map the file and hold only the pages they touch;
on another store, which can't be mapped, they read the array into memory.
"""

from __future__ import annotations

import os
import re
import uuid

import numpy as np
from pyspark.sql import SparkSession

from ..session import ensure_checkpoint_dir


def new_folder(spark: SparkSession, name: str) -> str:
    """The URI of a fresh folder below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _local(folder: str) -> str | None:
    """The path of a folder on a mounted file system (``file:/x`` or a plain path)."""
    path = re.sub(r"^file:/*(?=/)", "", folder)
    return path if path.startswith("/") else None


def save(folder: str, name: str, array: np.ndarray) -> None:
    data, own = memoryview(np.ascontiguousarray(array)).cast("B") if array.size else b"", f"{name}.{uuid.uuid4().hex}"
    root = _local(folder)
    if root is not None:
        os.makedirs(root, exist_ok=True)
        with open(f"{root}/{own}", "wb") as out:
            out.write(data)
        os.replace(f"{root}/{own}", f"{root}/{name}")
        return
    from pyarrow import fs  # for other stores only: it takes memory
    store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)
    with store.open_output_stream(f"{root}/{own}") as out:
        out.write(data)
    store.move(f"{root}/{own}", f"{root}/{name}")


def load(folder: str, name: str, dtype: str) -> np.ndarray:
    """The array of a file; empty if there is no such file."""
    root = _local(folder)
    if root is not None:
        path = f"{root}/{name}"
        if not os.path.exists(path) or not os.path.getsize(path):
            return np.zeros(0, dtype)
        return np.memmap(path, dtype=dtype, mode="r")
    from pyarrow import fs
    store, root = fs.FileSystem.from_uri(folder)
    if store.get_file_info(f"{root}/{name}").type == fs.FileType.NotFound:
        return np.zeros(0, dtype)
    with store.open_input_file(f"{root}/{name}") as f:
        return np.frombuffer(f.read(), dtype)
