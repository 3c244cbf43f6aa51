"""Flat binary files in the folder that driver and executors share.

Tasks write under a name that no other attempt uses and return it; only names in a committed manifest are read, so
files of failed or repeated attempts are ignored. Local files are memory-mapped; from other stores they are read whole.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession

from .session import shared_folder


def new_folder(spark: SparkSession, kind: str) -> str:
    """A fresh folder below the shared one, as a URI that tasks can open."""
    folder = f"{shared_folder(spark)}/{kind}-{uuid.uuid4().hex}"
    if folder.startswith("file:/") and not folder.startswith("file:///"):
        folder = "file:///" + folder[len("file:/") :].lstrip("/")
    store, path = fs.FileSystem.from_uri(folder)
    store.create_dir(path, recursive=True)
    return folder


def attempt_name(part: int) -> str:
    return f"{part:06d}-{uuid.uuid4().hex}"


def create(folder: str, name: str):
    """An output stream for a new file."""
    store, path = fs.FileSystem.from_uri(folder)
    return store.open_output_stream(f"{path}/{name}")


def mapped(folder: str, name: str, dtype) -> np.ndarray:
    """A file as a flat array, without a copy where it is local."""
    store, path = fs.FileSystem.from_uri(folder)
    if isinstance(store, fs.LocalFileSystem):
        source = pa.memory_map(f"{path}/{name}")
    else:
        source = store.open_input_file(f"{path}/{name}")
    buffer = source.read_buffer()
    return np.frombuffer(buffer, dtype)
