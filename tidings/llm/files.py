"""Raw arrays as files of a shared folder, written and read by tasks."""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow.fs
from pyspark.sql import SparkSession


def qualified(spark: SparkSession, path: str) -> str:
    """The path as Spark understands it, with its file system: one without a scheme lies in the default one."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(at).toString()


def _local(path: str) -> str | None:
    """The path of a mounted folder; None for other file systems."""
    if path.startswith("file:"):
        path = path[5:]
        return "/" + path.lstrip("/")
    return None if "://" in path else path


def _remote(folder: str) -> tuple:
    """The file system and path; the store that Hadoop calls s3a or s3n is s3 here."""
    return pyarrow.fs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", folder))


def save(folder: str, name: str, array: np.ndarray) -> None:
    """Writes a raw array; a task that runs twice leaves one whole file."""
    local = _local(folder)
    if local:
        os.makedirs(local, exist_ok=True)
        part = f"{local}/{name}.{uuid.uuid4().hex}"
        array.tofile(part)
        os.replace(part, f"{local}/{name}")
    else:
        fs, at = _remote(folder)
        fs.create_dir(at)
        with fs.open_output_stream(f"{at}/{name}") as out:
            out.write(array.tobytes())


@contextmanager
def appended(folder: str, name: str) -> Iterator[Callable[[bytes], object]]:
    """Writes a raw array piece by piece; it is there, whole, at the end."""
    local = _local(folder)
    if local:
        os.makedirs(local, exist_ok=True)
        part = f"{local}/{name}.{uuid.uuid4().hex}"
        with open(part, "wb") as out:
            yield out.write
        os.replace(part, f"{local}/{name}")
    else:
        fs, at = _remote(folder)
        fs.create_dir(at)
        with fs.open_output_stream(f"{at}/{name}") as out:
            yield out.write


def load_bytes(folder: str, name: str, share: tuple[int, int, int]) -> bytes:
    """Rows lo to hi of n equal ones that a file holds; no others are read."""
    local = _local(folder)
    fs, at = (pyarrow.fs.LocalFileSystem(), local) if local else _remote(folder)
    lo, hi, n = share
    with fs.open_input_file(f"{at}/{name}") as f:
        row = f.size() // n
        f.seek(lo * row)
        return f.read((hi - lo) * row)


def load(folder: str, name: str, kind) -> np.ndarray:
    """A raw array: mapped into memory where the folder is mounted, else read."""
    local = _local(folder)
    if local:
        return np.memmap(f"{local}/{name}", dtype=kind, mode="r")
    fs, at = _remote(folder)
    with fs.open_input_stream(f"{at}/{name}") as f:
        return np.frombuffer(f.read(), dtype=kind)
