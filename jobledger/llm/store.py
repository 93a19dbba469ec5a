"""A folder for array files that all workers can map.

The folder lies below ``spark.checkpoint.dir``, which driver and executors
share. Mapping needs a mounted folder (``file:`` or a plain path); any other
scheme is refused with a clear error rather than replaced by a local folder.
"""

from __future__ import annotations

import json
import os
import uuid
from urllib.parse import unquote, urlparse

import numpy as np
from pyspark.sql import SparkSession

from jobledger.session import checkpoint_dir


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder, for Spark's readers and writers."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one, as a path that ``open`` takes."""
    url = urlparse(shared_path(spark, name))
    if url.scheme not in ("", "file"):
        raise ValueError(f"array files need a mounted shared folder; spark.checkpoint.dir is {url.scheme}:")
    path = unquote(url.path)
    os.makedirs(path, exist_ok=True)
    return path


def save(path: str, arrays: dict[str, np.ndarray]) -> int:
    """Write named arrays as one file, so that a repeated or parallel attempt
    does no harm; its size in bytes."""
    table, at = {}, 0
    for name, a in arrays.items():
        table[name] = (a.dtype.str, a.shape, at)
        at += -(-a.nbytes // 64) * 64
    head = json.dumps(table).encode()
    first = -(-(8 + len(head)) // 64) * 64
    part = f"{path}.{uuid.uuid4().hex}"
    with open(part, "wb") as f:
        f.write(len(head).to_bytes(8, "little") + head)
        for name, a in arrays.items():
            f.seek(first + table[name][2])
            f.write(np.ascontiguousarray(a).tobytes())
        f.truncate(first + at)
    os.replace(part, path)
    return first + at


def load(path: str, size: int) -> dict[str, np.ndarray]:
    """The arrays of a file that ``save`` wrote with ``size`` bytes, mapped. A
    file that is not there, or not whole, is an error: a folder that an
    executor does not see never counts as an empty model."""
    if not os.path.exists(path) or os.path.getsize(path) != size:
        raise FileNotFoundError(f"{path} is missing or not {size} bytes long; do all executors see the shared folder?")
    raw = np.memmap(path, np.uint8, "r").view(np.ndarray)
    n = int.from_bytes(raw[:8].tobytes(), "little")
    first = -(-(8 + n) // 64) * 64
    out = {}
    for name, (kind, shape, at) in json.loads(raw[8: 8 + n].tobytes()).items():
        count = int(np.prod(shape))
        out[name] = raw[first + at: first + at + count * np.dtype(kind).itemsize].view(kind).reshape(shape)
    return out


def share(spark: SparkSession, value):
    """Broadcast a fitted model of bounded size; the result, called in a task,
    gives it. Packed by cloudpickle, so that executors need no package."""
    import pickle

    from pyspark import cloudpickle

    packed = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(packed.value)
