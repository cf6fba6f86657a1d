"""What the operators' Spark tasks need: this package on the executors, and
whole files in the shared folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession

import lexisieve

_shipped: set[str] = set()
ARROW_BYTES = 12 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, once per application. Spark's own
    file distribution carries it."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(lexisieve.__file__))
    folder = tempfile.mkdtemp(prefix="lexisieve-zip-")
    target = os.path.join(folder, "lexisieve_pkg.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for base, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(base, name)
                    z.write(full, os.path.join("lexisieve", os.path.relpath(full, root)))
    sc.addPyFile(target)
    # Executors that start later fetch it from the driver: it stays until the driver ends.
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    _shipped.add(sc.applicationId)


def released(fn: Callable) -> Callable:
    """``fn``, which at the end of its task gives back what Arrow's memory pool
    holds unused. A Python worker outlives its task, and the pool would keep
    the most that any task has needed beside the JVM's work of later steps."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from fn(batches)
        finally:
            pa.default_memory_pool().release_unused()
    return run


def bound_batches(spark: SparkSession) -> None:
    """Batches of ``ARROW_BYTES`` at most (a longer row is one of its own): whole
    texts otherwise make batches of 64 MB, held by JVM and worker alike. The
    submitter's own setting stays."""
    if not spark.sparkContext.getConf().contains(_BATCH_SETTING):
        spark.conf.set(_BATCH_SETTING, str(ARROW_BYTES))


def map_arrow(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` with the package on the executors, in bounded batches."""
    ship_package(df.sparkSession)
    bound_batches(df.sparkSession)
    return df.mapInArrow(released(fn), schema)


def batch_rows(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    """A record batch from row tuples."""
    cols = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(cols, schema)], schema=schema)


def filesystem(location: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a location and the path on it. A location without a
    scheme is a local path; ``file:``, ``hdfs:``, ``s3:`` and ``gs:`` are known."""
    if location.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + location[5:].lstrip("/")
    if "://" not in location:
        return pafs.LocalFileSystem(), location
    return pafs.FileSystem.from_uri(location)


class WholeFile:
    """Writes a file under another name and renames it when complete: a lost
    or repeated task leaves one whole file under the final name."""

    def __init__(self, location: str):
        self.fs, self.path = filesystem(location)
        self.fs.create_dir(os.path.dirname(self.path), recursive=True)
        self.part = f"{os.path.dirname(self.path)}/_{uuid.uuid4().hex}.tmp"
        self.out = self.fs.open_output_stream(self.part, compression=None)

    def write(self, data: bytes) -> None:
        self.out.write(data)

    def tell(self) -> int:
        return self.out.tell()

    def close(self) -> None:
        self.out.close()
        self.fs.move(self.part, self.path)


def open_file(location: str) -> pa.NativeFile:
    fs, path = filesystem(location)
    return fs.open_input_file(path)
