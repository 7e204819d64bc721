"""Shared helpers: staged tables, files written by tasks, batch slicing."""

from __future__ import annotations

import atexit
import ctypes
import io
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import suppress
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

import squall
from squall.session import shared_dir

# text handled at once inside a task; longer single texts are handled alone
SLICE_BYTES = 16 << 20

WORD = r"[^\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give executors this package, once per application, so that functions
    run in tasks can import it wherever the driver found it."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    top = Path(squall.__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="squall-py-")) / "squall_package.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for p in sorted(top.rglob("*.py")):
            out.write(p, p.relative_to(top.parent))
    sc.addPyFile(str(archive))
    _SHIPPED.add(sc.applicationId)


def scratch(spark: SparkSession, prefix: str) -> str:
    """A new path under the cluster's shared checkpoint folder.

    Spark or a task creates it on first write; it is removed when the driver
    process ends, because lazily returned DataFrames still read it until then.
    """
    path = shared_dir(spark, f"{prefix}-{uuid.uuid4().hex[:12]}")
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[len("file:"):]
    atexit.register(_remove, spark, path)
    return path


def _remove(spark: SparkSession, path: str) -> None:
    with suppress(Exception):  # the session may already be gone
        jvm = spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def stage(df: DataFrame, prefix: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: cuts the
    lineage, so a lost executor never forces the work behind it to be redone,
    and fixes values that later steps read more than once."""
    path = scratch(df.sparkSession, prefix)
    df.write.parquet(path)
    written = df.sparkSession.read.schema(df.schema).parquet(path)
    written.staged_at = path
    return written


def release(spark: SparkSession, *written: DataFrame | str) -> None:
    """Remove staged tables or scratch folders that nothing reads any more."""
    for table in written:
        _remove(spark, table if isinstance(table, str) else table.staged_at)


def placed(df: DataFrame) -> tuple[DataFrame, Column]:
    """``df`` and a column that tells its rows apart, the same in every scan.

    It is a hash of the file and the row's index in it, so it depends neither on
    how files are split nor on how many executors there are. A frame that is not
    read straight from Parquet is written to the shared folder first. Use it
    together with a key of the row where all rows of a corpus meet.
    """
    try:
        return df, _row_mark(df)
    except AnalysisException:
        df = stage(df, "input")
        return df, _row_mark(df)


def file_place(df: DataFrame) -> tuple[Column, Column]:
    """The file of each row of a frame read from Parquet, and the row's index in
    it; a column of the table that is called ``_metadata`` as well is not touched."""
    hidden = df.metadataColumn("_metadata")
    return hidden["file_path"], hidden["row_index"]


def _row_mark(df: DataFrame) -> Column:
    mark = F.xxhash64(*file_place(df))
    df.select(mark)  # fails if there is no file behind
    return mark


def give_back() -> None:
    """Return a task's free memory to the system: Python workers outlive their
    tasks, and what their allocators keep counts in later steps of a job."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # not every C library has it
        ctypes.CDLL(None).malloc_trim(0)


def task_file(folder: str, suffix: str, pid: int, seq: int, token: str) -> str:
    return f"{folder}/{pid:06d}-{token}-{seq:06d}{suffix}"


def attempt_token() -> str:
    """Part of the name of files that one task attempt writes. The committed
    manifest names the files of the attempt that won; others stay unread."""
    return uuid.uuid4().hex[:10]


def _located(uri: str) -> tuple[fs.FileSystem, str]:
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def write_file(uri: str, data) -> None:
    with create_file(uri) as out:
        out.write(data)


def create_file(uri: str) -> pa.NativeFile:
    store, path = _located(uri)
    store.create_dir(os.path.dirname(path), recursive=True)
    return store.open_output_stream(path, buffer_size=1 << 20)


def open_stream(uri: str) -> io.RawIOBase:
    store, path = _located(uri)
    return store.open_input_stream(path)


def read_file(uri: str) -> bytes:
    with open_stream(uri) as f:
        return f.read()


def folder_files(uri: str, suffix: str) -> list[pa.NativeFile]:
    """The files of a folder that Spark has written, open; none if there is no such folder."""
    store, path = _located(uri)
    found = store.get_file_info(fs.FileSelector(path, allow_not_found=True))
    return [store.open_input_file(f.path) for f in found if f.is_file and f.path.endswith(suffix)]


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a record batch into runs of rows of about equal text, ``most`` bytes
    each or a single row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    each = sizes.sum() / max(1, -(-int(sizes.sum()) // most))
    start = used = 0
    for i, n in enumerate(sizes.tolist()):
        if used and used + n / 2 > each:
            yield batch.slice(start, i - start)
            start, used = i, 0
        used += n
    if start < batch.num_rows:
        yield batch.slice(start)


def strings(column: pa.Array) -> pa.Array:
    """Text with nulls as empty strings and 64-bit offsets."""
    return pc.fill_null(column.cast(pa.large_string()), "")
