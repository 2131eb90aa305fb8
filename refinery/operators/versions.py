"""Versioned tables: every rewrite is a folder of its own, and one pointer names the one that counts.

``<root>/v00000007`` holds a version, ``<root>/_current/00000007`` says that it is
complete.  A pointer is an empty file that appears by one rename onto a name that
must not exist yet, so a reader finds the old version or the new one, never none
and never a half; of two writers of the same number one fails.  A reader that has
resolved a version goes on with its files until :func:`prune` removes them.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from refinery.operators import maintenance
from refinery.session import hadoop_fs
from refinery.sources.readers import read_curated

POINTERS = "_current"


def _folder(root: str, number: int) -> str:
    return f"{root.rstrip('/')}/v{number:08d}"


def _numbers(spark: SparkSession, folder: str, prefix: str = "") -> list[int]:
    fs, path = hadoop_fs(spark, folder)
    if not fs.exists(path):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    return sorted(int(n[len(prefix):]) for n in names if n.startswith(prefix) and n[len(prefix):].isdigit())


def current(spark: SparkSession, root: str) -> int | None:
    """Number of the version that counts, or ``None`` before the first one."""
    return max(_numbers(spark, f"{root.rstrip('/')}/{POINTERS}"), default=None)


def read(spark: SparkSession, root: str, partition_cols: Sequence[str] = ()) -> DataFrame:
    """The table as its current version holds it; partition values keep their text."""
    number = current(spark, root)
    if number is None:
        raise FileNotFoundError(f"no version of {root} has been published")
    return read_curated(spark, _folder(root, number), partition_cols)


def publish(spark: SparkSession, root: str, write: Callable[[str], None]) -> int:
    """Let ``write`` fill the folder of a new version and make it the current one; returns its number.

    What raises in ``write`` leaves the table as it was.  A writer that comes second with a number fails at its
    rename, after its folder was filled; it starts anew with the next one.
    """
    root = root.rstrip("/")
    taken = _numbers(spark, root, "v") + _numbers(spark, f"{root}/{POINTERS}")
    number = max(taken, default=0) + 1
    write(_folder(root, number))
    fs, pointers = hadoop_fs(spark, f"{root}/{POINTERS}")
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs.mkdirs(pointers)
    draft, target = path(pointers, f"_{uuid.uuid4().hex}"), path(pointers, f"{number:08d}")
    fs.create(draft).close()
    if fs.exists(target) or not fs.rename(draft, target):
        fs.delete(draft, False)
        raise RuntimeError(f"version {number} of {root} was published by another writer")
    return number


def compact(spark: SparkSession, root: str, layout: maintenance.Layout) -> int:
    """Publish a copy of the current version with few, right-sized files, checked against what it was made from."""
    number = current(spark, root)
    if number is None:
        raise FileNotFoundError(f"no version of {root} has been published")
    path = _folder(root, number)
    df = read_curated(spark, path, layout.partition_cols)
    files = maintenance.target_files(maintenance.size_mb(spark, path), layout.target_file_mb, layout.default_files)
    return publish(spark, root, lambda out: maintenance._rewrite_checked(spark, df, path, out, layout, files))


def prune(spark: SparkSession, root: str, keep: int = 2) -> list[int]:
    """Remove all but the last ``keep`` published versions (at least the current one) and older unpublished folders."""
    root = root.rstrip("/")
    published = _numbers(spark, f"{root}/{POINTERS}")
    if not published:
        return []
    stay = published[-max(1, keep):]
    gone = [n for n in _numbers(spark, root, "v") if n < stay[-1] and n not in stay]
    for n in gone:  # the pointer first: no reader may resolve a version that is going
        if n in published:
            maintenance.delete(spark, f"{root}/{POINTERS}/{n:08d}", False)
        maintenance.delete(spark, _folder(root, n))
    return gone
