"""File access inside tasks, through Arrow's file systems."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import SparkSession

from refinery.session import ship_package

#: bytes that one task copies when files are joined, and those it holds at a time
PIECE_BYTES = 64 << 20
CHUNK_BYTES = 1 << 20


def open_path(path: str):
    """(file system, path on it) of a path as Spark prints it (``file:/...``, ``scheme://host/...`` or plain)."""
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[len("file:"):].lstrip("/")
    if "://" not in path:
        return pafs.LocalFileSystem(), path
    return pafs.FileSystem.from_uri(quote(path, safe=":/"))


def remove_file(path: str) -> bool:
    """Delete one file (and a local checksum file beside it); False where it was gone already."""
    fs, p = open_path(path)
    if fs.get_file_info(p).type != pafs.FileType.File:
        return False
    fs.delete_file(p)
    folder, _, name = p.rpartition("/")
    side = f"{folder}/.{name}.crc"
    if fs.get_file_info(side).type == pafs.FileType.File:
        fs.delete_file(side)
    return True


def copied_pieces(batches):
    """Arrow batches of (path, start, length, target, at) -> the bytes copied from each ``path`` to ``at`` in ``target``.

    A task that is run again writes the same bytes to the same place.
    """
    for batch in batches:
        for path, start, length, target, at in zip(*(c.to_pylist() for c in batch.columns[:5])):
            fs, p = open_path(path)
            with fs.open_input_file(p) as src, open(open_path(target)[1], "r+b") as out:
                src.seek(start)
                out.seek(at)
                left = length
                while left:
                    data = src.read(min(left, CHUNK_BYTES))
                    if not data:
                        raise EOFError(f"{path} ends {left} bytes early")
                    out.write(data)
                    left -= len(data)
        yield pa.RecordBatch.from_pydict({"bytes": batch.column(2)})


def join_local(spark: SparkSession, head: bytes, parts: Sequence[tuple[str, int]], target: str,
               piece: int | None = None) -> int:
    """One file of ``head`` and the parts' bytes in the given order, on a file system that driver and executors mount;
    returns its size.

    The file is made in its whole length, then each task copies a piece of a part to its place, so no task handles
    more than ``piece`` bytes.  The driver sees names and sizes.
    """
    ship_package(spark)
    piece = piece or PIECE_BYTES
    rows, at = [], len(head)
    for path, size in parts:
        rows += [(path, start, min(piece, size - start), target, at + start, len(rows) + i)
                 for i, start in enumerate(range(0, size, piece))]
        at += size
    with open(open_path(target)[1], "wb") as out:
        out.write(head)
        out.truncate(at)
    if rows:
        dealt = spark.createDataFrame(rows, "path string, start long, length long, target string, at long, no int")
        done = dealt.repartitionById(len(rows), "no").mapInArrow(copied_pieces, "bytes long").agg({"bytes": "sum"}).first()[0]
        if done != at - len(head):
            raise RuntimeError(f"{target}: {done} bytes copied of {at - len(head)}")
    return at
