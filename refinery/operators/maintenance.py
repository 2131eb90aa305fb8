"""Table maintenance: small-file compaction with integrity checks, swap, retention.

File-system metadata (exists, size, rename, delete) goes through the Hadoop
``FileSystem`` API of the session, so it works on any cluster file system.
Data work (rewrite, verification) is Spark jobs:

* the rewrite reads the curated table with partition values kept as
  strings and writes it through ``REBALANCE(partition columns)`` with the
  target file size as AQE's advisory size: AQE splits a large (or hot)
  partition value across tasks and merges small ones, so every directory
  gets a few right-sized files (``coalesce(n)`` would leave up to n files
  per directory and could never raise the count);
* verification compares row count *and* an order-free checksum
  (sum of 64-bit row hashes as a decimal); the source's is observed while the
  rewrite reads it, the copy's is one aggregation;
* the incremental form rewrites only the partition folders whose file sizes
  ask for it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from refinery.functions import fixed
from refinery.session import session_conf, ship_package
from refinery.sources.files import remove_file
from refinery.sources.readers import read_curated


@dataclass(frozen=True)
class Layout:
    """Per-entity compaction settings."""
    partition_cols: list[str] = field(default_factory=list)
    default_files: int = 10
    target_file_mb: int = 128


SALES_LAYOUT = Layout(**fixed.SALES_LAYOUT)
CUSTOMERS_LAYOUT = Layout(**fixed.CUSTOMERS_LAYOUT)


# --- file-system metadata --------------------------------------------------------

def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def size_mb(spark: SparkSession, path: str) -> float:
    """Total bytes under ``path`` in MB (2 decimals); 0 when absent."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return 0.0
    return round(fs.getContentSummary(p).getLength() / (1024 ** 2), 2)


def delete(spark: SparkSession, path: str, recursive: bool = True) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.delete(p, recursive))


def rename(spark: SparkSession, src: str, dst: str) -> bool:
    fs, p = _fs(spark, src)
    return bool(fs.rename(p, spark.sparkContext._jvm.org.apache.hadoop.fs.Path(dst)))


def file_count(spark: SparkSession, path: str, glob: str = "*.parquet") -> int:
    """Number of files under ``path``; counted in Spark, no name reaches the driver's Python."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
            .load(path).select("length").count())


def target_files(size: float, target_file_mb: int, default: int, forced: int | None = None) -> int:
    """Forced value wins; else max(1, int(size / target)); unknown size -> default."""
    if forced:
        return int(forced)
    if size > 0:
        return max(1, int(size / target_file_mb))
    return default


# --- integrity ---------------------------------------------------------------------

def _fingerprint_columns(cols: Sequence[str]) -> list:
    parts = [x for c in cols for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    h = F.xxhash64(*parts).cast("decimal(38,0)")
    return [F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(h), F.lit(0)).cast("string").alias("checksum")]


def fingerprint(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One row: row count and order-free checksum (sum of xxhash64 as decimal).

    The hash skips nulls, so every column goes in with its null flag: a value
    that moves to another column across a null changes the checksum.
    """
    return df.agg(*_fingerprint_columns(list(cols or sorted(df.columns))))


def watched(df: DataFrame, name: str = "fingerprint") -> tuple[DataFrame, Observation]:
    """``df`` and an observation that holds its fingerprint once a job has read it: no scan of its own."""
    obs = Observation(name)
    return df.observe(obs, *_fingerprint_columns(sorted(df.columns))), obs


def verify_same(before: DataFrame, after: DataFrame, seen: dict | None = None) -> dict:
    """Compare count and checksum of two DataFrames over the same columns.

    ``seen`` is the fingerprint of ``before`` that was observed while it was written.  A task that ran twice may
    have been observed twice, so where it differs ``before`` is read to decide.
    """
    cols = sorted(before.columns)
    b = fingerprint(after.select(*[f"`{c}`" for c in cols]), cols).first()
    same = lambda x: x["rows"] == b["rows"] and x["checksum"] == b["checksum"]
    a = seen if seen is not None and same(seen) else fingerprint(before, cols).first()
    return {"rows_before": a["rows"], "rows_after": b["rows"], "same": same(a)}


# --- compaction ----------------------------------------------------------------------

def _dirs(df: DataFrame, partition_cols: Sequence[str]) -> list[tuple]:
    return [tuple(r) for r in df.select(*partition_cols).distinct().collect()]  # one per directory


def rewrite(df: DataFrame, out_path: str, partition_cols: Sequence[str], n_files: int,
            target_file_mb: int = 128, forced: bool = False, dirs: Sequence[tuple] | None = None) -> None:
    """Rewrite with few, right-sized files.

    Partitioned layouts go through ``REBALANCE(partition columns)`` with AQE's
    advisory partition size set to the target file size: every directory is
    written by one task, and a directory larger than the target is split
    over several tasks (one file each).  With ``forced``, ``n_files`` is shared
    out over the directories: rows of a directory are dealt by a hash into
    ``n_files / directories`` parts (at least one), each a file of its own.
    Unpartitioned tables are cut into ``n_files``.  ``dirs`` (the directories' values) saves the
    forced form a look at the data.
    """
    settings: dict[str, str | None] = {}
    if partition_cols and forced:
        dirs = _dirs(df, partition_cols) if dirs is None else list(dirs)
        parts = max(1, round(n_files / max(1, len(dirs))))
        names = [f"_dir_{c}" for c in partition_cols]
        known = df.sparkSession.createDataFrame([(*d, i * parts) for i, d in enumerate(dirs)],
                                                ", ".join(f"{n} string" for n in names) + ", _first int")
        same = [df[c].eqNullSafe(known[n]) for c, n in zip(partition_cols, names)]
        row = F.xxhash64(*[x for c in df.columns for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())])
        dealt = df.withColumn("_deal", F.pmod(row, F.lit(parts)).cast("int")).join(F.broadcast(known), same)
        out = (dealt.repartitionById(max(1, len(dirs) * parts), F.col("_first") + F.col("_deal"))
               .select(*[f"`{c}`" for c in df.columns]))
    elif partition_cols:
        out = df.hint("rebalance", *partition_cols)
        settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{int(target_file_mb)}m",
                    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k"}
    else:
        out = df.repartition(int(n_files))
    with session_conf(df.sparkSession, settings):
        (out.write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", "snappy")
            .partitionBy(*partition_cols).parquet(out_path))


def compact(spark: SparkSession, path: str, out_path: str, layout: Layout,
            forced_files: int | None = None) -> dict:
    """Rewrite ``path`` into ``out_path`` with fewer, larger files and verify it.

    Raises ``RuntimeError`` (leaving ``out_path`` in place for inspection)
    when the rewritten copy differs in row count or checksum.
    """
    before_mb = size_mb(spark, path)
    n = target_files(before_mb, layout.target_file_mb, layout.default_files, forced_files)
    df = read_curated(spark, path, layout.partition_cols)
    files_before = file_count(spark, path)
    rows = _rewrite_checked(spark, df, path, out_path, layout, n, bool(forced_files))
    after_mb = size_mb(spark, out_path)
    reduction = round(100 * (1 - after_mb / before_mb), 2) if before_mb > 0 else 0.0
    return {"path": path, "target_files": n, "files_before": files_before,
            "files_after": file_count(spark, out_path), "rows": rows,
            "size_mb_before": before_mb, "size_mb_after": after_mb, "reduction_pct": reduction}


def _rewrite_checked(spark: SparkSession, df: DataFrame, path: str, out_path: str, layout: Layout, n_files: int,
                     forced: bool = False) -> int:
    """Rewrite ``df`` and hold the copy against what the write read: the source is read once, the copy once."""
    seen_df, seen = watched(df)
    dirs = _dirs(df, layout.partition_cols) if forced and layout.partition_cols else None
    rewrite(seen_df, out_path, layout.partition_cols, n_files, layout.target_file_mb, forced, dirs)
    check = verify_same(df, read_curated(spark, out_path, layout.partition_cols), seen.get)
    if not check["same"]:
        raise RuntimeError(f"compaction integrity check failed for {path}: {check}")
    return check["rows_after"]


# --- incremental compaction ------------------------------------------------------------

def folder_sizes(spark: SparkSession, path: str, glob: str = "*.parquet") -> DataFrame:
    """``folder``, ``files`` and ``bytes`` of every folder with files under ``path``: a listing, no file is read."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
             .load(path).select("path", "length"))
    return files.groupBy(F.regexp_replace("path", "/[^/]*$", "").alias("folder")).agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))


def untidy_folders(spark: SparkSession, path: str, target_file_mb: int) -> DataFrame:
    """The folders that hold more files than their bytes fill at the target size."""
    target = target_file_mb * 1024 * 1024
    return folder_sizes(spark, path).where(F.col("files") > F.greatest(F.lit(1), F.ceil(F.col("bytes") / target)))


def restore_folders(spark: SparkSession, current: str, backup: str, folders: Sequence[str]) -> list[str]:
    """Move back those of the named folders whose swap broke off between its two moves."""
    back = [f for f in folders if not exists(spark, f"{current}/{f}") and exists(spark, f"{backup}/{f}")]
    for f in back:
        rename(spark, f"{backup}/{f}", f"{current}/{f}")
    return back


def _relative(spark: SparkSession, root: str, folder: str) -> str:
    fs, p = _fs(spark, root)
    whole = fs.makeQualified(p).toString().rstrip("/")
    if not folder.startswith(whole):
        raise ValueError(f"{folder} is not under {whole}")
    return folder[len(whole):].strip("/")


def swap_folder(spark: SparkSession, current: str, compacted: str, backup: str, folder: str) -> None:
    """Replace one partition folder of a table; the old one is kept under ``backup``, and put back if the move fails."""
    parent = f"{backup}/{folder}".rsplit("/", 1)[0]
    fs, p = _fs(spark, parent)
    fs.mkdirs(p)
    if exists(spark, f"{backup}/{folder}"):
        delete(spark, f"{backup}/{folder}")
    swap(spark, f"{current}/{folder}", f"{compacted}/{folder}", f"{backup}/{folder}")


def compact_untidy(spark: SparkSession, path: str, tmp: str, backup: str, layout: Layout) -> dict:
    """Compact only the partition folders that need it; the others are neither read nor moved.

    A listing of file sizes chooses the folders; they are rewritten together, checked, and then replaced
    one by one, so a reader finds all but the folder at hand.  What a broken-off run moved away is first put
    back.  A second run finds nothing to do.  The driver handles names of chosen folders only.
    """
    if exists(spark, backup):
        kept = [_relative(spark, backup, r["folder"]) for r in folder_sizes(spark, backup).select("folder").collect()]
        restore_folders(spark, path, backup, kept)
    if exists(spark, tmp):
        delete(spark, tmp)
    before_mb = size_mb(spark, path)
    chosen = untidy_folders(spark, path, layout.target_file_mb).collect()
    report = {"path": path, "folders": len(chosen), "files_before": sum(r["files"] for r in chosen), "files_after": 0,
              "rows": 0, "size_mb_before": before_mb, "size_mb_after": before_mb, "reduction_pct": 0.0}
    if not chosen:
        return report
    schema = read_curated(spark, path, layout.partition_cols).schema
    df = spark.read.schema(schema).option("basePath", path).parquet(*[r["folder"] for r in chosen])
    report["rows"] = _rewrite_checked(spark, df, path, tmp, layout, len(chosen))
    report["files_after"] = file_count(spark, tmp)
    for r in chosen:
        swap_folder(spark, path, tmp, backup, _relative(spark, path, r["folder"]))
    delete(spark, tmp)
    after_mb = size_mb(spark, path)
    report |= {"size_mb_after": after_mb, "reduction_pct": round(100 * (1 - after_mb / before_mb), 2)}
    return report


# --- swap --------------------------------------------------------------------------------

def swap(spark: SparkSession, current: str, compacted: str, backup: str) -> None:
    """Replace ``current`` by ``compacted``, keeping the old copy at ``backup``.

    Step 1 drops the previous backup, step 2 moves current -> backup, step 3
    moves compacted -> current; if step 3 fails, step 2 is undone.
    """
    if exists(spark, backup):
        delete(spark, backup)
    if not rename(spark, current, backup):
        raise RuntimeError(f"could not move {current} to {backup}")
    try:
        ok = rename(spark, compacted, current)
    except Exception:
        ok = False
    if not ok:
        rename(spark, backup, current)
        raise RuntimeError(f"could not move {compacted} to {current}; original restored")


def drop_backups(spark: SparkSession, backups: Sequence[str], dry_run: bool = True) -> list[str]:
    """Backups that exist (and are deleted unless ``dry_run``)."""
    present = [b for b in backups if exists(spark, b)]
    if not dry_run:
        for b in present:
            delete(spark, b)
    return present


def compact_all(spark: SparkSession, curated_root: str, layouts: dict[str, Layout],
                forced_files: int | None = None, cleanup_backups: bool = False, incremental: bool = False) -> DataFrame:
    """Compact every entity; failures are collected, the others still run.

    Returns one status row per entity (``incremental``: of the partition folders that needed it, ``UNCHANGED``
    where none did).  Where a crash between the two renames left a backup without its table, the backup is moved back
    first.  Backups are removed only when every entity was compacted and ``cleanup_backups`` is
    set: an entity that was skipped or failed keeps all of them.
    """
    rows, errors = [], []
    root = curated_root.rstrip("/")
    for entity, layout in layouts.items():
        cur, tmp, bak = f"{root}/{entity}", f"{root}/{entity}_compact_tmp", f"{root}/{entity}_backup"
        if not exists(spark, cur) and exists(spark, bak):
            rename(spark, bak, cur)
        if not exists(spark, cur):
            errors.append(entity)
            rows.append((entity, "SKIPPED", None, None, None, None, None, None, None, "path not found"))
            continue
        try:
            if incremental and layout.partition_cols:
                rep = compact_untidy(spark, cur, tmp, bak, layout)
            else:
                rep = compact(spark, cur, tmp, layout, forced_files)
                swap(spark, cur, tmp, bak)
            status = "UNCHANGED" if rep.get("folders") == 0 else "OK"
            rows.append((entity, status, rep["rows"], rep.get("folders"), rep["files_before"], rep["files_after"],
                         rep["size_mb_before"], rep["size_mb_after"], rep["reduction_pct"], None))
        except Exception as e:  # keep going, report at the end
            errors.append(entity)
            rows.append((entity, "FAILED", None, None, None, None, None, None, None, str(e)))
    if cleanup_backups and not errors:
        drop_backups(spark, [f"{root}/{e}_backup" for e in layouts], dry_run=False)
    return spark.createDataFrame(rows, "entity string, status string, rows long, folders int, files_before int, "
                                       "files_after int, size_mb_before double, size_mb_after double, "
                                       "reduction_pct double, error string")


# --- retention -----------------------------------------------------------------------

def expired_files(spark: SparkSession, root: str, as_of: dt.datetime, days: int = fixed.RETENTION_DAYS,
                  glob: str = "*.csv") -> DataFrame:
    """Files under ``root`` (recursive) last modified before ``as_of - days``.

    Uses the ``binaryFile`` source for the listing; the content column is
    never selected, so no file body is read.
    """
    cutoff = as_of - dt.timedelta(days=days)
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", glob).load(root).select("path", "modificationTime", "length"))
    return files.where(F.col("modificationTime") < F.lit(cutoff))


def delete_files(files: DataFrame) -> DataFrame:
    """Delete the files of the column ``path``, on the executors; returns ``path`` and ``deleted``.

    Only files go, never folders.  A file that is gone already (a task that is
    run again) is not an error.
    """
    spark = files.sparkSession
    ship_package(spark)

    def run(batches):
        for batch in batches:
            paths = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_pydict({"path": paths, "deleted": [remove_file(p) for p in paths]})

    dealt = files.select("path").repartition(spark.sparkContext.defaultParallelism)
    return dealt.mapInArrow(run, "path string, deleted boolean")


def purge(spark: SparkSession, root: str, as_of: dt.datetime, days: int = fixed.RETENTION_DAYS,
          glob: str = "*.csv", dry_run: bool = True) -> int:
    """Delete expired files (dry run by default); returns the number of expired files.

    Missing root -> 0.  One listing decides: exactly the files that it holds
    and that are older than the limit are deleted, each by itself, so files
    that land meanwhile and all folders stay.
    """
    if not exists(spark, root):
        return 0
    files = expired_files(spark, root, as_of, days, glob)
    return files.count() if dry_run else delete_files(files).count()
