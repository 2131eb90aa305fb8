"""Session helpers: a builder for scripts and a shared scratch folder.

Scratch data (landing round trips, compaction copies, stream checkpoints,
written intermediate tables) lives under the folder the cluster names in
``spark.checkpoint.dir``, so it is visible to every executor and survives
executor loss.  Where that setting is missing (tests), a folder inside the
SQL warehouse is used, which executors share as well; the executors' own disks
are never used.  Folders made by this process are removed when it ends.
"""

from __future__ import annotations

import atexit
import io
import uuid
import zipfile
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import SparkSession

_made: list[str] = []


def build_session(master: str | None = None, app_name: str = "refinery",
                  shuffle_partitions: int | None = None) -> SparkSession:
    """Session with AQE on (runtime coalescing, skew-join splitting, rebalance)."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    b = (b.config("spark.ui.enabled", "false")
          .config("spark.ui.showConsoleProgress", "false")
          .config("spark.sql.adaptive.enabled", "true")
          .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
          .config("spark.sql.adaptive.skewJoin.enabled", "true")
          .config("spark.sql.session.timeZone", "UTC")
          .config("spark.sql.parquet.compression.codec", "snappy"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return b.getOrCreate()


def _context(spark: SparkSession):
    try:
        return spark.sparkContext
    except Exception:  # a Spark Connect session has no SparkContext
        return None


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder; inside the SQL warehouse only where the setting is missing (tests)."""
    sc = _context(spark)
    if sc is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("spark.checkpoint.dir must name a shared folder")
        return configured
    if not sc.getCheckpointDir():
        configured = sc.getConf().get("spark.checkpoint.dir", None)
        sc.setCheckpointDir(configured or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch")
    return sc.getCheckpointDir()


def hadoop_fs(spark: SparkSession, path: str):
    """(FileSystem, Path) of a path, through Spark's own Hadoop configuration."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), jpath


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for one run; removed when the process ends."""
    path = f"{checkpoint_root(spark).rstrip('/')}/refinery/{name}-{uuid.uuid4().hex[:12]}"
    if _context(spark) is not None:
        fs, jpath = hadoop_fs(spark, path)
        fs.mkdirs(jpath)
        if not _made:
            atexit.register(_remove_made)
        _made.append(path)
    return path


def remove_dir(spark: SparkSession, path: str) -> None:
    """Delete one folder that :func:`scratch_dir` made."""
    if path not in _made:
        raise ValueError(f"not a scratch folder of this process: {path}")
    fs, jpath = hadoop_fs(spark, path)
    fs.delete(jpath, True)
    _made.remove(path)


def _remove_made() -> None:
    spark = SparkSession.getActiveSession()
    if spark is None or _context(spark) is None:
        return
    for path in list(_made):
        try:
            remove_dir(spark, path)
        except Exception:  # the JVM may have ended already; nothing depends on the removal
            return


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application.

    Tasks import it there; an application that is submitted with the package on
    every machine (or with ``--py-files``) loses nothing by it.
    """
    sc = _context(spark)
    if sc is None or any(f.startswith("refinery-") for f in sc._python_includes):
        return
    packed = io.BytesIO()
    root = Path(__file__).parent
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f"refinery/{f.relative_to(root)}")
    fs, path = hadoop_fs(spark, f"{scratch_dir(spark, 'package')}/refinery-{uuid.uuid4().hex[:8]}.zip")
    out = fs.create(path)
    out.write(packed.getvalue())
    out.close()
    sc.addPyFile(path.toString())


@contextmanager
def session_conf(spark: SparkSession, settings: dict[str, str | None]):
    """Set SQL settings for the statements run inside the block, then restore them."""
    conf = spark.conf
    previous = {k: conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            if v is not None:
                conf.set(k, v)
        yield
    finally:
        for k, v in previous.items():
            if settings[k] is None:
                continue
            if v is None:
                conf.unset(k)
            else:
                conf.set(k, v)
