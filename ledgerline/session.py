"""Session settings and the shared checkpoint folder.

All operators are plain DataFrame code; these settings are what they expect
from the session: UTC, ANSI casts, AQE with skew-join splitting and
partition coalescing, and a reliable checkpoint folder shared by the cluster.
"""

from __future__ import annotations

import os
import tempfile
import threading
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on. Shuffle partition count is sized by the caller
# (200+ on a cluster, 8 locally); AQE coalesces small ones at run time.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.csv.parser.columnPruning.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "ledgerline", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(SESSION_DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's checkpoint folder (``spark.checkpoint.dir``).

    Only a local session that names none (tests) gets a private folder; on a
    cluster a folder of one machine would be lost with it, so that raises.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # remote (Connect) session: the server's setting applies
        return spark.conf.get("spark.checkpoint.dir", None) or ""
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        master = sc.master or ""
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        configured = tempfile.mkdtemp(prefix="ledgerline-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


#: Lets an execution remove its shuffle files when it ends. Else they stay until
#: the driver's garbage is collected.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


_inside: dict[SparkSession, list] = {}
_lock = threading.Lock()


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """What runs inside removes its shuffle files; for results that become files
    of their own, which nothing computes again. Threads that share a session may
    overlap: the last one out gives the setting back."""
    with _lock:
        if spark not in _inside:
            _inside[spark] = [0, spark.conf.get(CLEANUP, "false")]
            spark.conf.set(CLEANUP, "true")
        _inside[spark][0] += 1
    try:
        yield
    finally:
        with _lock:
            _inside[spark][0] -= 1
            if not _inside[spark][0]:
                spark.conf.set(CLEANUP, _inside.pop(spark)[1])


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared folder.

    Used where a result must be read twice and must not be recomputed
    differently (sequence numbering, snapshot inputs). Survives executor loss.
    """
    ensure_checkpoint_dir(df.sparkSession)
    with freed_shuffles(df.sparkSession):
        return df.select("*").checkpoint(eager=True)  # a plan of its own: one made before keeps its shuffle files


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for job-private tables, below the checkpoint folder."""
    root = ensure_checkpoint_dir(spark)
    if root.startswith("file:"):
        root = root[len("file:"):]
    return os.path.join(root, "ledgerline")


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package.

    Where the driver's PYTHONPATH names the package's folder, workers have it
    too; otherwise the package is sent as a zip file through Spark, once per
    application."""
    root = Path(__file__).resolve().parents[1]
    given = [Path(p).resolve() for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    sc = spark.sparkContext
    if root in given or getattr(sc, "_ledgerline_shipped", False):
        return
    out = Path(tempfile.mkdtemp(prefix="ledgerline-code-")) / "ledgerline_code.zip"
    with zipfile.ZipFile(out, "w") as z:
        for f in sorted((root / "ledgerline").rglob("*.py")):
            z.write(f, f.relative_to(root))
    sc.addPyFile(str(out))
    sc._ledgerline_shipped = True
