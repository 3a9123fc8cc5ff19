"""Session helper.

Pins the settings the operators rely on: UTC session time zone (epoch and day
arithmetic), adaptive execution with skew-join splitting, Arrow for the few
pandas steps, and a checkpoint folder taken from the cluster configuration.
"""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def get_session(master: str | None = None, app: str = "tickforge",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the library expects."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = b.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    for k, v in _REQUIRED.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session (idempotent) and
    make the package importable by the Python workers."""
    for k, v in _REQUIRED.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # static conf on a shared session: leave as is
            pass
    checkpoint_dir(spark)
    ship_package(spark)
    return spark


_SHIPPED: set = set()
_ZIP: list = []


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers once per context
    (what ``--py-files`` does): the pandas steps are pickled by reference
    to their module, so workers must be able to import it."""
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    if not _ZIP:
        root = os.path.dirname(os.path.abspath(__file__))
        out = os.path.join(tempfile.mkdtemp(prefix="tickforge-pkg-"), "tickforge.zip")
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            for d, _, files in os.walk(root):
                for f in files:
                    if f.endswith(".py"):
                        full = os.path.join(d, f)
                        z.write(full, os.path.relpath(full, os.path.dirname(root)))
        _ZIP.append(out)
    sc.addPyFile(_ZIP[0])
    _SHIPPED.add(app)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the deployment (a shared file system) and is
    required.  Only in local mode, when it is unset (tests), a fresh scratch
    folder is made.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster "
                             "(checkpoints and intermediate tables are written there)")
        d = tempfile.mkdtemp(prefix="tickforge-ckpt-")   # local mode only (tests)
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def materialise(df):
    """Fix a table in the shared checkpoint folder, so that several uses read it instead of
    computing it again (and lost executors cost no recomputation of its inputs)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for an intermediate table under the shared checkpoint folder."""
    base = checkpoint_dir(spark)
    return os.path.join(base, "tables", name) if "://" not in base else f"{base.rstrip('/')}/tables/{name}"
