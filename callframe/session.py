"""Session helpers.

``configure`` sets the runtime SQL options the jobs rely on; it is called
by every registered query so the jobs behave the same on a session that
someone else built (a cluster's, a test's).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Runtime options every job relies on.
_RUNTIME_CONF = {
    # Python's json.loads keeps the last of duplicate keys; VARIANT parsing
    # rejects them unless told otherwise.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in _RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def get_session(master: str | None = None, app: str = "callframe",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session. On a cluster pass ``master=None`` and let
    spark-submit decide; tests and the bench pass ``local[N]``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false")
    if master and master.startswith("local"):
        # local mode: the driver is the only JVM
        builder = builder.config("spark.driver.memory", os.environ.get("CALLFRAME_DRIVER_MEMORY", "8g"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``. Only a local-mode
    session (tests, the bench) without one gets a folder under the local
    temp directory; on a cluster a missing setting is an error, because a
    machine-local folder would not survive a lost executor."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
        path = jdir.get() if jdir.isDefined() else None
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder for streaming checkpoints "
                               "and intermediate tables")
        path = tempfile.mkdtemp(prefix="callframe-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", path)
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder."""
    import uuid
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def make_folder(spark: SparkSession, path: str) -> None:
    folder, files = _folder(spark, path)
    files.mkdirs(folder)


def drop_scratch(spark: SparkSession, *paths: str) -> None:
    """Remove intermediate folders that no result reads any more."""
    for path in paths:
        folder, files = _folder(spark, path)
        files.delete(folder, True)
