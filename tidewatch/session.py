"""Session helpers.

The library never hard-codes cluster paths.  The checkpoint folder is read
from ``spark.checkpoint.dir``; only a single-machine session without that
setting gets a temporary folder.
"""

from __future__ import annotations

import os
import re
import shutil
import tempfile

from pyspark.sql import SparkSession

_SHIPPED: set = set()

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "tidewatch", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Make ``tidewatch`` importable on executors (grouped-map functions
    are pickled by reference): zip the package once per application and
    ``addPyFile`` it."""
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    base = os.path.join(tempfile.mkdtemp(prefix="tidewatch-pkg-"), "tidewatch")
    archive = shutil.make_archive(base, "zip", root_dir=os.path.dirname(pkg), base_dir="tidewatch")
    sc.addPyFile(archive)
    _SHIPPED.add(app)


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    ``fallback`` is installed only when the session names none.  Without
    either, a single-machine session (``local[n]``) gets a temporary folder
    of its own; a cluster session raises, because a machine-local folder
    there would be another disk on every node.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if fallback is None:
            if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
                raise RuntimeError("spark.checkpoint.dir is not set; name a folder that all executors share")
            fallback = tempfile.mkdtemp(prefix="tidewatch-checkpoint-")
        current = fallback
        spark.conf.set("spark.checkpoint.dir", current)
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(current)
    return current


def shared_folder(spark: SparkSession) -> str:
    """Folder for tables written between phases, readable by every executor."""
    return checkpoint_dir(spark).rstrip("/")


def materialize(df):
    """Cut lineage: reliable ``checkpoint()`` into the shared checkpoint
    folder named by ``spark.checkpoint.dir``.  Used where an intermediate
    feeds several passes, so upstream scans and shuffles run once; files
    survive executor loss."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def clean_shared(spark: SparkSession, older_than_seconds: float = 7 * 86_400) -> list[str]:
    """Delete what earlier runs left in the shared folder: tables between
    phases, stream runs and checkpoints that were last written more than
    ``older_than_seconds`` ago.  Results are lazy and read those files, so
    this is a job of its own, for an age at which no result is still read;
    the checkpoints of the running application are never touched.  Returns
    the deleted paths."""
    import time
    root = checkpoint_dir(spark).rstrip("/")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    own = path(spark.sparkContext._jsc.sc().getCheckpointDir().get()).getName()
    limit, gone = (time.time() - older_than_seconds) * 1000, []
    # runs of operators, of streams, tables of queries; checkpoints have one folder per application
    for pattern in ("tidewatch-llm/*", "streams/*/*", "tables/*", "????????-????-????-????-????????????"):
        for x in fs.globStatus(path(f"{root}/{pattern}")) or []:
            newest, inside = x.getModificationTime(), fs.listFiles(x.getPath(), True)
            while inside.hasNext():
                newest = max(newest, inside.next().getModificationTime())
            if newest < limit and x.getPath().getName() != own:
                fs.delete(x.getPath(), True)
                gone.append(x.getPath().toString())
    return gone
