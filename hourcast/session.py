"""Session helpers: a local session for tests/bench and the checkpoint dir."""
from __future__ import annotations

import atexit
import os
import re
import shutil
import zipfile

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, app: str = "hourcast",
              shuffle_partitions: int = 8) -> SparkSession:
    """Build (or reuse) a session with the settings the library relies on.

    ANSI mode stays on; the UI is off; timestamps are UTC; AQE re-plans joins
    and coalesces shuffle partitions at run time.
    """
    master = master or os.environ.get("SPARK_MASTER", "local[8]")
    spark = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        # coalesce shuffle output to the advisory size (64 MB) instead of keeping
        # at least the default parallelism: fewer tiny tasks, same size at scale
        .config("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", os.environ.get("SPARK_SESSION_TZ", "UTC"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    Reads ``spark.checkpoint.dir`` (or the SparkContext's dir). Where neither is
    set, a local session (one machine, as in tests) gets a scratch folder that
    goes with the process; on a cluster it is an error, as executors could not
    see a folder of the driver's machine.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not re.match(r"local(\[[^\[\]]*\])?$", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = _local_scratch()
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


def _local_scratch() -> str:
    import tempfile
    d = tempfile.mkdtemp(prefix="hourcast-ckpt-")
    atexit.register(shutil.rmtree, d, ignore_errors=True)
    return d


def importable(spark: SparkSession) -> None:
    """Put this package's folder on the Python workers' path (enough where
    driver and workers see the same folder, as in local mode)."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join(p for p in [root, *paths] if p)


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per application.

    For clusters whose machines do not have it installed; there, pandas and
    Arrow functions would fail with ModuleNotFoundError.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    folder = _local_scratch()  # the driver serves the file from here while it runs
    path = os.path.join(folder, "hourcast.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for base, _, names in os.walk(os.path.join(root, "hourcast")):
            for n in sorted(names):
                if n.endswith(".py"):
                    z.write(os.path.join(base, n), os.path.relpath(os.path.join(base, n), root))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


_SHIPPED: set = set()


def cut_lineage(df, eager: bool = True):
    """Reliable checkpoint into the shared checkpoint dir (never local)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)
