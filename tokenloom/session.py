"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark import SparkConf, SparkContext
from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Waveforms and long token arrays are wide rows: keep Arrow batches small.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1024",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}
# sizes that only fit one machine
_LOCAL_DEFAULTS = {"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "16g"}


def _submitted(driver_memory: str) -> dict[str, str]:
    """Settings of the submitter (``spark-submit``, ``PYSPARK_SUBMIT_ARGS``, spark-defaults.conf).

    Reading them starts the JVM if there is none yet, which fixes the driver's memory.
    """
    args = os.environ.get("PYSPARK_SUBMIT_ARGS", "")
    memory = SparkConf(loadDefaults=False)
    if "driver-memory" not in args and "spark.driver.memory" not in args:
        memory.set("spark.driver.memory", driver_memory)
    SparkContext._ensure_initialized(conf=memory)
    given = dict(SparkConf(loadDefaults=True).getAll())
    given.pop("spark.ui.showConsoleProgress", None)  # PySpark's launcher sets it, not the submitter
    return given


def get_spark(master: str | None = None, app: str = "tokenloom", **conf: str) -> SparkSession:
    """Return (or create) a session with the defaults this library is tuned for.

    The submitter's settings win: defaults only go to keys that are not set, the sizes for one
    machine only to local masters. ``conf`` is set in any case. A running session is
    returned with ``conf`` applied and nothing else changed.
    """
    spark = SparkSession.getActiveSession()
    if spark is None:
        given = _submitted(conf.get("spark.driver.memory", _LOCAL_DEFAULTS["spark.driver.memory"]))
        local = (master or given.get("spark.master", "local")).startswith("local")
        defaults = {**_DEFAULTS, **(_LOCAL_DEFAULTS if local else {})}
        builder = SparkSession.builder.appName(app)
        if master:
            builder = builder.master(master)
        for k, v in {**{k: v for k, v in defaults.items() if k not in given}, **conf}.items():
            builder = builder.config(k, v)
        spark = builder.getOrCreate()
    else:
        for k, v in conf.items():
            if spark.conf.isModifiable(k):
                spark.conf.set(k, v)
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder used to cut lineage.

    Reads ``spark.checkpoint.dir`` from the session (the cluster names a shared
    folder there). Only when it is unset on a local master -- local runs and tests -- a
    private scratch folder is created and registered, and removed when the process ends.
    On a cluster an unset folder is an error: a machine-local one would lose files.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="tokenloom-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    atexit.register(shutil.rmtree, local, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", local)
    sc.setCheckpointDir(local)
    return local
