"""Session construction and lineage cutting."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "leasegrid", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings every operator here assumes (UTC, AQE, Arrow)."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # checkpoints go when nothing refers to them any more
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **{k.replace("__", "."): v for k, v in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder of the cluster.

    ``spark.checkpoint.dir`` wins. Only a local master without that setting
    gets a temporary folder, which goes with the process; a cluster without it is
    a configuration error, because a machine-local folder would be lost with its
    machine.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir")
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="leasegrid-")
        atexit.register(shutil.rmtree, configured, ignore_errors=True)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh folder name below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: later reads see one frozen, recoverable copy."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def exchanged(df: DataFrame) -> DataFrame:
    """A join side that is exchanged by key and never sent whole through the driver.

    The planner's estimate is the pruned file size: many copies compress to few
    bytes, and rows exploded since do not count. Tables under the broadcast
    limit by that estimate can be far beyond the driver's memory.
    """
    return df.hint("merge")
