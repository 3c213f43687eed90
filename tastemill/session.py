"""Session helpers: settings the plans rely on, and the shared folder for checkpoints."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

#: SQL settings every plan assumes; all can be changed at run time.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


#: Contexts (by application id) whose executors have been given the package.
_shipped: set[str] = set()


def ship_package(context: SparkContext) -> None:
    """Give the executors this package as a zip, once per context; workers import it from there."""
    if context.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    # made on the driver, which hands the file to every executor
    path = os.path.join(tempfile.mkdtemp(prefix="package-"), "tastemill.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(root)))
    context.addPyFile(path)
    _shipped.add(context.applicationId)


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to an existing session and give its executors the package."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    ship_package(spark.sparkContext)
    return spark


def local_session(cores: str = "8", app: str = "tastemill", memory: str = "8g") -> SparkSession:
    """Local session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach.

    The cluster names it in ``spark.checkpoint.dir``. Where that is unset, a session on one machine (tests, a laptop)
    gets a temporary folder; on a cluster that would be another disk on every executor, so it is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("spark.checkpoint.dir is not set: name a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="tastemill-")
    spark.conf.set("spark.checkpoint.dir", local)
    return local


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder for a table a plan writes and reads back."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives the loss of executors, keeps the partitions."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def for_training(df: DataFrame) -> DataFrame:
    """Checkpointed rows for a fit that reads them many times, in no fewer parts than cores.

    Counts of parts come from the checkpoint; a large table has enough and is
    not shuffled.
    """
    out = cut_lineage(df)
    cores = df.sparkSession.sparkContext.defaultParallelism
    return out if out.rdd.getNumPartitions() >= cores else cut_lineage(out.repartition(cores))
