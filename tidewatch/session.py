"""Session settings and the folder that all executors share."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(master: str | None = None, app: str = "tidewatch", **conf: str) -> SparkSession:
    """A session with the settings every job here relies on. ``master`` is left to spark-submit
    unless given."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # stream state may outgrow the heap
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.ui.enabled": "false",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship(spark: SparkSession) -> None:
    """Gives the session's Python workers this package, once a session, wherever the job was started."""
    sc = spark.sparkContext
    if getattr(sc, "_tidewatch_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    # the driver serves the archive to its executors
    archive = os.path.join(tempfile.mkdtemp(prefix="tidewatch-"), "tidewatch.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
    sc.addPyFile(archive)
    sc._tidewatch_shipped = True


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder of the session. Where none is set, a local run gets a scratch folder;
    a cluster has to name one, since a machine-local folder would be lost with its executor."""
    sc = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_CONF, None) or sc.getCheckpointDir()
    if not folder:
        if not sc.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors can reach")
        folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(folder)
    return folder


def stored(df: DataFrame, name: str = "stored") -> DataFrame:
    """The frame written to the shared folder once and read back: its lineage is cut, it survives
    the loss of an executor, and readers only fetch the columns they use."""
    path = new_table_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def new_table_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no earlier run has used."""
    import uuid

    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
