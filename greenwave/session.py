"""Session defaults, shared folders, lineage cuts and the code that Python workers need."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(app: str = "greenwave", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the operators are tuned for; cluster settings win."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables that the cluster names in ``spark.checkpoint.dir``.

    Only where the session names none and runs on one machine (tests) is it a folder of our own.
    """
    sc = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_KEY, None) or sc.getConf().get(CHECKPOINT_KEY) or sc.getCheckpointDir()
    if folder is None:
        if not sc.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder every executor can reach")
        folder = os.path.join(tempfile.mkdtemp(prefix="greenwave-"), "checkpoints")
        sc.setCheckpointDir(folder)
    return folder.rstrip("/")


def new_table_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no earlier run has used."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the cluster's shared checkpoint folder and read it back.

    Survives executor loss.
    """
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet into the shared folder and read back: less space than a checkpoint where values repeat."""
    path = new_table_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once for each application, so that Python workers started elsewhere can import it."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    top = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="greenwave-"), "greenwave.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(top):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("greenwave", os.path.relpath(full, top)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)
