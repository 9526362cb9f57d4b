"""Session settings and the folder that all executors share."""

from __future__ import annotations

import hashlib
import io
import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build(master: str = "local[*]", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A session for tests and benches; on a cluster the caller brings its own."""
    builder = SparkSession.builder.master(master).appName("fairlead")
    for key, value in {**DEFAULTS, "spark.sql.shuffle.partitions": str(shuffle_partitions), **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Only a local master without that setting gets a temporary one."""
    known = spark.conf.get("spark.checkpoint.dir", None)
    if known:
        return known
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    own = os.path.join(tempfile.gettempdir(), f"fairlead-{spark.sparkContext.applicationId}")
    spark.conf.set("spark.checkpoint.dir", own)
    return own


def settle(df: DataFrame) -> DataFrame:
    """Write df once to the shared folder and go on from there, so that no later stage runs its lineage again."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def ship(spark: SparkSession) -> None:
    """Give the package to the executors once per application, so that their Python finds it wherever the driver's came from."""
    sc = spark.sparkContext
    if getattr(sc, "_fairlead_shipped", False):
        return
    sc._fairlead_shipped = True
    top = os.path.dirname(os.path.abspath(__file__))
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
        for folder, _, names in sorted(os.walk(top)):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.writestr(zipfile.ZipInfo(os.path.relpath(path, os.path.dirname(top))), open(path, "rb").read())
    data = buffer.getvalue()
    base = shared_dir(spark).removeprefix("file://").removeprefix("file:")
    if "://" in base:  # not a mounted folder: the driver serves the archive from its own disk
        base = tempfile.gettempdir()
    path = os.path.join(base, f"fairlead-{hashlib.sha256(data).hexdigest()[:16]}.zip")
    if not os.path.exists(path):
        os.makedirs(base, exist_ok=True)
        with open(f"{path}.{os.getpid()}", "wb") as f:
            f.write(data)
        os.replace(f"{path}.{os.getpid()}", path)
    sc.addPyFile(path)
