"""Session helpers shared by all operators."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One test table; Spark prunes columns and pushes filters into the Parquet scan."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def is_local(spark: SparkSession) -> bool:
    """Whether driver and workers are one process, and so share a disk."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Folder for cut lineage: the cluster's shared ``spark.checkpoint.dir``.  Only in local mode, where that is unset, a folder of our own; on
    a cluster a machine's own folder would be lost with the machine, so that is an error."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        if not shared and not is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(shared or tempfile.mkdtemp(prefix="colophon-ckpt-"))
    return shared or ""


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: a result used by several branches is computed once and survives lost executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder that all executors share, beside the checkpoints."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/{name}-{uuid.uuid4().hex}"


def ship_package(spark: SparkSession, root: str, name: str) -> None:
    """Send the package to the workers of a cluster, which need not have the driver's disk; workers on the same disk find it by its path."""
    sc = spark.sparkContext
    paths = sc.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        sc.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, *paths]))
    if not is_local(spark) and not getattr(sc, "_colophon_shipped", False):
        base = os.path.join(tempfile.mkdtemp(prefix="colophon-package-"), name)
        sc.addPyFile(shutil.make_archive(base, "zip", root, name))
        sc._colophon_shipped = True


def ship_file(spark: SparkSession, path: str) -> str:
    """Send a file of the driver to all workers; there ``shipped`` finds it by the name returned."""
    spark.sparkContext.addFile(path)
    return os.path.basename(path)


def shipped(name: str) -> str:
    return SparkFiles.get(name)
