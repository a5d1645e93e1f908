"""Cutting lineage and finding scratch space in the cluster's shared folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder, as named in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own, which
    goes when Python ends; on a cluster a machine-local folder would be lost
    with its machine.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = context.getConf().get("spark.checkpoint.dir")
        if named is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            named = tempfile.mkdtemp(prefix="wayfare-")
            atexit.register(shutil.rmtree, named, ignore_errors=True)
        context.setCheckpointDir(named)
    return context.getCheckpointDir()


def scratch_root(spark: SparkSession) -> str:
    """The folder of this application's written tables."""
    return f"{checkpoint_folder(spark)}/tables-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path for a written table, under the checkpoint folder."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as a scratch table and read back: its lineage ends there."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a written table wherever it lies."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def clear_scratch(spark: SparkSession) -> None:
    """Delete every table this application wrote; results read from them go too."""
    remove_path(spark, scratch_root(spark))


def ship(spark: SparkSession) -> str:
    """Send this package to the executors, whose Python workers import it by name; returns the archive's path.

    Needed where the package is not installed on them (``pip install`` or
    ``spark-submit --py-files`` do as well). Once a session, before the first query with a Python
    step. The driver serves the archive while the session lasts, so it stays until Python ends.
    """
    package = os.path.dirname(os.path.abspath(__file__))
    place = tempfile.mkdtemp(prefix="wayfare-package-")
    atexit.register(shutil.rmtree, place, ignore_errors=True)
    archive = shutil.make_archive(f"{place}/{os.path.basename(package)}", "zip", os.path.dirname(package), os.path.basename(package))
    spark.sparkContext.addPyFile(archive)
    return archive


def materialise(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into the checkpoint folder and cut its lineage."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint()
