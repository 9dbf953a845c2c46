"""Session helpers: table access, shuffle width and lineage cuts."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the executors' Python workers, once for an application, so none needs it installed."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    here = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="corpusloom-"), "corpusloom.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(here):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(here)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The Parquet table ``name`` below ``root``."""
    return spark.read.parquet(f"{root}/{name}.parquet")


def wide_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """``table``, spread over the cores where it was read into fewer partitions than there are, for work that costs far more than
    moving the rows. A table of many files, as large ones are, is left as it was read.
    """
    df = table(spark, root, name)
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if df._jdf.queryExecution().toRdd().getNumPartitions() < cores else df


def shuffle_width(spark: SparkSession) -> int:
    """Partitions of a shuffle, as the session sets it."""
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir`` as a plain path, for files that tasks and driver exchange.

    Without one, a temporary folder where everything runs on this machine, and an error elsewhere.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines see")
        named = tempfile.mkdtemp(prefix="corpusloom-")
    return named.removeprefix("file://").removeprefix("file:") if named.startswith("file:") else named


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder, its lineage cut.

    The folder is the one the cluster names in ``spark.checkpoint.dir``. Only where neither that nor
    a folder of the context is set is a temporary one used, and only if everything runs on this machine; elsewhere that is an error.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or shared_folder(spark))
    return df.checkpoint(eager=True)
