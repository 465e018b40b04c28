"""Sessions for tests and benchmarks, and the folder for checkpoints."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session. On a cluster the caller brings a session of its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """A new folder that all executors can reach, below spark.checkpoint.dir.

    Only where that is unset and all tasks run in this process (a local master) a temporary folder is taken; executors on other
    machines couldn't read it.
    """
    _checkpoints(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{uuid.uuid4().hex}"


def _checkpoints(spark: SparkSession) -> None:
    """Makes sure that there is a folder for checkpoints."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = context.getConf().get("spark.checkpoint.dir")
        if not folder and not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="strophe-checkpoint-"))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write df to the shared checkpoint folder, which the cluster names in spark.checkpoint.dir, and go on from the files."""
    _checkpoints(df.sparkSession)
    return df.checkpoint(eager=True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
