"""What several parts of a query share: the folder of driver and executors, a table that they read."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder the cluster names in ``spark.checkpoint.dir``; a local session may use its own."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    shared = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if shared:
        context.setCheckpointDir(shared)
    elif context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="larderline-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")


def shared_folder(spark: SparkSession) -> str:
    """The folder named by :func:`ensure_checkpoint_dir`, as text."""
    ensure_checkpoint_dir(spark)
    return spark.sparkContext.getCheckpointDir()


def read_whole(df: DataFrame, name: str) -> DataFrame:
    """``df`` with all its columns made for each reader, for a large table that several parts of one query read.

    Readers of different columns would each have exchanges of their own below ``df``. With the same columns their plans
    are the same, and what one of them exchanged serves all. A sum over all columns, observed as ``name``, holds them.
    """
    return df.observe(name, F.bit_xor(F.xxhash64(*df.columns)).alias("sum"))
