"""Helpers that the training-data operators share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions.batches import BATCH_BYTES, bound_batches, release_memory, tidy  # noqa: F401  (handed on)

#: Bytes of text whose tokens are looked at together; their arrays take some sixty times as much.
TOKEN_BYTES = 1 << 20
#: Texts for which a task of their own is worth its files, and least number of tasks.
TASK_TEXTS, LEAST_TASKS = 2_000, 8


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the corpus tables; only Spark's reader touches the path."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint(df: DataFrame) -> DataFrame:
    """Cuts the lineage with a reliable checkpoint in the folder that the cluster shares.

    The session's ``spark.checkpoint.dir`` is used; a folder of our own is set only where
    the session has none, as in local tests.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder, which driver and executors share. Where none is set, a local session gets one of its own; on a cluster that is refused."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="ckpt-"))
    return sc.getCheckpointDir()


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows, written as Parquet to a new place in the shared folder and read again."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def tasks_for(spark: SparkSession, texts: int) -> int | None:
    """The number of tasks for steps over the keys of so many texts, or None where shuffles are left as they are.

    Only where partitions hold less than half of ``TASK_TEXTS`` are they merged: many more tasks than texts need
    write many small files. The number follows the texts, and merging moves no rows.
    """
    tasks = max(LEAST_TASKS, -(-texts // TASK_TEXTS))
    return tasks if 2 * tasks < shuffle_partitions(spark) else None


def narrow(df: DataFrame, tasks: int | None) -> DataFrame:
    """The rows in at most so many tasks."""
    return df if tasks is None else df.coalesce(tasks)


def hex_fraction(key: Column) -> Column:
    """A seeded order key that any SQL engine can compute: 48 leading bits of the MD5 digest."""
    return F.conv(F.substring(F.md5(key), 1, 12), 16, 10).cast("long")
