"""Readers for the project's parquet tables and the place for cut lineage."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data folder; a file or a folder of files."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see: the session's ``spark.checkpoint.dir``.

    Only a session on one machine (a local master) without that setting gets a temporary folder, removed when Python ends; on a cluster the
    missing setting is an error, for a folder of one machine is not seen by the others.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder shared by all executors")
    if not _OWN:
        _OWN.append(tempfile.mkdtemp(prefix="sedimenta-"))
        atexit.register(shutil.rmtree, _OWN[0], ignore_errors=True)
    return _OWN[0]


_OWN: list[str] = []


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder, its lineage cut.

    Never ``localCheckpoint``: a lost executor must not lose the rows. The files go with the frame where the session has
    ``spark.cleaner.referenceTracking.cleanCheckpoints``.
    """
    sc = df.sparkSession.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)
