"""Lineage cuts into the cluster's shared folder.

Intermediate tables (term lists, statistics, tokens) are written once as
Parquet under the folder the session names in ``spark.checkpoint.dir`` and
read back. This

* cuts their lineage: a lost executor re-reads the table instead of
  recomputing a whole-catalogue aggregation;
* gives the planner the table's real size, so a join against it is a
  broadcast only when the written bytes are under
  ``spark.sql.autoBroadcastJoinThreshold``, and a shuffle join (with AQE's
  skew-join splitting) beyond it. Nothing is broadcast on an estimate.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts: the session's checkpoint folder.

    A cluster must name it in ``spark.checkpoint.dir``: executors would write
    a machine-local folder each to their own disks. Only a ``local`` master, as
    in tests, gets a fresh temporary folder where it is unset.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not is_local(sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="marquee-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def is_local(master: str) -> bool:
    """Whether the master runs everything in the driver's process."""
    return master == "local" or master.startswith("local[")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/marquee/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, paths: list[str] | None = None) -> DataFrame:
    """Write ``df`` as a table in the shared folder and return a frame reading it back.

    ``paths`` collects the table's path, for :func:`remove_tables` once nothing reads it any more.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if paths is not None:
        paths.append(path)
    df.write.mode("overwrite").parquet(path)
    # The schema is known: reading it back needs no inference job.
    return spark.read.schema(df.schema).parquet(path)


def remove_tables(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete tables that :func:`materialize` wrote."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        folder = jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(conf).delete(folder, True)
