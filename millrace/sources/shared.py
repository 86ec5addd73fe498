"""The one folder all executors can reach, and spreading of small inputs."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The cluster's folder from ``spark.checkpoint.dir`` or ``setCheckpointDir``.

    Where neither is set, a temporary one, in local mode only: executors of a cluster share no disk.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    given = context._jsc.sc().getCheckpointDir()
    if given.isDefined():
        return given.get().rstrip("/")
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors reach")
    app = context.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = tempfile.mkdtemp(prefix="millrace-")
    return _LOCAL[app]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def committed(spark: SparkSession, path: str, prefix: str) -> dict[int, str]:
    """The finished tables ``<path>/<prefix><number>``: those whose writer left its mark of success."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(conf)
    found = {}
    for status in fs.listStatus(folder) if fs.exists(folder) else []:
        name = status.getPath().getName()
        if name.startswith(prefix) and fs.exists(jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")):
            found[int(name.removeprefix(prefix))] = f"{path}/{name}"
    return found


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Give every core work when the input is only a few small files.

    Large inputs already split into many more tasks than cores and pass through untouched: no
    shuffle is added where it would cost.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    splits = df.rdd.getNumPartitions()
    if len(df.inputFiles()) >= cores or splits > 4 * cores:
        return df
    return df.repartition(max(cores, splits), *keys)  # no task gets more than the scan would give it
