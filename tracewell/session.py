"""Session settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the settings results depend on; everything else stays the cluster's."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, taken from ``spark.checkpoint.dir``.

    A machine-local folder would lose data with its executor, so outside a
    local session, which has one machine only, the missing setting is an error.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if base:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(base)
        return base
    if sc.getCheckpointDir() is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tracewell-"))
    return sc.getCheckpointDir()


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and go on from the files.

    Lost executors cost a re-read and no recomputation, the plan stays short,
    and later steps see real sizes, read only the columns they need, and can
    push filters into the scan.
    """
    path = new_path(df.sparkSession, "step")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*steps: DataFrame) -> None:
    """Delete the files of steps that ``cut_lineage`` wrote and nothing reads any more."""
    for step in steps:
        spark = step.sparkSession
        base = shared_dir(spark)
        for folder in {name.rsplit("/", 1)[0] for name in step.inputFiles()}:
            if folder.rsplit("/", 1)[1].startswith("step-"):
                path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{base}/{folder.rsplit('/', 1)[1]}")
                path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
