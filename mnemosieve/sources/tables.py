"""Input tables, and intermediate tables in the folder that all executors share."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's Parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names; in local mode without one, a folder of our own."""
    told = spark.conf.get(CHECKPOINT_KEY, None)
    if told:
        return told
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"{CHECKPOINT_KEY} must name a folder that the driver and the executors share")
    spark.conf.set(CHECKPOINT_KEY, "file://" + tempfile.mkdtemp(prefix="mnemosieve-"))
    return spark.conf.get(CHECKPOINT_KEY)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, *directories: str) -> DataFrame:
    """df as a table in the shared folder: cuts the lineage, survives the loss of executors. directories: columns by whose values it lies in directories."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    (df.write.partitionBy(*directories) if directories else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def file_system(spark: SparkSession, path: str):
    """The file system of a path, and the path as it knows it."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    p = hadoop.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def create_once(spark: SparkSession, path: str, data: bytes) -> bool:
    """Creates a small file; False if there is one already. Of several writers one gets True."""
    fs, p = file_system(spark, path)
    try:
        fs.mkdirs(p.getParent())
        if fs.getUri().getScheme() == "file":  # Hadoop's local file system looks first and creates then
            with os.fdopen(os.open(p.toUri().getPath(), os.O_CREAT | os.O_EXCL | os.O_WRONLY, 0o644), "wb") as f:
                f.write(data)
        else:
            out = fs.create(p, False)
            out.write(bytearray(data))
            out.close()
    except Exception as e:
        if isinstance(e, FileExistsError) or fs.exists(p):
            return False
        raise
    return True
