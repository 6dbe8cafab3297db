"""Tables kept between jobs in the folder that all executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``. On one machine a new local one is set where that is unset; on a
    cluster that is an error, because executors would write to their own disks."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        where = "file://" + tempfile.mkdtemp(prefix="fathom-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


def keep(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: later jobs start from the files, also after
    executors are lost."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/fathom-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
