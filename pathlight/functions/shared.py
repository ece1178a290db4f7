"""Tables in the folder that the driver and all executors share, and numbers over a whole table."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scratch(spark: SparkSession) -> str:
    """A folder that the driver and all executors share: ``spark.checkpoint.dir``, or one of our own where that is unset and all run on this machine."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="pathlight-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/pathlight/{spark.sparkContext.applicationId}"


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{scratch(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: work is done once and lost executors cost nothing but a reread."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clean(spark: SparkSession) -> None:
    """Delete what this application has written to the shared folder. Call it when its results are used up."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def numbered(df: DataFrame, name: str, *keys) -> DataFrame:
    """``df`` with a column ``name``: the place of each row in the order of ``keys``, from 0. ``keys`` should tell rows apart.

    Rows are dealt out by ranges of the keys and sorted in their tasks; only the count of each task's rows is gathered.
    """
    ordered = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()})
    ordered = materialize(ordered.withColumn("_at", F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))), "ordered")
    counts = sorted(ordered.groupBy("_part").agg(F.count("*").alias("n")).collect())  # a row a task
    firsts, total = [], 0
    for part, n in counts:
        firsts.append((part, total))
        total += n
    firsts = df.sparkSession.createDataFrame(firsts, "_part int, _first bigint")
    return ordered.join(F.broadcast(firsts), "_part").withColumn(name, F.col("_first") + F.col("_at")).drop("_part", "_first", "_at")
