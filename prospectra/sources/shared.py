"""Tables between steps, in the folder that all executors and the driver see."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def new_folder(spark: SparkSession, name: str) -> str:
    """A new path under `spark.checkpoint.dir`. Where that is unset, a local folder is taken, on one machine only."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        folder = f"file://{tempfile.mkdtemp(prefix='prospectra-')}"
        spark.conf.set("spark.checkpoint.dir", folder)
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def cut(df: DataFrame, name: str) -> DataFrame:
    """Cuts lineage: writes the rows to the shared folder and reads them again."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settled(df: DataFrame) -> DataFrame:
    """The same rows, made before any filter above: the optimiser would else put a filter below, in terms of all that made its columns, which for addresses is hundreds of patterns."""
    return df.select(F.inline(F.array(F.struct(*df.columns))))


def spread(df: DataFrame, *by: str) -> DataFrame:
    """The same rows dealt evenly over tasks, or all rows of a key to one of them. A file of few bytes is read by one task (a row group by one at most), however much work its rows are; narrow rows are dealt before that work."""
    s = df.sparkSession
    return df.repartition(max(4 * s.sparkContext.defaultParallelism, int(s.conf.get("spark.sql.shuffle.partitions"))), *by)


def file_system(spark: SparkSession, path: str):
    """The store that holds a path, and the path in it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where
