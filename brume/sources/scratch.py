"""Tables that a query writes and reads back, in the folder that driver and executors share."""

from __future__ import annotations

import contextlib
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: the session's checkpoint folder.

    Only a session that runs in one process, as in tests, gets a local folder where it names none.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="brume-"))
    return sc.getCheckpointDir()


def shared_path(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_folder(spark)}/{uuid.uuid4().hex}-{name}"


def delete(spark: SparkSession, path: str) -> None:
    """Remove a table, or a part of one, that was written on the way and is not read again."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def delete_table(df: DataFrame) -> None:
    """Remove the files of a table of `shared_table` that is not read again."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        delete(df.sparkSession, folder)


@contextlib.contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting of the session that holds within this block only."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def shuffles_end(spark: SparkSession) -> contextlib.AbstractContextManager[None]:
    """Spark deletes the shuffle files of an execution within this block when it ends: what it wrote is in a table then."""
    return setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def shared_table(df: DataFrame, name: str, partitions: list[str] | None = None) -> DataFrame:
    path = shared_path(df.sparkSession, name)
    out = df.write
    (out.partitionBy(*partitions) if partitions else out).parquet(path)
    return df.sparkSession.read.parquet(path)


def reread(write: Callable[[str], None], spark: SparkSession) -> DataFrame:
    path = shared_path(spark, "table")
    write(path)
    return spark.read.parquet(path)


def packed_doubles(*columns: str) -> Column:
    """Little-endian doubles of some columns, one after the other."""

    @F.pandas_udf("binary")
    def pack(*values: pd.Series) -> pd.Series:
        whole, width = np.column_stack(values).astype("<f8").tobytes(), 8 * len(values)
        return pd.Series([whole[i * width : (i + 1) * width] for i in range(len(values[0]))], dtype=object)

    return pack(*(F.col(c) for c in columns))
