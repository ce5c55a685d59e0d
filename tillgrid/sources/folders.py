"""Folders and files of any store that Spark reads, by its own file systems."""

from __future__ import annotations

import re
import tempfile
import time
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def _opened(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, in order; none for a missing one."""
    system, place = _opened(spark, folder)
    if not system.exists(place):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(place))


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _opened(spark, path)
    return system.exists(place)


def create_new(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False if it is there, also where another process was faster."""
    system, place = _opened(spark, path)
    system.mkdirs(place.getParent())
    return system.createNewFile(place)


def age_of(spark: SparkSession, path: str) -> float | None:
    """Seconds since a file was written, or None if there is none."""
    system, place = _opened(spark, path)
    if not system.exists(place):
        return None
    return time.time() - system.getFileStatus(place).getModificationTime() / 1000


def remove_folder(spark: SparkSession, folder: str) -> None:
    system, place = _opened(spark, folder)
    system.delete(place, True)


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder that is removed when the session's process ends.

    It lies in the folder that ``spark.checkpoint.dir`` names, which all machines
    share. Only a session on one machine may do without the setting.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        folder = tempfile.gettempdir()
    path = f"{folder.rstrip('/')}/{spark.conf.get('spark.app.id')}/{name}_{uuid4().hex}"
    system, place = _opened(spark, path)
    system.mkdirs(place)
    system.deleteOnExit(place)
    return path


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` computed once and read from a scratch folder from then on."""
    spark = df.sparkSession
    path = f"{scratch_folder(spark, name)}/rows"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(literal(path))


def literal(path: str) -> str:
    """A path to read whose brackets, braces, stars and question marks mean themselves."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)
