"""Commit points in the shared folder: exclusive files, listings, numbered tables.

A number or a claim belongs to whoever creates its file first; creation fails for
everybody else, also in other applications.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


def file_system(spark: SparkSession, path: str):
    """(file system, path) of the cluster's storage."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def create_exclusive(spark: SparkSession, path: str, text: str = "") -> bool:
    """Create a small file; False if it is there already.  The storage decides: on
    a local disk by the system's exclusive create, else by a create that doesn't
    overwrite (atomic on HDFS, a conditional write on object stores)."""
    fs, jpath = file_system(spark, path)
    fs.mkdirs(jpath.getParent())
    body = bytearray(text.encode())
    try:
        if fs.getUri().getScheme() == "file":
            place = spark._jvm.java.nio.file.Path.of(jpath.toUri().getPath(), spark.sparkContext._gateway.new_array(
                spark._jvm.java.lang.String, 0))
            options = spark.sparkContext._gateway.new_array(spark._jvm.java.nio.file.OpenOption, 2)
            options[0] = spark._jvm.java.nio.file.StandardOpenOption.CREATE_NEW
            options[1] = spark._jvm.java.nio.file.StandardOpenOption.WRITE
            spark._jvm.java.nio.file.Files.write(place, body, options)
        else:
            out = fs.create(jpath, False)
            out.write(body)
            out.close()
    except Py4JJavaError as e:
        if "FileAlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise
    return True


@dataclass(frozen=True)
class ListedFile:
    path: str
    bytes: int
    modified: int


def list_files(spark: SparkSession, source: str) -> list[ListedFile]:
    """Data files below a folder (or glob), hidden ones left out; the listing that
    a read of the folder makes as well."""
    fs, jpath = file_system(spark, source)
    out = []
    for root in fs.globStatus(jpath) or []:
        found = fs.listFiles(root.getPath(), True)
        while found.hasNext():
            s = found.next()
            if not s.getPath().getName().startswith(("_", ".")):
                out.append(ListedFile(s.getPath().toString(), s.getLen(), s.getModificationTime()))
    return out


class CommitLog:
    """Numbered states of a small table under ``path``: state n is a Parquet folder
    that the exclusive file ``n.commit`` names.  A state is written first and named
    last, so readers only see whole ones; of two writers of one number one fails."""

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path, schema

    def latest(self) -> tuple[int, DataFrame]:
        """(number, table); (0, empty) before the first commit."""
        fs, jpath = file_system(self.spark, self.path)
        names = [s.getPath().getName() for s in (fs.listStatus(jpath) if fs.exists(jpath) else [])]
        for last in sorted((int(n.split(".")[0]) for n in names if n.endswith(".commit")), reverse=True):
            named = self.spark.read.text(f"{self.path}/{last}.commit").first()
            if named:                          # else it is being written: the state before holds
                return last, self.spark.read.schema(self.schema).parquet(f"{self.path}/{named[0]}")
        return 0, self.spark.createDataFrame([], self.schema)

    def commit(self, number: int, table: DataFrame) -> None:
        """Make ``table`` state ``number``; RuntimeError if another writer was first."""
        folder = f"state-{number}-{uuid.uuid4().hex[:12]}"
        table.write.parquet(f"{self.path}/{folder}")
        if not create_exclusive(self.spark, f"{self.path}/{number}.commit", folder):
            raise RuntimeError(f"{self.path}: state {number} was committed by another writer; read it and repeat")
