"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.session import scratch_path

# Fixed value: the white space of the word rule `[^\x20\x09-\x0D]+`.
WORD = r"[^\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet below ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage: a lost executor rereads files instead of recomputing the
    steps before. The folder goes when the application ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    delete_at_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def delete_at_exit(spark: SparkSession, path: str) -> None:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jpath)


def give_back() -> None:
    """Return this Python worker's freed memory to the system: Spark keeps idle
    workers, and what they hold counts against the executor."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def row_key(*cols: str) -> list[Column]:
    """128 bits that stand for the values of ``cols`` (nulls included)."""
    parts = [F.struct(*(F.col(c) for c in cols))] + [F.col(c).isNull() for c in cols]
    return [F.xxhash64(*parts), F.xxhash64(F.lit("second"), *parts)]


def lookup_join(left: DataFrame, right: DataFrame, keys: list[str], weight: str,
                share: int = 1000, how: str = "inner") -> DataFrame:
    """Equi-join ``left`` with the unique-key table ``right``, hot keys apart.

    ``weight`` of ``right`` counts the rows of ``left`` (or a fixed share of
    them) with that key. Keys with more than 1/``share`` of all weight are at
    most ``share`` many, whatever the size of the data: that proven bound lets
    them be broadcast, so no task gets all rows of a hot key. The other keys
    take the shuffle join. ``right`` should be a stored table (it is read
    three times). ``how``: inner, or left_semi.
    """
    limit = (right.agg(F.sum(weight)).first()[0] or 0) / share
    hot = right.filter(F.col(weight) > limit)
    is_hot = hot.select(*keys).withColumn("__hot", F.lit(True))
    marked = left.join(F.broadcast(is_hot), keys, "left")
    values = [c for c in right.columns if c not in keys]
    rest = marked.filter(F.col("__hot").isNull()).drop("__hot")
    top = marked.filter(F.col("__hot")).drop("__hot")
    cold = right.filter(F.col(weight) <= limit)
    if how == "left_semi":
        return top.unionByName(rest.join(cold.select(*keys), keys, "left_semi"))
    out = [*left.columns, *values]
    return (top.join(F.broadcast(hot), keys, how).select(*out)
            .unionByName(rest.join(cold, keys, how).select(*out)))
