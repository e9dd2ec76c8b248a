"""Reading the given tables and helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonepulse.session import new_work_dir, prepare


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A given table through Spark's reader, so that any store Spark knows will do."""
    return prepare(spark).read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """Write a reused intermediate to the shared folder and read it back.

    Cuts lineage: a lost executor costs the tasks of a later stage, not this work.
    """
    spark = df.sparkSession
    path = new_work_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """True where crc32 of the id as text leaves ``fold`` modulo ``folds``; false for null ids."""
    rest = F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds))
    return F.coalesce(rest == fold, F.lit(False))
