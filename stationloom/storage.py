"""Intermediate tables on shared storage."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below ``spark.checkpoint.dir``, or below the warehouse folder where that is unset.

    Both are folders that Spark resolves and all executors share.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/stationloom/{label}-{uuid.uuid4().hex}"


def local_table(spark: SparkSession, rows: Sequence[Sequence], schema: str) -> DataFrame:
    """A table of rows held by the driver.

    Handed over as an Arrow table, a short one is a local relation of known size, so that Catalyst
    decides by size whether to broadcast it.
    """
    kind = T._parse_datatype_string(schema)
    names = kind.names
    table = pa.Table.from_pylist([dict(zip(names, r)) for r in rows], schema=to_arrow_schema(kind))
    return spark.createDataFrame(table, schema=kind)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write a small derived table and read it back.

    Cuts the lineage (a lost executor re-reads files), runs the steps above only once, and gives
    Catalyst the real size of the table: a join with it is broadcast only if the files are below
    ``spark.sql.autoBroadcastJoinThreshold`` and is a shuffle join otherwise.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
