"""The shared folder for intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_OWN: list[str] = []


def work_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which driver and executors share.

    Where the session names none, a temporary folder is used on a local master;
    elsewhere it would be another folder on each machine, so that is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
    if not _OWN:
        _OWN.append(tempfile.mkdtemp(prefix="statutegraph-work-"))
    return _OWN[0]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{work_dir(spark)}/statutegraph/{name}-{uuid.uuid4().hex}"


def nothing(spark: SparkSession, schema: T.StructType | str) -> DataFrame:
    """No rows of a schema, known as empty when planned: no Python worker starts for them."""
    fields = (schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)).fields
    return spark.range(0).select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in fields)).filter(F.lit(False))


#: Rows that one task sorts or joins where rows are counted before they shuffle.
TASK_ROWS = 500_000


def dealt(rows: DataFrame, n: int, *keys: str) -> DataFrame:
    """About `n` rows dealt by their keys to as many tasks as leave each TASK_ROWS, so that what a task holds does not grow with the input.

    Where Spark's own number of partitions does as well, it is left to Spark.
    """
    parts = -(-n // TASK_ROWS)
    return rows.repartition(parts, *keys) if parts > int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) else rows


def kept(df: DataFrame, name: str) -> DataFrame:
    """Written as Parquet in the shared folder and read again.

    Cuts the lineage: costly or nondeterministic steps run once, and what was
    computed survives lost executors.  The files stay until the owner of the
    folder clears it.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
