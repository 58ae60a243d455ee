"""Tables written once to the folder all executors share, and small frame helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

_ROOT = str(Path(__file__).resolve().parents[2])
_LOCAL_FOLDERS: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder ``spark.checkpoint.dir`` names; a temporary one only for a local session without it.

    The tables of one application lie in ``llm-<application id>`` below it and may be
    removed once the results that read them are written.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    app = spark.sparkContext.applicationId
    if folder is None:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if app not in _LOCAL_FOLDERS:
            _LOCAL_FOLDERS[app] = tempfile.mkdtemp(prefix="subtide-llm-")
        folder = _LOCAL_FOLDERS[app]
    return f"{folder.rstrip('/')}/llm-{app}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` computed now, stored as Parquet in the shared folder and read back."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_BATCH_ROWS, _BATCH_BYTES = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded(docs: DataFrame, rows: int = 1_000, size: int = 4 << 20) -> DataFrame:
    """``docs``, in a session whose tasks can import this package and get batches small enough for long texts.

    Spark's default of 10,000 rows lets a batch of long texts take hundreds of MB on both sides. A number of rows that the
    session's user has chosen stays as it is.
    """
    conf, workers = docs.sparkSession.conf, docs.sparkSession.sparkContext.environment
    # Tasks import this package by name; where the driver found it by its own search path alone, they are told where.
    paths = workers.get("PYTHONPATH", "").split(os.pathsep)
    if _ROOT not in paths:
        workers["PYTHONPATH"] = os.pathsep.join([_ROOT, *filter(None, paths)])
    if conf.get(_BATCH_ROWS) == "10000":
        conf.set(_BATCH_ROWS, str(rows))
        conf.set(_BATCH_BYTES, str(size))
    return docs


def text_column(text: str) -> Column:
    """The text as a string, null as empty."""
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def unused(names: list[str], *wanted: str) -> list[str]:
    """The ``wanted`` names, each lengthened until no column of ``names`` is called so."""
    taken, out = {n.lower() for n in names}, []
    for name in wanted:
        while name in taken:
            name = f"_{name}"
        out.append(name)
    return out


def quoted(name: str) -> str:
    """A column's name as ``select`` reads it, whatever signs it holds."""
    return "`" + name.replace("`", "``") + "`"


def mapped(docs: DataFrame, task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: StructType) -> DataFrame:
    """``docs.mapInArrow`` with columns by position, so that their names may hold any sign."""
    plain = StructType([StructField(f"c{k}", f.dataType, f.nullable) for k, f in enumerate(schema.fields)])
    return docs.toDF(*(f"c{k}" for k in range(len(docs.columns)))).mapInArrow(task, plain).toDF(*schema.names)


def hash_sample(rows: DataFrame, key: Column, sample: int, total: int) -> list[Row]:
    """At most ``sample`` of the ``total`` rows, those of the smallest hashes of ``key``, in their order.

    Rows above the hash that a fifth more than the sample would reach stay where they are, so what the driver gets does not grow
    with the input or its partitions. Where very many rows have one key, the sample may be smaller.
    """
    below = -(1 << 63) + int(min(1.0, 1.2 * sample / max(total, 1)) * ((1 << 64) - 1))
    (at,) = unused(rows.columns, "at")
    chosen = rows.withColumn(at, F.xxhash64(key)).where(F.col(at) <= F.lit(min(below, (1 << 63) - 1))).limit(2 * sample).collect()
    return sorted(chosen, key=lambda r: r[at])[:sample]


def split_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """A join in which adaptive execution can split the hot keys of ``left``, with a side that was aggregated by the same keys.

    Only shuffles made for a join are split. The further key, which follows from the others, keeps the join from taking over the
    aggregate's.
    """
    again = F.pmod(F.hash(*on), F.lit(2))
    return left.withColumn("_again", again).join(right.withColumn("_again", again), [*on, "_again"], how).drop("_again")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
