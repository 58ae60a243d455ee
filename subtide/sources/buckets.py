"""Parquet tables dealt into buckets by a key, so that joins and sums on the key need no shuffle.

Rows whose key has the same hash lie in files of the same bucket, and two tables with the same number of buckets join bucket by bucket. A file
``_buckets`` beside the part files says how the rows were dealt and how many the largest bucket has: a bucket is read by one task, so
a table in which one key holds far more than a bucket's share is read as a plain one, whose hot key every task sums before the shuffle.
"""

from __future__ import annotations

import json
import uuid
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SIDECAR = "_buckets"

#: A table is read by its buckets while none has more than so many times the mean.
UNEVEN = 4


def _location(spark: SparkSession, path: str):
    """The file system of ``path`` and the path in full; a catalog would look for a relative one in its warehouse."""
    short = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = short.getFileSystem(spark._jsc.hadoopConfiguration())
    return files, files.makeQualified(short)


def write_buckets(df: DataFrame, path: str, column: str, buckets: int, sort_by: list[str] | None = None) -> None:
    """Write ``df`` as Parquet in ``buckets`` buckets of ``column``, in the order of ``sort_by`` within each file.

    Tasks take whole buckets where they can and parts of a bucket where its rows are many, so a key with a third of all rows is
    many tasks' work and many files of its bucket. Rows without the key are a bucket's like any others.
    """
    if column not in df.columns:
        raise ValueError(f"no column {column} to deal rows by")
    files, full = _location(spark := df.sparkSession, path)
    bucket = F.pmod(F.hash(column), F.lit(buckets))
    name = f"subtide_write_{uuid.uuid4().hex}"
    # The hint takes columns alone.
    dealer = "_" * max(map(len, df.columns)) + "_bucket"
    laid = df.withColumn(dealer, bucket).hint("rebalance", dealer).drop(dealer)
    writer = laid.write.mode("overwrite").format("parquet").option("path", full.toString()).bucketBy(buckets, column)
    if sort_by:
        writer = writer.sortBy(*sort_by)
    try:
        writer.saveAsTable(name)
    finally:
        # The name goes, the files stay.
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    sizes = spark.read.schema(df.schema).parquet(full.toString()).groupBy(bucket).agg(F.count("*").alias("n"))
    rows, largest = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    out = files.create(spark._jvm.org.apache.hadoop.fs.Path(full, _SIDECAR))
    out.write(json.dumps({"column": column, "buckets": buckets, "rows": rows, "largest": largest}).encode())
    out.close()


def dealt(spark: SparkSession, path: str) -> dict | None:
    """How the table at ``path`` was dealt into buckets, or None."""
    files, full = _location(spark, path)
    sidecar = spark._jvm.org.apache.hadoop.fs.Path(full, _SIDECAR)
    if not files.exists(sidecar):
        return None
    stream = files.open(sidecar)
    try:
        return json.loads(bytes(stream.readAllBytes()))
    finally:
        stream.close()


def read_buckets(spark: SparkSession, path: str, schema) -> DataFrame | None:
    """The table at ``path`` by its buckets; None where it has none, or a bucket that is too large for them to help.

    Spark knows buckets from its catalog alone, so the folder gets a name there, made of its path and its buckets; no job runs.
    """
    found = dealt(spark, path)
    if found is None or found["largest"] * found["buckets"] > UNEVEN * max(found["rows"], 1):
        return None
    location = _location(spark, path)[1].toString()
    key = json.dumps([location, found["column"], found["buckets"], schema.simpleString()])
    name = f"subtide_buckets_{zlib.crc32(key.encode()):08x}_{zlib.adler32(key.encode()):08x}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    quoted = location.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
        f"CLUSTERED BY (`{found['column']}`) INTO {found['buckets']} BUCKETS LOCATION '{quoted}'"
    )
    spark.catalog.refreshTable(name)
    return spark.table(name)
