"""Read and write the five tables as CSV or Parquet, plain, sorted, in a folder per day or in buckets of a key.

A table partitioned by one of its dates keeps each day's rows in a folder ``<column>=<day>``. Readers see the same columns in the same order;
filters on the date, also those whose bounds a query computes as it runs, choose folders before any file is opened.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from subtide.sources.buckets import read_buckets, write_buckets
from subtide.sources.schemas import SCHEMAS

_CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "encoding": "UTF-8",
    "dateFormat": "yyyy-MM-dd",
}


def read_csv(
    spark: SparkSession, path: str, schema: StructType, multi_line: bool = False, bad_values: str = "fail"
) -> DataFrame:
    """CSV with a header and quoted fields; columns go by their names in the header, in any
    order, and further ones are left out.

    A value that does not fit the schema is an error, or missing with ``bad_values="null"``.
    Line breaks inside quotes need ``multi_line``, which stops Spark from splitting files.
    """
    mode = {"fail": "FAILFAST", "null": "PERMISSIVE"}[bad_values]
    options = _CSV_OPTIONS | {"multiLine": str(multi_line).lower(), "enforceSchema": "false", "mode": mode}
    header = spark.read.options(**options).csv(path).columns
    if missing := [name for name in schema.names if name not in header]:
        raise ValueError(f"{path}: no column {', '.join(missing)}")
    found = StructType([schema[name] if name in schema.names else StructField(name, StringType()) for name in header])
    return spark.read.options(**options).schema(found).csv(path).select(*schema.names)


def _fitted(name: str, kind: str) -> Column:
    """A text column as ``kind``, null where it does not fit."""
    text = F.col(name)
    if kind == "date":
        return F.try_to_timestamp(text, F.lit(_CSV_OPTIONS["dateFormat"])).cast("date")
    if kind == "boolean":
        return F.when(F.lower(text) == "true", True).when(F.lower(text) == "false", False)
    return text if kind == "string" else text.try_cast(kind)


#: Column of ``read_rescued`` with the values that did not fit, by column; and the entry for a line with too few or too many.
RESCUED, LINE = "_rescued", "_line"


def read_rescued(spark: SparkSession, path: str, schema: StructType, multi_line: bool = False) -> DataFrame:
    """``read_csv`` that loses nothing: a value that does not fit its column is missing there and stands, as it was, in the
    map ``_rescued`` (null if all fit). A line with too few or too many values stands there whole, as ``_line``."""
    options = _CSV_OPTIONS | {"multiLine": str(multi_line).lower(), "enforceSchema": "false", "mode": "PERMISSIVE"}
    header = spark.read.options(**options).csv(path).columns
    if missing := [name for name in schema.names if name not in header]:
        raise ValueError(f"{path}: no column {', '.join(missing)}")
    # Every column is parsed, or lines of the wrong length would not be seen.
    options |= {"columnNameOfCorruptRecord": LINE, "columnPruning": "false"}
    texts = spark.read.options(**options).schema(StructType([StructField(n, StringType()) for n in [*header, LINE]])).csv(path)
    typed = {f.name: _fitted(f.name, f.dataType.typeName()) for f in schema}
    lost = [F.when(F.col(n).isNotNull() & value.isNull(), F.struct(F.lit(n).alias("name"), F.col(n).alias("value"))) for n, value in typed.items() if schema[n].dataType != StringType()]
    lost.append(F.when(F.col(LINE).isNotNull(), F.struct(F.lit(LINE).alias("name"), F.col(LINE).alias("value"))))
    entries = F.map_from_entries(F.array_compact(F.array(*lost)))
    rescued = F.when(F.size(entries) > 0, entries)
    return texts.select(*[value.alias(n) for n, value in typed.items()], rescued.alias(RESCUED))


def read_table(
    spark: SparkSession, base_path: str, name: str, fmt: str = "parquet", multi_line: bool = False, bad_values: str = "fail"
) -> DataFrame:
    """One of the five tables from ``base_path``: ``<name>.csv`` or ``<name>.parquet``,
    each either a file or a folder of part files. The last two options are ``read_csv``'s."""
    schema = SCHEMAS[name]
    path = f"{base_path.rstrip('/')}/{name}.{fmt}"
    if fmt == "csv":
        return read_csv(spark, path, schema, multi_line, bad_values)
    if fmt == "parquet":
        if (by_bucket := read_buckets(spark, path, schema)) is not None:
            return by_bucket
        # A partition column comes last from its folders' names.
        return spark.read.schema(schema).parquet(path).select(*schema.names)
    raise ValueError(f"unknown format: {fmt}")


def load_tables(
    spark: SparkSession,
    base_path: str,
    names: list[str] | None = None,
    fmt: str = "parquet",
    views: bool = False,
    multi_line: bool = False,
    bad_values: str = "fail",
) -> dict[str, DataFrame]:
    """Several tables by name; with ``views`` they are also registered for ``spark.sql``."""
    tables = {name: read_table(spark, base_path, name, fmt, multi_line, bad_values) for name in (list(SCHEMAS) if names is None else names)}
    if views:
        for name, table in tables.items():
            table.createOrReplaceTempView(name)
    return tables


def write_table(
    df: DataFrame,
    base_path: str,
    name: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    sort_by: list[str] | None = None,
    partition_by: str | None = None,
    observed: tuple[Observation, list[Column]] | None = None,
    bucket_by: tuple[str, int] | None = None,
) -> str:
    """Write ``df`` as a folder of part files that ``read_table`` finds; returns its path.

    ``sort_by`` orders the rows within and across the part files, which lets later
    filters on those columns skip files and row groups. ``partition_by`` names a date of the table: each
    day gets a folder, and ``sort_by`` orders the rows of its files; rows without the date have a folder of their own.
    ``bucket_by`` is a key and a number of buckets: ``read_table`` then gives a table whose joins and sums on the key need no shuffle.
    ``observed`` are aggregates of the written rows, taken as they are written. Mode "overwrite" replaces the whole table, "overwrite_days" only the days that ``df`` has.
    """
    path = f"{base_path.rstrip('/')}/{name}.{fmt}"
    if mode == "overwrite_days" and not partition_by:
        raise ValueError("overwrite_days needs partition_by")
    if bucket_by:
        if partition_by or fmt != "parquet" or mode != "overwrite":
            raise ValueError("buckets are for whole Parquet tables without partitions")
        write_buckets(df.observe(observed[0], *observed[1]) if observed else df, path, *bucket_by, sort_by=sort_by)
        return path
    if partition_by:
        if dict(df.dtypes).get(partition_by) != "date":
            raise ValueError(f"{name}: {partition_by} is no date column")
        # Days go to as many tasks as their bytes ask for: adaptive execution merges small ones and splits a hot one.
        laid = df.hint("rebalance", F.col(partition_by)).sortWithinPartitions(partition_by, *(sort_by or []))
    else:
        laid = in_order(df, sort_by) if sort_by else df
    if observed:
        laid = laid.observe(observed[0], *observed[1])
    replaced = "dynamic" if mode == "overwrite_days" else "static"
    writer = laid.write.mode(mode.removesuffix("_days")).option("partitionOverwriteMode", replaced)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    if fmt == "csv":
        writer.options(**_CSV_OPTIONS).csv(path)
    elif fmt == "parquet":
        writer.parquet(path)
    else:
        raise ValueError(f"unknown format: {fmt}")
    return path


def in_order(df: DataFrame, columns: list[str]) -> DataFrame:
    """``df`` sorted by ``columns`` across its partitions, rows that agree in them in any order.

    Partitions are ranges of the columns and, after them, of a hash of the row, so a value that a third of all rows have
    is many tasks' work and many files.
    """
    return df.orderBy(*columns, F.xxhash64(*df.columns))


def move_folder(spark: SparkSession, source: str, target: str) -> None:
    """Put a folder in the place of another; readers see the old one or the new one, or for a moment none."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(source).getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path(target).getParent())
    old = path(f"{target}.replaced")
    if files.exists(path(target)):
        files.rename(path(target), old)
    if not files.rename(path(source), path(target)):
        if files.exists(old):
            files.rename(old, path(target))
        raise OSError(f"cannot move {source} to {target}")
    files.delete(old, True)


def drop_folder(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
