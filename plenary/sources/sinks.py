"""Writers. Parquet is the working format; CSV is for publishing."""

from __future__ import annotations

from collections.abc import Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from plenary.operators.dedup import first_per_key
from plenary.operators.index import materialize


# Cells are written as they are; by default Spark would trim them.
_AS_IS = {"escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def write_csv(df: DataFrame, path: str, null_as: str = "", quote_all: bool = False) -> None:
    """CSV with a header; nulls as `null_as`, every field quoted on request."""
    df.write.mode("overwrite").csv(path, header=True, nullValue=null_as, quoteAll=quote_all,
                                   emptyValue="" if not quote_all else None, **_AS_IS)


def write_lines(lines: DataFrame, path: str, header: str) -> None:
    """Text lines, each part file starting with the header as in Spark's own CSV output."""

    def with_header(batches):
        yield pd.DataFrame({"value": [header]})
        yield from batches

    lines.mapInPandas(with_header, "value string").write.mode("overwrite").text(path)


def write_unquoted(df: DataFrame, path: str) -> None:
    """CSV lines without quotes: separators, backslashes and line ends are escaped by a backslash."""
    cells = [
        F.regexp_replace(F.coalesce(F.col(c).cast("string"), F.lit("")), r"([\\,\r\n])", r"\\$1")
        for c in df.columns
    ]
    write_lines(df.select(F.concat_ws(",", *cells).alias("value")), path, ",".join(df.columns))


def write_by_value(df: DataFrame, path: str, column: str, kind: str = "parquet") -> None:
    """One folder per value, so that a filter on the column reads only its folders.

    Rows are spread by value and a row hash: a value with most of the rows is written by many tasks.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = F.pmod(F.xxhash64(*df.columns), F.lit(parts))
    writer = df.repartition(parts, F.col(column), spread).write.mode("overwrite").partitionBy(column)
    writer.csv(path, header=True, **_AS_IS) if kind == "csv" else writer.parquet(path)


def write_split(df: DataFrame, path: str, flag: str = "removed") -> None:
    """Kept and removed rows under one path, told apart by the flag's folder."""
    df.write.mode("overwrite").partitionBy(flag).parquet(path)


def write_stages(tables: Mapping[str, DataFrame], folder: str) -> None:
    """Each named stage as its own Parquet table."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}")


def write_backup(df: DataFrame, path: str) -> DataFrame:
    """A copy of the table as it is; the copy is what later steps read."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def upsert(spark: SparkSession, path: str, changes: DataFrame, key: str, partition: str,
           removals: DataFrame | None = None, order_by: list[str | Column] | None = None) -> DataFrame:
    """Changed and new rows put into a table partitioned by `partition`; only partitions that hold touched keys are rewritten.

    A row of `changes` takes the place of the rows with its key, in whatever partition they are; of several with one
    key the first by `order_by` (by all columns) counts. Keys in `removals` leave the table, and a key in both is
    removed. Null keys change and remove nothing. The new partitions are worked out and stored first, and Spark moves
    them into place only when all are written, so a run that fails before leaves the table as it was. Partitions
    left without rows lose their files. The partition column must be written back as it was read: its type is that
    of `changes`. Returns the rewritten values of `partition`, of which there are as many as folders.
    """
    old = spark.read.schema(changes.schema).parquet(path)
    names = changes.columns
    order = order_by or [F.col(f"`{c}`") for c in names]
    gone = (removals if removals is not None else changes.limit(0)).select(key).where(F.col(key).isNotNull()).distinct()
    fresh = materialize(first_per_key(changes.where(F.col(key).isNotNull()), [key], order).join(gone, key, "left_anti").select(*names))
    named = materialize(fresh.select(key).union(gone.select(key)).distinct())

    touched = old.select(key, partition).join(named, key, "left_semi").select(partition).union(fresh.select(partition)).distinct()
    folders = [r[0] for r in touched.collect()]
    if not folders:
        return touched
    inside = F.coalesce(F.col(partition).isin([v for v in folders if v is not None]), F.lit(False))
    if None in folders:
        inside = inside | F.col(partition).isNull()
    staged = materialize(old.where(inside).join(named, key, "left_anti").select(*names).unionByName(fresh))
    staged.repartition(F.col(partition), F.pmod(F.xxhash64(key), F.lit(int(spark.conf.get("spark.sql.shuffle.partitions"))))) \
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)

    # A dynamic overwrite leaves a folder alone that gets no row, so the files of emptied ones are removed by name.
    left = {r[0] for r in staged.select(partition).distinct().collect()}
    for value in set(folders) - left:
        where = F.col(partition).isNull() if value is None else F.col(partition) == F.lit(value)
        for row in old.where(where).select(F.col("_metadata.file_path").alias("file")).distinct().collect():
            file = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(row["file"]))
            file.getFileSystem(spark._jsc.hadoopConfiguration()).delete(file, False)
    return spark.createDataFrame([(v,) for v in folders], f"`{partition}` {dict(changes.dtypes)[partition]}")
