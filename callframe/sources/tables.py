"""Readers for the input tables and writers for job outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


#: column that holds the text of a line that is not a row of the schema
BROKEN = "_broken"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table. Columns are pruned and filters pushed into the
    Parquet scan by the optimizer, so readers never select early."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def dealt(df: DataFrame, key: str) -> DataFrame:
    """The same rows over all tasks by a hash of ``key``. One task reads a whole
    Parquet row group; work on wide texts made of its rows should not wait for it."""
    return df.repartition(F.xxhash64(key))


def read_records(spark: SparkSession, path: str, fmt: str = "parquet",
                 schema: str | None = None) -> DataFrame:
    """Read a split or a processed corpus. JSON lines need a schema
    (no inference pass over the data); see ``read_json_lines`` for files that
    may hold broken lines."""
    reader = spark.read
    if schema:
        reader = reader.schema(schema)
    return reader.format(fmt).load(path)


def read_json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines read by a schema, in one pass. A line that is no JSON
    object, or whose values do not fit the schema, becomes a row whose columns
    are NULL (as far as they could not be read) and whose text is kept in
    ``BROKEN``; on all other rows that column is NULL. Empty lines are skipped."""
    return (spark.read.schema(f"{schema}, `{BROKEN}` string").option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", BROKEN).json(path))


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None) -> None:
    """Write rows (parquet or JSON lines), optionally partitioned."""
    writer = df.write.mode(mode).format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
