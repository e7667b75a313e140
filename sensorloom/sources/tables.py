"""Stored tables and delimited files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column types a stored table may have.
STORED_TYPES = {
    "string": "STRING",
    "tinyint": "INT",
    "smallint": "INT",
    "int": "INT",
    "bigint": "BIGINT",
    "float": "DOUBLE",
    "double": "DOUBLE",
}


#: How a missing value is written, and the form of exported files.
CSV_NULL = "\\N"
CSV_FORM = {
    "quoteAll": True, "quote": '"', "escape": '"', "nullValue": CSV_NULL, "emptyValue": "", "lineSep": "\n",
    "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
}


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | str, sep: str = ";", header: bool = True
) -> DataFrame:
    """Delimited file with a given schema (no pass to guess types)."""
    return spark.read.schema(schema).option("sep", sep).option("header", header).csv(path)


def read_exported_csv(spark: SparkSession, path: str, schema: T.StructType | str, sep: str = ",") -> DataFrame:
    """What ``export_csv`` wrote, each text as it was. A file is read by one task, as its lines
    may break inside a value; a row that does not fit the schema is an error."""
    reader = spark.read.schema(schema).options(header=True, sep=sep, multiLine=True, mode="FAILFAST", **CSV_FORM)
    return reader.csv(path)


def read_table(spark: SparkSession, name_or_path: str) -> DataFrame:
    """A catalog table, or the parquet files under a path."""
    if "/" in name_or_path:
        from ..sinks.tables import recover_table

        recover_table(spark, name_or_path)
        return spark.read.parquet(name_or_path)
    return spark.table(name_or_path)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 8,
    fetch_rows: int = 10_000,
) -> DataFrame:
    """A database table; with a partition column the tasks read ranges of it."""
    reader = (
        spark.read.format("jdbc").option("url", url).option("dbtable", table).option("fetchsize", fetch_rows)
    )
    if partition_column and bounds:
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", bounds[0])
            .option("upperBound", bounds[1])
            .option("numPartitions", partitions)
        )
    return reader.load()


def list_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Names of the stored tables."""
    listing = spark.sql(f"SHOW TABLES IN `{database}`" if database else "SHOW TABLES")
    return listing.where(~F.col("isTemporary")).select(F.col("tableName").alias("name"))


def infer_table_schema(df: DataFrame) -> dict[str, str]:
    """Column types for a stored table; a type without one is an error."""
    out = {}
    for name, kind in df.dtypes:
        if kind not in STORED_TYPES:
            raise TypeError(f"{name}: type {kind} cannot be stored")
        out[name] = STORED_TYPES[kind]
    return out


def stream_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str = "parquet",
    max_files: int | None = None,
) -> DataFrame:
    """A table's files as a stream; ``path`` may be a folder or one file."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    # A pattern that names just this path: the file source takes a single file only so.
    return reader.load(f"{path[:-1]}[{path[-1]}]")


def stream_batches(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """What ``stage_batches`` wrote, as a stream of one file after the other."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
