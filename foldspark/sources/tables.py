"""Sources and sinks: files, catalog tables, database tables, literal ranges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def read_table(spark: SparkSession, name: str, folder: str | None = None) -> DataFrame:
    """A lazy table: ``folder/name.parquet``, or ``[schema.]name`` in the catalog."""
    if folder is None:
        return spark.table(name)
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    *,
    partition_column: str,
    lower: str,
    upper: str,
    partitions: int,
    **options: str,
) -> DataFrame:
    """A database table read in parallel slices of ``partition_column``.

    Without the slices one task would read the whole table.
    """
    reader = spark.read.format("jdbc").options(
        url=url,
        dbtable=table,
        partitionColumn=partition_column,
        lowerBound=lower,
        upperBound=upper,
        numPartitions=str(partitions),
        **options,
    )
    return reader.load()


def register_table(df: DataFrame, name: str) -> str:
    """Publish a frame under a schema-qualified name and return that name."""
    df.createOrReplaceGlobalTempView(name)
    database = df.sparkSession.conf.get("spark.sql.globalTempDatabase", "global_temp")
    return f"{database}.{name}"


def integer_range(spark: SparkSession, first: int, last: int, name: str = "x") -> DataFrame:
    """The integers ``first..last``, one row each."""
    return spark.range(first, last + 1).withColumnRenamed("id", name)


def shape(df: DataFrame) -> DataFrame:
    """One row with the number of rows and of columns."""
    return df.agg(F.count("*").alias("n_rows")).withColumn(
        "n_cols", F.lit(len(df.columns)).cast("long")
    )


def write_table(
    df: DataFrame,
    path: str,
    partition_by: list[str] | None = None,
    mode: str = "errorifexists",
) -> None:
    """Save a frame, such as a prediction table, as parquet."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
