"""Database table scans over JDBC (MySQL, PostgreSQL, SQL Server, ...).

The database drivers are not bundled with Spark; put the jar on the
classpath (``spark.jars`` / ``--packages``) where the job is deployed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The usual JDBC driver class of each supported database kind.
DRIVERS = {
    "mysql": "com.mysql.cj.jdbc.Driver",
    "postgres": "org.postgresql.Driver",
    "mssql": "com.microsoft.sqlserver.jdbc.SQLServerDriver",
    "derby": "org.apache.derby.jdbc.EmbeddedDriver",
}


def quote_name(kind: str, table: str) -> str:
    """Quote a mixed-case table name where the database folds case.

    PostgreSQL folds unquoted names to lower case, so ``Region_Sales`` must be
    written ``"Region_Sales"``.
    """
    if kind == "postgres" and not table.startswith('"') and table != table.lower():
        return f'"{table}"'
    return table


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    kind: str | None = None,
    user: str | None = None,
    password: str | None = None,
    partition_column: str | None = None,
    lower_bound: int | str | None = None,
    upper_bound: int | str | None = None,
    num_partitions: int | None = None,
    fetch_size: int = 10000,
    **options: str,
) -> DataFrame:
    """Whole-table scan. Column pruning and simple filters written on the
    result are pushed into the database query by Spark.

    For large tables give ``partition_column`` (numeric, date or timestamp)
    with bounds and ``num_partitions``: each partition then reads one range
    in its own task, in parallel. The bounds only set the stride; rows
    outside them are still read (by the first and last partition).
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", quote_name(kind or "", table))
    if kind in DRIVERS and "driver" not in options:
        reader = reader.option("driver", DRIVERS[kind])
    if user is not None:
        reader = reader.option("user", user)
    if password is not None:
        reader = reader.option("password", password)
    reader = reader.option("fetchsize", str(fetch_size))
    if partition_column is not None:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("partition_column needs lower_bound, upper_bound and num_partitions")
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", str(lower_bound))
            .option("upperBound", str(upper_bound))
            .option("numPartitions", str(num_partitions))
        )
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.load()


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", kind: str | None = None, **options: str) -> None:
    writer = df.write.format("jdbc").option("url", url).option("dbtable", quote_name(kind or "", table)).mode(mode)
    if kind in DRIVERS and "driver" not in options:
        writer = writer.option("driver", DRIVERS[kind])
    for key, value in options.items():
        writer = writer.option(key, value)
    writer.save()
