"""The log laid out by unit: a table in buckets of the serial number.

Rows of a unit lie in one bucket, sorted, so aggregates by unit and look-ups
of units need no exchange of the log. Appends keep the layout. The catalog
that knows the buckets is the session's; ``attach`` names the files of an
earlier session again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

UNIT = "sn"


def write(log: DataFrame, table: str, path: str, buckets: int, mode: str = "overwrite", by: str = UNIT) -> None:
    """``log`` as ``table`` at ``path`` in ``buckets`` files per task group, sorted by unit.

    Rows are dealt out by the bucket's hash first, so a task writes one bucket and not a file of each. A unit is bounded by
    its route through the stations; rows without a serial number share a bucket.
    """
    (log.repartition(buckets, by).write.mode(mode).format("parquet").option("path", path)
     .bucketBy(buckets, by).sortBy(by).saveAsTable(table))


def append(rows: DataFrame, table: str, path: str, buckets: int, by: str = UNIT) -> None:
    write(rows.select(*rows.sparkSession.table(table).columns), table, path, buckets, "append", by)


def attach(spark: SparkSession, table: str, path: str, schema: T.StructType, buckets: int, by: str = UNIT) -> DataFrame:
    """The table over files that ``write`` has left at ``path``."""
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({cols}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) "
              f"INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(table)
