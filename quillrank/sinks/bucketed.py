"""Bucketed Parquet folders outside any catalog.

Spark reads a table's buckets in place (no shuffle for a join or an aggregate
on the bucket columns, one bucket for an equality on them) only where the
catalog knows them. A folder is therefore entered in the session catalog for
the moment of writing or opening; the DataFrame that is returned keeps the
bucket layout and the files, and the entry is dropped again, so that nothing
is left in a shared metastore.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _entry() -> str:
    # Bucketing needs Spark's own catalog, whichever one is current.
    return f"spark_catalog.default.quillrank_{uuid.uuid4().hex[:16]}"


def _resolved(spark: SparkSession, entry: str) -> DataFrame:
    df = spark.table(entry)
    spark.sql(f"DROP TABLE IF EXISTS {entry}")  # external: the files stay
    return df


def write_bucketed(df: DataFrame, path: str, buckets: int, *columns: str, sort: tuple[str, ...] = (),
                   max_records: int = 0, compression: str | None = None) -> DataFrame:
    """Write ``df`` to a new folder in buckets of ``columns`` and return it as read from there.

    A task writes one file for each bucket it has rows of: data that is already
    partitioned by the columns gives about one file a bucket, and one hot key
    that several tasks share gives several. ``sort`` orders the rows of each
    file; ``max_records`` cuts files.
    """
    entry = _entry()
    writer = df.write.format("parquet").bucketBy(buckets, *columns).option("path", path)
    if sort:
        writer = writer.sortBy(*sort)
    if max_records:
        writer = writer.option("maxRecordsPerFile", max_records)
    if compression:
        writer = writer.option("compression", compression)
    writer.saveAsTable(entry)
    return _resolved(df.sparkSession, entry)


def open_bucketed(spark: SparkSession, path: str, schema: T.StructType, buckets: int, *columns: str,
                  sort: tuple[str, ...] = ()) -> DataFrame:
    """A folder of :func:`write_bucketed` again, for example in another session."""
    entry = _entry()
    names = ", ".join(f"`{c}`" for c in columns)
    order = f" SORTED BY ({', '.join(f'`{c}`' for c in sort)})" if sort else ""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE {entry} ({fields}) USING parquet CLUSTERED BY ({names}){order} INTO {int(buckets)} BUCKETS LOCATION '{path}'")
    return _resolved(spark, entry)
