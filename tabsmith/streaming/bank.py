"""Incremental failed-transaction extract with Structured Streaming.

The failed extract is a stateless filter, so it runs unchanged on a stream
of cleaned CSV files arriving in a folder: each new file is read once,
filtered and appended to the output. Progress is kept in the checkpoint
folder, so a restarted or failed job resumes where it stopped and writes
every file exactly once.

The cleaning job removes whole rows that repeat, over all history. As a stream
it remembers a digest of every row for as long as ``window`` after the row came
in, so copies that come within the window of each other collapse, and the state
holds one window's digests. The time is that of arrival: a watermark on dates in
the rows would drop rows that come late; here none is ever late or lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tabsmith.plans.bank import FAILED_STATUSES, STATUS_COL, clean_distinct, failed_transactions


def failed_stream(
    spark: SparkSession,
    cleaned_dir: str,
    schema: StructType,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Streaming DataFrame of failed/declined rows from CSV files in ``cleaned_dir``."""
    reader = spark.readStream.schema(schema).option("header", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return failed_transactions(reader.csv(cleaned_dir), STATUS_COL, FAILED_STATUSES)


def row_digest(columns: list[str]) -> Column:
    """SHA-256 of a whole row: each value's length and text, ``-`` for null, so
    that no two different rows spell the same."""
    values = [F.col(c).cast("string") for c in columns]
    return F.sha2(F.concat(*[F.when(v.isNull(), "-").otherwise(F.concat(F.octet_length(v), F.lit(":"), v)) for v in values]), 256)


def cleaned_stream(
    spark: SparkSession, raw_dir: str, schema: StructType, window: str = "7 days", max_files_per_trigger: int | None = None, **options: str
) -> DataFrame:
    """Streaming DataFrame of cleaned transactions from raw CSV files anywhere
    below ``raw_dir``: what ``clean_transactions`` gives, as long as copies of a
    row come within ``window`` of each other."""
    reader = spark.readStream.schema(schema).option("header", "true").option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    for key, value in options.items():
        reader = reader.option(key, value)
    raw = reader.csv(raw_dir)
    arrived = raw.withColumns({"__digest": row_digest(raw.columns), "__arrived": F.current_timestamp()})
    once = arrived.withWatermark("__arrived", window).dropDuplicatesWithinWatermark(["__digest"])
    return clean_distinct(once.drop("__digest", "__arrived"))


def run_clean_stream(
    spark: SparkSession, raw_dir: str, out_dir: str, checkpoint_dir: str, schema: StructType, fmt: str = "parquet",
    window: str = "7 days", available_now: bool = True, processing_time: str | None = None, max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Start the cleaning stream; triggers as in :func:`run_failed_stream`. The
    digests are kept in the state store under ``checkpoint_dir``, so a restarted
    stream still knows them."""
    return _started(cleaned_stream(spark, raw_dir, schema, window, max_files_per_trigger), out_dir, checkpoint_dir, fmt, available_now, processing_time)


def run_failed_stream(
    spark: SparkSession,
    cleaned_dir: str,
    out_dir: str,
    checkpoint_dir: str,
    schema: StructType,
    fmt: str = "parquet",
    available_now: bool = True,
    processing_time: str | None = None,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Start the stream. ``available_now`` processes what is there and stops
    (in several micro-batches when ``max_files_per_trigger`` bounds their
    size); otherwise it keeps running with ``processing_time`` triggers."""
    return _started(failed_stream(spark, cleaned_dir, schema, max_files_per_trigger), out_dir, checkpoint_dir, fmt, available_now, processing_time)


def _started(stream: DataFrame, out_dir: str, checkpoint_dir: str, fmt: str, available_now: bool, processing_time: str | None) -> StreamingQuery:
    writer = stream.writeStream.format(fmt).option("checkpointLocation", checkpoint_dir).outputMode("append")
    if fmt == "csv":
        writer = writer.option("header", "true")
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start(out_dir)
