"""Reading tables as streams and running a stream into a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from contentgate.session import configure

FILES_PER_TRIGGER = 1000


def read_stream(
    spark: SparkSession, path: str, schema: T.StructType, format: str = "parquet", files_per_trigger: int = FILES_PER_TRIGGER
) -> DataFrame:
    """New files of a folder (or glob) as a stream. The files per trigger bound a micro-batch,
    and with it what a stateful operator sees of one key at a time."""
    reader = configure(spark, streaming=True).readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    return reader.format(format).load(path)


def write_stream(
    stream: DataFrame, path: str, checkpoint: str, partition_by: tuple[str, ...] = (), continuous: str | None = None
) -> StreamingQuery:
    """Start a stream into a parquet table. The file sink records each finished batch, so a
    restart from the checkpoint neither loses nor repeats rows.

    ``continuous`` is a processing-time interval; without it the stream takes what is there
    and stops.
    """
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    trigger = {"processingTime": continuous} if continuous else {"availableNow": True}
    return writer.trigger(**trigger).start(path)
