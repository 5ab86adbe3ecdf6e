"""Incremental ingest: new source files become lines as they arrive. Optional; every other part is batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lodestrata.sources.lines import file_name, line_table


def stream_lines(spark: SparkSession, path: str, pattern: str = "*", files_per_trigger: int = 1000) -> DataFrame:
    """A stream of (source_file, line_num, line) from files that appear under `path`; each file is read once, whole."""
    reader = spark.readStream.option("pathGlobFilter", pattern).option("maxFilesPerTrigger", files_per_trigger)
    files = reader.text(path, wholetext=True).select(file_name().alias("source_file"), F.col("value").alias("text"))
    return line_table(files)


def append_lines(lines: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Append the lines that have arrived to Parquet files, exactly once, then stop."""
    return lines.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
