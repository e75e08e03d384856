"""Incremental cleaning of landed trade files.

Monthly pulls land as new CSV files in a country's landing folder. Instead
of re-cleaning the whole folder, a file-source stream picks up only the new
files, applies the same harmonise/clean operators as the batch job, and
appends to the Parquet clean table (partitioned by country). The
checkpoint makes the append exactly-once: a lost executor or a restarted
job resumes from the last committed batch. ``availableNow`` processes
everything present and stops, so the job can be scheduled like a batch.

A stream has one schema, so each landing folder holds files of one header
layout (one folder per country / export layout). A file whose header differs
stops the stream with an error instead of being read by position.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from importlens.operators.clean import clean_trade_frame, drop_incomplete
from importlens.schemas import strings

SPREAD = 16


def trade_stream(spark: SparkSession, landing_dir: str, header: list[str], iso3: str | None = None,
                 measure_type: str = "double", max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of cleaned rows from the files landing in ``landing_dir``."""
    reader = (spark.readStream.option("header", True).option("escape", '"').option("enforceSchema", False)
              .schema(strings(*header)))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    raw = reader.csv(landing_dir)
    return drop_incomplete(clean_trade_frame(raw, iso3, measure_type))


def start_trade_ingest(spark: SparkSession, landing_dir: str, out_dir: str, checkpoint_dir: str,
                       header: list[str], iso3: str | None = None, measure_type: str = "double",
                       available_now: bool = True, max_files_per_trigger: int | None = 1000) -> StreamingQuery:
    """Append newly landed files, cleaned, to the Parquet table at ``out_dir``.

    A batch takes at most ``max_files_per_trigger`` files, so a first run over a
    large folder is cut into bounded batches; a country's rows are dealt into at
    most ``SPREAD`` parts before the partitioned append, which bounds the files a
    batch writes and splits a large country whatever its codes.
    """
    writer = (trade_stream(spark, landing_dir, header, iso3, measure_type, max_files_per_trigger)
              .repartition("country_iso3", F.pmod(F.xxhash64("commodity_code", "month_date", "trade_value"), F.lit(SPREAD)))
              .writeStream.format("parquet")
              .option("checkpointLocation", checkpoint_dir)
              .partitionBy("country_iso3")
              .outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start(out_dir)
