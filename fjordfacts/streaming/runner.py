"""Resumable runs as streams: new files are read, transformed and appended once, whatever stops in between."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def stream_table(spark: SparkSession, path: str, schema: str, fmt: str = "parquet", files_per_trigger: int = 1000) -> DataFrame:
    return spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", files_per_trigger).load(path)


def run_available(stream: DataFrame, transform: Callable[[DataFrame], DataFrame], output: str, checkpoint: str, key: list[str] | None = None) -> StreamingQuery:
    """Takes all files that are there and stops. A batch that is repeated after a failure replaces its own earlier output; keys already written by earlier batches are left out if a key is given."""

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        out = transform(batch)
        if key:
            try:
                done = spark.read.parquet(output).where(F.col("batch") < number)
                out = out.join(done.select(*key).distinct(), key, "left_anti")
            except Exception as e:  # noqa: BLE001
                if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                    raise
        out.write.mode("overwrite").parquet(f"{output}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def boxed(query: StreamingQuery, seconds: float) -> bool:
    """Waits for a run at most so long and stops it then; whether it came to its end. What was not done comes with the next run."""
    ended = bool(query.awaitTermination(seconds))
    if not ended:
        query.stop()
    return ended


def windowed_status(stream: DataFrame, at: str = "ts", late: str = "1 day", width: str = "1 hour") -> DataFrame:
    """Status counts by event time; rows later than the watermark are dropped."""
    return stream.withWatermark(at, late).groupBy(F.window(at, width), "status").agg(F.count(F.lit(1)).alias("n"))
