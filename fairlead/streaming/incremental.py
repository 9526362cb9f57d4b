"""The batch operators on streams of files: each new file of rows is checked once, and late rows are counted in windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from fairlead.operators.quality import Rule, cell_findings, pair_findings


def read_rows(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int = 100) -> DataFrame:
    """A stream of the Parquet files that appear under a path or match a pattern."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def stream_findings(rows: DataFrame, rules: list[Rule], out: str, checkpoint: str) -> StreamingQuery:
    """Findings on new rows, appended to ``out`` once per micro-batch and ended when all files there are read.

    A batch that is run again after a failure overwrites its own partition (batch), so nothing is written twice.
    """

    def write(batch: DataFrame, number: int) -> None:
        found = cell_findings(batch, rules).unionByName(pair_findings(batch))
        found.write.mode("overwrite").parquet(f"{out}/batch={number}")

    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def first_deliveries(rows: DataFrame, key: str, at: str, lateness: str = "1 hour") -> DataFrame:
    """Rows whose key was not delivered before, within the watermark; state older than that is dropped."""
    return rows.withWatermark(at, lateness).dropDuplicatesWithinWatermark([key])


def counts_by_window(events: DataFrame, at: str, by: str, width: str = "1 hour", lateness: str = "10 minutes") -> DataFrame:
    """Rows per window and ``by``; rows later than the watermark are not counted again."""
    return events.withWatermark(at, lateness).groupBy(F.window(at, width).alias("w"), F.col(by)).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), by, "n")
