"""Holdings rolled up file by file as they land.

Every micro-batch is rolled up on its own and written to a folder named by its id. A batch that is run again
after a failure overwrites its own folder, so nothing counts twice; reading adds the partial sums up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerloom.functions import text
from ledgerloom.operators import holdings


def stream_raw_files(spark: SparkSession, path: str, glob: str = "*.txt") -> DataFrame:
    """Streaming form of ``sources.files.read_raw_files``."""
    frame = spark.readStream.format("text").options(wholetext=True, pathGlobFilter=glob).load(path)
    return frame.select(
        F.col("_metadata.file_name").alias("file_name"), text.unix_newlines(F.col("value")).alias("raw")
    )


def start_rollup(lines: DataFrame, store: str, checkpoint: str) -> StreamingQuery:
    """Rolls up all lines that are there now, batch by batch, into ``store``."""

    def write_partial(batch: DataFrame, batch_id: int) -> None:
        holdings.rollup(batch).write.mode("overwrite").parquet(f"{store}/batch={batch_id}")

    return (
        lines.writeStream.foreachBatch(write_partial)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_rollup(spark: SparkSession, store: str) -> DataFrame:
    """The roll-up over all batches so far."""
    return holdings.rollup(spark.read.parquet(store))
