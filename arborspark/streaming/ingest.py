"""Newly arrived skeleton files parsed once into a node table.

The stream checkpoint takes the place of a log of finished files: a restart
continues with the files not yet seen.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from arborspark.sources import swc


def ingest(spark: SparkSession, folder: str, target: str, checkpoint: str) -> StreamingQuery:
    """Parse all files that arrived since the last run and append their nodes."""
    arriving = spark.readStream.format("text").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.[sS][wW][cC]")
    lines = arriving.load(folder).select(*swc.SPLIT_COLUMNS)

    def append(batch, batch_id: int) -> None:
        rows = swc.split_lines(batch, F.col("file_path"))
        # a batch replayed after a failure overwrites its own folder only
        swc.nodes(swc.parse(rows, "coerce")).write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    return (
        lines.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
