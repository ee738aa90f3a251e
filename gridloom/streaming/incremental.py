"""Facts that arrive as a stream: latest values kept up to date, and late facts counted by window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from gridloom.sources.sinks import replace_partitions


def import_versions(stream: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Write each micro-batch into partitions (version, batch) of its own: a batch that is repeated after a failure
    overwrites itself, and a version whose facts come in several batches keeps all of them.

    A fact delivered again in a later batch is stored again; distinct_facts() removes that on reading. Another import needs
    a path of its own, because its batches are numbered from 0 again.
    """

    def write(batch: DataFrame, no: int) -> None:
        replace_partitions(batch.distinct().withColumn("batch", F.lit(no).cast("long")), path, "version", "batch")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


def event_counts(stream: DataFrame, at: str, kind: str, late: str = "10 minutes", width: str = "5 minutes") -> DataFrame:
    """(start, kind, n, total): events by window and kind; later than `late` behind the newest they are ignored."""
    w = stream.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, late).groupBy(F.window(at, width).alias("w"), F.col(kind).alias("kind"))
    return w.agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), "kind", "n", "total")
