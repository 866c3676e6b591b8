"""Landed files merged as they arrive.

The batch jobs find new rows by a load-time watermark. Where files land in a
folder, the same merge can follow the folder instead: the checkpoint records
which files were read, and ``availableNow`` ends the query when none is left.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from urbanlake.sources import tables


def merge_landed(
    spark: SparkSession,
    folder: str,
    schema: str,
    checkpoint: str,
    target: str,
    build: Callable[[DataFrame], DataFrame],
    keys: list[str],
    partition_by: list[str],
) -> None:
    """Merge every file of ``folder`` not merged before into ``target``.

    A batch repeated after a failure merges the same rows again, so the table
    is the same.
    """

    def merge_batch(batch: DataFrame, _: int) -> None:
        tables.upsert_table(build(batch), target, keys, partition_by)

    query = (
        spark.readStream.schema(schema)
        .parquet(folder)
        .writeStream.foreachBatch(merge_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
