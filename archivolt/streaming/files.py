"""A folder as a stream: new line tables run through the same batch transforms, with progress kept in a checkpoint.

The batch operators have no event time and keep no state across documents, so none is invented here: a document is complete
in one file, and a restart takes up after the files that were finished.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def stream_files(
    spark: SparkSession, folder: str, schema: str, transform: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, fmt: str = "json"
) -> StreamingQuery:
    """Applies a batch transform to each new set of files and appends the result as Parquet; ends when the folder is done."""
    source = spark.readStream.schema(schema).format(fmt).load(folder)

    def batch(df: DataFrame, number: int) -> None:
        transform(df).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return source.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
