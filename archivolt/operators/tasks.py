"""How much a task gets: texts dealt out by their bytes, and Arrow batches of bounded size.

What a task holds then doesn't grow with the table. A row is the least that is dealt, so a long text bounds its task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text in a task whose rows are exploded into words or lines.
TASK_BYTES = 8 << 20
#: Bytes of an Arrow batch on its way to a Python worker, unless the session has set its own; a row may exceed it.
BATCH_BYTES = 4 << 20
_BATCH, _DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"


def dealt(rows: DataFrame, text: Column | str, *keys: Column | str, task_bytes: int = TASK_BYTES) -> DataFrame:
    """Rows dealt by ``keys`` (in turn, without any) to as many tasks as their texts need; the texts are measured first.

    The texts move, once, and not what is made of them: grouping by the keys needs no other exchange.
    """
    size = rows.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return rows.repartition(1 + size // task_bytes, *keys)


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches of a session that hasn't set their size are bounded, since several copies of each are in memory at once."""
    if spark.conf.get(_BATCH) == _DEFAULT:
        spark.conf.set(_BATCH, str(BATCH_BYTES))
