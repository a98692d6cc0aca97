"""Files that land in a folder as a stream, and runs that take all that has landed.

A run ends by itself (``availableNow``); the next one, with the same checkpoint, goes on behind the
last file that was taken. Each micro-batch has a number that it keeps when it is run again after a
failure, and each checkpoint an identity of its own: writes that carry both happen once.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

#: Identity of a micro-batch: its stream, and its number in the stream.
Batch = tuple[str, int]
Sink = Callable[[DataFrame, Batch], None]


def landed(spark: SparkSession, folder: str, schema: StructType, form: str = "parquet",
           files_per_batch: int | None = None, **options: str) -> DataFrame:
    """The rows of the files in a folder, each file once, in the order in which they came. The
    schema is given: a stream that guesses one would change with its first file."""
    reader = spark.readStream.schema(schema).format(form).options(**options)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder)


def drain(stream: DataFrame, sink: Sink, checkpoint: str, mode: str = "append") -> list[dict]:
    """Give everything that has landed to the sink, batch by batch, then stop. Returns what Spark
    reports of each batch. A batch that fails ends the run; the next run repeats it.

    State lies in RocksDB on the executors' disks and in the checkpoint folder, not in the heap. The
    session's own choice of a state store is put back as soon as the run has begun."""
    def write(rows: DataFrame, number: int) -> None:
        spark = rows.sparkSession
        sink(rows, (spark.sparkContext.getLocalProperty("sql.streaming.queryId"), number))

    spark = stream.sparkSession
    chosen = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        query = stream.writeStream.foreachBatch(write).outputMode(mode).option(
            "checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        spark.conf.set(STATE_STORE, chosen)
    query.awaitTermination()
    return [json.loads(p.json) if hasattr(p, "json") else p for p in query.recentProgress]
