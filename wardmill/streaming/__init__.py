"""The task worker as a Structured Streaming job.

Messages come from any streaming source. Each is taken once per key within the watermark; a micro-batch
is decided against the task tables, annotated, and written: results, task states, deliveries and pings,
under the batch's number, so that a batch that runs again after a lost executor overwrites its own output.
Nothing of the stream is brought to the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from wardmill.operators import tasks

MESSAGE = "work_type string, redis_key string, sender string, version string"
_STATUS = {"start": "started", "cancel": "canceled", "exceed": "completed - failure", "fail": "failed", "complete": "completed - success"}


def deduplicated(messages: DataFrame, key: str, time: str, delay: str = "10 minutes") -> DataFrame:
    """Each key once, whatever number of deliveries come within the delay; state older than that is dropped."""
    return messages.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def run_once(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """Runs a stream over what is there, writing Parquet files under ``path``, and returns them as a table.

    In mode update each batch writes the rows it changed beside its number, as ``batch``.
    """
    if mode == "append":
        writer = stream.writeStream.format("parquet").option("path", path)
    else:
        writer = stream.writeStream.outputMode(mode).foreachBatch(lambda df, n: df.write.mode("overwrite").parquet(f"{path}/batch={n}"))
    writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.read.schema(stream.schema if mode == "append" else stream.schema.add("batch", "long")).parquet(path)


def attempts(events: DataFrame, key: str, kind: str, idle_days: int | None = None) -> DataFrame:
    """key, attempts, status: the state of each task, updated by its events in arrival order.

    With ``idle_days`` a task that hasn't been heard of for so long is forgotten: for streams that go on; a
    bounded run (availableNow) wouldn't end with such timers.
    """

    def update(k: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        n, status = state.get if state.exists else (0, "submitted")
        for f in frames:
            n += int(f[kind].isin(["start", "cancel", "exceed"]).sum())
            known = f[kind].map(_STATUS).dropna()
            status = known.iloc[-1] if len(known) else status
        state.update((n, status))
        if idle_days:
            state.setTimeoutDuration(idle_days * 86_400_000)
        yield pd.DataFrame({key: [k[0]], "attempts": [n], "status": [status]})

    schema = f"{key} {events.schema[key].dataType.simpleString()}, attempts int, status string"
    return events.groupBy(key).applyInPandasWithState(update, schema, "attempts int, status string", "update", GroupStateTimeout.ProcessingTimeTimeout if idle_days else GroupStateTimeout.NoTimeout)


def process(messages: DataFrame, tables: tuple[DataFrame, DataFrame, DataFrame], annotate: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(results, chunk states, document updates, deliveries) of a batch of messages.

    ``messages``: message_id, chunk_id, redelivered. ``annotate`` takes the messages that run and gives
    message_id, response, error; a failed annotation marks its task failed and is acknowledged all the same,
    since trying again is the sender's business. A message that can't be read or decided is requeued once,
    then dropped, and isn't passed on.
    """
    decided = tasks.decide(messages, *tables)
    done = annotate(decided.filter("decision = 'run'")).select("message_id", "response", F.col("error").alias("failure"))
    both = decided.join(done, "message_id", "left")
    results = both.filter("decision = 'run' AND failure IS NULL AND response IS NOT NULL").select("message_id", "document_id", "chunk_id", "response")
    states = tasks.updated_chunks(both, F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"))
    deliveries = both.select("message_id", "chunk_id", "decision", "error", tasks.delivery(F.col("redelivered"), F.col("error")).alias("action"), F.when(F.col("error").isNull(), tasks.NAME).alias("sender"))
    return results, states, tasks.failed_documents(both), deliveries


def start_worker(messages: DataFrame, load_tables: Callable[[], tuple[DataFrame, DataFrame, DataFrame]], annotate: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Messages (message_id, chunk_id, redelivered, ts) -> results, states, documents, deliveries and pings under ``out``.

    ``interval`` is the time between batches; without one the worker takes what is there and ends. What a
    source gives in one batch is bounded by its own option (``file_messages``).
    """

    def batch(df: DataFrame, number: int) -> None:
        results, states, documents, deliveries = process(df, load_tables(), annotate)
        deliveries = deliveries.persist()  # pings are read from it too
        try:
            for name, frame in (("results", results), ("states", states), ("documents", documents), ("deliveries", deliveries), ("pings", deliveries.filter("action = 'ack'").select("message_id", "chunk_id", "sender"))):
                frame.write.mode("overwrite").json(f"{out}/{name}/batch={number}")
        finally:
            deliveries.unpersist()

    once = deduplicated(messages, "message_id", "ts")
    writer = once.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()


def file_messages(spark: SparkSession, path: str, schema: str, most: int = 5) -> DataFrame:
    """JSON message files as a stream, at most ``most`` files a batch (the prefetch limit)."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", most).json(path)
