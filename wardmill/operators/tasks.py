"""Task messages: decisions, transitions, documents updated by failed tasks, deliveries.

The stores of job, document and chunk tasks are tables with a raw JSON column. An update is a projection
from the old row to the new one; each key has one writer (a group, or a state of the stream), which takes
the place of locks, so no update is lost and no lock error can hide a failed save.

Defined cases: a chunk without a task, and a job or document that is asked for and isn't there, are
errors, as their messages say; null attempts count as 0; keys that a schema doesn't know are kept as they
are, with their types.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

MAX_ATTEMPTS = 3
NAME = "fdl"
#: The fields of a document task that its cached projection holds.
CACHED = ("document_info", "failed_tasks", "job_id", "work_type")


def decision(status: Column, canceled: Column, stop_on_failure: Column, document_failed: Column, attempts: Column, most: int = MAX_ATTEMPTS) -> Column:
    """What to do with a chunk task. The order of the cases matters."""
    return (
        F.when(F.coalesce(status, F.lit("")).startswith("completed"), "skip")
        .when(F.coalesce(canceled, F.lit(False)), "canceled")
        .when(F.coalesce(stop_on_failure, F.lit(False)) & F.coalesce(document_failed, F.lit(False)), "canceled: document failed")
        .when(F.coalesce(attempts, F.lit(0)) >= most, "completed - failure")
        .otherwise("run")
    )


def decide(messages: DataFrame, chunks: DataFrame, documents: DataFrame, jobs: DataFrame) -> DataFrame:
    """Messages with ``decision`` and ``error``: joined with their chunk, its document (may be missing) and its job.

    A message whose chunk or job isn't there, or whose document is asked for (its job stops on failures) and
    isn't there, has an error and no decision, unless its chunk is complete.
    """
    c, d, j = chunks.withColumn("__chunk", F.lit(True)), documents.withColumn("__doc", F.lit(True)), jobs.withColumn("__job", F.lit(True))
    joined = messages.join(c, "chunk_id", "left").join(d, "document_id", "left").join(j, "job_id", "left")
    done = F.coalesce(F.col("status"), F.lit("")).startswith("completed")
    missing = (
        F.when(F.col("__chunk").isNull(), "chunk task not found")
        .when(~done & F.col("__job").isNull(), "job task not found")
        .when(~done & ~F.coalesce("user_canceled", F.lit(False)) & F.coalesce("stop_documents_on_failure", F.lit(False)) & F.col("__doc").isNull(), "document task not found")
    )
    out = joined.withColumn("error", missing)
    verdict = decision(F.col("status"), F.col("user_canceled"), F.col("stop_documents_on_failure"), F.col("document_failed"), F.col("attempts"))
    return out.withColumn("decision", F.when(F.col("error").isNull(), verdict)).drop("__chunk", "__doc", "__job")


def transitions(events: DataFrame, key: str, order: list[str], kind: str) -> DataFrame:
    """Events with the attempts so far and the status after each. ``kind``: start, cancel, exceed, fail, complete or other."""
    w = W.partitionBy(key).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    k = F.col(kind)
    known = F.when(k == "start", "started").when(k == "cancel", "canceled").when(k == "exceed", "completed - failure").when(k == "fail", "failed").when(k == "complete", "completed - success")
    return events.withColumns({"attempts": F.sum(F.when(k.isin("start", "cancel", "exceed"), 1).otherwise(0)).over(w), "status_after": F.coalesce(F.last(known, True).over(w), F.lit("submitted"))})


def outcome(decided: Column, failed: Column) -> Column:
    """The event that follows a decision: ``failed`` tells whether the annotation of a task that ran failed."""
    return F.when(decided == "run", F.when(failed, "fail").otherwise("complete")).when(decided.startswith("canceled"), "cancel").when(decided == "completed - failure", "exceed").otherwise("other")


def updated_chunks(decided: DataFrame, now: Column, most: int = MAX_ATTEMPTS) -> DataFrame:
    """chunk_id, status, attempts, started_at, completed_at, error_messages, results_key of chunk tasks after their messages.

    ``decided``: chunk_id, document_id, status, attempts, error_messages, decision, failure (the error of the
    annotation or null). Of several messages for one chunk the first that isn't skipped counts: one writer
    per key.
    """
    tries = F.coalesce("attempts", F.lit(0)) + 1
    said = (
        F.when(F.col("decision") == "completed - failure", F.concat(F.lit("Task has exceeded retries. (Attempts: "), tries.cast("string"), F.lit(f", max retries: {most} )")))
        .when(F.col("decision") == "canceled: document failed", F.lit('Task was marked as "canceled" because the current document has failed and won\'t be processed successfully.'))
        .otherwise(F.col("failure"))
    )
    event = outcome(F.col("decision"), F.col("failure").isNotNull())
    status = F.when(event == "cancel", "canceled").when(event == "exceed", "completed - failure").when(event == "fail", "failed").otherwise("completed - success")
    rows = decided.filter(F.col("decision").isNotNull() & (F.col("decision") != "skip")).select(
        "chunk_id", status.alias("status"), tries.alias("attempts"), now.alias("started_at"), now.alias("completed_at"),
        F.concat(F.coalesce("error_messages", F.array().cast("array<string>")), F.when(said.isNotNull(), F.array(said)).otherwise(F.array().cast("array<string>"))).alias("error_messages"),
        F.when(event == "complete", F.concat(F.lit("processed/documents/"), F.col("document_id").cast("string"), F.lit("/chunks/"), F.col("chunk_id").cast("string"), F.lit("/"), F.col("chunk_id").cast("string"), F.lit(f".{NAME}_results.json"))).alias("results_key"),
    )
    return one_writer(rows, "chunk_id", "attempts")


def one_writer(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The first row of each key by ``order`` and then by its content: the save that takes effect."""
    rest = [c for c in rows.columns if c != key]
    kept = rows.groupBy(key).agg(F.min_by(F.struct(*rest), F.struct(F.col(order).alias("o"), F.xxhash64(*rest).alias("h"))).alias("r"))
    return kept.select(key, "r.*")


def failed_documents(decided: DataFrame) -> DataFrame:
    """document_id, failed_tasks, failed_chunks (chunk -> tasks): what exceeded chunks add to their documents."""
    gone = decided.filter("decision = 'completed - failure'").groupBy("document_id").agg(F.sort_array(F.collect_set(F.col("chunk_id").cast("string"))).alias("c"))
    return gone.select("document_id", F.transform("c", lambda _: F.lit(NAME)).alias("failed_tasks"), F.map_from_entries(F.transform("c", lambda x: F.struct(x, F.array(F.lit(NAME))))).alias("failed_chunks"))


def with_projection(documents: DataFrame, raw: str, fields: tuple[str, ...] = CACHED) -> DataFrame:
    """Documents with ``cached``: the fields of their raw JSON that readers hold, each as it stands. Both are saved from one row."""
    return documents.withColumn("cached", F.to_json(F.map_filter(_fields(F.col(raw)), lambda k, _: k.isin(*fields))))


def delivery(redelivered: Column, error: Column) -> Column:
    """ack, requeue or drop: a message that fails is tried once more, then dropped; a failed annotation is no such failure."""
    return F.when(error.isNull(), "ack").when(F.coalesce(redelivered, F.lit(False)), "drop").otherwise("requeue")


def partial(df: DataFrame, column: str, schema: str) -> DataFrame:
    """A JSON column as typed fields, the raw text kept for keys that the schema lacks."""
    return df.withColumn("typed", F.from_json(column, schema))


def _fields(raw: Column) -> Column:
    """The keys of a JSON object with their values as they are."""
    return F.from_json(raw, "map<string,variant>")


def updated(raw: Column, changes: Column) -> Column:
    """A JSON object with the keys of another laid over it; unknown keys are kept, values keep their types."""
    new = _fields(changes)
    return F.to_json(F.map_concat(F.map_filter(_fields(raw), lambda k, _: ~F.map_contains_key(new, k)), new))
