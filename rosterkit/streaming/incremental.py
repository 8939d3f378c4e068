"""Incremental employer reports with Structured Streaming.

The batch job rescans the whole mailbox on every run and decodes every
workbook again. Here new messages arrive as a stream (any streaming
source with the messages schema, e.g. Parquet files dropped in a
folder); each micro-batch decodes only its own attachments and appends
them to a Parquet store in the shared folder. Reports are then built
from the store with the same plan as the batch job.

Exactly-once: every micro-batch writes to a directory named after its
batch id in overwrite mode, so a retried batch replaces its own output;
the stream's progress lives in ``checkpointLocation``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans import reports as P
from ..session import discard, ensure_checkpoint_dir, materialize


def _once(batch: DataFrame, repeated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The messages of ids that come once, and one message of each repeated
    id: whatever is sorted and shuffled here is the repeated ones only,
    never every message with its attachments."""
    same = F.col("message_id").eqNullSafe(F.col("_id"))
    ids = repeated.select(F.col("message_id").alias("_id"))
    return batch.join(ids, same, "left_anti"), batch.join(ids, same, "left_semi").dropDuplicates(["message_id"])


def first_delivery(df: DataFrame) -> DataFrame:
    """A message delivered again lies in a later ``batch`` too: the rows of
    its first batch. Batches are looked up for the messages of several."""
    several = df.groupBy(F.col("message_id").alias("_id")).agg(F.min("batch").alias("_first"), F.max("batch").alias("_last"))
    several = materialize(several.where("_first < _last").drop("_last"), "delivered_again")
    found = df.join(several, F.col("message_id").eqNullSafe(F.col("_id")), "left")
    return found.where(F.col("_first").isNull() | (F.col("batch") == F.col("_first"))).drop("_id", "_first", "batch")


def _store_batch(base: str, params: P.ReportParams):
    def write(batch: DataFrame, batch_id: int) -> None:
        ensure_checkpoint_dir(batch.sparkSession)
        repeated = materialize(batch.groupBy("message_id").count().where("count > 1"), "repeated_messages")
        single, again = _once(batch, repeated)
        again.persist()                                  # one choice for the three writes
        try:
            msgs = P.scan_messages(single.unionByName(again), params)
            P.decode_data_files(P.data_files(msgs, params)).write.mode("overwrite").partitionBy("kind").parquet(f"{base}/decoded/batch={batch_id}")
            P.attachment_names(msgs, params).write.mode("overwrite").parquet(f"{base}/attachments/batch={batch_id}")
            P.message_facts(msgs, params).write.mode("overwrite").parquet(f"{base}/messages/batch={batch_id}")
        finally:
            again.unpersist()
            discard(repeated)
    return write


def start_decoding(stream: DataFrame, base: str, checkpoint: str,
                   params: P.ReportParams = P.ReportParams(), available_now: bool = True) -> StreamingQuery:
    """Decode every new message of ``stream`` into the store at ``base``."""
    w = stream.writeStream.foreachBatch(_store_batch(base, params)).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def reports_from_store(spark: SparkSession, base: str,
                       params: P.ReportParams = P.ReportParams()) -> P.ReportRun:
    """Employer reports and diagnostics from everything decoded so far."""
    decoded = first_delivery(spark.read.parquet(f"{base}/decoded"))
    atts = first_delivery(spark.read.parquet(f"{base}/attachments"))
    facts = first_delivery(spark.read.parquet(f"{base}/messages"))
    return P.report_run(decoded, atts, P.stored_counts(facts, decoded), params)
