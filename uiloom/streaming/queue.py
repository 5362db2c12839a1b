"""Work queue over tables: commands arrive as files and are settled by an availableNow query.

A command (task_id, command_id, fence, attempt, code) reports one try at a task; `code` is null where it succeeded.
Leases (task_id, fence) name the holder that may report. Retries reuse their command id, so a command counts once.
What has been settled is read from the earlier batches' folders; for long histories uiloom.streaming.tasks keeps one row of state for each task instead."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

# Tries of a task, and the failures that are worth another one.
ATTEMPTS = 3
RETRYABLE = ("http-403", "http-408", "http-425", "http-429", "http-500", "http-502", "http-503", "http-504")

COMMAND = "task_id bigint, command_id string, fence bigint, attempt int, code string"


def settle(commands: DataFrame, leases: DataFrame) -> DataFrame:
    """One row (task_id, command_id, state) for each distinct command: `stale` without the current fence, `done`,
    `requeued` for a retryable failure with tries left, else `failed`. Of a command's copies the latest attempt counts,
    of equal attempts a success. Null task ids hold no lease and are stale."""
    latest = commands.groupBy("task_id", "command_id").agg(
        F.max(F.struct("attempt", F.col("code").isNull().alias("ok"), "code", "fence")).alias("last")
    )
    held = latest.select("task_id", "command_id", "last.*").join(leases.select("task_id", F.col("fence").alias("_current")), "task_id", "left")
    again = F.coalesce(F.col("code").isin(*RETRYABLE), F.lit(False)) & (F.col("attempt") < ATTEMPTS)
    state = (
        F.when(~F.col("fence").eqNullSafe(F.col("_current")) | F.col("_current").isNull(), "stale")
        .when(F.col("ok"), "done")
        .when(again, "requeued")
        .otherwise("failed")
    )
    return held.select("task_id", "command_id", state.alias("state"))


def run_available(spark: SparkSession, commands: str, leases: str, settled: str, checkpoint: str) -> StreamingQuery:
    """Settles the commands that lie in a Parquet folder and weren't settled yet, then stops.

    A batch goes to a folder of its own under `settled`, which a batch repeated after a failure overwrites; the leases are read
    anew for each batch. All folders must be shared ones. A command that was settled in an earlier batch is left out unless it was requeued."""
    stream = spark.readStream.schema(COMMAND).parquet(commands)

    def write(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        now = settle(batch, session.read.parquet(leases))
        if number > 0:
            before = session.read.schema("task_id bigint, command_id string, state string, batch bigint").parquet(settled)
            final = before.where((F.col("batch") < number) & (F.col("state") != "requeued")).select("task_id", "command_id")
            now = now.join(final, ["task_id", "command_id"], "left_anti")
        now.write.mode("overwrite").parquet(f"{settled}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
