"""State of tasks, kept by Spark's state store: one small row for each task, whatever its history.

Events (task_id, queue, kind, fence, attempt, code, profile) are `claim` (a holder takes the task under a higher fence), `report` (a try ends, code null where it succeeded)
and `profile` (the profile that tasks are checked against has changed). A transition (task_id, queue, event, state, fence, attempt, profile) is given for each event, stale ones included."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from uiloom.operators.matching import positions
from uiloom.streaming.queue import ATTEMPTS, RETRYABLE

EVENT = "task_id bigint, queue string, seq bigint, kind string, fence bigint, attempt int, code string, profile string"
STATE = "state string, fence bigint, attempt int, profile string"
TRANSITION = "task_id bigint, queue string, seq bigint, event string, state string, fence bigint, attempt int, profile string"
#: What a state store must offer for tasks.
STORE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


def move(now: tuple[str, int, int, str | None], event: Row) -> tuple[str, tuple[str, int, int, str | None]]:
    """What an event is (`applied` or `stale`) and the state after it: state, fence, attempts so far, profile.

    waiting -> held (claim) -> done, failed, or waiting again (a retryable code with tries left). A new profile takes a task that isn't done back to waiting, with all tries, and
    raises the fence, so that the holder's report is stale. Only the current fence may report; a claim needs a higher one; done is final."""
    state, fence, attempt, profile = now
    if event.kind == "profile":
        if state == "done" or event.profile is None or event.profile == profile:
            return "stale", now
        return "applied", ("waiting", fence + 1 if state == "held" else fence, 0, event.profile)
    if event.kind == "claim":
        if state != "waiting" or event.fence is None or event.fence <= fence:
            return "stale", now
        return "applied", ("held", event.fence, attempt + 1, profile)
    if event.kind == "report":
        if state != "held" or event.fence != fence:
            return "stale", now
        if event.code is None:
            return "applied", ("done", fence, attempt, profile)
        again = event.code in RETRYABLE and attempt < ATTEMPTS
        return "applied", ("waiting" if again else "failed", fence, attempt, profile)
    return "stale", now


class Tasks(StatefulProcessor):
    """A task's state, moved on by its events in the order of `seq`."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.own = handle.getValueState("task", STATE)

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: object) -> Iterator[Row]:  # noqa: N802, N803
        now = tuple(self.own.get()) if self.own.exists() else ("waiting", 0, 0, None)
        for event in sorted(rows, key=lambda e: (e.seq is None, e.seq or 0)):
            what, now = move(now, event)
            yield Row(task_id=key[0], queue=event.queue, seq=event.seq, event=what, state=now[0], fence=now[1], attempt=now[2], profile=now[3])
        self.own.update(now)

    def close(self) -> None:
        pass


def transitions(events: DataFrame) -> DataFrame:
    """The transitions of a stream of events. A batch holds a task's events in any order; over batches they must come in the order of `seq`. Events without task_id are left out."""
    return events.where("task_id IS NOT NULL").groupBy("task_id").transformWithState(Tasks(), outputStructType=TRANSITION, outputMode="append", timeMode="none")


def run_available(events: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Appends the transitions of the events that are there to a Parquet folder, then stops. Needs the settings STORE; each batch reads and writes the state of its own tasks only."""
    return transitions(events).writeStream.format("parquet").option("path", folder).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def fair_order(claims: DataFrame, queue: str, order: list[str]) -> DataFrame:
    """Claims with `turn`, gapless from 0: the queues take turns, in the order of their names, each serving its own claims in `order`; a queue that is empty is passed over."""
    numbered = positions(claims, [queue, *order], [queue], "_nth")
    return positions(numbered, ["_nth", queue], None, "turn").drop("_nth")
