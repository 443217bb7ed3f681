"""Change requests as a stream: each micro-batch is applied like a batch of requests."""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from crewlens.plans.medallion import change_employees
from crewlens.session import stored
from crewlens.sources.store import LayerStore


def apply_stream(
    requests: DataFrame, checkpoint: str, change: Callable[[DataFrame, str], object]
) -> StreamingQuery:
    """Start applying a streaming frame of requests of one kind: change(requests, batch id), one of
    the jobs of `plans.medallion`.

    A batch is one commit under its id. One that is replayed after a failure was applied whole, and
    then its stored answer stands, or it left nothing behind and is applied now.
    """

    def apply(batch: DataFrame, number: int) -> None:
        if not batch.isEmpty():
            change(stored(batch, "requests"), f"{checkpoint.rstrip('/')}#{number}")

    return (
        requests.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).start()
    )


def apply_employee_changes_stream(
    requests: DataFrame,
    store: LayerStore,
    checkpoint: str,
    today: Callable[[], datetime.date] = datetime.date.today,
) -> StreamingQuery:
    """Employee changes, each batch judged by the day it is first applied on."""

    def change(batch: DataFrame, name: str) -> None:
        if store.answer(name) is None:
            change_employees(store, batch, today(), name)

    return apply_stream(requests, checkpoint, change)
