"""Incremental runs over a message stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming.query import StreamingQuery

from sensormart.plans.increment import run_increment
from sensormart.plans.landing import land_messages
from sensormart.sources.store import StarStore


def start_stream(
    messages: DataFrame,
    store: StarStore,
    checkpoint: str,
    name: str = "increment",
    every: str | None = None,
    land_only: bool = False,
    after: Callable[[str], None] | None = None,
) -> StreamingQuery:
    """Feed a stream of messages (a ``value`` column) into the store.

    Without ``every`` the run takes what has arrived and ends, for use under a
    scheduler; ``every="10 minutes"`` keeps it running. History is unbounded, so
    repeats are looked up in the store and not in stream state. A micro-batch
    that is delivered again is recognised by its number and by the query's id,
    which Spark keeps in the checkpoint: another source, or the same one after its
    checkpoint was lost, has another id and is never taken for it. Errors end the
    query.
    ``land_only`` leaves the load to a separate ``load_pending``. ``after`` is called
    with the batch's label once it has landed (and loaded), before Spark notes the
    micro-batch as done: if it raises, the micro-batch is delivered again. Bound the
    micro-batches at the source (``max_files``, ``per_trigger``): a run takes all that
    has arrived, in as many of them as needed.
    """

    def handle(batch: DataFrame, number: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        if query is None:
            raise RuntimeError("the micro-batch does not tell its query's id")
        label = f"{name}-{query}-{number:012d}"
        if land_only:
            land_messages(store, batch, label)
        else:
            run_increment(store, batch, label)
        if after is not None:
            after(label)

    writer = messages.writeStream.queryName(name).foreachBatch(handle)
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()
