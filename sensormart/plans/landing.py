"""Landing: new messages -> raw history, rejects aside."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from sensormart.operators import contained_contents, content_columns
from sensormart.session import materialise, scratch
from sensormart.sources.messages import parse_messages, rejects_of
from sensormart.sources.store import RAW_TABLE, REJECT_TABLE, StarStore


def land_messages(store: StarStore, messages: DataFrame, batch: str) -> dict[str, int]:
    """Decode a batch of messages, keep the new documents, put bad records aside.

    The decoded batch is written once, with what containment needs: it is used
    several times, and its file size tells Spark which joins to broadcast. It is
    read back in the store's session, because the session of a streaming batch
    runs without adaptive execution. Returns what was counted: ``messages``,
    ``rejects`` and ``new`` documents; empty if the batch has landed before.
    """
    return _land(store, parse_messages(messages), batch)


def land_documents(store: StarStore, documents: DataFrame, batch: str) -> dict[str, int]:
    """Land decoded documents (MESSAGE columns)."""
    none = {"reject_reason": "string", "raw": "string", "bad_readings": "array<string>"}
    return _land(store, documents.withColumns({c: F.lit(None).cast(t) for c, t in none.items()}), batch)


def _land(store: StarStore, parsed: DataFrame, batch: str) -> dict[str, int]:
    step = f"land-{batch}"
    if store.committed(step):
        return {}
    store.begin(step)
    with scratch():
        seen, kept = Observation(), Observation()
        described = content_columns(parsed).withColumn("place", F.monotonically_increasing_id())
        rejects = (F.count("reject_reason") + F.count("bad_readings")).alias("rejects")
        watched = described.observe(seen, F.count(F.lit(1)).alias("messages"), rejects)
        arrived = materialise(watched, "arrived", store.spark)
        documents = arrived.filter("reject_reason IS NULL")
        # Equal documents are one, the first; documents without readings stay apart. Only
        # addresses and places are shuffled, and copies are combined before that.
        apart = F.when(F.col("content_size") == 0, F.col("place"))
        first = documents.groupBy("content", apart.alias("_apart")).agg(F.min("place").alias("place"))
        if store.has_landed():
            first = first.join(contained_contents(documents, store.visible(RAW_TABLE)), "content", "left_anti")
        # What is new is settled by addresses and places, so documents move once to meet it.
        new = documents.join(materialise(first.select("place"), "new-places"), "place", "left_semi")
        # The id follows from batch and content: a repeated batch gets the same ids. The batch
        # comes first, so the keys of a batch lie together.
        tail = F.when(F.col("content_size") == 0, F.concat(F.lit("-"), F.col("place")))
        oid = F.concat(F.lit(f"{batch}-"), F.col("content"), F.coalesce(tail, F.lit("")))
        new = new.withColumns({"_id": F.struct(oid.alias("oid")), "processed": F.lit(False)})
        # Rebalancing keeps a bucket's rows together and splits a bucket that is too large.
        # It is counted after that: adaptive execution drops what lies below an empty shuffle.
        store.write(RAW_TABLE, step, new.hint("rebalance", "bucket").observe(kept, F.count(F.lit(1)).alias("new")))
        if seen.get["rejects"]:
            store.write(REJECT_TABLE, step, rejects_of(arrived))
        # Without a new document there is nothing to load: the step is only noted.
        counts = {**seen.get, **kept.get}
        store.publish(step, counts, lands=counts["new"] > 0)
        return counts
