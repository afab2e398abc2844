"""Mixing sources to target weights by weighted fair queueing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensormart.llm.common import WORD, text_or_empty
from sensormart.operators import number_rows
from sensormart.session import materialise

WEIGHTS = (5, 2, 1)
#: A source, and a document, is repeated so often at most.
MOST = 3
#: Documents in one bucket of a queue, about.
BUCKET_ROWS = 4_000
#: Slots that a range of finish times is cut into, and the copies that are put in order.
SLOTS, SLOT_ROWS = 256, 2_000
_BITS = 60


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def shuffle_place(doc_id: Column, text: Column, seed: str) -> Column:
    """A place in [0, 2 ** 60) that depends on doc_id, text and seed alone.

    The text keeps many documents under one id, or without one, from sharing a place.
    """
    digest = F.md5(F.concat_ws(":", F.lit(seed), doc_id.cast("string"), F.md5(text.cast("binary"))))
    return F.conv(F.substring(digest, 1, _BITS // 4), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """One row per source: its rank, weight, size, documents, and target.

    Sources rank by code point, null last, and take the weights in turn. Targets
    share the total size by weight; one above ``most`` times its source's size
    stops there, and the rest is shared again until none is above. Each round is
    one sum over the sources.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"))
    totals = materialise(totals, "source-sizes")
    named = number_rows(totals.filter("source is not null"), ["source"], "rank", first=0)
    count = totals.filter("source is not null").agg(F.count(F.lit(1)).alias("n")).scalar()
    ranked = named.unionByName(totals.filter("source is null").withColumn("rank", count))
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = materialise(
        ranked.withColumn("weight", turn).withColumn("cap", most * F.col("source_size")), "source-ranks"
    )
    capped, held, flowing = F.lit(False), 0, None
    while True:
        row = ranked.agg(
            F.sum("source_size").alias("total"),
            F.sum(F.when(capped, F.col("cap"))).alias("held"),
            F.sum(F.when(~capped, F.col("weight"))).alias("flowing"),
            F.count_if(capped).alias("n"),
        ).first()
        if flowing is not None and row.n == held:
            break
        total, at_cap, flowing, held = row.total or 0, row.held or 0, row.flowing or 0.0, row.n
        share = F.lit(float(total - at_cap)) * F.col("weight") / F.lit(flowing or 1.0)
        capped = share > F.col("cap")
    target = F.when(capped, F.col("cap").cast("double")).otherwise(share)
    return ranked.withColumn("target", target).withColumn(
        "level", F.lit(float(total - at_cap) / (flowing or 1.0))
    )


def queue_documents(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Add to (source, size, place, ...) the words of the source up to and with each document.

    A source is cut into buckets of places with about ``BUCKET_ROWS`` documents,
    so that no source is one task; what lies before a bucket is a sum of bucket
    totals.
    """
    known = sources.select(F.col("source").alias("_source"), "rank", "weight", "source_size", "docs", "target")
    placed = rows.join(known, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    parts = F.ceil(F.col("docs") / BUCKET_ROWS)
    placed = placed.withColumn("bucket", F.floor(F.col("place") / F.lit(float(1 << _BITS)) * parts))
    inside = Window.partitionBy("rank", "bucket").orderBy("place", "doc_id", "size")
    running = F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return placed.withColumn("within", running)


def _before(queued: DataFrame) -> DataFrame:
    totals = queued.groupBy("rank", "bucket").agg(F.sum("size").alias("total"))
    earlier = Window.partitionBy("rank").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("rank", "bucket", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("before"))


def finish_times(upto: Column, source_size: Column, weight: Column, most: int) -> Column:
    """For each time round the source, the virtual finish time of a document."""
    rounds = F.sequence(F.lit(0), F.lit(most - 1))
    return F.transform(
        rounds, lambda e: F.struct(((e * source_size + upto) / weight).alias("finish"), e.alias("round"))
    )


def mix_documents(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    most: int = MOST,
    seed: str = "mix",
    whole_rows: bool = False,
) -> DataFrame:
    """Choose how often each document is taken, so that sources meet their targets.

    Documents of a source queue in an order shuffled by a hash of doc_id, text and seed.
    A document finishes at the words of its source up to it, those of earlier
    rounds included, divided by the source's weight. All copies in the order of
    finish time (ties: source, round, place, doc_id) are taken while their words
    fit the total. A source that ends after ``most`` rounds leaves its share to
    the others, as in its target.

    Returns doc_id, source, size, source_size, target, copies, taken (size times
    copies), and with ``whole_rows`` the row of ``docs`` as a struct ``row``. A null
    text has size 0; a document without words is never taken. A null source is a
    source of its own, the last. Null and repeated doc_ids are documents like
    others, told apart by their texts; rows equal in both share a place, and on the
    bound are taken all or not at all. Reruns agree. An empty table gives no rows.
    A very long text is counted and hashed whole, in one pass of its row.
    """
    key = docs.select(
        F.struct("*").alias("row"),
        "doc_id",
        "source",
        word_count(text_or_empty()).alias("size"),
        shuffle_place(F.col("doc_id"), text_or_empty(), seed).alias("place"),
    )
    narrow = materialise(key.drop("row"), "sizes")
    sources = source_targets(narrow, weights, most)
    queued = materialise(queue_documents(narrow, sources), "queue")
    before = materialise(_before(queued), "queue-starts")
    upto = F.col("before") + F.col("within")
    finishes = finish_times(upto, F.col("source_size"), F.col("weight"), most)
    placed = queued.join(before, ["rank", "bucket"])
    bound = _bound(placed, finishes, sources)
    if whole_rows:
        placed = queue_documents(key, sources).join(before, ["rank", "bucket"])
    if bound is None:
        copies = F.lit(0)
    else:
        order = lambda f: F.struct(
            f["finish"].alias("finish"), "rank", f["round"].alias("round"), "place", "doc_id", "size"
        )
        copies = F.size(F.filter(finishes, lambda f: order(f) <= bound))
    result = placed.withColumn("copies", F.when(F.col("size") > 0, copies).otherwise(F.lit(0)).cast("long"))
    return result.select(
        *(["row"] if whole_rows else []),
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        "copies",
        (F.col("size") * F.col("copies")).alias("taken"),
    )


def take_mix(docs: DataFrame) -> DataFrame:
    """``docs`` as the mix takes them: each row as often as it has copies.

    Documents without words are not taken; see ``mix_documents`` for the rest.
    """
    taken = mix_documents(docs, whole_rows=True).filter("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select("row.*")


def _bound(placed: DataFrame, finishes: Column, sources: DataFrame) -> Column | None:
    """The last copy that is taken, as a struct; None if nothing is.

    Copies are dealt into slots by finish time. Whole slots in front are taken by
    their totals, ``SLOTS`` numbers a round; only when the slot in which the budget
    ends holds at most ``SLOT_ROWS`` copies, or copies of one time, is it put in order.
    """
    total, level = sources.agg(F.sum("source_size").alias("total"), F.max("level").alias("level")).first()
    if not total:
        return None
    copies = placed.filter("size > 0").select("rank", "place", "doc_id", "size", F.explode(finishes).alias("f"))
    copies = copies.select("f.finish", "rank", "f.round", "place", "doc_id", "size")
    horizon = level * (1 + 1 / 16)
    while True:
        near = copies.filter(F.col("finish") <= horizon)
        reached, left = near.agg(F.sum("size")).first()[0] or 0, copies.filter(F.col("finish") > horizon)
        if reached >= total or left.isEmpty():
            break
        horizon *= 2
    # The range in which the budget ends is cut into slots, and the slot in which it
    # ends again, until what is left to put in order is small.
    names = ["finish", "rank", "round", "place", "doc_id", "size"]
    low, high, before = 0.0, horizon, 0
    while True:
        here = near.filter(F.col("finish").between(low, high))
        slot = F.least(F.floor((F.col("finish") - low) / F.lit((high - low) / SLOTS)), F.lit(SLOTS - 1))
        totals = here.groupBy(slot.alias("slot")).agg(
            F.sum("size").alias("total"), F.count(F.lit(1)).alias("n"), F.min("finish").alias("low"), F.max("finish").alias("high")
        )
        for crossing in sorted(totals.collect()):
            if before + crossing.total >= total:
                break
            before += crossing.total
        low, high = crossing.low, crossing.high
        if crossing.n <= SLOT_ROWS or low == high:
            break
    inside = near.filter(F.col("finish").between(low, high))
    inside = inside.withColumn("upto", F.sum("size").over(Window.orderBy(*names)))
    taken = inside.filter(F.col("upto") + before <= total).agg(F.max(F.struct(*names)).alias("last")).first().last
    if taken is None:
        earlier = near.filter(F.col("finish") < low).agg(F.max(F.struct(*names)).alias("last")).first().last
        if earlier is None:
            return None
        taken = earlier
    kinds = dict(copies.dtypes)
    return F.struct(*[F.lit(taken[n]).cast(kinds[n]).alias(n) for n in names])
