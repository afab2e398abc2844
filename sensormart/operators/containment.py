"""Which documents are new? Set containment against the whole history."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensormart.operators.dimensions import number_rows
from sensormart.operators.membership import possible
from sensormart.session import materialise


def normalise_measurements(docs: DataFrame) -> DataFrame:
    """Sort the readings inside each document, by parameter first."""
    return docs.withColumn("measurements", F.array_sort("measurements"))


#: Folders that a stored history is dealt into by station.
BUCKETS = 64
#: A set with so many candidates left is compared with each of them.
DIRECT = 64
#: From this depth on, the depth doubles.
SINGLE_STEPS = 8


#: What tells a reading of a station, see ``_keyed_elements``.
KEY = ["key", "check"]


def _elements(sort: bool = True):
    distinct = F.array_distinct("measurements")
    # One reading is in order as it is.
    return F.when(F.size("measurements") <= 1, F.col("measurements")).otherwise(F.array_sort(distinct) if sort else distinct)


def content_columns(docs: DataFrame) -> DataFrame:
    """Add what containment needs, so that the history can store it once.

    ``content``: address (SHA-256) of station and set of readings; equal
    documents have equal addresses. ``content_size``: distinct readings.
    ``first_updated``/``last_updated``: least and greatest ``lastUpdated`` text,
    which a scan of the history can be pruned by.
    """
    if "content" in docs.columns:
        return docs
    described = F.struct("location", "city", "country", "coordinates", _elements().alias("m"))
    times = F.transform("measurements", lambda m: F.coalesce(m["lastUpdated"], F.lit("")))
    # Adding zero makes one number of -0.0 and 0.0, which are equal.
    place = [F.col(f"coordinates.{c}") + F.lit(0.0) for c in ("latitude", "longitude")]
    station = F.xxhash64("location", "city", "country", *place)
    return docs.withColumns(
        {
            "content": F.sha2(F.to_json(described), 256),
            "content_size": F.coalesce(F.size(_elements(sort=False)), F.lit(0)),
            "first_updated": F.array_min(times),
            "last_updated": F.array_max(times),
            "station": station,
            "bucket": F.pmod(station, F.lit(BUCKETS)).cast("int"),
        }
    )


def drop_repeats(docs: DataFrame) -> DataFrame:
    """Keep one of several equal documents in a batch: the one with the least id.

    Documents without readings are always new, so only those with one id are one.
    Copies are combined in the map tasks, so a document that makes up a third of
    the batch moves once per task.
    """
    described = content_columns(docs)
    others = [c for c in described.columns if c != "content"]
    kept = F.min_by(F.struct(*others), F.col("_id.oid")).alias("_kept")
    apart = F.when(F.col("content_size") == 0, F.col("_id.oid")).alias("_apart")
    return described.groupBy("content", apart).agg(kept).select("_kept.*", "content").select(*docs.columns)


def _hashes(fields: list, seeds: list) -> list:
    """For each seed, a hash of the fields. A null is told from a field left out; -0.0 equals 0.0."""
    missing = reduce(lambda a, b: a + b, [F.when(f.isNull(), 1 << i).otherwise(0) for i, f in enumerate(fields)])
    return [F.xxhash64(seed, missing, *fields) for seed in seeds]


def _keyed_elements(docs: DataFrame, *columns) -> DataFrame:
    """One row per distinct reading; ``key`` and ``check`` stand for the station and the reading.

    They are two hashes with seeds of their own, 128 bits, which move and compare in a
    fraction of the nine fields' cost. NULL fields are equal: a missing city matches a
    missing city.
    """
    station = [F.col(c) for c in ("location", "city", "country")]
    station += [F.col(f"coordinates.{c}") + F.lit(0.0) for c in ("latitude", "longitude")]
    of_station = [h.alias(f"_{name}") for name, h in zip(KEY, _hashes(station, [F.lit(1), F.lit(2)]), strict=True)]
    exploded = docs.select(*columns, *of_station, F.explode(_elements(sort=False)).alias("m"))
    fields = [F.col("m.parameter"), F.col("m.value") + F.lit(0.0), F.col("m.unit"), F.col("m.lastUpdated")]
    hashes = _hashes(fields, [F.col(f"_{name}") for name in KEY])
    names = [c for c in exploded.columns if c not in ("m", "_key", "_check")]
    return exploded.select(*names, *[h.alias(name) for name, h in zip(KEY, hashes, strict=True)])


def nearby_history(stored: DataFrame, sets: DataFrame) -> DataFrame:
    """The stored documents that could contain one of ``sets``: by station and time.

    The batch's buckets, at most ``BUCKETS`` numbers, become a filter, which a
    history stored by bucket answers by not listing other folders; row groups are
    passed over by their range of times. Of other stations few documents pass a
    small filter (``possible``), and nothing is shuffled.
    """
    bounds = sets.agg(
        F.collect_set("bucket").alias("buckets"),
        F.min("last_updated").alias("lo"),
        F.max("first_updated").alias("hi"),
        F.approx_count_distinct("station").alias("stations"),
    ).first()
    near = content_columns(stored).filter(
        F.col("bucket").isin(sorted(bounds.buckets))
        & (F.col("content_size") > 0)
        & (F.col("last_updated") >= F.lit(bounds.lo))
        & (F.col("first_updated") <= F.lit(bounds.hi))
    )
    return possible(near, "station", sets.select("station"), bounds.stations)


def drop_contained(incoming: DataFrame, stored: DataFrame) -> DataFrame:
    """Incoming documents that no stored document of the same station contains.

    A stored document contains a new one when it has every reading of it, all
    four fields equal; a stored superset suppresses too. A document without
    readings is always new. Only the store is looked at, not the batch itself.
    Documents that carry their ``content_columns`` are not described again.
    """
    described = "content" in incoming.columns
    new = incoming if described else materialise(content_columns(incoming), "described")
    return new.join(contained_contents(new, stored), "content", "left_anti").select(*incoming.columns)


def contained_contents(new: DataFrame, stored: DataFrame) -> DataFrame:
    """Addresses (``content``) of the documents in ``new`` that a stored one contains.

    1. Of the history's readings, those that may be in the batch are looked up by a
       small filter, where they lie; only these are shuffled.
    2. Equal documents meet on their content address, among the documents found.
    3. Each reading is counted in the store; a document with a reading never stored
       is new, a single stored reading decides alone.
    4. What remains is looked up rarest reading first, see ``_rarest_first``.

    Copies are combined before they move. Where one reading may be in very many
    documents, the other side of its join is written first: adaptive execution
    splits a hot partition only if both sides come straight from a shuffle.
    """
    columns = ["content", "content_size", "station", "bucket", "first_updated", "last_updated"]
    station = ["location", "city", "country", "coordinates"]
    sets = new.filter("content_size > 0").select(*columns, *station, "measurements")

    # 1. readings that both have
    wanted = materialise(_keyed_elements(sets, "content", "content_size").distinct(), "wanted")
    history = nearby_history(stored, sets)
    kept = possible(_keyed_elements(history, F.col("content").alias("holder")), "key", wanted.select("key"), wanted.count())
    held = materialise(kept.distinct(), "held")

    # 2. equal documents
    holding = held.select(F.col("holder").alias("content")).distinct()
    equal = materialise(holding.join(sets.select("content"), "content", "left_semi"), "equal")

    # 3. readings that were never stored, single readings
    holders = materialise(held.groupBy(*KEY).agg(F.count(F.lit(1)).alias("holders")), "holders")
    known = wanted.join(holders, KEY).groupBy("content", "content_size").agg(F.count(F.lit(1)).alias("found"))
    known = known.filter("found = content_size").select("content", "content_size")
    known = materialise(known.join(equal, "content", "left_anti"), "known")
    contained = equal.unionByName(known.filter("content_size = 1").select("content"))
    several = known.filter("content_size > 1")
    if not several.isEmpty():
        contained = contained.unionByName(_rarest_first(several, wanted, held, holders))
    return contained


def _rarest_first(several: DataFrame, wanted: DataFrame, held: DataFrame, holders: DataFrame) -> DataFrame:
    """Addresses of the sets in ``several`` of which one holder has all readings (step 4).

    Readings are numbered from the rarest. Sets that begin with the same readings
    share a node, and a node's candidates, the holders of all those readings, are
    found once, out of the candidates of the node before it. A set leaves as soon
    as it is settled: no candidate is left; all its readings are matched; few
    candidates are left, which are compared one by one; or one of two candidates of
    a large node holds it. So a reading that a station repeats in all documents is
    looked at last, and mostly never. After ``SINGLE_STEPS`` readings the depth
    doubles, which bounds the number of rounds by the logarithm of the set size.

    Exact set containment has no known way that is always far below the number of
    pairs. Here the rows of a round are nodes times candidates; both shrink with
    every reading that is not in all sets.
    """
    chosen = materialise(wanted.join(several.select("content"), "content", "left_semi"), "chosen")
    used = holders.join(chosen.select(*KEY), KEY, "left_semi")
    ranks = materialise(number_rows(used, ["holders", *KEY], "rank").select(*KEY, "rank"), "ranks")
    sets = chosen.join(ranks, KEY).groupBy("content").agg(F.sort_array(F.collect_list("rank")).alias("ranks"))
    sets = materialise(sets.withColumn("node", F.col("ranks")[0].cast("string")), "rank-sets")
    rows = held.join(ranks, KEY).select("holder", "rank")
    stored = materialise(rows.groupBy("holder").agg(F.collect_list("rank").alias("stored")), "holder-sets")
    rows = stored.select("holder", F.size("stored").alias("width"), F.explode("stored").alias("rank"))
    rows = materialise(rows, "holder-ranks")
    # A holder with fewer readings than the least of a node's sets can hold none of them.
    least = F.min(F.size("ranks")).alias("least")
    nodes = materialise(sets.groupBy("node", F.col("ranks")[0].alias("rank")).agg(least), "nodes")
    candidates = rows.join(nodes, "rank").filter("width >= least").select("node", "holder")
    candidates = materialise(candidates, "candidates")
    depth, results = 1, []
    while True:
        seen = candidates.groupBy("node").agg(
            F.count(F.lit(1)).alias("n"), F.min("holder").alias("low"), F.max("holder").alias("high")
        )
        # A set whose node has no candidate is new.
        live = sets.join(materialise(seen, "node-sizes"), "node")
        rest = live.filter(F.size("ranks") > depth)
        compared = rest.filter(F.col("n") <= DIRECT).join(candidates, "node").select("content", "ranks", "holder")
        probed = rest.filter(F.col("n") > DIRECT)
        probes = probed.select("content", "ranks", F.explode(F.array("low", "high")).alias("holder"))
        inside = (
            compared.unionByName(probes)
            .join(stored, "holder")
            .filter(F.size(F.array_except("ranks", "stored")) == 0)
            .select("content")
        )
        matched = live.filter(F.size("ranks") <= depth).select("content")
        results.append(materialise(inside.unionByName(matched).distinct(), "contained"))
        sets = probed.select("content", "ranks", "node").join(results[-1], "content", "left_anti")
        step = 1 if depth < SINGLE_STEPS else depth
        following = F.slice("ranks", depth + 1, step)
        child = F.md5(F.concat_ws(",", "node", following.cast("array<string>")))
        sets = materialise(sets.withColumns({"following": following, "child": child}), "open-sets")
        if sets.isEmpty():
            return reduce(DataFrame.unionByName, results)
        children = materialise(sets.groupBy("node", "child", "following").agg(least), "children")
        many = F.size("following").alias("many")
        wanted_ranks = children.select("node", "child", "least", many, F.explode("following").alias("rank"))
        found = candidates.join(wanted_ranks, "node").join(rows, ["holder", "rank"]).filter("width >= least")
        if step > 1:
            found = found.groupBy("child", "holder", "many").agg(F.count(F.lit(1)).alias("found")).filter("found = many")
        candidates = materialise(found.select(F.col("child").alias("node"), "holder"), "candidates")
        sets = sets.select("content", "ranks", F.col("child").alias("node"))
        depth += step
