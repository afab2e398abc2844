"""Near-duplicates by circulant MinHash, banding and exact verification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensormart.llm.common import SHINGLE_WORDS, SIMILAR, WORD, slices, text_or_empty
from sensormart.llm.components import connected_components
from sensormart.session import materialise

#: A pair at similarity 0.75 shares fewer than two bands in 5 of a million cases; two bands are what
#: compares pairs that are not joined by a first holder or a pivot.
BANDS, ROWS = 40, 4
#: Families with more open members are compared by their core, which about so many members define.
SMALL_FAMILY, CORE_SAMPLE = 64, 48
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_CHUNK = 2048
_RANDOM = np.random.default_rng(20240229)
_BYTE = _RANDOM.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEPS = _RANDOM.integers(0, 1 << 63, SHINGLE_WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = np.arange(BANDS * ROWS, dtype=np.uint32)[:, None]


# -- shingles and signatures -------------------------------------------------
def words_of(text: str) -> list[bytes]:
    """Lower-cased words; bytes split at space, tab, LF, VT, FF and CR only."""
    return text.encode("utf-8", "surrogatepass").translate(_LOWER).split()


def shingle_set(words: list[bytes]) -> set:
    """Distinct runs of five words; fewer words are one run."""
    if len(words) < SHINGLE_WORDS:
        return {tuple(words)} if words else set()
    return set(zip(*(words[i:] for i in range(SHINGLE_WORDS)), strict=False))


def mix(x: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(words: list[bytes]) -> np.ndarray:
    """Distinct 64-bit hashes of a text's shingles, in order."""
    if not words:
        return np.zeros(0, np.uint64)
    data = np.frombuffer(b"".join(words), np.uint8)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(lengths) - lengths
    within = np.arange(len(data)) - np.repeat(starts, lengths)
    powers = np.multiply.accumulate(np.full(int(lengths.max()), _BASE))
    hashes = mix(np.add.reduceat(_BYTE[data] * powers[within], starts) + lengths.astype(np.uint64))
    if len(words) < SHINGLE_WORDS:
        hashes = np.concatenate([hashes, np.zeros(SHINGLE_WORDS - len(words), np.uint64)])
    n = len(hashes) - SHINGLE_WORDS + 1
    runs = sum(hashes[i : i + n] * _STEPS[i] for i in range(SHINGLE_WORDS))
    return np.unique(mix(runs))


def signature(hashes: np.ndarray) -> np.ndarray:
    """The smallest place of the shingles under each shift of one permutation.

    The first permutation places shingles on a circle of 2 ** 32 points. The
    second is applied after turning the circle by k points, for the k-th number.
    """
    places = (mix(hashes) >> np.uint64(32)).astype(np.uint32)
    least = np.full(BANDS * ROWS, 0xFFFFFFFF, np.uint32)
    for start in range(0, len(places), _CHUNK):
        x = places[start : start + _CHUNK] + _SHIFTS
        x ^= x >> np.uint32(16)
        x *= np.uint32(0x85EBCA6B)
        x ^= x >> np.uint32(13)
        x *= np.uint32(0xC2B2AE35)
        x ^= x >> np.uint32(16)
        np.minimum(least, x.min(axis=1), out=least)
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    rows = least.reshape(BANDS, ROWS).astype(np.uint64)
    key = np.arange(BANDS, dtype=np.uint64)
    for k in range(ROWS):
        key = mix(key * _BASE + rows[:, k])
    return key.view(np.int64)


def sign_documents(docs: DataFrame) -> DataFrame:
    """doc_id, text_key (a digest of the text), n_shingles and band keys of every document."""
    narrow = docs.select("doc_id", text_or_empty().alias("text")).withColumn("text_key", F.md5("text"))
    doc_id = narrow.schema["doc_id"].dataType.simpleString()

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sizes, keys = [], []
                for text in part.column("text").to_pylist():
                    hashes = shingle_hashes(words_of(text))
                    sizes.append(len(hashes))
                    keys.append(band_keys(signature(hashes)) if len(hashes) else [])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("text_key"), pa.array(sizes, pa.int64()), pa.array(keys, pa.list_(pa.int64()))],
                    ["doc_id", "text_key", "n_shingles", "bands"],
                )

    return narrow.mapInArrow(sign, f"doc_id {doc_id}, text_key string, n_shingles long, bands array<long>")


# -- candidates --------------------------------------------------------------
def _similar_size(a: str, b: str):
    """Sets whose sizes differ too much cannot be similar enough."""
    smaller, larger = F.least(F.col(a), F.col(b)), F.greatest(F.col(a), F.col(b))
    return 100 * smaller >= round(100 * SIMILAR) * larger


def verify(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes whose full shingle sets are similar enough."""
    left, right = (texts.select(F.col("node").alias(n), F.col("text").alias(f"text_{n}")) for n in "ab")
    both = pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, first = None, set()
        for batch in batches:
            kept = []
            for i, (a, x, y) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("a", "text_a", "text_b")), strict=True)):
                if a != node:
                    node, first = a, shingle_set(words_of(x))
                second = shingle_set(words_of(y))
                common = len(first & second)
                if 100 * common >= round(100 * SIMILAR) * (len(first) + len(second) - common):
                    kept.append(i)
            yield batch.select(["a", "b"]).take(pa.array(kept, pa.int64()))

    return both.mapInArrow(check, "a long, b long").distinct()


def find_links(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """(node, component) of the text classes that have a link.

    Candidates share a band. Instead of all pairs of a band's holders:

    1. Each class is compared with the first holder of its bands, then with a pivot:
       the class that meets most others in the bands where components still meet.
       A text with many edited copies becomes their pivot and joins most of them.
    2. Classes around one pivot are a family. Where components of a small family,
       or of different families, still meet in two bands, the pairs are compared.
    3. In a large family each class is compared with the family's core, the
       shingles that a quarter of a few members have. Two sets that share c
       shingles outside the core share at most c more than the smaller of their
       parts inside it. So pairs without a common shingle outside are compared
       only if those parts are large enough, the others only if with c they are.
       Nothing that could be a link is left out by this bound.

    Pairs inside a component need no comparison: they cannot change it.
    """
    held = classes.select("node", "n_shingles", F.explode("bands").alias("key"))
    shared = held.groupBy("key").agg(F.min("node").alias("first"), F.count(F.lit(1)).alias("holders")).filter("holders > 1")
    shared = materialise(shared, "shared-bands")
    if shared.isEmpty():
        return shared.select(F.col("first").alias("node"), F.col("first").alias("component"))
    members = materialise(held.join(shared, "key"), "band-members")
    wanted = materialise(members.select("node").distinct(), "candidates")
    texts = _texts(docs, classes.join(wanted, "node"))
    sizes = classes.select(F.col("node").alias("other"), F.col("n_shingles").alias("other_size"))

    nearest = members.filter("first <> node").groupBy("node", "n_shingles").agg(F.min("first").alias("other"))
    tried = materialise(_sized(nearest, sizes), "tried")
    links = materialise(verify(tried, texts), "links")
    open_members = _unsettled(members, links)
    if open_members.isEmpty():
        return connected_components(links)

    families = _families(open_members)
    for other in ("pivot", "family"):
        star = families.filter(F.col("node") != F.col(other)).select("node", "n_shingles", F.col(other).alias("other"))
        pairs = materialise(_sized(star, sizes).join(tried, ["a", "b"], "left_anti"), "pairs")
        tried = materialise(tried.unionByName(pairs), "tried")
        links = materialise(links.unionByName(verify(pairs, texts)), "links")
    placed = families.select("node", "family")
    open_members = materialise(_unsettled(members, links).join(placed, "node", "left"), "open-members")
    open_members = open_members.withColumn("family", F.coalesce("family", "node"))
    nodes = open_members.select("node", "n_shingles", "component", "family").distinct()
    grown = nodes.groupBy("family").agg(F.count(F.lit(1)).alias("members"))
    grown = materialise(grown.withColumn("large", F.col("members") > SMALL_FAMILY), "family-sizes")
    nodes = materialise(nodes.join(grown, "family"), "family-nodes")

    pairs = _second_band(open_members.join(grown.select("family", "large"), "family"))
    large = nodes.filter("large")
    if not large.isEmpty():
        pairs = pairs.unionByName(_bounded_pairs(large, texts))
    pairs = materialise(pairs.distinct().join(tried, ["a", "b"], "left_anti"), "pairs")
    return connected_components(materialise(links.unionByName(verify(pairs, texts)), "links"))


def _sized(stars: DataFrame, sizes: DataFrame) -> DataFrame:
    near = stars.join(sizes, "other").filter(_similar_size("n_shingles", "other_size"))
    return near.select(F.least("other", "node").alias("a"), F.greatest("other", "node").alias("b")).distinct()


def _unsettled(members: DataFrame, links: DataFrame) -> DataFrame:
    """The members of bands whose holders lie in several components."""
    components = connected_components(links)
    labelled = members.join(components, "node", "left").withColumn("component", F.coalesce("component", "node"))
    labelled = materialise(labelled, "labelled")
    mixed = labelled.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    mixed = materialise(mixed.filter("low < high").select("key"), "mixed-bands")
    return materialise(labelled.join(mixed, "key"), "unsettled")


def _families(unsettled: DataFrame) -> DataFrame:
    """(node, n_shingles, pivot, family): the most met holder of a node's bands, and where such steps lead."""
    met = unsettled.groupBy("node", "n_shingles").agg(F.sum("holders").alias("met"))
    met = materialise(met, "met")
    rank = F.struct("met", (-F.col("node")).alias("last"))
    best = unsettled.select("node", "key").join(met, "node").groupBy("key").agg(F.max(rank).alias("best"))
    best = materialise(best, "band-pivots")
    steps = unsettled.select("node", "n_shingles", "key").join(best, "key").groupBy("node", "n_shingles").agg(F.max("best").alias("best"))
    steps = materialise(steps.select("node", "n_shingles", (-F.col("best.last")).alias("pivot")), "pivots")
    onward = steps.select(F.col("node").alias("family"), F.col("pivot").alias("next"))
    families = steps.withColumn("family", F.col("pivot"))
    for _ in range(3):
        families = families.join(onward, "family", "left").withColumn("family", F.coalesce("next", "family")).drop("next")
    return materialise(families, "families")


def _second_band(unsettled: DataFrame) -> DataFrame:
    """Pairs of different components that share two bands, but for those inside a large family."""
    own = ["node", "n_shingles", "component", "family", "large"]
    useful = materialise(_useful_keys(unsettled), "useful-bands")
    keys = unsettled.join(useful, "key").groupBy(*own).agg(F.sort_array(F.collect_set("key")).alias("keys"))
    ordered = F.flatten(
        F.transform("keys", lambda x: F.transform(F.filter("keys", lambda y: y > x), lambda y: F.xxhash64(x, y)))
    )
    double = materialise(keys.select(*own, F.explode(ordered).alias("key")), "double-bands")
    double = double.join(materialise(_useful_keys(double), "double-keys"), "key")
    a, b = (double.select("key", *[F.col(c).alias(f"{c}_{n}") for c in own]) for n in "ab")
    apart = ~F.col("large_a") | (F.col("family_a") != F.col("family_b"))
    found = a.join(b, "key").filter("node_a < node_b and component_a <> component_b").filter(apart)
    found = found.filter(_similar_size("n_shingles_a", "n_shingles_b"))
    return found.select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct()


def _useful_keys(rows: DataFrame) -> DataFrame:
    """The keys in which components meet, and not only inside one large family."""
    seen = rows.groupBy("key").agg(
        *[f(c).alias(f"{n}_{c}") for n, f in (("low", F.min), ("high", F.max)) for c in ("component", "family")],
        F.bool_and("large").alias("all_large"),
    )
    return seen.filter("low_component < high_component and (low_family < high_family or not all_large)").select("key")


def _bounded_pairs(nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs of different components of a large family that the bound does not exclude."""
    # A few members of each family, by their hashes: about CORE_SAMPLE.
    share = F.lit(1 << 20) * CORE_SAMPLE / F.col("members")
    few = nodes.filter(F.pmod(F.xxhash64("node"), F.lit(1 << 20)) < share).select("family", "node").join(texts, "node")

    def core(group: pa.Table) -> pa.Table:
        hashes = [shingle_hashes(words_of(t)) for t in group.column("text").to_pylist()]
        values, counts = np.unique(np.concatenate(hashes), return_counts=True)
        kept = values[counts >= max(2, -(-len(hashes) // 4))].view(np.int64)
        return pa.table({"family": group.column("family").slice(0, 1), "core": pa.array([kept], pa.list_(pa.int64()))})

    cores = few.groupBy("family").applyInArrow(core, "family long, core array<long>")
    cores = materialise(cores, "family-cores")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            inside, outside = [], []
            for text, known in zip(batch.column("text").to_pylist(), batch.column("core"), strict=True):
                hashes = shingle_hashes(words_of(text)).view(np.int64)
                own = np.isin(hashes, known.values.to_numpy() if known.is_valid else [], assume_unique=True)
                inside.append(int(own.sum()))
                outside.append(hashes[~own])
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in ("family", "node", "component", "n_shingles")],
                    pa.array(inside, pa.int64()),
                    pa.array(outside, pa.list_(pa.int64())),
                ],
                ["family", "node", "component", "n", "inside", "outside"],
            )

    placed = nodes.select("family", "node", "component", "n_shingles").join(texts, "node").join(cores, "family", "left")
    profiles = placed.mapInArrow(
        compare, "family long, node long, component long, n long, inside long, outside array<long>"
    )
    profiles = materialise(profiles.dropDuplicates(["node"]), "profiles")
    counted = profiles.groupBy("family", "component").agg(F.count(F.lit(1)).alias("size"), F.min("n").alias("least"))
    largest = counted.groupBy("family").agg(F.max_by("component", "size").alias("main"), F.min("least").alias("least"))
    profiles = profiles.join(materialise(largest, "main-components"), "family")

    def enough(common, a: str, b: str):
        return 100 * common >= round(100 * SIMILAR) * (F.col(a) + F.col(b) - common)

    own = ["node", "component", "n", "inside"]
    live = profiles.filter(enough(F.col("inside"), "n", "least"))
    near = _both(live.filter("component <> main"), live, own, ["family"])
    inner = F.least("inside_a", "inside_b")
    quiet = near.filter(enough(inner, "n_a", "n_b")).select("node_a", "node_b")

    # Shingles outside the core that others have too, the rarest first. A pair that
    # needs some of them in common has one among the first of both, leaving out as
    # many as it needs, less one; and it needs no fewer than either side does.
    marks = profiles.select("family", *own, "main", "least", F.explode("outside").alias("mark"))
    spread = marks.groupBy("family", "mark").agg(F.count(F.lit(1)).alias("spread")).filter("spread > 1")
    spread = materialise(spread, "mark-spreads")
    ranked = marks.join(spread, ["family", "mark"]).groupBy("family", *own, "main", "least")
    ranked = ranked.agg(F.sort_array(F.collect_list(F.struct("spread", "mark")))["mark"].alias("outside"))
    ranked = materialise(ranked, "ranked-marks")
    percent = round(100 * SIMILAR)
    smallest = F.greatest(F.col("least"), F.ceil(F.col("n") * SIMILAR))
    needed = F.greatest(F.lit(1), F.ceil(percent * (F.col("n") + smallest) / (100 + percent) - 1e-9) - F.col("inside"))
    first = F.slice("outside", 1, F.greatest(F.size("outside") - needed + 1, F.lit(0)).cast("int"))
    heads = ranked.select("family", *own, "main", F.explode(first).alias("mark"))
    met = _both(heads.filter("component <> main"), heads, own, ["family", "mark"]).select("node_a", "node_b").distinct()
    met = materialise(met, "met-marks")
    for side in "ab":
        met = met.join(ranked.select(*[F.col(c).alias(f"{c}_{side}") for c in ("node", "n", "inside", "outside")]), f"node_{side}")
    common = inner + F.size(F.array_intersect("outside_a", "outside_b"))
    loud = met.filter(enough(common, "n_a", "n_b")).select("node_a", "node_b")
    found = quiet.unionByName(loud)
    return found.select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")).distinct()


def _both(left: DataFrame, right: DataFrame, columns: list[str], key: list[str]) -> DataFrame:
    """Pairs of rows with equal keys and different components."""
    a, b = (x.select(*key, *[F.col(c).alias(f"{c}_{n}") for c in columns]) for x, n in ((left, "a"), (right, "b")))
    return a.join(b, key).filter("component_a <> component_b").filter(_similar_size("n_a", "n_b"))


def _texts(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """(node, text) of the given classes, from one document of each."""
    known = docs.select("doc_id", text_or_empty().alias("text")).withColumn("text_key", F.md5("text"))
    asked = classes.select("node", F.col("text_key").alias("key"), F.col("least_id"))
    same = (F.col("text_key") == F.col("key")) & F.col("doc_id").eqNullSafe(F.col("least_id"))
    return materialise(known.join(asked, same).select("node", "text"), "candidate-texts")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Group documents by links of Jaccard similarity of at least 0.75 on five-word shingles.

    Equal texts are one class from the start. Returns one row per document:
    doc_id, n_shingles, component_id (the smallest doc_id reachable by links),
    kept (doc_id = component_id), text_key, component (a number of the group, null
    without words). Words are lower-cased A-Z; a text of
    fewer than five words is one shingle. Null texts and texts without words have
    no shingles, are linked with nothing, and are kept. Null ids are never the
    smallest; a component that has none gives null, and such rows are kept.
    Repeated doc_ids keep a row each. An empty table gives no rows.
    """
    signed = materialise(sign_documents(docs), "signed")
    classes = (
        signed.filter("n_shingles > 0")
        .groupBy("text_key")
        .agg(F.min("doc_id").alias("least_id"), F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"))
    )
    classes = materialise(classes.withColumn("node", F.monotonically_increasing_id()), "text-classes")
    found = materialise(find_links(docs, classes), "components")
    grouped = classes.select("text_key", "least_id", "node").join(found, "node", "left")
    grouped = grouped.withColumn("component", F.coalesce("component", "node"))
    smallest = grouped.groupBy("component").agg(F.min("least_id").alias("component_id"))
    smallest = materialise(smallest, "component-ids")
    by_text = grouped.join(smallest, "component").select("text_key", F.col("component_id").alias("_component"), "component")
    by_text = materialise(by_text, "text-components")
    empty = F.col("n_shingles") == 0
    component_id = F.when(empty, F.col("doc_id")).otherwise(F.col("_component"))
    result = signed.drop("bands").join(by_text, "text_key", "left").withColumn("component_id", component_id)
    return result.select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "text_key", "component"
    )


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates: that of the smallest doc_id.

    Of repeated rows one stays, of several texts under that doc_id the one whose
    digest is smallest. Rows without words stay as they are.
    """
    groups = near_duplicates(docs).filter("kept and n_shingles > 0")
    chosen = groups.groupBy("component").agg(F.min(F.struct("doc_id", "text_key")).alias("pick"))
    chosen = materialise(
        chosen.select(F.col("pick.doc_id").alias("_id"), F.col("pick.text_key").alias("_key")), "chosen-documents"
    )
    text = text_or_empty()
    rows = docs.select(F.struct("*").alias("row"), "doc_id", F.md5(text).alias("text_key"), text.rlike(WORD).alias("worded"))
    same = (F.col("text_key") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("worded")
    copy = F.row_number().over(Window.partitionBy("text_key", "doc_id").orderBy("worded"))
    joined = rows.join(chosen, same, "left").withColumn("copy", copy)
    return joined.filter(~F.col("worded") | (F.col("_key").isNotNull() & (F.col("copy") == 1))).select("row.*")
