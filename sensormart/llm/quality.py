"""Quality rules: hashed n-gram likelihood ratio of trusted to raw text."""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensormart.llm.common import WORD, text_or_empty
from sensormart.operators.membership import flag_possible, possible
from sensormart.session import materialise

#: What parts words beside the space.
BLANKS = "\t\n\x0b\x0c\r"
SYMBOLS = r"[#*$%&|<>]"
#: Hash buckets of words and word pairs: a power of two that grows with the text, one for
#: about so many bytes, between a least number and what the plan can carry as one literal.
BUCKET_BYTES, BUCKETS, MOST_BUCKETS = 12_288, 8192, 1 << 18
#: Added to every bucket's counts.
SMOOTHING = 1.0
#: Scores are whole millionths, so that sums do not depend on rounding.
UNIT = 1_000_000
#: Bins of mean scores in which the threshold is sought, and their half range.
BIN, RANGE = UNIT // 200, 2 * UNIT
#: A trusted document lost weighs as much as so many poor ones kept.
LOSS = 10
SLACK = 0.02
MIN_WORDS, REPEATED_PERCENT, WINDOW = 50, 50, 3
#: Windows of a text are looked up among so many repeated ones; beyond, all are sorted with their places.
FEW = 64


def split_words(text: Column) -> Column:
    """The words of a text; runs of white space give no empty ones."""
    # To split at a single character needs no regular expression.
    for blank in BLANKS:
        text = F.replace(text, F.lit(blank), F.lit(" "))
    return F.array_remove(F.split(text, " "), "")


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once.

    A column named inside a lambda may be replaced by its expression, which is then
    computed for every element; a lambda's own argument is not.
    """
    return F.get(F.transform(F.array(value), body), 0)


def word_hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def bucket_count(docs: DataFrame) -> int:
    """How many buckets a corpus gets: more text has more words and pairs to tell apart."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    wanted = max(BUCKETS, -(-size // BUCKET_BYTES))
    return min(MOST_BUCKETS, 1 << (wanted - 1).bit_length())


def bucket(hash_: Column, many: int) -> Column:
    """The bucket of a word or pair; ``many`` is a power of two."""
    return hash_.bitwiseAND(F.lit(many - 1).cast("long")).cast("int")


def neighbours(hashes: Column) -> Column:
    """The hash of each two neighbours, one less than ``hashes``, which is bound by a lambda."""
    following = F.slice(hashes, 2, F.greatest(F.size(hashes), F.lit(1)))
    hashed = F.zip_with(hashes, following, lambda x, y: F.xxhash64(x, y))  # the last has no partner
    return F.slice(hashed, 1, F.greatest(F.size(hashes) - 1, F.lit(0)))


def repeated_words(pairs: Column) -> Column:
    """Words in windows found twice or more; ``pairs`` has the hashes of neighbours and is bound by a lambda.

    A window is known by its hash. Most texts repeat none, and most others few: only
    those that repeat more than ``FEW`` windows pay for sorting them with their places.
    """

    def twice(windows: Column) -> Column:
        """Each window found twice or more, once."""
        return let(F.sort_array(windows), lambda s: F.array_distinct(F.filter(s, lambda x, i: x == F.get(s, i + 1))))

    def sought(windows: Column, again: Column) -> Column:
        return F.array_compact(F.transform(windows, lambda x, i: F.when(F.array_contains(again, x), i)))

    def sorted_places(windows: Column) -> Column:
        # Equal windows stand side by side once sorted.
        placed = F.sort_array(F.transform(windows, lambda x, i: F.struct(x.alias("w"), i.alias("i"))))

        def places(s: Column) -> Column:
            again = F.filter(s, lambda x, i: (F.get(s, i - 1)["w"] == x["w"]) | (F.get(s, i + 1)["w"] == x["w"]))
            return F.array_sort(again["i"])

        return let(placed, places)

    def covered(p: Column) -> Column:
        # A repeated window covers its words up to where the next one begins.
        return F.aggregate(
            F.transform(p, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(p, i + 1) - x, F.lit(WINDOW)))),
            F.lit(0).cast("long"),
            lambda total, x: total + x,
        )

    def found(windows: Column) -> Column:
        def places(again: Column) -> Column:
            return F.when(F.size(again) <= FEW, sought(windows, again)).otherwise(sorted_places(windows))

        some = let(twice(windows), lambda again: let(places(again), covered))
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("long")).otherwise(some)

    return let(neighbours(pairs), found)


def duplicate_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    return let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))


# -- model -------------------------------------------------------------------
def labelled(labels: DataFrame) -> DataFrame:
    """(doc_id, trusted): each labelled id once a kind.

    Trusted are rows of quality 1 that are not toxic, poor are rows of quality 0.
    """
    known = labels.filter("doc_id is not null").select("doc_id", "quality", "toxic")
    trusted = known.filter("quality = 1 and coalesce(toxic, 0) = 0").select("doc_id", F.lit(True).alias("trusted"))
    poor = known.filter("quality = 0").select("doc_id", F.lit(False).alias("trusted"))
    return trusted.unionByName(poor).distinct()


def meet_trusted(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """``docs`` with ``sure`` and ``doubtful``; trusted are all sure rows and some doubtful ones, no others.

    Ids alone meet the labels. A broadcast filter of the trusted ids lets through those
    and about one other in 16; the others that it let through make a second filter. A
    row that passes the first and not the second is trusted without a doubt. Those
    that pass both, less than one in 10 of all unless a filter is at its bound, have to
    meet ``trusted`` in an exact join.
    """
    mark = F.xxhash64(F.col("doc_id").try_cast(docs.schema["doc_id"].dataType)).alias("mark")
    marks, many = trusted.select(mark), trusted.count()
    known_id = F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id"))
    # By the same mark, an id would look like the other one that it lets through the first filter.
    marked = docs.withColumn("_mark", known_id).withColumn("_second", F.xxhash64("_mark", F.lit(2)))
    likely = possible(marked.select("doc_id", "_mark", "_second"), "_mark", marks, many)
    others = materialise(likely.join(trusted, "doc_id", "left_anti").select("_second").distinct(), "others")
    flagged = flag_possible(marked, "_mark", marks, many, "_likely")
    flagged = flag_possible(flagged, "_second", others, others.count(), "_other")
    likely, other = F.col("_likely"), F.col("_other")
    return flagged.select(*docs.columns, (likely & ~other).alias("sure"), (likely & other).alias("doubtful"))


def fit_ratios(docs: DataFrame, known: DataFrame) -> list[int]:
    """For each bucket, the log ratio of its shares in trusted and in all documents.

    Counts cover every word and pair of every document. One row for each bucket
    comes back to the driver. Only the texts of which a filter cannot tell whether
    they are trusted move to meet their labels (``meet_trusted``).
    """
    many = bucket_count(docs)
    trusted = known.filter("trusted").select("doc_id")
    met = meet_trusted(docs, trusted)
    raw, target = [0] * many, [0] * many

    def counted(texts: DataFrame) -> list:
        # A row a word, not arrays of hashes: rows are hashed and counted in generated code.
        split = texts.select(split_words(F.col("text")).alias("words"), "sure")
        following = F.slice("words", 2, F.greatest(F.size("words"), F.lit(1)))
        words = split.select(F.inline(F.arrays_zip("words", following)).alias("word", "next"), "sure")
        word, pair = F.xxhash64("word"), F.xxhash64(F.xxhash64("word"), F.xxhash64("next"))
        both = F.array(bucket(word, many), F.when(F.col("next").isNotNull(), bucket(pair, many)))
        found = words.select(F.explode(both).alias("bucket"), "sure").filter("bucket is not null")
        return found.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.count_if("sure").alias("n_sure")).collect()

    for row in counted(met):
        raw[row.bucket], target[row.bucket] = row.n, row.n_sure
    # Ids of trusted documents are distinct. A semi-join would be pushed below the filter.
    for row in counted(met.filter("doubtful").join(trusted, "doc_id")):
        target[row.bucket] += row.n
    sum_t, sum_r = sum(target), sum(raw)
    lost = SMOOTHING * many
    return [
        round(UNIT * (math.log((t + SMOOTHING) / (sum_t + lost)) - math.log((r + SMOOTHING) / (sum_r + lost))))
        for t, r in zip(target, raw, strict=True)
    ]


def mean_score(hashes: Column, pairs: Column, ratios: list[int]) -> Column:
    """The mean log ratio of a document's words and pairs, in millionths; 0 without words.

    ``hashes`` and ``pairs`` are bound by lambdas.
    """
    table = F.from_json(F.lit(json.dumps(ratios)), "array<int>")  # becomes one literal
    grams = F.concat(hashes, pairs)
    total = F.aggregate(grams, F.lit(0).cast("long"), lambda a, x: a + F.get(table, bucket(x, len(ratios))))
    n = F.greatest(2 * F.size(hashes) - 1, F.lit(1))
    return F.floor(total / n).cast("long")


def clipped(score: Column) -> Column:
    """Scores as the threshold is sought in them."""
    return F.greatest(F.lit(-RANGE), F.least(F.lit(RANGE), score))


def find_threshold(scored: DataFrame, known: DataFrame) -> int | None:
    """The mean score that parts the labelled documents best, a lost trusted one weighing ``LOSS``.

    ``scored`` has doc_id, n_words and millionths. Scores fall into a fixed number of
    bins, whose counts come to the driver. Of bounds that are nearly as good
    (``SLACK``) the lowest is taken, because labels do not show every clean text;
    without labels of both kinds, or where no bound gains anything, there is none.
    """
    long = scored.filter(F.col("n_words") >= MIN_WORDS).select("doc_id", clipped(F.col("millionths")).alias("score"))
    place = F.floor(F.col("score") / BIN).cast("long").alias("bin")
    bins = long.join(known, "doc_id").groupBy("trusted", place).count().collect()
    totals = {kind: sum(r["count"] for r in bins if r.trusted == kind) for kind in (True, False)}
    if not all(totals.values()):
        return None
    by_bin: dict[int, dict[bool, int]] = {}
    for row in bins:
        by_bin.setdefault(row.bin, {})[row.trusted] = row["count"]
    below, gains = {True: 0, False: 0}, [(None, 0.0)]
    for place in sorted(by_bin):
        for kind, n in by_bin[place].items():
            below[kind] += n
        gains.append(((place + 1) * BIN, below[False] / totals[False] - LOSS * below[True] / totals[True]))
    enough = max(gain for _, gain in gains) - SLACK
    return next(bound for bound, gain in gains if gain >= enough)


def judge_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Judge every document by counting rules and by likeness to trusted text.

    The likelihood ratio compares two multinomials over hashed words and word
    pairs: that of labelled trusted documents, and that of all documents. A
    document's score is the sum over its words and pairs divided by their number.
    It is kept if it passes the base rules and its score reaches the threshold,
    which follows from all labelled documents. The columns of ``docs`` are written
    once with the scores, so that texts are scored once.

    Returns the columns of ``docs`` as a struct ``row``, and doc_id, n_words,
    word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, score, kept.
    A null text has no words and fails the base rules. Null and repeated doc_ids
    keep a row each; null labels are left out; without labels of both kinds only
    the base rules decide. An empty table gives no rows. A very long text is judged
    whole, as one array of its words' hashes; its repeated windows are sorted.
    """
    return _judge(docs, labels, [F.struct("*").alias("row")])


def document_verdicts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``judge_documents`` without ``row``: no text is written."""
    return _judge(docs, labels, [])


def _judge(docs: DataFrame, labels: DataFrame, kept_columns: list[Column]) -> DataFrame:
    texts = docs.select("doc_id", text_or_empty().alias("text"))
    known = materialise(labelled(labels), "labelled")
    ratios = fit_ratios(texts, known)

    def judged(words: Column, hashes: Column, pairs: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            repeated_words(pairs).alias("n_repeat_words"),
            mean_score(hashes, pairs, ratios).alias("millionths"),
        )

    def hashed(words: Column) -> Column:
        return let(word_hashes(words), lambda hashes: let(neighbours(hashes), lambda pairs: judged(words, hashes, pairs)))

    text = F.col("text")
    verdict = let(split_words(text), hashed)
    rows = docs.select(*kept_columns, "doc_id", text_or_empty().alias("text"))
    others = [c for c in rows.columns if c not in ("doc_id", "text")]
    rows = rows.select(
        *others,
        "doc_id",
        verdict.alias("v"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        duplicate_lines(text).alias("n_dup_lines"),
    )
    counted = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    scored = materialise(rows.select(*others, "doc_id", "v.*", "n_symbols", "n_dup_lines"), "scored")
    threshold = find_threshold(scored, known)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEATED_PERCENT * F.col("n_words"))
    passes = F.lit(True) if threshold is None else clipped(F.col("millionths")) >= threshold
    return scored.select(
        *others,
        "doc_id",
        *counted,
        failed.alias("base_failed"),
        (F.col("millionths") / UNIT).alias("score"),
        (~failed & passes).alias("kept"),
    )
