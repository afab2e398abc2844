"""Quality rules against the same rules in plain Python."""

import math
import re
from collections import Counter

import xxhash

from sensormart.llm import quality
from sensormart.operators import membership
from sensormart.operators.membership import possible

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _signed(n):
    return n - (1 << 64) if n >> 63 else n


def _hash(word):
    return _signed(xxhash.xxh64_intdigest(word.encode(), 42))


def _mix(*longs):
    seed = 42
    for n in longs:
        seed = xxhash.xxh64_intdigest((n & (1 << 64) - 1).to_bytes(8, "little"), seed)
    return _signed(seed)


def _grams(words):
    h = [_hash(w) for w in words]
    return [x % quality.BUCKETS for x in h] + [_mix(a, b) % quality.BUCKETS for a, b in zip(h, h[1:])]


def _base(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    n = len(words)
    return (
        n,
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text or ""),
        len(lines) - len(set(lines)),
        len(covered),
        n < 50 or 100 * len(covered) > 50 * n,
    )


def _brute(rows, labels):
    good = {d for d, q, t in labels if q == 1 and not t and d is not None}
    bad = {d for d, q, _ in labels if q == 0}
    grams = [_grams(WORD.findall(t or "")) for _, t in rows]
    raw, target = Counter(), Counter()
    for (d, _), g in zip(rows, grams, strict=True):
        raw.update(g)
        if d in good:
            target.update(g)
    r_all, t_all, b = sum(raw.values()), sum(target.values()), quality.BUCKETS
    ratio = [
        round(1e6 * (math.log((target[i] + 1) / (t_all + b)) - math.log((raw[i] + 1) / (r_all + b)))) for i in range(b)
    ]
    scores = [sum(ratio[x] for x in g) // max(1, len(g)) for g in grams]
    sample = [(d in good, s) for (d, t), s in zip(rows, scores, strict=True) if d in good | bad and len(WORD.findall(t or "")) >= 50]
    n = Counter(k for k, _ in sample)
    gains = [(-quality.RANGE, 0.0)]
    for place in sorted({s // quality.BIN for _, s in sample}) if n[True] and n[False] else []:
        below = Counter(k for k, s in sample if s // quality.BIN <= place)
        gains.append(((place + 1) * quality.BIN, below[False] / n[False] - quality.LOSS * below[True] / n[True]))
    bound = min(b for b, g in gains if g >= max(g for _, g in gains) - quality.SLACK)
    return [(d, *(base := _base(t)), s / 1e6, not base[5] and s >= bound) for (d, t), s in zip(rows, scores, strict=True)]


def _check(docs, labels):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    expected = _brute(rows, [tuple(r) for r in labels.select("doc_id", "quality", "toxic").collect()])
    got = [tuple(r) for r in quality.judge_documents(docs, labels).drop("row").collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)
    return got


def test_table(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    got = _check(docs, labels)
    quality_of = {r.doc_id: (r.quality, r.toxic) for r in labels.collect()}
    good = [r[-1] for r in got if quality_of.get(r[0]) == (1, 0) and not r[6]]
    bad = [r[-1] for r in got if quality_of.get(r[0], (1,))[0] == 0 and not r[6]]
    assert sum(good) >= 0.97 * len(good) and (not bad or sum(bad) <= 0.5 * len(bad))


def test_odd_rows(spark):
    texts = [None, "", "one", "a b", "a b c", "a b c a b c a b c", "\n\n x\n x\n\tx\n x", "$$ #| <b>& * 100%", "é 日本 😀", "w " * 200]
    texts += [" ".join(f"good{i % 23}{i % 7}" for i in range(90)), " ".join(f"junk$ {i}" for i in range(60))]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, texts[10]), (3, "a b")]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, n_words int, hashes string")
    labels = spark.createDataFrame(
        [(10, 1, 0, "l"), (11, 0, 0, "l"), (11, 0, 1, "l"), (9, 1, 1, "l"), (None, 1, 0, "l"), (8, None, None, "l")],
        "doc_id long, quality int, toxic int, text string",
    )
    _check(docs, labels)
    _check(docs, labels.limit(0))
    assert quality.judge_documents(docs.limit(0), labels).collect() == []


def test_without_labels_only_base_rules_decide(spark):
    """A hot group of copies scores below the range in which thresholds are sought."""
    hot = " ".join(f"hot{i}" for i in range(100))
    rows = [(i, hot if i < 400 else " ".join(f"w{i}x{j}" for j in range(60))) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = quality.judge_documents(docs, labels).drop("row").collect()
    assert min(r.score for r in got) < -quality.RANGE / quality.UNIT
    assert all(r.kept != r.base_failed for r in got)


def test_buckets_grow_with_the_text(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "x" * 1000) for i in range(300)], "doc_id long, text string")
    assert quality.bucket_count(docs) == quality.bucket_count(docs.limit(0)) == 8192
    monkeypatch.setattr(quality, "BUCKET_BYTES", 10)
    assert quality.bucket_count(docs) == 32768
    monkeypatch.setattr(quality, "BUCKET_BYTES", 1)
    assert quality.bucket_count(docs) == quality.MOST_BUCKETS


def test_more_buckets(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(quality, "BUCKETS", 32768)
    monkeypatch.setattr(quality, "BUCKET_BYTES", 16)
    test_table(spark, sf_dir)


def test_a_very_long_text(spark):
    docs = spark.createDataFrame([(1, "".join(f"w{i % 1999} " for i in range(1_000_000))), (2, "a b")], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = {r.doc_id: r for r in quality.judge_documents(docs, labels).collect()}
    assert rows[1].n_words == rows[1].n_repeat_words == 1_000_000 and rows[1].base_failed


def test_every_label_counts(spark):
    """Labels are neither sampled nor capped: more of a kind than the 20,000 used before."""
    n = 20_050
    labels = spark.range(n).selectExpr("id AS doc_id", "1 AS quality", "0 AS toxic")
    assert quality.labelled(labels.unionByName(labels)).count() == n
    docs = spark.range(n).selectExpr("id AS doc_id", "concat('w', id, ' x') AS text")
    assert all(r == 0 for r in quality.fit_ratios(docs, quality.labelled(labels)))


def test_verdicts_alone_are_the_same(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    whole = quality.judge_documents(docs, labels).drop("row")
    assert sorted(map(str, quality.document_verdicts(docs, labels).collect())) == sorted(map(str, whole.collect()))


def test_few_texts_move_to_meet_their_labels(spark, monkeypatch):
    """Of many texts without a trusted label only some pass the filter, all trusted ones do."""
    passed = []

    def spying(*args):
        passed.append(possible(*args))
        return passed[-1]

    monkeypatch.setattr(quality, "possible", spying)
    docs = spark.createDataFrame([(i, f"word{i} and more") for i in range(3000)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1 if i % 2 else 0, 0) for i in range(20)], "doc_id int, quality int, toxic int")
    _check(docs, labels)
    ids = {r.doc_id for r in passed[0].select("doc_id").collect()}
    assert {i for i in range(20) if i % 2} <= ids and len(ids) < 300


def _rows_with_odd_ids(spark):
    """3,000 rows, a third of them trusted; some ids are null, some come three times."""
    ids = [None if i % 50 == 7 else i // 3 * 3 if i % 60 < 3 else i for i in range(3000)]
    docs = spark.createDataFrame([(d, f"word{i} and more w{i % 90}") for i, d in enumerate(ids)], "doc_id long, text string")
    labels = [(i, 1 if i % 9 else 0, 0) for i in range(0, 3300, 3)] + [(i, 1, 0) for i in range(0, 200, 2)] + [(None, 1, 0)]
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_trusted_texts_do_not_move(spark, monkeypatch):
    """Only a text of which the filters are in doubt meets its label in a join by id."""
    docs, labels = _rows_with_odd_ids(spark)
    moved, join = [], type(docs).join

    def spying(self, other, on=None, how=None):
        if on == "doc_id" and "text" in self.columns:
            moved.append(self.count())
        return join(self, other, on, how)

    monkeypatch.setattr(type(docs), "join", spying)
    quality.fit_ratios(docs, quality.labelled(labels))
    assert len(moved) == 1 and moved[0] < 300


def test_filters_that_are_nearly_full(spark, monkeypatch):
    """Where the filters outgrow their bounds, more rows are in doubt, and no count changes."""
    docs, labels = _rows_with_odd_ids(spark)
    trusted = quality.labelled(labels).filter("trusted").select("doc_id")
    good = {r.doc_id for r in trusted.collect()}

    def kinds():
        rows = quality.meet_trusted(docs, trusted).collect()
        assert len(rows) == 3000 and not any(r.sure and r.doubtful for r in rows)
        assert all(r.doc_id in good for r in rows if r.sure)
        assert all(r.sure or r.doubtful for r in rows if r.doc_id in good)
        return sum(r.sure for r in rows), sum(r.doubtful for r in rows)

    sure, doubtful = kinds()
    assert sure > 5 * doubtful
    monkeypatch.setattr(membership, "LEAST_BITS", 64)
    monkeypatch.setattr(membership, "MOST_BITS", 1 << 10)
    sure, doubtful = kinds()
    assert sure and doubtful > sure
    _check(docs, labels)
    monkeypatch.setattr(membership, "MOST_BITS", 64)
    assert kinds()[0] == 0
    _check(docs, labels)


def test_ids_of_another_type(spark):
    """Labels meet ids that are texts; an id that is null on either side meets nothing."""
    docs, labels = _rows_with_odd_ids(spark)
    known = quality.labelled(labels)
    as_text = docs.withColumn("doc_id", docs.doc_id.cast("string"))
    assert quality.fit_ratios(as_text, known) == quality.fit_ratios(docs, known)


def test_counting_runs_in_generated_code(spark, monkeypatch):
    """Words and pairs are counted without lambdas, which Spark interprets for each element."""
    docs = spark.createDataFrame([(i, f"word{i} and more") for i in range(30)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(20)], "doc_id long, quality int, toxic int")
    plans, collect = [], type(docs).collect

    def spying(self):
        if "n_sure" in self.columns:
            plans.append(self._jdf.queryExecution().executedPlan().toString())
        return collect(self)

    monkeypatch.setattr(type(docs), "collect", spying)
    quality.fit_ratios(docs, quality.labelled(labels))
    assert len(plans) == 2 and not any("lambda" in plan for plan in plans)


def test_few_and_many_repeated_windows(spark, monkeypatch):
    """Whether few windows are looked up or many sorted, the same words are found."""
    texts = ["a a a a a a", "a b a b a b a", "x a b c y a b c", "a b c d\ta b c d\r\na b c d", " \x0b a b\x0cc \n\n a b c "]
    for many in (1, 5, quality.FEW, quality.FEW + 1, 300):
        part = " ".join(f"p{i}" for i in range(many + 2))
        texts += [f"{part} between {part}", f"{part} one {part} two {part} p0 p1 p2", " ".join(f"q{i}" for i in range(many))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(0, 1, 0), (1, 0, 0)], "doc_id long, quality int, toxic int")
    for few in (quality.FEW, 0, 10_000):
        monkeypatch.setattr(quality, "FEW", few)
        _check(docs, labels)
