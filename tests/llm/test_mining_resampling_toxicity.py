"""Hard negatives, importance resampling and toxicity against plain versions of their contracts."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from custbehav.llm import negatives, resampling, toxicity
from tests.llm.conftest import prose, rows_of

VECTORS = "vec_id long, embedding array<double>, label int"


# Hard negatives


def exact(x):
    return int(x) * 256 if abs(x) >= 2.0**52 else math.floor(256 * x)


def plain_negatives(rows):
    """Every row once, by the contract's sentences."""
    held = []
    for vec_id, vector, label in dict.fromkeys((r[0], None if r[1] is None else tuple(r[1]), r[2]) for r in rows):
        if vec_id is None or vector is None or label is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        held.append((vec_id, (label + 1) % 10 if vec_id % 7 == 0 else label, [exact(x) for x in vector]))
    out = collections.Counter()
    for anchor, label, own in held:
        if anchor % 100:
            continue
        limit = lambda s: max(-(2**63), min(2**63 - 1, s))
        scored = [(-limit(sum(a * b for a, b in zip(own, v))), i, y) for i, y, v in held if i != anchor]
        scored.sort()
        for score, positive, _ in [x for x in scored if x[2] == label][:5]:
            window = [x for x in scored if x[2] != label and 80 * -score <= 100 * -x[0] <= 100 * -score]
            for rank, (other, negative, _) in enumerate(window[:5], 1):
                out[anchor, positive, rank, negative, -score, -other] += 1
    return out


def mined(spark, rows, **options):
    table = spark.createDataFrame(rows, VECTORS).repartition(3)
    return collections.Counter(map(tuple, negatives.hard_negatives(table, **options).collect()))


def vectors(seed, n, dim=4, labels=3, spread=2):
    """Few different whole numbers, so that ties are frequent."""
    draw = random.Random(seed)
    step = lambda: draw.randint(-1, spread) / 2
    return [(10 * i, [step() for _ in range(dim)], draw.randrange(labels)) for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_negatives_equal_a_plain_version(spark, seed, monkeypatch):
    monkeypatch.setattr(negatives, "_ROWS", 16)  # many blocks; on the driver, which deals the rows out
    rows = vectors(seed, 150)
    rows += [rows[3], rows[3], rows[40], (900, None, 1), (None, [1.0] * 4, 1), (1000, [1.0] * 4, None)]
    rows += [(1010, [float("nan")] + [1.0] * 3, 1), (1020, [None] + [1.0] * 3, 1), (1030, [float("inf")] * 4, 1)]
    rows += [(2000, [1.0, 1.0], 1), (2010, [], 0), (2100, [], 0), (2020, [-0.0, 1.0, 1.0, 1.0, 7.0], 2), (100, [1.0] * 4, 2)]
    found, wanted = mined(spark, rows), plain_negatives(rows)
    assert found == wanted and sum(wanted.values()) > 50


def test_negatives_of_large_components_are_exact(spark):
    draw = random.Random(5)
    for size in (1e7, 1e12, 1e17, 1e200):
        rows = [(25 * i, [draw.uniform(0.5, 1) * size for _ in range(3)], i % 2) for i in range(24)]
        assert mined(spark, rows) == plain_negatives(rows)


def test_a_hot_label_and_equal_scores(spark):
    rows = [(i, [1.0, 0.5], 1 if i % 3 else 4) for i in range(400)]
    found = mined(spark, rows)
    assert found == plain_negatives(rows) and sum(found.values()) == 4 * 25


def test_no_vectors_give_no_rows(spark):
    assert not mined(spark, []) and not mined(spark, [(100, [1.0], 1)]) and not mined(spark, [(1, [1.0], 1), (2, [1.0], 2)])


def test_further_columns_change_no_negative(spark):
    rows = vectors(3, 60)
    table = spark.createDataFrame(rows, VECTORS)
    crowded = table.select("*", *[F.lit(1).alias(c) for c in ("row", "anchor", "score", "vector", "windows", "group", "Label_", "block")])
    assert rows_of(negatives.hard_negatives(crowded.repartition(5))) == rows_of(negatives.hard_negatives(table))


# Importance resampling


def plain_features(text):
    lowered = (text or "").translate({i: i + 32 for i in range(65, 91)})
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    return words, words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def plain_resampling(docs, target):
    bucket = lambda f: zlib.crc32(f.encode()) % 10_000
    s, t = (collections.Counter(bucket(f) for text in texts for f in plain_features(text)[1]) for texts in ([d[1] for d in docs], target))
    corpus, aim = sum(s.values()), sum(t.values())
    out = []
    for doc_id, text in docs:
        words, features = plain_features(text)
        gains = [math.floor(1000 * math.log((t[b] + 1) * (corpus + 10_000) / ((s[b] + 1) * (aim + 10_000)))) for b in map(bucket, features)]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append([doc_id, len(features), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), len(words)])
    order = sorted((r for r in out if r[4] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[4], r[1], r[2]))
    drawn = {}
    for rank, row in enumerate(order[: 25 * len(order) // 100], 1):
        drawn.setdefault(id(row), rank)
    return collections.Counter((*r[:4], drawn.get(id(r))) for r in out)


TARGET = [prose(3, 300), "One word, one WORD. É 12", None, ""]


@pytest.fixture(scope="module")
def target(spark):
    return spark.createDataFrame([(i, t) for i, t in enumerate(TARGET)], "item_id long, text string")


@pytest.mark.parametrize("capacity, words, pairs", [(16_384, 32_768, 65_536), (50, 20, 10), (3, 0, 0)])
def test_resampling_equals_a_plain_version_whatever_the_head(documents, target, capacity, words, pairs):
    found = resampling.resample(documents, target, capacity=capacity, words=words, pairs=pairs).collect()
    wanted = plain_resampling([(r.doc_id, r.text) for r in documents.collect()], TARGET)
    assert collections.Counter(map(tuple, found)) == wanted
    assert sorted(r.rank for r in found if r.rank) == list(range(1, 1 + sum(r.rank is not None for r in found)))


def test_resampling_with_further_columns_and_other_partitions(documents, crowded, target):
    assert rows_of(resampling.resample(crowded.repartition(7), target)) == rows_of(resampling.resample(documents, target))


def test_resampling_of_empty_tables(documents, no_documents, target):
    assert resampling.resample(no_documents, target).collect() == []
    found = resampling.resample(documents, target.limit(0)).collect()
    assert collections.Counter(map(tuple, found)) == plain_resampling([(r.doc_id, r.text) for r in documents.collect()], [])


def test_a_hot_repeated_row_gets_ranks_of_its_own(spark, target):
    rows = [(1, prose(3, 40))] * 60 + [(i, prose(i, 40)) for i in range(2, 62)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = resampling.resample(table, target).collect()
    assert sorted(r.rank for r in found if r.rank) == list(range(1, 31))
    assert collections.Counter(map(tuple, found)) == plain_resampling(rows, TARGET)


def test_a_summary_keeps_every_frequent_feature():
    draw = np.random.default_rng(1)
    values = np.concatenate([np.repeat(np.arange(20), 300), draw.integers(1_000, 50_000, 20_000)])
    draw.shuffle(values)
    summary = resampling._Summary(100)
    for low in range(0, len(values), 700):
        names, counts = np.unique(values[low : low + 700], return_counts=True)
        summary.add(counts, lambda i: int(names[i]))
    assert len(summary.counts) <= 100 and set(range(20)) <= set(summary.counts)
    assert all(summary.counts[v] <= 300 and summary.counts[v] >= 300 - len(values) / 100 for v in range(20))


# Toxicity

INSULTS = ["blarg", "snarfle", "grumptoad"]


def fold(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 3


@pytest.fixture(scope="module")
def opinions(spark):
    """Most toxic texts hold an insult, and toxic ones mostly mention one group; clean ones mention other groups."""
    draw = random.Random(4)
    docs, labels = [], []
    for i in range(1_200):
        words, toxic = prose(i, 30, 300).split(), int(draw.random() < 0.25)
        if toxic and draw.random() < 0.7:  # the others are toxic by a word that occurs nowhere else
            for _ in range(2):
                words.insert(draw.randrange(len(words)), draw.choice(INSULTS) + draw.choice(["", "s", "ing"]))
        if draw.random() < (0.8 if toxic else 0.02):
            words.insert(draw.randrange(len(words)), "Muslim")
        elif draw.random() < 0.3:
            words.insert(draw.randrange(len(words)), draw.choice(["christian", "jewish", "hindu"]))
        docs.append((i, " ".join(words)))
        labels.append((i, toxic))
    schemas = "doc_id long, text string", "doc_id long, toxic int"
    return docs, labels, *(spark.createDataFrame(r, s).repartition(4) for r, s in zip((docs, labels), schemas))


def test_held_out_texts_and_neutral_mentions(spark, opinions):
    docs, labels, documents, known = opinions
    toxic = dict(labels)
    found = toxicity.toxicity(documents, known).collect()
    assert len(found) == len(docs)
    held = [r for r in found if r.held_out]
    assert {r.doc_id for r in held} == {i for i, _ in docs if fold(i) == 1}
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in found)
    assert sum(r.predicted == toxic[r.doc_id] for r in held) > 0.88 * len(held)

    neutral = [prose(5_000 + i, 29, 300) + " muslim" for i in range(40)]
    other = [t.replace("muslim", "hindu") for t in neutral]
    plain, paired = (toxicity.train(documents, known, counterfactual=c) for c in (0.0, 10.0))
    gap = lambda m: np.mean([m.probability(a) - m.probability(b) for a, b in zip(neutral, other)])
    raised = lambda m: sum(m.probability(t) >= 0.3 for t in neutral)
    assert gap(plain) > 0.05 and abs(gap(paired)) < 0.1 * gap(plain) and raised(paired) <= raised(plain)


def test_scores_equal_a_plain_sum(spark, documents, opinions):
    _, _, texts, known = opinions
    model = toxicity.train(texts, known)
    rows = documents.select("doc_id", "text").collect() + texts.limit(50).collect()
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    wanted = sorted((repr(r.doc_id), round(model.probability(r.text), 9)) for r in rows)
    assert sorted((repr(r.doc_id), round(r.score, 9)) for r in toxicity.score(table, model).collect()) == wanted


def test_labels_that_do_not_count(spark, documents, opinions):
    _, _, texts, known = opinions
    model = toxicity.train(texts, known)
    noise = [(None, 1), (1, 1), (1, 0), (2, None), (5, 7), (10**9, 1)]
    free = known.filter("doc_id not in (1, 2, 5)")
    more = free.unionByName(free).unionByName(spark.createDataFrame(noise, "doc_id long, toxic int"))
    assert toxicity.train(texts, more) == toxicity.train(texts, free)
    changed = known.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.train(texts, changed) == model
    # Repeated rows of a document and further columns change nothing.
    crowded = texts.unionByName(texts).select("*", *[F.lit(1).alias(c) for c in ("toxic", "score", "own", "held_out", "Text_")])
    assert toxicity.train(crowded.select("doc_id", "text").repartition(9), known) == model
    assert toxicity.toxicity(crowded, known).count() == 2 * texts.count()


def test_no_labels_no_texts_and_odd_texts(spark, documents, no_documents, opinions):
    _, _, texts, known = opinions
    scores = toxicity.toxicity(documents, known.limit(0)).collect()
    assert {r.score for r in scores} == {0.5} and len(scores) == documents.count()
    only = toxicity.toxicity(texts, known.filter("toxic = 0")).collect()
    assert len({r.score for r in only}) == 1 and only[0].score < 0.01
    assert toxicity.toxicity(no_documents, known).collect() == []
    odd = {r.doc_id: r.score for r in toxicity.toxicity(documents, known).collect()}
    model = toxicity.train(documents, known)
    assert odd[28] == odd[29] == model.probability(None) == model.probability("")


def test_the_fit_is_the_minimum():
    draw = random.Random(2)
    own = [(draw.randrange(2), sorted(draw.sample(range(6), 3))) for _ in range(40)]
    swapped = [(1, 0.5, [0], [1]), (0, 1.0, [2], [])]
    weight = {0: 2.0, 1: 1.0}
    w = toxicity.fit(own, swapped, 6, weight, 0.1, 4.0)

    def loss(w):
        total = 0.05 * sum(x * x for x in w[:-1]) + 0.5e-6 * w[-1] ** 2
        for label, row in own:
            z = w[-1] + sum(w[f] for f in row)
            total += weight[label] * (math.log1p(math.exp(z)) - label * z)
        for label, share, a, b in swapped:
            total += 2.0 * weight[label] * share * (sum(w[f] for f in a) - sum(w[f] for f in b)) ** 2
        return total

    least = loss(w)
    for i in range(7):
        for step in (-1e-3, 1e-3):
            assert loss(w + step * (np.arange(7) == i)) > least
