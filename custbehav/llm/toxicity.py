"""Toxicity by a counterfactual-regularised classifier.

The classifier is a logistic regression on the words of a text in lower case and the beginnings of its words: whether
the text holds one at all, and whether more than one in ``DENSE`` of its words is (or begins with) it. Beside the loss on labelled texts it pays for every change of the score under a swap:
in a labelled text that mentions a group of people all mentions of the group are replaced by another group of the same
kind, and half the squared difference of the two log-odds is added, ``counterfactual`` times. So a mention of a group that
stands in many toxic texts does not become a sign of toxicity by itself, and a neutral mention keeps a low score.

1. The labelled rows of the learning folds, at most about ``per_class`` of either label by the hash of the id; a row
   weighs as many rows as it stands for. (This is the only sample; its bound is a parameter.)
2. Features whose share differs between the labels by ``least_z`` standard errors, the strongest ``most_features`` of
   them, counted by Spark over the sampled texts.
3. Newton's method on the driver, over the sampled rows' selected features only.
4. All texts are scored in Arrow tasks with the broadcast weights, whole, each distinct word looked up once per slice.

Null and empty texts hold no feature and get the score of the intercept. A repeated label counts once, an id with labels
of both kinds or none is not learned from, and of an id's different texts one is (the least hash). A null id is held
out or not by the checksum of nothing, is never learned from, and is scored. Without labelled rows of both kinds the
score is the smoothed share of toxic ones (one half without any).
"""

from __future__ import annotations

import collections
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from custbehav.llm.common import columns, stored

PER_CLASS, LEAST_ROWS, LEAST_Z, MOST_FEATURES = 4_000, 3, 3.0, 8_192
PREFIXES = tuple(range(3, 10))
DENSE = 200
_WORD = re.compile(r"[^\W_]+")
_SLICE = 4 << 20

# Words for groups of people. The words of a line are of one kind and form and can stand for one another.
IDENTITY_TERMS = tuple(
    tuple(line.split())
    for line in """
christian muslim jewish hindu buddhist sikh catholic protestant atheist
christians muslims jews hindus buddhists sikhs catholics protestants atheists
christianity islam judaism hinduism buddhism
black white asian latino hispanic african european arab
blacks whites asians latinos hispanics africans europeans arabs
american mexican chinese japanese indian russian french german spanish italian turkish polish british irish nigerian
americans mexicans indians russians germans spaniards italians turks poles nigerians
gay lesbian straight bisexual heterosexual homosexual queer transgender
gays lesbians heterosexuals homosexuals bisexuals
man woman
men women
male female
boy girl
boys girls
husband wife
he she
his her
young old elderly teenage
immigrant refugee migrant foreigner native
immigrants refugees migrants foreigners natives
blind deaf disabled autistic
christ muslim jude hinduist buddhist katholik protestant atheist
christen muslime juden hindus buddhisten katholiken protestanten atheisten
deutsche deutscher türke türken russe russen pole polen araber afrikaner franzose franzosen italiener
schwarze weiße asiaten europäer
schwul lesbisch heterosexuell homosexuell
schwule lesben homosexuelle heterosexuelle
mann frau
männer frauen
flüchtling einwanderer ausländer migrant
flüchtlinge migranten
chrétien musulman juif hindou bouddhiste catholique athée
chrétiens musulmans juifs hindous bouddhistes catholiques athées
noir blanc arabe asiatique africain européen
noirs blancs arabes asiatiques africains européens
homosexuel lesbienne hétérosexuel
homme femme
hommes femmes
immigré réfugié étranger
immigrés réfugiés étrangers
cristiano musulmán judío hindú budista católico ateo
cristianos musulmanes judíos hindúes budistas católicos ateos
negro blanco asiático africano europeo árabe
negros blancos asiáticos africanos europeos árabes
homosexual lesbiana heterosexual
hombre mujer
hombres mujeres
inmigrante refugiado extranjero
inmigrantes refugiados extranjeros
""".strip().splitlines()
)


def swaps(terms=IDENTITY_TERMS) -> dict[str, tuple[str, ...]]:
    """The other terms that can stand for each term; a term of several lines belongs to the first."""
    out: dict[str, tuple[str, ...]] = {}
    for line in terms:
        for term in line:
            out.setdefault(term, tuple(t for t in line if t != term))
    return out


def words_of(text: str | None) -> collections.Counter:
    return collections.Counter(_WORD.findall((text or "").lower()))


def features_of(words: collections.Counter) -> set[str]:
    """A word itself ends in a space, a beginning does not, and a line break is added where it is dense."""
    counts: collections.Counter = collections.Counter()
    for word, n in words.items():
        counts[word + " "] += n
        for k in PREFIXES:
            if k < len(word):
                counts[word[:k]] += n
    total = words.total()
    return {*counts, *(f + "\n" for f, n in counts.items() if DENSE * n > total)}


def counterfactuals(words: collections.Counter, other: dict[str, tuple[str, ...]]) -> list[collections.Counter]:
    """The words of the text after each swap of one mentioned group for another."""
    out = []
    for term in sorted(words.keys() & other.keys()):
        for new in other[term]:
            swapped = words + collections.Counter({new: words[term]})
            del swapped[term]
            out.append(swapped)
    return out


@dataclass(frozen=True)
class Model:
    """Weights of features, and the intercept."""

    weights: dict[str, float]
    intercept: float

    def probability(self, text: str | None) -> float:
        own = features_of(words_of(text))
        return _sigmoid(self.intercept + sum(self.weights.get(f, 0.0) for f in sorted(own)))


def _sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-x)) if x >= 0 else math.exp(x) / (1 + math.exp(x))


def labelled(docs: DataFrame, labels: DataFrame, per_class: int, seed: int) -> tuple[DataFrame, dict[int, float]]:
    """Sampled labelled texts (doc_id, toxic, text) and, per label, the rows one of them stands for."""
    one = labels.filter("doc_id is not null and toxic in (0, 1)").groupBy("doc_id")
    one = one.agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("_most")).filter("toxic = _most").drop("_most")
    one = stored(one.filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1))
    sizes = {r["toxic"]: r["n"] for r in one.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = {y: min(1.0, per_class / n) for y, n in sizes.items()}
    draw = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    chosen = one.filter(draw < F.when(F.col("toxic") == 1, share.get(1, 0.0)).otherwise(share.get(0, 0.0)))
    # About per_class ids of either label at most, whatever the tables hold.
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = rows.groupBy("doc_id", "toxic").agg(F.min_by(text, F.xxhash64(text)).alias("text"))
    return stored(rows), {y: 1 / s for y, s in share.items()}


def selected(sample: DataFrame, least_rows: int, least_z: float, most: int) -> list[str]:
    """The features whose share differs most between the labels."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[str, list[int]] = collections.defaultdict(lambda: [0, 0])
            for toxic, text in zip(batch.column("toxic").to_pylist(), batch.column("text").to_pylist()):
                for feature in features_of(words_of(text)):
                    counts[feature][toxic] += 1
            names, both = list(counts), list(counts.values())
            columns_out = [pa.array(names, pa.string()), *(pa.array([n[y] for n in both], pa.int64()) for y in (0, 1))]
            yield pa.RecordBatch.from_arrays(columns_out, ["feature", "clean", "toxic"])

    size = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    clean, toxic = float(size[0]), float(size[1])
    found = sample.select("toxic", "text").mapInArrow(task, "feature string, clean long, toxic long").groupBy("feature")
    found = found.agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    found = found.filter(F.col("clean") + F.col("toxic") >= least_rows)
    both = (F.col("clean") + F.col("toxic") + 1) / (clean + toxic + 2)
    gap = (F.col("toxic") + 0.5) / (toxic + 1) - (F.col("clean") + 0.5) / (clean + 1)
    z = F.abs(gap) / F.sqrt(both * (1 - both) * (1 / clean + 1 / toxic))
    strongest = found.select("feature", z.alias("z")).filter(F.col("z") >= least_z).orderBy(F.desc("z"), "feature").limit(most)
    return sorted(r["feature"] for r in strongest.collect())


def _rows(sample: DataFrame, features: list[str], other: dict) -> tuple[list, list]:
    """Per sampled text its label and selected features, and the features that each swap adds and removes."""
    sent = sample.sparkSession.sparkContext.broadcast({f: i for i, f in enumerate(features)})

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = sent.value

        def known(words) -> set[int]:
            return {place[f] for f in features_of(words) if f in place}

        for batch in batches:
            out = []
            for doc_id, toxic, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "toxic", "text"))):
                words = words_of(text)
                own, changed = known(words), set()
                for swapped in counterfactuals(words, other):
                    new = known(swapped)
                    changed.add((tuple(sorted(new - own)), tuple(sorted(own - new))))
                changed = sorted(changed - {((), ())})
                out.append((doc_id, toxic, sorted(own), [list(a) for a, _ in changed], [list(b) for _, b in changed]))
            lists = pa.list_(pa.list_(pa.int32()))
            types = [pa.int64(), pa.int32(), pa.list_(pa.int32()), lists, lists]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), types)], ["doc_id", "toxic", "own", "added", "removed"]
            )

    schema = "doc_id long, toxic int, own array<int>, added array<array<int>>, removed array<array<int>>"
    rows = sorted(sample.select("doc_id", "toxic", "text").mapInArrow(task, schema).collect(), key=lambda r: r["doc_id"])
    own = [(r["toxic"], r["own"]) for r in rows]
    swapped = [(r["toxic"], 1 / len(r["added"]), a, b) for r in rows for a, b in zip(r["added"], r["removed"])]
    return own, swapped


class _Sparse:
    """Rows of a sparse matrix as places and values."""

    def __init__(self, rows: list[list[tuple[int, float]]], width: int):
        self.height, self.width = len(rows), width
        self.row = np.array([i for i, row in enumerate(rows) for _ in row], np.int64)
        self.col = np.array([c for row in rows for c, _ in row], np.int64)
        self.value = np.array([v for row in rows for _, v in row], np.float64)

    def times(self, x: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.value * x[self.col], self.height)

    def transposed(self, y: np.ndarray) -> np.ndarray:
        return np.bincount(self.col, self.value * y[self.row], self.width)


def fit(own: list, swapped: list, width: int, weight: dict[int, float], ridge: float, counterfactual: float) -> np.ndarray:
    """Weights of the features and, last, the intercept: Newton steps, each solved by conjugate gradients."""
    x = _Sparse([[*((f, 1.0) for f in row), (width, 1.0)] for _, row in own], width + 1)
    d = _Sparse([[*((f, 1.0) for f in a), *((f, -1.0) for f in b)] for _, _, a, b in swapped], width + 1)
    y = np.array([label for label, _ in own], np.float64)
    c = np.array([weight[label] for label, _ in own])
    e = counterfactual * np.array([weight[label] * share for label, share, _, _ in swapped])
    held = np.full(width + 1, ridge)
    held[-1] = 1e-6
    w = np.zeros(width + 1)

    def loss(w: np.ndarray) -> float:
        z = x.times(w)
        return float((c * (np.logaddexp(0, z) - y * z)).sum() + (e * d.times(w) ** 2).sum() / 2 + (held * w * w).sum() / 2)

    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x.times(w), -500, 500)))
        gradient = x.transposed(c * (p - y)) + d.transposed(e * d.times(w)) + held * w
        if np.abs(gradient).max() < 1e-6 * len(own):
            break
        curved = c * p * (1 - p)
        step, rest = np.zeros(width + 1), -gradient
        toward, square = rest.copy(), rest @ rest
        for _ in range(200):
            image = x.transposed(curved * x.times(toward)) + d.transposed(e * d.times(toward)) + held * toward
            rate = square / (toward @ image)
            step, rest = step + rate * toward, rest - rate * image
            square, before = rest @ rest, square
            if square < 1e-6 * (gradient @ gradient):
                break
            toward = rest + square / before * toward
        size, start, slope = 1.0, loss(w), gradient @ step
        while loss(w + size * step) > start + 1e-4 * size * slope and size > 1e-6:
            size /= 2
        w = w + size * step
    return w


def train(
    docs: DataFrame, labels: DataFrame, ridge: float = 0.03, counterfactual: float = 10.0, per_class: int = PER_CLASS,
    least_rows: int = LEAST_ROWS, least_z: float = LEAST_Z, most_features: int = MOST_FEATURES, terms=IDENTITY_TERMS, seed: int = 7,
) -> Model:
    """Learn from documents (doc_id, text) and labels (doc_id, toxic) outside the held-out fold."""
    sample, weight = labelled(docs, labels, per_class, seed)
    seen = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(seen) < 2:
        return Model({}, math.log((seen.get(1, 0) + 0.5) / (seen.get(0, 0) + 0.5)))
    features = selected(sample, least_rows, least_z, most_features)
    own, swapped = _rows(sample, features, swaps(terms))
    w = fit(own, swapped, len(features), weight, ridge, counterfactual).tolist()
    return Model({f: v for f, v in zip(features, w)}, w[-1])


class _Scorer:
    """Sums of weights of the distinct features of texts, looked up by distinct words."""

    def __init__(self, model: Model):
        self.intercept = model.intercept
        names = sorted({f.rstrip("\n") for f in model.weights})
        self.present, self.dense = (np.array([model.weights.get(n + end, 0.0) for n in names]) for end in ("", "\n"))
        self.whole = pa.array([n[:-1] if n.endswith(" ") else None for n in names], pa.large_string())
        self.begin = {k: pa.array([n if len(n) == k and n[-1] != " " else None for n in names], pa.large_string()) for k in PREFIXES}

    def scores(self, texts: list[str]) -> np.ndarray:
        split = [_WORD.findall(t.lower()) for t in texts]
        sizes = np.fromiter(map(len, split), np.int64, len(split))
        words = pa.array([w for own in split for w in own], pa.large_string()).dictionary_encode()
        place, names = words.indices.to_numpy(zero_copy_only=False), words.dictionary
        text = np.repeat(np.arange(len(texts)), sizes)
        length = pc.utf8_length(names).to_numpy(zero_copy_only=False)
        hits = [self._looked_up(names, self.whole)]
        hits += [np.where(length > k, self._looked_up(pc.utf8_slice_codeunits(names, 0, k), self.begin[k]), -1) for k in PREFIXES]
        pairs = []
        for hit in hits:
            at = np.flatnonzero(hit[place] >= 0) if len(hit) else np.zeros(0, np.int64)
            pairs.append(text[at] * max(len(self.present), 1) + hit[place[at]])
        # In the order of the features, so that the sum is the same everywhere.
        found, counts = np.unique(np.concatenate(pairs).astype(np.int64), return_counts=True)
        row, feature = np.divmod(found, max(len(self.present), 1))
        value = self.present[feature] + np.where(DENSE * counts > sizes[row], self.dense[feature], 0.0)
        total = self.intercept + np.bincount(row, value, len(texts))
        return np.array([_sigmoid(x) for x in total.tolist()])

    @staticmethod
    def _looked_up(names: pa.Array, known: pa.Array) -> np.ndarray:
        return pc.fill_null(pc.index_in(names, known, skip_nulls=True), -1).to_numpy(zero_copy_only=False).astype(np.int64)


def score(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """Every document with its fold, score and verdict."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(sent.value)
        for batch in batches:
            texts, found, held, size = batch.column("text").to_pylist(), [], [], 0
            for text in texts:
                if held and size + len(text or "") > _SLICE:
                    found.append(scorer.scores(held))
                    held, size = [], 0
                held.append(text or "")
                size += len(text or "")
            found.append(scorer.scores(held))
            value = pa.array(np.concatenate(found))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), value], ["doc_id", "held_out", "score"])

    checksum = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    rows = docs.select("doc_id", (checksum % 3 == 1).alias("held_out"), "text")
    scored = rows.mapInArrow(task, "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def toxicity(
    docs: DataFrame, labels: DataFrame, threshold: float = 0.7, id_column: str = "doc_id", text_column: str = "text",
    label_column: str = "toxic", **options,
) -> DataFrame:
    """Learn from the labelled rows whose checksum of the id leaves 0 or 2 divided by three, and score all rows."""
    rows = columns(docs, doc_id=id_column, text=text_column).withColumn("doc_id", F.col("doc_id").cast("long"))
    known = columns(labels, doc_id=id_column, toxic=label_column)
    known = known.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    return score(rows, train(rows, known, **options), threshold)
