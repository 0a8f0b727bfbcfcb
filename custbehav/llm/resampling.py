"""Importance resampling towards a target distribution, with a head-tail vocabulary.

Features are the words of a text and its pairs of neighbouring words; a feature's bucket is the CRC-32 of its
bytes modulo the number of buckets. The head of the vocabulary is broadcast: frequent words with the exact state
of their checksum, frequent pairs with their bucket. A pair outside the head continues the checksum from the
state its first word left, a word outside it takes its checksum directly. Both give the same bucket, so which
features are in the head decides the work and never the result.

1. Every task keeps the frequent words and pairs of its texts in summaries of bounded size (Misra and Gries: a
   feature with more than one part in ``capacity`` of a task's features is in its summary); the summaries are
   added up and the most frequent ones make the head.
2. Bucket totals of the corpus and of the target, added up in the task and then by bucket.
3. Every document's mean gain, a Gumbel key from its id, and the exact rank of the sum of both.

Null texts have no feature; a null id is an empty one and comes last among ties. Rows repeated with one id have one
score and ranks of their own. No rows give no rows; no target texts give gains from the corpus alone.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from custbehav.functions.ordering import running_totals
from custbehav.llm.common import columns, stored
from custbehav.llm.tokens import encoded, slices

# Entries of a task's summary, and of the head: for words and for pairs each.
CAPACITY, HEAD_WORDS, HEAD_PAIRS = 16_384, 32_768, 65_536
_BATCH = 65_536


def _pairs(sizes: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places that begin a pair, and per text the number of its pairs."""
    starts = np.ones(len(words), bool)
    starts[np.cumsum(sizes)[sizes > 0] - 1] = False
    return np.flatnonzero(starts), np.maximum(sizes - 1, 0)


class _Summary:
    """Frequent features with counts that are too low by the same amount at most."""

    def __init__(self, capacity: int):
        self.capacity, self.counts = capacity, {}

    def _cut(self, counts: np.ndarray) -> int:
        if len(counts) <= self.capacity:
            return 0
        return int(np.partition(counts, -self.capacity - 1)[-self.capacity - 1])

    def add(self, counts: np.ndarray, name) -> None:
        """Merge counts of features; ``name`` gives the feature at a place."""
        cut = self._cut(counts)
        for place in np.flatnonzero(counts > cut).tolist():
            feature = name(place)
            self.counts[feature] = self.counts.get(feature, 0) + int(counts[place]) - cut
        cut = self._cut(np.fromiter(self.counts.values(), np.int64, len(self.counts)))
        if cut:
            self.counts = {f: n - cut for f, n in self.counts.items() if n > cut}


def _frequent(texts: DataFrame, capacity: int) -> DataFrame:
    """Words and pairs (feature, n) that the summaries of the tasks hold, added up."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        single, double = _Summary(capacity), _Summary(capacity)
        for batch in batches:
            for _, own in slices(batch, "text"):
                sizes, words, names = encoded(own)
                names = names.to_pylist()
                single.add(np.bincount(words, minlength=len(names)), names.__getitem__)
                at, _ = _pairs(sizes, words)
                codes, both = pd.factorize(words[at] * len(names) + words[at + 1])
                double.add(
                    np.bincount(codes, minlength=len(both)),
                    lambda i: names[both[i] // len(names)] + b" " + names[both[i] % len(names)],
                )
        counts = [*single.counts.items(), *double.counts.items()]
        for low in range(0, len(counts), _BATCH):
            feature, n = zip(*counts[low : low + _BATCH])
            yield pa.RecordBatch.from_arrays([pa.array(feature, pa.binary()), pa.array(n, pa.int64())], ["feature", "n"])

    found = texts.mapInArrow(task, "feature binary, n long").groupBy("feature").agg(F.sum("n").alias("n"))
    return found.withColumn("is_pair", F.instr(F.col("feature").cast("string"), " ") > 0)


def head(texts: DataFrame, capacity: int = CAPACITY, words: int = HEAD_WORDS, pairs: int = HEAD_PAIRS) -> tuple[list, list]:
    """The most frequent words and pairs, at most so many; those with the counts of the last place may be left out."""
    found = stored(_frequent(texts, capacity))
    size = F.floor(F.log2("n") * 16)  # some hundred sizes, whatever the counts
    sizes = found.groupBy("is_pair", size.alias("size")).agg(F.count(F.lit(1)).alias("features")).collect()
    out = []
    for is_pair, room in ((False, words), (True, pairs)):
        least = math.inf
        for row in sorted((r for r in sizes if r["is_pair"] == is_pair), key=lambda r: -r["size"]):
            room -= row["features"]
            if room < 0:
                break
            least = row["size"]
        chosen = found.filter((F.col("is_pair") == is_pair) & (size >= least)) if least < math.inf else found.limit(0)
        out.append(sorted(bytes(r[0]) for r in chosen.select("feature").collect()))
    return out[0], out[1]


def vocabulary(head_words: list[bytes], head_pairs: list[bytes], buckets: int) -> dict:
    """What is broadcast: words with the state of their checksum, and pairs of their places with a bucket."""
    halves = [p.split(b" ", 1) for p in head_pairs]
    words = sorted({*head_words, *(w for pair in halves for w in pair)})
    place = {w: i for i, w in enumerate(words)}
    keys = np.array([place[a] * len(words) + place[b] for a, b in halves], np.int64)
    values = np.array([zlib.crc32(p) % buckets for p in head_pairs], np.int64)
    order = np.argsort(keys)
    return {
        "words": words, "states": np.fromiter(map(zlib.crc32, words), np.int64, len(words)),
        "pairs": keys[order], "buckets": values[order],
    }


class _Buckets:
    """Buckets of all features of texts, by the head where it has them."""

    def __init__(self, known: dict, buckets: int):
        self.known, self.buckets = known, buckets
        self.words = pa.array(known["words"], pa.large_binary())

    def of(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Words and pairs per text, and the buckets of both in the order of the texts."""
        sizes, words, names = encoded(texts)
        place = pc.fill_null(pc.index_in(names, self.words), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        names = names.to_pylist()
        states = self.known["states"][place] if len(self.words) else np.zeros(len(names), np.int64)
        for i in np.flatnonzero(place < 0).tolist():
            states[i] = zlib.crc32(names[i])
        at, n_pairs = _pairs(sizes, words)
        codes, both = pd.factorize(words[at] * max(len(names), 1) + words[at + 1])
        first, second = np.divmod(both, max(len(names), 1))
        found = np.full(len(both), -1, np.int64)
        if len(self.known["pairs"]):
            key = np.where((place[first] < 0) | (place[second] < 0), -1, place[first] * len(self.words) + place[second])
            near = np.minimum(np.searchsorted(self.known["pairs"], key), len(self.known["pairs"]) - 1)
            found = np.where(self.known["pairs"][near] == key, self.known["buckets"][near], -1)
        after = [zlib.crc32(b" ", state) for state in states.tolist()]
        tail = np.flatnonzero(found < 0)
        for i, a, b in zip(tail.tolist(), first[tail].tolist(), second[tail].tolist()):
            found[i] = zlib.crc32(names[b], after[a]) % self.buckets
        return sizes, n_pairs, (states % self.buckets)[words], found[codes]


def bucket_totals(texts: DataFrame, sent, buckets: int) -> np.ndarray:
    """Features per bucket over all texts, repeats counted."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, total = _Buckets(sent.value, buckets), np.zeros(buckets, np.int64)
        for batch in batches:
            for _, part in slices(batch, "text"):
                for found in own.of(part)[2:]:
                    total += np.bincount(found, minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    rows = texts.mapInArrow(task, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(buckets, np.int64)
    for row in rows:
        out[row["bucket"]] = row["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket the floor of a thousand times the logarithm of the smoothed ratio of the shares."""
    in_target, in_corpus = float(target.sum() + len(target)), float(corpus.sum() + len(corpus))
    ratio = lambda t, s: (t + 1.0) * in_corpus / ((s + 1.0) * in_target)
    return np.array([math.floor(1000 * math.log(ratio(t, s))) for t, s in zip(target.tolist(), corpus.tolist())], np.int64)


def weights(docs: DataFrame, sent, gain: np.ndarray) -> DataFrame:
    """Add words, features and the floored mean gain to the texts."""
    value = docs.sparkSession.sparkContext.broadcast(gain)

    def summed(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        ends = np.concatenate(([0], np.cumsum(values)))
        last = np.cumsum(sizes)
        return ends[last] - ends[last - sizes]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _Buckets(sent.value, len(value.value))
        for batch in batches:
            for part, texts in slices(batch, "text"):
                n_words, n_pairs, single, double = own.of(texts)
                features = n_words + n_pairs
                total = summed(value.value[single], n_words) + summed(value.value[double], n_pairs)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n_words), pa.array(features), pa.array(total // np.maximum(features, 1))],
                    ["doc_id", "n_words", "n_features", "weight"],
                )

    return docs.mapInArrow(task, "doc_id long, n_words long, n_features long, weight long")


def ranked(scored: DataFrame, percent: int, least_words: int) -> DataFrame:
    """Add ``rank`` to the highest scores among the texts of enough words; ties go to the smaller id.

    Rows with one id and score are ranked together and dealt their ranks afterwards.
    """
    draws = scored.filter(F.col("n_words") >= least_words).count() * percent // 100
    copies = scored.filter(F.col("n_words") >= least_words)
    copies = copies.groupBy("doc_id", "n_words", "n_features", "weight", "score").agg(F.count(F.lit(1)).alias("copies"))
    # Descending by score and ascending by id; equal ids with different texts are told apart by what they hold.
    order = F.struct(
        (-F.col("score")).alias("a"), F.col("doc_id").isNull().alias("b"), F.col("doc_id").alias("c"),
        F.col("n_words").alias("d"), F.col("n_features").alias("e"), F.col("weight").alias("f"),
    )
    placed = running_totals(copies.withColumn("order", order), [], "order", -F.col("score"), ["copies"])
    each = placed.select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"))
    place = F.col("copies_before") + F.col("copy")
    drawn = each.select("doc_id", "n_features", "weight", "score", F.when(place <= draws, place).alias("rank"))
    short = scored.filter(F.col("n_words") < least_words).select("doc_id", "n_features", "weight", "score")
    return drawn.unionByName(short.withColumn("rank", F.lit(None).cast("long")))


def resample(
    docs: DataFrame, target: DataFrame, buckets: int = 10_000, percent: int = 25, least_words: int = 20, seed: int = 7,
    id_column: str = "doc_id", text_column: str = "text", **sizes,
) -> DataFrame:
    """Every document with its number of features, weight, score and, if it is drawn, its rank."""
    rows = columns(docs, doc_id=id_column, text=text_column).withColumn("doc_id", F.col("doc_id").cast("long"))
    wanted = columns(target, text=text_column)
    sent = rows.sparkSession.sparkContext.broadcast(vocabulary(*head(rows.select("text"), **sizes), buckets))
    corpus, aim = (bucket_totals(texts.select("text"), sent, buckets) for texts in (rows, wanted))
    weighed = weights(rows, sent, gains(corpus, aim))
    digits = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digits, 1, 8), 16, 10).cast("double")
    key = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))
    return ranked(stored(weighed.withColumn("score", F.col("weight") + key)), percent, least_words)
