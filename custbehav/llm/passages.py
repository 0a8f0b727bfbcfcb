"""Repeated passages: overlapping paragraphs of whole texts by MinHash banding, exact Jaccard, components.

Paragraphs are all stretches of ``seed + spread - 1`` = 22 words, wherever lines end. Each has a MinHash of one row, its band key: the
least hash of its ten-word shingles; neighbours mostly share it, so a text has a key about every seven words. The bands are
tuned to lose nothing: two passages of 25 words or more whose five-word shingles have a Jaccard similarity of
0.8 hold at least 22 equal words in a row (to break the row inside a passage of n words costs four shingles of one side
and five of the other, and so needs n >= 44), and those share a key.

Of every key the first occurrence is the centre, and the others are compared with it. Keys of two documents that lie at one
distance are one comparison, in blocks of ``BLOCK`` words of the centre's document. The words around are
cut from the texts once per round. The passage is the longest stretch around the key whose exact similarity reaches the threshold. Where the
centre is not similar, or differs inside the 22 words, the 22-word stretches around the key become keys of the next round, and
where this is so again, those with the words beside them (``wider_keys``). So occurrences that share nothing but a phrase part,
whatever their number; what some rounds of centres leave is compared pair by pair inside a wider key.
A dense group of any size costs one comparison per member and key distance.

Similar stretches of a document that overlap are one passage; links between passages make components, the units of
removal, of which the first passage is kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from custbehav.llm.common import columns, stored
from custbehav.llm.components import components

_SEED = 20240611
# A side of a join with up to so many rows is broadcast.
BROADCAST_ROWS = 200_000
# Words of the centre's document that are compared at once, and the words looked at on either side.
BLOCK, AROUND = 512, 64


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x9FB21C651E98DF25)
    return x ^ (x >> np.uint64(32))


def _coefficients(n: int, kind: int) -> np.ndarray:
    return np.random.default_rng((_SEED, kind)).integers(0, 1 << 64, n, np.uint64) | np.uint64(1)


_ORDER = _coefficients(64, 1)


def _word_keys(text: str | None) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    words = (text or "").encode("utf-8", "replace").lower().split()
    return np.fromiter(map(digest, words), np.uint64, len(words))


def _grams(keys: np.ndarray, n: int) -> np.ndarray:
    """Keys of all n-word shingles; a shorter text has none. Shingles of 1, 2, 4... words are put together."""
    m = len(keys) - n + 1
    if m <= 0:
        return np.array([], np.uint64)
    out, done, part, size, level = None, 0, keys, 1, 0
    while True:
        if n & size:
            piece = part[done : done + m]
            out = piece if out is None else out * _ORDER[32 + level] + piece
            done += size
        if done == n:
            return _mixed(out + np.uint64(n))
        part = part[: len(part) - size] * _ORDER[level] + part[size:]
        size, level = size * 2, level + 1


def _sliding(values: np.ndarray, width: int, least: np.ufunc) -> np.ndarray:
    """The least (or greatest) of every ``width`` neighbours."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = least(out[: len(out) - step], out[step:])
        have += step
    return out


def band_places(keys: np.ndarray, seed: int, spread: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and values of the band keys of a text: the least shingle hashes of its paragraphs, each value once."""
    marks = _grams(keys, seed)
    if len(marks) < spread:
        return np.array([], np.int64), np.array([], np.uint64)
    least = _sliding(marks, spread, np.minimum)
    nothing = np.zeros(spread - 1, np.uint64)
    greatest = _sliding(np.concatenate([nothing, least, nothing]), spread, np.maximum)
    starts = np.flatnonzero(greatest == marks)
    first = np.sort(np.unique(marks[starts], return_index=True)[1])
    return starts[first], marks[starts[first]]


PLACES = "key long, doc_id long, start int"


def _places(docs: DataFrame, least_words: int, seed: int, spread: int) -> DataFrame:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                part = batch.slice(low, 512)
                starts, values = [], []
                for text in part.column(1).to_pylist():
                    keys = _word_keys(text)
                    found = band_places(keys if len(keys) >= least_words else keys[:0], seed, spread)
                    starts.append(found[0].astype(np.int32))
                    values.append(found[1])
                rows = pa.array(np.repeat(np.arange(len(starts)), [len(s) for s in starts]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(values).view(np.int64)), part.column(0).take(rows), pa.array(np.concatenate(starts))],
                    ["key", "doc_id", "start"],
                )

    return docs.mapInArrow(task, PLACES)


def _small(rows: DataFrame) -> DataFrame:
    """``rows``, a written table, broadcast if they are few; else the join shuffles both sides."""
    return F.broadcast(rows) if rows.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else rows


def _with_centres(places: DataFrame) -> DataFrame:
    """Every occurrence of a key beside the first one, of another document."""
    centres = places.groupBy("key").agg(F.min(F.struct("doc_id", "start")).alias("c"), F.max("doc_id").alias("_last"))
    centres = centres.filter("c.doc_id <> _last").select("key", F.col("c.doc_id").alias("to_id"), F.col("c.start").alias("to_start"))
    return places.join(centres, "key").filter("doc_id <> to_id")


def _in_pairs(places: DataFrame) -> DataFrame:
    other = places.select("key", F.col("doc_id").alias("to_id"), F.col("start").alias("to_start"))
    return places.join(other, "key").filter("doc_id > to_id")


PIECES = "to_id long, block int, doc_id long, shift int, base int, words binary, seeds array<struct<start:int,key:long>>"


def _pieces(docs: DataFrame, met: DataFrame, size: int) -> DataFrame:
    """The words around the keys of both sides, cut from each text once; the centre's pieces have no doc_id."""
    block, shift = F.floor(F.col("to_start") / BLOCK).cast("int"), F.col("start") - F.col("to_start")
    seeds = F.collect_set(F.struct("start", "key")).alias("seeds")
    pairs = stored(met.groupBy("doc_id", "to_id", block.alias("block"), shift.alias("shift")).agg(seeds))
    own = pairs.select("doc_id", F.struct("to_id", "block", "shift", "seeds").alias("r"))
    empty = [F.lit(None).cast(kind).alias(name) for name, kind in own.select("r.*").dtypes if name in ("to_id", "shift", "seeds")]
    centres = pairs.select(F.col("to_id").alias("doc_id"), "block").distinct()
    centres = centres.select("doc_id", F.struct(empty[0], "block", *empty[1:]).alias("r"))
    wanted = stored(own.unionByName(centres).groupBy("doc_id").agg(F.collect_list("r").alias("wanted")))

    def cut(doc_id, words, r):
        if r["seeds"] is None:
            low, high = r["block"] * BLOCK - AROUND, (r["block"] + 1) * BLOCK + size + AROUND
            to_id, doc_id = doc_id, None
        else:
            starts = [s["start"] for s in r["seeds"]]
            low, high, to_id = min(starts) - AROUND, max(starts) + size + AROUND, r["to_id"]
        low = max(low, 0)
        return to_id, r["block"], doc_id, r["shift"], low, words[low:high].tobytes(), r["seeds"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds_type = pa.list_(pa.struct([("start", pa.int32()), ("key", pa.int64())]))
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), seeds_type)
        names = ["to_id", "block", "doc_id", "shift", "base", "words", "seeds"]
        for batch in batches:
            for low in range(0, batch.num_rows, 64):
                rows = []
                for row in batch.slice(low, 64).to_pylist():
                    words = (_word_keys(row["text"]) >> np.uint64(32)).astype(np.uint32)
                    rows += [cut(row["doc_id"], words, r) for r in row["wanted"]]
                values = list(zip(*rows)) or [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], names)

    texts = docs.join(_small(stored(wanted.select("doc_id"))), "doc_id", "left_semi").join(wanted, "doc_id")
    return stored(texts.select("doc_id", "text", "wanted").mapInArrow(task, PIECES))


def _loss(threshold: float) -> int:
    """What a shingle that only one side has costs, in shingles that both have."""
    return round(2 * threshold / (1 - threshold)) if threshold < 1 else 10**6


def similar_stretch(grams_a, grams_b, shared, start, size, shift, shingle, threshold, least_words):
    """The longest similar stretch around the ``size`` words at ``start``: (low, high) in ``a`` and in ``b``, or None.

    The sides are given by their shingles; ``shared`` tells which of ``a`` the other side has. ``shift`` is how far the words stand later in ``a``. A shingle counts 1 if the other side has it, else the
    loss that its like on both sides costs at the threshold; the stretch is the longest one with a sum of 0 or more
    that passes the exact test; failing that, the same along equal places, and the equal words around the key.
    """
    low, high = start, start + size - shingle + 1
    if low < 0 or high > len(grams_a):
        return None
    beside = np.zeros(len(grams_a), bool)
    first, last = max(shift, 0), min(len(grams_a), len(grams_b) + shift)
    if last > first:
        beside[first:last] = grams_a[first:last] == grams_b[first - shift : last - shift]
    if not beside[low:high].all():
        return None
    loss = _loss(threshold)
    for equal, cost in ((shared, loss), (beside, loss), (beside, 10**6)):
        sums = np.concatenate([[0], np.cumsum(np.where(equal, 1, -cost))])
        ahead = np.maximum.accumulate(sums[high:][::-1])[::-1]
        ends = high + np.searchsorted(-ahead, -sums[: low + 1], side="right") - 1
        ends = np.where(ends >= high, ends, -1)
        i = int(np.argmax(ends - np.arange(low + 1)))
        inside = np.flatnonzero(equal[i : int(ends[i])]) + i
        i, j = int(inside[0]), int(inside[-1])
        p, q = (at[np.argmin(np.abs(at - (k - shift)))] for k in (i, j) for at in (np.flatnonzero(grams_b == grams_a[k]),))
        if min(j - i, q - p) + shingle < least_words:
            continue
        one, two = np.unique(grams_a[i : j + 1]), np.unique(grams_b[p : q + 1])
        both = len(np.intersect1d(one, two, assume_unique=True))
        if both >= threshold * (len(one) + len(two) - both) - 1e-9:
            return i, j + shingle, int(p), int(q) + shingle
    return None


COMPARED = "doc_id long, start int, end int, to_id long, to_start int, to_end int, key long"


def _wider_keys(words: np.ndarray, starts: np.ndarray, row: int) -> tuple[np.ndarray, np.ndarray]:
    """``wider_keys`` of many places: the number of the place in ``starts``, and the key."""
    own, wide, beyond = _grams(words, row), _grams(words, row + 3), _grams(words, 14)
    number, places, out = np.flatnonzero(starts < len(own)), [], []
    starts, own = starts[number], own[starts[number]]
    for back in range(4):
        at = starts - back
        here = (at >= 0) & (at < len(wide))
        places.append(number[here])
        out.append(wide[at[here]] + np.uint64(back))
    for side, first in ((5, row + 3), (6, -14 - 5)):
        for at in (starts + first, starts + first + 1, starts + first + 2):
            here = (at >= 0) & (at < len(beyond))
            places.append(number[here])
            out.append(own[here] * _ORDER[20] + beyond[at[here]] * _ORDER[21] + np.uint64(side))
    return np.concatenate(places), _mixed(np.concatenate(out)).view(np.int64)


def wider_keys(words: np.ndarray, start: int, row: int) -> list[int]:
    """Keys of the ``row`` = 22 words at ``start`` together with what stands beside them.

    Similar passages that share these words and no 25 in a row have 44 to 49 words and one break, within three words of these;
    beyond it at least 19 words are equal, and stand at most one word nearer or farther. So the keys are the four stretches of
    25 words, and the words with 14 others on either side in three places; similar passages share one of them.
    """
    return _wider_keys(words, np.array([start]), row)[1].tolist()


def _compared(
    pieces: DataFrame, size: int, row: int, widen: bool, shingle: int, threshold: float, least_words: int
) -> DataFrame:
    """Similar stretches, and (without ``to_id``) the keys for the next round.

    ``row`` is the length of the stretches that are keys of the next round; where the keys have it already they are kept, or
    replaced by wider ones (``widen``).
    """

    # A similar stretch has so many shingles that stand on the other side as well.
    least = -(-(least_words - shingle + 1) * _loss(threshold) // (_loss(threshold) + 1))

    def rows_of(r, other):
        """Similar stretches, and the places and keys for the next round."""
        a, (b, grams_b) = np.frombuffer(r["words"], np.uint32).astype(np.uint64), other
        shift = r["shift"] - r["base"] + r["to_base"]
        equal, first, last = np.zeros(len(a), np.int64), max(shift, 0), min(len(a), len(b) + shift)
        if last > first:
            equal[first:last] = a[first:last] == b[first - shift : last - shift]
        sums, until = np.concatenate([[0], np.cumsum(equal)]), -1
        grams_a = _grams(a, shingle)
        shared = np.isin(grams_a, grams_b)
        hopeless = np.count_nonzero(shared) < least
        rows, next_keys, same, widened = [], set(), [], []
        for seed in sorted(r["seeds"], key=lambda s: s["start"]):
            start, failed = seed["start"] - r["base"], False
            if start + size > until:
                found = None
                if not hopeless:
                    found = similar_stretch(grams_a, grams_b, shared, start, size, shift, shingle, threshold, least_words)
                failed = found is None
                if found:
                    until = found[1]
                    own, to = (found[0] + r["base"], found[1] + r["base"]), (found[2] + r["to_base"], found[3] + r["to_base"])
                    rows.append((r["doc_id"], *own, r["to_id"], *to))
            if size == row:
                low, high = max(start - 2 * least_words, 0), min(start + row + 2 * least_words, len(a))
                if failed and not widen:
                    same.append((start, seed["key"]))
                elif widen and (failed or sums[high] - sums[low] < high - low):
                    widened.append(start)
                continue
            low, high = max(start + size - row, 0), min(start + row, len(a))
            if failed or sums[high] - sums[low] < high - low:
                differ = sums[low + row : high + 1] - sums[low : high + 1 - row] < row
                next_keys.update((low + np.flatnonzero(differ | failed)).tolist())
        starts, keys = (np.array(x, np.int64) for x in (zip(*same) if same else ((), ())))
        if next_keys:
            starts = np.array(sorted(next_keys))
            keys = _grams(a, row).view(np.int64)[starts]
        if widened:
            number, keys = _wider_keys(a, np.array(widened), row)
            starts = np.array(widened)[number]
        return rows, starts + r["base"], keys

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32())
        names = ["doc_id", "start", "end", "to_id", "to_start", "to_end", "key"]
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part, others, rows, ids, starts, keys = batch.slice(low, 256), {}, [], [], [], []
                for r in part.to_pylist():
                    if r["to_words"] not in others:
                        b = np.frombuffer(r["to_words"], np.uint32).astype(np.uint64)
                        others[r["to_words"]] = b, _grams(b, shingle)
                    found, own_starts, own_keys = rows_of(r, others[r["to_words"]])
                    rows += found
                    ids.append(np.full(len(own_keys), r["doc_id"], np.int64))
                    starts.append(own_starts)
                    keys.append(own_keys)
                values = list(zip(*rows)) or [()] * len(kinds)
                yield pa.RecordBatch.from_arrays([*(pa.array(v, k) for v, k in zip(values, kinds)), pa.nulls(len(rows), pa.int64())], names)
                n = sum(map(len, keys))
                columns = [np.concatenate(ids), np.concatenate(starts).astype(np.int32), np.concatenate(keys)]
                empty = [pa.nulls(n, kind) for kind in kinds[2:]]
                yield pa.RecordBatch.from_arrays([*map(pa.array, columns[:2]), *empty, pa.array(columns[2])], names)

    centres = pieces.filter("doc_id is null").select(
        "to_id", "block", F.col("base").alias("to_base"), F.col("words").alias("to_words")
    )
    return pieces.filter("doc_id is not null").join(centres, ["to_id", "block"]).mapInArrow(task, COMPARED)


def _passages(links: DataFrame, shingle: int) -> tuple[DataFrame, DataFrame]:
    """Passages (node, doc_id, start, n_words), and links between their nodes."""
    sides = links.select("doc_id", "start", "end").unionByName(
        links.select(F.col("to_id").alias("doc_id"), F.col("to_start").alias("start"), F.col("to_end").alias("end"))
    )
    order = Window.partitionBy("doc_id").orderBy("start", "end")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    apart = (before.isNull() | (F.col("start") + shingle > before)).cast("int")
    numbered = sides.distinct().withColumn("_new", apart).withColumn("_n", F.sum("_new").over(order))
    numbered = stored(numbered.select("doc_id", "start", "end", F.xxhash64("doc_id", "_n").alias("node")))
    passages = numbered.groupBy("node", "doc_id").agg(F.min("start").alias("start"), F.max("end").alias("_end"))
    one = numbered.withColumnRenamed("node", "a")
    two = numbered.toDF("to_id", "to_start", "to_end", "b")
    joined = links.join(one, ["doc_id", "start", "end"]).join(two, ["to_id", "to_start", "to_end"]).select("a", "b").distinct()
    return passages.select("node", "doc_id", "start", (F.col("_end") - F.col("start")).alias("n_words")), joined


def repeated_passages(
    docs: DataFrame,
    least_words: int = 25,
    shingle: int = 5,
    threshold: float = 0.8,
    seed: int = 10,
    spread: int = 13,
    rounds: int = 4,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per passage of a document that is similar to one of another document.

    ``doc_id``, ``start`` (words before it) and ``n_words`` say where, ``component_id`` is
    the least doc_id that has a passage of its component, ``n_documents`` how many documents have one, ``kept`` is
    true for the first passage of the component (by doc_id, then start) only. Passages have ``least_words`` words at least and go
    over line ends; letters A-Z count in either case. Null and blank texts have none; what repeats inside a document only
    is not reported; rows that repeat an id are one document; rows with a
    null id are not compared; an empty table gives no rows. ``rounds`` (2 at least) decides the work only.
    """
    rows_in = columns(docs, doc_id=id_column, text=text_column)
    rows_in = rows_in.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("doc_id is not null")
    row = seed + spread - 1
    places, size, links = stored(_places(rows_in, least_words, seed, spread)), seed, None
    for turn in range(rounds + 1):
        met = _with_centres(places) if turn < rounds else _in_pairs(places)
        compared = stored(_compared(_pieces(rows_in, met, size), size, row, turn == 1, shingle, threshold, least_words))
        found = compared.filter("to_id is not null").drop("key")
        links = found if links is None else links.unionByName(found)
        places, size = stored(compared.filter("to_id is null").select("key", "doc_id", "start").distinct()), row
        if places.isEmpty():
            break
    passages, joined = _passages(links.distinct(), shingle)
    roots = stored(components(joined, "a", "b"))
    placed = stored(passages.join(roots, "node").select("root", "doc_id", "start", "n_words"))
    per_document = placed.groupBy("root", "doc_id").agg(F.min("start").alias("start"))
    groups = per_document.groupBy("root").agg(F.min(F.struct("doc_id", "start")).alias("f"), F.count(F.lit(1)).alias("n_documents"))
    return placed.join(_small(stored(groups)), "root").select(
        "doc_id", "start", "n_words", F.col("f.doc_id").alias("component_id"), "n_documents",
        ((F.col("doc_id") == F.col("f.doc_id")) & (F.col("start") == F.col("f.start"))).alias("kept"),
    )
