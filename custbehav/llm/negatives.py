"""Hard negatives by a secondary-sort shuffle.

Rows are packed into blocks, anchors into blocks of their own, and every block of anchors meets every block of rows;
one matrix product gives the scores of both. What leaves a product are keys (anchor, descending score, kind, id), dealt
by anchor and sorted inside the partitions (the DataFrame form of repartitionAndSortWithinPartitions), so that an
iterator reads an anchor's rows from the highest score down and holds its open windows only, never its rows.

1. Positives: a block passes on its first rows of an anchor's label, as many as are wanted at most; the first ones in the
   sorted order are the anchor's positives.
2. Negatives: the positives go back to the anchors. A block passes on the first rows of other labels inside each
   positive's window of scores. In the sorted order a positive opens its window, and every negative that follows is
   emitted to the open windows that reach down to its score until they have enough. Positives stand before negatives of
   an equal score.

What a block leaves out comes after enough others of the same block, so the result is exact, and an anchor sends the
shuffle a number of rows per block that is bounded by the parameters, however many rows share its label.

Rows without id, label or vector, or with a null or non-finite component, take no part. Rows that are equal in all three
count once; rows that share an id otherwise are rows of their own, but never partners of one another. Missing components
of a shorter vector are zero. Scores are exact integers; one beyond 64 bits becomes the nearest 64-bit number.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from custbehav.llm.common import columns, stored

_ROWS, _ANCHORS, _GROUP = 4096, 1024, 4
_LONG = np.iinfo(np.int64)


def finite(vector: Column) -> Column:
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def _whole(x: float, scale: int) -> int:
    """The floor of a scaled number; the scale is a power of two, so only the range can be exceeded."""
    return int(x) * scale if abs(x) >= 2.0**52 else math.floor(x * scale)


def _packed(vectors: pa.Array, scale: int) -> tuple[int, bytes, str]:
    """Whole components side by side, in the narrowest type that holds them; shorter vectors end in zeros."""
    sizes = np.diff(vectors.offsets.to_numpy())
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    dim = int(sizes.max(initial=0))
    largest = float(np.abs(values).max(initial=0.0))
    if largest * scale >= 2.0**62:
        whole = [str(_whole(x, scale)) for x in values.tolist()]
        ends = np.cumsum(sizes).tolist()
        rows = [whole[end - size : end] + ["0"] * (dim - size) for end, size in zip(ends, sizes.tolist())]
        return dim, ",".join(x for row in rows for x in row).encode(), "wide"
    out = np.zeros((len(sizes), dim), np.int64)
    out[np.arange(dim)[None, :] < sizes[:, None]] = np.floor(values * scale).astype(np.int64)
    kind = next(k for k in ("int16", "int32", "int64") if np.abs(out).max(initial=0) <= np.iinfo(k).max)
    return dim, out.astype(kind).tobytes(), kind


def _unpacked(raw: bytes, n: int, dim: int, kind: str) -> np.ndarray:
    if kind == "wide":
        return np.array([int(x) for x in raw.split(b",") if x], object).reshape(n, dim)
    return np.frombuffer(raw, kind).astype(np.int64).reshape(n, dim)


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of both, exact as whole numbers."""
    dim = min(a.shape[1], b.shape[1])
    a, b = a[:, :dim], b[:, :dim]
    largest = [int(np.abs(x).max()) if x.size else 0 for x in (a, b)]
    bound = largest[0] * largest[1] * dim
    if bound < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if bound < 2**63:
        return a.astype(np.int64) @ b.astype(np.int64).T
    exact = a.astype(object) @ b.astype(object).T
    return np.clip(exact, int(_LONG.min), int(_LONG.max)).astype(np.int64)


_BLOCK = "block long, n long, dim long, kind string, rows binary, ids binary, labels binary, vectors binary, lows binary, highs binary"
_KEYS = "anchor long, descending long, negative boolean, id long, score long"


def _names(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(", ")]


def _blocks(rows: DataFrame, size: int, slots: int, scale: int) -> DataFrame:
    """Rows (vec_id, label, vector, and for anchors row, windows) in blocks, each in the order of the ids."""
    anchors = "windows" in rows.columns

    def block(table: pa.Table, number: int) -> pa.RecordBatch:
        table = table.combine_chunks().sort_by("vec_id")
        n = len(table)
        dim, raw, kind = _packed(table.column("vector").combine_chunks(), scale)
        own = np.array(table.column("row").to_pylist(), np.int64) if anchors else number * _ROWS + np.arange(n)
        low, high = np.ones((n, slots), np.int64), np.zeros((n, slots), np.int64)  # an empty window
        for i, windows in enumerate(table.column("windows").to_pylist() if anchors else []):
            for slot, score in enumerate(windows or []):
                low[i, slot], high[i, slot] = lowest(score), score
        binary = [own, *(table.column(c).to_numpy() for c in ("vec_id", "label"))]
        held = [number, n, dim, kind, *(np.asarray(x, np.int64).tobytes() for x in binary), raw, low.tobytes(), high.tobytes()]
        types = [pa.int64()] * 3 + [pa.string()] + [pa.binary()] * 6
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(held, types)], _names(_BLOCK))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, held, n = TaskContext.get().partitionId() << 24, [], 0
        for batch in batches:
            while len(batch):
                part = batch.slice(0, size - n)
                held, n, batch = [*held, part], n + len(part), batch.slice(len(part))
                if n == size:
                    yield block(pa.Table.from_batches(held), number)
                    number, held, n = number + 1, [], 0
        if n:
            yield block(pa.Table.from_batches(held), number)

    return rows.mapInArrow(task, _BLOCK)


def lowest(positive: int) -> int:
    """The least negative score of a positive's window: 80 percent, rounded up."""
    return -(-80 * positive // 100)


def _first(score: np.ndarray, wanted: np.ndarray, count: int) -> np.ndarray:
    """Per row the places of its first ``count`` wanted scores, descending, then by place; as a mask."""
    out = wanted.copy()
    for i in np.flatnonzero(wanted.sum(axis=1) > count).tolist():
        at = np.flatnonzero(wanted[i])
        own = score[i, at]
        least = np.partition(own, len(at) - count)[len(at) - count]
        ties = at[own == least]
        out[i] = False
        out[i, at[own > least]] = True
        out[i, ties[: count - int((own > least).sum())]] = True
    return out


def _candidates(met: DataFrame, count: int, negative: bool) -> DataFrame:
    """Keys of what a block of rows can add to the anchors of a block."""

    def pair(a: dict, b: dict) -> pa.RecordBatch:
        score = scores(*(_unpacked(x["vectors"], x["n"], x["dim"], x["kind"]) for x in (a, b)))
        ids, others = (np.frombuffer(x["ids"], np.int64) for x in (a, b))
        same = np.frombuffer(a["labels"], np.int64)[:, None] == np.frombuffer(b["labels"], np.int64)[None, :]
        apart = ids[:, None] != others[None, :]
        if negative:
            chosen = np.zeros(score.shape, bool)
            for low, high in zip(*(np.frombuffer(a[x], np.int64).reshape(a["n"], -1).T for x in ("lows", "highs"))):
                chosen |= _first(score, apart & ~same & (low[:, None] <= score) & (score <= high[:, None]), count)
        else:
            chosen = _first(score, apart & same, count)
        at, place = np.nonzero(chosen)
        found = score[at, place]
        anchor = np.frombuffer(a["rows"], np.int64)[at]
        kind = pa.array(np.full(len(at), negative))
        return pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(~found), kind, pa.array(others[place]), pa.array(found)], _names(_KEYS))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                yield pair(row["a"], row["b"])

    return met.mapInArrow(task, _KEYS)


def _in_order(keys: DataFrame) -> DataFrame:
    """All keys of an anchor in one partition, from its highest score down."""
    return keys.repartition("anchor").sortWithinPartitions("anchor", "descending", "negative", "id")


def _positives(keys: DataFrame, count: int) -> DataFrame:
    """The first keys of every anchor."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, seen = None, 0
        for batch in batches:
            kept = []
            for anchor in batch.column("anchor").to_pylist():
                current, seen = (anchor, seen + 1) if anchor == current else (anchor, 1)
                kept.append(seen <= count)
            yield batch.filter(pa.array(kept, pa.bool_()))

    return _in_order(keys).mapInArrow(task, _KEYS)


_FOUND = "anchor long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def _mined(keys: DataFrame, count: int) -> DataFrame:
    """Read the keys in order: positives open windows, negatives are emitted to the open ones."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, windows = None, []  # per window: the positive, its score, the least score, negatives emitted
        for batch in batches:
            out = []
            for anchor, _, negative, vec_id, score in zip(*(c.to_pylist() for c in batch.columns)):
                if anchor != current:
                    current, windows = anchor, []
                if not negative:
                    windows.append([vec_id, score, lowest(score), 0])
                    continue
                windows = [w for w in windows if w[3] < count and w[2] <= score]
                for window in windows:
                    if score <= window[1]:  # not so for a score below zero, whose window is empty
                        window[3] += 1
                        out.append((anchor, window[0], window[3], vec_id, window[1], score))
            names = _names(_FOUND)
            cells = zip(*out) if out else [[] for _ in names]
            types = [pa.int32() if name == "rank" else pa.int64() for name in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cells, types)], names)

    return _in_order(keys).mapInArrow(task, _FOUND)


def _met(anchors: DataFrame, rows: DataFrame, groups: int) -> DataFrame:
    """Every block of anchors beside every block of rows: the anchors are dealt to each group of blocks of rows."""
    left = anchors.select(F.struct("*").alias("a"), F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"))
    right = rows.select(F.struct("*").alias("b"), F.pmod(F.xxhash64("block"), F.lit(groups)).cast("int").alias("group"))
    return left.join(right, "group").select("a", "b")


def hard_negatives(
    vectors: DataFrame, positives: int = 5, negatives: int = 5, anchor_step: int = 100, shift_step: int = 7, labels: int = 10,
    scale: int = 256, id_column: str = "vec_id", label_column: str = "label", vector_column: str = "embedding",
) -> DataFrame:
    """Per anchor (an id divisible by ``anchor_step``) and positive the first negatives of the positive's window."""
    rows = columns(vectors, vec_id=id_column, label=label_column, vector=vector_column)
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite(F.col("vector")))
    label, vec_id = F.col("label").cast("long"), F.col("vec_id").cast("long")
    rows = rows.select(
        vec_id.alias("vec_id"),
        F.when(vec_id % shift_step == 0, (label + 1) % labels).otherwise(label).alias("label"),
        # Zeros of both signs are one number.
        F.transform("vector", lambda x: x.cast("double") + F.lit(0.0)).alias("vector"),
    ).distinct()
    rows = stored(rows)

    number = F.monotonically_increasing_id()
    anchors = stored(rows.filter(F.col("vec_id") % anchor_step == 0).withColumn("row", number))
    parts = max(1, -(-anchors.count() // _ANCHORS))
    blocks = stored(_blocks(rows, _ROWS, positives, scale))
    groups = max(1, -(-blocks.count() // _GROUP))

    def packed(windows: DataFrame) -> DataFrame:
        return _blocks(windows.repartition(parts, "row"), _ANCHORS, positives, scale)

    none = F.array().cast("array<long>")
    first = _candidates(_met(packed(anchors.withColumn("windows", none)), blocks, groups), positives, negative=False)
    chosen = stored(_positives(first, positives))
    # As many scores per anchor as it has positives.
    windows = chosen.groupBy(F.col("anchor").alias("row")).agg(F.collect_list("score").alias("windows"))
    opened = anchors.join(windows, "row")
    second = _candidates(_met(packed(opened), blocks, groups), negatives, negative=True)
    mined = _mined(chosen.unionByName(second), negatives)
    named = mined.join(anchors.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id")), "anchor")
    return named.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
