"""Near-duplicate vectors by sorted projection passes.

A pass gives every vector a code, the signs of its projections on random directions put side by side, and
orders all vectors by it; those with close directions share leading signs and come to lie near each other.
Every vector is compared with a bounded number of followers in each order, all passes in one sort by (pass,
code), and pairs of a cosine over the threshold are links. The number of passes follows from the number of
vectors, so that a pair just at the threshold is met with the same chance at every size. Equal vectors are one
class before that, and their copies only a number.

The windows find most components. A component whose vectors all lie within half the threshold's angle of its
middle has all pairs linked, which takes one comparison per vector, so large dense groups cost no more than others.

All other links, inside wider components or between components the windows left apart, are found exactly: all
vectors are cut into blocks around centres, two blocks are compared if the angle between their middles is at most
the threshold's and both radii, and of each comparison only numbers and the edges of a spanning forest are kept.
So no link is lost at any size; where the vectors have no clusters no angle rules a pair of blocks out, and this
step compares all pairs. Blocks grow with the table instead of becoming more, so what is known of all of them,
a middle and a radius each, has a bound.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from custbehav.llm.common import columns, stored
from custbehav.llm.components import components

_CODE_BITS = 62
# Vectors of a block at least, and blocks at most (but for those that ends of cells, components and partitions add).
_BLOCK, _MOST_BLOCKS = 1024, 1 << 15
# Vectors of two blocks are compared by tiles of so many rows.
_TILE = 2048
# Blocks are compared by pairs of groups of them: bytes of a group, groups in a small table, and centres at most.
_GROUP_BYTES, _GROUPS, _CENTRES = 32 << 20, 6, 1024
# Components whose sums a task holds at a time.
_SUMS = 4096
# Radians by which a bound must clear the threshold; rounding of an angle is far below.
_MARGIN = 1e-6


def usable(vector: Column) -> Column:
    """Not null, not zero, all components present and finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _unit(raw: list[bytes], dim: int) -> np.ndarray:
    own = np.frombuffer(b"".join(raw)).reshape(len(raw), dim)
    own = own / np.abs(own).max(axis=1, keepdims=True)
    return own / np.linalg.norm(own, axis=1, keepdims=True)


def _coded(classes: DataFrame, passes: int, seed: int) -> DataFrame:
    """One row per class and pass with its code."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        directions: dict[int, np.ndarray] = {}
        weights = np.left_shift(np.int64(1), np.arange(_CODE_BITS - 1, -1, -1, dtype=np.int64))
        for batch in batches:
            nodes, dims, raw = (batch.column(i).to_pylist() for i in range(3))
            for dim in sorted(set(dims)):
                at = [i for i, d in enumerate(dims) if d == dim]
                if dim not in directions:
                    generator = np.random.default_rng((seed, dim))
                    directions[dim] = generator.standard_normal((passes, dim, _CODE_BITS))
                for low in range(0, len(at), 512):
                    part = at[low : low + 512]
                    own, picked = [raw[i] for i in part], pa.array([nodes[i] for i in part], pa.int64())
                    unit = _unit(own, dim)
                    for number in range(passes):
                        code = ((unit @ directions[dim][number]) > 0) @ weights
                        fixed = [pa.array(np.full(len(part), v, np.int64)) for v in (dim, number)]
                        yield pa.RecordBatch.from_arrays(
                            [*fixed, pa.array(code), picked, pa.array(own, pa.binary())], ["dim", "pass", "code", "node", "vector"]
                        )

    return classes.select("node", "dim", "vector").mapInArrow(
        task, "dim long, pass long, code long, node long, vector binary"
    )


def _close(groups: np.ndarray, nodes: np.ndarray, units: np.ndarray, first: int, window: int, threshold: float):
    """Pairs (a, b) of rows ``first`` and after with one of the ``window`` rows before them."""
    for step in range(1, window + 1):
        start = max(first, step)
        if start >= len(nodes):
            break
        later, earlier = slice(start, None), slice(start - step, len(nodes) - step)
        near = np.einsum("ij,ij->i", units[later], units[earlier]) >= threshold
        near &= groups[later] == groups[earlier]
        at = np.flatnonzero(near) + start
        yield nodes[at - step], nodes[at]


_FOUND = "a long, b long, part long, place long, dim long, pass long, vector binary"


def _table(part: int, dims, passes, nodes, raw, places) -> pa.RecordBatch:
    n = len(nodes)
    columns_out = [
        pa.array(nodes, pa.int64()), pa.nulls(n, pa.int64()), pa.array([part] * n, pa.int64()), pa.array(places, pa.int64()),
        pa.array(dims, pa.int64()), pa.array(passes, pa.int64()), pa.array(raw, pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns_out, [f.split()[0] for f in _FOUND.split(", ")])


def spanning(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the links (a, b) so many that they connect all that the links connect, and no ring."""
    nodes, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    ends, label = at.reshape(2, -1), np.arange(len(nodes))
    kept, left = [], np.arange(len(a))
    while True:
        high, low = label[ends[:, left]].max(axis=0), label[ends[:, left]].min(axis=0)
        order = np.lexsort((low, high))
        order = order[high[order] != low[order]]
        left, high, low = left[order], high[order], low[order]
        if not len(left):
            taken = np.concatenate(kept or [left])
            return a[taken], b[taken]
        # Every part takes its link to the least part before it: labels fall, so no ring arises.
        part, first = np.unique(high, return_index=True)
        kept.append(left[first])
        parent = np.arange(len(nodes))
        parent[part] = low[first]
        while (parent[parent] != parent).any():
            parent = parent[parent]
        label = parent[label]


def _links_only(pairs) -> pa.RecordBatch:
    a = np.concatenate([p[0] for p in pairs] or [np.array([], np.int64)])
    b = np.concatenate([p[1] for p in pairs] or [np.array([], np.int64)])
    a, b = spanning(a, b)
    both = np.unique(np.stack((np.minimum(a, b), np.maximum(a, b)), axis=1), axis=0).astype(np.int64)
    empty = [pa.nulls(len(both), t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())]
    return pa.RecordBatch.from_arrays(
        [pa.array(both[:, 0]), pa.array(both[:, 1]), *empty], [f.split()[0] for f in _FOUND.split(", ")]
    )


def links(classes: DataFrame, threshold: float, passes: int, window: int, seed: int) -> DataFrame:
    """Pairs (a, b) of classes with a cosine of at least the threshold, that connect all that the passes find."""
    ordered = _coded(classes, passes, seed).repartitionByRange("dim", "pass", "code", "node")
    ordered = ordered.sortWithinPartitions("dim", "pass", "code", "node")

    def compared(dims, passes_, nodes, raw, first):
        groups = np.array(dims, np.int64) * 65536 + np.array(passes_, np.int64)
        own = np.array(nodes, np.int64)
        found = []
        for dim in sorted(set(dims)):
            at = np.flatnonzero(np.array(dims) == dim)
            unit = _unit([raw[i] for i in at], dim)
            found += _close(groups[at], own[at], unit, int(np.searchsorted(at, first)), window, threshold)
        return found

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        held: list[list] = [[], [], [], []]  # dims, passes, nodes, vectors: the rows a later one is compared with
        seen = 0
        for batch in batches:
            new = [batch.column(i).to_pylist() for i in (0, 1, 3, 4)]
            if seen < window:
                head = [column[: window - seen] for column in new]
                yield _table(part - 1, *head, [window + seen + i for i in range(len(head[0]))])
            before = len(held[0])
            rows = [old + fresh for old, fresh in zip(held, new)]
            found = compared(*rows, before)
            if found:
                yield _links_only(found)
            seen += len(new[0])
            held = [column[-window:] for column in rows]
        tail = len(held[0])
        if tail:
            yield _table(part, *held, [window - tail + i for i in range(tail)])

    def across(group: pa.Table) -> pa.Table:
        """The last rows of a partition with the first ones of the next."""
        rows = sorted(zip(*(group.column(c).to_pylist() for c in ("place", "dim", "pass", "a", "vector"))))
        _, dims, passes_, nodes, raw = zip(*rows)
        found = compared(list(dims), list(passes_), list(nodes), list(raw), 0)
        return pa.Table.from_batches([_links_only(found).select(["a", "b"])])

    found = stored(ordered.mapInArrow(task, _FOUND))
    borders = found.filter("b is null").groupBy("part").applyInArrow(across, "a long, b long")
    return found.filter("b is not null").select("a", "b").unionByName(borders).distinct()


def modelled_passes(classes: int, window: int, threshold: float, recall: float) -> int:
    """Passes by which two vectors just at the threshold meet with the chance ``recall``.

    They agree in a sign with the chance 1 - angle / pi, and lie in one window where they agree in as many leading
    signs as leave a window's number of vectors.
    """
    agree = 1 - math.acos(max(-1.0, min(1.0, threshold))) / math.pi
    met = agree ** min(max(0.0, math.log2(max(classes, 1) / window)), _CODE_BITS)
    return math.ceil(math.log(1 - recall) / math.log1p(-met)) if met < recall else 1


def _by_dim(dims: list[int]) -> Iterator[tuple[int, np.ndarray]]:
    every = np.array(dims, np.int64)
    for dim in np.unique(every).tolist():
        yield dim, np.flatnonzero(every == dim)


def _middles(members: DataFrame) -> DataFrame:
    """Per component the sum of its unit vectors; a task sends one sum per component, or few."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}

        def sums() -> pa.RecordBatch:
            raw = [own.tobytes() for own in held.values()]
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.int64()), pa.array(raw, pa.binary())], ["root", "part"])

        for batch in batches:
            every = np.array(batch.column(0).to_pylist(), np.int64)
            raw = batch.column(2).to_pylist()
            for dim, at in _by_dim(batch.column(1).to_pylist()):
                at = at[np.argsort(every[at], kind="stable")]
                roots, first = np.unique(every[at], return_index=True)
                for root, own in zip(roots.tolist(), np.add.reduceat(_unit([raw[i] for i in at], dim), first)):
                    held[root] = held[root] + own if root in held else own
            if len(held) >= _SUMS:
                yield sums()
                held.clear()
        if held:
            yield sums()

    def whole(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(part) for part in group.column("part").to_pylist())
        return pa.table({"root": group.column("root").slice(0, 1), "middle": pa.array([total.tobytes()], pa.binary())})

    parts = members.select("root", "dim", "vector").mapInArrow(partial, "root long, part binary")
    return parts.groupBy("root").applyInArrow(whole, "root long, middle binary")


def _groups(members: DataFrame, threshold: float) -> DataFrame:
    """Per component ``rows``, ``classes``, and ``tight``: all lie within half the threshold's angle of its middle."""
    half = math.cos(math.acos(max(-1.0, min(1.0, threshold))) / 2 * (1 - 1e-9))

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vector, middle = batch.column(3).to_pylist(), batch.column(4).to_pylist()
            inside = np.zeros(batch.num_rows, bool)
            for dim, at in _by_dim(batch.column(2).to_pylist()):
                centre = np.frombuffer(b"".join(middle[i] for i in at)).reshape(len(at), dim)
                length = np.linalg.norm(centre, axis=1)
                cosine = np.einsum("ij,ij->i", _unit([vector[i] for i in at], dim), centre)
                inside[at] = (length > 0) & (cosine >= half * length)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(inside)], ["root", "copies", "inside"])

    placed = members.join(_middles(members), "root").select("root", "copies", "dim", "vector", "middle")
    return placed.mapInArrow(near, "root long, copies long, inside boolean").groupBy("root").agg(
        F.sum("copies").alias("rows"), F.count(F.lit(1)).alias("classes"), F.min("inside").alias("tight")
    )


def _packed(vectors: list[bytes]) -> bytes:
    """The vectors side by side, in 32 bits if that loses nothing."""
    whole = np.frombuffer(b"".join(vectors))
    with np.errstate(over="ignore"):
        short = whole.astype(np.float32)
    return short.tobytes() if np.array_equal(short, whole) else whole.tobytes()


def _unpacked(raw: bytes, n: int, dim: int) -> np.ndarray:
    """Unit vectors of what ``_packed`` gave."""
    own = np.frombuffer(raw, np.float32 if len(raw) == 4 * n * dim else np.float64).astype(np.float64).reshape(n, dim)
    return _unit([row.tobytes() for row in own], dim)


_BLOCKS = (
    "block long, dim long, n long, nodes binary, roots binary, settled binary, copies binary, vectors binary, middle binary, "
    "radius double, group long"
)


def _directions(middles: np.ndarray) -> np.ndarray:
    """Middles kept in 32 bits as unit vectors."""
    own = middles.astype(np.float64)
    return own / np.linalg.norm(own, axis=1, keepdims=True)


def _blocks(placed: DataFrame, seed: int) -> DataFrame:
    """Rows of vectors that lie near each other; a large tight component has blocks of its own."""
    total = placed.count()
    size = max(_BLOCK, -(-total // _MOST_BLOCKS))
    most = min(-(-total // size), _CENTRES)
    # Nodes are hashes and distinct: the least of them first, then their vectors only.
    least = [row[0] for row in placed.select("node").orderBy("node").limit(most).collect()]
    centres: dict[int, list[bytes]] = {}
    if least:
        for dim, raw in placed.filter(F.col("node") <= least[-1]).sort("node").select("dim", "vector").collect():
            centres.setdefault(dim, []).append(raw)
    around = placed.sparkSession.sparkContext.broadcast({d: _unit(raw, d) for d, raw in centres.items()})

    def to_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.left_shift(np.int64(1), np.arange(_CODE_BITS - 1, -1, -1, dtype=np.int64))
        directions: dict[int, np.ndarray] = {}
        for batch in batches:
            dims, raw = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            cell, code = np.zeros(len(dims), np.int64), np.zeros(len(dims), np.int64)
            for dim in sorted(set(dims)):
                at = np.flatnonzero(np.array(dims) == dim)
                if dim not in directions:
                    directions[dim] = np.random.default_rng((seed, dim, 1)).standard_normal((dim, _CODE_BITS))
                unit, near = _unit([raw[i] for i in at], dim), around.value.get(dim)
                if near is not None:
                    cell[at] = (unit @ near.T).argmax(axis=1)
                    unit = unit - near[cell[at]]
                code[at] = ((unit @ directions[dim]) > 0) @ weights
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cell), pa.array(code)], [*batch.schema.names, "cell", "code"]
            )

    def cut(rows: list, number: int) -> tuple:
        nodes, dims, raw, copies, roots, settled = zip(*rows)
        unit = _unit(raw, dims[0])
        middle = unit.sum(axis=0)
        middle = (middle if np.linalg.norm(middle) > 1e-6 else unit[0]).astype(np.float32)
        radius = float(np.arccos(np.clip(unit @ _directions(middle[None])[0], -1, 1)).max())
        own = [np.array(x, np.int64).tobytes() for x in (nodes, roots, settled, copies)]
        group = settled[0] if len(set(settled)) == 1 else None
        return number, dims[0], len(rows), *own, _packed(raw), middle.tobytes(), radius, group

    names = [f.split()[0] for f in _BLOCKS.split(", ")]
    kinds = [pa.int64()] * 3 + [pa.binary()] * 6 + [pa.float64(), pa.int64()]

    def to_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, held, key = TaskContext.get().partitionId() << 36, [], None
        for batch in batches:
            out = []
            for *row, owner, cell in zip(*(batch.column(i).to_pylist() for i in range(8))):
                if held and (key != (row[1], owner, cell) or len(held) == size):
                    out.append(cut(held, number))
                    number, held = number + 1, []
                key = (row[1], owner, cell)
                held.append(row)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(cut(held, number), kinds)], names)

    own_blocks = F.when(F.col("tight") & (F.col("classes") >= size), F.col("root")).alias("owner")
    rows = placed.select("node", "dim", "vector", "copies", "root", "settled", own_blocks)
    kept = "node long, dim long, vector binary, copies long, root long, settled long, owner long"
    celled = rows.mapInArrow(to_cells, f"{kept}, cell long, code long")
    # A component that has blocks of its own is not cut by cells as well.
    celled = celled.withColumn("cell", F.when(F.col("owner").isNull(), F.col("cell")).otherwise(-1))
    order = ["dim", "owner", "cell", "code", "node"]
    celled = celled.repartitionByRange(*order).sortWithinPartitions(*order)
    return stored(celled.drop("code").mapInArrow(to_blocks, _BLOCKS))


def _forest(near: np.ndarray) -> list[tuple[int, int]]:
    """Some of the true places (row, column) that connect all that they all connect."""
    rows, cols = near.any(axis=1), near.any(axis=0)
    edges = []
    for start in np.flatnonzero(rows).tolist():
        if not rows[start]:
            continue
        rows[start] = False
        open_rows = [start]
        while open_rows:
            row = open_rows.pop()
            fresh = np.flatnonzero(near[row] & cols)
            cols[fresh] = False
            for col in fresh.tolist():
                edges.append((row, col))
                more = np.flatnonzero(near[:, col] & rows)
                rows[more] = False
                edges += [(r, col) for r in more.tolist()]
                open_rows += more.tolist()
    return edges


def _crossing(placed: DataFrame, threshold: float, seed: int) -> tuple[DataFrame, DataFrame]:
    """All links between classes of different ``settled``: ``node`` and ``crossing`` rows, and edges (a, b) of the roots.

    The driver holds a middle and a radius per block, whose number has a bound.
    """
    blocks, tile = _blocks(placed, seed), _TILE
    known = sorted(blocks.select("block", "dim", "n", "radius", "group", "middle").collect())
    sizes, dims = (np.array([k[i] for k in known], np.int64) for i in (2, 1))
    total, widest = int(sizes.sum()), int(max(dims, default=1))
    groups = max(-(-total * widest * 8 // _GROUP_BYTES), min(_GROUPS, len(known)), 1)
    group = (np.cumsum(sizes) - sizes) * groups // max(total, 1)
    alike = np.array([k[4] is not None for k in known], bool)
    settled, radii = np.array([k[4] or 0 for k in known], np.int64), np.array([k[3] for k in known])
    at = {int(d): np.flatnonzero(dims == d) for d in set(dims.tolist())}
    middles = {d: np.frombuffer(b"".join(known[i][5] for i in where), np.float32).reshape(-1, d) for d, where in at.items()}
    number_of = {k[0]: i for i, k in enumerate(known)}
    sent = placed.sparkSession.sparkContext.broadcast((number_of, group, alike, settled, radii, dims, at, middles))
    angle = math.acos(max(-1.0, min(1.0, threshold))) + _MARGIN

    def met(number: int) -> np.ndarray:
        """Numbers of the blocks that may hold a link to be counted with this one."""
        _, _, alike, settled, radii, dims, at, middles = sent.value
        dim = int(dims[number])
        where = at[dim]
        place = np.searchsorted(where, number)
        own = _directions(middles[dim][place : place + 1])[0]
        cosines = np.concatenate([_directions(middles[dim][low : low + tile]) @ own for low in range(0, len(where), tile)])
        near = np.arccos(np.clip(cosines, -1, 1)) <= angle + radii[where] + radii[number]
        near |= where == number
        if alike[number]:
            near &= ~(alike[where] & (settled[where] == settled[number]))
        return where[near]

    payload = ["n", "nodes", "roots", "settled", "copies", "vectors"]
    kinds = [pa.int64()] * 4 + [pa.binary()] * 5

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, *rest in zip(*(batch.column(i).to_pylist() for i in range(7))):
                number_of, group = sent.value[:2]
                number = number_of[block]
                mine = int(group[number])
                for other in np.unique(group[met(number)]).tolist():
                    row = (min(mine, other), max(mine, other), number, *rest)
                    yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], ["first", "second", "number", *payload])

    schema = (
        "first long, second long, number long, n long, nodes binary, roots binary, settled binary, copies binary, vectors binary"
    )
    dealt = blocks.select("block", *payload).mapInArrow(deal, schema)

    def count(parts: pa.Table) -> pa.Table:
        _, group, _, _, _, dims, _, _ = sent.value
        first, second = parts.column("first")[0].as_py(), parts.column("second")[0].as_py()
        rows = sorted(zip(*(parts.column(c).to_pylist() for c in ("number", *payload))))
        held = {r[0]: [*(np.frombuffer(x, np.int64) for x in r[2:6]), _unpacked(r[6], r[1], int(dims[r[0]]))] for r in rows}
        linked = {number: np.zeros(len(own[0]), np.int64) for number, own in held.items()}
        edges = set()
        for i, mine in held.items():
            for j in met(i).tolist():
                if j < i or j not in held or (min(group[i], group[j]), max(group[i], group[j])) != (first, second):
                    continue
                theirs = held[j]
                for low, start in product(range(0, len(mine[0]), tile), range(0, len(theirs[0]), tile)):
                    _, roots_i, settled_i, copies_i, unit_i = (x[low : low + tile] for x in mine)
                    _, roots_j, settled_j, copies_j, unit_j = (x[start : start + tile] for x in theirs)
                    near = unit_i @ unit_j.T >= threshold
                    if not near.any():
                        continue
                    near &= settled_i[:, None] != settled_j[None, :]
                    linked[i][low : low + tile] += near @ copies_j
                    if i != j:
                        linked[j][start : start + tile] += near.T @ copies_i
                    near &= roots_i[:, None] != roots_j[None, :]
                    edges |= {(int(roots_i[a]), int(roots_j[b])) for a, b in _forest(near)}
        nodes = np.concatenate([own[0] for own in held.values()])
        sums = np.concatenate(list(linked.values()))
        nodes, sums, pairs = nodes[sums > 0], sums[sums > 0], sorted(edges)
        empty, none = pa.nulls(len(pairs), pa.int64()), pa.nulls(len(nodes), pa.int64())
        tables = (
            [pa.array(nodes, pa.int64()), pa.array(sums, pa.int64()), none, none],
            [empty, empty, *(pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1))],
        )
        return pa.concat_tables([pa.table(t, ["node", "linked", "a", "b"]) for t in tables])

    found = stored(dealt.groupBy("first", "second").applyInArrow(count, "node long, linked long, a long, b long"))
    crossing = found.filter("node is not null").groupBy("node").agg(F.sum("linked").alias("crossing"))
    return crossing, found.filter("a is not null").select("a", "b")


def near_duplicates(
    vectors: DataFrame,
    threshold: float = 0.9,
    passes: int | None = None,
    window: int = 16,
    recall: float = 0.95,
    seed: int = 20240607,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """One row per row of ``vectors``: ``vec_id``, ``n_links``, ``component_id`` and ``kept``.

    Links and components are exact; ``passes`` and ``window`` only decide how many are found before the blocks.
    Without ``passes`` their number follows from the distinct vectors and the ``recall`` at the threshold.

    Vectors that are null, zero or hold null or non-finite components have no link, and vectors of different
    length have none with each other. Copies are linked with each other and share all else. Rows that repeat an
    id stay rows of their own. ``component_id`` is the least id reachable, null only where all ids are. An empty
    table gives no rows.
    """
    rows = columns(vectors, vec_id=id_column, embedding=vector_column)
    vector = F.col("embedding").cast("array<double>")
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.when(usable(vector), vector).alias("v"))
    rows = stored(rows.withColumn("node", F.when(F.col("v").isNotNull(), F.xxhash64("v"))))
    shared = rows.filter("node is not null").groupBy("node").agg(
        F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least"), F.first("v").alias("v")
    )

    def to_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [np.array(v) for v in batch.column(3).to_pylist()]
            sizes = pa.array([len(v) for v in lists], pa.int64())
            raw = pa.array([v.tobytes() for v in lists], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], sizes, raw], ["node", "copies", "least", "dim", "vector"])

    classes = stored(shared.mapInArrow(to_bytes, "node long, copies long, least long, dim long, vector binary"))
    if passes is None:
        passes = modelled_passes(classes.count(), window, threshold, recall)
    stars = components(links(classes, threshold, passes, window, seed), "a", "b")
    members = stored(classes.join(stars, "node").select("root", "copies", "dim", "vector"))
    found = classes.join(stars, "node", "left").withColumn("root", F.coalesce("root", "node"))
    found = found.join(_groups(members, threshold), "root", "left")
    # What is settled alike needs no comparison: all of it is linked.
    settled = F.when(F.col("tight"), F.col("root")).otherwise(F.col("node")).alias("settled")
    every = stored(found.select("node", "dim", "vector", "copies", "least", "root", settled, "tight", "rows", "classes"))
    crossing, edges = _crossing(every, threshold, seed)
    merged = components(edges, "a", "b").select(F.col("node").alias("root"), F.col("root").alias("whole"))
    linked = F.when(F.col("tight"), F.col("rows") - F.col("copies")).otherwise(0).alias("linked")
    known = every.select("node", "root", "copies", "least", linked).join(merged, "root", "left")
    known = stored(known.withColumn("whole", F.coalesce("whole", "root")).join(crossing, "node", "left"))
    leasts = known.groupBy("whole").agg(F.min("least").alias("component"))
    known = known.join(leasts, "whole").select(
        "node", (F.col("linked") + F.coalesce("crossing", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component"
    )
    joined = rows.drop("v").join(known, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component"))
    return joined.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
