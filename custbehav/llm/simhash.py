"""SimHash near-duplicates found by Golay-code fuzzy hashing.

The fingerprint of a text holds, bit by bit, the majority of the 64-bit hashes of its word shingles. Links
between fingerprints of few differing bits are searched with the binary Golay code: it is perfect, every
23-bit word lies within three bits of exactly one of 4,096 codewords, so a 21- or 22-bit segment decodes
to one 12-bit index, and the segments one bit away decode to six indices at most. Three differing bits
over three segments leave one of two cases (pigeonhole):

* a segment X is equal and another, Y, differs in one bit at most: the key is X itself with an index of Y;
* every segment differs in exactly one bit: the key is the indices of the first two segments with the
  equal half of the third.

One side of the join carries its own index, the other the indices of all neighbours, so each fingerprint
has 8 keys to be found by and about 88 to search with, all of 33 bits and more. Pairs are verified on all 64
bits inside the join. Equal fingerprints are one class before the search: copies never meet as pairs, and a
fingerprint has no more than 43,744 others within three bits, whatever the size of the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from custbehav.llm.common import columns, set_aside, stored
from custbehav.llm.components import components

# Generator polynomial of the binary Golay code of length 23 (a fixed value of the code).
_GENERATOR = 0b101011100011
_SEGMENTS = ((0, 21), (21, 21), (42, 22))
_SHINGLES_AT_ONCE = 1 << 17


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Majority of the shingle hashes (XXH64, seed 42) per bit; zero for a text without words."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), seed=42)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    total = len(words) - shingle + 1
    votes = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for low in range(0, total, _SHINGLES_AT_ONCE):
        high = min(total, low + _SHINGLES_AT_ONCE)
        spans = zip(starts[low:high].tolist(), ends[low + shingle - 1 : high + shingle - 1].tolist())
        hashes = np.fromiter((digest(joined[a:b], 42) for a, b in spans), "<u8", high - low)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > total, bitorder="little").view("<u8")[0])


def _fingerprinted(rows: DataFrame, shingle: int) -> DataFrame:
    """``rows``, long columns and then the text, with the fingerprint in the text's place."""
    names = [*rows.columns[:-1], "fingerprint"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *kept, texts = batch.columns
            marks = np.array([fingerprint(t, shingle) for t in texts.to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([*kept, pa.array(marks.view(np.int64))], names)

    return rows.mapInArrow(task, ", ".join(f"{name} long" for name in names))


def fingerprints(docs: DataFrame, shingle: int = 3, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id`` and ``fingerprint`` (its 64 bits as a long) of every row."""
    rows = columns(docs, doc_id=id_column, text=text_column).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return _fingerprinted(rows, shingle)


def _syndromes(words: np.ndarray) -> np.ndarray:
    """Remainders of 23-bit words by the generator polynomial."""
    words = words.copy()
    for bit in range(22, 10, -1):
        words ^= ((words >> bit) & 1) * (_GENERATOR << (bit - 11))
    return words


def _error_patterns() -> np.ndarray:
    """For each of the 2,048 syndromes the error of at most three bits that causes it."""
    single = [1 << i for i in range(23)]
    errors = [0, *single]
    errors += [single[i] | single[j] for i in range(23) for j in range(i)]
    errors += [single[i] | single[j] | single[k] for i in range(23) for j in range(i) for k in range(j)]
    errors = np.array(errors, np.int64)
    table = np.zeros(2048, np.int64)
    table[_syndromes(errors)] = errors
    return table


_ERRORS = _error_patterns()


def golay_index(words: np.ndarray) -> np.ndarray:
    """Index (0 to 4,095) of the codeword within three bits of each 23-bit word."""
    return (words ^ _ERRORS[_syndromes(words)]) >> 11


def _neighbour_indices(words: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Indices of each word and of all words one bit away: (row, index) without repeats."""
    flips = np.concatenate(([0], 1 << np.arange(bits, dtype=np.int64)))
    indices = np.sort(golay_index((words[:, None] ^ flips[None, :]).ravel()).reshape(len(words), -1), axis=1)
    new = np.ones(indices.shape, bool)
    new[:, 1:] = indices[:, 1:] != indices[:, :-1]
    rows, at = np.nonzero(new)
    return rows, indices[rows, at]


def _key(kind: int, *parts: tuple[np.ndarray, int]) -> np.ndarray:
    key = np.int64(kind)
    for value, bits in parts:
        key = (key << np.int64(bits)) | value
    return key


def _pairs_of(rows_a: np.ndarray, rows_b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions (in a, in b) of all combinations with the same row; both are sorted by row."""
    count_a, count_b = np.bincount(rows_a, minlength=n), np.bincount(rows_b, minlength=n)
    start_b = np.cumsum(count_b) - count_b
    repeat = count_b[rows_a]
    at_a = np.repeat(np.arange(len(rows_a)), repeat)
    inside = np.arange(len(at_a)) - np.repeat(np.cumsum(repeat) - repeat, repeat)
    return at_a, start_b[rows_a[at_a]] + inside


def own_keys(marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key): the eight keys a fingerprint is found by."""
    parts = [((marks >> np.uint64(at)) & np.uint64((1 << bits) - 1)).astype(np.int64) for at, bits in _SEGMENTS]
    index = [golay_index(p) for p in parts]
    keys = [
        _key(x * 3 + y, (parts[x], 22), (index[y], 12)) for x in range(3) for y in range(3) if x != y
    ]
    keys += [_key(9 + h, (index[0], 12), (index[1], 12), ((parts[2] >> (11 * h)) & 2047, 11)) for h in (0, 1)]
    return np.tile(np.arange(len(marks)), len(keys)), np.concatenate(keys)


def search_keys(marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key): the keys under which every fingerprint within three bits is found."""
    n = len(marks)
    parts = [((marks >> np.uint64(at)) & np.uint64((1 << bits) - 1)).astype(np.int64) for at, bits in _SEGMENTS]
    near = [_neighbour_indices(p, bits) for p, (_, bits) in zip(parts, _SEGMENTS)]
    rows, keys = [], []
    for x in range(3):
        for y in range(3):
            if x != y:
                r, index = near[y]
                rows.append(r)
                keys.append(_key(x * 3 + y, (parts[x][r], 22), (index, 12)))
    at_a, at_b = _pairs_of(near[0][0], near[1][0], n)
    r = near[0][0][at_a]
    for h in (0, 1):
        half = (parts[2][r] >> (11 * h)) & 2047
        rows.append(r)
        keys.append(_key(9 + h, (near[0][1][at_a], 12), (near[1][1][at_b], 12), (half, 11)))
    return np.concatenate(rows), np.concatenate(keys)


def _keyed(marks: DataFrame, keys_of, name: str) -> DataFrame:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 2048):
                own = batch.column(0).slice(low, 2048).to_numpy(zero_copy_only=False)
                rows, keys = keys_of(own.view(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(own[rows])], ["key", name])

    return marks.mapInArrow(task, f"key long, {name} long")


def links(marks: DataFrame, max_bits: int = 3) -> DataFrame:
    """All pairs ``a`` < ``b`` of distinct fingerprints that differ in at most ``max_bits`` (3 or fewer) bits."""
    if not 0 <= max_bits <= 3:
        raise ValueError("the Golay keys cover up to three differing bits")
    found, sought = _keyed(marks, own_keys, "a"), _keyed(marks, search_keys, "b")
    close = (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
    return found.join(sought, (found["key"] == sought["key"]) & close).select("a", "b").distinct()


def _components(classes: DataFrame, max_bits: int) -> DataFrame:
    """``fingerprint`` and ``root`` of the fingerprints with a link to another one."""
    stars = components(links(classes.select("fingerprint"), max_bits), "a", "b")
    return stored(stars.select(F.col("node").alias("fingerprint"), "root"))


def near_duplicates(
    docs: DataFrame, shingle: int = 3, max_bits: int = 3, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id``.

    ``component_id`` is the smallest id reachable over links of at most ``max_bits`` differing bits. Null
    and blank texts have fingerprint zero and link like any other; repeated rows and equal texts share their
    fingerprint; rows with a null id take part, and their component's id is null only if no row in it has
    one. An empty table gives no rows.
    """
    rows = stored(fingerprints(docs, shingle, id_column, text_column))
    classes = stored(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("least")))
    linked = classes.join(_components(classes, max_bits), "fingerprint")
    smallest = linked.groupBy("root").agg(F.min("least").alias("component_least"))
    linked = linked.join(smallest, "root").select("fingerprint", "component_least")
    named = classes.join(linked, "fingerprint", "left").select(
        "fingerprint", F.coalesce("component_least", "least").alias("component_id")
    )
    return rows.join(named, "fingerprint").select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


def deduplicated(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """``docs`` (doc_id, text and any other columns) with one document of every component.

    The one with the least id stays, a null id last; of rows that repeat the id, the one whose columns have the
    least hash; of rows alike in all columns, one.
    """
    docs, back = set_aside(docs, "doc_id", "text")
    # A map has no hash of its own; its text has one.
    texts = [F.to_json(F.struct(f.name)) if "map<" in f.dataType.simpleString() else F.col(f.name) for f in docs.schema.fields]
    mark = F.xxhash64(*texts)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), mark.alias("mark"), "text")
    rows = stored(_fingerprinted(rows, shingle))
    classes = stored(rows.select("fingerprint").distinct())
    grouped = rows.join(_components(classes, max_bits), "fingerprint", "left").select(
        F.coalesce("root", "fingerprint").alias("root"), "doc_id", "mark"
    )
    last = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")
    alike = grouped.groupBy("root", "doc_id", "mark").agg((F.count(F.lit(1)) > 1).alias("repeated"))
    first = alike.groupBy("root").agg(F.min_by("mark", last).alias("mark"), F.min_by("repeated", last).alias("repeated"))
    first = stored(first.select(F.col("mark").alias("_mark"), "repeated"))
    marked = docs.withColumn("_mark", mark)
    single = marked.join(first.filter("not repeated").select("_mark"), "_mark", "left_semi")
    repeated = marked.join(first.filter("repeated").select("_mark"), "_mark", "left_semi")
    return back(single.unionByName(repeated.dropDuplicates(["_mark"])))
