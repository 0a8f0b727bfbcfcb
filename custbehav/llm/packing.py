"""Packing documents into training sequences by lexical retrieval.

The documents are token ids; the ids are also the terms of a BM25 index, so the vocabulary bounds all
statistics: document frequencies of the whole corpus are at most one number per id and are broadcast. The
index is sharded. Before that one shuffle puts the documents of the whole corpus in the order of their key terms,
those of the strongest that most documents share first, so related documents lie in the same shard wherever they
stood in the files; a key that many documents share is split by the next ones. Each task cuts its part of
this order into shards of bounded size and builds an inverted index per shard. A window starts with a seed
document; all its terms are looked up, and the unused documents found fill the window greedily in the order of their scores. The last one that does not fit is cut,
and its rest seeds the next window, so all windows are full. What remains at the end of a shard is cut
into sequences whose lengths are powers of two and need no padding.
"""

from __future__ import annotations

import json
import os
import unicodedata
import zlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from custbehav.llm.common import columns, stored

# Entries of a table of known words before it becomes the older of two.
_KEEP_WORDS = 800_000
# Key terms of a document, and the strongest terms they are taken from.
_KEYS, _STRONG = 4, 24
# Rows whose keys limit a range of documents.
_LIMIT_ROWS = 100
# A term is common in a shard if more than this share of the documents have it.
_COMMON = 0.2
# Letters whose lower case is not one letter, or depends on what follows.
_SPECIAL_CASES = frozenset("\u0130\u03a3")
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"
)


# One run of letters, then signs only; the vocabulary cuts such a word between the two.
_PLAIN = regex.compile(r"(\p{L}+)([^\s\p{L}\p{N}'<]*)")
# The signs of ASCII among them.
_SIGNS = "!\"#$%&()*+,-./:;=>?@[\\]^_`{|}~"
# The white space of bytes.split, and for every byte whether it is that.
_SPACES = b" \t\n\r\x0b\x0c"
_IS_SPACE = bytes(b in _SPACES for b in range(256))
# Latin letters up to U+024F: NFC leaves them alone, and each but U+0130 has one letter in lower case. Their bytes are below this.
_LATIN = "".join(chr(c) for c in range(0x250) if chr(c).isalpha() and (c < 0x80 or c >= 0xC0) and c != 0x130)
_LATIN_END = 0xCA
# The letters that vocabularies of bytes write for bytes; the space between words stays.
_BYTE_LETTERS = np.arange(256, dtype="<u2")
_BYTE_LETTERS[[*range(0x20), *range(0x7F, 0xA1), 0xAD]] = [*range(0x100, 0x120), *range(0x121, 0x144)]
# Text whose words are looked up at a time, each different one once; a longer text is taken alone.
_SLICE_BYTES = 32 << 20
# Runs of letters that the library encodes as one text. It holds some hundred bytes for each; thousands are
# slower, as their memory goes back to the system after every text.
_RUNS = 100
# Text whose words are told apart at a time.
_BLOCK_BYTES = 4 << 20
_WORD_END = "</w>"


def _listed(words: pa.Array) -> list[bytes]:
    return words.cast(pa.large_binary()).to_numpy(zero_copy_only=False).tolist()


def _changes(held: bytes) -> np.ndarray:
    """The places before a word's first byte and of its last, one after the other; white space begins and ends ``held``."""
    space, found = held.translate(_IS_SPACE), []
    for low in range(0, max(len(held) - 1, 1), _BLOCK_BYTES):
        own = np.frombuffer(space, bool, min(_BLOCK_BYTES + 1, len(held) - low), low)
        found.append((np.flatnonzero(own[1:] != own[:-1]) + low).astype(np.int32))
    return np.concatenate(found)


class Kept(dict):
    """A table of bounded size. When it is full it becomes the older one, and what is asked for again comes back from there."""

    def __init__(self):
        self.older: dict = {}

    def missing(self, keys: Iterable[bytes]) -> list[bytes]:
        """The keys that neither table has; all others are in this one afterwards."""
        return self._new(keys, [key for key in keys if key not in self])

    def of_all(self, keys: list[bytes], encode) -> list[bytes]:
        """The values of different keys; those that neither table has are encoded."""
        values = [*map(self.get, keys)]
        places = [i for i, value in enumerate(values) if value is None]
        if places:
            unknown = [keys[i] for i in places]
            if self and len(self) + len(unknown) > _KEEP_WORDS:
                self.older = dict(self)
                self.clear()
                self.update((key, value) for key, value in zip(keys, values) if value is not None)
            found = [*map(self.older.get, unknown)]
            new = [key for key, value in zip(unknown, found) if value is None]
            if new:
                encoded = iter(encode(new))
                found = [next(encoded) if value is None else value for value in found]
            self.update(zip(unknown, found))
            for i, value in zip(places, found):
                values[i] = value
        return values

    def _new(self, keys: Iterable[bytes], new: list[bytes]) -> list[bytes]:
        """``new`` are those of the keys that this table does not have."""
        if self and len(self) + len(new) > _KEEP_WORDS:
            self.older = dict(self)
            self.clear()
            new = list(keys)
        older = self.older
        self.update((key, older[key]) for key in new if key in older)
        return [key for key in new if key not in older]


class WordIds(Kept):
    """Ids (little-endian, 16 or 32 bits each) of a word without white space, both as bytes.

    The vocabulary's pre-tokens never reach across white space, so the ids of a text are those of its words. The
    ids of a plain word are those of its letters in lower case and of its signs; new letter runs are encoded
    many at a time, the last token of each tells where it ends. Plain words of Latin letters are told apart by column and
    looked up by their letters; this table has the others.
    """

    def __init__(self, vocabulary: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary)
        size = self.tokenizer.get_vocab_size()
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.ends = np.array([(self.tokenizer.id_to_token(i) or "").endswith(_WORD_END) for i in range(size)])
        self.letters, self.others = Kept(), Kept()
        # For letters in lower case the normalizer and the patterns of the vocabulary change nothing, only its letters for bytes.
        plain = {"normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}, "added_tokens": []}
        self.of_letters = Tokenizer.from_str(json.dumps(json.loads(vocabulary) | plain))

    def _encode(self, words: list[bytes]) -> list[bytes]:
        found = self.tokenizer.encode_batch([word.decode("utf-8") for word in words], add_special_tokens=False)
        return [np.array(e.ids, self.dtype).tobytes() for e in found]

    def _encode_text(self, runs: list[bytes], latin: bool) -> list[int]:
        raw = b" ".join(runs)
        text = _BYTE_LETTERS[np.frombuffer(raw, np.uint8)].tobytes().decode("utf-16-le") if latin else raw.decode("utf-8")
        tokenizer = self.of_letters if latin else self.tokenizer
        return tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _encode_runs(self, runs: list[bytes], latin: bool) -> list[bytes]:
        found: list[int] = []
        for low in range(0, len(runs), _RUNS):
            found.extend(self._encode_text(runs[low : low + _RUNS], latin))
        ids = np.array(found, self.dtype)
        cuts = np.flatnonzero(self.ends[ids]) + 1
        if len(cuts) != len(runs):
            return self._encode(runs)
        width, raw, ends = ids.itemsize, ids.tobytes(), cuts.tolist()
        return [raw[a * width : b * width] for a, b in zip([0, *ends], ends)]

    def _encode_letters(self, runs: list[bytes]) -> list[bytes]:
        if np.frombuffer(b"".join(runs), np.uint8).max() < _LATIN_END:
            return self._encode_runs(runs, True)
        latin = [max(run) < _LATIN_END for run in runs]
        quick = iter(self._encode_runs([*compress(runs, latin)], True)) if any(latin) else iter(())
        others = iter(self._encode_runs([run for run, own in zip(runs, latin) if not own], False))
        return [next(quick if own else others) for own in latin]

    def _add(self, known: Kept, words: set[bytes], encode) -> None:
        new = known.missing(words)
        if new:
            known.update(zip(new, encode(new)))

    def _parts(self, word: bytes) -> tuple[bytes, bytes] | None:
        """Letters in lower case and signs of a plain word."""
        text = word.decode("utf-8")
        match = _PLAIN.fullmatch(text)
        if match and (text.isascii() or (unicodedata.is_normalized("NFC", text) and not _SPECIAL_CASES & set(text))):
            return match[1].lower().encode("utf-8"), match[2].encode("utf-8")
        return None

    def _of_latin(self, bodies: pa.Array, signs: pa.Array) -> pa.Array:
        """Ids of words of Latin letters, cut into letters and signs."""
        runs = pc.utf8_lower(bodies).dictionary_encode()
        own = pa.array(self.letters.of_all(_listed(runs.dictionary), self._encode_letters), pa.large_binary())
        signs = signs.dictionary_encode()
        distinct = _listed(signs.dictionary)
        self._add(self.others, {*distinct} - {b""}, self._encode)
        signed = pa.array([self.others[sign] if sign else b"" for sign in distinct], pa.large_binary())
        return pc.binary_join_element_wise(own.take(runs.indices), signed.take(signs.indices), pa.scalar(b"", pa.large_binary()))

    def learn(self, words: list[bytes]) -> None:
        plain, runs, signs, rest = [], [], [], []
        for word in self.missing(words):
            parts = self._parts(word)
            if parts:
                plain.append(word)
                runs.append(parts[0])
                signs.append(parts[1])
            else:
                rest.append(word)
        self._add(self.letters, set(runs), self._encode_letters)
        self._add(self.others, {s for s in signs if s}.union(rest), self._encode)
        letters, others = self.letters, self.others
        others[b""] = b""
        self.update(zip(plain, map(bytes.__add__, map(letters.__getitem__, runs), map(others.__getitem__, signs))))
        self.update(zip(rest, map(others.__getitem__, rest)))

    def of_distinct(self, words: pa.Array) -> pa.Array:
        """Ids of different words."""
        # Without the signs at their end, and without the Latin letters at their beginning.
        bodies, signs = pc.ascii_rtrim(words, _SIGNS), pc.utf8_ltrim(words, _LATIN)
        size, left, right = (pc.binary_length(part).to_numpy() for part in (words, bodies, signs))
        latin = pa.array((left > 0) & (left + right == size))
        other = pc.invert(latin)
        rest = _listed(words.filter(other))
        self.learn(rest)
        others = pa.array([*map(self.__getitem__, rest)], pa.large_binary())
        found = pa.concat_arrays([self._of_latin(bodies.filter(latin), signs.filter(latin)), others])
        places = np.empty(len(words), np.int64)
        places[np.concatenate([np.flatnonzero(latin), np.flatnonzero(other)])] = np.arange(len(words))
        return found.take(pa.array(places))

    def of_all(self, texts: pa.Array) -> list[bytes]:
        """Ids of some texts; null ones are empty."""
        texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
        held = b" ".join([b"", *texts.to_pylist(), b""])
        limits = np.concatenate([[0], np.cumsum(pc.binary_length(texts).to_numpy() + 1)])
        changes = _changes(held)
        if not len(changes):
            return [b""] * len(texts)
        offsets = np.zeros(len(changes) // 2 + 1, np.int32)
        np.cumsum(changes[1::2] - changes[::2], out=offsets[1:])
        buffers = [None, pa.py_buffer(offsets), pa.py_buffer(held.translate(None, _SPACES))]
        words = pa.Array.from_buffers(pa.binary(), len(offsets) - 1, buffers).dictionary_encode()
        del held, buffers, offsets
        ids = self.of_distinct(words.dictionary.cast(pa.string())).take(words.indices)
        places = np.frombuffer(ids.buffers()[1], np.int64)[ids.offset :]
        cuts = places[np.searchsorted(changes[::2], limits)].tolist()
        raw = memoryview(ids.buffers()[2])
        return [bytes(raw[a:b]) for a, b in zip(cuts, cuts[1:])]

    def of(self, text: str) -> bytes:
        return self.of_all(pa.array([text.encode("utf-8", "replace")], pa.large_binary()))[0]


_WORD_IDS: dict[int, WordIds] = {}


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with texts of bounded size, or one text."""
    sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy().astype(np.int64)
    until, low = np.cumsum(sizes), 0
    while low < len(until):
        high = int(np.searchsorted(until, until[low] - sizes[low] + _SLICE_BYTES, side="right"))
        yield batch.slice(low, max(high - low, 1))
        low = max(high, low + 1)


def tokenized(docs: DataFrame, vocabulary: str, end_id: int, id_column: str, text_column: str) -> tuple[DataFrame, int]:
    """(rows of doc_id and ids with the end id, bytes per id); of every task a last row with ``counts`` instead.

    ``counts`` are its documents, its tokens, and its documents with each id, 64 bits each.
    """
    with open(vocabulary, encoding="utf-8") as file:
        text = file.read()
    content = docs.sparkSession.sparkContext.broadcast(text)
    width = WordIds(text).dtype.itemsize

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = hash(content.value)
        if key not in _WORD_IDS:
            _WORD_IDS[key] = WordIds(content.value)
        words = _WORD_IDS[key]
        end = np.array([end_id], words.dtype).tobytes()
        counts = np.zeros(2 + max(len(words.ends), end_id + 1), np.int64)
        frequency, names = counts[2:], ["doc_id", "ids", "counts"]
        for batch in batches:
            for part in _slices(batch):
                ids = [own + end for own in words.of_all(part.column(1))]
                distinct = np.concatenate([_distinct(np.frombuffer(own, words.dtype))[0] for own in ids])
                frequency += np.bincount(distinct, minlength=len(frequency))
                counts[:2] += len(ids), sum(map(len, ids)) // words.dtype.itemsize
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary()), pa.nulls(len(ids), pa.binary())], names)
        if counts[0]:
            last = [pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.array([counts.tobytes()])]
            yield pa.RecordBatch.from_arrays(last, names)

    rows = columns(docs, doc_id=id_column, text=text_column).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(task, "doc_id long, ids binary, counts binary"), width


def _statistics(rows: DataFrame) -> tuple[np.ndarray, int, int]:
    """(document frequency of every id, documents, tokens): one number per id of the vocabulary."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for batch in batches:
            total = sum((np.frombuffer(own, np.int64) for own in batch.column(0).to_pylist()), total)
        used = np.flatnonzero(total)
        if len(used):
            yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["id", "n"])

    # A file holds a row or two: a task a core adds those of many.
    cores = rows.sparkSession.sparkContext.defaultParallelism
    counts = rows.filter("counts is not null").select("counts").coalesce(cores).mapInArrow(task, "id long, n long")
    found = dict(counts.groupBy("id").agg(F.sum("n").alias("n")).collect())  # one row per id of the vocabulary
    documents, tokens = found.pop(0, 0), found.pop(1, 0)
    frequency = np.zeros(max(max(found, default=0) - 1, 1), np.int64)
    for key, n in found.items():
        frequency[key - 2] = n
    return frequency, documents, tokens


def _distinct(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ids, ascending, and how often each stands there."""
    ids = ids.copy()
    ids.sort()
    first = np.empty(len(ids) + 1, bool)
    first[0] = first[-1] = True
    np.not_equal(ids[1:], ids[:-1], out=first[1:-1])
    starts = first.nonzero()[0]
    return ids[starts[:-1]], starts[1:] - starts[:-1]


def _weighed(ids: np.ndarray, idf: np.ndarray, mean_length: float, k1: float, b: float) -> tuple[np.ndarray, np.ndarray]:
    """The distinct terms of a document and their BM25 weights."""
    term, tf = _distinct(ids)
    norm = k1 * (1 - b + b * len(ids) / mean_length)
    return term.astype(np.int64), idf[term] * (tf * (k1 + 1) / (tf + norm))


def _place(row) -> tuple:
    """Keys, doc_id and mark in their order; a null id comes first."""
    *keys, name, mark = row
    return *keys, name is not None, name or 0, mark


def key_terms(term: np.ndarray, weight: np.ndarray, frequency: np.ndarray) -> np.ndarray:
    """Of the strongest terms that other documents have too, those that most documents have."""
    shared = frequency[term] > 1
    if not shared.all():
        term, weight = term[shared], weight[shared]
    number = min(_STRONG, (len(term) + 1) // 2)
    if len(term) > 2 * _STRONG:
        # Only those that reach the last of the strongest are put in order.
        most = weight >= np.partition(weight, len(weight) - number)[len(weight) - number]
        term, weight = term[most], weight[most]
    strongest = term[np.argsort(-weight, kind="stable")[:number]]
    return strongest[np.lexsort((strongest, -frequency[strongest]))][:_KEYS]


def _in_order(rows: DataFrame, width: int, sent, documents: int, parts: int, k1: float, b: float) -> DataFrame:
    """The documents of the whole corpus by their key terms, in up to ``parts`` ranges of keys, so no key is bound to one task.

    The limits of the ranges are keys of some rows (about ``_LIMIT_ROWS`` a range), so the terms of the others are
    counted once.
    """
    dtype, names = f"<u{width}", [f"key{i}" for i in range(_KEYS)]
    context, order = rows.sparkSession.sparkContext, [*names, "doc_id", "mark"]

    def keyed(rows: DataFrame, limits) -> DataFrame:
        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            (idf, mean_length, frequency), bounds = sent.value, limits.value
            for batch in batches:
                keys = np.full((_KEYS, batch.num_rows), -1, np.int32)
                marks, part = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int32)
                for row, (name, raw) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                    found = key_terms(*_weighed(np.frombuffer(raw, dtype), idf, mean_length, k1, b), frequency)
                    keys[: len(found), row], marks[row] = found, zlib.crc32(raw)
                    part[row] = bisect_right(bounds, _place((*keys[:, row].tolist(), name, int(marks[row]))))
                yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, (*keys, marks, part))], ["doc_id", "ids", *order[:-2], "mark", "part"])

        fields = "doc_id long, ids binary, " + ", ".join(f"{n} int" for n in names) + ", mark long, part int"
        return rows.mapInArrow(task, fields)

    bounds = []
    if parts > 1:
        some = rows.sample(min(1.0, parts * _LIMIT_ROWS / documents), seed=1)
        found = sorted({_place(row) for row in keyed(some, context.broadcast([])).select(*order).collect()})
        bounds = [found[len(found) * i // parts] for i in range(1, parts) if found]
    dealt = keyed(rows, context.broadcast(bounds)).repartitionById(parts, "part")
    return dealt.sortWithinPartitions(*order).select("doc_id", "ids")


class Shard:
    """Inverted index over some documents, and the windows their retrieval fills."""

    def __init__(self, names, ids, idf, mean_length, query_terms, k1, b):
        self.names, self.ids = names, ids
        self.lengths, codes = np.array([len(x) for x in ids]), {}
        self.codes = np.array([codes.setdefault(name, len(codes)) for name in names])
        self.copies = len(codes) < len(names)
        terms, weights = zip(*(_weighed(own, idf, mean_length, k1, b) for own in ids))
        self.strongest = []
        for term, weight in zip(terms, weights):
            if query_terms is not None and len(term) > query_terms:
                term = term[np.argpartition(-weight, query_terms - 1)[:query_terms]]
            self.strongest.append(term)
        term, docs = np.concatenate(terms), np.repeat(np.arange(len(ids)), [len(own) for own in terms])
        order = np.argsort(term.astype(np.min_scalar_type(len(idf))), kind="stable")
        self.docs, self.weights = docs[order], np.concatenate(weights)[order]
        sizes = np.bincount(term, minlength=len(idf))
        self.starts = np.concatenate([[0], np.cumsum(sizes)])
        # The documents in the index; terms that many of them have are rows with a weight for each.
        self.members = np.arange(len(ids))
        common = np.flatnonzero(sizes > _COMMON * len(ids))
        self.row = np.full(len(idf), -1)
        self.row[common] = np.arange(len(common))
        self.rows = np.zeros((len(common), len(ids)))
        for own, a, b in zip(self.rows, self.starts[common].tolist(), self.starts[common + 1].tolist()):
            own[self.docs[a:b]] = self.weights[a:b]
        self._choose(np.repeat(self.row < 0, sizes))

    def neighbours(self, seed: int, unused: np.ndarray) -> np.ndarray:
        """Unused documents with a term of the seed, best first."""
        scores = self._scores(seed, unused)
        found = np.flatnonzero(scores)
        return self.members[found[np.argsort(-scores[found], kind="stable")]]

    def _scores(self, seed: int, unused: np.ndarray) -> np.ndarray:
        """Scores of the documents in the index; zero for one without a term of the seed and for used ones."""
        terms = self.strongest[seed]
        rows = self.row[terms]
        terms, rows = terms[rows < 0], rows[rows >= 0].tolist()
        spans = [*zip(self.starts[terms].tolist(), self.starts[terms + 1].tolist())]
        docs = np.concatenate([self.docs[:0], *(self.docs[a:b] for a, b in spans)])
        weights = np.concatenate([self.weights[:0], *(self.weights[a:b] for a, b in spans)])
        scores = np.bincount(docs, weights, len(self.members)).astype(float, copy=False)
        for row in rows:
            scores += self.rows[row]
        scores *= unused[self.members]
        return scores

    def _choose(self, kept: np.ndarray) -> None:
        """Only some of the index's single entries remain."""
        self.starts = np.concatenate([[0], np.cumsum(kept)])[self.starts]
        self.docs, self.weights = self.docs[kept], self.weights[kept]

    def _keep(self, unused: np.ndarray) -> None:
        """Take the documents that are used out of the index once they are a fifth of it."""
        kept = unused[self.members]
        if np.count_nonzero(kept) < 0.8 * len(kept):
            self._choose(kept[self.docs])
            self.docs = (np.cumsum(kept) - 1)[self.docs]
            self.rows, self.members = self.rows[:, kept], self.members[kept]

    def windows(self, size: int) -> Iterator[list[tuple[int, int, int]]]:
        """Lists of (document, start, length) that add up to ``size``, the last one to less."""
        unused = np.ones(len(self.names), bool)
        window, room, following = [], size, 0
        rest = None  # (document, start) of the part that is not packed yet
        while True:
            if rest is None:
                while following < len(unused) and not unused[following]:
                    following += 1
                if following == len(unused):
                    break
                rest, unused[following] = (following, 0), False
            seed, start = rest
            length = int(min(room, self.lengths[seed] - start))
            window.append((seed, start, length))
            room -= length
            start += length
            rest = (seed, start) if start < self.lengths[seed] else None
            if room and rest is None:
                rest = self._fill(seed, unused, window, room)
                room = size - sum(piece[2] for piece in window)
            if not room:
                yield window
                window, room = [], size
        if window:
            yield window

    def _fill(self, seed, unused, window, room):
        """Add the neighbours that fit; returns the best that does not, to be cut."""
        self._keep(unused)
        scores, too_long = self._scores(seed, unused), None
        lengths = self.lengths[self.members]
        # A copy of what the window holds is left out.
        if self.copies:
            codes = self.codes[self.members]
            scores[np.isin(codes, self.codes[[piece[0] for piece in window]])] = 0
        while len(scores) and scores[best := int(scores.argmax())] > 0:
            number, length = int(self.members[best]), int(lengths[best])
            if length > room:
                if too_long is None:
                    too_long = number
                scores[lengths > room] = 0
                continue
            window.append((number, 0, length))
            unused[number] = False
            room -= length
            if not room:
                return None
            scores[best] = 0
            if self.copies:
                scores[codes == codes[best]] = 0
        if too_long is None:
            return None
        unused[too_long] = False
        return too_long, 0


def _sequences(windows: Iterator[list], size: int) -> Iterator[list[tuple[int, int, int]]]:
    """The windows; one that is not full is cut into lengths that are powers of two."""
    for window in windows:
        left = sum(piece[2] for piece in window)
        if left == size:
            yield window
            continue
        pieces = list(reversed(window))
        while left:
            room = 1 << (left.bit_length() - 1)
            left -= room
            cut = []
            while room:
                number, start, length = pieces.pop()
                taken = min(room, length)
                cut.append((number, start, taken))
                room -= taken
                if taken < length:
                    pieces.append((number, start + taken, length - taken))
            yield cut


def pack(
    docs: DataFrame,
    vocabulary: str,
    end_id: int,
    window: int = 4096,
    shard_tokens: int = 3_000_000,
    query_terms: int | None = None,
    k1: float = 1.2,
    b: float = 0.75,
    with_ids: bool = True,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per piece of a document: its place in the document and in a sequence, and its ids.

    ``doc_tokens`` counts the document's ids with the end id; ``ids`` are 32-bit little-endian, ``ids_crc32`` is their
    checksum. Null texts are empty documents of one id. Rows that repeat an id are documents of their own; in one
    window they do not meet unless one is cut. A seed asks with all its terms, or with its ``query_terms`` strongest
    if that is set. An empty table gives no rows.
    """
    rows, width = tokenized(docs, vocabulary, end_id, id_column, text_column)
    rows = stored(rows)
    frequency, documents, tokens = _statistics(rows)
    rows = rows.filter("counts is null").select("doc_id", "ids")
    idf = np.log1p((documents - frequency + 0.5) / (frequency + 0.5))
    sent = docs.sparkSession.sparkContext.broadcast((idf, tokens / max(documents, 1), frequency))
    dtype = f"<u{width}"

    def packed(names, ids, sequence) -> Iterator[pa.RecordBatch]:
        shard = Shard(names, ids, *sent.value[:2], query_terms, k1, b)
        out = [[] for _ in range(8)]
        for pieces in _sequences(shard.windows(window), window):
            offset = 0
            for number, start, length in pieces:
                own = ids[number][start : start + length].astype("<u4").tobytes()
                row = (names[number], start, length, zlib.crc32(own), len(ids[number]), sequence, offset, own if with_ids else None)
                for column, value in zip(out, row):
                    column.append(value)
                offset += length
            sequence += 1
        kinds = [pa.int64()] * 7 + [pa.binary()]
        arrays = [pa.array(column, kind) for column, kind in zip(out, kinds)]
        yield sequence, pa.RecordBatch.from_arrays(arrays, [f.split()[0] for f in PIECES.split(", ")])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence = TaskContext.get().partitionId() << 36
        names, ids, total = [], [], 0
        for batch in batches:
            for name, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                names.append(name)
                ids.append(np.frombuffer(raw, dtype))
                total += len(ids[-1])
                if total >= shard_tokens:
                    for sequence, out in packed(names, ids, sequence):
                        yield out
                    names, ids, total = [], [], 0
        if names:
            for sequence, out in packed(names, ids, sequence):
                yield out

    # A task gets a whole shard at least.
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(min(tasks, tokens // shard_tokens), 1)
    pieces = _in_order(rows, width, sent, documents, parts, k1, b).mapInArrow(task, PIECES)
    return pieces if with_ids else pieces.drop("ids")
