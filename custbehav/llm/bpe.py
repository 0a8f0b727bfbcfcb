"""Token counts by byte-pair merging with a heap and a linked list.

A pre-token starts as one symbol per byte. The heap holds the adjacent pairs that have a rank; the lowest rank
(leftmost on a tie) is popped, its two symbols become one, and the pairs with the new neighbours go in.
A pair that changed meanwhile is recognised by its stamp and skipped. The count of a pre-token is its initial
symbols minus its merges; no identifier is formed. A pre-token of n bytes costs n log n, so a text without
spaces is no danger. Counts of short pre-tokens are kept per worker in a table of bounded size.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from custbehav.llm.common import columns

_SPACE = r"\t-\r \x85\xa0  -     　"
# Fixed value: how the vocabulary's library cuts a text into pre-tokens.
PRE_TOKENS = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^%s\p{L}\p{N}]+|[%s]+(?![^%s])|[%s]+" % ((_SPACE,) * 4)
)
_STARTS_WITH_SPACE = regex.compile(f"[{_SPACE}]")
_KEEP_LENGTH, _KEEP_NUMBER = 48, 700_000


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in the vocabulary file."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    names = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}
    return [names[b] for b in range(256)]


class _Irregular(Exception):
    """White space that makes a text's words depend on one another."""


class MergeCounter(dict):
    """Number of tokens of a pre-token; a dict, so that known ones cost one lookup."""

    def __init__(self, vocabulary: str):
        content = json.loads(vocabulary)
        self.ranks = {tuple(pair): rank for rank, pair in enumerate(content["model"]["merges"])}
        self.symbols = byte_symbols()
        self.specials = [token["content"] for token in content["added_tokens"]]
        self.cut = regex.compile("|".join(map(regex.escape, self.specials))) if self.specials else None
        self.words = _Words(self)

    def merged(self, pre_token: str) -> int:
        symbols = self.symbols
        text = [symbols[b] for b in pre_token.encode("utf-8", "replace")]
        count = len(text)
        if count < 2:
            return count
        ranks = self.ranks
        after = list(range(1, count + 1))
        before = list(range(-1, count - 1))
        end = count
        heap = []
        for i in range(count - 1):
            rank = ranks.get((text[i], text[i + 1]))
            if rank is not None:
                heap.append((rank, i, text[i], text[i + 1]))
        heapify(heap)
        while heap:
            _, left, a, b = heappop(heap)
            right = after[left]
            if right >= end or text[left] != a or text[right] != b:
                continue
            text[left] = a + b
            text[right] = None
            follower = after[left] = after[right]
            count -= 1
            if follower < end:
                before[follower] = left
                rank = ranks.get((text[left], text[follower]))
                if rank is not None:
                    heappush(heap, (rank, left, text[left], text[follower]))
            ahead = before[left]
            if ahead >= 0:
                rank = ranks.get((text[ahead], text[left]))
                if rank is not None:
                    heappush(heap, (rank, ahead, text[ahead], text[left]))
        return count

    def __missing__(self, pre_token: str) -> int:
        return _keep(self, pre_token, self.merged(pre_token))

    def plain(self, text: str) -> int:
        """Tokens of a text without special tokens.

        A pre-token takes one space before it, so the text can be cut before every space and the words be
        looked up whole, unless there is white space on both sides of a space: then it is cut as a whole.
        """
        first, *rest = text.split(" ")
        try:
            return sum(map(self.__getitem__, PRE_TOKENS.findall(first))) + sum(map(self.words.__getitem__, rest))
        except _Irregular:
            return sum(map(self.__getitem__, PRE_TOKENS.findall(text)))

    def tokens(self, text: str) -> int:
        """Tokens of a text; a special token's string inside it is one token."""
        if self.cut and any(special in text for special in self.specials):
            parts = self.cut.split(text)
            return len(parts) - 1 + sum(map(self.plain, parts))
        return self.plain(text)


class _Words(dict):
    """Number of tokens of a word with a space before it."""

    def __init__(self, counter: MergeCounter):
        self.counter = counter

    def __missing__(self, word: str) -> int:
        if not word or _STARTS_WITH_SPACE.match(word):
            raise _Irregular
        pre_tokens = PRE_TOKENS.findall(" " + word)
        return _keep(self, word, sum(map(self.counter.__getitem__, pre_tokens)))


def _keep(known: dict, key: str, count: int) -> int:
    if len(key) <= _KEEP_LENGTH and "\n" not in key:
        if len(known) >= _KEEP_NUMBER:
            known.clear()
        known[key] = count
    return count


_COUNTERS: dict[int, MergeCounter] = {}


def token_counts(
    docs: DataFrame, vocabulary: str, limit: int = 512, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more than ``limit``).

    ``vocabulary`` is the path of the vocabulary file on the driver; its content, of fixed size, is
    broadcast. Null texts are empty and have no token; repeated rows are counted each; an empty table gives no rows.
    """
    with open(vocabulary, encoding="utf-8") as file:
        content = docs.sparkSession.sparkContext.broadcast(file.read())

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = hash(content.value)
        counter = _COUNTERS.get(key)
        if counter is None:
            counter = _COUNTERS[key] = MergeCounter(content.value)
        for batch in batches:
            texts = ["" if t is None else t for t in batch.column(1).to_pylist()]
            counts = pa.array([counter.tokens(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), counts], ["doc_id", "n_bytes", "n_tokens"])

    rows = columns(docs, doc_id=id_column, text=text_column)
    size = F.octet_length(F.coalesce("text", F.lit(""))).cast("long")
    rows = rows.select(F.col("doc_id").cast("long").alias("doc_id"), "text", size.alias("n_bytes"))
    counted = rows.mapInArrow(task, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
