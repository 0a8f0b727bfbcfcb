"""Words of texts inside Arrow tasks, as bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Every byte that is no digit, letter or part of a character beyond ASCII becomes a space; A-Z become a-z.
_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)
# Text handled at a time; a longer one is handled alone.
_SLICE_BYTES = 4 << 20


def plain_words(text: bytes) -> list[bytes]:
    """Runs of digits, letters and characters beyond ASCII, with A-Z in lower case."""
    return text.translate(_BYTES).split()


def slices(batch: pa.RecordBatch, column: str) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Parts of a batch of bounded size with their texts; null is empty."""
    texts = [t or b"" for t in batch.column(column).cast(pa.binary()).to_pylist()]
    start, held = 0, 0
    for i, text in enumerate(texts):
        if i > start and held + len(text) > _SLICE_BYTES:
            yield batch.slice(start, i - start), texts[start:i]
            start, held = i, 0
        held += len(text)
    if start < len(texts):
        yield batch.slice(start), texts[start:]


def encoded(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words per text, the place of every word in the list of distinct words, and that list."""
    split = [plain_words(t) for t in texts]
    sizes = np.fromiter(map(len, split), np.int64, len(split))
    words = pa.array([w for own in split for w in own], pa.large_binary()).dictionary_encode()
    return sizes, words.indices.to_numpy(zero_copy_only=False).astype(np.int64), words.dictionary
