"""Vectorised words, word hashes and word n-gram hashes of many texts at once.

Texts of a batch are laid end to end as UTF-8 bytes.  Equal words of a batch are found by their
bytes (an Arrow dictionary), and each distinct word is hashed once, to 128 bits
by XXH3, of which two independent 64-bit halves are handed out.  An n-gram's hash
takes its words' hashes in one after the other, each through a full mixing step, so
no arrangement of words cancels out.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

#: A-Z as a-z.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True

def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser: every output bit depends on every input bit."""
    with np.errstate(over="ignore"):
        x = x + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x1F83D9ABFB41BD6B) & 0xFFFFFFFFFFFFFFFF)
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


def join_texts(texts: Iterable[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """One byte array and ``n + 1`` offsets; a null text is empty."""
    texts = [t or b"" for t in texts]
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=offsets[1:])
    return np.frombuffer(b"".join(texts), np.uint8), offsets


def find_words(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word starts and ends (bytes), and per text the index of its first word."""
    if not len(buf):
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(len(offsets), np.int64)
    space = IS_SPACE[buf]
    begins = ~space
    first = np.zeros(len(buf) + 1, bool)
    first[offsets] = True  # a text's first byte never continues the word before it
    begins[1:] &= space[:-1] | first[1:-1]
    starts = np.flatnonzero(begins)
    last = ~space
    last[:-1] &= space[1:] | first[1:-1]
    ends = np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def hash_spans(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each span ``buf[start:end]``, the halves of its XXH3."""
    import pyarrow as pa
    from xxhash import xxh3_128_digest

    size = ends - starts
    offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    data = buf[np.repeat(starts - offsets[:-1], size) + np.arange(offsets[-1])]
    spans = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(data)]).dictionary_encode()
    both = np.frombuffer(b"".join(map(xxh3_128_digest, spans.dictionary.to_pylist())), "<u8").reshape(-1, 2)
    code = spans.indices.to_numpy(zero_copy_only=False)
    return both[code, 0], both[code, 1]


def hash_ngrams(words: np.ndarray, k: int, seed: int = 1) -> np.ndarray:
    """Hashes of the ``k`` words from each position; the last ``k - 1`` positions mean nothing
    to the caller unless they lie inside one text."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, k, np.uint64)
    for j in range(k):
        out = mix(out ^ words[j : j + n], seed)
    return out


def ngram_owner(first_word: np.ndarray, k: int, n: int) -> np.ndarray:
    """For n-gram start positions ``0..n-1`` the text index, or -1 where the n-gram leaves its text."""
    owner = np.repeat(np.arange(len(first_word) - 1, dtype=np.int64), np.diff(first_word))
    if n <= 0:
        return owner[:0]
    return np.where(owner[:n] == owner[k - 1 : k - 1 + n], owner[:n], -1)


def bytes_of(column) -> list[bytes | None]:
    """An Arrow string or binary column as bytes objects."""
    import pyarrow as pa

    return column.cast(pa.binary()).to_pylist() if not pa.types.is_large_string(column.type) else column.cast(pa.large_binary()).to_pylist()


def slices(sizes: list[int], most: int) -> Iterable[slice]:
    """Consecutive slices whose sizes add up to about ``most`` (one over-long item stands alone)."""
    at = total = 0
    for i, size in enumerate(sizes):
        if i > at and total + size > most:
            yield slice(at, i)
            at, total = i, 0
        total += size
    if at < len(sizes):
        yield slice(at, len(sizes))


def parts(column, most: int) -> Iterator[tuple[slice, list[bytes | None]]]:
    """An Arrow text column a few megabytes at a time: the rows' slice and their texts as bytes."""
    import pyarrow.compute as pc

    for part in slices(pc.fill_null(pc.binary_length(column), 0).to_pylist(), most):
        yield part, bytes_of(column.slice(part.start, part.stop - part.start))
    release()


def release() -> None:
    """Hand memory kept for later back to the system: workers live on, idle, beside the JVM."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # where the C library has it
        trim(0)
