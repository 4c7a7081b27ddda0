"""Exact removal of repeated word windows behind a count-min prefilter.

A window is ``k`` consecutive words of one document.  Every word covered by a
window that also starts in a document with a smaller id is removed.

Two passes over the windows:

1. *Prefilter.*  Each chunk of documents sketches its windows: one row of
   ``2**CELL_BITS`` counters of documents.  Only the counters it touches
   travel, as sorted differences (two to three bytes a window), cut into
   segments of the counter range.  A segment's task adds up the sketches of
   all chunks and answers each chunk with one bit a counter: two documents
   or more, or not.  Different windows may share a counter, so a count can
   be too high, never too low: no repeated window is lost.
2. *Exact grouping.*  Only windows estimated repeated are grouped, by a
   96-bit fingerprint of their words (of two independent hashes of each word): each chunk sends a fingerprint once
   with its least document, a segment's task finds the least document of
   all chunks and answers with one bit a fingerprint: the least lies in
   another chunk, or not.

At scale: no sketch is ever whole anywhere; segments and chunks grow in
number with the input, not in size, and a chunk sends a window once however
often it holds it, so a passage that a third of the documents share costs one
entry a chunk.  Texts are shuffled once (the chunks), and that shuffle is
read by all passes.

Cases: a null or wordless text has no words and an empty kept text; fewer
than ``k`` words make no window; rows that repeat an id do not remove each
other's words (no id is smaller); a null id counts as larger than all ids; an
empty table gives no rows; very long texts are whole (a chunk holds one
document at least); other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pieces_of, text_bytes
from .textcore import bytes_of, find_words, hash_ngrams, hash_spans, join_texts, ngram_owner

CELL_BITS = 40
CHUNK_BYTES = 4 << 20
SEGMENT_BYTES = 12 << 20
_LAST_ID = np.int64(2**63 - 1)


def _pack(values: np.ndarray) -> bytes:
    """Unsigned integers as byte planes, without the planes that are all zero."""
    if not len(values):
        return b""
    width = max(1, (int(values.max()).bit_length() + 7) // 8)
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def _unpack(blob: bytes, n: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    if n:
        planes = np.frombuffer(blob, np.uint8).reshape(-1, n)
        out[:, : len(planes)] = planes.T
    return out.view("<u8").reshape(-1)


def _cuts(sorted_hashes: np.ndarray, segments: int) -> np.ndarray:
    """Positions where the segments of the 64-bit range begin in sorted hashes."""
    edges = np.asarray([(i << 64) // segments for i in range(1, segments)], np.uint64)
    return np.concatenate([[0], np.searchsorted(sorted_hashes, edges), [len(sorted_hashes)]]).astype(np.int64)


def _cell_cuts(cells: np.ndarray, segments: int) -> np.ndarray:
    """``_cuts`` by the cell alone, so a counter goes to one segment from every chunk."""
    return _cuts(cells << np.uint64(64 - CELL_BITS), segments)


def _deltas(x: np.ndarray) -> np.ndarray:
    return np.diff(x, prepend=np.uint64(0))


class _Chunk:
    """Words and windows of one chunk, in an order that every pass finds again."""

    def __init__(self, table: pa.Table, k: int):
        batch = table.combine_chunks()
        ids = batch.column("doc_id").combine_chunks() if isinstance(batch.column("doc_id"), pa.ChunkedArray) else batch.column("doc_id")
        texts = batch.column("text").combine_chunks() if isinstance(batch.column("text"), pa.ChunkedArray) else batch.column("text")
        keys = ids.fill_null(int(_LAST_ID)).to_numpy(zero_copy_only=False)
        raw = bytes_of(texts)
        order = sorted(range(len(raw)), key=lambda i: (keys[i], raw[i] or b""))
        self.ids = ids.take(pa.array(order, pa.int64()))
        self.keys = keys[order] if len(order) else keys
        self.buf, self.offsets = join_texts([raw[i] for i in order])
        self.starts, self.ends, self.first = find_words(self.buf, self.offsets)
        words, self.others = hash_spans(self.buf, self.starts, self.ends)
        h1 = hash_ngrams(words, k, seed=1)
        owner = ngram_owner(self.first, k, len(h1))
        self.at = np.flatnonzero(owner >= 0)  # window starts, as word numbers
        h1, self.owner = h1[self.at], owner[self.at]
        self.order = np.argsort(h1, kind="stable")
        self.h1 = h1[self.order]
        self.k = k

    def cells(self) -> tuple[np.ndarray, np.ndarray]:
        """For each distinct counter, in order: where its windows begin in ``order``,
        and whether documents of this chunk share it."""
        cell = self.h1 >> np.uint64(64 - CELL_BITS)
        new = np.flatnonzero(np.diff(cell, prepend=~cell[:1]) != 0)
        owner = self.owner[self.order]
        last = np.append(new[1:], len(cell)) - 1
        return new, self._differs(owner, new, last)

    @staticmethod
    def _differs(owner: np.ndarray, new: np.ndarray, last: np.ndarray) -> np.ndarray:
        if not len(new):
            return np.zeros(0, bool)
        return np.minimum.reduceat(owner, new) != np.maximum.reduceat(owner, new)

    def repeated(self, bits: list[tuple[int, int, bytes]]) -> np.ndarray:
        """Positions in ``order`` of the windows estimated repeated, by the answers to ``cells``."""
        new, _ = self.cells()
        flags = _answers(bits)
        return np.flatnonzero(np.repeat(flags, np.diff(np.append(new, len(self.h1)))))

    def keyed(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Windows ``at``, ordered by fingerprint: window numbers, both hash parts, and group starts."""
        h2 = hash_ngrams(self.others, self.k, seed=2)[self.at][self.order[at]] >> np.uint64(32)
        h1 = self.h1[at]
        order = np.lexsort((h2, h1))
        h1, h2, window = h1[order], h2[order], self.order[at][order]
        new = np.flatnonzero((np.diff(h1, prepend=~h1[:1]) != 0) | (np.diff(h2, prepend=~h2[:1]) != 0))
        return window, h1, h2, new


def _answers(bits: list[tuple[int, int, bytes]]) -> np.ndarray:
    """Answer bits of all segments in order."""
    parts = [np.unpackbits(np.frombuffer(b, np.uint8), count=n) for _, n, b in sorted(bits)]
    return np.concatenate(parts).astype(bool) if parts else np.zeros(0, bool)


def _bits(table: pa.Table, step: int) -> list[tuple[int, int, bytes]]:
    return [(r["segment"], r["n"], r["bits"]) for r in table.to_pylist() if r["step"] == step]


_SENT = "segment int, chunk long, n int, a binary, b binary, c binary, ids binary"
_ANSWER = "chunk long, segment int, step int, n int, bits binary"
_SENT_ARROW = pa.schema([("segment", pa.int32()), ("chunk", pa.int64()), ("n", pa.int32()), ("a", pa.binary()), ("b", pa.binary()), ("c", pa.binary()), ("ids", pa.binary())])
_ANSWER_ARROW = pa.schema([("chunk", pa.int64()), ("segment", pa.int32()), ("step", pa.int32()), ("n", pa.int32()), ("bits", pa.binary())])


def _sent(rows: list[tuple]) -> pa.Table:
    return pa.Table.from_arrays([pa.array(list(c), f.type) for c, f in zip(list(zip(*rows)) or [()] * 7, _SENT_ARROW)], schema=_SENT_ARROW)


def _answer(rows: list[tuple]) -> pa.Table:
    return pa.Table.from_arrays([pa.array(list(c), f.type) for c, f in zip(list(zip(*rows)) or [()] * 5, _ANSWER_ARROW)], schema=_ANSWER_ARROW)


def remove_repeats(docs: DataFrame, k: int = 13) -> DataFrame:
    """``doc_id, n_words, n_removed, text`` per row: the kept words, joined by one blank."""
    total = text_bytes(docs)
    chunks, segments = pieces_of(total, CHUNK_BYTES), pieces_of(total, SEGMENT_BYTES)
    dealt = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text"),
        # the row's number too, so that rows that repeat an id and a text do not fill one chunk
        F.pmod(F.xxhash64("doc_id", F.monotonically_increasing_id()), F.lit(chunks)).cast("long").alias("chunk"),
    )

    def sketch(table: pa.Table) -> pa.Table:
        name = table.column("chunk")[0].as_py()
        chunk = _Chunk(table, k)
        new, shared = chunk.cells()
        cell = chunk.h1[new] >> np.uint64(64 - CELL_BITS)
        cut = _cell_cuts(cell, segments)
        return _sent([
            (i, name, int(b - a), _pack(_deltas(cell[a:b])), np.packbits(shared[a:b]).tobytes(), None, None)
            for i, (a, b) in enumerate(zip(cut[:-1], cut[1:])) if b > a
        ])

    def merge_sketches(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        cells = [np.cumsum(_unpack(r["a"], r["n"]), dtype=np.uint64) for r in rows]
        every = np.sort(np.concatenate(cells))
        many = [every[1:][every[1:] == every[:-1]]]
        many += [c[np.unpackbits(np.frombuffer(r["b"], np.uint8), count=r["n"]).astype(bool)] for c, r in zip(cells, rows)]
        many = np.unique(np.concatenate(many))
        return _answer([
            (r["chunk"], r["segment"], 1, r["n"], np.packbits(_among(c, many)).tobytes()) for c, r in zip(cells, rows)
        ])

    def fingerprints(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _sent([])
        name = table.column("chunk")[0].as_py()
        chunk = _Chunk(table, k)
        window, h1, h2, new = chunk.keyed(chunk.repeated(_bits(answers, 1)))
        if not len(new):
            return _sent([])
        least = np.minimum.reduceat(chunk.owner[window], new)  # documents are in the order of their ids
        docs_here, rank = np.unique(chunk.keys[least], return_inverse=True)
        h1, h2 = h1[new], h2[new]
        cut = _cuts(h1, segments)
        return _sent([
            (i, name, int(b - a), _pack(_deltas(h1[a:b])), h2[a:b].astype("<u4").tobytes(), _pack(rank[a:b].astype(np.uint64)), docs_here.astype("<i8").tobytes())
            for i, (a, b) in enumerate(zip(cut[:-1], cut[1:])) if b > a
        ])

    def group_fingerprints(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        h1 = np.concatenate([np.cumsum(_unpack(r["a"], r["n"]), dtype=np.uint64) for r in rows])
        h2 = np.concatenate([np.frombuffer(r["b"], "<u4") for r in rows])
        own = np.concatenate([np.frombuffer(r["ids"], "<i8")[_unpack(r["c"], r["n"]).astype(np.int64)] for r in rows])
        order = np.lexsort((h2, h1))
        a, b = h1[order], h2[order]
        new = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
        least = np.repeat(np.minimum.reduceat(own[order], new), np.diff(np.append(new, len(a))))
        elsewhere = np.empty(len(a), bool)
        elsewhere[order] = least < own[order]
        at = np.concatenate([[0], np.cumsum([r["n"] for r in rows])])
        return _answer([
            (r["chunk"], r["segment"], 2, r["n"], np.packbits(elsewhere[at[i] : at[i + 1]]).tobytes()) for i, r in enumerate(rows)
        ])

    def remove(table: pa.Table, answers: pa.Table) -> pa.Table:
        schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("text", pa.string())])
        if not table.num_rows:
            return schema.empty_table()
        chunk = _Chunk(table, k)
        window, _, _, new = chunk.keyed(chunk.repeated(_bits(answers, 1)))
        covered = np.zeros(len(chunk.starts) + 1, np.int64)
        if len(new):
            size = np.diff(np.append(new, len(window)))
            keys = chunk.keys[chunk.owner[window]]
            gone = np.repeat(_answers(_bits(answers, 2)), size) | (np.repeat(np.minimum.reduceat(keys, new), size) < keys)
            begin = chunk.at[window[gone]]
            np.add.at(covered, begin, 1)
            np.add.at(covered, begin + k, -1)
        kept = np.cumsum(covered[:-1]) == 0
        n_words = np.diff(chunk.first)
        before = np.concatenate([[0], np.cumsum(kept)])[chunk.first]
        starts, size = chunk.starts[kept], (chunk.ends - chunk.starts)[kept] + 1
        stop = np.cumsum(size)
        source = np.repeat(starts - (stop - size), size) + np.arange(int(stop[-1]) if len(stop) else 0)
        out = chunk.buf[np.minimum(source, len(chunk.buf) - 1)] if len(source) else chunk.buf[:0]
        out[stop - 1] = 32
        edge = np.concatenate([[0], stop])[before]
        raw = out.tobytes()
        texts = [raw[a : max(a, b - 1)].decode() for a, b in zip(edge[:-1].tolist(), edge[1:].tolist())]
        return pa.Table.from_arrays([chunk.ids, pa.array(n_words, pa.int64()), pa.array(n_words - np.diff(before), pa.int64()), pa.array(texts, pa.string())], schema=schema)

    by_chunk = dealt.groupBy("chunk")
    sent = by_chunk.applyInArrow(sketch, _SENT)
    first = sent.groupBy("segment").applyInArrow(merge_sketches, _ANSWER)
    keys = by_chunk.cogroup(first.groupBy("chunk")).applyInArrow(fingerprints, _SENT)
    second = keys.groupBy("segment").applyInArrow(group_fingerprints, _ANSWER)
    both = first.unionByName(second)
    return by_chunk.cogroup(both.groupBy("chunk")).applyInArrow(remove, "doc_id long, n_words long, n_removed long, text string")


def _among(x: np.ndarray, sorted_set: np.ndarray) -> np.ndarray:
    if not len(sorted_set):
        return np.zeros(len(x), bool)
    place = np.searchsorted(sorted_set, x)
    return sorted_set[np.minimum(place, len(sorted_set) - 1)] == x
