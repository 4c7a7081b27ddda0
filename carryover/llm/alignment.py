"""Alignment of two tokenizers over the same texts, and how often their ids meet.

Each text, with a blank before it, is encoded by a byte-level BPE file (A) and by a
sentencepiece model (B, which adds the blank itself).  Both token rows cover the
same bytes, so each is a rising list of end offsets:

* *Galloping intersection*: the shorter end list drives.  For each of its
  ends the place in the longer list is found by exponential search from
  the place of the end before it, then binary search between the last two
  probes.  Blocks of ``BLOCK`` ends of all texts of a batch step together, each
  block's first end galloping from its text's start, so a step is a few array
  passes and no place is looked for from scratch.
* Ends that both lists hold slice the tokens into groups.
* The place found for an end is its rank in the other list; the ranks of a
  token's start and end differ by the tokens it overlaps.  Those ranges are the links.

A link is an occurrence of an (A id, B id) pair.  Its count, over all texts, is
found without a shuffle of texts or links, and with every text encoded once:

1. A task reads its texts in chunks of about ``CHUNK_BYTES`` (an over-long text is whole).  A chunk
   keeps its distinct pairs as a rising list; each document is stored as places in
   that list with their numbers, a byte or two each, and the list, with the chunk's
   sums, in one packed row for each of ``SEGMENTS`` parts of the B ids.
2. A segment's task reads its rows as a stream and adds them up.  What it holds is
   bounded by the two vocabularies, not by the corpus.
3. The totals go ahead of the same rows in a second stream of the segment, which
   answers every chunk: the total of each of its pairs, and whether it is the
   highest of its B id.
4. Documents meet the answers of their chunk and add them up.

No key of the data decides the chunk, so no hot key can fill one, and the rows sent grow
in proportion to the input: ``SEGMENTS`` a chunk at most, however many chunks there are.

Cases: a null or empty text, and one whose joined A or B bytes are not the blank and the
text (a text that holds sentencepiece's own mark), has no tokens: zeros and an empty
``groups_sha256``; repeated rows are documents of their own and each counts;
ids may be null or tied; an empty table gives no rows; very long texts are whole;
other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .textcore import parts
from .tokens import byte_pairs, sentence_pieces

CHUNK_BYTES = 8 << 20
BATCH_BYTES = 1 << 20
#: What a row counts besides its text, so that empty texts fill chunks too.
ROW_BYTES = 64
SEGMENTS = 256
BLOCK = 64


def gallop(longer: np.ndarray, targets: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each target the first place from ``at`` on where ``longer`` is not less.

    ``longer`` rises and its last value is no less than any target."""
    low, high, last = at.copy(), at.copy(), len(longer) - 1
    left = np.flatnonzero(longer[high] < targets)
    step = 1
    while len(left):  # exponential: longer[high] is less, so the place lies behind it
        low[left] = high[left] + 1
        high[left] = np.minimum(high[left] + step, last)
        step *= 2
        left = left[longer[high[left]] < targets[left]]
    left = np.flatnonzero(low < high)
    while len(left):  # binary: the place lies in low..high
        middle = (low[left] + high[left]) >> 1
        less = longer[middle] < targets[left]
        low[left[less]] = middle[less] + 1
        high[left[~less]] = middle[~less]
        left = left[low[left] < high[left]]
    return low


def intersect(driver: np.ndarray, driver_first: np.ndarray, longer: np.ndarray, longer_first: np.ndarray) -> np.ndarray:
    """The place in ``longer`` of each end of ``driver`` (of the first end not less).

    Both hold the ends of several texts end to end; ``*_first`` is where each text begins."""
    sizes = np.diff(driver_first)
    blocks = -(-sizes // BLOCK)
    text = np.repeat(np.arange(len(sizes)), blocks)
    within = np.arange(len(text)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    begin = driver_first[:-1][text] + within * BLOCK
    size = np.minimum(driver_first[1:][text] - begin, BLOCK)
    place = np.empty(len(driver), np.int64)
    at = longer_first[:-1][text]
    for j in range(int(size.max(initial=0))):
        live = size > j
        if not live.all():
            begin, size, at = begin[live], size[live], at[live]
        at = gallop(longer, driver[begin + j], at)
        place[begin + j] = at
    return place


class Aligned:
    """Two token rows of several texts, aligned.

    ``a``, ``b``: ids; ``a_first``, ``b_first``: where each text begins in them; ``a_common``,
    ``b_common``: places of the ends that both hold; ``link_a``, ``link_b``, ``link_text``: the links."""

    def __init__(self, a: list[np.ndarray], b: list[np.ndarray], a_width: np.ndarray, b_width: np.ndarray):
        n = len(a)
        self.a = np.concatenate([*a, np.zeros(0, np.int64)]).astype(np.int64)
        self.b = np.concatenate([*b, np.zeros(0, np.int64)]).astype(np.int64)
        self.a_first = np.concatenate([[0], np.cumsum([len(x) for x in a])]).astype(np.int64)
        self.b_first = np.concatenate([[0], np.cumsum([len(x) for x in b])]).astype(np.int64)
        ends = np.cumsum(a_width[self.a]), np.cumsum(b_width[self.b])  # texts end to end: they end alike
        a_drives = np.diff(self.a_first) <= np.diff(self.b_first)
        common, links = ([], []), ([], [], [])
        for drives, (side, other) in ((a_drives, (0, 1)), (~a_drives, (1, 0))):
            first, ids = (self.a_first, self.b_first), (self.a, self.b)
            mine, own, own_first = self._of(drives, first[side])
            theirs, far, far_first = self._of(drives, first[other])
            place = intersect(ends[side][mine], own_first, ends[other][theirs], far_first)
            equal = ends[other][theirs][place] == ends[side][mine]
            common[side].append(mine[equal])
            common[other].append(theirs[place[equal]])
            begin = np.concatenate([[0], place + equal])[:-1]  # rank of each token's start
            count = place - begin + 1
            stop = np.cumsum(count)
            reach = np.repeat(begin - (stop - count), count) + np.arange(int(stop[-1]) if len(stop) else 0)
            pair = np.repeat(ids[side][mine], count), ids[other][theirs][reach]
            links[0].append(pair[side])
            links[1].append(pair[other])
            links[2].append(np.repeat(own, count))
        self.a_common, self.b_common = (np.sort(np.concatenate(x)) for x in common)
        self.link_a, self.link_b, self.link_text = (np.concatenate(x) for x in links)
        self.n_links = np.bincount(self.link_text, minlength=n)
        self.n_groups = np.diff(np.searchsorted(self.a_common, self.a_first))

    @staticmethod
    def _of(texts: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of the tokens of some texts, the text of each, and where each of those texts begins among them."""
        size = np.diff(first)
        owner = np.repeat(np.arange(len(texts)), size)
        mine = np.flatnonzero(texts[owner])
        return mine, owner[mine], np.concatenate([[0], np.cumsum(size[texts])])

    def group_digests(self, names: list[bytes], most_a: int, most_b: int) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` of each text, hashed; ``names`` as by ``_names``."""
        a_size, b_size = np.diff(self.a_common, prepend=-1), np.diff(self.b_common, prepend=-1)
        before_b = np.repeat(np.cumsum(b_size) - b_size, a_size)  # B tokens of the groups before
        before_a = np.repeat(np.cumsum(a_size), b_size)
        code = np.empty(len(self.a) + len(self.b), np.int64)
        last = np.zeros(len(self.a), np.int64)
        last[self.a_common] = most_a
        code[np.arange(len(self.a)) + before_b] = self.a + last
        last = np.zeros(len(self.b), np.int64)
        last[self.b_common] = most_b
        code[np.arange(len(self.b)) + before_a] = 2 * most_a + self.b + last
        spelled = list(map(names.__getitem__, code.tolist()))
        first = (self.a_first + self.b_first).tolist()
        return [hashlib.sha256(b"".join(spelled[i:j])[:-1]).hexdigest() if j > i else "" for i, j in zip(first, first[1:])]


def _names(most_a: int, most_b: int) -> list[bytes]:
    """Ids with what follows them: A inside and at the end of its side of a group, then B."""
    return [b"%d%s" % (i, end) for most, ends in ((most_a, (b",", b"|")), (most_b, (b",", b";"))) for end in ends for i in range(most)]


class _Sides:
    """Both tokenizers, with the widths of their ids in bytes."""

    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = byte_pairs(a_path), sentence_pieces(b_path)
        self.a_width, self.b_width = (np.asarray([len(p) for p in x.pieces], np.int64) for x in (self.a, self.b))
        self.most_a, self.most_b = len(self.a.pieces), len(self.b.pieces)

    def align(self, texts: list[bytes | None]) -> Aligned:
        rows_a, rows_b = [], []
        none = np.zeros(0, np.int64)
        every = [t.decode() if t else "" for t in texts]
        for raw, text, ids_b in zip(texts, every, self.b.encode(every)):
            ids_a = self.a.encode(" " + text, special=False) if text else none
            whole = b" " + (raw or b"")
            fits = text and all(b"".join(map(side.pieces.__getitem__, ids)) == whole for side, ids in ((self.b, ids_b), (self.a, ids_a.tolist())))
            rows_a.append(ids_a if fits else none)
            rows_b.append(np.asarray(ids_b, np.int64) if fits else none)
        return Aligned(rows_a, rows_b, self.a_width, self.b_width)

    def key(self, a: np.ndarray, b: np.ndarray, segments: int) -> np.ndarray:
        """A number for each pair: its segment, its B id in the segment, its A id, in this order."""
        return ((b % segments) * -(-self.most_b // segments) + b // segments) * self.most_a + a

    def span(self, segments: int) -> int:
        """How many numbers a segment has."""
        return -(-self.most_b // segments) * self.most_a


def _pack(values: np.ndarray) -> bytes:
    """Unsigned integers as byte planes, as many as the largest needs."""
    if not len(values):
        return b""
    width = max(1, (int(values.max()).bit_length() + 7) // 8)
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def _unpack(blob: bytes, n: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    if n:
        planes = np.frombuffer(blob, np.uint8).reshape(-1, n)
        out[:, : len(planes)] = planes.T
    return out.view("<i8").reshape(-1)


def _add(keys: np.ndarray, counts: np.ndarray, more: np.ndarray, by: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two lists of (key, count) as one of distinct rising keys."""
    every, code = np.unique(np.concatenate([keys, more]), return_inverse=True)
    out = np.zeros(len(every), np.int64)
    np.add.at(out, code, np.concatenate([counts, by]))
    return every, out


_COUNTS = ["n_a", "n_b", "n_groups", "n_links"]
_ROW_ARROW = pa.schema([("segment", pa.int32()), ("chunk", pa.int64()), ("n", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])
_ROW = "segment int, chunk long, n int, keys binary, counts binary"
#: Rows of documents (no segment) and of chunks' pairs (the columns of ``_ROW``) in one table.
_STORED_ARROW = pa.schema([*_ROW_ARROW, ("doc_id", pa.int64()), *((c, pa.int64()) for c in _COUNTS), ("groups_sha256", pa.string()), ("places", pa.binary()), ("times", pa.binary())])
_STORED = f"{_ROW}, doc_id long, {', '.join(f'{c} long' for c in _COUNTS)}, groups_sha256 string, places binary, times binary"
_ANSWER_ARROW = pa.schema([("chunk", pa.int64()), ("segment", pa.int32()), ("n", pa.int32()), ("totals", pa.binary()), ("best", pa.binary())])
_ANSWER = "chunk long, segment int, n int, totals binary, best binary"
_RESULT_ARROW = pa.schema([("doc_id", pa.int64()), *((c, pa.int64()) for c in [*_COUNTS, "n_best", "count_sum"]), ("groups_sha256", pa.string())])
_RESULT = f"doc_id long, {', '.join(f'{c} long' for c in _COUNTS)}, n_best long, count_sum long, groups_sha256 string"


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    return pa.Table.from_arrays([pa.array(list(c), f.type) for c, f in zip(list(zip(*rows)) or [()] * len(schema), schema)], schema=schema)


class _Chunk:
    """Documents read so far, until they make a chunk."""

    def __init__(self, sides: _Sides, segments: int):
        self.sides, self.segments, self.names = sides, segments, _names(sides.most_a, sides.most_b)
        self.clear()

    def clear(self) -> None:
        self.bytes, self.rows, self.keys, self.times = 0, [], [], []

    def add(self, ids: list, texts: list[bytes | None]) -> None:
        x = self.sides.align(texts)
        every = self.segments * self.sides.span(self.segments)
        of_text, times = np.unique(x.link_text * every + self.sides.key(x.link_a, x.link_b, self.segments), return_counts=True)
        size = np.bincount(of_text // every, minlength=len(texts))
        digests = x.group_digests(self.names, self.sides.most_a, self.sides.most_b)
        self.rows += zip(ids, np.diff(x.a_first).tolist(), np.diff(x.b_first).tolist(), x.n_groups.tolist(), x.n_links.tolist(), digests, size.tolist())
        self.keys.append(of_text % every)
        self.times.append(times)
        self.bytes += sum(ROW_BYTES + len(t or b"") for t in texts)

    def finish(self, name: int) -> Iterator[pa.RecordBatch]:
        """The rows of the chunk's documents and of its pairs."""
        flat, times = np.concatenate(self.keys), np.concatenate(self.times)
        keys, counts = _add(flat[:0], times[:0], flat, times)
        place = np.searchsorted(keys, flat)
        out, at = [], 0
        for doc_id, n_a, n_b, n_groups, n_links, digest, size in self.rows:
            own = _pack(np.diff(place[at : at + size], prepend=0)), _pack(times[at : at + size])
            out.append((None, name, size, None, None, doc_id, n_a, n_b, n_groups, n_links, digest, *own))
            at += size
        span = self.sides.span(self.segments)
        cut = np.searchsorted(keys, np.arange(self.segments + 1) * span).tolist()
        for i, (a, b) in enumerate(zip(cut, cut[1:])):
            if b > a:
                out.append((i, name, b - a, _pack(np.diff(keys[a:b] - i * span, prepend=0)), _pack(counts[a:b]), *[None] * 8))
        self.clear()
        return iter(_table(out, _STORED_ARROW).to_batches())


def aligned_chunks(docs: DataFrame, a_path: str, b_path: str, segments: int) -> DataFrame:
    """The columns of ``_STORED``: every text encoded and aligned."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        chunk, name = _Chunk(_Sides(a_path, b_path), segments), TaskContext.get().partitionId() << 32
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for part, texts in parts(batch.column(1), BATCH_BYTES):
                chunk.add(ids[part], texts)
                if chunk.bytes >= CHUNK_BYTES:
                    yield from chunk.finish(name)
                    name += 1
        if chunk.rows:
            yield from chunk.finish(name)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, _STORED)


def segment_totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of chunks' pairs -> one row for each segment (without a chunk)."""
    held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    waiting: dict[int, list] = {}
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def settle(segment: int) -> None:
        held[segment] = _add(*held.get(segment, none), *map(np.concatenate, zip(*waiting.pop(segment))))

    for batch in batches:
        for r in batch.to_pylist():
            rows = waiting.setdefault(r["segment"], [])
            rows.append((np.cumsum(_unpack(r["keys"], r["n"])), _unpack(r["counts"], r["n"])))
            if sum(len(k) for k, _ in rows) > max(1 << 16, len(held.get(r["segment"], none)[0])):
                settle(r["segment"])
    for segment in list(waiting):
        settle(segment)
    for segment, (keys, counts) in held.items():
        yield from _table([(segment, None, len(keys), _pack(np.diff(keys, prepend=0)), _pack(counts))], _ROW_ARROW).to_batches()


def segment_answers(most_a: int):
    """A segment's totals, then its chunks' rows -> an answer to each chunk's row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every = counts = highest = None
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                keys = np.cumsum(_unpack(r["keys"], r["n"]))
                if r["chunk"] is None:
                    every, counts, b = keys, _unpack(r["counts"], r["n"]), keys // most_a
                    new = np.flatnonzero(np.diff(b, prepend=-1))
                    highest = counts == np.repeat(np.maximum.reduceat(counts, new), np.diff(np.append(new, len(b))))
                else:
                    at = np.searchsorted(every, keys)
                    out.append((r["chunk"], r["segment"], r["n"], _pack(counts[at]), np.packbits(highest[at]).tobytes()))
            if out:
                yield from _table(out, _ANSWER_ARROW).to_batches()

    return run


def add_up(docs: pa.Table, answers: pa.Table) -> pa.Table:
    """A chunk's documents with the sums of their pairs' answers."""
    rows = sorted(answers.to_pylist(), key=lambda r: r["segment"])
    none = np.zeros(0, np.int64)
    totals = np.concatenate([none, *(_unpack(r["totals"], r["n"]) for r in rows)])
    highest = np.concatenate([none, *(np.unpackbits(np.frombuffer(r["best"], np.uint8), count=r["n"]) for r in rows)])
    n_best, count_sum = [], []
    for places, times, n in zip(*(docs.column(c).to_pylist() for c in ("places", "times", "n"))):
        at, times = np.cumsum(_unpack(places, n)), _unpack(times, n)
        n_best.append(int((times * highest[at]).sum()))
        count_sum.append(int((times * totals[at]).sum()))
    columns = [docs.column("doc_id"), *(docs.column(c) for c in _COUNTS), pa.array(n_best, pa.int64()), pa.array(count_sum, pa.int64()), docs.column("groups_sha256")]
    return pa.Table.from_arrays(columns, schema=_RESULT_ARROW)


def align_tokenizers(docs: DataFrame, a_path: str, b_path: str, segments: int = SEGMENTS) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` per row of ``docs``."""
    both = stored(aligned_chunks(docs, a_path, b_path, segments), "aligned")
    pairs = both.where("segment is not null").select([f.name for f in _ROW_ARROW])
    totals = pairs.repartition(segments, "segment").mapInArrow(segment_totals, _ROW)
    ahead = totals.unionByName(pairs).repartition(segments, "segment").sortWithinPartitions("segment", F.col("chunk").isNotNull())
    answers = ahead.mapInArrow(segment_answers(len(byte_pairs(a_path).pieces)), _ANSWER)
    aligned = both.where("segment is null").select("chunk", "n", "doc_id", *_COUNTS, "groups_sha256", "places", "times")
    return aligned.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(add_up, _RESULT)
