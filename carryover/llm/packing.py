"""Best-fit packing of tokenised documents into fixed-length sequences.

Each document becomes its token ids plus a closing id; a document longer
than ``capacity`` is cut so that its first piece takes the odd rest and the
others are full.  Full pieces are sequences of their own.  The others are
packed by *best-fit decreasing*: pieces in falling length, each into the
open bin with the least remaining capacity that still holds it.  The open
bins hang in a segment tree over remaining capacities (one leaf per
capacity, a node counts the bins below it), so the tightest bin is found in
``log2(capacity)`` steps and the tree's size depends on ``capacity`` alone.

At scale: texts never leave the task that reads them (tokenising emits one
narrow row per piece, written to the shared scratch folder, so a lost
executor does not tokenise again).  Pieces are dealt at random into groups
of about ``group_size``; groups are packed independently, which costs at
most about one part-filled sequence a group.  No key of the data decides
the group, so a hot source or a hot document id cannot fill one.

Cases: a null or empty text is just the closing id; repeated rows are
packed once each; null ids are kept; an empty table gives no rows; other
columns are not read.  Equal lengths go in the order of
``(doc_id, piece)``.  A very long text is tokenised whole: it is split at
single spaces between non-space characters, where the tokenizer always
starts a new word, and the ids of the parts are joined.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pieces_of, stored
from .textcore import parts
from .tokens import byte_pairs

CAPACITY = 2048
END_ID = 0
GROUP_SIZE = 65_536
#: Bytes of text encoded at once in a task.
BATCH_BYTES = 2 << 20

def tokenised_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32``."""
    end = np.asarray([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            for part, texts in parts(batch.column(1), BATCH_BYTES):
                rows: list[tuple] = []
                for doc_id, text in zip(doc_ids[part], texts):
                    ids = byte_pairs(tokenizer).encode((text or b"").decode(), special=True)
                    raw = ids.astype("<u4").tobytes() + end
                    n = len(ids) + 1
                    at, stop, piece = 0, n % capacity or capacity, 0
                    while at < n:
                        rows.append((doc_id, piece, at, stop - at, zlib.crc32(raw[4 * at : 4 * stop])))
                        at, stop, piece = stop, stop + capacity, piece + 1
                columns = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], batch.schema.field(0).type), pa.array(columns[1], pa.int32())]
                    + [pa.array(c, pa.int64()) for c in columns[2:]],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"
    )


def best_fit(lengths: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Best fit in the given order: a bin and an offset for each length.

    ``lengths`` should fall; every length lies in ``1..capacity``.
    """
    size = 1 << capacity.bit_length()  # leaves for remaining capacities 0..capacity
    tree = [0] * (2 * size)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins, offsets, made = [], [], 0
    for length in lengths:
        node, found = size + length, 0
        if tree[node]:
            found = node
        else:  # climb to the first right-hand neighbour that holds a bin, then go down its left edge
            while node > 1:
                if not node & 1 and tree[node + 1]:
                    found = node + 1
                    break
                node >>= 1
            while found and found < size:
                found *= 2
                if not tree[found]:
                    found += 1
        if found:
            left = found - size
            bin_id = open_bins[left].pop()
            while found:
                tree[found] -= 1
                found >>= 1
        else:
            left, bin_id, made = capacity, made, made + 1
        bins.append(bin_id)
        offsets.append(capacity - left)
        left -= length
        if left:
            open_bins[left].append(bin_id)
            node = size + left
            while node:
                tree[node] += 1
                node >>= 1
    return bins, offsets


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, group_size: int = GROUP_SIZE) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to rows with a ``length`` of at most
    ``capacity``.  ``pieces`` must be a stored table (it is read twice)."""
    groups = pieces_of(pieces.count(), group_size)

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "doc_id", "piece"], ascending=[False, True, True], kind="stable")
        bins, offsets = best_fit(group["length"].tolist(), capacity)
        at = int(group["__group"].iloc[0]) << 40
        out = group.drop(columns="__group")
        out["sequence_id"] = np.asarray(bins, "int64") + at
        out["offset"] = np.asarray(offsets, "int64")
        return out

    dealt = pieces.withColumn("__group", F.pmod(F.hash(F.monotonically_increasing_id()), F.lit(groups)))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return dealt.groupBy("__group").applyInPandas(run, f"{fields}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, group_size: int = GROUP_SIZE) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` per piece."""
    pieces = stored(tokenised_pieces(docs, tokenizer, capacity), "pieces")
    return pack_pieces(pieces, capacity, group_size)
