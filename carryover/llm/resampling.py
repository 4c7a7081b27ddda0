"""Importance resampling of documents towards a target distribution, by hashed word n-grams.

Every feature (a run of 1 to ``ngram`` words) falls into the bucket
``crc32 % buckets``.  A bucket's gain compares its share in the target texts with its
share in all documents; a document's weight is the sum of its features' gains.
Keyed Gumbel noise on top makes the highest scores a draw without
replacement with probability proportional to ``exp(weight / 1000)``.

*Length-bucketed CRC matrices*: the distinct features of a batch are grouped by byte
length, each group is one two-dimensional uint8 array, and all its CRCs advance
together, one column at a time, through the 256-entry table; the results are
scattered back to the features' places.  Features longer than ``LONGEST`` bytes, few and
each of a length of its own, are hashed one by one (the same CRC).

At scale: texts never leave the task that reads them.  The first pass sends one row
for each bucket a task met (pre-aggregated there), the second reads the gains, an
array of ``buckets`` numbers.  The ranks come from one range sort of narrow rows
(16 bytes of key a document, ties broken by the row, so no run of equal scores is one
task's) and the row counts of its partitions.

Cases: a null, empty or wordless text has no features and weight 0; a word is any run of
ASCII digits, letters (A-Z as a-z) and code points beyond ASCII; a null id hashes as an
empty one; repeated rows are drawn each for itself, ties beyond the id in
any order; with fewer than ``least_words`` words a document is never drawn; an empty table gives no rows,
an empty target gives gains by the documents alone; very long texts are whole; other columns are
not read, whatever their names.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored
from .textcore import parts

BUCKETS = 10_000
BATCH_BYTES = 2 << 20
LONGEST = 256


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


CRC_TABLE = _crc_table()
#: A-Z as a-z, and which bytes are part of words.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
IN_WORD = np.zeros(256, bool)
IN_WORD[48:58] = IN_WORD[97:123] = IN_WORD[128:] = True


def crc_matrices(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """CRC-32 of each ``data[offsets[i]:offsets[i + 1]]``."""
    sizes = np.diff(offsets)
    out = np.zeros(len(sizes), np.uint32)
    order = np.argsort(sizes, kind="stable")
    edges = np.flatnonzero(np.diff(sizes[order], prepend=-1))
    for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(order)]):
        which = order[a:b]
        length = int(sizes[which[0]])
        if length > LONGEST:
            out[which] = [zlib.crc32(data[offsets[i] : offsets[i + 1]].tobytes()) for i in which.tolist()]
            continue
        matrix = data[offsets[which][:, None] + np.arange(length)]
        crc = np.full(len(which), 0xFFFFFFFF, np.uint32)
        for column in np.ascontiguousarray(matrix.T):
            crc = CRC_TABLE[(crc ^ column) & np.uint32(0xFF)] ^ (crc >> np.uint32(8))
        out[which] = ~crc
    return out


def feature_buckets(texts: list[bytes | None], ngram: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bucket of every feature of every text, the text of each, and the texts' numbers of words."""
    raw = [t or b"" for t in texts]
    buf = FOLD[np.frombuffer(b"\x00".join([*raw, b""]), np.uint8)]  # a zero behind each text
    stops = np.cumsum([len(t) + 1 for t in raw])
    inside = np.concatenate([[False], IN_WORD[buf], [False]])
    starts = np.flatnonzero(inside[1:] & ~inside[:-1])
    ends = np.flatnonzero(inside[:-1] & ~inside[1:])
    owner = np.searchsorted(stops, starts, side="right")
    # words end to end, each with one blank behind it
    sizes = ends - starts + 1
    at = np.concatenate([[0], np.cumsum(sizes)])
    source = np.repeat(starts - at[:-1], sizes) + np.arange(at[-1])
    flat = buf[np.minimum(source, max(len(buf) - 1, 0))]
    flat[at[1:] - 1] = 32
    found, owners = [], []
    for n in range(1, ngram + 1):
        first = np.flatnonzero(owner[: len(owner) - n + 1] == owner[n - 1 :]) if len(owner) >= n else np.zeros(0, np.int64)
        begin, size = at[first], at[first + n] - 1 - at[first]
        offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
        data = flat[np.repeat(begin - offsets[:-1], size) + np.arange(offsets[-1])]
        every = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])
        coded = every.dictionary_encode()
        held = coded.dictionary
        held_offsets = np.frombuffer(held.buffers()[1], np.int64)[held.offset : held.offset + len(held) + 1] if len(held) else np.zeros(1, np.int64)
        crc = crc_matrices(np.frombuffer(held.buffers()[2] or b"", np.uint8), held_offsets)
        found.append((crc % np.uint32(buckets)).astype(np.int64)[coded.indices.to_numpy(zero_copy_only=False)])
        owners.append(owner[first])
    return np.concatenate(found), np.concatenate(owners), np.bincount(owner, minlength=len(raw))


def bucket_counts(texts: DataFrame, ngram: int, buckets: int) -> np.ndarray:
    """How many features of all ``texts`` (one column) fall into each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, every in parts(batch.column(0), BATCH_BYTES):
                total += np.bincount(feature_buckets(every, ngram, buckets)[0], minlength=buckets)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met.astype(np.int32)), pa.array(total[met])], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    rows = texts.mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    for bucket, n in rows.collect():  # at most ``buckets`` rows
        out[bucket] = n
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of smoothed shares, rounded down."""
    n, s_all, t_all = len(source), float(source.sum()), float(target.sum())
    ratio = ((target + 1.0) * (s_all + n)) / ((source + 1.0) * (t_all + n))
    return np.asarray([math.floor(1000 * math.log(x)) for x in ratio.tolist()], np.int64)


def weighted(docs: DataFrame, gains: np.ndarray, ngram: int) -> DataFrame:
    """``doc_id, n_words, n_features, weight`` per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in parts(batch.column(1), BATCH_BYTES):
                bucket, owner, words = feature_buckets(texts, ngram, len(gains))
                n = len(words)
                order = np.argsort(owner, kind="stable") if ngram > 1 else slice(None)
                size = np.bincount(owner, minlength=n)
                summed = np.concatenate([[0], np.cumsum(gains[bucket[order]])])
                stop = np.cumsum(size)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(part.start, n), pa.array(words, pa.int64()), pa.array(size, pa.int64()), pa.array(summed[stop] - summed[stop - size], pa.int64())],
                    names=["doc_id", "n_words", "n_features", "weight"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def importance_resample(
    docs: DataFrame, target: DataFrame, ngram: int = 1, buckets: int = BUCKETS, least_words: int = 20, percent: int = 10, seed: int = 2024
) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` per row of ``docs``; ``rank`` is null where not drawn."""
    gains = bucket_gains(bucket_counts(docs.select("text"), ngram, buckets), bucket_counts(target.select("text"), ngram, buckets))
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.ln(-F.ln((h + 0.5) / 4294967296)))
    scored = weighted(docs, gains, ngram).withColumn("score", (F.col("weight") + noise).cast("long")).withColumn("can", F.col("n_words") >= least_words)
    scored = stored(scored, "scores").withColumn("row", F.monotonically_increasing_id())
    # rows in falling order: the place in the partition from the id, the rows before it from the partitions' counts
    ordered = scored.orderBy(F.desc("can"), F.desc("score"), F.asc_nulls_last("doc_id"), "row")
    ordered = stored(ordered.withColumn("at", F.monotonically_increasing_id()).drop("row"), "ordered")
    part, place = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    counts = ordered.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    every = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each partition of the sort
    before = counts.select("part", F.coalesce(F.sum("n").over(every), F.lit(0)).alias("before"))
    draws = (ordered.agg(F.count_if("can")).first()[0] or 0) * percent // 100
    rank = F.col("before") + place + 1
    out = ordered.withColumn("part", part).join(F.broadcast(before), "part")
    return out.select("doc_id", "n_features", "weight", "score", F.when(rank <= draws, rank).cast("long").alias("rank"))
