"""Near-duplicate documents by fast similarity sketching.

A document's set is its distinct word shingles.  The sketch of a set has
``COORDINATES`` bins.  Round ``i`` hashes every element to a bin and a value;
a bin keeps the least ``(round, value)``.  The first ``COORDINATES`` rounds
choose the bin at random, the next ``COORDINATES`` place every element in bin
``i - COORDINATES``, so each coordinate is surely filled, large sets fill in
a round or two, and the share of equal coordinates of two sketches is
concentrated about the sets' Jaccard similarity as with independent hashes.
``BANDS`` bands of ``ROWS`` coordinates make candidates: at similarity 0.8 a
pair shares no band with probability (1 - 0.8**4)**32 < 5e-8.  Candidates are
confirmed on the full sets.

No pairs within a group are emitted for its own sake:

1. Equal sets are one class; its least id stands for it from here on.
2. Each representative is compared with one other: the least id that shares
   a band with it.  Confirmed links join components.
3. Documents of buckets that still hold several components are compared
   across components only, and only pairs that can reach the threshold: shingles
   are put in one order, rare ones first (by a count of ``CELLS`` hashed cells, so
   its size is fixed; any order is exact), and a pair at the threshold must
   share a shingle so early in both that enough are left behind it.  Members
   of one large group with many edits of their own share none.  Confirmed
   links join components again.

Buckets are found with ``groupBy`` + join, never by gathering one; texts
travel only for representatives that share a band with another.

Cases: a null or wordless text has an empty set, is linked with nothing and
kept; a text with fewer words than a shingle has its whole sequence as its
only element; ties go to the least id; rows that repeat an id and text share
one class (each is returned); rows that share an id but not a text are documents of
their own, decided each for itself (of equal sets under one id the least text hash stays); a row with a null id gets the component of its
class, if others have its set, joins nothing else and is kept; an empty table gives no rows; other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .textcore import (
    FOLD,
    find_words,
    hash_ngrams,
    hash_spans,
    join_texts,
    mix,
    parts,
)

COORDINATES = 128
ROWS = 4
BANDS = COORDINATES // ROWS
BATCH_BYTES = 2 << 20
#: Cells that count shingles for their order, in parts of ``CELLS_EACH``.
CELLS, CELLS_EACH = 1 << 20, 1 << 14


def shingle_sets(texts: list[bytes | None], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every text end to end, and ``n + 1`` offsets."""
    buf, offsets = join_texts(texts)
    starts, ends, first = find_words(buf, offsets)
    words = hash_spans(FOLD[buf], starts, ends)[0]
    grams = hash_ngrams(words, k)
    sets = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= k:
            sets.append(np.unique(grams[a : b - k + 1]))
        elif b > a:
            sets.append(hash_ngrams(words[a:b], b - a, seed=2 + b - a))
        else:
            sets.append(grams[:0])
    out = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(s) for s in sets], out=out[1:])
    return (np.concatenate(sets) if sets else grams[:0]), out


def sketches(flat: np.ndarray, offsets: np.ndarray, t: int = COORDINATES) -> np.ndarray:
    """Fast similarity sketches (sets x coordinates); an empty set's row is all ones."""
    size = np.diff(offsets)
    unset = np.uint64(0xFFFFFFFFFFFFFFFF)
    out = np.full((len(size), t), unset, np.uint64)
    todo = np.flatnonzero(size)
    owner = np.repeat(np.arange(len(size)), size)
    items = flat
    for i in range(2 * t):
        h = mix(items, 1000 + i)
        value = (h >> np.uint64(10)) | (np.uint64(i) << np.uint64(54))
        place = (h & np.uint64(t - 1)).astype(np.int64) if i < t else i - t
        np.minimum.at(out.reshape(-1), owner * t + place, value)
        open_ = (out[todo] == unset).any(axis=1)
        if not open_.any():
            break
        if not open_.all():
            live = np.zeros(len(size), bool)
            todo = todo[open_]
            live[todo] = True
            keep = live[owner]
            owner, items = owner[keep], items[keep]
    return out


def bands(sketch: np.ndarray) -> np.ndarray:
    """One hash for each band (sets x bands); the band's number is part of it."""
    cut = sketch.reshape(len(sketch), BANDS, ROWS)
    out = np.zeros(cut.shape[:2], np.uint64) + np.arange(BANDS, dtype=np.uint64)
    for r in range(ROWS):
        out = mix(out ^ cut[:, :, r], 77 + r)
    return out


def signatures(docs: DataFrame, k: int) -> DataFrame:
    """``doc_id, tkey, n, h1, h2, bands`` per row: set size, 128-bit set hash, band hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in parts(batch.column(2), BATCH_BYTES):
                flat, offsets = shingle_sets(texts, k)
                band = bands(sketches(flat, offsets))
                sums = []
                for seed in (11, 12):
                    total = np.zeros(len(flat) + 1, np.uint64)
                    np.cumsum(mix(flat, seed), out=total[1:])
                    sums.append(total[offsets[1:]] - total[offsets[:-1]])
                m = len(band)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(part.start, m), batch.column(1).slice(part.start, m)]
                    + [pa.array(np.diff(offsets), pa.int64())]
                    + [pa.array(s.view(np.int64)) for s in sums]
                    + [pa.ListArray.from_arrays(np.arange(0, m * BANDS + 1, BANDS, dtype=np.int32), pa.array(band.reshape(-1).view(np.int64)))],
                    names=["doc_id", "tkey", "n", "h1", "h2", "bands"],
                )

    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("tkey"), F.col("text"))
    return rows.mapInArrow(run, "doc_id long, tkey long, n long, h1 long, h2 long, bands array<long>")


def confirmed(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose full sets reach the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple = (None, None)
        for batch in batches:
            right = batch.column(3)
            b_ids = batch.column(1).to_pylist()
            keep = np.zeros(batch.num_rows, bool)
            for part, left in parts(batch.column(2), BATCH_BYTES):
                flat, offsets = shingle_sets(left, k)
                for i in range(part.start, part.stop):
                    mine = flat[offsets[i - part.start] : offsets[i - part.start + 1]]
                    if last[0] != b_ids[i]:
                        last = (b_ids[i], shingle_sets([right[i].as_py().encode()], k)[0])
                    other = last[1]
                    place = np.searchsorted(other, mine)
                    same = int((other[np.minimum(place, len(other) - 1)] == mine).sum()) if len(other) else 0
                    keep[i] = 100 * same >= percent * (len(mine) + len(other) - same) and same > 0
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep))

    one = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("a_text"))
    two = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("b_text"))
    both = pairs.select("a", "b").join(one, "a").join(two, "b").select("a", "b", "a_text", "b_text")
    return both.mapInArrow(run, "a long, b long")


def shingle_counts(texts: DataFrame, k: int) -> np.ndarray:
    """How many sets hold the shingles of each of ``CELLS`` hashed cells."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CELLS, np.int64)
        for batch in batches:
            for _, every in parts(batch.column(0), BATCH_BYTES):
                np.add.at(total, _cell(shingle_sets(every, k)[0]), 1)
        for i in range(0, CELLS, CELLS_EACH):
            if total[i : i + CELLS_EACH].any():
                yield pa.RecordBatch.from_pydict({"part": pa.array([i // CELLS_EACH], pa.int32()), "n": pa.array([total[i : i + CELLS_EACH].astype("<i8").tobytes()], pa.binary())})

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(b, "<i8") for b in table.column("n").to_pylist())
        return pa.table({"part": table.column("part").slice(0, 1), "n": pa.array([total.tobytes()], pa.binary())})

    out = np.zeros(CELLS, np.int64)
    for part, n in texts.select("text").mapInArrow(count, "part int, n binary").groupBy("part").applyInArrow(add, "part int, n binary").collect():
        out[part * CELLS_EACH : (part + 1) * CELLS_EACH] = np.frombuffer(bytes(n), "<i8")
    return out


def _cell(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - CELLS.bit_length() + 1)).astype(np.int64)


def early_shingles(texts: DataFrame, counts: np.ndarray, k: int, percent: int) -> DataFrame:
    """``shingle, rep, label, n, place, short`` for the first shingles of each set, rare ones first.

    Of ``n`` shingles the first ``n - ceil(n * percent / 100) + 1`` meet every set at the threshold;
    against sets at least as large fewer do (``short``)."""
    shared = texts.sparkSession.sparkContext.broadcast(np.minimum(counts, 2**31 - 1).astype(np.int32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, every in parts(batch.column(2), BATCH_BYTES):
                flat, offsets = shingle_sets(every, k)
                found: list[np.ndarray] = []
                sizes = []
                for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                    one = flat[a:b]
                    first = (b - a) - -(-(b - a) * percent // 100) + 1
                    found.append(one[np.lexsort((one, shared.value[_cell(one)]))[:first]])
                    sizes.append(len(found[-1]))
                size = np.asarray(sizes)
                n = np.repeat(np.diff(offsets), size)
                place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + 1
                short = place <= n - -(-2 * percent * n // (100 + percent)) + 1
                take = pa.array(np.repeat(np.arange(part.start, part.stop), size))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(found).view(np.int64)), batch.column(0).take(take), batch.column(1).take(take)]
                    + [pa.array(n.astype(np.int32)), pa.array(place.astype(np.int32)), pa.array(short)],
                    names=["shingle", "rep", "label", "n", "place", "short"],
                )

    return texts.select("rep", "label", "text").mapInArrow(run, "shingle long, rep long, label long, n int, place int, short boolean")


def across(texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs ``a, b`` of different labels that may reach the threshold; ``texts``: ``rep, label, text``."""
    early = stored(early_shingles(texts, shingle_counts(texts, k), k, percent), "early")
    one = early.select("shingle", F.col("rep").alias("a"), F.col("label").alias("la"), F.col("n").alias("na"), F.col("place").alias("pa"))
    two = early.where("short").select("shingle", F.col("rep").alias("b"), F.col("label").alias("lb"), F.col("n").alias("nb"), F.col("place").alias("pb"))
    fits = F.expr(
        f"la <> lb AND (na > nb OR na = nb AND a < b) AND nb * 100 >= na * {percent} "
        f"AND (1 + least(na - pa, nb - pb)) * {100 + percent} >= (na + nb) * {percent}"
    )
    return one.join(two, "shingle").where(fits).select("a", "b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, label``: for each node of the links the least node it reaches.

    Each round takes the least label among neighbours and then the label's own
    label, so paths halve; rounds are written to the shared folder."""
    both = stored(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("label")), "labels")
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        )
        step = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        up = labels.select(F.col("node").alias("label"), F.col("label").alias("above"))
        new = stored(step.join(up, "label").select("node", "old", F.least("label", "above").alias("label")), "labels")
        labels = new.select("node", "label")
        if new.where("old <> label").isEmpty():
            return labels


def labelled(reps: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return reps.withColumn("label", F.col("rep"))
    own = labels.withColumnRenamed("node", "rep")
    return reps.join(own, "rep", "left").withColumn("label", F.coalesce("label", "rep"))


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``."""
    return decided(docs, k, percent).drop("tkey")


def decided(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """``near_duplicates`` with ``tkey``, the hash of the row's text."""
    sig = stored(signatures(docs, k), "signatures")
    key = ["n", "h1", "h2"]
    classes = sig.where("n > 0 and doc_id is not null").groupBy(*key).agg(F.min(F.struct("doc_id", "tkey")).alias("least"))
    classes = stored(classes.select(*key, "least.doc_id", "least.tkey", F.col("least.doc_id").alias("rep")), "classes")
    # of several classes with one least id, all but the first go by a number of their own
    shared_id = classes.groupBy("doc_id").agg(F.min("tkey").alias("first"), F.count("*").alias("c")).where("c > 1").drop("c")
    namesakes = not shared_id.isEmpty()
    if namesakes:
        rep = F.when(F.coalesce(F.col("tkey") != F.col("first"), F.lit(False)), F.xxhash64("doc_id", "tkey")).otherwise(F.col("doc_id"))
        classes = stored(classes.drop("rep").join(shared_id, "doc_id", "left").select(*key, "doc_id", "tkey", rep.alias("rep")), "classes")

    reps = sig.join(classes, [*key, "doc_id", "tkey"]).dropDuplicates(["doc_id", "tkey"])
    exploded = reps.select(F.explode("bands").alias("bucket"), "rep")
    shared = exploded.groupBy("bucket").agg(F.min("rep").alias("pivot"), F.max("rep").alias("top")).where("pivot < top")
    members = stored(exploded.join(shared.select("bucket", "pivot"), "bucket"), "members")

    wanted = members.select("rep").distinct().join(classes.select("rep", "doc_id", "tkey"), "rep")
    texts = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("tkey")).join(wanted, ["doc_id", "tkey"])
    texts = stored(texts.dropDuplicates(["doc_id", "tkey"]).select(F.col("rep").alias("doc_id"), "text"), "texts")

    pairs = members.where("pivot < rep").groupBy(F.col("rep").alias("a")).agg(F.min("pivot").alias("b"))
    links = stored(confirmed(pairs, texts, k, percent), "confirmed")
    labels = components(links)

    # what the first comparison left apart: documents of buckets with several components
    apart = labelled(members.select("bucket", "rep"), labels)
    mixed = apart.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi").select("bucket")
    rest = apart.join(mixed, "bucket").select("rep", "label").distinct()
    rest = stored(texts.join(rest.withColumnRenamed("rep", "doc_id"), "doc_id").select(F.col("doc_id").alias("rep"), "label", "text"), "rest")
    extra = stored(confirmed(across(rest, k, percent), texts, k, percent), "confirmed")
    if not extra.isEmpty():
        labels = components(links.union(extra))

    final = labelled(classes, labels)
    if namesakes:
        least = final.groupBy("label").agg(F.min(F.struct("doc_id", "tkey")).alias("least"))
        final = final.join(least, "label").withColumn("stands", F.struct("doc_id", "tkey") == F.col("least")).withColumn("label", F.col("least.doc_id"))
    else:
        final = final.withColumn("stands", F.col("rep") == F.col("label"))
    # the text that stands for its component; null in other classes
    final = final.select(*key, "label", F.when(F.col("stands"), F.col("tkey")).alias("stays"))
    out = sig.select("doc_id", "tkey", "n", "h1", "h2").join(final, key, "left")
    label = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("label"))
    kept = (F.col("n") == 0) | F.col("doc_id").isNull() | ((F.col("doc_id") == F.col("label")) & F.coalesce(F.col("tkey") == F.col("stays"), F.lit(False)))
    return out.select("doc_id", F.col("n").alias("n_shingles"), label.alias("component_id"), kept.alias("kept"), "tkey")


def keep_one_each(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` without the documents another one of their group stands for; of rows that
    repeat an id and a text one stays."""
    found = decided(docs, k, percent)
    gone = found.where("not kept").select("doc_id", "tkey", F.lit(0).cast("long").alias("alone")).distinct()
    gone = stored(gone, "decisions")  # ``alone`` must be a column, not a constant, for the join to use the rows' partitioning
    # rows without an id stand alone; the rows of an id and text meet once, and what another document stands for goes
    alone = F.when(docs["doc_id"].isNull(), F.monotonically_increasing_id()).otherwise(F.lit(0)).alias("alone")
    own = [docs["doc_id"].cast("long").alias("doc_id"), F.xxhash64(docs["text"]).alias("tkey"), alone]
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), *own)
    return rows.dropDuplicates(["doc_id", "tkey", "alone"]).join(gone, ["doc_id", "tkey", "alone"], "left_anti").select("row.*")
