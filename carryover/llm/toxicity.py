"""Toxicity by compression distance: which dictionary shortens a text's windows?

Two zstandard dictionaries are trained, one on windows of ordinary documents, one
on what is toxic in the toxic ones.  Each window of a text (``WINDOW`` bytes, to the next
white space, ASCII letters folded) is compressed twice, and the difference of the lengths says
how much the toxic dictionary knows about it.  Toxic texts consist mostly of
ordinary words, so both compressors have the ordinary dictionary, the same
distance back; the toxic one has the toxic dictionary before it.  Then a window without
toxic words compresses alike on both sides.

*Training.*  At most ``SAMPLE_DOCS`` labelled documents of each class are used, those of least
hash; two thirds train, one third calibrates.  The ordinary dictionary is trained on at most
``SAMPLE_WINDOWS`` distinct windows.  The toxic one is trained on lines of words that toxic
training documents use at least ``RATIO`` times as often as ordinary ones, counted by distinct contexts (word before,
word behind), so copies of one document count once; at most ``MOST_WORDS`` words.
*Calibration.*  The lengths' differences of the calibration documents' windows give each difference a log
likelihood ratio; from these a logistic model makes a document's score: its
threshold is 0.5.

At scale: scoring is one pass that shuffles nothing; the model (two dictionaries, a few numbers) is bounded by the parameters.
Training texts are joined by a broadcast of at most ``2 * SAMPLE_DOCS`` ids; windows and words are made distinct
and counted by Spark before anything reaches the driver.

Cases: a null, empty or blank text has one blank window and is scored as any other; rows that repeat an id
are scored each for itself; an id with labels of both kinds, a null id or a null label does not train; without a toxic word or
without one of the classes every score is the share of toxic documents in the calibration third (0 without any); an empty
table gives no rows; very long texts are whole; other columns are not read, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .textcore import parts

SAMPLE_DOCS = 6_000
SAMPLE_WINDOWS = 60_000
MOST_WORDS = 2_000
WINDOW = 48
RATIO, LEAST_CONTEXTS = 10, 5
ORDINARY_BYTES, TOXIC_BYTES = 112_000, 4_096
BATCH_BYTES = 2 << 20
#: Differences of lengths are told apart from -LOWEST to BINS - LOWEST - 1.
LOWEST, BINS = 4, 24

_WINDOWS = re.compile(rb".{%d}[^ \t\n]{0,32}[ \t\n]?|.+" % WINDOW, re.DOTALL)
_WORDS = re.compile(rb"[^ \t\n\r]+")


def folded(text: bytes | None) -> bytes:
    return b" %s " % (text or b"").lower()


def windows(text: bytes | None) -> Iterator[bytes]:
    """The text's windows, in order and without overlap; at least one."""
    return (m.group() for m in _WINDOWS.finditer(folded(text)))


def compressor(content: bytes):
    """zstandard with ``content`` as the history before each window."""
    import zstandard

    given = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    how = zstandard.ZstdCompressionParameters.from_level(
        3, strategy=zstandard.STRATEGY_LAZY2, min_match=4, search_log=7, target_length=64, hash_log=17, chain_log=17, window_log=20,
        write_content_size=False, write_checksum=False, write_dict_id=False,
    )
    given.precompute_compress(compression_params=how)
    return zstandard.ZstdCompressor(dict_data=given, compression_params=how)


def train(samples: list[bytes], size: int, **how: int) -> bytes:
    """A dictionary trained by zstandard, or the samples themselves where they are too few to train on."""
    import zstandard

    if sum(map(len, samples)) > 2 * size:
        try:
            return zstandard.train_dictionary(size, samples, **how).as_bytes()
        except zstandard.ZstdError:  # samples too much alike
            pass
    return b"".join(samples)[-size:]


@dataclass
class Model:
    ordinary: bytes
    toxic: bytes
    ratios: np.ndarray | None  # of each difference; None: no model, every score is ``base``
    weights: np.ndarray | None
    base: float

    def features(self, counts: np.ndarray) -> np.ndarray:
        """Of documents' counts of differences (documents x BINS)."""
        n = counts.sum(axis=1)
        total = counts @ self.ratios
        above = counts[:, LOWEST + 4 :].sum(axis=1)
        best = np.where(counts > 0, self.ratios, -np.inf).max(axis=1)
        return np.column_stack([np.ones(len(n)), total / np.sqrt(n), total / n, best, np.log(n), above / n, np.minimum(above, 8)])

    def scores(self, counts: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(counts), self.base)
        return 1 / (1 + np.exp(-np.clip(self.features(counts) @ self.weights, -500, 500)))


def difference_counts(texts: list[bytes | None], ordinary: bytes, toxic: bytes) -> np.ndarray:
    """How often each difference of lengths occurs among the windows of each text."""
    plain, other = compressor(ordinary), compressor(toxic + ordinary)
    out = np.zeros((len(texts), BINS), np.int64)
    for i, text in enumerate(texts):
        seen = [0] * BINS
        for w in windows(text):
            seen[min(max(len(plain.compress(w)) - len(other.compress(w)) + LOWEST, 0), BINS - 1)] += 1
        out[i] = seen
    return out


def in_training(doc_id, folds: int, held: int):
    """Whether the id's CRC is not of the held-out remainder."""
    return F.crc32(doc_id.cast("string")) % folds != held


def training_texts(docs: DataFrame, labels: DataFrame, folds: int, held: int) -> DataFrame:
    """``toxic, calibrates, text`` of at most ``SAMPLE_DOCS`` labelled documents of each class."""
    one = labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    one = one.agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most")).where(F.col("toxic") == F.col("most"))
    one = one.where(in_training(F.col("doc_id"), folds, held)).select("doc_id", (F.col("toxic") > 0).alias("toxic"))

    def least(rows: DataFrame, *key: str) -> DataFrame:
        both = [rows.where(w).orderBy(F.xxhash64(*key), *key).limit(SAMPLE_DOCS) for w in ("toxic", "not toxic")]
        return both[0].unionByName(both[1])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tkey"), "text")
    found = rows.join(F.broadcast(least(one, "doc_id")), "doc_id").select("doc_id", "tkey", "toxic").distinct()
    chosen = F.broadcast(stored(least(found, "doc_id", "tkey"), "chosen"))  # at most 2 * SAMPLE_DOCS rows
    texts = rows.join(chosen, ["doc_id", "tkey"]).dropDuplicates(["doc_id", "tkey"])
    return texts.select("toxic", (F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0).alias("calibrates"), "text")


def ordinary_windows(texts: DataFrame) -> list[bytes]:
    """Distinct windows of the ordinary training texts, ``SAMPLE_WINDOWS`` at most, by least hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, every in parts(batch.column(0), BATCH_BYTES):
                yield pa.RecordBatch.from_arrays([pa.array(sorted({w for t in every for w in windows(t)}), pa.binary())], names=["window"])

    found = texts.where("not toxic and not calibrates").select("text").mapInArrow(run, "window binary").distinct()
    return [bytes(r[0]) for r in found.orderBy(F.xxhash64("window"), "window").limit(SAMPLE_WINDOWS).collect()]


def toxic_words(texts: DataFrame) -> list[tuple[bytes, int]]:
    """Words of the toxic training texts with their numbers of distinct contexts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, every in parts(batch.column(1), BATCH_BYTES):
                kinds = batch.column(0).slice(part.start, len(every)).to_pylist()
                seen = set()
                for kind, text in zip(kinds, every):
                    words = _WORDS.findall(folded(text))
                    seen.update(zip([kind] * len(words), [b""] + words, words, words[1:] + [b""]))
                rows = sorted(seen)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.bool_()), *(pa.array([r[i] for r in rows], pa.binary()) for i in (1, 2, 3))], names=["toxic", "before", "word", "behind"]
                )

    used = texts.where("not calibrates").select("toxic", "text").mapInArrow(run, "toxic boolean, before binary, word binary, behind binary").distinct()
    counts = used.groupBy("word").agg(F.count_if("toxic").alias("n"), F.count_if(~F.col("toxic")).alias("others"))
    counts = stored(counts, "words")
    total = counts.agg(F.sum("n"), F.sum("others")).first()
    if not total[0] or not total[1]:
        return []
    often = (F.col("n") >= LEAST_CONTEXTS) & (F.col("n") * F.lit(float(total[1])) >= RATIO * (F.col("others") + 1) * F.lit(float(total[0])))
    return [(bytes(r["word"]), r["n"]) for r in counts.where(often).orderBy(F.desc("n"), "word").limit(MOST_WORDS).collect()]


def word_lines(words: list[tuple[bytes, int]]) -> list[bytes]:
    """Lines of eight words to train on, each word as often as its contexts say, in a fixed mixed order."""
    every = [w for w, n in words for _ in range(min(n, 1000))]
    every = [every[i] for i in np.random.default_rng(8).permutation(len(every)).tolist()]
    return [b" %s " % b" ".join(every[i : i + 8]) for i in range(0, len(every), 8)]


def logistic(x: np.ndarray, y: np.ndarray, keep: float = 0.1) -> np.ndarray:
    """Weights of a logistic regression with a small penalty (Newton steps); features of any scale."""
    mean, scale = x.mean(axis=0), x.std(axis=0)
    mean[0], scale[scale == 0] = 0, 1
    z, w = (x - mean) / scale, np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -500, 500)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + keep * np.eye(len(w)), z.T @ (y - p) - keep * w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    out = w / scale
    out[0] -= (w * mean / scale).sum()
    return out


def fit(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0) -> Model:
    """The model, learnt from labelled documents outside the held-out fold."""
    texts = stored(training_texts(docs, labels, folds, held), "training")
    words = toxic_words(texts)
    ordinary = train(ordinary_windows(texts), ORDINARY_BYTES, level=3)
    toxic = train(word_lines(words), TOXIC_BYTES, k=64, d=8)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, every in parts(batch.column(1), BATCH_BYTES):
                counts = difference_counts(every, ordinary, toxic)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(part.start, len(every)), pa.array(counts.tolist(), pa.list_(pa.int64()))], names=["toxic", "counts"])

    rows = texts.where("calibrates").select("toxic", "text").mapInArrow(run, "toxic boolean, counts array<long>").collect()  # at most 2 * SAMPLE_DOCS
    y = np.asarray([r["toxic"] for r in rows], float)
    model = Model(ordinary, toxic, None, None, float(y.mean()) if len(y) else 0.0)
    if not toxic or not 0 < model.base < 1:
        return model
    counts = np.asarray([r["counts"] for r in rows], np.int64)
    by_class = np.stack([counts[y == c].sum(axis=0) + 1.0 for c in (0, 1)])
    share = by_class / by_class.sum(axis=1, keepdims=True)
    model.ratios = np.log(share[1] / share[0])
    model.weights = logistic(model.features(counts), y)
    return model


def toxicity(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0) -> DataFrame:
    """``doc_id, held_out, score, predicted`` per row of ``docs``; ``labels``: ``doc_id, toxic``."""
    model = fit(docs, labels, folds, held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, every in parts(batch.column(1), BATCH_BYTES):
                scores = model.scores(difference_counts(every, model.ordinary, model.toxic)) if model.weights is not None else model.scores(every)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(part.start, len(every)), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")
    held_out = F.coalesce(~in_training(F.col("doc_id"), folds, held), F.lit(False))
    return rows.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
