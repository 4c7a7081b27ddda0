"""Language identification by multilingual mixture inference.

Every language has a character n-gram model: texts are folded to lower case,
every run of ASCII characters that are no letters is one blank, and the
trigrams of bytes of the folded text fall into ``BUCKETS`` hashed cells; a cell's probability
is its smoothed share of the language's training trigrams.  A document is a
bag of cells drawn from a mixture of languages.  Expectation-maximisation
estimates its proportions; the set of languages is chosen by penalised
likelihood: starting from the full mixture, the language with the least
share is dropped while the Bayesian information criterion
(``log likelihood - languages/2 * log(trigrams)``) does not fall.

At scale: counting is one pass, each task sums its texts into one array per
language and emits at most ``BUCKETS`` rows per language it met; Spark adds
them up.  The model has ``BUCKETS x languages`` cells (the number of language
labels is a property of the label set, not of the corpus) and is the only
thing sent to the tasks.  Prediction is one pass without shuffle.  A hot
source, long texts or copies do not matter: nothing is grouped by them.

Cases: a null text or one without a letter is ``und`` with score 0 and no
languages; null labels are not learned from; without any labelled row every
document is ``und``; an empty table gives no rows; equal shares go to the
alphabetically first language; repeated rows are predicted alike; texts are
read whole, a few megabytes at a time; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .textcore import join_texts, parts

BUCKETS = 1 << 15
BATCH_BYTES = 2 << 20
SMOOTHING = 0.5
EM_STEPS = 12
UNDETERMINED = "und"

#: Bytes as the models see them: a-z and every byte beyond ASCII stand, the rest is a blank.
_FOLD = np.full(256, 32, np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def _cells(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Trigram cells of all texts end to end, and ``n + 1`` offsets.

    A folded text is in lower case with one blank for each run of other ASCII
    characters; a text without a letter has no cells."""
    buf, offsets = join_texts([f" {t.lower()} ".encode() if t else b"" for t in texts])
    buf = _FOLD[buf]
    plain = np.concatenate([[0], np.cumsum((buf > 32) & (buf < 128))])[offsets]
    for i in np.flatnonzero((np.diff(plain) == 0) & (np.diff(offsets) > 0)):  # no a-z: is there another letter?
        if not any(c.isalpha() for c in texts[i]):
            buf[offsets[i] : offsets[i + 1]] = 32
    keep = buf != 32
    keep[1:] |= buf[:-1] != 32
    keep[offsets[:-1][np.diff(offsets) > 0]] = True
    offsets = np.concatenate([[0], np.cumsum(keep)])[offsets]
    b = buf[keep].astype(np.uint32)
    if len(b) < 3:
        return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
    code = b[:-2] | (b[1:-1] << np.uint32(8)) | (b[2:] << np.uint32(16))
    code = ((code * np.uint32(2654435769)) >> np.uint32(32 - BUCKETS.bit_length() + 1)).astype(np.int32)
    size = np.maximum(np.diff(offsets) - 2, 0)  # trigrams that stay inside their text
    first = np.repeat(offsets[:-1], size)
    out = np.concatenate([[0], np.cumsum(size)])
    return code[first + np.arange(int(out[-1])) - np.repeat(out[:-1], size)], out


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    """Record batches cut to a bounded number of bytes, with their texts (the last column)."""
    for batch in batches:
        for part, texts in parts(batch.column(batch.num_columns - 1), BATCH_BYTES):
            yield batch.slice(part.start, part.stop - part.start), [None if t is None else t.decode() for t in texts]


def learn(docs: DataFrame, text: str = "text", label: str = "lang") -> DataFrame:
    """Cell counts ``lang, cell, n`` of the rows with a label and a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch, texts in _batches(batches):
            cells, offsets = _cells(texts)
            labels = np.asarray(batch.column(0).to_pylist(), object)
            each = np.repeat(labels, np.diff(offsets))
            for lang in dict.fromkeys(labels):
                counts.setdefault(lang, np.zeros(BUCKETS, np.int64))
                counts[lang] += np.bincount(cells[each == lang], minlength=BUCKETS)
        for lang, n in counts.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(at), pa.string()), "cell": pa.array(at, pa.int32()), "n": pa.array(n[at], pa.int64())})

    rows = docs.select(F.col(label).cast("string"), F.col(text)).where(F.col(label).isNotNull() & F.col(text).isNotNull())
    return rows.mapInArrow(run, "lang string, cell int, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n"))


def fit(counts: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages in alphabetical order and their cell probabilities (languages x cells)."""
    table = counts.toPandas()
    langs = sorted(table["lang"].unique())
    model = np.full((len(langs), BUCKETS), SMOOTHING)
    for i, lang in enumerate(langs):
        own = table[table["lang"] == lang]
        model[i, own["cell"].to_numpy()] += own["n"].to_numpy()
    return langs, model / model.sum(axis=1, keepdims=True)


def mixture(likelihood: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float]:
    """EM for the proportions of one document and the log-likelihood they reach.

    ``likelihood`` is cells x languages, ``weight`` the count of each cell."""
    share = np.full(likelihood.shape[1], 1.0 / likelihood.shape[1])
    total = weight.sum()
    for _ in range(EM_STEPS if len(share) > 1 else 0):
        joint = likelihood * share
        before, share = share, (weight / joint.sum(axis=1)) @ joint / total
        if np.abs(share - before).max() < 1e-3:
            break
    return share, float(weight @ np.log(likelihood @ share))


def infer(likelihood: np.ndarray, weight: np.ndarray) -> dict[int, float]:
    """The chosen languages (index -> share) of one document."""
    chosen = np.arange(likelihood.shape[1])
    share, fit_now = mixture(likelihood, weight)
    price = 0.5 * np.log(weight.sum() + 1)
    while len(chosen) > 1:
        if (live := share > 1e-3).sum() < len(chosen) and live.any():  # shares that EM has all but removed
            rest = chosen[live]
        else:
            rest = np.delete(chosen, len(share) - 1 - np.argmin(share[::-1]))
        part, fit_rest = mixture(likelihood[:, rest], weight)
        if fit_rest - price * len(rest) < fit_now - price * len(chosen):
            break
        chosen, share, fit_now = rest, part, fit_rest
    return dict(zip(chosen.tolist(), share.tolist()))


def predict(docs: DataFrame, langs: list[str], model: np.ndarray, text: str = "text") -> DataFrame:
    """``row, lang_pred, score, lang_shares``: the input row as a struct (so no name can
    clash), the language, its share of the document, and every chosen language's share."""
    shared = docs.sparkSession.sparkContext.broadcast(np.ascontiguousarray(model.T))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        likelihood = shared.value
        for batch, texts in _batches(batches):
            cells, offsets = _cells(texts)
            pred, score, shares = [], [], []
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                if a == b or not langs:
                    pred.append(UNDETERMINED), score.append(0.0), shares.append([])
                    continue
                if b - a > 4096:
                    seen = np.bincount(cells[a:b], minlength=BUCKETS)
                    at = np.flatnonzero(seen)
                    weight = seen[at]
                else:
                    at, weight = np.unique(cells[a:b], return_counts=True)
                found = infer(likelihood[at], weight.astype(float))
                best = max(sorted(found), key=found.get)
                pred.append(langs[best])
                score.append(min(1.0, max(0.0, found[best])))
                shares.append([(langs[i], s) for i, s in sorted(found.items())])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(shares, pa.map_(pa.string(), pa.float64()))],
                names=["row", "lang_pred", "score", "lang_shares"],
            )

    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), F.col(f"`{text}`"))
    schema = T.StructType(rows.schema.fields[:1])
    schema = schema.add("lang_pred", T.StringType()).add("score", T.DoubleType()).add("lang_shares", T.MapType(T.StringType(), T.DoubleType()))
    return rows.mapInArrow(run, schema)


def held_out(doc_id: Column) -> Column:
    """The third of the documents that is never learned from; a null id is not learned from either."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(True))


def identify(docs: DataFrame) -> DataFrame:
    """Learn from the labelled two thirds of ``docs`` and predict every row:
    ``doc_id, held_out, lang_pred, score, lang_shares``."""
    langs, model = fit(learn(docs.where(~held_out(F.col("doc_id")))))
    found = predict(docs.select("doc_id", "text"), langs, model)
    return found.select("row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), "lang_pred", "score", "lang_shares")


def keep_identified(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with a language; a null ``lang`` takes the prediction.
    If no language could be learned: the rows with a letter, ``lang`` as it is."""
    langs, model = fit(learn(docs.where(~held_out(F.col("doc_id")))))
    if not langs:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = predict(docs, langs, model).where(F.col("lang_pred") != UNDETERMINED)
    own = [F.coalesce("row.lang", "lang_pred").alias("lang") if c == "lang" else F.col(f"row.`{c}`") for c in docs.columns]
    return found.select(*own)
