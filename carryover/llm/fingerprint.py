"""Document fingerprints from closed syncmers, in DataFrame functions only.

A text's tokens are its words (a word longer than ``MAX_WORD`` code points
counts as several tokens, so text without blanks has tokens too).  Every run
of ``s`` tokens has a hash.  A run of ``k`` tokens is a closed syncmer if the
least of its ``k - s + 1`` inner hashes is the first or the last one.  That
depends on the run alone, not on what surrounds it, so the same passage gives
the same anchors in any document, and at least one of any ``k - s + 1`` runs
is chosen.  The fingerprint is the anchors in the order of the text: anchors
match by value and keep their relative position.

The likeness of two fingerprints is the share of common anchors among all
distinct anchors of both (Jaccard); two empty texts are alike (1).

At scale: one exchange of the texts, by ranges of their order, brings every document
beside its successor, one range a task.  The order is ``doc_id``, then a hash of the text, then a
hash of the row's place, so an id or a text that a third of the rows share is many ranges
too.  The bounds are rows of a sample (by hash, ``SAMPLE_EACH`` a range), cut into ranges of about
``RANGE_BYTES``; a row finds its range among them in two steps of a square root each.  A range's
first row also travels to the range before it, so no neighbour is missed.  All else is per row.

Cases: a null text is empty; an empty or blank text has no anchors and an
empty fingerprint; a text of fewer than ``k`` tokens has one anchor, its
whole token sequence; rows that repeat an id stand beside each other, equal
texts together; null ids come first; a table of one row is its own next
document; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import pieces_of

K, S = 6, 2
MAX_WORD = 24
RANGE_BYTES = 16 << 20
SAMPLE_EACH = 40


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]{1,%d})" % MAX_WORD), F.lit(1))


def anchors(text: str, k: int = K, s: int = S) -> str:
    """SQL for the anchors (array of int, in the order of the text) of a token array column."""
    w = k - s + 1
    hashes = f"transform(sequence(1, size({text}) - {s - 1}), i -> xxhash64(slice({text}, i, {s})))"
    chosen = (
        f"transform(filter(sequence(1, size(h) - {w - 1}), i -> "
        f"least(h[i - 1], h[i + {w - 2}]) <= array_min(slice(h, i, {w}))), "
        f"i -> hash(slice(h, i, {w})))"
    )
    return (
        f"CASE WHEN size({text}) = 0 THEN cast(array() AS array<int>) "
        f"WHEN size({text}) < {k} THEN array(hash({text})) "
        f"ELSE transform(array({hashes}), h -> {chosen})[0] END"
    )


def spelled(anchors_: str) -> Column:
    """Anchors as hexadecimal words."""
    return F.expr(f"array_join(transform({anchors_}, x -> hex(x & 4294967295L)), ' ')")


def likeness(a: str, b: str) -> Column:
    """Common distinct anchors over all distinct anchors; 1 for two empty ones."""
    return F.expr(
        f"CASE WHEN size({a}) = 0 AND size({b}) = 0 THEN 1.0D "
        f"ELSE CAST(size(array_intersect({a}, {b})) AS DOUBLE) / size(array_union({a}, {b})) END"
    )


def with_fingerprint(df: DataFrame, text: str, name: str, k: int = K, s: int = S) -> DataFrame:
    """Adds column ``name``, the anchors of column ``text``."""
    return df.withColumn("__tokens", tokens(F.col(text))).withColumn(name, F.expr(anchors("__tokens", k, s))).drop("__tokens")


def _place(*columns: Column) -> Column:
    """Numbers as one string in the same order."""
    return F.concat(*[F.lpad(F.hex(c.bitwiseXOR(F.lit(-(2**63)))), 16, "0") for c in columns])


def _cut(sample: list[tuple[str, int]], n: int) -> list[str]:
    """Keys that cut the sample of (key, bytes) into ``n`` ranges of about equal bytes."""
    share, total, out = sum(size for _, size in sample) / n, 0, []
    for key, size in sorted(sample):
        if total >= share * (len(out) + 1) and len(out) < n - 1:
            out.append(key)
        total += size
    return out


def _range(bounds: list[str]) -> Column:
    """How many of the sorted bounds are not above the column ``key``."""
    if not bounds:
        return F.lit(0)
    width = math.isqrt(len(bounds)) + 1
    blocks = [bounds[i : i + width] for i in range(0, len(bounds), width)]
    up_to = "size(filter(split({of}, ','), b -> b <= key))"
    block = up_to.format(of="'" + ",".join(x[0] for x in blocks) + "'")
    inner = up_to.format(of="split('" + ";".join(",".join(x) for x in blocks) + "', ';')[block - 1]")
    return F.expr(f"transform(array({block}), block -> if(block = 0, 0, (block - 1) * {width} + {inner}))[0]")


def with_next(docs: DataFrame) -> tuple[DataFrame, Window]:
    """Rows dealt by ranges of their order, and the window in which a row's successor follows it.

    Rows with ``place = 0`` are the documents, the others copies of ranges' first rows."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.monotonically_increasing_id().alias("row"))
    rows = rows.withColumn("tie", F.xxhash64("text")).withColumn("row", F.xxhash64("row"))
    has, id_ = F.when(F.col("doc_id").isNull(), F.lit("0")).otherwise(F.lit("1")), F.coalesce(F.col("doc_id").cast("long"), F.lit(0))
    rows = rows.withColumn("key", F.concat(has, _place(id_, F.col("tie"), F.col("row"))))
    size = rows.agg(F.sum(F.octet_length("text")).alias("bytes"), F.count("*").alias("n"), F.min("key").alias("first")).first()
    n = pieces_of(size["bytes"], RANGE_BYTES)
    every = max(1, size["n"] // (SAMPLE_EACH * n))
    sample = rows.where(F.pmod("row", F.lit(every)) == 0).select("key", F.octet_length("text") + 1).collect() if n > 1 else []
    bounds = [b for b in _cut([tuple(r) for r in sample], n) if b != size["first"]]
    own = rows.withColumn("range", _range(bounds).cast("int")).withColumn("place", F.lit(0))
    first = F.col("key").isin(bounds) if bounds else F.lit(False)  # a bound is the first row of its range
    firsts = own.where(first).withColumn("range", F.col("range") - 1).withColumn("place", F.lit(1))
    head = rows.where(F.col("key") == size["first"]).limit(1).withColumn("range", F.lit(len(bounds))).withColumn("place", F.lit(2))
    dealt = own.unionByName(firsts).unionByName(head).repartitionById(len(bounds) + 1, "range")
    return dealt, Window.partitionBy("range").orderBy(F.col("place") == 2, F.col("doc_id").asc_nulls_first(), "tie", "row", "place")


def edited_fingerprints(docs: DataFrame, k: int = K, s: int = S) -> DataFrame:
    """``doc_id, n_chars, edited_text, fingerprint, edited_fingerprint, near_edited, near_next``.

    The edited text has its last half replaced by as many first code points of the next document."""
    dealt, order = with_next(docs)
    dealt = with_fingerprint(dealt, "text", "anchors", k, s)
    beside = dealt.select("*", F.lead("text").over(order).alias("next_text"), F.lead("anchors").over(order).alias("next_anchors"))
    rows = beside.where("place = 0").withColumn("n_chars", F.char_length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    rows = rows.withColumn("edited_text", F.concat(F.expr("substr(text, 1, int(n_chars - floor(n_chars / 2)))"), F.substr("next_text", F.lit(1), half)))
    rows = with_fingerprint(rows, "edited_text", "edited_anchors", k, s)
    return rows.select(
        "doc_id", "n_chars", "edited_text",
        spelled("anchors").alias("fingerprint"), spelled("edited_anchors").alias("edited_fingerprint"),
        likeness("anchors", "edited_anchors").alias("near_edited"), likeness("anchors", "next_anchors").alias("near_next"),
    )
