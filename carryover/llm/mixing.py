"""Temperature mixing of sources to target weights.

A source with token share ``p`` gets weight ``p**t / sum(p**t)``.  The exponent
``t`` is bisected: lower exponents even the sources out.  ``target_entropy``
(a share of the greatest entropy, ``log(sources)``) fixes it; ``max_repeat``
bounds how often any source may be gone through, and wins if both cannot be
met.  The weights are realised within ``budget`` tokens as block permutations:
a source's documents fall into blocks by hash, each epoch goes through all
blocks in a new order, and the last epoch stops where the source's quota
ends.  ``slot`` tells where in the whole run (0 to 1) a block begins, so
sorting by it interleaves the sources in proportion.  Without a budget the
run is the shortest in which every document appears at least once.

At scale: one aggregation per source and one per block reach the driver's
plan as one row a source (the components of a mixture; their number is not
the corpus size).  Blocks are at most ``MOST_BLOCKS`` a source, so a hot source is
cut into many; the order of blocks and the cut are windows over blocks and
over the documents of the one block in which a quota ends.  Documents meet
the plan (blocks x epochs, small) by a join Spark chooses; texts are not
needed for it but to count words.

Cases: a null source is a source of its own; a document without tokens costs
nothing and appears once, in epoch 0; equal shares get equal weights; rows
that repeat an id and text stay together (all in or all out of an epoch);
null ids are kept; a mixture of one source is that source; an empty table
gives no rows; all columns of the input are kept (one of them named like a
new column stands, and the new one is left out).
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WORD, stored

BLOCK_TOKENS = 2_000_000
MOST_BLOCKS = 1024


def words_in(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def weights_at(shares: list[float], exponent: float) -> list[float]:
    top = max(shares)
    raw = [(s / top) ** exponent for s in shares]
    return [r / sum(raw) for r in raw]


def entropy(weights: list[float]) -> float:
    return -sum(w * math.log(w) for w in weights if w > 0)


def repeats(shares: list[float], weights: list[float], budget: float | None) -> list[float]:
    """How often each source is gone through; ``budget`` in units of all tokens, or none: the least is 1."""
    ratio = [w / s for w, s in zip(weights, shares)]
    scale = 1 / min(ratio) if budget is None else budget
    return [r * scale for r in ratio]


def bisect(bad: float, good: float, is_good: Callable[[float], bool]) -> float:
    """The border between two exponents, on the side where ``is_good`` holds."""
    for _ in range(60):
        middle = (bad + good) / 2
        bad, good = (bad, middle) if is_good(middle) else (middle, good)
    return good


def exponent_for(shares: list[float], budget: float | None = None, target_entropy: float | None = None, max_repeat: float | None = None) -> float:
    """The exponent that meets the targets; ``shares`` are positive and add up to one."""
    if len(set(shares)) == 1:
        if max_repeat is not None and max(repeats(shares, shares, budget)) > max_repeat + 1e-9:
            raise ValueError("the budget asks for more repetitions than allowed")
        return 1.0
    out = 1.0
    if target_entropy is not None:
        wanted = target_entropy * math.log(len(shares))
        out = bisect(0.0, 64.0, lambda t: entropy(weights_at(shares, t)) <= wanted)
    elif max_repeat is not None:
        out = 0.0
    if max_repeat is not None:
        most = lambda t: max(repeats(shares, weights_at(shares, t), budget))
        if most(1.0) > max_repeat + 1e-9:
            raise ValueError("the budget asks for more repetitions than allowed")
        if most(out) > max_repeat + 1e-9:
            out = bisect(out, 1.0, lambda t: most(t) <= max_repeat + 1e-9)
    return out


def mix_sources(
    docs: DataFrame,
    budget_tokens: int | None = None,
    target_entropy: float | None = None,
    max_repeat: float | None = None,
    source: str = "source",
    key: str = "carryover",
) -> DataFrame:
    """``docs`` repeated or thinned to the weights, with ``tokens, epoch, block, slot``."""
    spark = docs.sparkSession
    skey = F.when(F.col(source).isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col(source).cast("string")))
    # the input row as a struct, so that no column of it can clash
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), words_in().alias("tokens"), skey.alias("__source"))
    rows = rows.withColumn("__row", F.xxhash64("row.doc_id", "row.text", "__source"))
    narrow = stored(rows.select("__source", "__row", "tokens"), "tokens")
    totals = [(r[0], r[1]) for r in narrow.groupBy("__source").agg(F.sum("tokens")).orderBy("__source").collect()]
    weighed = [(s, n) for s, n in totals if n > 0]
    quota: dict[str, int] = {}
    if weighed:
        total = sum(n for _, n in weighed)
        shares = [n / total for _, n in weighed]
        budget = None if budget_tokens is None else budget_tokens / total
        t = exponent_for(shares, budget, target_entropy, max_repeat)
        times = repeats(shares, weights_at(shares, t), budget)
        # without a budget no rounding may push a source below one full epoch
        quota = {s: max(n if budget is None else 0, math.floor(n * r + 1e-3)) for (s, n), r in zip(weighed, times)}
    schema = T.StructType([T.StructField("__source", T.StringType()), T.StructField("blocks", T.LongType()), T.StructField("full", T.LongType()), T.StructField("rest", T.LongType()), T.StructField("all", T.LongType()), T.StructField("quota", T.LongType())])
    # one row a source, made here: a hot source's rows need not be brought together to meet it
    plan = spark.createDataFrame(
        [(s, min(MOST_BLOCKS, 1 + n // BLOCK_TOKENS), quota.get(s, 0) // n if n else 0, quota.get(s, 0) % n if n else 0, n, quota.get(s, 0)) for s, n in totals], schema
    )
    block = F.pmod(F.xxhash64("__row", F.lit(key)), F.col("blocks")).cast("int")
    turn = F.xxhash64("__row", F.lit(key), F.col("epoch"))

    # blocks in the order of each epoch, and where each begins in its source's run
    dealt = narrow.join(F.broadcast(plan), "__source").withColumn("block", block)
    blocks = dealt.groupBy("__source", "block", "full", "rest", "all", "quota").agg(F.sum("tokens").alias("held"))
    epochs = blocks.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.greatest(F.col("full") - F.when(F.col("rest") > 0, 0).otherwise(1), F.lit(0)))))
    order = Window.partitionBy("__source", "epoch").orderBy(F.xxhash64("block", "epoch", F.lit(key)), "block")
    epochs = epochs.withColumn("before", F.sum("held").over(order) - F.col("held"))
    allowed = F.when(F.col("epoch") < F.col("full"), F.col("held")).otherwise(F.greatest(F.least(F.col("rest") - F.col("before"), F.col("held")), F.lit(0)))
    slot = F.coalesce((F.col("epoch") * F.col("all") + F.col("before")) / F.nullif(F.col("quota"), F.lit(0)), F.lit(0.0))
    epochs = epochs.select("__source", "block", "epoch", "held", allowed.alias("allowed"), slot.alias("slot"))
    epochs = stored(epochs.where("allowed > 0 or epoch = 0"), "epochs")

    # the block in which a quota ends: its documents in turn, as many as fit
    cut = epochs.where("allowed < held and allowed > 0")
    inside = dealt.select("__source", "block", "__row", "tokens").join(cut, ["__source", "block"]).withColumn("turn", turn)
    run = Window.partitionBy("__source", "block", "epoch").orderBy("turn").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    fits = inside.withColumn("sum", F.sum("tokens").over(run)).where("sum <= allowed")
    upto = fits.groupBy("__source", "block", "epoch").agg(F.max("turn").alias("upto"))
    least, most = F.lit(-(2**63)), F.lit(2**63 - 1)
    steps = epochs.join(upto, ["__source", "block", "epoch"], "left")
    steps = steps.withColumn("upto", F.when(F.col("allowed") == F.col("held"), most).otherwise(F.coalesce("upto", least)))
    steps = stored(steps.select("__source", "block", "epoch", "upto", "slot"), "steps")

    out = rows.join(F.broadcast(plan.select("__source", "blocks")), "__source").withColumn("block", block).join(steps, ["__source", "block"])
    chosen = F.when(F.col("tokens") == 0, F.col("epoch") == 0).otherwise(turn <= F.col("upto"))
    new = [c for c in ("tokens", "epoch", "block", "slot") if c not in docs.columns]
    return out.where(chosen).select("row.*", *new)
