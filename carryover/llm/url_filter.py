"""URL filter: host/path rules, then a character language-model ratio.

Rules decide what they fit.  Their decisions are also the lesson: accepted and
rejected URLs each have a variable-order Markov model of characters, with
contexts of up to ``ORDER`` characters blended by Witten-Bell smoothing: a
context seen often counts for itself, a rare one leans on its shorter suffix,
an unseen one is its suffix.  A URL's score is its log-likelihood under the
accepted model less that under the rejected one, per character.  A fifth of
the labelled URLs (by hash) is not counted but scored, and the threshold is
where these are split with the least mean error of both classes, or equal
likelihood (0) if that fifth has no example of a class that has some.

At scale, in DataFrame functions only: one row per character of a URL, added
up per distinct ``ORDER + 1``-gram before the shuffle; all shorter contexts
come from these sums.  The score of a distinct gram is worked out once and
joined back to the characters, salted by ``SALTS``, as some grams stand in
every URL (and a host may own a third of them).  The driver sees the
threshold's histogram, ``2 * STEPS + 1`` rows at most.

Cases: a null URL, and one without ``://``, has an empty host and path and fits
no rule; a null or empty URL is blocked; if either class has no example, the
method allows the rest; of rules that fit, the longest wins (of two with
equal length the first by name); repeated rows are judged alike; null ids are
kept; an empty table gives no rows; very long URLs are whole, in time in proportion to
their length; only the two named columns are read, whatever the others are called.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

ORDER = 4
SALTS = 8
STEPS = 1000
STEP = 0.005
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(url, "://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """Then up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(rules: dict[str, str], host: Column, path: Column) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, or nulls.  ``rules``: ``host/path -> verdict``."""
    rule = verdict = F.lit(None).cast("string")
    for name in sorted(rules, key=lambda r: (len(r), [-ord(c) for c in r])):  # later ones win
        of, _, start = name.partition("/")
        fits = ((host == of) | host.endswith("." + of)) & path.startswith("/" + start)
        rule = F.when(fits, F.lit(name)).otherwise(rule)
        verdict = F.when(fits, F.lit(rules[name])).otherwise(verdict)
    return rule, verdict


def grams(url: str = "url") -> Column:
    """Every character of a URL (and its end) with the ``ORDER`` characters before it."""
    body = f"regexp_replace(translate({url}, '{UPPER}', '{LOWER}'), '^[^:/?#]*://', '')"
    padded = f"concat(repeat('\\u0002', {ORDER}), {body}, '\\u0003')"
    # cut into characters once: substr walks from the start of the text for every place
    return F.expr(f"transform(array(split({padded}, '')), u -> transform(sequence(1, size(u) - {ORDER}), i -> array_join(slice(u, i, {ORDER + 1}), '')))[0]")


def gram_scores(counted: DataFrame) -> DataFrame:
    """``gram, score``: log ratio of a gram's last character under both models.

    ``counted``: ``gram, a, r``, the gram's counts in accepted and rejected URLs (0 if in neither)."""
    suffix = F.explode(F.expr(f"transform(sequence(1, {ORDER + 1}), n -> right(gram, n))")).alias("suffix")
    nodes = counted.select("a", "r", suffix).groupBy("suffix").agg(F.sum("a").alias("a"), F.sum("r").alias("r"))
    nodes = stored(nodes.withColumn("context", F.expr("left(suffix, length(suffix) - 1)")), "nodes")
    contexts = nodes.groupBy("context").agg(
        F.sum("a").alias("all_a"), F.sum("r").alias("all_r"), F.count_if(F.col("a") > 0).alias("kinds_a"), F.count_if(F.col("r") > 0).alias("kinds_r")
    )
    nodes = nodes.join(contexts, "context").select("suffix", F.struct(F.length("suffix").alias("n"), "a", "all_a", "kinds_a", "r", "all_r", "kinds_r").alias("node"))
    paths = counted.select("gram", suffix).join(nodes, "suffix").groupBy("gram").agg(F.sort_array(F.collect_list("node")).alias("path"))
    blend = "aggregate(path, 1D / 256, (p, x) -> if(x.all_{c} = 0, p, (x.{c} + x.kinds_{c} * p) / (x.all_{c} + x.kinds_{c})))"
    return paths.select("gram", F.expr(f"ln({blend.format(c='a')}) - ln({blend.format(c='r')})").alias("score"))


def judge(pages: DataFrame, rules: dict[str, str], page_id: str = "page_id", url: str = "url") -> DataFrame:
    """``page_id, host, path, rule, verdict, score, threshold`` for every row."""
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url")).withColumn("host", host).withColumn("path", path)
    rule, verdict = fitting_rule(rules, F.col("host"), F.col("path"))
    rows = rows.withColumn("rule", rule).withColumn("ruled", verdict).withColumn("row", F.xxhash64("page_id", "url"))
    rows = rows.withColumn("held_out", F.pmod(F.xxhash64("url", F.lit("held out")), F.lit(5)) == 0)
    named = rows.where("length(url) > 0")

    counts = lambda v: F.when((F.col("ruled") == v) & ~F.col("held_out"), 1).otherwise(0).alias(v)
    marks = named.select(F.explode(grams()).alias("gram"), counts("allow"), counts("block"))
    counted = marks.groupBy("gram").agg(F.sum("allow").alias("a"), F.sum("block").alias("r"))
    scored = stored(gram_scores(stored(counted, "grams")), "scores")

    salted = scored.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    marks = named.select("row", F.explode(grams()).alias("gram"), F.pmod("row", F.lit(SALTS)).cast("int").alias("salt"))
    summed = marks.join(salted, ["gram", "salt"]).groupBy("row").agg(F.avg("score").alias("score"))
    # equal id and url: equal rows, whose grams were summed together; the mean is the same
    table = stored(rows.join(summed, "row", "left").withColumn("score", F.round(F.coalesce("score", F.lit(0.0)), 9)), "judged")

    bin_ = F.least(F.greatest(F.floor(F.col("score") / STEP), F.lit(-STEPS)), F.lit(STEPS))
    tuned = table.where("ruled is not null").groupBy(bin_.alias("bin"))
    of = lambda v: F.count_if((F.col("ruled") == v) & F.col("held_out"))
    bins = [tuple(r) for r in tuned.agg(of("allow"), of("block"), F.count_if(F.col("ruled") == "allow"), F.count_if(F.col("ruled") == "block")).collect()]
    threshold = best_threshold([b[:3] for b in bins if b[1] or b[2]])
    if threshold == float("-inf") and any(b[3] for b in bins) and any(b[4] for b in bins):
        threshold = 0.0  # only the held-out part lacks a class
    blocked = F.col("url").isNull() | (F.col("url") == "") | (F.col("score") < threshold)
    decided = F.coalesce("ruled", F.when(blocked, "block").otherwise("allow"))
    return table.select("page_id", "host", "path", "rule", decided.alias("verdict"), "score", F.lit(threshold).alias("threshold"))


def best_threshold(bins: list[tuple[int, int, int]]) -> float:
    """The lower edge of the bin from which to allow, with the least mean error of both
    classes; the middle one of equals.  ``-inf`` if a class has no example."""
    allows, blocks = sum(b[1] for b in bins), sum(b[2] for b in bins)
    if not allows or not blocks:
        return float("-inf")
    edges = sorted({b[0] for b in bins} | {b[0] + 1 for b in bins} | {0})
    error = {e: sum(b[1] for b in bins if b[0] < e) / allows + sum(b[2] for b in bins if b[0] >= e) / blocks for e in edges}
    least = min(error.values())
    good = [e for e in edges if error[e] == least]
    return good[len(good) // 2] * STEP
