"""Sources mixed to target weights along a training run, by inverted cumulative token demand."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloom.operators.skew import running
from gridloom.session import cut

#: The target table is a recipe, not data: more rows are refused.
MAX_SOURCES = 10_000
#: How much the sources that must be repeated most gain in weight from the first to the last token of training.
TILT = 0.5

#: Knots of a weight schedule: (time from 0 to 1, weight), in order, straight in between.
Schedule = Mapping[str, Sequence[tuple[float, float]]]


def tilted(shares: Mapping[str, float], pressure: Mapping[str, float], tilt: float = TILT) -> dict[str, list[tuple[float, float]]]:
    """A schedule whose weights sum to 1 at any time and average to the shares: scarce sources come later.

    pressure says how often a source has to be used; sources above the average gain up to `tilt` of their weight.
    """
    mean = sum(shares[s] * pressure[s] for s in shares)
    most = max((abs(pressure[s] - mean) for s in shares), default=0.0) or 1.0
    return {s: [(0.0, w * (1 - tilt * (pressure[s] - mean) / most)), (1.0, w * (1 + tilt * (pressure[s] - mean) / most))] for s, w in shares.items()}


def segments(knots: Sequence[tuple[float, float]]) -> list[tuple[float, float, float, float, float]]:
    """The integral of a schedule as segments (start, length, weight at start, weight at end, area before), areas summing to 1."""
    area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(knots, knots[1:], strict=False))
    if not area > 0 or any(w < 0 for _, w in knots) or any(b[0] < a[0] for a, b in zip(knots, knots[1:], strict=False)):
        raise ValueError("a schedule needs knots in order of time, weights of at least 0 and some weight above")
    out, before = [], 0.0
    for (t0, w0), (t1, w1) in zip(knots, knots[1:], strict=False):
        out.append((t0, t1 - t0, w0 / area, w1 / area, before))
        before += (t1 - t0) * (w0 + w1) / 2 / area
    return out


def mix(counts: DataFrame, targets: DataFrame, schedule: Schedule | None = None) -> DataFrame:
    """(position, doc_id, source, use_no, n_tokens): the selected uses of documents, in training order.

    counts: doc_id, text_hash, source, n_tokens. targets: source, target_share, max_repeats; repeated rows count once.
    Shares are taken in proportion to their sum over the sources that have tokens; a source without any, with a null or
    non-positive share, or not in targets is not used. The total is the largest at which every source reaches its share
    with at most max_repeats (1 if null) uses of a document, so at least one source is used up. A source's documents are
    laid end to end in a mixed order, once for each use; the k-th token of a source has the position in training at which
    the integral of the source's weight schedule has demanded k tokens, a document that of its middle token. Documents of
    0 tokens demand nothing and are not used. A document is whole; so a source's tokens are off its share by at most
    half a document. schedule: knots for every source; by default tilted().
    """
    rows = targets.select("source", "target_share", "max_repeats").filter(F.col("source").isNotNull() & (F.col("target_share") > 0)).distinct().limit(MAX_SOURCES + 1).collect()
    if len(rows) > MAX_SOURCES or len({r.source for r in rows}) < len(rows):
        raise ValueError(f"targets must name each of at most {MAX_SOURCES} sources once")
    spark = counts.sparkSession
    named = F.broadcast(spark.createDataFrame([(r.source,) for r in rows], "source string"))
    counts = cut(counts.filter(F.col("n_tokens") > 0).join(named, "source", "left_semi"))
    sums = {r.source: (r.t, r.n) for r in counts.groupBy("source").agg(F.sum("n_tokens").alias("t"), F.count(F.lit(1)).alias("n")).collect()}
    rows = [r for r in rows if r.source in sums]
    whole = sum(r.target_share for r in rows)
    shares = {r.source: r.target_share / whole for r in rows}
    uses = {r.source: max(1, r.max_repeats or 1) for r in rows}
    total = min((sums[s][0] * uses[s] / w for s, w in shares.items()), default=0.0)
    demand = {s: total * w for s, w in shares.items()}
    pressure = {s: demand[s] / sums[s][0] for s in shares}
    schedule = schedule or tilted(shares, pressure)
    plan = [(s, float(sums[s][0]), float(demand[s]), int(uses[s]), segments(schedule[s])) for s in shares]
    plans = spark.createDataFrame(plan, "source string, has double, wants double, uses int, segments array<struct<t0:double,h:double,w0:double,w1:double,before:double>>")

    laid = running(counts, ["source"], ["doc_id", "text_hash"], "n_tokens", total=sum(n for _, n in sums.values())).join(F.broadcast(plans), "source")
    middle = F.col("_before") + F.col("n_tokens") / 2
    most = F.least(F.col("uses"), F.ceil((F.col("wants") - middle) / F.col("has"))).cast("int")
    used = laid.withColumn("use_no", F.explode(F.when(most > 0, F.sequence(F.lit(1), most)).otherwise(F.array().cast("array<int>"))))
    goal = ((F.col("use_no") - 1) * F.col("has") + middle) / F.col("wants")
    used = used.withColumn("goal", F.least(goal, F.lit(1.0)))
    part = F.coalesce(F.element_at(F.filter("segments", lambda s: (s["before"] <= F.col("goal")) & (s["h"] > 0)), -1), F.col("segments")[0])
    used = used.withColumn("s", part)
    # Within a segment the area up to x is w0 x + (w1 - w0) x^2 / 2h; this form of the root is stable for flat segments.
    rest = F.col("goal") - F.col("s.before")
    root = F.sqrt(F.greatest(F.lit(0.0), F.col("s.w0") * F.col("s.w0") + 2 * rest * (F.col("s.w1") - F.col("s.w0")) / F.col("s.h")))
    x = F.when(rest <= 0, F.lit(0.0)).otherwise(F.least(F.col("s.h"), 2 * rest / (F.col("s.w0") + root)))
    return used.select((F.col("s.t0") + x).alias("position"), "doc_id", "source", "use_no", "n_tokens").orderBy("position", "doc_id", "use_no")


def share_report(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, target_share, max_repeats, n_uses, most_uses, n_tokens, actual_share) of every source in targets."""
    by = mixed.groupBy("source").agg(F.count(F.lit(1)).alias("n_uses"), F.max("use_no").alias("most_uses"), F.sum("n_tokens").alias("n_tokens"))
    t = targets.select("source", "target_share", "max_repeats").distinct().join(by, "source", "left").na.fill(0, ["n_uses", "most_uses", "n_tokens"])
    whole = F.sum("n_tokens").over(Window.partitionBy(F.lit(1)))  # a row for each source, MAX_SOURCES at most
    return t.withColumn("all", whole).select("source", "target_share", "max_repeats", "n_uses", "most_uses", "n_tokens", F.coalesce(F.try_divide(F.col("n_tokens"), F.col("all")), F.lit(0.0)).alias("actual_share"))
