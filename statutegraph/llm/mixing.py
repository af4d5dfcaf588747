"""Mixing sources to target weights along a time-varying curriculum.

A source's share of the mix is its weight's share of all words, held under a
number of passes over what it has.  Over training time, 0 to 1, it is drawn at
a rate that its schedule sets, a piecewise linear curve: the rate's integral is
the source's cumulative demand in words, and inverting that integral at the
words already taken gives a document its training position.  Rows are
range-sorted by position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from .common import WORD, attached, placed_in_order, ranked, row_key, staged

WEIGHTS = (5, 2, 1)
MAX_PASSES = 3
#: Points (time, rate) of a weight schedule, times from 0 to 1; between them the rate is linear.
#: Only its shape counts: a source's rates are scaled so that their integral is its target.
Schedule = tuple[tuple[float, float], ...]
#: By place of the weight in WEIGHTS; sources may be given their own.
SCHEDULES: tuple[Schedule, ...] = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 0.5), (1.0, 1.5)), ((0.0, 0.2), (1.0, 1.8)))


def source_targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_passes: int = MAX_PASSES) -> DataFrame:
    """(source, source_size) to their weight, slope class and target.

    Sources by code point, null last, get the weights in turn.  Target: the
    weight's share of all sizes, at most `max_passes` times the source's size,
    the excess reshared by weight until none is above.  That ends where targets
    are min(cap, level * weight): sources in the order of cap / weight are at
    their cap up to the one whose level, computed from those before it, is
    below its own ratio.  The order and the sums before come from a range shuffle
    and sums by range partition.
    """
    listed, n = ranked(sources, [F.col("source").asc_nulls_last()], "sources")
    if not n:
        return listed.select("source", "source_size", F.lit(0).alias("turn"), F.lit(0.0).alias("target"))
    turn = (F.col("_rank") % F.lit(len(weights))).cast("int")
    of = F.element_at(F.array(*map(F.lit, weights)), F.col("turn") + 1).cast("long")
    listed = listed.withColumn("turn", turn).withColumn("weight", of).withColumn("cap", F.col("source_size") * F.lit(max_passes))
    order = [(F.col("cap") / F.col("weight")).asc(), F.col("_rank").asc()]
    rows = placed_in_order(listed.drop("_part"), order, "source-levels").withColumnRenamed("_row", "_at")
    parts = rows.groupBy("_part").agg(F.sum("cap").alias("c"), F.sum("weight").alias("w"), F.sum("source_size").alias("s")).collect()  # a row for each range partition
    total, all_weight = sum(r["s"] for r in parts), sum(r["w"] for r in parts)
    before, caps, used = [], 0, 0
    for r in sorted(parts, key=lambda r: r["_part"]):
        before.append((r["_part"], caps, used))
        caps, used = caps + r["c"], used + r["w"]
    within = W.partitionBy("_part").orderBy("_at").rowsBetween(W.unboundedPreceding, -1)
    rows = rows.join(F.broadcast(sources.sparkSession.createDataFrame(before, "_part long, _caps long, _used long")), "_part")
    caps_before = F.col("_caps") + F.coalesce(F.sum("cap").over(within), F.lit(0))
    used_before = F.col("_used") + F.coalesce(F.sum("weight").over(within), F.lit(0))
    level = (F.lit(total).cast("long") - caps_before).cast("double") / (F.lit(all_weight).cast("long") - used_before).cast("double")
    rows = rows.withColumn("level", level).withColumn("full", F.col("cap").cast("double") <= F.col("level") * F.col("weight"))
    rows = staged(rows.select("source", "source_size", "turn", "weight", "cap", "level", "full"), "source-targets")
    # From the first source that is not full on, levels fall: its own is the highest of those that are left.
    final = rows.filter(~F.col("full")).agg(F.max("level").alias("level")).collect()[0]["level"]
    target = F.col("cap").cast("double") if final is None else F.least(F.col("cap").cast("double"), F.lit(final) * F.col("weight"))
    return rows.select("source", "source_size", "turn", target.alias("target"))


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def text_digest(text: Column) -> Column:
    """64 bits of a text, which tell rows under one id apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def position_at(words: Column, target: Column, schedule: Schedule) -> Column:
    """The latest time up to which the cumulative demand, the integral of the scaled rate, is `words` of `target`."""
    times, rates = [float(t) for t, _ in schedule], [float(r) for _, r in schedule]
    areas = [(t1 - t0) * (r0 + r1) / 2 for t0, t1, r0, r1 in zip(times, times[1:], rates, rates[1:])]
    if times[0] != 0 or times[-1] != 1 or min(rates) < 0 or any(t1 <= t0 for t0, t1 in zip(times, times[1:])) or sum(areas) <= 0:
        raise ValueError(f"no schedule: {schedule}")
    x = F.greatest(F.lit(0.0), F.least(F.lit(1.0), words / target))
    out, done, upto = F.lit(1.0), 1.0, 1.0
    for i in range(len(areas) - 1, -1, -1):
        done -= areas[i] / sum(areas)
        before = max(0.0, done) if i else 0.0
        rate, slope = rates[i] / sum(areas), (rates[i + 1] - rates[i]) / (times[i + 1] - times[i]) / sum(areas)
        y = F.greatest(F.lit(0.0), x - F.lit(before))
        root = F.sqrt(F.greatest(F.lit(0.0), F.lit(rate * rate) + F.lit(2.0 * slope) * y))
        # 2y / (rate + root) solves slope/2 * u^2 + rate * u = y without cancellation, for slopes of either sign and 0.
        at = F.least(F.lit(times[i + 1]), F.lit(times[i]) + F.lit(2.0) * y / F.greatest(F.lit(rate) + root, F.lit(1e-300)))
        at = F.when(y <= 0, F.lit(times[i])).otherwise(at)
        out = at if i == len(areas) - 1 else F.when(x < F.lit(upto), at).otherwise(out)
        upto = before
    return out


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    max_passes: int = MAX_PASSES,
    schedules: tuple[Schedule, ...] = SCHEDULES,
    of_source: dict[str | None, Schedule] | None = None,
    whole: bool = False,
    seed: str = "mix",
) -> DataFrame:
    """Every document's part in the mix: doc_id, source, size, source_size, target, taken, positions, digest.

    Within a source documents follow in the order of a keyed digest of their id.
    The mix takes passes over them until the source's target in words is met;
    the last document of the last pass is cut there, or with `whole` taken if at
    least half of it is due.  `taken` counts words over all passes; `positions`
    holds the training time (0 to 1) of each copy, none for documents not taken.
    Sources follow `schedules` in the turn of their weights, those named in
    `of_source` their own.  `digest` is a hash of the text.

    Null texts have size 0 and take no part; documents without a word neither; a
    null source is one source; repeated rows count each.  With no words at all
    every target is 0.  Other columns are not looked at.  Reruns agree, and no
    Python runs on the executors.  Texts are read once, for their sizes.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        words_in(F.col(text_col)).alias("size"),
        F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit("")))).alias("draw"),
        text_digest(F.col(text_col)).alias("digest"),
        F.monotonically_increasing_id().alias("tie"),
    )
    rows = staged(rows, "mix-sizes")
    # Null ids draw alike: text and place in the input, as staged, let a range of them be cut.
    order = [F.col("source").asc_nulls_last(), F.col("draw"), F.col("size"), F.col("digest"), F.col("tie")]
    placed = placed_in_order(rows, order, "mix")
    parts = staged(placed.groupBy("source", "_part").agg(F.sum("size").alias("words")), "mix-parts")
    plan = source_targets(parts.groupBy("source").agg(F.sum("words").alias("source_size")), weights, max_passes)
    # For a source there is a row for each range partition at most; all but two parts of each hold that source alone.
    before = F.coalesce(F.sum("words").over(W.partitionBy("source").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select(F.col("source").alias("_s"), F.col("_part").alias("_p"), before.alias("_before"))
    parts = parts.join(plan.withColumnRenamed("source", "_t"), F.col("_s").eqNullSafe(F.col("_t"))).drop("_t")
    within = W.partitionBy("source", "_part").orderBy("_row").rowsBetween(W.unboundedPreceding, -1)
    rows = placed.withColumn("_within", F.coalesce(F.sum("size").over(within), F.lit(0)))
    rows = rows.join(parts, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_part") == F.col("_p")))
    start = F.col("_before") + F.col("_within")
    goal = F.round("target").cast("long")
    rest_of_pass = F.pmod(goal, F.greatest(F.col("source_size"), F.lit(1)))
    passes = ((goal - rest_of_pass) / F.greatest(F.col("source_size"), F.lit(1))).cast("long")  # divides without remainder, at most max_passes
    rest = goal - passes * F.col("source_size") - start
    due = F.greatest(F.lit(0), F.least(F.col("size"), rest))
    due = F.when(F.col("size") == 0, F.lit(0)).when(F.lit(whole), F.when(due * 2 >= F.col("size"), F.col("size")).otherwise(F.lit(0))).otherwise(due)
    rows = rows.withColumns({"_start": start, "_passes": passes, "_due": due.cast("long")})
    copies = F.when(F.col("size") == 0, F.lit(0)).otherwise(F.col("_passes") + (F.col("_due") > 0).cast("long")).cast("int")

    def at(k: Column) -> Column:
        words = (F.col("_start") + k * F.col("source_size")).cast("double")
        out = position_at(words, F.col("target"), schedules[-1])
        for i, schedule in enumerate(schedules[:-1]):
            out = F.when(F.col("turn") % F.lit(len(schedules)) == i, position_at(words, F.col("target"), schedule)).otherwise(out)
        for name, schedule in (of_source or {}).items():
            out = F.when(F.col("source").eqNullSafe(F.lit(name)), position_at(words, F.col("target"), schedule)).otherwise(out)
        return out

    positions = F.when(copies > 0, F.transform(F.sequence(F.lit(0), F.greatest(copies - 1, F.lit(0))), at)).otherwise(F.array().cast(T.ArrayType(T.DoubleType())))
    return rows.select(
        "doc_id", "source", "size", "source_size", "target", (F.col("size") * F.col("_passes") + F.col("_due")).alias("taken"), positions.alias("positions"), "digest"
    )


def training_order(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """A row for each copy that the mix takes: `doc` (all columns), `copy` and `position`, range-sorted by position.

    Ties in position follow by id, then copy.  Documents without a word, null
    texts too, are not taken; very long ones are taken like others; rows that
    repeat have positions each; null ids are documents; an empty table gives
    none; columns may have any name.  Words are counted once: rows find their
    positions again by id, source and a hash of the text.
    """
    mixed = mix(docs, id_col, text_col, source_col, **how)
    own = row_key(F.col(id_col), F.col(source_col), text_digest(F.col(text_col)))
    rows = attached(docs, own, mixed, row_key(F.col("doc_id"), F.col("source"), F.col("digest")), F.col("positions"))
    rows = rows.select("doc", F.posexplode("got").alias("copy", "position"))
    return rows.repartitionByRange(F.col("position"), F.col(f"doc.{id_col}")).sortWithinPartitions("position", f"doc.{id_col}", "copy")
