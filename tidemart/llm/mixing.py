"""Mixing sources to target weights along a time-varying curriculum, with DataFrame operations only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemart.llm.store import written

WORD = r"[^\x20\x09-\x0D]+"
#: Knots (time, intensity) of the schedules that sources follow in turn: early, even and late in training.
SCHEDULES = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.25), (0.5, 1.0), (1.0, 1.75)))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def in_turn(values, rank: Column) -> Column:
    """The value a source of this rank (from 1) gets when ``values`` repeat."""
    return F.element_at(F.array(*[F.lit(float(v)) for v in values]), ((rank - 1) % len(values) + 1).cast("int"))


def targets(sizes: DataFrame, weights=(5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """Words that each source gives, from one row per source (``src``, ``source_size``).

    ``share`` times all words are dealt by weight; a source stops at ``most`` times its size and the rest goes to the
    others by weight. Sources in the order of ``most * size / weight`` fill up one after the other, so the common level
    per unit of weight follows from running sums. The table has a row per source, which one task can order.
    """
    everything = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    cap = F.col("source_size") * F.lit(float(most))
    filling = Window.partitionBy().orderBy(cap / F.col("weight"), "src")
    ranked = sizes.withColumn("rank", F.row_number().over(Window.partitionBy().orderBy("src")))
    level = (
        F.sum("source_size").over(everything) * F.lit(float(share))
        - F.coalesce(F.sum(cap).over(filling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    ) / F.sum("weight").over(filling.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    return (
        ranked.withColumn("weight", in_turn(weights, F.col("rank")))
        .withColumn("level", level)
        .withColumn("open", cap / F.col("weight") > F.col("level"))
        .withColumn("level", F.max(F.when(F.col("open"), F.col("level"))).over(everything))
        .select("src", "source_size", "rank", F.when(F.col("open"), F.col("weight") * F.col("level")).otherwise(cap).alias("target"))
    )


def time_of(part: Column, knots) -> Column:
    """The time at which a source has given this part (0 to 1) of its words: the inverse of its integrated schedule."""
    areas = [(b - a) * (v + w) / 2 for (a, v), (b, w) in zip(knots, knots[1:])]
    total, before, out = sum(areas), 0.0, None
    pieces = []
    for area, ((a, v), (b, w)) in zip(areas, zip(knots, knots[1:])):
        rest = part * F.lit(total) - F.lit(before)
        root = F.sqrt(F.greatest(F.lit(v * v) + rest * F.lit(2 * (w - v) / (b - a)), F.lit(0.0)))
        pieces.append((before / total, F.lit(a) + rest * 2 / F.greatest(root + F.lit(v), F.lit(1e-12))))
        before += area
    for start, time in pieces:
        out = time if out is None else F.when(part >= F.lit(start), time).otherwise(out)
    return out


def decide(
    docs: DataFrame, weights=(5, 2, 1), share: float = 1.5, most: float = 2.0, schedules=SCHEDULES,
    doc_id: str = "doc_id", text: str = "text", source: str = "source", keep: tuple[str, ...] = (), prefix: int = 3,
) -> DataFrame:
    """Decide what the mix takes of every document, and when.

    Within a source, documents stand in the order of md5(doc_id); the mix reads this sequence, a second time where the
    target is above the size, until the target is reached. The document at the end gives only the words still needed.
    The copy that starts after ``x`` of the target's words is read at the time at which the integrated schedule reaches
    ``x``. Returns ``row`` (a struct of the columns in ``keep``), ``doc_id``, ``size``, ``source_size``, ``target``,
    ``taken`` (words, copies counted), ``positions`` (training time of each copy, between 0 and 1) and what breaks ties
    in the order of training: ``src``, ``place`` and ``tie``.

    A null text has size 0, and so have empty ones; documents without words are never taken. A null source is a source
    of its own, after the others. A null doc_id sorts like an empty one; rows with equal ids are rows of their own.
    An empty table gives an empty result. Input columns only travel inside ``row``, so no name can clash.

    Running sums are split: sizes are summed for each source and each value of the first ``prefix`` hex digits, these
    sums are accumulated per source, and documents are ordered within (source, digits), so no source is in one task.
    Words are counted once, into a table without texts in the shared folder.
    """
    lay = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row") if keep else F.lit(None).cast("int").alias("row"),
        F.col(doc_id).alias("doc_id"),
        F.coalesce(F.concat(F.lit("0"), F.col(source)), F.lit("1")).alias("src"),
        word_count(F.col(text)).alias("size"),
        F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))).alias("place"),
        F.md5(F.coalesce(F.col(text), F.lit(""))).alias("tie"),
    ).withColumn("slot", F.substring("place", 1, prefix))
    slim = written(lay.drop("row"), "mix")
    slots = slim.groupBy("src", "slot").agg(F.sum("size").alias("slot_size"))
    goals = targets(slots.groupBy("src").agg(F.sum("slot_size").alias("source_size")), weights, share, most)
    before = Window.partitionBy("src").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = slots.select("src", "slot", F.coalesce(F.sum("slot_size").over(before), F.lit(0)).alias("start")).join(goals, "src")
    within = Window.partitionBy("src", "slot").orderBy("place", "doc_id", "size", "tie").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offset = F.col("start") + F.sum("size").over(within) - F.col("size")
    limit = F.floor(F.col("target") + 0.5)

    def given(copy: int) -> Column:
        return F.least(F.greatest(F.col("limit") - F.col("offset") - F.col("source_size") * copy, F.lit(0)), F.col("size"))

    copies = range(int(-(-most // 1)))
    times = [
        F.when(given(e) > 0, reduce(
            lambda rest, k: F.when((F.col("rank") - 1) % len(schedules) == k, time_of((F.col("offset") + F.col("source_size") * e) / F.col("target"), schedules[k])).otherwise(rest),
            range(len(schedules)), F.lit(None).cast("double")))
        for e in copies
    ]
    rows = (lay if keep else slim.withColumn("row", F.lit(None).cast("int"))).join(starts, ["src", "slot"])
    return rows.withColumn("offset", offset).withColumn("limit", limit).select(
        "row", "doc_id", "size", "source_size", "target", sum((given(e) for e in copies[1:]), given(0)).cast("long").alias("taken"),
        F.array_compact(F.array(*times)).alias("positions"), "src", "place", "tie",
    )


def mix(docs: DataFrame, **options) -> DataFrame:
    """The decisions of ``decide``, its options, in the order of training, untaken documents last."""
    decided = decide(docs, **options)
    return decided.orderBy(F.get("positions", F.lit(0)).asc_nulls_last(), "src", "place", "doc_id", "tie").drop("src", "place", "tie")


def training_order(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus itself: the columns of ``docs``, a row per copy the mix takes, in the order of training.

    A document of which only some words are still needed comes whole. Options are those of ``decide``. The texts move
    twice, to their place in the source and to their place in the training.
    """
    decided = decide(docs, keep=tuple(docs.columns), **options)
    copies = decided.select("row", F.explode("positions").alias("at"), "src", "place", "tie")
    return copies.orderBy("at", "src", "place", "tie").select("row.*")
