"""Mixing sources to target weights by weighted fair queueing.

Each source is a flow that offers its documents in shuffled order, as often as the cap allows. An
offer finishes at the virtual time ``words of the source so far / target of the source``; all
offers are served by finish time until the budget (the sum of the targets) is spent. Every source
therefore receives words in proportion to its target, within a document.

Nothing is sorted in one task. A source's running sum is taken over ranges of its shuffled order,
the global one over ranges of finish time; range sums are added up on a small table. The shuffle
is the order of MD5(id), so reruns agree.

Words are runs of non-space characters. A document without words (null, empty) is never taken. A
source whose name is missing comes last. Rows that repeat whole share an order and are served
alike, one after the other; other ties cannot arise, as the order is that of a digest of the id.
Very long texts are counted whole and taken whole. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import running_total, text_or_empty, word_count
from barloom.sinks.writers import written

#: Rows that one window partition of a running sum should hold.
RANGE_ROWS = 20_000


def source_targets(
    sources: DataFrame, weights: Sequence[float], share: float, most: float
) -> DataFrame:
    """``source, source_no, source_size, target`` from one row per source (``source, source_size``).

    Targets divide ``share`` times all sizes by weight. A source stops at ``most`` times its size
    and the excess goes to the others by weight. In order of size over weight the capped sources
    come first; the level that the others share is known at the first source under its cap.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    named = sources.select(
        "source",
        "source_size",
        F.row_number().over(by_name).alias("source_no"),
        F.get(cycle, (F.row_number().over(by_name) - 1) % len(weights)).alias("weight"),
        (F.lit(float(most)) * F.col("source_size")).alias("cap"),
    )
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.orderBy(F.lit(1)).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    level = (
        F.lit(float(share)) * F.sum("source_size").over(everything)
        - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    ) / F.sum("weight").over(rest)
    levelled = named.withColumn("level", level).withColumn(
        "place", F.row_number().over(order)
    )
    free = F.col("cap") > F.col("level") * F.col("weight")
    shared = F.min_by(F.when(free, F.col("level")), F.when(free, F.col("place"))).over(everything)
    fair = shared * F.col("weight")
    return levelled.select(
        "source",
        "source_no",
        "source_size",
        F.when(shared.isNull() | (fair > F.col("cap")), F.col("cap")).otherwise(fair).alias("target"),
    )


def mix_sources(
    docs: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    most: int = 2,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """``doc_id, size, source_size, target, taken, text_hash`` of every row.

    ``taken`` counts repeats; ``text_hash`` (xxhash64) tells rows apart that share an id.
    """
    sized = written(
        docs.select(
            F.col(doc_id).cast("bigint").alias("doc_id"),
            F.col(source).cast("string").alias("source"),
            word_count(text_or_empty(text)).alias("size"),
            F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))).alias("shuffled"),
            F.xxhash64(text_or_empty(text)).alias("tie"),
        ),
        "mix-sizes",
    )
    rows = sized.count()
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = written(source_targets(sources, weights, share, most), "mix-targets").withColumnRenamed(
        "source", "__source"
    )
    # One row per source, written: the planner broadcasts it if its size allows that.
    flows = sized.join(targets, sized["source"].eqNullSafe(targets["__source"])).drop(
        "source", "__source"
    )

    ranges = max(1, -(-rows // range_rows))
    part = F.conv(F.substring("shuffled", 1, 8), 16, 10).cast("double") / float(1 << 32)
    queued = running_total(
        flows.withColumn("__range", F.floor(part * ranges)),
        ["source_no"],
        "__range",
        ["shuffled", "tie", "size"],
        "size",
        "words",
    ).select("doc_id", "source_no", "size", "source_size", "target", "words", "tie")
    queued = written(queued, "mix-queue")

    budget = targets.agg(F.coalesce(F.sum("target"), F.lit(0.0))).first()[0]
    bins = max(1, -(-rows * most // range_rows))

    def offer(round_: int) -> Column:
        finish = (F.lit(round_) * F.col("source_size") + F.col("words")) / F.col("target")
        return F.struct(
            F.floor(finish * bins).alias("bin"),
            finish.alias("finish"),
            F.col("source_no"),
            F.lit(round_).alias("round"),
            F.col("words"),
        )

    valid = (F.col("size") > 0) & (F.col("target") > 0)
    offers = queued.where(valid).select(
        "size", F.explode(F.array(*[offer(r) for r in range(most)])).alias("offer")
    )
    # Virtual time in bins: sums per bin find the bin where the budget runs out.
    by_bin = Window.orderBy("bin")
    totals = (
        offers.groupBy(F.col("offer.bin").alias("bin"))
        .agg(F.sum("size").alias("words"))
        .select("bin", "words", F.sum("words").over(by_bin).alias("end"))
    )
    crossing = totals.where(F.col("end") > budget).orderBy("bin").first()
    if crossing is None:
        served = [F.lit(1).cast("long")] * most
    else:
        start = crossing.end - crossing.words
        in_order = Window.orderBy("offer").rowsBetween(Window.unboundedPreceding, 0)
        last = (
            offers.where(F.col("offer.bin") == crossing.bin)
            .withColumn("total", F.lit(start) + F.sum("size").over(in_order))
            .where(F.col("total") <= budget)
            .agg(F.max("offer").alias("offer"))
            .first()
            .offer
        )
        served = []
        for r in range(most):
            fits = offer(r)["bin"] < crossing.bin
            if last is not None:
                end = F.struct(
                    F.lit(last.bin).cast("bigint").alias("bin"),
                    F.lit(last.finish).alias("finish"),
                    F.lit(last.source_no).alias("source_no"),
                    F.lit(last.round).alias("round"),
                    F.lit(last.words).cast("bigint").alias("words"),
                )
                fits = offer(r) <= end
            served.append(fits.cast("long"))
    times = sum(served[1:], served[0])
    return queued.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        F.when(valid, F.col("size") * times).otherwise(0).cast("bigint").alias("taken"),
        F.col("tie").alias("text_hash"),
    )
