"""Mixing sources to target weights by entropy balancing.

A document's rate, its expected number of copies, is tilted exponentially in its number of words
away from 1 within its bounds 0 and 2: the rates nearest to 1 in entropy whose words meet the
source's target. Newton steps solve the convex dual, one multiplier per source; systematic
rounding makes copies of the rates. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators.ordering import with_sorted_ordinal
from .common import WORD, stored

# Fixed values of the mix: weights by source order, share of all words, copies at most.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
TOLERANCE = 1e-7
# Newton steps and rounds of filling sources; far more than either takes, and going beyond them is an error.
STEPS = 500
# Documents of one source and size whose copies are dealt out in one sorted group.
CELL_ROWS = 20_000
# Single documents per source whose copies change by one to bring the words closer to the target.
CORRECTIONS = 3


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST
) -> DataFrame:
    """``(source, source_size, target)`` from rows ``(source, size, n)``.

    A target is ``min(most * source_size, level * weight)`` with the one level at which all targets add up. The level rises
    until no further source is full: a round is an aggregate over the sources, however many there are, and so
    is the sort that gives them their weights.
    """
    totals = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).cast("long").alias("source_size"))
    ranked = with_sorted_ordinal(totals, F.asc_nulls_last("source"), name="_place")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_place") % len(weights) + 1).cast("int"))
    full = stored(ranked.select("source", "source_size", weight.alias("_weight"), (most * F.col("source_size")).cast("double").alias("_cap")), "caps")
    wanted = share * (full.agg(F.sum("source_size")).first()[0] or 0)
    level, before = 0.0, None
    for _ in range(STEPS):
        reached = F.col("_cap") <= F.lit(level) * F.col("_weight")
        now = full.agg(
            F.count_if(reached).alias("n"), F.coalesce(F.sum(F.when(reached, F.col("_cap"))), F.lit(0.0)).alias("words"),
            F.sum(F.when(~reached, F.col("_weight"))).alias("open"), F.max(F.col("_cap") / F.col("_weight")).alias("top"),
        ).first()
        if now["open"] is None or now["n"] == before:
            level = level if now["open"] else now["top"] or 0.0
            break
        level, before = (wanted - now["words"]) / now["open"], now["n"]
    else:
        raise RuntimeError("the targets of the sources did not settle")
    return full.select("source", "source_size", F.least(F.col("_cap"), F.lit(level) * F.col("_weight")).alias("target"))


def _rate(tilt: Column, size: Column, most: int) -> Column:
    return most / (1 + F.exp(-tilt * size))


def balanced_tilts(
    sizes: DataFrame, targets: DataFrame, *, most: int = MOST, steps: int = STEPS, tolerance: float = TOLERANCE
) -> DataFrame:
    """``(source, tilt)``: the multiplier of each source's word constraint, per word.

    The words of a source as a function of its tilt bend away from 0 on both sides, so Newton
    steps from 0 approach the solution without passing it. A step is a join and an aggregate over
    ``(source, size, n)``, a row per source and size whatever the number of documents. Tilts
    are rounded, so that the order of a sum doesn't show. A source that is full or gets nothing has an
    infinite tilt.
    """
    full = F.col("target") >= most * F.col("source_size")
    open_ = targets.where(~full & (F.col("target") > 0))
    state = stored(open_.select("source", "target", F.lit(0.0).alias("tilt"), F.lit(False).alias("done")), "tilts")
    size, n = F.col("size").cast("double"), F.col("n")
    rate = _rate(F.col("tilt"), size, most)
    slope = rate * (1 - rate / most) * size * size * n
    for _ in range(steps):
        left = state.where("not done")
        if left.isEmpty():
            break
        at = state.withColumnRenamed("source", "_source")
        sums = (
            sizes.join(at, F.col("source").eqNullSafe(F.col("_source")))
            .groupBy("_source")
            .agg(F.first("target").alias("target"), F.first("tilt").alias("tilt"), F.sum(rate * size * n).alias("_words"), F.sum(slope).alias("_slope"))
        )
        short = F.col("target") - F.col("_words")
        met = F.abs(short) <= tolerance * F.col("target")
        step = F.round(F.col("tilt") + F.coalesce(F.try_divide(short, F.col("_slope")), F.lit(0.0)), 12)
        # A step that rounds to nothing is as near as a tilt can come.
        met = met | (step == F.col("tilt"))
        state = stored(
            sums.select(F.col("_source").alias("source"), "target", F.when(met, F.col("tilt")).otherwise(step).alias("tilt"), met.alias("done")),
            "tilts",
        )
    else:
        raise RuntimeError(f"{left.count()} sources do not meet their targets after {steps} steps")
    infinite = F.lit(float("inf"))
    ends = targets.where(full | (F.col("target") <= 0)).select(
        "source", F.when(F.col("target") > 0, infinite).otherwise(-infinite).alias("tilt")
    )
    return state.select("source", "tilt").unionByName(ends)


def with_sizes(docs: DataFrame) -> DataFrame:
    """``docs`` with ``size``, the number of words of ``text``."""
    return docs.withColumn("size", word_count())


def _corrections(placed: DataFrame, targets: DataFrame, most: int) -> DataFrame:
    """``(_s, _z, _t, _fixes)``: per cell, ranks whose copies change by one.

    Each time the document whose size is nearest to what a source lacks or has too much is taken;
    the sums and the choice are aggregates with a row per source.
    """
    same = F.col("source").eqNullSafe(F.col("_s"))
    named = targets.select(F.col("source").alias("_s"), "target")
    chosen = []
    for _ in range(CORRECTIONS):
        words = placed.groupBy("source").agg(F.sum(F.col("copies") * F.col("size")).alias("_words"))
        left = words.join(named, same).select("_s", (F.col("target") - F.col("_words")).alias("_left"))
        room = F.when(F.col("_left") > 0, F.col("copies") < most).otherwise(F.col("copies") > 0)
        miss = F.abs(F.abs("_left") - F.col("size"))
        nearest = (
            placed.where("size > 0").join(left, same).where(room & (miss < F.abs("_left"))).groupBy("_s")
            .agg(F.min(F.struct(miss.alias("miss"), "size", "_salt", "_rank", F.signum("_left").cast("int").alias("step"))).alias("p"))
            .select("_s", F.col("p.size").alias("_z"), F.col("p._salt").alias("_t"), F.col("p._rank").alias("_r"), F.col("p.step").alias("_step"))
        )
        nearest = stored(nearest, "corrections")
        chosen.append(nearest)
        at = same & (F.col("size") == F.col("_z")) & (F.col("_salt") == F.col("_t")) & (F.col("_rank") == F.col("_r"))
        placed = placed.join(nearest, at, "left").select(
            "source", "size", "_salt", "_rank", (F.col("copies") + F.coalesce("_step", F.lit(0))).alias("copies")
        )
    every = chosen[0]
    for more in chosen[1:]:
        every = every.unionByName(more)
    return every.groupBy("_s", "_z", "_t").agg(F.collect_list(F.struct(F.col("_r").alias("rank"), F.col("_step").alias("step"))).alias("_fixes"))


def mix_sources(
    sized: DataFrame, *, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST, seed: int = 42
) -> DataFrame:
    """``sized`` (``doc_id``, ``source``, ``size`` and what else there is) with ``source_size``,
    ``target``, ``rate`` and ``copies``, 0 to ``most``.

    Inside a source the documents are ordered by size, and a copy is made wherever the running sum
    of rates passes a whole number, so the words taken differ from the target by about one
    document; the copies of a few documents then change by one to make up for most of that.
    Running sums go over cells (source, size, salt) and rows are ranked inside a cell of
    about ``CELL_ROWS``, so no source, size or group of copies has to lie in one task. Nothing is
    broadcast that Spark does not know to be small.

    A document without words has rate 0; null source is a source, the last; repeated rows are
    documents of their own; an empty table gives no rows. Columns with the names of the results
    are replaced. ``sized`` is read twice, once for ids, sources and sizes only.
    """
    sized = sized.drop("source_size", "target", "rate", "copies", "_salt", "_draw", "_source")
    sized = sized.withColumn("_source", F.col("source").cast("string")).withColumn("_draw", F.xxhash64("doc_id", F.lit(seed)))
    light = stored(sized.select("doc_id", "_source", "size", "_draw"), "sizes")
    sizes = stored(light.groupBy(F.col("_source").alias("source"), "size").agg(F.count("*").alias("n")), "size_counts")
    targets = stored(source_targets(sizes, weights, share, most), "targets")
    tilts = stored(balanced_tilts(sizes, targets, most=most), "tilts")
    hot = sizes.where(F.col("n") > CELL_ROWS).select(
        F.col("source").alias("_s"), F.col("size").alias("_z"), F.ceil(F.col("n") / CELL_ROWS).cast("int").alias("_salts")
    )

    def salted(df: DataFrame) -> DataFrame:
        found = df.join(hot, F.col("_source").eqNullSafe(F.col("_s")) & (F.col("size") == F.col("_z")), "left")
        return found.withColumn("_salt", F.pmod("_draw", F.coalesce("_salts", F.lit(1)))).drop("_s", "_z", "_salts")

    size = F.col("size").cast("double")
    rate = F.when(size == 0, 0.0).otherwise(_rate(F.col("tilt"), size, most))
    before = Window.partitionBy("source").orderBy("size", "_salt").rowsBetween(Window.unboundedPreceding, -1)
    cells = stored(
        salted(light).groupBy(F.col("_source").alias("source"), "size", "_salt").agg(F.count("*").alias("_n"))
        .join(targets.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
        .join(tilts.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
        .withColumn("rate", rate)
        .withColumn("_before", F.coalesce(F.sum(F.col("rate") * F.col("_n")).over(before), F.lit(0.0)))
        .select(F.col("source").alias("_s"), F.col("size").alias("_z"), F.col("_salt").alias("_t"), "source_size", "target", "rate", "_before"),
        "cells",
    )
    same = F.col("_source").eqNullSafe(F.col("_s")) & (F.col("size") == F.col("_z")) & (F.col("_salt") == F.col("_t"))
    rank = F.row_number().over(Window.partitionBy("_source", "size", "_salt").orderBy("_draw", "doc_id"))
    start = F.col("_before") + (F.col("_rank") - 1) * F.col("rate") + 0.5
    copies = (F.floor(start + F.col("rate")) - F.floor(start)).cast("int")

    def placed(df: DataFrame, cells: DataFrame) -> DataFrame:
        return salted(df).join(cells, same).withColumn("_rank", rank).withColumn("copies", copies)

    first = placed(light, cells).select(F.col("_source").alias("source"), "size", "_salt", "_rank", "copies")
    fixes = _corrections(stored(first, "copies"), targets, most)
    names = [F.col("_s").eqNullSafe(F.col("_fs")), F.col("_z") == F.col("_fz"), F.col("_t") == F.col("_ft")]
    fixed = cells.join(fixes.withColumnsRenamed({"_s": "_fs", "_z": "_fz", "_t": "_ft"}), names, "left").drop("_fs", "_fz", "_ft")
    own = F.filter(F.col("_fixes"), lambda x: x["rank"] == F.col("_rank"))
    step = F.coalesce(F.aggregate(own, F.lit(0), lambda total, x: total + x["step"]), F.lit(0))
    return (
        placed(sized, fixed).withColumn("copies", F.col("copies") + step)
        .drop("_source", "_draw", "_salt", "_s", "_z", "_t", "_before", "_rank", "_fixes")
    )


def repeat_documents(docs: DataFrame) -> DataFrame:
    """The mixed corpus: every row of ``docs`` as often as its copies say."""
    sized = docs.select("doc_id", "source", word_count().alias("size"), F.struct(*docs.columns).alias("_row"))
    mixed = mix_sources(sized).where("copies > 0")
    return mixed.select("_row", F.explode(F.array_repeat(F.lit(0), F.col("copies")))).select("_row.*")
